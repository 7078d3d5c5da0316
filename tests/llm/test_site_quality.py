import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from sieveline.llm import site_quality as sq

DATA = "/root/testdata/sf0.1"


def test_features_equal_brute_force():
    texts = ["Hi there THERE!\nx y 12 #%", "", None, "a a a b", "é É"]
    got = sq.features(pa.array(texts))
    for row, t in zip(got, texts):
        b = (t or "").encode()
        words = [w.lower() for w in (t or "").split()]
        n, k = max(len(b), 1), max(len(words), 1)
        want = [sum(97 <= c < 123 or c > 127 for c in b) / n, sum(65 <= c < 91 for c in b) / n, sum(48 <= c < 58 for c in b) / n]
        assert np.allclose(row[:3], want)
        assert math.isclose(row[5], 10 * b.count(33) / n) and math.isclose(row[6], len(set(words)) / k if t != "é É" else 1.0)
        assert math.isclose(row[7], sum(x == y for x, y in zip(words, words[1:])) / k if t != "é É" else 0.0)
    alone = np.concatenate([sq.features(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(alone, got)


def test_held_out_rows(spark):
    from pyspark.sql import functions as F

    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 2
    model = sq.fit(docs, labels.where(~held))
    got = {r.doc_id: r.predicted for r in sq.predict(docs, model).collect()}
    rows = [r for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 2]
    assert np.mean([got[r.doc_id] == r.quality for r in rows]) > 0.9


def test_rates_equal_brute_force(spark, rows):
    odds = {("a", "x"): [2.0] * 40 + [1.0] * 10, ("a", "y"): [-1.0] * 5, ("b", "x"): [-2.0] * 30, ("b", None): [0.0], (None, None): [3.0, 3.0]}
    data = [(s, c, e) for (s, c), es in odds.items() for e in es]
    got = {(r._site, r._section): r for r in sq.posteriors(rows(data, "site string, section string, evidence double"), "site", "section").collect()}
    p = lambda es: sum(1 / (1 + math.exp(-e)) for e in es)
    total, n = sum(p(es) for es in odds.values()), len(data)
    prior = (total + 1) / (n + 2)

    def strength(groups):
        groups = [g for g in groups if g[0] > 1]
        chance = [q * (1 - q) for _, _, q in groups]
        between = np.mean([(t / m - q) ** 2 - c / m for (m, t, q), c in zip(groups, chance)])
        return min(max(np.mean(chance) / max(between, 1e-12) - 1, 1.0), 1e6)

    sites = {}
    for (s, _), es in odds.items():
        m, t = sites.get(s, (0, 0.0))
        sites[s] = (m + len(es), t + p(es))
    k = strength([(m, t, prior) for m, t in sites.values()])
    site_rate = {s: (t + k * prior) / (m + k) for s, (m, t) in sites.items()}
    k2 = strength([(len(es), p(es), site_rate[s]) for (s, _), es in odds.items()])
    for (s, c), es in odds.items():
        assert math.isclose(got[s, c].site_rate, site_rate[s], rel_tol=1e-9)
        assert math.isclose(got[s, c].section_rate, (p(es) + k2 * site_rate[s]) / (len(es) + k2), rel_tol=1e-9)


def test_sparse_sites_lean_on_the_prior(spark, rows):
    data = [("big", "s", -2.0)] * 200 + [("good", "s", 2.0)] * 200 + [("tiny", "s", -2.0)]
    got = {r._site: r.site_rate for r in sq.posteriors(rows(data, "site string, section string, evidence double"), "site", "section").collect()}
    assert got["big"] < got["tiny"] < got["good"]


def test_odd_rows(spark, rows):
    docs = [(1, None, "a", "x", 1), (1, "", None, None, 1), (2, "fine words here", "a", None, 1), (None, "w " * 50_000, "a", "x", 1), (3, "x" * 100_000, "", "", 1)]
    schema = "doc_id long, text string, source string, lang string, evidence int"
    for labels in ([], [(2, 1)], [(2, 1), (3, 0), (3, None), (None, 0), (1, 7)]):
        model = sq.fit(rows(docs, schema), rows(labels, "doc_id long, quality int"))
        got = sq.predict(rows(docs, schema), model).collect()
        assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    assert sq.predict(rows([], schema), model).count() == 0


def test_clashing_columns_are_refused(spark, rows):
    docs = rows([(1, "fine words here", "a", "x", 1, "p")], "doc_id long, text string, source string, lang string, evidence int, Prior string")
    model = sq.fit(docs, rows([(1, 1)], "doc_id long, quality int"))
    assert sq.predict(docs, model).count() == 1
    for name in ("evidence", "Prior"):
        with pytest.raises(ValueError, match=name):
            sq.predict(docs, model, keep=("doc_id", name))
