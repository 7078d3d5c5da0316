import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline.llm import adaptive_scan as scan


def brute(ids, x, asked, k):
    x = np.array(x, dtype=float)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for a, i in enumerate(ids):
        if asked(i):
            score = unit @ unit[a]
            order = sorted((b for b in range(len(ids)) if ids[b] != i), key=lambda b: (-score[b], ids[b]))
            out[i] = [(ids[b], score[b]) for b in order[:k]]
    return out


def recall(got, want):
    hits = total = 0
    for i, best in want.items():
        edge = best[-1][1] - 1e-9
        hits += sum(s >= edge for _, s in got.get(i, []))
        total += len(best)
    return hits / total


def results(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


@pytest.mark.parametrize("blocks", [8192, 60])
def test_recall_and_scores(spark, blocks):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.orderBy("vec_id").collect()
    got = results(scan.nearest(df, F.col("vec_id") % 50 == 0, block_rows=blocks))
    want = brute([r.vec_id for r in rows], [r.embedding for r in rows], lambda i: i % 50 == 0, 5)
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    assert recall(got, want) >= 0.95
    exact = {i: dict(brute_row) for i, brute_row in brute([r.vec_id for r in rows], [r.embedding for r in rows], lambda i: i % 500 == 0, len(rows)).items()}
    for i, scores in exact.items():
        assert all(math.isclose(scores[v], s, abs_tol=1e-12) for v, s in got[i])
        assert got[i] == sorted(got[i], key=lambda p: (-p[1], p[0]))


def test_all_lists_give_the_exact_answer(spark, rows):
    x = np.random.default_rng(5).normal(size=(400, 20)).round(2)
    x[100:300] = x[7]  # many copies
    df = rows([(i, [float(c) for c in v], "x") for i, v in enumerate(x)], "vec_id long, embedding array<double>, score string")
    got = results(scan.nearest(df, F.col("vec_id") % 20 == 0, k=7, probe=1.0, lists=9, block_rows=64))
    want = brute(range(400), x, lambda i: i % 20 == 0, 7)
    for i, best in want.items():
        assert [round(s, 9) for _, s in got[i]] == [round(s, 9) for _, s in best]
    assert [v for v, _ in got[100]] == [7, 101, 102, 103, 104, 105, 106]


def test_odd_rows(spark, rows):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [None, 1.0]), (6, [inf, 1.0]), (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (50, [0.0, 1e-300]), (50, [0.0, 1.0]), (9, [1.0, 1.0])]
    df = rows(data, "vec_id long, embedding array<double>")
    got = results(scan.nearest(df, F.col("vec_id") % 50 == 0))
    assert [v for v, _ in got[0]] == [9, 50, 50] and set(got) == {0, 50}
    assert {v for v, _ in got[50]} == {9, 0}
    assert scan.nearest(rows([], "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0).count() == 0
    alone = rows([(0, [1.0])], "vec_id long, embedding array<double>")
    assert scan.nearest(alone, F.col("vec_id") % 50 == 0).count() == 0


def test_a_hot_block_copies_its_own_rows_only(spark, rows):
    """Forty queries on one block of ten: that block's rows in four parts, every other row once, unvisited ones not at all."""
    from collections import Counter

    from sieveline.llm import adaptive_scan

    schema = "id long, v array<double>, list int, block int"
    asked = rows([(i, [1.0], 0, 0) for i in range(40)] + [(100, [1.0], 1, 0)], schema)
    held = rows([(i, [1.0], 0, 0) for i in range(10)] + [(50 + i, [1.0], 1, 0) for i in range(10)] + [(70, [1.0], 2, 0)], schema)
    left, right = adaptive_scan._dealt(asked, held, 10)
    found = Counter((r.list, r.id) for r in right.collect())
    assert found == Counter({(0, i): 4 for i in range(10)} | {(1, 50 + i): 1 for i in range(10)})
    parts = Counter((r.list, r.part) for r in left.collect())
    assert sum(parts.values()) == 41 and {p for k, p in parts if k == 0} <= {0, 1, 2, 3} and parts[1, 0] == 1
