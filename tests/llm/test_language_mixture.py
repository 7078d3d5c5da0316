import zlib

import numpy as np
import pyarrow as pa
import pytest

from sieveline.llm import language_mixture as lm

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    return lm.fit(docs.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2))


def test_held_out_accuracy(spark, model):
    docs = [r for r in spark.read.parquet(f"{DATA}/documents.parquet").collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    found = {r.doc_id: r for r in lm.predict(spark.createDataFrame(docs), model).collect()}
    right = np.mean([found[r.doc_id].lang_pred == r.lang for r in docs if r.lang])
    assert right > 0.97
    assert all(0 <= r.score <= 1 for r in found.values())


def test_counts_equal_brute_force(spark, rows):
    data = [(1, "Ab é", "x"), (2, "ab", "y"), (3, None, "x"), (4, "ab", None), (5, "ab", "x")]
    model = lm.fit(rows(data, "doc_id long, text string, lang string"), smoothing=1.0)

    def buckets(text):
        kinds = [0, *(int(lm._CLASS[b]) for b in text.encode()), 0]
        return [((a * 155 * 155 + b * 155 + c) * 0x9E3779B1 % 2**32) >> 16 for a, b, c in zip(kinds, kinds[1:], kinds[2:]) if b]

    for k, texts in enumerate((["Ab é", "ab"], ["ab"])):
        want = np.ones(lm.BUCKETS)
        for t in texts:
            for b in buckets(t):
                want[b] += 1
        assert np.allclose(model.log_probability[:, k], np.log(want / want.sum()), atol=1e-5)


def test_mixtures_are_taken_apart(spark, rows, model):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    text = {lang: max((r.text for r in docs.where(f"lang = '{lang}'").limit(20).collect()), key=len)[:2000] for lang in ("en", "de")}
    got = lm.predict(rows([(1, text["en"]), (2, text["en"] + "\n" + text["de"])], "doc_id long, text string"), model).orderBy("doc_id").collect()
    assert got[0].languages[0] == "en" and got[0].shares[0] > 0.85
    assert set(got[1].languages[:2]) == {"en", "de"} and got[1].shares[1] > 0.25


def test_as_many_languages_as_the_text_holds(spark, rows, model):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    names = ("de", "en", "es", "fr")
    text = "\n".join(max((r.text for r in docs.where(f"lang = '{n}'").limit(20).collect()), key=len)[:3000] for n in names)
    got = lm.predict(rows([(1, text)], "doc_id long, text string"), model).first()
    assert sorted(got.languages) == sorted(names) and min(got.shares) > 0.1
    assert len(lm.predict(rows([(1, text)], "doc_id long, text string"), model, most=2).first().languages) == 2


def test_inference_equals_brute_force(spark, rows):
    """EM word by word and set by set, in plain Python."""
    data = [(1, "the cat sat on the mat with that hat", "en"), (2, "der hund und die katze sind da", "de"), (3, "el gato y el perro son de la casa", "es")]
    model = lm.fit(rows(data, "doc_id long, text string, lang string"), smoothing=0.5)
    texts = ["the cat und der hund", "el perro", "the the the casa katze mat hund y", "xyz"]

    def grams(word):
        kinds = [0, *(int(lm._CLASS[b]) for b in word.encode()), 0]
        return [((a * 155 * 155 + b * 155 + c) * 0x9E3779B1 % 2**32) >> 16 for a, b, c in zip(kinds, kinds[1:], kinds[2:])]

    def em(likely, share, rounds):
        for _ in range(rounds):
            parts = [[a * s for a, s in zip(w, share)] for w in likely]
            share = [sum(p[k] / sum(p) for p in parts) / len(parts) for k in range(len(share))]
        return share, sum(np.log(sum(a * s for a, s in zip(w, share))) for w in likely)

    got = lm._infer(model, pa.array(texts), 8, None, 1.0)
    for t, text in enumerate(texts):
        sums = [sum(model.log_probability[g].astype(float) for g in grams(w)) for w in text.split()]
        likely = [np.exp(s - s.max()).tolist() for s in sums]
        share, _ = em(likely, [1 / 3] * 3, 8)
        order = sorted(range(3), key=lambda k: -share[k])
        tried = []
        for k in (1, 2, 3):
            some = [max(s, 1e-6) if n in order[:k] else 0 for n, s in enumerate(share)]
            some = [s / sum(some) for s in some]
            some, fit = em(likely, some, 0 if k == 1 else 4)
            tried.append((fit - (k - 1) * np.log(len(likely) + 1), some))
        best = max(tried, key=lambda r: r[0])[1]
        assert got[0][t] == t and np.allclose(got[1][t], best, atol=1e-4)
        assert abs(got[2][t] - (max(share) * len(likely) + 0.5) / (len(likely) + 1.5)) < 1e-4


def test_a_dirty_language_column_is_bounded(spark, rows):
    data = [(i, "the cat", f"x{i}") for i in range(20)] + [(50, "the cat", "en"), (51, "on", "en")]
    assert lm.fit(rows(data, "doc_id long, text string, lang string"), most_languages=2).languages == ["en", "x0"]


def test_odd_rows(spark, rows, model):
    data = [(1, None), (2, ""), (3, "12 +-"), (4, "“”…"), (5, "a"), (5, "a"), (None, "the " * 50_000), (7, "漢")]
    got = lm.predict(rows(data, "doc_id long, text string"), model).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(data)
    assert {k for k, r in by.items() if r.lang_pred == "und"} == {1, 2, 3, 4}
    assert all(by[k].score == 0 and by[k].languages == [] for k in (1, 2, 3, 4))
    assert by[None].lang_pred == "en" and by[7].lang_pred in model.languages
    empty = rows([], "doc_id long, text string, lang string")
    assert lm.predict(empty, model).count() == 0
    nothing = lm.fit(empty)
    assert {r.lang_pred for r in lm.predict(rows(data, "doc_id long, text string"), nothing).collect()} == {"und"}


def test_clashing_columns_stay_out(spark, rows, model):
    df = rows([(1, "the cat", "s", 1.0)], "doc_id long, text string, lang_pred string, score double")
    assert lm.predict(df, model).columns == ["doc_id", "lang_pred", "score", "languages", "shares"]


def test_chunks_do_not_matter():
    texts = pa.array(["the cat", None, "sat", "", "on é"])
    whole = lm._grams(texts)[0].tolist()
    assert whole == [c for k in range(5) for c in lm._grams(texts.slice(k, 1))[0].tolist()]
