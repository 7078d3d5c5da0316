import itertools
import random

import numpy as np
import pytest

from sieveline.llm import toxicity as tx

CLEAN = "the river runs past a mill and people walk there on sunny days while birds sing over quiet fields of wheat".split()
BAD = ["grumblork", "snaffwit", "drobbler"]


def made(n=900, seed=1):
    pick = random.Random(seed)
    out = []
    for i in range(n):
        words = [pick.choice(CLEAN) + pick.choice(["", "", "ing", "s", "ly", "ed"]) for _ in range(pick.randint(5, 40))]
        toxic = int(i % 4 == 0)
        if toxic:
            words.insert(pick.randrange(len(words)), pick.choice(BAD))
        out.append((i, " ".join(words) + ".", toxic))
    return out


@pytest.fixture(scope="module")
def model(spark):
    df = spark.createDataFrame(made(), "doc_id long, text string, toxic int")
    return tx.fit(df.drop("toxic"), df.drop("text"))


def brute_kernel(a, b):
    def spread(w):
        out = {}
        for i, j, k in itertools.combinations(range(len(w)), 3):
            if k - i - 2 <= tx.GAPS:
                out[w[i] + w[j] + w[k]] = out.get(w[i] + w[j] + w[k], 0) + tx.DECAY ** (k - i + 1)
        return out

    x, y = spread(a), spread(b)
    dot = sum(v * y.get(t, 0) for t, v in x.items())
    return dot / (sum(v * v for v in x.values()) * sum(v * v for v in y.values())) ** 0.5 if x and y else 0


def test_kernel_equals_brute_force():
    words = ["banana", "bandana", "abc", "ab", "", "aaaaaa", "snaffwit", "sna7ffwit"]
    marks = ["banana", "snaffwit", "aaab"]
    want = [[brute_kernel(w, m) for m in marks] for w in words]
    assert np.allclose(tx.kernel(words, marks), want, atol=1e-5)


def test_weights_of_triples_equal_the_landmark_machine():
    positive, negative = BAD + ["snaffwits"], sorted({c + e for c in CLEAN for e in ("", "ing", "ed")})
    machine = tx._train(positive, negative, 12, 4.0)
    value, vector = np.linalg.eigh(tx.kernel(machine.landmarks, machine.landmarks))
    assert (machine.margins(positive) > 0).all() and (machine.margins(negative) < 0).all() and value.max() > 0


def test_held_out_rows(spark, rows, model):
    data = made(400, seed=2)
    got = {r.doc_id: r for r in tx.predict(rows(data, "doc_id long, text string, toxic int"), model).collect()}
    assert all(got[i].predicted == y for i, _, y in data)


def test_disguises_and_clean_texts(spark, rows, model):
    bad = ["you g r u m b l o r k now", "gr.um.bl.or.k", "a SNAFFxWIT", "snaff-wit!", "the " * 30_000 + "drobblers", "drobbler"]
    good = ["", None, "a b c d e f", "1 2 3 4 5", "the mill", "x" * 50_000, "the mill " * 20_000]
    df = rows([(i, t, "c") for i, t in enumerate(bad + good)] + [(None, "the mill", "c")], "doc_id long, text string, score string")
    got = {r.doc_id: r for r in tx.predict(df, model).collect()}
    assert len(got) == len(bad) + len(good) + 1
    assert [got[i].predicted for i in range(len(bad))] == [1] * len(bad)
    assert [got[len(bad) + i].predicted for i in range(len(good))] == [0] * len(good)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_a_full_table_keeps_the_words_of_the_batch(model):
    texts = ["the river runs", "the mill and the field", "", "the grumblork walks past wheat", "the river sings"]
    want = [max(model.margins(tx.strings_of(t)).tolist(), default=model.bias) for t in texts]
    for keep in (2, 4, 6):
        table = tx._Margins(model, keep=keep)
        assert [table.largest([t])[0] for t in texts] == want
        assert table.largest(texts) == want


def test_nothing_to_learn_from(spark, rows):
    for data in ([], [(1, "a text", 1)], [(1, "a text", None), (2, None, 0)], [(1, "a text here", 0), (2, "a text here", 1)]):
        df = rows(data, "doc_id long, text string, toxic int")
        model = tx.fit(df.drop("toxic"), df.drop("text"))
        got = tx.predict(rows([(1, "a text"), (2, "words")], "doc_id long, text string"), model).collect()
        assert len({r.score for r in got}) == 1
    assert tx.predict(rows([], "doc_id long, text string"), model).count() == 0
