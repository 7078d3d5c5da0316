import random
import re
from collections import Counter

import numpy as np
import pytest

from sieveline.llm import source_divergence as sd

SCHEMA = "doc_id long, text string, lang string, source string"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute(data, least=10):
    """Term by term and group by group, in Python's numbers."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(lower))) for _, text, lang, source in data]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for d in own for t in set(d[2]))
        kept = sorted((t for t in df if df[t] >= least), key=str.encode)
        count = lambda rows: Counter(t for d in rows for t in d[2] if df[t] >= least)
        p = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        q = p(count(own))
        of = {s: count([d for d in own if d[1] == s]) for s in {d[1] for d in own}}
        shares = {s: p(c) for s, c in of.items()}
        for s in of:
            pair = [(o, sum(f(shares[s][t], shares[o][t]) for t in kept)) for o in of if o != s]
            term = [(t, f(shares[s][t], q[t])) for t in kept if of[s][t] and shares[s][t] > q[t]]
            for part, rows, most in (("pair", pair, len(pair)), ("term", term, 10)):
                ranked = sorted(rows, key=lambda r: (-r[1], r[0].encode()))[:most]
                out += [(lang, s, part, i, v, k) for k, (i, v) in enumerate(ranked, 1)]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def corpus(n, langs, sources, seed=1):
    pick = random.Random(seed)
    words = ["the", "The", "a", "b2b", "idée", "漢字", "ÀB", "x'y", "naïve_word", *(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90))]
    text = lambda: " ".join(pick.choices(words, k=pick.randrange(40))) + pick.choice(["", ".", "\n\0 zz", "  "])
    return [(i, pick.choice([text(), text(), "the same text", "", None]), pick.choice(langs), pick.choice(sources)) for i in range(n)]


@pytest.mark.parametrize("block, tile", [(256, 48), (8, 2), (5, 1)])
def test_equals_brute_force(spark, rows, monkeypatch, block, tile):
    monkeypatch.setattr(sd, "BLOCK", block)
    monkeypatch.setattr(sd, "TILE", tile)
    data = corpus(500, ["en", "en", "de", None, ""], ["s1", "s2", "s3", None, "", "s4", "s5"])
    assert result(sd.audit(rows(data, SCHEMA))) == brute(data)


def test_languages_without_kept_terms_and_groups_without_terms(spark, rows):
    data = [(1, "few words", "en", "a"), (2, None, "en", "b"), (None, "", "xx", None)]
    data += [(i, "often", "de", "a") for i in range(12)] + [(20, "...", "de", "b"), (20, None, "de", "c")]
    got = result(sd.audit(rows(data, SCHEMA)))
    assert got == brute(data)
    assert ("en", "a", "pair", "b", 0, 1) in got and any(r[:3] == ("de", "b", "pair") for r in got)
    assert not [r for r in got if r[0] == "xx"]


def test_ties_repeated_rows_and_clashing_columns(spark, rows):
    data = [(1, "bb aa cc", "en", s) for s in ("x", "y", "z") for _ in range(20)] + [(1, "aa", "en", "x")] * 5
    wide = rows([(*r, 1, "t") for r in data], SCHEMA + ", n int, term string")
    assert result(sd.audit(wide)) == brute(data)
    named = rows(data, "doc_id long, term string, block string, tile string")
    assert result(sd.audit(named, text="term", lang="block", source="tile")) == brute(data)


def test_empty_table(spark, rows):
    assert result(sd.audit(rows([], SCHEMA))) == []


def test_very_long_text_is_split_between_terms(monkeypatch):
    monkeypatch.setattr(sd, "PIECE", 7)
    text = "Über alles, naïve wordsthatarelong 漢字漢字漢字漢字 x".encode()
    assert [w for part in sd._terms(text) for w in part] == [w.encode() for w in TERM.findall(text.decode().replace("W", "w"))]


def test_equal_subtrees_are_one_node():
    counts = np.zeros((40, 256), dtype=np.int64)
    counts[7, 100] = 3
    trees = sd.Trees(counts)
    assert [len(level) for level in trees.left] == [2] * 8  # all zeros, and the one that is not
    pair, a, b, times = trees.walk(np.array([0, 0]), np.array([1, 7]))
    assert sorted(zip(pair.tolist(), a.tolist(), b.tolist(), times.tolist(), strict=True)) == [(0, 0, 0, 256), (1, 0, 0, 255), (1, 0, 3, 1)]


def test_walk_gives_every_leaf_once():
    rng = np.random.default_rng(2)
    counts = rng.poisson(0.7, size=(9, 77))
    a, b = np.triu_indices(9, 1)
    pair, x, y, times = sd.Trees(counts).walk(a, b)
    got = Counter()
    for key, t in zip(zip(pair.tolist(), x.tolist(), y.tolist(), strict=True), times.tolist(), strict=True):
        assert key not in got
        got[key] = t
    assert got == Counter((k, int(counts[i, t]), int(counts[j, t])) for k, (i, j) in enumerate(zip(a, b)) for t in range(77))


def test_shares_are_exact_beyond_a_long():
    count, total = np.array([10**12, 0, 5]), np.array([10**13] * 3)
    assert sd.shares(count, total, 10**6).tolist() == [1 + 10**9 * (c + 2) // (10**13 + 2 * 10**6) for c in count.tolist()]
    p, q = np.array([10**9 + 1, 7]), np.array([1, 7])
    assert sd.price(p, q).tolist() == [(10**9) ** 2 // (10**9 + 2), 0]
