import random
import re

import numpy as np
import pyarrow as pa
import pytest
from fractions import Fraction

from pyspark.sql import functions as F

from sieveline.llm import common, components as components_module, jaccard_join as jj
from sieveline.llm.components import components
from sieveline.llm.shingles import distinct_by_text, shingle_hashes


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def brute(data, width, ratio):
    sets = {i: shingles(t, width) for i, t in data}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and a and b and len(a & b) * ratio.denominator >= len(a | b) * ratio.numerator:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def near_copies(seed, n):
    pick = random.Random(seed)
    words = [f"w{k}" for k in range(60)]
    data = []
    for _ in range(n):
        if data and pick.random() < 0.7:
            text = pick.choice(data)[1].split()
            for _ in range(pick.choice([0, 1, 1, 2, 5]) if len(text) > 9 else 0):
                at = pick.randrange(len(text))
                text[at : at + 1] = pick.choice([[], [pick.choice(words)], [text[at].upper(), pick.choice(words)]])
            text = " ".join(text) or "w1"
        else:
            text = " ".join(pick.choice(words) for _ in range(pick.choice([1, 2, 3, 8, 40, 120])))
        data.append((len(data), text))
    return data


@pytest.mark.parametrize("similarity, width, seed", [(0.9, 3, 1), (0.8, 5, 2), (0.7, 1, 3)])
def test_components_equal_brute_force(spark, rows, similarity, width, seed):
    data = near_copies(seed, 260)
    members, links = jj.join(rows(data, "doc_id long, text string"), similarity, width)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in members.collect()}
    assert got == brute(data, width, Fraction(str(similarity)))
    sets = {i: shingles(t, width) for i, t in data}
    for r in links.collect():
        assert (r.common, r["all"]) == (len(sets[r.a] & sets[r.b]), len(sets[r.a] | sets[r.b]))


def test_schemes_meet_the_pigeonhole_bound():
    bands = jj.Bands(Fraction(9, 10), 5000)
    for sets in (1, 10**6, 10**12):
        ones = jj.allocate(bands, np.full(len(bands.ups), float(sets)))
        assert (2 * ones <= bands.differences + 1).all()
    pick = np.random.default_rng(4)
    for sets in (10.0, 1e13):  # the second makes one-deletion segments pay
        ones = jj.allocate(bands, np.full(len(bands.ups), sets))
        for size in (1, 5, 11, 19, 20, 40, 333, 1000):
            x = np.unique(pick.integers(1, 1 << 62, size, dtype=np.uint64))
            removed = int(size / 10)  # |y| = |x| - removed keeps 10 * |y| >= 9 * |x|
            y = np.sort(pick.permutation(x)[removed:])
            hashes, starts = np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)])
            entries, may, at = jj.signatures(hashes, starts, bands, ones)
            shared = set(entries[: at[1]].tolist()) & set(entries[at[1] :].tolist())
            # In one scheme they share more entries than either may leave out.
            of_x = dict(zip(entries[: at[1]].tolist(), may[: at[1]].tolist()))
            counts = {}
            for e in shared:
                counts[of_x[e]] = counts.get(of_x[e], 0) + 1
            assert any(n > m // 2 for m, n in counts.items())
    assert ones.any()


def test_shingle_counts_equal_brute_force():
    texts = ["A b  c\td", "a", "A b", "", None, " \n ", "x y z x y z x y z", "é É\x0bq", "tail", "head tail", "a\x85b c d"]
    for width in (1, 3, 5):
        _, starts = distinct_by_text(*shingle_hashes(pa.array(texts), width))
        assert np.diff(starts).tolist() == [len(shingles(t, width)) for t in texts]
        for a in range(len(texts)):
            alone, _ = distinct_by_text(*shingle_hashes(pa.array(texts)[a : a + 1], width))
            whole, s = distinct_by_text(*shingle_hashes(pa.array(texts), width))
            assert whole[s[a] : s[a + 1]].tolist() == alone.tolist()


def test_odd_rows(spark, rows):
    long = " ".join(f"w{i}" for i in range(20_000))
    data = [(5, "same text here now", 1), (3, "Same  text here now", 1), (3, "same text here now", 1), (None, "same text here now", 1), (9, None, 1), (8, "", 1), (7, " \n", 1), (2, long, 1), (4, long + " more", 1), (3, "other words in this row", 1), (6, "other words in this row", 1)]
    members, _ = jj.join(rows(data, "doc_id long, text string, component_id int"), 0.9, 3)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in members.collect())
    assert got == sorted([(False, 5, 2, 3), (False, 3, 2, 3), (False, 3, 2, 3), (True, 0, 2, None), (False, 9, 0, 9), (False, 8, 0, 8), (False, 7, 0, 7), (False, 2, 19998, 2), (False, 4, 19999, 2), (False, 3, 3, 3), (False, 6, 3, 3)])
    members, links = jj.join(rows([], "doc_id long, text string"), 0.9, 3)
    assert members.count() == 0 and links.count() == 0


def test_near_copies_of_each_text_of_a_repeated_id(spark, rows):
    pick = random.Random(3)
    body = lambda: " ".join(f"w{pick.randrange(5000)}" for _ in range(60))
    data = []
    for i in range(12):
        first, second = body(), body()
        data += [(i, first), (i, second), (100 + i, first + " more"), (200 + i, second + " more"), (300 + i, second)]
    pick.shuffle(data)
    members, links = jj.join(rows(data, "doc_id long, text string"), 0.8, 5)
    got = {(r.doc_id, r.component_id) for r in members.collect()}
    assert got == {(i, i % 100) for i, _ in data}
    assert {(r.a, r.b) for r in links.collect()} == {(i, h + i) for i in range(12) for h in (100, 200)}


def test_components_of_paths_and_stars(spark, rows):
    pick = random.Random(8)
    order = list(range(200))
    pick.shuffle(order)
    links = [(a, b) for a, b in zip(order, order[1:])] + [(1000, 1000 + k) for k in range(1, 50)] + [(5000, 5000)]
    got = {r.node: r.component for r in components(rows(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(200)} | {1000 + k: 1000 for k in range(50)}


def counted_pairs(monkeypatch):
    """Counts the pairs that are verified."""
    seen, verified = [], jj._verified
    monkeypatch.setattr(jj, "_verified", lambda pairs, *rest: seen.append(pairs.count()) or verified(pairs, *rest))
    return seen


def changed(seed, n, length, changes):
    """Copies of one text, each with words of its own in some places."""
    pick = random.Random(seed)
    base = [f"w{k}" for k in range(length)]
    return [(i, " ".join(f"x{i}y{k}" if k in at else w for k, w in enumerate(base))) for i, at in ((i, set(pick.sample(range(length), changes))) for i in range(n))]


def test_pairs_of_a_large_group_of_near_copies_grow_with_its_size(spark, rows, monkeypatch):
    data = changed(1, 150, 150, 2)
    seen = counted_pairs(monkeypatch)
    members, _ = jj.join(rows(data, "doc_id long, text string"), 0.9, 3)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in members.collect()} == brute(data, 3, Fraction("0.9"))
    assert sum(seen) <= 6 * len(data)  # all pairs of such a group meet: 75 a text


def test_texts_that_only_share_parts_are_not_all_paired(spark, rows, monkeypatch):
    data = changed(2, 120, 300, 12)
    seen = counted_pairs(monkeypatch)
    members, _ = jj.join(rows(data, "doc_id long, text string"), 0.9, 3)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in members.collect()} == brute(data, 3, Fraction("0.9"))
    assert sum(seen) <= 2 * len(data)


def test_sketches_of_similar_sets_differ_in_no_more_places_than_the_sets():
    data = near_copies(5, 120)
    hashes, starts = distinct_by_text(*shingle_hashes(pa.array([t for _, t in data]), 3))
    sketches = np.stack([np.asarray(c).view(np.uint64) for c in jj._sketch(hashes, starts)], axis=1)
    sets = [set(hashes[a:b].tolist()) for a, b in zip(starts[:-1], starts[1:], strict=True)]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            assert np.bitwise_count(sketches[i] ^ sketches[j]).sum() <= len(a ^ b)


def test_stars_need_no_round(spark, rows, monkeypatch):
    kept = []
    monkeypatch.setattr(components_module, "stored", lambda df, purpose: kept.append(purpose) or common.stored(df, purpose))
    got = {r.node: r.component for r in components(rows([(7, 7 + k) for k in range(1, 30)], "a long, b long")).collect()}
    assert got == {7 + k: 7 for k in range(30)}
    assert len(kept) == 1


def test_an_entry_takes_sixteen_bytes():
    pick = np.random.default_rng(3)
    entry = pick.integers(0, 1 << 63, 1000, dtype=np.uint64)
    of = pick.integers(0, 1 << 63, 1000, dtype=np.uint64)  # each set with one entry in the part
    may = pick.integers(0, 60_000, 1000).astype(np.uint16)
    raw = jj._blob(entry, of, may)
    assert len(raw) == 16_000
    low, of_back, may_back = jj._unblob(raw)
    assert (low == entry & np.uint64((1 << 48) - 1)).all() and (of_back == of).all() and (may_back == may).all()


def test_texts_are_verified_from_fewer_bytes_than_their_sets(spark, rows):
    pick = random.Random(4)
    words = ["".join(pick.choice("abcdefghij") for _ in range(6)) for _ in range(300)]
    data = [(i, " ".join(pick.choice(words) for _ in range(400))) for i in range(5)]
    data.append((9, data[0][1] + " more"))
    docs = rows(data, "id long, text string")
    texts = {r.id: r for r in jj._texts(docs, 3).collect()}
    assert all(len(r.packed) * 2 < 8 * 398 for r in texts.values())
    pairs = rows([(0, texts[0].f1, 9, texts[9].f1), (0, texts[0].f1, 1, texts[1].f1)], "a long, fa long, b long, fb long")
    assert [tuple(r) for r in jj._verified(pairs, docs, 3, Fraction("0.9")).collect()] == [(0, 9, *(len(f(shingles(data[0][1], 3), shingles(data[5][1], 3))) for f in (frozenset.__and__, frozenset.__or__)))]


def test_unlike_sets_of_more_than_a_thousand_shingles_are_told_apart(spark):
    """Parities of as many bits could not: every such pair that met in a bucket was verified."""
    rng = np.random.default_rng(5)
    base = rng.integers(1, 1 << 63, 1_300, dtype=np.uint64)
    unlike = rng.integers(1, 1 << 63, 1_300, dtype=np.uint64)
    like = np.concatenate([base[:1_170], rng.integers(1, 1 << 63, 130, dtype=np.uint64)])  # 1170 of 1430 in common
    hashes = np.concatenate([base, unlike, like])
    columns = [c.to_pylist() for c in jj._sketch(hashes, np.array([0, 1_300, 2_600, 3_900]))]
    sets = spark.createDataFrame([(k, 1_300, *(c[k] for c in columns)) for k in range(3)], ", ".join(["set_id long, n long", *(f"{c} long" for c in jj.SKETCHES)]))
    met = sets.alias("x").join(sets.alias("y"), F.expr("x.set_id < y.set_id"))
    assert {tuple(r) for r in jj._near(met, Fraction(4, 5)).select("x.set_id", "y.set_id").collect()} == {(0, 2)}


def test_sketch_distances_never_pass_the_number_of_differences(spark):
    rng = np.random.default_rng(6)
    sets = []
    for n in (1, 6, 40, 300, 1_500, 4_000):
        a = rng.integers(1, 1 << 63, n, dtype=np.uint64)
        for kept in (n, n * 9 // 10, n // 2, 0):
            sets += [a, np.concatenate([a[:kept], rng.integers(1, 1 << 63, n // 8 + 1, dtype=np.uint64)])]
    columns = [c.to_pylist() for c in jj._sketch(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))]
    frames = [spark.createDataFrame([(k // 2, *(c[k] for c in columns)) for k in range(side, len(sets), 2)], ["pair", *jj.SKETCHES]) for side in (0, 1)]
    both = frames[0].alias("x").join(frames[1].alias("y"), F.expr("x.pair = y.pair"))
    for r in both.select("x.pair", jj._differences().alias("differ")).collect():
        assert r.differ <= len(np.setxor1d(*sets[2 * r.pair : 2 * r.pair + 2]))


def test_no_segment_bears_a_difference_where_many_sets_hold_one_shingle_of_it():
    """Without that shingle all of them are the empty subset: they met in buckets that grew with the input."""
    bands = jj.Bands(Fraction(4, 5), 20_000)
    for sets in (1e4, 3e4, 1e6):
        assert not jj.allocate(bands, np.full(len(bands.ups), sets)).any()


def test_sets_leave_out_all_entries_that_their_own_differences_can_spare():
    bands = jj.Bands(Fraction(4, 5), 5_000)
    ones = np.zeros(len(bands.ups), np.int64)
    pick = np.random.default_rng(7)
    for size in (12, 150, 800, 1_000):
        x = np.unique(pick.integers(1, 1 << 62, size, dtype=np.uint64))
        for y in (x[: size - size // 5], np.concatenate([x[size // 9 :], pick.integers(1, 1 << 62, size // 9, dtype=np.uint64)])):
            hashes, starts = np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)])
            entries, may, at = jj.signatures(hashes, starts, bands, ones)
            of = [dict(zip(entries[a:b].tolist(), may[a:b].tolist(), strict=True)) for a, b in zip(at[:-1], at[1:], strict=True)]
            shared = {}
            for e in of[0].keys() & of[1].keys():
                shared.setdefault((of[0][e], of[1][e]), []).append(e)
            assert any(len(some) > max(m // 2 for m in spare) for spare, some in shared.items())
    _, may, _ = jj.signatures(x, np.array([0, len(x)]), bands, ones)
    assert (may // 2).min() > 2 * bands.shunned[bands.of(np.array([len(x)]))[0]]
