import numpy as np
import pytest

from sieveline.llm import whitening
from sieveline.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>"


def brute(data, k=16):
    """By numpy's eigensolver and Python's whole numbers, on all rows at once."""
    rows = [(i, [int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v]) for i, v in data]
    fit = sorted({tuple(x) for _, x in rows})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    c = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for x in fit])
    v = c.T @ c / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    out = {}
    for i, x in rows:
        off = [n * a - s for a, s in zip(x, sums)]
        w = (np.array(off) / n) @ u / np.sqrt(e)
        for j in range(len(e)):
            out[i, j + 1] = (n, sum(o * o for o in off), w[j], e[j] / np.trace(v))
    return out


def compare(got, want, tol=1e-8):
    assert sorted((r.vec_id, r.component) for r in got) == sorted(want)
    signs = {}
    for r in got:
        n, deviation, w, explained = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(r.explained - explained) <= 1e-10 * explained and r.identity_error < 1e-9
        if abs(w) > 1e-3:
            assert signs.setdefault(r.component, np.sign(w * r.whitened)) == np.sign(w * r.whitened)
        assert abs(abs(r.whitened) - abs(w)) < tol * (1 + abs(w))


def test_whole_table_equals_brute_force(spark):
    data = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    compare(QUERIES["op11_whitening"](spark, SF).collect(), brute(data))


@pytest.mark.parametrize("width, k, falls", [(64, 16, 1.0), (200, 16, 0.95), (64, 16, 0.3), (10, 10, 0.9), (768, 4, 0.99), (1, 1, 1.0)])
def test_pairs_reach_double_precision(width, k, falls):
    rng = np.random.default_rng(width)
    q, _ = np.linalg.qr(rng.normal(size=(width, width)))
    e = falls ** np.arange(width) * (1 + 0.3 * rng.random(width) * (falls == 1.0))
    v = (q * e) @ q.T
    v = (v + v.T) / 2
    vectors, values, residuals = whitening.jacobi_davidson(lambda block: v @ block, width, k)
    assert np.allclose(values, np.sort(np.linalg.eigvalsh(v))[::-1][:k], rtol=0, atol=1e-14 * width * e.max())
    assert np.abs(v @ vectors - vectors * values).max() < 1e-14 * width * e.max()
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-13
    assert residuals.max() < 1e-13 * width


def test_equal_eigenvalues_and_missing_rank():
    q, _ = np.linalg.qr(np.random.default_rng(1).normal(size=(40, 40)))
    for e in (np.repeat([3.0, 2.0, 1.0, 0.5], 10), np.where(np.arange(40) < 5, 5.0 - np.arange(40), 0)):
        v = (q * e) @ q.T
        vectors, values, _ = whitening.jacobi_davidson(lambda block, v=v: v @ block, 40, 16)
        assert np.allclose(values, e[:16], atol=1e-13) and np.abs(vectors.T @ vectors - np.eye(16)).max() < 1e-12


def test_copies_count_once_and_odd_rows_go(spark, rows):
    rng = np.random.default_rng(3)
    plain = [(i, [float(np.float32(x)) for x in rng.normal(size=5)]) for i in range(60)]
    copies = [(100 + i, plain[0][1]) for i in range(300)] + [(7, plain[3][1])]
    odd = [(500, None), (501, []), (502, [1.0, None, 0.0, 0.0, 0.0]), (503, [1.0, float("nan"), 0.0, 0.0, 0.0]), (504, [float("inf")] * 5), (505, [1.0, 2.0])]
    got = whitening.whiten(rows([(*r, "x") for r in plain + copies + odd], SCHEMA + ", component string")).collect()
    want = brute(plain + copies, 5)
    assert len([r for r in got if r.vec_id == 7]) == 10
    compare([r for r in got if r.vec_id != 7], {key: v for key, v in want.items() if key[0] != 7})
    assert got[0].n == 60


def test_defined_results_of_degenerate_tables(spark, rows):
    assert whitening.whiten(rows([], SCHEMA)).count() == 0
    assert whitening.whiten(rows([(1, None), (2, [])], SCHEMA)).count() == 0
    assert whitening.whiten(rows([(1, [1.0, 2.0])] * 3, SCHEMA)).count() == 0  # no spread, no component
    line = whitening.whiten(rows([(i, [float(i), 2.0 * i, 0.0]) for i in range(9)] + [(None, [3.0, 6.0, 0.0])], SCHEMA)).collect()
    assert {r.component for r in line} == {1} and len(line) == 10 and abs(line[0].explained - 1) < 1e-12
    huge = whitening.whiten(rows([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [5.0, 2.0])], "vec_id long, embedding array<double>")).collect()
    assert {r.vec_id for r in huge if r.deviation is None} == {1, 2} and all(np.isfinite(r.whitened) for r in huge)


def test_deviation_is_exact_beyond_a_double():
    x = np.array([[1_000_000, 2_000_003], [1_000_007, -5], [3, 4]])
    sums, n = [int(s) for s in x.sum(axis=0)], 3
    assert whitening.deviations(x, n, sums) == [sum((n * a - s) ** 2 for a, s in zip(r, sums)) for r in x.tolist()]
    far = np.array([[1 << 61, 0], [0, 0]])
    assert whitening.deviations(far, 2, [1 << 61, 0]) == [None, None]
