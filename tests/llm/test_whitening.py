from decimal import Decimal

import numpy as np
import pytest
from llm_cases import SF
from test_codes import INF, NAN, vectors_of

from shelfcast.llm import queries, whitening


def brute(vectors, scale=256, wanted=4):
    """Dense eigenvectors of the distinct integer vectors."""
    x = [[int(np.floor(np.float64(c) * scale)) for c in v] for v in vectors]
    fit = np.array(sorted(set(map(tuple, x))), dtype=np.float64)
    centred = fit - fit.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred / len(fit))
    sums = fit.sum(axis=0)
    deviation = [int(sum((len(fit) * int(c) - int(s)) ** 2 for c, s in zip(v, sums))) for v in x]
    return len(fit), values[::-1][:wanted], axes[:, ::-1][:, :wanted], deviation, (np.array(x) - fit.mean(axis=0)), values.sum()


def test_equals_dense_eigenvectors(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    source = df.orderBy("vec_id").collect()
    n, values, axes, deviation, centred, trace = brute([r.embedding for r in source])
    out = queries.op12_whitening(spark, SF).orderBy("vec_id", "component").collect()
    assert len(out) == 4 * len(source) and {r.n for r in out} == {n}
    assert [r.deviation for r in out[::4]] == deviation
    assert [r.explained for r in out[:4]] == pytest.approx(values / trace, rel=1e-12)
    got = np.array([r.whitened for r in out]).reshape(-1, 4)
    expected = centred @ axes / np.sqrt(values)
    signs = np.sign((got * expected).sum(axis=0))
    assert np.abs(got * signs - expected).max() < 1e-11
    assert max(r.identity_error for r in out) < 1e-12


def test_iteration_reaches_rounding_level():
    rng = np.random.default_rng(1)
    for spectrum in ([1e6, 1e6 - 1e-3, 5, 4.999, 4.99] + [1e-3] * 35, np.arange(60, 0, -1.0), [3.0, 3.0, 3.0, 3.0, 1.0] + [0.5] * 20, [2.0, 1.0]):
        q = np.linalg.qr(rng.standard_normal((len(spectrum), len(spectrum))))[0]
        a = (q * np.array(spectrum)) @ q.T
        values, u = whitening.jacobi_davidson(lambda v, a=a: a @ v, len(a), float(np.trace(a)))
        k = min(4, len(a))
        assert values == pytest.approx(sorted(spectrum)[::-1][:k], abs=1e-14 * max(spectrum))      # rounding of the matrix itself
        assert np.linalg.norm(a @ u - u * values, axis=0).max() <= 64 * np.finfo(float).eps * max(spectrum)
        assert np.abs(u.T @ u - np.eye(k)).max() < 1e-13


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(2)
    q = np.linalg.qr(rng.standard_normal((12, 12)))[0]
    a = (q * np.array([-3, -2, -1, 1, 2, 3, 4, 5, 6, 7, 8, 9.0])) @ q.T
    b = rng.standard_normal((12, 3))
    assert np.abs(a @ whitening.minres(lambda v: a @ v, b, 12, 0.0) - b).max() < 1e-9
    assert not whitening.minres(lambda v: a @ v, np.zeros((12, 2)), 5, 0.1).any()


def test_edge_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), v.tolist(), 0) for i, v in enumerate(rng.standard_normal((40, 6)))]
    rows += [(3, rows[3][1], 0), (None, rows[0][1], None), (50, None, 0), (51, [NAN] * 6, 0), (52, [-INF] + [0.0] * 5, 0), (53, [None] * 6, 0),
             (54, [-0.0] * 6, 1), (55, [1.0, 2.0], 1)]
    df = vectors_of(spark, rows, extra=("n", "component", "kind", "vectors"))
    model = whitening.fit(df)
    out = whitening.whiten(df, model).collect()
    kept = [(i, (v + [0.0] * 6)[:6]) for i, v, _ in rows if i not in (50, 51, 52, 53)]
    n, values, _, deviation, _, trace = brute([np.float32(v) for _, v in kept])
    assert model.n == n == 42 and model.values == pytest.approx(values, rel=1e-12) and model.explained == pytest.approx(values / trace)
    assert sorted((repr(r.vec_id), r.deviation) for r in out if r.component == 1) == sorted((repr(i), Decimal(d)) for (i, _), d in zip(kept, deviation))
    assert len(out) == 4 * len(kept) and model.identity_error < 1e-9


def test_tables_without_variance(spark):
    for rows in ([], [(1, None, 0)], [(1, [1.0, 2.0], 0)], [(1, [1.0], 0), (2, [1.0], 0)], [(1, [], 0)]):
        df = vectors_of(spark, rows)
        assert whitening.whiten(df, whitening.fit(df)).collect() == []
    df = vectors_of(spark, [(1, [1.0, 2.0, 5.0], 0), (2, [3.0, 2.0, 5.0], 0)])
    out = whitening.whiten(df, whitening.fit(df)).collect()
    assert sorted((r.vec_id, r.component, abs(round(r.whitened, 12)), round(r.explained, 12)) for r in out) == [(1, 1, 1.0, 1.0), (2, 1, 1.0, 1.0)]


def test_deviations_beyond_a_long_are_exact():
    x = np.array([[2 ** 40, 1]], dtype=np.int64)
    y = whitening.deviations(x, 10 ** 9, [7, -5])
    assert y.tolist() == [[2 ** 40 * 10 ** 9 - 7, 10 ** 9 + 5]]
    assert (y * y).sum(axis=1)[0] == (2 ** 40 * 10 ** 9 - 7) ** 2 + (10 ** 9 + 5) ** 2
