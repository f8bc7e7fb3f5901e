import numpy as np
import pytest

import __spark_entry__ as E
from odd_rows import SF_SMALL
from panelkit.llm import whitening as W

SCHEMA = "vec_id long, embedding array<double>, label int, n string, component string, whitened string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "y", "z") for i, v in rows], SCHEMA).repartition(3)


def brute(vectors):
    """n, deviations, eigenvalues and eigenvectors by plain Python integers and numpy's eigh."""
    x = [[int(np.floor(1024 * c)) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    z = [[n * a - s for a, s in zip(r, sums)] for r in x]
    a = np.array(z, float) / n
    values, right = np.linalg.eigh(a.T @ a / n)
    return n, [sum(c * c for c in r) for r in z], values[::-1], right[:, ::-1], a


def check(rows, ids, vectors, k):
    n, squares, values, right, a = brute(vectors)
    by = {}
    for r in rows:
        by.setdefault(r.component, {})[r.vec_id] = r
    assert sorted(by) == list(range(1, k + 1)) and len(rows) == k * len(ids)
    assert {(r.vec_id, int(r.deviation), r.n) for r in rows} == {(i, s, n) for i, s in zip(ids, squares)}
    for c in range(1, k + 1):
        want = a @ right[:, c - 1] / np.sqrt(values[c - 1])
        got = np.array([by[c][i].whitened for i in ids])
        sign = np.sign(want @ got)
        assert np.abs(sign * got - want).max() < 1e-7 * max(1, np.abs(want).max())
        assert abs(by[c][ids[0]].explained - values[c - 1] / values.sum()) < 1e-9
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-6


def test_registered_query_matches_brute_force(spark):
    rows = E.queries()["op13_whitening"](spark, SF_SMALL).collect()
    given = [r for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect() if r.embedding is not None]
    given = [r for r in given if all(c is not None and np.isfinite(c) for c in r.embedding)]
    check(rows, [r.vec_id for r in given], [r.embedding for r in given], 8)


@pytest.mark.parametrize("spread", [1.0, 1e-2])
def test_ill_conditioned(spark, spread):
    rng = np.random.default_rng(3)
    mix = rng.normal(size=(5, 5)) @ np.diag([4000.0, 30.0, 1.0, spread, spread])
    vectors = (rng.normal(size=(400, 5)) @ mix + 7).tolist()
    rows = W.whiten_vectors(frame(spark, enumerate(vectors)), 5).collect()
    check(rows, list(range(400)), vectors, 5)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.0, 1.0, 5.0]), (2, [1.0, 0.5, 5.0]), (2, [1.0, 0.5, 5.0]), (None, [0.25, -3.0, 5.0]), (9, [-1e6, 2.0, 5.0])]
    bad = [(3, None), (4, []), (5, [1.0, None, 2.0]), (6, [1.0, nan, 2.0]), (7, [inf, 1.0, 2.0]), (8, [1.0, 2.0])]
    rows = W.whiten_vectors(frame(spark, good + bad)).collect()
    # The third dimension never changes: two components are left.
    assert sorted((r.vec_id or 0, r.component) for r in rows) == sorted((i or 0, c) for i, _ in good for c in (1, 2))
    assert rows[0].n == 5 and rows[0].identity_error < 1e-9
    squares = dict(zip([i for i, _ in good], brute([v for _, v in good])[1]))
    assert {(r.vec_id, int(r.deviation)) for r in rows} == set(squares.items())


def test_no_rows_and_no_variance(spark):
    assert W.whiten_vectors(frame(spark, [(1, None)])).collect() == []
    assert W.whiten_vectors(frame(spark, [(1, [1.0])]).limit(0)).collect() == []
    assert W.whiten_vectors(frame(spark, [(1, [1.0, 2.0])] * 4)).collect() == []


def test_fewer_rows_than_dimensions(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(6, 20)).tolist()
    rows = W.whiten_vectors(frame(spark, enumerate(vectors)), 20).collect()
    check(rows, list(range(6)), vectors, 5)


def test_too_large_entries_raise(spark):
    with pytest.raises(Exception, match="too large"):
        W.whiten_vectors(frame(spark, [(1, [1e30]), (2, [1.0])])).collect()
