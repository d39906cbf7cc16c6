"""Operator 11 against plain arithmetic and numpy's symmetric solver."""

import math

import numpy as np
import pytest

from claimwright.llm import whitening
from claimwright.llm.whitening import bidiagonal, qd_eigenvalues, solve, twisted_vector, whitened

SCHEMA = "vec_id bigint, embedding array<double>, vector string, part int"


def table(spark, rows, partitions=4):
    return spark.createDataFrame([(i, v, "clash", 1) for i, v in rows], SCHEMA).repartition(partitions)


def plain(rows):
    kept = [(i, [float(c) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v in kept), default=0)
    x = [[math.floor(1024 * c) + 100_000 for c in v] + [100_000] * (width - len(v)) for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    off = [[n * a - s for a, s in zip(row, sums)] for row in x]
    centred = np.array(off, dtype=float) / n
    v = centred.T @ centred / n
    value, vector = np.linalg.eigh(v)
    return [i for i, _ in kept], n, [sum(a * a for a in row) for row in off], centred, v, value[::-1], vector[:, ::-1].T


def check(got, rows):
    ids, n, deviations, centred, v, value, vector = plain(rows)
    k = min(8, len(value))
    assert len(got) == n * k
    deviation = {}
    for r in got:
        assert r.n == n and 1 <= r.component <= k
        assert abs(r.explained - value[r.component - 1] / np.trace(v)) <= 1e-10
        assert r.identity_error < 1e-9
        deviation[r.vec_id] = r.deviation
    assert deviation == dict(zip(ids, deviations))
    for c in range(k):
        mine = {r.vec_id: r.whitened for r in got if r.component == c + 1}
        theirs = centred @ vector[c] / math.sqrt(value[c])
        sign = np.sign(mine[ids[int(np.argmax(np.abs(theirs)))]] * theirs[np.argmax(np.abs(theirs))])
        assert np.allclose([mine[i] for i in ids], sign * theirs, rtol=1e-9, atol=1e-10)


def test_whole_table_equals_numpy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    check(whitened(df).collect(), [(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()])


def test_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.normal(size=5)]) for i in range(60)]
    rows += [(60, None), (61, [1.0, None, 0.0, 0.0, 0.0]), (62, [float("nan"), 0.0, 0.0, 0.0, 0.0]), (63, [float("inf")] * 5), (64, [0.5, -0.5]), (65, []),
             (66, [0.0] * 5), (67, [1e4, 3.0, 0.0, 0.0, -1.0])]
    check(whitened(table(spark, rows)).collect(), rows)
    # No long holds this entry: the vector takes no part.
    assert len(whitened(table(spark, [*rows, (68, [1e300] * 5)])).collect()) == len(whitened(table(spark, rows)).collect())


def test_repeated_rows_and_null_ids(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(c) for c in rng.normal(size=3)]) for i in range(20)]
    got = whitened(table(spark, rows + rows + [(None, [0.0, 0.0, 0.0])])).collect()
    assert len(got) == 41 * 3 and {r.n for r in got} == {41} and sum(r.vec_id is None for r in got) == 3
    assert all(len({r.whitened for r in got if r.vec_id == i and r.component == 1}) == 1 for i in range(20))


def test_without_variance(spark):
    assert whitened(table(spark, [])).collect() == [] and whitened(table(spark, [(1, None)])).collect() == []
    for rows in ([(1, [2.0, 3.0])], [(i, [2.0, 3.0]) for i in range(5)]):
        got = whitened(table(spark, rows)).collect()
        assert len(got) == 2 * len(rows)
        assert {(r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {(0, None, None, None)}
    got = whitened(table(spark, [(1, [0.0, 1.0, 1.0]), (2, [1.0, 0.0, 1.0])])).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in got) and got[0].identity_error < 1e-12


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(1, [4e15]), (2, [-4e15]), (3, [0.0])]
    got = {r.vec_id: r for r in whitened(table(spark, rows)).collect()}
    assert got[1].deviation is None and got[2].deviation is None and got[3].deviation == 0
    assert abs(got[1].whitened) == pytest.approx(math.sqrt(1.5))


def test_totals_are_exact_across_tasks(spark):
    rows = [(i, [4e15, -3e15 + i / 1024, 0.25]) for i in range(300)]
    n, sums = whitening.totals(whitening._vector_column(table(spark, rows, 7), "embedding"))
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows]
    assert (n, sums) == (300, [sum(c) for c in zip(*x)])


CASES = {
    "random": lambda g, d: g.normal(size=(3 * d, d)) * g.uniform(0.1, 10, d),
    "graded": lambda g, d: g.normal(size=(3 * d, d)) * 10.0 ** -np.arange(d),
    "half empty": lambda g, d: g.normal(size=(3 * d, d)) * (np.arange(d) < d / 2),
    "equal variances": lambda g, d: np.vstack([np.eye(d)] * 3),
    "close pairs": lambda g, d: np.diag(1 + 1e-13 * g.normal(size=d)),
    "rank one": lambda g, d: np.repeat(g.normal(size=(3 * d, 1)), d, axis=1),
    "zero": lambda g, d: np.zeros((d, d)),
}


@pytest.mark.parametrize("d", [1, 2, 3, 17, 40])
@pytest.mark.parametrize("case", CASES)
def test_solver(case, d):
    a = CASES[case](np.random.default_rng(d), d)
    r = np.zeros((d, d))
    q = np.linalg.qr(a, mode="r")
    r[: len(q)] = q
    model, v = solve(r, len(a), [0] * d, d), a.T @ a / len(a)
    value = np.linalg.eigvalsh(v)[::-1]
    scale = max(value[0], 1e-300)
    assert np.abs(model.variances - value).max() <= 1e-13 * scale
    assert np.abs(model.directions @ model.directions.T - np.eye(d)).max() < 1e-10
    assert max(np.linalg.norm(v @ z - s * z) for z, s in zip(model.directions, model.variances)) <= 1e-11 * scale


def test_bidiagonal_form_and_high_relative_accuracy():
    g = np.random.default_rng(1)
    r = np.triu(g.normal(size=(12, 12)))
    diagonal, upper, v = bidiagonal(r)
    b = np.diag(diagonal) + np.diag(upper, 1)
    assert np.allclose(v @ v.T, np.eye(12)) and np.allclose(r.T @ r, v @ b.T @ b @ v.T)
    # Singular values over 60 orders of magnitude keep their digits: their product is that of the diagonal.
    diagonal, upper = 10.0 ** -np.arange(0, 30, 2.0), np.full(14, 1e-3) * 10.0 ** -np.arange(0, 28, 2.0)
    values = qd_eigenvalues(diagonal, upper)
    assert math.isclose(sum(math.log(x) for x in values), 2 * sum(math.log(x) for x in diagonal), rel_tol=1e-13)
    z = twisted_vector(diagonal, upper, values[0])
    b = np.diag(diagonal) + np.diag(upper, 1)
    assert np.linalg.norm(b.T @ b @ z - values[0] * z) < 1e-15
