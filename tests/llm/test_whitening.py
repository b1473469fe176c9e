import math

import numpy as np
import pytest
from fareweave.llm import whitening as W
from fareweave.llm.queries import QUERIES
from fareweave.storage import materialize

FOLDER = "/root/testdata/sf0.01"


def counted(matrix):
    calls = []

    def apply(block):
        calls.append(block.shape[1])
        return matrix @ block

    return apply, calls


def made(width, seed, spectrum):
    random = np.random.default_rng(seed)
    q, _ = np.linalg.qr(random.normal(size=(width, width)))
    return (q * spectrum) @ q.T


SPECTRA = {
    "falling": lambda d: np.linspace(1, 10, d),
    "steep": lambda d: 2.0 ** -np.arange(d),
    "flat": lambda d: 1 + 1e-3 * np.arange(d) / d,
    "equal": lambda d: np.ones(d),
    "pairs": lambda d: np.repeat(np.arange(1, d), 2)[:d].astype(float),
    "rank 3": lambda d: np.r_[5.0, 4.0, 3.0, np.zeros(d - 3)],
    "zero": lambda d: np.zeros(d),
    "one large": lambda d: np.r_[1e8, np.linspace(1, 2, d - 1)],
}


@pytest.mark.parametrize("name", sorted(SPECTRA))
@pytest.mark.parametrize(("width", "wanted"), [(1, 32), (5, 32), (64, 32), (200, 8)])
def test_pairs_against_a_dense_solver(name, width, wanted):
    if name == "rank 3" and width < 3:
        return
    matrix = made(width, 1, SPECTRA[name](width) if width > 1 else np.array([2.0]))
    matrix = (matrix + matrix.T) / 2
    apply, calls = counted(matrix)
    got = W.jacobi_davidson(apply, width, wanted)
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1][:wanted], vectors[:, ::-1][:, :wanted]
    top = max(values[0], 0)
    assert np.abs(got.values - values).max() <= 1e-12 * max(top, 1e-300) or top == 0
    assert np.abs(got.vectors.T @ got.vectors - np.eye(len(values))).max() < 1e-12
    assert np.linalg.norm(matrix @ got.vectors - got.vectors * got.values, axis=0).max() <= 1e-12 * top + 1e-300
    for i in range(len(values)):
        near = np.abs(values - values[i]) < 1e-6 * top
        if near.sum() == 1 and i < len(values) - 1:
            assert abs(abs(got.vectors[:, i] @ vectors[:, i]) - 1) < 1e-9
    assert len(calls) < 300


def test_correction_equations_against_a_dense_solver():
    random = np.random.default_rng(3)
    matrix = made(12, 4, np.linspace(1, 5, 12))
    ritz, _ = np.linalg.qr(random.normal(size=(12, 3)))
    shifts = np.einsum("ij,ij->j", ritz, matrix @ ritz)
    residuals = matrix @ ritz - ritz * shifts
    inner = W.INNER_STEPS, W.INNER_SHARE
    W.INNER_STEPS, W.INNER_SHARE = 40, 1e-13
    try:
        steps = W._minres(lambda b: matrix @ b, shifts, np.zeros((12, 0)), ritz, residuals)
    finally:
        W.INNER_STEPS, W.INNER_SHARE = inner
    for j in range(3):
        p = np.eye(12) - np.outer(ritz[:, j], ritz[:, j])
        dense = np.linalg.lstsq(p @ (matrix - shifts[j] * np.eye(12)) @ p, -p @ residuals[:, j], rcond=1e-12)[0]
        assert np.allclose(p @ dense, steps[:, j], atol=1e-8)


def expected(vectors, components=32):
    x = np.floor(64 * np.asarray(vectors, dtype=float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = (x * n - sums) / n
    cov = centred.T @ centred / n
    values, turn = np.linalg.eigh(cov)
    values, turn = values[::-1][:components], turn[:, ::-1][:, :components]
    deviation = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums)) for row in x]
    return n, deviation, centred @ turn / np.sqrt(values), values / np.trace(cov)


def check(rows, vectors, ids, components=32):
    n, deviation, whitened, explained = expected(vectors, components)
    k = len(explained)
    assert len(rows) == len(ids) * k
    at = {v: i for i, v in enumerate(ids)}
    got = np.zeros((len(ids), k))
    for r in rows:
        i, c = at[r.vec_id], r.component - 1
        got[i, c] = r.whitened
        assert r.n == n and r.deviation == deviation[i]
        assert math.isclose(r.explained, explained[c], rel_tol=1e-9)
        assert r.identity_error < 1e-9
    signs = np.sign((got * whitened).sum(axis=0))
    assert np.abs(got * signs - whitened).max() < 1e-6
    assert len({r.identity_error for r in rows}) == 1


def test_the_given_table(spark):
    vectors = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    rows = QUERIES["op12_whitening"](spark, FOLDER).collect()
    check(rows, [r.embedding for r in vectors], [r.vec_id for r in vectors])


def test_rows_that_take_no_part_and_clashing_columns(spark):
    random = np.random.default_rng(5)
    vectors = random.normal(size=(40, 3)).round(3)
    vectors[7] = 0
    vectors[8] = vectors[9]
    good = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    bad = [(100, None), (101, [1.0, None, 2.0]), (102, [float("nan"), 0.0, 0.0]), (103, [float("inf"), 0.0, 0.0]), (104, [])]
    table = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>").repartition(6)
    table = table.selectExpr("*", "1 as id", "2 as x", "3 as width", "4 as component", "5 as n", "6 as whitened")
    check(W.whiten(table).collect(), vectors, list(range(40)))


def test_widths_apart_null_ids_and_repeated_rows(spark):
    random = np.random.default_rng(6)
    two, five = random.normal(size=(30, 2)), random.normal(size=(25, 5))
    rows = [(f"a{i}", v.tolist()) for i, v in enumerate(two)] + [(f"b{i}", v.tolist()) for i, v in enumerate(five)]
    got = W.whiten(spark.createDataFrame(rows, "vec_id string, embedding array<float>"), components=4).collect()
    check([r for r in got if r.vec_id[0] == "a"], two.astype(np.float32), [f"a{i}" for i in range(30)], 4)
    check([r for r in got if r.vec_id[0] == "b"], five.astype(np.float32), [f"b{i}" for i in range(25)], 4)
    nulls = spark.createDataFrame([(None, [1.0, 2.0]), (None, [1.0, 2.0]), (1, [3.0, 1.0])], "vec_id long, embedding array<double>")
    got = W.whiten(nulls).collect()
    # All variance lies in one direction: one component, and the repeated vector stands twice.
    assert sorted((r.vec_id is None, r.component) for r in got) == [(False, 1), (True, 1), (True, 1)]
    assert all(abs(r.explained - 1) < 1e-12 and r.identity_error < 1e-9 for r in got)


def test_no_variance_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert W.whiten(spark.createDataFrame([], schema)).collect() == []
    assert W.whiten(spark.createDataFrame([(1, [1.0, 2.0])], schema)).collect() == []
    assert W.whiten(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(9)], schema)).collect() == []


def test_huge_entries_keep_exact_sums(spark):
    rows = [(i, [v, 1.0 * i]) for i, v in enumerate([1e300, -1e300, 2.0**60, 5.0, -7.5])]
    stored = materialize(W._whole_numbers(spark.createDataFrame(rows, "id long, v array<double>"), "id", "v", 64, 10), "huge")
    fit = W._fits(stored)[2]
    x = [int(min(max(math.floor(v * 64), -(2**53)), 2**53)) + 10 for _, (v, _) in rows]
    assert int(fit.base[0]) * 5 + int(fit.rest[0]) == sum(x)
    got = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 5 * len({r.component for r in got}) and any(r.deviation is None for r in got)
