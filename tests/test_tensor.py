"""Tensor operators against numpy, and decompositions of planted tensors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tableloom.operators import tensor as tn
from tableloom.plans.scratch import materialize

X = np.arange(24.0).reshape(3, 4, 2)


def table(spark, values):
    return tn.small_tensor(spark, values)


def array(x):
    return tn.small_array(x)


@pytest.fixture(scope="module")
def x(spark):
    return table(spark, X)


def test_unfoldings(x):
    for mode in range(3):
        want = np.moveaxis(X, mode, 0).reshape(X.shape[mode], -1)
        got = np.zeros_like(want)
        for r in tn.unfold(x, mode).collect():
            got[r["row"], r["col"]] = r["value"]
        np.testing.assert_array_equal(got, want)
        np.testing.assert_array_equal(array(tn.fold(tn.unfold(x, mode), mode, X.shape)), X)


def test_layout(spark, x):
    np.testing.assert_array_equal(array(tn.reshape(x, (6, 4))), X.reshape(6, 4))
    np.testing.assert_array_equal(array(tn.vectorise(x, keep=1)), X.reshape(3, 8))
    np.testing.assert_array_equal(array(tn.fixed(x, {2: 1})), X[:, :, 1])
    np.testing.assert_array_equal(array(tn.fixed(x, {0: 0, 1: 2})), X[0, 2, :])
    flat = tn.from_flat(spark.range(24), F.col("id"), F.col("id").cast("double"), (3, 4, 2))
    np.testing.assert_array_equal(array(flat), X)
    with pytest.raises(ValueError):
        tn.reshape(x, (5, 5))


def matrix(spark, m):
    return spark.createDataFrame([(int(d), int(i), float(v)) for (d, i), v in np.ndenumerate(m)], "d bigint, i bigint, value double")


@pytest.mark.parametrize("limit", [4096, 2])
def test_mode_products(spark, x, monkeypatch, limit):
    monkeypatch.setattr(tn, "SOLVE_LIMIT", limit)  # 2 takes the way of tall matrices
    m, v = np.arange(20.0).reshape(5, 4), np.arange(4.0)
    got = tn.mode_dot(x, matrix(spark, m), 1, 5)
    assert got.shape == (3, 5, 2)
    np.testing.assert_allclose(array(got), np.einsum("abc,db->adc", X, m))
    vector = spark.createDataFrame([(i, float(n)) for i, n in enumerate(v)], "i bigint, value double")
    assert tn.mode_dot_vector(x, vector, 1).shape == (3, 2)
    np.testing.assert_allclose(array(tn.mode_dot_vector(x, vector, 1)), np.einsum("abc,b->ac", X, v))


def test_norms_and_means(spark, x):
    assert tn.norm(x).first()["norm"] == pytest.approx(np.linalg.norm(X))
    y = table(spark, X + 1)
    row = tn.relative_error(y, x).first()
    assert row["difference"] == pytest.approx(np.sqrt(24)) and row["error"] == pytest.approx(np.sqrt(24) / np.linalg.norm(X))
    np.testing.assert_allclose(array(tn.mean_over(x, 0)), X.mean(axis=0))
    sizes = tn.parameter_counts(tn.shape_table(x, (3, 4, 2))).first()
    assert tuple(sizes) == (24, 9 + 16 + 4, 24)


def planted(rank, shape, seed=3):
    rng = np.random.default_rng(seed)
    factors = [rng.normal(size=(s, rank)) for s in shape]
    letters = "abc"
    return np.einsum(",".join(f"{c}r" for c in letters) + "->abc", *factors), factors


def factor_table(spark, f):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(f)], "row bigint, f array<double>")


def test_reconstructions(spark):
    values, factors = planted(2, (3, 4, 2))
    tables = [factor_table(spark, f) for f in factors]
    np.testing.assert_allclose(array(tn.kruskal_to_tensor(tables, 2, (3, 4, 2))), values)
    core = np.arange(12.0).reshape(2, 3, 2)
    rng = np.random.default_rng(1)
    us = [rng.normal(size=(s, r)) for s, r in zip((3, 4, 5), core.shape)]
    got = tn.tucker_to_tensor(table(spark, core), [factor_table(spark, u) for u in us], (3, 4, 5))
    np.testing.assert_allclose(array(got), np.einsum("abc,ia,jb,kc->ijk", core, *us))
    weights = sum(float((f * f).sum()) for f in factors)
    small = table(spark, values + 0.5)
    for error in (tn.kruskal_error(small, tables, 2), tn.relative_error(table(spark, values), small)):
        objective = tn.penalised_objective(error, tables, None, 0.1).first()["objective"]
        assert objective == pytest.approx(0.25 * 24 + 0.1 * weights)


def test_errors_of_factored_forms_read_stored_cells_only(spark):
    values, factors = planted(2, (3, 4, 2))
    tables = [factor_table(spark, f) for f in factors]
    sparse = np.where(np.arange(24).reshape(3, 4, 2) % 5 == 0, values + 1, 0.0)
    stored = tn.Tensor(table(spark, sparse).cells.where("value <> 0"), sparse.shape)
    row = tn.kruskal_error(stored, tables, 2).first()
    gap, size = np.linalg.norm(values - sparse), np.linalg.norm(sparse)
    assert tuple(row) == pytest.approx((gap, size, gap / size)) and stored.cells.count() == 5
    core = np.arange(12.0).reshape(2, 3, 2)
    rng = np.random.default_rng(1)
    us = [rng.normal(size=(n, r)) for n, r in zip((3, 4, 2), core.shape)]
    whole = np.einsum("abc,ia,jb,kc->ijk", core, *us)
    row = tn.tucker_error(stored, table(spark, core), [factor_table(spark, u) for u in us]).first()
    assert row["difference"] == pytest.approx(np.linalg.norm(whole - sparse))


def test_line_search_finds_the_best_step(spark):
    values, factors = planted(2, (5, 4, 3))
    x = tn.Tensor(materialize(table(spark, values).cells), values.shape)
    # the change leads past the planted factors, which lie at a step of 0.5
    change = [np.random.default_rng(n).normal(size=f.shape) for n, f in enumerate(factors)]
    stacked = [factor_table(spark, np.hstack([f - 0.5 * d, d])) for f, d in zip(factors, change)]
    step, error = tn._stretch(x, stacked, 2, float((values ** 2).sum()))
    assert step == pytest.approx(0.5, abs=1e-6) and error < 1e-6
    back = [factor_table(spark, np.hstack([f, d])) for f, d in zip(factors, change)]
    assert tn._stretch(x, back, 2, float((values ** 2).sum()))[1] < 1e-6


def test_unfoldings_meet_in_tasks(spark, monkeypatch):
    rng = np.random.default_rng(6)
    y = rng.normal(size=(4, 50))
    monkeypatch.setattr(tn, "BUFFER", 4 * 7)  # runs of seven columns
    np.testing.assert_allclose(tn._row_gram(factor_table(spark, y), 4, 50), y @ y.T)
    factor, held = tn._leading(factor_table(spark, y), 4, 50, 2)
    u, sigma, _ = np.linalg.svd(y, full_matrices=False)
    got = np.array([r["f"] for r in factor.orderBy("row").collect()])
    np.testing.assert_allclose(got @ got.T, u[:, :2] @ u[:, :2].T, atol=1e-9)
    assert held == pytest.approx((sigma[:2] ** 2).sum())


def test_cp_recovers_a_planted_tensor(spark):
    values, _ = planted(2, (6, 5, 4))
    x = tn.Tensor(materialize(table(spark, values).cells), values.shape)
    found = tn.parafac(x, 2, sweeps=30, tol=1e-6, seed=7)
    assert found.errors[-1] < 1e-3 and len(found.errors) < 30
    assert all(b <= a + 1e-6 for a, b in zip(found.errors, found.errors[1:]))
    rebuilt = array(tn.kruskal_to_tensor(found.factors, 2, x.shape))
    assert np.linalg.norm(rebuilt - values) / np.linalg.norm(values) == pytest.approx(found.errors[-1], abs=1e-5)
    assert [f.count() for f in found.factors] == [6, 5, 4]


def test_tucker_bounds(spark):
    values, _ = planted(2, (6, 5, 4))
    x = tn.Tensor(materialize(table(spark, values).cells), values.shape)
    exact = tn.tucker(x, (2, 2, 2), sweeps=4)
    assert exact.errors[-1] < 1e-6 and exact.core.shape == (2, 2, 2)
    rebuilt = array(tn.tucker_to_tensor(exact.core, exact.factors, x.shape))
    np.testing.assert_allclose(rebuilt, values, atol=1e-6)
    rough = tn.tucker(x, (1, 1, 1), sweeps=4)
    assert 0 < rough.errors[-1] < 1
    # not below what the best rank of one unfolding allows
    singular = np.linalg.svd(values.reshape(6, -1), compute_uv=False)
    assert rough.errors[-1] >= np.sqrt((singular[1:] ** 2).sum() / (singular ** 2).sum()) - 1e-9


def test_large_ranks_take_the_array_path(spark):
    rng = np.random.default_rng(2)
    f = rng.normal(size=(30, 20))
    df = factor_table(spark, f)
    np.testing.assert_allclose(tn.gram(df, 20), f.T @ f)
    np.testing.assert_allclose(tn.gram(df.withColumn("f", F.slice("f", 1, 3)), 3), (f.T @ f)[:3, :3])
    m = rng.normal(size=(20, 15))
    got = np.array([r["f"] for r in tn.times(df, m).orderBy("row").collect()])
    np.testing.assert_allclose(got, f @ m)


def test_regression_recovers_planted_weights(spark):
    rng = np.random.default_rng(11)
    w = np.outer(rng.normal(size=5), rng.normal(size=4)) + np.outer(rng.normal(size=5), rng.normal(size=4))
    xs = rng.normal(size=(300, 5, 4))
    rows = [(i, [float(v) for v in s.ravel()], float((s * w).sum())) for i, s in enumerate(xs)]
    df = materialize(spark.createDataFrame(rows, "sample_id bigint, x array<double>, y double").repartition(3))
    fitted = tn.KruskalRegressor((5, 4), 2, reg=1e-9, max_iter=2000, tol=1e-11, starts=3).fit(df)
    assert np.linalg.norm(fitted.weights() - w) / np.linalg.norm(w) < 1e-6 and fitted.iterations < 2000
    gap = fitted.predict(df).agg(F.max(F.abs(F.col("y") - F.col("predicted")))).first()[0]
    assert gap < 1e-4


@pytest.mark.parametrize("shape", [(5, 4), (3, 2, 4)])
def test_moments_and_passes_give_the_same_equations(spark, shape):
    rng = np.random.default_rng(1)
    rows = [([float(v) for v in rng.normal(size=int(np.prod(shape)))], float(rng.normal())) for _ in range(40)]
    df = spark.createDataFrame(rows, "x array<double>, y double")
    model = tn.KruskalRegressor(shape, 2)
    model.factors = [rng.normal(size=(n, 2)) for n in shape]
    second, first, size = model._moments(df)
    assert size == pytest.approx(sum(y * y for _, y in rows))
    for mode in range(len(shape)):
        p = model._spread(mode)
        np.testing.assert_allclose(p @ model.factors[mode].ravel(), model.weights().ravel())
        a, b = model._equations(df, mode)
        np.testing.assert_allclose(p.T @ second @ p, a)
        np.testing.assert_allclose(p.T @ first, b)


def test_wide_samples_are_fitted_by_passes(spark, monkeypatch):
    rng = np.random.default_rng(11)
    w = np.outer(rng.normal(size=3), rng.normal(size=2))
    rows = [([float(v) for v in x.ravel()], float((x * w).sum())) for x in rng.normal(size=(60, 3, 2))]
    df = materialize(spark.createDataFrame(rows, "x array<double>, y double"))
    monkeypatch.setattr(tn, "SOLVE_LIMIT", 5)
    fitted = tn.KruskalRegressor((3, 2), 1, reg=1e-9, max_iter=30, tol=1e-8).fit(df)
    assert np.linalg.norm(fitted.weights() - w) < 1e-5
    np.testing.assert_allclose(array(fitted.weight_tensor(spark)), fitted.weights())


def test_samples_as_arrays(spark, x):
    got = {r["sample_id"]: r["x"] for r in tn.pack_samples(x).collect()}
    assert got == {i: list(X[i].ravel()) for i in range(3)}


def test_random_normals_have_unit_moments(spark):
    row = tn.random_cells(spark.range(4000), ["id"], 64, normal=True).agg(F.avg("value"), F.stddev("value")).first()
    assert abs(row[0]) < 0.06 and abs(row[1] - 1) < 0.05
