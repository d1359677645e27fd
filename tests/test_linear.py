"""Newton steps against a plain solver."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from episodica.operators.linear import LinearModel, curvature, fit_logistic


def plain(x, y, w, c):
    """Gradient descent by exact Newton steps on the whole matrix, far past convergence."""
    z = np.column_stack([x, np.ones(len(x))])
    ridge = np.append(np.full(x.shape[1], 1 / c), 0)
    b = np.zeros(z.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-z @ b))
        b -= 0.5 * np.linalg.solve(z.T @ (z * (w * p * (1 - p))[:, None]) + np.diag(ridge), z.T @ (w * (p - y)) + ridge * b)
    return b


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(700, 4)) * [1, 5, 0.1, 20] + [0, 3, 0, -7], 3)
    x[:, 3] = 0.0  # a constant column
    y = (rng.random(700) < 1 / (1 + np.exp(1.5 - x[:, 0] + 0.2 * x[:, 1]))).astype(float)
    w = rng.integers(0, 4, 700).astype(float)
    rows = [(*map(float, r), float(t), float(u)) for r, t, u in zip(x, y, w, strict=True)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, label double, w double").repartition(5)
    return df.withColumn("x", F.array("a", "b", "c", "d")), x, y, w


@pytest.mark.parametrize("c", [1.0, 100.0, 1e6])
def test_coefficients_equal_a_plain_solver(table, c):
    df, x, y, w = table
    for weight, given in ((None, np.ones(len(x))), ("w", w)):
        got = fit_logistic(df, "x", "label", weight, c)
        assert np.allclose([*got.coefficients, got.intercept], plain(x, y, given, c), atol=1e-6) and got.passes <= 9


def test_vectors_and_scores(spark, table, tmp_path):
    df, *_ = table
    vectors = VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="v").transform(df)
    model, other = fit_logistic(vectors, "v"), fit_logistic(df, "x")
    assert np.allclose(model.coefficients, other.coefficients, atol=1e-12)
    model.save(spark, str(tmp_path / "m"))
    again = LinearModel.load(spark, str(tmp_path / "m"))
    assert again.coefficients == model.coefficients and again.intercept == model.intercept
    for r in again.transform(vectors, "v").limit(40).collect():
        want = 1 / (1 + np.exp(-(np.dot(r.x, model.coefficients) + model.intercept)))
        assert r.p == pytest.approx(want, abs=1e-12)


def test_one_pass_of_sums(table):
    df, x, y, _ = table
    b = np.array([0.3, -0.2, 1.0, 0.0, -0.5])
    z = np.column_stack([x, np.ones(len(x))])
    p = 1 / (1 + np.exp(-z @ b))
    got = {(r.part, r.i, r.j): r.value for r in curvature(df, b, "x").collect()}
    hessian, gradient = z.T @ (z * (p * (1 - p))[:, None]), z.T @ (p - y)
    assert len(got) == 15 + 5 + 1
    assert all(got["hessian", i, j] == pytest.approx(hessian[i, j]) for i in range(5) for j in range(i, 5))
    assert all(got["gradient", i, -1] == pytest.approx(gradient[i]) for i in range(5))
    assert got["loss", -1, -1] == pytest.approx(-(y * np.log(p) + (1 - y) * np.log(1 - p)).sum())


def test_separable_one_class_nulls_and_nothing(spark):
    rows = [(float(k), float(k >= 10)) for k in range(20)] + [(None, 1.0), (3.0, None)]
    df = spark.createDataFrame(rows, "a double, label double").withColumn("x", F.when(F.col("a").isNotNull(), F.array("a")))
    got = fit_logistic(df, "x", c=1.0)
    want = plain(np.arange(20.0)[:, None], (np.arange(20) >= 10).astype(float), np.ones(20), 1.0)
    assert np.allclose([*got.coefficients, got.intercept], want, atol=1e-6)
    one = fit_logistic(df.where("label = 1"), "x")
    assert np.isfinite([*one.coefficients, one.intercept]).all() and one.transform(df.where("a = 12"), "x").first().p > 0.99
    nothing = fit_logistic(df.where("false"), "x")
    assert nothing.coefficients == [] and nothing.intercept == 0.0
