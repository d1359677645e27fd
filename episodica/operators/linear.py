"""Logistic regression by Newton steps: each pass adds up one small matrix, so a handful of passes is enough.

A step needs the gradient and the curvature (the features' Gram matrix, weighted by p (1 - p)).  Tasks multiply
their own Arrow batches, Spark adds the entries of all tasks up, and the driver solves a system of as many
equations as there are features.  Nothing that grows with the rows leaves the tasks.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.functions import scalars as S
from episodica.sources.shared import store


def as_array(df: DataFrame, features: str) -> Column:
    """The features of a row as an array of doubles, whether they are an ML vector or an array."""
    kind = df.schema[features].dataType.typeName()
    return vector_to_array(features) if "vector" in kind else F.col(features).cast("array<double>")


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows by features, out of an Arrow column of lists."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def curvature(rows: DataFrame, coefficients: Iterable[float], features: str = "features", label: str = "label", weight: str | None = None) -> DataFrame:
    """Sums over all rows at the given coefficients (the intercept last): ``(part, i, j, value)``.

    Part ``hessian`` holds the entries i <= j of sum(w p (1 - p) x_i x_j), part ``gradient`` sum(w (p - y) x_i) with
    j = -1, part ``loss`` the log loss with i = j = -1.  The place after the last feature is the intercept's.
    Every task gives out one row an entry; they are added up by Spark, within the task first.  NULL labels, weights or
    features leave a row out; an empty table has no entries.
    """
    b = np.array(list(coefficients), float)
    d = len(b)
    upper = np.triu_indices(d)
    frame = rows.select(
        as_array(rows, features).alias("x"), F.col(label).cast("double").alias("y"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w")
    ).where("x is not null and y is not null and w is not null")

    def run(batches):
        hessian, gradient, loss, seen = np.zeros((d, d)), np.zeros(d), 0.0, False
        for batch in batches:
            if not batch.num_rows:
                continue
            seen = True
            x = np.concatenate([matrix(batch.column(0), d - 1), np.ones((batch.num_rows, 1))], axis=1)
            y, w = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            margin = x @ b
            p = 1 / (1 + np.exp(-margin))
            hessian += x.T @ (x * (w * p * (1 - p))[:, None])
            gradient += x.T @ (w * (p - y))
            loss += float((w * (np.logaddexp(0, margin) - y * margin)).sum())
        if seen:
            value = np.concatenate([hessian[upper], gradient, [loss]])
            i = np.concatenate([upper[0], np.arange(d), [-1]])
            j = np.concatenate([upper[1], np.full(d + 1, -1)])
            part = ["hessian"] * len(upper[0]) + ["gradient"] * d + ["loss"]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(value)], names=["part", "i", "j", "value"])

    entries = frame.mapInArrow(run, "part string, i int, j int, value double")
    return entries.groupBy("part", "i", "j").agg(F.sum("value").alias("value"))


@dataclass
class LinearModel:
    """Coefficients and intercept of a logistic model, and how many passes over the rows found them."""

    coefficients: list[float]
    intercept: float
    passes: int = 0

    def margin(self, x: Column) -> Column:
        weights = F.array(*[F.lit(float(c)) for c in self.coefficients])
        return F.aggregate(F.zip_with(x, weights, lambda a, b: a * b), F.lit(float(self.intercept)), lambda s, v: s + v)

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """Adds the probability ``p``, one expression over the array of features."""
        return df.withColumn("p", S.sigmoid(self.margin(as_array(df, features))))

    def save(self, spark, path: str) -> None:
        rows = [(i, float(c)) for i, c in enumerate([*self.coefficients, self.intercept])]
        spark.createDataFrame(rows, "i int, value double").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark, path: str) -> "LinearModel":
        values = [r.value for r in spark.read.parquet(path).orderBy("i").collect()]
        return cls(values[:-1], values[-1])


def fit_logistic(
    rows: DataFrame, features: str = "features", label: str = "label", weight: str | None = None, c: float = 1.0, max_iter: int = 25, tol: float = 1e-10
) -> LinearModel:
    """Minimise the summed log loss plus ||coefficients||^2 / (2 c); the intercept is free.

    A Newton step at a time, halved as long as it does not lower the loss, until the expected gain is ``tol`` of the
    loss.  ``max_iter`` bounds the passes over the rows.  Without rows all coefficients are 0.
    """
    first = rows.select(F.size(as_array(rows, features)).alias("d")).where("d >= 0").first()
    d = first.d if first else 0
    ridge = np.append(np.full(d, 1.0 / c), 0.0)
    b, step, best, passes = np.zeros(d + 1), np.zeros(d + 1), np.inf, 0
    while passes < max_iter:
        hessian, gradient, loss = np.zeros((d + 1, d + 1)), np.zeros(d + 1), 0.0
        # as many entries as pairs of features, whatever the rows are
        sums = curvature(rows, b, features, label, weight).toPandas()
        passes += 1
        if not len(sums):
            break
        for part, table in sums.groupby("part"):
            i, j, value = table["i"].to_numpy(), table["j"].to_numpy(), table["value"].to_numpy()
            if part == "hessian":
                hessian[i, j] = value
                hessian[j, i] = value
            elif part == "gradient":
                gradient[i] = value
            else:
                loss = float(value[0])
        loss += 0.5 * float((ridge * b * b).sum())
        if loss > best + 1e-12 * abs(best) and np.abs(step).max() > 1e-14:
            step /= 2
            b = b - step  # back to half of the way
            continue
        best = loss
        gradient += ridge * b
        hessian += np.diag(ridge + 1e-12 * np.trace(hessian) / (d + 1))
        step = np.linalg.lstsq(hessian, -gradient, rcond=None)[0]
        if -gradient @ step / 2 <= tol * max(1e-300, abs(loss)):
            b = b + step  # the last correction costs no further pass
            break
        b = b + step
    return LinearModel([float(v) for v in b[:-1]], float(b[-1]), passes)


class LogisticNewton:
    """Estimator form of :func:`fit_logistic` for the registry of models."""

    def __init__(self, C: float = 1.0, maxIter: int = 25):
        self.C, self.max_iter = C, maxIter

    def fit(self, rows: DataFrame) -> LinearModel:
        """The rows are stored once, as each step passes over them."""
        kept = store(rows.select(as_array(rows, "features").alias("features"), "label"), "newton-rows")
        return fit_logistic(kept, c=self.C, max_iter=self.max_iter)
