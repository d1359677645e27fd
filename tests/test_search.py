"""Concurrent search with pruning against its serial form, and the budget in rows."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from episodica.operators import models as L
from episodica.operators.encode import FittedEncoder
from test_models import SCHEMA, SPEC, rows

SPACES = {"logistic_regression": {"C": ("log", 1e-5, 10.0), "maxIter": ("choice", (4,))}}


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame(rows(600), SCHEMA).cache()


@pytest.fixture(autouse=True)
def frames(train, monkeypatch, made={}):
    """The folds are prepared once for all searches here."""
    if not made:
        made["frames"] = L._cv_frames(train, SPEC, 2, L.SEED)
    monkeypatch.setattr(L, "_cv_frames", lambda *_: made["frames"])


def plain(history):
    return sorted((r.model, r.number, r.state, None if r.value is None else round(r.value, 9)) for r in history.collect())


def test_pruned_trials_and_the_same_winner(train):
    names = ["logistic_regression"]
    side_by_side = L.search(train, names, 4, SPEC, k=2, spaces=SPACES, at_once=4, least=4)
    serial = L.search(train, names, 4, SPEC, k=2, spaces=SPACES, at_once=1, least=4)
    assert plain(side_by_side) == plain(serial)
    states = {r.state: r.n for r in side_by_side.groupBy("state").agg(F.count("*").alias("n")).collect()}
    assert states == {"PRUNED": 2, "COMPLETE": 2}


def test_programming_errors_are_raised(train, monkeypatch):
    def broken(n_rows, **params):
        raise TypeError("a fault")

    def refused(n_rows, **params):
        raise ValueError("unfit")

    monkeypatch.setitem(L.REGISTRY, "logistic_regression", broken)
    with pytest.raises(TypeError):
        L.search(train, ["logistic_regression"], 2, SPEC, k=2, spaces=SPACES, at_once=2)
    monkeypatch.setitem(L.REGISTRY, "logistic_regression", refused)
    assert {r.state for r in L.search(train, ["logistic_regression"], 2, SPEC, k=2, spaces=SPACES).collect()} == {"FAIL"}


def test_budget_decides_the_trials(train):
    names = ["logistic_regression"]
    small = L.budgeted_search(train, names, 700, SPEC, k=2, rungs=2, spaces=SPACES)
    large = L.budgeted_search(train, names, 1800, SPEC, k=2, rungs=2, spaces=SPACES)
    assert 1 <= small.count() < large.count()
    assert small.agg(F.sum("rows")).first()[0] <= 700 and large.agg(F.sum("rows")).first()[0] <= 1800
    assert plain(small) == plain(large.join(small.select("number", "rung"), ["number", "rung"], "semi"))
    per_rung = {r.rung: r.rows for r in large.groupBy("rung").agg(F.max("rows").alias("rows")).collect()}
    assert per_rung[1] == 600 and 150 < per_rung[0] < 450
    # who goes up was among the better half of those finished by then
    up = {r.number for r in large.where("rung = 1").collect()}
    first = {r.number: r.value for r in large.where("rung = 0").collect()}
    assert up and max(first[n] for n in up) == max(first[n] for n in sorted(first)[: 2 * len(up)])
    assert L.budgeted_search(train, names, 0, SPEC, k=2, rungs=2, spaces=SPACES).count() == 0


def test_trials_share_the_stages_of_a_fold(train, monkeypatch):
    made = []
    inner = FittedEncoder.stages
    monkeypatch.setattr(FittedEncoder, "stages", lambda *args: made.append(1) or inner(*args))
    history = L.search(train, ["logistic_regression"], 3, SPEC, k=2, spaces=SPACES, at_once=2).collect()
    assert len(history) == 3 and all(r.state == "COMPLETE" for r in history)
    assert not made


def test_rows_of_a_spark_estimator_are_made_once(spark):
    rows_made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        rows_made.add(1)
        return x

    rows = spark.range(400).select((F.col("id") % 2).cast("double").alias("label"), counted(F.col("id").cast("double")).alias("x"))
    stages = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features")]).fit(rows)
    model = L.fit_vectors(L.boosted_trees(400, maxIter=2, maxDepth=2), stages, stages.transform(rows))
    assert rows_made.value == 400
    assert model.classifier.getNumTrees == 2
