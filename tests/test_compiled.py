import numpy as np
import pytest
from pyspark.sql import functions as F

from episodica.operators import compiled as C
from episodica.operators import encode as E
from episodica.operators import models as L
from episodica.operators.decide import Calibrator, fit_isotonic
from episodica.operators.isotonic import IsotonicCurve
from episodica.operators.linear import LinearModel
from episodica.operators.score import Scorer
from episodica.operators.trees import KINDS, PACKED, TreeEnsemble
from episodica.roles import ScoreRoles
from episodica.streaming import scoring
from test_models import SCHEMA, SPEC, rows

STRANGE = [
    ("e", -1, None, None, None, None, None, None, 0),
    ("e", -2, 30, 1, True, "?", 77, "never", 0),
    ("e", -3, 30, 1, True, E.RARE, 50, "é", 1),
    ("e", -4, 500, 1, True, "M", 1, "c1", 1),
    (None, None, 40, 2, False, "F", 2, "", None),
]


@pytest.fixture(scope="module")
def fitted(spark):
    data = spark.createDataFrame(rows(), SCHEMA)
    train, val = data.where("k < 600"), data.where("k >= 600").unionByName(spark.createDataFrame(STRANGE, SCHEMA))
    encoder = E.fit_encoder(train, SPEC)
    params = {"logistic_regression": {}, "random_forest": {"trees": 8, "depth": 6, "leaf": 10}, "leafwise_boosting": {"rounds": 10, "leaves": 8, "leaf": 10}}
    return {n: L.train_model(train, n, SPEC, p, encoder) for n, p in params.items()}, val


def by_key(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("name", ["logistic_regression", "random_forest", "leafwise_boosting"])
@pytest.mark.parametrize("method", ["uncalibrated", "platt", "isotonic"])
def test_equal_to_the_scorer_with_joins(spark, fitted, name, method):
    models, val = fitted
    calibrator = {"uncalibrated": Calibrator("uncalibrated"), "platt": Calibrator("platt", LinearModel([3.0], -2.0))}.get(method)
    if method == "isotonic":
        scored = models[name].transform(val).where("y is not null").select("k", "y", "p")
        calibrator = fit_isotonic(scored, ScoreRoles("k", "y", "p"))
    scorer = Scorer(models[name], calibrator, 0.3, {"age": (0, 120)})
    ready = C.compile_scorer(scorer)
    want, got = by_key(scorer.score(val)), by_key(ready.score(val))
    assert len(want) == 304 and want.keys() == got.keys()
    for k in want:
        assert got[k][0] == pytest.approx(want[k][0], abs=1e-12) and got[k][2:] == want[k][2:]
    plan = ready.score(val)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and "UDF" not in plan and "Python" not in plan
    # the literal arrays are folded, not read from text row by row
    assert "json" not in ready.score(val)._jdf.queryExecution().optimizedPlan().toString().lower()


def test_stream_and_quarantine(spark, fitted, tmp_path):
    models, val = fitted
    ready = C.compile_scorer(Scorer(models["leafwise_boosting"], Calibrator("uncalibrated"), 0.3, {"age": (0, 120)}))
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    val.repartition(3).write.parquet(source)
    requests = scoring.read_requests(spark, source, val.schema, files_per_trigger=1)
    for running in scoring.score_compiled(requests, ready, out, str(tmp_path / "log")):
        running.awaitTermination()
    assert by_key(spark.read.parquet(f"{out}/scored")) == by_key(ready.score(val))
    assert [(r.k, r.failed) for r in spark.read.parquet(f"{out}/quarantine").collect()] == [(-4, ["age:range"])]


def test_too_large(fitted):
    models, _ = fitted
    scorer = Scorer(models["random_forest"], Calibrator("uncalibrated"), 0.3)
    with pytest.raises(C.TooLarge, match="levels of code"):
        C.compile_scorer(scorer, 30)
    with pytest.raises(C.TooLarge, match="tree nodes"):
        C.compile_scorer(scorer, 70)


def test_empty_tables(spark, fitted):
    models, val = fitted
    ready = C.compile_scorer(Scorer(models["logistic_regression"], Calibrator("isotonic", IsotonicCurve(spark.createDataFrame([], "x double, value double"))), 0.3, {}))
    assert {r.p for r in ready.score(val).collect()} == {None}
    assert ready.score(val.limit(0)).count() == 0
    assert spark.range(1).select(C.tree_margin(TreeEnsemble(spark.createDataFrame([], PACKED)), F.array(F.lit(1.0)), C.Budget(5)).alias("m")).first().m == 0.0


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 9, 1000])
def test_count_up_to(spark, n):
    xs = [i * 0.5 for i in range(n)]
    asked = [-1.0, 0.0, 0.25, 0.5, n * 0.5 - 0.5, n * 0.5, None]
    got = spark.createDataFrame([(i, x) for i, x in enumerate(asked)], "i int, x double").select("i", C.count_up_to(C.literal(xs, "double"), n, F.col("x")).alias("c"))
    assert [r.c for r in got.orderBy("i").collect()] == [0 if x is None else int(np.searchsorted(xs, x, "right")) for x in asked]


def test_a_tree_that_is_one_leaf(spark):
    one = {"feature": [-1], "cut": [0.0], "low": [-1], "high": [-1], "value": [0.25], "cover": [3.0]}
    two = {"feature": [0, -1, -1], "cut": [0.5, 0.0, 0.0], "low": [1, -1, -1], "high": [2, -1, -1], "value": [0.0, 1.0, 2.0], "cover": [3.0, 1.0, 2.0]}
    packed = [(i, *[bytearray(np.array(t[n], k).tobytes()) for n, k in KINDS.items()]) for i, t in enumerate((one, two))]
    model = TreeEnsemble(spark.createDataFrame(packed, PACKED))
    rows_ = spark.createDataFrame([(0.5,), (0.6,)], "a double")
    got = rows_.select(C.tree_margin(model, F.array("a"), C.Budget(4)).alias("m"))
    assert [r.m for r in got.collect()] == [1.25, 2.25]
