import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from episodica.operators import encode as E
from episodica.operators import explain as X
from episodica.operators import models as L
from episodica.operators import score as O
from episodica.plans import train as T
from episodica.roles import FeatureSpec
from episodica.streaming import scoring

SPEC = FeatureSpec(numeric=("age", "los"), binary=("flag",), cat_low=("sex", "state"), cat_high=("code",), entity="id", key="k", extra_ids=())


def rows(n=900, seed=1):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        age = None if rng.random() < 0.05 else rng.randrange(20, 95)
        code = f"c{rng.randrange(40)}" if rng.random() < 0.95 else None
        flag = rng.random() < 0.4
        y = int(rng.random() < 0.1 + 0.25 * flag + (0.2 if code in ("c1", "c2", "c3") else 0) + (0.15 if (age or 0) > 70 else 0))
        out.append((f"e{k // 3}", k, age, rng.randrange(0, 9), flag, rng.choice("MF"), rng.choice([1, 1, 1, 2, 2, 50 + k % 9]), code, y))
    return out


SCHEMA = "id string, k int, age int, los int, flag boolean, sex string, state int, code string, y int"


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(rows(), SCHEMA).cache()


@pytest.fixture(scope="module")
def split(data):
    return data.where("k < 600"), data.where("k >= 600")


def test_numeric_stats(data):
    pdf = data.toPandas()
    got = {r.feature: r for r in E.numeric_stats(data, SPEC.numeric).collect()}
    filled = pdf.age.fillna(pdf.age.median())
    assert got["age"].median == pdf.age.median() and got["age"].mean == pytest.approx(filled.mean())
    assert got["age"].std == pytest.approx(filled.std(ddof=0))


def test_constant_number_and_flag_tie(spark):
    df = spark.createDataFrame([(3, True), (3, False)], "x int, f boolean")
    assert E.numeric_stats(df, ["x"]).first().std == 1.0
    assert E.flag_modes(df, ["f"]).first().mode == 0


def smooth(n, s, total_n, total_s):
    mean = total_s / total_n
    if n == 0:
        return mean
    m, prior = s / n, mean * (1 - mean)
    w = n * prior / (n * prior + m * (1 - m))
    return w * m + (1 - w) * mean


def test_target_encoding_is_cross_fitted(data):
    train = data.withColumn("fold", F.col("k") % 5)
    pdf = train.toPandas().assign(code=lambda d: d.code.fillna("UNKNOWN"))
    full = {r.level: r.encoded for r in E.target_table(train, ["code"], "y").collect()}
    crossed = {(r.level, r.fold): r.encoded for r in E.cross_target_table(train, ["code"], "y", "fold").collect()}
    for level, g in pdf.groupby("code"):
        assert full[level] == pytest.approx(smooth(len(g), g.y.sum(), len(pdf), pdf.y.sum()))
        for fold in g.fold.unique():
            other = pdf[pdf.fold != fold]
            mine = other[other.code == level]
            assert crossed[level, fold] == pytest.approx(smooth(len(mine), mine.y.sum(), len(other), other.y.sum()))


def test_encoder_vectors(spark, data, split):
    train, val = split
    encoder = E.fit_encoder(train, SPEC)
    model = L._fit(encoder, LogisticRegression(maxIter=2), encoder.prepare_train(train), SPEC)
    names = encoder.feature_names()
    assert "cat_low__state___infrequent__" in names and "cat_low__sex_F" in names
    out = model.transform(encoder.prepare(val))
    x = np.array([r.features.toArray() for r in out.select("features").collect()])
    assert x.shape == (300, len(names)) and np.isfinite(x).all()
    strange = spark.createDataFrame([("e", -1, None, 1, None, "?", 77, "never", 0)], SCHEMA)
    v = model.transform(encoder.prepare(strange)).first().features.toArray()
    slot = dict(zip(names, v))
    assert slot["cat_low__sex_F"] == slot["cat_low__sex_M"] == 0.0 and slot["cat_low__state___infrequent__"] == 0.0
    assert slot["cat_high__code"] == pytest.approx(train.selectExpr("avg(y)").first()[0])


def test_registry_and_search_space():
    assert L.REGISTRY["logistic_regression"](100, C=2.0).C == 2.0
    rng = random.Random(0)
    for _ in range(50):
        p = L.draw(L.SPACES["boosted_trees"], rng)
        assert p["maxIter"] in range(10, 21, 5) and 0.02 <= p["stepSize"] <= 0.2 and p["maxBins"] in (32, 64, 128)
        assert L.typed_params({k: str(v) for k, v in p.items()}, L.SPACES["boosted_trees"]) == p


def test_benchmark_calibrate_score_stream(spark, data, split, tmp_path):
    train, val = split
    small = {"logistic_regression": {"maxIter": 20}, "boosted_trees": {"maxIter": 3, "maxDepth": 3}}
    models, board = L.benchmark(train, val, ["logistic_regression", "boosted_trees", "unknown"], str(tmp_path / "scores"), SPEC, small)
    assert {(r.model, r.curve) for r in spark.read.parquet(str(tmp_path / "scores-curves")).select("model", "curve").distinct().collect()} == {(m, c) for m in models for c in ("pr", "roc")}
    assert set(models) == {"logistic_regression", "boosted_trees"} and board.count() == 2
    assert all(r.roc_auc > 0.55 for r in board.collect())
    done = T.calibrate_model(models["boosted_trees"], val)
    picked = done.picked.first()
    assert picked.cost <= min(picked.always_cost, picked.never_cost)
    path = str(tmp_path / "scorer")
    done.scorer.ranges = {"age": (0, 120), "los": (0, None)}
    done.scorer.save(spark, path)
    loaded = O.Scorer.load(spark, path, SPEC)
    batch = {r.k: (round(r.p, 9), r.decision, r.risk_band) for r in loaded.score(val).collect()}
    assert batch == {r.k: (round(r.p, 9), r.decision, r.risk_band) for r in done.scorer.score(val).collect()}
    val.repartition(3).write.parquet(str(tmp_path / "in"))
    spark.createDataFrame([("bad", 5000, 150, 1, True, "M", 1, "c1", 0), ("bad", 5001, 30, None, True, "M", 1, "c1", 0)], SCHEMA).write.mode("append").parquet(str(tmp_path / "in"))
    requests = scoring.read_requests(spark, str(tmp_path / "in"), data.schema, files_per_trigger=2)
    scoring.score_stream(requests, loaded, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    streamed = {r.k: (round(r.p, 9), r.decision, r.risk_band) for r in spark.read.parquet(str(tmp_path / "out/scored")).collect()}
    want = {r.k: (round(r.p, 9), r.decision, r.risk_band) for r in loaded.score(spark.read.parquet(str(tmp_path / "in"))).collect()}
    assert streamed == want and 5001 in streamed
    bad = {r.k: r.failed for r in spark.read.parquet(str(tmp_path / "out/quarantine")).collect()}
    assert bad == {5000: ["age:range"]}


def test_benchmark_without_any_model(split, tmp_path):
    with pytest.raises(RuntimeError):
        L.benchmark(*split, ["unknown"], str(tmp_path / "none"), SPEC)


def test_search_and_trials(spark, split, tmp_path):
    spaces = {"logistic_regression": {"C": ("log", 0.1, 10.0), "maxIter": ("choice", (5,))}}
    trials = L.search(split[0], ["logistic_regression"], 2, SPEC, k=2, spaces=spaces)
    assert trials.where("state = 'COMPLETE' and value > 0.2").count() == 2
    models, board = L.refit_best(trials, *split, str(tmp_path / "refit"), SPEC, spaces)
    assert set(models) == {"logistic_regression"} and board.first().roc_auc > 0.55
    assert L.search(split[0], ["logistic_regression"], 9, SPEC, k=2, spaces=spaces, budget_seconds=0.0, sample=100).count() == 1
    history = spark.createDataFrame([("m", i, v, s) for i, (v, s) in enumerate([(0.1, "COMPLETE"), (0.3, "COMPLETE"), (None, "FAIL"), (0.3, "COMPLETE"), (0.2, "COMPLETE")])], "model string, number int, value double, state string")
    assert [r.best_value for r in L.running_best(history).orderBy("number").collect()] == [0.1, 0.3, 0.3, 0.3]
    assert L.best_trial(history).first().number == 1


def test_ensembles(spark):
    rng = random.Random(3)
    data = []
    for k in range(400):
        y = int(rng.random() < 0.3)
        for m, noise in (("a", 0.2), ("b", 0.3), ("c", 0.4)):
            data.append((k, y, m, min(1.0, max(0.0, rng.gauss(0.3 + 0.4 * y, noise))), "calib" if k % 2 else "test"))
    scores = spark.createDataFrame(data, "claim_id int, y int, model string, p double, half string")
    board, coefficients = L.ensemble_report(scores, ["a", "b", "c", "missing"], "claim_id")
    assert {r.model for r in board.collect()} == {"a", "b", "c", "soft_vote", "stacking"} and coefficients["a"] > coefficients["c"]
    with pytest.raises(ValueError):
        L.ensemble_report(scores.where("model = 'a'"), ["a", "b"], "claim_id")


def test_no_vote_without_the_score_of_every_model(spark):
    data = [(k, k % 3 % 2, m, 0.1 * (k % 7) + 0.1 * i, "calib" if k % 2 else "test") for k in range(60) for i, m in enumerate("abc")]
    schema = "claim_id int, y int, model string, p double, half string"
    whole = spark.createDataFrame(data, schema)
    assert {r.model for r in L.ensemble_report(whole, ["a", "b", "c"], "claim_id")[0].collect()} == {"a", "b", "c", "soft_vote", "stacking"}
    assert L.soft_vote(whole, models=["a", "b", "c"]).where("p is null").count() == 0
    assert sorted(map(tuple, L.soft_vote(whole, models=["a", "b", "c"]).collect())) == sorted(map(tuple, L.soft_vote(whole).collect()))
    at = next(i for i, r in enumerate(data) if r[0] == 8 and r[2] == "b")
    for lost in ([], [(*data[at][:3], None, "test")], [(*data[at][:3], float("nan"), "test")]):
        with pytest.raises(Exception, match="without the score of every model; key 8"):
            L.ensemble_report(spark.createDataFrame(data[:at] + data[at + 1 :] + lost, schema), ["a", "b", "c"], "claim_id")[0].collect()


def test_a_failed_family_shows(spark, split, tmp_path, monkeypatch):
    from episodica.plans.catalog import QUERIES, training

    def broken(n_rows, **params):
        raise ValueError("singular")

    path = str(tmp_path / "scores")
    L.benchmark(*split, ["logistic_regression", "extra_trees"], path, SPEC, {"extra_trees": {"trees": 2}})
    monkeypatch.setitem(L.REGISTRY, "extra_trees", broken)
    # the scores of the earlier run are still there
    models, board = L.benchmark(*split, ["logistic_regression", "extra_trees"], path, SPEC)
    rows = L.leaderboard(board).collect()
    assert set(models) == {"logistic_regression"} and [(r.model, r.state, r.error) for r in rows] == [("logistic_regression", "COMPLETE", None), ("extra_trees", "FAIL", "ValueError: singular")]
    assert rows[0].pr_auc > 0 and rows[1].pr_auc is None
    monkeypatch.setattr(training, "_bench", lambda spark, sf: (path, board, ["random_forest"]))
    for name in ("l11_stacking", "l12_ensemble_report"):
        with pytest.raises(RuntimeError, match="no scores of random_forest"):
            QUERIES[name](spark, "/nowhere")


# ---------------------------------------------------------------- attributions
@pytest.fixture(scope="module")
def vectors(spark):
    rng = random.Random(8)
    data = []
    for k in range(500):
        a, b, c = rng.random(), rng.random(), float(rng.randrange(3))
        data.append((k, a, b, c, float(a + b * c + rng.gauss(0, 0.3) > 1.2)))
    df = spark.createDataFrame(data, "k int, a double, b double, c double, label double")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).cache()


@pytest.mark.parametrize("kind", ["boosted", "forest"])
def test_tree_attributions_add_up(vectors, kind):
    trees = GBTClassifier(maxIter=4, maxDepth=3, seed=1) if kind == "boosted" else RandomForestClassifier(numTrees=5, maxDepth=4, seed=1)
    model = trees.fit(vectors)
    phi, base = X.tree_attributions(vectors, model, ["a", "b", "c"], "k")
    total = {r.k: r.s + base for r in phi.groupBy("k").agg(F.sum("phi").alias("s")).collect()}
    for r in model.transform(vectors).collect():
        p = float(r.probability[1])
        assert total[r.k] == pytest.approx(math.log(p / (1 - p)) if kind == "boosted" else p, abs=1e-9)
    top = X.top_contributions(phi, "k", 2)
    assert top.groupBy("k").count().where("count <> 2").count() == 0
    if kind == "boosted":
        implied = {r.k: r.p for r in X.implied_probability(phi, base, "k").collect()}
        assert implied[0] == pytest.approx(float(model.transform(vectors).where("k = 0").first().probability[1]))


def test_tree_attributions_equal_the_definition(vectors):
    """One tree against the average over all feature orders of the cover-weighted expectation."""
    model = GBTClassifier(maxIter=1, maxDepth=3, seed=1).fit(vectors)
    nodes, weights, votes = X.tree_nodes(model)
    table = {int(r.id): r for r in nodes[0].itertuples()}

    def expect(x, known, at=0):
        n = table[at]
        if n.leftChild < 0:
            return float(n.prediction) * 2.0 * weights[0]
        f, cut = n.split["featureIndex"], n.split["leftCategoriesOrThreshold"][0]
        if f in known:
            return expect(x, known, n.leftChild if x[f] <= cut else n.rightChild)
        return sum(table[c].rawCount / n.rawCount * expect(x, known, c) for c in (n.leftChild, n.rightChild))

    phi, base = X.tree_attributions(vectors.limit(20), model, ["a", "b", "c"], "k")
    got = {(r.k, r.feature): r.phi for r in phi.collect()}
    assert base == pytest.approx(expect(None, ()))
    for row in vectors.limit(20).collect():
        x = row.features.toArray()
        for i, name in enumerate("abc"):
            rest = [j for j in range(3) if j != i]
            want = 0.0
            for size in range(3):
                for known in itertools.combinations(rest, size):
                    share = math.factorial(size) * math.factorial(2 - size) / 6
                    want += share * (expect(x, (*known, i)) - expect(x, known))
            assert got[row.k, name] == pytest.approx(want, abs=1e-9)


def test_linear_attributions(vectors):
    model = LogisticRegression(maxIter=20).fit(vectors)
    phi, base = X.linear_attributions(vectors, model, ["a", "b", "c"], X.vector_mean(vectors), "k")
    total = {r.k: r.s + base for r in phi.groupBy("k").agg(F.sum("phi").alias("s")).collect()}
    for r in model.transform(vectors).limit(50).collect():
        assert total[r.k] == pytest.approx(float(r.rawPrediction[1]), abs=1e-9)
    assert [r["rank"] for r in X.importance(phi).orderBy(F.desc("mean_abs")).collect()] == [1, 2, 3]


def test_dependence_trend(spark):
    values = [(float(i % 40), float(i % 40) * 2, "f") for i in range(1200)]
    phi = spark.createDataFrame(values, "value double, phi double, feature string")
    got = X.dependence_trend(phi).orderBy("low").collect()
    x = np.array([v for v, *_ in values])
    edges = np.unique(np.quantile(x, np.linspace(0, 1, 21)))
    want = [((lo + hi) / 2, 2 * x[(x >= lo) & (x <= hi)].mean(), ((x >= lo) & (x <= hi)).sum()) for lo, hi in zip(edges[:-1], edges[1:])]
    assert np.allclose([(r.mid, r.mean_phi, r.n) for r in got], want)


def test_trend_comes_with_its_caps(spark):
    values = [(float(i % 40), float(i % 40) * 2, "f") for i in range(1200)] + [(float(i % 10), 1.0, "few") for i in range(400)] + [(3.0, 1.0, "one")] * 30
    phi = spark.createDataFrame(values, "value double, phi double, feature string")
    got = X.trend_and_caps(phi).orderBy("bin_low").toPandas()
    f = got[got.feature == "f"]
    want = X.dependence_trend(phi.where("feature = 'f'")).orderBy("low").toPandas()
    assert len(want) > 10 and (f[["bin_low", "bin_high", "mid", "mean_phi", "n"]].to_numpy() == want[["low", "high", "mid", "mean_phi", "n"]].to_numpy()).all()
    assert set(f.low) == {np.quantile([v for v, *_ in values[:1200]], 0.05)} and set(f.high) == {np.quantile([v for v, *_ in values[:1200]], 0.95)}
    rest = got[got.feature != "f"].set_index("feature")
    assert sorted(rest.index) == ["few", "one"] and rest.mean_phi.isna().all() and rest.low["one"] == 3 and rest.high["one"] == 3 + 1e-6


def test_local_surrogate(spark, data, split):
    trained = L.train_model(split[0], "logistic_regression", SPEC, {"maxIter": 20})
    got = X.local_surrogate(split[1], trained, n_each=2, n_samples=200, n_features=4, background=split[0])
    pdf = got.toPandas()
    assert len(pdf) == 4 * 4 and set(pdf.risk_bucket) == {"high", "low"} and np.isfinite(pdf.weight).all()
    assert pdf[pdf.risk_bucket == "high"].score.min() > pdf[pdf.risk_bucket == "low"].score.max()


def test_validation_and_types(spark):
    df = spark.createDataFrame([(1, 5, 50), (2, -1, None), (3, 5, 121)], "k int, los int, age int")
    valid, rejected = O.split_valid(df, {"age": (0, 120), "los": (0, None)})
    assert [r.k for r in valid.collect()] == [1]
    assert {r.k: r.failed for r in rejected.collect()} == {2: ["age:required", "los:range"], 3: ["age:range"]}
    with pytest.raises(ValueError):
        O.to_feature_types(df, SPEC)


def test_ways_to_meet_a_leaf_are_worked_out_once(monkeypatch):
    """Many rows give what each gives alone, from one small table a leaf."""
    rng, seen, real = np.random.default_rng(3), [], X.condition_values
    monkeypatch.setattr(X, "condition_values", lambda inside, *rest: seen.append(len(inside)) or real(inside, *rest))
    x, conditions = rng.normal(size=(500, 6)), [(1, -np.inf, 0.2, 0.4), (3, -0.5, np.inf, 0.7), (4, -1.0, 0.5, 0.25)]
    phi, alone = np.zeros(x.shape), np.zeros(x.shape)
    base = X.leaf_shapley(x, 1.5, conditions, phi)
    assert seen == [8]
    assert all(X.leaf_shapley(x[i : i + 1], 1.5, conditions, alone[i : i + 1]) == base for i in range(500))
    met = np.all([(x[:, f] > lo) & (x[:, f] <= hi) for f, lo, hi, _ in conditions], axis=0)
    assert np.allclose(phi, alone, atol=1e-12) and np.allclose(phi.sum(axis=1) + base, 1.5 * met, atol=1e-12)
