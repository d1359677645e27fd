"""Training, benchmark, search and ensembles on Spark ML estimators."""

from __future__ import annotations

import logging
import random
import statistics
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from episodica.operators.boosting import LeafwiseBoosting
from episodica.operators.decide import probability
from episodica.operators.encode import FittedEncoder, fit_encoder
from episodica.operators.linear import LinearModel, LogisticNewton, fit_logistic
from episodica.operators.metrics import metric_panel, pr_curve, ranking_scores, roc_curve
from episodica.operators.net import FeedForward, NetSettings, fit_net
from episodica.operators.splits import assign_balanced_folds, hold_out, sample_entities
from episodica.operators.trees import DeepForest, TreeEnsemble
from episodica.roles import FeatureSpec, ScoreRoles
from episodica.sources.files import write_curves
from episodica.sources.shared import store

logger = logging.getLogger(__name__)
SEED = 42


def logistic_regression(n_rows: int, **params):
    """L2 with strength 1/C on the summed loss, by Newton steps."""
    return LogisticNewton(**params)


def random_forest(n_rows: int, **params):
    return DeepForest(**{"trees": 200, "depth": 20, "leaf": 50, "seed": SEED, **params})


def extra_trees(n_rows: int, **params):
    """As a random forest, but every tree sees all rows, and a feature has one cut, drawn at random."""
    return random_forest(n_rows, **{"random_cuts": True, "bootstrap": False, **params})


def leafwise_boosting(n_rows: int, **params):
    """Up to 300 rounds of trees with up to 63 leaves; held-out rows stop it earlier."""
    return LeafwiseBoosting(**{"rounds": 300, "rate": 0.05, "leaves": 63, "leaf": 50, "seed": SEED, **params})


def boosted_trees(n_rows: int, **params):
    defaults = {"maxIter": 20, "maxDepth": 4, "stepSize": 0.1, "subsamplingRate": 0.9, "maxBins": 64, "seed": SEED}
    return GBTClassifier(**{**defaults, **params})


REGISTRY = {
    "logistic_regression": logistic_regression,
    "random_forest": random_forest,
    "extra_trees": extra_trees,
    "boosted_trees": boosted_trees,
    "leafwise_boosting": leafwise_boosting,
}


# classifiers that are kept as tables; any other is a model of Spark ML
TABLES = {"linear": LinearModel, "trees": TreeEnsemble, "net": FeedForward}
# what a model that can't be built or fitted on given rows raises; any other error is a fault of the program
REFUSALS = (PySparkException, Py4JJavaError, ValueError, ArithmeticError)


class VectorModel:
    """The stages that make the vector ``features``, and a classifier on it that adds the probability ``p``."""

    def __init__(self, stages: PipelineModel, classifier):
        self.stages, self.classifier = stages, classifier

    def transform(self, df: DataFrame) -> DataFrame:
        return self.transform_vectors(self.stages.transform(df))

    def transform_vectors(self, rows: DataFrame) -> DataFrame:
        """Adds ``p`` to rows that have their ``features``."""
        out = self.classifier.transform(rows)
        return out if isinstance(self.classifier, tuple(TABLES.values())) else out.withColumn("p", probability())

    def save(self, spark, path: str) -> None:
        kind = next((k for k, c in TABLES.items() if isinstance(self.classifier, c)), "spark")
        self.stages.write().overwrite().save(f"{path}/stages")
        if kind == "spark":
            PipelineModel(stages=[self.classifier]).write().overwrite().save(f"{path}/{kind}")
        else:
            self.classifier.save(spark, f"{path}/{kind}")
        spark.createDataFrame([(kind,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/kind")

    @classmethod
    def load(cls, spark, path: str) -> "VectorModel":
        kind = spark.read.text(f"{path}/kind").first()[0]
        stages = PipelineModel.load(f"{path}/stages")
        return cls(stages, TABLES[kind].load(spark, f"{path}/{kind}") if kind in TABLES else PipelineModel.load(f"{path}/{kind}").stages[0])


@dataclass
class TrainedModel:
    name: str
    encoder: FittedEncoder
    model: VectorModel

    def transform(self, df: DataFrame) -> DataFrame:
        """Rows with the vector and the probability ``p``."""
        return self.model.transform(self.encoder.prepare(df))

    def score(self, df: DataFrame) -> DataFrame:
        """``(key, label, model, p)``: scores are keyed rows, never positions."""
        spec = self.encoder.spec
        label = [spec.label] if spec.label in df.columns else []
        return self.transform(df).select(spec.key, *label, F.lit(self.name).alias("model"), "p")

    def save(self, spark, path: str) -> None:
        self.encoder.save(spark, f"{path}/encoder")
        self.model.save(spark, f"{path}/model")

    @classmethod
    def load(cls, spark, path: str, name: str = "loaded", spec: FeatureSpec = FeatureSpec()) -> "TrainedModel":
        return cls(name, FittedEncoder.load(spark, f"{path}/encoder", spec), VectorModel.load(spark, f"{path}/model"))


def train_model(
    train: DataFrame, name: str, spec: FeatureSpec = FeatureSpec(), params: dict | None = None, encoder: FittedEncoder | None = None
) -> TrainedModel:
    """Encoder and classifier, both fitted on ``train`` only; an encoder fitted on the same rows may be given."""
    encoder = encoder or fit_encoder(train, spec)
    estimator = REGISTRY[name](train.count(), **(params or {}))
    return TrainedModel(name, encoder, _fit(encoder, estimator, spread(encoder.prepare_train(train), spec.key), spec))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Even partitions, at least one per core: training passes over these rows many times."""
    spark = df.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(parts, key)


def vectors(encoder: FittedEncoder, prepared: DataFrame, spec: FeatureSpec, *kept: str) -> tuple[PipelineModel, DataFrame]:
    """The fitted stages and what they make of prepared rows: ``label``, ``features`` and the columns ``kept``."""
    needed = [c for c in prepared.columns if c.startswith(("num__", "bin__", "cat_low__", "cat_high__"))]
    labelled = prepared.select(F.col(spec.label).cast("double").alias("label"), *needed, *kept)
    stages = Pipeline(stages=encoder.stages(prepared.sparkSession)).fit(labelled)
    return stages, stages.transform(labelled).select(*kept, "features", "label")


def _fit(encoder: FittedEncoder, estimator, prepared: DataFrame, spec: FeatureSpec) -> VectorModel:
    return fit_vectors(estimator, *vectors(encoder, prepared, spec))


def fit_vectors(estimator, stages: PipelineModel, rows: DataFrame, kept: bool = False) -> VectorModel:
    """An estimator of Spark ML reads its rows several times before it has a form of its own: they are made once, on disk.

    Partitions and their order stay as they are, so its samples do too.  Other estimators store their rows, and ``kept``
    rows come from a table that is on disk already.
    """
    once = isinstance(estimator, Estimator) and not kept
    rows = rows.select("features", "label")
    if once:
        rows = rows.persist(StorageLevel.DISK_ONLY)
    try:
        return VectorModel(stages, estimator.fit(rows))
    finally:
        if once:
            rows.unpersist()


def benchmark(
    train: DataFrame, val: DataFrame, names, scores_path: str, spec: FeatureSpec = FeatureSpec(), params: dict | None = None
) -> tuple[dict[str, TrainedModel], DataFrame]:
    """Fit each model on ``train``, write its validation scores and curves, and return the models and the leaderboard.

    A model that cannot be built or fitted has no scores and stands in the leaderboard without metrics, with ``state`` FAIL
    and its ``error``; it is an error if none succeeds.  Names that the registry lacks are skipped.  Scores are stored as
    Parquet partitioned by model, so later reports read them instead of fitting again; those that an earlier run left for a
    model that fails now are not read.
    """
    spark = train.sparkSession
    encoder = fit_encoder(train, spec)
    n_rows = train.count()
    prepared = spread(encoder.prepare_train(train), spec.key).persist()
    models, timings = {}, []
    for name in names:
        started = time.time()
        if name not in REGISTRY:
            logger.warning("%s is not in the registry", name)
            continue
        try:
            estimator = REGISTRY[name](n_rows, **((params or {}).get(name, {})))
            trained = TrainedModel(name, encoder, _fit(encoder, estimator, prepared, spec))
            fitted = time.time()
            trained.score(val).drop("model").write.mode("overwrite").parquet(f"{scores_path}/model={name}")
        except REFUSALS as error:  # one failing model must not end the benchmark
            logger.warning("%s failed: %s", name, error)
            timings.append((name, None, None, "FAIL", f"{type(error).__name__}: {error}"[:1000]))
            continue
        models[name] = trained
        timings.append((name, fitted - started, time.time() - fitted, "COMPLETE", None))
    prepared.unpersist()
    if not models:
        raise RuntimeError("no model could be trained")
    roles = ScoreRoles(spec.key, spec.label, "p")
    scores = spark.read.parquet(scores_path).where(F.col("model").isin(list(models)))
    board = metric_panel(scores, roles, by=["model"])
    store_curves(scores, roles, f"{scores_path.rstrip('/')}-curves")
    states = spark.createDataFrame(timings, "model string, fit_seconds double, predict_seconds double, state string, error string")
    return models, board.join(states, "model", "right")


def store_curves(scores: DataFrame, roles: ScoreRoles, path: str) -> None:
    """Precision-recall and ROC curve of every model in a table of scores."""
    write_curves({"pr": pr_curve(scores, roles, ["model"]), "roc": roc_curve(scores, roles, ["model"])}, path)


def leaderboard(panel: DataFrame, metric: str = "pr_auc", name: str = "model") -> DataFrame:
    return panel.orderBy(F.desc(metric), F.asc(name))


# Search spaces as (kind, low, high[, step]) or (kind, choices), around the defaults above.
SPACES = {
    "boosted_trees": {
        "maxIter": ("int", 10, 20, 5),
        "maxDepth": ("int", 3, 5, 1),
        "stepSize": ("log", 0.02, 0.2),
        "minInstancesPerNode": ("int", 1, 20, 1),
        "subsamplingRate": ("float", 0.6, 1.0),
        "maxBins": ("choice", (32, 64, 128)),
    },
    "random_forest": {
        "trees": ("int", 100, 300, 50),
        "depth": ("int", 10, 20, 2),
        "leaf": ("int", 20, 200, 10),
    },
    "leafwise_boosting": {
        "rounds": ("int", 200, 800, 50),
        "rate": ("log", 0.01, 0.2),
        "leaves": ("int", 15, 127, 8),
        "leaf": ("int", 20, 200, 10),
        "l2": ("log", 0.001, 10.0),
    },
    "logistic_regression": {"C": ("log", 0.01, 100.0)},
}


def draw(space: dict, rng: random.Random) -> dict:
    """One random point of a search space."""
    out = {}
    for name, (kind, *bounds) in space.items():
        if kind == "int":
            low, high, step = bounds
            out[name] = rng.randrange(low, high + 1, step)
        elif kind == "log":
            low, high = bounds
            out[name] = low * (high / low) ** rng.random()
        elif kind == "float":
            out[name] = rng.uniform(*bounds)
        else:
            out[name] = rng.choice(bounds[0])
    return out


@dataclass
class Fold:
    """What all trials on a fold share: its stages, and the vectors of its training and validation rows, made once, on disk."""

    rows: int
    stages: PipelineModel | None
    train: DataFrame
    val: DataFrame


def _cv_frames(df: DataFrame, spec: FeatureSpec, k: int, seed: int) -> list[Fold]:
    """The folds.  Encoders, stages and vectors are made once for all trials; no stages are left where they can't be fitted."""
    folded = store(assign_balanced_folds(df, spec.entity, spec.key, spec.label, k, seed), "folds")
    frames = []
    for i in range(k):
        train, val = folded.where(F.col("fold") != i), folded.where(F.col("fold") == i)
        encoder = fit_encoder(train, spec)
        prepared, held_out = store(spread(encoder.prepare_train(train), spec.key), "fold-train"), store(encoder.prepare(val), "fold-val")
        try:
            stages, rows = vectors(encoder, prepared, spec, spec.entity)
            scored = stages.transform(held_out).select(spec.key, spec.label, "features").persist(StorageLevel.DISK_ONLY)
            frames.append(Fold(prepared.count(), stages, rows.persist(StorageLevel.DISK_ONLY), scored))
        except REFUSALS as error:
            logger.warning("fold %s: %s", i, error)
            frames.append(Fold(prepared.count(), None, prepared, held_out))
    return frames


def _release(frames: list[Fold]) -> None:
    for fold in frames:
        fold.train.unpersist()
        fold.val.unpersist()


def concurrently(spark, work: list[Callable], at_once: int) -> list:
    """Results of calls that start Spark jobs, ``at_once`` at a time, in the order given.

    Each slot has a scheduler pool of its own, so with ``spark.scheduler.mode`` FAIR they share the executors evenly.
    The threads have the caller's job settings.
    """
    if at_once <= 1 or len(work) <= 1:
        return [call() for call in work]

    def run(call, slot):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"trial-{slot}")
        return call()

    with ThreadPoolExecutor(at_once) as threads:
        return list(threads.map(inheritable_thread_target(run), work, [i % at_once for i in range(len(work))]))


def fold_value(fold: Fold, name: str, params: dict, spec: FeatureSpec, train: DataFrame | None = None, n_rows: int | None = None) -> float | None:
    """Average precision on a fold's held-out rows of a model fitted on its other rows; None if it can't be fitted."""
    if fold.stages is None:
        return None
    try:
        estimator = REGISTRY[name](n_rows or fold.rows, **params)
        model = fit_vectors(estimator, fold.stages, fold.train if train is None else train, kept=True)
        scored = model.transform_vectors(fold.val).select(spec.key, spec.label, "p")
        found = ranking_scores(scored, ScoreRoles(spec.key, spec.label, "p")).first()
    except REFUSALS as error:
        logger.warning("%s %s failed: %s", name, params, error)
        return None
    return found.pr_auc if found else None


def search(
    df: DataFrame,
    names,
    n_trials: int,
    spec: FeatureSpec = FeatureSpec(),
    k: int = 3,
    seed: int = SEED,
    budget_seconds: float | None = None,
    spaces: dict | None = None,
    sample: int | None = None,
    at_once: int = 4,
    least: int = 5,
) -> DataFrame:
    """Seeded random search with grouped, stratified folds, maximising average precision; ``at_once`` fits run side by side.

    Returns the trial history ``(model, number, params, value, seconds, state)``.  All statistics are refitted inside
    each fold.  The trials of a family go through the folds together.  After each fold but the last those whose mean
    so far is below the family's median end as ``PRUNED`` (``value`` is that mean), if at least ``least`` are left to
    compare; so the outcome does not depend on how many run side by side.  A trial that can't be fitted is ``FAIL``.
    With a budget in seconds no further trial begins when the time is over, but each family gets one.
    ``sample`` bounds the rows of the search: whole entities are drawn.
    """
    spark, spaces = df.sparkSession, spaces or SPACES
    if sample is not None:
        df = sample_entities(df, sample, spec.entity, spec.key, spec.label, seed)
    frames, started = _cv_frames(df, spec, k, seed), time.time()
    rngs = {name: random.Random(f"{name}|{seed}") for name in names}
    trials = [{"name": name, "number": n, "params": draw(spaces[name], rngs[name]), "values": [], "seconds": 0.0, "state": None} for n in range(n_trials) for name in names]

    def run(trial, fold):
        begun = time.time()
        if fold == 0 and trial["number"] and budget_seconds is not None and begun - started > budget_seconds:
            return "LATE", 0.0
        return fold_value(frames[fold], trial["name"], trial["params"], spec), time.time() - begun

    for fold in range(k):
        going = [t for t in trials if t["state"] is None]
        for trial, (value, seconds) in zip(going, concurrently(spark, [lambda t=t: run(t, fold) for t in going], at_once), strict=True):
            trial["seconds"] += seconds
            if value is None or value == "LATE":
                trial["state"] = value or "FAIL"
            else:
                trial["values"].append(value)
        for name in names:
            alive = [t for t in going if t["name"] == name and t["state"] is None]
            if fold < k - 1 and len(alive) >= least:
                middle = statistics.median(statistics.fmean(t["values"]) for t in alive)
                for t in alive:
                    t["state"] = "PRUNED" if statistics.fmean(t["values"]) < middle else None
    _release(frames)
    history = [
        (t["name"], t["number"], {p: str(v) for p, v in t["params"].items()}, statistics.fmean(t["values"]) if t["values"] and t["state"] != "FAIL" else None,
         t["seconds"], t["state"] or "COMPLETE")
        for t in trials if t["state"] != "LATE"
    ]
    schema = "model string, number int, params map<string,string>, value double, seconds double, state string"
    return spark.createDataFrame(history, schema)


def budgeted_search(
    df: DataFrame, names, budget_rows: int, spec: FeatureSpec = FeatureSpec(), k: int = 3, seed: int = SEED, rungs: int = 3, spaces: dict | None = None
) -> DataFrame:
    """Search over several families until ``budget_rows`` rows have been trained on, on nested samples of entities.

    Rung r of ``rungs`` trains on a share 2^(r + 1 - rungs) of a fold's entities; as a hash chooses them, each rung
    holds the one below, and entities stay whole.  All rungs are scored on the fold's whole held-out rows.  A family
    either begins a trial on rung 0, or, as soon as a rung has two finished trials for each one that left it and one
    more to leave, lets its best go one rung up.  The next family is one without a trial, then the one that last gained
    most average precision per row trained (the least trained one on a tie).  A step that the budget can't pay is not
    made, and a family that can't pay any step is out.  Everything is counted in rows, so reruns make the same steps.

    Returns the history ``(model, number, rung, params, value, rows, seconds, state)``, one row a trial and rung;
    ``COMPLETE`` is a trial's state on the top rung, ``RUNG`` below it, ``FAIL`` if it can't be fitted.
    """
    spark, spaces = df.sparkSession, spaces or SPACES
    frames, steps = _cv_frames(df, spec, k, seed), 1 << 20
    dealt = F.pmod(F.xxhash64(F.col(spec.entity).cast("string"), F.lit(seed)), F.lit(steps))
    sampled = []
    for rung in range(rungs):
        some = [f.train.where(dealt < (steps >> (rungs - 1 - rung))) for f in frames]
        sampled.append([(rows, rows.count()) for rows in some])
    cost = [sum(n for _, n in of_rung) for of_rung in sampled]
    rngs = {name: random.Random(f"{name}|{seed}") for name in names}
    arms = {name: {"done": [[] for _ in range(rungs)], "left": [set() for _ in range(rungs)], "best": 0.0, "gain": None, "rows": 0, "open": True} for name in names}
    history, spent, params_of = [], 0, {}
    while True:
        choice = sorted((a["gain"] is not None, -(a["gain"] or 0.0), a["rows"], i) for i, a in enumerate(arms.values()) if a["open"])
        if not choice:
            break
        name = list(names)[choice[0][3]]
        arm, number, rung = arms[name], None, 0
        for r in range(rungs - 2, -1, -1):
            waiting = [(value, -n) for value, n in arm["done"][r] if n not in arm["left"][r]]
            if waiting and len(arm["done"][r]) >= 2 * (len(arm["left"][r]) + 1):
                number, rung = -max(waiting)[1], r + 1
                break
        if spent + cost[rung] > budget_rows:
            arm["open"] = False
            continue
        if number is None:
            number = sum(key[0] == name for key in params_of)
            params_of[name, number] = draw(spaces[name], rngs[name])
        else:
            arm["left"][rung - 1].add(number)
        begun, params = time.time(), params_of[name, number]
        calls = [lambda f=f, rows=rows, n=n: fold_value(f, name, params, spec, rows, n) for f, (rows, n) in zip(frames, sampled[rung], strict=True)]
        values = concurrently(spark, calls, k)
        spent, arm["rows"] = spent + cost[rung], arm["rows"] + cost[rung]
        value = None if None in values else statistics.fmean(values)
        arm["gain"] = max(0.0, (value or 0.0) - arm["best"]) / max(cost[rung], 1)
        if value is not None:
            arm["best"] = max(arm["best"], value)
            arm["done"][rung].append((value, number))
        state = "FAIL" if value is None else "COMPLETE" if rung == rungs - 1 else "RUNG"
        history.append((name, number, rung, {p: str(v) for p, v in params.items()}, value, cost[rung], time.time() - begun, state))
        if cost[rung] == 0:
            arm["open"] = False
    _release(frames)
    schema = "model string, number int, rung int, params map<string,string>, value double, rows long, seconds double, state string"
    return spark.createDataFrame(history, schema)


def refit_best(
    trials: DataFrame, train: DataFrame, val: DataFrame, scores_path: str, spec: FeatureSpec = FeatureSpec(), spaces: dict | None = None
) -> tuple[dict[str, TrainedModel], DataFrame]:
    """The best trial of each family fitted on all of ``train``: the models and their validation panel.

    Validation scores go to ``scores_path`` as in :func:`benchmark`, the curves of each model beside them.
    """
    chosen = {r.model: typed_params(r.params, (spaces or SPACES)[r.model]) for r in best_trial(trials).collect()}
    models, board = benchmark(train, val, list(chosen), scores_path, spec, chosen)
    return models, board


def typed_params(params: dict[str, str], space: dict) -> dict:
    """Parameters of a trial as numbers again."""
    out = {}
    for name, text in params.items():
        kind, *bounds = space[name]
        out[name] = type(bounds[0][0])(text) if kind == "choice" else int(text) if kind == "int" else float(text)
    return out


def running_best(trials: DataFrame, by: str = "model") -> DataFrame:
    """Completed trials with the best value so far; a search has a bounded number of trials."""
    window = W.partitionBy(by).orderBy("number").rowsBetween(W.unboundedPreceding, 0)
    return trials.where(F.col("state") == "COMPLETE").withColumn("best_value", F.max("value").over(window))


def best_trial(trials: DataFrame, by: str = "model") -> DataFrame:
    """The completed trial with the highest value per model; the earliest one wins a tie."""
    columns = [c for c in trials.columns if c != by]
    done = trials.where((F.col("state") == "COMPLETE") & F.col("value").isNotNull())
    best = done.groupBy(by).agg(F.min_by(F.struct(*columns), F.struct(-F.col("value"), F.col("number"))).alias("_b"))
    return best.select(by, "_b.*")


def pick_winner(panel: DataFrame, metric: str = "pr_auc", name: str = "model") -> DataFrame:
    """One row: the best model by a metric, by name on a tie."""
    return panel.agg(F.min_by(F.struct(name, metric), F.struct(-F.col(metric), F.col(name))).alias("_w")).select("_w.*")


def compare_to_baseline(tuned: DataFrame, baseline: DataFrame, metrics, lower_is_better=("brier", "log_loss"), name: str = "model") -> DataFrame:
    """Long table of tuned, baseline, delta and whether it is better, per model and metric."""
    joined = tuned.join(baseline.select(name, *[F.col(m).alias(f"{m}_base") for m in metrics]), name, "left")
    cells = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("tuned"), F.col(f"{m}_base").alias("baseline")) for m in metrics]
    long = joined.select(name, F.inline(F.array(*cells))).withColumn("delta", F.col("tuned") - F.col("baseline"))
    lower = F.col("metric").isin(list(lower_is_better))
    return long.withColumn("improved", F.when(lower, F.col("delta") < 0).otherwise(F.col("delta") > 0))


def rank_metrics(panel: DataFrame, metrics, lower_is_better=("brier", "log_loss"), name: str = "model") -> DataFrame:
    """Rank of each model per metric, 1 = best, each metric in its own direction."""
    long = panel.unpivot([name], list(metrics), "metric", "value")
    signed = F.when(F.col("metric").isin(list(lower_is_better)), F.col("value")).otherwise(-F.col("value"))
    return long.withColumn("rank", F.rank().over(W.partitionBy("metric").orderBy(signed)))


def train_neural_net(train: DataFrame, spec: FeatureSpec = FeatureSpec(), **settings) -> TrainedModel:
    """Feed-forward net with weighted positives; a tenth of the rows, held out at random, ends the training early."""
    encoder = fit_encoder(train, spec)
    prepared = spread(hold_out(encoder.prepare_train(train), spec.key), spec.key).withColumn("label", F.col(spec.label).cast("double"))
    stages = Pipeline(stages=encoder.stages(train.sparkSession)).fit(prepared)
    rows = stages.transform(prepared).select("features", "label", "is_validation")
    return TrainedModel("neural_net", encoder, VectorModel(stages, fit_net(rows, NetSettings(**settings))))


def align_scores(scores: DataFrame, models, key: str = "claim_id", label: str = "y") -> DataFrame:
    """One row per key with one score column per model."""
    return scores.groupBy(key, label).pivot("model", list(models)).agg(F.first("p"))


def soft_vote(scores: DataFrame, key: str = "claim_id", label: str = "y", models=None) -> DataFrame:
    """Mean score over the models.

    With ``models`` the vote is that of all of them: a key that lacks the score of one, or has NULL or NaN for it, is an error.
    """
    if models is None:
        return scores.groupBy(key, label).agg(F.avg("p").alias("p"))
    scored = F.col("p").isNotNull() & ~F.isnan("p")
    voted = [F.max(F.when((F.col("model") == m) & scored, 1).otherwise(0)).alias(f"_m{i}") for i, m in enumerate(models)]
    votes = scores.where(F.col("model").isin(list(models))).groupBy(key, label).agg(F.avg("p").alias("p"), *voted)
    lacks = F.concat(F.lit("no vote without the score of every model; key "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
    whole = F.array_min(F.array(F.lit(1), *[F.col(f"_m{i}") for i in range(len(models))])) == 1
    return votes.select(key, label, F.when(whole, F.col("p")).otherwise(F.raise_error(lacks)).alias("p"))


def stack(calib: DataFrame, test: DataFrame, models, label: str = "y"):
    """Logistic regression on aligned base scores: ``(scored test rows, coefficient per model, intercept)``."""
    aligned = F.array(*[F.col(m).cast("double") for m in models])
    fitted = fit_logistic(calib.dropna(subset=list(models)).select(aligned.alias("_v"), label), "_v", label)
    scored = fitted.transform(test.dropna(subset=list(models)).withColumn("_v", aligned), "_v").drop("_v")
    return scored, dict(zip(models, fitted.coefficients)), fitted.intercept


def ensemble_report(scores: DataFrame, models, entity: str, key: str = "claim_id", label: str = "y", half: str = "half", curves_path: str | None = None):
    """Base models, vote and stack on the test half: ``(leaderboard, stack coefficients)``.

    ``scores`` is the keyed score table with a ``half`` column.  Base models without any score are left out; at
    least two must be there, and a row that one of them has no score for is an error.  The curves of all go to ``curves_path``.
    """
    present = {r.model for r in scores.select("model").distinct().collect()}
    used = [m for m in models if m in present]
    if len(used) < len(models):
        logger.warning("no scores of %s", [m for m in models if m not in present])
    if len(used) < 2:
        raise ValueError(f"an ensemble needs two base models, found {used}")
    base = scores.where(F.col("model").isin(used))
    wide = base.groupBy(key, label, half).pivot("model", used).agg(F.first("p"))
    calib, test = wide.where(F.col(half) == "calib"), wide.where(F.col(half) == "test")
    stacked, coefficients, _ = stack(calib, test, used, label)
    parts = [
        base.where(F.col(half) == "test").select(key, label, "model", "p"),
        soft_vote(base.where(F.col(half) == "test"), key, label, used).withColumn("model", F.lit("soft_vote")),
        stacked.select(key, label, "p").withColumn("model", F.lit("stacking")),
    ]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    if curves_path:
        store_curves(union, ScoreRoles(key, label, "p"), curves_path)
    return leaderboard(metric_panel(union, ScoreRoles(key, label, "p"), by=["model"])), coefficients
