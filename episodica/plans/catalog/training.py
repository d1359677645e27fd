"""Fitted models and what follows from them.  Their numbers depend on Spark ML, so most have no SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from episodica.operators import explain as X
from episodica.operators import metrics as M
from episodica.operators import models as L
from episodica.operators import score as O
from episodica.operators.encode import fit_encoder
from episodica.operators.splits import assign_halves
from episodica.plans import train as T
from episodica.plans import views as V
from episodica.plans.catalog.decisions import _all, _train
from episodica.plans.catalog.registry import query, rnd
from episodica.roles import FeatureSpec, ScoreRoles
from episodica.sources.shared import shared_path, store
from episodica.streaming import scoring

SPEC = FeatureSpec()
V_ROLES = ScoreRoles("claim_id", "y", "p")
FAMILIES = ("logistic_regression", "random_forest", "boosted_trees")
_FITTED: dict = {}


def _once(spark, sf, name, build):
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _FITTED:
        _FITTED[key] = build()
    return _FITTED[key]


def _val(spark, sf):
    return _all(spark, sf).where("split = 'val'")


def _model(spark, sf, name):
    encoder = _once(spark, sf, "encoder", lambda: fit_encoder(_train(spark, sf), SPEC))
    return _once(spark, sf, name, lambda: L.train_model(_train(spark, sf), name, SPEC, None, encoder))


def _bench(spark, sf):
    def build():
        path = shared_path(spark, "benchmark-scores")
        models, board = L.benchmark(_train(spark, sf), _val(spark, sf), FAMILIES, path, SPEC)
        return path, board, [name for name in FAMILIES if name not in models]

    return _once(spark, sf, "benchmark", build)


def _calibration(spark, sf):
    return _once(spark, sf, "calibration", lambda: T.calibrate_model(_model(spark, sf, "boosted_trees"), _val(spark, sf)))


def _audit(spark, sf):
    return _once(spark, sf, "audit", lambda: T.audit_model(_calibration(spark, sf), _val(spark, sf)))


# ---------------------------------------------------------------- encoding to vectors
@query("k7_feature_vector")
def feature_vector(spark, sf):
    """Non-zero slots of the assembled vector, by name."""
    trained = _model(spark, sf, "logistic_regression")
    names = F.array(*[F.lit(n) for n in trained.encoder.feature_names()])
    from pyspark.ml.functions import vector_to_array

    rows = trained.transform(_val(spark, sf)).select(vector_to_array("features").alias("x"))
    cells = rows.select(F.inline(F.arrays_zip(names.alias("feature"), F.col("x").alias("value"))))
    return cells.groupBy("feature").agg(F.count_if(F.col("value") != 0).alias("n_nonzero"), F.avg("value").alias("mean"))


@query("k8_train_only_fit")
def train_only_fit(spark, sf):
    """Statistics of an encoder fitted on each training fold: they differ because the folds do."""
    from episodica.operators.encode import numeric_stats
    from episodica.operators.splits import assign_folds

    folded = assign_folds(_train(spark, sf), "beneficiary_id", "claim_id")
    out = None
    for i in range(3):
        part = numeric_stats(folded.where(F.col("fold") != i), SPEC.numeric).withColumn("held_out", F.lit(i))
        out = part if out is None else out.unionByName(part)
    return out


# ---------------------------------------------------------------- models
@query("l1_logistic_regression")
def logistic_regression(spark, sf):
    return _model(spark, sf, "logistic_regression").score(_val(spark, sf))


@query("l2_random_forest")
def random_forest(spark, sf):
    return _model(spark, sf, "random_forest").score(_val(spark, sf))


@query("l3_boosted_trees")
def boosted_trees(spark, sf):
    return _model(spark, sf, "boosted_trees").score(_val(spark, sf))


@query("l3_leafwise_boosting")
def leafwise_boosting(spark, sf):
    """Best-leaf-first boosting from gradient histograms, with early stop."""
    return _model(spark, sf, "leafwise_boosting").score(_val(spark, sf))


@query("l2_extra_trees")
def extra_trees(spark, sf):
    return _model(spark, sf, "extra_trees").score(_val(spark, sf))


@query("l4_neural_net")
def neural_net(spark, sf):
    trained = _once(spark, sf, "net", lambda: L.train_neural_net(_train(spark, sf), SPEC))
    return trained.score(_val(spark, sf))


@query("l6_benchmark")
def benchmark(spark, sf):
    """A family that can't be fitted stands last, with its error."""
    return L.leaderboard(_bench(spark, sf)[1])


def _trials(spark, sf):
    def build():
        names = ["logistic_regression", "boosted_trees"]
        return L.search(_train(spark, sf), names, 8, SPEC)

    return _once(spark, sf, "trials", build)


@query("l7_search")
def search(spark, sf):
    return _trials(spark, sf).withColumn("params", F.to_json("params"))


@query("l7_refit")
def refit(spark, sf):
    """The best trial of each family on all training rows: its validation metrics."""
    _, board = L.refit_best(_trials(spark, sf), _train(spark, sf), _val(spark, sf), shared_path(spark, "refit-scores"), SPEC)
    return board.drop("fit_seconds", "predict_seconds", "state", "error")


@query("d24_fold_mean")
def fold_mean(spark, sf):
    """Mean over folds of a model's average precision."""
    from episodica.operators.splits import assign_folds

    folded = assign_folds(_train(spark, sf), "beneficiary_id", "claim_id").select("claim_id", "fold")
    scores = _model(spark, sf, "logistic_regression").score(_train(spark, sf)).join(folded, "claim_id")
    return M.ranking_scores(scores, V_ROLES, ["model", "fold"]).groupBy("model").agg(F.avg("pr_auc").alias("mean_pr_auc"))


# a trial history derived from the supplier table: number, value and state per family
_TRIALS = "tr AS (SELECT s_nationkey AS fam, s_suppkey AS number, s_acctbal AS value, CASE WHEN s_suppkey % 7 = 3 THEN 'FAIL' ELSE 'COMPLETE' END AS state FROM supplier)"


def _trial_table(spark, sf):
    state = F.when(F.col("s_suppkey") % 7 == 3, "FAIL").otherwise("COMPLETE")
    return V.table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("fam"), F.col("s_suppkey").alias("number"), F.col("s_acctbal").alias("value"), state.alias("state")
    )


@query(
    "e5_running_best",
    f"WITH {_TRIALS} SELECT fam::BIGINT AS fam, number, {rnd('value', 'value')}, {rnd('max(value) OVER (PARTITION BY fam ORDER BY number ROWS UNBOUNDED PRECEDING)', 'best_value')} FROM tr WHERE state = 'COMPLETE'",
)
def running_best(spark, sf):
    return L.running_best(_trial_table(spark, sf), "fam").drop("state")


@query(
    "l8_best_trial",
    f"WITH {_TRIALS} SELECT fam::BIGINT AS fam, number, {rnd('value', 'value')} FROM tr WHERE state = 'COMPLETE' QUALIFY row_number() OVER (PARTITION BY fam ORDER BY value DESC, number) = 1",
)
def best_trial(spark, sf):
    return L.best_trial(_trial_table(spark, sf), "fam").drop("state")


@query("l9_budgeted_search")
def budgeted_search(spark, sf):
    """Families compete for a budget of six times the training rows, on nested samples of entities."""
    rows = _train(spark, sf)
    trials = L.budgeted_search(rows, ["logistic_regression", "boosted_trees"], 6 * rows.count(), SPEC)
    return trials.groupBy("model", "rung", "state").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("best_value"), F.sum("rows").alias("rows"))


def _base_scores(spark, sf):
    """Scores of all families; an ensemble of fewer would look like theirs."""
    path, _, failed = _bench(spark, sf)
    if failed:
        raise RuntimeError(f"no scores of {', '.join(failed)}: an ensemble needs all of {', '.join(FAMILIES)}")
    halves = assign_halves(_val(spark, sf), "beneficiary_id", "claim_id").select("claim_id", "half")
    return spark.read.parquet(path).join(halves, "claim_id")


@query("l11_stacking")
def stacking(spark, sf):
    used = ["boosted_trees", "logistic_regression", "random_forest"]
    wide = _base_scores(spark, sf).groupBy("claim_id", "y", "half").pivot("model", used).agg(F.first("p"))
    scored, _, _ = L.stack(wide.where("half = 'calib'"), wide.where("half = 'test'"), used)
    return scored.select("claim_id", "y", "p")


@query("l12_ensemble_report")
def ensemble_report(spark, sf):
    return L.ensemble_report(_base_scores(spark, sf), FAMILIES, "beneficiary_id", curves_path=shared_path(spark, "ensemble-curves"))[0]


# ---------------------------------------------------------------- calibration, audit, scoring
@query("j2_calibrators")
def calibrators(spark, sf):
    return _calibration(spark, sf).panel


@query("j4_reliability_before_after")
def reliability_before_after(spark, sf):
    return _calibration(spark, sf).reliability


@query("m1_audit")
def audit(spark, sf):
    return _audit(spark, sf)[1]


@query("o2_batch_scores")
def batch_scores(spark, sf):
    """A scorer saved, loaded again, and applied to the test split."""
    path = shared_path(spark, "scorer")
    _calibration(spark, sf).scorer.save(spark, path)
    return O.Scorer.load(spark, path).score(_all(spark, sf).where("split = 'test'"))


@query("o3_stream_scores")
def stream_scores(spark, sf):
    """The test split as a stream of files; equal to the batch scores."""
    out, checkpoint = shared_path(spark, "stream-out"), shared_path(spark, "stream-checkpoint")
    source = shared_path(spark, "stream-in")
    _all(spark, sf).where("split = 'test'").write.parquet(source)
    requests = scoring.read_requests(spark, source, _all(spark, sf).schema)
    running = scoring.score_stream(requests, _calibration(spark, sf).scorer, out, checkpoint)
    running.awaitTermination()
    return spark.read.parquet(f"{out}/scored").drop("batch")


# ---------------------------------------------------------------- explanations
def _linear(spark, sf):
    trained = _model(spark, sf, "logistic_regression")
    rows = trained.transform(_val(spark, sf))
    means = X.vector_mean(trained.transform(_train(spark, sf)))
    return X.linear_attributions(rows, trained.model.classifier, trained.encoder.feature_names(), means, "claim_id")


def _phi(spark, sf):
    """Tree attributions of the validation split."""

    def build():
        trained = _model(spark, sf, "boosted_trees")
        rows = trained.transform(_val(spark, sf))
        phi, base = X.tree_attributions(rows, trained.model.classifier, trained.encoder.feature_names(), "claim_id")
        return store(phi, "attributions"), base

    return _once(spark, sf, "phi", build)


@query("p1_tree_attributions")
def tree_attributions(spark, sf):
    return _phi(spark, sf)[0].where("phi <> 0")


@query("p1_linear_attributions")
def linear_attributions(spark, sf):
    phi, _ = _linear(spark, sf)
    return phi.where("phi <> 0")


@query("d20_attribution_summary")
def attribution_summary(spark, sf):
    return X.importance(_phi(spark, sf)[0])


@query("p2_importance")
def importance(spark, sf):
    return X.importance(_linear(spark, sf)[0])


@query("d21_dependence_trend")
def dependence_trend(spark, sf):
    return X.dependence_trend(_phi(spark, sf)[0])


@query("p3_trend_and_caps")
def trend_and_caps(spark, sf):
    """Value caps (5 % and 95 %) of every feature, and the trend of those with more than ten values, a row a bin."""
    return X.trend_and_caps(_phi(spark, sf)[0])


@query("p4_local_surrogate")
def local_surrogate(spark, sf):
    trained = _model(spark, sf, "boosted_trees")
    return X.local_surrogate(_val(spark, sf), trained, background=_train(spark, sf))


@query("f9_top_contributions")
def top_contributions(spark, sf):
    return X.top_contributions(_phi(spark, sf)[0], "claim_id")


@query("p6_row_explanation")
def row_explanation(spark, sf):
    """Top contributions and implied probability of the rows with the 10th lowest and highest score."""
    phi, base = _phi(spark, sf)
    implied = X.implied_probability(phi, base, "claim_id")
    rows = X.nth_extremes(implied, "p", "claim_id", 10)
    return X.top_contributions(phi.join(rows, "claim_id"), "claim_id").select("claim_id", "risk_bucket", "p", "feature", "value", "phi", "rank")
