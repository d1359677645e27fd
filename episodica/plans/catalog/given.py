"""Encoder fitted on the training split, classifiers with given coefficients: scores and what follows from them, with SQL."""

from __future__ import annotations

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from episodica.operators import audit as A
from episodica.operators import explain as X
from episodica.operators import metrics as M
from episodica.operators import score as O
from episodica.operators import splits as P
from episodica.operators.compiled import compile_scorer
from episodica.operators.decide import Calibrator
from episodica.operators.encode import RARE, fit_encoder, numeric_stats
from episodica.operators.linear import LinearModel
from episodica.operators.models import TrainedModel, VectorModel
from episodica.operators.trees import KINDS, PACKED, TreeEnsemble
from episodica.plans import views as V
from episodica.plans.catalog.decisions import _STATS, _TARGET, _TEXT, SPEC, TRAIN, _all, _smooth, _train
from episodica.plans.catalog.evaluation import AUDIT_ROLES, SLICES, _edges, panel_sql
from episodica.plans.catalog.fixed import PHI, _phi
from episodica.plans.catalog.registry import ORACLE, query, rnd
from episodica.plans.catalog.training import _once
from episodica.roles import ScoreRoles
from episodica.sources.shared import shared_path, store
from episodica.streaming import scoring

# ---------------------------------------------------------------- a logistic model whose coefficients follow a rule
NUMBERS = {c: (-1) ** i * 0.1 * (i + 1) for i, c in enumerate(SPEC.numeric)}
FLAGS = {c: 0.05 * (i + 1) for i, c in enumerate(SPEC.binary)}
LETTER, SHARED, MEANS, START = 0.02, 0.3, 2.0, -2.0
SLOPE, SHIFT, THRESHOLD = 3.0, -2.0, 0.2

_MODES = ", ".join(f"(SELECT v FROM (SELECT CAST({c} AS BIGINT) AS v, count(*) AS n FROM train WHERE {c} IS NOT NULL GROUP BY 1) ORDER BY n DESC, v LIMIT 1) AS mode_{c}" for c in SPEC.binary)
_KEPT = " UNION ALL ".join(f"SELECT '{c}' AS feature, {_TEXT.format(c=c)} AS level, count(*) < 20 AS rare FROM train GROUP BY 2" for c in SPEC.cat_low)
_SHARES = f"""g AS (SELECT feature, level, count(*) AS n, sum(y) AS s FROM lv GROUP BY feature, level),
 t AS (SELECT *, sum(n) OVER (PARTITION BY feature)::DOUBLE AS tn, sum(s) OVER (PARTITION BY feature) AS ts FROM g),
 codes AS (SELECT feature, level, {_smooth('n::DOUBLE', 's', 'tn', 'ts')} AS encoded FROM t)"""
# every row with its numbers and flags scaled, its one-hot levels joined (k_) and its target means joined (h_)
ENCODED = f"""{_TARGET}, {_SHARES}, kept AS ({_KEPT}),
one AS (SELECT {', '.join(f'median({c})::DOUBLE AS med_{c}, avg({c}) AS mean_{c}, CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1 END AS std_{c}' for c in SPEC.numeric)}, {_MODES}, avg(y::DOUBLE) AS overall FROM train),
vec AS (SELECT f.claim_id, f.beneficiary_id, f.split, f.y, f.sex, f.race, f.age_bin,
 {', '.join(f'(coalesce(f.{c}::DOUBLE, med_{c}) - mean_{c}) / std_{c} AS num__{c}' for c in SPEC.numeric)},
 {', '.join(f'coalesce(CAST(f.{c} AS BIGINT), mode_{c}, 0)::DOUBLE AS bin__{c}' for c in SPEC.binary)},
 {', '.join(f'k_{c}.level AS low_{c}, k_{c}.rare AS rare_{c}' for c in SPEC.cat_low)},
 {', '.join(f'coalesce(h_{c}.encoded, overall) AS cat_high__{c}' for c in SPEC.cat_high)}
 FROM feats f CROSS JOIN one
 {' '.join(f"LEFT JOIN kept k_{c} ON k_{c}.feature = '{c}' AND k_{c}.level = {_TEXT.format(c='f.' + c)}" for c in SPEC.cat_low)}
 {' '.join(f"LEFT JOIN codes h_{c} ON h_{c}.feature = '{c}' AND h_{c}.level = {_TEXT.format(c='f.' + c)}" for c in SPEC.cat_high)})"""
_TERMS = (
    [f"{w!r}::DOUBLE * num__{c}" for c, w in NUMBERS.items()]
    + [f"{w!r}::DOUBLE * bin__{c}" for c, w in FLAGS.items()]
    + [f"CASE WHEN low_{c} IS NULL THEN 0.0::DOUBLE WHEN rare_{c} THEN {SHARED}::DOUBLE ELSE {LETTER}::DOUBLE * length(low_{c}) END" for c in SPEC.cat_low]
    + [f"{MEANS}::DOUBLE * cat_high__{c}" for c in SPEC.cat_high]
)
RAW = f"{ENCODED}, raws AS (SELECT *, 1 / (1 + exp(-({START}::DOUBLE + {' + '.join(_TERMS)}))) AS raw FROM vec)"
FINAL = f"{RAW}, fin AS (SELECT *, 1 / (1 + exp(-({SLOPE}::DOUBLE * raw + {SHIFT}::DOUBLE))) AS p FROM raws)"
_BANDS = "CASE WHEN p < 0.05 THEN 'low' WHEN p < 0.15 THEN 'moderate' WHEN p < 0.35 THEN 'high' ELSE 'very_high' END AS risk_band"
# the fixed ranges of a request refuse these rows
_ALLOWED = " AND ".join(f"NOT coalesce({c} < {lo}" + (f" OR {c} > {hi}" if hi is not None else "") + ", false)" for c, (lo, hi) in O.RANGES.items())
SCORED = f"""WITH {FINAL} SELECT claim_id, {rnd('p', 'p')}, {THRESHOLD}::DOUBLE AS threshold, CASE WHEN p >= {THRESHOLD}::DOUBLE THEN 'flag' ELSE 'skip' END AS decision, {_BANDS}
 FROM fin WHERE split = 'test' AND claim_id IN (SELECT claim_id FROM feats WHERE {_ALLOWED})"""


def coefficients(names) -> list[float]:
    """One number a slot: by place for numbers and flags, by the length of its level for a one-hot slot."""
    out = []
    for name in names:
        role, rest = name.split("__", 1)
        if role == "num":
            out.append(NUMBERS[rest])
        elif role == "bin":
            out.append(FLAGS[rest])
        elif role == "cat_high":
            out.append(MEANS)
        else:
            level = next(rest[len(c) + 1 :] for c in sorted(SPEC.cat_low, key=len, reverse=True) if rest.startswith(f"{c}_"))
            out.append(SHARED if level == RARE else LETTER * len(level))
    return out


def _encoder(spark, sf):
    return _once(spark, sf, "encoder", lambda: fit_encoder(_train(spark, sf), SPEC))


def _scorer(spark, sf) -> O.Scorer:
    encoder = _encoder(spark, sf)
    model = LinearModel(coefficients(encoder.feature_names()), START)
    stages = PipelineModel(stages=[])  # the compiled form needs none
    trained = TrainedModel("given", encoder, VectorModel(stages, model))
    return O.Scorer(trained, Calibrator("platt", LinearModel([SLOPE], SHIFT)), THRESHOLD)


def _compiled(spark, sf):
    return _once(spark, sf, "given-compiled", lambda: compile_scorer(_scorer(spark, sf)))


def _part(spark, sf, split):
    return _all(spark, sf).where(F.col("split") == split)


@query("o1_compiled_scores", SCORED)
def compiled_scores(spark, sf):
    """Scores of the test split by a scorer that is one expression."""
    return _compiled(spark, sf).score(_part(spark, sf, "test"))


@query("o3_compiled_stream", SCORED)
def compiled_stream(spark, sf):
    """The test split as a stream of files through the same expression."""
    source, out = shared_path(spark, "requests-in"), shared_path(spark, "requests-out")
    _part(spark, sf, "test").write.parquet(source)
    requests = scoring.read_requests(spark, source, _all(spark, sf).schema, files_per_trigger=4)
    for running in scoring.score_compiled(requests, _compiled(spark, sf), out, shared_path(spark, "requests-log")):
        running.awaitTermination()
    return spark.read.parquet(f"{out}/scored")


# ---------------------------------------------------------------- trees with given cuts over the encoded slots
def _given_trees(spark, names) -> TreeEnsemble:
    """Three trees: a stump on the age, one of depth two on the stay and a flag, and a single leaf."""
    at = {n: i for i, n in enumerate(names)}
    age, stay, flag = at["num__age_at_admit"], at["num__los_days"], at["bin__has_prior_admit"]
    trees = [
        {"feature": [age, -1, -1], "cut": [0.25, 0, 0], "low": [1, -1, -1], "high": [2, -1, -1], "value": [0, -0.5, 0.75]},
        {"feature": [stay, -1, flag, -1, -1], "cut": [-0.125, 0, 0.5, 0, 0], "low": [1, -1, 3, -1, -1], "high": [2, -1, 4, -1, -1], "value": [0, -1.0, 0, 0.25, 1.5]},
        {"feature": [-1], "cut": [0], "low": [-1], "high": [-1], "value": [-0.25]},
    ]
    cells = [(i, *[bytearray(np.array(t.get(n, [1.0] * len(t["cut"])), k).tobytes()) for n, k in KINDS.items()]) for i, t in enumerate(trees)]
    return TreeEnsemble(spark.createDataFrame(cells, PACKED), 0.5, -1.0, True)


@query(
    "o1_compiled_trees",
    f"""WITH {ENCODED}, m AS (SELECT claim_id, -1.0::DOUBLE + 0.5::DOUBLE * (CASE WHEN num__age_at_admit <= 0.25 THEN -0.5 ELSE 0.75 END
  + CASE WHEN num__los_days <= -0.125 THEN -1.0 WHEN bin__has_prior_admit <= 0.5 THEN 0.25 ELSE 1.5 END - 0.25)::DOUBLE AS margin FROM vec WHERE split = 'val')
 SELECT claim_id, {rnd('1 / (1 + exp(-margin))', 'p')} FROM m""",
)
def compiled_trees(spark, sf):
    encoder = _encoder(spark, sf)
    trained = TrainedModel("trees", encoder, VectorModel(PipelineModel(stages=[]), _given_trees(spark, encoder.feature_names())))
    ready = compile_scorer(O.Scorer(trained, Calibrator("uncalibrated"), THRESHOLD))
    return ready.probabilities(_part(spark, sf, "val")).select("claim_id", "p")


# ---------------------------------------------------------------- encoding: the registered queries of training.py, said in SQL
_N = "(SELECT count(*) FROM val)"
_SLOTS = (
    [f"SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} <> 0) AS n_nonzero, avg({c}) AS mean FROM val" for c in (*[f"num__{c}" for c in SPEC.numeric], *[f"bin__{c}" for c in SPEC.binary], *[f"cat_high__{c}" for c in SPEC.cat_high])]
    + [f"SELECT 'cat_low__{c}_' || k.level, count(v.claim_id), count(v.claim_id)::DOUBLE / {_N} FROM kept k LEFT JOIN val v ON v.low_{c} = k.level WHERE k.feature = '{c}' AND NOT k.rare GROUP BY k.level" for c in SPEC.cat_low]
    + [f"SELECT 'cat_low__{c}_{RARE}', (SELECT count(*) FROM val WHERE rare_{c}), (SELECT count(*) FROM val WHERE rare_{c})::DOUBLE / {_N} WHERE EXISTS (SELECT 1 FROM kept WHERE feature = '{c}' AND rare)" for c in SPEC.cat_low]
)
ORACLE["k7_feature_vector"] = f"WITH {ENCODED}, val AS (SELECT * FROM vec WHERE split = 'val'), slots AS ({' UNION ALL '.join(_SLOTS)}) SELECT feature, n_nonzero, {rnd('mean', 'mean')} FROM slots"

_RANKED = V.ranked_sql("train").replace("strata", "tr_strata").replace("ranked AS", "tr_ranked AS")
ORACLE["k8_train_only_fit"] = f"WITH {TRAIN}, {_RANKED}, folded AS (SELECT t.*, (r.r - 1) % 3 AS fold FROM train t JOIN tr_ranked r ON r.entity = t.beneficiary_id) " + " UNION ALL ".join(
    f"SELECT *, {i}::BIGINT AS held_out FROM ({_STATS.replace('FROM train', f'FROM folded WHERE fold <> {i}')})" for i in range(3)
)


# ---------------------------------------------------------------- what a report needs, on the given model's scores
def _val_scores(spark, sf):
    """Validation rows with the raw and the calibrated probability, the half, and the audit's attributes."""

    def build():
        rows = P.assign_halves(_part(spark, sf, "val"), "beneficiary_id", "claim_id")
        ready = _compiled(spark, sf)
        typed = rows.select("claim_id", "half")
        scored = ready.probabilities(rows).select("claim_id", "beneficiary_id", "y", "sex", "race", "age_bin", "p")
        return store(scored.join(typed, "claim_id"), "given-scores")

    return _once(spark, sf, "given-scores", build)


_HALF = V.ranked_sql("val").replace("strata", "val_strata").replace("ranked AS", "val_ranked AS")
VAL = f"{FINAL}, val AS (SELECT * FROM fin WHERE split = 'val'), {_HALF}, half AS (SELECT v.*, CASE WHEN r.r <= r.sz // 2 THEN 'calib' ELSE 'test' END AS half FROM val v JOIN val_ranked r ON r.entity = v.beneficiary_id)"
_AUD = f"{VAL}, aud AS (SELECT claim_id, beneficiary_id, sex, race, age_bin, y, p, CAST(p >= {THRESHOLD}::DOUBLE AS INTEGER) AS yhat FROM half WHERE half = 'test')"


@query("m1_given_audit", f"WITH {_AUD}{SLICES[len(V.AUD):]} SELECT * FROM slices")
def given_audit(spark, sf):
    """Scores, calibration, decisions and slices of the test half of the validation split."""
    decided = _val_scores(spark, sf).where("half = 'test'").withColumn("yhat", (F.col("p") >= THRESHOLD).cast("int"))
    return A.slice_metrics(decided, roles=AUDIT_ROLES)


@query(
    "j4_given_reliability",
    f"""WITH {VAL}, both_ AS (SELECT 'after' AS stage, p, y FROM half WHERE half = 'test' UNION ALL SELECT 'before', raw, y FROM half WHERE half = 'test'),
 e AS (SELECT stage, {_edges(15, 'stage')} AS edges FROM both_ GROUP BY stage),
 b AS (SELECT s.stage, p, y, len(list_filter(edges, lambda x: x <= round(p, 9)))::BIGINT AS bin FROM both_ s JOIN e ON e.stage = s.stage)
 SELECT stage, bin, {rnd('avg(p)', 'mean_pred', 6)}, {rnd('avg(y)', 'frac_pos', 6)}, count(*) AS n FROM b GROUP BY stage, bin""",
    digits=6,
)
def given_reliability(spark, sf):
    """Reliability of the same rows before and after the calibration curve."""
    after = _val_scores(spark, sf).where("half = 'test'").select("claim_id", "y", "p")
    # the curve is strictly rising, so the raw score follows from the calibrated one
    raw = (F.log(F.col("p") / (1 - F.col("p"))) - SHIFT) / SLOPE
    both = after.withColumn("stage", F.lit("after")).unionByName(after.withColumn("p", raw).withColumn("stage", F.lit("before")))
    return M.quantile_reliability(both, ScoreRoles("claim_id", "y", "p"), ["stage"])


_FOLDED = f"{VAL}, folded AS (SELECT v.claim_id, v.y, v.p, (r.r - 1) % 3 AS fold FROM val v JOIN val_ranked r ON r.entity = v.beneficiary_id), {panel_sql('folded', 'fold', 'claim_id')}"


@query("d24_given_fold_mean", f"WITH {_FOLDED} SELECT {rnd('avg(pr_auc)', 'mean_pr_auc')}, {rnd('avg(roc_auc)', 'mean_roc_auc')} FROM panel")
def given_fold_mean(spark, sf):
    """Mean over three grouped folds of the given model's ranking metrics."""
    rows = _val_scores(spark, sf).select("claim_id", "beneficiary_id", "y", "p")
    folded = P.assign_folds(rows, "beneficiary_id", "claim_id")
    by_fold = M.ranking_scores(folded, ScoreRoles("claim_id", "y", "p"), ["fold"])
    return by_fold.agg(F.avg("pr_auc").alias("mean_pr_auc"), F.avg("roc_auc").alias("mean_roc_auc"))


# ---------------------------------------------------------------- explanations of the given linear model over line items
_BASE = -0.5


@query(
    "d21_given_trend",
    f"""WITH {PHI}, e AS (SELECT feature, list_sort(list_distinct(list_transform(quantile_cont(value, [{', '.join(f'{i / 20!r}' for i in range(21))}]), lambda x: round(x, 12)))) AS edges FROM phi GROUP BY feature),
 bins AS (SELECT feature, edges[i] AS low, edges[i + 1] AS high FROM e, range(1, 21) r(i) WHERE i < len(edges)),
 binned AS (SELECT b.feature, low, high, avg(phi) AS mean_phi, count(*) AS n FROM bins b JOIN phi p ON p.feature = b.feature AND round(value, 12) BETWEEN low AND high GROUP BY ALL HAVING count(*) >= 20)
 SELECT feature, {rnd('low', 'low')}, {rnd('high', 'high')}, {rnd('(low + high) / 2', 'mid')}, {rnd('mean_phi', 'mean_phi')}, n FROM binned""",
)
def given_trend(spark, sf):
    return X.dependence_trend(_phi(spark, sf))


@query(
    "p6_given_rows",
    f"""WITH {PHI}, s AS (SELECT k, 1 / (1 + exp(-(sum(phi) + {_BASE}::DOUBLE))) AS p FROM phi GROUP BY k),
 o AS (SELECT k, p, row_number() OVER (ORDER BY round(p, 10) DESC, k) AS h, row_number() OVER (ORDER BY round(p, 10), k) AS l FROM s),
 rows_ AS (SELECT k, p, 'high' AS risk_bucket FROM o WHERE h = 10 UNION ALL SELECT k, p, 'low' FROM o WHERE l = 10)
 SELECT r.k, risk_bucket, {rnd('p', 'p')}, feature, {rnd('phi', 'phi')}, row_number() OVER (PARTITION BY r.k ORDER BY abs(phi) DESC, feature) AS rank FROM rows_ r JOIN phi f ON f.k = r.k QUALIFY rank <= 8""",
)
def given_rows(spark, sf):
    """Contributions and implied probability of the rows with the tenth highest and lowest score."""
    phi = _phi(spark, sf)
    # equal rows may differ in the last bits of their sums
    implied = X.implied_probability(phi, _BASE, "k").withColumn("p", F.round("p", 10))
    rows = X.nth_extremes(implied, "p", "k", 10)
    return X.top_contributions(phi.join(rows.drop("rank"), "k"), "k").select("k", "risk_bucket", "p", "feature", "phi", "rank")
