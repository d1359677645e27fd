"""Cost sweep, confusion counts and the feature-encoding statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from episodica.operators import decide as D
from episodica.operators import encode as E
from episodica.plans import views as V
from episodica.plans.catalog.evaluation import ROLES
from episodica.plans.catalog.registry import query, rnd
from episodica.plans.catalog.splits import split_rows
from episodica.roles import FeatureSpec

SPEC = FeatureSpec()


@query(
    "d17_confusion",
    f"""WITH {V.SCORED}, c AS (SELECT count(*) FILTER (WHERE p < 0.3 AND y = 0) AS tn, count(*) FILTER (WHERE p >= 0.3 AND y = 0) AS fp,
  count(*) FILTER (WHERE p < 0.3 AND y = 1) AS fn, count(*) FILTER (WHERE p >= 0.3 AND y = 1) AS tp FROM sc)
 SELECT *, {rnd('tp::DOUBLE / (tp + fn)', 'recall')}, {rnd('tp::DOUBLE / (tp + fp)', '"precision"')}, {rnd('(tp + fp)::DOUBLE / (tp + fp + tn + fn)', 'flagged_share')} FROM c""",
)
def confusion(spark, sf):
    return D.confusion(V.scored(spark, sf), 0.3, ROLES)


@query(
    "d18_cost_parts",
    f"""WITH {V.SCORED}, c AS (SELECT count(*) FILTER (WHERE p >= 0.3 AND y = 0) AS fp, count(*) FILTER (WHERE p < 0.3 AND y = 1) AS fn, count(*) FILTER (WHERE p >= 0.3 AND y = 1) AS tp FROM sc)
 SELECT fp, fn, tp, 15000.0::DOUBLE * fn AS cost_missed, 500.0::DOUBLE * fp AS cost_needless, 500.0::DOUBLE * tp AS cost_useful FROM c""",
)
def cost_parts(spark, sf):
    return D.cost_parts(D.confusion(V.scored(spark, sf), 0.3, ROLES)).select("fp", "fn", "tp", "cost_missed", "cost_needless", "cost_useful")


# informative scores, so that the cheapest threshold lies inside the grid
_MIX = f"{V.LAB}, sm AS (SELECT claim, y, model, CASE WHEN y = 1 THEN 0.02::DOUBLE + 0.9::DOUBLE * p ELSE 0.4::DOUBLE * p END AS p FROM ({' UNION ALL '.join(f'''SELECT claim, y, '{m}' AS model, {V.score_sql(m)} AS p FROM lab''' for m in V.SCORE_SQL)}))"
SWEEP = f"""{_MIX}, grid AS (SELECT i, i * 0.002::DOUBLE AS t FROM range(501) g(i)),
cells AS (SELECT model, p, count(*) AS n, sum(y)::BIGINT AS pos FROM sm GROUP BY model, p),
swept AS (SELECT model, i AS grid_idx, t AS threshold,
   sum(CASE WHEN p < t THEN n - pos ELSE 0 END)::BIGINT AS tn, sum(CASE WHEN p >= t THEN n - pos ELSE 0 END)::BIGINT AS fp,
   sum(CASE WHEN p < t THEN pos ELSE 0 END)::BIGINT AS fn, sum(CASE WHEN p >= t THEN pos ELSE 0 END)::BIGINT AS tp
   FROM cells, grid GROUP BY model, i, t),
costed AS (SELECT *, 15000.0::DOUBLE * fn + 500.0::DOUBLE * (tp + fp) AS cost FROM swept),
best AS (SELECT * FROM costed QUALIFY row_number() OVER (PARTITION BY model ORDER BY cost, grid_idx) = 1)"""


def _mixed(spark, sf):
    p = F.when(F.col("y") == 1, F.lit(0.02) + F.lit(0.9) * F.col("p")).otherwise(F.lit(0.4) * F.col("p"))
    return V.scores(spark, sf).withColumn("p", p)


@query("j1_cost_sweep", f"WITH {SWEEP} SELECT * REPLACE (round(threshold, 8) AS threshold) FROM costed")
def cost_sweep(spark, sf):
    return D.cost_sweep(_mixed(spark, sf), ROLES, ["model"])


@query("j1_cost_threshold", f"WITH {SWEEP} SELECT * REPLACE (round(threshold, 8) AS threshold) FROM best")
def cost_threshold(spark, sf):
    return D.pick_threshold(D.cost_sweep(_mixed(spark, sf), ROLES, ["model"]), ["model"])


@query(
    "j3_cost_baselines",
    f"""WITH {SWEEP} SELECT model, cost, 500.0::DOUBLE * (tn + fp + fn + tp) AS always_cost, 15000.0::DOUBLE * (fn + tp) AS never_cost, {rnd('cost / (tn + fp + fn + tp)', 'cost_per_row')},
  500.0::DOUBLE * (tn + fp + fn + tp) - cost AS saved_vs_always, 15000.0::DOUBLE * (fn + tp) - cost AS saved_vs_never FROM best""",
)
def cost_baselines(spark, sf):
    picked = D.pick_threshold(D.cost_sweep(_mixed(spark, sf), ROLES, ["model"]), ["model"])
    return D.with_baselines(picked).select("model", "cost", "always_cost", "never_cost", "cost_per_row", "saved_vs_always", "saved_vs_never")


# ---------------------------------------------------------------- encoding statistics, fitted on the train split
TRAIN = f"{V.SPLIT}, train AS (SELECT * FROM feats WHERE split = 'train')"


def _train(spark, sf):
    return V.staged(spark, sf, "features", split_rows).where("split = 'train'")


def _all(spark, sf):
    return V.staged(spark, sf, "features", split_rows)


@query(
    "k1_median_impute",
    f"WITH {V.COH}, m AS (SELECT median(days_since_last_discharge) AS m FROM coh) SELECT claim_id, coalesce(days_since_last_discharge::DOUBLE, m) AS gap FROM coh, m",
)
def median_impute(spark, sf):
    rows = V.cohort(spark, sf)
    median = E.numeric_stats(rows, ["days_since_last_discharge"]).select("median").scalar()
    return rows.select("claim_id", F.coalesce(F.col("days_since_last_discharge").cast("double"), median).alias("gap"))


_STATS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, median({c})::DOUBLE AS median, {rnd(f'avg({c})', 'mean')}, {rnd(f'CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1 END', 'std')} FROM train" for c in SPEC.numeric
)


@query("k2_standardise", f"WITH {TRAIN} {_STATS}")
def standardise(spark, sf):
    return E.numeric_stats(_train(spark, sf), SPEC.numeric)


@query(
    "k3_flag_modes",
    f"WITH {TRAIN} " + " UNION ALL ".join(f"SELECT '{c}' AS feature, (SELECT v FROM (SELECT CAST({c} AS BIGINT) AS v, count(*) AS n FROM train WHERE {c} IS NOT NULL GROUP BY 1) ORDER BY n DESC, v LIMIT 1) AS mode" for c in SPEC.binary),
)
def flag_modes(spark, sf):
    return E.flag_modes(_train(spark, sf), SPEC.binary)


_TEXT = "coalesce(CAST({c} AS VARCHAR), 'UNKNOWN')"


@query("k4_filled_text", f"WITH {V.COH} SELECT claim_id, {', '.join(_TEXT.format(c=c) + ' AS ' + c for c in ('state_code', 'admit_dx_code'))} FROM coh")
def filled_text(spark, sf):
    return V.cohort(spark, sf).select("claim_id", *[E.filled_text(c).alias(c) for c in ("state_code", "admit_dx_code")])


@query(
    "k5_level_counts",
    f"WITH {TRAIN} " + " UNION ALL ".join(f"SELECT '{c}' AS feature, {_TEXT.format(c=c)} AS level, count(*) AS n, count(*) < 20 AS rare FROM train GROUP BY 2" for c in SPEC.cat_low),
)
def one_hot_levels(spark, sf):
    return E.level_counts(_train(spark, sf), SPEC.cat_low)


def _smooth(n: str, s: str, tn: str, ts: str) -> str:
    mean, overall = f"({s} / nullif({n}, 0))", f"({ts} / {tn})"
    prior = f"({overall} * (1 - {overall}))"
    weight = f"({n} * {prior} / nullif({n} * {prior} + {mean} * (1 - {mean}), 0))"
    return f"CASE WHEN {n} > 0 AND {prior} > 0 THEN {weight} * {mean} + (1 - {weight}) * {overall} ELSE {overall} END"


_LEVELS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {_TEXT.format(c=c)} AS level, y::DOUBLE AS y, (('0x' || substr(md5(claim_id || '|42'), 1, 8))::BIGINT % 5) AS fold, claim_id FROM train" for c in SPEC.cat_high
)
_TARGET = f"{TRAIN}, lv AS ({_LEVELS})"


@query(
    "k6_target_encoding",
    f"""WITH {_TARGET}, g AS (SELECT feature, level, count(*) AS n, sum(y) AS s FROM lv GROUP BY feature, level),
 t AS (SELECT *, sum(n) OVER (PARTITION BY feature)::DOUBLE AS tn, sum(s) OVER (PARTITION BY feature) AS ts FROM g)
 SELECT feature, level, n, {rnd(_smooth('n::DOUBLE', 's', 'tn', 'ts'), 'encoded')}, {rnd('ts / tn', 'overall')} FROM t""",
)
def target_encoding(spark, sf):
    return E.target_table(_train(spark, sf), SPEC.cat_high, "y")


@query(
    "k6_target_cross_fit",
    f"""WITH {_TARGET}, tot AS (SELECT feature, count(*)::DOUBLE AS n, sum(y) AS s FROM lv GROUP BY feature),
 byfold AS (SELECT feature, fold, count(*)::DOUBLE AS n, sum(y) AS s FROM lv GROUP BY feature, fold),
 bylevel AS (SELECT feature, level, count(*)::DOUBLE AS n, sum(y) AS s FROM lv GROUP BY feature, level),
 cell AS (SELECT feature, level, fold, count(*)::DOUBLE AS n, sum(y) AS s FROM lv GROUP BY feature, level, fold),
 o AS (SELECT c.feature, c.level, c.fold, l.n - c.n AS n, l.s - c.s AS s, t.n - f.n AS tn, t.s - f.s AS ts FROM cell c
   JOIN bylevel l ON l.feature = c.feature AND l.level = c.level JOIN byfold f ON f.feature = c.feature AND f.fold = c.fold JOIN tot t ON t.feature = c.feature),
 e AS (SELECT feature, level, fold, {_smooth('n', 's', 'tn', 'ts')} AS encoded FROM o)
 SELECT lv.claim_id, {rnd("max(CASE WHEN lv.feature = 'admit_dx_code' THEN encoded END)", 'cat_high__admit_dx_code')}, {rnd("max(CASE WHEN lv.feature = 'drg_code' THEN encoded END)", 'cat_high__drg_code')}
 FROM lv JOIN e ON e.feature = lv.feature AND e.level = lv.level AND e.fold = lv.fold GROUP BY lv.claim_id""",
)
def target_cross_fit(spark, sf):
    """What the training rows see: target means of the other folds only."""
    train = _train(spark, sf).withColumn("_tfold", E.target_fold("claim_id"))
    table = E.cross_target_table(train, SPEC.cat_high, "y", "_tfold")
    encoded = E.apply_target(train, table, SPEC.cat_high, {c: 0.0 for c in SPEC.cat_high}, "claim_id", "_tfold")
    return encoded.select("claim_id", *[f"cat_high__{c}" for c in SPEC.cat_high])
