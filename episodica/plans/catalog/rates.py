"""Rate tables, histograms, missingness, correlations, orderings and report tables."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from episodica.functions import scalars as S
from episodica.functions.ordered import average_ranks, null_safe_join
from episodica.functions.sketch import merge_sketches, quantile_sketches, rank_error, rank_is_close, sketch_quantiles
from episodica.operators import metrics as M
from episodica.operators import rates as R
from episodica.plans import views as V
from episodica.plans.catalog.cohort import wilson_sql
from episodica.plans.catalog.registry import query, rnd
from episodica.roles import CONDITION_FLAGS
from episodica.sources.shared import store

RATE = f"k, n, {rnd('k::DOUBLE / n', 'rate')}, {wilson_sql()}"


@query("d1_ever_positive", f"WITH {V.LAB} SELECT id, max(y)::BIGINT AS ever_pos, count(*) AS n_rows FROM lab GROUP BY id")
def ever_positive(spark, sf):
    from episodica.operators.splits import entity_strata

    return entity_strata(V.labelled(spark, sf), "id", "y")


_RATE_BY = "g AS (SELECT {0}, sum(y)::BIGINT AS k, count(*) AS n FROM {1} GROUP BY {0})"


@query(
    "d5_rate_by_group",
    f"WITH {V.LAB}, {_RATE_BY.format('grp', 'lab')} SELECT grp, {RATE}, {rnd('(SELECT avg(y) FROM lab)', 'overall_rate')} FROM g",
)
def rate_by_group(spark, sf):
    return R.rate_by(V.labelled(spark, sf), "grp")


@query(
    "d6_rate_min_support",
    f"WITH {V.COH}, {_RATE_BY.format('admit_dx_chapter', 'coh')} SELECT admit_dx_chapter, {RATE}, {rnd('(SELECT avg(y) FROM coh)', 'overall_rate')} FROM g WHERE n >= 300",
)
def rate_min_support(spark, sf):
    return R.rate_by(V.cohort(spark, sf), "admit_dx_chapter", min_rows=300)


@query(
    "d7_rate_by_flag",
    f"WITH {V.COH}, g AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS flag, coalesce(sum(y), 0)::BIGINT AS k, count(*) AS n FROM coh WHERE {c}" for c in CONDITION_FLAGS)
    + f") SELECT flag, {RATE} FROM g WHERE n >= 1000",
)
def rate_by_flag(spark, sf):
    return R.rate_by_flag(V.cohort(spark, sf), CONDITION_FLAGS, min_rows=1000)


@query(
    "d8_label_balance",
    f"WITH {V.LAB} SELECT c::BIGINT AS y, count(l.y) AS n, {rnd('count(l.y)::DOUBLE / (SELECT count(*) FROM lab)', 'share')} FROM range(2) t(c) LEFT JOIN lab l ON l.y = c GROUP BY c",
)
def label_balance(spark, sf):
    return R.label_balance(V.labelled(spark, sf))


@query(
    "d9_monthly_rate",
    f"WITH {V.LAB} SELECT CAST(date_trunc('month', a) AS DATE) AS month, count(*) AS n, {rnd('avg(y)', 'rate')} FROM lab WHERE date_trunc('month', a) BETWEEN DATE '1996-01-01' AND DATE '1998-12-01' GROUP BY 1",
)
def monthly_rate(spark, sf):
    return R.monthly_rate(V.labelled(spark, sf), "a", "y", "1996-01-01", "1998-12-01")


_MISSABLE = ("CLM_FROM_DT", "CLM_THRU_DT", "CLM_ADMSN_DT", "NCH_BENE_DSCHRG_DT", "ADMTNG_ICD9_DGNS_CD", *[f"ICD9_DGNS_CD_{i}" for i in range(1, 11)], *[f"ICD9_PRCDR_CD_{i}" for i in range(1, 7)])


@query(
    "d10_missing_share",
    f'WITH {V.RAW}, s AS ({" UNION ALL ".join(f"SELECT {chr(39)}{c}{chr(39)} AS col, avg(CAST({c} IS NULL AS INTEGER)) AS sh FROM raw" for c in _MISSABLE)}) '
    f'SELECT col AS "column", {rnd("sh", "share")} FROM s WHERE sh > 0 OR (SELECT max(sh) FROM s) = 0 ORDER BY sh DESC, col LIMIT 20',
)
def missing_share(spark, sf):
    return R.missing_share(V.raw_claims(spark, sf), _MISSABLE)


@query(
    "d11_rate_by_age",
    f"""WITH {V.COH}, g AS (SELECT CAST(floor((age_at_admit - 20) / 5) * 5 + 20 AS BIGINT) AS bin_low, sum(y)::BIGINT AS k, count(*) AS n
 FROM coh WHERE age_at_admit >= 20 AND age_at_admit < 105 GROUP BY 1) SELECT bin_low, {RATE}, bin_low + 2.5::DOUBLE AS centre FROM g""",
)
def rate_by_age(spark, sf):
    return R.rate_by_age(V.cohort(spark, sf))


def _histogram_sql(value: str, edges) -> str:
    array = "[" + ", ".join(f"{e!r}::DOUBLE" for e in edges) + "]"
    top = len(edges) - 2
    return f"""WITH {V.COH}, e AS (SELECT {array} AS edges),
 v AS (SELECT y, CAST({value} AS DOUBLE) AS v FROM coh WHERE {value} BETWEEN {edges[0]!r}::DOUBLE AND {edges[-1]!r}::DOUBLE),
 b AS (SELECT y, least(len(list_filter(edges, lambda x: x <= v)) - 1, {top})::BIGINT AS bin, edges FROM v, e),
 c AS (SELECT y, bin, count(*) AS n, any_value(edges[bin + 1]) AS lo, any_value(edges[bin + 2]) AS hi FROM b GROUP BY y, bin)
 SELECT y, bin, n, {rnd('lo', 'bin_low')}, {rnd('hi', 'bin_high')}, {rnd('n / (sum(n) OVER (PARTITION BY y) * (hi - lo))', 'density')} FROM c"""


_AGE_EDGES = R.even_edges(20.0, 105.0, 2.0)
_LOS_EDGES = R.log_edges(1.0, 60.0, 32)


@query("d12_age_density", _histogram_sql("age_at_admit", _AGE_EDGES))
def age_density(spark, sf):
    return R.density_histogram(V.cohort(spark, sf), F.col("age_at_admit"), _AGE_EDGES, "y")


@query("d12_los_density", _histogram_sql("least(greatest(los_days, 0) + 1, 60)", _LOS_EDGES))
def los_density(spark, sf):
    value = S.clamp(S.clamp("los_days", low=0) + 1, high=60)
    return R.density_histogram(V.cohort(spark, sf), value, _LOS_EDGES, "y")


@query(
    "d13_box_summary",
    f"""WITH {V.COH}, v AS (SELECT y, least(greatest(los_days, 0), 60) AS v FROM coh),
 q AS (SELECT y, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM v GROUP BY y)
 SELECT v.y, {rnd('any_value(q1)', 'q1')}, {rnd('any_value(q.median)', 'median')}, {rnd('any_value(q3)', 'q3')},
  min(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1)) AS whisker_low, max(v) FILTER (WHERE v <= q3 + 1.5 * (q3 - q1)) AS whisker_high, count(*) AS n
 FROM v JOIN q ON q.y = v.y GROUP BY v.y""",
)
def box_summary(spark, sf):
    return R.box_summary(V.cohort(spark, sf), "los_days", "y", 60)


@query(
    "d14_rate_by_prior_count",
    f"""WITH {V.COH}, g AS (SELECT least(prior_6mo_inpatient_count, 6) AS bucket, sum(y)::BIGINT AS k, count(*) AS n FROM coh GROUP BY 1)
 SELECT bucket, {RATE} FROM g WHERE n >= 50""",
)
def rate_by_prior_count(spark, sf):
    bucket = S.clamp("prior_6mo_inpatient_count", high=6)
    return R.rate_by(V.cohort(spark, sf), {"bucket": bucket}, min_rows=50, overall=False)


_RANKED = ("los_days", "age_at_admit", "num_diagnoses", "num_procedures", "prior_6mo_inpatient_count", "days_since_last_discharge_imputed", "chronic_count", "admit_month", "admit_dow", "y")
_AVG_RANK = ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE AS r_{c}" for c in _RANKED)


@query(
    "d15_spearman",
    f"WITH {V.FEAT}, r AS (SELECT {_AVG_RANK} FROM feat), one AS (SELECT "
    + ", ".join(f"corr(r_{a}, r_{b}) AS c_{i}_{j}" for i, a in enumerate(_RANKED) for j, b in enumerate(_RANKED))
    + " FROM r) "
    + " UNION ALL ".join(f"SELECT '{a}' AS column_a, '{b}' AS column_b, {rnd(f'c_{i}_{j}', 'r')} FROM one" for i, a in enumerate(_RANKED) for j, b in enumerate(_RANKED)),
)
def spearman(spark, sf):
    return R.spearman(V.features(spark, sf), _RANKED)


_MODELS = ("m1", "m2", "m3")


@query(
    "d16_score_correlations",
    f"WITH {V.LAB}, w AS (SELECT {', '.join(f'{V.score_sql(m)} AS {m}' for m in _MODELS)} FROM lab) "
    + " UNION ALL ".join(f"SELECT '{a}' AS model_a, '{b}' AS model_b, {rnd(f'corr({a}, {b})', 'r')} FROM w" for a in _MODELS for b in _MODELS),
)
def score_correlations(spark, sf):
    from episodica.operators.models import align_scores

    return M.score_correlations(align_scores(V.scores(spark, sf), _MODELS, "claim"), _MODELS)


_CAPPED = ("l_quantity", "l_extendedprice", "l_discount")


@query(
    "d22_percentile_caps",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {rnd(f'quantile_cont({c}, 0.05)', 'low', 4)}, {rnd(f'quantile_cont({c}, 0.95)', 'high', 4)} FROM lineitem" for c in _CAPPED
    ),
    digits=4,
)
def percentile_caps(spark, sf):
    return R.percentile_caps(V.table(spark, sf, "lineitem"), _CAPPED)


@query(
    "e7_average_rank",
    f"SELECT s.l_partkey, s.l_quantity AS qty, {rnd('r', 'avg_rank')} FROM (SELECT l_partkey, l_quantity, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2.0::DOUBLE AS r FROM lineitem) s",
)
def average_rank(spark, sf):
    from episodica.functions.joins import salted_join

    rows = V.table(spark, sf, "lineitem").select("l_partkey", "l_returnflag", "l_quantity")
    ranks = average_ranks(rows, "l_quantity", ["l_returnflag"])
    joined = salted_join(rows, ranks, ["l_returnflag", "l_quantity"], "left", "l_partkey")
    return joined.select("l_partkey", F.col("l_quantity").alias("qty"), "avg_rank")


@query(
    "e8_share_of_total",
    f"WITH {V.LAB} SELECT grp, count(*) AS n, {rnd('count(*)::DOUBLE / sum(count(*)) OVER ()', 'share')} FROM lab GROUP BY grp",
)
def share_of_total(spark, sf):
    counts = V.encounters(spark, sf).groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy(F.lit(0))))


@query(
    "f5_top_chapters",
    f"WITH {V.COH}, {_RATE_BY.format('admit_dx_chapter', 'coh')} SELECT admit_dx_chapter, {RATE} FROM g ORDER BY k::DOUBLE / n DESC, admit_dx_chapter LIMIT 12",
)
def top_chapters(spark, sf):
    rates = R.rate_by(V.cohort(spark, sf), "admit_dx_chapter", overall=False)
    return rates.orderBy(F.desc("rate"), "admit_dx_chapter").limit(12)


@query(
    "p5_label_encoding",
    f"WITH {V.COH}, l AS ("
    + " UNION ".join(f"SELECT '{c}' AS feature, coalesce(CAST({c} AS VARCHAR), '__missing__') AS level FROM coh" for c in ("sex", "race", "age_bin", "admit_dx_chapter", "admit_dx_code", "drg_code"))
    + ") SELECT feature, level, row_number() OVER (PARTITION BY feature ORDER BY md5(level || '|42'), level) - 1 AS code FROM l",
)
def label_encoding(spark, sf):
    from episodica.operators.explain import label_encoding

    return label_encoding(V.cohort(spark, sf), ("sex", "race", "age_bin", "admit_dx_chapter", "admit_dx_code", "drg_code"))


# ---------------------------------------------------------------- sketches per ship day, merged over the days of a year
_SKETCHED = "l_extendedprice"


@query(
    "d22_sketch_caps",
    f"SELECT l_returnflag, CAST(year(l_shipdate) AS BIGINT) AS year, count({_SKETCHED}) AS n, TRUE AS low_is_close, TRUE AS high_is_close FROM lineitem GROUP BY ALL HAVING count({_SKETCHED}) > 0",
)
def sketch_caps(spark, sf):
    """Percentile caps from sketches of single days, merged per year: their true ranks are within the error of a sketch."""
    rows = V.table(spark, sf, "lineitem").select("l_returnflag", "l_shipdate", F.year("l_shipdate").alias("year"), F.col(_SKETCHED).cast("double").alias("v"))
    daily = store(quantile_sketches(rows, "v", ["l_returnflag", "l_shipdate"]), "daily-sketches")
    yearly = merge_sketches(daily.withColumn("year", F.year("l_shipdate")), ["l_returnflag", "year"])
    group = ["l_returnflag", "year"]
    caps = store(sketch_quantiles(yearly, {"low": 0.05, "high": 0.95}, group), "caps")
    # one row a group and value, so that no group meets its caps row by row
    counts = rows.groupBy(*group, "v").agg(F.count(F.lit(1)).alias("_c"))
    ranks = null_safe_join(counts, caps, group).groupBy(*group, "n").agg(
        *[F.sum(F.when(test, F.col("_c")).otherwise(0)).alias(f"{c}_{side}") for c in ("low", "high") for side, test in (("below", F.col("v") < F.col(c)), ("upto", F.col("v") <= F.col(c)))]
    )
    # three times the error at 99 % confidence
    close = [rank_is_close(F.col(f"{c}_below"), F.col(f"{c}_upto"), F.col("n"), p, 3 * rank_error()).alias(f"{c}_is_close") for c, p in (("low", 0.05), ("high", 0.95))]
    return ranks.select(*group, "n", *close)
