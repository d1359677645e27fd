"""Drift of a current against a reference population, on all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episodica.functions.ordered import global_cumsum, null_safe_join
from episodica.sources.shared import store

# Per-column threshold, dataset share threshold, smallest usable reference deviation.
COLUMN_THRESHOLD = 0.1
DATASET_SHARE = 0.5
MIN_STD = 0.001
NUMERIC_METHOD = "Wasserstein distance (normed)"
LEVEL_METHOD = "Jensen-Shannon distance"


def normalise_types(df: DataFrame) -> DataFrame:
    """Numbers and booleans to double, everything else to text."""
    numeric = (T.NumericType, T.BooleanType)

    def cast(field):
        if isinstance(field.dataType, T.BooleanType):
            return F.col(field.name).cast("int").cast("double").alias(field.name)
        return F.col(field.name).cast("double" if isinstance(field.dataType, numeric) else "string").alias(field.name)

    return df.select(*[cast(f) for f in df.schema.fields])


def _side_counts(df: DataFrame, is_current: Column, columns, value_type: str) -> DataFrame:
    """``(column, value, n_ref, n_cur)``: both sides in one pass, reduced before the shuffle and written once."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast(value_type).alias("value")) for c in columns]
    long = df.select(is_current.alias("_cur"), F.inline(F.array(*cells)))
    counts = long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count_if(~F.col("_cur")).alias("n_ref"), F.count_if(F.col("_cur")).alias("n_cur")
    )
    return store(counts, "drift-counts")


def numeric_drift(df: DataFrame, is_current: Column, columns) -> DataFrame:
    """Wasserstein distance between the two empirical distributions over the reference deviation."""
    counts = _side_counts(df, is_current, columns, "double").withColumn("gap_from", F.col("value"))
    v, n = F.col("value"), F.col("n_ref")
    facts = counts.groupBy("column").agg(
        F.sum("n_ref").alias("_nr"), F.sum("n_cur").alias("_nc"), (F.sum(v * n) / F.sum("n_ref")).alias("_mean")
    )
    cum = global_cumsum(counts, "value", ["n_ref", "n_cur"], ["column"], next_values=["gap_from"])
    joined = null_safe_join(cum, facts, ["column"])
    step = F.abs(F.col("cum_n_ref") / F.col("_nr") - F.col("cum_n_cur") / F.col("_nc")) * (F.col("next_gap_from") - v)
    square = n * (v - F.col("_mean")) * (v - F.col("_mean"))
    sums = joined.groupBy("column").agg(F.coalesce(F.sum(step), F.lit(0.0)).alias("_w"), F.sqrt(F.sum(square) / F.max("_nr")).alias("_std"))
    return sums.select(
        "column", F.lit(NUMERIC_METHOD).alias("method"), (F.col("_w") / F.greatest("_std", F.lit(MIN_STD))).alias("distance")
    )


def level_drift(df: DataFrame, is_current: Column, columns) -> DataFrame:
    """Square root of the Jensen-Shannon divergence (natural log) between the level shares."""
    counts = _side_counts(df, is_current, columns, "string")
    totals = counts.groupBy("column").agg(F.sum("n_ref").alias("_nr"), F.sum("n_cur").alias("_nc"))
    joined = null_safe_join(counts, totals, ["column"])
    p, q = F.col("n_ref") / F.col("_nr"), F.col("n_cur") / F.col("_nc")
    mid = (p + q) / 2
    part = lambda x: F.when(x > 0, x * F.log(x / mid)).otherwise(0.0)
    divergence = F.greatest(F.sum(part(p) + part(q)) / 2, F.lit(0.0))
    return joined.groupBy("column").agg(F.sqrt(divergence).alias("distance")).select(
        "column", F.lit(LEVEL_METHOD).alias("method"), "distance"
    )


def drift_report(df: DataFrame, is_current: Column, numeric, levels, threshold: float = COLUMN_THRESHOLD) -> DataFrame:
    """``(column, method, distance, threshold, drifted)`` for all columns."""
    parts = []
    if numeric:
        parts.append(numeric_drift(df, is_current, numeric))
    if levels:
        parts.append(level_drift(df, is_current, levels))
    report = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return report.withColumns({"threshold": F.lit(threshold), "drifted": F.col("distance") > threshold})


def drift_summary(report: DataFrame, share: float = DATASET_SHARE) -> DataFrame:
    """Drifted columns, their share, and whether the dataset as a whole has drifted."""
    return report.agg(
        F.count(F.lit(1)).alias("n_columns"),
        F.count_if("drifted").alias("n_drifted"),
        (F.count_if("drifted") / F.count(F.lit(1))).alias("share_drifted"),
    ).withColumn("dataset_drifted", F.col("share_drifted") >= share)


def drift_table(report: DataFrame, top: int = 15) -> DataFrame:
    """The ``top`` columns by distance, with short method names."""
    short = F.regexp_replace(F.replace("method", F.lit(" distance"), F.lit("")), r" \(normed\)", "")
    return report.withColumn("method", short).orderBy(F.desc("distance"), "column").limit(top)


METRIC_JSON = "metrics array<struct<metric_name:string, config:struct<column:string, method:string, threshold:double>, value:string>>"


def parse_drift_json(df: DataFrame, text: str = "value") -> DataFrame:
    """Flatten stored drift reports (one JSON document per row) to ``(column, method, distance, threshold, drifted)``."""
    metric = F.explode(F.from_json(text, METRIC_JSON)["metrics"])
    rows = df.select(metric.alias("m")).where(F.col("m.metric_name").startswith("ValueDrift"))
    return rows.select(
        F.col("m.config.column").alias("column"),
        F.col("m.config.method").alias("method"),
        F.col("m.value").try_cast("double").alias("distance"),
        F.coalesce("m.config.threshold", F.lit(COLUMN_THRESHOLD)).alias("threshold"),
    ).withColumn("drifted", F.col("distance") > F.col("threshold"))


def to_drift_json(report: DataFrame) -> DataFrame:
    """One JSON document ``{"metrics": [...]}`` of a drift report, which holds one row per column."""
    metric = F.struct(
        F.concat(F.lit("ValueDrift(column="), "column", F.lit(")")).alias("metric_name"),
        F.struct("column", "method", "threshold").alias("config"),
        F.col("distance").alias("value"),
    )
    return report.agg(F.to_json(F.struct(F.sort_array(F.collect_list(metric)).alias("metrics"))).alias("value"))
