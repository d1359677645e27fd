"""Rate tables, histograms, missingness and correlations: the data behind descriptive reports."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from episodica.functions import scalars as S
from episodica.functions.joins import salted_join
from episodica.functions.ordered import average_ranks, exact_quantiles, null_safe_join
from episodica.functions.sketch import approx_quantiles
from episodica.sources.shared import store

# distinct values of a column whose ranks are broadcast: a few MB
LOOKUP_VALUES = 1 << 16


def with_wilson(counts: DataFrame, hits: str = "k", total: str = "n") -> DataFrame:
    low, high = S.wilson_bounds(hits, total)
    return counts.withColumns({"rate": F.col(hits) / F.col(total), "low": low, "high": high})


def rate_by(df: DataFrame, group, label: str = "y", min_rows: int = 0, overall: bool = True) -> DataFrame:
    """Label rate per group with its Wilson interval; groups below ``min_rows`` are left out.

    ``group`` is a column name or a dict ``{name: expression}``.  ``overall_rate`` covers all rows.
    """
    keys = {group: F.col(group)} if isinstance(group, str) else group
    counts = df.groupBy(*[e.alias(k) for k, e in keys.items()]).agg(
        F.sum(F.col(label).cast("bigint")).alias("k"), F.count(label).alias("n")
    )
    if overall:
        counts = counts.withColumn("overall_rate", df.select(F.avg(label)).scalar())
    return with_wilson(counts.where(F.col("n") >= max(min_rows, 1)))


def rate_by_flag(df: DataFrame, flags, label: str = "y", min_rows: int = 0) -> DataFrame:
    """Label rate among the rows where each flag is set: ``(flag, k, n, rate, low, high)`` in one scan."""
    wide = df.agg(
        *[F.count_if(F.col(f).cast("boolean")).alias(f"n_{f}") for f in flags],
        *[F.coalesce(F.sum(F.when(F.col(f).cast("boolean"), F.col(label).cast("bigint"))), F.lit(0)).alias(f"k_{f}") for f in flags],
    )
    rows = F.inline(F.array(*[F.struct(F.lit(f).alias("flag"), F.col(f"k_{f}").alias("k"), F.col(f"n_{f}").alias("n")) for f in flags]))
    return with_wilson(wide.select(rows).where(F.col("n") >= max(min_rows, 1)))


def label_balance(df: DataFrame, label: str = "y") -> DataFrame:
    """Rows and share of both classes; a class without rows appears with 0."""
    one = df.agg(F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1"))
    rows = one.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("y"), F.col(f"n{c}").alias("n")) for c in (0, 1)])),
        (F.col("n0") + F.col("n1")).alias("_all"),
    )
    return rows.select("y", "n", F.try_divide("n", "_all").alias("share"))


def monthly_rate(df: DataFrame, date: str, label: str = "y", first=None, last=None) -> DataFrame:
    """Volume and label rate per calendar month in the closed month range."""
    month = F.trunc(date, "month")
    out = df.groupBy(month.alias("month")).agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("rate"))
    if first is not None:
        out = out.where(F.col("month").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return out


def missing_share(df: DataFrame, columns=None, top: int = 20) -> DataFrame:
    """Share of NULL per column: those above 0, or all if none is, the ``top`` highest."""
    columns = columns or df.columns
    wide = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in columns])
    long = wide.unpivot([], list(columns), "column", "share")
    any_missing = F.max("share").over(W.partitionBy(F.lit(0))) > 0  # one row per column
    shown = long.withColumn("_any", any_missing).where(~F.col("_any") | (F.col("share") > 0)).drop("_any")
    return shown.orderBy(F.desc("share"), "column").limit(top)


def rate_by_age(df: DataFrame, age: str = "age_at_admit", label: str = "y", low: int = 20, high: int = 105, width: int = 5) -> DataFrame:
    """Label rate per left-closed age bin; the last value of the range belongs to no bin."""
    inside = df.where((F.col(age) >= low) & (F.col(age) < high))
    out = rate_by(inside, {"bin_low": S.fixed_width_bin(age, low, width)}, label, overall=False)
    return out.withColumn("centre", F.col("bin_low") + width / 2)


def density_histogram(df: DataFrame, value: Column, edges: list[float], by: str) -> DataFrame:
    """Density per class and bin.  Bins are left-closed, the last one is closed on both sides."""
    n_bins = len(edges) - 1
    array = F.array(*[F.lit(float(e)) for e in edges])
    valued = df.select(by, value.cast("double").alias("_v")).where(F.col("_v").between(float(edges[0]), float(edges[-1])))
    cells = valued.groupBy(by, "_v").agg(F.count(F.lit(1)).alias("n"))
    index = F.least(F.size(F.filter(array, lambda e: e <= F.col("_v"))) - 1, F.lit(n_bins - 1))
    counts = cells.groupBy(by, index.alias("bin")).agg(F.sum("n").alias("n"))
    low, high = F.get(array, F.col("bin")), F.get(array, F.col("bin") + 1)
    total = F.sum("n").over(W.partitionBy(by))  # at most one row per bin
    return counts.withColumns({"bin_low": low, "bin_high": high}).withColumn("density", F.col("n") / (total * (high - low)))


def even_edges(low: float, high: float, step: float) -> list[float]:
    return [low + i * step for i in range(int((high - low) / step) + 1)]


def log_edges(low: float, high: float, count: int) -> list[float]:
    """``count`` edges that are evenly spaced on a log scale; the ends are exact."""
    a, b = math.log10(low), math.log10(high)
    inner = [10 ** (a + (b - a) * i / (count - 1)) for i in range(1, count - 1)]
    return [float(low), *inner, float(high)]


def box_summary(df: DataFrame, value: str, by: str, cap: int = 60) -> DataFrame:
    """Median, quartiles and whiskers (furthest values within 1.5 IQR of the box) per class.

    The values are whole numbers in [0, cap], so a class has at most cap + 1 distinct ones.
    """
    capped = S.clamp(value, 0, cap)
    counts = df.where(F.col(value).isNotNull()).groupBy(by, capped.alias("_v")).agg(F.count(F.lit(1)).alias("n"))
    quartiles = counts.groupBy(by).agg(F.percentile("_v", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n")).alias("_q"))
    quartiles = quartiles.select(by, *[F.get("_q", F.lit(i)).alias(c) for i, c in enumerate(("q1", "median", "q3"))])
    joined = null_safe_join(counts, quartiles, [by])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("_v").between(F.col("q1") - reach, F.col("q3") + reach)
    return joined.groupBy(by, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
        F.sum("n").alias("n"),
    )


def spearman(df: DataFrame, columns) -> DataFrame:
    """Rank correlation of every pair of columns (complete rows): ``(column_a, column_b, r)``.

    Ranks come from the distinct values of all columns in one pass and are looked up by value: columns with up to
    ``LOOKUP_VALUES`` distinct values by broadcast, which moves no row, others by one salted join each.
    """
    columns = list(columns)
    complete = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    cells = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns]))
    ranks = store(average_ranks(complete.select(cells), "value", ["column"]), "ranks")
    many = {r["column"] for r in ranks.groupBy("column").count().where(F.col("count") > LOOKUP_VALUES).collect()}
    ranked = complete
    for c in sorted(columns, key=lambda c: c in many):
        own = ranks.where(F.col("column") == c)
        side = own.select(F.col("value").alias(c), F.col("avg_rank").alias(f"_rk_{c}"))
        if c in many:
            other = next((o for o in ranked.columns if o != c), c)
            ranked = salted_join(ranked, side, [c], "left", other, own.select(F.col("value").alias(c), F.col("n").alias("_n"))).drop(c)
        else:
            ranked = ranked.join(F.broadcast(side), c, "left").drop(c)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    one = ranked.agg(*[F.corr(f"_rk_{a}", f"_rk_{b}").alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    rows = []
    for i, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            rows.append(F.struct(F.lit(x).alias("column_a"), F.lit(y).alias("column_b"), F.col(f"r{i}").alias("r")))
    return one.select(F.inline(F.array(*rows)))


def percentile_caps(df: DataFrame, columns, low: float = 0.05, high: float = 0.95, approx: bool = False) -> DataFrame:
    """Lower and upper percentile of each column: ``(feature, low, high)`` from the distinct values.

    With ``approx`` they come from a sketch per column, in one pass and off by a bounded rank.
    """
    stacks = F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns]))
    if approx:
        return approx_quantiles(df.select(stacks), "value", {"low": low, "high": high}, ["feature"]).drop("n")
    return exact_quantiles(df.select(stacks), "value", {"low": low, "high": high}, ["feature"])
