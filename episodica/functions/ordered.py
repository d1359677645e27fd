"""Ordered computations over a whole table without sorting it in one task.

A global prefix sum, an exact quantile or a random rank needs a total order.  A window without
``partitionBy`` would send every row to one task, and a window over a few strata would do almost
the same.  Here the rows are first reduced to one row per distinct value, the values are cut into
ranges of similar size, each range is summed on its own, and the (tiny) table of range totals
supplies the offset of each range.  Repeated values cannot overload a range: they are one row.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from episodica.sources.shared import store

BUCKET = "_range"


def null_safe_join(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Equi-join that lets NULL keys meet; the keys appear once in the output."""
    keys = list(keys)
    if not keys:
        raise ValueError("a join needs at least one key")
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def value_counts(df: DataFrame, value: str, by=(), **aggregates: Column) -> DataFrame:
    """One row per distinct (by, value) with ``n`` and further aggregates; NULL values are left out.

    The counts are written to the shared folder: what follows uses them several times (ranges, range
    totals, running sums), and the rows themselves should be read once.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"), *[e.alias(k) for k, e in aggregates.items()])
    return store(counts, "value-counts")


def range_edges(df: DataFrame, column: str, parts: int | None = None) -> list[float]:
    """Cut points that split the values into ranges of similar row count.

    They only balance the work, so approximate quantiles are enough; the results do not depend on
    them.  They come back as plain numbers, so every branch of a plan uses the same ranges.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(2, parts)
    probs = [i / parts for i in range(1, parts)]
    error = 1.0 / (4 * parts)
    # a table without values has one cut, anywhere
    return sorted(set(df.select(F.col(column).cast("double").alias("v")).approxQuantile("v", probs, error))) or [0.0]


def with_range(df: DataFrame, column: str, edges: list[float]) -> DataFrame:
    """Add the index of the range (left-closed) that holds the value."""
    splits = [float("-inf"), *edges, float("inf")]
    staged = df.withColumn("_range_in", F.col(column).cast("double"))
    bucketizer = Bucketizer(splits=splits, inputCol="_range_in", outputCol=BUCKET, handleInvalid="keep")
    return bucketizer.transform(staged).drop("_range_in")


def global_cumsum(
    df: DataFrame,
    order_by: str,
    values,
    by=(),
    descending: bool = False,
    edges: list[float] | None = None,
    next_values=(),
) -> DataFrame:
    """Running sums ``cum_<v>`` (inclusive) in the order of ``order_by`` within ``by``.

    ``(by, order_by)`` must be unique: aggregate with :func:`value_counts` first.  For each name in
    ``next_values`` a column ``next_<v>`` holds the value of the following row, NULL at the end.
    Without ``edges`` a pass over the values finds cut points: the call itself runs a Spark job.
    """
    by = list(by)
    tagged = with_range(df, order_by, edges or range_edges(df, order_by))
    cells = [*by, BUCKET]
    order = F.col(order_by).desc() if descending else F.col(order_by).asc()
    range_order = F.col(BUCKET).desc() if descending else F.col(BUCKET).asc()
    first = F.max_by if descending else F.min_by

    totals = tagged.groupBy(*cells).agg(
        *[F.sum(v).alias(f"_t_{v}") for v in values],
        *[first(v, order_by).alias(f"_f_{v}") for v in next_values],
    )
    outer = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    before = outer.orderBy(range_order).rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *cells,
        *[F.coalesce(F.sum(f"_t_{v}").over(before), F.lit(0)).alias(f"_o_{v}") for v in values],
        *[F.lead(f"_f_{v}").over(outer.orderBy(range_order)).alias(f"_n_{v}") for v in next_values],
    )
    inside = W.partitionBy(*cells).orderBy(order)
    running = inside.rowsBetween(W.unboundedPreceding, 0)
    joined = null_safe_join(tagged, offsets, cells)
    return joined.withColumns(
        {
            **{f"cum_{v}": F.col(f"_o_{v}") + F.sum(v).over(running) for v in values},
            **{f"next_{v}": F.coalesce(F.lead(v).over(inside), F.col(f"_n_{v}")) for v in next_values},
        }
    ).drop(BUCKET, *[f"_o_{v}" for v in values], *[f"_n_{v}" for v in next_values])


def exact_quantiles(df: DataFrame, column: str, probs: dict[str, float], by=(), weight: str | None = None) -> DataFrame:
    """Exact, linearly interpolated quantiles: one row per group, one column per entry of ``probs``.

    ``weight`` names a count column when ``df`` is already reduced to one row per (by, value).
    """
    by = list(by)
    if weight is None:
        counts = value_counts(df, column, by)
    else:
        counts = df.where(F.col(column).isNotNull()).select(*by, column, F.col(weight).alias("n"))
    ranked = global_cumsum(counts, column, ["n"], by)
    if by:
        ranked = null_safe_join(ranked, counts.groupBy(*by).agg(F.sum("n").alias("_total")), by)
    else:
        ranked = ranked.withColumn("_total", counts.select(F.sum("n")).scalar())
    first, last = F.col("cum_n") - F.col("n"), F.col("cum_n") - 1
    value = F.col(column).cast("double")
    aggs = []
    for name, q in probs.items():
        at = (F.col("_total") - 1) * F.lit(float(q))
        for side, pos in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            aggs.append(F.max(F.when(pos.between(first, last), value)).alias(f"_{side}_{name}"))
    picked = ranked.groupBy(*by).agg(F.max("_total").alias("_total"), *aggs)
    return picked.select(
        *by,
        *[
            (
                F.col(f"_lo_{name}")
                + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}"))
                * ((F.col("_total") - 1) * F.lit(float(q)) - F.floor((F.col("_total") - 1) * F.lit(float(q))))
            ).alias(name)
            for name, q in probs.items()
        ],
    )


def average_ranks(df: DataFrame, column: str, by=()) -> DataFrame:
    """Average rank (ties share the mean) of each distinct value, with its count: ``(by, column, n, avg_rank)``."""
    ranked = global_cumsum(value_counts(df, column, by), column, ["n"], by)
    return ranked.select(*by, column, "n", (F.col("cum_n") - F.col("n") + (F.col("n") + 1) / 2).alias("avg_rank"))


def shuffle_hash(key: str, seed) -> Column:
    """The only source of randomness: md5 of the key and the seed, the same on every engine and run."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))


def shuffle_rank(df: DataFrame, key: str, seed=42, by=(), at_most: Column | None = None, prefix: int | None = None) -> DataFrame:
    """Rank rows in seeded random order within ``by``: adds ``shuffle_rank`` (from 1) and ``group_size``.

    ``key`` must be unique within ``by``.  Rows are ranked inside (by, hash prefix) cells, which are
    equally full whatever ``by`` is, and shifted by the counts of the earlier prefixes.  The prefix has as many hex
    digits as make sixteen cells for every shuffle partition.  With
    ``at_most`` (an expression on ``group_size`` and the ``by`` columns) only the rows with a rank up
    to it are returned, and cells that lie wholly behind it are never sorted.
    """
    by = list(by)
    if prefix is None:
        cells_wanted = 16 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        prefix = max(1, math.ceil(math.log2(cells_wanted) / 4))
    hashed = df.withColumn("_hash", shuffle_hash(key, seed)).withColumn("_cell", F.substring("_hash", 1, prefix))
    cells = [*by, "_cell"]
    outer = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    counts = hashed.groupBy(*cells).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        *cells,
        F.coalesce(F.sum("_n").over(outer.orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_n").over(outer).alias("group_size"),
    )
    joined = null_safe_join(hashed, offsets, cells)
    if at_most is not None:
        joined = joined.where(F.col("_before") < at_most)
    inside = W.partitionBy(*cells).orderBy("_hash", key)
    ranked = joined.withColumn("shuffle_rank", F.col("_before") + F.row_number().over(inside))
    if at_most is not None:
        ranked = ranked.where(F.col("shuffle_rank") <= at_most)
    return ranked.drop("_hash", "_cell", "_before")
