"""Mixing sources to target weights [native]: hash order, distributed prefix sums, and a cut at each source's budget."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from episodica.sources.shared import store

WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS = 60


def targets(sources: DataFrame, weights: tuple[int, ...], total: float, most: float) -> DataFrame:
    """``target`` per source, from one row per ``source`` with its ``source_size``.

    Sources by code point, null last, get the weights in turn and share ``total`` times all sizes by weight; none
    gets more than ``most`` times its size.  In order of size per weight the filled sources come first: with the
    first k of them filled, the others get ``level`` words a weight, and k is the first that nobody exceeds.
    The windows see one row per source, not per document.
    """
    by_name, by_fill = W.orderBy(F.col("source").asc_nulls_last()), W.orderBy("_fill", F.col("source").asc_nulls_last())
    before, onward = by_fill.rowsBetween(W.unboundedPreceding, -1), by_fill.rowsBetween(0, W.unboundedFollowing)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    turn = F.array(*[F.lit(float(w)) for w in weights])
    return (
        sources.withColumn("_weight", turn[(F.row_number().over(by_name) - 1) % len(weights)])
        .withColumn("_cap", F.lit(float(most)) * F.col("source_size"))
        .withColumn("_fill", F.col("_cap") / F.col("_weight"))
        .withColumn("_left", F.lit(float(total)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        .withColumn("_level", F.col("_left") / F.sum("_weight").over(onward))
        .withColumn("_level", F.min(F.when(F.col("_fill") >= F.col("_level"), F.struct("_fill", "_level"))).over(everything)["_level"])
        .withColumn("target", F.least(F.col("_cap"), F.coalesce(F.col("_level") * F.col("_weight"), F.col("_cap"))))
        .select("source", "source_size", "target")
    )


def mix_sources(
    docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
    weights: tuple[int, ...] = (3, 1, 2), total: float = 1.5, most: float = 2.0,
) -> DataFrame:
    """Per row: key, ``size`` (words), source, ``source_size``, ``target`` of its source, ``taken`` (words the mix takes).

    Each source's rows are ordered by a hash of the key.  A source gives whole epochs as long as its budget (the
    target, rounded) allows; of the next one it gives the rows in hash order up to the budget, the last of them in
    part.  So the words taken are the budget exactly, and no row gives more than ``most`` times its size.

    The range of the hash is cut into about sqrt(rows) cells.  Sums per source and cell are a partial aggregate; the
    prefix sums over them find the one cell of each source in which the budget ends, and only that cell's rows
    are put in order.  No task sees a source as a whole, and reruns agree.

    Null texts have size 0.  A null source is a source, the last one; null keys hash like an empty key.  Repeated
    rows are rows of their own.  An empty table gives no rows; sources without words have target 0.
    """
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    sized = store(
        docs.select(
            F.col(key).alias("key"), F.col(source).alias("source"), F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.conv(F.substring(F.md5(name.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long").alias("hash"),
        ), "sized",
    )
    bits = max(math.ceil(math.log2(sized.count() + 1) / 2), 1)
    sized = sized.withColumn("cell", F.shiftright("hash", HASH_BITS - bits))
    cells = store(sized.groupBy("source", "cell").agg(F.sum("size").alias("cell_size")), "cells")
    budgets = targets(cells.groupBy("source").agg(F.sum("cell_size").alias("source_size")), weights, total, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    budgets = (
        budgets.withColumn("budget", F.round("target").cast("long")).withColumn("epochs", whole)
        .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))
    )
    running = W.partitionBy("source").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    ahead = cells.withColumn("before", F.coalesce(F.sum("cell_size").over(running), F.lit(0)))
    # the cell in which the budget ends: the last one that starts before the rest is used up
    budgets, ahead = store(budgets, "budgets"), ahead.withColumnRenamed("source", "_source")
    ends = (
        budgets.join(ahead, F.col("source").eqNullSafe(F.col("_source")) & (F.col("before") < F.col("rest")))
        .groupBy("source", "source_size", "target", "epochs", "rest").agg(F.max(F.struct("cell", "before")).alias("end"))
    )
    none = budgets.where("rest <= 0").select("source", "source_size", "target", "epochs", "rest", F.struct(F.lit(-1).cast("long").alias("cell"), F.lit(0).cast("long").alias("before")).alias("end"))
    plan = store(ends.unionByName(none).withColumnRenamed("source", "_source"), "plan")
    dealt = sized.join(plan, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    in_order = W.partitionBy("source").orderBy("hash", "key", "size").rowsBetween(W.unboundedPreceding, -1)
    left = F.col("rest") - F.col("end.before") - F.coalesce(F.sum("size").over(in_order), F.lit(0))
    last = dealt.where(F.col("cell") == F.col("end.cell")).withColumn("extra", F.greatest(F.lit(0), F.least(F.col("size"), left)))
    rest = dealt.where(F.col("cell") != F.col("end.cell")).withColumn("extra", F.when(F.col("cell") < F.col("end.cell"), F.col("size")).otherwise(F.lit(0)))
    return last.unionByName(rest).select(
        F.col("key").alias(key), "size", F.col("source").alias(source), "source_size", "target",
        (F.col("epochs") * F.col("size") + F.col("extra")).cast("long").alias("taken"),
    )


# the same by plain windows over all documents of a source
ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(COALESCE(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS hash
  FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight, 2.0::DOUBLE * source_size AS cap
  FROM sources),
levels AS (
  SELECT *, cap / weight AS fill,
         (1.5::DOUBLE * sum(source_size) OVER () - COALESCE(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl
  FROM weighted),
chosen AS (SELECT arg_min(lvl, fill) AS lvl FROM levels WHERE fill >= lvl),
aimed AS (
  SELECT source, source_size, LEAST(cap, COALESCE((SELECT lvl FROM chosen) * weight, cap)) AS target FROM weighted),
budgets AS (
  SELECT *, CAST(round(target) AS BIGINT) AS budget,
         CASE WHEN source_size > 0 THEN CAST(floor(round(target) / source_size) AS BIGINT) ELSE 0 END AS epochs
  FROM aimed),
placed AS (
  SELECT s.*, b.source_size, b.target, b.epochs, b.budget - b.epochs * b.source_size AS rest,
         COALESCE(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.hash, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source, source_size, target, CAST(epochs * size + GREATEST(0, LEAST(size, rest - before)) AS BIGINT) AS taken
FROM placed
"""
