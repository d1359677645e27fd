"""Isotonic regression as a table of pooled blocks: solved per score range, merged pairwise, applied by a range join."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from episodica.functions.joins import salted_join
from episodica.functions.ordered import range_edges, with_range
from episodica.sources.shared import store

BLOCKS = "low double, high double, n double, pos double"
# distinct scores that one task pools, and curve points that may stand in an expression
PER_RANGE = 1 << 17
IN_PLACE = 4096


def pooled(table: pd.DataFrame) -> pd.DataFrame:
    """Adjacent violators pooled: blocks (low, high, n, pos) by rising score, whose means rise strictly.

    A block that ends below its predecessor's mean swallows it, again and again; each row is swallowed once.
    """
    low, high, n, pos = (table[c].to_numpy() for c in ("low", "high", "n", "pos"))
    first, weight, hits = np.zeros(len(low), np.int64), np.zeros(len(low)), np.zeros(len(low))
    top = -1
    for i in range(len(low)):
        at, w, h = i, n[i], pos[i]
        while top >= 0 and hits[top] * w >= h * weight[top]:
            at, w, h = first[top], w + weight[top], h + hits[top]
            top -= 1
        top += 1
        first[top], weight[top], hits[top] = at, w, h
    begin = first[: top + 1]
    end = np.append(begin[1:], len(low)) - 1
    return pd.DataFrame({"low": low[begin], "high": high[end], "n": weight[: top + 1], "pos": hits[: top + 1]})


def pool_groups(blocks: DataFrame, by: list[str], part: str) -> DataFrame:
    types = {f.name: f.dataType.simpleString() for f in blocks.schema.fields}
    keys = [*by, part]

    def solve(names, table):
        out = pooled(table.sort_values("low"))
        for i, k in enumerate(keys):
            out.insert(i, k, names[i])
        return out

    schema = ", ".join([*[f"`{k}` {types[k]}" for k in keys], BLOCKS])
    return blocks.select(*keys, "low", "high", "n", "pos").groupBy(*keys).applyInPandas(solve, schema)


def isotonic_blocks(points: DataFrame, score: str = "p", by=(), per_range: int = PER_RANGE) -> DataFrame:
    """``(by, low, high, n, pos, value)``: the blocks of the isotonic fit of positives on scores, one curve per ``by``.

    ``points`` has one row per (by, score) with ``n`` and ``pos``, so a hot score is one row.  Ranges of about
    ``per_range`` scores are pooled by themselves.  Then neighbours are merged, two by two, until one range is left.
    Where two solved ranges meet, all means of the left one below the right one's smallest stay as they are, and so
    do those of the right one above the left one's largest: only the blocks between reach a task, often none.
    NULL scores and points without rows are left out; an empty table has no blocks.
    """
    by = list(by)
    known = points.where(F.col(score).isNotNull() & (F.col("n") > 0))
    known = known.select(*by, *[F.col(score).cast("double").alias(c) for c in ("low", "high")], F.col("n").cast("double").alias("n"), F.col("pos").cast("double").alias("pos"))
    known = store(known, "curve-points")
    ranges = max(1, math.ceil(known.count() / per_range))
    edges = range_edges(known, "low", ranges)[: ranges - 1] if ranges > 1 else []
    parted = with_range(known, "low", edges) if edges else known.withColumn("_range", F.lit(0.0))
    blocks = store(pool_groups(parted.withColumn("part", F.col("_range").cast("int")), by, "part"), "curve-blocks")
    parts = len(edges) + 1
    while parts > 1:
        mean = F.col("pos") / F.col("n")
        right = F.col("part") % 2 == 1
        blocks = blocks.withColumns({"pair": F.floor(F.col("part") / 2).cast("int"), "mean": mean, "right": right})
        cuts = blocks.groupBy(*by, "pair").agg(F.min(F.when(F.col("right"), F.col("mean"))).alias("least"), F.max(F.when(~F.col("right"), F.col("mean"))).alias("most"))
        # one row a pair of ranges and curve; a curve may have very many blocks in a pair
        cut = salted_join(blocks, cuts, [*by, "pair"], "left", "low", null_safe=True)
        met = F.when(F.col("right"), F.col("mean") <= F.col("most")).otherwise(F.col("mean") >= F.col("least"))
        cut = cut.withColumn("met", F.coalesce(met, F.lit(False))).withColumn("part", F.col("pair"))
        kept = cut.where("not met").select(*by, "part", "low", "high", "n", "pos")
        blocks = store(kept.unionByName(pool_groups(cut.where("met"), by, "part")), "curve-blocks")
        parts = (parts + 1) // 2
    return blocks.select(*by, "low", "high", "n", "pos", (F.col("pos") / F.col("n")).alias("value"))


def curve_points(blocks: DataFrame) -> DataFrame:
    """``(x, value)``: both ends of every block (one row, if they are equal), between which the curve is a straight line."""
    ends = F.array_distinct(F.array("low", "high"))
    return blocks.select(F.explode(ends).alias("x"), "value")


class IsotonicCurve:
    """A fitted curve: a table of points in the shared folder or a saved model."""

    def __init__(self, points: DataFrame):
        self.points = points

    def apply(self, df: DataFrame, score: str = "p", in_place: int = IN_PLACE) -> DataFrame:
        """Replace ``score`` by the curve's value: straight lines between points, the end values beyond them.

        Up to ``in_place`` points are an expression (a binary search, no shuffle).  Curves with more points meet the
        distinct scores in ranges of similar size, and those the rows by a join that spreads hot scores.
        A NULL score, or a curve without points, gives NULL.
        """
        points = self.points.limit(in_place + 1).collect()
        if len(points) <= in_place:
            return df.withColumns({"_x": F.col(score).cast("double")}).transform(lambda t: in_expression(t, sorted((r.x, r.value) for r in points), score))
        scores = df.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("_score")).agg(F.count(F.lit(1)).alias("_n"))
        scores = store(scores, "distinct-scores")
        both = scores.select(F.col("_score").cast("double").alias("x"), F.lit(None).cast("double").alias("value"), F.col("_score"), F.lit(1).alias("kind"))
        both = both.unionByName(self.points.select("x", "value", F.lit(None).cast(scores.schema["_score"].dataType).alias("_score"), F.lit(0).alias("kind")))
        both = with_range(both, "x", range_edges(self.points, "x"))
        at = F.struct("x", "value")
        ends = both.where("kind = 0").groupBy("_range").agg(F.max_by(at, "x").alias("_last"), F.min_by(at, "x").alias("_first"))
        # one row a range: the nearest points in the ranges before and after
        order = W.partitionBy(F.lit(0)).orderBy("_range")
        ends = scores_ranges(both).join(ends, "_range", "left").select(
            "_range",
            F.last("_last", True).over(order.rowsBetween(W.unboundedPreceding, -1)).alias("_before"),
            F.first("_first", True).over(order.rowsBetween(1, W.unboundedFollowing)).alias("_after"),
        )
        point = F.when(F.col("kind") == 0, at)
        inside = W.partitionBy("_range").orderBy("x", "kind")
        back = W.partitionBy("_range").orderBy(F.desc("x"), "kind")
        placed = both.withColumns({"_left": F.last(point, True).over(inside.rowsBetween(W.unboundedPreceding, 0)), "_right": F.last(point, True).over(back.rowsBetween(W.unboundedPreceding, 0))})
        placed = placed.where("kind = 1").join(ends, "_range")
        left, right = F.coalesce("_left", "_before"), F.coalesce("_right", "_after")
        looked = placed.select("_score", line(F.col("x"), left["x"], left["value"], right["x"], right["value"]).alias("_value"))
        out = salted_join(df.withColumn("_score", F.col(score)), looked, ["_score"], "left", next((c for c in df.columns if c != score), "_score"), scores)
        return out.withColumn(score, F.col("_value")).drop("_score", "_value")

    def save(self, spark: SparkSession, path: str) -> None:
        self.points.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "IsotonicCurve":
        return cls(spark.read.parquet(path))


def scores_ranges(both: DataFrame) -> DataFrame:
    return both.select("_range").distinct()


def line(x: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """The straight line through two points; one of them, where the other is missing or at the same place."""
    slope = F.try_divide(y1 - y0, x1 - x0)
    return F.when(x0.isNull() | (x == x1), y1).when(x1.isNull() | (x0 == x1), y0).otherwise(y0 + slope * (x - x0))


def in_expression(df: DataFrame, points: list[tuple[float, float]], score: str) -> DataFrame:
    """The curve over column ``_x`` by a binary search for the points around it."""
    if not points:
        return df.withColumn(score, F.lit(None).cast("double")).drop("_x")
    xs, ys = ([F.lit(float(p[i])) for p in points] for i in (0, 1))
    splits = [float("-inf"), *[p[0] for p in points], float("inf")]
    placed = Bucketizer(splits=splits, inputCol="_x", outputCol="_at", handleInvalid="keep").transform(df)
    at = F.col("_at").cast("int")  # points up to here lie at or left of x
    xs, ys = F.array(*xs), F.array(*ys)
    value = line(F.col("_x"), F.get(xs, at - 1), F.get(ys, at - 1), F.get(xs, at), F.get(ys, at))
    return placed.withColumn(score, F.when(F.col("_x").isNotNull(), value)).drop("_x", "_at")


def fit_isotonic_curve(points: DataFrame, score: str = "p", per_range: int = PER_RANGE) -> IsotonicCurve:
    """The isotonic curve of counts per score, see :func:`isotonic_blocks`, written to the shared folder."""
    return IsotonicCurve(store(curve_points(isotonic_blocks(points, score, per_range=per_range)), "curve"))
