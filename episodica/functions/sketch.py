"""Approximate quantiles from mergeable sketches: one small row per group and period, merged as far as a question asks.

A sketch is a KLL sketch of Spark's own, made and merged inside the JVM with partial aggregation before the shuffle.
What moves is sketches, not values, so a group with most of the rows costs no more than others.  Stored per day they
answer for any span of days without reading the rows again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# entries of the lowest level
ACCURACY = 4096
SKETCH = "sketch"


def rank_error(k: int = ACCURACY) -> float:
    """Share of the rows by which a quantile's rank is off, at 99 % confidence: 0.0013 for the default.

    Fixed values: the constants of the published error of KLL sketches.
    """
    return 2.296 / k**0.9021


def sketch_bytes(k: int = ACCURACY) -> int:
    """Bound of a sketch's size, whatever it has seen: levels shrink by a third, the smallest ones hold eight entries."""
    return 8 * (3 * k + 8 * 64) + 64


def quantile_sketches(df: DataFrame, value: Column | str, by=(), k: int = ACCURACY) -> DataFrame:
    """``(by, n, sketch)``: one sketch of the values per group, of at most :func:`sketch_bytes`.

    NULL and NaN values are left out; a group without values has no row.  NULL in ``by`` is a group.  Which entries a
    sketch keeps is drawn at random, so two runs differ within the rank error.  Up to ``k`` values it holds all.
    """
    v = F.col(value) if isinstance(value, str) else value
    rows = df.select(*by, v.cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("_v", F.lit(k)).alias(SKETCH)).where("n > 0")


def merge_sketches(sketches: DataFrame, by=()) -> DataFrame:
    """Sketches of coarser groups; the rank error stays that of a single sketch."""
    merged = sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double(SKETCH).alias(SKETCH))
    return merged.where("n > 0")


def sketch_quantiles(sketches: DataFrame, probs: dict[str, float], by=()) -> DataFrame:
    """``(by, n, <name> ...)``: for each name the value at its share of the rows, one that occurs in the data."""
    found = F.kll_sketch_get_quantile_double(SKETCH, F.array(*[F.lit(float(p)) for p in probs.values()]))
    held = sketches.select(*by, "n", found.alias("_q"))
    return held.select(*by, "n", *[F.get("_q", F.lit(i)).alias(name) for i, name in enumerate(probs)])


def approx_quantiles(df: DataFrame, value: Column | str, probs: dict[str, float], by=(), k: int = ACCURACY) -> DataFrame:
    """Quantiles per group in one pass over the rows, each off by :func:`rank_error` of the group's rows."""
    return sketch_quantiles(quantile_sketches(df, value, by, k), probs, by)


def rank_is_close(below: Column, up_to: Column, n: Column, prob: float, error: float) -> Column:
    """Whether a value with ``below`` smaller rows and ``up_to`` rows not larger may stand for the quantile ``prob``."""
    return (below / n - error <= prob) & (prob <= up_to / n + error)
