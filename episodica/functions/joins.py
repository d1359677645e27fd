"""Joins of a large fact table to a keyed side when one key may hold a large part of the facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.functions.ordered import null_safe_join


def key_counts(df: DataFrame, keys) -> DataFrame:
    """Rows per key as ``_n``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def hot_keys(counts: DataFrame, keys) -> DataFrame:
    """Keys that hold more than 1/(2P) of the rows, P being the shuffle partitions, with ``_copies``.

    ``counts`` has the rows per key as ``_n``.  At most 2P keys can pass, so the result is small whatever the data.
    """
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    limit = F.greatest(counts.select(F.sum("_n")).scalar() / (2 * parts), F.lit(1.0))
    return counts.where(F.col("_n") > limit).select(*keys, F.ceil(F.col("_n") / limit).cast("int").alias("_copies"))


def salted_join(
    facts: DataFrame, side: DataFrame, keys, how: str = "left", spread: str | None = None, counts: DataFrame | None = None,
    null_safe: bool = False, shuffled: bool = False,
) -> DataFrame:
    """Join ``facts`` to ``side`` on ``keys`` so that no key lands in one task as a whole.

    Rows of hot keys are spread over as many salts as the key fills fair shares, and only the side
    rows of those keys are copied (at most 4P copies in all).  The list of hot keys is broadcast;
    its size is bounded by construction.  ``spread`` names the column whose hash picks the salt.
    ``counts`` may give the rows per key as ``_n``, if they are known.  NULL keys meet nothing, unless
    ``null_safe`` makes NULL a key like others.  ``shuffled`` is for sides whose rows are much larger than Spark's
    estimate of them (packed years, derived keys): they are never collected and broadcast.
    """
    left, right = salted_sides(facts, side, keys, spread, counts)
    if shuffled:
        right = right.hint("merge")
    both = [*keys, "_salt"]
    return (null_safe_join(left, right, both, how) if null_safe else left.join(right, both, how)).drop("_salt")


def salted_sides(facts: DataFrame, side: DataFrame, keys, spread: str | None = None, counts: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides of a salted join with their ``_salt``, for callers that shape the side further before they join."""
    keys = list(keys)
    spread = spread or next(c for c in facts.columns if c not in keys)
    hot = F.broadcast(hot_keys(key_counts(facts, keys) if counts is None else counts, keys))
    copies = F.coalesce(F.col("_copies"), F.lit(1))
    left = null_safe_join(facts, hot, keys, "left").withColumn("_salt", F.pmod(F.hash(spread), copies)).drop("_copies")
    right = (
        null_safe_join(side, hot, keys, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), copies - 1)))
        .drop("_copies")
    )
    return left, right
