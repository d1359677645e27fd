"""Episode cohort: order within the entity, look-ahead label, look-back count, attributes, exclusions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from episodica.functions import scalars as S
from episodica.functions.joins import hot_keys, key_counts, salted_join, salted_sides
from episodica.functions.ordered import null_safe_join
from episodica.roles import EpisodeRoles

# Exclusion rules of the claims preset, in reporting order.
EXCLUSIONS = ("died_during", "censored_death", "censored_window", "long_los", "too_young")


def with_sequence(df: DataFrame, roles: EpisodeRoles = EpisodeRoles(), lookback_days: int = 180) -> DataFrame:
    """Add ``next_start``, ``prev_end`` and ``prior_count`` for each episode of an entity.

    The order within an entity is (start, end, key).  ``prior_count`` counts the other episodes of the
    entity that start in the half-open window (start - lookback, start], same-day ones included.

    Rows are shuffled once, by entity, and the windows run on them.  Entities that hold more than 1/(2P) of the rows
    (P being the shuffle partitions) go through :func:`sequence_of_hot` instead, so none ends up in one task.
    """
    hot = hot_keys(key_counts(df, [roles.entity]), [roles.entity]).select(roles.entity)
    few = null_safe_join(df, F.broadcast(hot), [roles.entity], "left_anti")
    many = null_safe_join(df, F.broadcast(hot), [roles.entity], "left_semi")
    return sequence_of_few(few, roles, lookback_days).unionByName(sequence_of_hot(many, roles, lookback_days))


def neighbour_columns(roles: EpisodeRoles) -> dict[str, Column]:
    """The columns of :func:`with_sequence` from first and last key of the stay, its neighbours and its window."""
    return {
        "next_start": F.when(F.col(roles.key) < F.col("_last"), F.col(roles.start)).otherwise(F.col("_next")),
        "prev_end": F.when(F.col(roles.key) > F.col("_first"), F.col(roles.end)).otherwise(F.col("_prev")),
        "prior_count": (F.col("_in_window") - 1).cast("int"),
    }


def day_number(column: str) -> Column:
    return F.datediff(F.col(column), F.lit("1970-01-01").cast("date"))


def sequence_of_few(df: DataFrame, roles: EpisodeRoles, lookback_days: int) -> DataFrame:
    """:func:`with_sequence` by windows over the rows of each entity; all windows share one shuffle and one sort."""
    entity, key, start, end = roles.entity, roles.key, roles.start, roles.end
    order = W.partitionBy(entity).orderBy("_day", start, end, key)
    look = W.partitionBy(entity).orderBy("_day").rangeBetween(-(lookback_days - 1), 0)
    stay = W.partitionBy(entity, "_day", start, end)
    dates = F.struct(start, end)
    # the neighbouring row belongs to another stay, or there is none
    edge = lambda c: F.col(c).isNull() | ~F.col(c).eqNullSafe(dates)
    rows = df.withColumn("_day", day_number(start)).withColumns({"_after": F.lead(dates).over(order), "_before": F.lag(dates).over(order)})
    return (
        rows.withColumns(
            {
                "_first": F.min(key).over(stay),
                "_last": F.max(key).over(stay),
                "_next": F.max(F.when(edge("_after"), F.col(f"_after.{start}"))).over(stay),
                "_prev": F.max(F.when(edge("_before"), F.col(f"_before.{end}"))).over(stay),
            }
        )
        .withColumn("_in_window", F.count(F.lit(1)).over(look))
        .withColumns(neighbour_columns(roles))
        .drop("_day", "_after", "_before", "_first", "_last", "_next", "_prev", "_in_window")
    )


def sequence_of_hot(df: DataFrame, roles: EpisodeRoles, lookback_days: int) -> DataFrame:
    """:func:`with_sequence` for entities with very many rows.

    The window functions run on one row per (entity, start, end).  That table is bounded by the
    calendar however many episodes an entity has, is reduced before the shuffle, and is joined back
    on all three columns with salts, so not even an entity with a third of all rows on one day ends up in one task.
    """
    entity, key, start, end = roles.entity, roles.key, roles.start, roles.end
    keys = [entity, start, end]
    stays = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min(key).alias("_first"), F.max(key).alias("_last")
    )
    order = W.partitionBy(entity).orderBy(start, end)
    look = W.partitionBy(entity).orderBy(day_number(start)).rangeBetween(-(lookback_days - 1), 0)
    stays = stays.select(
        entity,
        start,
        end,
        "_n",
        "_first",
        "_last",
        F.lead(start).over(order).alias("_next"),
        F.lag(end).over(order).alias("_prev"),
        F.sum("_n").over(look).alias("_in_window"),
    )
    return (
        salted_join(df, stays.drop("_n"), keys, "inner", key, stays.select(*keys, "_n"), null_safe=True)
        .withColumns(neighbour_columns(roles))
        .drop("_first", "_last", "_next", "_prev", "_in_window")
    )


def with_return_label(df: DataFrame, roles: EpisodeRoles = EpisodeRoles(), horizon_days: int = 30) -> DataFrame:
    """Gaps to the neighbours and the label ``y``; needs the columns of :func:`with_sequence`."""
    gaps = df.withColumns(
        {
            "days_to_next": S.days_between(roles.end, "next_start"),
            "days_since_last": S.days_between("prev_end", roles.start),
        }
    )
    return gaps.withColumn("y", S.return_label("days_to_next", horizon_days))


def latest_record(df: DataFrame, keys, order: str, columns) -> DataFrame:
    """The columns of the row with the greatest ``order`` per key, as one partial-aggregated max."""
    packed = df.groupBy(*keys).agg(F.max_by(F.struct(*columns), order).alias("_latest"))
    return packed.select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in columns])


def attach_snapshot(
    df: DataFrame,
    snapshots: DataFrame,
    keys,
    fact_year: str,
    snapshot_year: str,
    columns,
    anchor: str,
    spread: str,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Attributes of the fact's own year, or the latest year's whole block where ``anchor`` is NULL.

    Both look-ups need one join: a key's yearly rows (those with the anchor) are packed into a map by year plus the
    latest record.  The packed rows grow with the entities, so they are shuffled and never pass through the driver.  Rows
    are packed behind the shuffle of the join: a task that reads many of them would sort and spill them to pack them first.
    ``snapshots`` must be unique per (keys, year): a repeated year is an error, found by a Spark job before the join.  Snapshots without a year are left out, and NULL keys meet nothing.
    """
    snapshots = snapshots.where(F.col(snapshot_year).isNotNull())
    repeated = duplicate_snapshots(snapshots, [*keys, snapshot_year]).head(1)
    if repeated:
        raise ValueError(f"more than one snapshot of a key and year, the first: {repeated[0].asDict()}")
    block = F.struct(*columns)
    left, right = salted_sides(df, snapshots, keys, spread, counts)
    both = [*keys, "_salt"]
    packed = right.repartition(*both).groupBy(*both).agg(
        F.map_from_entries(F.collect_list(F.when(F.col(anchor).isNotNull(), F.struct(F.col(snapshot_year), block)))).alias("_by_year"),
        F.max_by(block, snapshot_year).alias("_latest"),
    )
    joined = left.join(packed.hint("merge"), both, "left").drop("_salt")
    exact = F.try_element_at("_by_year", F.col(fact_year))
    use_exact = exact.getField(anchor).isNotNull()
    return joined.withColumns(
        {c: F.when(use_exact, exact.getField(c)).otherwise(F.col(f"_latest.{c}")) for c in columns}
    ).drop("_by_year", "_latest")


def duplicate_snapshots(snapshots: DataFrame, keys) -> DataFrame:
    """Keys with more than one snapshot row; must be empty before :func:`attach_snapshot`.

    Hardly any two rows share a key, so rows are counted behind the shuffle, in small parts.
    """
    keys = list(keys)
    return snapshots.select(*keys).repartition(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def exclusion_flags(
    df: DataFrame,
    roles: EpisodeRoles = EpisodeRoles(),
    death: str = "death_date",
    length: str = "los_days",
    age: str = "age_at_admit",
    label: str = "y",
    horizon_days: int = 30,
    max_length: int = 365,
    min_age: int = 18,
    last_observed: Column | None = None,
) -> DataFrame:
    """One nullable flag ``excl_<rule>`` per rule; the last observed start comes from ``df`` itself."""
    died = F.col(death)
    if last_observed is None:
        last_observed = df.select(F.max(roles.start)).scalar()
    horizon_end = F.date_add(F.col(roles.end), horizon_days)
    rules = {
        "died_during": died.isNotNull() & (died >= F.col(roles.start)) & (died <= F.col(roles.end)),
        "censored_death": died.isNotNull() & (died > F.col(roles.end)) & (died <= horizon_end) & (F.col(label) == 0),
        "censored_window": horizon_end > last_observed,
        "long_los": F.col(length) > max_length,
        "too_young": F.col(age) < min_age,
    }
    return df.withColumns({f"excl_{name}": rules[name] for name in EXCLUSIONS})


def keep_included(flagged: DataFrame) -> DataFrame:
    """Rows where no rule applies.  Three-valued: an undecidable rule drops the row as well."""
    names = [f"excl_{name}" for name in EXCLUSIONS]
    return flagged.where(~reduce(or_, [F.col(n) for n in names])).drop(*names)


def attrition(flagged: DataFrame) -> DataFrame:
    """Rows per exclusion reason, all rows and dropped rows: ``(reason, n)`` from one pass."""
    names = [f"excl_{name}" for name in EXCLUSIONS]
    kept = ~reduce(or_, [F.col(n) for n in names])
    wide = flagged.agg(
        F.count(F.lit(1)).alias("total"),
        (F.count(F.lit(1)) - F.count_if(kept)).alias("dropped"),
        *[F.count_if(F.col(f"excl_{name}")).alias(name) for name in EXCLUSIONS],
    )
    return wide.unpivot([], ["total", "dropped", *EXCLUSIONS], "reason", "n")


def cohort_summary(
    cohort: DataFrame,
    n_before=None,
    entity: str = "beneficiary_id",
    label: str = "y",
    sample: str = "sample",
    year: str = "admit_year",
    length: str = "los_days",
    age: str = "age_at_admit",
) -> DataFrame:
    """One row of cohort facts from one pass.

    The medians are exact; whole days and years have few distinct values, so the aggregation state
    (a count per value) stays small.  Use ``exact_quantiles`` for columns without that bound.
    """
    counts = cohort.agg(
        F.count(F.lit(1)).alias("n_encounters"),
        F.countDistinct(entity).alias("n_beneficiaries"),
        F.coalesce(F.sum(label), F.lit(0)).cast("bigint").alias("positive_count"),
        F.countDistinct(sample).alias("n_samples_present"),
        F.min(year).alias("admit_year_min"),
        F.max(year).alias("admit_year_max"),
        F.median(length).alias("median_los"),
        F.median(age).alias("median_age"),
    )
    out = counts.withColumn("positive_rate", S.share("positive_count", "n_encounters"))
    return out if n_before is None else out.withColumn("n_dropped_total", n_before - F.col("n_encounters"))
