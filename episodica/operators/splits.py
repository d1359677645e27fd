"""Entity-level splits, folds and samples: rows of one entity always stay together.

Entities are ranked in seeded md5 order within the strata "ever positive" / "never positive".  The rank
is computed on one row per entity and cell by cell, see ``shuffle_rank``; rows then pick up their
entity's result through a join that spreads entities with very many rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.functions.joins import salted_join
from episodica.functions.ordered import null_safe_join, shuffle_rank
from episodica.sources.shared import store


def entity_strata(df: DataFrame, entity: str, label: str) -> DataFrame:
    """One row per entity: ``ever_pos`` and the number of its rows."""
    return df.groupBy(entity).agg(F.max(label).cast("int").alias("ever_pos"), F.count(F.lit(1)).alias("n_rows"))


def ranked_entities(df: DataFrame, entity: str, label: str, seed=42, at_most: Column | None = None) -> DataFrame:
    """Entities with ``shuffle_rank`` and ``group_size`` within their stratum.

    The entity table is written once: counting the cells and ranking both read it.
    """
    return shuffle_rank(store(entity_strata(df, entity, label), "entities"), entity, seed, ["ever_pos"], at_most)


def _label_rows(df: DataFrame, assignment: DataFrame, entity: str, key: str) -> DataFrame:
    return salted_join(df, assignment, [entity], "left", key)


def split_of_entities(
    df: DataFrame, entity: str, label: str, test_size: float = 0.15, val_size: float = 0.15, seed=42
) -> DataFrame:
    """``(entity, split)``: test and validation take their share of each stratum, train the rest."""
    shares = [test_size, val_size]
    if min(shares) <= 0 or sum(shares) >= 1:
        raise ValueError(f"every part needs rows: shares {shares} must be positive and leave some for training")
    rank, size = F.col("shuffle_rank"), F.col("group_size")
    n_test = F.floor(size * test_size + 0.5)
    n_val = F.floor(size * val_size + 0.5)
    split = F.when(rank <= n_test, "test").when(rank <= n_test + n_val, "val").otherwise("train")
    return ranked_entities(df, entity, label, seed).select(entity, split.alias("split"))


def assign_splits(
    df: DataFrame,
    entity: str = "beneficiary_id",
    key: str = "claim_id",
    label: str = "y",
    test_size: float = 0.15,
    val_size: float = 0.15,
    seed=42,
) -> DataFrame:
    """Add ``split`` in {train, val, test}; no entity is in two of them."""
    return _label_rows(df, split_of_entities(df, entity, label, test_size, val_size, seed), entity, key)


def split_summary(df: DataFrame, entity: str = "beneficiary_id", label: str = "y") -> DataFrame:
    """Entities, rows and label rate per split."""
    return df.groupBy("split").agg(
        F.countDistinct(entity).alias("n_beneficiaries"),
        F.count(F.lit(1)).alias("n_encounters"),
        F.avg(label).alias("positive_rate"),
    )


def assign_halves(df: DataFrame, entity: str, key: str, label: str = "y", seed=42) -> DataFrame:
    """Add ``half``: 'calib' for the first floor(n/2) entities of each stratum, 'test' for the others."""
    half = F.when(F.col("shuffle_rank") <= F.floor(F.col("group_size") / 2), "calib").otherwise("test")
    halves = ranked_entities(df, entity, label, seed).select(entity, half.alias("half"))
    return _label_rows(df, halves, entity, key)


def assign_folds(df: DataFrame, entity: str, key: str, label: str = "y", k: int = 3, seed=42) -> DataFrame:
    """Add ``fold`` in 0..k-1: entities are dealt out in turn within each stratum."""
    fold = ((F.col("shuffle_rank") - 1) % k).cast("int")
    folds = ranked_entities(df, entity, label, seed).select(entity, fold.alias("fold"))
    return _label_rows(df, folds, entity, key)


def coarse(n: Column) -> Column:
    """A count with six significant bits, so that counts of any size have few values; up to 63 it stays as it is."""
    shift = F.greatest(F.length(F.bin(n)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", n, shift), shift)


def deal_profiles(profiles: list[tuple[int, int, int]], k: int) -> list[tuple[int, int, list[int]]]:
    """``(rows, positives, entities)`` to ``(rows, positives, running count of entities up to each fold)``.

    Entities are dealt one by one, heavy profiles first, always to the lightest fold (the first of equals).  Rows and
    positives weigh the same in all: a share of the rows plus a share of the positives.  A profile's entities go in one
    step: those given to a fold of load l start at l, l + w, l + 2 w ..., and the lowest starts come first.
    """
    all_rows, all_positives = (sum(p[i] * p[2] for p in profiles) for i in (0, 1))
    weigh = {p: p[0] * max(all_positives, 1) + p[1] * all_rows for p in profiles}
    loads, out = [0] * k, []
    for p in sorted(profiles, key=lambda q: (-weigh[q], q)):
        rows, positives, n = p
        w = weigh[p]

        def below(level, w=w):
            return [max(0, -((load - level) // w)) for load in loads]

        low, high = min(loads), max(loads) + w * (n + 1)
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if sum(below(middle)) <= n else (low, middle - 1)
        given = below(low)
        # what is left starts at the same load everywhere
        for f in sorted(range(k), key=lambda f: (loads[f] + w * given[f], f))[: n - sum(given)]:
            given[f] += 1
        loads = [load + w * c for load, c in zip(loads, given, strict=True)]
        out.append((rows, positives, [sum(given[: f + 1]) for f in range(k)]))
    return out


def assign_balanced_folds(df: DataFrame, entity: str, key: str, label: str = "y", k: int = 3, seed=42) -> DataFrame:
    """Add ``fold`` in 0..k-1: whole entities, with rows and positives spread evenly even if entities differ much.

    Entities are counted by profile (rows and positives, six significant bits each): a histogram of bounded size,
    which is dealt heaviest first to the lightest fold, see :func:`deal_profiles`.  Within a profile the seeded order
    decides.  No fold outweighs another by more than its last entity.  NULL labels count as 0; a NULL entity is one.
    """
    counts = df.groupBy(entity).agg(F.count(F.lit(1)).alias("_rows"), F.coalesce(F.sum(F.col(label).cast("bigint")), F.lit(0)).alias("_positives"))
    entities = store(counts.select(entity, coarse(F.col("_rows")).alias("_rows"), coarse(F.col("_positives")).alias("_positives")), "entities")
    profile = ["_rows", "_positives"]
    histogram = entities.groupBy(*profile).agg(F.count(F.lit(1)).alias("n")).collect()
    dealt = deal_profiles([(r[0], r[1], r.n) for r in histogram], k)
    plan = df.sparkSession.createDataFrame(dealt, "_rows long, _positives long, _upto array<long>")
    ranked = shuffle_rank(entities, entity, seed, profile).join(plan, profile)
    folds = ranked.select(entity, F.size(F.filter("_upto", lambda u: F.col("shuffle_rank") > u)).alias("fold"))
    return salted_join(df, folds, [entity], "left", key, null_safe=True)


def keep_entities(df: DataFrame, chosen: DataFrame, entity: str, key: str) -> DataFrame:
    """All rows of the chosen entities."""
    return salted_join(df, chosen.select(entity), [entity], "left_semi", key)


def entity_profile(df: DataFrame, entity: str, label: str = "y") -> DataFrame:
    """One row: rows, entities, mean rows per entity, share of ever-positive entities."""
    return entity_strata(df, entity, label).agg(
        F.sum("n_rows").alias("n_rows"),
        F.count(F.lit(1)).alias("n_entities"),
        F.avg("n_rows").alias("rows_per_entity"),
        F.avg("ever_pos").alias("positive_share"),
    )


def _choose_entities(df: DataFrame, entity: str, label: str, n_pos: Column, n_neg: Column, seed) -> DataFrame:
    """The first entities of each stratum in seeded order."""
    quota = F.when(F.col("ever_pos") == 1, n_pos).otherwise(n_neg)
    return ranked_entities(df, entity, label, seed, at_most=quota).select(entity)


def _profile_values(df: DataFrame, entity: str, label: str) -> dict:
    return entity_profile(df, entity, label).first().asDict()


def sample_to_rows(df: DataFrame, n_rows: int, entity: str, key: str, label: str = "y", seed=42) -> DataFrame:
    """Whole entities adding up to about ``n_rows`` rows, with the share of positive entities kept."""
    facts = _profile_values(df, entity, label)
    if facts["n_rows"] is None or facts["n_rows"] <= n_rows:
        return df
    n_entities = int(n_rows / facts["rows_per_entity"])
    n_pos = int(round(n_entities * facts["positive_share"]))
    return keep_entities(df, _choose_entities(df, entity, label, F.lit(n_pos), F.lit(n_entities - n_pos), seed), entity, key)


def sample_entities(df: DataFrame, n_entities: int, entity: str, key: str, label: str = "y", seed=42) -> DataFrame:
    """All rows of ``n_entities`` entities, at least one per stratum; everything if there are no more rows."""
    facts = _profile_values(df, entity, label)
    if facts["n_rows"] is None or facts["n_rows"] <= n_entities:
        return df
    n_pos = max(1, int(round(n_entities * facts["positive_share"])))
    n_neg = max(1, n_entities - n_pos)
    return keep_entities(df, _choose_entities(df, entity, label, F.lit(n_pos), F.lit(n_neg), seed), entity, key)


def sample_fraction(df: DataFrame, n_rows: int, entity: str, key: str, label: str = "y", seed=42) -> DataFrame:
    """Whole entities: the fraction n_rows / rows of each stratum; everything if there are no more rows."""
    facts = _profile_values(df, entity, label)
    if facts["n_rows"] is None or facts["n_rows"] <= n_rows:
        return df
    fraction = min(0.999, n_rows / facts["n_rows"])
    quota = F.floor(F.col("group_size") * fraction + 0.5)
    chosen = ranked_entities(df, entity, label, seed, at_most=quota).select(entity)
    return keep_entities(df, chosen, entity, key)


def sample_rows(df: DataFrame, n: int, key: str, seed=42) -> DataFrame:
    """``n`` rows in seeded md5 order of a unique key (all rows if there are fewer)."""
    return shuffle_rank(df, key, seed, at_most=F.lit(n)).drop("shuffle_rank", "group_size")


def hold_out(df: DataFrame, key: str, fraction: float = 0.1, at_least: int = 1024, seed=42) -> DataFrame:
    """Add ``is_validation``: max(at_least, fraction) of the rows, never more than half, drawn by row key."""
    wanted = F.greatest(F.lit(at_least), F.floor(F.col("group_size") * fraction))
    quota = F.least(wanted, F.floor(F.col("group_size") / 2))
    ranked = shuffle_rank(df, key, seed)
    return ranked.withColumn("is_validation", F.col("shuffle_rank") <= quota).drop("shuffle_rank", "group_size")


def leaking_entities(df: DataFrame, entity: str, part: str = "split") -> DataFrame:
    """Entities seen in more than one part; must be empty."""
    return df.groupBy(entity).agg(F.countDistinct(part).alias("n_parts")).where("n_parts > 1")


def broken_entities(full: DataFrame, sample: DataFrame, entity: str) -> DataFrame:
    """Sampled entities that lost rows; must be empty."""
    have = sample.groupBy(entity).agg(F.count(F.lit(1)).alias("n_sample"))
    want = full.groupBy(entity).agg(F.count(F.lit(1)).alias("n_full"))
    return null_safe_join(have, want, [entity]).where("n_sample <> n_full")


def partition_check(df: DataFrame, part: str = "half") -> DataFrame:
    """Rows with and without a part: an exhaustive, disjoint labelling leaves ``n_unassigned`` at 0."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(part).isNull()).alias("n_unassigned"))
