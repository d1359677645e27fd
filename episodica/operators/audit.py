"""Fairness audit: metrics per attribute value, parity gaps and reliability per slice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.functions.ordered import null_safe_join
from episodica.operators.metrics import metric_panel, quantile_reliability
from episodica.roles import ScoreRoles

OVERALL = "OVERALL"
ATTRIBUTES = ("sex", "race", "age_bin")
# Display order of the slices of the preset's attributes.
SLICE_ORDER = {"age_bin": ("<65", "65-74", "75-84", "85+"), "sex": ("Female", "Male")}


def by_slice(df: DataFrame, attributes=ATTRIBUTES, overall: bool = True) -> DataFrame:
    """Each row once per attribute as ``(attribute, slice)``, and once more per attribute as OVERALL."""
    cells = []
    for a in attributes:
        cells.append(F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("slice")))
        if overall:
            cells.append(F.struct(F.lit(a).alias("attribute"), F.lit(OVERALL).alias("slice")))
    return df.select("*", F.inline(F.array(*cells)))


def decision_counts(df: DataFrame, decision: str = "yhat", label: str = "y", attributes=ATTRIBUTES) -> DataFrame:
    """Confusion counts per (attribute, slice), OVERALL included, from grouping sets: one pass, no row copies."""
    flagged, case = F.col(decision) == 1, F.col(label) == 1
    counts = df.groupingSets([[], *[[F.col(a)] for a in attributes]], *attributes).agg(
        *[F.grouping(a).alias(f"_g_{a}") for a in attributes],
        F.count(F.lit(1)).alias("n"),
        F.count_if(case).alias("n_pos"),
        F.count_if(flagged).alias("n_flagged"),
        F.count_if(case & ~flagged).alias("fn"),
        F.count_if(~case & flagged).alias("fp"),
    )
    values = ["n", "n_pos", "n_flagged", "fn", "fp"]
    is_total = F.lit(True)
    for a in attributes:
        is_total = is_total & (F.col(f"_g_{a}") == 1)
    names = F.when(is_total, F.array(*[F.lit(a) for a in attributes]))
    value = F.when(is_total, F.lit(OVERALL))
    for a in attributes:
        names = names.when(F.col(f"_g_{a}") == 0, F.array(F.lit(a)))
        value = value.when(F.col(f"_g_{a}") == 0, F.col(a).cast("string"))
    return counts.select(F.explode(names).alias("attribute"), value.alias("slice"), *values)


def slice_metrics(
    df: DataFrame, decision: str = "yhat", roles: ScoreRoles = ScoreRoles(), attributes=ATTRIBUTES, seed=42
) -> DataFrame:
    """Long slice table.  Metrics that need both classes are NULL in a one-class slice.

    Ranking metrics of the OVERALL rows are computed once and shared by the attributes.
    """
    counts = decision_counts(df, decision, roles.label, attributes)
    narrow = df.select(roles.key, roles.label, roles.score, *attributes)
    cells = [F.struct(F.lit(a).alias("part"), F.col(a).cast("string").alias("slice")) for a in attributes]
    cells.append(F.struct(F.lit(OVERALL).alias("part"), F.lit(OVERALL).alias("slice")))
    parts = narrow.select(roles.key, roles.label, roles.score, F.inline(F.array(*cells)))
    panel = metric_panel(parts, roles, by=["part", "slice"], seed=seed).drop("n", "n_pos")
    part = F.when(F.col("slice") == OVERALL, F.lit(OVERALL)).otherwise(F.col("attribute"))
    joined = null_safe_join(counts.withColumn("part", part), panel, ["part", "slice"], "left").drop("part")
    mixed = (F.col("n_pos") > 0) & (F.col("n_pos") < F.col("n"))
    n_neg = F.col("n") - F.col("n_pos")
    guarded = {c: F.when(mixed, F.col(c)) for c in ("brier", "pr_auc", "roc_auc", "recall_at_top10")}
    return joined.withColumns(
        {
            **guarded,
            "prevalence": F.col("n_pos") / F.col("n"),
            "selection_rate": F.col("n_flagged") / F.col("n"),
            "fnr_at_t": F.when(mixed, F.try_divide("fn", "n_pos")),
            "fpr_at_t": F.when(mixed, F.try_divide(F.col("fp"), n_neg)),
        }
    ).select(
        "attribute", "slice", "n", "n_pos", "prevalence", "selection_rate", "brier",
        "pr_auc", "roc_auc", "recall_at_top10", "fnr_at_t", "fpr_at_t",
    )


def parity_gaps(counts: DataFrame) -> DataFrame:
    """Per attribute: demographic-parity and equalised-odds differences and the FNR range with its slices.

    Takes the output of :func:`decision_counts`.  A slice without positives (negatives) counts with an
    FNR (FPR) of 0.
    """
    zero = F.lit(0.0)
    rates = counts.where(F.col("slice") != OVERALL).select(
        "attribute",
        "slice",
        (F.col("n_flagged") / F.col("n")).alias("sel"),
        F.coalesce(F.try_divide("fn", "n_pos"), zero).alias("fnr"),
        F.coalesce(F.try_divide(F.col("n_pos") - F.col("fn"), F.col("n_pos")), zero).alias("tpr"),
        F.coalesce(F.try_divide(F.col("fp"), F.col("n") - F.col("n_pos")), zero).alias("fpr"),
    )
    spread = lambda c: F.max(c) - F.min(c)
    return rates.groupBy("attribute").agg(
        spread("sel").alias("demographic_parity_difference"),
        F.greatest(spread("tpr"), spread("fpr")).alias("equalized_odds_difference"),
        F.max("fnr").alias("fnr_max"),
        F.min("fnr").alias("fnr_min"),
        spread("fnr").alias("fnr_gap"),
        F.min_by("slice", F.struct(-F.col("fnr"), F.col("slice"))).alias("worst_fnr_slice"),
        F.min_by("slice", F.struct(F.col("fnr"), F.col("slice"))).alias("best_fnr_slice"),
    )


def slice_reliability(
    df: DataFrame, roles: ScoreRoles = ScoreRoles(), attributes=ATTRIBUTES, n_bins: int = 10, min_rows: int = 200
) -> DataFrame:
    """Reliability per slice over quantile bins, for slices with enough rows and both classes."""
    cells = [F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("slice")) for a in attributes]
    keys = ["attribute", "slice"]
    parts = df.select(roles.key, roles.label, roles.score, F.inline(F.array(*cells)))
    sizes = parts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col(roles.label).cast("bigint")).alias("_p"))
    shown = sizes.where((F.col("_n") >= min_rows) & (F.col("_p") > 0) & (F.col("_p") < F.col("_n"))).select(*keys)
    curve = quantile_reliability(parts, roles, keys, n_bins, upper_side=False)
    return null_safe_join(curve, shown, keys, "left_semi")


def ordered_slices(table: DataFrame) -> DataFrame:
    """Add ``slice_order``: the fixed order where one is known, otherwise by size, OVERALL first."""
    position = F.when(F.col("slice") == OVERALL, F.lit(0).cast("bigint"))
    for attribute, names in SLICE_ORDER.items():
        for i, name in enumerate(names):
            position = position.when((F.col("attribute") == attribute) & (F.col("slice") == name), F.lit(i + 1).cast("bigint"))
    return table.withColumn("slice_order", position.otherwise(F.lit(2**40) - F.col("n")))
