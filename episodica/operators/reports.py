"""Report tables: column views, combined leaderboards, slices per attribute, reference lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Report headings of the metric columns.
HEADINGS = {
    "model": "Model",
    "pr_auc": "PR-AUC",
    "roc_auc": "ROC-AUC",
    "brier": "Brier",
    "recall_at_top10": "Recall@10%",
    "fit_seconds": "Fit (s)",
    "slice": "Group",
    "n": "n",
    "prevalence": "Prevalence",
    "fnr_at_t": "FNR@t",
    "fpr_at_t": "FPR@t",
}


def report_view(table: DataFrame, columns, headings=None) -> DataFrame:
    """The chosen columns under their report headings."""
    headings = {**HEADINGS, **(headings or {})}
    return table.select(*[F.col(c).alias(headings.get(c, c)) for c in columns])


def combine_boards(boards: dict[str, DataFrame | None]) -> DataFrame:
    """All leaderboards under one another with their name in ``board``; missing ones are skipped."""
    out = None
    for name, table in boards.items():
        if table is None:
            continue
        named = table.withColumn("board", F.lit(name))
        out = named if out is None else out.unionByName(named, allowMissingColumns=True)
    if out is None:
        raise ValueError("no leaderboard to combine")
    return out


def slices_of(table: DataFrame, attribute: str) -> DataFrame:
    return table.where(F.col("attribute") == attribute)


def against_previous_best(new: DataFrame, previous: DataFrame, metric: str = "pr_auc", name: str = "model") -> DataFrame:
    """New models with the best previous value and the difference to it."""
    best = previous.agg(F.max_by(F.struct(F.col(name).alias("best_model"), F.col(metric).alias("best_value")), F.struct(F.col(metric), F.col(name))).alias("b")).scalar()
    out = new.select(name, metric).withColumn("_b", best).select("*", "_b.*").drop("_b")
    return out.withColumn("delta", F.col(metric) - F.col("best_value"))
