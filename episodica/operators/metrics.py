"""Exact ranking and calibration metrics, per group, from one row per distinct score.

Everything starts from ``score_counts``: (group, score) with the number of rows and positives.  That
aggregation is partial before its shuffle, so the data that is ordered afterwards has no repeated
scores, and the order itself is computed range by range (``global_cumsum``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.functions import scalars as S
from episodica.functions.joins import salted_join
from episodica.functions.ordered import (
    exact_quantiles,
    global_cumsum,
    null_safe_join,
    shuffle_rank,
    value_counts,
)
from episodica.functions.sketch import approx_quantiles
from episodica.roles import ScoreRoles
from episodica.sources.shared import store

ROLES = ScoreRoles()
TOP_FRACTION = 0.10


def score_counts(df: DataFrame, roles: ScoreRoles = ROLES, by=()) -> DataFrame:
    """``(by, score, n, pos, neg)``, one row per distinct score."""
    counts = value_counts(df, roles.score, by, pos=F.sum(F.col(roles.label).cast("bigint")))
    return counts.withColumn("neg", F.col("n") - F.col("pos"))


def ranked_counts(counts: DataFrame, score: str, by=(), next_values=()) -> DataFrame:
    """Counts with running sums from the highest score down: ``cum_n``, ``cum_pos`` (TP), ``cum_neg`` (FP)."""
    return global_cumsum(counts, score, ["n", "pos", "neg"], by, descending=True, next_values=next_values)


def top_k(total: Column, fraction: float) -> Column:
    """Rows in the top fraction: round half to even, at least one."""
    return F.greatest(F.lit(1), F.bround(total * F.lit(float(fraction)), 0)).cast("bigint")


def _with_k(counts: DataFrame, ranked: DataFrame, by, fraction: float) -> DataFrame:
    """Ranked counts with ``_k``, the size of the top fraction of their group."""
    totals = counts.groupBy(*by).agg(top_k(F.sum("n"), fraction).alias("_k"))
    if by:
        return null_safe_join(ranked, totals, by)
    return ranked.withColumn("_k", totals.select("_k").scalar())


def _cut(score: str) -> Column:
    """Aggregate: the score at the k-th row, and how many rows and positives lie strictly above it."""
    above = F.col("cum_n") - F.col("n")
    facts = F.struct(
        F.col(score).alias("_cut_score"), "_k", above.alias("_n_above"), (F.col("cum_pos") - F.col("pos")).alias("_pos_above")
    )
    return F.max(F.when((above < F.col("_k")) & (F.col("_k") <= F.col("cum_n")), facts))


def _rank_once(df: DataFrame, roles: ScoreRoles, by, fraction: float, columns: dict[str, Column]) -> DataFrame:
    """``columns`` and the cut per group from a single pass over the ranked counts.

    One row per group, written to the shared folder: rows meet it later, and Spark then knows its size.
    """
    counts = score_counts(df, roles, by)
    ranked = _with_k(counts, ranked_counts(counts, roles.score, by), by, fraction)
    return store(_aggregate(ranked, by, {**columns, "_cut": _cut(roles.score)}), "ranked-sums")


def top_rows(df: DataFrame, roles: ScoreRoles = ROLES, by=(), fraction: float = TOP_FRACTION, seed=42) -> DataFrame:
    """The k highest-scored rows of each group; rows tied at the cut are taken in seeded md5 order of the key."""
    by = list(by)
    cut = _rank_once(df, roles, by, fraction, {}).select(*by, "_cut.*")
    if by:
        tagged = null_safe_join(df, cut, by)
    else:
        tagged = df.withColumn("_cut", cut.select(F.struct("_cut_score", "_k", "_n_above")).scalar()).select("*", "_cut.*")
    extra = ["_cut_score", "_k", "_n_above", "_pos_above"]
    sure = tagged.where(F.col(roles.score) > F.col("_cut_score")).drop("_cut", *extra)
    tied = shuffle_rank(tagged.where(F.col(roles.score) == F.col("_cut_score")), roles.key, seed, by, at_most=F.col("_k") - F.col("_n_above"))
    return sure.unionByName(tied.drop("_cut", *extra, "shuffle_rank", "group_size"))


def _ranking_sums() -> dict[str, Column]:
    """AP and ROC-AUC over ranked counts."""
    pos, neg = F.sum("pos"), F.sum("neg")
    ap = F.sum(F.col("pos").cast("double") * F.col("cum_pos") / F.col("cum_n"))
    wrong_pairs = F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") / 2))
    return {"pr_auc": F.try_divide(ap, pos), "roc_auc": 1 - F.try_divide(wrong_pairs, pos.cast("double") * neg)}


def _loss_sums(score: str) -> dict[str, Column]:
    """Brier score and log loss over counts; they need no order."""
    p, clipped, total = F.col(score), S.clip_score(score), F.sum("n")
    brier = F.sum(F.col("pos") * (p - 1) * (p - 1) + F.col("neg") * p * p)
    loss = -F.sum(F.col("pos") * F.log(clipped) + F.col("neg") * F.log(1 - clipped))
    return {"brier": brier / total, "log_loss": loss / total}


def _aggregate(df: DataFrame, by, columns: dict[str, Column]) -> DataFrame:
    return df.groupBy(*by).agg(*[c.alias(name) for name, c in columns.items()])


def ranking_scores(df: DataFrame, roles: ScoreRoles = ROLES, by=()) -> DataFrame:
    """``(by, pr_auc, roc_auc)``."""
    return _aggregate(ranked_counts(score_counts(df, roles, by), roles.score, by), by, _ranking_sums())


def loss_scores(df: DataFrame, roles: ScoreRoles = ROLES, by=()) -> DataFrame:
    """``(by, brier, log_loss)`` straight from the rows: one partial aggregation."""
    case = F.col(roles.label).cast("bigint")
    weighted = df.select(*by, roles.score, F.lit(1).alias("n"), case.alias("pos"), (1 - case).alias("neg"))
    return _aggregate(weighted, by, _loss_sums(roles.score))


def metric_panel(
    df: DataFrame, roles: ScoreRoles = ROLES, by=(), fraction: float = TOP_FRACTION, seed=42
) -> DataFrame:
    """One row per group: PR-AUC (average precision), ROC-AUC, Brier, log loss, recall and precision at top k, n, n_pos."""
    by = list(by)
    counted = {"n": F.sum("n"), "n_pos": F.sum("pos")}
    sums = _rank_once(df, roles, by, fraction, {**_ranking_sums(), **_loss_sums(roles.score), **counted})
    selected = _selected_positives(df, sums.select(*by, "_cut.*"), roles, by, seed)
    if by:
        panel = null_safe_join(sums, selected, by)
    else:
        panel = sums.withColumn("_sel", selected.select(F.struct("_k", "_pos_selected")).scalar()).select("*", "_sel.*").drop("_sel")
    hits = F.col("_pos_selected")
    return panel.withColumns(
        {
            "recall_at_top10": F.when(F.col("n_pos") > 0, hits / F.col("n_pos")).otherwise(0.0),
            "precision_at_top10": F.when(F.col("n_pos") > 0, hits / F.col("_k")).otherwise(0.0),
        }
    ).select(*by, "pr_auc", "roc_auc", "brier", "log_loss", "recall_at_top10", "precision_at_top10", "n", "n_pos")


def _selected_positives(df: DataFrame, cut: DataFrame, roles: ScoreRoles, by, seed) -> DataFrame:
    """Positives among the top k: those above the cut are known from the counts, only ties are ranked."""
    want = F.col("_k") - F.col("_n_above")
    if by:
        ties = null_safe_join(
            df.select(*by, roles.key, roles.label, F.col(roles.score).alias("_cut_score")), cut, [*by, "_cut_score"]
        )
    else:
        one_row = cut.select(F.struct("_cut_score", "_k", "_n_above", "_pos_above")).scalar()
        tagged = df.select(roles.key, roles.label, F.col(roles.score).alias("_s")).withColumn("_cut", one_row)
        ties = tagged.where(F.col("_s") == F.col("_cut._cut_score")).select(roles.key, roles.label, "_cut.*")
    picked = shuffle_rank(ties, roles.key, seed, by, at_most=want)
    return picked.groupBy(*by).agg(
        F.max("_k").alias("_k"), (F.max("_pos_above") + F.sum(F.col(roles.label).cast("bigint"))).alias("_pos_selected")
    )


def _spread_index(points: DataFrame, by, max_points: int) -> DataFrame:
    """Keep at most ``max_points`` evenly spaced rows of ``idx`` = 0..m-1 and number them anew."""
    by = list(by)
    sizes = points.groupBy(*by).agg(F.max("idx").alias("_last"))
    if by:
        points = null_safe_join(points, sizes, by)
    else:
        points = points.withColumn("_last", sizes.select("_last").scalar())
    last, slots = F.greatest(F.col("_last"), F.lit(1)), max_points - 1
    # slot j holds row floor(j * last / slots); a row is kept if some j maps to it
    slot = F.ceil(F.col("idx") * slots / last)
    kept = F.floor(slot * last / slots) == F.col("idx")
    small = last < max_points
    return (
        points.where(small | kept)
        .withColumn("idx", F.when(small, F.col("idx")).otherwise(slot).cast("bigint"))
        .drop("_last")
    )


def pr_curve(df: DataFrame, roles: ScoreRoles = ROLES, by=(), max_points: int = 1000) -> DataFrame:
    """``(by, idx, recall, precision)`` from the lowest score up, closed by the point (0, 1)."""
    by = list(by)
    counts = score_counts(df, roles, by).withColumn("one", F.lit(1))
    ranked = global_cumsum(counts, roles.score, ["n", "pos", "one"], by, descending=True)
    totals = counts.groupBy(*by).agg(F.sum("pos").alias("_p"), F.count(F.lit(1)).alias("_m"))
    if by:
        ranked = null_safe_join(ranked, totals, by)
    else:
        ranked = ranked.withColumn("_t", totals.select(F.struct("_p", "_m")).scalar()).select("*", "_t.*")
    body = ranked.select(
        *by,
        (F.col("_m") - F.col("cum_one")).alias("idx"),
        F.coalesce(F.try_divide(F.col("cum_pos"), F.col("_p")), F.lit(1.0)).alias("recall"),
        (F.col("cum_pos") / F.col("cum_n")).alias("precision"),
    )
    end = totals.select(*by, F.col("_m").alias("idx"), F.lit(0.0).alias("recall"), F.lit(1.0).alias("precision"))
    return _spread_index(body.unionByName(end), by, max_points)


def roc_curve(
    df: DataFrame, roles: ScoreRoles = ROLES, by=(), max_points: int = 1000, drop_collinear: bool = True
) -> DataFrame:
    """``(by, idx, fpr, tpr)`` from (0, 0) on; inner points on a straight piece are left out first."""
    by = list(by)
    counts = score_counts(df, roles, by)
    ranked = ranked_counts(counts, roles.score, by, next_values=["pos", "neg"])
    totals = counts.groupBy(*by).agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_q"), F.max(roles.score).alias("_top"))
    if by:
        ranked = null_safe_join(ranked, totals, by)
    else:
        ranked = ranked.withColumn("_t", totals.select(F.struct("_p", "_q", "_top")).scalar()).select("*", "_t.*")
    if drop_collinear:
        ranked = ranked.where(
            (F.col(roles.score) == F.col("_top"))
            | F.col("next_pos").isNull()
            | (F.col("next_pos") != F.col("pos"))
            | (F.col("next_neg") != F.col("neg"))
        )
    corners = ranked.select(
        *by,
        roles.score,
        F.lit(1).alias("one"),
        F.try_divide(F.col("cum_neg"), F.col("_q")).alias("fpr"),
        F.try_divide(F.col("cum_pos"), F.col("_p")).alias("tpr"),
    )
    numbered = global_cumsum(corners, roles.score, ["one"], by, descending=True)
    body = numbered.select(*by, F.col("cum_one").alias("idx"), "fpr", "tpr")
    start = totals.select(*by, F.lit(0).cast("bigint").alias("idx"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return _spread_index(body.unionByName(start), by, max_points)


def quantile_reliability(
    df: DataFrame,
    roles: ScoreRoles = ROLES,
    by=(),
    n_bins: int = 15,
    upper_side: bool = True,
    digits: int | None = 9,
    approx: bool = False,
) -> DataFrame:
    """``(by, bin, mean_pred, frac_pos, n)`` over quantile bins; empty bins do not appear.

    A score equal to an inner edge belongs to the bin above it (``upper_side``) or below it.  Edges
    and scores are compared after rounding to ``digits`` so that interpolation noise moves no row.  With ``approx``
    the edges come from a sketch per group, off by a bounded rank: the rows are read twice and never put in order.
    """
    by = list(by)
    names = {f"_e{i}": i / n_bins for i in range(1, n_bins)}
    rounded = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    if approx:
        counts = df.where(F.col(roles.score).isNotNull()).select(*by, roles.key, roles.score, F.lit(1).alias("n"), F.col(roles.label).cast("bigint").alias("pos"))
        quantiles = approx_quantiles(df, roles.score, names, by)
    else:
        counts = score_counts(df, roles, by)
        quantiles = exact_quantiles(counts, roles.score, names, by, weight="n")
    edges = quantiles.select(*by, F.array(*[rounded(F.col(c)) for c in names]).alias("_edges"))
    if by and approx:
        # rows, not counts: a group may have most of them
        joined = salted_join(counts, edges, by, "inner", roles.key, null_safe=True)
    elif by:
        joined = null_safe_join(counts, edges, by)
    else:
        joined = counts.withColumn("_edges", edges.select("_edges").scalar())
    x = rounded(F.col(roles.score))
    below = (lambda e: e <= x) if upper_side else (lambda e: e < x)
    binned = joined.withColumn("bin", F.size(F.filter("_edges", below)))
    return binned.groupBy(*by, "bin").agg(
        (F.sum(F.col(roles.score) * F.col("n")) / F.sum("n")).alias("mean_pred"),
        (F.sum("pos") / F.sum("n")).alias("frac_pos"),
        F.sum("n").alias("n"),
    )


def lift(panel: DataFrame) -> DataFrame:
    """PR-AUC over prevalence."""
    return panel.withColumns(
        {
            "prevalence": F.col("n_pos") / F.col("n"),
            "lift": F.try_divide(F.col("pr_auc") * F.col("n"), F.col("n_pos")),
        }
    )


def score_correlations(wide: DataFrame, models) -> DataFrame:
    """Pearson correlation of every ordered pair of score columns: ``(model_a, model_b, r)`` from one pass."""
    models = list(models)
    pairs = [(a, b) for i, a in enumerate(models) for b in models[i:]]
    one_row = wide.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    long = one_row.unpivot([], [F.col(f"`{a}|{b}`") for a, b in pairs], "pair", "r")
    half = long.select(
        F.split_part("pair", F.lit("|"), F.lit(1)).alias("model_a"), F.split_part("pair", F.lit("|"), F.lit(2)).alias("model_b"), "r"
    )
    mirrored = half.where("model_a <> model_b").select(F.col("model_b").alias("model_a"), F.col("model_a").alias("model_b"), "r")
    return half.unionByName(mirrored)
