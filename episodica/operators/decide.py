"""Decision economics: cost sweep over thresholds, confusion counts, calibrators."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from episodica.functions import scalars as S
from episodica.functions.ordered import null_safe_join
from episodica.operators.isotonic import fit_isotonic_curve
from episodica.operators.linear import fit_logistic
from episodica.operators.metrics import metric_panel, score_counts
from episodica.roles import ScoreRoles

# Default costs of a miss and of an outreach, and the number of thresholds tried.
COST_FN = 15000.0
COST_FP = 500.0
N_GRID = 501
# Calibration methods in tie order.
METHODS = ("uncalibrated", "isotonic", "platt")


def cost_sweep(
    df: DataFrame,
    roles: ScoreRoles = ScoreRoles(),
    by=(),
    cost_fn: float = COST_FN,
    cost_fp: float = COST_FP,
    n_grid: int = N_GRID,
) -> DataFrame:
    """``(by, grid_idx, threshold, tn, fp, fn, tp, cost)`` for every threshold of an even grid on [0, 1].

    One pass puts each score into the last grid point it reaches; the sweep then runs over at most
    ``n_grid`` rows per group.
    """
    by = list(by)
    step = 1.0 / (n_grid - 1)
    p = F.col(roles.score)
    guess = F.floor(p / step)
    reached = (
        F.when((guess + 1) * step <= p, guess + 1).when(guess * step > p, guess - 1).otherwise(guess)
    )
    cells = (
        df.groupBy(*by, F.greatest(F.lit(-1), F.least(reached, F.lit(n_grid - 1))).cast("int").alias("grid_idx"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(roles.label).cast("bigint")).alias("pos"))
        .withColumn("neg", F.col("n") - F.col("pos"))
    )
    totals = cells.groupBy(*by).agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_q"))
    spine = totals.withColumn("grid_idx", F.explode(F.sequence(F.lit(0), F.lit(n_grid - 1))))
    full = null_safe_join(spine, cells, [*by, "grid_idx"], "left").na.fill(0, ["pos", "neg"])
    window = (W.partitionBy(*by) if by else W.partitionBy(F.lit(0))).orderBy(F.col("grid_idx").desc())
    running = window.rowsBetween(W.unboundedPreceding, 0)
    swept = full.withColumns({"tp": F.sum("pos").over(running), "fp": F.sum("neg").over(running)})
    counted = swept.withColumns({"fn": F.col("_p") - F.col("tp"), "tn": F.col("_q") - F.col("fp")})
    return counted.select(
        *by,
        "grid_idx",
        (F.col("grid_idx") * F.lit(step)).alias("threshold"),
        "tn",
        "fp",
        "fn",
        "tp",
        (cost_fn * F.col("fn") + cost_fp * (F.col("tp") + F.col("fp"))).alias("cost"),
    )


def pick_threshold(sweep: DataFrame, by=()) -> DataFrame:
    """The cheapest row of the sweep; the lowest threshold wins a tie."""
    by = list(by)
    columns = [c for c in sweep.columns if c not in by]
    best = sweep.groupBy(*by).agg(F.min_by(F.struct(*columns), F.struct("cost", "grid_idx")).alias("_best"))
    return best.select(*by, "_best.*")


def with_baselines(picked: DataFrame, cost_fn: float = COST_FN, cost_fp: float = COST_FP) -> DataFrame:
    """Cost of treating everyone and no one, cost per row and savings against both."""
    n = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return picked.withColumns({"always_cost": cost_fp * n, "never_cost": cost_fn * (F.col("fn") + F.col("tp"))}).withColumns(
        {
            "cost_per_row": F.col("cost") / n,
            "saved_vs_always": F.col("always_cost") - F.col("cost"),
            "saved_vs_never": F.col("never_cost") - F.col("cost"),
        }
    )


def confusion(df: DataFrame, threshold: float, roles: ScoreRoles = ScoreRoles(), by=()) -> DataFrame:
    """Confusion counts at a threshold with recall, precision and flagged share."""
    hit, case = F.col(roles.score) >= threshold, F.col(roles.label) == 1
    counts = df.groupBy(*by).agg(
        F.count_if(~hit & ~case).alias("tn"),
        F.count_if(hit & ~case).alias("fp"),
        F.count_if(~hit & case).alias("fn"),
        F.count_if(hit & case).alias("tp"),
    )
    flagged = F.col("tp") + F.col("fp")
    return counts.withColumns(
        {
            "recall": F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fn")), F.lit(0.0)),
            "precision": F.coalesce(F.try_divide(F.col("tp"), flagged), F.lit(0.0)),
            "flagged_share": F.try_divide(flagged, flagged + F.col("tn") + F.col("fn")),
        }
    )


def cost_parts(counts: DataFrame, cost_fn: float = COST_FN, cost_fp: float = COST_FP) -> DataFrame:
    """Cost split into missed cases, needless and useful outreach."""
    return counts.withColumns(
        {
            "cost_missed": cost_fn * F.col("fn"),
            "cost_needless": cost_fp * F.col("fp"),
            "cost_useful": cost_fp * F.col("tp"),
        }
    )


class Calibrator:
    """A fitted calibration method; ``apply`` replaces the score column."""

    def __init__(self, method: str, model=None):
        self.method, self.model = method, model

    def apply(self, df: DataFrame, score: str = "p") -> DataFrame:
        if self.method == "uncalibrated":
            return df
        if self.method == "isotonic":
            return self.model.apply(df, score)
        # two parameters only, so the fitted curve is a plain expression
        slope, shift = float(self.model.coefficients[0]), float(self.model.intercept)
        return df.withColumn(score, S.sigmoid(F.col(score) * slope + shift))


def fit_isotonic(df: DataFrame, roles: ScoreRoles = ScoreRoles()) -> Calibrator:
    """Isotonic fit on one weighted row per distinct score, which gives the same curve as all rows."""
    return Calibrator("isotonic", fit_isotonic_curve(score_counts(df, roles), roles.score))


def fit_platt(df: DataFrame, roles: ScoreRoles = ScoreRoles(), c: float = 1e6) -> Calibrator:
    """Logistic curve on the raw score with a nearly absent penalty, fitted on two weighted rows per distinct score."""
    stacked = score_counts(df, roles).select(
        F.array(F.col(roles.score).cast("double")).alias("_x"),
        F.inline(F.array(F.struct(F.lit(1.0).alias("_y"), F.col("pos").cast("double").alias("_w")),
                         F.struct(F.lit(0.0).alias("_y"), F.col("neg").cast("double").alias("_w")))),
    ).where("_w > 0")
    return Calibrator("platt", fit_logistic(stacked, "_x", "_y", "_w", c))


def calibrate(calib: DataFrame, test: DataFrame, roles: ScoreRoles = ScoreRoles()):
    """Fit all methods on ``calib``; return them with their metric panel on ``test``: ``(calibrators, panel)``."""
    fitted = {"uncalibrated": Calibrator("uncalibrated"), "isotonic": fit_isotonic(calib, roles), "platt": fit_platt(calib, roles)}
    scored = None
    for order, name in enumerate(METHODS):
        part = fitted[name].apply(test, roles.score).withColumns({"method": F.lit(name), "method_order": F.lit(order)})
        scored = part if scored is None else scored.unionByName(part)
    return fitted, metric_panel(scored, roles, by=["method", "method_order"])


def pick_method(panel: DataFrame) -> DataFrame:
    """The method with the lowest Brier score; earlier methods win ties."""
    return panel.agg(F.min_by("method", F.struct("brier", "method_order")).alias("method"), F.min("brier").alias("brier"))


def probability(column: str = "probability"):
    """Positive-class probability of an ML classifier's output."""
    return vector_to_array(F.col(column))[1]
