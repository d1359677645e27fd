"""From a feature table to a deployable scorer, and the audit of its decisions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.operators import audit as A
from episodica.operators import decide as D
from episodica.operators.metrics import quantile_reliability
from episodica.operators.models import TrainedModel
from episodica.operators.score import Scorer
from episodica.operators.splits import assign_halves
from episodica.roles import ScoreRoles
from episodica.sources.shared import store


@dataclass
class Calibration:
    scorer: Scorer
    panel: DataFrame
    sweep: DataFrame
    picked: DataFrame
    reliability: DataFrame
    test_scores: DataFrame


def calibrate_model(
    trained: TrainedModel, val: DataFrame, cost_fn: float = D.COST_FN, cost_fp: float = D.COST_FP, seed=42
) -> Calibration:
    """Halve the validation entities, fit the calibrators on one half, choose method and threshold on the other.

    The raw scores are written once; every later step reads them.
    """
    spec = trained.encoder.spec
    roles = ScoreRoles(spec.key, spec.label, "p")
    halves = assign_halves(val, spec.entity, spec.key, spec.label, seed)
    scores = trained.transform(halves).select(spec.entity, spec.key, spec.label, "half", "p")
    scores = store(scores, "calibration-scores")
    calib, test = scores.where("half = 'calib'"), scores.where("half = 'test'")
    fitted, panel = D.calibrate(calib, test, roles)
    panel = store(panel, "calibration-panel")
    best = fitted[D.pick_method(panel).first().method]
    calibrated = best.apply(test)
    sweep = D.cost_sweep(calibrated, roles, cost_fn=cost_fn, cost_fp=cost_fp)
    picked = D.with_baselines(D.pick_threshold(sweep), cost_fn, cost_fp)
    threshold = float(picked.first().threshold)
    both = test.withColumn("stage", F.lit("before")).unionByName(calibrated.withColumn("stage", F.lit("after")))
    reliability = quantile_reliability(both, roles, ["stage"])
    return Calibration(Scorer(trained, best, threshold), panel, sweep, picked, reliability, calibrated)


def audit_model(calibration: Calibration, rows: DataFrame, attributes=A.ATTRIBUTES):
    """Slice table and parity gaps of the decisions on the test half: ``(audited rows, slices, gaps)``."""
    spec = calibration.scorer.trained.encoder.spec
    decided = calibration.test_scores.withColumn("yhat", (F.col("p") >= calibration.scorer.threshold).cast("int"))
    audited = store(decided.drop(spec.entity).join(rows.select(spec.key, *attributes), spec.key), "audit-rows")
    roles = ScoreRoles(spec.key, spec.label, "p")
    slices = A.slice_metrics(audited, roles=roles, attributes=attributes)
    gaps = A.parity_gaps(A.decision_counts(audited, "yhat", spec.label, attributes))
    return audited, slices, gaps
