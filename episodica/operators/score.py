"""Validation, scoring, and the deployable bundle of encoder, model, calibrator and threshold."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.functions import scalars as S
from episodica.operators.decide import Calibrator
from episodica.operators.isotonic import IsotonicCurve
from episodica.operators.linear import LinearModel
from episodica.operators.models import TrainedModel
from episodica.roles import CONDITION_FLAGS, FeatureSpec, require_columns

# Allowed range of each number in a scoring request (None = no upper limit).
RANGES = {
    "los_days": (0, None),
    "age_at_admit": (0, 120),
    "num_diagnoses": (0, None),
    "num_procedures": (0, None),
    "prior_6mo_inpatient_count": (0, None),
    "days_since_last_discharge_imputed": (0, None),
    "chronic_count": (0, 11),
    "admit_month": (1, 12),
    "admit_dow": (1, 7),
}


def failed_rules(ranges=None, required=()) -> Column:
    """Names of the rules a row breaks: ``<column>:required`` or ``<column>:range``."""
    ranges = RANGES if ranges is None else ranges
    checks = [F.when(F.col(c).isNull(), F.lit(f"{c}:required")) for c in dict.fromkeys([*ranges, *required])]
    for c, (low, high) in ranges.items():
        outside = F.col(c) < low
        if high is not None:
            outside = outside | (F.col(c) > high)
        checks.append(F.when(outside, F.lit(f"{c}:range")))
    return F.array_compact(F.array(*checks))


def validate(df: DataFrame, ranges=None, required=()) -> DataFrame:
    """Add ``failed``, the list of broken rules; an empty list means a valid row."""
    return df.withColumn("failed", failed_rules(ranges, required))


def split_valid(df: DataFrame, ranges=None, required=()) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and quarantined rows with their broken rules."""
    checked = validate(df, ranges, required)
    return checked.where(F.size("failed") == 0).drop("failed"), checked.where(F.size("failed") > 0)


def in_range(df: DataFrame, ranges: dict) -> tuple[DataFrame, DataFrame]:
    """Rows within all ranges, and the others with the ranges they break; NULL breaks none."""
    judged = df.withColumn("failed", F.filter(failed_rules(ranges), lambda rule: rule.endswith(":range")))
    return judged.where(F.size("failed") == 0).drop("failed"), judged.where(F.size("failed") > 0)


def add_request_fields(df: DataFrame, flags=CONDITION_FLAGS, age: str = "age_at_admit") -> DataFrame:
    """Fields derived from a request, with the bins the model was trained on."""
    return df.withColumns({"chronic_count": S.count_true(flags), "age_bin": S.age_band(age)})


def to_feature_types(df: DataFrame, spec: FeatureSpec = FeatureSpec()) -> DataFrame:
    """Check that all features are there and cast them by role; other columns stay in front."""
    require_columns(df, spec.features())
    others = [c for c in df.columns if c not in spec.features()]
    return df.select(
        *others,
        *[F.col(c).cast("double").alias(c) for c in spec.numeric],
        *[F.col(c).cast("boolean").alias(c) for c in spec.binary],
        *[F.col(c).cast("string").alias(c) for c in (*spec.cat_low, *spec.cat_high)],
    )


def decisions(scored: DataFrame, threshold: float, score: str = "p") -> DataFrame:
    """Decision (flag / skip) and risk band of each score."""
    hit = F.col(score) >= threshold
    return scored.withColumns(
        {
            "threshold": F.lit(float(threshold)),
            "decision": F.when(hit, "flag").otherwise("skip"),
            "risk_band": S.risk_band(score),
        }
    )


class Scorer:
    """Everything a new episode needs to be scored; stateless, so the same code runs batch and stream."""

    def __init__(self, trained: TrainedModel, calibrator: Calibrator, threshold: float, ranges: dict | None = None):
        self.trained, self.calibrator, self.threshold = trained, calibrator, threshold
        self.ranges = RANGES if ranges is None else ranges

    def checked(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows that may be scored, and those outside the allowed ranges with their broken rules.

        Only ranges are checked: the encoder has a place for missing values.
        """
        return in_range(df, {c: bounds for c, bounds in self.ranges.items() if c in df.columns})

    def score(self, df: DataFrame) -> DataFrame:
        """``(key, p, threshold, decision, risk_band)`` of the rows that pass :meth:`checked`, in batch and stream alike."""
        df, _ = self.checked(df)
        key = self.trained.encoder.spec.key
        raw = self.trained.transform(to_feature_types(df, self.trained.encoder.spec)).select(key, "p")
        return decisions(self.calibrator.apply(raw), self.threshold)

    def save(self, spark: SparkSession, path: str) -> None:
        self.trained.save(spark, path)
        if self.calibrator.model is not None:
            self.calibrator.model.save(spark, f"{path}/calibrator")
        facts = {"model": self.trained.name, "calibrator": self.calibrator.method, "threshold": self.threshold, "ranges": self.ranges}
        spark.createDataFrame([(json.dumps(facts),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/decision")

    @classmethod
    def load(cls, spark: SparkSession, path: str, spec: FeatureSpec = FeatureSpec()) -> "Scorer":
        facts = json.loads(spark.read.text(f"{path}/decision").first()[0])
        kinds = {"isotonic": IsotonicCurve, "platt": LinearModel}
        kind = kinds.get(facts["calibrator"])
        model = kind.load(spark, f"{path}/calibrator") if kind else None
        return cls(TrainedModel.load(spark, path, facts["model"], spec), Calibrator(facts["calibrator"], model), facts["threshold"], facts["ranges"])
