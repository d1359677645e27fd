"""Column roles: which column plays which part in an operator."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

# Names of the 11 condition flags of the claims preset.
CONDITION_FLAGS = (
    "chronic_alzheimer",
    "chronic_chf",
    "chronic_ckd",
    "chronic_cancer",
    "chronic_copd",
    "chronic_depression",
    "chronic_diabetes",
    "chronic_ihd",
    "chronic_osteoporosis",
    "chronic_ra_oa",
    "chronic_stroke",
)


@dataclass(frozen=True)
class EpisodeRoles:
    """One row per episode of an entity, with a start and an end date."""

    entity: str = "beneficiary_id"
    key: str = "claim_id"
    start: str = "admit_date"
    end: str = "discharge_date"


@dataclass(frozen=True)
class ScoreRoles:
    """One row per scored case: row key, label 0/1 and score."""

    key: str = "claim_id"
    label: str = "y"
    score: str = "p"


@dataclass(frozen=True)
class FeatureSpec:
    """Model features by role. The defaults are the claims preset: 9 + 13 + 5 + 2 = 29 columns."""

    numeric: tuple[str, ...] = (
        "los_days",
        "age_at_admit",
        "num_diagnoses",
        "num_procedures",
        "prior_6mo_inpatient_count",
        "days_since_last_discharge_imputed",
        "chronic_count",
        "admit_month",
        "admit_dow",
    )
    binary: tuple[str, ...] = ("is_weekend_admit", "has_prior_admit", *CONDITION_FLAGS)
    cat_low: tuple[str, ...] = ("sex", "race", "age_bin", "admit_dx_chapter", "state_code")
    cat_high: tuple[str, ...] = ("admit_dx_code", "drg_code")
    entity: str = "beneficiary_id"
    key: str = "claim_id"
    label: str = "y"
    extra_ids: tuple[str, ...] = field(default=("sample", "admit_date", "discharge_date", "admit_year"))

    def features(self) -> list[str]:
        return [*self.numeric, *self.binary, *self.cat_low, *self.cat_high]


def require_columns(df: DataFrame, columns) -> DataFrame:
    """Return ``df`` unchanged, or raise with the full list of missing columns."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def project_features(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Check that every feature is there and return them in the order of the spec."""
    return require_columns(df, spec.features()).select(*spec.features())
