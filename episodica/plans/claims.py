"""Claims preset: raw all-text claim and snapshot frames to the cohort and the feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.functions import scalars as S
from episodica.functions.joins import key_counts
from episodica.operators import cohort as C
from episodica.operators.splits import assign_splits
from episodica.roles import CONDITION_FLAGS, EpisodeRoles, FeatureSpec, require_columns
from episodica.sources.shared import store

# Column names of the public synthetic claim files that the preset reads.
DX_COLUMNS = tuple(f"ICD9_DGNS_CD_{i}" for i in range(1, 11))
PROCEDURE_COLUMNS = tuple(f"ICD9_PRCDR_CD_{i}" for i in range(1, 7))
CLAIM_COLUMNS = (
    "DESYNPUF_ID",
    "CLM_ID",
    "CLM_FROM_DT",
    "CLM_THRU_DT",
    "PRVDR_NUM",
    "CLM_ADMSN_DT",
    "ADMTNG_ICD9_DGNS_CD",
    "CLM_DRG_CD",
    "CLM_UTLZTN_DAY_CNT",
    "NCH_BENE_DSCHRG_DT",
    *DX_COLUMNS,
    *PROCEDURE_COLUMNS,
)
FLAG_COLUMNS = (
    "SP_ALZHDMTA",
    "SP_CHF",
    "SP_CHRNKIDN",
    "SP_CNCR",
    "SP_COPD",
    "SP_DEPRESSN",
    "SP_DIABETES",
    "SP_ISCHMCHT",
    "SP_OSTEOPRS",
    "SP_RA_OA",
    "SP_STRKETIA",
)
SNAPSHOT_COLUMNS = (
    "DESYNPUF_ID",
    "BENE_BIRTH_DT",
    "BENE_DEATH_DT",
    "BENE_SEX_IDENT_CD",
    "BENE_RACE_CD",
    "SP_STATE_CODE",
    *FLAG_COLUMNS,
)

ROLES = EpisodeRoles()
ATTRIBUTES = ("birth_date", "death_date", "sex_code", "race_code", "state_code", *CONDITION_FLAGS)
COHORT_COLUMNS = (
    "beneficiary_id",
    "claim_id",
    "sample",
    "admit_date",
    "discharge_date",
    "admit_year",
    "los_days",
    "age_at_admit",
    "age_bin",
    "sex",
    "race",
    "state_code",
    "admit_dx_chapter",
    "admit_dx_code",
    "drg_code",
    "num_diagnoses",
    "num_procedures",
    *CONDITION_FLAGS,
    "prior_6mo_inpatient_count",
    "days_since_last_discharge",
    "y",
)


def type_claims(raw: DataFrame) -> DataFrame:
    """Claim rows with typed columns, before any row is dropped."""
    require_columns(raw, [*(c for c in CLAIM_COLUMNS if c not in ("PRVDR_NUM", "CLM_UTLZTN_DAY_CNT")), "sample"])
    start = F.coalesce(S.parse_yyyymmdd("CLM_ADMSN_DT"), S.parse_yyyymmdd("CLM_FROM_DT"))
    end = F.coalesce(S.parse_yyyymmdd("NCH_BENE_DSCHRG_DT"), S.parse_yyyymmdd("CLM_THRU_DT"))
    return raw.select(
        F.col("DESYNPUF_ID").alias("beneficiary_id"),
        F.col("CLM_ID").alias("claim_id"),
        "sample",
        start.alias("admit_date"),
        end.alias("discharge_date"),
        S.dx_chapter("ADMTNG_ICD9_DGNS_CD").alias("admit_dx_chapter"),
        F.col("ADMTNG_ICD9_DGNS_CD").alias("admit_dx_code"),
        F.col("CLM_DRG_CD").alias("drg_code"),
        S.count_present(DX_COLUMNS).alias("num_diagnoses"),
        S.count_present(PROCEDURE_COLUMNS).alias("num_procedures"),
    )


def dated_claims(typed: DataFrame) -> DataFrame:
    """Rows with both dates, plus length of stay and year."""
    return typed.dropna(subset=["admit_date", "discharge_date"]).withColumns(
        {"los_days": S.days_between("admit_date", "discharge_date"), "admit_year": F.year("admit_date")}
    )


def parse_claims(raw: DataFrame) -> DataFrame:
    """Typed claim rows; rows without a start or an end date are dropped."""
    return dated_claims(type_claims(raw))


def parse_snapshots(raw: DataFrame) -> DataFrame:
    """Typed yearly snapshots with decoded flags."""
    return raw.select(
        F.col("DESYNPUF_ID").alias("beneficiary_id"),
        "sample",
        F.col("year").alias("snapshot_year"),
        S.parse_yyyymmdd("BENE_BIRTH_DT").alias("birth_date"),
        S.parse_yyyymmdd("BENE_DEATH_DT").alias("death_date"),
        F.col("BENE_SEX_IDENT_CD").try_cast("int").alias("sex_code"),
        F.col("BENE_RACE_CD").try_cast("int").alias("race_code"),
        F.col("SP_STATE_CODE").try_cast("int").alias("state_code"),
        *[S.decode_flag(raw_name).alias(name) for raw_name, name in zip(FLAG_COLUMNS, CONDITION_FLAGS)],
    )


def flagged_episodes(raw_claims: DataFrame, raw_snapshots: DataFrame) -> DataFrame:
    """All episodes with label, history, attributes and exclusion flags, before anything is dropped.

    The typed claims are written to the shared folder first: four branches of the plan need them, each
    with other columns, and text should be read and parsed once only.  The date filter then reaches
    the scan of that table instead of parsing every date a second time.
    """
    claims = dated_claims(store(type_claims(raw_claims), "claims"))
    labelled = C.with_return_label(C.with_sequence(claims, ROLES), ROLES)
    joined = C.attach_snapshot(
        labelled,
        parse_snapshots(raw_snapshots),
        keys=["beneficiary_id", "sample"],
        fact_year="admit_year",
        snapshot_year="snapshot_year",
        columns=ATTRIBUTES,
        anchor="birth_date",
        spread="claim_id",
        counts=key_counts(claims, ["beneficiary_id", "sample"]),
    )
    typed = joined.withColumn("age_at_admit", S.age_in_years("birth_date", "admit_date")).withColumns(
        {
            "age_bin": S.age_band("age_at_admit"),
            "sex": S.map_code("sex_code", S.SEX_LABELS),
            "race": S.map_code("race_code", S.RACE_LABELS),
            "prior_6mo_inpatient_count": F.col("prior_count"),
            "days_since_last_discharge": F.col("days_since_last"),
        }
    )
    return C.exclusion_flags(typed, ROLES, last_observed=claims.select(F.max("admit_date")).scalar())


def build_cohort(raw_claims: DataFrame, raw_snapshots: DataFrame) -> DataFrame:
    """The cohort: one row per included index episode, 31 columns."""
    return C.keep_included(flagged_episodes(raw_claims, raw_snapshots)).select(*COHORT_COLUMNS)


def derive_features(cohort: DataFrame) -> DataFrame:
    return S.add_derived_features(cohort, CONDITION_FLAGS)


def build_features(cohort: DataFrame, spec: FeatureSpec = FeatureSpec(), seed: int = 42) -> DataFrame:
    """Cohort plus derived features plus the entity-level split; all features are checked to be there.

    The cohort is stored once: the split reads it several times.
    """
    featured = assign_splits(derive_features(store(cohort, "cohort")), spec.entity, spec.key, spec.label, seed=seed)
    require_columns(featured, spec.features())
    return featured
