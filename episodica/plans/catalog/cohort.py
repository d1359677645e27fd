"""Sources, row-local expressions, joins and the cohort itself."""

from __future__ import annotations

from pyspark.sql import functions as F

from episodica.functions import scalars as S
from episodica.functions.joins import salted_join

from episodica.operators import cohort as C
from episodica.operators import score as O
from episodica.plans import claims as P
from episodica.plans import views as V
from episodica.plans.catalog.registry import query, rnd
from episodica.roles import CONDITION_FLAGS, EpisodeRoles

ROLES = EpisodeRoles("id", "claim", "a", "d")


@query("a4_keep_list", f"WITH {V.RAW} SELECT {', '.join(P.CLAIM_COLUMNS)} FROM raw")
def keep_list(spark, sf):
    return V.raw_claims(spark, sf).select(*P.CLAIM_COLUMNS)


_DATES = ("CLM_FROM_DT", "CLM_THRU_DT", "CLM_ADMSN_DT", "NCH_BENE_DSCHRG_DT")


@query("b1_parse_dates", f"WITH {V.RAW} SELECT CLM_ID, {', '.join(V.day_sql(c) + ' AS ' + c for c in _DATES)} FROM raw")
def parse_dates(spark, sf):
    return V.raw_claims(spark, sf).select("CLM_ID", *[S.parse_yyyymmdd(c).alias(c) for c in _DATES])


@query("b2_date_fallback", f"WITH {V.CLAIMS} SELECT claim_id, admit_date, discharge_date FROM parsed")
def date_fallback(spark, sf):
    raw = V.raw_claims(spark, sf)
    return raw.select(
        F.col("CLM_ID").alias("claim_id"),
        F.coalesce(S.parse_yyyymmdd("CLM_ADMSN_DT"), S.parse_yyyymmdd("CLM_FROM_DT")).alias("admit_date"),
        F.coalesce(S.parse_yyyymmdd("NCH_BENE_DSCHRG_DT"), S.parse_yyyymmdd("CLM_THRU_DT")).alias("discharge_date"),
    )


@query("b3_day_differences", f"WITH {V.LAB} SELECT claim, d - a AS los_days, days_to_next, days_since_last FROM lab")
def day_differences(spark, sf):
    return V.labelled(spark, sf).select("claim", S.days_between("a", "d").alias("los_days"), "days_to_next", "days_since_last")


@query(
    "b4_calendar_parts",
    f"WITH {V.ENC} SELECT claim, CAST(year(a) AS BIGINT) AS yr, CAST(month(a) AS BIGINT) AS mon, CAST(isodow(a) AS BIGINT) AS dow FROM enc",
)
def calendar_parts(spark, sf):
    return V.encounters(spark, sf).select("claim", F.year("a").alias("yr"), F.month("a").alias("mon"), S.iso_weekday("a").alias("dow"))


@query("b5_weekend", f"WITH {V.ENC} SELECT claim, isodow(a) >= 6 AS is_weekend FROM enc")
def weekend(spark, sf):
    return V.encounters(spark, sf).select("claim", S.is_weekend("a").alias("is_weekend"))


@query(
    "b6_drop_missing_dates",
    f"WITH {V.CLAIMS} SELECT (SELECT count(*) FROM parsed) AS n_before, (SELECT count(*) FROM claims) AS n_after",
)
def drop_missing_dates(spark, sf):
    raw, kept = V.raw_claims(spark, sf), P.parse_claims(V.raw_claims(spark, sf))
    return kept.agg(raw.select(F.count(F.lit(1))).scalar().alias("n_before"), F.count(F.lit(1)).alias("n_after"))


@query("b7_present_counts", f"WITH {V.CLAIMS} SELECT claim_id, num_diagnoses, num_procedures FROM parsed")
def present_counts(spark, sf):
    return V.raw_claims(spark, sf).select(
        F.col("CLM_ID").alias("claim_id"),
        S.count_present(P.DX_COLUMNS).alias("num_diagnoses"),
        S.count_present(P.PROCEDURE_COLUMNS).alias("num_procedures"),
    )


@query("b8_dx_chapter", f"WITH {V.ENC} SELECT claim, dx, {V.chapter_sql('dx')} AS chapter FROM enc")
def dx_chapter(spark, sf):
    return V.encounters(spark, sf).select("claim", "dx", S.dx_chapter("dx").alias("chapter"))


@query(
    "b9_lenient_casts",
    f"WITH {V.SNAP} SELECT DESYNPUF_ID, year::BIGINT AS year, TRY_CAST(SP_STATE_CODE AS BIGINT) AS state_code, TRY_CAST(BENE_RACE_CD AS BIGINT) AS race_code FROM snapraw",
)
def lenient_casts(spark, sf):
    snaps = V.raw_snapshots(spark, sf)
    return snaps.select(
        "DESYNPUF_ID", "year", F.col("SP_STATE_CODE").try_cast("int").alias("state_code"), F.col("BENE_RACE_CD").try_cast("int").alias("race_code")
    )


@query(
    "b10_code_labels",
    f"""WITH {V.SNAPS} SELECT beneficiary_id, snapshot_year::BIGINT AS snapshot_year,
 CASE sex_code WHEN 1 THEN 'Male' WHEN 2 THEN 'Female' ELSE 'Unknown' END AS sex,
 CASE race_code WHEN 1 THEN 'White' WHEN 2 THEN 'Black' WHEN 3 THEN 'Other' WHEN 5 THEN 'Hispanic' ELSE 'Unknown' END AS race FROM snaps""",
)
def code_labels(spark, sf):
    snaps = P.parse_snapshots(V.raw_snapshots(spark, sf))
    return snaps.select(
        "beneficiary_id", "snapshot_year", S.map_code("sex_code", S.SEX_LABELS).alias("sex"), S.map_code("race_code", S.RACE_LABELS).alias("race")
    )


@query("b11_flag_decode", f"WITH {V.SNAPS} SELECT beneficiary_id, snapshot_year::BIGINT AS snapshot_year, {', '.join(CONDITION_FLAGS)} FROM snaps")
def flag_decode(spark, sf):
    return P.parse_snapshots(V.raw_snapshots(spark, sf)).select("beneficiary_id", "snapshot_year", *CONDITION_FLAGS)


@query("b12_age", f"WITH {V.FLAGGED} SELECT claim_id, age_at_admit FROM flagged")
def age(spark, sf):
    return V.flagged(spark, sf).select("claim_id", "age_at_admit")


@query("b13_return_label", f"WITH {V.LAB} SELECT claim, days_to_next, y::BIGINT AS y FROM lab")
def return_label(spark, sf):
    return V.build_labelled(spark, sf).select("claim", "days_to_next", "y")


@query("b14_age_band", f"WITH {V.FLAGGED} SELECT claim_id, age_bin FROM flagged")
def age_band(spark, sf):
    flagged = V.flagged(spark, sf)
    return flagged.select("claim_id", S.age_band("age_at_admit").alias("age_bin"))


_EXCL = ", ".join(f"excl_{n}" for n in C.EXCLUSIONS)


@query("b15_exclusions", f"WITH {V.FLAGGED} SELECT claim_id, {_EXCL}, {V.INCLUDED} AS kept FROM flagged")
def exclusions(spark, sf):
    flagged = V.build_flagged(spark, sf)
    names = [f"excl_{n}" for n in C.EXCLUSIONS]
    kept = ~F.expr(" OR ".join(names))
    return flagged.select("claim_id", *names, kept.alias("kept"))


@query("b16_date_offset", f"WITH {V.ENC} SELECT claim, d + 30 AS horizon_end FROM enc")
def date_offset(spark, sf):
    return V.encounters(spark, sf).select("claim", F.date_add("d", 30).alias("horizon_end"))


@query("b17_cohort", f"WITH {V.COH} SELECT * FROM coh")
def cohort(spark, sf):
    """Flagship: raw text claims and snapshots to the finished cohort."""
    return P.build_cohort(V.raw_claims(spark, sf), V.raw_snapshots(spark, sf))


@query("b18_flag_count", f"WITH {V.FEAT} SELECT claim_id, chronic_count FROM feat")
def flag_count(spark, sf):
    return V.cohort(spark, sf).select("claim_id", S.count_true(CONDITION_FLAGS).alias("chronic_count"))


@query("b19_gap_impute", f"WITH {V.FEAT} SELECT claim_id, has_prior_admit, days_since_last_discharge_imputed FROM feat")
def gap_impute(spark, sf):
    return V.features(spark, sf).select("claim_id", "has_prior_admit", "days_since_last_discharge_imputed")


@query("b21_score_clip", f"WITH {V.SCORED} SELECT claim, {rnd('greatest(least(p, 1 - 1e-7), 1e-7)', 'p')} FROM sc")
def score_clip(spark, sf):
    return V.scored(spark, sf).select("claim", S.clip_score("p").alias("p"))


@query(
    "b22_value_clip",
    f"WITH {V.COH} SELECT claim_id, least(greatest(los_days, 0) + 1, 60) AS los_capped, least(prior_6mo_inpatient_count, 6) AS prior_capped FROM coh",
)
def value_clip(spark, sf):
    los = S.clamp(S.clamp("los_days", low=0) + 1, high=60)
    return V.cohort(spark, sf).select("claim_id", los.alias("los_capped"), S.clamp("prior_6mo_inpatient_count", high=6).alias("prior_capped"))


@query(
    "b23_decision",
    f"WITH {V.SCORED} SELECT claim, CAST(p >= 0.3 AS BIGINT) AS yhat, CASE WHEN p >= 0.3 THEN 'flag' ELSE 'skip' END AS decision FROM sc",
)
def decision(spark, sf):
    rows = V.scored(spark, sf).withColumn("yhat", S.decide("p", 0.3))
    return O.decisions(rows, 0.3).select("claim", "yhat", "decision")


@query(
    "b24_risk_band",
    f"WITH {V.SCORED} SELECT claim, CASE WHEN p < 0.05 THEN 'low' WHEN p < 0.15 THEN 'moderate' WHEN p < 0.35 THEN 'high' ELSE 'very_high' END AS risk_band FROM sc",
)
def risk_band(spark, sf):
    return V.scored(spark, sf).select("claim", S.risk_band("p").alias("risk_band"))


# the ranges are narrowed so that the given rows break some of them
_CHECKS = {"los_days": (1, 7), "age_at_admit": (30, 90), "chronic_count": (1, 4), "admit_month": (1, 12), "admit_dow": (1, 7)}
_CHECK_SQL = " || ".join(
    ["CASE WHEN days_since_last_discharge IS NULL THEN 'days_since_last_discharge:required;' ELSE '' END"]
    + [f"CASE WHEN {c} < {lo} OR {c} > {hi} THEN '{c}:range;' ELSE '' END" for c, (lo, hi) in _CHECKS.items()]
)


@query("b25_validation", f"WITH {V.FEAT} SELECT claim_id, {_CHECK_SQL} AS failed FROM feat")
def validation(spark, sf):
    """Broken rules of each row; valid and quarantined rows are put together again."""
    valid, rejected = O.split_valid(V.features(spark, sf), _CHECKS, ["days_since_last_discharge"])
    both = valid.withColumn("failed", F.array().cast("array<string>")).unionByName(rejected)
    return both.select("claim_id", F.array_join(F.transform("failed", lambda x: F.concat(x, F.lit(";"))), "").alias("failed"))


@query(
    "b26_name_cleanup",
    """SELECT p_partkey, regexp_replace(name, '^(num|bin|cat_low|cat_high)__', '') AS feature, split_part(p_name, ' ', 1) AS head FROM (
  SELECT *, CASE p_partkey % 4 WHEN 0 THEN 'num__' WHEN 1 THEN 'bin__' WHEN 2 THEN 'cat_low__' ELSE '' END || p_name AS name FROM part)""",
)
def name_cleanup(spark, sf):
    part = V.table(spark, sf, "part")
    prefix = S.map_code(F.col("p_partkey") % 4, {0: "num__", 1: "bin__", 2: "cat_low__"}, "")
    named = part.withColumn("name", F.concat(prefix, "p_name"))
    return named.select("p_partkey", S.strip_prefix("name").alias("feature"), F.split_part("p_name", F.lit(" "), F.lit(1)).alias("head"))


@query(
    "b27_month_range",
    f"WITH {V.ENC} SELECT claim, CAST(date_trunc('month', a) AS DATE) AS month FROM enc WHERE date_trunc('month', a) BETWEEN DATE '1996-01-01' AND DATE '1998-12-01'",
)
def month_range(spark, sf):
    rows = V.encounters(spark, sf).select("claim", F.trunc("a", "month").alias("month"))
    return rows.where(F.col("month").between(F.lit("1996-01-01").cast("date"), F.lit("1998-12-01").cast("date")))


@query(
    "b28_fixed_width_bins",
    f"WITH {V.COH} SELECT claim_id, CAST(floor((age_at_admit - 20) / 5) * 5 + 20 AS BIGINT) AS bin_low, floor((age_at_admit - 20) / 5) * 5 + 22.5::DOUBLE AS centre FROM coh WHERE age_at_admit >= 20 AND age_at_admit < 105",
)
def fixed_width_bins(spark, sf):
    rows = V.cohort(spark, sf).where("age_at_admit >= 20 AND age_at_admit < 105")
    low = S.fixed_width_bin("age_at_admit", 20, 5)
    return rows.select("claim_id", low.alias("bin_low"), (low + F.lit(2.5)).alias("centre"))


@query(
    "b31_rounded_share",
    f"WITH {V.LAB} SELECT grp, coalesce(round(CAST(sum(y) AS DOUBLE) / nullif(count(*), 0), 6), 0.0) AS positive_rate FROM lab GROUP BY grp",
)
def rounded_share(spark, sf):
    counts = V.labelled(spark, sf).groupBy("grp").agg(F.sum("y").alias("k"), F.count(F.lit(1)).alias("n"))
    return counts.select("grp", S.share("k", "n").alias("positive_rate"))


def wilson_sql(k: str = "k", n: str = "n") -> str:
    """``low`` and ``high`` of the Wilson interval (z = 1.96)."""
    z2 = "(1.96::DOUBLE * 1.96::DOUBLE)"
    p, m = f"(CAST({k} AS DOUBLE) / {n})", f"CAST({n} AS DOUBLE)"
    mid = f"({p} + {z2} / (2.0 * {m}))"
    half = f"(1.96::DOUBLE * sqrt({p} * (1 - {p}) / {m} + {z2} / (4.0 * {m} * {m})))"
    scale = f"(1 + {z2} / {m})"
    return f"{rnd(f'greatest(0, least(1, ({mid} - {half}) / {scale}))', 'low')}, {rnd(f'greatest(0, least(1, ({mid} + {half}) / {scale}))', 'high')}"


@query("b32_wilson", f"WITH {V.LAB}, g AS (SELECT id, sum(y)::BIGINT AS k, count(*) AS n FROM lab GROUP BY id) SELECT id, k, n, {wilson_sql()} FROM g")
def wilson(spark, sf):
    counts = V.labelled(spark, sf).groupBy("id").agg(F.sum("y").alias("k"), F.count(F.lit(1)).alias("n"))
    low, high = S.wilson_bounds("k", "n")
    return counts.select("id", "k", "n", low.alias("low"), high.alias("high"))


@query("b33_sigmoid", f"WITH {V.SCORED} SELECT claim, {rnd('1 / (1 + exp(-(4 * p - 2)))', 'q')} FROM sc")
def sigmoid(spark, sf):
    return V.scored(spark, sf).select("claim", S.sigmoid(4 * F.col("p") - 2).alias("q"))


# ---------------------------------------------------------------- joins
@query(
    "c2_year_join",
    f"""WITH {V.CLAIMS}, {V.SNAPS} SELECT c.claim_id, s.birth_date, s.state_code::BIGINT AS state_code, s.beneficiary_id IS NOT NULL AS matched
FROM claims c LEFT JOIN snaps s ON s.beneficiary_id = c.beneficiary_id AND s.sample = c.sample AND s.snapshot_year = c.admit_year""",
)
def year_join(spark, sf):
    claims = P.parse_claims(V.raw_claims(spark, sf)).select("claim_id", "beneficiary_id", "sample", "admit_year")
    snaps = P.parse_snapshots(V.raw_snapshots(spark, sf)).withColumn("matched", F.lit(True))
    side = snaps.select("beneficiary_id", "sample", F.col("snapshot_year").alias("admit_year"), "birth_date", "state_code", "matched")
    joined = salted_join(claims, side, ["beneficiary_id", "sample", "admit_year"], "left", "claim_id", shuffled=True)
    return joined.select("claim_id", "birth_date", "state_code", F.coalesce("matched", F.lit(False)).alias("matched"))


@query(
    "c3_latest_year_fallback",
    f"WITH {V.FLAGGED} SELECT claim_id, birth_date, death_date, sex_code::BIGINT AS sex_code, state_code::BIGINT AS state_code, chronic_chf FROM attached",
)
def latest_year_fallback(spark, sf):
    flagged = V.build_flagged(spark, sf)
    return flagged.select("claim_id", "birth_date", "death_date", "sex_code", "state_code", "chronic_chf")


@query("c8_global_max_date", f"WITH {V.ENC} SELECT claim, d + 30 > (SELECT max(a) FROM enc) AS censored FROM enc")
def global_max_date(spark, sf):
    rows = V.encounters(spark, sf)
    return rows.select("claim", (F.date_add("d", 30) > rows.select(F.max("a")).scalar()).alias("censored"))


@query("c9_audit_attributes", f"WITH {V.AUD} SELECT claim_id, sex, race, age_bin, {rnd('p', 'p')} FROM aud")
def audit_attributes(spark, sf):
    """Scores meet the audited attributes by key."""
    attributes = V.cohort(spark, sf).select("claim_id", "sex", "race", "age_bin")
    keyed = V.encounters(spark, sf).select(F.col("claim").cast("string").alias("claim_id"), V.score_columns()["m1"].alias("p"))
    return attributes.join(keyed, "claim_id")


# ---------------------------------------------------------------- order within the entity
@query("e1_next_start", f"WITH {V.LAB} SELECT claim, next_start FROM lab")
def next_start(spark, sf):
    return C.with_sequence(V.encounters(spark, sf), ROLES).select("claim", "next_start")


@query("e2_previous_end", f"WITH {V.LAB} SELECT claim, prev_end FROM lab")
def previous_end(spark, sf):
    return C.with_sequence(V.encounters(spark, sf), ROLES).select("claim", "prev_end")


@query("f1_sequence_order", f"WITH {V.LAB} SELECT claim, next_start, prev_end, prior_count FROM lab")
def sequence_order(spark, sf):
    """Everything that depends on the order within the entity, without a global sort."""
    return C.with_sequence(V.encounters(spark, sf), ROLES).select("claim", "next_start", "prev_end", "prior_count")


@query("e3_prior_180d_count", f"WITH {V.LAB} SELECT claim, prior_count FROM lab")
def prior_count(spark, sf):
    return C.with_sequence(V.encounters(spark, sf), ROLES).select("claim", "prior_count")


@query(
    "c1_window_count_join",
    f"WITH {V.LAB} SELECT id, a, max(prior_count) + 1 AS n_in_window, count(*) AS n_rows FROM lab GROUP BY id, a",
)
def window_count_join(spark, sf):
    """Look-back counts are unique per (entity, day), so putting them back fans no row out."""
    rows = C.with_sequence(V.encounters(spark, sf), ROLES)
    return rows.groupBy("id", "a").agg((F.max("prior_count") + 1).alias("n_in_window"), F.count(F.lit(1)).alias("n_rows"))


@query(
    "e4_latest_record",
    f"WITH {V.SNAPS} SELECT beneficiary_id, sample::BIGINT AS sample, snapshot_year::BIGINT AS snapshot_year, birth_date, state_code::BIGINT AS state_code FROM snaps QUALIFY row_number() OVER (PARTITION BY beneficiary_id, sample ORDER BY snapshot_year DESC) = 1",
)
def latest_record(spark, sf):
    snaps = P.parse_snapshots(V.raw_snapshots(spark, sf))
    return C.latest_record(snaps, ["beneficiary_id", "sample"], "snapshot_year", ["snapshot_year", "birth_date", "state_code"])


# ---------------------------------------------------------------- summaries of the cohort
@query(
    "d3_cohort_summary",
    f"""WITH {V.COH} SELECT count(*) AS n_encounters, count(DISTINCT beneficiary_id) AS n_beneficiaries, sum(y)::BIGINT AS positive_count,
 count(DISTINCT sample) AS n_samples_present, min(admit_year) AS admit_year_min, max(admit_year) AS admit_year_max,
 round(sum(y)::DOUBLE / count(*), 6) AS positive_rate, median(los_days)::DOUBLE AS median_los, median(age_at_admit)::DOUBLE AS median_age,
 (SELECT count(*) FROM flagged) - count(*) AS n_dropped_total FROM coh""",
)
def cohort_summary(spark, sf):
    before = P.parse_claims(V.raw_claims(spark, sf)).select(F.count(F.lit(1))).scalar()
    return C.cohort_summary(V.cohort(spark, sf), before)


@query(
    "d4_attrition",
    f"WITH {V.FLAGGED} SELECT 'total' AS reason, count(*) AS n FROM flagged UNION ALL SELECT 'dropped', count(*) - count(*) FILTER (WHERE {V.INCLUDED}) FROM flagged"
    + "".join(f" UNION ALL SELECT '{n}', count(*) FILTER (WHERE excl_{n}) FROM flagged" for n in C.EXCLUSIONS),
)
def attrition(spark, sf):
    return C.attrition(V.flagged(spark, sf))


@query(
    "g1_relaxed_concat",
    "SELECT c_custkey::BIGINT AS k, c_name AS name, c_acctbal AS bal, c_mktsegment AS seg FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier",
)
def relaxed_concat(spark, sf):
    customers = V.table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("seg"))
    suppliers = V.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("bal"))
    return customers.unionByName(suppliers, allowMissingColumns=True)


@query("o4_request_fields", f"WITH {V.FEAT} SELECT claim_id, chronic_count, age_bin FROM feat")
def request_fields(spark, sf):
    rows = V.cohort(spark, sf).drop("age_bin")
    return O.add_request_fields(rows).select("claim_id", "chronic_count", "age_bin")
