"""Claims-shaped views over the given tables, and the same views as SQL for the checks.

Orders become claims (customer = entity, order = claim) and customers become yearly snapshots.  Dates
are written as text with gaps and errors so that parsing, fallbacks and NULL rules have work to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.operators.cohort import keep_included, with_return_label, with_sequence
from episodica.plans import claims as P
from episodica.roles import CONDITION_FLAGS, EpisodeRoles
from episodica.sources.shared import shared_path

FIRST_YEAR, LAST_YEAR = 1995, 2000


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ---------------------------------------------------------------- episodes straight from orders
def encounters(spark: SparkSession, sf: str) -> DataFrame:
    """``(id, claim, a, d, dx, grp)``."""
    k = F.col("o_orderkey")
    a = F.col("o_orderdate").cast("date")
    base = F.lpad((k % 1000).cast("string"), 3, "0")
    dx = (
        F.when(k % 23 == 0, F.lit(None).cast("string"))
        .when(k % 19 == 0, F.concat(F.lit("E"), base))
        .when(k % 17 == 0, F.concat(F.lit("V"), base))
        .otherwise(base)
    )
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("id"),
        k.alias("claim"),
        a.alias("a"),
        F.date_add(a, (k % 9).cast("int")).alias("d"),
        dx.alias("dx"),
        F.col("o_orderpriority").alias("grp"),
    )


ENC = """enc AS (
  SELECT o_custkey AS id, o_orderkey AS claim, CAST(o_orderdate AS DATE) AS a,
         CAST(o_orderdate AS DATE) + CAST(o_orderkey % 9 AS INTEGER) AS d,
         CASE WHEN o_orderkey % 23 = 0 THEN NULL
              WHEN o_orderkey % 19 = 0 THEN 'E' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0')
              WHEN o_orderkey % 17 = 0 THEN 'V' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0')
              ELSE lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') END AS dx,
         o_orderpriority AS grp
  FROM orders)"""

LAB = f"""{ENC}, seq AS (
  SELECT *, lead(a) OVER w AS next_start, lag(d) OVER w AS prev_end,
         count(*) OVER (PARTITION BY id ORDER BY a RANGE BETWEEN INTERVAL 179 DAYS PRECEDING AND CURRENT ROW) - 1 AS prior_count
  FROM enc WINDOW w AS (PARTITION BY id ORDER BY a, d, claim)),
lab AS (
  SELECT *, next_start - d AS days_to_next, a - prev_end AS days_since_last,
         CASE WHEN next_start - d > 0 AND next_start - d <= 30 THEN 1 ELSE 0 END AS y
  FROM seq)"""

# ---------------------------------------------------------------- raw claims and snapshots, all text


def raw_claims(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("claim")
    day = lambda c: F.date_format(c, "yyyyMMdd")
    null = F.lit(None).cast("string")
    d = F.when(k % 97 == 0, F.date_add("d", 400)).otherwise(F.col("d"))
    e = encounters(spark, sf).withColumn("d", d)
    admitted = (
        F.when(k % 31 == 0, F.lit("20091332")).when(k % 29 == 0, F.lit("")).when(k % 5 == 0, null)
        .when(k % 41 == 0, F.concat(F.lit(" "), day("a"))).otherwise(day("a"))
    )
    code = lambda i: F.when(k % 10 >= i - 1, F.lpad(((k * i) % 1000).cast("string"), 3, "0"))
    procedure = lambda i: F.when(k % 7 >= i, F.lpad(((k + i) % 100).cast("string"), 2, "0"))
    columns = {
        "DESYNPUF_ID": F.col("id").cast("string"),
        "CLM_ID": k.cast("string"),
        "CLM_FROM_DT": F.when(k % 101 != 0, day("a")),
        "CLM_THRU_DT": day("d"),
        "PRVDR_NUM": F.concat(F.lit("P"), (k % 50).cast("string")),
        "CLM_ADMSN_DT": admitted,
        "ADMTNG_ICD9_DGNS_CD": F.col("dx"),
        "CLM_DRG_CD": F.lpad((k % 37).cast("string"), 3, "0"),
        "CLM_UTLZTN_DAY_CNT": F.datediff("d", "a").cast("string"),
        "NCH_BENE_DSCHRG_DT": F.when(k % 7 != 0, day("d")),
        **{c: code(i + 1) for i, c in enumerate(P.DX_COLUMNS)},
        **{c: procedure(i + 1) for i, c in enumerate(P.PROCEDURE_COLUMNS)},
    }
    return e.select(*[v.alias(c) for c, v in columns.items()], (F.col("id") % 3 + 1).cast("int").alias("sample"))


def raw_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("c_custkey")
    yr = F.col("year")
    null = F.lit(None).cast("string")
    years = table(spark, sf, "customer").select("c_custkey", F.explode(F.sequence(F.lit(FIRST_YEAR), F.lit(LAST_YEAR))).alias("year"))
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    birth = F.concat((1910 + (c * 13) % 85).cast("string"), two(1 + c % 12), two(1 + c % 28))
    died = F.date_add(F.lit("1996-01-01").cast("date"), ((c * 37) % 1800).cast("int"))
    flag = lambda i: (
        F.when((c + i) % 37 == 0, null).when((c * i + yr) % 4 == 0, F.lit("1")).otherwise(F.lit("2"))
    )
    columns = {
        "DESYNPUF_ID": c.cast("string"),
        "BENE_BIRTH_DT": F.when(((c + yr) % 7 == 0) | (c % 53 == 0), null).otherwise(birth),
        "BENE_DEATH_DT": F.when(c % 11 == 0, F.date_format(died, "yyyyMMdd")),
        "BENE_SEX_IDENT_CD": (1 + c % 3).cast("string"),
        "BENE_RACE_CD": F.when(c % 43 == 0, null).otherwise((c % 6).cast("string")),
        "SP_STATE_CODE": F.when(c % 47 == 0, F.lit("XX")).otherwise((c % 54).cast("string")),
        **{name: flag(i + 1) for i, name in enumerate(P.FLAG_COLUMNS)},
    }
    return years.select(*[v.alias(n) for n, v in columns.items()], (c % 3 + 1).cast("int").alias("sample"), "year")


_CODES = ",\n         ".join(
    [f"CASE WHEN claim % 10 >= {i - 1} THEN lpad(CAST((claim * {i}) % 1000 AS VARCHAR), 3, '0') END AS ICD9_DGNS_CD_{i}" for i in range(1, 11)]
    + [f"CASE WHEN claim % 7 >= {i} THEN lpad(CAST((claim + {i}) % 100 AS VARCHAR), 2, '0') END AS ICD9_PRCDR_CD_{i}" for i in range(1, 7)]
)
RAW = f"""{ENC}, enc2 AS (
  SELECT * REPLACE (CASE WHEN claim % 97 = 0 THEN d + 400 ELSE d END AS d) FROM enc),
raw AS (
  SELECT CAST(id AS VARCHAR) AS DESYNPUF_ID, CAST(claim AS VARCHAR) AS CLM_ID,
         CASE WHEN claim % 101 <> 0 THEN strftime(a, '%Y%m%d') END AS CLM_FROM_DT,
         strftime(d, '%Y%m%d') AS CLM_THRU_DT,
         'P' || CAST(claim % 50 AS VARCHAR) AS PRVDR_NUM,
         CASE WHEN claim % 31 = 0 THEN '20091332' WHEN claim % 29 = 0 THEN '' WHEN claim % 5 = 0 THEN NULL
              WHEN claim % 41 = 0 THEN ' ' || strftime(a, '%Y%m%d') ELSE strftime(a, '%Y%m%d') END AS CLM_ADMSN_DT,
         dx AS ADMTNG_ICD9_DGNS_CD,
         lpad(CAST(claim % 37 AS VARCHAR), 3, '0') AS CLM_DRG_CD,
         CAST(d - a AS VARCHAR) AS CLM_UTLZTN_DAY_CNT,
         CASE WHEN claim % 7 <> 0 THEN strftime(d, '%Y%m%d') END AS NCH_BENE_DSCHRG_DT,
         {_CODES},
         CAST(id % 3 + 1 AS INTEGER) AS sample
  FROM enc2)"""

_FLAGS = ",\n         ".join(
    f"CASE WHEN (c_custkey + {i}) % 37 = 0 THEN NULL WHEN (c_custkey * {i} + yr) % 4 = 0 THEN '1' ELSE '2' END AS {name}"
    for i, name in enumerate(P.FLAG_COLUMNS, 1)
)
SNAP = f"""snapraw AS (
  SELECT CAST(c_custkey AS VARCHAR) AS DESYNPUF_ID,
         CASE WHEN (c_custkey + yr) % 7 = 0 OR c_custkey % 53 = 0 THEN NULL
              ELSE CAST(1910 + (c_custkey * 13) % 85 AS VARCHAR) || lpad(CAST(1 + c_custkey % 12 AS VARCHAR), 2, '0')
                   || lpad(CAST(1 + c_custkey % 28 AS VARCHAR), 2, '0') END AS BENE_BIRTH_DT,
         CASE WHEN c_custkey % 11 = 0 THEN strftime(DATE '1996-01-01' + CAST((c_custkey * 37) % 1800 AS INTEGER), '%Y%m%d') END AS BENE_DEATH_DT,
         CAST(1 + c_custkey % 3 AS VARCHAR) AS BENE_SEX_IDENT_CD,
         CASE WHEN c_custkey % 43 = 0 THEN NULL ELSE CAST(c_custkey % 6 AS VARCHAR) END AS BENE_RACE_CD,
         CASE WHEN c_custkey % 47 = 0 THEN 'XX' ELSE CAST(c_custkey % 54 AS VARCHAR) END AS SP_STATE_CODE,
         {_FLAGS},
         CAST(c_custkey % 3 + 1 AS INTEGER) AS sample, CAST(yr AS INTEGER) AS year
  FROM customer, range({FIRST_YEAR}, {LAST_YEAR + 1}) AS years(yr))"""


def day_sql(column: str) -> str:
    return f"CAST(try_strptime(trim({column}), '%Y%m%d') AS DATE)"


def chapter_sql(column: str) -> str:
    from episodica.functions.scalars import DX_CHAPTERS

    number = f"TRY_CAST(substr(trim({column}), 1, 3) AS INTEGER)"
    ranges = " ".join(f"WHEN {number} BETWEEN {lo} AND {hi} THEN '{name}'" for lo, hi, name in DX_CHAPTERS)
    return f"CASE WHEN trim({column}) LIKE 'E%' THEN 'External' WHEN trim({column}) LIKE 'V%' THEN 'Health_Factors' {ranges} ELSE 'Unknown' END"


_SNAP_COLUMNS = ", ".join(
    [
        f"{day_sql('BENE_BIRTH_DT')} AS birth_date",
        f"{day_sql('BENE_DEATH_DT')} AS death_date",
        "TRY_CAST(BENE_SEX_IDENT_CD AS INTEGER) AS sex_code",
        "TRY_CAST(BENE_RACE_CD AS INTEGER) AS race_code",
        "TRY_CAST(SP_STATE_CODE AS INTEGER) AS state_code",
        *[f"TRY_CAST({raw} AS INTEGER) = 1 AS {name}" for raw, name in zip(P.FLAG_COLUMNS, CONDITION_FLAGS)],
    ]
)
SNAPS = f"{SNAP}, snaps AS (SELECT DESYNPUF_ID AS beneficiary_id, sample, year AS snapshot_year, {_SNAP_COLUMNS} FROM snapraw)"

_PRESENT = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in P.DX_COLUMNS)
_PROCS = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in P.PROCEDURE_COLUMNS)
CLAIMS = f"""{RAW}, parsed AS (
  SELECT DESYNPUF_ID AS beneficiary_id, CLM_ID AS claim_id, sample,
         coalesce({day_sql('CLM_ADMSN_DT')}, {day_sql('CLM_FROM_DT')}) AS admit_date,
         coalesce({day_sql('NCH_BENE_DSCHRG_DT')}, {day_sql('CLM_THRU_DT')}) AS discharge_date,
         {chapter_sql('ADMTNG_ICD9_DGNS_CD')} AS admit_dx_chapter,
         ADMTNG_ICD9_DGNS_CD AS admit_dx_code, CLM_DRG_CD AS drg_code,
         CAST({_PRESENT} AS BIGINT) AS num_diagnoses, CAST({_PROCS} AS BIGINT) AS num_procedures
  FROM raw),
claims AS (
  SELECT *, discharge_date - admit_date AS los_days, year(admit_date) AS admit_year
  FROM parsed WHERE admit_date IS NOT NULL AND discharge_date IS NOT NULL)"""

_BLOCK = ("birth_date", "death_date", "sex_code", "race_code", "state_code", *CONDITION_FLAGS)
_PICK = ", ".join(f"CASE WHEN e.birth_date IS NOT NULL THEN e.{c} ELSE f.{c} END AS {c}" for c in _BLOCK)
FLAGGED = f"""{CLAIMS}, {SNAPS}, ordered AS (
  SELECT *, lead(admit_date) OVER w AS next_start, lag(discharge_date) OVER w AS prev_end,
         count(*) OVER (PARTITION BY beneficiary_id ORDER BY admit_date RANGE BETWEEN INTERVAL 179 DAYS PRECEDING AND CURRENT ROW) - 1 AS prior_6mo_inpatient_count
  FROM claims WINDOW w AS (PARTITION BY beneficiary_id ORDER BY admit_date, discharge_date, claim_id)),
labelled AS (
  SELECT *, admit_date - prev_end AS days_since_last_discharge,
         CASE WHEN next_start - discharge_date > 0 AND next_start - discharge_date <= 30 THEN 1 ELSE 0 END AS y
  FROM ordered),
latest AS (
  SELECT * FROM snaps QUALIFY row_number() OVER (PARTITION BY beneficiary_id, sample ORDER BY snapshot_year DESC) = 1),
attached AS (
  SELECT l.*, {_PICK}
  FROM labelled l
  LEFT JOIN snaps e ON e.beneficiary_id = l.beneficiary_id AND e.sample = l.sample AND e.snapshot_year = l.admit_year
  LEFT JOIN latest f ON f.beneficiary_id = l.beneficiary_id AND f.sample = l.sample),
aged AS (
  SELECT *, CAST(floor((admit_date - birth_date) / 365.25) AS BIGINT) AS age_at_admit,
         CASE sex_code WHEN 1 THEN 'Male' WHEN 2 THEN 'Female' ELSE 'Unknown' END AS sex,
         CASE race_code WHEN 1 THEN 'White' WHEN 2 THEN 'Black' WHEN 3 THEN 'Other' WHEN 5 THEN 'Hispanic' ELSE 'Unknown' END AS race
  FROM attached),
flagged AS (
  SELECT *, CASE WHEN age_at_admit < 65 THEN '<65' WHEN age_at_admit < 75 THEN '65-74' WHEN age_at_admit < 85 THEN '75-84' ELSE '85+' END AS age_bin,
         death_date IS NOT NULL AND death_date >= admit_date AND death_date <= discharge_date AS excl_died_during,
         death_date IS NOT NULL AND death_date > discharge_date AND death_date <= discharge_date + 30 AND y = 0 AS excl_censored_death,
         discharge_date + 30 > (SELECT max(admit_date) FROM claims) AS excl_censored_window,
         los_days > 365 AS excl_long_los,
         age_at_admit < 18 AS excl_too_young
  FROM aged)"""
INCLUDED = "NOT (excl_died_during OR excl_censored_death OR excl_censored_window OR excl_long_los OR excl_too_young)"

_INT = ("sample", "admit_year", "state_code", "y")
_COHORT_SELECT = ", ".join(f"CAST({c} AS BIGINT) AS {c}" if c in _INT else c for c in P.COHORT_COLUMNS)
COH = f"{FLAGGED}, coh AS (SELECT {_COHORT_SELECT} FROM flagged WHERE {INCLUDED})"

_FLAG_SUM = " + ".join(f"coalesce(CAST({c} AS INTEGER), 0)" for c in CONDITION_FLAGS)
FEAT = f"""{COH}, feat AS (
  SELECT *, CAST(month(admit_date) AS BIGINT) AS admit_month, CAST(isodow(admit_date) AS BIGINT) AS admit_dow,
         isodow(admit_date) >= 6 AS is_weekend_admit, CAST({_FLAG_SUM} AS BIGINT) AS chronic_count,
         days_since_last_discharge IS NOT NULL AS has_prior_admit,
         coalesce(days_since_last_discharge, 9999) AS days_since_last_discharge_imputed
  FROM coh)"""


def ranked_sql(source: str, entity: str = "beneficiary_id", label: str = "y", seed: int = 42) -> str:
    """CTEs ``strata`` and ``ranked``: one row per entity with its seeded rank in its stratum."""
    return f"""strata AS (SELECT {entity} AS entity, max({label}) AS ever_pos, count(*) AS n_rows FROM {source} GROUP BY {entity}),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY ever_pos ORDER BY md5(CAST(entity AS VARCHAR) || '|{seed}'), entity) AS r,
         count(*) OVER (PARTITION BY ever_pos) AS sz FROM strata)"""


SPLIT = f"""{FEAT}, {ranked_sql('feat')}, splits AS (
  SELECT entity, CASE WHEN r <= floor(sz * 0.15::DOUBLE + 0.5) THEN 'test'
                      WHEN r <= floor(sz * 0.15::DOUBLE + 0.5) + floor(sz * 0.15::DOUBLE + 0.5) THEN 'val' ELSE 'train' END AS split
  FROM ranked),
feats AS (SELECT f.*, s.split FROM feat f JOIN splits s ON s.entity = f.beneficiary_id)"""

# ---------------------------------------------------------------- scores


def score_columns(claim: str = "claim") -> dict:
    """Three deterministic score columns with many ties."""
    k = F.col(claim).cast("bigint")
    return {
        "m1": ((k * 7919) % 1000) / F.lit(1000.0),
        "m2": ((k * 104729) % 500) / F.lit(500.0),
        "m3": ((k * 31) % 89) / F.lit(89.0),
    }


SCORE_SQL = {
    "m1": "((CAST({k} AS BIGINT) * 7919) % 1000) / 1000.0::DOUBLE",
    "m2": "((CAST({k} AS BIGINT) * 104729) % 500) / 500.0::DOUBLE",
    "m3": "((CAST({k} AS BIGINT) * 31) % 89) / 89.0::DOUBLE",
}


def score_sql(model: str, claim: str = "claim") -> str:
    return SCORE_SQL[model].format(k=claim)


_STAGED: dict[tuple[str, str, str], str] = {}


def staged(spark: SparkSession, sf: str, name: str, build) -> DataFrame:
    """A stage table: built from the given tables by the first query that needs it, then read from files.

    Later stages read what earlier stages wrote, so an operator that uses its input several times does
    not repeat the work before it, and a lost executor costs one file scan.
    """
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _STAGED:
        path = shared_path(spark, name)
        build(spark, sf).write.option("compression", "zstd").parquet(path)
        _STAGED[key] = path
    return spark.read.parquet(_STAGED[key])


def build_labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Episodes from orders with order, history and label."""
    roles = EpisodeRoles("id", "claim", "a", "d")
    return with_return_label(with_sequence(encounters(spark, sf), roles), roles)


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    return staged(spark, sf, "labelled", build_labelled)


def scores(spark: SparkSession, sf: str) -> DataFrame:
    """Keyed score table ``(claim, id, model, p, y)``."""
    base = labelled(spark, sf).select("claim", "id", "y")
    cells = [F.struct(F.lit(m).alias("model"), e.alias("p")) for m, e in score_columns().items()]
    return base.select("claim", "id", "y", F.inline(F.array(*cells)))


def scored(spark: SparkSession, sf: str, model: str = "m1") -> DataFrame:
    """One model: ``(claim, id, y, p)``."""
    return labelled(spark, sf).select("claim", "id", "y", score_columns()[model].alias("p"))


SCORED = f"{LAB}, sc AS (SELECT claim, id, y, {score_sql('m1')} AS p FROM lab)"
SCORES = f"{LAB}, scores AS (" + " UNION ALL ".join(
    f"SELECT claim, id, y, '{m}' AS model, {score_sql(m)} AS p FROM lab" for m in SCORE_SQL
) + ")"

AUDIT_THRESHOLD = 0.3


def build_flagged(spark: SparkSession, sf: str) -> DataFrame:
    return P.flagged_episodes(raw_claims(spark, sf), raw_snapshots(spark, sf))


def flagged(spark: SparkSession, sf: str) -> DataFrame:
    """Episodes with exclusion flags, shared by the attrition report and the cohort."""
    return staged(spark, sf, "flagged", build_flagged)


def cohort(spark: SparkSession, sf: str) -> DataFrame:
    return keep_included(flagged(spark, sf)).select(*P.COHORT_COLUMNS)


def features(spark: SparkSession, sf: str) -> DataFrame:
    return P.derive_features(cohort(spark, sf))


def audit_rows(spark: SparkSession, sf: str) -> DataFrame:
    """``(claim_id, sex, race, age_bin, y, p, yhat)``."""
    p = score_columns("claim_id")["m1"]
    rows = cohort(spark, sf).select("claim_id", "beneficiary_id", "sex", "race", "age_bin", "y", p.alias("p"))
    return rows.withColumn("yhat", (F.col("p") >= AUDIT_THRESHOLD).cast("int"))


AUD = f"""{COH}, aud AS (
  SELECT claim_id, beneficiary_id, sex, race, age_bin, y, {score_sql('m1', 'claim_id')} AS p,
         CAST({score_sql('m1', 'claim_id')} >= {AUDIT_THRESHOLD}::DOUBLE AS INTEGER) AS yhat FROM coh)"""
AUDL = f"""{AUD}, audl AS (""" + " UNION ALL ".join(
    f"SELECT '{a}' AS attribute, {a} AS slice, claim_id, y, p, yhat FROM aud" for a in ("sex", "race", "age_bin")
) + """),
audo AS (SELECT * FROM audl UNION ALL """ + " UNION ALL ".join(
    f"SELECT '{a}' AS attribute, 'OVERALL' AS slice, claim_id, y, p, yhat FROM aud" for a in ("sex", "race", "age_bin")
) + ")"
