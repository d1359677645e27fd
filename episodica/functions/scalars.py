"""Row-local column expressions. All of them stay inside code generation; none is a UDF."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Numeric diagnosis-code chapters, inclusive on both ends.
DX_CHAPTERS = (
    (1, 139, "Infectious"),
    (140, 239, "Neoplasms"),
    (240, 279, "Endocrine_Metabolic"),
    (280, 289, "Blood"),
    (290, 319, "Mental"),
    (320, 389, "Nervous_Sense"),
    (390, 459, "Circulatory"),
    (460, 519, "Respiratory"),
    (520, 579, "Digestive"),
    (580, 629, "Genitourinary"),
    (630, 679, "Pregnancy"),
    (680, 709, "Skin"),
    (710, 739, "Musculoskeletal"),
    (740, 759, "Congenital"),
    (760, 779, "Perinatal"),
    (780, 799, "Symptoms_Illdefined"),
    (800, 999, "Injury_Poisoning"),
)
# Code labels, age bands and risk bands (upper bounds are exclusive).
SEX_LABELS = {1: "Male", 2: "Female"}
RACE_LABELS = {1: "White", 2: "Black", 3: "Other", 5: "Hispanic"}
AGE_BANDS = ((65, "<65"), (75, "65-74"), (85, "75-84"))
AGE_BAND_LAST = "85+"
RISK_BANDS = ((0.05, "low"), (0.15, "moderate"), (0.35, "high"))
RISK_BAND_LAST = "very_high"
SCORE_EPS = 1e-7


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_yyyymmdd(col) -> Column:
    """Text ``YYYYMMDD`` to a date; anything that is not such a date becomes NULL."""
    return F.try_to_date(F.trim(_c(col).cast("string")), "yyyyMMdd")


def days_between(start, end) -> Column:
    """Whole days from ``start`` to ``end``."""
    return F.datediff(_c(end), _c(start))


def iso_weekday(col) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(_c(col)) + 1


def is_weekend(col) -> Column:
    return iso_weekday(col) >= 6


def count_present(columns) -> Column:
    """How many of the columns are not NULL in this row."""
    return reduce(add, [_c(c).isNotNull().cast("int") for c in columns])


def count_true(columns) -> Column:
    """How many flags are true in this row; NULL counts as false."""
    return reduce(add, [F.coalesce(_c(c).cast("int"), F.lit(0)) for c in columns])


def range_label(number: Column, ranges, default: str) -> Column:
    """Label of the inclusive range that holds a small non-negative number.

    The ranges are spread over one constant array that is indexed by the number, so a row costs one
    look-up however many ranges there are.
    """
    slots = [""] * (max(hi for _, hi, _ in ranges) + 1)
    for lo, hi, name in ranges:
        slots[lo : hi + 1] = [name] * (hi + 1 - lo)
    label = F.get(F.split(F.lit(",".join(slots)), ","), number)
    return F.coalesce(F.nullif(label, F.lit("")), F.lit(default))


def dx_chapter(col) -> Column:
    """Diagnosis code to chapter: E and V codes by prefix, the others by their first three characters."""
    code = F.trim(_c(col).cast("string"))
    number = F.substring(code, 1, 3).try_cast("int")
    return (
        F.when(code.startswith("E"), "External")
        .when(code.startswith("V"), "Health_Factors")
        .otherwise(range_label(number, DX_CHAPTERS, "Unknown"))
    )


def map_code(col, labels: dict, default: str = "Unknown") -> Column:
    """Code to label; unlisted codes and NULL get the default."""
    items = iter(labels.items())
    code, label = next(items)
    out = F.when(_c(col) == code, label)
    for code, label in items:
        out = out.when(_c(col) == code, label)
    return out.otherwise(default)


def decode_flag(col, yes: int = 1) -> Column:
    """Text or integer flag to a nullable boolean."""
    return _c(col).try_cast("int") == yes


def age_in_years(birth, at) -> Column:
    return F.floor(F.datediff(_c(at), _c(birth)) / 365.25).cast("int")


def band(value, bands, last: str) -> Column:
    """First band whose exclusive upper bound lies above the value; NULL falls into the last band."""
    (bound, name), *rest = bands
    out = F.when(_c(value) < bound, name)
    for bound, name in rest:
        out = out.when(_c(value) < bound, name)
    return out.otherwise(last)


def age_band(col) -> Column:
    return band(col, AGE_BANDS, AGE_BAND_LAST)


def risk_band(col) -> Column:
    return band(col, RISK_BANDS, RISK_BAND_LAST)


def return_label(gap, horizon_days: int = 30) -> Column:
    """1 if the next start comes 1..horizon days after this end, otherwise 0 (also without a next one)."""
    return F.when((_c(gap) > 0) & (_c(gap) <= horizon_days), 1).otherwise(0)


def clamp(col, low=None, high=None) -> Column:
    """Limit to [low, high]; NULL stays NULL."""
    out = _c(col)
    if low is not None:
        out = F.when(out < low, F.lit(low)).otherwise(out)
    if high is not None:
        out = F.when(out > high, F.lit(high)).otherwise(out)
    return out


def clip_score(col, eps: float = SCORE_EPS) -> Column:
    return F.greatest(F.least(_c(col), F.lit(1 - eps)), F.lit(eps))


def decide(score, threshold) -> Column:
    """1 where the score reaches the threshold."""
    return (_c(score) >= threshold).cast("int")


def fixed_width_bin(col, low, width) -> Column:
    """Lower edge of the left-closed bin that holds the value."""
    return (F.floor((_c(col) - low) / width) * width + low).cast("int")


def share(part, whole, digits: int = 6) -> Column:
    """part / whole, rounded, 0 where the whole is 0."""
    return F.coalesce(F.round(F.try_divide(_c(part).cast("double"), _c(whole).cast("double")), digits), F.lit(0.0))


def wilson_bounds(hits, total, z: float = 1.96) -> tuple[Column, Column]:
    """Wilson score interval of a proportion, safe for total = 0 and clipped to [0, 1]."""
    k, n = _c(hits).cast("double"), _c(total).cast("double")
    safe_n = F.when(n > 0, n).otherwise(1.0)
    p = F.when(n > 0, k / safe_n).otherwise(0.0)
    scale = 1.0 + z * z / safe_n
    mid = (p + z * z / (2.0 * safe_n)) / scale
    half = F.sqrt(p * (1.0 - p) / safe_n + z * z / (4.0 * safe_n * safe_n)) * z / scale
    zero, one = F.lit(0.0), F.lit(1.0)
    return F.greatest(zero, F.least(one, mid - half)), F.greatest(zero, F.least(one, mid + half))


def sigmoid(col) -> Column:
    return 1.0 / (1.0 + F.exp(-_c(col)))


def strip_prefix(col, prefixes=("num", "bin", "cat_low", "cat_high"), separator: str = "__") -> Column:
    """Drop the role prefix of an encoded feature name."""
    return F.regexp_replace(_c(col), f"^({'|'.join(prefixes)}){separator}", "")


def add_calendar_features(df: DataFrame, start: str, prefix: str = "admit") -> DataFrame:
    return df.withColumns(
        {
            f"{prefix}_month": F.month(start),
            f"{prefix}_dow": iso_weekday(start),
            f"is_weekend_{prefix}": is_weekend(start),
        }
    )


def add_derived_features(
    df: DataFrame,
    flags,
    start: str = "admit_date",
    gap: str = "days_since_last_discharge",
    missing_gap: int = 9999,
) -> DataFrame:
    """Episode-local features: calendar parts, number of flags, has-prior flag and imputed gap."""
    return add_calendar_features(df, start).withColumns(
        {
            "chronic_count": count_true(flags),
            "has_prior_admit": F.col(gap).isNotNull(),
            f"{gap}_imputed": F.coalesce(F.col(gap), F.lit(missing_gap)),
        }
    )
