import datetime as dt

import pytest
from pyspark.sql import functions as F

from episodica.functions import scalars as S
from episodica.roles import CONDITION_FLAGS, FeatureSpec, project_features


def column(spark, values, type_, expression):
    df = spark.createDataFrame([(v,) for v in values], f"x {type_}")
    return [r[0] for r in df.select(expression(F.col("x"))).collect()]


def test_parse_yyyymmdd(spark):
    got = column(spark, ["20090228", "20091332", " 20091231", "", None, "2009022"], "string", S.parse_yyyymmdd)
    assert got == [dt.date(2009, 2, 28), None, dt.date(2009, 12, 31), None, None, None]


def test_dx_chapter(spark):
    codes = ["0389", "V450", "E812", "780", "000", "7", None, "ABC", "999", " 250"]
    want = ["Infectious", "Health_Factors", "External", "Symptoms_Illdefined", "Unknown", "Infectious", "Unknown", "Unknown", "Injury_Poisoning", "Endocrine_Metabolic"]
    assert column(spark, codes, "string", S.dx_chapter) == want


def test_bands(spark):
    assert column(spark, [64, 65, 74, 75, 84, 85, None], "int", S.age_band) == ["<65", "65-74", "65-74", "75-84", "75-84", "85+", "85+"]
    assert column(spark, [0.049, 0.05, 0.15, 0.35], "double", S.risk_band) == ["low", "moderate", "high", "very_high"]


def test_label_edges(spark):
    assert column(spark, [-3, 0, 1, 30, 31, None], "int", S.return_label) == [0, 0, 1, 1, 0, 0]


def test_code_labels(spark):
    assert column(spark, [1, 2, 3, 5, 4, None], "int", lambda c: S.map_code(c, S.RACE_LABELS)) == ["White", "Black", "Other", "Hispanic", "Unknown", "Unknown"]


def test_flag_decode_is_nullable(spark):
    assert column(spark, ["1", "2", "x", None], "string", S.decode_flag) == [True, False, None, None]


def test_wilson(spark):
    df = spark.createDataFrame([(0, 0), (5, 10)], "k int, n int")
    low, high = S.wilson_bounds("k", "n")
    rows = df.select(low.alias("low"), high.alias("high")).collect()
    assert rows[0].low == pytest.approx(0.0) and rows[0].high == pytest.approx(0.793457, abs=1e-6)
    assert rows[1].low == pytest.approx(0.236593, abs=1e-5) and rows[1].high == pytest.approx(0.763407, abs=1e-5)


def test_derived_features(spark):
    flags = ", ".join(f"{c} boolean" for c in CONDITION_FLAGS)
    rows = [(dt.date(2009, 1, 5), None, *[True, None] + [False] * 9), (dt.date(2009, 6, 13), 12, *[True] * 11)]
    df = spark.createDataFrame(rows, f"admit_date date, days_since_last_discharge int, {flags}")
    a, b = S.add_derived_features(df, CONDITION_FLAGS).collect()
    assert (a.admit_month, a.admit_dow, a.is_weekend_admit, a.chronic_count, a.has_prior_admit, a.days_since_last_discharge_imputed) == (1, 1, False, 1, False, 9999)
    assert (b.admit_month, b.admit_dow, b.is_weekend_admit, b.chronic_count, b.has_prior_admit, b.days_since_last_discharge_imputed) == (6, 6, True, 11, True, 12)


def test_strip_prefix_and_clamp(spark):
    assert column(spark, ["cat_low__sex_Male", "num__x", "plain"], "string", S.strip_prefix) == ["sex_Male", "x", "plain"]
    assert column(spark, [-1, 3, 99, None], "int", lambda c: S.clamp(c, 0, 60)) == [0, 3, 60, None]


def test_feature_spec(spark):
    assert len(FeatureSpec().features()) == 29
    with pytest.raises(ValueError, match="los_days"):
        project_features(spark.range(1), FeatureSpec())
