import numpy as np
import pytest
from pyspark.sql import functions as F

from episodica.functions import sketch as K
from episodica.operators import metrics as M
from episodica.operators import rates as R
from episodica.roles import ScoreRoles

ROLES = ScoreRoles("k", "y", "p")


def error(values, q, prob):
    """How far the rank of ``q`` is from ``prob``, as a share of the rows."""
    values = np.sort(values)
    low, high = np.searchsorted(values, q, "left") / len(values), np.searchsorted(values, q, "right") / len(values)
    return max(0.0, low - prob, prob - high)


@pytest.fixture(scope="module")
def table(spark):
    # one day and group hold most of the rows
    u = F.rand(7)
    group = F.when(F.col("id") % 10 < 8, "hot").when(F.col("id") % 10 == 8, "cold")
    return spark.range(400_000).select(F.col("id").alias("k"), group.alias("g"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 30).alias("day"), (u * u * u).alias("p"), (F.rand(8) < u).cast("int").alias("y")).cache()


@pytest.mark.parametrize("k", [200, 4096])
def test_days_merge_within_the_rank_error(table, k):
    probs = {f"q{i}": i / 20 for i in range(21)}
    daily = K.quantile_sketches(table, "p", ["g", "day"], k)
    merged = K.merge_sketches(daily, ["g"])
    pdf = table.toPandas()
    got = {r.g: r for r in K.sketch_quantiles(merged, probs, ["g"]).collect()}
    assert set(got) == {"hot", "cold", None}
    for g, r in got.items():
        values = pdf[pdf.g.isna() if g is None else pdf.g == g].p.to_numpy()
        assert r.n == len(values)
        # 63 quantiles, each within the error at 99 % confidence; three times that leaves no chance
        assert max(error(values, r[name], prob) for name, prob in probs.items()) <= 3 * K.rank_error(k)
    assert daily.unionByName(merged.withColumn("day", F.lit(-1))).agg(F.max(F.octet_length("sketch"))).first()[0] <= K.sketch_bytes(k)


def test_few_values_are_kept_whole(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(101)] + [("a", None), ("a", float("nan")), ("b", None)], "g string, v double")
    (r,) = K.approx_quantiles(df, "v", {"low": 0.0, "half": 0.5, "high": 1.0}, ["g"]).collect()
    assert (r.g, r.n, r.low, r.half, r.high) == ("a", 101, 0.0, 50.0, 100.0)


def test_empty_tables(spark, table):
    none = table.limit(0)
    assert K.approx_quantiles(none, "p", {"m": 0.5}).count() == 0
    assert K.merge_sketches(K.quantile_sketches(none, "p", ["g"])).count() == 0
    assert M.quantile_reliability(none, ROLES, ["g"], approx=True).count() == 0


def test_caps_and_reliability(table):
    pdf = table.toPandas()
    (caps,) = R.percentile_caps(table, ["p"], approx=True).collect()
    assert error(pdf.p, caps.low, 0.05) <= 3 * K.rank_error() and error(pdf.p, caps.high, 0.95) <= 3 * K.rank_error()
    exact = {(r.g, r.bin): r for r in M.quantile_reliability(table, ROLES, ["g"]).collect()}
    near = {(r.g, r.bin): r for r in M.quantile_reliability(table, ROLES, ["g"], approx=True).collect()}
    assert exact.keys() == near.keys() and len(near) == 45
    for g in ("hot", "cold", None):
        n = sum(r.n for (h, _), r in exact.items() if h == g)
        assert n == sum(r.n for (h, _), r in near.items() if h == g)
        for b in range(15):
            assert abs(exact[g, b].n - near[g, b].n) <= 6 * K.rank_error() * n
            assert near[g, b].mean_pred == pytest.approx(exact[g, b].mean_pred, abs=0.02)
