import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from episodica.functions import ordered as O
from episodica.functions.joins import hot_keys, key_counts, salted_join


def skewed(spark, n=3000, seed=5):
    rng = random.Random(seed)
    rows = [("a" if rng.random() < 0.5 else None if rng.random() < 0.3 else "b", round(rng.random() ** 6, 3) if rng.random() < 0.7 else 0.25, i) for i in range(n)]
    return rows, spark.createDataFrame(rows, "g string, x double, k int")


@pytest.mark.parametrize("descending", [False, True])
def test_global_cumsum(spark, descending):
    rows, df = skewed(spark)
    counts = O.value_counts(df, "x", ["g"])
    got = O.global_cumsum(counts, "x", ["n"], ["g"], descending, next_values=["n"])
    for g in ("a", "b", None):
        mine = sorted({x for h, x, _ in rows if h == g}, reverse=descending)
        size = {x: sum(1 for h, v, _ in rows if h == g and v == x) for x in mine}
        cum = np.cumsum([size[x] for x in mine])
        want = {x: (int(cum[i]), size[mine[i + 1]] if i + 1 < len(mine) else None) for i, x in enumerate(mine)}
        assert {r.x: (r.cum_n, r.next_n) for r in got.collect() if r.g == g} == want


def test_ranges_split_the_work(spark):
    _, df = skewed(spark)
    counts = O.value_counts(df, "x", ["g"])
    edges = O.range_edges(counts, "x", 8)
    sizes = [r["count"] for r in O.with_range(counts, "x", edges).groupBy(O.BUCKET).count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 0.4 * counts.count()


def test_exact_quantiles(spark):
    rows, df = skewed(spark)
    probs = {"q0": 0.0, "q1": 0.1, "q5": 0.5, "q9": 0.937, "q10": 1.0}
    got = {r.g: r for r in O.exact_quantiles(df, "x", probs, ["g"]).collect()}
    for g in ("a", "b", None):
        x = [v for h, v, _ in rows if h == g]
        for name, q in probs.items():
            assert got[g][name] == pytest.approx(np.quantile(x, q), abs=1e-12)
    whole = O.exact_quantiles(df, "x", probs).first()
    assert whole.q9 == pytest.approx(np.quantile([v for _, v, _ in rows], 0.937), abs=1e-12)


def test_shuffle_rank(spark):
    rows, df = skewed(spark, 900)
    key = lambda k: (hashlib.md5(f"{k}|7".encode()).hexdigest(), k)
    got = {r.k: (r.shuffle_rank, r.group_size) for r in O.shuffle_rank(df, "k", 7, ["g"]).collect()}
    first = {r.k for r in O.shuffle_rank(df, "k", 7, ["g"], at_most=F.lit(40)).collect()}
    for g in ("a", "b", None):
        order = sorted([k for h, _, k in rows if h == g], key=key)
        assert {k: got[k] for k in order} == {k: (i + 1, len(order)) for i, k in enumerate(order)}
        assert set(order[:40]) == {k for k in order if k in first}


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_salted_join_equals_plain_join(spark, how):
    rows = [("hot" if i % 3 else None if i % 5 == 0 else f"k{i % 50}", i) for i in range(2000)]
    facts = spark.createDataFrame(rows, "key string, i int")
    side = spark.createDataFrame([("hot", 1), (None, 2), ("k3", 3), ("k6", 4), ("none", 5)], "key string, v int")
    counts = key_counts(facts, ["key"])
    assert hot_keys(counts, ["key"]).where("key = 'hot'").first()._copies > 1
    for null_safe, plain in ((True, O.null_safe_join(facts, side, ["key"], how)), (False, facts.join(side, "key", how))):
        want = sorted(map(str, plain.collect()))
        assert sorted(map(str, salted_join(facts, side, ["key"], how, "i", null_safe=null_safe).collect())) == want
        assert sorted(map(str, salted_join(facts, side, ["key"], how, "i", counts, null_safe).collect())) == want


def test_hot_keys_are_bounded(spark):
    facts = spark.range(5000).select((F.col("id") % 7).alias("key"))
    assert hot_keys(key_counts(facts, ["key"]), ["key"]).count() <= 2 * 4


def test_empty_table(spark):
    none = spark.createDataFrame([], "g string, x double, k int")
    assert O.average_ranks(none, "x", ["g"]).count() == 0 and O.exact_quantiles(none, "x", {"q": 0.5}, ["g"]).count() == 0


def test_average_ranks(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (5.0,)], "x double")
    assert {r.x: r.avg_rank for r in O.average_ranks(df, "x").collect()} == {1.0: 1.0, 2.0: 2.5, 5.0: 4.0}
