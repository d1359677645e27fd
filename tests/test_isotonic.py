"""Pooled blocks against plain pool-adjacent-violators, whatever the ranges."""

import numpy as np
import pytest

from episodica.functions.ordered import value_counts
from episodica.operators.isotonic import IsotonicCurve, curve_points, fit_isotonic_curve, isotonic_blocks
from pyspark.sql import functions as F


def plain(points):
    """(score, n, pos) to blocks [low, high, n, pos]."""
    blocks = []
    for x, n, pos in sorted(points):
        blocks.append([x, x, n, pos])
        while len(blocks) > 1 and blocks[-2][3] * blocks[-1][2] >= blocks[-1][3] * blocks[-2][2]:
            high = blocks.pop()
            blocks[-1] = [blocks[-1][0], high[1], blocks[-1][2] + high[2], blocks[-1][3] + high[3]]
    return [tuple(map(float, b)) for b in blocks]


def shapes():
    rng = np.random.default_rng(5)
    n = 400
    x = np.round(np.sort(rng.random(n)), 6)
    yield "noise", [(v, 3, int(rng.integers(0, 4))) for v in x]
    yield "rising", [(k / n, n, k) for k in range(n)]
    yield "falling", [(k / n, n, n - k) for k in range(n)]
    yield "saw", [(k / n, 100, (k % 50) * 2) for k in range(n)]
    yield "hot", [(v, 10**6 if k == 200 else 2, 10**5 if k == 200 else int(rng.random() < v) * 2) for k, v in enumerate(x)]
    yield "flat", [(k / n, 4, 2) for k in range(n)]
    yield "one", [(0.5, 7, 3)]


@pytest.mark.parametrize(("name", "points"), list(shapes()), ids=lambda v: v if isinstance(v, str) else "")
def test_blocks(spark, name, points):
    df = spark.createDataFrame([(float(x), int(n), int(p)) for x, n, p in points], "p double, n long, pos long").repartition(6)
    want = plain(points)
    for per_range in (1 << 17, 37):
        got = sorted((r.low, r.high, r.n, r.pos) for r in isotonic_blocks(df, per_range=per_range).collect())
        assert got == want


def test_curves_by_group_with_nulls(spark):
    rng = np.random.default_rng(6)
    rows = [(g, float(np.round(rng.random(), 3)), int(rng.integers(0, 2))) for g in ("a", "b", None) for _ in range(300)] + [("a", None, 1)]
    df = spark.createDataFrame(rows, "g string, p double, y int")
    counts = value_counts(df, "p", ["g"], pos=F.sum("y"))
    got = isotonic_blocks(counts, by=["g"], per_range=100).collect()
    for g in ("a", "b", None):
        mine = [(r.p, r.n, r.pos) for r in counts.collect() if r.g == g]
        assert sorted((r.low, r.high, r.n, r.pos) for r in got if r.g == g) == plain(mine)
        assert all(r.value == r.pos / r.n for r in got)


def test_a_million_distinct_scores(spark):
    """Ranges of one task each; the blocks have rising means and keep all rows."""
    points = spark.range(1_000_000).select((F.col("id") / 1e6).alias("p"), F.lit(1).alias("n"), (F.pmod(F.xxhash64("id"), F.lit(10**6)) < F.col("id")).cast("int").alias("pos"))
    got = isotonic_blocks(points).toPandas().sort_values("low")
    assert got.n.sum() == 1_000_000 and (np.diff(got.value) > 0).all() and (got.low.to_numpy()[1:] > got.high.to_numpy()[:-1]).all()
    pdf = points.toPandas()
    want = plain(list(zip(pdf.p, pdf.n, pdf.pos)))
    assert [tuple(r) for r in got[["low", "high", "n", "pos"]].to_numpy()] == want


def test_curve_in_an_expression_and_by_ranges(spark, tmp_path):
    points = spark.createDataFrame([(0.1, 4, 0), (0.2, 4, 2), (0.3, 4, 1), (0.5, 4, 3), (0.8, 4, 4)], "p double, n long, pos long")
    curve = fit_isotonic_curve(points)
    assert sorted((r.x, r.value) for r in curve.points.collect()) == [(0.1, 0.0), (0.2, 0.375), (0.3, 0.375), (0.5, 0.75), (0.8, 1.0)]
    curve.save(spark, str(tmp_path / "c"))
    curve = IsotonicCurve.load(spark, str(tmp_path / "c"))
    xs = [0.0, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.65, 0.8, 0.9, 1.0] + [0.25] * 500
    rows = spark.createDataFrame([(k, float(x)) for k, x in enumerate(xs)] + [(-1, None)], "k int, p double")
    want = dict(enumerate(np.interp(xs, [0.1, 0.2, 0.3, 0.5, 0.8], [0.0, 0.375, 0.375, 0.75, 1.0]))) | {-1: None}
    for in_place in (4096, 2):
        got = {r.k: r.p for r in curve.apply(rows, "p", in_place).collect()}
        assert got.keys() == want.keys() and all(got[k] == want[k] or got[k] == pytest.approx(want[k], abs=1e-12) for k in got)
    rng = np.random.default_rng(1)
    many = IsotonicCurve(spark.createDataFrame([(float(x), float(v)) for x, v in zip(np.sort(rng.random(300)), np.sort(rng.random(300)))], "x double, value double"))
    some = spark.createDataFrame([(k, float(x)) for k, x in enumerate(rng.random(500) * 1.2 - 0.1)], "k int, p double")
    a, b = ({r.k: r.p for r in many.apply(some, "p", n).collect()} for n in (4096, 10))
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], abs=1e-12) for k in a)


def test_nothing(spark):
    empty = spark.createDataFrame([], "p double, n long, pos long")
    assert isotonic_blocks(empty).count() == 0 and curve_points(isotonic_blocks(empty)).count() == 0
    rows = spark.createDataFrame([(0.5,)], "p double")
    assert fit_isotonic_curve(empty).apply(rows).first().p is None
