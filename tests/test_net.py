"""The net's gradient against finite differences, the average of copies, patience, and cases without anything to learn."""

import numpy as np
import pytest

from episodica.operators import net as N

WIDTHS = [5, 7, 4, 1]


def batch(n=40, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 5))
    return x, (rng.random(n) < 0.3).astype(float), rng.uniform(0.5, 4, n)


def test_gradient_equals_finite_differences():
    x, y, w = batch()
    flat = N.untrained(WIDTHS, 1).astype(float)
    loss, g = N.gradient(flat, WIDTHS, x, y, w)
    assert loss == pytest.approx(N.losses(N.margins(flat, WIDTHS, x), y, w).mean())
    for k in range(0, len(flat), 3):
        up, down = flat.copy(), flat.copy()
        up[k] += 1e-6
        down[k] -= 1e-6
        slope = (N.gradient(up, WIDTHS, x, y, w)[0] - N.gradient(down, WIDTHS, x, y, w)[0]) / 2e-6
        assert g[k] == pytest.approx(slope, abs=1e-6)


def table(spark, n=3000, parts=4):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, 3))
    y = (x[:, 0] * x[:, 1] > 0.4).astype(float)
    rows = [(k, [float(v) for v in r], float(t), k % 10 == 0) for k, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "k int, features array<double>, label double, is_validation boolean").repartition(parts, "k"), x, y


def test_pass_is_the_average_of_the_tasks_copies(spark):
    df, x, y = table(spark, 600, 3)
    kept = df.selectExpr("cast(features as array<float>) x", "label y", "is_validation held").cache()
    s = N.NetSettings(hidden=(6,), batch=50, dropout=0.0)
    widths = [3, 6, 1]
    flat = N.untrained(widths, 1)
    values = np.stack([flat, np.zeros_like(flat), np.zeros_like(flat)])
    got, steps, loss = N.pass_over(kept, values, 0, widths, 2.0, s, 0, True)
    from pyspark.sql import functions as F

    parts = kept.withColumn("part", F.spark_partition_id()).toPandas()
    want, total = np.zeros_like(values, float), 0
    for part, rows in parts[~parts.held].groupby("part"):
        state = N.State(values, 0)
        xs, ys = np.array(rows.x.tolist(), np.float32), rows.y.to_numpy(np.float32)
        N.learn(state, widths, xs, ys, np.where(ys > 0, np.float32(2), np.float32(1)), s, np.random.default_rng([s.seed, 0, part]))
        want += state.values.astype(float) * len(rows)
        total += len(rows)
    assert np.allclose(got, want / total, atol=1e-6)
    out = parts[parts.held]
    margin = N.margins(flat, widths, np.array(out.x.tolist(), np.float32))
    assert loss == pytest.approx(N.losses(margin, out.y.to_numpy(), np.where(out.y > 0, 2.0, 1.0)).mean(), rel=1e-5)


def test_learns_stops_and_keeps_the_best(spark, tmp_path):
    df, x, y = table(spark)
    s = N.NetSettings(hidden=(32, 16), batch=64, rate=5e-3, epochs=12, patience=2)
    made = N.fit_net(df, s)
    assert min(made.history) < 0.5 * made.history[0] and len(made.history) <= 13
    stopped = N.fit_net(df, N.NetSettings(hidden=(8,), batch=64, rate=3.0, epochs=12, patience=2))
    assert len(stopped.history) < 13 and len(stopped.history) - 1 - int(np.argmin(stopped.history)) == 2
    scored = made.transform(df).toPandas()
    out = scored[scored.is_validation]
    assert ((out.p > 0.5) == (out.label > 0)).mean() > 0.85
    made.save(spark, str(tmp_path / "net"))
    again = N.FeedForward.load(spark, str(tmp_path / "net")).transform(df).toPandas()
    assert np.allclose(again.sort_values("k").p, scored.sort_values("k").p)
    assert np.array_equal(N.fit_net(df, s).weights, made.weights)


def test_nothing_to_learn(spark):
    schema = "features array<double>, label double, is_validation boolean"
    empty = N.fit_net(spark.createDataFrame([], schema))
    assert empty.transform(spark.createDataFrame([([], 0.0, False)], schema)).first().p == pytest.approx(0, abs=1e-6)
    ones = spark.createDataFrame([([1.0, 2.0], 1.0, False), ([0.0, 1.0], 1.0, None), (None, 1.0, False), ([1.0, 1.0], None, False)], schema)
    scored = N.fit_net(ones).transform(ones).toPandas()
    assert scored.p.dropna().tolist() == pytest.approx([1, 1, 1]) and scored.p.isna().sum() == 1
