"""Leaf-wise boosting against a plain version on the same cut points."""

import numpy as np
import pytest

from episodica.operators import boosting as B
from episodica.operators.trees import KINDS, bin_edges


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(12)
    n = 1200
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 2, n), rng.gamma(2, size=n), np.ones(n)]).astype(float)
    y = (rng.random(n) < 1 / (1 + np.exp(1 - 2 * x[:, 0] * x[:, 1] - (x[:, 2] > 3)))).astype(float)
    df = spark.createDataFrame([(k, [float(v) for v in r], float(t)) for k, (r, t) in enumerate(zip(x, y))], "k int, features array<double>, label double")
    return df.repartition(4).cache(), x, y


def plain(x, y, edges, rounds, rate, leaves, leaf):
    """Margins after each round; all histograms anew, one split after the other."""
    margin = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    out = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)

        def best(rows):
            found = (0.0, None, None)
            for f, cuts in enumerate(edges):
                for cut in cuts:
                    low, high = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                    if min(len(low), len(high)) >= leaf:
                        gain = g[low].sum() ** 2 / h[low].sum() + g[high].sum() ** 2 / h[high].sum() - g[rows].sum() ** 2 / h[rows].sum()
                        if gain > found[0] + 1e-10:
                            found = (gain, low, high)
            return found

        open_rows = [(*best(np.arange(len(y))), np.arange(len(y)))]
        while len(open_rows) < leaves:
            at = max(range(len(open_rows)), key=lambda i: open_rows[i][0])
            if open_rows[at][0] <= 1e-10:
                break
            _, low, high, _ = open_rows.pop(at)
            open_rows += [(*best(low), low), (*best(high), high)]
        for _, _, _, rows in open_rows:
            margin[rows] -= rate * g[rows].sum() / h[rows].sum()
        out.append(margin.copy())
    return out


@pytest.mark.parametrize(("refresh", "per_task"), [(2, 1 << 18), (50, 300), (50, 0)])
def test_equal_to_a_plain_version(table, refresh, per_task):
    """Whole trees in a task, tops from summed histograms with subtrees below, and histograms alone."""
    df, x, y = table
    settings = B.BoostSettings(rounds=5, rate=0.3, leaves=9, leaf=25, patience=None, refresh=refresh, per_task=per_task)
    model = B.fit_boosting(df, settings)
    want = 1 / (1 + np.exp(-plain(x, y, bin_edges(df, 4), 5, 0.3, 9, 25)[-1]))
    got = {r.k: r.p for r in model.transform(df).collect()}
    assert model.table.count() == 5 and np.allclose([got[k] for k in range(len(y))], want, atol=1e-9)


def test_leaves_and_early_stop(spark, table, tmp_path):
    df, x, y = table
    model = B.fit_boosting(df, B.BoostSettings(rounds=25, rate=0.8, leaves=31, leaf=5, patience=3))
    trees = [{n: np.frombuffer(r[n], k) for n, k in KINDS.items()} for r in model.table.collect()]
    assert 1 <= len(trees) < 25
    for t in trees:
        leaves = t["feature"] < 0
        assert leaves.sum() <= 31 and t["cover"][leaves].min() >= 5 and t["cover"][0] < len(y)
        assert t["cover"][leaves].sum() == pytest.approx(t["cover"][0])
    model.save(spark, str(tmp_path / "m"))
    again = type(model).load(spark, str(tmp_path / "m"))
    a, b = ({r.k: r.p for r in m.transform(df).collect()} for m in (model, again))
    assert a == b
    p = np.array([a[k] for k in range(len(y))])
    assert -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean() < 0.9 * -(y.mean() * np.log(y.mean()) + (1 - y.mean()) * np.log(1 - y.mean()))


def test_best_first_waits_for_unknown_children():
    def node(gain, children=None):
        return B.Node(np.zeros((3, 0)), gain, 0 if gain else -1, 0, children)

    nodes = [node(9, (1, 2)), node(5, (3, 4)), node(4), node(1), node(0)]
    assert B.best_first(nodes, 10) == ([0, 1], [4, 2, 3])  # node 2 is next, but its children are unknown
    assert B.best_first(nodes, 2) == ([0], [1, 2])
    assert B.best_first([node(0)], 5) == ([], [0])


def test_strange_tables(spark):
    schema = "k int, features array<double>, label double"
    one = spark.createDataFrame([(1, [1.0, 2.0], 1.0)], schema)
    assert B.fit_boosting(one.where("false")).transform(one).first().p == 0.0 and B.fit_boosting(one).transform(one).first().p == 1.0
    flat = spark.createDataFrame([(k, [1.0, 1.0], float(k % 4 == 0)) for k in range(40)] + [(50, None, 1.0), (51, [1.0, 1.0], None)], schema)
    assert B.fit_boosting(flat, B.BoostSettings(leaf=1)).transform(one).first().p == pytest.approx(0.25)


def test_attributions_add_up_to_the_margin(table):
    from pyspark.sql import functions as F

    from episodica.operators.explain import tree_attributions

    df, *_ = table
    model = B.fit_boosting(df, B.BoostSettings(rounds=3, rate=0.4, leaves=6, leaf=30, patience=None))
    phi, base = tree_attributions(df, model, ["a", "b", "c", "d"], "k")
    total = {r.k: r.s + base for r in phi.groupBy("k").agg(F.sum("phi").alias("s")).collect()}
    for r in model.transform(df).collect():
        assert total[r.k] == pytest.approx(np.log(r.p / (1 - r.p)), abs=1e-9)


@pytest.mark.parametrize("product", [1, 7, 1 << 14])
def test_two_bin_features_are_summed_by_products(product, monkeypatch):
    monkeypatch.setattr(B, "PRODUCT", product)
    rng = np.random.default_rng(3)
    sizes = np.array([2, 5, 1, 2, 2, 9])
    firsts = np.append(0, np.cumsum(sizes))
    for n in (0, 1, 40):
        bins = np.column_stack([rng.integers(0, s, n) for s in sizes]).astype(np.uint8)
        g, h = rng.normal(size=n), rng.random(n)
        want = np.zeros((3, firsts[-1]))
        for row, a, b in zip(bins, g, h, strict=True):
            want[:, firsts[:-1] + row] += np.array([[1.0], [a], [b]])
        found = B.histogram(bins, g, h, firsts)
        assert np.array_equal(found[0], want[0])
        assert np.allclose(found, want, atol=1e-12)
