"""Forests: tops from summed histograms and handed-over subtrees against each other and a plain tree."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from episodica.operators import trees as T


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(2)
    n = 1500
    x = np.column_stack([np.round(rng.normal(size=n), 2), rng.integers(0, 2, n), rng.integers(0, 30, n), np.zeros(n), np.round(rng.random(n), 3)]).astype(float)
    y = (rng.random(n) < 0.1 + 0.5 * (x[:, 0] > 0.3) * x[:, 1] + 0.3 * (x[:, 2] > 20)).astype(float)
    df = spark.createDataFrame([(k, [float(v) for v in r], float(t)) for k, (r, t) in enumerate(zip(x, y))], "k int, features array<double>, label double")
    return df.repartition(5).cache(), x, y


def nodes_of(ensemble):
    return {r.tree: {n: np.frombuffer(r[n], k).tolist() for n, k in T.KINDS.items()} for r in ensemble.table.collect()}


def as_rules(tree, at=0):
    """A tree as nested tuples, whatever the order of its nodes."""
    if tree["feature"][at] < 0:
        return round(tree["value"][at], 12), tree["cover"][at]
    return tree["feature"][at], tree["cut"][at], as_rules(tree, tree["low"][at]), as_rules(tree, tree["high"][at])


def plain(x, y, edges, leaf, depth):
    """CART on the given cuts: all features, all rows, Gini."""
    n, hits = len(y), y.sum()
    stop = (round(hits / n, 12), n)
    if depth == 0 or hits in (0, n):
        return stop
    best = None
    for f, cuts in enumerate(edges):
        for cut in cuts:
            low = x[:, f] <= cut
            if leaf <= low.sum() <= n - leaf:
                pure = sum(y[s].sum() ** 2 / s.sum() + (s.sum() - y[s].sum()) ** 2 / s.sum() for s in (low, ~low))
                if best is None or pure > best[0] + 1e-9:
                    best = (pure, f, cut, low)
    if best is None or best[0] <= (hits**2 + (n - hits) ** 2) / n + 1e-9:
        return stop
    _, f, cut, low = best
    return f, float(cut), plain(x[low], y[low], edges, leaf, depth - 1), plain(x[~low], y[~low], edges, leaf, depth - 1)


@pytest.mark.parametrize("per_task", [1 << 18, 200, 40])
def test_one_tree_equals_a_plain_one(table, per_task):
    df, x, y = table
    settings = T.ForestSettings(trees=1, depth=6, leaf=20, bootstrap=False, share=1.0)
    edges = T.bin_edges(df, 5)
    got = nodes_of(T.fit_forest(df, settings, per_task))[0]
    assert as_rules(got) == plain(x, y, edges, 20, 6)


def test_tops_and_subtrees_give_the_same_forest(table, spark, tmp_path):
    df, x, y = table
    settings = T.ForestSettings(trees=7, depth=9, leaf=8, seed=3)
    whole, cut = T.fit_forest(df, settings), T.fit_forest(df, settings, per_task=150, trees_at_once=3)
    a, b = nodes_of(whole), nodes_of(cut)
    assert {t: as_rules(v) for t, v in a.items()} == {t: as_rules(v) for t, v in b.items()} and len(a) == 7
    assert len({str(as_rules(v)) for v in a.values()}) == 7
    cut.block_bytes = 1
    p = {r.k: r.p for r in cut.transform(df).collect()}
    whole.save(spark, str(tmp_path / "f"))
    again = {r.k: r.p for r in T.TreeEnsemble.load(spark, str(tmp_path / "f")).transform(df).collect()}
    assert p.keys() == again.keys() and all(p[k] == pytest.approx(again[k], abs=1e-12) for k in p)

    def leaf(rules, row):
        while len(rules) == 4:
            rules = rules[2] if row[rules[0]] <= rules[1] else rules[3]
        return rules[0]

    for k in range(0, 1500, 50):
        assert p[k] == pytest.approx(np.mean([leaf(as_rules(v), x[k]) for v in a.values()]), abs=1e-9)
    order = np.argsort([p[k] for k in range(1500)])
    rank = np.empty(1500)
    rank[order] = np.arange(1500)
    assert (rank[y == 1].mean() - rank[y == 0].mean()) / 1500 + 0.5 > 0.7


def test_samples_are_poisson_and_repeatable():
    ids = np.arange(200_000)
    w = T.occurrences(ids, 4, 42)
    assert np.array_equal(w, T.occurrences(ids, 4, 42)) and not np.array_equal(w, T.occurrences(ids, 5, 42))
    assert abs(w.mean() - 1) < 0.01 and abs(w.var() - 1) < 0.02 and abs((w == 0).mean() - np.exp(-1)) < 0.005


def test_leaves_depth_and_random_cuts(table):
    df, *_ = table
    for random_cuts, per_task in ((False, 1 << 18), (True, 1 << 18), (True, 300)):
        settings = T.ForestSettings(trees=4, depth=5, leaf=30, random_cuts=random_cuts, bootstrap=not random_cuts)
        for tree in nodes_of(T.fit_forest(df, settings, per_task)).values():
            covers = [c for f, c in zip(tree["feature"], tree["cover"]) if f < 0]
            assert min(covers) >= 30 and len(covers) > 4

            def deepest(at, t=tree):
                return 0 if t["feature"][at] < 0 else 1 + max(deepest(t["low"][at]), deepest(t["high"][at]))

            assert deepest(0) <= 5


def test_small_and_strange_tables(spark):
    schema = "k int, features array<double>, label double"
    nothing = spark.createDataFrame([], schema)
    one = spark.createDataFrame([(1, [1.0, 2.0], 1.0)], schema)
    rows = spark.createDataFrame([(k, [1.0, float(k % 3)], 1.0) for k in range(30)] + [(99, None, 1.0), (98, [1.0, 1.0], None)], schema)
    settings = T.ForestSettings(trees=3, leaf=1)
    assert {r.p for r in T.fit_forest(nothing, settings).transform(one).collect()} == {0.0}
    assert {r.p for r in T.fit_forest(rows, settings).transform(one).collect()} == {1.0}
    assert T.fit_forest(one, T.ForestSettings(trees=3, leaf=1, bootstrap=False)).transform(nothing).count() == 0
    same = spark.createDataFrame([(k, [5.0, 5.0], float(k % 2)) for k in range(40)], schema)
    forest = T.fit_forest(same, T.ForestSettings(trees=2, leaf=1, bootstrap=False))
    assert {r.p for r in forest.transform(one).collect()} == {0.5} and {len(t["value"]) for t in nodes_of(forest).values()} == {1}


def test_cut_points_are_quantiles(spark):
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.normal(size=20000), rng.integers(0, 2, 20000), np.repeat(rng.random(10), 2000), rng.exponential(size=20000) ** 3])
    df = spark.createDataFrame([([float(v) for v in r],) for r in x], "features array<double>").repartition(9)
    edges = T.bin_edges(df, 4, shards=3)
    assert len(edges[0]) <= 254 and len(edges[1]) == 2 and len(edges[2]) == 10 and np.array_equal(edges[2], np.unique(x[:, 2]))
    for f in (0, 3):
        shares = np.searchsorted(np.sort(x[:, f]), edges[f], "right") / 20000
        assert np.abs(shares - np.arange(1, 255) / 255).max() < 3 / 1020


def test_handed_rows_are_bits_and_cuts_stay_the_same():
    rng = np.random.default_rng(5)
    bins = (rng.random((3000, 19)) < 0.2).astype(np.uint8)
    bins[:, [0, 7]] = rng.integers(0, 200, (3000, 2))
    bins[:, 4] = 0
    small = T.slim(bins, [0, 7])
    assert small.shape == (3000, 2 + 3) and (T.full(small, [0, 7], 19) == bins).all()
    weight, labels = rng.integers(1, 4, 3000).astype(float), (rng.random(3000) < 0.3).astype(float)
    marks, shape = np.stack([weight, weight * labels]), (19, 200)
    cells = (bins + np.arange(19) * 200).ravel()
    sums = [np.bincount(cells, np.repeat(m, 19), 19 * 200).reshape(shape) for m in marks]
    for units in (None, rng.random(19)):
        for some in (np.arange(19), np.array([1, 2, 4, 9]), np.array([0, 7]), np.array([4])):
            want = T.gini_split(*[s[some] for s in sums], 50, units=None if units is None else units[some])
            got = T.best_cut(bins.T[some], marks, bins.max(axis=0)[some], marks[0].sum(), marks[1].sum(), 50, None if units is None else units[some])
            assert got == (want and want[1:3])


def test_a_task_gives_out_its_sums_once(table, spark):
    df, _, _ = table
    settings = T.ForestSettings(trees=2, leaf=8)
    edges = T.bin_edges(df, 5)
    packed = T.pack_rows(df.coalesce(1), edges).cache()
    levels = max(len(e) for e in edges) + 1
    found = T.split_tops(packed.union(packed).coalesce(1), {0: {}, 1: {}}, [(0, 0), (1, 0)], settings, 5, levels)
    once = T.split_tops(packed, {0: {}, 1: {}}, [(0, 0), (1, 0)], settings, 5, levels)
    assert {k: (r.feature, r.cut, r.total) for k, r in found.items()} == {k: (r.feature, r.cut, 2 * r.total) for k, r in once.items()}


@pytest.mark.parametrize("random_cuts", [False, True])
def test_draws_of_many_nodes_are_those_of_each(random_cuts, monkeypatch):
    nodes = [*range(40), *(int(v) for v in np.random.default_rng(4).integers(0, 1 << 32, 200)), (1 << 32) - 1]
    for seed, tree, width, share in ((42, 0, 111, "sqrt"), (7, 199, 5, 1.0), (0, 3, 12, "sqrt"), (1 << 40, 3, 12, "sqrt")):
        settings = T.ForestSettings(seed=seed, share=share, random_cuts=random_cuts)
        for some in (nodes, [*nodes, 1 << 70]):
            features, units = T.chosen_of_many(settings, tree, some, width)
            for i, node in enumerate(some):
                want, rng = settings.chosen(tree, node, width)
                assert np.array_equal(features[i], want) and (units is None or np.array_equal(units[i], rng.random(len(want))))
    asked = []
    monkeypatch.setattr(T.ForestSettings, "chosen", lambda *a: asked.append(a))
    T.chosen_of_many(T.ForestSettings(random_cuts=random_cuts), 1, nodes, 111)
    assert not asked


@pytest.mark.parametrize("random_cuts", [False, True])
@pytest.mark.parametrize("leaf", [1, 30])
def test_small_nodes_grow_together_as_they_grow_alone(random_cuts, leaf, monkeypatch):
    rng = np.random.default_rng(6)
    bins = (rng.random((9000, 19)) < 0.2).astype(np.uint8)
    bins[:, [0, 7]] = rng.integers(0, 200, (9000, 2))
    bins[:, 4], bins[:, 11] = 0, rng.integers(0, 3, 9000)
    labels = (rng.random(9000) < 0.1 + 0.4 * (bins[:, 0] > 150) + 0.2 * bins[:, 2]).astype(float)
    weight, settings = rng.integers(1, 5, 9000).astype(float), T.ForestSettings(leaf=leaf, depth=12, random_cuts=random_cuts)

    def grown():
        feature, cut, low, high, value, cover = (list(c) for c in zip(*T.grow_subtree(bins, labels, weight, settings, 5, 2, 1)))
        return as_rules({"feature": feature, "cut": cut, "low": low, "high": high, "value": value, "cover": cover})

    for small, rows_at_once in ((1 << 12, 1 << 16), (100, 1 << 16), (1 << 20, 500)):
        monkeypatch.setattr(T, "SMALL", small)
        monkeypatch.setattr(T, "TOGETHER", rows_at_once)
        together = grown()
        monkeypatch.setattr(T, "SMALL", 0)
        assert together == grown()


def test_tasks_add_up_histograms_before_they_meet(table, monkeypatch):
    df, _, _ = table
    settings, edges = T.ForestSettings(trees=2, leaf=8), T.bin_edges(df, 5)
    packed, levels = T.pack_rows(df, edges), max(len(e) for e in edges) + 1
    plain = T.split_tops(packed, {0: {}, 1: {}}, [(0, 0), (1, 0)], settings, 5, levels)
    monkeypatch.setattr(T, "MEETING", 1)
    assert T.split_tops(packed, {0: {}, 1: {}}, [(0, 0), (1, 0)], settings, 5, levels) == plain
