import hashlib
import random

import numpy as np
import pytest

from episodica.operators import decide as D
from episodica.operators import metrics as M
from episodica.roles import ScoreRoles

ROLES = ScoreRoles("k", "y", "p")


def scored(n=700, seed=3, digits=2):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        y = int(rng.random() < 0.15)
        p = 0.5 if rng.random() < 0.33 else round(min(1.0, max(0.0, rng.gauss(0.3 + 0.2 * y, 0.2))), digits)
        rows.append(("m" + str(k % 2), k, y, p))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "g string, k int, y int, p double")


def by_hand(rows):
    y, p = np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
    ap, last = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        hit = p >= t
        recall = y[hit].sum() / y.sum()
        ap += (recall - last) * y[hit].mean()
        last = recall
    pos, neg = p[y == 1], p[y == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    c = np.clip(p, 1e-7, 1 - 1e-7)
    k = max(1, round(len(y) * 0.1))
    order = sorted(rows, key=lambda r: (-r[3], hashlib.md5(f"{r[1]}|42".encode()).hexdigest(), r[1]))[:k]
    sel = sum(r[2] for r in order)
    loss = -np.mean(y * np.log(c) + (1 - y) * np.log(1 - c))
    return {"pr_auc": ap, "roc_auc": auc, "brier": np.mean((p - y) ** 2), "log_loss": loss,
            "recall_at_top10": sel / y.sum(), "precision_at_top10": sel / k, "n": len(y), "n_pos": y.sum()}


@pytest.mark.parametrize("seed", [3, 4])
def test_panel(spark, seed):
    rows = scored(seed=seed)
    got = {r.g: r for r in M.metric_panel(frame(spark, rows), ROLES, ["g"]).collect()}
    for g in ("m0", "m1"):
        for name, want in by_hand([r for r in rows if r[0] == g]).items():
            assert got[g][name] == pytest.approx(want, abs=1e-12), name
    one = M.metric_panel(frame(spark, rows), ROLES).first()
    for name, want in by_hand(rows).items():
        assert one[name] == pytest.approx(want, abs=1e-12), name


def test_one_class(spark):
    got = M.metric_panel(frame(spark, [("g", i, 0, i / 10) for i in range(10)]), ROLES).first()
    assert got.pr_auc is None and got.roc_auc is None and got.recall_at_top10 == 0.0 and got.n_pos == 0


def test_top_k_rounds_half_to_even(spark):
    rows = [(f"n{n}", 1000 * n + i, i % 2, (i * 7 % n) / n) for n in (5, 25, 35) for i in range(n)]
    got = M.top_rows(frame(spark, rows), ROLES, ["g"]).groupBy("g").count().collect()
    assert {r.g: r["count"] for r in got} == {"n5": 1, "n25": 2, "n35": 4}
    assert M.top_rows(frame(spark, rows), ROLES).count() == round(65 * 0.1)


def test_curves(spark):
    rows = scored(300)
    df = frame(spark, rows)
    y, p = np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
    cuts = sorted(set(p))
    pr = [(r.idx, r.recall, r.precision) for r in M.pr_curve(df, ROLES).orderBy("idx").collect()]
    want = [(y[p >= t].sum() / y.sum(), y[p >= t].mean()) for t in cuts] + [(0.0, 1.0)]
    assert [i for i, *_ in pr] == list(range(len(want)))
    assert np.allclose([v[1:] for v in pr], want)
    # the same curve thinned out by evenly spaced index
    small = M.pr_curve(df, ROLES, max_points=10).orderBy("idx").collect()
    picked = np.linspace(0, len(want) - 1, 10).astype(int)
    assert np.allclose([(r.recall, r.precision) for r in small], [want[i] for i in picked])
    fp = np.array([((p >= t) & (y == 0)).sum() for t in cuts[::-1]])
    tp = np.array([((p >= t) & (y == 1)).sum() for t in cuts[::-1]])
    keep = [i for i in range(len(fp)) if i in (0, len(fp) - 1) or fp[i + 1] - 2 * fp[i] + fp[i - 1] or tp[i + 1] - 2 * tp[i] + tp[i - 1]]
    want = [(0.0, 0.0)] + [(fp[i] / fp[-1], tp[i] / tp[-1]) for i in keep]
    roc = M.roc_curve(df, ROLES).orderBy("idx").collect()
    assert np.allclose([(r.fpr, r.tpr) for r in roc], want)


@pytest.mark.parametrize("upper", [True, False])
def test_reliability(spark, upper):
    rows = scored(500)
    y, p = np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
    edges = np.round(np.quantile(p, np.linspace(0, 1, 16)), 9)[1:-1]
    bins = np.digitize(np.round(p, 9), edges) if upper else np.searchsorted(edges, np.round(p, 9))
    got = {r.bin: r for r in M.quantile_reliability(frame(spark, rows), ROLES, n_bins=15, upper_side=upper).collect()}
    assert set(got) == set(bins)
    for b, r in got.items():
        assert r.n == (bins == b).sum() and r.mean_pred == pytest.approx(p[bins == b].mean()) and r.frac_pos == pytest.approx(y[bins == b].mean())


def test_cost_sweep_against_loops(spark):
    rows = scored(400, digits=3) + [("m0", 9001, 1, 1.0), ("m1", 9002, 0, 0.0), ("m0", 9003, 1, 0.006)]
    y, p = np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
    grid = np.linspace(0, 1, 501)
    got = D.cost_sweep(frame(spark, rows), ROLES).orderBy("grid_idx").collect()
    want = []
    for t in grid:
        tp, fp = int(((p >= t) & (y == 1)).sum()), int(((p >= t) & (y == 0)).sum())
        want.append((tp, fp, 15000.0 * (y.sum() - tp) + 500.0 * (tp + fp)))
    assert [(r.tp, r.fp, r.cost) for r in got] == want
    best = D.pick_threshold(D.cost_sweep(frame(spark, rows), ROLES)).first()
    i = int(np.argmin([w[2] for w in want]))
    assert best.grid_idx == i and best.threshold == pytest.approx(grid[i])
    done = D.with_baselines(D.pick_threshold(D.cost_sweep(frame(spark, rows), ROLES))).first()
    assert done.cost <= min(done.always_cost, done.never_cost) and done.tn + done.fp + done.fn + done.tp == len(rows)


def test_all_negative_flags_no_one(spark):
    rows = [("g", i, 0, 0.99 * i / 99) for i in range(100)]
    best = D.pick_threshold(D.cost_sweep(frame(spark, rows), ROLES)).first()
    assert best.cost == 0 and best.threshold >= 0.99


def test_published_cost_arithmetic(spark):
    counts = spark.createDataFrame([(12608, 77391, 273, 9282)], "tn long, fp long, fn long, tp long")
    parts = D.cost_parts(counts).first()
    assert parts.cost_missed + parts.cost_needless + parts.cost_useful == 47_431_500


def test_calibrators(spark):
    rows = scored(1500, seed=9, digits=4)
    df = frame(spark, rows)
    calib, test = df.where("k % 2 = 0"), df.where("k % 2 = 1")
    fitted, panel = D.calibrate(calib, test, ROLES)
    briers = {r.method: r.brier for r in panel.collect()}
    assert D.pick_method(panel).first().method == min(D.METHODS, key=lambda m: briers[m])
    for name in D.METHODS:
        out = fitted[name].apply(test).selectExpr("min(p) as lo", "max(p) as hi", "count(*) as n").first()
        assert 0 <= out.lo <= out.hi <= 1 and out.n == test.count()
    iso = [r.p for r in fitted["isotonic"].apply(test.select("k", "y", "p", test.p.alias("raw"))).orderBy("raw").collect()]
    assert all(a <= b + 1e-12 for a, b in zip(iso, iso[1:]))
    # weighted distinct scores give the logistic fit of all rows
    x, t = np.array([r[3] for r in rows if r[1] % 2 == 0]), np.array([r[2] for r in rows if r[1] % 2 == 0])
    w = np.zeros(2)
    design = np.c_[np.ones_like(x), x]
    for _ in range(50):
        q = 1 / (1 + np.exp(-design @ w))
        w += np.linalg.solve(design.T @ (design * (q * (1 - q))[:, None]), design.T @ (t - q))
    model = fitted["platt"].model
    assert np.allclose([model.intercept, model.coefficients[0]], w, atol=1e-3)


def test_sums_beyond_long(spark):
    """Ten billion rows on each of two scores: the products of counts exceed 64 bits."""
    half = 5 * 10**9
    counts = spark.createDataFrame([(0.2, 2 * half, half, half), (0.7, 2 * half, half, half)], "p double, n long, pos long, neg long")
    ranked = M.ranked_counts(counts, "p")
    got = M._aggregate(ranked, [], M._ranking_sums()).first()
    assert got.pr_auc == pytest.approx(0.5) and got.roc_auc == pytest.approx(0.5)
