import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from episodica.operators import audit as A
from episodica.operators import drift as D
from episodica.operators import metrics as M
from episodica.operators import rates as R
from episodica.roles import ScoreRoles

ROLES = ScoreRoles("k", "y", "p")


@pytest.fixture(scope="module")
def audit_rows(spark):
    rng = random.Random(2)
    rows = []
    for k in range(2000):
        sex, race = rng.choice(["Male", "Female"]), rng.choice(["White", "White", "Black", "Other"])
        y = 0 if race == "Other" else int(rng.random() < 0.2)
        p = round(min(1.0, max(0.0, rng.gauss(0.3 + 0.1 * y, 0.15))), 2)
        rows.append((k, sex, race, "85+" if k % 2 else "<65", y, p, int(p >= 0.35)))
    return spark.createDataFrame(rows, "k int, sex string, race string, age_bin string, y int, p double, yhat int").cache()


def test_slice_table(audit_rows):
    table = {(r.attribute, r.slice): r for r in A.slice_metrics(audit_rows, roles=ROLES).collect()}
    assert len(table) == 3 + 2 + 3 + 2
    pdf = audit_rows.toPandas()
    for (attribute, name), r in table.items():
        part = pdf if name == A.OVERALL else pdf[pdf[attribute] == name]
        assert (r.n, r.n_pos) == (len(part), part.y.sum()) and r.selection_rate == pytest.approx(part.yhat.mean())
        if name == "Other":
            assert r.pr_auc is None and r.brier is None and r.fnr_at_t is None
            continue
        pos = part[part.y == 1]
        assert r.fnr_at_t == pytest.approx(1 - pos.yhat.mean()) and r.brier == pytest.approx(((part.p - part.y) ** 2).mean())
        one = M.metric_panel(audit_rows if name == A.OVERALL else audit_rows.where(F.col(attribute) == name), ROLES).first()
        if attribute == "sex":
            assert r.pr_auc == pytest.approx(one.pr_auc) and r.recall_at_top10 == pytest.approx(one.recall_at_top10)


def test_parity_gaps(audit_rows):
    pdf = audit_rows.toPandas()
    gaps = {r.attribute: r for r in A.parity_gaps(A.decision_counts(audit_rows)).collect()}
    sel = pdf.groupby("sex").yhat.mean()
    assert gaps["sex"].demographic_parity_difference == pytest.approx(sel.max() - sel.min())
    fnr = 1 - pdf[pdf.y == 1].groupby("sex").yhat.mean()
    assert gaps["sex"].worst_fnr_slice == fnr.idxmax() and gaps["sex"].fnr_gap == pytest.approx(fnr.max() - fnr.min())
    fpr = pdf[pdf.y == 0].groupby("sex").yhat.mean()
    assert gaps["sex"].equalized_odds_difference == pytest.approx(max(fnr.max() - fnr.min(), fpr.max() - fpr.min()))


def test_slice_order_and_reliability(audit_rows):
    table = A.ordered_slices(A.decision_counts(audit_rows))
    race = [r.slice for r in table.where("attribute = 'race'").orderBy("slice_order").collect()]
    assert race[:2] == ["OVERALL", "White"]
    assert [r.slice for r in table.where("attribute = 'sex'").orderBy("slice_order").collect()] == ["OVERALL", "Female", "Male"]
    shown = {(r.attribute, r.slice) for r in A.slice_reliability(audit_rows, ROLES).collect()}
    assert ("race", "Other") not in shown and ("sex", "Male") in shown


def test_drift(spark):
    rng = np.random.default_rng(1)
    ref, cur = np.round(rng.normal(0, 2, 500), 1), np.round(rng.normal(0.5, 2, 300), 1)
    levels_r, levels_c = rng.choice(list("abc"), 500), rng.choice(list("abcd"), 300, p=[0.6, 0.2, 0.1, 0.1])
    rows = [(False, float(v), str(w), 3.0) for v, w in zip(ref, levels_r)] + [(True, float(v), str(w), 3.0) for v, w in zip(cur, levels_c)]
    df = spark.createDataFrame(rows, "cur boolean, x double, g string, same double")
    got = {r.column: r for r in D.drift_report(df, F.col("cur"), ["x", "same"], ["g"]).collect()}
    grid = np.unique(np.r_[ref, cur])
    cdf = lambda s: np.searchsorted(np.sort(s), grid[:-1], "right") / len(s)
    want = np.sum(np.abs(cdf(ref) - cdf(cur)) * np.diff(grid)) / ref.std()
    assert got["x"].distance == pytest.approx(want) and got["same"].distance == 0.0
    p = np.array([(levels_r == c).mean() for c in "abcd"])
    q = np.array([(levels_c == c).mean() for c in "abcd"])
    m = (p + q) / 2
    kl = lambda a: np.sum(a[a > 0] * np.log(a[a > 0] / m[a > 0]))
    assert got["g"].distance == pytest.approx(np.sqrt((kl(p) + kl(q)) / 2))
    summary = D.drift_summary(D.drift_report(df, F.col("cur"), ["x", "same"], ["g"])).first()
    assert summary.n_columns == 3 and summary.n_drifted == sum(r.drifted for r in got.values())


def test_drift_json_round_trip(spark):
    rows = [("a", "Wasserstein distance (normed)", 0.25), ("b", "Jensen-Shannon distance", 0.01)]
    report = spark.createDataFrame(rows, "column string, method string, distance double").withColumns({"threshold": F.lit(0.1), "drifted": F.col("distance") > 0.1})
    text = D.to_drift_json(report)
    assert len(json.loads(text.first().value)["metrics"]) == 2
    back = D.parse_drift_json(text)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, report.select(*back.columns).collect()))
    assert [r.method for r in D.drift_table(back).collect()] == ["Wasserstein", "Jensen-Shannon"]


def test_normalise_types(spark):
    df = spark.createDataFrame([(1, True, "x", None)], "i int, b boolean, s string, f float")
    assert [t for _, t in D.normalise_types(df).dtypes] == ["double", "double", "string", "double"]


def test_label_balance_keeps_empty_class(spark):
    df = spark.createDataFrame([(0,), (0,)], "y int")
    assert {r.y: (r.n, r.share) for r in R.label_balance(df).collect()} == {0: (2, 1.0), 1: (0, 0.0)}


def test_missing_share(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, None, "b")], "x int, y int, z string")
    assert [(r.column, r.share) for r in R.missing_share(df).collect()] == [("y", 1.0), ("x", 0.5)]
    assert R.missing_share(df.select("z")).first().share == 0.0


def test_spearman_against_ml(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    rng = random.Random(4)
    df = spark.createDataFrame([(rng.randrange(5), rng.random(), rng.randrange(100)) for _ in range(300)], "a int, b double, c int")
    vectors = VectorAssembler(inputCols=["a", "b", "c"], outputCol="v").transform(df)
    want = Correlation.corr(vectors, "v", "spearman").first()[0].toArray()
    got = {(r.column_a, r.column_b): r.r for r in R.spearman(df, ["a", "b", "c"]).collect()}
    assert len(got) == 9
    for i, x in enumerate("abc"):
        for j, y in enumerate("abc"):
            assert got[x, y] == pytest.approx(want[i, j], abs=1e-9)


def test_spearman_moves_no_rows_for_columns_with_few_values(spark, monkeypatch):
    rng = random.Random(6)
    df = spark.createDataFrame([(rng.randrange(3), rng.randrange(40), rng.random()) for _ in range(400)], "a int, b int, c double")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        looked_up = R.spearman(df, ["a", "b", "c"])
        assert "SortMergeJoin" not in looked_up._jdf.queryExecution().executedPlan().toString()
        monkeypatch.setattr(R, "LOOKUP_VALUES", 20)
        mixed = R.spearman(df, ["a", "b", "c"])
        assert mixed._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") == 2
        monkeypatch.setattr(R, "LOOKUP_VALUES", 0)
        joined = R.spearman(df, ["a", "b", "c"])
        want = {(r.column_a, r.column_b): pytest.approx(r.r, abs=1e-12) for r in looked_up.collect()}
        assert len(want) == 9
        for other in (mixed, joined):
            assert {(r.column_a, r.column_b): r.r for r in other.collect()} == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
