"""Ranking metrics, curves, reliability, fairness slices and drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from episodica.functions.ordered import global_cumsum
from episodica.operators import audit as A
from episodica.operators import drift as D
from episodica.operators import explain as X
from episodica.operators import metrics as M
from episodica.operators import models as L
from episodica.operators import reports as Q
from episodica.plans import views as V
from episodica.plans.catalog.registry import query, rnd
from episodica.roles import ScoreRoles

ROLES = ScoreRoles("claim", "y", "p")
AUDIT_ROLES = ScoreRoles("claim_id", "y", "p")
METRICS = ("pr_auc", "roc_auc", "brier", "log_loss", "recall_at_top10", "precision_at_top10")


def panel_sql(source: str, by: str, key: str = "claim") -> str:
    """CTE ``panel`` with all metrics per ``by`` (comma-separated names), from row-level windows."""
    return f"""pg AS (SELECT {by}, p, count(*) AS n, sum(y)::DOUBLE AS pos, (count(*) - sum(y))::DOUBLE AS neg FROM {source} GROUP BY {by}, p),
pc AS (SELECT *, sum(n) OVER (PARTITION BY {by} ORDER BY p DESC) AS cn, sum(pos) OVER (PARTITION BY {by} ORDER BY p DESC) AS cp,
         coalesce(sum(neg) OVER (PARTITION BY {by} ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM pg),
pa AS (SELECT {by}, sum(pos * cp / cn) / nullif(sum(pos), 0) AS pr_auc, sum(pos * (nb + neg / 2)) / nullif(sum(pos) * sum(neg), 0) AS roc_auc,
         sum(n)::BIGINT AS n, sum(pos)::BIGINT AS n_pos FROM pc GROUP BY {by}),
pb AS (SELECT {by}, avg((p - y) * (p - y)) AS brier,
         avg(-(y * ln(greatest(least(p, 1 - 1e-7), 1e-7)) + (1 - y) * ln(1 - greatest(least(p, 1 - 1e-7), 1e-7)))) AS log_loss FROM {source} GROUP BY {by}),
pr AS (SELECT {by}, y, row_number() OVER (PARTITION BY {by} ORDER BY p DESC, md5(CAST({key} AS VARCHAR) || '|42'), {key}) AS r,
         greatest(1, round_even(count(*) OVER (PARTITION BY {by}) * 0.1::DOUBLE, 0)) AS k FROM {source}),
pk AS (SELECT {by}, sum(y) FILTER (WHERE r <= k) AS sel, any_value(k) AS k FROM pr GROUP BY {by}),
panel AS (SELECT *, CASE WHEN n_pos > 0 THEN sel::DOUBLE / n_pos ELSE 0.0 END AS recall_at_top10, CASE WHEN n_pos > 0 THEN sel::DOUBLE / k ELSE 0.0 END AS precision_at_top10
  FROM pa JOIN pb USING ({by}) JOIN pk USING ({by}))"""


PANEL = f"{V.SCORES}, {panel_sql('scores', 'model')}"
PANEL_COLUMNS = ", ".join(rnd(m, m) for m in METRICS)


def panel(spark, sf):
    return M.metric_panel(V.scores(spark, sf), ROLES, by=["model"])


ONE = f"{V.SCORED}, g AS (SELECT p, count(*) AS n, sum(y)::BIGINT AS pos, (count(*) - sum(y))::BIGINT AS neg FROM sc GROUP BY p)"


@query(
    "e6_cumulative_counts",
    f"WITH {ONE} SELECT {rnd('p', 'p')}, n, pos, (sum(n) OVER w)::BIGINT AS cum_n, (sum(pos) OVER w)::BIGINT AS cum_pos, (sum(neg) OVER w)::BIGINT AS cum_neg FROM g WINDOW w AS (ORDER BY p DESC)",
)
def cumulative_counts(spark, sf):
    counts = M.score_counts(V.scored(spark, sf), ROLES)
    return M.ranked_counts(counts, "p").select("p", "n", "pos", "cum_n", "cum_pos", "cum_neg")


@query("i1_average_precision", f"WITH {PANEL} SELECT model, {rnd('pr_auc', 'pr_auc')} FROM panel")
def average_precision(spark, sf):
    return M.ranking_scores(V.scores(spark, sf), ROLES, ["model"]).select("model", "pr_auc")


@query("i2_roc_auc", f"WITH {PANEL} SELECT model, {rnd('roc_auc', 'roc_auc')} FROM panel")
def roc_auc(spark, sf):
    return M.ranking_scores(V.scores(spark, sf), ROLES, ["model"]).select("model", "roc_auc")


@query("i3_brier", f"WITH {V.SCORES} SELECT model, {rnd('avg((p - y) * (p - y))', 'brier')} FROM scores GROUP BY model")
def brier(spark, sf):
    return M.loss_scores(V.scores(spark, sf), ROLES, ["model"]).select("model", "brier")


@query("i4_log_loss", f"WITH {PANEL} SELECT model, {rnd('log_loss', 'log_loss')} FROM panel")
def log_loss(spark, sf):
    return M.loss_scores(V.scores(spark, sf), ROLES, ["model"]).select("model", "log_loss")


@query("i5_recall_precision_at_top", f"WITH {PANEL} SELECT model, {rnd('recall_at_top10', 'recall_at_top10')}, {rnd('precision_at_top10', 'precision_at_top10')} FROM panel")
def recall_precision_at_top(spark, sf):
    return panel(spark, sf).select("model", "recall_at_top10", "precision_at_top10")


@query("i7_metric_panel", f"WITH {PANEL} SELECT model, {PANEL_COLUMNS}, n, n_pos FROM panel")
def metric_panel(spark, sf):
    return panel(spark, sf)


@query("i7_metric_panel_single", f"WITH {V.SCORED}, one AS (SELECT 1 AS b, * FROM sc), {panel_sql('one', 'b')} SELECT {PANEL_COLUMNS}, n, n_pos FROM panel")
def metric_panel_single(spark, sf):
    """The same panel without groups, on one model."""
    return M.metric_panel(V.scored(spark, sf), ROLES)


@query("f4_top_fraction", f"WITH {PANEL.replace('SELECT model, y, row_number()', 'SELECT model, y, claim, row_number()')} SELECT model, claim, y::BIGINT AS y FROM pr WHERE r <= k")
def top_fraction(spark, sf):
    return M.top_rows(V.scores(spark, sf), ROLES, ["model"]).select("model", "claim", "y")


def _points(points: str, x: str, y: str) -> str:
    return f"""lastp AS (SELECT model, max(idx) AS last FROM {points} GROUP BY model),
slots AS (SELECT model, j, CASE WHEN last < 200 THEN j ELSE j * last // 199 END AS pos_at FROM lastp, range(0, 200) t(j) WHERE last >= 200 OR j <= last)
SELECT s.model, j AS idx, {rnd(x, x)}, {rnd(y, y)} FROM slots s JOIN {points} ON {points}.model = s.model AND {points}.idx = pos_at"""


EACH = f"{V.SCORES}, g AS (SELECT model, p, count(*) AS n, sum(y)::BIGINT AS pos, (count(*) - sum(y))::BIGINT AS neg FROM scores GROUP BY model, p), tot AS (SELECT model, count(*) AS points, sum(pos)::DOUBLE AS pos, sum(neg)::DOUBLE AS neg FROM g GROUP BY model)"


@query(
    "i6_pr_curve",
    f"""WITH {EACH}, c AS (SELECT model, p, sum(n) OVER w AS cn, sum(pos) OVER w AS cp, count(*) OVER (PARTITION BY model) - row_number() OVER w AS idx FROM g WINDOW w AS (PARTITION BY model ORDER BY p DESC)),
 pts AS (SELECT c.model, idx, cp::DOUBLE / tot.pos AS recall, cp::DOUBLE / cn AS "precision" FROM c JOIN tot ON tot.model = c.model
   UNION ALL SELECT model, points, 0.0, 1.0 FROM tot), {_points('pts', 'recall', '"precision"')}""",
)
def pr_curve(spark, sf):
    return M.pr_curve(V.scores(spark, sf), ROLES, ["model"], max_points=200)


@query(
    "i6_roc_curve",
    f"""WITH {EACH}, c AS (SELECT model, p, pos, neg, sum(neg) OVER w AS cf, sum(pos) OVER w AS cp, lead(pos) OVER w AS np, lead(neg) OVER w AS nn, row_number() OVER w AS r FROM g WINDOW w AS (PARTITION BY model ORDER BY p DESC)),
 kept AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY p DESC) AS idx FROM c WHERE r = 1 OR np IS NULL OR np <> pos OR nn <> neg),
 pts AS (SELECT k.model, idx, cf::DOUBLE / tot.neg AS fpr, cp::DOUBLE / tot.pos AS tpr FROM kept k JOIN tot ON tot.model = k.model UNION ALL SELECT model, 0, 0.0, 0.0 FROM tot),
 {_points('pts', 'fpr', 'tpr')}""",
)
def roc_curve(spark, sf):
    return M.roc_curve(V.scores(spark, sf), ROLES, ["model"], max_points=200)


def _edges(n_bins: int, by: str) -> str:
    probs = ", ".join(f"{i / n_bins!r}" for i in range(1, n_bins))
    return f"list_transform(quantile_cont(p, [{probs}]), lambda x: round(x, 9))"


@query(
    "i8_reliability",
    f"""WITH {V.SCORES}, e AS (SELECT model, {_edges(15, 'model')} AS edges FROM scores GROUP BY model),
 b AS (SELECT s.model, p, y, len(list_filter(edges, lambda x: x <= round(p, 9)))::BIGINT AS bin FROM scores s JOIN e ON e.model = s.model)
 SELECT model, bin, {rnd('avg(p)', 'mean_pred', 6)}, {rnd('avg(y)', 'frac_pos', 6)}, count(*) AS n FROM b GROUP BY model, bin""",
    digits=6,
)
def reliability(spark, sf):
    return M.quantile_reliability(V.scores(spark, sf), ROLES, ["model"], 15)


@query("i9_lift", f"WITH {PANEL} SELECT model, {rnd('n_pos::DOUBLE / n', 'prevalence')}, {rnd('pr_auc * n / n_pos', 'lift')} FROM panel")
def lift(spark, sf):
    return M.lift(panel(spark, sf)).select("model", "prevalence", "lift")


# ---------------------------------------------------------------- leaderboards and comparisons
@query("f2_leaderboard", f"WITH {PANEL} SELECT model, {rnd('pr_auc', 'pr_auc')} FROM panel ORDER BY pr_auc DESC, model")
def leaderboard(spark, sf):
    return L.leaderboard(panel(spark, sf)).select("model", "pr_auc")


_LONG = " UNION ALL ".join(f"SELECT model, '{m}' AS metric, {m} AS value, {1 if m in ('brier', 'log_loss') else -1} * {m} AS signed FROM panel" for m in METRICS)


@query("f3_metric_ranks", f"WITH {PANEL}, l AS ({_LONG}) SELECT model, metric, {rnd('value', 'value')}, rank() OVER (PARTITION BY metric ORDER BY round(signed, 10)) AS rank FROM l")
def metric_ranks(spark, sf):
    rounded = panel(spark, sf).select("model", *[F.round(m, 10).alias(m) for m in METRICS])
    return L.rank_metrics(rounded, METRICS)


@query(
    "f6_extreme_rows",
    f"""WITH {V.SCORED}, r AS (SELECT *, row_number() OVER (ORDER BY p DESC, claim) AS rh, row_number() OVER (ORDER BY p, claim) AS rl FROM sc)
 SELECT 'high' AS risk_bucket, rh - 1 AS rank, claim, {rnd('p', 'p')} FROM r WHERE rh <= 3 UNION ALL SELECT 'low', rl - 1, claim, {rnd('p', 'p')} FROM r WHERE rl <= 3""",
)
def extreme_rows(spark, sf):
    return X.extreme_rows(V.scored(spark, sf), "p", "claim").select("risk_bucket", "rank", "claim", "p")


@query(
    "f7_first_best",
    f"WITH {PANEL} SELECT (SELECT model FROM panel ORDER BY brier, model LIMIT 1) AS lowest_brier, (SELECT model FROM panel ORDER BY pr_auc DESC, model LIMIT 1) AS highest_ap",
)
def first_best(spark, sf):
    return panel(spark, sf).agg(
        F.min_by("model", F.struct("brier", "model")).alias("lowest_brier"), F.min_by("model", F.struct(-F.col("pr_auc"), F.col("model"))).alias("highest_ap")
    )


@query("l13_winner", f"WITH {PANEL} SELECT model, {rnd('pr_auc', 'pr_auc')} FROM panel ORDER BY panel.pr_auc DESC, model LIMIT 1")
def winner(spark, sf):
    return L.pick_winner(panel(spark, sf))


# scores moved towards the label stand for tuned models
_TUNED = "tuned AS (SELECT claim, id, y, model, 0.9::DOUBLE * p + 0.1::DOUBLE * y AS p FROM scores WHERE model <> 'm3')"


@query(
    "c6_tuned_vs_baseline",
    f"""WITH {V.SCORES}, {_TUNED}, base AS (SELECT * FROM scores WHERE model <> 'm2'), {panel_sql('tuned', 'model')},
 tp AS (SELECT * FROM panel), {panel_sql('base', 'model').replace('pg AS', 'qg AS').replace('FROM pg', 'FROM qg').replace('pc AS', 'qc AS').replace('FROM pc', 'FROM qc').replace('pa AS', 'qa AS').replace('pb AS', 'qb AS').replace('pr AS', 'qr AS').replace('FROM pr ', 'FROM qr ').replace('pk AS', 'qk AS').replace('panel AS', 'bp AS').replace('FROM pa JOIN pb', 'FROM qa JOIN qb').replace('JOIN pk', 'JOIN qk')}, """
    + "j AS ("
    + " UNION ALL ".join(f"SELECT t.model, '{m}' AS metric, t.{m} AS tuned, b.{m} AS baseline, {-1 if m == 'brier' else 1} AS s FROM tp t LEFT JOIN bp b ON b.model = t.model" for m in ("pr_auc", "roc_auc", "brier"))
    + f") SELECT model, metric, {rnd('tuned', 'tuned', 9)}, {rnd('baseline', 'baseline', 9)}, {rnd('tuned - baseline', 'delta', 9)}, s * (tuned - baseline) > 0 AS improved FROM j",
    digits=9,
)
def tuned_vs_baseline(spark, sf):
    scores = V.scores(spark, sf)
    tuned = scores.where("model <> 'm3'").withColumn("p", F.lit(0.9) * F.col("p") + F.lit(0.1) * F.col("y"))
    base = scores.where("model <> 'm2'")
    return L.compare_to_baseline(M.metric_panel(tuned, ROLES, ["model"]), M.metric_panel(base, ROLES, ["model"]), ("pr_auc", "roc_auc", "brier"))


@query(
    "c7_aligned_scores",
    f"WITH {V.LAB} SELECT claim, y::BIGINT AS y, {', '.join(rnd(V.score_sql(m), m) for m in ('m1', 'm2', 'm3'))} FROM lab",
)
def aligned_scores(spark, sf):
    return L.align_scores(V.scores(spark, sf), ("m1", "m2", "m3"), "claim")


@query("l10_soft_vote", f"WITH {V.SCORES} SELECT claim, any_value(y)::BIGINT AS y, {rnd('avg(p)', 'p')} FROM scores GROUP BY claim")
def soft_vote(spark, sf):
    return L.soft_vote(V.scores(spark, sf), "claim")


@query(
    "q1_board_view",
    f"""WITH {PANEL} SELECT model AS "Model", {rnd('pr_auc', '"PR-AUC"')}, {rnd('roc_auc', '"ROC-AUC"')}, {rnd('brier', '"Brier"')}, {rnd('recall_at_top10', '"Recall@10%"')} FROM panel""",
)
def board_view(spark, sf):
    return Q.report_view(panel(spark, sf), ("model", "pr_auc", "roc_auc", "brier", "recall_at_top10"))


@query(
    "q4_against_previous_best",
    f"""WITH {PANEL}, prev AS (SELECT model, pr_auc FROM panel WHERE model <> 'm3' ORDER BY pr_auc DESC LIMIT 1)
 SELECT p.model, {rnd('p.pr_auc', 'pr_auc')}, prev.model AS best_model, {rnd('prev.pr_auc', 'best_value')}, {rnd('p.pr_auc - prev.pr_auc', 'delta')} FROM panel p, prev WHERE p.model = 'm3'""",
)
def against_previous_best(spark, sf):
    board = panel(spark, sf)
    return Q.against_previous_best(board.where("model = 'm3'"), board.where("model <> 'm3'"))


# ---------------------------------------------------------------- fairness
_COUNTS = "cnt AS (SELECT attribute, slice, count(*) AS n, sum(y)::BIGINT AS n_pos, sum(yhat)::BIGINT AS n_flagged, count(*) FILTER (WHERE y = 1 AND yhat = 0) AS fn, count(*) FILTER (WHERE y = 0 AND yhat = 1) AS fp FROM audo GROUP BY attribute, slice)"


@query("d23_grouping_sets", f"WITH {V.AUDL}, {_COUNTS} SELECT * FROM cnt")
def grouping_sets(spark, sf):
    return A.decision_counts(V.audit_rows(spark, sf))


def _mixed(expression: str, alias: str) -> str:
    return rnd(f"CASE WHEN c.n_pos > 0 AND c.n_pos < c.n THEN {expression} END", alias)


SLICES = f"""{V.AUDL}, {_COUNTS}, {panel_sql('audo', 'attribute, slice', 'claim_id')}, slices AS (
 SELECT c.attribute, c.slice, c.n, c.n_pos, {rnd('c.n_pos::DOUBLE / c.n', 'prevalence')}, {rnd('n_flagged::DOUBLE / c.n', 'selection_rate')},
  {_mixed('brier', 'brier')}, {_mixed('pr_auc', 'pr_auc')}, {_mixed('roc_auc', 'roc_auc')}, {_mixed('recall_at_top10', 'recall_at_top10')},
  {_mixed('fn::DOUBLE / c.n_pos', 'fnr_at_t')}, {_mixed('fp::DOUBLE / (c.n - c.n_pos)', 'fpr_at_t')}
 FROM cnt c JOIN panel p ON p.attribute = c.attribute AND p.slice = c.slice)"""


@query("m2_slice_metrics", f"WITH {SLICES} SELECT * FROM slices WHERE attribute = 'race'")
def slice_metrics(spark, sf):
    return A.slice_metrics(V.audit_rows(spark, sf), roles=AUDIT_ROLES, attributes=("race",))


@query("m3_slice_table", f"WITH {SLICES} SELECT * FROM slices")
def slice_table(spark, sf):
    return A.slice_metrics(V.audit_rows(spark, sf), roles=AUDIT_ROLES)


@query(
    "m4_parity_gaps",
    f"""WITH {V.AUDL}, {_COUNTS}, r AS (SELECT attribute, slice, n_flagged::DOUBLE / n AS sel, coalesce(fn::DOUBLE / nullif(n_pos, 0), 0) AS fnr,
  coalesce((n_pos - fn)::DOUBLE / nullif(n_pos, 0), 0) AS tpr, coalesce(fp::DOUBLE / nullif(n - n_pos, 0), 0) AS fpr FROM cnt WHERE slice <> 'OVERALL')
 SELECT attribute, {rnd('max(sel) - min(sel)', 'demographic_parity_difference')}, {rnd('greatest(max(tpr) - min(tpr), max(fpr) - min(fpr))', 'equalized_odds_difference')},
  {rnd('max(fnr)', 'fnr_max')}, {rnd('min(fnr)', 'fnr_min')}, {rnd('max(fnr) - min(fnr)', 'fnr_gap')},
  first(slice ORDER BY fnr DESC, slice) AS worst_fnr_slice, first(slice ORDER BY fnr, slice) AS best_fnr_slice FROM r GROUP BY attribute""",
)
def parity_gaps(spark, sf):
    return A.parity_gaps(A.decision_counts(V.audit_rows(spark, sf)))


@query(
    "m5_slice_reliability",
    f"""WITH {V.AUDL}, s AS (SELECT attribute, slice FROM audl GROUP BY attribute, slice HAVING count(*) >= 200 AND sum(y) > 0 AND sum(y) < count(*)),
 e AS (SELECT attribute, slice, {_edges(10, '')} AS edges FROM audl GROUP BY attribute, slice),
 b AS (SELECT a.attribute, a.slice, p, y, len(list_filter(edges, lambda x: x < round(p, 9)))::BIGINT AS bin FROM audl a
   JOIN s ON s.attribute = a.attribute AND s.slice = a.slice JOIN e ON e.attribute = a.attribute AND e.slice = a.slice)
 SELECT attribute, slice, bin, {rnd('avg(p)', 'mean_pred', 6)}, {rnd('avg(y)', 'frac_pos', 6)}, count(*) AS n FROM b GROUP BY attribute, slice, bin""",
    digits=6,
)
def slice_reliability(spark, sf):
    return A.slice_reliability(V.audit_rows(spark, sf), AUDIT_ROLES)


@query("q3_slices_of_attribute", f"""WITH {SLICES} SELECT slice AS "Group", n, prevalence AS "Prevalence", pr_auc AS "PR-AUC", fnr_at_t AS "FNR@t", fpr_at_t AS "FPR@t" FROM slices WHERE attribute = 'sex'""")
def slices_of_attribute(spark, sf):
    table = A.slice_metrics(V.audit_rows(spark, sf), roles=AUDIT_ROLES)
    return Q.report_view(Q.slices_of(table, "sex"), ("slice", "n", "prevalence", "pr_auc", "fnr_at_t", "fpr_at_t"))


# ---------------------------------------------------------------- drift: lines shipped before and from 1998 on
_NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
_LEVELS = ("l_returnflag", "l_linestatus", "l_linenumber")
_SIDE = "l AS (SELECT *, l_shipdate >= TIMESTAMP '1998-01-01' AS cur FROM lineitem)"


def _line_sides(spark, sf):
    return V.table(spark, sf, "lineitem"), F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")


def _wasserstein(c: str) -> str:
    return f"""SELECT '{c}' AS "column", 'Wasserstein distance (normed)' AS method, sum(abs(cr - cc) * (nv - v)) / greatest((SELECT stddev_pop({c}) FROM l WHERE NOT cur), 0.001) AS distance FROM (
  SELECT v, lead(v) OVER (ORDER BY v) AS nv, sum(r) OVER (ORDER BY v) / sum(r) OVER () AS cr, sum(q) OVER (ORDER BY v) / sum(q) OVER () AS cc FROM (
    SELECT {c} AS v, count(*) FILTER (WHERE NOT cur)::DOUBLE AS r, count(*) FILTER (WHERE cur)::DOUBLE AS q FROM l GROUP BY {c}))"""


def _jensen_shannon(c: str) -> str:
    return f"""SELECT '{c}', 'Jensen-Shannon distance', sqrt(greatest(sum(CASE WHEN r > 0 THEN r * ln(2 * r / (r + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(2 * q / (r + q)) ELSE 0 END) / 2, 0)) FROM (
  SELECT count(*) FILTER (WHERE NOT cur)::DOUBLE / (SELECT count(*) FROM l WHERE NOT cur) AS r, count(*) FILTER (WHERE cur)::DOUBLE / (SELECT count(*) FROM l WHERE cur) AS q FROM l GROUP BY {c})"""


DRIFT = f"{_SIDE}, dr AS ({' UNION ALL '.join([_wasserstein(c) for c in _NUMERIC] + [_jensen_shannon(c) for c in _LEVELS])})"


def drift(spark, sf):
    lines, current = _line_sides(spark, sf)
    return D.drift_report(lines, current, _NUMERIC, _LEVELS, threshold=0.005)


@query("n1_drift_report", f'WITH {DRIFT} SELECT "column", method, {rnd("distance", "distance", 7)}, 0.005::DOUBLE AS threshold, distance > 0.005 AS drifted FROM dr', digits=7)
def drift_report(spark, sf):
    return drift(spark, sf)


@query("n2_numeric_drift", f"""WITH {DRIFT} SELECT "column", method, {rnd('distance', 'distance', 7)} FROM dr WHERE method LIKE 'W%'""", digits=7)
def numeric_drift(spark, sf):
    lines, current = _line_sides(spark, sf)
    return D.numeric_drift(lines, current, _NUMERIC)


@query("n3_level_drift", f"""WITH {DRIFT} SELECT "column", method, {rnd('distance', 'distance', 7)} FROM dr WHERE method LIKE 'J%'""", digits=7)
def level_drift(spark, sf):
    lines, current = _line_sides(spark, sf)
    return D.level_drift(lines, current, _LEVELS)


@query(
    "n4_drift_summary",
    f"WITH {DRIFT} SELECT count(*) AS n_columns, count(*) FILTER (WHERE distance > 0.005) AS n_drifted, {rnd('avg(CAST(distance > 0.005 AS INTEGER))', 'share_drifted')}, avg(CAST(distance > 0.005 AS INTEGER)) >= 0.5 AS dataset_drifted FROM dr",
)
def drift_summary(spark, sf):
    return D.drift_summary(drift(spark, sf))


@query(
    "n5_drift_table",
    f"""WITH {DRIFT} SELECT "column", replace(replace(method, ' distance', ''), ' (normed)', '') AS method, {rnd('distance', 'distance', 7)}, 0.005::DOUBLE AS threshold, distance > 0.005 AS drifted FROM dr ORDER BY distance DESC LIMIT 5""",
    digits=7,
)
def drift_table(spark, sf):
    return D.drift_table(drift(spark, sf), 5)
