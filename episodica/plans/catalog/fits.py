"""Single steps of the fitting algorithms on the given tables, where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from episodica.functions.ordered import value_counts
from episodica.operators import encode as E
from episodica.operators import isotonic as I
from episodica.operators import linear as N
from episodica.operators import splits as P
from episodica.plans import views as V
from episodica.plans.catalog.decisions import _MIX, _TEXT, SPEC, TRAIN, _all, _mixed, _train
from episodica.plans.catalog.registry import query, rnd

# ---------------------------------------------------------------- one Newton step of a logistic model at given coefficients
STEP = {"los_days": 0.03, "age_at_admit": 0.004, "chronic_count": -0.1, "num_diagnoses": 0.02}
SHIFT = -1.5
_X = [*STEP, "1.0::DOUBLE"]
_P = f"(1 / (1 + exp(-({' + '.join(f'{w}::DOUBLE * {c}' for c, w in STEP.items())} + {SHIFT}::DOUBLE))))"
_PARTS = [
    f"SELECT 'hessian' AS part, {i} AS i, {j} AS j, sum(p * (1 - p) * x{i} * x{j}) / count(*) AS value FROM f" for i in range(len(_X)) for j in range(i, len(_X))
] + [f"SELECT 'gradient', {i}, -1, sum((p - y) * x{i}) / count(*) FROM f" for i in range(len(_X))] + [
    "SELECT 'loss', -1, -1, sum(-(y * ln(p) + (1 - y) * ln(1 - p))) / count(*) FROM f"
]


@query(
    "l1_newton_step",
    f"WITH {TRAIN}, f AS (SELECT y::DOUBLE AS y, {_P} AS p, {', '.join(f'{c}::DOUBLE AS x{i}' for i, c in enumerate(_X))} FROM train), "
    f"parts AS ({' UNION ALL '.join(_PARTS)}) SELECT part, i::BIGINT AS i, j::BIGINT AS j, {rnd('value', 'value')} FROM parts",
)
def newton_step(spark, sf):
    """Mean curvature, gradient and loss of a logistic model on four columns, at fixed coefficients."""
    rows = _train(spark, sf).select(F.array(*[F.col(c).cast("double") for c in STEP]).alias("x"), "y")
    sums = N.curvature(rows, [*STEP.values(), SHIFT], "x", "y")
    return sums.withColumn("value", F.col("value") / rows.select(F.count(F.lit(1))).scalar())


# ---------------------------------------------------------------- isotonic blocks by the min-max formula
@query(
    "j2_isotonic_blocks",
    f"""WITH {_MIX}, c AS (SELECT model, p, count(*) AS n, sum(y) AS pos FROM sm GROUP BY model, p),
 o AS (SELECT model, p, n, pos, row_number() OVER w AS i, sum(n) OVER w AS cn, sum(pos) OVER w AS cp FROM c WINDOW w AS (PARTITION BY model ORDER BY p)),
 means AS (SELECT a.model, a.i AS j, b.i AS i, (b.cp - a.cp + a.pos)::DOUBLE / (b.cn - a.cn + a.n)::DOUBLE AS mean FROM o a JOIN o b ON b.model = a.model AND b.i >= a.i),
 least AS (SELECT model, j, i, min(mean) OVER (PARTITION BY model, j ORDER BY i DESC ROWS UNBOUNDED PRECEDING) AS low FROM means),
 fit AS (SELECT model, i, max(low) AS value FROM least GROUP BY model, i)
 SELECT model, {rnd('min(p)', 'low')}, {rnd('max(p)', 'high')}, sum(n)::DOUBLE AS n, sum(pos)::DOUBLE AS pos, {rnd('any_value(value)', 'value')}
 FROM fit JOIN o USING (model, i) GROUP BY model, value""",
)
def isotonic_blocks(spark, sf):
    """Pooled blocks of every model's calibration curve."""
    counts = value_counts(_mixed(spark, sf), "p", ["model"], pos=F.sum(F.col("y").cast("bigint")))
    return I.isotonic_blocks(counts, by=["model"], per_range=256)


# ---------------------------------------------------------------- label means of the rows before each row
_ORDERED = " UNION ALL ".join(f"SELECT claim_id, '{c}' AS feature, {_TEXT.format(c=c)} AS level, y::DOUBLE AS y, md5(claim_id || '|42') AS h FROM train" for c in SPEC.cat_high)
_BEFORE = "OVER (PARTITION BY feature, level ORDER BY h, claim_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


@query(
    "l3_ordered_target",
    f"WITH {TRAIN}, o AS ({_ORDERED}), b AS (SELECT claim_id, feature, level, count(*) {_BEFORE} AS n_before, coalesce(sum(y) {_BEFORE}, 0) AS s FROM o) "
    f"SELECT claim_id, feature, level, n_before, {rnd('(s + (SELECT avg(y::DOUBLE) FROM train)) / (n_before + 1)', 'encoded')} FROM b",
)
def ordered_target(spark, sf):
    """Ordered target statistics of the high-cardinality columns over the training rows."""
    return E.ordered_target(_train(spark, sf), SPEC.cat_high, "y", "claim_id")


@query(
    "l3_level_target",
    f"WITH {TRAIN}, o AS ({_ORDERED}) SELECT feature, level, count(*) AS n, {rnd('(sum(y) + (SELECT avg(y::DOUBLE) FROM train)) / (count(*) + 1)', 'encoded')} FROM o GROUP BY feature, level",
)
def level_target(spark, sf):
    return E.level_target(_train(spark, sf), SPEC.cat_high, "y")


# ---------------------------------------------------------------- folds with even rows and positives
def _coarse(n: str) -> str:
    return f"(({n} >> greatest(length(bin({n})) - 6, 0)) << greatest(length(bin({n})) - 6, 0))"


_FOLDS = f"""{V.SPLIT}, ent AS (SELECT beneficiary_id AS e, count(*) AS n, sum(y)::BIGINT AS p FROM feats GROUP BY 1),
rough AS (SELECT e, {_coarse('n')} AS n, {_coarse('p')} AS p FROM ent),
hist AS (SELECT n, p, count(*) AS m FROM rough GROUP BY n, p),
allof AS (SELECT sum(n * m)::HUGEINT AS tn, greatest(sum(p * m), 1)::HUGEINT AS tp FROM hist),
heavy AS (SELECT n, p, m, n * tp + p * tn AS w FROM hist, allof),
inside AS (SELECT e, n, p, m, w, row_number() OVER (PARTITION BY n, p ORDER BY md5(e || '|42'), e) AS place FROM rough JOIN heavy USING (n, p)),
line AS (SELECT n, p, w, row_number() OVER (ORDER BY w DESC, n, p, m, place) AS i FROM inside),
deal AS (
  SELECT 0::BIGINT AS i, NULL::BIGINT AS n, NULL::BIGINT AS p, NULL::INTEGER AS fold, [{{'load': 0::HUGEINT, 'fold': 0}}, {{'load': 0::HUGEINT, 'fold': 1}}, {{'load': 0::HUGEINT, 'fold': 2}}] AS folds
  UNION ALL
  SELECT l.i, l.n, l.p, d.folds[1].fold, list_sort([{{'load': d.folds[j].load + CASE WHEN j = 1 THEN l.w ELSE 0 END, 'fold': d.folds[j].fold}} FOR j IN range(1, 4)]) FROM deal d JOIN line l ON l.i = d.i + 1),
given AS (SELECT n, p, f.fold, (SELECT count(*) FROM deal d WHERE d.n = h.n AND d.p = h.p AND d.fold <= f.fold) AS upto FROM heavy h, (VALUES (0), (1), (2)) f(fold)),
folds AS (SELECT e, count(*) FILTER (WHERE place > upto) AS fold FROM inside JOIN given USING (n, p) GROUP BY e)"""


@query(
    "h7_balanced_folds",
    f"WITH RECURSIVE {_FOLDS} SELECT claim_id, beneficiary_id, fold::BIGINT AS fold FROM feats JOIN folds ON e = beneficiary_id",
)
def balanced_folds(spark, sf):
    return P.assign_balanced_folds(_all(spark, sf), "beneficiary_id", "claim_id").select("claim_id", "beneficiary_id", "fold")


@query(
    "g3_planted_leak",
    f"WITH {V.SPLIT}, two AS (SELECT beneficiary_id, split FROM feats UNION ALL SELECT beneficiary_id, 'late' FROM feats WHERE length(claim_id) % 2 = 0 AND right(claim_id, 1) = '7') "
    "SELECT beneficiary_id, count(DISTINCT split) AS n_parts FROM two GROUP BY beneficiary_id HAVING count(DISTINCT split) > 1",
)
def planted_leak(spark, sf):
    """Entities whose later rows were given to a part of their own: all of them are found."""
    rows = _all(spark, sf)
    late = rows.where("length(claim_id) % 2 = 0 and right(claim_id, 1) = '7'").withColumn("split", F.lit("late"))
    return P.leaking_entities(rows.select("beneficiary_id", "split").union(late.select("beneficiary_id", "split")), "beneficiary_id")
