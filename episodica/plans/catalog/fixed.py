"""What follows from fitted models, on fixed coefficients, and further flows over the features: all with SQL."""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from episodica.functions.ordered import exact_quantiles
from episodica.operators import drift as D
from episodica.operators import explain as X
from episodica.operators import score as O
from episodica.plans import views as V
from episodica.plans.catalog.decisions import _all
from episodica.plans.catalog.evaluation import _jensen_shannon, _wasserstein
from episodica.plans.catalog.registry import query, rnd

# a linear model with given coefficients over columns of the line items
WEIGHTS = {"quantity": 0.03, "discount": -7.0, "tax": 11.0}
_CELLS = " UNION ALL ".join(f"SELECT k, '{c}' AS feature, {c} AS value, {w}::DOUBLE * ({c} - m_{c}) AS phi FROM x, m" for c, w in WEIGHTS.items())
PHI = f"""x AS (SELECT l_orderkey * 10 + l_linenumber AS k, l_quantity::DOUBLE AS quantity, l_discount::DOUBLE AS discount, l_tax::DOUBLE AS tax FROM lineitem),
m AS (SELECT {', '.join(f'avg({c}) AS m_{c}' for c in WEIGHTS)} FROM x), phi AS ({_CELLS})"""


def _phi(spark, sf):
    lines = V.table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"), *[F.col(f"l_{c}").cast("double").alias(c) for c in WEIGHTS]
    )
    rows = VectorAssembler(inputCols=list(WEIGHTS), outputCol="features").transform(lines)
    model = SimpleNamespace(coefficients=list(WEIGHTS.values()), intercept=-0.5)
    return X.linear_attributions(rows, model, list(WEIGHTS), X.vector_mean(rows), "k")[0]


@query("p1_fixed_attributions", f"WITH {PHI} SELECT k, feature, {rnd('value', 'value')}, {rnd('phi', 'phi')} FROM phi")
def fixed_attributions(spark, sf):
    return _phi(spark, sf)


@query(
    "d20_fixed_summary",
    f"WITH {PHI}, s AS (SELECT feature, avg(abs(phi)) AS a, avg(phi) AS b FROM phi GROUP BY feature) SELECT feature, {rnd('a', 'mean_abs')}, {rnd('b', 'mean_signed')}, row_number() OVER (ORDER BY a DESC, feature) AS rank FROM s",
)
def fixed_summary(spark, sf):
    return X.importance(_phi(spark, sf))


@query(
    "f9_fixed_top",
    f"WITH {PHI} SELECT k, feature, {rnd('value', 'value')}, {rnd('phi', 'phi')}, row_number() OVER (PARTITION BY k ORDER BY abs(phi) DESC, feature) AS rank FROM phi QUALIFY rank <= 2",
)
def fixed_top(spark, sf):
    return X.top_contributions(_phi(spark, sf), "k", 2)


@query(
    "p3_fixed_caps",
    f"WITH {PHI} SELECT feature, {rnd('quantile_cont(value, 0.05)', 'low')}, {rnd('quantile_cont(value, 0.95)', 'high')} FROM phi GROUP BY feature",
)
def fixed_caps(spark, sf):
    return exact_quantiles(_phi(spark, sf), "value", {"low": 0.05, "high": 0.95}, ["feature"])


def _outside(c: str, low, high) -> str:
    test = f"{c} < {low}" + (f" OR {c} > {high}" if high is not None else "")
    return f"SELECT '{c}:range' AS rule, count(*) AS n FROM feats WHERE {test} HAVING count(*) > 0"


@query("o2_quarantine", f"WITH {V.SPLIT} " + " UNION ALL ".join(_outside(c, *bounds) for c, bounds in O.RANGES.items()))
def quarantine(spark, sf):
    """Rows that a scorer refuses, per broken rule."""
    _, refused = O.in_range(_all(spark, sf), O.RANGES)
    return refused.select(F.explode("failed").alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


_NUMERIC = ("los_days", "age_at_admit", "num_diagnoses", "num_procedures", "prior_6mo_inpatient_count", "days_since_last_discharge_imputed", "chronic_count", "admit_month", "admit_dow", "y")
_LEVELS = ("sex", "race", "age_bin")
_PARTS = " UNION ALL ".join([_wasserstein(c) for c in _NUMERIC] + [_jensen_shannon(c) for c in _LEVELS])


@query(
    "n1_feature_drift",
    f"""WITH {V.SPLIT}, l AS (SELECT *, split = 'val' AS cur FROM feats WHERE split IN ('train', 'val')), dr AS ({_PARTS})
 SELECT "column", method, {rnd("distance", "distance", 7)}, 0.1::DOUBLE AS threshold, distance > 0.1 AS drifted FROM dr""",
    digits=7,
)
def feature_drift(spark, sf):
    """Features and label of the validation split against the training split."""
    rows = _all(spark, sf).where("split in ('train', 'val')")
    return D.drift_report(rows, F.col("split") == "val", _NUMERIC, _LEVELS, threshold=0.1)
