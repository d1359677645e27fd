"""Readers, writers, guards and checks: the given tables go to the shared folder and come back through the operator."""

from __future__ import annotations

from pyspark.sql import functions as F

from episodica.operators import audit as A
from episodica.operators import drift as D
from episodica.operators import reports as R
from episodica.operators import score as O
from episodica.operators import splits as P
from episodica.operators.linear import LinearModel
from episodica.plans import views as V
from episodica.plans.catalog.decisions import _all
from episodica.plans.catalog.registry import ORACLE, QUERIES, query, rnd
from episodica.roles import FeatureSpec, project_features
from episodica.sources import files
from episodica.sources.shared import shared_path

SPEC = FeatureSpec()
TEXT = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_clerkless")


def _orders_csv(spark, sf):
    """Orders as text in several CSV files, with a column that no reader asks for."""
    folder = shared_path(spark, "orders-csv")
    rows = V.table(spark, sf, "orders").select(*[F.col(c).cast("string") for c in TEXT[:4]], F.lit("x").alias("o_clerkless"))
    rows.repartition(5, "o_orderkey").write.option("header", True).csv(folder)
    return folder


@query("a1_text_scan", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, o_orderpriority FROM orders")
def text_scan(spark, sf):
    """Several CSV files by pattern, all columns as text, the wanted ones by header name."""
    return files.read_text_csv(spark, _orders_csv(spark, sf), "*.csv", TEXT[:4]).drop("file_name")


_NAME = "concat('DE1_0_', CAST(1990 + s_suppkey % 20 AS {t}), '_Beneficiary_Summary_File_Sample_', CAST(s_suppkey AS {t}), '.csv')"


@query("a2_file_numbers", "SELECT s_suppkey, s_suppkey::BIGINT AS sample, (1990 + s_suppkey % 20)::BIGINT AS year FROM supplier")
def file_numbers(spark, sf):
    """Sample and year out of file names."""
    named = V.table(spark, sf, "supplier").select("s_suppkey", F.expr(_NAME.format(t="string")).alias("file_name"))
    sample, year = files.file_number("file_name", r"Sample_(\d+)"), files.file_number("file_name", r"DE1_0_(\d{4})_")
    return named.select("s_suppkey", sample.alias("sample"), year.alias("year"))


_KEPT = "(c_custkey * 7 + y) % 5 <> 0"


@query("a3_stacked_years", f"SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_mktsegment, y::BIGINT AS year FROM customer, range(1995, 2001) t(y) WHERE {_KEPT}")
def stacked_years(spark, sf):
    """One text snapshot of the customers a year, stacked into long form."""
    folders = {}
    for year in range(1995, 2001):
        folders[year] = shared_path(spark, f"snapshot-{year}")
        rows = V.table(spark, sf, "customer").where(_KEPT.replace("y)", f"{year})")).select(F.col("c_custkey").cast("string"), "c_mktsegment")
        rows.write.option("header", True).csv(folders[year])
    return files.stack_years(spark, folders, ("c_custkey", "c_mktsegment"))


@query(
    "a5_input_guard",
    """SELECT '*.csv' AS pattern, 'read' AS outcome, count(*) AS n FROM orders UNION ALL SELECT 'claims_*.csv', 'no file', NULL FROM (SELECT 1)
 UNION ALL SELECT 'column', 'missing columns', NULL FROM (SELECT 1)""",
)
def input_guard(spark, sf):
    """What the reader says to files that are there, to a pattern without files, and to a header without a wanted column."""
    folder = _orders_csv(spark, sf)
    out = files.read_text_csv(spark, folder, "*.csv", TEXT).agg(F.lit("*.csv").alias("pattern"), F.lit("read").alias("outcome"), F.count(F.lit(1)).alias("n"))
    for name, pattern, columns, error in (("claims_*.csv", "claims_*.csv", TEXT, FileNotFoundError), ("column", "*.csv", ("o_nothing",), ValueError)):
        try:
            files.read_text_csv(spark, folder, pattern, columns)
            said = "read"
        except error as problem:
            said = "no file" if error is FileNotFoundError else str(problem).split(": ")[1].split(" [")[0]
        out = out.union(spark.createDataFrame([(name, said, None)], "pattern string, outcome string, n long"))
    return out


@query("a6_stored_cohort", ORACLE["b17_cohort"])
def stored_cohort(spark, sf):
    """The cohort as compressed Parquet in one folder a sample, read back."""
    path, rows = shared_path(spark, "cohort"), QUERIES["b17_cohort"](spark, sf)
    files.write_table(rows, path, ["sample"])
    back = spark.read.schema(rows.schema).parquet(path)
    return back.select(*rows.columns)


@query("a9_summary_json", ORACLE["j1_cost_threshold"])
def summary_json(spark, sf):
    """The chosen thresholds as a JSON summary, read back."""
    path, rows = shared_path(spark, "summary"), QUERIES["j1_cost_threshold"](spark, sf)
    files.write_summary_json(rows, path)
    return files.read_summary_json(spark, path, rows.schema)


@query("a10_report_csv", ORACLE["d2_split_summary"])
def report_csv(spark, sf):
    """The split summary as a CSV report, read back."""
    path, rows = shared_path(spark, "report"), QUERIES["d2_split_summary"](spark, sf)
    files.write_report_csv(rows, path)
    return files.read_report_csv(spark, path, rows.schema)


@query(
    "a12_stored_curves",
    f"SELECT model, 'pr' AS curve, idx, recall AS x, \"precision\" AS y FROM ({ORACLE['i6_pr_curve']}) UNION ALL SELECT model, 'roc', idx, fpr, tpr FROM ({ORACLE['i6_roc_curve']})",
)
def stored_curves(spark, sf):
    """Both curves of a model as one long table, read back."""
    path = shared_path(spark, "curves")
    columns = {"pr": ("recall", "precision"), "roc": ("fpr", "tpr")}
    files.write_curves({c: QUERIES[f"i6_{c}_curve"](spark, sf).select("model", "idx", *xy) for c, xy in columns.items()}, path)
    return spark.read.parquet(path)


# fixed coefficients over columns of the line items
WEIGHTS, SHIFT = {"l_quantity": 0.02, "l_discount": -3.0, "l_tax": 5.0}, -0.7
_MARGIN = " + ".join(f"{w}::DOUBLE * {c}::DOUBLE" for c, w in WEIGHTS.items())


@query("a13_saved_model", f"SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, {rnd(f'1 / (1 + exp(-({_MARGIN} + {SHIFT}::DOUBLE)))', 'p')} FROM lineitem")
def saved_model(spark, sf):
    """A linear model saved, loaded again and compiled to one expression over the line items."""
    path = shared_path(spark, "model")
    LinearModel(list(WEIGHTS.values()), SHIFT).save(spark, path)
    rows = V.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.array(*[F.col(c).cast("double") for c in WEIGHTS]).alias("features"))
    return LinearModel.load(spark, path).transform(rows).drop("features")


_FEATURES = f"WITH {V.SPLIT} SELECT {{}} FROM feats"


@query("b20_feature_order", _FEATURES.format(", ".join(SPEC.features())))
def feature_order(spark, sf):
    """The features in the order of the spec, out of a table with further columns in another order."""
    rows = _all(spark, sf)
    return project_features(rows.select(*sorted(rows.columns, reverse=True)), SPEC)


_ROLE_CASTS = [
    *[f"CAST({c} AS DOUBLE) AS {c}" for c in SPEC.numeric], *[f"CAST({c} AS BOOLEAN) AS {c}" for c in SPEC.binary],
    *[f"CAST({c} AS VARCHAR) AS {c}" for c in (*SPEC.cat_low, *SPEC.cat_high)],
]


@query("o1_feature_types", _FEATURES.format(", ".join(["claim_id", *_ROLE_CASTS])))
def feature_types(spark, sf):
    """Features checked and cast by role, as the scorer wants them."""
    return O.to_feature_types(_all(spark, sf).select("claim_id", *SPEC.features()), SPEC)


_PLAIN = ("los_days", "chronic_count", "is_weekend_admit", "chronic_chf", "sex", "state_code", "admit_date", "admit_dx_code")


@query(
    "b29_plain_types",
    _FEATURES.format("claim_id, los_days::DOUBLE AS los_days, chronic_count::DOUBLE AS chronic_count, is_weekend_admit::INTEGER::DOUBLE AS is_weekend_admit, chronic_chf::INTEGER::DOUBLE AS chronic_chf, "
                     "CAST(sex AS VARCHAR) AS sex, state_code::DOUBLE AS state_code, CAST(admit_date AS VARCHAR) AS admit_date, admit_dx_code"),
)
def plain_types(spark, sf):
    """Numbers and flags as doubles, all else as text, before drift is measured."""
    return D.normalise_types(_all(spark, sf).select("claim_id", *_PLAIN))


@query("b30_drift_json", ORACLE["n1_drift_report"], digits=7)
def drift_json(spark, sf):
    """A drift report as a JSON document and flattened again."""
    return D.parse_drift_json(D.to_drift_json(QUERIES["n1_drift_report"](spark, sf)))


_POSITION = " ".join(
    [f"WHEN slice = '{A.OVERALL}' THEN 0"] + [f"WHEN attribute = '{a}' AND slice = '{s}' THEN {i + 1}" for a, names in A.SLICE_ORDER.items() for i, s in enumerate(names)]
)


@query("f8_slice_order", f"SELECT attribute, slice, n, (CASE {_POSITION} ELSE 1099511627776 - n END)::BIGINT AS slice_order FROM ({ORACLE['m3_slice_table']})")
def slice_order(spark, sf):
    """The slices of the audit with the order in which a report shows them."""
    return A.ordered_slices(QUERIES["m3_slice_table"](spark, sf)).select("attribute", "slice", "n", "slice_order")


_LOST = "right(claim_id, 1) = '3'"


@query(
    "g4_broken_entities",
    f"WITH {V.SPLIT} SELECT beneficiary_id, count(*) FILTER (WHERE NOT {_LOST}) AS n_sample, count(*) AS n_full FROM feats GROUP BY beneficiary_id "
    f"HAVING count(*) FILTER (WHERE {_LOST}) > 0 AND count(*) FILTER (WHERE NOT {_LOST}) > 0",
)
def broken_entities(spark, sf):
    """A sample that lost rows of its entities: each such entity is found."""
    rows = _all(spark, sf)
    return P.broken_entities(rows, rows.where(f"not {_LOST}"), "beneficiary_id")


@query("g5_partition_gaps", f"WITH {V.SPLIT} SELECT count(*) AS n_rows, count(*) FILTER (WHERE {_LOST}) AS n_unassigned FROM feats")
def partition_gaps(spark, sf):
    """Rows whose part was lost are counted as unassigned."""
    return P.partition_check(_all(spark, sf).withColumn("half", F.when(~F.expr(_LOST), F.col("split"))))


@query(
    "h8_hold_out",
    f"WITH {V.SPLIT}, r AS (SELECT claim_id, row_number() OVER (ORDER BY md5(claim_id || '|42'), claim_id) AS place, count(*) OVER () AS n FROM feats) "
    "SELECT claim_id, place <= least(greatest(1024, floor(n * 0.1::DOUBLE)), floor(n / 2)) AS is_validation FROM r",
)
def held_out(spark, sf):
    """Rows held out at random for early stopping."""
    return P.hold_out(_all(spark, sf), "claim_id").select("claim_id", "is_validation")


@query("q2_combined_boards", f"SELECT model, pr_auc, brier, 'all' AS board FROM ({ORACLE['i7_metric_panel']}) UNION ALL SELECT model, NULL, brier, 'brier' FROM ({ORACLE['i7_metric_panel']})")
def combined_boards(spark, sf):
    """Leaderboards under one another; one has fewer columns, one is missing."""
    panel = QUERIES["i7_metric_panel"](spark, sf)
    return R.combine_boards({"all": panel.select("model", "pr_auc", "brier"), "none": None, "brier": panel.select("model", "brier")})
