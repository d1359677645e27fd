"""Readers and writers: raw text files with provenance, tables, reports, and the input manifest."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episodica.plans.claims import CLAIM_COLUMNS, SNAPSHOT_COLUMNS

# File name patterns, kinds per sample and known broken files of the public claim files.
CLAIM_GLOB = "DE1_0_2008_to_2010_Inpatient_Claims_Sample_*.csv"
SNAPSHOT_GLOB = "DE1_0_*_Beneficiary_Summary_File_Sample_*.csv"
FILE_KINDS = (
    ("beneficiary_2008", "de1_0_2008_beneficiary_summary_file_sample_"),
    ("beneficiary_2009", "de1_0_2009_beneficiary_summary_file_sample_"),
    ("beneficiary_2010", "de1_0_2010_beneficiary_summary_file_sample_"),
    ("inpatient", "de1_0_2008_to_2010_inpatient_claims_sample_"),
    ("outpatient", "de1_0_2008_to_2010_outpatient_claims_sample_"),
)
KNOWN_BROKEN = ("de1_0_2010_beneficiary_summary_file_sample_1.zip",)


def matching_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """``(path, file_name)`` of the files that match, listed by Spark without opening them."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return listing.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"))


def read_text_csv(spark: SparkSession, folder: str, pattern: str, columns) -> DataFrame:
    """All files that match, every column as text, chosen by header name; raises if there is no file.

    Provenance comes as ``file_name``.  All files must have the header of the first one; Spark raises on
    a file that differs.
    """
    try:
        found = [r.path for r in matching_files(spark, folder, pattern).collect()]
    except AnalysisException as error:
        raise FileNotFoundError(f"no file {pattern} in {folder}") from error
    if not found:
        raise FileNotFoundError(f"no file {pattern} in {folder}")
    header = spark.read.option("header", True).csv(sorted(found)[0]).columns
    missing = [c for c in columns if c not in header]
    if missing:
        raise ValueError(f"{pattern}: missing columns {missing}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    # enforceSchema=False makes Spark check each file's header against the schema
    rows = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(sorted(found))
    return rows.select(*columns, F.col("_metadata.file_name").alias("file_name"))


def file_number(column: str, pattern: str):
    return F.regexp_extract(column, pattern, 1).try_cast("int")


def read_claims(spark: SparkSession, folder: str) -> DataFrame:
    """Raw claims of all samples, with ``sample`` from the file name."""
    rows = read_text_csv(spark, folder, CLAIM_GLOB, CLAIM_COLUMNS)
    return rows.withColumn("sample", file_number("file_name", r"Sample_(\d+)")).drop("file_name")


def read_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Raw yearly snapshots of all samples and years, with ``sample`` and ``year`` from the file name."""
    rows = read_text_csv(spark, folder, SNAPSHOT_GLOB, SNAPSHOT_COLUMNS)
    return rows.withColumns(
        {"sample": file_number("file_name", r"Sample_(\d+)"), "year": file_number("file_name", r"DE1_0_(\d{4})_")}
    ).drop("file_name")


def stack_years(spark: SparkSession, folders: dict[int, str], columns, pattern: str = "*.csv") -> DataFrame:
    """Yearly text files of one folder a year in long form, with ``year``; raises for a year without files."""
    out = None
    for year, folder in sorted(folders.items()):
        part = read_text_csv(spark, folder, pattern, columns).drop("file_name").withColumn("year", F.lit(int(year)))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise FileNotFoundError("no year to stack")
    return out


def sample_numbers(spark: SparkSession, first: int, last: int | None = None) -> DataFrame:
    """``(sample)``: the numbers from ``first`` to ``last``, or ``first`` alone."""
    return spark.range(first, (first if last is None else last) + 1).select(F.col("id").cast("int").alias("sample"))


def expected_files(spark: SparkSession, samples) -> DataFrame:
    """``(sample, kind, file_name)``: five files per sample, without the known broken ones."""
    numbers = spark.createDataFrame([(int(s),) for s in samples], "sample int")
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(p).alias("prefix")) for k, p in FILE_KINDS])
    rows = numbers.select("sample", F.inline(kinds))
    named = rows.select("sample", "kind", F.concat("prefix", F.col("sample").cast("string"), F.lit(".zip")).alias("file_name"))
    return named.where(~F.col("file_name").isin(*KNOWN_BROKEN))


def canonical_csv_name(file_name):
    """Archive name to the name of the CSV inside: upper-case first token, capitalised words, numbers as they are."""
    parts = F.split(F.regexp_replace(F.col(file_name), r"\.[^.]*$", ""), "_")
    word = lambda w: (
        F.when(F.lower(w) == "de1", F.upper(w)).when(F.lower(w) == "to", F.lit("to")).otherwise(F.initcap(w))
    )
    return F.concat(F.array_join(F.transform(parts, word), "_"), F.lit(".csv"))


def missing_files(spark: SparkSession, samples, folder: str) -> DataFrame:
    """Expected files whose CSV is not in the folder."""
    wanted = expected_files(spark, samples).withColumn("csv_name", canonical_csv_name("file_name"))
    present = matching_files(spark, folder, "*.csv").select(F.col("file_name").alias("csv_name"))
    return wanted.join(present, "csv_name", "left_anti")


def write_table(df: DataFrame, path: str, partition_by=(), compression: str = "zstd") -> None:
    df.write.mode("overwrite").option("compression", compression).partitionBy(*partition_by).parquet(path)


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One split of a feature table; the filter prunes the folders when the table is partitioned by split."""
    try:
        table = spark.read.parquet(path)
    except AnalysisException as error:
        raise FileNotFoundError(f"no feature table at {path}: build the cohort and the features first") from error
    return table.where(F.col("split") == split)


def write_key_table(df: DataFrame, path: str, keys=("claim_id", "beneficiary_id"), part: str = "split") -> None:
    write_table(df.select(*keys, part), path)


def write_scores(df: DataFrame, path: str, key: str = "claim_id", label: str = "y") -> None:
    """Keyed scores, one folder per model."""
    write_table(df.select(key, label, "model", "p"), path, ["model"])


def write_curves(curves: dict[str, DataFrame], path: str) -> None:
    """Curves as one long table ``(model, curve, idx, x, y)``; the last two columns of each frame are x and y."""
    out = None
    for name, curve in curves.items():
        x, y = curve.columns[-2:]
        long = curve.select("model", F.lit(name).alias("curve"), "idx", F.col(x).alias("x"), F.col(y).alias("y"))
        out = long if out is None else out.unionByName(long)
    write_table(out, path)


def write_summary_json(df: DataFrame, path: str) -> None:
    """A small aggregate as JSON lines in one file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_summary_json(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_report_csv(df: DataFrame, path: str) -> None:
    """A small report as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_report_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def write_audit_rows(df: DataFrame, path: str, attributes=("sex", "race", "age_bin"), key: str = "claim_id") -> None:
    """Row-level predictions with the audited attributes."""
    write_table(df.select(key, *attributes, "y", "p", "yhat"), path)
