"""The operators as stages of a pipeline: ``(spark, docs, sf_dir) -> DataFrame`` with the columns of ``docs``.

A stage works on all rows it is given.  Columns other than those of ``documents`` pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.llm.arrow import pick
from episodica.llm.decontaminate import find_contamination
from episodica.llm.language import identify_language
from episodica.llm.mixture import mix_sources
from episodica.llm.near_duplicates import find_near_duplicates
from episodica.llm.secrets import scan_secrets


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the compressors agree on; the rejected go."""
    named = identify_language(docs, docs.columns)
    return pick(named.where(~F.col("rejected")), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id.

    The list of documents to drop is written by ``find_near_duplicates``; texts meet it in an anti-join on the id.  Rows
    with a null id stay.
    """
    groups = find_near_duplicates(docs)
    dropped = groups.where(~F.col("kept")).select(F.col("doc_id").alias("_dropped")).distinct()
    return docs.join(dropped, docs["doc_id"] == F.col("_dropped"), "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    judged = find_contamination(docs, benchmark, docs.columns)
    return pick(judged.where(~F.col("contaminated")), docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by its kind in brackets; ``n_chars`` follows the text."""
    scanned = scan_secrets(docs, docs.columns)
    spans, text = F.col("found"), F.col("doc")["text"]
    begin = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def add(done, span):
        # spans are in order of their start; what overlaps an earlier one is cut with it
        ahead = F.substring(text, done["at"] + 1, F.greatest(span["start"] - done["at"], F.lit(0)))
        piece = F.concat(done["out"], ahead, F.lit("["), span["kind"], F.lit("]"))
        later = F.greatest(done["at"], span["stop"])
        return F.struct(F.when(span["start"] >= done["at"], piece).otherwise(done["out"]).alias("out"), later.alias("at"))

    made = F.aggregate(spans, begin, add)
    clean = F.when(F.size(spans) > 0, F.concat(made["out"], F.substring(text, made["at"] + 1, F.length(text)))).otherwise(text)
    out = scanned.select("doc", clean.alias("clean"))
    columns = []
    for name in docs.columns:
        column = F.col("doc")[name]
        if name == "text":
            column = F.col("clean")
        elif name == "n_chars":
            column = F.when(F.col("clean") == text, column).otherwise(F.length("clean")).cast(docs.schema[name].dataType)
        columns.append(column.alias(name))
    return out.select(*columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document how many of its words the mix takes."""
    return mix_sources(docs)
