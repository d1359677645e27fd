"""Quality by compression: how much better a text compresses after good than after bad labelled text."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.llm.arrow import annotate, fold
from episodica.llm.dictionaries import Compressors, sample_dictionaries
from episodica.sources.shared import store

FEATURES = ("preference", "density", "preference_2", "density_2", "product")


def labels_of(labels: DataFrame, key: str, label: str) -> DataFrame:
    """One row per key; a key whose labels contradict each other, or a null one, teaches nothing."""
    one = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min(label).alias("_label"), F.max(label).alias("_most"))
    return one.where((F.col("_label") == F.col("_most")) & F.col("_label").isin(0, 1)).select("_key", "_label")


def score_quality(
    docs: DataFrame, labels: DataFrame, keep: list[str], key: str = "doc_id", text: str = "text", label: str = "quality",
    folds: int = 4, held: int = 2, cut: float = 0.7,
) -> DataFrame:
    """Per row the columns ``keep`` as a struct ``doc``, ``held_out``, ``score`` in [0, 1] and ``predicted`` (score >= ``cut``).

    Two raw-content dictionaries of 128 KB are sampled from good and bad texts outside the held-out fold.  Every
    whole text is compressed with each and with none; ``preference`` is the difference of the two sizes over the
    plain size, ``density`` the plain size over the length.  A logistic model over both, their squares and their
    product, fitted on all labelled rows outside the held-out fold, turns them into a calibrated probability.

    Null and empty texts count as one empty text and are scored like it.  Without labels of both kinds the score
    is 0.5 everywhere.  A null key is not held out and has no label.  Repeated rows give repeated results.
    """
    known = labels_of(labels, key, label)
    learn = (
        docs.where(fold(docs[key], folds) != held).select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(known, "_key")
    )
    found = sample_dictionaries(learn, F.col("_key"), F.col("_text"), F.col("_label"))
    models = {"good": found.get("1", b""), "bad": found.get("0", b""), "plain": b""}

    def start():
        compressors = Compressors(models)

        def work(batch):
            held_out, preference, density = batch.column("held_out"), [], []
            for value in batch.column("_text").to_pylist():
                data = (value or "").encode("utf-8", "replace")
                good, bad, plain = compressors.sizes(data)
                preference.append((bad - good) / plain)
                density.append(min(plain / max(len(data), 1), 2.0))
            return held_out, preference, density

        return work

    inputs = {"_text": F.col(text), "held_out": F.coalesce(fold(F.col(key), folds) == held, F.lit(False))}
    sized = store(annotate(docs, list(dict.fromkeys([*keep, key])), inputs, "held_out boolean, preference double, density double", start), "quality")
    a, b = F.col("preference"), F.col("density")
    sized = sized.withColumns({"preference_2": a * a, "density_2": b * b, "product": a * b})
    rows = sized.where(~F.col("held_out")).withColumn("_key", F.col("doc")[key]).join(known, "_key").select("_label", *FEATURES)
    rows = rows.withColumn("_label", F.col("_label").cast("double"))
    if rows.groupBy("_label").count().count() < 2:
        scored = sized.withColumn("score", F.lit(0.5))
    else:
        vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        model = LogisticRegression(labelCol="_label", regParam=1e-5, maxIter=100).fit(vectors.transform(rows))
        weights = [float(w) for w in model.coefficients]
        total = F.lit(float(model.intercept))
        for name, weight in zip(FEATURES, weights, strict=True):
            total = total + F.lit(weight) * F.col(name)
        scored = sized.withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-total)))
    return scored.select(
        F.struct(*[F.col("doc")[c].alias(c) for c in keep]).alias("doc"), "held_out", "score",
        (F.col("score") >= cut).cast("int").alias("predicted"), "preference", "density",
    )
