"""Streaming scorer: files arrive, each row is checked, scored and appended.  No state, no watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from episodica.operators.compiled import CompiledScorer
from episodica.operators.score import Scorer


def read_requests(spark: SparkSession, folder: str, schema, fmt: str = "parquet", files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).format(fmt).load(folder)


def score_stream(requests: DataFrame, scorer: Scorer, out: str, checkpoint: str, trigger=None) -> StreamingQuery:
    """Append scores of the valid rows to ``out/scored`` and the others with their reasons to ``out/quarantine``.

    The scorer's own checks and scores are used, so a stream gives what a batch of the same rows gives.
    A batch that is run again after a failure overwrites the folder of its own batch number, so no row is written
    twice.
    """

    def handle(batch: DataFrame, number: int) -> None:
        _, rejected = scorer.checked(batch)
        scorer.score(batch).write.mode("overwrite").parquet(f"{out}/scored/batch={number}")
        rejected.write.mode("overwrite").parquet(f"{out}/quarantine/batch={number}")

    writer = requests.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def score_compiled(requests: DataFrame, scorer: CompiledScorer, out: str, checkpoint: str, trigger=None) -> list[StreamingQuery]:
    """The same two outputs for a scorer that is an expression: two plain streams into files, ``scored`` and ``quarantine``.

    No batch function runs on the driver; the file sink's own log makes each batch count once.
    """
    parts = {"scored": scorer.score(requests), "quarantine": scorer.checked(requests)[1]}
    return [
        part.writeStream.format("parquet").option("checkpointLocation", f"{checkpoint}/{name}").trigger(**(trigger or {"availableNow": True})).start(f"{out}/{name}")
        for name, part in parts.items()
    ]
