"""Where jobs put intermediate tables: the folder the cluster shares, never a machine-local one."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one process, may go without that setting: it then gets a
    temporary folder.  Anywhere else a missing setting is an error, as executors don't see each other's disks.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = LOCAL.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="episodica-")
        LOCAL[spark.sparkContext.applicationId] = base
    return f"{base.rstrip('/')}/episodica/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


# temporary folders of local sessions without the setting, by application
LOCAL: dict[str, str] = {}


def store(df: DataFrame, name: str, partition_by=()) -> DataFrame:
    """Write a frame to the shared folder and read it back: the plan after it starts from files."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.parquet(path)
