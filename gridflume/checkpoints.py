"""Where iterative operators cut their lineage: a folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_root(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Only where none is set and all tasks run on this machine, a new one.
    """
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="gridflume-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/gridflume/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: one run of its plan, where a checkpoint takes two."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``staged``, and the rows that were written, counted by the write itself."""
    seen = Observation()
    out = staged(df.observe(seen, F.count(F.lit(1)).alias("rows")), name)
    return out, seen.get["rows"]


def checkpointed(spark: SparkSession, job: Callable[[], DataFrame]) -> DataFrame:
    """Run a job that checkpoints, in the shared folder."""
    shared_root(spark)
    return job()
