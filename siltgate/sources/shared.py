"""Lineage cuts in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str | None:
    """The cluster's checkpoint folder, if the session names one."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below the shared one; a machine-local one only where a local session names none."""
    base = shared_folder(spark)
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="siltgate-")
    return f"{base.rstrip('/')}/store-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write a reused intermediate to the shared folder once.

    Reliable checkpoint files survive the loss of an executor.  Without a shared
    folder the plan is left as it is: a machine-local copy would not survive.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    if folder is None:
        return df
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
