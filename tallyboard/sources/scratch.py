"""Durable scratch space shared by the cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Where that is unset a local folder is made and used on a single machine; on a cluster, whose
    executors could not see it, that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tallyboard-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once below the shared scratch folder and read it back."""
    return cut_and_count(df)[0]


def cut_and_count(df: DataFrame) -> tuple[DataFrame, int]:
    """``cut_lineage`` with the number of rows, counted while they are written."""
    path, seen = scratch_path(df.sparkSession, "cut"), Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get["rows"]
