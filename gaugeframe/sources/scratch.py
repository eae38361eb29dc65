"""Written intermediate tables: the way this library cuts lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the session; a local one only for a local master."""
    context = spark.sparkContext
    root = spark.conf.get(SETTING, None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {SETTING} to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="gaugeframe-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(
    df: DataFrame, name: str = "table", partition_by: Sequence[str] = ()
) -> DataFrame:
    """Write once as parquet and read back, so later scans are pruned and lineage is short."""
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
