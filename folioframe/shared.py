"""Tables in the folder that all executors share, to cut lineage where a plan must not be computed twice."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a local folder of ours only where that is unset and the master is local, as in tests."""
    global _own
    there = spark.conf.get("spark.checkpoint.dir", None)
    if there:
        return there
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if _own is None:
        _own = tempfile.mkdtemp(prefix="folioframe-")
    return _own


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read from a table just written: what later steps see is fixed, and lost executors cost nothing of it."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
