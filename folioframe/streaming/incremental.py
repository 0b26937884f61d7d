"""Incremental ingest of new text files: a file stream, one bounded run over what is new, upserts a micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.files import path_columns

SCHEMA = "file_path string, file_name string, full_text string, collection string, subcollection string, location string"


def incoming_stream(spark: SparkSession, folder: str, per_batch: int = 1_000) -> DataFrame:
    """New text files of a folder and those below, as document rows; at most ``per_batch`` files a micro-batch."""
    lines = spark.readStream.option("wholetext", "true").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", str(per_batch)).text(folder)
    path = F.col("_metadata.file_path")
    rows = lines.select(path.alias("file_path"), F.regexp_extract(path, r"([^/]+)$", 1).alias("file_name"), F.col("value").alias("full_text"))
    inner = F.regexp_replace("file_path", "^.*" + folder.rstrip("/").rsplit("/", 1)[-1] + "/", "")
    return rows.select("*", *[c.alias(n) for n, c in path_columns(inner).items()])


def run_available(stream: DataFrame, checkpoint: str, load: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Everything that is there now, then stop. ``load`` gets each micro-batch and its number; it must skip what it has loaded
    before, since a batch that failed comes again under its number."""
    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def path_upsert(target: str) -> Callable[[DataFrame, int], None]:
    """A loader that appends files whose path the target doesn't have; a batch writes a folder of its own, over what a failed try left."""

    def load(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        jvm = spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(target)
        there = root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root)
        fresh = batch.dropDuplicates(["file_path"])
        if there:
            old = spark.read.schema(SCHEMA + ", batch int").parquet(target).where(F.col("batch") != number)
            fresh = fresh.join(old.select("file_path"), "file_path", "left_anti")
        fresh.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return load
