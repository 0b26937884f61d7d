"""Where long jobs cut their lineage, and how grouped Arrow operators see their groups."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..shared import shared_dir
from ..shipping import ship

BATCH_ROWS = 1_000
#: Rows of two or three numbers that may be broadcast: some 100 MB in memory.
BROADCAST_ROWS = 2_000_000
_written: list[str] = []


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again: the lineage ends here, and lost executors cost nothing that was written."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._folioframe_path = path
    _written.append(path)
    return out


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def discard(df: DataFrame) -> None:
    """Delete a staged table that no later step reads."""
    if path := getattr(df, "_folioframe_path", None):
        _delete(df.sparkSession, path)


def mark() -> int:
    """A point to sweep back to."""
    return len(_written)


def sweep(spark: SparkSession, since: int = 0, keep: DataFrame | None = None) -> None:
    """Delete all tables staged since a mark, but for ``keep``. Results that still read them must have been written before."""
    kept = getattr(keep, "_folioframe_path", None)
    gone = [p for p in _written[since:] if p != kept]
    _written[since:] = [kept] if kept in _written[since:] else []
    for path in gone:
        _delete(spark, path)


def small(df: DataFrame, most_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A table of ids, to be broadcast where it has at most ``most_rows`` rows; beyond that Spark joins it by shuffle.

    Give a staged table: it is counted here.
    """
    return F.broadcast(df) if df.count() <= most_rows else df


#: A key in more than this share of all rows, and in HOT_LEAST of them, is hot; so there are at most HOT_SHARE hot ones.
HOT_SHARE, HOT_LEAST = 100_000, 4_096


def joined_by_count(each: DataFrame, per_key: DataFrame, keys: list[str], total: int, times: str = "times") -> DataFrame:
    """``each`` joined with a staged table of a row per key and its rows in ``each``: hot keys by a broadcast of at most
    HOT_SHARE rows, the rest by a shuffle in which no key has more rows than the hot bound."""
    is_hot = F.col(times) > max(HOT_LEAST, total // HOT_SHARE)
    hot = F.broadcast(per_key.where(is_hot))
    return each.join(hot, keys).unionByName(each.join(hot.select(*keys), keys, "left_anti").join(per_key.where(~is_hot), keys))


def tidy() -> None:
    """Give freed memory back: a worker stays between tasks, and what it keeps is missing elsewhere."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` in batches of BATCH_ROWS rows, since texts are long, by workers that tidy up after each task."""
    ship(df.sparkSession).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            tidy()

    return df.mapInArrow(run, schema)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of a partition that is sorted by ``keys``, whole even where a batch ends inside one."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        columns = [table[k].to_pylist() for k in keys]
        rows = list(zip(*columns, strict=True))
        first = 0
        for i, row in enumerate(rows):
            if row != last:
                if i > first:
                    held.append(table.slice(first, i - first))
                if held:
                    yield pa.concat_tables(held)
                held, first, last = [], i, row
        held.append(table.slice(first))
    if held:
        yield pa.concat_tables(held)


def by_groups(df: DataFrame, keys: list[str], fn: Callable[[pa.Table], pa.Table | None], schema: str, partitions: int | None = None) -> DataFrame:
    """Apply ``fn`` to each group of ``keys``, on Arrow tables, in one shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, keys):
            out = fn(group)
            if out is not None and out.num_rows:
                yield from out.to_batches()

    dealt = df.repartition(*([partitions] if partitions else []), *keys)
    return arrow_map(dealt.sortWithinPartitions(*keys), run, schema)
