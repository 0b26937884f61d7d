"""A total order over a whole table without a task that sorts it: range partitions, written once, and one row a partition on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import written

#: Rows of a range partition, so that their number grows with the table.
PARTITION_ROWS = 1_000_000


def free_name(columns: list[str], wish: str) -> str:
    """``wish``, with underscores before it until no column is called so, in whatever case."""
    taken = {c.lower() for c in columns}
    while wish.lower() in taken:
        wish = "_" + wish
    return wish


def ranged(rows: DataFrame, order: list[Column], partitions: int | None = None) -> tuple[DataFrame, str]:
    """The rows, range-partitioned by ``order`` and written, with the name of a new column that tells the partition."""
    part = free_name(rows.columns, "range_part")
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    partitions = partitions or max(least, -(-rows.count() // PARTITION_ROWS))
    return written(rows.repartitionByRange(partitions, *order).withColumn(part, F.spark_partition_id()), "ordered"), part


def numbered(rows: DataFrame, order: list[Column], name: str = "n", start: int = 0, partitions: int | None = None, before: Column | None = None, before_name: str = "before") -> DataFrame:
    """The rows with numbers from start + 1 on, without gaps, by ``order``; a column called ``name`` is replaced.

    Counting rows and numbering them see the same written partitions; a partition's numbers start after the sizes of
    those before it. With ``before``, a column ``before_name`` has that expression's value in the preceding row, null in
    the first: each partition's last value is on the driver too.
    """
    placed, part = ranged(rows, order, partitions)
    # The greatest by the order is the last of its partition's window.
    inside = Window.partitionBy(part).orderBy(*order)
    sizes = dict(placed.groupBy(part).count().collect())
    if not sizes:
        out = rows.withColumn(name, F.lit(None).cast("long")).limit(0)
        return out.withColumn(before_name, before) if before is not None else out
    base, at = [], start
    for p in sorted(sizes):
        base += [F.lit(p), F.lit(at)]
        at += sizes[p]
    out = placed.withColumn(name, (F.row_number().over(inside) + F.create_map(*base)[F.col(part)]).cast("long"))
    if before is not None:
        first = free_name(out.columns, "first_in_part")
        ends = placed.select(part, before.alias(before_name), F.row_number().over(inside).alias("at"), F.count("*").over(Window.partitionBy(part)).alias("size")).where(F.col("at") == F.col("size"))
        last = {r[part]: r[before_name] for r in ends.collect()}
        carry, parts = [], sorted(sizes)
        for p, q in zip(parts[1:], parts, strict=False):
            carry += [F.lit(p), F.lit(last[q])]
        own = F.lag(before).over(inside)
        kind = placed.select(before.alias("x")).schema["x"].dataType
        out = out.withColumn(first, F.row_number().over(inside) == 1)
        carried = F.create_map(*carry)[F.col(part)].cast(kind) if carry else F.lit(None).cast(kind)
        out = out.withColumn(before_name, F.when(F.col(first), carried).otherwise(own)).drop(first)
    return out.drop(part)
