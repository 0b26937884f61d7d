"""Corpora as catalog databases: schemas, guards for tables that may be missing, versions that are swapped whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schemas import TABLES, VERSIONS

DEFAULT = "default"


def corpora(spark: SparkSession, patterns: tuple[str, ...] = ("*_historical_*", "*_corpus_*", "survey_*"), named: tuple[str, ...] = ()) -> list[str]:
    """Names of databases that hold corpora, sorted; any failure or none gives the default alone."""
    try:
        found = {d.name for p in (*patterns, *named) for d in spark.catalog.listDatabases(p)}
    except Exception:  # noqa: BLE001  a catalog that can't be listed has the default
        found = set()
    return sorted(found) or [DEFAULT]


def create(spark: SparkSession, database: str, version: str = "v4") -> None:
    """The database and its empty tables, where they don't exist; a table that lacks columns gets them."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name in VERSIONS[version]:
        full = f"`{database}`.`{name}`"
        if not spark.catalog.tableExists(f"{database}.{name}"):
            spark.createDataFrame([], T.StructType([T.StructField(f.name, f.dataType) for f in TABLES[name].fields])).write.format("parquet").saveAsTable(full)
            continue
        have = set(spark.table(full).columns)
        missing = [f for f in TABLES[name].fields if f.name not in have]
        if missing:
            spark.sql(f"ALTER TABLE {full} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in missing)})")


def load(spark: SparkSession, database: str, table: str) -> DataFrame | None:
    """A table, or None where it doesn't exist."""
    return spark.table(f"`{database}`.`{table}`") if spark.catalog.tableExists(f"{database}.{table}") else None


def load_or_empty(spark: SparkSession, database: str, table: str) -> DataFrame:
    found = load(spark, database, table)
    return found if found is not None else spark.createDataFrame([], TABLES[table])


def append(rows: DataFrame, database: str, table: str) -> None:
    """Rows at the end of a table, by column name; columns that rows lack are null."""
    columns = [f.name for f in TABLES[table].fields]
    have = set(rows.columns)
    from pyspark.sql import functions as F

    rows.select(*[F.col(c) if c in have else F.lit(None).cast(TABLES[table][c].dataType).alias(c) for c in columns]).write.insertInto(f"`{database}`.`{table}`")


def swap(rows: DataFrame, database: str, table: str) -> None:
    """A new version of a table in place of the old: written whole under another name before names are changed."""
    spark = rows.sparkSession
    fresh, old = f"`{database}`.`{table}__new`", f"`{database}`.`{table}__old`"
    spark.sql(f"DROP TABLE IF EXISTS {fresh}")
    rows.write.format("parquet").saveAsTable(fresh)
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    if spark.catalog.tableExists(f"{database}.{table}"):
        spark.sql(f"ALTER TABLE `{database}`.`{table}` RENAME TO {old}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO `{database}`.`{table}`")
    spark.sql(f"DROP TABLE IF EXISTS {old}")


def jdbc(spark: SparkSession, url: str, table: str, key: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 16, **options: str) -> DataFrame:
    """A table of an external database, read in ranges of a key where one is given. Its driver must be on the class path."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if key and bounds:
        reader = reader.options(partitionColumn=key, lowerBound=str(bounds[0]), upperBound=str(bounds[1]), numPartitions=str(partitions))
    return reader.load()
