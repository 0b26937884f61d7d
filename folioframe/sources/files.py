"""File listings, page texts, extraction files, and the sinks around them. Everything goes through Spark's readers and writers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import free_name, numbered


def listing(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """(path, file_name, length) of files below a folder, by path; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), "length").orderBy("path")


def batch_window(files: DataFrame, batch: int, size: int = 50) -> DataFrame:
    """The batch-th run of ``size`` files by path, from 1."""
    place = free_name(files.columns, "place")
    return numbered(files, [F.asc("path")], place).where(F.col(place).between((batch - 1) * size + 1, batch * size)).drop(place)


def without_copies(files: DataFrame) -> DataFrame:
    """Files whose names say neither duplicate nor partial."""
    name = F.lower("file_name")
    return files.where(~F.contains(name, F.lit("duplicate")) & ~F.contains(name, F.lit("partial")))


def path_columns(relative_path: Column) -> dict[str, Column]:
    """Collection, subcollection and location from a relative path: its first two folders, and the first part that names a place."""
    parts = F.split(relative_path, "/")
    place = F.get(F.filter(parts, lambda p: F.lower(p).rlike("county|reservation|agency|district|territory")), F.lit(0))
    return {
        "collection": F.when(F.size(parts) > 1, F.get(parts, F.lit(0))).otherwise(F.lit("Unknown")),
        "subcollection": F.when(F.size(parts) > 2, F.get(parts, F.lit(1))),
        "location": place,
    }


def name_from_folder(folder: Column) -> Column:
    """The file name that an output folder stands for; what shared a sign can't be told apart."""
    return F.concat(F.replace(F.replace(folder, F.lit("__"), F.lit("; ")), F.lit("_"), F.lit(" ")), F.lit(".pdf"))


def replies(spark: SparkSession, glob: str) -> DataFrame:
    """(path, folder, reply): whole text files of model replies."""
    files = spark.read.text(glob, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("reply"))
    return files.select("path", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("folder"), "reply")


def review_file(spark: SparkSession, path: str) -> DataFrame:
    """Candidates of a review file, one a row; a file without any gives none."""
    item = "struct<type:string,id_a:bigint,name_a:string,id_b:bigint,name_b:string,score:double,keep:string,decision:string>"
    return spark.read.schema(f"candidates array<{item}>").json(path, multiLine=True).select(F.explode("candidates").alias("c")).select("c.*")


def write_review(candidates: DataFrame, path: str) -> None:
    """A review file: one JSON object with all candidates, for a person to read and edit."""
    columns = ["type", "id_a", "name_a", "id_b", "name_b", "score", "keep", "decision"]
    order = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("o"), *columns)))
    whole = candidates.agg(F.transform(order, lambda x: F.struct(*[x[c].alias(c) for c in columns])).alias("candidates"))
    whole.select(F.to_json("candidates", {"ignoreNullFields": "false"}).alias("c")).select(F.concat(F.lit('{"candidates":'), F.col("c"), F.lit("}")).alias("value")).write.mode("overwrite").text(path)


def uuid_map(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, uuid) of a JSON object; a missing file gives no row."""
    from pyspark.errors import AnalysisException

    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException:
        return spark.createDataFrame([], "file_name string, uuid string")
    return text.select(F.explode(F.from_json("value", "map<string,string>")).alias("file_name", "uuid"))


def write_json_lines(rows: DataFrame, path: str) -> None:
    """Rows of one text column as lines."""
    rows.select("value").write.mode("overwrite").text(path)


def write_replies(rows: DataFrame, path: str, quarantine: str) -> None:
    """Chunk replies: valid ones as JSON lines by document, the rest beside them to be looked at."""
    rows.where("valid_json").write.mode("overwrite").partitionBy("document_id").json(path)
    rows.where("not valid_json").write.mode("overwrite").json(quarantine)


def dump_context(path: str, **parts: DataFrame) -> None:
    """One JSON object with an array a part, in the order of its columns, as context for a run elsewhere. Give parts that fit in one value."""
    texts = [df.agg(F.to_json(F.sort_array(F.collect_list(F.struct(*df.columns)))).alias("t")).select(F.concat(F.lit(f'"{name}":'), F.col("t")).alias("t")) for name, df in parts.items()]
    all_texts = reduce(DataFrame.unionByName, texts)
    all_texts.agg(F.concat(F.lit("{"), F.array_join(F.collect_list("t"), ","), F.lit("}")).alias("value")).write.mode("overwrite").text(path)


def load_context(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path, multiLine=True)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Rows of CSV files with a head line; quoted fields may hold line breaks. An empty field is null, quoted or not."""
    return spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"')


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").csv(path, header=True, escape='"')
