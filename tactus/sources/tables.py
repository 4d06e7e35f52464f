"""Tables that runs have written, read again: Parquet of many songs, JSON records, and what lies in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_songs(spark: SparkSession, paths: list[str] | str, song_id: str | None = None) -> DataFrame:
    """Parquet files under the union of their schemas. song_id is a literal where given, else the column or partition of that name, else the file's folder."""
    rows = spark.read.option("mergeSchema", True).parquet(*([paths] if isinstance(paths, str) else paths))
    if song_id is not None:
        return rows.withColumn("song_id", F.lit(song_id))
    return rows if "song_id" in rows.columns else rows.withColumn("song_id", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1))


def read_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON records, a file each or a line each."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def output_stats(spark: SparkSession, path: str) -> DataFrame:
    """files, bytes of the data files under a folder; file contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    own = files.where(~F.regexp_extract("path", r"([^/]+)$", 1).rlike("^[._]"))
    return own.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).cast("long").alias("bytes"))
