"""Helpers shared by the corpus operators: table access and durable intermediate tables."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_LIBC = ctypes.CDLL(None)
#: Spark's switch for removing an execution's shuffle files at its end.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``; where it is unset, a local one if the master is local (tests), else an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="tactus-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path in the shared folder, removed when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: cuts the lineage and survives lost executors.

    The write's shuffle files go when it ends, as the table stands for them."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table made by ``materialize`` that is no longer read."""
    spark = df.sparkSession
    base = shared_dir(spark).removeprefix("file://").removeprefix("file:").rstrip("/")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if base in path:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(conf).delete(at, True)


def release() -> None:
    """Gives memory that a worker process has freed back to the system: workers outlive their tasks, and their executor's limit holds for all of them."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):  # glibc
        _LIBC.malloc_trim(0)


def held_out(doc_id: Column) -> Column:
    """True for the fold that no model learns from: crc32 of the id's text divisible by five; a null id is in no fold and counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def sampled(rate: Column | float, id_col: str, salt: str) -> Column:
    """Whether a row is in a sample of about ``rate`` of the ids, by the whole 63 bits of a hash; a rate of 1 or more takes all."""
    share = F.shiftrightunsigned(F.xxhash64(id_col, F.lit(salt)), 1) / F.lit(2.0**63)
    return share < rate


def is_small(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows; reads no more than needed to know."""
    return df.limit(rows + 1).count() <= rows
