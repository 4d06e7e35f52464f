"""Token ids in Parquet list columns, for selective reads of tokens or metadata.

Files hold one row per document in ascending id order: doc_id, source columns if asked for, n_tokens, the document's start
within its file, and ``ids`` as a list of 32-bit integers. Spark's Parquet writer gets the row-group and page sizes, so
that column indexes let a reader skip pages by doc_id, and reading metadata never touches the ids. Ids are dictionary
encoded, or delta encoded (format version 2) with ``encoding="delta"``. Global starts are prefix sums over the files'
token totals, read from the metadata columns alone.

Null texts count as empty: such a document has its end id only. Null doc_ids stand first; rows of one id are ordered by text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tactus.llm.common import new_path, release
from tactus.llm.tokens import encoder, slices, tokenizer_path

#: Pieces that a worker remembers: the files of a task are long, and its memory holds little else.
CACHE = 1_000_000
SCHEMA = "doc_id long, n_tokens long, start_in_file long, shard long, ids array<int>"


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, spaced: bool = False, encoding: str = "dictionary", row_group_bytes: int = 32 << 20, page_rows: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the token files of ``docs`` to ``path``. ``tokenizer``: a tokenizers file; ``spaced``: it is byte-level."""
    spark = docs.sparkSession

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use, start = encoder(tokenizer, spaced, CACHE), 0
        for batch in batches:
            for part in slices(batch, text_bytes=8 << 20):
                ids, cuts = use.encode(part["text"])
                n = np.diff(cuts) + 1
                out = np.insert(ids.astype(np.int32), cuts[1:], end_id)
                ends = np.cumsum(n)
                starts = start + ends - n
                start += int(ends[-1])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(out))
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(n), pa.array(starts), part["shard"], lists], ["doc_id", "n_tokens", "start_in_file", "shard", "ids"])
            release()

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    key = F.col("doc_id").asc_nulls_first()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = slim.repartitionByRange(parts, key).sortWithinPartitions(key, "text").withColumn("shard", F.spark_partition_id().cast("long"))
    options = {"compression": "zstd", "parquet.block.size": row_group_bytes, "parquet.page.row.count.limit": page_rows}
    options |= {"parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary": "false"} if encoding == "delta" else {"parquet.enable.dictionary": "true"}
    ordered.mapInArrow(encode, SCHEMA).write.options(**options).parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids; columns that aren't selected aren't read."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    # one row a file: its number and its tokens
    totals = rows.groupBy("shard").agg(F.sum("n_tokens").alias("tokens"))
    before = F.coalesce(F.sum("tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.join(F.broadcast(totals.select("shard", before.alias("before"))), "shard").select("doc_id", (F.col("before") + F.col("start_in_file")).alias("start"), "n_tokens", "ids")


def with_crc32(rows: DataFrame) -> DataFrame:
    """Replaces ``ids`` by the crc32 of its little-endian unsigned 32-bit integers."""
    kept = [c for c in rows.columns if c != "ids"]
    kinds = dict(rows.dtypes)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b["ids"]
            cuts, raw = ids.offsets.to_numpy(), memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<i4")).cast("B")
            crc = [zlib.crc32(raw[4 * i : 4 * j]) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*(b[c] for c in kept), pa.array(crc, pa.int64())], [*kept, "ids_crc32"])

    return rows.mapInArrow(digest, ", ".join(f"{c} {kinds[c]}" for c in kept) + ", ids_crc32 long")


def op5_token_files(spark, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-files")
    write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, tokenizer_path("word_bpe_49k.json"))
    return with_crc32(read_token_files(spark, path))
