"""Packing token ids into fixed windows: concatenate and cut.

All documents' ids form one stream; window w holds its positions [w * size, (w + 1) * size). The first pass encodes the
documents and writes their ids as a table with each one's start within its partition; the partitions' token totals, one
row each, give global offsets by a prefix sum. The second pass cuts the ids at window borders. A window that crosses a
partition's border has its pieces in two partitions: these boundary records need no special care, as a piece carries its
window and offset. Only the last window has padding.

Null texts count as empty: such a document is its end id alone. Documents are taken in the order in which they are
stored; repeated rows are packed as often as they occur.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tactus.llm.common import materialize, release
from tactus.llm.tokens import encoder, slices, tokenizer_path

#: Ids that a task cuts at a time.
PART = 1 << 20
_TOKENS = "doc_id long, n long, start_in_part long, part long, ids binary"
_FIELDS = {"doc_id": "long", "start": "long", "length": "long", "ids_crc32": "long", "doc_tokens": "long", "sequence_id": "long", "offset": "long"}


def pack(docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 0, spaced: bool = True, with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and its ids if ``with_ids``."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use, at = encoder(tokenizer, spaced), 0
        for batch in batches:
            for rows in slices(batch):
                ids, cuts = use.encode(rows["text"])
                n = np.diff(cuts) + 1
                out = np.insert(ids.astype(use.kind), cuts[1:], end_id)
                ends = np.cumsum(n)
                starts = at + ends - n
                at += int(ends[-1])
                packed = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((np.concatenate([[0], ends]) * use.kind.itemsize).astype(np.int32)), pa.py_buffer(out)])
                yield pa.RecordBatch.from_arrays([rows["doc_id"], pa.array(n), pa.array(starts), rows["part"], packed], ["doc_id", "n", "start_in_part", "part", "ids"])
            release()

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.spark_partition_id().cast("long").alias("part"))
    tokens = materialize(slim.mapInArrow(encode, _TOKENS), "packing")
    totals = tokens.groupBy("part").agg(F.sum("n").alias("tokens"))  # a row per partition
    before = F.coalesce(F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = tokens.join(F.broadcast(totals.select("part", before.alias("before"))), "part").select("doc_id", "n", (F.col("before") + F.col("start_in_part")).alias("at"), "ids")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = encoder(tokenizer, spaced).kind
        for batch in batches:
            for part in slices(batch, 4096, PART * kind.itemsize, "ids"):
                yield pieces(part, kind)
            release()

    def pieces(batch: pa.RecordBatch, kind: np.dtype) -> pa.RecordBatch:
        n, at = batch["n"].to_numpy(), batch["at"].to_numpy()
        k = (at + n - 1) // size - at // size + 1  # pieces of each document
        doc = np.repeat(np.arange(len(n)), k)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(k) - k, k)
        window = (at // size)[doc] + nth
        begin = np.maximum(window * size, at[doc])
        end = np.minimum((window + 1) * size, (at + n)[doc])
        start, length = begin - at[doc], end - begin
        texts = batch["ids"]
        base = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) // kind.itemsize
        # a document's pieces lie one after another, and so do documents: all ids are in place
        wide = np.frombuffer(texts.buffers()[2], kind)[base[0] : base[-1]].astype("<u4")
        raw, lo = memoryview(wide).cast("B"), (base[:-1] - base[0])[doc] + start
        crc = [zlib.crc32(raw[4 * i : 4 * j]) for i, j in zip(lo.tolist(), (lo + length).tolist(), strict=True)]
        columns = [batch["doc_id"].take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(n[doc]), pa.array(window), pa.array(begin % size)]
        if with_ids:
            columns.append(pa.ListArray.from_arrays(pa.array(np.append(lo, len(wide)).astype(np.int32)), pa.array(wide.view("<i4"))))
        return pa.RecordBatch.from_arrays(columns, [*_FIELDS, *["ids"] * with_ids])

    return placed.mapInArrow(cut, ", ".join(f"`{c}` {t}" for c, t in (_FIELDS | ({"ids": "array<int>"} if with_ids else {})).items()))


def sequences(pieces: DataFrame, size: int = 1024, pad_id: int = 0) -> DataFrame:
    """The packed windows of ``pack``'s pieces: sequence_id, ids (padded to ``size`` unless their number is a power of two), n_ids, doc_ids."""
    rows = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    whole = pieces.groupBy("sequence_id").agg(rows.alias("r")).select("sequence_id", F.flatten("r.ids").alias("ids"), F.col("r.doc_id").alias("doc_ids"))
    n = F.size("ids")
    padded = F.when(n.bitwiseAND(n - 1) == 0, F.col("ids")).otherwise(F.concat("ids", F.array_repeat(F.lit(pad_id), F.lit(size) - n)))
    return whole.select("sequence_id", padded.alias("ids"), n.cast("long").alias("n_ids"), "doc_ids")


def op8_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path("byte_bpe_50k.json"), with_ids=False)


def stage_packing(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed documents with their ids."""
    return pack(docs, tokenizer_path("byte_bpe_50k.json"))
