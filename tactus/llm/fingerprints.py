"""Document fingerprints from prefix polynomial hashes.

A text's code points c_0..c_{n-1} give, for two 31-bit primes p, the modular prefix array
S[i] = sum over j < i of (c_j + 1) * B^j mod p. The span [i, j) has the value (S[j] - S[i]) * B^(M - i) mod p for a
common M >= n, so any two spans are compared in constant time, and the longest common extension of two positions is
found by binary search. A fingerprint holds the text's length, its whole-text value and the smallest values of its
spans of ``SPAN`` code points (a bottom-k sketch), so equal texts have equal fingerprints and the share of common spans of two
texts can be estimated from their fingerprints alone.

Null texts count as empty. An empty text has no spans; two empty texts have likeness 1. Texts of fewer than
``SPAN`` code points are one span each.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRIMES = (2147483647, 2147483629)
BASES = (1000003, 69069 * 613 + 2)
SPAN, SKETCH = 12, 64
_MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=8)
def _powers(size: int, base: int, prime: int) -> np.ndarray:
    """B^0..B^(size-1) mod p by doubling."""
    out = np.ones(1, np.uint64)
    step = base % prime
    while len(out) < size:
        out = np.concatenate([out, out * np.uint64(step) % np.uint64(prime)])
        step = step * step % prime
    return out[:size]


def powers(size: int, k: int) -> np.ndarray:
    return _powers(1 << max(10, (size - 1).bit_length()), BASES[k], PRIMES[k])


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)


@dataclass
class PrefixHash:
    """Prefix arrays of one text under both primes."""

    n: int
    sums: tuple[np.ndarray, np.ndarray]

    @classmethod
    def of(cls, text: str | np.ndarray | None) -> PrefixHash:
        points = text if isinstance(text, np.ndarray) else code_points(text)
        n, sums = len(points), []
        for k, p in enumerate(PRIMES):
            terms = (points.astype(np.uint64) + np.uint64(1)) * powers(n + 1, k)[:n] % np.uint64(p)
            out = np.zeros(n + 1, np.uint64)
            np.cumsum(terms, out=out[1:])
            sums.append(out % np.uint64(p))
        return cls(n, tuple(sums))

    def spans(self, start: np.ndarray, size: int, top: int | None = None) -> np.ndarray:
        """Position-free 62-bit values of the spans of ``size`` code points at ``start``; comparable across texts for the same ``top`` >= n."""
        top = self.n if top is None else top
        out = []
        for k, p in enumerate(PRIMES):
            s, p = self.sums[k], np.uint64(p)
            out.append((s[start + size] + p - s[start]) % p * powers(top + 1, k)[top - start] % p)
        return out[0] << np.uint64(31) | out[1]

    def equal(self, i: int, other: PrefixHash, j: int, size: int) -> bool:
        top = max(self.n, other.n)
        return bool(self.spans(np.array([i]), size, top)[0] == other.spans(np.array([j]), size, top)[0])


def common_extension(a: PrefixHash, i: int, b: PrefixHash, j: int) -> int:
    """Length of the longest common extension of position i of a and j of b, by binary search."""
    low, high = 0, min(a.n - i, b.n - j)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a.equal(i, b, j, mid) else (low, mid - 1)
    return low


def _all_spans(points: np.ndarray, size: int) -> np.ndarray:
    """Position-free values of every span of ``size`` code points: the prefix differences brought to a common power.

    ``top`` cancels out of a comparison only if shared, so spans are scaled by the inverse power instead."""
    h = PrefixHash.of(points)
    start, out = np.arange(h.n - size + 1), []
    for k, p in enumerate(PRIMES):
        s, q = h.sums[k], np.uint64(p)
        inverse = _inverse_powers(h.n + 1, k)
        out.append((s[size:] + q - s[: h.n - size + 1]) % q * inverse[start] % q)
    return out[0] << np.uint64(31) | out[1]


@lru_cache(maxsize=8)
def _inverse(size: int, k: int) -> np.ndarray:
    return _powers(size, pow(BASES[k], -1, PRIMES[k]), PRIMES[k])


def _inverse_powers(size: int, k: int) -> np.ndarray:
    return _inverse(1 << max(10, (size - 1).bit_length()), k)


def _mixed(values: np.ndarray) -> np.ndarray:
    """32 bits in an order unrelated to the text."""
    values = values * _MIX
    values ^= values >> np.uint64(32)
    return (values * _MIX >> np.uint64(32)).astype(np.uint32)


def fingerprint(points: np.ndarray) -> tuple[str, np.ndarray]:
    """The fingerprint string ``n:value:sketch`` in hex and its sketch as an ascending array."""
    n = len(points)
    if not n:
        return "0:0:", np.zeros(0, np.uint32)
    found = _mixed(_all_spans(points, min(n, SPAN)))
    if len(found) > 8 * SKETCH:  # the smallest values with repeats, then without
        for keep in (4 * SKETCH, len(found)):
            sketch = np.unique(np.partition(found, keep - 1)[:keep] if keep < len(found) else found)
            if len(sketch) >= SKETCH:
                break
    else:
        sketch = np.unique(found)
    sketch = sketch[:SKETCH]
    h = PrefixHash.of(points)
    whole = int(h.sums[0][n]) << 31 | int(h.sums[1][n])
    return f"{n:x}:{whole:x}:" + sketch.astype(">u4").tobytes().hex(), sketch


def sketch_of(mark: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(mark.rsplit(":", 1)[1]), ">u4").astype(np.uint32)


def likeness(a: str, b: str) -> float:
    """Estimated share of common spans of two fingerprinted texts, 0 to 1: the k-minimum-values estimate of resemblance."""
    if a == b:
        return 1.0
    return _likeness(sketch_of(a), sketch_of(b))


def _likeness(x: np.ndarray, y: np.ndarray) -> float:
    if not len(x) or not len(y):
        return float(len(x) == len(y))
    both = np.union1d(x, y)[:SKETCH]
    return float(np.isin(np.intersect1d(x, y, assume_unique=True), both, assume_unique=True).sum() / len(both))


def edited(points: np.ndarray, following: np.ndarray) -> np.ndarray:
    """The last half (rounded down) replaced by as many first code points of the following text, or all of it."""
    half = len(points) // 2
    return np.concatenate([points[: len(points) - half], following[:half]])


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, common_prefix long"
_NAMES = [c.split()[0] for c in _OUT.split(", ")]


def _row(doc_id, points: np.ndarray, mark: str, sketch: np.ndarray, following: np.ndarray, next_mark: str, next_sketch: np.ndarray) -> tuple:
    changed = edited(points, following)
    own, new = PrefixHash.of(points), PrefixHash.of(changed)
    new_mark, new_sketch = fingerprint(changed)
    near = 1.0 if new_mark == mark else _likeness(sketch, new_sketch)
    near_next = 1.0 if next_mark == mark else _likeness(sketch, next_sketch)
    sha = hashlib.sha256(changed.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")).hexdigest()
    return doc_id, len(points), sha, mark, new_mark, near, near_next, common_extension(own, 0, new, 0)


def _stream(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of a partition sorted by (block, own first, id, text), each with the next of its block."""
    last, rows = None, []
    for pdf in parts:
        for doc_id, text, block, own in zip(pdf["doc_id"].astype("Int64").tolist(), pdf["text"].tolist(), pdf["block"].tolist(), pdf["own"].tolist(), strict=True):
            if last is not None and last[1] == block and last[2]:
                points = code_points(text if isinstance(text, str) else "")
                here = points, *fingerprint(points)
                rows.append(_row(last[0], *last[3:], *here))
            elif own:
                points = code_points(text if isinstance(text, str) else "")
                here = points, *fingerprint(points)
            else:
                continue  # a further row of the id that follows the block
            last = (None if doc_id is pd.NA else doc_id, block, own, *here)
            if len(rows) >= 1024:
                yield pd.DataFrame(rows, columns=_NAMES).astype({"doc_id": "Int64"})
                rows = []
    if rows:
        yield pd.DataFrame(rows, columns=_NAMES).astype({"doc_id": "Int64"})


def _place(borders: list[int], key: Column) -> Column:
    """How many of the ascending borders are at most ``key``: among runs of borders first, then in one run."""
    if not borders:
        return F.lit(0)
    size = math.isqrt(len(borders) - 1) + 1
    runs = [borders[i : i + size] for i in range(0, len(borders), size)]
    before = F.array_size(F.filter(F.lit([r[0] for r in runs]).cast("array<long>"), lambda x: x <= key)) - 1
    inside = F.get(F.lit(runs).cast("array<array<long>>"), before)
    return F.when(before < 0, 0).otherwise(before * size + F.array_size(F.filter(inside, lambda x: x <= key)))


def edit_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint every text and its edited text, in ascending id order (null ids first; rows of one id by text).

    Ids are cut into blocks at their approximate quantiles, a few for each shuffle partition. The texts are shuffled once, by
    block, and streamed in order; the first document of a block is dealt to the block before it too. The driver holds one
    number a block."""
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [(k + 1) / (4 * parts) for k in range(4 * parts - 1)]
    borders = sorted({int(x) for x in slim.approxQuantile("doc_id", shares, 0.1 / parts)})
    key = F.coalesce("doc_id", F.lit(-(2**63)))
    block = _place(borders, key)
    least = slim.select(block.alias("block"), key.alias("key")).groupBy("block").agg(F.min("key").alias("key")).orderBy("block").collect()
    if not least:
        return spark.createDataFrame([], _OUT)
    before = [(r["key"], least[k - 1]["block"]) for k, r in enumerate(least)]  # the first one's stands before the first: the last
    heads = F.broadcast(spark.createDataFrame(before, "key long, before int"))
    rows = slim.withColumns({"block": block, "key": key}).join(heads, "key", "left")
    own = F.struct(F.col("block").alias("block"), F.lit(True).alias("own"))
    copies = F.filter(F.array(own, F.struct(F.col("before").alias("block"), F.lit(False).alias("own"))), lambda x: x["block"].isNotNull())
    dealt = rows.select("doc_id", "key", "text", F.inline(copies)).repartition(parts, "block")
    return dealt.sortWithinPartitions("block", F.desc("own"), "key", "text").select("doc_id", "text", "block", "own").mapInPandas(_stream, _OUT)


def op10_document_fingerprints(spark, sf_dir: str) -> DataFrame:
    return edit_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
