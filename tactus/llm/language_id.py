"""Language identification by rank-order profiles of character n-grams.

A profile is the ``TOP`` most frequent n-grams (one to three letters, words padded by a boundary) in order of falling
frequency. A text's profile is compared with each language's by the out-of-place distance: the sum over its n-grams of
how far the ranks are apart, ``TOP`` for one that the language's profile lacks. The nearest language wins, the first in
alphabetical order where distances tie.

Language profiles are learned from texts with a language outside the held-out fold, in a sample of about ``SAMPLE``
documents a language (chosen by a hash of the id); every text is predicted whole. The score is how much nearer the best
language is than the second best, as a share of the second's distance (1 where only one language is known). A text that is null or has
no letter gets ``und`` and score 0, as does any text where no language could be learned. Rows keep their multiplicity.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tactus.llm.common import held_out, sampled
from tactus.llm.tokens import slices

TOP, SAMPLE = 400, 4000
_EDGE = 1  # a code point that is no letter stands for a word's boundary


@cache
def _letters() -> np.ndarray:
    """By code point, whether it is a letter."""
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a text, packed into ascending integers, and how often each occurs."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = np.where(letter, points, _EDGE).astype(np.int64)
    code = np.concatenate([[_EDGE], code, [_EDGE]])
    code = code[np.concatenate([[True], (code[1:] != _EDGE) | (code[:-1] != _EDGE)])]  # one boundary between words
    two = code[:-1] << 21 | code[1:]
    grams = np.concatenate([code[code != _EDGE], two, (two[:-1] << 21 | code[2:])[code[1:-1] != _EDGE]])
    grams.sort()
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    return grams[first], np.diff(np.append(first, len(grams)))


def profile(grams: np.ndarray, counts: np.ndarray, top: int = TOP) -> np.ndarray:
    """The most frequent n-grams in order; ties by their packed value."""
    if len(grams) > top:
        often = counts >= np.partition(counts, len(counts) - top)[len(counts) - top]
        grams, counts = grams[often], counts[often]
    return grams[np.argsort(-counts, kind="stable")[:top]]


class Profiles:
    """Language profiles as sorted n-grams with their ranks."""

    def __init__(self, ranked: dict[str, list[int]]):
        self.langs = sorted(ranked)
        self.sorted, self.rank = [], []
        for lang in self.langs:
            grams = np.array(ranked[lang], np.int64)
            order = np.argsort(grams)
            self.sorted.append(grams[order])
            self.rank.append(order)

    def predict(self, text: str | None) -> tuple[str, float]:
        own = profile(*gram_counts(text))
        if not len(own) or not self.langs:
            return "und", 0.0
        place, far = np.arange(len(own)), []
        for grams, rank in zip(self.sorted, self.rank, strict=True):
            at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
            far.append(int(np.where(grams[at] == own, np.minimum(np.abs(rank[at] - place), TOP), TOP).sum()))
        best = int(np.argmin(far))
        second = min((d for k, d in enumerate(far) if k != best), default=None)
        return self.langs[best], 1.0 if second is None else round((second - far[best]) / second, 9) if second else 0.0


def learn(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Profiles:
    """Profiles of the languages of the rows outside the held-out fold."""
    known = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))  # a row per language
    rate = F.least(F.lit(1.0), F.lit(float(sample)) / F.col("n"))
    chosen = known.join(F.broadcast(counts), "lang").where(sampled(rate, "doc_id", "language")).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
                found.setdefault(lang, []).append(gram_counts(text))
            if sum(map(len, found.values())) > 2000:
                yield from _summed(found)
                found = {}
        yield from _summed(found)

    grams = chosen.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    ranked: dict[str, list[int]] = {}
    for r in grams.withColumn("place", place).where(F.col("place") <= TOP).orderBy("lang", "place").collect():  # TOP rows a language
        ranked.setdefault(r["lang"], []).append(r["gram"])
    return Profiles(ranked)


def _summed(found: dict[str, list]) -> Iterator[pa.RecordBatch]:
    for lang, rows in found.items():
        grams, at = np.unique(np.concatenate([g for g, _ in rows]), return_inverse=True)
        n = np.bincount(at, np.concatenate([c for _, c in rows]), len(grams)).astype(np.int64)
        if len(grams):
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams)), pa.array(grams), pa.array(n)], ["lang", "gram", "n"])


def predict(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2048):
                found = [profiles.predict(t) for t in part["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return predict(docs, learn(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
