"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary and one on toxic text. A text is cut into windows of ``WORDS`` words; each
window is compressed with either, and the bytes that the toxic dictionary saves are its margin. A document's score is a
logistic function of its windows' margins: the greatest, and how many and what share of all there are above ``LEVELS`` bytes.

What the toxic dictionary is trained on are the spans by which toxic texts differ: runs of bytes whose ``GRAM``-byte sequences are in ``TIMES`` the
share of toxic as of ordinary texts at least, each at a fixed level of significance for itself, whatever language or word it belongs to.
Trained on whole toxic windows it would hold ordinary words above all, and two samples of those differ by noise. The ordinary dictionary is trained
on windows of ordinary texts; its content stands behind the toxic one's too, so that a window of ordinary words
has the same length under both. The logistic function is fitted on cross-fitted margins: each of ``FOLDS`` parts of the texts
is compressed with dictionaries of the others. Its constant puts 0.5 at the cut with the best F1 on these.

Only labels of documents outside the held-out fold are learned from, in a sample of at most about ``SAMPLE`` documents
a class (chosen by a hash of the id) of at most ``LONGEST`` characters, and of their ordinary windows at most ``TRAINED``; all texts are scored whole.
Null and empty texts, and texts of white space only, have no windows; they get the score of a text whose windows have no margin.
Labels of ids with several rows count as toxic if one is. Rows keep their multiplicity. Without labels of both classes all texts
score alike.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tactus.llm.common import held_out, sampled
from tactus.llm.tokens import slices

WORDS, STEP, GRAM = 8, 7, 6
ORDINARY_BYTES, TOXIC_BYTES, TRAINED = 32_768, 1536, 40_000
SAMPLE, LONGEST, FOLDS = 2500, 50_000, 4
#: Bytes of margin; how many sequences of all are taken for toxic wrongly on average; least ratio of its shares, beyond what a language with more toxic texts has.
LEVELS, WRONG, TIMES = (2, 4), 5.0, 4.0
FEATURES = 3 + 2 * len(LEVELS) + 1
#: The same for both dictionaries: far enough a search for the whole of them, short matches allowed.
_SETTINGS = {"compression_level": 6, "window_log": 17, "hash_log": 17, "chain_log": 17, "search_log": 6, "target_length": 32, "min_match": 4, "strategy": zstandard.STRATEGY_LAZY2}
#: The end of a trained dictionary's header: the three first repeated offsets.
_HEADER_END = b"".join(x.to_bytes(4, "little") for x in (1, 4, 8))


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    settings = zstandard.ZstdCompressionParameters(**_SETTINGS, write_content_size=False, write_checksum=False, write_dict_id=False)
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=held, compression_params=settings)


def _lengths(use: zstandard.ZstdCompressor, data: bytes, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Compressed length of each span of ``data``."""
    if not len(at):
        return np.zeros(0, np.int64)
    spans = zstandard.BufferWithSegments(data, np.stack([at, size], 1).astype(np.uint64).tobytes())
    done = use.multi_compress_to_buffer(spans, threads=1)
    return np.array([len(x) for x in done], np.int64)


def windows(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and size in bytes of the windows of a text with single-byte white space between words."""
    word = np.frombuffer(text, np.uint8) > 32
    edge = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return start, end
    first = np.arange(0, max(1, len(start) - (WORDS - STEP)), STEP)
    return start[first], end[np.minimum(first + WORDS, len(start)) - 1] - start[first]


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...] = ()

    def margins(self, data: bytes, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        if not hasattr(self, "_use"):
            self._use = _compressor(self.ordinary), _compressor(self.toxic + self.ordinary)
        return _lengths(self._use[0], data, at, size) - _lengths(self._use[1], data, at, size)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_use"}

    def features(self, texts: list[bytes]) -> np.ndarray:
        """A row per text: largest margin, mean of the three largest, log of the number of windows; then logs of the numbers and roots of the shares of
        windows above each level, and the root of the mean margin. A negative margin counts as none."""
        spans = [windows(t) for t in texts]
        base = np.cumsum([0, *map(len, texts)])
        at = np.concatenate([s[0] + b for s, b in zip(spans, base, strict=False)]) if texts else np.zeros(0, np.int64)
        size = np.concatenate([s[1] for s in spans]) if texts else at
        m = np.maximum(self.margins(b"".join(texts), at, size), 0)
        out, k = np.zeros((len(texts), FEATURES)), 0
        for i, (s, _) in enumerate(spans):
            own = m[k : k + len(s)]
            k += len(s)
            if len(own):
                top = np.sort(own)[::-1][:3]
                above = [int((own >= x).sum()) for x in LEVELS]
                out[i] = top[0], top.sum() / 3, math.log1p(len(own)), *map(math.log1p, above), *(math.sqrt(n / len(own)) for n in above), math.sqrt(own.mean())
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        w = np.array(self.weights)
        return 1 / (1 + np.exp(-np.clip(x @ w[1:] + w[0], -30, 30)))


def plain(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "replace")


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Newton's method over weighted rows, with a ridge on all but the constant."""
    x = np.column_stack([np.ones(len(x)), x])
    w, pen = np.zeros(x.shape[1]), np.diag([1e-9, *[ridge] * (x.shape[1] - 1)])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w - np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + pen, x.T @ (weight * (p - y)) + pen @ w)
    return w


def _best_cut(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The cut of the values z with the best weighted F1 of label 1, halfway to the value below it."""
    order = np.argsort(-z, kind="stable")
    z, hit = z[order], np.cumsum((weight * y)[order])
    last = np.append(z[1:] != z[:-1], True)  # equal values fall on one side
    f1 = np.where(last, 2 * hit / (np.cumsum(weight[order]) + hit[-1]), -1)
    k = int(np.argmax(f1))
    return float((z[k] + z[min(k + 1, len(z) - 1)]) / 2)


def _trained(size: int, samples: list[bytes], k: int, d: int) -> bytes:
    """The content of a dictionary trained by zstandard; the samples themselves where they are too few to train on."""
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(size, samples, k=k, d=d, level=6).as_bytes().split(_HEADER_END, 1)[-1]
    except zstandard.ZstdError:
        return b" ".join(dict.fromkeys(samples))[-size:]


def _grams(text: bytes) -> np.ndarray:
    """The ``GRAM``-byte sequences of a text, packed, by their starts; a space stands at both ends."""
    raw = np.frombuffer(b" " + text + b" ", np.uint8).astype(np.uint64)
    out = np.zeros(max(0, len(raw) - GRAM + 1), np.uint64)
    for i in range(GRAM):
        out |= raw[i : i + len(out)] << np.uint64(8 * i)
    return out


def _root(a: np.ndarray, b: np.ndarray, n1: float, n0: float) -> np.ndarray:
    """Signed root of the likelihood ratio of a of n1 toxic and b of n0 ordinary documents; standard normal where both have the same share, also if rare."""
    part = lambda k, n, p: np.where(k > 0, k * np.log(np.maximum(p, 1e-300)), 0) + np.where(n > k, (n - k) * np.log(np.maximum(1 - p, 1e-300)), 0)
    both = (a + b) / (n1 + n0)
    g = 2 * (part(a, n1, a / n1) + part(b, n0, b / n0) - part(a, n1, both) - part(b, n0, both))
    return np.sqrt(np.maximum(g, 0)) * np.sign(a / n1 - b / n0)


def contrasting(texts: list[bytes], labels: np.ndarray) -> np.ndarray:
    """The sequences that a share of toxic texts ``TIMES`` that of ordinary ones holds, ``WRONG`` of them by chance. Equal texts count once."""
    once: dict[bytes, int] = {}
    for t, v in zip(texts, labels, strict=True):
        once[t] = max(once.get(t, 0), int(v))
    n1 = sum(once.values())
    found = {v: np.unique(np.concatenate([np.zeros(0, np.uint64), *(np.unique(_grams(t)) for t, w in once.items() if w == v)]), return_counts=True) for v in (0, 1)}
    (u0, c0), (u1, c1) = found[0], found[1]
    if not len(u1) or not len(u0):
        return u1
    at = np.minimum(np.searchsorted(u0, u1), len(u0) - 1)
    a, b, n0 = c1.astype(float), np.where(u0[at] == u1, c0[at], 0).astype(float), len(once) - n1
    return u1[(_root(a, b, n1, n0) >= NormalDist().inv_cdf(1 - min(0.5, WRONG / len(u1)))) & (a / n1 >= TIMES * b / n0)]


def _spans(text: bytes, grams: np.ndarray) -> bytes:
    """The parts of a text that the sequences cover, one after another."""
    hit = np.flatnonzero(np.isin(_grams(text), grams))
    edge = np.zeros(len(text) + 3, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + GRAM, -1)
    covered = np.cumsum(edge)[: len(text) + 2] > 0
    return np.frombuffer(b" " + text + b" ", np.uint8)[covered].tobytes()


def train(texts: list[bytes], labels: np.ndarray, seed: int = 7) -> Model:
    """A model without weights: the two dictionaries."""
    ordinary = [t[i : i + n] for t, v in zip(texts, labels, strict=True) if not v for i, n in zip(*(x.tolist() for x in windows(t)), strict=True)]
    np.random.default_rng(seed).shuffle(ordinary)
    grams = contrasting(texts, labels)
    toxic = [s for t, v in zip(texts, labels, strict=True) if v and (s := _spans(t, grams))]
    return Model(_trained(ORDINARY_BYTES, ordinary[:TRAINED], 64, 8), _trained(TOXIC_BYTES, toxic, 32, GRAM))


def fit(rows: list[tuple[str | None, int]], share: float | None = None) -> Model:
    """A model from (text, label) rows; ``share``: of label 1 among all labelled rows, where the sample has another."""
    texts, labels = [plain(t) for t, _ in rows], np.array([int(v) for _, v in rows], float)
    if not len(labels) or labels.min() == labels.max():
        return Model(b"", b"", (30.0 if len(labels) and labels[0] else -30.0, *[0.0] * FEATURES))
    fold = np.array([zlib.crc32(t) % FOLDS for t in texts])  # equal texts lie in one fold
    x = np.zeros((len(texts), FEATURES))
    for k in range(FOLDS):
        own, other = np.flatnonzero(fold == k), np.flatnonzero(fold != k)
        if len(own) and len(other):
            x[own] = train([texts[i] for i in other], labels[other]).features([texts[i] for i in own])
    n1, n0 = labels.sum(), len(labels) - labels.sum()
    share = n1 / len(labels) if share is None else share
    weight = np.where(labels == 1, share / n1, (1 - share) / n0) * len(labels)
    w = _logistic(x, labels, weight)
    w[0] -= _best_cut(x @ w[1:] + w[0], labels, weight)
    whole = train(texts, labels)
    return Model(whole.ordinary, whole.toxic, tuple(map(float, w)))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, longest: int = LONGEST) -> Model:
    """Fit on a hashed sample of the labelled rows outside the held-out fold."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(~held_out(F.col("doc_id")))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    rate = F.lit(0.0)
    for v, n in counts.items():
        rate = F.when(F.col("toxic") == v, F.lit(min(1.0, sample / n))).otherwise(rate)
    chosen = known.where(sampled(rate, "doc_id", "toxicity"))
    texts = docs.select("doc_id", "text").where(F.length("text") <= longest)
    rows = texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic", "doc_id").collect()  # bounded by ``sample`` a class
    return fit([(r["text"], r["toxic"]) for r in sorted(rows, key=lambda r: (r["doc_id"], r["text"]))], counts.get(1, 0) / max(1, sum(counts.values())))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2048, 8 << 20):
                found = model.scores(model.features([plain(t) for t in part["text"].to_pylist()]))
                yield pa.RecordBatch.from_arrays([part["doc_id"], pc.round(pa.array(found), 9)], ["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, score double")


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score(docs, learn(docs, labels)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def stage_toxicity(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the model doesn't reject, with their columns."""
    model = learn(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    schema, names = docs.schema, docs.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2048, 8 << 20):
                found = model.scores(model.features([plain(t) for t in part["text"].to_pylist()]))
                yield pa.RecordBatch.from_arrays([part[c] for c in names], names).filter(pa.array(found < 0.5))

    return docs.mapInArrow(keep, schema)
