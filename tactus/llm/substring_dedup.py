"""Removal of word spans that an earlier document holds too, by suffix automata of reference shards.

A window is ``WINDOW`` consecutive words of a document. A window whose words also start in a document with a smaller id is a repeat,
and every word that a repeat covers is removed, judged on the input.

The reference of a document is the whole corpus, so its automata can't all be sent to every executor. Instead reference and
documents are routed to shards where they can meet: a window belongs to its minimizer, the least of the hashes of its runs
of ``RUN`` words, and equal windows have equal minimizers. (1) Documents with equal words are one; later ones go whole.
(2) Minimizers in one document only are put aside by counting. (3) The pieces of text around the others (consecutive windows of
one minimizer) are sent to the minimizer's shard, each distinct piece once with its least document. Pieces of a minimizer that has more
than ``HOT`` of them go window by window to shards of their own, so no shard grows with a frequent passage or a repetitive document.
(4) A shard builds the suffix automaton of its pieces, with the least document of every state, and streams the pieces through it: the state of
the last ``WINDOW`` words gives the least document that holds a window. (5) Each document's repeats are merged into
maximal spans and cut out.

Words are runs of other than ASCII white space. Null texts have no words. Rows without an id are left as they are and remove
nothing. Rows of one id are told apart by their words and don't remove each other's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tactus.llm.common import discard, materialize
from tactus.llm.jaccard_join import mixed
from tactus.llm.tokens import slices

WINDOW, RUN, HOT = 13, 4, 512
_A = np.uint64(0x9E3779B97F4A7C15)


class SuffixAutomaton:
    """Of several word sequences, each with an owner; a state knows the least owner of its words."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.len, self.least = [-1], [0], [None]

    def _state(self, length: int, step: dict, link: int) -> int:
        self.next.append(step)
        self.link.append(link)
        self.len.append(length)
        self.least.append(None)
        return len(self.len) - 1

    def _clone(self, p: int, q: int, c) -> int:
        new = self._state(self.len[p] + 1, dict(self.next[q]), self.link[q])
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = new
            p = self.link[p]
        self.link[q] = new
        return new

    def _extend(self, last: int, c) -> int:
        q = self.next[last].get(c)
        if q is not None:
            return q if self.len[q] == self.len[last] + 1 else self._clone(last, q, c)
        new, p = self._state(self.len[last] + 1, {}, 0), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.len[q] == self.len[p] + 1 else self._clone(p, q, c)
        return new

    def add(self, words: list, owner: int) -> None:
        last = 0
        for c in words:
            last = self._extend(last, c)
            if self.least[last] is None or owner < self.least[last]:
                self.least[last] = owner

    def finish(self) -> None:
        """Hands every state's least owner on to its suffixes."""
        for s in sorted(range(1, len(self.len)), key=lambda s: -self.len[s]):
            own, up = self.least[s], self.link[s]
            if up > 0 and own is not None and (self.least[up] is None or own < self.least[up]):
                self.least[up] = own

    def statistics(self, words: list, window: int) -> list:
        """For each place where at least ``window`` words match, the least owner of the last ``window`` of them, else None."""
        s, length, out = 0, 0, []
        for c in words:
            while s and c not in self.next[s]:
                s = self.link[s]
                length = self.len[s]
            if c in self.next[s]:
                s = self.next[s][c]
                length += 1
            if length >= window:
                while self.len[self.link[s]] >= window:
                    s = self.link[s]
                    length = self.len[s]
                out.append(self.least[s])
            else:
                out.append(None)
        return out[window - 1 :]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, and the offsets of each text's."""
    cut = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
    values = cut.flatten().dictionary_encode()
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in values.dictionary.cast(pa.binary()).to_pylist()], np.uint64)
    code = values.indices.to_numpy()
    ends = cut.offsets.to_numpy().astype(np.int64) - cut.offsets[0].as_py()
    real = pc.not_equal(values.dictionary, "").to_numpy(zero_copy_only=False).astype(bool)
    if not real.all():
        real = real[code]
        ends, code = np.concatenate([[0], np.cumsum(real)])[ends], code[real]
    return (hashes[code] if len(code) else np.zeros(0, np.uint64)), ends


def minimizers(word: np.ndarray, window: int, run: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of a word sequence, the place and value of its minimizer (the first of equal ones)."""
    if len(word) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    value = word
    for i in range(1, run):
        value = mixed(value[: len(word) - i] * _A + word[i:])
    place, width, wide = np.arange(len(value)), 1, window - run + 1
    while width < wide:  # the least of twice as many places each time
        step = min(width, wide - width)
        later = value[step:] < value[:-step]
        place, value = np.where(later, place[step:], place[:-step]), np.where(later, value[step:], value[:-step])
        width += step
    return place, value


_BASE = "doc_id long, tag long, sig binary, n_words long, kept_sha256 string, mins array<long>, times array<int>"
_PIECE = "doc_id long, tag long, start int, shard long, piece long, words binary"


def _profile(window: int, run: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2048, 8 << 20):
                word, ends = word_hashes(part["text"])
                place, value = minimizers(word, window, run)  # of all texts at once; windows across two texts are passed over
                new = np.concatenate([[True], place[1:] != place[:-1]])
                sig, sha, size, mins, times = [], [], [0], [], []
                for a, b, words in zip(ends[:-1].tolist(), ends[1:].tolist(), _words(part["text"]), strict=True):
                    sig.append(hashlib.blake2b(word[a:b].tobytes(), digest_size=16).digest())
                    sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
                    if b - a >= window:
                        new[a] = True
                        own = slice(a, b - window + 1)
                        found, often = np.unique(value[own][new[own]], return_counts=True)
                        mins.append(found)
                        times.append(often)
                        size.append(size[-1] + len(found))
                    else:
                        size.append(size[-1])
                cuts = pa.array(size, pa.int32())
                lists = [pa.ListArray.from_arrays(cuts, pa.array(np.concatenate(x).view(np.int64) if x else np.zeros(0, np.int64))) for x in (mins, times)]
                lists[1] = lists[1].cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["tag"], pa.array(sig, pa.binary()), pa.array(np.diff(ends)), pa.array(sha, pa.string()), *lists], [c.split()[0] for c in _BASE.split(", ")])

    return go


def _words(texts: pa.Array) -> Iterator[list[bytes]]:
    """The words of each text as bytes, whose split knows ASCII white space alone."""
    return ((t or b"").split() for t in texts.cast(pa.binary()).to_pylist())


def _pieces(window: int, run: int):
    """Rows (doc_id, tag, text, mins, hot) to the pieces of their repeated minimizers. A piece's words go along once a task."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            for part in slices(batch, 1024, 8 << 20):
                word, ends = word_hashes(part["text"])
                places, values = minimizers(word, window, run)
                out: list[list] = [[] for _ in range(6)]
                for k, (a, b, mins, hot) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), part["mins"].to_pylist(), part["hot"].to_pylist(), strict=True)):
                    if b - a < window:
                        continue
                    w, place, value = word[a:b], places[a : b - window + 1], values[a : b - window + 1]
                    wanted = np.array(mins, np.int64).view(np.uint64)
                    order = np.argsort(wanted)
                    wanted, hot = wanted[order], np.array(hot)[order]
                    at = np.minimum(np.searchsorted(wanted, value), len(wanted) - 1)
                    here = wanted[at] == value
                    split = np.concatenate([[True], place[1:] != place[:-1]]) | (hot[at] & here)
                    first = np.flatnonzero(split)
                    last = np.append(first[1:], len(place))
                    keep = here[first]
                    doc, tag = part["doc_id"][k].as_py(), part["tag"][k].as_py()
                    for s, e, h, many in zip(first[keep].tolist(), last[keep].tolist(), value[first[keep]].tolist(), hot[at[first[keep]]].tolist(), strict=True):
                        words = w[s : e + window - 1].tobytes()
                        piece = xxhash.xxh3_64_intdigest(words, seed=1)
                        shard = xxhash.xxh3_64_intdigest(words, seed=h & 0x7FFFFFFF) if many else h
                        out[0].append(doc)
                        out[1].append(tag)
                        out[2].append(s)
                        out[3].append(shard - (1 << 64) if shard >> 63 else shard)
                        out[4].append(piece - (1 << 64) if piece >> 63 else piece)
                        out[5].append(None if piece ^ shard in sent else words)
                        sent.add(piece ^ shard)
                if len(sent) > 400_000:
                    sent = set()
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], [c.split()[0] for c in _PIECE.split(", ")])

    return go


def _shards(window: int):
    """Sorted rows (shard, piece, owner, words) to the least owner of each of a piece's windows."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, out = None, [], [[], [], []]

        def solve() -> None:
            if len(held) == 1:
                piece, owner, words = held[0]
                found = [[owner] * (len(words) // 8 - window + 1)]
            else:
                lists = [np.frombuffer(words, np.uint64).tolist() for _, _, words in held]
                automaton = SuffixAutomaton()
                for words, (_, owner, _) in zip(lists, held, strict=True):
                    automaton.add(words, owner)
                automaton.finish()
                found = [automaton.statistics(words, window) for words in lists]
            for (piece, _, _), least in zip(held, found, strict=True):
                out[0].append(shard)
                out[1].append(piece)
                out[2].append(least)

        def batch_out() -> pa.RecordBatch:
            done = pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.list_(pa.int64()))], ["shard", "piece", "least"])
            out[:] = [[], [], []]
            return done

        for batch in batches:
            for s, p, o, w in zip(*(batch[c].to_pylist() for c in ("shard", "piece", "owner", "words")), strict=True):
                if s != shard:
                    if held:
                        solve()
                    shard, held = s, []
                held.append((p, o, w))
            if len(out[0]) > 5000:
                yield batch_out()
        if held:
            solve()
        yield batch_out()

    return go


def _cut(window: int):
    """Rows (doc_id, tag, text, starts) without the covered words."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed = [], []
            for words, starts in zip(_words(batch["text"]), batch["starts"].to_pylist(), strict=True):
                edge = np.zeros(len(words) + 1, np.int64)
                at = np.unique(np.array(starts, np.int64))
                np.add.at(edge, at, 1)
                np.add.at(edge, at + window, -1)
                gone = np.cumsum(edge)[:-1] > 0
                kept.append(b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g))
                removed.append(int(gone.sum()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["tag"], pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "tag", "n_cut", "kept"])

    return go


def dedup_spans(docs: DataFrame, window: int = WINDOW, run: int = RUN, hot: int = HOT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256, and kept, the text that is left where words were removed (else null)."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    tagged = slim.withColumn("tag", F.xxhash64("text"))
    base = materialize(tagged.mapInArrow(_profile(window, run), _BASE), "profiles")
    firsts = materialize(base.where(f"doc_id is not null and n_words >= {window}").groupBy("sig").agg(F.min("doc_id").alias("first")), "firsts")
    leaders = base.join(firsts, "sig").where("doc_id = first")

    each = leaders.select("doc_id", F.inline(F.arrays_zip(F.col("mins").alias("h"), F.col("times").alias("times"))))
    often = each.groupBy("h").agg(F.count(F.lit(1)).alias("docs"), F.sum("times").alias("n")).where("docs > 1").drop("docs")
    repeated = each.drop("times").join(often, "h").groupBy("doc_id").agg(F.collect_list(F.struct("h", (F.col("n") > hot).alias("hot"))).alias("r"))
    wanted = materialize(repeated.select(F.col("doc_id").alias("_doc"), F.col("r.h").alias("mins"), F.col("r.hot").alias("hot")), "wanted")
    slim_base = materialize(base.drop("mins", "times"), "rows")
    discard(base)
    hits = materialize(tagged.join(wanted, tagged.doc_id == wanted["_doc"]).drop("_doc").dropDuplicates(["doc_id", "tag"]), "hits")
    discard(wanted)
    pieces = materialize(hits.mapInArrow(_pieces(window, run), _PIECE), "pieces")
    owners = pieces.groupBy("shard", "piece").agg(F.min("doc_id").alias("owner"), F.first("words", True).alias("words"))
    least = materialize(owners.repartition(parts, "shard").sortWithinPartitions("shard").mapInArrow(_shards(window), "shard long, piece long, least array<long>"), "least")
    earlier = F.filter(F.transform("least", lambda m, i: F.when(m < F.col("doc_id"), F.col("start") + i)), lambda x: x.isNotNull())
    repeats = pieces.drop("words").join(least, ["shard", "piece"]).select("doc_id", "tag", earlier.alias("starts")).where(F.size("starts") > 0)
    starts = materialize(repeats.groupBy("doc_id", "tag").agg(F.flatten(F.collect_list("starts")).alias("starts")), "starts")
    discard(pieces)
    discard(least)
    cut = hits.select("doc_id", "tag", "text").join(starts, ["doc_id", "tag"]).mapInArrow(_cut(window), "doc_id long, tag long, n_cut long, kept string")
    rows = slim_base.join(firsts, "sig", "left")
    rows = rows.join(cut.withColumnsRenamed({"doc_id": "_doc", "tag": "_tag"}), (F.col("doc_id") == F.col("_doc")) & (F.col("tag") == F.col("_tag")), "left")
    copy = F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False))
    kept = F.when(copy, "").otherwise(F.col("kept"))
    removed = F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_cut", F.lit(0)))
    return rows.select("doc_id", "n_words", removed.alias("n_removed"), F.coalesce(F.sha2(kept, 256), "kept_sha256").alias("kept_sha256"), kept.alias("kept"))


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup_spans(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("kept")
