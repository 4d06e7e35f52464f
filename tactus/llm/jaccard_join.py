"""Set-similarity join on word shingles by chosen paths.

A text's set holds the 64-bit hashes of its runs of ``SHINGLE`` lower-case words (fewer words: the one run of all). Texts with equal
sets form a class first; only its least document takes part further, with the class's size as weight.

*Chosen paths.* In each of several runs a set chooses its tokens whose hash under the run is below 1 / (similarity * size), about
1 / similarity of them; sets that choose a token meet in its bucket. Two sets at the threshold share a chosen token
of a run with probability 1 - 1/e at least, so runs are repeated until the share of missed pairs is below 1 - ``RECALL``.
Buckets of more than ``LIMIT`` sets are split again: their sets, alone, are read once more and choose further tokens by hashes that depend on the
path so far, to a depth of ``DEPTH``. A deeper path is shared less surely, so those sets choose in as many runs as the last depth needs.
Buckets are compared whole, in sketch form (one-permutation minima of ``BINS`` bins, a byte each); one that is
still large at the last depth is compared in pairs of blocks. Pairs whose sketches agree far enough that the sets may reach the threshold
connect them; a bucket gives a spanning forest, not its pairs.

*Exact check.* All sets that may be similar are now in one component of those forests. Components are compared whole by exact
intersection sizes, large ones in pairs of blocks, each set shipped once a block. This yields every set's number of links and a spanning
forest of the true links, whose components are the classes. Links between sets of one component that no bucket showed are found too. Where classes alone are asked for, the buckets'
trees are checked edge by edge first, which takes time in proportion to a group, and only components that these leave in several classes are compared whole.

Null texts, texts without words and rows without an id have no links; a text without words is a class of its own. Rows of one
id with different texts belong each to its own text's class; repeated rows count as copies. Words are parted by ASCII white space.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tactus.llm.common import is_small, materialize, release
from tactus.llm.components import components
from tactus.llm.tokens import slices

SHINGLE, SIMILARITY, RECALL, DEPTH, LIMIT, BLOCK, BINS = 5, 0.8, 0.99999, 3, 4096, 512, 64
#: Tables of ids and hashes (some 50 bytes a row) are broadcast up to so many rows; beyond that, texts are shuffled to them.
SMALL = 200_000
#: Rows of a matrix of pairs that are worked on at a time.
ROWS = 256
#: Sketches of sets at the threshold agree at least so far less than it but for a share of about 1e-6.
SLACK = 0.25
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_32 = np.uint64(32)


def runs_for(recall: float, depth: int = 1) -> int:
    """Runs until pairs at the threshold that meet at this depth only are found so surely. On average one chosen token of a path is shared, so a run
    misses by 1/e at depth 1, and by exp(miss - 1) of the miss before at each further one."""
    miss = 0.0
    for _ in range(depth):
        miss = math.exp(miss - 1)
    return max(1, math.ceil(math.log(1 - recall) / math.log(miss)))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _32)) * _A
    x = (x ^ (x >> _32)) * _B
    return x ^ (x >> _32)


def shingle_sets(texts: pa.Array, k: int = SHINGLE) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each text."""
    lower = pc.utf8_lower(pc.fill_null(texts.cast(pa.string()), ""))
    cut = pc.ascii_split_whitespace(lower)
    values = cut.flatten().dictionary_encode()
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in values.dictionary.to_pylist()], np.uint64)
    empty = pc.equal(values.dictionary, "").to_numpy(zero_copy_only=False).astype(bool)
    code = values.indices.to_numpy()
    ends = cut.offsets.to_numpy().astype(np.int64) - cut.offsets[0].as_py()
    if empty.any():
        real = ~empty[code]
        ends = np.concatenate([[0], np.cumsum(real)])[ends]
        code = code[real]
    word = hashes[code] if len(code) else np.zeros(0, np.uint64)
    rolled = word.copy()
    for i in range(1, k):
        rolled = mixed(rolled[: len(word) - i] * _A + word[i:]) if len(word) > i else rolled[:0]
    out = []
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        if b - a >= k:
            z = np.sort(mixed(rolled[a : b - k + 1]))
            out.append(z[np.concatenate([[True], z[1:] != z[:-1]])])
        elif b > a:
            out.append(np.array([xxhash.xxh3_64_intdigest(word[a:b].tobytes())], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


_EDGES = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - BINS.bit_length() + 1)


def sketch(z: np.ndarray) -> np.ndarray:
    """A byte of the least hash in each bin, never 0; 0 where a bin is empty."""
    first = np.searchsorted(z, _EDGES)
    full = first < np.append(first[1:], len(z))
    low = z[np.minimum(first, len(z) - 1)]
    return np.where(full, mixed(low) % np.uint64(255) + np.uint64(1), 0).astype(np.uint8)


def choose(z: np.ndarray, paths: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Which path (row) chooses which token (column) of a set."""
    most = np.uint64(min(2**64 - 1, int(2**64 / (similarity * len(z)))))
    return np.nonzero(mixed(z[None, :] ^ paths[:, None]) < most)


def chosen_paths(z: np.ndarray, runs: int, similarity: float, depth: int = DEPTH) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each depth, the paths and the places of their parents among the paths before."""
    paths, out = mixed(np.arange(1, runs + 1, dtype=np.uint64) * _B), []
    for _ in range(depth):
        parent, token = choose(z, paths, similarity)
        paths = mixed(paths[parent] * _A + z[token])
        out.append((paths, parent))
    return out


_PROFILE = "doc_id long, text_key long, sig binary, size int, sketch binary, paths array<long>"
_DEEP = "rep long, " + ", ".join(f"p{d} array<long>, at{d} array<int>" for d in range(1, DEPTH + 1))


def _profiles(runs: int, similarity: float, shingle: int) -> Callable:
    """Digest, size, sketch and the chosen tokens of the first level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2048, 8 << 20):
                rows = []
                for z in shingle_sets(part["text"], shingle):
                    if len(z):
                        rows.append((hashlib.blake2b(z.tobytes(), digest_size=16).digest(), len(z), sketch(z).tobytes(), chosen_paths(z, runs, similarity, 1)[0][0].view(np.int64)))
                    else:
                        rows.append((None, 0, None, None))
                sig, size, marks, paths = zip(*rows, strict=True)
                columns = [part["doc_id"], part["text_key"], pa.array(sig, pa.binary()), pa.array(size, pa.int32()), pa.array(marks, pa.binary()), _lists(paths, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _PROFILE.split(", ")])
            release()

    return run


def _deep_paths(runs: int, similarity: float, shingle: int) -> Callable:
    """Rows (rep, text) to the chosen paths of all levels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2048, 8 << 20):
                levels = [[x for p, at in chosen_paths(z, runs, similarity) for x in (p.view(np.int64), at.astype(np.int32))] for z in shingle_sets(part["text"], shingle)]
                columns = [part["rep"], *(_lists(x, pa.int32() if k % 2 else pa.int64()) for k, x in enumerate(zip(*levels, strict=True)))]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _DEEP.split(", ")])

    return run


def _lists(rows: tuple, kind: pa.DataType) -> pa.Array:
    size = np.array([0 if x is None else len(x) for x in rows])
    flat = [x for x in rows if x is not None and len(x)]
    values = pa.array(np.concatenate(flat) if flat else np.zeros(0), kind)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), values)


def _forest(near: np.ndarray) -> np.ndarray:
    """The least index of each row's component of a symmetric boolean matrix."""
    n = len(near)
    root = np.full(n, -1)
    for i in range(n):
        if root[i] < 0:
            seen = np.zeros(n, bool)
            seen[i], edge = True, np.array([i])
            while len(edge):
                more = np.zeros(n, bool)
                for k in range(0, len(edge), ROWS):
                    more |= near[edge[k : k + ROWS]].any(0)
                edge = np.flatnonzero(more & ~seen)
                seen[edge] = True
            root[seen] = i
    return root


def _across(block: np.ndarray) -> np.ndarray:
    """The symmetric matrix of two sides that are linked by ``block``."""
    n, m = block.shape
    out = np.zeros((n + m, n + m), block.dtype)
    out[:n, n:], out[n:, :n] = block, block.T
    return out


def _agree(x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
    """Whether the estimated similarity of each row of x to each of y is at least so much."""
    out, b = np.zeros((len(x), len(y)), bool), np.where(y > 0, y, -2).astype(np.int16).T.copy()
    other = (y > 0).astype(np.float32)
    for k in range(0, len(x), ROWS):
        part = x[k : k + ROWS]
        a, full, same = np.where(part > 0, part, -1).astype(np.int16).T.copy(), (part > 0).astype(np.float32), np.zeros((len(part), len(y)), np.uint8)
        for i in range(BINS):
            same += a[i][:, None] == b[i]
        filled = full.sum(1)[:, None] + other.sum(1) - full @ other.T
        out[k : k + ROWS] = same >= np.float32(least) * np.maximum(1, filled)
    return out


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list]]:
    """Runs of rows with equal first ``keys`` columns of a sorted partition, as columns."""
    key, held = None, None
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(columns[0]):
            continue
        change = np.zeros(len(columns[0]), bool)
        for c in columns[:keys]:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), len(change)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            here, rows = tuple(c[a].item() if hasattr(c[a], "item") else c[a] for c in columns[:keys]), [c[a:b] for c in columns[keys:]]
            if here == key:
                held.append(rows)
                continue
            if held:
                yield key, [np.concatenate(x) for x in zip(*held, strict=True)]
            key, held = here, [rows]
    if held:
        yield key, [np.concatenate(x) for x in zip(*held, strict=True)]


def _step(before: Column, at: Column, path: Column) -> Column:
    """A path with its parent, found by its place among the paths before."""
    return F.struct(F.get(before, at).alias("parent"), path.alias("path"))


def _candidates(least: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        us, vs = [], []
        for (_, i, j), (side, rep, marks) in _groups(batches, 3):
            if len(rep) > 1:
                x = np.frombuffer(b"".join(marks), np.uint8).reshape(len(rep), BINS)
                if i != j:  # two blocks: each by itself is compared elsewhere
                    order = np.lexsort((rep, side))
                    rep, x, n = rep[order], x[order], int((side == 0).sum())
                    if 0 < n < len(rep):
                        root = _forest(_across(_agree(x[:n], x[n:], least)))
                        own = root != np.arange(len(rep))
                        us.append(rep[own])
                        vs.append(rep[root[own]])
                elif len(rep) == 2:
                    if _agree(x[:1], x[1:], least)[0, 0]:
                        us.append(rep[:1])
                        vs.append(rep[1:])
                else:
                    order = np.argsort(rep, kind="stable")
                    rep, x = rep[order], x[order]
                    root = _forest(_agree(x, x, least))
                    own = root != np.arange(len(rep))
                    us.append(rep[own])
                    vs.append(rep[root[own]])
            if len(us) > 500:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["u", "v"])
                us, vs = [], []
        if us:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["u", "v"])

    return run


def _blocked(rows: DataFrame, key: str, size: str, block: int) -> DataFrame:
    """Adds (i, j) and side: rows of a group of more than ``block`` are dealt to blocks, and to the pairs of blocks."""
    n = F.greatest(F.lit(1), F.ceil(F.col(size) / block)).cast("int")
    own = F.pmod(F.xxhash64("rep", F.col(key)), n).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("_n") - 1), lambda k: F.struct(F.least("_own", k).alias("i"), F.greatest("_own", k).alias("j"), F.when(F.col("_own") <= k, 0).otherwise(1).alias("side")))
    return rows.withColumns({"_n": n}).withColumn("_own", own).withColumn("_p", F.explode(pairs)).select("*", "_p.i", "_p.j", "_p.side").drop("_n", "_own", "_p")


def _overlaps(sets: list[np.ndarray], cut: int | None = None) -> np.ndarray:
    """Exact intersection sizes of all pairs of sets, or of the first ``cut`` with the others."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(z) for z in sets])
    token, place, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = often > 1
    new = np.cumsum(shared) - 1
    keep = shared[place]
    place, owner = new[place[keep]], owner[keep]
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    a, b = (0, n) if cut is None else (cut, cut)
    out, width, total = np.zeros((b, n - a), np.float32), max(256, (1 << 20) // max(1, n)), int(shared.sum())
    for k in range(0, total, width):
        lo, hi = np.searchsorted(place, [k, k + width])
        x = np.zeros((n, min(width, total - k)), np.float32)
        x[owner[lo:hi], place[lo:hi] - k] = 1
        out += x[:b] @ x[a:].T
    return out


def _verify(similarity: float, shingle: int) -> Callable:
    names = ["rep", "n_links", "root"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[], [], []]
        for (_, i, j), (side, rep, weight, texts) in _groups(batches, 3):
            n = int((side == 0).sum()) if i != j else None  # two blocks: only across
            if len(rep) < 2 or n in (0, len(rep)):
                continue
            order = np.lexsort((rep, side))
            rep, weight = rep[order], weight[order]
            sets = shingle_sets(pa.array([texts[k] for k in order], pa.string()), shingle)
            size, counts = np.array([len(z) for z in sets], np.float64), _overlaps(sets, n)
            linked = np.zeros(counts.shape, bool)
            for k in range(0, len(counts), ROWS):
                both = counts[k : k + ROWS].astype(np.float64)
                linked[k : k + ROWS] = both >= similarity * (size[:n][k : k + ROWS, None] + size[None, n or 0 :] - both) - 1e-9
            del counts
            if n is None:
                np.fill_diagonal(linked, False)
            else:
                linked = _across(linked)
            any_ = linked.any(1)
            root = _forest(linked)
            out[0].append(rep[any_])
            out[1].append(np.concatenate([linked[k : k + ROWS] @ weight for k in range(0, len(linked), ROWS)])[any_].astype(np.int64))
            out[2].append(rep[root][any_])
            if len(out[0]) > 200:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names)
                out = [[], [], []]
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names)
        release()

    return run


def _linked(similarity: float, shingle: int) -> Callable:
    """The pairs of a text (side 0) and those that follow it that are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own = None, None
        for batch in batches:
            for part in slices(batch, 1024, 4 << 20):
                u, salt, side, v = (part[c].to_numpy(zero_copy_only=False) for c in ("u", "salt", "side", "v"))
                ok = np.zeros(len(u), bool)
                for k, z in enumerate(shingle_sets(part["text"], shingle)):
                    if side[k] == 0:
                        key, own = (u[k], salt[k]), z
                    elif key == (u[k], salt[k]):
                        both = len(np.intersect1d(own, z, assume_unique=True))
                        ok[k] = both >= similarity * (len(own) + len(z) - both) - 1e-9
                yield pa.RecordBatch.from_arrays([pa.array(u[ok]), pa.array(v[ok])], ["u", "v"])
            release()

    return run


def _verified(edges: DataFrame, texts: Callable[[DataFrame], DataFrame], similarity: float, shingle: int, fan: int = 1024) -> DataFrame:
    """Those of the edges (u, v) whose sets are similar enough. A node of many edges is dealt to several keys; its text goes once to each, and each other end's once an edge."""
    parts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = materialize(texts(edges.select(F.explode(F.array("u", "v")).alias("rep")).distinct()), "ends")
    salts = edges.groupBy("u").agg(F.ceil(F.count(F.lit(1)) / fan).cast("int").alias("n"))
    salted = edges.join(salts, "u").select("u", F.pmod(F.xxhash64("u", "v"), F.col("n")).cast("int").alias("salt"), F.lit(1).alias("side"), "v")
    ends = salted.join(known.withColumnRenamed("rep", "v"), "v").select("u", "salt", "side", "v", "text")
    heads = salts.select("u", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("salt"), F.lit(0).alias("side"), F.col("u").alias("v")).join(known.withColumnRenamed("rep", "u"), "u").select("u", "salt", "side", "v", "text")
    return heads.unionByName(ends).repartition(parts, "u", "salt").sortWithinPartitions("u", "salt", "side").mapInArrow(_linked(similarity, shingle), "u long, v long")


def _bucket_pairs(first: DataFrame, texts: Callable[[DataFrame], DataFrame], recall: float, similarity: float, shingle: int, limit: int) -> DataFrame:
    """path, n, rep: the members of all buckets to be compared. ``first``: rep, path of the first level; ``texts`` adds the text to rows of rep."""
    sizes = materialize(first.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    met, large = first.join(sizes.where(F.col("n") <= limit), "path"), sizes.where(F.col("n") > limit)
    if large.isEmpty():
        return met
    crowded = first.join(large.select("path"), "path", "left_semi").select("rep").distinct()
    deep = materialize(texts(crowded).mapInArrow(_deep_paths(runs_for(recall, DEPTH), similarity, shingle), _DEEP), "deep")
    for d in range(1, DEPTH + 1):
        if d == 1:
            rows = deep.select("rep", F.explode("p1").alias("path"))
        else:
            chosen = F.zip_with(f"at{d}", f"p{d}", partial(_step, F.col(f"p{d - 1}")))
            rows = deep.select("rep", F.inline(chosen)).join(large.select(F.col("path").alias("parent")), "parent", "left_semi").select("rep", "path")
        sizes = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        if d < DEPTH:
            sizes = materialize(sizes, "buckets")
            large, sizes = sizes.where(F.col("n") > limit), sizes.where(F.col("n") <= limit)
        met = met.unionByName(rows.join(sizes, "path"))
        if d < DEPTH and large.isEmpty():
            break
    return met


def _classified(docs: DataFrame, similarity: float, recall: float, shingle: int, limit: int, block: int, id_col: str, text_col: str, counted: bool = True) -> DataFrame:
    """``similarity_classes`` with text_key, the hash of a row's text; unless ``counted``, n_links is a lower bound."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("text_key", F.xxhash64("text"))
    base = materialize(slim.mapInArrow(_profiles(runs_for(recall), similarity, shingle), _PROFILE), "profiles")
    least = F.min(F.struct("doc_id", "text_key"))
    classes = base.where("sig is not null and doc_id is not null").groupBy("sig").agg(least.alias("first"), F.count(F.lit(1)).alias("weight"), F.first("sketch").alias("sketch"), F.first("paths").alias("paths"))
    # a class has a number of its own, as several may begin with texts of one id
    classes = materialize(classes.select(F.monotonically_increasing_id().alias("rep"), "sig", "first.*", "weight", "sketch", "paths"), "classes")

    def texts(reps: DataFrame) -> DataFrame:
        """rep, the other columns and the text of each row of ``reps``; of repeated rows one."""
        wanted = materialize(reps.join(classes.select("rep", "doc_id", "text_key"), "rep"), "wanted")
        wanted = F.broadcast(wanted) if is_small(wanted, SMALL) else wanted
        rows = slim.where("doc_id is not null and text is not null").join(wanted, ["doc_id", "text_key"])
        return rows.groupBy(*reps.columns).agg(F.min("text").alias("text"))

    met = _bucket_pairs(classes.select("rep", F.explode("paths").alias("path")), texts, recall, similarity, shingle, limit)
    met = _blocked(met.join(classes.select("rep", "sketch"), "rep"), "path", "n", limit)
    dealt = met.select("path", "i", "j", "side", "rep", "sketch").repartition(parts, "path", "i", "j").sortWithinPartitions("path", "i", "j")
    edges = materialize(dealt.mapInArrow(_candidates(similarity - SLACK), "u long, v long").distinct(), "candidates")
    joined, sure = components(edges), None
    if not counted:
        # where the buckets' trees alone, checked exactly, make one class of a component, no other pair of it matters
        sure = materialize(_verified(edges, texts, similarity, shingle), "sure")
        own = joined.join(components(sure).withColumnRenamed("root", "class"), "node", "left").select("node", "root", F.coalesce("class", "node").alias("class"))
        open_ = own.groupBy("root").agg(F.min("class").alias("a"), F.max("class").alias("b")).where("a <> b").select("root")
        joined = materialize(joined.join(open_, "root", "left_semi"), "open")
    sizes = joined.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    members = joined.join(sizes, "root").withColumnRenamed("node", "rep").join(classes.select("rep", "weight"), "rep")
    dealt = _blocked(texts(members), "root", "n", block).select("root", "i", "j", "side", "rep", "weight", "text").repartition(parts, "root", "i", "j").sortWithinPartitions("root", "i", "j")
    links = materialize(dealt.mapInArrow(_verify(similarity, shingle), "rep long, n_links long, root long"), "links")
    if sure is not None:
        links = links.unionByName(sure.select(F.col("u").alias("rep"), F.lit(0).cast("long").alias("n_links"), F.col("v").alias("root")))
    counts = links.groupBy("rep").agg(F.sum("n_links").alias("n_links"))
    roots = components(links.select(F.col("rep").alias("u"), F.col("root").alias("v"))).withColumnRenamed("node", "rep")
    first = roots.join(classes.select("rep", "doc_id"), "rep").groupBy("root").agg(F.min("doc_id").alias("class_id"))
    known = classes.join(counts, "rep", "left").join(roots.join(first, "root").drop("root"), "rep", "left")
    known = known.select("sig", F.coalesce("class_id", "doc_id").alias("class_id"), (F.coalesce("n_links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    out = base.select("doc_id", "text_key", "sig", F.col("size").cast("long").alias("n_shingles")).join(known, "sig", "left")
    return out.select("doc_id", "text_key", F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"), F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"), "n_shingles")


def similarity_classes(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, shingle: int = SHINGLE, limit: int = LIMIT, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of ``docs``: doc_id, class_id (the least id of its class), n_links (other documents similar enough), n_shingles."""
    return _classified(docs, similarity, recall, shingle, limit, block, id_col, text_col).drop("text_key")


def op1_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return similarity_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def stage_jaccard_join(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class, the one with the least id; rows without an id stay."""
    found = _classified(docs, SIMILARITY, RECALL, SHINGLE, LIMIT, BLOCK, "doc_id", "text", counted=False)
    gone = materialize(found.where("class_id < doc_id").select("doc_id", "text_key").distinct(), "gone")
    gone = (F.broadcast(gone) if is_small(gone, SMALL) else gone).alias("gone")
    return docs.alias("docs").join(gone, (F.col("docs.doc_id").cast("long") == F.col("gone.doc_id")) & (F.xxhash64("docs.text") == F.col("gone.text_key")), "left_anti")
