"""Hard-negative mining over a pivot table.

A row is an id, a label and an integer vector; a score is the inner product with an anchor. A vector v becomes the point (v, sqrt(M^2 - |v|^2)) and an anchor a
the point (a, 0), M the greatest norm: then distance^2 = |a|^2 + M^2 - 2 score, so scores are Euclidean distances. Every row's distances to
``PIVOTS`` pivots are stored. For an anchor at distances q and a row at distances D, the triangle inequality brackets their distance by
max |q - D| and min (q + D), and so the score from both sides.

*Table.* Rows are ordered by their nearest pivot and its distance and cut into shards of a bounded number of components, each with the range of its
distances; a group of equal vectors is spread over as many shards as it needs. Pivots are the farthest-first rows of a bounded sample; they
bear on the work, not on the results.

*Search.* A shard's ranges bracket an anchor's scores with all of its rows: anchors are sent only to shards that may hold what they look for. There,
leaves of ``LEAF`` rows are bracketed in the same way, then rows, and the rows left get exact scores in blocks. The first search gives
each anchor its best rows of its label, starting from a threshold found around its own place of the table; the second one gives, for each of these positives,
the best rows of other labels between ``low`` and ``high`` percent of the positive's score. Tasks hold one shard and a batch of anchors, and send the few best of
each; nothing whole passes through a task or the driver.

Rows with a null id, label or vector, or with a null or non-finite component take no part. Shorter vectors are continued by zeros. Scores are exact;
what leaves the longs is clipped to their ends. Ties go to the smaller id. Repeated rows each take a place of their own, but an anchor's "other rows" are those
of other ids, and equal anchors search once. An anchor without positives, or without rows between the bounds, gives no rows; an empty table gives none. Other columns
aren't read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tactus.llm.common import materialize, sampled

PIVOTS, SAMPLE = 16, 2000
#: Components in a shard, rows in a leaf, anchors at a time, summaries of shards in a block, rows around an anchor that give its first threshold.
SHARD, LEAF, ANCHORS, BLOCK, AROUND = 4_000_000, 256, 256, 1024, 1024
_NEAR = 1e-5  # distances are kept as 32-bit floats: brackets are widened by this share of their scale
_EXACT = 2.0**53 / 128


def quantised(vector: np.ndarray, scale: int = 256) -> np.ndarray:
    return np.clip(np.floor(scale * vector.astype(np.float64)), -(2.0**63), 2.0**63 - 1024).astype(np.int64)


def _matrix(column: pa.Array, dims: int, kind: type = np.float64) -> np.ndarray:
    """A row for each list, continued by zeros."""
    cuts = column.offsets.to_numpy().astype(np.int64)
    flat, size = column.values.to_numpy(zero_copy_only=False)[cuts[0] : cuts[-1]], np.diff(cuts)
    if len(size) and (size == dims).all():
        return flat.reshape(len(size), dims).astype(kind)
    out = np.zeros((len(size), dims), kind)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(cuts[:-1] - cuts[0], size)] = flat
    return out


def _read(scale: int) -> Callable:
    """Integer vectors of the rows that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = pa.RecordBatch.from_arrays([pc.filter(c, pc.is_valid(batch["vector"])) for c in batch.columns], batch.schema.names)
            lists = batch["vector"]
            cuts = lists.offsets.to_numpy().astype(np.int64)
            flat = lists.values.slice(cuts[0], cuts[-1] - cuts[0])
            good = pc.fill_null(pc.is_finite(flat), False).to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(lists)), np.diff(cuts))
            keep = np.ones(len(lists), bool)
            keep[owner[~good]] = False
            whole = quantised(pc.fill_null(flat, 0).to_numpy(zero_copy_only=False), scale)[keep[owner]]
            size = np.diff(cuts)[keep]
            norm = np.bincount(owner[keep[owner]], weights=whole.astype(np.float64) ** 2, minlength=len(lists))[keep]
            kept = [batch[c].filter(pa.array(keep)) for c in ("id", "label", "anchor")]
            vectors = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(whole))
            yield pa.RecordBatch.from_arrays([*kept, vectors, pa.array(norm), pa.array(size.astype(np.int32))], ["id", "label", "anchor", "vector", "norm", "dims"])

    return run


class Table:
    """What every task knows of the table: pivots (bounded by PIVOTS), dimensions and the greatest norm."""

    def __init__(self, sample: np.ndarray, dims: int, most: float, pivots: int):
        self.dims, self.most = dims, most
        self.kind = np.float64 if most < _EXACT else np.int64 if most < 2.0**55 else object
        points = self._points(sample)
        chosen = [int(np.argmax(((points - points.mean(0)) ** 2).sum(1)))]
        reach = ((points - points[chosen[0]]) ** 2).sum(1)
        while len(chosen) < min(pivots, len(points)) and reach.max() > 0:
            chosen.append(int(np.argmax(reach)))
            reach = np.minimum(reach, ((points - points[chosen[-1]]) ** 2).sum(1))
        self.pivots = points[chosen]

    def _points(self, vectors: np.ndarray) -> np.ndarray:
        return np.hstack([vectors, np.sqrt(np.maximum(0, self.most - (vectors**2).sum(1)))[:, None]])

    def stored(self, vectors: np.ndarray) -> np.ndarray:
        """Distances of rows to the pivots."""
        return np.sqrt(np.maximum(0, 2 * self.most - 2 * self._points(vectors) @ self.pivots.T)).astype(np.float32)

    def asked(self, vectors: np.ndarray) -> np.ndarray:
        """Distances of anchors to the pivots."""
        return np.sqrt(np.maximum(0, (vectors**2).sum(1)[:, None] + self.most - 2 * vectors @ self.pivots[:, :-1].T))

    def bracket(self, vectors: np.ndarray, asked: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest scores of anchors with rows, or groups of them, whose distances are from ``low`` to ``high``."""
        gap, reach = np.zeros((len(asked), len(low))), np.full((len(asked), len(low)), np.inf)
        for j in range(asked.shape[1]):
            q = asked[:, j, None]
            np.maximum(gap, np.maximum(low[None, :, j] - q, q - high[None, :, j]), out=gap)
            np.minimum(reach, q + high[None, :, j], out=reach)
        scale = ((vectors**2).sum(1) + self.most)[:, None]
        slack = _NEAR * scale + 1
        return (scale - reach**2) / 2 - slack, (scale - gap**2) / 2 + slack

    def scores(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Exact inner products of all rows of both (of ``kind``), in the longs' range."""
        found = x @ y.T
        return np.clip(found, -(2**63), 2**63 - 1).astype(np.int64)


def _shards(table: Table, n: int) -> Callable:
    """From rows of one shard, in order: their distances' ranges with its first row, and a threshold with each anchor: the nth best score around it."""
    dims = table.dims

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)  # one shard
        if not sum(b.num_rows for b in parts):
            return
        shard = pa.Table.from_batches(parts).combine_chunks()
        vectors, d = shard["vector"].chunk(0), _matrix(shard["d"].chunk(0), len(table.pivots), np.float32)
        ids, label = shard["id"].to_numpy(), shard["label"].to_numpy()
        seed: list[int | None] = [None] * len(ids)
        for i in np.flatnonzero(shard["anchor"].to_numpy()).tolist():
            a, b = max(0, i - AROUND), i + AROUND
            same = np.flatnonzero((label[a:b] == label[i]) & (ids[a:b] != ids[i])) + a
            if len(same) >= n:
                seed[i] = int(np.sort(table.scores(_matrix(vectors.slice(i, 1), dims, table.kind), _matrix(vectors.take(pa.array(same)), dims, table.kind))[0])[-n])
        edge = [pa.array([x, *[None] * (len(ids) - 1)], pa.list_(pa.float32())) for x in (d.min(0), d.max(0))]
        columns = [*(shard[c].chunk(0) for c in ("shard", "place", "id", "label", "anchor", "vector", "d")), pa.array(seed, pa.int64()), *edge]
        yield pa.RecordBatch.from_arrays(columns, ["shard", "place", "id", "label", "anchor", "vector", "d", "seed", "low", "high"])

    return run


def pivot_table(rows: DataFrame, anchor: Column, n: int, id_col: str, label_col: str, vector_col: str, scale: int, pivots: int) -> tuple[DataFrame, Table | None]:
    """The stored table, a row for each that takes part, and what tasks know of it (None for an empty table)."""
    spark = rows.sparkSession
    slim = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col(vector_col).alias("vector")).where("id is not null and label is not null and vector is not null")
    read = materialize(slim.mapInArrow(_read(scale), "id long, label long, anchor boolean, vector array<long>, norm double, dims int"), "vectors")
    count, dims, most = read.agg(F.count(F.lit(1)), F.max("dims"), F.max("norm")).first()
    if not count:
        return read, None
    dims = max(1, dims)
    taken = read.where(sampled(min(1.0, 2 * SAMPLE / count), "id", "pivots")).orderBy(F.xxhash64("id")).limit(SAMPLE).select("vector").toArrow()["vector"].combine_chunks()
    if not len(taken):
        taken = read.limit(1).select("vector").toArrow()["vector"].combine_chunks()
    chunk = taken.chunk(0) if isinstance(taken, pa.ChunkedArray) else taken
    table = Table(_matrix(chunk, dims), dims, most, pivots)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = table.stored(_matrix(batch["vector"], dims))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(d) + 1, dtype=np.int32) * d.shape[1]), pa.array(d.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("id", "label", "anchor", "vector")), lists, pa.array(d.argmin(1).astype(np.int32)), pa.array(d.min(1))], ["id", "label", "anchor", "vector", "d", "cell", "reach"])

    far = read.select("id", "label", "anchor", "vector").mapInArrow(measured, "id long, label long, anchor boolean, vector array<long>, d array<float>, cell int, reach float")
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // max(LEAF, SHARD // dims)))
    keyed = far.withColumn("nth", F.monotonically_increasing_id())  # parts equal vectors
    dealt = keyed.repartitionByRange(shards, "cell", "reach", "nth").sortWithinPartitions("cell", "reach", "nth")
    dealt = dealt.select(F.spark_partition_id().alias("shard"), F.monotonically_increasing_id().alias("place"), "id", "label", "anchor", "vector", "d")
    kinds = "shard int, place long, id long, label long, anchor boolean, vector array<long>, d array<float>, seed long, low array<float>, high array<float>"
    return materialize(dealt.mapInArrow(_shards(table, n), kinds), "pivot-table"), table


def _streams(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.Table, Iterator[pa.RecordBatch]]]:
    """For each run of equal ``key`` in a sorted partition: its rows of side 0 whole, then those of side 1 in batches."""
    rows = (batch.slice(a, n) for batch in batches for a, n in _runs(batch, key))
    ahead = next(rows, None)
    while ahead is not None:
        now, held = ahead[key][0].as_py(), []
        while ahead is not None and ahead[key][0].as_py() == now and ahead["side"][0].as_py() == 0:
            held.append(ahead)
            ahead = next(rows, None)

        def queries(now=now) -> Iterator[pa.RecordBatch]:
            nonlocal ahead
            while ahead is not None and ahead[key][0].as_py() == now:
                yield ahead
                ahead = next(rows, None)

        if held:
            yield pa.Table.from_batches(held).combine_chunks(), queries()
        for _ in queries():  # what was left
            pass


def _runs(batch: pa.RecordBatch, key: str) -> Iterator[tuple[int, int]]:
    k, side = batch[key].to_numpy(zero_copy_only=False), batch["side"].to_numpy()
    cuts = [0, *(np.flatnonzero((k[1:] != k[:-1]) | (side[1:] != side[:-1])) + 1).tolist(), len(k)] if len(k) else [0]
    yield from ((a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True))


_QUERY = ("anchor_key", "id", "label", "vector", "wants", "least", "most")


def _routed(table: Table) -> Callable:
    """Anchors with each shard of a block whose ranges let it hold scores from least to most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, queries in _streams(batches, "block"):
            low, high = (_matrix(block[c].chunk(0), len(table.pivots)) for c in ("low", "high"))
            shard = block["shard"].to_numpy()
            for batch in queries:
                vectors = _matrix(batch["vector"], table.dims)
                below, above = table.bracket(vectors, table.asked(vectors), low, high)
                open_ = (above >= batch["least"].to_numpy()[:, None]) & (below <= batch["most"].to_numpy()[:, None])
                row, to = np.nonzero(open_)
                for k in range(0, len(row), 20_000):
                    at = pa.array(row[k : k + 20_000])
                    yield pa.RecordBatch.from_arrays([pa.array(shard[to[k : k + 20_000]], pa.int32()), *(batch[c].take(at) for c in _QUERY)], ["shard", *_QUERY])

    return run


def _searched(table: Table, same: bool, n: int, share: tuple[int, int]) -> Callable:
    """The best n rows of a shard for each want of an anchor: of the same label, or of another with a score between the shares of the want."""
    low_share, high_share = share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, queries in _streams(batches, "shard"):
            base, d = _matrix(shard["vector"].chunk(0), table.dims, table.kind), _matrix(shard["d"].chunk(0), len(table.pivots), np.float32)
            ids, label = shard["id"].to_numpy(), shard["label"].to_numpy()
            starts = np.arange(0, len(ids), LEAF)
            low, high = np.minimum.reduceat(d, starts), np.maximum.reduceat(d, starts)
            for batch in queries:
                for k in range(0, batch.num_rows, ANCHORS):
                    yield from one(batch.slice(k, ANCHORS), base, d, ids, label, starts, low, high)

    def one(batch, base, d, ids, label, starts, low, high) -> Iterator[pa.RecordBatch]:
        exact = _matrix(batch["vector"], table.dims, table.kind)
        vectors, own, own_label = exact.astype(np.float64), batch["id"].to_numpy(), batch["label"].to_numpy()
        asked, least, most = table.asked(vectors), batch["least"].to_numpy().copy(), batch["most"].to_numpy()
        # one want for each result list: its number, its anchor's row, its score
        cuts = batch["wants"].offsets.to_numpy()
        row = np.repeat(np.arange(len(own)), np.diff(cuts))
        nth, want = np.arange(len(row)) - (cuts[:-1] - cuts[0])[row], batch["wants"].values.to_numpy()[cuts[0] : cuts[-1]]
        score, found = np.full((len(row), n), -(2**63)), np.full((len(row), n), -1)
        held = np.zeros(len(row), np.int64)
        below, above = table.bracket(vectors, asked, low, high)
        for leaf in np.argsort(-above.max(0), kind="stable").tolist():
            live = np.flatnonzero((above[:, leaf] >= least) & (below[:, leaf] <= most))
            if not len(live):
                continue
            at = np.arange(starts[leaf], min(starts[leaf] + LEAF, len(ids)))
            if 2 * len(live) <= len(own):  # brackets of rows cost more than products, so they follow only where leaves' brackets part anchors
                under, over = table.bracket(vectors[live], asked[live], d[at], d[at])
                at = at[((over >= least[live, None]) & (under <= most[live, None])).any(0)]
                if not len(at):
                    continue
            got = table.scores(exact[live], base[at])
            fits = (own_label[live, None] == label[at]) == same
            fits &= own[live, None] != ids[at]
            place = np.full(len(own), -1)
            place[live] = np.arange(len(live))
            lists = np.flatnonzero(place[row] >= 0)
            mine, ok = got[place[row[lists]]], fits[place[row[lists]]]
            if not same:
                w = want[lists, None]
                ok &= _within(mine, w, low_share, high_share)
            full = held[lists] == n
            ok &= ~full[:, None] | (mine > score[lists, -1:]) | ((mine == score[lists, -1:]) & (ids[at] < found[lists, -1:]))
            better = np.flatnonzero(ok.any(1))
            if not len(better):
                continue
            lists, ok, mine = lists[better], ok[better], mine[better]
            # what doesn't fit goes behind all that does
            none = np.arange(n) >= held[lists, None]
            out = np.hstack([none, ~ok])
            all_score, all_ids = np.hstack([score[lists], mine]), np.hstack([found[lists], np.broadcast_to(ids[at], mine.shape)])
            order = np.lexsort((all_ids, ~all_score, out), axis=-1)[:, :n]  # ~x falls as x rises, for every long
            score[lists], found[lists] = np.take_along_axis(all_score, order, 1), np.take_along_axis(all_ids, order, 1)
            held[lists] = np.minimum(n, held[lists] + ok.sum(1))
            if same:  # one list an anchor: its nth best score is its new threshold
                done = lists[held[lists] == n]
                least[row[done]] = np.maximum(least[row[done]], score[done, -1].astype(np.float64))
        i, j = np.nonzero(np.arange(n) < held[:, None])
        if len(i):
            at = pa.array(row[i])
            yield pa.RecordBatch.from_arrays([batch["anchor_key"].take(at), batch["id"].take(at), pa.array(nth[i].astype(np.int32)), pa.array(found[i, j]), pa.array(score[i, j])], ["anchor_key", "anchor_id", "nth", "found", "score"])

    return run


def _within(score: np.ndarray, want: np.ndarray, low: int, high: int) -> np.ndarray:
    """low * want <= 100 * score <= high * want without leaving the longs: by quotients and remainders of 100."""

    def split(x: np.ndarray, by: int) -> tuple[np.ndarray, np.ndarray]:
        q, r = x // 100, x % 100
        return q * by + r * by // 100, r * by % 100

    (a, a_rest), (b, _) = split(want, low), split(want, high)
    return (score >= a + (a_rest > 0)) & (score <= b)


def hard_negatives(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256, pivots: int = PIVOTS, id_col: str = "id", label_col: str = "label", vector_col: str = "vector") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. ``anchor``: which rows are anchors; components x count as
    floor(scale * x); ``low`` and ``high``: percent of the positive's score that a negative's lies between (at most 100)."""
    spark = rows.sparkSession
    stored, table = pivot_table(rows, anchor, positives, id_col, label_col, vector_col, scale, pivots)
    if table is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = stored.select("shard", F.lit(0).alias("side"), "place", "id", "label", "vector", "d")
    shards = stored.where("low is not null").select("shard", "low", "high")
    blocks = shards.agg(F.max("shard")).first()[0] // BLOCK + 1

    def sent(queries: DataFrame) -> DataFrame:
        """Anchors with the shards they go to: shards' ranges in blocks, each block once for each part of the anchors."""
        salt = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("salt")
        left = shards.select((F.col("shard") / BLOCK).cast("int").alias("block"), salt, F.lit(0).alias("side"), "shard", "low", "high")
        right = queries.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.pmod(F.xxhash64("anchor_key"), F.lit(parts)).cast("int").alias("salt"), F.lit(1).alias("side"), *_QUERY)
        both = left.unionByName(right, allowMissingColumns=True).withColumn("block", F.col("block") * parts + F.col("salt"))
        dealt = both.repartition(parts, "block").sortWithinPartitions("block", "side")
        return dealt.mapInArrow(_routed(table), "shard int, anchor_key long, id long, label long, vector array<long>, wants array<long>, least double, most double")

    def search(queries: DataFrame, same: bool, n: int) -> DataFrame:
        right = sent(queries).withColumn("side", F.lit(1))
        dealt = base.unionByName(right, allowMissingColumns=True).repartition(parts, "shard").sortWithinPartitions("shard", "side", "place")
        return dealt.mapInArrow(_searched(table, same, n, (low, high)), "anchor_key long, anchor_id long, nth int, found long, score long")

    anchors = stored.where("anchor").groupBy("id", "label", "vector").agg(F.max("seed").cast("double").alias("least"))
    anchors = materialize(anchors.withColumn("anchor_key", F.monotonically_increasing_id()), "anchors")
    first = anchors.select("anchor_key", "id", "label", "vector", F.array(F.lit(0).cast("long")).alias("wants"), F.coalesce("least", F.lit(float("-inf"))).alias("least"), F.lit(float("inf")).alias("most"))
    best = Window.partitionBy("anchor_key").orderBy(F.desc("score"), "found")
    own = search(first, True, positives).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= positives)
    own = materialize(own.select("anchor_key", "anchor_id", "rank", "found", "score"), "positives")

    # a score below 0 has nothing between its shares
    lists = own.where("score >= 0").groupBy("anchor_key").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("wanted"))  # at most ``positives`` of an anchor
    wants = F.col("wanted.score")
    second = anchors.join(lists, "anchor_key").select("anchor_key", "id", "label", "vector", wants.alias("wants"), (F.array_min(wants) * (low / 100) - 1).alias("least"), (F.array_max(wants) * (high / 100) + 1).alias("most"))
    each = Window.partitionBy("anchor_key", "nth").orderBy(F.desc("score"), "found")
    other = search(second, False, negatives).withColumn("rank", F.row_number().over(each)).where(F.col("rank") <= negatives)
    joined = other.select("anchor_key", (F.col("nth") + 1).alias("place"), "rank", F.col("found").alias("negative_id"), F.col("score").alias("negative_score")).join(own.select("anchor_key", F.col("rank").alias("place"), "anchor_id", F.col("found").alias("positive_id"), F.col("score").alias("positive_score")), ["anchor_key", "place"])
    return joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", label.alias("label"), "embedding"), F.col("vec_id") % 100 == 0, id_col="vec_id", vector_col="embedding")


OP12_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
c AS (SELECT vec_id, label, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM v),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, sum(a.x * b.x)::BIGINT AS score
    FROM c a JOIN c b ON a.i = b.i WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id GROUP BY ALL),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other)::INT AS rank,
    s.other AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY rank <= 5
"""
