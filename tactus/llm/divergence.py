"""Source divergence audit: how far each source's words are from those of the other sources, and of all texts, of its language.

Terms are runs of ASCII letters and characters beyond ASCII, ASCII letters in lower case. A language keeps the V terms that at least ``MIN_DOCS`` of its
rows hold. A group (language, source), and a language as a whole, gives a kept term the scaled integer probability
p = 1 + floor(10^9 (count + 1) / (N + V)), N the counts' sum over kept terms; p against q diverges by f = floor((p - q)^2 / q).

*Counts* are made a batch of texts at a time, so that a (group, term) pair is shuffled once a batch and not once a word; they are dealt by language
and term, so neither a large group nor a large language meets in one task.

*Terms of a group* (part ``term``) are searched by bounds. All terms of a count in a group share p, and f falls with q below p, so a bucket (group, count)
is bounded by the least probability that its language gives one of its terms; the greatest one tells whether all of them qualify. Buckets are taken
best bound first until ``top`` qualifying terms are sure; the kth value of those stops the search: buckets whose bounds are strictly below it are never
evaluated, the others are.

*Pairs of sources* (part ``pair``) sum f over all kept terms. Postings (a term's sources) give the terms that both sources hold; terms of one side alone
are summed by its buckets against the probability of no occurrence, and terms of neither are a product:
sum f = sum over shared terms of [f(pa, pb) - f(pa, b0) - f(a0, pb) + f(a0, b0)] + sum over a's terms of f(pa, b0) + sum over b's of f(a0, pb) + (V - Da - Db) f(a0, b0).

Null texts, languages and sources count as empty strings; rows without terms still make their group occur. A language without kept terms has pair values of 0
and no terms. Equal values are ranked by the item's UTF-8 bytes. Repeated rows are rows of their own. An empty table gives no rows. Other columns aren't read.
All arithmetic is on longs, exact for up to 9 * 10^15 words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tactus.llm.common import is_small, materialize
from tactus.llm.tokens import slices

MIN_DOCS, TOP = 3, 200
#: Group tables of up to so many rows (some tens of bytes each) are broadcast, larger ones joined by shuffles.
SMALL = 200_000
_BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Numbers of pairs that a task works on at a time, or holds before it sends them.
_CELLS = 2_000_000


def chance(count: Column, total: Column) -> Column:
    """1 + floor(10^9 (count + 1) / total) for count < total, by long division in steps of three digits, so that no product leaves the longs."""
    rest, out = count + 1, F.lit(0).cast("long")
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + F.call_function("div", rest, total)
        rest = rest % total
    return 1 + out


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, term, n (occurrences), docs (rows that hold it) of each part of a batch."""
    for batch in batches:
        for part in slices(batch, 1 << 20, 32 << 20):
            cut = pc.split_pattern(pc.ascii_lower(pc.replace_substring_regex(part["text"].cast(pa.string()), _BETWEEN, " ")), " ")
            doc = np.repeat(np.arange(part.num_rows), np.diff(cut.offsets.to_numpy()))
            words = cut.flatten().dictionary_encode()
            full = pc.not_equal(words.dictionary, "").to_numpy(zero_copy_only=False)
            code = words.indices.to_numpy()
            real = full[code]
            width = max(1, len(words.dictionary))
            key, n = np.unique(doc[real] * width + code[real], return_counts=True)
            lang, source = part["lang"].dictionary_encode(), part["source"].dictionary_encode()
            both = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
            held = both[key // width] * width + key % width
            order = np.argsort(held, kind="stable")
            held, n = held[order], n[order]
            at = np.flatnonzero(np.append(True, held[1:] != held[:-1])) if len(held) else np.zeros(0, np.int64)
            group, term = held[at] // width, held[at] % width
            sums = np.add.reduceat(n, at) if len(at) else np.zeros(0, np.int64)
            columns = [lang.dictionary.take(pa.array(group // max(1, len(source.dictionary)))), source.dictionary.take(pa.array(group % max(1, len(source.dictionary)))), words.dictionary.take(pa.array(term)), pa.array(sums.astype(np.int64)), pa.array(np.diff(np.append(at, len(held))).astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, source, term, n, total (in the language), lead (true once a term of a language) of the kept terms. ``docs``: text, lang, source."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = docs.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    # one shuffle: both groupings that follow are within (lang, term)
    each = counted.repartition(parts, "lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    own = Window.partitionBy("lang", "term")
    whole = each.withColumns({"total": F.sum("n").over(own), "in_docs": F.sum("docs").over(own), "lead": F.row_number().over(own.orderBy("source")) == 1})
    return whole.where(F.col("in_docs") >= min_docs).select("lang", "source", "term", "n", "total", "lead")


def _groups(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """lang, source, all (N + V of the language), own (of the group), zero (the group's p of no occurrence), held (its terms), v, of every group."""
    langs = terms.groupBy("lang").agg(F.sum("n").alias("n_lang"), F.count_if("lead").alias("v"))
    sums = terms.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("held"))
    found = docs.select("lang", "source").distinct().join(langs, "lang", "left").join(sums, ["lang", "source"], "left").fillna(0)
    found = found.select("lang", "source", (F.col("n_lang") + F.col("v")).alias("all"), (F.col("n") + F.col("v")).alias("own"), "held", "v")
    return found.withColumn("zero", F.when(F.col("v") > 0, chance(F.lit(0).cast("long"), F.col("own"))).otherwise(F.lit(1)))


def _bounded(small: DataFrame) -> DataFrame:
    return F.broadcast(small) if is_small(small, SMALL) else small


def _buckets(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, n, size, p, and the extreme q of the bucket's terms."""
    found = terms.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("size"), F.min("total").alias("low"), F.max("total").alias("high")).join(_bounded(groups), ["lang", "source"])
    return found.select("lang", "source", "n", "size", chance(F.col("n"), F.col("own")).alias("p"), chance(F.col("low"), F.col("all")).alias("q_low"), chance(F.col("high"), F.col("all")).alias("q_high"))


def top_terms(terms: DataFrame, groups: DataFrame, buckets: DataFrame, top: int = TOP) -> DataFrame:
    """lang, source, term, value, rank: each group's ``top`` terms of the greatest divergence."""
    group = Window.partitionBy("lang", "source")
    best_first = group.orderBy(F.desc("bound"), F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    sure = F.when(F.col("p") > F.col("q_high"), F.col("size")).otherwise(F.lit(0))
    bounded = buckets.where("p > q_low").withColumn("bound", distance(F.col("p"), F.col("q_low")))
    ordered = materialize(bounded.select("lang", "source", "n", "p", "bound", (F.coalesce(F.sum(sure).over(best_first), F.lit(0)) < top).alias("first")), "bounds")

    def evaluated(wave: DataFrame) -> DataFrame:
        rows = terms.join(_bounded(wave.select("lang", "source", "n", "p")), ["lang", "source", "n"]).join(_bounded(groups.select("lang", "source", "all")), ["lang", "source"])
        rows = rows.withColumn("q", chance(F.col("total"), F.col("all"))).where("p > q")
        rows = rows.select("lang", "source", "term", distance(F.col("p"), F.col("q")).alias("value"))
        return rows.withColumn("rank", F.row_number().over(group.orderBy(F.desc("value"), "term"))).where(F.col("rank") <= top)

    seen = materialize(evaluated(ordered.where("first")), "best")
    kth = seen.where(F.col("rank") == top).select("lang", "source", F.col("value").alias("kth"))
    rest = ordered.where("not first").join(_bounded(kth), ["lang", "source"], "left").where("kth is null or bound >= kth")
    both = seen.drop("rank").unionByName(evaluated(rest).drop("rank"))
    return both.withColumn("rank", F.row_number().over(group.orderBy(F.desc("value"), "term"))).where(F.col("rank") <= top)


class _Shared:
    """Sums of the shared terms' part for the pairs of a language's sources."""

    def __init__(self):
        self.place: dict[tuple[str, str], int] = {}
        self.keys: list[np.ndarray] = []
        self.sums: list[np.ndarray] = []
        self.held = 0

    def add(self, source: np.ndarray, p: np.ndarray, zero: np.ndarray) -> None:
        """Terms (rows) with the numbers of their sources (columns, as many for each), and those's probabilities. ``source``: numbers under 2^31."""
        n, m = source.shape
        rows = max(1, _CELLS // (m * m))
        wide = max(1, _CELLS // m)  # a term of very many sources, in strips
        f = lambda x, y: (x - y) * (x - y) // y
        for k in range(0, n, rows):
            s, b, b0 = source[k : k + rows, None, :], p[k : k + rows, None, :], zero[k : k + rows, None, :]
            for i in range(0, m, wide):
                t, a, a0 = (x[k : k + rows, i : i + wide, None] for x in (source, p, zero))
                value = f(a, b) - f(a, b0) - f(a0, b) + f(a0, b0)
                self._fold((t << 31 | s).ravel(), value.ravel())

    def _fold(self, key: np.ndarray, value: np.ndarray) -> None:
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
        at = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        self.keys.append(key[at])
        self.sums.append(np.add.reduceat(value, at))
        self.held += len(at)

    def shrink(self) -> None:
        if len(self.keys) > 1:
            key, value = np.concatenate(self.keys), np.concatenate(self.sums)
            self.keys, self.sums, self.held = [], [], 0
            self._fold(key, value)

    def rows(self) -> Iterator[pa.RecordBatch]:
        self.shrink()
        names = list(self.place)
        lang, source = (pa.array([x[k] for x in names], pa.string()) for k in (0, 1))
        for key, value in zip(self.keys, self.sums, strict=True):
            a, b = key >> 31, key & (1 << 31) - 1
            a, b, value = a[a != b], b[a != b], value[a != b]
            for k in range(0, len(a), 100_000):
                x, y = pa.array(a[k : k + 100_000]), pa.array(b[k : k + 100_000])
                yield pa.RecordBatch.from_arrays([lang.take(x), source.take(x), source.take(y), pa.array(value[k : k + 100_000])], ["lang", "source", "item", "shared"])
        self.keys, self.sums, self.held, self.place = [], [], 0, {}


def _shared_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows lang, term, source, p, zero sorted by language and term."""
    held, left = _Shared(), None

    def whole_terms(table: pa.Table) -> None:
        lang, term, source = (table[c].combine_chunks().dictionary_encode() for c in ("lang", "term", "source"))
        li, si = lang.indices.to_numpy().astype(np.int64), source.indices.to_numpy().astype(np.int64)
        group = li * len(source.dictionary) + si
        ids, place = np.unique(group, return_inverse=True)
        langs, sources = lang.dictionary.to_pylist(), source.dictionary.to_pylist()
        number = np.array([held.place.setdefault((langs[g // len(sources)], sources[g % len(sources)]), len(held.place)) for g in ids.tolist()], np.int64)[place]
        key = li * len(term.dictionary) + term.indices.to_numpy()
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(starts, len(key)))
        p, zero = table["p"].to_numpy(), table["zero"].to_numpy()
        for m in np.unique(size[size > 1]).tolist():
            at = starts[size == m][:, None] + np.arange(m)
            held.add(number[at], p[at], zero[at])

    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([left, table]) if left is not None else table
        if not table.num_rows:
            continue
        last = {c: table[c][-1] for c in ("lang", "term")}
        same = pc.and_(pc.equal(table["lang"], last["lang"]), pc.equal(table["term"], last["term"]))
        n = table.num_rows - pc.sum(same).as_py()  # the last term may go on in the next batch
        if n:
            whole_terms(table.slice(0, n))
        left = table.slice(n)
        if held.held > _CELLS:
            held.shrink()
            if held.held > _CELLS // 2:
                yield from held.rows()
    if left is not None and left.num_rows:
        whole_terms(left)
    yield from held.rows()


def source_pairs(terms: DataFrame, groups: DataFrame, buckets: DataFrame) -> DataFrame:
    """lang, source, item, value for all ordered pairs of sources of a language."""
    parts = int(terms.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    postings = terms.select("lang", "term", "source", "n").join(_bounded(groups.select("lang", "source", "own", "zero")), ["lang", "source"])
    postings = postings.select("lang", "term", "source", chance(F.col("n"), F.col("own")).alias("p"), "zero")
    dealt = postings.repartition(parts, "lang", "term").sortWithinPartitions("lang", "term")
    shared = dealt.mapInArrow(_shared_sums, "lang string, source string, item string, shared long").groupBy("lang", "source", "item").agg(F.sum("shared").alias("shared"))
    # a group has as many buckets as its terms have different counts: about the root of its words
    listed = groups.join(buckets.groupBy("lang", "source").agg(F.collect_list(F.struct("p", "size")).alias("levels")), ["lang", "source"], "left")
    listed = listed.withColumn("levels", F.coalesce("levels", F.array().cast("array<struct<p:bigint,size:bigint>>")))
    a, b = (listed.select("lang", "v", *(F.col(c).alias(f"{c}_{k}") for c in ("source", "levels", "held", "zero"))) for k in "ab")
    pairs = a.join(b.drop("v"), "lang").where("source_a <> source_b")
    start = F.lit(0).cast("long")
    of_a = F.aggregate("levels_a", start, lambda acc, x: acc + x["size"] * distance(x["p"], F.col("zero_b")))
    of_b = F.aggregate("levels_b", start, lambda acc, x: acc + x["size"] * distance(F.col("zero_a"), x["p"]))
    rest = (F.col("v") - F.col("held_a") - F.col("held_b")) * distance(F.col("zero_a"), F.col("zero_b"))
    alone = pairs.select("lang", F.col("source_a").alias("source"), F.col("source_b").alias("item"), (of_a + of_b + rest).alias("alone"))
    return alone.join(shared, ["lang", "source", "item"], "left").select("lang", "source", "item", (F.col("alone") + F.coalesce("shared", start)).alias("value"))


def divergence_audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: see the module."""
    named = ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))
    slim = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in named))
    terms = materialize(term_counts(slim, min_docs), "terms")
    groups = materialize(_groups(slim, terms), "groups")
    buckets = materialize(_buckets(terms, groups), "count-buckets")
    group = Window.partitionBy("lang", "source")
    pairs = source_pairs(terms, groups, buckets).withColumn("rank", F.row_number().over(group.orderBy(F.desc("value"), "item")))
    found = top_terms(terms, groups, buckets, top).withColumnRenamed("term", "item")
    columns = lambda rows, part: rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank"))
    return columns(pairs, "pair").unionByName(columns(found, "term"))


def op13_source_divergence(spark, sf_dir: str) -> DataFrame:
    return divergence_audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
w AS (SELECT r, lang, source, unnest(words) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL),
langs AS (SELECT lang, sum(total) AS n_lang, count(*) AS v FROM kept GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
sums AS (SELECT lang, source, sum(n) AS n FROM c JOIN kept USING (lang, term) GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
        1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(s.n, 0) + l.v)::HUGEINT AS p,
        1 + (1000000000::HUGEINT * (k.total + 1)) // (l.n_lang + l.v)::HUGEINT AS q
    FROM g JOIN kept k ON k.lang = g.lang JOIN langs l ON l.lang = g.lang
    LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every_pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0)::BIGINT AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM (FROM every_pair UNION ALL FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
