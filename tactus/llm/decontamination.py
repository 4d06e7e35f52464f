"""Benchmark decontamination by canonical templates, in DataFrame operations only.

A text becomes a sequence of tokens: words, and numbers with the unit or currency sign beside them. Its template has ``<num>`` for a
number, ``<qty>`` for a number with a unit, ``<name>`` for a capitalised word inside a sentence, and lower-case words. Windows of
``WINDOW`` template tokens are hash-joined with the benchmark's. A match counts if at least ``LITERALS`` of its tokens are words,
and if the slots agree: equal values stand for equal values, both ways, over all matched windows of a document that
lie on one alignment with the item. A sentence's first word may be a name: windows that match but for such words count too, with these words as
slots, if they agree with the alignment's other windows. A document is contaminated by an item if such windows cover at least ``SHARE`` of the
item's windows with enough words (``n_windows`` is the number of all), so that a question with other numbers and names is caught as well as a verbatim copy.
An item of fewer than ``WINDOW`` tokens is one window of its own length. An item of which no window has enough words is found word for word: anywhere in a document, or,
if it has fewer than ``LITERALS`` tokens, as the whole of one; all of its windows count as matched then.

One scan makes the hashes of all windows, and only those that the benchmark has are kept; the documents of these are read once more for
their tokens, which settle whether templates are equal and slots agree. The benchmark's hashes, and the ids of the documents that have some, are
broadcast up to ``BROADCAST`` rows of two numbers each, and shuffled otherwise. Null texts match nothing, equal items each match. Rows of one id are
told apart by their texts; equal rows count as one document. Items with a null id are left out.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tactus.llm.common import is_small, materialize

WINDOW, LITERALS, SHARE, BROADCAST = 8, 5, 0.5, 200_000
#: Units that belong to the number before them.
UNITS = ("km", "cm", "mm", "m", "kg", "mg", "g", "lb", "oz", "l", "ml", "h", "hours", "hour", "min", "minutes", "s", "seconds", "days", "weeks", "months", "years", "miles", "feet", "meters", "metres", "dollars", "euros", "cents", "percent", "degrees")
#: A number with its signs and unit, or a word with the sentence end before it.
TOKEN = r"(?:[$€£] ?)?[0-9]+(?:[.,][0-9]+)*(?: ?(?:%|°|(?:" + "|".join(UNITS) + r")\b))?|(?:[.!?:\n]\s*)?\p{L}[\p{L}\p{M}]*"
_ENDS = ".!?: \n\r\t"
#: Before a sentence's first word in a template.
_FIRST = "\x02"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.concat(F.lit("\n"), text), F.lit(TOKEN), F.lit(0))


def canonical(x: Column) -> Column:
    """A token's place in the template, with ``_FIRST`` before a sentence's first word. Plain words, by far the most tokens, are settled by the first test."""
    c = F.substring(x, 1, 1)
    numeric = ((c >= "0") & (c <= "9")) | c.isin("$", "€", "£")
    bare = F.translate(x, "0123456789.,", "") == ""
    word = F.when((c >= "a") & (c <= "z"), F.lower(x))
    return word.when(numeric, F.when(bare, "<num>").otherwise("<qty>")).when(initial(x), F.concat(F.lit(_FIRST), value(x))).when(F.lower(c) != c, "<name>").otherwise(F.lower(x))


def initial(x: Column) -> Column:
    """Whether a token is a sentence's first word, which may be a name."""
    return F.substring(x, 1, 1).isin(".", "!", "?", ":", "\n")


def value(x: Column) -> Column:
    """A token without the sentence end before it."""
    return F.lower(F.ltrim(x, F.lit(_ENDS)))


def _widened(rows: DataFrame, column: str, widths: tuple[int, ...]) -> DataFrame:
    """Adds ``column``_w for each width w, the hashes of windows of w places from an array of hashes: of two, of four and so on, two windows of the last power of
    two at the end. The last places, where no whole window begins, are to be left out."""
    made, step = {1: column}, 1
    joined = lambda a, b, k: F.zip_with(a, F.slice(b, k + 1, F.greatest(F.size(b), F.lit(1))), lambda x, y: F.xxhash64(x, y))
    while 2 * step <= max(widths):
        rows, made[2 * step] = rows.withColumn(f"{column}_p{2 * step}", joined(made[step], made[step], step)), f"{column}_p{2 * step}"
        step *= 2
    for w in widths:
        power = 1 << w.bit_length() - 1
        rows = rows.withColumn(f"{column}_{w}", F.col(made[power]) if power == w else joined(made[power], made[power], w - power))
    return rows


def _keys(rows: DataFrame, widths: tuple[int, ...]) -> DataFrame:
    """The columns of ``rows`` but text; w, pos, h, loose of each window of each width: the hash of its template. A window with sentences' first words has a loose row too, in
    which these are ``<first>``. A text's tokens are made once for all widths."""
    names = [c for c in rows.columns if c != "text"]
    rows = rows.withColumn("marked", F.transform(tokens(F.col("text")), canonical))
    rows = rows.select(*names, F.size("marked").alias("n"), F.transform("marked", lambda x: F.xxhash64(F.ltrim(x, F.lit(_FIRST)))).alias("strict"), F.transform("marked", lambda x: F.when(x.startswith(_FIRST), F.lit(0).cast("long")).otherwise(F.xxhash64(x))).alias("masked"))
    rows = _widened(_widened(rows.where(F.col("n") >= min(widths)), "strict", widths), "masked", widths)
    whole = lambda c, w: F.slice(f"{c}_{w}", F.lit(1), F.greatest(F.col("n") - (w - 1), F.lit(0))).alias(c)
    zipped = {w: F.arrays_zip(whole("strict", w), whole("masked", w)) for w in widths}
    if len(widths) == 1:
        each = rows.select(*names, F.lit(widths[0]).alias("w"), F.posexplode(zipped[widths[0]]).alias("pos", "span"))
    else:
        placed = [F.transform(z, partial(_placed, w)) for w, z in zipped.items()]
        each = rows.select(*names, F.inline(F.concat(*placed)))
    key = lambda c, loose: F.struct(F.col(f"span.{c}").alias("h"), F.lit(loose).alias("loose"))
    keys = F.when(F.col("span.strict") != F.col("span.masked"), F.array(key("strict", False), key("masked", True))).otherwise(F.array(key("strict", False)))
    return each.select(*names, "w", "pos", F.inline(keys))


def _placed(width: int, span: Column, pos: Column) -> Column:
    return F.struct(F.lit(width).alias("w"), pos.alias("pos"), span.alias("span"))


def _slices(rows: DataFrame, window: int) -> DataFrame:
    """The columns of ``rows`` but text; n (the number of tokens), and pos and raw of each window: of few texts."""
    names = [c for c in rows.columns if c != "text"]
    rows = rows.select(*names, tokens(F.col("text")).alias("raw")).withColumn("n", F.size("raw"))
    # the transform of one element makes a text's tokens once
    spans = F.get(F.transform(F.array("raw"), lambda r: F.transform(F.sequence(F.lit(0), F.size(r) - window), lambda i: F.slice(r, i + 1, window))), F.lit(0))
    return rows.where(F.col("n") >= window).select(*names, "n", F.posexplode(spans).alias("pos", "raw"))


def _items(known: DataFrame, window: int, literals: int) -> DataFrame:
    """item_id, item_key, w, n_windows, n_usable, item_pos, h, loose, item_raw, item_template of the items' windows with enough words."""
    spans = _slices(known, window).select("item_id", "item_key", (F.col("n") - (window - 1)).cast("long").alias("n_windows"), F.col("pos").alias("item_pos"), F.col("raw").alias("item_raw"))
    keys = _keys(known, (window,)).withColumnRenamed("pos", "item_pos")
    spans = spans.join(keys, ["item_id", "item_key", "item_pos"])
    spans = spans.withColumn("item_template", F.transform("item_raw", lambda x: F.when(F.col("loose") & initial(x), "<first>").otherwise(F.translate(canonical(x), _FIRST, ""))))
    spans = spans.where(F.size(F.filter("item_template", lambda x: ~x.startswith("<"))) >= literals)
    # of an item's windows only those with so many words can match
    return spans.withColumn("n_usable", F.count(F.when(~F.col("loose"), 1)).over(Window.partitionBy("item_id", "item_key")))


def _small(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if is_small(rows, BROADCAST) else rows


def _found(texts: DataFrame, spans: DataFrame, widths: tuple[int, ...], share: float) -> DataFrame:
    """``contamination`` by the windows of ``_items``, of all widths at once."""
    hits = materialize(_keys(texts, widths).join(_small(spans.select("w", "h", "loose").distinct()), ["w", "h", "loose"]), "hits")
    own = hits.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("pos", "w", "h", "loose")).alias("own"))
    ids = hits.select(F.col("doc_id").alias("id"), F.col("text_key").alias("key")).distinct()
    rows = texts.join(_small(ids), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key")), "left_semi")
    rows = rows.groupBy(F.col("doc_id").alias("id"), F.col("text_key").alias("key")).agg(F.min("text").alias("text"))
    rows = rows.join(own, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key")))
    cut = F.get(F.transform(F.array(tokens(F.col("text"))), lambda r: F.transform("own", lambda x: F.struct(x["pos"].alias("pos"), x["w"].alias("w"), x["h"].alias("h"), x["loose"].alias("loose"), F.slice(r, x["pos"] + 1, x["w"]).alias("doc_raw")))), F.lit(0))
    hits = rows.select("doc_id", "text_key", F.inline(cut)).join(spans, ["w", "h", "loose"])
    hits = hits.select("doc_id", "text_key", "item_id", "item_key", "n_windows", "n_usable", "loose", "item_pos", (F.col("pos") - F.col("item_pos")).alias("shift"), "item_raw", "item_template", "doc_raw")
    same = F.zip_with("doc_raw", "item_template", lambda x, t: F.when(t == "<first>", initial(x)).otherwise(F.translate(canonical(x), _FIRST, "") == t))
    # a loose match with the same first words is a strict one too
    other = F.zip_with(F.zip_with("item_raw", "item_template", lambda x, t: F.when(t == "<first>", value(x))), "doc_raw", lambda a, b: a != value(b))
    hits = hits.where(F.forall(same, lambda x: x) & (~F.col("loose") | F.exists(other, lambda x: F.coalesce(x, F.lit(False)))))
    slots = F.filter(F.zip_with(F.zip_with("item_raw", "doc_raw", lambda a, b: F.struct(value(a).alias("item"), value(b).alias("doc"))), "item_template", lambda p, t: F.when(t.startswith("<"), p)), lambda p: p.isNotNull())
    # a line of strict matches stands by itself; with the loose ones it stands if those agree as well
    hits = hits.withColumn("pairs", slots).withColumn("with_loose", F.explode(F.when(F.col("loose"), F.array(F.lit(True))).otherwise(F.array(F.lit(False), F.lit(True)))))
    # one alignment of a document with an item has at most the item's windows
    keys = ["doc_id", "text_key", "item_id", "item_key", "n_windows", "n_usable"]
    lines = hits.groupBy(*keys, "shift", "with_loose").agg(F.collect_set("item_pos").alias("found"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"))
    ways = lambda k: F.size(F.array_distinct(F.transform("pairs", lambda p: p[k])))
    agreed = lines.where((F.size("pairs") == ways("item")) & (F.size("pairs") == ways("doc")))
    found = agreed.groupBy(*keys).agg(F.size(F.array_distinct(F.flatten(F.collect_set("found")))).cast("long").alias("n_matched"))
    return found.where(F.col("n_matched") >= share * F.col("n_usable")).select("doc_id", "text_key", "item_id", "n_matched", "n_windows")


def _verbatim(texts: DataFrame, bare: DataFrame, window: int, literals: int) -> DataFrame:
    """``contamination`` by items without a usable window, word for word: one of ``literals`` tokens or more anywhere in a document, a shorter one as all of it.
    Documents and items meet by the hash of as many values as the shorter of window and item has, a shorter item by that of all, and then are compared whole."""
    values = lambda c: F.transform(tokens(c), value)
    items = bare.select("item_id", values(F.col("text")).alias("item")).withColumn("size", F.size("item")).where("size > 0")
    items = items.withColumn("w", F.when(F.col("size") >= literals, F.least("size", F.lit(window))).otherwise(0))
    items = materialize(items.withColumn("h", F.when(F.col("w") > 0, F.hash(F.slice("item", F.lit(1), F.greatest("w", F.lit(1))))).otherwise(F.hash("item"))), "bare-items")
    widths = [r["w"] for r in items.where("w > 0").select("w").distinct().orderBy("w").collect()]  # at most window - literals + 1 numbers
    rows = texts.select("doc_id", "text_key", values(F.col("text")).alias("doc"))
    spans = lambda w: F.transform(F.filter(F.sequence(F.lit(1), F.greatest(F.size("doc"), F.lit(1))), lambda i: i + (w - 1) <= F.size("doc")), lambda i: F.struct(F.lit(w).alias("w"), i.alias("pos"), F.hash(F.slice("doc", i, w)).alias("h")))
    each = F.concat(F.array(F.struct(F.lit(0).alias("w"), F.lit(1).alias("pos"), F.hash("doc").alias("h"))), *(spans(w) for w in widths))
    keyed = rows.select("doc_id", "text_key", "doc", F.inline(F.filter(each, lambda x: x["h"].isNotNull())))
    met = keyed.join(F.broadcast(items) if is_small(items, BROADCAST) else items, ["w", "h"])
    same = F.when(F.col("w") == 0, F.col("doc") == F.col("item")).otherwise(F.slice("doc", F.col("pos"), F.col("size")) == F.col("item"))
    n = F.greatest(F.col("size") - (window - 1), F.lit(1)).cast("long")
    return met.where(same).select("doc_id", "text_key", "item_id", n.alias("n_matched"), n.alias("n_windows")).distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, literals: int = LITERALS, share: float = SHARE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key, item_id, n_matched, n_windows of each document and item that share enough windows."""
    known = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select("item_id", F.xxhash64("text").alias("item_key"), "text").distinct()
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    sized = materialize(known.withColumn("size", F.least(F.size(tokens(F.col("text"))), F.lit(window))), "items")
    widths = tuple(r["size"] for r in sized.where(F.col("size") >= literals).select("size").distinct().orderBy("size").collect()) or (window,)  # at most window - literals + 1 numbers
    spans = materialize(reduce(DataFrame.unionByName, [_items(sized.where(F.col("size") == k).drop("size"), k, literals) for k in widths]), "templates")
    found = _found(texts, spans, widths, share)
    bare = sized.join(spans.select("item_id", "item_key").distinct(), ["item_id", "item_key"], "left_anti")
    return found if bare.isEmpty() else found.unionByName(_verbatim(texts, bare, window, literals))


def op7_decontamination(spark, sf_dir: str) -> DataFrame:
    found = contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "item_id", "n_matched", "n_windows")


_SQL_TOKEN = TOKEN.replace("'", "''")
OP7_SQL = f"""
with tokens as (
  select 'd' as side, doc_id as id, regexp_extract_all(chr(10) || text, '{_SQL_TOKEN}') as raw from documents where text is not null
  union all
  select 'b', item_id, regexp_extract_all(chr(10) || text, '{_SQL_TOKEN}') from benchmark where text is not null and item_id is not null
), templates as (
  select side, id, raw, list_transform(raw, lambda x: lower(regexp_replace(x, '^[.!?: \\n\\r\\t]+', ''))) as v,
    list_transform(raw, lambda x: regexp_matches(x, '^[.!?:\\n]')) as f, list_transform(raw, lambda x: case
      when regexp_matches(x, '^[0-9$€£]') then case when regexp_matches(x, '^[0-9.,]+$') then '<num>' else '<qty>' end
      when regexp_matches(x, '^[.!?:\\n]') then lower(regexp_replace(x, '^[.!?: \\n\\r\\t]+', ''))
      when lower(x[1]) <> x[1] then '<name>' else lower(x) end) as t
  from tokens
), sizes as (
  select distinct least(len(t), {WINDOW}) as w from templates where side = 'b' and len(t) >= {LITERALS}
), strict as (
  select side, id, w, p, v[p:p + w - 1] as v, f[p:p + w - 1] as f, t[p:p + w - 1] as t, n from (
    select side, id, v, f, t, w, len(t) - w + 1 as n, unnest(range(1, len(t) - w + 2)) as p
    from templates join sizes on len(t) >= w and (side = 'd' or w = least(len(t), {WINDOW})))
), spans as (
  select side, id, w, p, v, t, n, false as loose from strict
  union all
  select side, id, w, p, v, list_transform(list_zip(t, f), lambda x: case when x[2] then '<first>' else x[1] end), n, true from strict where list_contains(f, true)
), items as (
  select *, count(*) filter (where not loose) over (partition by id) as usable from spans
  where side = 'b' and len(list_filter(t, lambda x: not starts_with(x, '<'))) >= {LITERALS}
), hits as (
  select d.id as doc_id, b.id as item_id, b.n as n_windows, b.usable, b.p as item_pos, d.p - b.p as shift, b.v as bv, d.v as dv, b.t as t, b.w, b.loose
  from spans d join items b on d.t = b.t and d.w = b.w and d.loose = b.loose
  where d.side = 'd' and (not b.loose or len(list_filter(range(1, b.w + 1), lambda k: b.t[k] = '<first>' and b.v[k] <> d.v[k])) > 0)
), lines as (
  select *, true as with_loose from hits union all select *, false from hits where not loose
), slots as (
  select distinct doc_id, item_id, shift, with_loose, bv[k] as a, dv[k] as b
  from (select *, unnest(range(1, w + 1)) as k from lines) where starts_with(t[k], '<')
), broken as (
  select doc_id, item_id, shift, with_loose from slots group by 1, 2, 3, 4, a having count(distinct b) > 1
  union
  select doc_id, item_id, shift, with_loose from slots group by 1, 2, 3, 4, b having count(distinct a) > 1
)
select doc_id, item_id, count(distinct item_pos) as n_matched, n_windows
from lines h where not exists (select 1 from broken x where x.doc_id = h.doc_id and x.item_id = h.item_id and x.shift = h.shift and x.with_loose = h.with_loose)
group by doc_id, item_id, n_windows, usable having count(distinct item_pos) >= {SHARE} * usable
union
select d.id, b.id, greatest(len(b.v) - {WINDOW - 1}, 1), greatest(len(b.v) - {WINDOW - 1}, 1)
from templates d join (select * from templates where side = 'b' and len(v) > 0 and id not in (select id from items)) b
  on d.side = 'd' and case when len(b.v) < {LITERALS} then d.v = b.v
    else len(list_filter(range(1, len(d.v) - len(b.v) + 2), lambda p: d.v[p:p + len(b.v) - 1] = b.v)) > 0 end
"""


def stage_decontamination(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that no benchmark item contaminates, with their columns."""
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id", "text_key").distinct()
    found = _small(materialize(found, "contaminated")).alias("found")
    return docs.alias("docs").join(found, F.col("docs.doc_id").cast("long").eqNullSafe(F.col("found.doc_id")) & (F.xxhash64("docs.text") == F.col("found.text_key")), "left_anti")
