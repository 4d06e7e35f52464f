"""Line deduplication over overlapping three-line windows, in DataFrame operations only.

Lines are what newlines part, compared as they are. A window is three consecutive lines of one document that aren't all
blank (empty or of spaces). Among equal windows the first, by document id and then by position, stays; each later one covers its three lines,
and the covered lines of a document are removed together, judged on the input. Two digests stand for a window's lines;
its first place comes from a grouped minimum with partial aggregation, and only windows that occur more than once are joined back to
their places, a join that adaptive execution splits where one window is very frequent.

Null texts have no lines and stay null; texts of fewer than three lines stay as they are. Rows of one id are told apart by their
texts; rows equal in both count as one document, whose every row gets the same result. A null id sorts first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.split(text_col, "\n", -1).alias("lines"))


def covered_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """doc_id, text_key, covered: the 0-based numbers of the lines to remove, for documents that have any."""
    lines = _lines(docs, id_col, text_col).where(F.size("lines") >= window)
    starts = F.sequence(F.lit(0), F.size("lines") - window)
    spans = F.transform(starts, lambda i: F.array(*(F.get("lines", i + k) for k in range(window))))  # slices would copy the whole array each
    each = lines.select("doc_id", "text_key", F.posexplode(spans).alias("pos", "span")).where(F.trim(F.array_join("span", "")) != "")
    placed = each.select(F.xxhash64("span").alias("h1"), F.xxhash64(F.lit("second"), "span").alias("h2"), F.struct(F.coalesce("doc_id", F.lit(-(2**63))).alias("d"), F.col("text_key").alias("k"), F.col("pos").alias("p")).alias("place"), "doc_id")
    first = placed.groupBy("h1", "h2").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = placed.join(first, ["h1", "h2"]).where(F.col("place") > F.col("first"))
    return later.groupBy("doc_id", F.col("place.k").alias("text_key")).agg(F.collect_set("place.p").alias("starts")).select("doc_id", "text_key", F.array_distinct(F.flatten(F.transform("starts", lambda p: F.sequence(p, p + (window - 1))))).alias("covered"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` with ``text_col`` cleaned, and n_lines, n_removed (long) beside it, in place of columns of these names."""
    found = covered_lines(docs, id_col, text_col, window).alias("found")
    own = lambda c: F.col(f"docs.`{c}`")
    whole, covered = own(text_col), F.col("found.covered")
    lines = F.split(whole, "\n", -1)
    rows = docs.alias("docs").join(found, own(id_col).cast("long").eqNullSafe(F.col("found.doc_id")) & (F.xxhash64(whole) == F.col("found.text_key")), "left")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), covered)
    # the transform of one element splits a text once; named in the inner function itself, the split would be made anew for each line
    left = F.transform(F.array(lines), lambda x: F.array_join(F.transform(kept, lambda i: F.get(x, i)), "\n"))
    text = F.when(covered.isNull(), whole).otherwise(F.get(left, F.lit(0)))
    n_lines = F.when(whole.isNull(), 0).otherwise(F.size(lines)).cast("long")
    counts = [n_lines.alias("n_lines"), F.coalesce(F.size(covered), F.lit(0)).cast("long").alias("n_removed")]
    return rows.select(*(text.alias(c) if c == text_col else own(c) for c in docs.columns if c not in ("n_lines", "n_removed")), *counts)


def op6_line_dedup(spark, sf_dir: str) -> DataFrame:
    done = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return done.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


OP6_SQL = """
with lines as (
  select doc_id, string_split(text, chr(10)) as l from documents where text is not null
), windows as (
  select doc_id, l, unnest(range(1, len(l) - 1)) as p from lines where len(l) >= 3
), spans as (
  select doc_id, p, l[p] as a, l[p + 1] as b, l[p + 2] as c from windows where trim(l[p] || l[p + 1] || l[p + 2]) <> ''
), later as (
  select doc_id, p from (select doc_id, p, row_number() over (partition by a, b, c order by doc_id, p) as k from spans) where k > 1
), covered as (
  select distinct doc_id, p + k as p from later, (select unnest(range(0, 3)) as k)
), each_line as (
  select doc_id, unnest(range(1, len(l) + 1)) as p, unnest(l) as line from lines
), kept as (
  select e.doc_id, count(*) as n_lines, count(c.p) as n_removed,
         coalesce(string_agg(case when c.p is null then e.line end, chr(10) order by e.p), '') as kept
  from each_line e left join covered c on c.doc_id = e.doc_id and c.p = e.p group by e.doc_id
)
select d.doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_removed, 0) as n_removed,
       case when d.text is not null then sha256(kept) end as kept_sha256
from documents d left join kept using (doc_id)
"""


def stage_line_dedup(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of three-line windows. One that has no line left goes; ``n_chars`` follows the text. Columns named as the
    operator's own counts stay as they are."""
    held = {c: f"kept_{c}" for c in ("n_lines", "n_removed") if c in docs.columns}
    done = dedup_lines(docs.withColumnsRenamed(held)).where("n_removed = 0 or n_removed < n_lines")
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(F.col("n_removed") == 0, F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return done.select(*(F.col(held[c]).alias(c) if c in held else F.col(c) for c in docs.columns))
