"""Cross-song analytics over feature tables: schema-tolerant unions, spread, correlation, description, normalisation, histograms."""

from __future__ import annotations

from functools import reduce
from itertools import combinations_with_replacement

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tactus.operators.storage import saved


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def diagonal_union(frames: list[DataFrame]) -> DataFrame:
    """All rows under the union of the columns, null where a frame lacks one."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _clean(c: str):
    """NaN counts as missing, as in data frames."""
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def long_format(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, value) rows."""
    pairs = F.array(*(F.struct(F.lit(c).alias("feature"), _clean(c).alias("value")) for c in columns))
    return df.select(F.inline(pairs))


def variance_top(df: DataFrame, columns: list[str], k: int = 6) -> DataFrame:
    return long_format(df, columns).groupBy("feature").agg(F.var_samp("value").alias("variance")).orderBy(F.desc("variance"), "feature").limit(k)


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of each pair (a <= b) over the rows where both are known, in one pass."""
    pairs = list(combinations_with_replacement(sorted(columns), 2))
    row = df.select(*(_clean(c).alias(c) for c in columns)).agg(*(F.corr(a, b).alias(f"c{k}") for k, (a, b) in enumerate(pairs)))
    return row.select(F.inline(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{k}").alias("corr")) for k, (a, b) in enumerate(pairs)))))


def order_statistics(values: DataFrame, ranks: DataFrame, bins: int = 1024, few: int = 1024) -> DataFrame:
    """feature, rank, value: the rank-th smallest (from 0) of each feature's values (feature, value), exactly.

    ``ranks``: feature, rank, lo, hi (the feature's least and greatest value), some rows a feature. Each pass counts the values between lo and hi in ``bins``
    equal parts, with partial aggregation, and narrows a rank's range to the least and greatest value of its part. A rank is found when its range
    is one value; ranges of at most ``few`` values are sorted at last. No state is larger than the parts of all ranks, whatever the number of values or of distinct ones."""
    spark, done = values.sparkSession, []
    left = [(r["feature"], r["rank"], 0, r["lo"], r["hi"], None) for r in ranks.collect()]  # ranks asked for: some a column
    schema = "feature string, rank long, below long, lo double, hi double, n long"
    while left:
        ready = [r for r in left if r[3] == r[4]]
        done += [(f, k, lo) for f, k, _, lo, _, _ in ready]
        small = [r for r in left if r[3] < r[4] and r[5] is not None and r[5] <= few]
        left = [r for r in left if r[3] < r[4] and (r[5] is None or r[5] > few)]
        if small:
            met = values.join(F.broadcast(spark.createDataFrame(small, schema).withColumnRenamed("feature", "_f")), (F.col("feature") == F.col("_f")) & F.col("value").between(F.col("lo"), F.col("hi")))
            picked = met.groupBy("feature", "rank").agg(F.sort_array(F.collect_list("value")).alias("v"), F.min("below").alias("below"))  # at most ``few`` values each
            done += [tuple(r) for r in picked.select("feature", "rank", F.get("v", (F.col("rank") - F.col("below")).cast("int"))).collect()]
        if left:
            met = values.join(F.broadcast(spark.createDataFrame(left, schema).withColumnRenamed("feature", "_f")), (F.col("feature") == F.col("_f")) & F.col("value").between(F.col("lo"), F.col("hi")))
            # halves, so that the range of the widest column is a number
            part = F.least(F.lit(bins - 1), F.floor((F.col("value") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2) * bins))
            counted = met.groupBy("feature", "rank", "below", part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
            upto = F.col("below") + F.sum("n").over(Window.partitionBy("feature", "rank").orderBy("part"))
            left = [tuple(r) for r in counted.withColumn("upto", upto).where("upto > rank and upto - n <= rank").select("feature", "rank", (F.col("upto") - F.col("n")).alias("below"), "lo", "hi", "n").collect()]
    return spark.createDataFrame(done, "feature string, rank long, value double")


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Of the columns, or of all numeric ones: feature, count, null_count, mean, std, min, quartiles (interpolated, exact), max. A column without values has nulls."""
    long = long_format(df, numeric_columns(df) if columns is None else columns)
    out = saved(long.groupBy("feature").agg(F.count("value").alias("count"), (F.count(F.lit(1)) - F.count("value")).alias("null_count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max")))
    place = F.explode(F.array(*(F.struct(F.lit(q).alias("q"), (F.lit(q) * (F.col("count") - 1)).alias("at")) for q in (0.25, 0.5, 0.75)))).alias("p")
    asked = out.where("count > 0").select("feature", place, F.col("min").alias("lo"), F.col("max").alias("hi")).select("feature", "p.q", "p.at", "lo", "hi")
    near = asked.select("feature", "q", "at", F.explode(F.array(F.floor("at"), F.ceil("at"))).alias("rank"), "lo", "hi")
    found = order_statistics(long.where("value is not null"), near.select("feature", "rank", "lo", "hi").distinct())
    # a few rows a column
    both = near.join(F.broadcast(found), ["feature", "rank"]).groupBy("feature", "q", "at").agg(F.min("value").alias("a"), F.max("value").alias("b"))
    value = F.col("a") + (F.col("b") - F.col("a")) * (F.col("at") - F.floor("at"))
    wide = both.groupBy("feature").agg(*(F.max(F.when(F.col("q") == q, value)).alias(name) for q, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))))
    return out.join(wide, "feature", "left").select("feature", "count", "null_count", "mean", "std", "min", "q25", "q50", "q75", "max")


def minmax(df: DataFrame, columns: list[str]) -> DataFrame:
    """Each column brought to 0..1; a constant one stays as it is. The ranges are one row, joined by broadcast."""
    ends = df.agg(*(x for c in columns for x in (F.min(c).cast("double").alias(f"_lo_{c}"), F.max(c).cast("double").alias(f"_hi_{c}"))))
    scaled = {c: F.when(F.col(f"_hi_{c}") > F.col(f"_lo_{c}"), (F.col(c) - F.col(f"_lo_{c}")) / (F.col(f"_hi_{c}") - F.col(f"_lo_{c}"))).otherwise(F.col(c).cast("double")) for c in columns}
    return df.join(F.broadcast(ends)).select(*(scaled[c].alias(c) if c in scaled else F.col(c) for c in df.columns))


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """bin (1..bins), its lower edge and its count; the greatest value falls in the last bin."""
    ends = F.broadcast(df.agg(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi")))
    at = F.when(F.col("hi") > F.col("lo"), F.least(F.lit(bins), F.floor((F.col(column) - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins) + 1)).otherwise(1)
    rows = df.where(F.col(column).isNotNull()).join(ends).select(at.cast("long").alias("bin"), "lo", "hi")
    return rows.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.min("lo").alias("lo"), F.min("hi").alias("hi")).select("bin", (F.col("lo") + (F.col("hi") - F.col("lo")) / bins * (F.col("bin") - 1)).alias("edge"), "n")


def positional_zip(left: DataFrame, right: DataFrame, left_order: list, right_order: list, keys: list[str]) -> DataFrame:
    """Rows of both sides in order, side by side inside each key, as far as both go; clashing columns of the right get the suffix ``_2``."""
    number = lambda df, order: df.withColumn("_ord", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    r = right.select(*(F.col(c).alias(f"{c}_2" if c in left.columns and c not in keys else c) for c in right.columns))
    r_order = [f"{c}_2" if c in left.columns and c not in keys else c for c in right_order]
    return number(left, left_order).join(number(r, r_order), [*keys, "_ord"]).drop("_ord")


def keep_newest(files: DataFrame, n: int, keys: list[str], newest: list[str]) -> DataFrame:
    """All but the newest n rows of each key, by the columns ``newest`` from the greatest down: the files to delete. Tasks send at most n rows of a key, so a
    key of any size is one small group; rows equal to the last one kept in all these columns stay."""
    place = F.struct(*newest)
    kept = files.select(*keys, place.alias("_at")).withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("_at")))).where(F.col("_k") <= n)
    last = kept.where(F.col("_k") == n).select(*keys, F.col("_at").alias("_last"))
    return files.join(last, keys).where(place < F.col("_last")).select(*files.columns)


def batch_rollup(files: DataFrame, status: str, seconds: str) -> DataFrame:
    """Totals, counts by status, rates (0 for no files) and mean time."""
    n = lambda s: F.count_if(F.col(status) == s)
    out = files.agg(F.count(F.lit(1)).alias("total"), n("success").alias("success"), n("failed").alias("failed"), n("skipped").alias("skipped"), F.sum(seconds).alias("seconds"))
    rate = lambda c: F.round(F.coalesce(F.try_divide(F.col(c), F.col("total")), F.lit(0.0)), 4)
    return out.withColumns({"success_rate": rate("success"), "failure_rate": rate("failed"), "avg_seconds": F.round(F.coalesce(F.try_divide(F.col("seconds"), F.col("total")), F.lit(0.0)), 3), "seconds": F.round(F.coalesce("seconds", F.lit(0.0)), 3)})
