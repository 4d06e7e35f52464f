"""Queries of the relational operators over the driver's star schema and documents' metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tactus.functions import flatten as fl
from tactus.functions import music
from tactus.operators import analytics as an
from tactus.plans.timeline import _round
from tactus.plans.views import table

_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _files(spark, d: str) -> DataFrame:
    """Orders as processed files."""
    o = table(spark, d, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "O", "skipped").otherwise("failed")
    return o.select(F.col("o_orderkey").alias("file"), F.concat(F.lit("stem_"), (F.col("o_custkey") % 5).cast("string")).alias("stem"), F.col("o_orderdate").alias("mtime"), status.alias("status"), (F.col("o_totalprice") / 1000).alias("seconds"))


_FILES = "files as (select o_orderkey as file, 'stem_' || (o_custkey % 5)::varchar as stem, o_orderdate as mtime, case o_orderstatus when 'F' then 'success' when 'O' then 'skipped' else 'failed' end as status, o_totalprice / 1000 as seconds from orders)"


def _nested(spark, d: str) -> DataFrame:
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return c.select(F.col("c_custkey").alias("id"), F.struct(F.col("c_name").alias("name"), F.struct(F.col("n_name").alias("name"), F.array(F.col("n_nationkey").cast("long"), F.col("n_regionkey").cast("long")).alias("keys")).alias("nation")).alias("who"))


def diagonal_union(spark, d: str) -> DataFrame:
    return _round(an.diagonal_union([table(spark, d, "customer").select("c_custkey", F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")), table(spark, d, "supplier").select("s_suppkey", F.col("s_name").alias("name"))]))


def feature_fallback_join(spark, d: str) -> DataFrame:
    """Precomputed revenue of an order's lines, or the order's own total where there is none."""
    pre = table(spark, d, "lineitem").where("l_quantity > 45").groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("pre"))
    o = table(spark, d, "orders").join(pre, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return _round(o.select("o_orderkey", F.coalesce("pre", "o_totalprice").alias("value"), F.when(F.col("pre").isNull(), "fallback").otherwise("precomputed").alias("source")))


def positional_zip(spark, d: str) -> DataFrame:
    l = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    o = l.where("l_quantity < 25").withColumnsRenamed({"l_linenumber": "line", "l_quantity": "quantity"})
    return _round(an.positional_zip(l, o, ["l_linenumber", "l_quantity"], ["line", "quantity"], ["l_orderkey"]))


def file_tables(spark, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    k = F.col("n_nationkey").cast("double")
    return _round(n.select(F.col("n_nationkey").cast("long").alias("id"), music.backoff_delay(k, 1.0, 2.0, 60.0).alias("delay"), music.tempo_band(k * 9).alias("band"), music.clamped_timeout(k, 60, 300, 1800).alias("timeout"), music.bar_count(k * 10, F.lit(120.0), F.lit(4)).alias("bars"), music.many_bars(music.bar_count(k * 10, F.lit(120.0), F.lit(4)), k * 10).alias("many"), music.safe_fft_size(F.col("n_nationkey") * 100).cast("long").alias("fft"), music.time_to_sample(k * 0.0123, F.lit(22050.0)).alias("sample"), music.time_to_sample(k * 0.0123, F.lit(22050.0), "trunc").alias("sample_trunc"), music.slug(F.col("n_name")).alias("slug")))


def rollup_extension(spark, d: str) -> DataFrame:
    """Extension: subtotals over status and stem."""
    return _files(spark, d).rollup("status", "stem").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "flatten": lambda s, d: fl.flatten(_nested(s, d)).select("id", F.col("`who.name`").alias("who_name"), F.col("`who.nation.name`").alias("who_nation_name")),
    "flatten_parquet": lambda s, d: fl.flatten_for_files(_nested(s, d)),
    "unflatten": lambda s, d: fl.unflatten(fl.flatten(_nested(s, d))).select("id", F.col("who.name").alias("name"), F.col("who.nation.name").alias("nation")),
    "diagonal_union": diagonal_union,
    "feature_variance_topk": lambda s, d: _round(an.variance_top(table(s, d, "lineitem"), _FEATURES, 3)),
    "feature_corr": lambda s, d: _round(an.correlations(table(s, d, "lineitem"), _FEATURES)),
    "feature_describe": lambda s, d: _round(an.describe(table(s, d, "lineitem"), _FEATURES)),
    "minmax_norm": lambda s, d: _round(an.minmax(table(s, d, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice"])),
    "histogram": lambda s, d: _round(an.histogram(table(s, d, "orders"), "o_totalprice", 30)),
    "positional_zip": positional_zip,
    "feature_fallback_join": feature_fallback_join,
    "missing_files": lambda s, d: table(s, d, "customer").join(table(s, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey"),
    "newest_per_stem": lambda s, d: _files(s, d).groupBy("stem").agg(F.max_by("file", F.struct("mtime", "file")).alias("file")),
    "keep_newest_n": lambda s, d: an.keep_newest(_files(s, d), 10, ["stem"], ["mtime", "file"]).select("stem", "file"),
    "batch_rollup": lambda s, d: an.batch_rollup(_files(s, d), "status", "seconds"),
    "scalar_tables": file_tables,
    "status_rollup": rollup_extension,
}

_L = "select 'l_quantity' as feature, l_quantity::double as v from lineitem union all select 'l_extendedprice', l_extendedprice from lineitem union all select 'l_discount', l_discount from lineitem union all select 'l_tax', l_tax from lineitem"
_NEST = "select c_custkey as id, c_name, n_name, n_nationkey::varchar || ',' || n_regionkey::varchar as keys from customer join nation on c_nationkey = n_nationkey"
_PAIRS = [(a, b) for i, a in enumerate(sorted(_FEATURES)) for b in sorted(_FEATURES)[i:]]
ORACLE_SQL = {
    "flatten": f"select id, c_name as who_name, n_name as who_nation_name from ({_NEST})",
    "flatten_parquet": f"select id, c_name as who_name, n_name as who_nation_name, keys as who_nation_keys from ({_NEST})",
    "unflatten": f"select id, c_name as name, n_name as nation from ({_NEST})",
    "diagonal_union": "select c_custkey, c_name as name, round(c_acctbal, 6) + 0.0 as balance, null::bigint as s_suppkey from customer union all select null, s_name, null, s_suppkey from supplier",
    "feature_variance_topk": f"select feature, round(var_samp(v), 6) as variance from ({_L}) group by feature order by var_samp(v) desc, feature limit 3",
    "feature_corr": " union all ".join(f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) + 0.0 as corr from lineitem" for a, b in _PAIRS),
    "feature_describe": f"select feature, count(v) as count, count(*) - count(v) as null_count, round(avg(v), 6) as mean, round(stddev_samp(v), 6) as std, min(v) as min, round(quantile_cont(v, 0.25), 6) as q25, round(quantile_cont(v, 0.5), 6) as q50, round(quantile_cont(v, 0.75), 6) as q75, max(v) as max from ({_L}) group by feature",
    "minmax_norm": "select o_orderkey, round((o_totalprice - min(o_totalprice) over ()) / (max(o_totalprice) over () - min(o_totalprice) over ()), 6) as o_totalprice from orders",
    "histogram": "select bin, round(lo + (hi - lo) / 30 * (bin - 1), 6) as edge, count(*) as n from (select least(30, floor((o_totalprice - lo) / (hi - lo) * 30)::bigint + 1) as bin, lo, hi from orders, (select min(o_totalprice) as lo, max(o_totalprice) as hi from orders)) group by bin, lo, hi",
    "positional_zip": "select l_orderkey, l_linenumber, round(l_quantity, 6) as l_quantity, line, round(quantity, 6) as quantity from (select l_orderkey, l_linenumber, l_quantity, row_number() over (partition by l_orderkey order by l_linenumber, l_quantity) as k from lineitem) join (select l_orderkey, l_linenumber as line, l_quantity as quantity, row_number() over (partition by l_orderkey order by l_linenumber, l_quantity) as k from lineitem where l_quantity < 25) using (l_orderkey, k)",
    "feature_fallback_join": "select o_orderkey, round(coalesce(pre, o_totalprice), 6) as value, case when pre is null then 'fallback' else 'precomputed' end as source from orders left join (select l_orderkey, sum(l_extendedprice) as pre from lineitem where l_quantity > 45 group by 1) on o_orderkey = l_orderkey",
    "missing_files": "select c_custkey from customer where c_custkey not in (select o_custkey from orders)",
    "newest_per_stem": f"with {_FILES} select stem, file from (select *, row_number() over (partition by stem order by mtime desc, file desc) as k from files) where k = 1",
    "keep_newest_n": f"with {_FILES} select stem, file from (select *, row_number() over (partition by stem order by mtime desc, file desc) as k from files) where k > 10",
    "batch_rollup": f"with {_FILES} select count(*) as total, count(*) filter (where status = 'success') as success, count(*) filter (where status = 'failed') as failed, count(*) filter (where status = 'skipped') as skipped, round(sum(seconds), 3) as seconds, round(count(*) filter (where status = 'success') / count(*)::double, 4) as success_rate, round(count(*) filter (where status = 'failed') / count(*)::double, 4) as failure_rate, round(sum(seconds) / count(*), 3) as avg_seconds from files",
    "scalar_tables": "select n_nationkey::bigint as id, least(pow(2.0, n_nationkey), 60.0)::double as delay, case when n_nationkey * 9 < 60 then '0-60' when n_nationkey * 9 < 80 then '60-80' when n_nationkey * 9 < 120 then '80-120' when n_nationkey * 9 < 160 then '120-160' else '160-200' end as band, least(greatest(n_nationkey * 60.0, 300.0), 1800.0)::double as timeout, ceil(n_nationkey * 10 / (60.0::double / 120.0 * 4))::bigint as bars, (ceil(n_nationkey * 10 / (60.0::double / 120.0 * 4)) > 100 or n_nationkey * 10 > 180) as many, greatest(2, least(2048, (1 << (length(bin(greatest(n_nationkey * 100, 1)::bigint)) - 1))))::bigint as fft, round_even(n_nationkey * 0.0123::double * 22050.0::double, 0)::bigint as sample, trunc(n_nationkey * 0.0123::double * 22050.0::double)::bigint as sample_trunc, regexp_replace(lower(n_name), '[^a-z0-9]+', '_', 'g') as slug from nation",
    "status_rollup": f"with {_FILES} select status, stem, count(*) as n from files group by rollup (status, stem)",
}
