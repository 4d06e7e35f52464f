"""Queries of the graph operators over the driver's tables, and of features and sources over blocks of samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tactus.operators import features, graph
from tactus.plans.signal import blocks
from tactus.plans import views as v
from tactus.plans.timeline import _round, aligned
from tactus.plans.views import notes, table
from tactus.sinks import reports
from tactus.sources import audio, midi


#: Ids of blocks in an excerpt of a song.
EXCERPT = 2000


def supply_edges(spark, d: str) -> DataFrame:
    """Order lines as a graph from suppliers to parts; a supplier and a part of one key are one node."""
    l = table(spark, d, "lineitem")
    return l.select(F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("source"), F.concat(F.lit("s"), F.col("l_partkey").cast("string")).alias("target"))


_EDGES = "edges as (select 's' || l_suppkey::varchar as source, 's' || l_partkey::varchar as target from lineitem)"


def nation_edges(spark, d: str) -> DataFrame:
    """A small digraph: n -> (7n + 3) mod 25."""
    k = F.col("n_nationkey")
    return table(spark, d, "nation").select(k.cast("long").alias("source"), ((k * 7 + 3) % 25).cast("long").alias("target"))


def supplier_edges(spark, d: str) -> DataFrame:
    """A digraph with two edges from each supplier, to those whose numbers are 7s + 3 and 3s + 1 by the number of suppliers."""
    s = table(spark, d, "supplier")
    n, k = s.count(), F.col("s_suppkey")
    return s.select(k.cast("long").alias("source"), F.explode(F.array(((k * 7 + 3) % n + 1).cast("long"), ((k * 3 + 1) % n + 1).cast("long"))).alias("target"))


def _cycle_rows(found: DataFrame) -> DataFrame:
    return found.select(F.col("length").cast("long").alias("length"), F.array_join(F.transform("path", lambda x: x.cast("string")), ",").alias("path"))


def symbol_resolution(spark, d: str) -> DataFrame:
    """Customers as callers: names of nations resolve as functions of their region, self names as methods, others stay references."""
    n = table(spark, d, "nation")
    calls = table(spark, d, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("caller"), (F.col("c_custkey") % 5).cast("int").alias("module"), F.lit("K").alias("klass"), F.concat(F.when(F.col("c_custkey") % 3 == 0, "self.n").otherwise("n"), F.col("c_nationkey").cast("string")).alias("name"))
    name = F.concat(F.lit("n"), F.col("n_nationkey").cast("string"))
    functions = n.select(F.col("n_regionkey").cast("int").alias("module"), name.alias("name"), F.concat(F.lit("function:"), name).alias("id"))
    methods = functions.select("module", F.lit("K").alias("klass"), "name", F.concat(F.lit("method:"), "name").alias("id"))
    return graph.resolve(calls, functions, methods)


def base_resolution(spark, d: str) -> DataFrame:
    """Suppliers as classes whose base is a nation's name: one of the own region resolves, others stay references."""
    n = table(spark, d, "nation")
    classes = n.select(F.col("n_regionkey").cast("int").alias("module"), F.col("n_name").alias("name"), F.concat(F.lit("class:"), "n_name").alias("id"))
    bases = table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("klass"), (F.col("s_suppkey") % 5).cast("int").alias("module"), F.col("n_name").alias("name"))
    return graph.resolve_bases(bases, classes)


def edge_semijoin(spark, d: str) -> DataFrame:
    """Order lines as edges between suppliers and parts of which the tables hold those with even keys."""
    edges = table(spark, d, "lineitem").select(F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("source"), F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("target"))
    ids = table(spark, d, "supplier").where("s_suppkey % 2 = 0").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id")).unionByName(table(spark, d, "part").where("p_partkey % 2 = 0").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("id")))
    return graph.between(edges, ids).groupBy("source", "target").agg(F.count(F.lit(1)).alias("n"))


def _signals(spark, d: str) -> DataFrame:
    """Blocks strung together per bar label as a song at 8 kHz, scaled into [-1, 1]; an excerpt for each ``EXCERPT`` ids bounds a row's length."""
    rows = F.array_sort(F.collect_list(F.struct("vec_id", "samples")))
    # the peak is an aggregate of the group: as an expression over the row's samples it would be worked out again for each sample
    peak = F.max(F.array_max(F.transform("samples", F.abs)))
    songs = blocks(spark, d).withColumn("excerpt", F.floor(F.col("vec_id") / EXCERPT)).groupBy("bar_index", "excerpt").agg(F.flatten(F.transform(rows, lambda r: r["samples"])).alias("x"), peak.alias("peak"))
    return songs.select(F.concat(F.lit("song_"), F.col("bar_index").cast("string"), F.when(F.col("excerpt") == 0, "").otherwise(F.concat(F.lit("_"), F.col("excerpt").cast("string")))).alias("song_id"), F.lit("full_mix").alias("stem"), F.lit(8000).alias("sample_rate"), F.transform("x", lambda v: (v / F.col("peak")).cast("float")).alias("samples"))


def spectral_features(spark, d: str) -> DataFrame:
    rows = blocks(spark, d).select("vec_id", F.lit(8000).alias("sample_rate"), "samples")
    return features.slice_features(rows).drop("sample_rate")


def wav_roundtrip(spark, d: str) -> DataFrame:
    """Blocks written as 16-bit WAV bytes and read again: number and energy of the samples."""
    rows = blocks(spark, d).select(F.col("vec_id").cast("string").alias("song_id"), F.lit("full_mix").alias("stem"), F.lit(8000).alias("sample_rate"), F.transform("samples", lambda v: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), v.cast("double")))).alias("samples"))
    back = audio.signals_of(audio.with_wav(rows))
    return back.select(F.col("song_id").cast("long").alias("vec_id"), "sample_rate", F.size("samples").cast("long").alias("n"), F.aggregate("samples", F.lit(0).cast("long"), lambda a, v: a + F.rint(v * 32768).cast("long")).alias("total"))


def midi_roundtrip(spark, d: str) -> DataFrame:
    """Notes written as MIDI bytes a stem and parsed again."""
    n = notes(spark, d).select("song_id", "stem", "pitch", "velocity", (F.col("note_ix") * 0.5).alias("start_s"), (F.col("note_ix") * 0.5 + 0.25).alias("end_s"))
    back = midi.notes_of(midi.with_midi(n))
    return _round(back.groupBy("song_id", "stem").agg(F.count(F.lit(1)).alias("num_notes"), F.sum("pitch").alias("pitch_sum"), F.sum("velocity").alias("velocity_sum"), F.round(F.min("start_s"), 3).alias("start_s")))


QUERIES = {
    "module_coupling": lambda s, d: graph.coupling(supply_edges(s, d)),
    "top_packages": lambda s, d: graph.top_targets(supply_edges(s, d)),
    "edge_dedup": lambda s, d: supply_edges(s, d).distinct(),
    "symbol_resolution": symbol_resolution,
    "base_resolution": base_resolution,
    "edge_semijoin": edge_semijoin,
    "graph_cycles": lambda s, d: _cycle_rows(graph.cycles(nation_edges(s, d))),
    "graph_cycles_dense": lambda s, d: _cycle_rows(graph.cycles(supplier_edges(s, d), 6)),
    "strong_components": lambda s, d: graph.strong_components(supplier_edges(s, d)),
    "spectral_features": spectral_features,
    "beat_track": lambda s, d: features.analyse(_signals(s, d)),
    "wav_roundtrip": wav_roundtrip,
    "midi_roundtrip": midi_roundtrip,
    "abc_text": lambda s, d: reports.abc(aligned(s, d)),
    "markdown_report": lambda s, d: reports.markdown(aligned(s, d)),
}

_P = "with recursive e as (select n_nationkey::bigint as a, ((n_nationkey * 7 + 3) % 25)::bigint as b from nation), walk(path, last) as (select [a, b], b from e where b > a union all select list_append(path, b), b from walk join e on a = last where b > path[1] and not list_contains(path, b) and len(path) < 21)"
_S = "with recursive e as (select distinct s_suppkey::bigint as a, unnest([(s_suppkey * 7 + 3) % n + 1, (s_suppkey * 3 + 1) % n + 1])::bigint as b from (select *, count(*) over () as n from supplier))"
#: The report's head, its line break as SQL.
_HEAD = reports.HEAD.replace("\n", "' || chr(10) || '")
_NAMES = "['C','C#','D','D#','E','F','F#','G','G#','A','A#','B']"
ORACLE_SQL = {
    "markdown_report": f"""with {v.aligned_sql('a')}, rows as (select song_id, stem, bar_index, string_agg(printf('| %.3f | %d | %s | %d | %.3f |', round(start_s, 3), pitch, ({_NAMES})[pitch % 12 + 1] || (pitch // 12 - 1)::varchar, velocity, round(end_s - start_s, 3)), chr(10) order by note_ix) as r from aligned group by 1, 2, 3
), body as (select song_id, stem, string_agg('### Bar ' || bar_index::varchar || chr(10) || chr(10) || '{_HEAD}' || chr(10) || r || chr(10), chr(10) order by bar_index) as b from rows group by 1, 2
) select song_id, stem, '# MIDI Analysis Report: ' || song_id || chr(10) || chr(10) || '## Stem: ' || stem || chr(10) || chr(10) || b as text from body""",
    "abc_text": f"""with {v.aligned_sql('a')}, notes_ as (select song_id, stem, bar_index, start_s, pitch, pitch // 12 - 5 as o, (['C','^C','D','^D','E','F','^F','G','^G','A','^A','B'])[pitch % 12 + 1] as name, greatest(1, round_even((end_beat_float - start_beat_float) * 4, 0)::bigint)::varchar as n from aligned
), shown as (select *, case when o > 0 then lower(name) || repeat(chr(39), greatest(o - 1, 0)) else name || repeat(',', -o) end || n as t from notes_
), bars_ as (select song_id, stem, bar_index, string_agg(t, ' ' order by start_s, pitch, t) as line from shown group by 1, 2, 3
) select song_id, stem, 'X:1' || chr(10) || 'T:' || song_id || ' ' || stem || chr(10) || 'M:4/4' || chr(10) || 'L:1/16' || chr(10) || 'Q:1/4=120' || chr(10) || 'K:C' || chr(10) || string_agg(line || ' |', chr(10) order by bar_index) as text from bars_ group by 1, 2""",
    "module_coupling": f"with {_EDGES}, e as (select distinct source, target from edges where source <> target) select node, sum(o)::bigint as out_degree, sum(i)::bigint as in_degree, sum(o + i)::bigint as total from (select source as node, 1 as o, 0 as i from e union all select target, 0, 1 from e) group by node order by total desc, out_degree desc, in_degree desc, node desc limit 12",
    "top_packages": f"with {_EDGES} select target, count(*) as n from edges group by 1 order by n desc, target limit 15",
    "edge_dedup": f"with {_EDGES} select distinct source, target from edges",
    "symbol_resolution": "select 'c' || c_custkey as caller, case when n_nationkey is null then 'ref:' || name when c_custkey % 3 = 0 then 'method:n' || c_nationkey else 'function:n' || c_nationkey end as target from (select *, case when c_custkey % 3 = 0 then 'self.n' else 'n' end || c_nationkey as name from customer) left join nation on n_nationkey = c_nationkey and n_regionkey = c_custkey % 5",
    "base_resolution": "select 's' || s_suppkey as klass, case when n_regionkey = s_suppkey % 5 then 'class:' || n_name else 'ref:' || n_name end as target from supplier join nation on s_nationkey = n_nationkey",
    "edge_semijoin": "select 's' || l_suppkey as source, 'p' || l_partkey as target, count(*) as n from lineitem where l_suppkey in (select s_suppkey from supplier where s_suppkey % 2 = 0) and l_partkey in (select p_partkey from part where p_partkey % 2 = 0) group by 1, 2",
    "graph_cycles": f"{_P} select length, path from (select 1::bigint as length, a::varchar as path from e where a = b union all select len(path)::bigint, array_to_string(path, ',') from walk join e on a = last where b = path[1] and len(path) <= 20)",
    "graph_cycles_dense": f"{_S}, walk(path, last) as (select [a, b], b from e where b > a union all select list_append(path, b), b from walk join e on a = last where b > path[1] and not list_contains(path, b) and len(path) < 6) select length, path from (select distinct 1::bigint as length, a::varchar as path from e where a = b union all select len(path)::bigint, array_to_string(path, ',') from walk join e on a = last where b = path[1])",
    "strong_components": f"{_S}, reach(a, b) as (select a, b from e where a <> b union select reach.a, e.b from reach join e on e.a = reach.b), mutual as (select x.a, x.b from reach x join reach y on x.a = y.b and x.b = y.a where x.a <> x.b) select a as node, greatest(a, max(b)) as root from mutual group by a",
    "wav_roundtrip": "select vec_id, 8000 as sample_rate, count(*) as n, sum(trunc(greatest(-1.0::double, least(1.0::double, v::double)) * 32767))::bigint as total from (select vec_id, unnest(embedding) as v from embeddings) group by vec_id",
    "midi_roundtrip": "select 'song_' || user_id::varchar as song_id, event_type as stem, count(*) as num_notes, sum(36 + event_id % 61)::bigint as pitch_sum, sum(1 + event_id % 127)::bigint as velocity_sum, round(min(event_id) * 0.5::double, 3) as start_s from events group by 1, 2",
}
