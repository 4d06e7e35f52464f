"""Queries over sample blocks: the embeddings table's vectors stand for blocks of 64 samples, its label for the bar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tactus.functions import flatten as fl
from tactus.functions import music
from tactus.functions import signals as sg
from tactus.operators import charts
from tactus.operators import frames as fr
from tactus.operators import loudness as ld
from tactus.plans.timeline import _round
from tactus.plans.views import table
from tactus.sinks import reports


def blocks(spark, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select("vec_id", F.col("label").alias("bar_index"), F.col("embedding").alias("samples"))


def frame_stats(spark, d: str) -> DataFrame:
    """Mean, population deviation and range of each block."""
    x = blocks(spark, d)
    return _round(x.select("vec_id", sg.mean(F.col("samples")).alias("mean"), sg.std(F.col("samples")).alias("std"), F.array_min("samples").cast("double").alias("min"), F.array_max("samples").cast("double").alias("max")))


def rms_energy(spark, d: str) -> DataFrame:
    x = F.col("samples")
    return _round(blocks(spark, d).select("vec_id", sg.rms(x).alias("rms"), sg.energy(x).alias("energy"), sg.zero_crossing_rate(x).alias("zcr")))


def prefix_energy(spark, d: str) -> DataFrame:
    """Running energy inside each block."""
    each = blocks(spark, d).select("vec_id", F.posexplode("samples").alias("ix", "v"))
    from pyspark.sql import Window

    run = F.sum(F.col("v").cast("double") * F.col("v").cast("double")).over(Window.partitionBy("vec_id").orderBy("ix").rowsBetween(Window.unboundedPreceding, 0))
    return _round(each.select("vec_id", "ix", run.alias("energy")))


def frames_to_bars(spark, d: str) -> DataFrame:
    """Block means and deviations gathered per bar."""
    x = blocks(spark, d).select("bar_index", sg.rms(F.col("samples")).alias("rms"), sg.zero_crossing_rate(F.col("samples")).alias("zcr"))
    return _round(x.groupBy("bar_index").agg(F.avg("rms").alias("rms_mean"), F.stddev_pop("rms").alias("rms_std"), F.avg("zcr").alias("zcr_mean"), F.count(F.lit(1)).alias("frames")))


def evolving_segments(spark, d: str) -> DataFrame:
    """Four equal parts of each block, the last with the remainder."""
    each = blocks(spark, d).select("vec_id", F.size("samples").alias("n"), F.posexplode("samples").alias("ix", "v"))
    part = F.least(F.floor(F.col("ix") / F.greatest(F.lit(1), F.floor(F.col("n") / 4))), F.lit(3))
    out = each.withColumn("segment_index", part).groupBy("vec_id", "segment_index").agg(F.sqrt(F.avg(F.col("v").cast("double") * F.col("v").cast("double"))).alias("rms"), F.avg(F.col("v").cast("double")).alias("mean"))
    return _round(out)


def list_expand(spark, d: str) -> DataFrame:
    """The first thirteen samples of each block as columns."""
    x = blocks(spark, d).select("vec_id", F.transform("samples", lambda v: v.cast("double")).alias("mfcc_mean"))
    return _round(fl.expand_lists(x, {"mfcc_mean": 13}))


def mono_downmix(spark, d: str) -> DataFrame:
    """The even and odd samples as two channels."""
    x = F.col("samples")
    even, odd = F.filter(x, lambda v, i: i % 2 == 0), F.filter(x, lambda v, i: i % 2 == 1)
    return _round(blocks(spark, d).select("vec_id", sg.downmix(even, odd).alias("m")).select("vec_id", F.posexplode("m").alias("ix", "v")).select("vec_id", "ix", F.col("v").cast("double").alias("v")))


def peak_normalize(spark, d: str) -> DataFrame:
    return _round(blocks(spark, d).select("vec_id", F.posexplode(sg.peak_normalize(F.transform("samples", lambda v: v.cast("double")))).alias("ix", "v")))


def int16_roundtrip(spark, d: str) -> DataFrame:
    q = blocks(spark, d).select("vec_id", sg.to_int16(F.col("samples")).alias("q"))
    return _round(q.select("vec_id", F.posexplode(F.arrays_zip("q", sg.from_int16(F.col("q")).alias("back"))).alias("ix", "r")).select("vec_id", "ix", F.col("r.q").alias("q"), F.col("r.back").alias("back")))


def decimate(spark, d: str) -> DataFrame:
    return _round(blocks(spark, d).select("vec_id", F.posexplode(sg.decimate(F.col("samples"), 16)).alias("ix", "v")).select("vec_id", "ix", F.col("v").cast("double").alias("v")))


def audio_validity(spark, d: str) -> DataFrame:
    """Blocks with faults planted by number: empty, null, not a number, infinite, and a rate of zero."""
    k = F.col("vec_id") % 6
    x = F.when(k == 0, F.array().cast("array<float>")).when(k == 1, F.lit(None)).when(k == 2, F.concat("samples", F.array(F.lit(float("nan")).cast("float")))).when(k == 3, F.concat("samples", F.array(F.lit(float("inf")).cast("float")))).otherwise(F.col("samples"))
    return blocks(spark, d).select("vec_id", sg.valid(x, F.when(k == 4, 0).otherwise(22050)).alias("valid"))


def _tracks(spark, d: str) -> DataFrame:
    """The vectors as frames of four tracks."""
    x = blocks(spark, d)
    part = lambda a, n: F.transform(F.slice("samples", a, n), lambda v: v.cast("double"))
    at = lambda i: F.get("samples", F.lit(i)).cast("double")
    return x.select(F.concat(F.lit("track_"), (F.col("vec_id") % 4).cast("string")).alias("song_id"), F.lit("full_mix").alias("stem"), F.floor(F.col("vec_id") / 4).alias("frame"), at(0).alias("centroid"), at(1).alias("bandwidth"), at(2).alias("rolloff"), at(3).alias("zcr"), part(5, 13).alias("mfcc"), part(18, 12).alias("chroma"))


def _track_ranges(spark, d: str) -> DataFrame:
    """Bars of a quarter of a second at 22,050 samples a second over the tracks."""
    songs = _tracks(spark, d).groupBy("song_id", "stem").agg((F.max("frame") + 1).alias("n_frames")).withColumn("sample_rate", F.lit(22050))
    k = F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n_frames") * 512 / 22050 / 0.25) - 1))
    bars = songs.select("song_id", k.alias("bar_index")).withColumns({"start_s": F.col("bar_index") * F.lit(0.25), "end_s": (F.col("bar_index") + 1) * F.lit(0.25)})
    return fr.bar_frame_ranges(bars, songs)


def frame_range_join(spark, d: str) -> DataFrame:
    """The frames of each bar; neighbouring bars may share one."""
    return fr.frames_in_bars(_tracks(spark, d).select("song_id", "stem", "frame"), _track_ranges(spark, d)).select("song_id", "bar_index", "frame")


def precomputed_frames(spark, d: str) -> DataFrame:
    out = fr.aggregate_frames(fr.frames_in_bars(_tracks(spark, d), _track_ranges(spark, d)))
    return _round(reports.wide_features(out).drop("stem"))


def list_stats(spark, d: str) -> DataFrame:
    return _round(fl.scalars(blocks(spark, d), "x_"))


def matrix_stats(spark, d: str) -> DataFrame:
    """Rows of sixteen samples of each block as a matrix."""
    rows = F.transform(F.sequence(F.lit(0), F.floor(F.size("samples") / 16).cast("int") - 1), lambda k: F.slice("samples", k * 16 + 1, 16))
    m, s = sg.row_stats(F.col("m"))
    each = F.posexplode(F.arrays_zip(m.alias("mean"), s.alias("std"))).alias("row", "r")
    return _round(blocks(spark, d).select("vec_id", rows.alias("m")).select("vec_id", each).select("vec_id", "row", "r.mean", "r.std"))


def inferred_duration(spark, d: str) -> DataFrame:
    t = F.transform("samples", lambda v: F.abs(v.cast("double")))
    return _round(blocks(spark, d).select("vec_id", music.inferred_duration(F.when(F.col("vec_id") % 5 > 0, t), F.col("vec_id") % 3 * 40.0).alias("duration_s")))


def _song_blocks(spark, d: str) -> DataFrame:
    """The vectors as blocks of the songs that their labels name, in the order of their ids."""
    from pyspark.sql import Window

    x = blocks(spark, d)
    nth = F.row_number().over(Window.partitionBy("bar_index").orderBy("vec_id")) - 1
    return x.select(F.concat(F.lit("song_"), F.col("bar_index").cast("string")).alias("song_id"), F.lit("full_mix").alias("stem"), F.lit(0).alias("channel"), nth.cast("long").alias("block"), F.lit(8000).alias("sample_rate"), "samples", "vec_id")


def waveform_pyramid(spark, d: str) -> DataFrame:
    return _round(charts.waveform_pyramid(_song_blocks(spark, d)).drop("stem"))


def spectrogram_db(spark, d: str) -> DataFrame:
    """The spectrum of each vector under a Hann window, in decibels below its song's peak."""
    x = blocks(spark, d).select(F.concat(F.lit("song_"), F.col("bar_index").cast("string")).alias("song_id"), "vec_id", F.lit(8000).alias("sample_rate"), "samples")
    return charts.spectrogram(x, 64, 64).select("song_id", "vec_id", F.posexplode("db").alias("bin", "db")).select("song_id", "vec_id", "bin", (F.round("db", 3) + 0.0).alias("db"))


def song_loudness(spark, d: str) -> DataFrame:
    """Loudness of the songs at 8 kHz, K-weighted."""
    return _round(ld.loudness(ld.weighted_segments(_song_blocks(spark, d))))


def loudness_gating(spark, d: str) -> DataFrame:
    """The vectors as tenths of a second whose energies are weighted already."""
    x = F.col("samples")
    return _round(ld.loudness(_song_blocks(spark, d).select("song_id", "stem", F.col("block").alias("segment"), sg.energy(x).alias("energy"), F.size(x).cast("long").alias("n"))))


_X = "with x as (select vec_id, label as bar_index, embedding as samples from embeddings), e as (select vec_id, bar_index, len(samples) as n, unnest(range(0, len(samples))) as ix, unnest(samples)::double as v from x)"
_ZCR = "select vec_id, bar_index, sqrt(sum(v * v) / max(n)) as rms, sum(v * v) as energy, sum(flip)::double / max(n) as zcr from (select *, ((v < 0) <> (lag(v) over (partition by vec_id order by ix) < 0))::int as flip from e) group by 1, 2"

QUERIES = {
    "frame_stats": frame_stats, "rms_energy_zcr": rms_energy, "prefix_energy": prefix_energy, "frames_to_bars": frames_to_bars, "evolving_segments": evolving_segments, "list_expand": list_expand,
    "frame_range_join": frame_range_join, "precomputed_frames": precomputed_frames, "list_stats": list_stats, "matrix_stats": matrix_stats, "inferred_duration": inferred_duration,
    "waveform_pyramid": waveform_pyramid, "spectrogram_db": spectrogram_db, "song_loudness": song_loudness, "loudness_gating": loudness_gating,
    "mono_downmix": mono_downmix, "peak_normalize": peak_normalize, "int16_roundtrip": int16_roundtrip, "decimate": decimate, "audio_validity": audio_validity,
}
_FRAMES = """with frames as (select 'track_' || (vec_id % 4)::varchar as song_id, vec_id // 4 as frame, embedding as e from embeddings
), songs as (select song_id, max(frame) + 1 as n from frames group by 1
), bars as (select song_id, n, unnest(range(0, ceil(n * 512 / 22050.0::double / 0.25::double)::bigint)) as bar_index from songs
), ranges as (select song_id, bar_index, greatest(0, floor((trunc(bar_index * 0.25::double * 22050) - 1024) / 512.0::double)::bigint) as a,
  least(n, floor((trunc((bar_index + 1) * 0.25::double * 22050) - 1024) / 512.0::double)::bigint + 1) as b from bars
), met as (select r.song_id, bar_index, frame, e from ranges r join frames f on f.song_id = r.song_id and f.frame >= a and f.frame < b)"""
_FRAME_COLUMNS = ", ".join(
    [f"round({f}(e[{i}]::double), 6) + 0.0 as {n}" for n, f, i in (("spectral_centroid_mean", "avg", 1), ("spectral_centroid_std", "stddev_pop", 1), ("spectral_rolloff_mean", "avg", 3), ("spectral_rolloff_std", "stddev_pop", 3), ("spectral_bandwidth_mean", "avg", 2), ("zcr", "avg", 4))]
    + [f"round(avg(e[{i + 18}]::double), 6) + 0.0 as chroma_mean_{i:02d}" for i in range(12)]
    + [f"round({f}(e[{i + 5}]::double), 6) + 0.0 as mfcc_{i:02d}_{s}" for s, f in (("mean", "avg"), ("std", "stddev_pop")) for i in range(13)]
)
_SONGS = f"{_X}, songs as (select 'song_' || bar_index::varchar as song_id, row_number() over (partition by bar_index order by vec_id) - 1 as block, vec_id, samples from x)"
ORACLE_SQL = {
    "waveform_pyramid": f"{_SONGS} select song_id, level::integer as level, floor(block / pow(4.0::double, level))::bigint as bucket, round(min(list_min(samples))::double, 6) + 0.0 as lo, round(max(list_max(samples))::double, 6) + 0.0 as hi, sum(len(samples))::bigint as n from songs, range(0, 8) t(level) where len(samples) > 0 group by 1, 2, 3",
    "spectrogram_db": """with x as (select 'song_' || label::varchar as song_id, vec_id, unnest(embedding)::double as v, unnest(range(0, len(embedding))) as i from embeddings
), wave as (select k, i, cos(2 * pi() * k * i / 64) * (0.5 - 0.5 * cos(2 * pi() * i / 64)) as c, sin(2 * pi() * k * i / 64) * (0.5 - 0.5 * cos(2 * pi() * i / 64)) as s from range(0, 33) a(k), range(0, 64) b(i)
), p as (select song_id, vec_id, k, pow(sum(v * c), 2) + pow(sum(v * s), 2) as p from x join wave using (i) group by 1, 2, 3)
select song_id, vec_id, k::integer as bin, round(greatest(-80.0::double, 10 * log10(greatest(p, 1e-10) / greatest(max(p) over (partition by song_id), 1e-10))), 3) + 0.0 as db from p""",
    "loudness_gating": f"""{_SONGS}, seg as (select song_id, block, sum(v * v) as e, count(*) as n from (select song_id, block, unnest(samples)::double as v from songs) group by 1, 2
), win as (select song_id, case when count(*) over m = 4 then sum(e) over m / sum(n) over m end as m, case when count(*) over s = 30 then sum(e) over s / sum(n) over s end as s from seg
  window m as (partition by song_id order by block rows between current row and 3 following), s as (partition by song_id order by block rows between current row and 29 following)
), lev as (select song_id, m, s, -0.691 + 10 * log10(m) as lm, -0.691 + 10 * log10(s) as ls from win
), gates as (select song_id, -0.691 + 10 * log10(avg(m) filter (where lm > -70)) - 10 as gm, -0.691 + 10 * log10(avg(s) filter (where ls > -70)) - 20 as gs from lev group by 1
) select song_id, 'full_mix' as stem, case when count(m) > 0 then round(coalesce(-0.691 + 10 * log10(avg(m) filter (where lm > -70 and lm > gm)), -70.0), 6) end as integrated,
  round(quantile_cont(ls, 0.95) filter (where ls > -70 and ls > gs) - quantile_cont(ls, 0.1) filter (where ls > -70 and ls > gs), 6) + 0.0 as range_lu, round(max(lm), 6) as momentary_max, round(max(ls), 6) as short_term_max, count(m) as num_blocks, count(m) > 0 as available
from lev join gates using (song_id) group by song_id""",
    "frame_range_join": f"{_FRAMES} select song_id, bar_index, frame from met",
    "precomputed_frames": f"{_FRAMES} select song_id, bar_index, count(*) as frames, {_FRAME_COLUMNS} from met group by 1, 2",
    "list_stats": f"{_X} select vec_id as x_vec_id, any_value(bar_index) as x_bar_index, round(avg(v), 6) + 0.0 as x_samples_mean, round(stddev_pop(v), 6) + 0.0 as x_samples_std from e group by vec_id",
    "matrix_stats": f"{_X} select vec_id, (ix // 16)::integer as row, round(avg(v), 6) + 0.0 as mean, round(stddev_pop(v), 6) + 0.0 as std from e where ix < n // 16 * 16 group by 1, 2",
    "inferred_duration": f"{_X} select vec_id, case when vec_id % 5 > 0 then round(max(abs(v)) + 60.0::double / case when vec_id % 3 > 0 then vec_id % 3 * 40.0::double else 120.0::double end, 6) else 0.0 end::double as duration_s from e group by vec_id",
    "frame_stats": f"{_X} select vec_id, round(avg(v), 6) + 0.0 as mean, round(stddev_pop(v), 6) + 0.0 as std, round(min(v), 6) + 0.0 as min, round(max(v), 6) + 0.0 as max from e group by vec_id",
    "rms_energy_zcr": f"{_X} select vec_id, round(rms, 6) as rms, round(energy, 6) as energy, round(zcr, 6) as zcr from ({_ZCR})",
    "prefix_energy": f"{_X} select vec_id, ix::integer as ix, round(sum(v * v) over (partition by vec_id order by ix rows unbounded preceding), 6) as energy from e",
    "frames_to_bars": f"{_X} select bar_index, round(avg(rms), 6) as rms_mean, round(stddev_pop(rms), 6) as rms_std, round(avg(zcr), 6) as zcr_mean, count(*) as frames from ({_ZCR}) group by bar_index",
    "evolving_segments": f"{_X} select vec_id, least(ix // greatest(1, n // 4), 3)::bigint as segment_index, round(sqrt(avg(v * v)), 6) as rms, round(avg(v), 6) + 0.0 as mean from e group by 1, 2",
    "list_expand": f"{_X} select vec_id, {', '.join(f'round(samples[{i + 1}]::double, 6) + 0.0 as mfcc_mean_{i:02d}' for i in range(13))} from x",
    "mono_downmix": f"{_X} select vec_id, (ix // 2)::integer as ix, round(((max(case when ix % 2 = 0 then v end)::float + max(case when ix % 2 = 1 then v end)::float)::float / 2)::double, 6) + 0.0 as v from e group by 1, 2",
    "peak_normalize": f"{_X} select vec_id, ix::integer as ix, round(v / max(abs(v)) over (partition by vec_id), 6) + 0.0 as v from e",
    "int16_roundtrip": f"{_X} select vec_id, ix::integer as ix, q, round(q / 32768.0::double, 6) + 0.0 as back from (select *, trunc(greatest(-1.0::double, least(1.0::double, v)) * 32767)::integer as q from e)",
    "decimate": f"{_X} select vec_id, (ix // 4)::integer as ix, round(v, 6) + 0.0 as v from e where ix % 4 = 0",
    "audio_validity": "select vec_id, vec_id % 6 = 5 as valid from embeddings",
}
