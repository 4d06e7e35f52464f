"""Beat grids and bars.

Beats are (song_id, beat_index, time_s). Everything is per song: a median interval, generated beats beyond the last, bars as pairs
of beats. Only beats of a song meet in one task, and a song's beats are few beside its notes and samples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tactus.functions.music import beats_per_bar


def number_beats(times: DataFrame, *order: str) -> DataFrame:
    """Beats from (song_id, time_s) rows, numbered from 0."""
    return times.withColumn("beat_index", (F.row_number().over(Window.partitionBy("song_id").orderBy("time_s", *order)) - 1).cast("long"))


def intervals(beats: DataFrame) -> DataFrame:
    """Adds interval_s, the time since the beat before (null at the first)."""
    return beats.withColumn("interval_s", F.col("time_s") - F.lag("time_s").over(Window.partitionBy("song_id").orderBy("time_s", "beat_index")))


def median_interval(beats: DataFrame, tempo_bpm: float = 120.0) -> DataFrame:
    """song_id, interval_s, n_beats, last_s; a song of one beat, or whose median isn't positive, has the interval of the tempo."""
    spare = 60.0 / tempo_bpm if tempo_bpm > 0 else 0.5
    out = intervals(beats).groupBy("song_id").agg(F.median("interval_s").alias("m"), F.count(F.lit(1)).alias("n_beats"), F.max("time_s").alias("last_s"))
    return out.select("song_id", F.when(F.col("m") > 0, F.col("m")).otherwise(spare).alias("interval_s"), "n_beats", "last_s")


def _extended(beats: DataFrame, until: DataFrame, tempo_bpm: float, compat: str, how: str) -> DataFrame:
    """``extend`` by the join ``how`` of beats and ends, with until_s and n, the number of beats that the song has then. Beats are read once: what a song's last beat knows of the others makes the further ones."""
    more = 1 if compat == "a" else 0
    spare = 60.0 / tempo_bpm if tempo_bpm > 0 else 0.5
    order, song = Window.partitionBy("song_id").orderBy("time_s", "beat_index"), Window.partitionBy("song_id")
    placed = beats.select("song_id", "beat_index", "time_s", (F.col("time_s") - F.lag("time_s").over(order)).alias("gap_s"), F.lead(F.lit(True)).over(order).isNull().alias("is_last"))
    placed = placed.select("song_id", "beat_index", "time_s", "is_last", F.median("gap_s").over(song).alias("m"), F.count(F.lit(1)).over(song).alias("n_beats"), F.max("time_s").over(song).alias("last_s"))
    # the side with a row a song is hashed: beats need no sort for it
    rows = placed.join(until.select("song_id", "until_s").hint("shuffle_hash"), "song_id", how).withColumn("interval_s", F.when(F.col("m") > 0, F.col("m")).otherwise(spare))
    after = F.when(F.col("last_s") < F.col("until_s"), F.ceil((F.col("until_s") - F.col("last_s")) / F.col("interval_s")) + more)
    fresh = F.when(F.col("last_s").isNull(), F.ceil(F.col("until_s") / F.col("interval_s")) + 1)
    rows = rows.withColumn("count", F.greatest(F.coalesce(after, fresh if compat == "a" else F.lit(None), F.lit(0)), F.lit(0)).cast("int"))
    # step 0 is the beat itself
    steps = F.when(F.col("n_beats").isNotNull(), F.sequence(F.lit(0), F.when(F.col("is_last"), F.col("count")).otherwise(0))).when(F.col("count") > 0, F.sequence(F.lit(1), F.col("count"))).otherwise(F.array().cast("array<int>"))
    k, n = F.col("k"), F.coalesce("n_beats", F.lit(0))
    time = F.when(k == 0, F.col("time_s")).when(F.col("last_s").isNull(), (k - 1) * F.col("interval_s")).otherwise(F.col("last_s") + k * F.col("interval_s"))
    index = F.when(k == 0, F.col("beat_index")).otherwise((n + k - 1).cast("long"))
    return rows.withColumn("k", F.explode(steps)).select("song_id", index.alias("beat_index"), time.alias("time_s"), (k > 0).alias("added"), "until_s", (n + F.col("count")).alias("n"))


def extend(beats: DataFrame, until: DataFrame, tempo_bpm: float = 120.0, compat: str = "a", bare: bool = True) -> DataFrame:
    """Beats with further ones at the median interval until each song's ``until_s`` (song_id, until_s); a song without beats gets a grid from 0 where ``bare``.

    ``compat``: a adds one beat more than b."""
    return _extended(beats, until, tempo_bpm, compat, "full" if bare else "left").select("song_id", "beat_index", "time_s", "added")


def bar_grid(beats: DataFrame, durations: DataFrame, ts_num: int = 4, ts_den: int = 4, tempo_bpm: float = 120.0) -> DataFrame:
    """song_id, bar_index, start_s, end_s. Bar k spans beats int(k * bpb) to int(k * bpb + bpb), ends at the song's duration at the latest,
    and is left out, with its number, where it has no length. Songs without beats have no bars. ``durations``: song_id, duration_s."""
    bpb = beats_per_bar(ts_num, ts_den)
    places = _extended(beats, durations.select("song_id", F.col("duration_s").alias("until_s")), tempo_bpm, "a", "inner")
    n, i, k = F.col("n"), F.col("beat_index"), F.col("k")
    # a beat gives its time to the bars that it begins or ends, found among the numbers around it; the last one ends all later bars too. So the grid is made once
    most = F.greatest(F.lit(0).cast("long"), F.ceil(n / bpb) - 1)
    low = F.greatest(F.lit(0).cast("long"), F.floor((i - bpb) / bpb).cast("long") - 1)
    high = F.least(most, F.when(i == n - 1, most).otherwise(F.ceil((i + 1) / bpb).cast("long") + 1))
    near = places.select("*", F.explode(F.sequence(F.least(low, high), high)).alias("k"))
    begins, ends = (k * bpb).cast("long") == i, F.least((k * bpb + bpb).cast("long"), n - 1) == i
    bars = near.where(begins | ends).groupBy("song_id", "k").agg(F.max(F.when(begins, F.col("time_s"))).alias("start_s"), F.max(F.when(ends, F.least("time_s", "until_s"))).alias("end_s"))
    return bars.select("song_id", k.alias("bar_index"), "start_s", "end_s").where("end_s > start_s")


def synthesize(spans: DataFrame, start: Column, end: Column, tempo: Column) -> DataFrame:
    """A row per beat from start to end at the tempo; one that isn't positive counts as 120."""
    step = 60.0 / F.when(tempo > 0, tempo).otherwise(120.0)
    n = F.greatest(F.lit(0), F.ceil((end - start) / step)).cast("int")
    return spans.select("*", F.explode(F.sequence(F.lit(0), n)).alias("beat_index")).withColumns({"time_s": start + F.col("beat_index") * step, "beat_index": F.col("beat_index").cast("long")})


def every_nth(beats: DataFrame, n: int) -> DataFrame:
    return beats.where(F.pmod("beat_index", F.lit(n)) == 0)
