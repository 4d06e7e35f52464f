"""Aggregates of aligned notes per bar and stem."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tactus.functions.music import first_known

KEYS = ("song_id", "stem", "bar_index")


def with_defaults(events: DataFrame) -> DataFrame:
    """Adds stem 'all' and dur_s where the columns are missing."""
    if "stem" not in events.columns:
        events = events.withColumn("stem", F.lit("all"))
    if "dur_s" not in events.columns:
        events = events.withColumn("dur_s", F.col("end_s") - F.col("start_s"))
    return events


def with_times(rows: DataFrame) -> DataFrame:
    """start_s and end_s from the first known of the names that tables use for them; an end that is missing is the start."""
    start = first_known(rows.columns, "start_s", "start", "original_start")
    end = first_known(rows.columns, "end_s", "end", spare=start)
    return rows.withColumns({"start_s": start, "end_s": end})


def piano_roll(notes: DataFrame, step_s: float, end_s: float | None = None) -> DataFrame:
    """Velocity sums per song, pitch and time step; only notes that begin at or before ``end_s`` where it is given."""
    rows = notes.where("end_s > start_s" if end_s is None else f"end_s > start_s and start_s <= {float(end_s)}")
    steps = F.explode(F.sequence(F.floor(F.col("start_s") / step_s), F.floor(F.col("end_s") / step_s)))
    return rows.select("song_id", "pitch", "velocity", steps.alias("time_ix")).groupBy("song_id", "pitch", "time_ix").agg(F.sum("velocity").alias("velocity"))


def bars(events: DataFrame) -> DataFrame:
    """Number of notes, mean velocity, pitch range and time range per song, stem and bar; rows with a null key are left out."""
    rows = with_defaults(events)
    for k in KEYS:
        rows = rows.where(F.col(k).isNotNull())
    return rows.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("num_notes"), F.avg("velocity").alias("mean_velocity"), F.min("pitch").alias("pitch_min"), F.max("pitch").alias("pitch_max"), F.min("start_s").alias("start_s"), F.max("end_s").alias("end_s"))


def notes_per_stem(notes: DataFrame) -> DataFrame:
    return notes.groupBy("stem").agg(F.count(F.lit(1)).alias("num_notes"))


def beats_by_stem(beats: DataFrame, stems: DataFrame) -> DataFrame:
    """The song's one grid for each of its stems (song_id, stem)."""
    return beats.join(stems, "song_id")


def bars_of_times(notes: DataFrame, grid: DataFrame) -> DataFrame:
    """Notes with the bar whose interval holds their start; unlike a bar number this is right for any signature."""
    from tactus.operators.align import _bucket, widths

    spans = grid.select(F.col("song_id").alias("_song"), F.col("bar_index").alias("time_bar"), F.col("start_s").alias("bar_start"), F.col("end_s").alias("bar_end"))
    wide = widths(grid, "start_s", "end_s").hint("shuffle_hash")
    spans = spans.join(wide.withColumnRenamed("song_id", "_song"), "_song").withColumn("_c", F.explode(F.sequence(_bucket(F.col("bar_start"), F.col("width")), _bucket(F.col("bar_end"), F.col("width"))))).drop("width")
    rows = notes.join(wide, "song_id").withColumn("_b", _bucket(F.col("start_s"), F.col("width"))).drop("width")
    return rows.join(spans, (F.col("song_id") == F.col("_song")) & (F.col("_b") == F.col("_c")) & (F.col("start_s") >= F.col("bar_start")) & (F.col("start_s") < F.col("bar_end"))).drop("_b", "_c", "_song")
