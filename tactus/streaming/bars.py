"""Extension: bars and phrases of note streams.

Notes arrive with an event time; musical time is what the tempo makes of it. Bars are tumbling windows of a bar's length, phrases are
session windows with a gap; late notes are dropped after the watermark, and state is one row per song, stem and open window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _stats() -> list:
    return [F.count(F.lit(1)).alias("num_notes"), F.avg("velocity").alias("mean_velocity"), F.min("pitch").alias("pitch_min"), F.max("pitch").alias("pitch_max")]


def bar_windows(notes: DataFrame, bar_seconds: float, late: str = "10 minutes") -> DataFrame:
    """``notes``: song_id, stem, ts, pitch, velocity."""
    out = notes.withWatermark("ts", late).groupBy("song_id", "stem", F.window("ts", f"{round(bar_seconds * 1000)} milliseconds")).agg(*_stats())
    return out.select("song_id", "stem", F.col("window.start").alias("bar_start"), F.col("window.end").alias("bar_end"), "num_notes", "mean_velocity", "pitch_min", "pitch_max")


def phrases(notes: DataFrame, gap_seconds: float, late: str = "10 minutes") -> DataFrame:
    out = notes.withWatermark("ts", late).groupBy("song_id", "stem", F.session_window("ts", f"{round(gap_seconds * 1000)} milliseconds")).agg(*_stats())
    return out.select("song_id", "stem", F.col("session_window.start").alias("phrase_start"), F.col("session_window.end").alias("phrase_end"), "num_notes", "mean_velocity", "pitch_min", "pitch_max")
