"""Tables behind charts: a pyramid of a waveform's extremes, a spectrogram relative to its song's peak, runs of a piano roll."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tactus.functions import dsp


def waveform_pyramid(blocks: DataFrame, factor: int = 4, levels: int = 8) -> DataFrame:
    """song_id, stem, level, bucket, lo, hi, n: least and greatest sample of ``factor`` ^ level blocks (song_id, stem, block, samples), so that a chart of any width
    reads rows in proportion to it. One grouped pass for all levels; blocks without samples have no part."""
    rows = blocks.where("size(samples) > 0").select("song_id", "stem", "block", F.array_min("samples").cast("double").alias("lo"), F.array_max("samples").cast("double").alias("hi"), F.size("samples").cast("long").alias("n"))
    each = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("level"))
    bucket = F.floor(F.col("block") / F.pow(F.lit(factor), F.col("level"))).cast("long")
    return each.groupBy("song_id", "stem", "level", bucket.alias("bucket")).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n"))


def spectrogram(signals: DataFrame, size: int = dsp.N_FFT, hop: int = dsp.HOP, floor_db: float = -80.0, frames_at_once: int = 1024) -> DataFrame:
    """The columns of ``signals`` but samples and sample_rate, frame, and db: the power of each bin in decibels below the song's greatest, not under ``floor_db``. Frames are made in parts, so
    a task holds those of one part; the song's peak comes from a first grouped pass over them."""
    kept = [c for c in signals.columns if c not in ("samples", "sample_rate")]
    kinds = dict(signals.dtypes)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for i, x in enumerate(pdf["samples"]):
                for k in range(0, 0 if x is None else max(0, (len(x) - size) // hop + 1), frames_at_once):
                    power = dsp.power_frames(x[k * hop : (k + frames_at_once - 1) * hop + size], size, hop)
                    yield pd.DataFrame({c: [pdf[c].iloc[i]] * len(power) for c in kept} | {"frame": range(k, k + len(power)), "power": list(power)})

    frames = signals.select(*kept, "samples").mapInPandas(run, ", ".join(f"{c} {kinds[c]}" for c in kept) + ", frame long, power array<double>")
    peak = frames.groupBy("song_id").agg(F.max(F.array_max("power")).alias("_peak"))
    db = F.transform("power", lambda p: F.greatest(F.lit(floor_db), 10 * F.log10(F.greatest(p, F.lit(1e-10)) / F.greatest(F.col("_peak"), F.lit(1e-10)))))
    return frames.join(peak, "song_id").select(*kept, "frame", db.alias("db"))


def piano_runs(notes: DataFrame, rate: float = 100.0) -> DataFrame:
    """song_id, pitch, from_ix, until_ix, velocity: the stretches of a piano roll of ``rate`` steps a second on which the sum of sounding velocities is one and not 0.

    A note begins and ends at its times' steps, cut towards zero; its velocity comes and goes there and a running sum along a song's pitch gives the roll, so rows
    follow the notes and not the steps they last."""
    at = lambda c: (F.col(c) * rate).cast("long")
    rows = notes.select("song_id", "pitch", "velocity", at("start_s").alias("a"), at("end_s").alias("b")).where("b > a")
    change = F.explode(F.array(F.struct(F.col("a").alias("ix"), F.col("velocity").cast("long").alias("d")), F.struct(F.col("b").alias("ix"), (-F.col("velocity")).cast("long").alias("d")))).alias("e")
    steps = rows.select("song_id", "pitch", change).groupBy("song_id", "pitch", F.col("e.ix").alias("ix")).agg(F.sum("e.d").alias("d")).where("d <> 0")
    w = Window.partitionBy("song_id", "pitch").orderBy("ix")
    runs = steps.select("song_id", "pitch", F.col("ix").alias("from_ix"), F.lead("ix").over(w).alias("until_ix"), F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("velocity"))
    return runs.where("velocity <> 0")
