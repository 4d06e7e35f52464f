"""Slices of signals as WAV files, and the intervals they come from."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tactus.functions import dsp, tables
from tactus.operators import features
from tactus.sinks import files
from tactus.sources import audio
from tactus.sources.wav_blocks import channels_of


def intervals_of_times(times: DataFrame) -> DataFrame:
    """song_id, bar_index, start_s, end_s between each of a song's bar times (song_id, time_s) and the next."""
    w = Window.partitionBy("song_id").orderBy("time_s")
    rows = times.select("song_id", (F.row_number().over(w) - 1).cast("long").alias("bar_index"), F.col("time_s").alias("start_s"), F.lead("time_s").over(w).alias("end_s"))
    return rows.where("end_s > start_s")


def chunk_name() -> Column:
    return F.format_string("bar_%04d.wav", F.col("bar_index"))


def chunk_files(sounds: DataFrame, native: bool = False) -> DataFrame:
    """song_id, stem, name, content of a WAV file for each bar's sound (``features.bar_sounds``) at its rate: with all channels if ``native``, else their mean."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            sounds = [channels_of(raw, n) for raw, n in zip(pdf["samples"], pdf["num_channels"], strict=True)]
            yield pdf[["song_id", "stem", "name"]].assign(content=[audio.encode(x if native else x.mean(0, dtype=float), r) for x, r in zip(sounds, pdf["sample_rate"], strict=True)])

    rows = sounds.select("song_id", "stem", chunk_name().alias("name"), "samples", "num_channels", "sample_rate")
    return rows.mapInPandas(run, "song_id string, stem string, name string, content binary")


def write_chunks(slices: DataFrame, folder: str) -> DataFrame:
    """Write each slice (song_id, stem, bar_index, sample_rate, samples) as ``folder/song/stem/bar_0000.wav``; the columns of ``slices`` but samples, and chunk_path. Samples are mono, or channels as arrays
    of equal length."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            yield pdf[["song_id", "stem", "name"]].assign(content=[audio.encode(x, r) for x, r in zip(pdf["samples"], pdf["sample_rate"], strict=True)])

    content = slices.select("song_id", "stem", chunk_name().alias("name"), "samples", "sample_rate").mapInPandas(run, "song_id string, stem string, name string, content binary")
    files.write_files(content, folder)
    return slices.drop("samples").withColumn("chunk_path", files.place_of(folder, F.col("song_id"), F.col("stem"), chunk_name()))


def chunk_signals(signals: DataFrame, intervals: DataFrame, folder: str, rounding: str = "round") -> DataFrame:
    """Files of all stems over intervals (song_id, bar_index, start_s, end_s), which may overlap or leave gaps. ``rounding`` of times to samples: round, trunc or ms."""
    return write_chunks(features.bar_slices(signals, intervals, rounding), folder)


def chunks_with_features(signals: DataFrame, intervals: DataFrame, folder: str, rounding: str = "round", extractor=dsp.features, record: str = tables.RECORD) -> DataFrame:
    """Files and features of the same slices: the columns of ``write_chunks``, chunk_index (a stem's chunks counted by their start), and the record of ``extractor``."""
    slices = features.bar_slices(signals, intervals, rounding).persist()
    written = write_chunks(slices, folder)
    nth = F.row_number().over(Window.partitionBy("song_id", "stem").orderBy("start_s", "bar_index")) - 1
    return features.slice_features(slices, extractor, record).withColumn("chunk_index", nth).withColumn("chunk_path", files.place_of(folder, F.col("song_id"), F.col("stem"), chunk_name())).select(*written.columns, "chunk_index", *(c.split()[0] for c in record.split(", ")))
