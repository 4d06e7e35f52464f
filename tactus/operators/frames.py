"""Bar features from frames that were computed once for a whole signal: a range join of bars with frames, then one grouped pass.

A bar's frames are an interval of whole numbers, so the range join is an equality join on the numbers that the interval holds: rows grow
with frames (and the few that neighbouring bars share), and no task compares all frames of a song with all of its bars.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tactus.config import Config
from tactus.functions import dsp
from tactus.operators.features import centred
from tactus.operators.storage import saved
from tactus.sources.wav_blocks import channels_of


def frames_of(blocks: DataFrame, size: int = dsp.N_FFT, hop: int = dsp.HOP) -> DataFrame:
    """song_id, stem, sample_rate, n_frames, frame and the features of each centred frame, from blocks whose context holds half a frame at least (see
    ``sources.wav_blocks``). Cepstra are cut off relative to their signal's greatest mel band, which a grouped pass finds; no task holds a signal."""
    head = "song_id string, stem string, sample_rate int, n_frames bigint, frame bigint, centroid double, bandwidth double, rolloff double, zcr double, seconds double, "
    kept = ["song_id", "stem", "sample_rate", "n_frames", "frame", "centroid", "bandwidth", "rolloff", "zcr", "seconds"]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(size) / size)
        for pdf in parts:
            for song, stem, sr, n_channels, total, first, lead, n, raw in pdf.itertuples(index=False, name=None):
                rows, frame = centred(channels_of(raw, int(n_channels)).mean(0, dtype=float), int(total), int(first), int(lead), int(n), size, hop)
                for k in range(0, len(rows), 1024):
                    began, x = time.perf_counter(), rows[k : k + 1024]
                    s = np.abs(np.fft.rfft(x * window, axis=1))
                    c, b, r = dsp.centroid_bandwidth_rolloff(s, int(sr))
                    flips = x < 0
                    own = {"song_id": song, "stem": stem, "sample_rate": int(sr), "n_frames": 1 + int(total) // hop, "frame": frame[k : k + 1024]}
                    mel, pitch = dsp.mel_db(s, int(sr), size), dsp.chroma(s, int(sr))
                    own["seconds"] = (time.perf_counter() - began) / len(x)
                    yield pd.DataFrame(own | {"centroid": c, "bandwidth": b, "rolloff": r, "zcr": (flips[:, 1:] != flips[:, :-1]).sum(1) / size, "mel": list(mel), "chroma": list(pitch)})[[c.split()[0] for c in head.split(", ") if c] + ["mel", "chroma"]]

    def cepstra(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            found = dsp.mfcc_of(np.vstack(pdf["mel"]), pdf["top"].to_numpy()[:, None]) if len(pdf) else []
            yield pdf[kept].assign(mfcc=list(found), chroma=pdf["chroma"])

    rows = blocks.where("error is null and n > 0").select("song_id", "stem", "sample_rate", "num_channels", "num_frames", "first_frame", "lead", "n", "samples")
    made = saved(rows.mapInPandas(run, head + "mel array<double>, chroma array<double>"))
    top = made.groupBy("song_id", "stem").agg(F.max(F.array_max("mel")).alias("top"))
    return made.join(top, ["song_id", "stem"]).mapInPandas(cepstra, head + "mfcc array<double>, chroma array<double>")


def frame_at(seconds: Column, rate: Column, hop: int = dsp.HOP, n_fft: int = dsp.N_FFT) -> Column:
    """The frame whose centre lies at or before a time."""
    return F.floor(((seconds * rate).cast("long") - n_fft // 2) / hop)


def bar_frame_ranges(bars: DataFrame, songs: DataFrame, hop: int = dsp.HOP, n_fft: int = dsp.N_FFT) -> DataFrame:
    """song_id, stem, bar_index, first_frame, end_frame of bars that hold a frame. ``songs``: song_id, stem, sample_rate, n_frames."""
    first = F.greatest(F.lit(0), frame_at(F.col("start_s"), F.col("sample_rate"), hop, n_fft))
    end = F.least(F.col("n_frames"), frame_at(F.col("end_s"), F.col("sample_rate"), hop, n_fft) + 1)
    return bars.join(songs, "song_id").select("song_id", "stem", "bar_index", first.alias("first_frame"), end.alias("end_frame")).where("end_frame > first_frame")


def frames_in_bars(frames: DataFrame, ranges: DataFrame) -> DataFrame:
    """The frames of each bar; one that two bars share stands in both."""
    each = ranges.select("song_id", "stem", "bar_index", F.explode(F.sequence("first_frame", F.col("end_frame") - 1)).alias("frame"))
    return frames.join(each, ["song_id", "stem", "frame"])


def aggregate_frames(rows: DataFrame, n_mfcc: int = dsp.N_MFCC, n_chroma: int = 12) -> DataFrame:
    """Means and deviations per bar, in one pass with partial aggregation; a column seconds (of work) is summed."""
    part = lambda c, n, f: F.array(*(f(F.get(c, F.lit(i))) for i in range(n)))
    aggs = [F.avg("centroid").alias("spectral_centroid_mean"), F.stddev_pop("centroid").alias("spectral_centroid_std"), F.avg("rolloff").alias("spectral_rolloff_mean"), F.stddev_pop("rolloff").alias("spectral_rolloff_std"), F.avg("bandwidth").alias("spectral_bandwidth_mean"), F.avg("zcr").alias("zcr")]
    aggs += [part("mfcc", n_mfcc, F.avg).alias("mfcc_mean"), part("mfcc", n_mfcc, F.stddev_pop).alias("mfcc_std"), part("chroma", n_chroma, F.avg).alias("chroma_mean"), F.count(F.lit(1)).alias("frames")]
    aggs += [F.sum("seconds").alias("seconds")] if "seconds" in rows.columns else []
    return rows.groupBy("song_id", "stem", "bar_index").agg(*aggs)


def sound_energies(sounds: DataFrame) -> DataFrame:
    """The columns of ``sounds`` but samples and num_channels, rms and energy of the mean of the channels."""
    kept = [c for c in sounds.columns if c not in ("samples", "num_channels")]
    kinds = dict(sounds.dtypes)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            found = [channels_of(raw, n).mean(0, dtype=float) for raw, n in zip(pdf["samples"], pdf["num_channels"], strict=True)]
            energy = np.array([float(x @ x) for x in found])
            yield pdf[kept].assign(rms=np.sqrt(energy / np.array([max(1, len(x)) for x in found])), energy=energy)

    return sounds.mapInPandas(run, ", ".join(f"{c} {kinds[c]}" for c in kept) + ", rms double, energy double")


def precomputed_bar_features(blocks: DataFrame, sounds: DataFrame, bars: DataFrame, config: Config = Config()) -> DataFrame:
    """Features of every bar and stem from frames that are made once. ``sounds``: of ``features.bar_sounds``; ``blocks``: with half a frame of context."""
    size, hop = config.frame_length, config.hop_length
    songs = blocks.where("error is null and first_frame = 0").select("song_id", "stem", "sample_rate", (F.floor(F.col("num_frames") / hop) + 1).alias("n_frames"))
    found = aggregate_frames(frames_in_bars(frames_of(blocks, size, hop), bar_frame_ranges(bars, songs, hop, size)))
    return found.join(sound_energies(sounds), ["song_id", "stem", "bar_index"])
