"""Signal features as Arrow batches: bars' slices, features of slices, analysis of songs, preprocessing.

A signal is a row (song_id, stem, sample_rate, samples). A bar's slice is cut in the JVM before Python sees it, so that a task holds slices of
a batch and not songs; whole-song kernels (tempo, trimming) take one song at a time."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tactus.config import Config
from tactus.functions import dsp
from tactus.functions.music import time_to_sample
from tactus.functions.tables import RECORD
from tactus.sources.wav_blocks import SCHEMA, channels_of

#: Frames around a block that its analysis needs.
ANALYSIS_CONTEXT = dsp.N_FFT // 2


def bar_slices(signals: DataFrame, bars: DataFrame, rounding: str = "round") -> DataFrame:
    """The samples of each bar and stem: signals x the song's bars, slices without samples left out."""
    at = lambda t: F.least(F.greatest(time_to_sample(t, F.col("sample_rate"), rounding), F.lit(0)), F.size("samples"))
    # a song's bars go to its row, and slices come out of it: a join on the song would copy all samples for each bar
    listed = bars.groupBy("song_id").agg(F.collect_list(F.struct("bar_index", "start_s", "end_s")).alias("_bars"))
    cut = F.transform("_bars", lambda k: F.struct(k["bar_index"].alias("bar_index"), k["start_s"].alias("start_s"), k["end_s"].alias("end_s"), at(k["start_s"]).alias("a"), at(k["end_s"]).alias("b")))
    own = F.transform(F.filter(cut, lambda k: k["b"] > k["a"]), lambda k: F.struct(k["bar_index"].alias("bar_index"), k["start_s"].alias("start_s"), k["end_s"].alias("end_s"), F.slice("samples", k["a"].cast("int") + 1, (k["b"] - k["a"]).cast("int")).alias("samples")))
    return signals.join(listed, "song_id").select("song_id", "stem", "sample_rate", F.inline(own))


def slice_features(slices: DataFrame, extractor: Callable[[np.ndarray, int], dict] = dsp.features, record: str = RECORD) -> DataFrame:
    """The columns of ``slices`` but its samples, and its features. ``extractor``: samples and rate to the fields of ``record``."""
    kept = [c for c in slices.columns if c != "samples"]
    kinds = dict(slices.dtypes)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            found = pd.DataFrame([extractor(x, r) for x, r in zip(pdf["samples"], pdf["sample_rate"], strict=True)], columns=[c.split()[0] for c in record.split(", ")])
            yield pd.concat([pdf[kept].reset_index(drop=True), found], axis=1)

    return slices.mapInPandas(run, ", ".join(f"{c} {kinds[c]}" for c in kept) + ", " + record)


def centred(x: np.ndarray, total: int, first: int, lead: int, n: int, size: int, hop: int) -> tuple[np.ndarray, np.ndarray]:
    """The frames of a signal of ``total`` samples whose centres lie in a block, the last block's also at the signal's end, and their numbers. ``x``: the block's n
    samples from ``first`` with ``lead`` and as many as there are up to half a frame after them; beyond both ends of the signal are zeros."""
    start, end = first - lead, first + n
    frame = np.arange(-(-first // hop), (total // hop if end >= total else (end - 1) // hop) + 1)
    if not len(frame):
        return np.zeros((0, size)), frame
    a, b = frame[0] * hop - size // 2, frame[-1] * hop + size // 2
    x = np.pad(x, (max(0, start - a), max(0, b - (start + len(x)))))
    return np.lib.stride_tricks.sliding_window_view(x[max(0, a - start) :], size)[::hop][: len(frame)], frame


def analyse_blocks(blocks: DataFrame) -> DataFrame:
    """song_id, stem, duration_s, tempo_bpm, beat_times, seconds (of work) of signals in blocks with ``ANALYSIS_CONTEXT`` frames around (see ``sources.wav_blocks``).

    Spectra, by far the most work, are made block by block; a song's mel bands, some thirty kilobytes a second of sound, meet in one task for the
    beats' path, so no row or task holds a song's samples. The result is that of the whole signal."""

    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(dsp.N_FFT) / dsp.N_FFT)
        for batch in batches:
            out: list[list] = [[], []]
            for sr, n_channels, total, first, lead, n, raw in zip(*(batch[c].to_pylist() for c in ("sample_rate", "num_channels", "num_frames", "first_frame", "lead", "n", "samples")), strict=True):
                began, db = time.perf_counter(), np.zeros((0, dsp.N_MELS))
                if total >= dsp.N_FFT:
                    rows, _ = centred(channels_of(raw, n_channels).mean(0, dtype=float), total, first, lead, n, dsp.N_FFT, dsp.HOP)
                    db = np.concatenate([db, *(dsp.mel_db(np.abs(np.fft.rfft(rows[k : k + 1024] * window, axis=1)), sr) for k in range(0, len(rows), 1024))])
                out[0].append(db.astype("<f8").tobytes())
                out[1].append(time.perf_counter() - began)
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("song_id", "stem", "sample_rate", "num_frames", "block")), pa.array(out[0], pa.binary()), pa.array(out[1])], ["song_id", "stem", "sample_rate", "num_frames", "block", "bands", "seconds"])

    def path(pdf: pd.DataFrame) -> pd.DataFrame:
        began, sr = time.perf_counter(), int(pdf["sample_rate"].iloc[0])
        db = np.frombuffer(b"".join(pdf.sort_values("block")["bands"]), "<f8").reshape(-1, dsp.N_MELS)
        tempo, beats = dsp.track(dsp.onset_strength(db), sr / dsp.HOP) if len(db) and np.isfinite(db).all() else (0.0, [])
        row = (pdf["song_id"].iloc[0], pdf["stem"].iloc[0], pdf["num_frames"].iloc[0] / sr, float(tempo), beats, float(pdf["seconds"].sum()) + time.perf_counter() - began)
        return pd.DataFrame([row], columns=["song_id", "stem", "duration_s", "tempo_bpm", "beat_times", "seconds"])

    rows = blocks.where("error is null").select("song_id", "stem", "sample_rate", "num_channels", "num_frames", "block", "first_frame", "lead", "n", "samples")
    made = rows.mapInArrow(bands, "song_id string, stem string, sample_rate int, num_frames long, block long, bands binary, seconds double")
    return made.groupBy("song_id", "stem").applyInPandas(path, "song_id string, stem string, duration_s double, tempo_bpm double, beat_times array<double>, seconds double")


def as_blocks(signals: DataFrame, context: int = 0, block_frames: int = 1 << 16) -> DataFrame:
    """Whole signals (song_id, stem, sample_rate, samples) as the blocks of ``sources.wav_blocks``."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for song, stem, sr, x in zip(pdf["song_id"], pdf["stem"], pdf["sample_rate"], pdf["samples"], strict=True):
                for a in range(0, max(1, len(x)), block_frames):
                    b, lead = min(len(x), a + block_frames), min(a, context)
                    row = (song, stem, None, int(sr), 1, len(x), a // block_frames, a, lead, b - a, np.asarray(x[a - lead : b + context], "<f4").tobytes(), None)
                    yield pd.DataFrame([row], columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return signals.select("song_id", "stem", "sample_rate", "samples").mapInPandas(run, SCHEMA)


def bar_sounds(blocks: DataFrame, bars: DataFrame) -> DataFrame:
    """song_id, stem, bar_index, start_s, end_s, sample_rate, num_channels, samples: the frames of each bar and stem at the native rate, with all channels, from blocks
    without context. A song's bars go to its blocks' rows, each block gives its pieces of them, and a bar's pieces, two as a rule, are put together again."""
    listed = bars.groupBy("song_id").agg(F.sort_array(F.collect_list(F.struct("start_s", "end_s", "bar_index"))).alias("bars"))
    rows = blocks.where("error is null and n > 0").select("song_id", "stem", "sample_rate", "num_channels", "num_frames", "first_frame", "n", "samples").join(listed, "song_id")
    names = ("song_id", "stem", "bar_index", "start_s", "end_s", "sample_rate", "num_channels", "first", "samples")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                song, stem, sr, n_channels, total, first, n, raw = (batch[c][i].as_py() for c in ("song_id", "stem", "sample_rate", "num_channels", "num_frames", "first_frame", "n", "samples"))
                spans, raw = batch["bars"][i].values, memoryview(raw)
                start, end, index = (spans.field(c).to_numpy() for c in ("start_s", "end_s", "bar_index"))
                a, b = (np.clip(np.rint(t * sr), 0, total).astype(int) for t in (start, end))
                a, b = np.maximum(a, first), np.minimum(b, first + n)
                met = np.flatnonzero(b > a)
                pieces = [bytes(raw[4 * n_channels * (a[k] - first) : 4 * n_channels * (b[k] - first)]) for k in met]
                m = len(met)
                columns = [pa.array([song] * m, pa.string()), pa.array([stem] * m, pa.string()), pa.array(index[met], pa.int64()), pa.array(start[met]), pa.array(end[met]), pa.array([sr] * m, pa.int32()), pa.array([n_channels] * m, pa.int32()), pa.array(a[met], pa.int64()), pa.array(pieces, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names)

    pieces = rows.mapInArrow(cut, "song_id string, stem string, bar_index long, start_s double, end_s double, sample_rate int, num_channels int, first long, samples binary")
    keys = [c for c in names if c not in ("first", "samples")]
    whole = F.aggregate(F.sort_array(F.collect_list(F.struct("first", "samples"))), F.lit(b""), lambda acc, x: F.concat(acc, x["samples"]))
    return pieces.groupBy(*keys).agg(whole.alias("samples"))


def sound_features(sounds: DataFrame, extractor: Callable[[np.ndarray, int], dict] = dsp.features, record: str = RECORD) -> DataFrame:
    """The columns of ``sounds`` but samples and num_channels, the features of the mean of their channels, and seconds (of work). ``extractor``: samples and rate to the fields of ``record``."""
    kept = [c for c in sounds.columns if c not in ("samples", "num_channels")]
    kinds, fields = dict(sounds.dtypes), [c.split()[0] for c in record.split(", ")]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = []
            for raw, n_channels, sr in zip(pdf["samples"], pdf["num_channels"], pdf["sample_rate"], strict=True):
                began = time.perf_counter()
                found = extractor(channels_of(raw, n_channels).mean(0, dtype=float), int(sr))
                rows.append([*(found[c] for c in fields), time.perf_counter() - began])
            yield pd.concat([pdf[kept].reset_index(drop=True), pd.DataFrame(rows, columns=[*fields, "seconds"])], axis=1)

    return sounds.mapInPandas(run, ", ".join(f"{c} {kinds[c]}" for c in kept) + f", {record}, seconds double")


def analyse(signals: DataFrame) -> DataFrame:
    """song_id, stem, duration_s, tempo_bpm, beat_times of each signal."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = []
            for song, stem, sr, x in zip(pdf["song_id"], pdf["stem"], pdf["sample_rate"], pdf["samples"], strict=True):
                x = np.zeros(0) if x is None else np.asarray(x, float)
                tempo, beats = dsp.tempo_and_beats(x, int(sr)) if sr and sr > 0 and np.isfinite(x).all() else (0.0, [])
                rows.append((song, stem, len(x) / sr if sr else 0.0, float(tempo), beats))
            yield pd.DataFrame(rows, columns=["song_id", "stem", "duration_s", "tempo_bpm", "beat_times"])

    return signals.select("song_id", "stem", "sample_rate", "samples").mapInPandas(run, "song_id string, stem string, duration_s double, tempo_bpm double, beat_times array<double>")


def beats_of(analysis: DataFrame) -> DataFrame:
    return analysis.select("song_id", "tempo_bpm", F.posexplode("beat_times").alias("beat_index", "time_s")).withColumn("beat_index", F.col("beat_index").cast("long"))


def preprocess(signals: DataFrame, config: Config) -> DataFrame:
    """Resample, trim silence, normalise the peak, in this order; trim_offset_s is what trimming cut from the front."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = []
            for song, stem, sr, x in zip(pdf["song_id"], pdf["stem"], pdf["sample_rate"], pdf["samples"], strict=True):
                y, cut = dsp.trim(dsp.resample(x, int(sr), config.analysis_sr), config.analysis_sr, config.silence_threshold_db, config.keep_silence_ms)
                top = np.abs(y).max() if len(y) else 0.0
                rows.append((song, stem, config.analysis_sr, (y / top if config.normalize and top > 0 else y).astype(np.float32), cut))
            yield pd.DataFrame(rows, columns=["song_id", "stem", "sample_rate", "samples", "trim_offset_s"])

    return signals.select("song_id", "stem", "sample_rate", "samples").mapInPandas(run, "song_id string, stem string, sample_rate int, samples array<float>, trim_offset_s double")
