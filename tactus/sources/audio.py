"""WAV files as signals, and signals as WAV bytes or files."""

from __future__ import annotations

import io
import re
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tactus import schemas


def decode(content: bytes) -> tuple[int, np.ndarray]:
    """Rate and mono samples in [-1, 1) of PCM with one to four bytes a sample."""
    rate, x = decode_channels(content)
    return rate, x.mean(0)


def decode_channels(content: bytes) -> tuple[int, np.ndarray]:
    """Rate and samples (channel, time) as they lie in the file."""
    with wave.open(io.BytesIO(content)) as w:
        width, channels, rate, raw = w.getsampwidth(), w.getnchannels(), w.getframerate(), w.readframes(w.getnframes())
    if width == 1:
        x = (np.frombuffer(raw, np.uint8).astype(float) - 128) / 128
    elif width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((b[:, 0] << 8 | b[:, 1] << 16 | b[:, 2] << 24) >> 8) / float(1 << 23)
    else:
        x = np.frombuffer(raw, f"<i{width}") / float(1 << (8 * width - 1))
    return rate, x.reshape(-1, channels).T


def encode(samples: np.ndarray, rate: int) -> bytes:
    """16-bit PCM of mono samples, or of channels as rows."""
    x = np.stack([np.asarray(c, float) for c in samples]) if len(samples) and np.ndim(samples[0]) else np.asarray(samples, float)[None]
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(len(x))
        w.setsampwidth(2)
        w.setframerate(int(rate))
        w.writeframes((np.clip(x.T, -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def signals_of(files: DataFrame) -> DataFrame:
    """Signals of rows (song_id, stem, content); a file that can't be read gives a row with its error and no samples."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = []
            for song, stem, content in zip(pdf["song_id"], pdf["stem"], pdf["content"], strict=True):
                try:
                    rate, x = decode(content)
                    rows.append((song, stem, rate, x.astype(np.float32), None))
                except Exception as e:  # any fault of the file is data here
                    rows.append((song, stem, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["song_id", "stem", "sample_rate", "samples", "error"]).astype({"sample_rate": "Int32"})

    return files.select("song_id", "stem", "content").mapInPandas(run, schemas.SIGNAL)


def list_files(spark: SparkSession, path: str, pattern: str = "*.wav", compat: str = "a", ids: str = "folder") -> DataFrame:
    """song_id, stem, path: the folder is the song, the file name its stem in lower case (a: no_vocals is called accompaniment); the newest of files that
    share both stays. ``ids`` relative: the song is the path below ``path`` without its suffix, parts joined by ``_``. Contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    name = F.lower(F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1))
    stem = F.when(name == "no_vocals", "accompaniment").otherwise(name) if compat == "a" else name
    song = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    if ids == "relative":
        root = re.sub("^file:/*", "/", path).rstrip("/") + "/"
        below = F.substring_index(F.concat(F.lit("/"), F.col("path")), root, -1)
        song, stem = F.translate(F.regexp_replace(below, r"\.[^./]+$", ""), "/", "_"), F.lit("full_mix")
    rows = files.select(song.alias("song_id"), stem.alias("stem"), "path", "modificationTime")
    return rows.groupBy("song_id", "stem").agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path"))


def read_files(spark: SparkSession, path: str, pattern: str = "*.wav", compat: str = "a", ids: str = "folder") -> DataFrame:
    """``list_files`` with content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return list_files(spark, path, pattern, compat, ids).join(files.select("path", "content"), "path")


def with_wav(signals: DataFrame) -> DataFrame:
    """The columns of ``signals`` but samples, and content, the WAV bytes."""
    kept = [c for c in signals.columns if c != "samples"]
    kinds = dict(signals.dtypes)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            yield pdf[kept].assign(content=[encode(x, r) for x, r in zip(pdf["samples"], pdf["sample_rate"], strict=True)])

    return signals.mapInPandas(run, ", ".join(f"{c} {kinds[c]}" for c in kept) + ", content binary")
