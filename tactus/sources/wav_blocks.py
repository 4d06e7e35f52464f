"""WAV files as blocks of frames: a data source whose partitions are byte ranges of files.

A partition holds ranges of about ``split_bytes``: a part of a long file, or several short files. A task reads a file's header and the bytes of its own blocks, so a
file of any length spreads over tasks and no row holds a whole song. Channels and the native rate are kept. A block may carry ``context`` frames of its
neighbours on both sides, for windows that reach over its ends.

Rows: song_id, stem, path, sample_rate, num_channels, num_frames (of the file), block, first_frame, lead (context frames before it), n (its own frames), samples
(little-endian 32-bit floats in [-1, 1), frame by frame, context included), error. A file without frames gives one row with n = 0; one that can't be read, one row with its error.
PCM of one to four bytes and floats of four and eight are read. Of files that share song and stem the newest counts. Paths are those of
Arrow's file systems (local and mounted folders, and object stores by URI)."""

from __future__ import annotations

import fnmatch
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "song_id string, stem string, path string, sample_rate int, num_channels int, num_frames long, block long, first_frame long, lead int, n int, samples binary, error string"
_NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
_ARROW = pa.schema([("song_id", pa.string()), ("stem", pa.string()), ("path", pa.string()), ("sample_rate", pa.int32()), ("num_channels", pa.int32()), ("num_frames", pa.int64()), ("block", pa.int64()), ("first_frame", pa.int64()), ("lead", pa.int32()), ("n", pa.int32()), ("samples", pa.binary()), ("error", pa.string())])


def located(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path there."""
    return pafs.FileSystem.from_uri(re.sub("^file:/+", "/", path) if path.startswith("file:") else path)


def names(path: str, root: str, compat: str, ids: str) -> tuple[str, str]:
    """Song and stem of a file: its folder and its name in lower case (a: no_vocals is called accompaniment). ``ids`` relative: the song is the path below
    ``root`` without its suffix, parts joined by ``_``, and the stem full_mix."""
    bare = re.sub(r"\.[^./]+$", "", path)
    if ids == "relative":
        return bare.removeprefix(root.rstrip("/") + "/").replace("/", "_"), "full_mix"
    stem = bare.rsplit("/", 1)[-1].lower()
    return path.rsplit("/", 2)[-2], "accompaniment" if compat == "a" and stem == "no_vocals" else stem


@dataclass
class Header:
    rate: int
    channels: int
    width: int
    floats: bool
    data: int
    frames: int

    @property
    def align(self) -> int:
        return self.width * self.channels


def header(f, size: int) -> Header:
    """Reads the chunks before the samples; those between are skipped, not read."""
    if f.read(4) != b"RIFF" or f.read(8)[4:] != b"WAVE":
        raise ValueError("not a WAV file")
    form, at = None, 12
    while at + 8 <= size:
        f.seek(at)
        kind, n = struct.unpack("<4sI", f.read(8))
        if kind == b"fmt ":
            raw = f.read(min(n, 40))
            code, channels, rate, _, _, bits = struct.unpack("<HHIIHH", raw[:16])
            form = (struct.unpack("<H", raw[24:26])[0] if code == 0xFFFE and len(raw) >= 26 else code, channels, rate, bits)
        elif kind == b"data":
            if not form:
                raise ValueError("no format before the samples")
            code, channels, rate, bits = form
            if code not in (1, 3) or not channels or not rate or bits // 8 not in ((1, 2, 3, 4) if code == 1 else (4, 8)):
                raise ValueError(f"unknown sample format {code} of {bits} bits")
            left = size - at - 8
            return Header(rate, channels, bits // 8, code == 3, at + 8, min(n, left) // (bits // 8 * channels) if 0 < n < 0xFFFFFFFF else left // (bits // 8 * channels))
        at += 8 + n + n % 2
    raise ValueError("no samples")


def floats(raw: bytes, width: int, is_float: bool = False) -> np.ndarray:
    if is_float:
        return np.frombuffer(raw, f"<f{width}").astype("<f4")
    if width == 1:
        return ((np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128).astype("<f4")
    if width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        return (((b[:, 0] << 8 | b[:, 1] << 16 | b[:, 2] << 24) >> 8) / float(1 << 23)).astype("<f4")
    return (np.frombuffer(raw, f"<i{width}") / float(1 << (8 * width - 1))).astype("<f4")


class Ranges(InputPartition):
    """Byte ranges (path, size, start, end) of files; the first range of a file speaks for the file."""

    def __init__(self, ranges: list[tuple[str, int, int, int]]):
        super().__init__(ranges)
        self.ranges = ranges


class WavReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root = options["path"]
        self.pattern, self.compat, self.ids = options.get("pattern", "*.wav"), options.get("compat", "a"), options.get("ids", "folder")
        self.block, self.context, self.split = int(options.get("block_frames", 1 << 16)), int(options.get("context", 0)), int(options.get("split_bytes", 4 << 20))

    def partitions(self) -> list[Ranges]:
        fs, root = located(self.root)
        newest: dict[tuple[str, str], tuple] = {}
        for f in fs.get_file_info(pafs.FileSelector(root, recursive=True)):
            if f.type == pafs.FileType.File and fnmatch.fnmatch(f.path.rsplit("/", 1)[-1].lower(), self.pattern.lower()):
                key, own = names(f.path, root, self.compat, self.ids), (f.mtime_ns or 0, f.path, f.size)
                newest[key] = max(newest.get(key, own), own)
        out, held = [], 0
        for _, path, size in sorted(newest.values(), key=lambda x: x[1]):
            for start in range(0, max(1, size), self.split):
                end = min(size, start + self.split)
                if not out or held + end - start > self.split:
                    out.append([])
                    held = 0
                out[-1].append((path, size, start, end))
                held += end - start
        return [Ranges(x) for x in out] or [Ranges([])]

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        fs, root = located(self.root)
        for path, size, start, end in partition.ranges:
            song, stem = names(path, root, self.compat, self.ids)
            rows = self._rows(fs, path, size, start, end)
            try:
                for row in rows:
                    yield self._batch((song, stem, path, *row))
            except (ValueError, OSError, struct.error) as e:  # any fault of the file is data here
                if start == 0:
                    yield self._batch((song, stem, path, None, None, None, None, None, None, None, None, f"{type(e).__name__}: {e}"))

    def _rows(self, fs: pafs.FileSystem, path: str, size: int, start: int, end: int) -> Iterator[tuple]:
        with fs.open_input_file(path) as f:
            h = header(f, size)
            if start == 0 and not h.frames:
                yield h.rate, h.channels, 0, 0, 0, 0, 0, b"", None
            step = self.block * h.align
            first = max(0, -(-(start - h.data) // step))  # blocks that begin in the range
            for k in range(first, -(-h.frames // self.block)):
                if h.data + k * step >= end:
                    break
                a, b = k * self.block, min((k + 1) * self.block, h.frames)
                lead, tail = min(a, self.context), min(h.frames - b, self.context)
                raw = f.read_at((b + tail - a + lead) * h.align, h.data + (a - lead) * h.align)
                yield h.rate, h.channels, h.frames, k, a, lead, b - a, floats(raw, h.width, h.floats).tobytes(), None

    def _batch(self, row: tuple) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _ARROW.types, strict=True)], schema=_ARROW)


class WavBlocks(DataSource):
    @classmethod
    def name(cls) -> str:
        return "wav_blocks"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WavReader:
        return WavReader(self.options)


def read_blocks(spark: SparkSession, path: str, **options: object) -> DataFrame:
    """The blocks of the WAV files under ``path``; options: pattern, block_frames, context, split_bytes, compat, ids."""
    spark.dataSource.register(WavBlocks)
    return spark.read.format("wav_blocks").options(**{k: str(v) for k, v in options.items()}).load(path)


def channels_of(samples: bytes, num_channels: int) -> np.ndarray:
    """Samples (channel, frame) of a row's bytes."""
    return np.frombuffer(samples, "<f4").reshape(-1, num_channels).T
