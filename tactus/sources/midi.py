"""Standard MIDI files as notes, and notes as MIDI bytes."""

from __future__ import annotations

import struct
import time
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tactus import schemas


def _number(data: bytes, at: int) -> tuple[int, int]:
    value = 0
    while True:
        byte = data[at]
        at += 1
        value = value << 7 | byte & 0x7F
        if byte < 0x80:
            return value, at


def _events(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(tick, status, data) of one track; meta events have status 0xFF and their kind first."""
    at, tick, status = 0, 0, 0
    while at < len(data):
        delta, at = _number(data, at)
        tick += delta
        if data[at] & 0x80:
            status = data[at]
            at += 1
        if status == 0xFF:
            kind, (size, start) = data[at], _number(data, at + 1)
            yield tick, status, bytes([kind]) + data[start : start + size]
            at = start + size
        elif status in (0xF0, 0xF7):
            size, start = _number(data, at)
            at = start + size
        else:
            size = 1 if status & 0xF0 in (0xC0, 0xD0) else 2
            yield tick, status, data[at : at + size]
            at += size


#: Notes after which a task hands over what it has.
ROWS_AT_ONCE = 10_000


def named(notes: list[dict], compat: str) -> list[dict]:
    """a: an instrument without a name is called by its number. b: names stay as they are, and there is no duration."""
    if compat == "a":
        return [n | {"instrument_name": n["instrument_name"] or f"Instrument_{n['instrument_index']}"} for n in notes]
    return [n | {"dur_s": None} for n in notes]


def parse(content: bytes) -> tuple[list[dict], list[tuple[float, float]]]:
    """Notes in order of track and time, and the tempo map as (time_s, bpm). A note-on of velocity 0 ends a note."""
    if content[:4] != b"MThd":
        raise ValueError("not a MIDI file")
    size, _, _, division = struct.unpack(">IHHh", content[4:14])
    # a negative division counts frames a second and ticks a frame, and tempo events don't apply
    ticks_a_second = -(division >> 8) * (division & 0xFF) if division < 0 else None
    at, tracks = 8 + size, []
    while at + 8 <= len(content):
        kind, n = content[at : at + 4], struct.unpack(">I", content[at + 4 : at + 8])[0]
        if kind == b"MTrk":
            tracks.append(list(_events(content[at + 8 : at + 8 + n])))
        at += 8 + n
    changes = sorted((t, int.from_bytes(d[1:4], "big")) for track in tracks for t, s, d in track if s == 0xFF and d[0] == 0x51)
    marks = [(0, 0.0, 500_000)]
    for t, us in changes if division > 0 else ():
        t0, s0, us0 = marks[-1]
        marks.append((t, s0 + (t - t0) * us0 / 1e6 / division, us))

    def seconds(tick: int) -> float:
        if ticks_a_second:
            return tick / ticks_a_second
        t0, s0, us0 = next(m for m in reversed(marks) if m[0] <= tick)
        return s0 + (tick - t0) * us0 / 1e6 / division

    notes, number = [], 0
    for track in tracks:
        name, program, open_, own = "", {}, {}, {}
        for tick, status, d in track:
            channel = status & 0x0F
            if status == 0xFF:
                if d[0] == 3:
                    name = d[1:].decode("latin-1")
            elif status & 0xF0 == 0xC0:
                program[channel] = d[0]
            elif status & 0xF0 == 0x90 and d[1]:
                open_.setdefault((channel, d[0]), []).append((tick, d[1]))
            elif status & 0xF0 in (0x80, 0x90) and open_.get((channel, d[0])):
                began, velocity = open_[channel, d[0]].pop(0)
                key = (channel, program.get(channel, 0))
                if key not in own:
                    own[key] = number
                    number += 1
                a, b = seconds(began), seconds(tick)
                notes.append({"instrument_index": own[key], "instrument_name": name, "program": key[1], "is_drum": channel == 9, "pitch": d[0], "velocity": velocity, "start_s": a, "end_s": b, "dur_s": b - a})
    tempos = [(s, 60e6 / us) for _, s, us in marks[1:]] or [(0.0, 120.0)]
    return notes, tempos


def _size(value: int) -> bytes:
    out = [value & 0x7F]
    while value := value >> 7:
        out.append(value & 0x7F | 0x80)
    return bytes(reversed(out))


def build(notes: list[tuple[int, int, float, float]], tempo_bpm: float = 120.0, program: int = 0, division: int = 480) -> bytes:
    """A file of one track from (pitch, velocity, start_s, end_s)."""
    tick = lambda s: max(0, round(s * tempo_bpm / 60 * division))
    events = [(tick(s), 1, bytes([0x90, p, max(1, v)])) for p, v, s, _ in notes] + [(max(tick(s) + 1, tick(e)), 0, bytes([0x80, p, 0])) for p, _, s, e in notes]
    out, last = b"\x00\xff\x51\x03" + round(60e6 / tempo_bpm).to_bytes(3, "big") + bytes([0, 0xC0, program]), 0
    for t, _, data in sorted(events):
        out += _size(t - last) + data
        last = t
    out += b"\x00\xff\x2f\x00"
    return b"MThd" + struct.pack(">IHHh", 6, 0, 1, division) + b"MTrk" + struct.pack(">I", len(out)) + out


def notes_of(files: DataFrame, compat: str = "a") -> DataFrame:
    """Notes of rows (song_id, stem, content), numbered in order as note_ix; a file that can't be parsed has none; ``read_scores`` gives its error."""
    fields = [c.split()[0] for c in schemas.NOTES.split(", ")[2:]]

    def table(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["song_id", "stem", *fields, "note_ix"])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []  # of many files, as a table each costs far more than its notes
        for pdf in parts:
            for song, stem, content in zip(pdf["song_id"], pdf["stem"], pdf["content"], strict=True):
                try:
                    found = named(parse(content)[0], compat)
                except (ValueError, IndexError, struct.error):
                    continue
                rows.extend((song, stem, *(n[c] for c in fields), k) for k, n in enumerate(found))
                if len(rows) >= ROWS_AT_ONCE:
                    yield table(rows)
                    rows = []
        if rows:
            yield table(rows)

    return files.select("song_id", "stem", "content").mapInPandas(run, schemas.NOTES + ", note_ix bigint")


def read_scores(files: DataFrame, compat: str = "a") -> DataFrame:
    """A row per file (song_id, stem, content): its notes, an array with note_ix, or the error of a file that can't be parsed, and seconds (of work). Each file is parsed once."""
    names = [c.split()[0] for c in schemas.NOTES.split(", ")[2:]]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = []
            for song, stem, content in zip(pdf["song_id"], pdf["stem"], pdf["content"], strict=True):
                began = time.perf_counter()
                try:
                    notes, error = [{c: n.get(c) for c in names} | {"note_ix": k} for k, n in enumerate(named(parse(content)[0], compat))], None
                except (ValueError, IndexError, struct.error) as e:
                    notes, error = [], f"{type(e).__name__}: {e}"
                rows.append((song, stem, notes, error, time.perf_counter() - began))
            yield pd.DataFrame(rows, columns=["song_id", "stem", "notes", "error", "seconds"])

    fields = ", ".join(f"{c.split()[0]}: {c.split()[1]}" for c in schemas.NOTES.split(", ")[2:])
    return files.select("song_id", "stem", "content").mapInPandas(run, f"song_id string, stem string, notes array<struct<{fields}, note_ix: bigint>>, error string, seconds double")


def tempo_map_of(files: DataFrame) -> DataFrame:
    """song_id, stem, tempo_map (of time_s, tempo_bpm), error."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = []
            for song, stem, content in zip(pdf["song_id"], pdf["stem"], pdf["content"], strict=True):
                try:
                    rows.append((song, stem, [{"time_s": s, "tempo_bpm": b} for s, b in parse(content)[1]], None))
                except (ValueError, IndexError, struct.error) as e:
                    rows.append((song, stem, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["song_id", "stem", "tempo_map", "error"])

    return files.select("song_id", "stem", "content").mapInPandas(run, "song_id string, stem string, tempo_map array<struct<time_s:double,tempo_bpm:double>>, error string")


def with_midi(notes: DataFrame, tempo_bpm: float = 120.0) -> DataFrame:
    """song_id, stem, content: a MIDI file for each stem's notes. A stem is one file, so its notes meet in one task."""

    def table(files: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*files, strict=True), (pa.string(), pa.string(), pa.binary()), strict=True)], ["song_id", "stem", "content"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the files that end in a batch leave together: a call and a table for each cost far more than its notes
        last, own = None, []
        for batch in batches:
            files = []
            columns = (batch[c].to_pylist() for c in ("song_id", "stem", "pitch", "velocity", "start_s", "end_s"))
            for song, stem, *note in zip(*columns, strict=True):
                if (song, stem) != last and own:
                    files.append((*last, build(own, tempo_bpm)))
                    own = []
                last = (song, stem)
                own.append(tuple(note))
            if files:
                yield table(files)
        if own:
            yield table([(*last, build(own, tempo_bpm))])

    rows = notes.select("song_id", "stem", "pitch", "velocity", "start_s", "end_s").where(F.col("pitch").between(0, 127))
    return rows.repartition("song_id", "stem").sortWithinPartitions("song_id", "stem").mapInArrow(run, "song_id string, stem string, content binary")
