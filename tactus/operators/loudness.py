"""Loudness by ITU-R BS.1770 and EBU R128 over songs that lie in blocks of samples.

Filters are recursive, so a block's output depends on all before it: yet only through the four numbers of the filter's state. A first pass gives the state that each
block reaches from silence, a scan of these few numbers along a song gives the state at each block's start, and a second pass filters all blocks at once from there.
Energies of tenths of a second come out of it, windows over which give momentary (0.4 s) and short-term (3 s) power; gates are grouped passes.

Blocks are rows (song_id, stem, channel, block, sample_rate, samples), channels from 0, weighted alike, blocks in order without gaps; null samples
count as none. Songs shorter than 0.4 s have no loudness; one whose blocks all fall below the absolute gate has -70.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tactus.functions import dsp

#: Fixed values of the standards: offset of the scale, the gates, seconds of a segment, segments of both windows.
OFFSET, ABSOLUTE, RELATIVE, RANGE_RELATIVE = -0.691, -70.0, -10.0, -20.0
PER_SECOND, MOMENTARY, SHORT_TERM = 10, 4, 30
_KEY = "song_id string, stem string, channel int, block long"
_KEYS = ["song_id", "stem", "channel", "block"]
_FILTERS: dict[int, dsp.KFilter] = {}


def _filter(sr: int) -> dsp.KFilter:
    if sr not in _FILTERS:
        _FILTERS[sr] = dsp.KFilter(sr)
    return _FILTERS[sr]


def _samples(x: object) -> np.ndarray:
    return np.zeros(0) if x is None else np.nan_to_num(np.asarray(x, float))


def weighted_segments(blocks: DataFrame) -> DataFrame:
    """song_id, stem, segment, energy, n: the K-weighted energy of all channels and the samples of one, by tenths of a second."""
    rows = blocks.select("song_id", "stem", F.col("channel").cast("int").alias("channel"), F.col("block").cast("long").alias("block"), F.col("sample_rate").cast("int").alias("sample_rate"), "samples").where("sample_rate >= 100")

    def ends(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            signals = [_samples(x) for x in pdf["samples"]]
            yield pdf[[*_KEYS, "sample_rate"]].assign(n=[len(x) for x in signals], state=[_filter(int(sr)).run(x, np.zeros(4))[1] for sr, x in zip(pdf["sample_rate"], signals, strict=True)])

    def starts(pdf: pd.DataFrame) -> pd.DataFrame:
        """The scan along a channel of a song: a row of some numbers for each block."""
        pdf, state, at, found = pdf.sort_values("block"), np.zeros(4), 0, []
        leaps: dict[tuple[int, int], np.ndarray] = {}
        for sr, n, end in zip(pdf["sample_rate"], pdf["n"], pdf["state"], strict=True):
            found.append((at, state))
            leap = leaps.setdefault((sr, n), np.linalg.matrix_power(_filter(int(sr)).a, int(n)))
            state, at = leap @ state + np.asarray(end), at + int(n)
        return pdf[_KEYS].assign(first=[f for f, _ in found], state=[s for _, s in found])

    def energies(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for song, stem, channel, sr, x, first, state in zip(*(pdf[c] for c in ("song_id", "stem", "channel", "sample_rate", "samples", "first", "state")), strict=True):
                x = _samples(x)
                if len(x):
                    y, _ = _filter(int(sr)).run(x, np.asarray(state))
                    segment = (first + np.arange(len(y))) // (sr // PER_SECOND)
                    cut = np.flatnonzero(np.append(True, np.diff(segment) > 0))
                    yield pd.DataFrame({"song_id": song, "stem": stem, "channel": channel, "segment": segment[cut], "energy": np.add.reduceat(y * y, cut), "n": np.diff(np.append(cut, len(y)))})

    reached = rows.mapInPandas(ends, _KEY + ", sample_rate int, n long, state array<double>")
    known = reached.groupBy("song_id", "stem", "channel").applyInPandas(starts, _KEY + ", first long, state array<double>")
    found = rows.join(known, _KEYS).mapInPandas(energies, "song_id string, stem string, channel int, segment long, energy double, n long")
    return found.groupBy("song_id", "stem", "segment").agg(F.sum("energy").alias("energy"), F.sum(F.when(F.col("channel") == 0, F.col("n"))).alias("n"))


def level(power: Column) -> Column:
    """Loudness of a mean square."""
    return OFFSET + 10 * F.log10(power)


def loudness(segments: DataFrame) -> DataFrame:
    """song_id, stem, integrated, range_lu, momentary_max, short_term_max, num_blocks, available. ``segments``: of ``weighted_segments``; a last one that isn't whole is left out."""
    song = Window.partitionBy("song_id", "stem")
    whole = segments.withColumn("_full", F.max("n").over(song)).where(F.col("n") == F.col("_full"))

    def windows(size: int, name: str) -> list[Column]:
        w = song.orderBy("segment").rowsBetween(0, size - 1)
        return [F.when(F.count(F.lit(1)).over(w) == size, F.sum("energy").over(w) / F.sum("n").over(w)).alias(name)]

    powers = whole.select("song_id", "stem", *windows(MOMENTARY, "m"), *windows(SHORT_TERM, "s"))
    powers = powers.select("song_id", "stem", "m", "s", level(F.col("m")).alias("lm"), level(F.col("s")).alias("ls"))
    over = lambda p, l: F.avg(F.when(F.col(l) > ABSOLUTE, F.col(p)))
    gates = powers.groupBy("song_id", "stem").agg((level(over("m", "lm")) + RELATIVE).alias("gate"), (level(over("s", "ls")) + RANGE_RELATIVE).alias("range_gate"))
    rows = powers.join(gates, ["song_id", "stem"])
    kept = lambda c, l, gate: F.when((F.col(l) > ABSOLUTE) & (F.col(l) > F.col(gate)), F.col(c))
    ends = F.percentile(kept("ls", "ls", "range_gate"), F.array(F.lit(0.1), F.lit(0.95)))  # ten values a second of a song
    out = rows.groupBy("song_id", "stem").agg(level(F.avg(kept("m", "lm", "gate"))).alias("integrated"), ends.alias("ends"), F.max("lm").alias("momentary_max"), F.max("ls").alias("short_term_max"), F.count("m").alias("num_blocks"))
    available = F.col("num_blocks") > 0
    return out.select("song_id", "stem", F.when(available, F.coalesce("integrated", F.lit(ABSOLUTE))).alias("integrated"), (F.get("ends", F.lit(1)) - F.get("ends", F.lit(0))).alias("range_lu"), "momentary_max", "short_term_max", "num_blocks", available.alias("available"))
