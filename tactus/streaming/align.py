"""Extension: notes of a stream on the beats of a stream.

Beats and notes arrive in one stream of rows (song_id, kind, ts, ...), out of order within the watermark. A song's state holds its beats from the last one at or before the watermark on, and
the notes whose beats aren't settled. A note is settled once the watermark has passed it and the first beat after it: then its position is that of the
batch's as-of join on the same beats. Notes after a song's last beat come out with that beat's number ``wait_s`` of event time later. Rows behind the watermark are late:
a late note is placed by the beats that are still held, a late beat is left out."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUT = "song_id string, note_ix long, time_s double, beat_index long, beat_float double, held int"
_BEAT, _NOTE = "beat_index long, time_s double", "note_ix long, time_s double"


def placed(notes: np.ndarray, times: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """Number and fractional place of each time among beats (of which ``first`` came before): before the first they go on below it, after the last it is the last's number."""
    at = np.clip(np.searchsorted(times, notes, "right") - 1, 0, len(times) - 1)
    after = np.minimum(at + 1, len(times) - 1)
    gap = times[after] - times[at]
    part = np.where(gap > 0, (notes - times[at]) / np.where(gap > 0, gap, 1), 0.0)
    return at + first, at + first + part


class BeatAligner(StatefulProcessor):
    """Keeps a song's open beats and notes; times are seconds since the epoch."""

    def __init__(self, wait_s: float):
        self.wait_s = wait_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.beats = handle.getListState("beats", "time_s double")
        self.notes = handle.getListState("notes", _NOTE)
        self.gone = handle.getValueState("gone", "n long")  # beats that were settled and dropped

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows))
        new = new.assign(t=new["ts"].astype("datetime64[ns]").astype("int64") / 1e9)
        now = timerValues.getCurrentWatermarkInMs() / 1000
        beats, notes, gone = self._held()
        fresh = new[new["kind"] == "beat"]["t"].to_numpy()
        beats = np.sort(np.concatenate([beats, fresh[fresh >= (beats[0] if len(beats) and gone else -np.inf)]]))
        notes = notes + list(zip(new[new["kind"] == "note"]["note_ix"].astype("int64").tolist(), new[new["kind"] == "note"]["t"].tolist(), strict=True))
        yield self._settled(key, beats, notes, gone, now)
        for _, t in notes:
            self.handle.registerTimer(int((t + self.wait_s) * 1000) + 1)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        beats, notes, gone = self._held()
        now = timerValues.getCurrentWatermarkInMs() / 1000
        yield self._settled(key, beats, notes, gone, now, expiredTimerInfo.getExpiryTimeInMs() / 1000 - self.wait_s)

    def _held(self) -> tuple[np.ndarray, list, int]:
        gone = self.gone.get()[0] if self.gone.exists() else 0
        beats = np.array([b[0] for b in self.beats.get()]) if self.beats.exists() else np.zeros(0)
        return beats, [tuple(n) for n in self.notes.get()] if self.notes.exists() else [], int(gone)

    def _settled(self, key: Any, beats: np.ndarray, notes: list, gone: int, now: float, waited: float = -np.inf) -> pd.DataFrame:
        """The notes that can be placed by now, or have waited long enough; the state keeps the others and the beats they may need."""
        times = np.array([t for _, t in notes])
        after = np.append(beats, np.inf)[np.searchsorted(beats, times, "right")] if len(notes) else times
        ready = ((times <= now) & (after <= now)) | (times <= waited) if len(beats) else times <= waited
        index, place = placed(times[ready], beats, gone) if len(beats) and ready.any() else (np.zeros(int(ready.sum()), np.int64), np.zeros(int(ready.sum())))
        out = pd.DataFrame({"song_id": key[0], "note_ix": np.array([k for k, _ in notes], np.int64)[ready] if len(notes) else np.zeros(0, np.int64), "time_s": times[ready] if len(notes) else times, "beat_index": index, "beat_float": place})
        kept = [n for n, r in zip(notes, ready, strict=True) if not r]
        need = min([now, *(t for _, t in kept)])
        drop = max(0, int(np.searchsorted(beats, need, "right")) - 1)
        self.beats.put([(float(t),) for t in beats[drop:]]) if len(beats) > drop else self.beats.clear()
        self.notes.put([(int(k), float(t)) for k, t in kept]) if kept else self.notes.clear()
        self.gone.update((gone + drop,))
        return out.assign(held=np.int32(len(beats) - drop + len(kept)))

    def close(self) -> None:
        pass


def align_stream(rows: DataFrame, late: str = "10 seconds", wait_s: float = 60.0) -> DataFrame:
    """song_id, note_ix, time_s, beat_index, beat_float, held (rows of the song's state then) of a stream's notes. ``rows``: song_id, kind (beat or note), ts, note_ix.
    Needs a state store of column families, such as RocksDB's."""
    keyed = rows.withWatermark("ts", late).select("song_id", "kind", "ts", "note_ix").groupBy("song_id")
    return keyed.transformWithStateInPandas(BeatAligner(wait_s), OUT, "Append", "EventTime")
