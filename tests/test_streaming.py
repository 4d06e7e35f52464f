"""The streamed as-of join against the batch's, and its state."""

import random

import numpy as np
import pytest

from tactus.operators import align as batch
from tactus.streaming import align
from tactus.streaming import bars as streaming
from pyspark.sql import functions as F


def test_places_equal_the_asof_join():
    r = np.random.default_rng(0)
    beats, notes = np.sort(r.uniform(0, 10, 12)), r.uniform(-1, 11, 50)
    index, place = align.placed(notes, beats, 5)
    for t, k, p in zip(notes, index, place, strict=True):
        at = max([i for i in range(12) if beats[i] <= t], default=0)
        assert k == at + 5 and p == pytest.approx(at + 5 + ((t - beats[at]) / (beats[at + 1] - beats[at]) if at < 11 else 0))


def test_streamed_alignment_equals_the_batch(spark, tmp_path):
    """Rows out of order in several files: places of the batch's join on the same rows, with a state that stays small."""
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        r, rows = random.Random(1), []
        for song in ("a", "b"):
            t = 1_700_000_000.0
            for k in range(240):
                t += r.choice([0.4, 0.5, 0.6])
                rows.append((song, "beat", t, None))
                rows += [(song, "note", t + r.random() * 0.39, 1000 * k + j) for j in range(2)]
        rows.sort(key=lambda x: x[2] + r.uniform(0, 3))  # at most three seconds late
        rows += [(s, "beat", 1_700_001_000.0 + k, None) for s in ("a", "b") for k in range(2)]
        schema = "song_id string, kind string, t double, note_ix long"
        whole = spark.createDataFrame(rows, schema)
        cuts = [*range(0, len(rows) - 4, 240), len(rows) - 4, len(rows)]
        source = tmp_path / "in"
        source.mkdir()
        stream = spark.readStream.schema("song_id string, kind string, ts timestamp, note_ix long").option("maxFilesPerTrigger", 1).parquet(str(source))
        query = align.align_stream(stream, "5 seconds", 30.0).writeStream.format("memory").queryName("placed").outputMode("append").option("checkpointLocation", str(tmp_path / "check")).start()
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            spark.createDataFrame(rows[a:b], schema).select("song_id", "kind", F.timestamp_micros((F.col("t") * 1e6).cast("long")).alias("ts"), "note_ix").coalesce(1).write.mode("append").parquet(str(source))
            query.processAllAvailable()
        query.processAllAvailable()
        query.stop()
        got = {(x["song_id"], x["note_ix"]): (x["beat_index"], x["beat_float"]) for x in spark.table("placed").collect()}
        held = spark.table("placed").agg(F.max("held")).first()[0]
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass") if before is None else spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    beats = whole.where("kind = 'beat'").selectExpr("song_id", "t as time_s", "row_number() over (partition by song_id order by t) - 1 as beat_index").selectExpr("song_id", "cast(beat_index as long) as beat_index", "time_s")
    notes = whole.where("kind = 'note'").selectExpr("song_id", "note_ix", "t as start_s")
    want = {(x["song_id"], x["note_ix"]): (x["p_index"], x["p"]) for x in batch.beat_position(notes, beats, "start_s", "p").collect()}
    assert got.keys() == want.keys()
    for k, (index, place) in want.items():
        assert got[k][0] == index and got[k][1] == pytest.approx(place, abs=1e-4)
    assert held < 200  # of 720 rows a song: the watermark follows by a file of 120 rows a song


def test_streamed_phrases(spark, tmp_path):
    rows = [("s", "v", f"2024-01-01 00:00:{t:02d}", 60 + t, 90) for t in (0, 1, 2, 20, 21, 50)]
    spark.createDataFrame(rows, "song_id string, stem string, t string, pitch int, velocity int").selectExpr("song_id", "stem", "cast(t as timestamp) as ts", "pitch", "velocity").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "in")).schema).parquet(str(tmp_path / "in"))
    q = streaming.phrases(stream, 5.0).writeStream.format("memory").queryName("phrases").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r["num_notes"], r["pitch_min"]) for r in spark.table("phrases").collect()) == [(1, 110), (2, 80), (3, 60)]
