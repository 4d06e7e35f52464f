"""Files, signals and whole songs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tactus.config import Config
from tactus.functions import dsp, flatten, music, signals
from tactus.operators import analytics, batch, graph
from tactus.plans import song
from tactus.sinks import reports
from tactus.sources import audio, code, midi
from tactus.streaming import bars as streaming


def clicks(seconds=8.0, bpm=120, sr=22050):
    x = np.random.default_rng(0).normal(0, 0.01, int(seconds * sr))
    pulse = np.hanning(int(0.02 * sr)) * 0.9
    for t in np.arange(0, seconds - 0.1, 60 / bpm):
        x[int(t * sr) : int(t * sr) + len(pulse)] += pulse
    return np.clip(x, -1, 1)


def test_tempo_of_clicks_and_silence():
    tempo, beats = dsp.tempo_and_beats(clicks(), 22050)
    assert tempo == pytest.approx(120, abs=4) and 12 <= len(beats) <= 17 and np.median(np.diff(beats)) == pytest.approx(0.5, abs=0.03)
    assert dsp.tempo_and_beats(np.zeros(22050 * 3), 22050) == (0.0, [])


def test_features_of_a_sine_and_of_nothing():
    x = np.sin(2 * np.pi * 440 * np.arange(22050) / 22050)
    f = dsp.features(x, 22050)
    assert f["rms"] == pytest.approx(1 / np.sqrt(2), abs=1e-3) and int(np.argmax(f["chroma_mean"])) == 9 and 400 < f["spectral_centroid_mean"] < 900
    assert all(np.isfinite(v).all() for v in map(np.asarray, f.values()))
    assert dsp.features(np.zeros(0), 22050)["mfcc_mean"] == [0.0] * 13
    assert all(np.isfinite(np.asarray(v)).all() for v in dsp.features(np.ones(3), 22050).values())


def test_trim_and_resample():
    x = np.concatenate([np.zeros(22050), np.sin(np.arange(22050)), np.zeros(22050)])
    y, cut = dsp.trim(x, 22050)
    assert 0.7 < cut < 1.0 and len(y) < len(x) and len(dsp.trim(np.zeros(100), 22050)[0]) == 100
    assert len(dsp.resample(x, 22050, 11025)) == len(x) // 2


def test_midi_round_trip_and_faults():
    rows = [(60, 100, 0.0, 0.5), (64, 90, 0.5, 1.0), (60, 80, 1.0, 2.0)]
    found, tempo = midi.parse(midi.build(rows))
    assert [(n["pitch"], n["velocity"], round(n["start_s"], 3), round(n["end_s"], 3)) for n in found] == rows and tempo == [(0.0, 120.0)]
    with pytest.raises(ValueError, match="MIDI"):
        midi.parse(b"nothing")


def test_wav_round_trip_and_faulty_file(spark):
    rate, x = audio.decode(audio.encode(np.array([0.0, 0.5, -1.0, 2.0]), 8000))
    assert rate == 8000 and np.allclose(x, [0, 0.5, -1, 1], atol=1e-4)
    rows = spark.createDataFrame([("a", "x", bytearray(audio.encode(np.zeros(4), 8000))), ("b", "x", bytearray(b"no"))], "song_id string, stem string, content binary")
    got = {r["song_id"]: r for r in audio.signals_of(rows).collect()}
    assert len(got["a"]["samples"]) == 4 and got["b"]["samples"] is None and got["b"]["error"]


def test_song_run(spark, tmp_path):
    (tmp_path / "in" / "one").mkdir(parents=True)
    (tmp_path / "in" / "one" / "full_mix.wav").write_bytes(audio.encode(clicks(), 22050))
    (tmp_path / "in" / "one" / "no_vocals.wav").write_bytes(audio.encode(clicks(4.0), 22050))
    (tmp_path / "in" / "one" / "broken.wav").write_bytes(b"broken")
    (tmp_path / "in" / "one" / "full_mix.mid").write_bytes(midi.build([(60, 100, 0.5 * k, 0.5 * k + 0.4) for k in range(12)]))
    paths = song.run(spark, str(tmp_path / "in"), str(tmp_path / "in"), str(tmp_path / "out"), Config())
    read = {k: spark.read.parquet(p) for k, p in paths.items()}
    assert read["events"].count() == 12 and read["bar_grid"].count() >= 3
    assert {r["stem"] for r in read["bar_features"].select("stem").distinct().collect()} == {"full_mix", "accompaniment"}
    assert read["bar_features"].where("rms > 0 and not isnan(spectral_centroid_mean)").count() == read["bar_features"].count()
    assert spark.read.json(str(tmp_path / "out" / "errors")).count() == 1
    assert "### Bar 0" in (tmp_path / "out" / "reports" / "stems" / "one" / "full_mix" / "notes.md").read_text()


def test_names_and_scalars(spark):
    r = spark.createDataFrame([(60, 0.0005)], "p int, t double").select(music.pitch_name(F.col("p")).alias("n"), music.safe_fft_size(F.lit(1000)).alias("s"), music.time_to_sample(F.col("t"), F.lit(1000.0)).alias("r")).first()
    assert (r["n"], r["s"], r["r"]) == ("C4", 512, 0)
    names = spark.createDataFrame([(p,) for p in (0, 48, 61, 69, 127)], "p int").select(music.pitch_name(F.col("p")).alias("n")).collect()
    assert [x["n"] for x in names] == ["C-1", "C3", "C#4", "A4", "G9"]
    assert music.beats_per_bar(7, 8) == 3.5 and music.beats_per_bar(0, 4) == 4.0


def test_signal_columns(spark):
    r = spark.createDataFrame([([0.5, -0.5, 0.5],)], "x array<double>").select(signals.rms(F.col("x")).alias("r"), signals.zero_crossing_rate(F.col("x")).alias("z"), signals.valid(F.col("x"), F.lit(0)).alias("v"), signals.to_int16(F.col("x")).alias("q")).first()
    assert r["r"] == 0.5 and r["z"] == pytest.approx(2 / 3) and r["v"] is False and r["q"] == [16383, -16383, 16383]


def test_flatten_and_back(spark):
    df = spark.createDataFrame([(((1, [1.0, 2.0]), 3))], "a struct<b:int,c:array<double>>, d int")
    flat = flatten.flatten(df)
    assert flat.columns == ["a.b", "a.c", "d"] and flatten.unflatten(flat).schema["a"].dataType.names == ["b", "c"]
    assert flatten.flatten_for_files(df).first().asDict() == {"a_b": 1, "a_c": "1.0,2.0", "d": 3}


def test_analytics(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (float("nan"), 5.0)], "x double, y double")
    d = {r["feature"]: r for r in analytics.describe(df, ["x", "y"]).collect()}
    assert (d["x"]["count"], d["x"]["null_count"], d["x"]["mean"], d["x"]["q50"]) == (2, 1, 2.0, 2.0)
    assert [r["y"] for r in analytics.minmax(df, ["y"]).collect()] == [5.0] * 3
    assert analytics.variance_top(df, ["x", "y"], 1).first()["feature"] == "x"
    assert sum(r["n"] for r in analytics.histogram(df, "y", 4).collect()) == 3
    zipped = analytics.positional_zip(df, df.limit(2), ["x"], ["x"], ["y"])
    assert zipped.count() == 2 and zipped.columns == ["y", "x", "x_2"]


def test_graph(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("b", "a"), ("d", "d"), ("a", "b")], "source string, target string")
    assert [r["path"] for r in graph.cycles(e).collect()] == [["d"], ["a", "b"], ["a", "b", "c"]]
    assert graph.coupling(e).first()["node"] == "b"
    rows = code.scan(spark.createDataFrame([("x/m.py", "import os\nclass A(B):\n    def f(self):\n        self.g()\n"), ("x/bad.py", "def (")], "path string, value string")).collect()
    assert {r["type"] for r in rows} == {"module", "class", "method", "CONTAINS", "INHERITS", "IMPORTS", "CALLS", "error"}


def test_retries_breaker_and_manifest(spark, tmp_path):
    tries = []

    def work():
        tries.append(1)
        if len(tries) < 3:
            raise OSError("not yet")
        return "done"

    assert batch.retry(work, 3, sleep=lambda s: None) == "done" and batch.delay(10, 1, 2, 5) == 5
    with pytest.raises(batch.RetryError):
        batch.retry(lambda: 1 / 0, 1, sleep=lambda s: None)
    now = [0.0]
    b = batch.CircuitBreaker(2, 10, clock=lambda: now[0])
    for _ in range(2):
        with pytest.raises(ZeroDivisionError):
            b.call(lambda: 1 / 0)
    with pytest.raises(RuntimeError, match="open"):
        b.call(lambda: 1)
    now[0] = 11
    assert b.call(lambda: 1) == 1 and b.state == "CLOSED"
    songs = spark.createDataFrame([("a",), ("b",)], "song_id string")
    m = batch.Ledger(spark, str(tmp_path / "m"))
    tried = songs.selectExpr("song_id", "if(song_id = 'a', 'success', 'failed') as state", "1 as attempt", "0.5 as seconds", "cast(null as string) as error")
    assert m.left(songs, "beats").count() == 2
    m.record(tried, "beats")
    assert [r["song_id"] for r in m.left(songs, "beats").collect()] == ["b"] and m.left(songs, "bars").count() == 2
    m.record(tried.where("song_id = 'b'").selectExpr("song_id", "'success' as state", "2 as attempt", "seconds", "error"), "beats")
    assert m.left(songs, "beats").count() == 0 and m.rows().count() == 3 and m.latest("beats").where("song_id = 'b'").first()["attempt"] == 2


def test_reports(spark, tmp_path):
    e = spark.createDataFrame([("s", "v", 0, 0, 60, 100, 0.1, 0.5, 0.2, 1.0), ("s", "v", 0, 1, 64, 90, 0.3, 0.6, 0.6, 1.2), ("s", "v", 1, 2, 67, 80, 1.0, 1.5, 2.0, 3.0)], "song_id string, stem string, bar_index long, note_ix long, pitch int, velocity int, start_s double, end_s double, start_beat_float double, end_beat_float double")
    text = reports.markdown(e).first()["text"]
    assert "| 0.100 | 60 | C4 | 100 | 0.400 |\n| 0.300 | 64 | E4 | 90 | 0.300 |" in text and "### Bar 1" in text and "| 1.000 | 67 | G4 | 80 | 0.500 |" in text
    assert "C3 E2 |\nG4 |" in reports.abc(e).first()["text"]
    assert "- Tempo (BPM): N/A" in reports.summary(spark.createDataFrame([("s", 3.0)], "song_id string, duration_s double")).first()["text"]
    reports.write_csv(spark.createDataFrame([([1.5, 2.0], 1)], "a array<double>, b int"), str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c"), header=True).first()["a"] == "1.5,2.0"


def test_streamed_bars(spark, tmp_path):
    spark.createDataFrame([("s", "v", f"2024-01-01 00:00:{t:02d}", 60, 90) for t in (0, 1, 2, 5)], "song_id string, stem string, t string, pitch int, velocity int").selectExpr("song_id", "stem", "cast(t as timestamp) as ts", "pitch", "velocity").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "in")).schema).parquet(str(tmp_path / "in"))
    q = streaming.bar_windows(stream, 2.0).writeStream.format("memory").queryName("bars").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r["num_notes"] for r in spark.sql("select * from bars").collect()) == [1, 1, 2]


def test_signals_keep_all_blocks(spark, tmp_path):
    from tactus.plans import network

    rows = spark.range(0, 4300, 100).selectExpr("id as vec_id", "cast(id % 3 as int) as label", "array(0.5f, -0.25f) as embedding")
    rows.write.parquet(str(tmp_path / "embeddings.parquet"))
    found = network._signals(spark, str(tmp_path)).select("song_id", F.size("samples").alias("n")).collect()
    assert sum(r["n"] for r in found) == 2 * 43
    assert {r["song_id"] for r in found} == {f"song_{k}{e}" for k in range(3) for e in ("", "_1", "_2")}


def test_peak_of_a_signal_is_found_once(spark):
    """As an expression in the function over samples the peak would be worked out for each of them."""
    from tactus.plans import network

    plan = network._signals(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "max(array_max(" in plan


def test_midi_of_many_stems_is_built_and_read_in_few_tables(spark):
    """Each stem as a call and a table of its own took most of the time."""
    from pyspark.sql import functions as F

    notes = spark.range(30_000).select(F.concat(F.lit("s"), (F.col("id") % 2500).cast("string")).alias("song_id"), F.when(F.col("id") % 2 == 0, "v").alias("stem"), (F.col("id") % 128).cast("int").alias("pitch"), F.lit(90).alias("velocity"), (F.col("id") * 0.5).alias("start_s"), (F.col("id") * 0.5 + 0.25).alias("end_s"))
    files = midi.with_midi(notes)
    assert "FlatMapGroups" not in files._jdf.queryExecution().executedPlan().toString()
    batches = files.mapInArrow(lambda parts: (p.slice(0, 1) for p in parts), files.schema).count()
    assert batches <= 30
    back = midi.notes_of(files)
    assert back.mapInArrow(lambda parts: (p.slice(0, 1) for p in parts), back.schema).count() <= 30
    got = back.groupBy("song_id", "stem").agg(F.sort_array(F.collect_list("pitch")).alias("p"), F.max("note_ix").alias("n"))
    want = notes.groupBy("song_id", "stem").agg(F.sort_array(F.collect_list("pitch")).alias("p"), (F.count(F.lit(1)) - 1).alias("n"))
    assert got.count() == 2500 and got.exceptAll(want).count() == 0
