"""Song runs with chunks, faults and repeats; frames, graphs, tables read back, steps."""

import os
import shutil
import struct
import sys
import time
from xml.etree import ElementTree

import numpy as np
import pytest
from pyspark.sql import functions as F

from tactus.cli import parser
from tactus.config import Config
from tactus.functions import dsp, flatten, music
from tactus.operators import batch, bars, features, frames, graph
from tactus.plans import song
from tactus.sinks import chunks, files, reports
from tactus.sources import audio, code, commands, midi, tables, wav_blocks
from tests.test_sources_and_features import clicks


@pytest.fixture(scope="module")
def songs(tmp_path_factory):
    root = tmp_path_factory.mktemp("songs")
    for name in ("one", "two"):
        (root / name).mkdir()
        (root / name / "full_mix.wav").write_bytes(audio.encode(clicks(6.0), 22050))
        (root / name / "full_mix.mid").write_bytes(midi.build([(60, 100, 0.5 * k, 0.5 * k + 0.4) for k in range(10)]))
    (root / "bad").mkdir()
    (root / "bad" / "full_mix.mid").write_bytes(b"broken")
    (root / "bad" / "full_mix.wav").write_bytes(b"broken")
    return str(root)


def listing(root):
    return {os.path.relpath(os.path.join(d, f), root): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names if "/." not in d and not f.startswith((".", "_"))}


def test_run_with_chunks_faults_and_repeats(spark, songs, tmp_path):
    """A second run over the same songs leaves what the first one wrote of them; only the failed song is tried again."""
    out, config = str(tmp_path / "out"), Config(write_chunks=True, skip_existing=True, max_retries=1)
    paths = song.run(spark, songs, songs, out, config)
    made = spark.read.parquet(paths["bar_features"]).collect()
    assert made and all(r["chunk_path"] == f"{out}/chunks/{r['song_id']}/full_mix/bar_{r['bar_index']:04d}.wav" for r in made)
    for r in made:
        rate, x = audio.decode(open(r["chunk_path"], "rb").read())
        assert rate == 22050 and abs(len(x) / rate - (r["end_s"] - r["start_s"])) < 1e-3 and np.sqrt(np.mean(x * x)) == pytest.approx(r["rms"], abs=1e-3)
    assert {(r["song_id"], r["error"].split(":")[0]) for r in tables.read_json(spark, f"{out}/errors").collect()} == {("bad", "ValueError")}
    results = lambda: {r["song_id"]: r for r in spark.read.json(f"{out}/results").collect()}
    first = results()
    assert {k: (r["status"], r["attempts"]) for k, r in first.items()} == {"one": ("success", 1), "two": ("success", 1), "bad": ("failed", 2)}
    assert first["one"]["seconds"] > 0 and first["one"]["num_bars"] >= 2 and first["one"]["input_path"].endswith("one/full_mix.wav") and "not a MIDI file" in first["bad"]["error"]
    analysis = spark.read.json(f"{out}/analysis").where("song_id = 'one'").first()
    assert {"beats", "bar_features", "report_notes"} <= set(analysis["step_seconds"].asDict()) and analysis["environment"]["spark"] == spark.version and "bar_grid" in " ".join(analysis["tables"])
    text = open(f"{out}/reports/songs/one/summary.md").read()
    assert "- Attempts: 1" in text and "| full_mix | 10 |" in text and "### Bar 0" in open(f"{out}/reports/stems/one/full_mix/notes.md").read() and open(f"{out}/reports/stems/one/full_mix/tune.abc").read().startswith("X:1")
    before = listing(out)
    song.run(spark, songs, songs, out, config)
    after = listing(out)
    own = lambda files: {k: v for k, v in files.items() if k.split("/")[0] not in ("results", "errors", "ledger")}
    assert own(before) == own(after) and any("reports/songs/one" in k for k in after) and any("analysis/song_id=one" in k for k in after)
    assert {k: r["status"] for k, r in results().items()} == {"one": "skipped", "two": "skipped", "bad": "failed"}
    stats = tables.output_stats(spark, f"{out}/chunks").first()
    assert stats["files"] == len(made) and stats["bytes"] > 0
    read = tables.read_songs(spark, paths["events"])
    assert {r["song_id"] for r in read.select("song_id").distinct().collect()} == {"one", "two"}
    with pytest.raises(RuntimeError, match="errors"):
        song.run(spark, songs, songs, str(tmp_path / "stop"), Config(stop_on_error=True, max_retries=0))


def test_run_with_a_flaky_song(spark, songs, tmp_path, monkeypatch):
    """One song's file is whole only from the second attempt on: the others are read once."""
    root, out = tmp_path / "in", str(tmp_path / "out")
    shutil.copytree(songs, root)
    shutil.copy(root / "one" / "full_mix.mid", root / "bad" / "full_mix.mid")
    real = batch.Ledger.record

    def record(self, tried, step):
        real(self, tried, step)
        shutil.copy(root / "one" / "full_mix.wav", root / "bad" / "full_mix.wav")

    monkeypatch.setattr(batch.Ledger, "record", record)
    paths = song.run(spark, str(root), str(root), out, Config(max_retries=2))
    ledger = batch.Ledger(spark, f"{out}/ledger").rows().where("step = 'read'").collect()
    assert sorted((r["song_id"], r["attempt"], r["state"]) for r in ledger) == [("bad", 1, "failed"), ("bad", 2, "success"), ("one", 1, "success"), ("two", 1, "success")]
    assert {r["song_id"] for r in spark.read.parquet(paths["bars"]).select("song_id").distinct().collect()} == {"one", "two", "bad"}
    assert {r["status"] for r in spark.read.json(f"{out}/results").collect()} == {"success"}


def test_run_of_the_other_variant(spark, songs, tmp_path):
    paths = song.run(spark, songs, songs, str(tmp_path / "b"), Config(compat="b", max_retries=0))
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "b" / "reports" / "lines")).where("song_id = 'one'").collect()]
    assert lines[0].startswith("# MIDI Analysis Report: one") and sum(x.startswith("| ") and x[2].isdigit() for x in lines) == 10
    wide = spark.read.parquet(paths["wide_features"]).first()
    assert wide["zcr_min"] <= wide["zcr_mean"] <= wide["zcr_max"] and wide["tempo_bpm"] >= 0 and wide["spectral_centroid_max"] > 0 and "mfcc_12_std" in wide.asDict() and "chroma_mean_11" in wide.asDict()


def test_run_with_preprocessing_and_native_chunks(spark, tmp_path):
    """Silence is cut and the peak is 1; without preprocessing, chunks keep rate and channels."""
    (tmp_path / "in" / "s").mkdir(parents=True)
    x = clicks(6.0, sr=44100) * 0.5
    (tmp_path / "in" / "s" / "full_mix.wav").write_bytes(audio.encode([np.concatenate([np.zeros(44100), x]), np.concatenate([np.zeros(44100), -0.25 * x])], 44100))
    for k, config in enumerate((Config(write_chunks=True, preprocess=True), Config(write_chunks=True, native_chunks=True))):
        out = str(tmp_path / f"out{k}")
        paths = song.run(spark, str(tmp_path / "in"), None, out, config)
        row = spark.read.parquet(paths["bar_features"]).where("bar_index = 1").first()
        rate, got = audio.decode_channels(open(row["chunk_path"], "rb").read())
        assert (rate, len(got)) == ((22050, 1) if k == 0 else (44100, 2))
        assert abs(got.shape[1] / rate - row["duration_s"]) < 1e-3
        duration = spark.read.parquet(paths["song_summary"]).first()["duration_s"]
        assert (5.0 < duration < 6.5) if k == 0 else duration == 7.0
        if k:
            assert np.allclose(got[1], -0.25 * got[0], atol=1e-4)


def test_precomputed_path_is_the_runs_own_choice(spark, tmp_path):
    """A song of over three minutes takes its features from frames made once, a short one bar by bar."""
    from tactus.operators import features as f

    for name, seconds in (("long", 185.0), ("short", 5.0)):
        (tmp_path / "in" / name).mkdir(parents=True)
        (tmp_path / "in" / name / "full_mix.wav").write_bytes(audio.encode(clicks(seconds, sr=8000), 8000))
    paths = song.run(spark, str(tmp_path / "in"), None, str(tmp_path / "out"), Config())
    rows = spark.read.parquet(paths["bar_features"])
    grid = spark.read.parquet(paths["bar_grid"])
    blocks = wav_blocks.read_blocks(spark, str(tmp_path / "in"), context=f.ANALYSIS_CONTEXT)
    direct = {(r["song_id"], r["bar_index"]): r["spectral_centroid_mean"] for r in f.sound_features(f.bar_sounds(wav_blocks.read_blocks(spark, str(tmp_path / "in")), grid)).collect()}
    pre = {(r["song_id"], r["bar_index"]): r["spectral_centroid_mean"] for r in frames.precomputed_bar_features(blocks, f.bar_sounds(wav_blocks.read_blocks(spark, str(tmp_path / "in")), grid), grid).collect()}
    got = {(r["song_id"], r["bar_index"]): r["spectral_centroid_mean"] for r in rows.collect()}
    assert len(got) == rows.count() == grid.count()
    for (name, k), value in got.items():
        assert value == pytest.approx((pre.get((name, k)) or direct[name, k]) if name == "long" else direct[name, k])
    assert any(pre[k] != pytest.approx(direct[k]) for k in pre if k[0] == "long")


def test_blocks_are_byte_ranges(spark, tmp_path):
    """Each partition reads the header and its own blocks only; formats, odd chunks, empty and broken files."""
    x = np.random.default_rng(0).uniform(-0.9, 0.9, (2, 200_000))
    for name in "abcdef":
        (tmp_path / "in" / name).mkdir(parents=True)
    put = lambda name, content: (tmp_path / "in" / name / "Full_Mix.wav").write_bytes(content)
    put("a", audio.encode(x, 48000))
    body = x[0].astype("<f4").tobytes()
    put("b", b"RIFF" + struct.pack("<I", 0) + b"WAVEJUNK" + struct.pack("<I", 3) + b"abc\0fmt " + struct.pack("<IHHIIHH", 16, 3, 1, 8000, 32000, 4, 32) + b"data" + struct.pack("<I", len(body)) + body)
    put("c", audio.encode(np.zeros(0), 8000))
    put("d", b"RIFF0000WAVE")
    put("e", audio.encode(x[0], 8000)[:1001])
    raw = np.array([0, 1, -1, (1 << 23) - 1, -(1 << 23)], np.int64)
    put("f", b"RIFF" + struct.pack("<I", 0) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, 8000, 24000, 3, 24) + b"data" + struct.pack("<I", 15) + b"".join(int(v & 0xFFFFFF).to_bytes(3, "little") for v in raw))
    reader = wav_blocks.WavReader({"path": str(tmp_path / "in"), "block_frames": "4096", "split_bytes": "50000", "context": "100"})
    parts = reader.partitions()
    assert len(parts) > 20 and all(sum(e - s for _, _, s, e in p.ranges) <= 50_000 for p in parts)
    rows = [r for p in parts for b in reader.read(p) for r in b.to_pylist()]
    read = max(sum(len(r["samples"] or b"") // 2 for b in reader.read(p) for r in b.to_pylist()) for p in parts if len(p.ranges) == 1)
    assert read < 50_000 + 4 * 4096 + 4 * 800  # of 800,000 bytes: the range, what its last block reaches over, context of four blocks
    for name, want, rate in (("a", np.trunc(x * 32767) / 32768, 48000), ("b", x[:1], 8000), ("f", raw[None] / (1 << 23), 8000)):
        own = sorted((r for r in rows if r["song_id"] == name), key=lambda r: r["block"])
        assert [r["first_frame"] for r in own] == [4096 * k for k in range(len(own))] and {r["sample_rate"] for r in own} == {rate} and own[0]["stem"] == "full_mix"
        whole = np.concatenate([wav_blocks.channels_of(r["samples"], r["num_channels"])[:, r["lead"] : r["lead"] + r["n"]] for r in own], 1)
        assert np.allclose(whole, want, atol=1e-6)
        assert all(np.allclose(wav_blocks.channels_of(r["samples"], r["num_channels"]), want[:, r["first_frame"] - r["lead"] : r["first_frame"] + r["n"] + 100], atol=1e-6) for r in own)
    rest = {r["song_id"]: r for r in rows if r["song_id"] in "cde"}
    assert (rest["c"]["n"], rest["c"]["error"]) == (0, None) and "no samples" in rest["d"]["error"] and rest["e"]["num_frames"] == 478
    assert wav_blocks.read_blocks(spark, str(tmp_path / "in"), block_frames=4096, split_bytes=50000).count() == len(rows)
    (tmp_path / "none").mkdir()
    assert wav_blocks.read_blocks(spark, str(tmp_path / "none")).count() == 0
    assert {r["song_id"] for r in wav_blocks.read_blocks(spark, str(tmp_path), ids="relative").select("song_id").collect()} == {f"in_{k}_Full_Mix" for k in "abcdef"}
    assert {r["song_id"] for r in audio.list_files(spark, str(tmp_path), ids="relative").collect()} == {f"in_{k}_Full_Mix" for k in "abcdef"}


@pytest.mark.parametrize("seconds", [0.05, 3.0, 20.0])
def test_beats_of_blocks_equal_the_whole(spark, tmp_path, seconds):
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "x.wav").write_bytes(audio.encode(clicks(seconds), 22050))
    whole = audio.decode((tmp_path / "s" / "x.wav").read_bytes())[1].astype(np.float32).astype(float)
    tempo, beats = dsp.tempo_and_beats(whole, 22050)
    for size in (2048, 1 << 16):
        r = features.analyse_blocks(wav_blocks.read_blocks(spark, str(tmp_path), context=features.ANALYSIS_CONTEXT, block_frames=size)).first()
        assert r["tempo_bpm"] == pytest.approx(tempo, rel=1e-9) and r["beat_times"] == pytest.approx(beats) and r["duration_s"] == len(whole) / 22050


def test_files_appear_whole_or_not_at_all(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = lambda texts: spark.createDataFrame([(s, "v", n, t) for s, n, t in texts], "song_id string, stem string, name string, content string")
    files.write_files(rows([("a", "1", "x"), ("a", "2", "y"), ("b", "1", "z"), ("../c", "../n", None)]), out)
    assert {k: open(f"{out}/{k}").read() for k in listing(out)} == {"a/v/1": "x", "a/v/2": "y", "b/v/1": "z"} and open(f"{out}/_c/v/_n").read() == ""
    bad = rows([("a", "1", "new"), ("b", "1", "new")]).withColumn("content", F.when(F.col("song_id") == "b", F.raise_error(F.lit("no"))).otherwise(F.col("content")))
    with pytest.raises(Exception, match="no"):
        files.write_files(bad, out)
    assert open(f"{out}/a/v/1").read() == "x" and not os.path.exists(f"{out}/.pending")
    files.write_files(rows([("a", "3", "w")]), out)
    assert {k: open(f"{out}/{k}").read() for k in listing(out)} == {"a/v/3": "w", "b/v/1": "z"}
    assert rows([("a/b", "n", "")]).select(files.place_of("/r/", F.col("song_id"), F.col("name"))).first()[0] == "/r/a_b/n"
    files.write_files(midi.with_midi(spark.createDataFrame([("s", "v", 60, 90, 0.0, 1.0)], "song_id string, stem string, pitch int, velocity int, start_s double, end_s double")).withColumn("name", F.lit("v.mid")), out)
    assert midi.parse(open(f"{out}/s/v/v.mid", "rb").read())[0][0]["pitch"] == 60


def test_chunks_of_intervals(spark, tmp_path):
    signals = spark.createDataFrame([("s", "v", 1000, [float(k) / 4000 for k in range(3000)])], "song_id string, stem string, sample_rate int, samples array<double>")
    spans = spark.createDataFrame([("s", 0, 0.0, 1.0), ("s", 1, 0.5, 1.2506), ("s", 2, 2.9, 9.0), ("s", 3, 5.0, 6.0)], "song_id string, bar_index long, start_s double, end_s double")
    sizes = {m: {r["bar_index"]: r["n"] for r in features.bar_slices(signals, spans, m).select("bar_index", F.size("samples").alias("n")).collect()} for m in ("round", "trunc", "ms")}
    assert sizes == {"round": {0: 1000, 1: 751, 2: 100}, "trunc": {0: 1000, 1: 750, 2: 100}, "ms": {0: 1000, 1: 750, 2: 100}}
    found = chunks.chunk_signals(signals, spans, str(tmp_path / "c"), "ms").collect()
    assert {len(audio.decode(open(r["chunk_path"], "rb").read())[1]) for r in found} == {1000, 750, 100}
    times = spark.createDataFrame([("s", 0.0), ("s", 1.5), ("s", 1.5), ("s", 2.0)], "song_id string, time_s double")
    assert [(r["bar_index"], r["start_s"], r["end_s"]) for r in chunks.intervals_of_times(times).orderBy("start_s").collect()] == [(0, 0.0, 1.5), (2, 1.5, 2.0)]


def test_resampling_in_blocks():
    x = np.random.default_rng(1).normal(size=5000)
    assert np.allclose(dsp.resample(x, 48000, 22050, block=100), dsp.resample(x, 48000, 22050))


def test_frames_made_once_agree_with_slices(spark):
    x = clicks(4.0).astype(np.float32)
    signals = spark.createDataFrame([("s", "v", 22050, x.tolist())], "song_id string, stem string, sample_rate int, samples array<float>")
    spans = spark.createDataFrame([("s", k, float(k), k + 1.0) for k in range(4)] + [("s", 9, 8.0, 9.0)], "song_id string, bar_index long, start_s double, end_s double")
    blocks = features.as_blocks(signals, features.ANALYSIS_CONTEXT, 5000)
    got = {r["bar_index"]: r for r in frames.precomputed_bar_features(blocks, features.bar_sounds(features.as_blocks(signals), spans), spans).collect()}
    assert set(got) == {0, 1, 2, 3}
    c, b, r, z, m, h = dsp.frame_features(x.astype(float), 22050)
    for k, row in got.items():
        lo, hi = max(0, (k * 22050 - 1024) // 512), min(len(c), ((k + 1) * 22050 - 1024) // 512 + 1)
        assert row["spectral_centroid_mean"] == pytest.approx(c[lo:hi].mean()) and row["spectral_rolloff_std"] == pytest.approx(r[lo:hi].std()) and row["frames"] == hi - lo
        assert np.allclose(row["mfcc_std"], m[lo:hi].std(0)) and np.allclose(row["chroma_mean"], h[lo:hi].mean(0)) and row["zcr"] == pytest.approx(z[lo:hi].mean())
        own = x[k * 22050 : (k + 1) * 22050].astype(float)
        assert row["energy"] == pytest.approx((own**2).sum()) and row["rms"] == pytest.approx(np.sqrt((own**2).mean()))


def test_graph_of_sources(spark, tmp_path):
    files = [("p/a.py", "import b\nclass A(B):\n    def f(self):\n        self.g()\n        h()\n    def g(self):\n        pass\ndef h():\n    print(1)\nclass B:\n    pass\n"), ("p/b.py", "class C(A):\n    pass\n")]
    (tmp_path / "p").mkdir()
    for name, text in files:
        (tmp_path / name).write_text(text)
    rows = code.scan(code.read_sources(spark, str(tmp_path / "p")))
    wanted = code.dependencies(spark, '[project]\ndependencies = ["numpy>=1", "pandas"]\n[project.optional-dependencies]\nx = ["numpy; os_name"]')
    nodes, edges = graph.build(rows, wanted, "mine")
    found = {(r["source"], r["target"], r["type"]) for r in edges.collect()}
    assert {("method:a.A.f", "method:a.A.g", "CALLS"), ("method:a.A.f", "function:a.h", "CALLS"), ("function:a.h", "ref:print", "CALLS"), ("class:a.A", "class:a.B", "INHERITS"), ("class:b.C", "ref:A", "INHERITS"), ("module:a", "import:b", "IMPORTS"), ("project:mine", "package:numpy", "DEPENDS_ON")} <= found
    assert graph.between(edges, nodes).count() == sum(1 for s, t, _ in found if {s, t} <= {r["id"] for r in nodes.collect()})
    graph.write_graph(nodes, edges, str(tmp_path / "g"))
    s = tables.read_json(spark, str(tmp_path / "g" / "summary")).first()
    assert (s["nodes"], s["edges"]) == (nodes.count(), len(found))
    assert spark.read.text(str(tmp_path / "g" / "mermaid")).first()["value"] == "graph LR"
    parts = sorted((tmp_path / "g" / "graphml").glob("part-*"))
    tree = ElementTree.fromstring("".join(p.read_text() for p in parts))
    tag = lambda x: "{http://graphml.graphdrawing.org/xmlns}" + x
    assert len(tree.findall(f".//{tag('node')}")) == s["nodes"] and len(tree.findall(f".//{tag('edge')}")) == s["edges"] and len(tree.findall(tag("key"))) == 5


def test_dependency_report(spark):
    nodes = spark.createDataFrame([(f"module:{m}", "module", m) for m in ("pa", "pb", "pc", "q")], "id string, type string, name string")
    edges = spark.createDataFrame([("module:pa", "import:x.pb", "IMPORTS"), ("module:pb", "import:pc", "IMPORTS"), ("module:pc", "import:pa", "IMPORTS"), ("module:q", "import:pa", "IMPORTS"), ("module:q", "import:numpy.linalg", "IMPORTS"), ("module:pa", "import:numpy", "IMPORTS"), ("module:pa", "f", "CALLS")], "source string, target string, type string")
    imports = graph.resolve_imports(edges, nodes)
    assert {(r["source"], r["target"]) for r in imports.collect()} == {("module:pa", "module:pb"), ("module:pb", "module:pc"), ("module:pc", "module:pa"), ("module:q", "module:pa"), ("module:q", "package:numpy"), ("module:pa", "package:numpy")}
    assert graph.within(imports, "p").count() == 3
    lines = [r["value"] for r in graph.dependency_report(imports, ("p", "q")).collect()]
    assert lines[0].startswith("# ") and "- `pa` -> `pb` -> `pc`" in lines and "| `numpy` | 2 |" in lines and "| `pa` | 1 | 1 | 2 |" in lines and lines.count("- none") == 1
    assert graph.first_by_id(nodes.withColumn("id", F.lit("<&\">")), ["name"]).count() == 1
    one = nodes.limit(1).withColumn("id", F.lit('<&">'))
    text = "\n".join(r["value"] for r in graph.graphml(one, edges.limit(0)).orderBy("place").collect())
    assert ElementTree.fromstring(text)[-1][0].get("id") == '<&">'


def test_sql_functions_and_records(spark):
    music.register(spark)
    r = spark.sql("select pitch_name(61) as n, beats_per_bar(7, 8) as b, beats_per_bar(0, 4) as d, signal_rms(array(0.5D, -0.5D)) as r, signal_zcr(array(0.5D, -0.5D, 0.5D)) as z, quarter_notes(2.0D, 90.0D) as q").first()
    assert (r["n"], r["b"], r["d"], r["r"]) == ("C#4", 3.5, 4.0, 0.5) and r["z"] == pytest.approx(2 / 3) and r["q"] == 3.0
    df = spark.createDataFrame([(1, "x", [1.0, 3.0], True)], "a int, b string, c array<double>, d boolean")
    assert flatten.scalars(df, "p_").first().asDict() == {"p_a": 1, "p_c_mean": 2.0, "p_c_std": 1.0, "p_d": True}
    rows = spark.createDataFrame([(None, 2.0, 5.0), (1.0, None, None), (None, None, None)], "start_s double, start double, end double")
    assert [(r["start_s"], r["end_s"]) for r in bars.with_times(rows).collect()] == [(2.0, 5.0), (1.0, 1.0), (0.0, 0.0)]
    wide = reports.wide_features(spark.createDataFrame([("s", [0.5] * 12, [1.0] * 13)], "song_id string, chroma_mean array<double>, mfcc_mean array<double>"))
    assert wide.columns[:2] == ["song_id", "chroma_mean_00"] and wide.columns[-1] == "mfcc_12_mean"


def test_steps_health_and_commands(spark):
    tries, steps = [], batch.Steps(spark, retries=2)

    def work():
        tries.append(1)
        if len(tries) < 2:
            raise OSError("not yet")
        return 7

    assert steps.run("Some Step", work) == 7 and "some_step" in steps.seconds
    began, slow = time.monotonic(), batch.Steps(spark, 2, 1.0)
    with pytest.raises(TimeoutError, match="more than"):
        slow.run("slow", lambda: spark.range(0, 10**13, 1, 4).selectExpr("sum(hash(id) % 7)").collect())
    assert time.monotonic() - began < 30 and slow.attempts == {"slow": 1} and not spark.sparkContext.getLocalProperty("spark.jobGroup.id")
    with pytest.raises(FileNotFoundError):
        batch.Steps(spark, 2).run("gone", lambda: spark.read.parquet("/no/such/path").count())
    assert batch.run_command(["echo", "a b"]).strip() == "a b" and batch.shown(["x", "a b"]) == "x 'a b'"
    with pytest.raises(RuntimeError, match="ended with"):
        batch.run_command(["false"])
    assert {r["tool"] for r in batch.health(spark, ("sh", "no-such-tool")).where("available").collect()} == {"sh"}
    assert parser().parse_args(["in", "out", "--write-chunks", "--step-timeout", "3"]).step_timeout == 3.0


def test_files_through_a_program(spark, tmp_path, monkeypatch):
    """Another container, here a WAV file backwards, becomes signals; what can't be read is an error, and a program that always fails isn't started for ever."""
    (tmp_path / "in" / "s").mkdir(parents=True)
    content = audio.encode(np.linspace(-0.5, 0.5, 1000), 8000)
    (tmp_path / "in" / "s" / "full_mix.vaw").write_bytes(content[::-1])
    (tmp_path / "in" / "s" / "other.vaw").write_bytes(b"x")
    back = (sys.executable, "-c", "import sys; d = sys.stdin.buffer.read(); sys.exit('too short') if len(d) < 9 else sys.stdout.buffer.write(d[::-1])")
    got = {r["stem"]: r for r in commands.read_converted(spark, str(tmp_path / "in"), "*.vaw", back).collect()}
    assert got["full_mix"]["sample_rate"] == 8000 and np.allclose(got["full_mix"]["samples"], np.linspace(-0.5, 0.5, 1000), atol=1e-3)
    assert got["other"]["samples"] is None and "ended with 1" in got["other"]["error"]
    rows = spark.createDataFrame([(k, bytearray(b"x"), "y") for k in range(20)], "k int, content binary, extra string").coalesce(1)
    out = commands.through_command(rows, (sys.executable, "-c", "raise SystemExit(3)"), retries=0).collect()
    assert all(r["content"] is None and r["extra"] == "y" for r in out) and sum("circuit is open" in r["error"] for r in out) == 20 - commands.FAILURES
    gone = commands.through_command(rows, ("/no/such/program",)).collect()
    assert sum("No such file" in r["error"] for r in gone) == commands.FAILURES and all(r["error"] for r in gone)


def test_midi_variants_and_frames_a_second():
    content = midi.build([(60, 100, 0.0, 1.0)])
    found, _ = midi.parse(content)
    assert found[0]["instrument_name"] == "" and midi.named(found, "a")[0]["instrument_name"] == "Instrument_0" and midi.named(found, "b")[0]["dur_s"] is None
    smpte = content[:12] + struct.pack(">h", -(25 << 8) + 40 - 0) + content[14:]
    division = struct.unpack(">h", smpte[12:14])[0]
    rate = -(division >> 8) * (division & 0xFF)
    assert midi.parse(smpte)[0][0]["end_s"] == pytest.approx(960 / rate)
