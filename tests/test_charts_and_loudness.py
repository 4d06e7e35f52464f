"""Loudness against a plain filter, charts' tables, order statistics, components."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tactus.functions import dsp
from tactus.operators import analytics, charts, graph, loudness


def plain_filter(b, a, x):
    y = np.zeros(len(x))
    for i in range(len(x)):
        y[i] = sum(b[k] * x[i - k] for k in range(3) if i >= k) - sum(a[k] * y[i - k] for k in (1, 2) if i >= k)
    return y


def test_filters_are_those_of_the_standard_at_48_khz():
    (b, a), (c, d) = dsp.KFilter._biquad(48000, 1681.974450955533, 0.7071752369554196, 3.999843853973347), dsp.KFilter._biquad(48000, 38.13547087602444, 0.5003270373238773, None)
    assert np.allclose(b, [1.53512485958697, -2.69169618940638, 1.19839281085285]) and np.allclose(a, [1, -1.69065929318241, 0.73248077421585])
    assert np.allclose(c, [1, -2, 1]) and np.allclose(d, [1, -1.99004745483398, 0.99007225036621])


@pytest.mark.parametrize("n", [1, 255, 256, 257, 1000])
def test_filter_in_rows_equals_the_plain_one(n):
    f, x = dsp.KFilter(22050), np.random.default_rng(n).normal(size=n + 300)
    shelf, high = f._biquad(22050, 1681.974450955533, 0.7071752369554196, 3.999843853973347), f._biquad(22050, 38.13547087602444, 0.5003270373238773, None)
    want = plain_filter(*high, plain_filter(*shelf, x))
    y, state = f.run(x[:300], np.zeros(4))
    z, end = f.run(x[300:], state)
    assert np.allclose(np.concatenate([y, z]), want)
    assert np.allclose(end, f.after(n, state) + f.run(x[300:], np.zeros(4))[1])


def blocks(spark, songs, sr, size):
    rows = [(s, "mix", c, k, sr, [float(v) for v in x[k * size : (k + 1) * size]]) for s, channels in songs.items() for c, x in enumerate(channels) for k in range(max(1, -(-len(x) // size)))]
    return spark.createDataFrame(rows, "song_id string, stem string, channel int, block long, sample_rate int, samples array<double>")


def test_loudness_of_blocks_equals_the_whole(spark):
    """A tone of full scale at 997 Hz measures -3.01 on one channel; cuts between blocks don't show; both channels add; gates leave silence out."""
    sr = 8000
    t = np.arange(5 * sr) / sr
    tone = np.sin(2 * np.pi * 997 * t)
    songs = {"one": [tone], "two": [tone, tone], "gaps": [np.concatenate([tone, np.zeros(10 * sr)])], "silent": [np.zeros(2 * sr)], "short": [tone[: sr // 4]], "none": [np.zeros(0)]}
    found = {}
    for size in (777, 100_000):
        rows = loudness.loudness(loudness.weighted_segments(blocks(spark, songs, sr, size))).collect()
        found[size] = {r["song_id"]: (r["integrated"], r["available"], r["range_lu"], r["momentary_max"]) for r in rows}
    for song, got in found[777].items():
        assert got == pytest.approx(found[100_000][song], abs=1e-9, nan_ok=True)
    got = found[777]
    y = plain_filter(*dsp.KFilter._biquad(sr, 38.13547087602444, 0.5003270373238773, None), plain_filter(*dsp.KFilter._biquad(sr, 1681.974450955533, 0.7071752369554196, 3.999843853973347), tone))
    seg = (y**2).reshape(-1, sr // 10).mean(1)
    power = np.array([seg[k : k + 4].mean() for k in range(len(seg) - 3)])
    gate = -0.691 + 10 * math.log10(power.mean()) - 10
    want = -0.691 + 10 * math.log10(power[-0.691 + 10 * np.log10(power) > gate].mean())
    assert got["one"][0] == pytest.approx(want, abs=1e-6) and got["one"][0] == pytest.approx(-3.01, abs=0.1)
    assert got["two"][0] == pytest.approx(want + 10 * math.log10(2), abs=1e-6)
    assert got["gaps"][0] == pytest.approx(want, abs=0.7) and got["gaps"][2] > 0
    assert got["silent"][:2] == (-70.0, True) and got["short"][:2] == (None, False) and "none" not in got


def test_spectrogram_peaks_at_the_tone_and_in_parts(spark):
    x = np.sin(2 * np.pi * 1000 * np.arange(8000) / 8000)
    df = spark.createDataFrame([("s", "v", 8000, x.tolist()), ("s", "w", 8000, (x / 10).tolist()), ("e", "v", 8000, [])], "song_id string, stem string, sample_rate int, samples array<double>")
    rows = charts.spectrogram(df, 256, 128, frames_at_once=7).collect()
    whole = {(r["song_id"], r["stem"], r["frame"]): r["db"] for r in charts.spectrogram(df, 256, 128).collect()}
    assert len(rows) == len(whole) == 2 * ((8000 - 256) // 128 + 1)
    assert all(np.allclose(r["db"], whole[r["song_id"], r["stem"], r["frame"]]) for r in rows)
    v, w = whole["s", "v", 5], whole["s", "w", 5]
    assert int(np.argmax(v)) == 32 and max(v) == pytest.approx(0, abs=1e-6) and max(w) == pytest.approx(-20, abs=1e-6) and min(min(v), min(w)) >= -80


def test_piano_runs_equal_cells(spark):
    r = random.Random(2)
    notes = [("s", r.choice([60, 61]), r.randint(1, 127), a := r.random() * 3, a + r.choice([0.0, 0.004, 0.3, 1.0])) for _ in range(60)]
    cells = {}
    for _, p, v, a, b in notes:
        for k in range(int(a * 100), int(b * 100)):
            cells[p, k] = cells.get((p, k), 0) + v
    runs = charts.piano_runs(spark.createDataFrame(notes, "song_id string, pitch int, velocity int, start_s double, end_s double")).collect()
    assert {(x["pitch"], k): x["velocity"] for x in runs for k in range(x["from_ix"], x["until_ix"])} == cells
    assert charts.piano_runs(spark.createDataFrame([], "song_id string, pitch int, velocity int, start_s double, end_s double")).count() == 0


def test_order_statistics_of_ties_and_extremes(spark):
    g = np.random.default_rng(3)
    columns = {"a": g.normal(size=3000), "b": np.repeat([1.0, 2.0, 7.0], 1000), "c": np.concatenate([[-1.7e308, 1.7e308], g.normal(size=2998)]), "d": g.integers(0, 50, 3000).astype(float), "e": np.full(3000, 4.0)}
    df = spark.createDataFrame([tuple(float(x[i]) for x in columns.values()) for i in range(3000)], ", ".join(f"{c} double" for c in columns))
    long = analytics.long_format(df, list(columns))
    ranks = [(c, k, float(x.min()), float(x.max())) for c, x in columns.items() for k in (0, 1, 749, 750, 1499, 1500, 2998, 2999)]
    got = {(r["feature"], r["rank"]): r["value"] for r in analytics.order_statistics(long, spark.createDataFrame(ranks, "feature string, rank long, lo double, hi double"), bins=16, few=20).collect()}
    assert got == {(c, k): float(np.sort(columns[c])[k]) for c, k, _, _ in ranks}


def test_description_of_missing_values(spark):
    df = spark.createDataFrame([(1.0, None, float("nan")), (2.0, None, 5.0), (4.0, None, None)], "a double, b double, c double")
    got = {r["feature"]: r for r in analytics.describe(df.withColumn("text", F.lit("x"))).collect()}
    assert (got["a"]["q25"], got["a"]["q50"], got["a"]["q75"]) == (1.5, 2.0, 3.0)
    assert got["b"]["count"] == 0 and got["b"]["null_count"] == 3 and got["b"]["q50"] is None
    assert (got["c"]["count"], got["c"]["q25"], got["c"]["q75"]) == (1, 5.0, 5.0)


@pytest.mark.parametrize("seed", range(2))
def test_components_and_cycles_of_random_graphs(spark, seed):
    r = random.Random(seed)
    edges = {(r.randrange(18), r.randrange(18)) for _ in range(32)}
    reach = {(a, b) for a, b in edges}
    while True:
        more = reach | {(a, d) for a, b in reach for c, d in edges if b == c}
        if more == reach:
            break
        reach = more
    mutual = {a: max(b for b in range(18) if (a, b) in reach and (b, a) in reach) for a in range(18) if any((a, b) in reach and (b, a) in reach and a != b for b in range(18))}
    df = spark.createDataFrame(sorted(edges), "source long, target long")
    assert {x["node"]: x["root"] for x in graph.strong_components(df).collect()} == mutual
    found = set()

    def walk(path):
        for a, b in edges:
            if a == path[-1]:
                if b == path[0]:
                    found.add(tuple(path))
                elif b > path[0] and b not in path and len(path) < 5:
                    walk([*path, b])

    for n in range(18):
        walk([n])
    assert {tuple(x["path"]) for x in graph.cycles(df, 5).collect()} == found
    assert graph.cycles(df.limit(0)).count() == 0


def test_newest_files_of_a_large_key(spark):
    files = [(k, i % 37, f"f{i}") for i in range(500) for k in ("hot", "rare")[: 1 + (i % 50 == 0)]]
    df = spark.createDataFrame(files, "stem string, mtime int, file string")
    for n in (3, 20):
        want = {x for k in ("hot", "rare") for x in sorted((f for f in files if f[0] == k), key=lambda f: (f[1], f[2]), reverse=True)[n:]}
        assert {tuple(x) for x in analytics.keep_newest(df, n, ["stem"], ["mtime", "file"]).collect()} == want
    assert df.columns == analytics.keep_newest(df, 3, ["stem"], ["mtime", "file"]).columns


def test_extractors_in_sql(spark, tmp_path):
    """A second extractor runs in SQL and over chunks without a change to either."""
    from tactus.functions import tables
    from tactus.sinks import chunks

    peak = lambda x, sr: {"peak": float(np.abs(x).max(initial=0)), "length_s": len(x) / sr}
    record = "peak double, length_s double"
    assert "peaks" in tables.register(spark, peaks=(peak, record))
    x = np.sin(np.arange(4000) / 7)
    spark.createDataFrame([(1, x.tolist(), 8000), (2, None, 8000), (3, [], None), (4, [0.5, None], 8000)], "id int, samples array<double>, sample_rate int").createOrReplaceTempView("sounds")
    got = {r["id"]: r for r in spark.sql("select id, p.*, f.rms, f.mfcc_mean from sounds, lateral peaks(samples, sample_rate) p, lateral signal_features(samples, sample_rate) f").collect()}
    assert set(got) == {1, 2, 4} and got[1]["peak"] == pytest.approx(np.abs(x).max()) and got[1]["length_s"] == 0.5 and got[2]["rms"] == 0 and got[4]["peak"] == 0.5
    want = dsp.features(x, 8000)
    assert got[1]["rms"] == pytest.approx(want["rms"]) and np.allclose(got[1]["mfcc_mean"], want["mfcc_mean"])
    assert spark.sql("select v.zcr_max from sounds, lateral variant_features(samples, sample_rate) v where id = 1").first()[0] == pytest.approx(dsp.variant_features(x, 8000)["zcr_max"])
    signals = spark.createDataFrame([("s", "v", 8000, x.tolist())], "song_id string, stem string, sample_rate int, samples array<double>")
    spans = spark.createDataFrame([("s", 0, 0.0, 0.25), ("s", 1, 0.25, 0.5)], "song_id string, bar_index long, start_s double, end_s double")
    rows = {r["chunk_index"]: r for r in chunks.chunks_with_features(signals, spans, str(tmp_path / "c"), extractor=peak, record=record).collect()}
    assert set(rows) == {0, 1} and rows[1]["length_s"] == 0.25 and rows[0]["peak"] == pytest.approx(np.abs(x[:2000]).max()) and (tmp_path / "c" / "s" / "v" / "bar_0001.wav").exists()
