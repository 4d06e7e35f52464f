"""Grids, alignment and bars on small inputs with known results."""

import math

import pytest

from tactus.config import Config
from tactus.operators import align, bars, grid
from tactus.plans import timeline, views


def beats(spark, times, song="s"):
    return spark.createDataFrame([(song, i, float(t)) for i, t in enumerate(times)], "song_id string, beat_index long, time_s double")


def notes(spark, spans, song="s"):
    return spark.createDataFrame([(song, "bass", k, p, 90, float(a), float(b)) for k, (a, b, p) in enumerate(spans)], "song_id string, stem string, note_ix long, pitch int, velocity int, start_s double, end_s double")


def aligned(spark, spans, times, until=None, compat="a", num=4, den=4):
    n = notes(spark, spans)
    ends = spark.createDataFrame([("s", float(until if until is not None else max(b for _, b, _ in spans)))], "song_id string, until_s double")
    out = align.align(n, grid.extend(beats(spark, times), ends, compat=compat), num, den, compat)
    return [(r["beat_index"], round(r["start_beat_float"], 6), round(r["end_beat_float"], 6), r["bar_index"], round(r["beat_in_bar"], 6)) for r in out.orderBy("note_ix").collect()]


def test_alignment_a(spark):
    got = aligned(spark, [(0.1, 0.5, 60), (0.6, 1.0, 64), (1.2, 1.8, 67)], [0, 0.5, 1, 1.5, 2])
    assert got == [(0, 0.2, 1.0, 0, 0.2), (1, 1.2, 2.0, 0, 1.2), (2, 2.4, 3.6, 0, 2.4)]


def test_alignment_b_with_extension(spark):
    got = aligned(spark, [(0.1, 0.5, 60), (1.0, 1.5, 64), (8.0, 8.5, 67)], [0, 0.5, 1, 1.5, 2], until=10, compat="b")
    assert got == [(0, 0.2, 1.0, 0, 0.2), (2, 2.0, 3.0, 0, 2.0), (16, 16.0, 17.0, 4, 0.0)]


@pytest.mark.parametrize(
    ("start", "a", "b"),
    [(0.0, (-4.0, -1, 0.0), (0.0, 0, 0.0)), (1.9, (-0.2, 0, 3.8), (0.0, 0, 0.0)), (2.0, (0.0, 0, 0.0), (0.0, 0, 0.0)), (2.25, (0.5, 0, 0.5), (0.5, 0, 0.5)), (3.0, (2.0, 0, 2.0), (2.0, 0, 2.0)), (4.0, (4.0, 1, 0.0), (4.0, 1, 0.0))],
)
def test_late_first_beat(spark, start, a, b):
    for compat, want in (("a", a), ("b", b)):
        ((_, at, _, bar, within),) = aligned(spark, [(start, start, 60)], [2, 2.5, 3, 3.5, 4], compat=compat)
        assert (at, bar, within) == pytest.approx(want)


@pytest.mark.parametrize(
    ("times", "num", "den", "duration", "want"),
    [
        ([0.5 * k for k in range(8)], 4, 4, 4.0, [(0, 0, 2), (1, 2, 4)]),
        ([0.0], 4, 4, 2.0, [(0, 0, 2)]),
        ([0, 0.5, 1.0], 4, 4, 1.5, [(0, 0, 1.5)]),
        ([0.5 * k for k in range(12)], 4, 4, 6.0, [(0, 0, 2), (1, 2, 4), (2, 4, 6)]),
        ([0.5 * k for k in range(12)], 6, 8, 6.0, [(0, 0, 1.5), (1, 1.5, 3), (2, 3, 4.5), (3, 4.5, 6)]),
        ([0.5 * k for k in range(12)], 7, 8, 6.0, [(0, 0, 1.5), (1, 1.5, 3.5), (2, 3.5, 5), (3, 5, 6)]),
        ([0.5 * k for k in range(4)], 1, 8, 2.0, [(1, 0, 0.5), (3, 0.5, 1), (5, 1, 1.5), (7, 1.5, 2)]),
        ([1.0, 1.5, 2.0, 2.5, 3.0], 4, 4, 5.0, [(0, 1, 3), (1, 3, 5)]),
    ],
)
def test_bars(spark, times, num, den, duration, want):
    d = spark.createDataFrame([("s", duration), ("no beats", 10.0)], "song_id string, duration_s double")
    got = grid.bar_grid(beats(spark, times), d, num, den).orderBy("bar_index").collect()
    assert [(r["bar_index"], r["start_s"], r["end_s"]) for r in got] == want


def test_overlap_keeps_empty_cells_and_strict_borders(spark):
    n = notes(spark, [(0.1, 0.5, 60), (1.2, 1.8, 64), (2.3, 2.9, 67), (0.9, 2.1, 72), (1.0, 1.0, 50)])
    cells = spark.createDataFrame([("s", k, float(k), float(k + 1)) for k in range(4)], "song_id string, cell_ix long, cell_start_s double, cell_end_s double")
    for width in (0.25, 8.0):
        got = sorted((r["cell_ix"], r["pitch"] or 0) for r in align.overlap(n, cells, width).collect())
        assert got == [(0, 60), (0, 72), (1, 64), (1, 72), (2, 67), (2, 72), (3, 0)]
    q = align.quantized(align.overlap(n, cells)).where("pitch = 64").collect()
    assert [(r["start_s"], r["original_start"]) for r in q] == [(1.0, 1.2)]


def test_overlap_with_steps_is_overlap_with_their_cells(spark):
    n = notes(spark, [(0.1, 0.5, 60), (1.2, 1.8, 64), (2.3, 2.9, 67), (0.9, 2.1, 72), (1.0, 1.0, 50), (1.5, 1.5, 51), (1.7, 1.3, 52), (-2.0, 0.3, 53), (62.0, 200.0, 54), (0.3, 0.6, 55)])
    n = n.unionByName(notes(spark, [(0.0, 3.0, 1)], "none")).unionByName(notes(spark, [(0.0, 3.0, 2)], "other"))
    for step in (0.1, 1.0, 7.0):
        d = spark.createDataFrame([("s", 130.5), ("none", 0.0), ("bare", 3.0), ("other", 61 * step)], "song_id string, duration_s double")
        cells = spark.createDataFrame([(s, k, k * step, (k + 1) * step) for s, until in (("s", 130.5), ("bare", 3.0), ("other", 61 * step)) for k in range(math.ceil(until / step))], "song_id string, cell_ix long, cell_start_s double, cell_end_s double")
        tidy = lambda x: sorted((tuple(r) for r in x.select("song_id", "cell_ix", "cell_start_s", "cell_end_s", "note_ix", "pitch", "start_s").collect()), key=repr)
        assert tidy(align.overlap_steps(n, d, step)) == tidy(align.overlap(n, cells, step))


def test_exploded_cells_are_not_broadcast_or_shuffled(spark):
    """A song's cells are far more than its row's size tells the planner."""
    for query in (timeline.grid_overlap, timeline.grid_overlap_quantized):
        plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan
    n = notes(spark, [(0.0, 1.0, 60)])
    cells = spark.range(3).selectExpr("'s' as song_id", "id as cell_ix", "double(id) as cell_start_s", "double(id + 1) as cell_end_s")
    assert "Broadcast" not in align.overlap(n, cells)._jdf.queryExecution().executedPlan().toString()


def test_bar_grid_makes_its_grid_once_and_hashes_rows_of_songs(spark):
    d = spark.createDataFrame([("s", 4.0)], "song_id string, duration_s double")
    plan = grid.bar_grid(beats(spark, [0.0, 0.5]), d, 1, 8)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ExistingRDD") <= 4
    plan = views.notes(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Sort " not in plan and "Broadcast" not in plan


def test_grids_read_beats_and_ends_once(spark):
    """Each reading of beats or ends brings its own joins, sorts and aggregates into the one task that holds a song's."""
    d = spark.createDataFrame([("s", 4.0)], "song_id string, duration_s double")
    for made in (grid.bar_grid(beats(spark, [0.0, 0.5]), d, 3, 4), grid.extend(beats(spark, [0.0, 0.5]), d.withColumnRenamed("duration_s", "until_s"))):
        assert made._jdf.queryExecution().executedPlan().toString().count("ExistingRDD") == 2


def test_grids_of_songs_with_unknown_ends(spark):
    b = beats(spark, [0.0, 1.0, 2.0], "none").unionByName(beats(spark, [0.0, 1.0, 2.0], "null")).unionByName(beats(spark, [5.0, 5.0, 5.0], "flat"))
    u = spark.createDataFrame([("null", None), ("flat", 6.0), ("bare", 0.4), ("before", -1.0)], "song_id string, until_s double")
    known = [(s, k, float(k), False) for s in ("none", "null") for k in range(3)] + [("flat", k, 5.0, False) for k in range(3)]
    for compat, bare, more in (("a", True, [("flat", 3, 5.5, True), ("flat", 4, 6.0, True), ("flat", 5, 6.5, True), ("bare", 0, 0.0, True), ("bare", 1, 0.5, True)]), ("b", True, [("flat", 3, 5.5, True), ("flat", 4, 6.0, True)]), ("b", False, [("flat", 3, 5.5, True), ("flat", 4, 6.0, True)])):
        assert sorted(tuple(r) for r in grid.extend(b, u, compat=compat, bare=bare).collect()) == sorted(known + more)
    got = sorted(tuple(r) for r in grid.bar_grid(b, u.withColumnRenamed("until_s", "duration_s"), 2, 4).collect())
    assert got == [("flat", 1, 5.0, 6.0), ("null", 0, 0.0, 2.0)]


def test_notes_meet_their_songs_row_once(spark):
    n, g = notes(spark, [(0.1, 0.5, 60)]), beats(spark, [0.0, 0.5, 1.0])
    plan = align.align(n, g)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ShuffledHashJoin") == 1


def test_bars_leave_out_null_keys(spark):
    e = spark.createDataFrame([("s", "x", 0, 60, 80, 0.0, 1.0), ("s", "x", 0, 64, 100, 0.5, 1.5), ("s", "x", None, 1, 1, 0.0, 9.0)], "song_id string, stem string, bar_index long, pitch int, velocity int, start_s double, end_s double")
    (r,) = bars.bars(e).collect()
    assert (r["num_notes"], r["mean_velocity"], r["pitch_min"], r["pitch_max"], r["start_s"], r["end_s"]) == (2, 90.0, 60, 64, 0.0, 1.5)


def test_empty_tables(spark):
    n = notes(spark, [(0.0, 1.0, 60)]).limit(0)
    b = beats(spark, [0.0]).limit(0)
    u = spark.createDataFrame([], "song_id string, until_s double")
    assert align.align(n, grid.extend(b, u)).count() == 0
    assert grid.bar_grid(b, u.withColumnRenamed("until_s", "duration_s")).count() == 0
    assert grid.extend(b, spark.createDataFrame([("s", 1.0)], "song_id string, until_s double")).count() == 3


@pytest.mark.parametrize("wrong", [{"analysis_sr": 0}, {"hop_length": 0}, {"ts_den": 3}, {"silence_threshold_db": 1.0}, {"compat": "c"}, {"step_timeout_s": -1}])
def test_config_is_checked(wrong):
    with pytest.raises(ValueError, match="must"):
        Config(**wrong)
