"""A batch of songs from files to tables: beats, bars, aligned events, bar statistics and features, chunk files, reports.

Sound is read as blocks of byte ranges and features are made bar by bar, so no row holds a song; only silence trimming and normalising (``preprocess``) take whole
songs. Every table is written once and read back by those that follow from it. Faults of files are found by the reads that the analysis makes anyway, and
only the songs that have some are read again in the next attempt. The ledger under ``out`` keeps each song's attempts, states and own seconds of work."""

from __future__ import annotations

import platform
from dataclasses import asdict

import pyspark
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tactus import schemas
from tactus.config import Config
from tactus.functions import dsp, tables
from tactus.functions.music import many_bars
from tactus.operators import align, bars, batch, features, frames, grid
from tactus.operators.storage import saved
from tactus.sinks import chunks, files, reports
from tactus.sources import audio, midi, wav_blocks

#: Whole songs in one Arrow batch, where songs are rows; blocks in one.
SONGS_AT_ONCE, BLOCKS_AT_ONCE = 4, 64
_HEARD = "song_id string, stem string, duration_s double, tempo_bpm double, beat_times array<double>, sample_rate int, num_channels int, error string, seconds double"


def sound(spark: SparkSession, path: str, config: Config, context: int = 0) -> DataFrame:
    """The files' blocks; with ``preprocess`` those of the trimmed and normalised signals at the analysis rate."""
    if not config.preprocess:
        return wav_blocks.read_blocks(spark, path, compat=config.compat, context=context)
    signals = audio.signals_of(audio.read_files(spark, path, compat=config.compat))
    made = features.preprocess(signals.where("samples is not null"), config)
    return features.as_blocks(made, context).unionByName(signals.where("samples is null").select("song_id", "stem", "error"), allowMissingColumns=True)


def heard(blocks: DataFrame) -> DataFrame:
    """A row per file: duration, tempo and beats of each song's full mix or first good stem, rate and channels, or the error."""
    kinds = blocks.groupBy("song_id", "stem").agg(F.max("sample_rate").alias("sample_rate"), F.max("num_channels").alias("num_channels"), F.max("num_frames").alias("num_frames"), F.max("error").alias("error"))
    kinds = saved(kinds)
    mains = kinds.where("error is null").groupBy("song_id").agg(F.min(F.struct((F.col("stem") != "full_mix").alias("k"), "stem")).alias("m")).select("song_id", F.col("m.stem").alias("stem"))
    found = features.analyse_blocks(blocks.join(mains, ["song_id", "stem"], "left_semi"))
    out = kinds.join(found.select("song_id", "stem", "tempo_bpm", "beat_times", "seconds"), ["song_id", "stem"], "left")
    return out.select("song_id", "stem", (F.col("num_frames") / F.col("sample_rate")).alias("duration_s"), "tempo_bpm", "beat_times", "sample_rate", "num_channels", "error", F.coalesce("seconds", F.lit(0.0)).alias("seconds"))


def run(spark: SparkSession, wav_path: str, midi_path: str | None, out: str, config: Config = Config()) -> dict[str, str]:
    """Read a folder of songs (a folder each), write the tables and reports under ``out``; returns their paths.

    Songs whose last attempt the ledger calls a success are left out if the configuration says so: nothing of theirs is written again. A file that can't be read is an error of its song,
    which is tried again up to ``max_retries`` times, alone; then the song's other files count, or the run ends if the configuration says so. ``results`` has a row
    per song of this run: status, path, error, attempts, seconds, tempo, duration, bars."""
    at_once = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(at_once)
    spark.conf.set(at_once, str(SONGS_AT_ONCE if config.preprocess else BLOCKS_AT_ONCE))
    try:
        return _run(spark, wav_path, midi_path, out.rstrip("/"), config)
    finally:
        spark.conf.set(at_once, before)


def _run(spark: SparkSession, wav_path: str, midi_path: str | None, out: str, config: Config) -> dict[str, str]:
    steps, ledger = batch.Steps(spark, config.max_retries, config.step_timeout_s), batch.Ledger(spark, f"{out}/ledger")
    work, paths = f"{out}/.work", {}
    listed = audio.list_files(spark, wav_path, compat=config.compat)
    songs = steps.run("files", lambda: saved(listed.groupBy("song_id").agg(F.min("path").alias("input_path"))))
    todo = ledger.left(songs, "run").select("song_id") if config.skip_existing else songs.select("song_id")
    todo = saved(todo)
    every, pending, attempt, kept = todo, todo, 0, None
    while True:
        attempt += 1
        at, again = f"{work}/attempt={attempt}", pending
        blocks = sound(spark, wav_path, config, features.ANALYSIS_CONTEXT).join(F.broadcast(again) if attempt > 1 else again, "song_id", "left_semi")
        steps.run("analyse", lambda at=at, blocks=blocks: heard(blocks).write.mode("overwrite").parquet(f"{at}/heard"))
        now = spark.read.schema(_HEARD).parquet(f"{at}/heard")
        scores = _scores(spark, midi_path, config, again)
        steps.run("notes", lambda at=at, scores=scores: scores.write.mode("overwrite").parquet(f"{at}/scores"))
        scores = spark.read.schema(scores.schema).parquet(f"{at}/scores")
        faults = now.select("song_id", "stem", "error", "seconds").unionByName(scores.select("song_id", "stem", "error", "seconds"))
        tried = again.join(faults.groupBy("song_id").agg(F.min("error").alias("error"), F.sum("seconds").alias("seconds")), "song_id", "left")
        tried = tried.select("song_id", F.when(F.col("error").isNull(), "success").otherwise("failed").alias("state"), F.lit(attempt).alias("attempt"), F.coalesce("seconds", F.lit(0.0)).alias("seconds"), "error")
        ledger.record(tried, "read")
        # songs that failed are tried once more; what this attempt found of the others stands
        failed = saved(tried.where("state = 'failed'").select("song_id"))
        last = attempt > config.max_retries or failed.isEmpty()
        stand = lambda df, failed=failed, last=last: df if last else df.join(failed, "song_id", "left_anti")
        kept = (stand(now), stand(scores)) if kept is None else (kept[0].unionByName(stand(now)), kept[1].unionByName(stand(scores)))
        if last:
            break
        pending = failed
    found, scores = kept
    errors = found.where("error is not null").select("song_id", "stem", "error").unionByName(scores.where("error is not null").select("song_id", "stem", "error"))
    steps.run("errors", lambda: reports.write_json(errors, f"{out}/errors"))
    if config.stop_on_error and not failed.isEmpty():
        raise RuntimeError(f"some files can't be read, see {out}/errors")

    def table(name: str, rows: DataFrame) -> DataFrame:
        """Written by song, and the rows of this run's songs read back."""
        paths[name] = f"{out}/{name}"
        steps.run(name, lambda: reports.write_dataset(rows, paths[name]))
        return spark.read.schema(rows.schema).parquet(paths[name]).join(every, "song_id", "left_semi").select(*rows.columns)

    own = found.where("beat_times is not null").select("song_id", "duration_s", "tempo_bpm", "beat_times")
    stems = found.where("error is null").select("song_id", "stem")
    mono = features.beats_of(own)
    beats = table("beats", bars.beats_by_stem(mono, stems).select("song_id", "stem", "beat_index", "time_s", "tempo_bpm"))
    beats = beats.groupBy("song_id", "beat_index").agg(F.first("time_s").alias("time_s"))
    notes = scores.where("error is null").select("song_id", "stem", F.inline("notes"))
    bar_grid = table("bar_grid", grid.bar_grid(beats, own.select("song_id", "duration_s"), config.ts_num, config.ts_den))
    until = notes.groupBy("song_id").agg(F.max("end_s").alias("until_s"))
    events = table("events", align.align(notes, grid.extend(beats, until, compat=config.compat), config.ts_num, config.ts_den, config.compat))
    made = table("bars", bars.bars(events))
    measured = _bar_features(spark, wav_path, out, config, steps, every, own, bar_grid, work)
    table("bar_features", measured.drop("seconds"))

    counts = lambda df, name: df.groupBy("song_id").agg(F.count(F.lit(1)).alias(name))
    per_stem = stems.join(made.groupBy("song_id", "stem").agg(F.sum("num_notes").alias("num_notes")), ["song_id", "stem"], "full").join(measured.groupBy("song_id", "stem").agg(F.count(F.lit(1)).alias("num_bars"), F.avg("rms").alias("rms_mean")), ["song_id", "stem"], "left")
    stem_rows = per_stem.groupBy("song_id").agg(F.collect_list(F.struct("stem", "num_notes", "num_bars", "rms_mean")).alias("stems"), F.count(F.lit(1)).alias("num_stems"))
    summary = own.select("song_id", "duration_s", "tempo_bpm").join(counts(beats, "num_beats"), "song_id", "left").join(counts(bar_grid, "num_bars"), "song_id", "left").join(counts(events, "num_notes"), "song_id", "left").na.fill(0).join(stem_rows, "song_id", "left")
    summary = table("song_summary", summary)

    seconds = ledger.rows().where("step = 'read'").join(every, "song_id", "left_semi").groupBy("song_id").agg(F.max_by(F.struct("state", "attempt", "error"), F.struct("at", "attempt")).alias("r"))
    reading = found.groupBy("song_id").agg(F.sum("seconds").alias("a")).join(scores.groupBy("song_id").agg(F.sum("seconds").alias("b")), "song_id", "full").join(measured.groupBy("song_id").agg(F.sum("seconds").alias("c")), "song_id", "full")
    total = reading.select("song_id", sum((F.coalesce(c, F.lit(0.0)) for c in "abc"), F.lit(0.0)).alias("seconds"))
    tried = saved(seconds.select("song_id", "r.*").join(total, "song_id", "left").na.fill(0.0, ["seconds"]))
    status = summary.join(tried.select("song_id", F.col("state").alias("status"), F.col("attempt").alias("attempts"), "seconds"), "song_id", "left")
    texts = [(reports.markdown(events), "notes.md"), (reports.abc(events), "tune.abc")]
    by_stem = texts[0][0].select("song_id", "stem", F.lit(texts[0][1]).alias("name"), F.col("text").alias("content")).unionByName(texts[1][0].select("song_id", "stem", F.lit(texts[1][1]).alias("name"), F.col("text").alias("content")))
    steps.run("report notes", lambda: files.write_files(by_stem, f"{out}/reports/stems"))
    steps.run("report summary", lambda: files.write_files(reports.summary(status).select("song_id", F.lit("summary.md").alias("name"), F.col("text").alias("content")), f"{out}/reports/songs"))
    if config.compat == "b":
        steps.run("report lines", lambda: reports.write_lines(reports.markdown_lines(events), f"{out}/reports/lines"))
        paths["wide_features"] = f"{out}/wide_features"
    ledger.record(tried, "run")
    results = songs.join(tried, "song_id", "left").join(summary.select("song_id", "tempo_bpm", "duration_s", "num_bars"), "song_id", "left")
    shown = F.coalesce("state", F.lit("skipped")).alias("status")
    reports.write_json(results.select("song_id", "input_path", shown, "error", F.col("attempt").alias("attempts"), F.round("seconds", 3).alias("seconds"), "tempo_bpm", "duration_s", "num_bars"), f"{out}/results")
    facts = {
        "config": F.to_json(F.create_map(*(F.lit(x) for k, v in asdict(config).items() for x in (k, str(v))))),
        "environment": F.create_map(*(F.lit(x) for pair in (("spark", spark.version), ("pyspark", pyspark.__version__), ("python", platform.python_version()), ("platform", platform.platform())) for x in pair)),
        "capabilities": F.create_map(*(F.lit(x) for r in batch.health(spark).collect() for x in (r["tool"], r["available"]))),
        "step_seconds": F.create_map(*(F.lit(x) for pair in steps.seconds.items() for x in pair)),
    }
    written = F.array(*(F.lit(p) for p in sorted(paths.values())))
    reports.write_songs(status.withColumns(facts | {"tables": written}), f"{out}/analysis")
    return paths


def _scores(spark: SparkSession, midi_path: str | None, config: Config, songs: DataFrame) -> DataFrame:
    if midi_path:
        return midi.read_scores(audio.read_files(spark, midi_path, "*.mid*", compat=config.compat).join(songs, "song_id", "left_semi"), config.compat)
    fields = ", ".join(f"{c.split()[0]}: {c.split()[1]}" for c in schemas.NOTES.split(", ")[2:])
    return spark.createDataFrame([], f"song_id string, stem string, notes array<struct<{fields}, note_ix: bigint>>, error string, seconds double")


def _bar_features(spark: SparkSession, wav_path: str, out: str, config: Config, steps: batch.Steps, songs: DataFrame, own: DataFrame, bar_grid: DataFrame, work: str) -> DataFrame:
    """Features of every bar and stem, and the bars' files. Songs of many bars take them from frames that are made once; bars without a frame, and other songs, from
    the bar's own samples. The other variant's table, one wide row a bar with its own tempo, is written as it is."""
    sounds = features.bar_sounds(sound(spark, wav_path, config).join(songs, "song_id", "left_semi"), bar_grid).persist()
    try:
        counts = bar_grid.groupBy("song_id").agg(F.count(F.lit(1)).alias("k"))
        many = saved(own.join(counts, "song_id").where(many_bars(F.col("k"), F.col("duration_s"))).select("song_id"))
        names = [c.split()[0] for c in tables.RECORD.split(", ")]
        keys, facts = ["song_id", "stem", "bar_index"], ["start_s", "end_s"]
        direct, made = sounds, None
        if not many.isEmpty():
            blocks = sound(spark, wav_path, config, features.ANALYSIS_CONTEXT).join(many, "song_id", "left_semi")
            # zcr, rms and the others of the record under its names
            made = frames.precomputed_bar_features(blocks, sounds.join(many, "song_id", "left_semi"), bar_grid.join(many, "song_id", "left_semi"), config)
            made = saved(made.select(*keys, *facts, *names, "seconds"))
            direct = sounds.join(made.select(*keys), keys, "left_anti")
        found = features.sound_features(direct).select(*keys, *facts, *names, "seconds")
        found = found if made is None else found.unionByName(made)
        path = files.place_of(f"{out}/chunks", F.col("song_id"), F.col("stem"), chunks.chunk_name()) if config.write_chunks else F.lit("")
        whole = found.join(own.select("song_id", "tempo_bpm"), "song_id", "left").withColumns({"duration_s": F.col("end_s") - F.col("start_s"), "tempo_bpm": F.coalesce("tempo_bpm", F.lit(0.0)), "chunk_path": path, "audio_source": F.when(F.col("stem") == "full_mix", "analysis_fallback").otherwise("stem")})
        columns = [c.split()[0] for c in schemas.BAR_FEATURES.split(", ")]
        steps.run("bar features", lambda: whole.select(*columns, "seconds").write.mode("overwrite").parquet(f"{work}/features"))
        if config.compat == "b":
            wide = features.sound_features(sounds, dsp.variant_features, tables.VARIANT_RECORD).withColumns({"duration_s": F.col("end_s") - F.col("start_s"), "chunk_path": path})
            steps.run("wide features", lambda: reports.write_dataset(wide.select(*keys, *facts, "duration_s", *dsp.VARIANT_FIELDS, "chunk_path"), f"{out}/wide_features"))
        if config.write_chunks:
            steps.run("chunks", lambda: files.write_files(chunks.chunk_files(sounds, config.native_chunks), f"{out}/chunks"))
    finally:
        sounds.unpersist()
    return spark.read.schema(schemas.BAR_FEATURES + ", seconds double").parquet(f"{work}/features")
