"""Text reports: note tables per bar, song summaries, ABC notation. Each is a column of text built in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tactus.functions.music import pitch_name

#: The heads of the reports' tables.
HEAD_B = "| Beat | Pitch | Note | Velocity | Start (s) | Duration (s) |\n|------|-------|------|----------|-----------|---------------|"
HEAD = "| Time (s) | Pitch | Note | Velocity | Duration (s) |\n|----------|-------|------|----------|---------------|"


def note_row() -> Column:
    c = F.col
    return F.format_string("| %.3f | %d | %s | %d | %.3f |", c("start_s"), c("pitch"), pitch_name(c("pitch")), c("velocity"), c("end_s") - c("start_s"))


def note_row_b() -> Column:
    c = F.col
    return F.format_string("| %.2f | %d | %s | %d | %.3f | %.3f |", c("beat_in_bar"), c("pitch"), pitch_name(c("pitch")), c("velocity"), c("start_s"), c("dur_s"))


def markdown_lines(events: DataFrame, order: str = "note_ix") -> DataFrame:
    """song_id, place, value: the lines of each song's other form of report, by stem and bar, to be written in the order of place. A row a note, so no row holds a song."""
    at = lambda stem, bar, part, k: F.struct(stem.alias("stem"), bar.cast("long").alias("bar"), F.lit(part).alias("part"), k.cast("long").alias("k"))
    c, none = F.col, F.lit(-1)
    notes = events.select("song_id", at(c("stem"), c("bar_index"), 2, c(order)).alias("place"), note_row_b().alias("value"))
    heads = events.select("song_id", "stem", "bar_index").distinct().select("song_id", at(c("stem"), c("bar_index"), 1, none).alias("place"), F.concat(F.lit("\n### Bar "), c("bar_index").cast("string"), F.lit("\n\n" + HEAD_B)).alias("value"))
    stems = events.select("song_id", "stem").distinct().select("song_id", at(c("stem"), F.lit(-(2**62)), 0, none).alias("place"), F.concat(F.lit("\n## Stem: "), "stem").alias("value"))
    songs = events.select("song_id").distinct().select("song_id", at(F.lit(""), F.lit(-(2**62)), -1, none).alias("place"), F.concat(F.lit("# MIDI Analysis Report: "), "song_id").alias("value"))
    return notes.unionByName(heads).unionByName(stems).unionByName(songs)


def write_lines(lines: DataFrame, path: str) -> None:
    """Lines in order, in as many files a song as its size asks for: parts of a range sort, in the order of their names."""
    lines.repartitionByRange("song_id", "place").sortWithinPartitions("song_id", "place").select("song_id", "value").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("song_id").text(path)


def wide_features(features: DataFrame) -> DataFrame:
    """Bar features as scalar columns: chroma_mean_00.., mfcc_00_mean.., spectral columns, and zcr."""
    has = set(features.columns)
    single = [c for c in features.columns if not dict(features.dtypes)[c].startswith("array")]
    lists = [F.get("chroma_mean", F.lit(i)).alias(f"chroma_mean_{i:02d}") for i in range(12)] if "chroma_mean" in has else []
    lists += [F.get(f"mfcc_{s}", F.lit(i)).alias(f"mfcc_{i:02d}_{s}") for s in ("mean", "std") if f"mfcc_{s}" in has for i in range(13)]
    return features.select(*single, *lists)


def _ordered(text: Column, *order: str) -> Column:
    rows = F.array_sort(F.collect_list(F.struct(*order, text.alias("_t"))))
    return F.array_join(F.transform(rows, lambda r: r["_t"]), "\n")


def markdown(events: DataFrame, order: str = "note_ix") -> DataFrame:
    """song_id, stem, text: the notes of each stem in a table per bar, in the order of ``order`` inside a bar."""
    per_bar = events.groupBy("song_id", "stem", "bar_index").agg(_ordered(note_row(), order).alias("rows"))
    section = F.concat(F.lit("### Bar "), F.col("bar_index").cast("string"), F.lit(f"\n\n{HEAD}\n"), F.col("rows"), F.lit("\n"))
    whole = per_bar.groupBy("song_id", "stem").agg(_ordered(section, "bar_index").alias("body"))
    return whole.select("song_id", "stem", F.concat(F.lit("# MIDI Analysis Report: "), "song_id", F.lit("\n\n## Stem: "), "stem", F.lit("\n\n"), "body").alias("text"))


def abc(events: DataFrame, tempo_bpm: float = 120.0, ts_num: int = 4, ts_den: int = 4) -> DataFrame:
    """song_id, stem, text: notes as ABC tunes with bar lines; lengths are in sixteenths, at least one."""
    letters = F.array(*(F.lit(x) for x in ("C", "^C", "D", "^D", "E", "F", "^F", "G", "^G", "A", "^A", "B")))
    name, octave = F.get(letters, F.pmod("pitch", F.lit(12)).cast("int")), F.floor(F.col("pitch") / 12).cast("int") - 5
    pitch = F.when(octave > 0, F.concat(F.lower(name), F.repeat(F.lit("'"), F.greatest(octave - 1, F.lit(0))))).otherwise(F.concat(name, F.repeat(F.lit(","), F.greatest(-octave, F.lit(0)))))
    length = F.greatest(F.lit(1), F.rint((F.col("end_beat_float") - F.col("start_beat_float")) * 4).cast("int"))
    rows = F.array_sort(F.collect_list(F.struct("start_s", "pitch", F.concat(pitch, length.cast("string")).alias("_t"))))
    per_bar = events.groupBy("song_id", "stem", "bar_index").agg(F.array_join(F.transform(rows, lambda r: r["_t"]), " ").alias("line"))
    body = _ordered(F.concat("line", F.lit(" |")), "bar_index")
    head = f"\nM:{ts_num}/{ts_den}\nL:1/16\nQ:1/4={tempo_bpm:g}\nK:C\n"
    return per_bar.groupBy("song_id", "stem").agg(body.alias("body")).select("song_id", "stem", F.concat(F.lit("X:1\nT:"), "song_id", F.lit(" "), "stem", F.lit(head), "body").alias("text"))


#: Fields of a song's summary: title, column, form.
FIELDS = (("Duration (s)", "duration_s", "%.2f"), ("Tempo (BPM)", "tempo_bpm", "%.2f"), ("Beats", "num_beats", "%d"), ("Bars", "num_bars", "%d"), ("Notes", "num_notes", "%d"), ("Stems", "num_stems", "%d"), ("Status", "status", "%s"), ("Attempts", "attempts", "%d"), ("Work (s)", "seconds", "%.3f"))


def summary(songs: DataFrame) -> DataFrame:
    """song_id, text: a Markdown summary; columns that are missing or null read N/A. A column stems (of stem, num_notes, num_bars, rms_mean) gives a table of them."""
    kinds = dict(songs.dtypes)
    shown = lambda c, form: F.when(F.col(c).isNull(), "N/A").otherwise(F.coalesce(F.format_string(form, F.col(c)), F.lit("N/A"))) if c in kinds else F.lit("N/A")
    lines = [F.concat(F.lit(f"- {title}: "), shown(c, form)) for title, c, form in FIELDS]
    table = []
    if "stems" in kinds:
        cell = lambda c, form: F.when(c.isNull(), "N/A").otherwise(F.format_string(form, c))
        row = lambda s: F.concat(F.lit("| "), s["stem"], F.lit(" | "), cell(s["num_notes"], "%d"), F.lit(" | "), cell(s["num_bars"], "%d"), F.lit(" | "), cell(s["rms_mean"], "%.4f"), F.lit(" |"))
        body = F.array_join(F.transform(F.array_sort("stems"), row), "\n")
        table = [F.lit(""), F.lit("## Stems"), F.lit(""), F.lit("| Stem | Notes | Bars | Mean RMS |\n|------|-------|------|----------|"), F.coalesce(body, F.lit(""))]
    return songs.select("song_id", F.concat_ws("\n", F.concat(F.lit("# Song: "), "song_id"), F.lit(""), *lines, *table).alias("text"))


def write_songs(rows: DataFrame, path: str, form: str = "json") -> None:
    """Rows by song as JSON or Parquet; writing a song again replaces that song's partition only, and an empty table replaces nothing."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("song_id").format(form).save(path)


def write_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def write_csv(rows: DataFrame, path: str) -> None:
    """CSV with a header; arrays become comma-joined text."""
    flat = [F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c) if t.startswith("array") else F.col(c) for c, t in rows.dtypes]
    rows.select(*flat).write.mode("overwrite").csv(path, header=True)


def write_dataset(rows: DataFrame, path: str) -> None:
    write_songs(rows, path, "parquet")
