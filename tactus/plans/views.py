"""The driver's tables as notes, beats and signals, in Spark and as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tactus.operators.grid import number_beats


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the song they belong to, one a user, and the seconds since its first: songs grow in number with the data. Times are whole
    milliseconds, so that means of two of them have no more than the six places that are compared."""
    e = table(spark, sf_dir, "events")
    e = e.withColumns({"song_id": F.concat(F.lit("song_"), F.col("user_id").cast("string")), "us": F.unix_millis(F.col("ts").cast("timestamp")) * 1000})
    first = e.groupBy("song_id").agg(F.min("us").alias("first_us"))
    # one row a song is the side that is hashed, so events are neither sorted nor is a table that grows broadcast
    return e.join(first.hint("shuffle_hash"), "song_id").withColumn("start_s", (F.col("us") - F.col("first_us")) / 1e6)


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _timed(spark, sf_dir)
    return e.select(
        "song_id",
        F.col("event_type").alias("stem"),
        F.col("event_id").alias("note_ix"),
        (36 + F.col("event_id") % 61).cast("int").alias("pitch"),
        (1 + F.col("event_id") % 127).cast("int").alias("velocity"),
        "start_s",
        (F.col("start_s") + F.col("value") / 10).alias("end_s"),
        (F.col("value") / 10).alias("dur_s"),
    )


def beats(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _timed(spark, sf_dir).where("event_type = 'signup'")
    return number_beats(e.select("song_id", F.col("start_s").alias("time_s"), "event_id"), "event_id").select("song_id", "beat_index", "time_s")


def durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notes(spark, sf_dir).groupBy("song_id").agg(F.max("end_s").alias("duration_s"))


NOTES_SQL = """timed as (
  select *, (us - min(us) over (partition by song_id)) / 1e6 as start_s
  from (select *, 'song_' || user_id::varchar as song_id, epoch_us(ts) // 1000 * 1000 as us from events)
), notes as (
  select song_id, event_type as stem, event_id as note_ix, (36 + event_id % 61)::integer as pitch, (1 + event_id % 127)::integer as velocity,
         start_s, start_s + value / 10 as end_s, value / 10 as dur_s from timed
), beats as (
  select song_id, row_number() over (partition by song_id order by start_s, event_id) - 1 as beat_index, start_s as time_s
  from timed where event_type = 'signup'
), durations as (select song_id, max(end_s) as duration_s from notes group by song_id
), medians as (
  select song_id, case when median(gap) > 0 then median(gap) else 0.5 end as interval_s, count(*) as n_beats, max(time_s) as last_s
  from (select *, time_s - lag(time_s) over (partition by song_id order by time_s, beat_index) as gap from beats) group by song_id
)"""


def extended_sql(more: int) -> str:
    """The grid extended to the songs' ends."""
    return f"""{NOTES_SQL}, extended as (
  select song_id, beat_index, time_s, false as added from beats
  union all
  select song_id, n_beats + k - 1, last_s + k * interval_s, true
  from (select song_id, n_beats, interval_s, last_s, unnest(range(1, case when last_s < duration_s then ceil((duration_s - last_s) / interval_s)::bigint + {more} else 0 end + 1)) as k
        from medians join durations using (song_id))
)"""


def bars_sql(num: int, den: int) -> str:
    bpb = num * 4.0 / den
    return f"""{extended_sql(1)}, sizes as (select song_id, count(*) as n from extended group by song_id
), spans as (
  select song_id, n, k, floor(k * {bpb})::bigint as a, least(floor(k * {bpb} + {bpb})::bigint, n - 1) as b
  from (select song_id, n, unnest(range(0, ceil(n / {bpb})::bigint)) as k from sizes)
), bar_grid as (
  select s.song_id, k as bar_index, x.time_s as start_s, least(y.time_s, duration_s) as end_s
  from spans s join extended x on x.song_id = s.song_id and x.beat_index = a
  join extended y on y.song_id = s.song_id and y.beat_index = b join durations d on d.song_id = s.song_id
  where least(y.time_s, duration_s) > x.time_s
)"""


def aligned_sql(compat: str, num: int = 4, den: int = 4) -> str:
    """Notes on the extended grid; the extension's beats join by inequality, as the oracle is small."""
    bpb = num * 4.0 / den
    steps = "select song_id, beat_index, time_s, lead(time_s) over (partition by song_id order by time_s, beat_index) as next_s, min(time_s) over (partition by song_id) as first_s, max(time_s) over (partition by song_id) as last_s, count(*) over (partition by song_id) as n from extended"
    ends = "select song_id, min(time_s) as first_s, max(time_s) as last_s, count(*) as n from extended group by song_id"

    def position(col: str, out: str, source: str) -> str:
        if compat == "a":
            inside, outside = f"greatest(r.{col}, e.first_s) >= s.time_s and greatest(r.{col}, e.first_s) < s.next_s", "e.n - 1"
        else:
            inside, outside = f"r.{col} > s.time_s and r.{col} <= s.next_s", f"case when r.{col} <= e.first_s then 0 else e.n end"
        return f"""{out} as (
  select r.*, coalesce(s.beat_index + (r.{col} - s.time_s) / (s.next_s - s.time_s), {outside})::double as {out}_f, coalesce(s.beat_index, {outside})::bigint as {out}_i
  from {source} r join ends e on e.song_id = r.song_id left join steps s on s.song_id = r.song_id and s.next_s > s.time_s and {inside}
)"""

    index = "b1_i" if compat == "a" else "trunc(b1_f)::bigint"
    return f"""{extended_sql(1 if compat == 'a' else 0)}, steps as ({steps}), ends as ({ends}), {position('start_s', 'b1', 'notes')}, {position('end_s', 'b2', 'b1')}, aligned as (
  select song_id, stem, note_ix, pitch, velocity, start_s, end_s, dur_s, {index} as beat_index, trunc(b1_f / {bpb})::bigint as bar_index,
         b1_f - {bpb} * floor(b1_f / {bpb}) as beat_in_bar, b1_f as start_beat_float, b2_f as end_beat_float from b2
)"""
