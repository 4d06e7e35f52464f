"""Column functions of musical time and notation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Pitch-class names from C upwards.
PITCH_CLASSES = ("C", "C#", "D", "D#", "E", "F", "F#", "G", "G#", "A", "A#", "B")


def pitch_name(pitch: Column) -> Column:
    names = F.array(*map(F.lit, PITCH_CLASSES))
    return F.concat(F.get(names, (F.pmod(pitch, F.lit(12))).cast("int")), (F.floor(pitch / 12) - 1).cast("string"))


def beats_per_bar(num: float, den: float) -> float:
    """Quarter-note beats in a bar; a signature that isn't positive counts as 4/4."""
    return num * 4.0 / den if num > 0 and den > 0 else 4.0


def bar_count(duration_s: Column, tempo_bpm: Column, num: Column) -> Column:
    return F.ceil(duration_s / (60.0 / tempo_bpm * num))


def many_bars(bars: Column, duration_s: Column) -> Column:
    """Whether features of whole signals should be computed once and then dealt to bars."""
    return (bars > 100) | (duration_s > 180)


def tempo_band(tempo: Column) -> Column:
    out = F.lit("160-200")
    for low, high in ((120, 160), (80, 120), (60, 80), (0, 60)):
        out = F.when(tempo < high, f"{low}-{high}").otherwise(out)
    return out


def backoff_delay(attempt: Column, base: float, factor: float, most: float) -> Column:
    return F.least(F.lit(base) * F.pow(F.lit(factor), attempt), F.lit(most))


def clamped_timeout(megabytes: Column, per_mb: float, least: float, most: float) -> Column:
    return F.least(F.greatest(megabytes * per_mb, F.lit(float(least))), F.lit(float(most)))


def time_to_sample(seconds: Column, rate: Column, rounding: str = "round") -> Column:
    """``round`` (half to even), ``trunc``, or ``ms`` (whole milliseconds first)."""
    if rounding == "ms":
        return ((seconds * 1000).cast("long") * rate / 1000).cast("long")
    return (F.rint(seconds * rate) if rounding == "round" else seconds * rate).cast("long")


def slug(name: Column) -> Column:
    return F.regexp_replace(F.lower(name), "[^a-z0-9]+", "_")


def safe_fft_size(n: Column, most: int = 2048) -> Column:
    """The largest power of two not above n, from 2 to ``most``."""
    return F.greatest(F.lit(2), F.least(F.lit(most), F.pow(F.lit(2.0), F.length(F.bin(F.greatest(n, F.lit(1)))) - 1).cast("int")))


def inferred_duration(beat_times: Column, tempo_bpm: Column) -> Column:
    """The last beat and one more; 0 without beats."""
    return F.coalesce(F.array_max(beat_times) + 60.0 / F.when(tempo_bpm > 0, tempo_bpm).otherwise(120.0), F.lit(0.0))


def first_known(columns: list[str], *names: str, spare: Column | None = None) -> Column:
    """The first of the named columns that is there and not null, else ``spare``."""
    return F.coalesce(*(F.col(n) for n in names if n in columns), F.lit(0.0) if spare is None else spare)


def register(spark) -> list[str]:
    """Registers SQL functions of the same names over columns, and returns the names."""
    forms = {
        "pitch_name": ("pitch INT", "STRING", "concat(element_at(array(" + ", ".join(f"'{n}'" for n in PITCH_CLASSES) + "), cast(pmod(pitch, 12) as int) + 1), cast(cast(floor(pitch / 12) as int) - 1 as string))"),
        "beats_per_bar": ("num DOUBLE, den DOUBLE", "DOUBLE", "if(num > 0 and den > 0, num * 4 / den, 4D)"),
        "quarter_notes": ("dur_s DOUBLE, tempo_bpm DOUBLE", "DOUBLE", "dur_s * tempo_bpm / 60"),
        "signal_rms": ("x ARRAY<DOUBLE>", "DOUBLE", "if(size(x) > 0, sqrt(aggregate(x, 0D, (a, v) -> a + v * v) / size(x)), 0D)"),
        "signal_zcr": ("x ARRAY<DOUBLE>", "DOUBLE", "if(size(x) > 1, size(filter(sequence(1, size(x) - 1), i -> (x[i] < 0) <> (x[i - 1] < 0))) / size(x), 0D)"),
    }
    for name, (args, kind, body) in forms.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {kind} RETURN {body}")
    return list(forms)
