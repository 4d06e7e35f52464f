"""Column functions over sample arrays; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _fold(x: Column, step) -> Column:
    return F.aggregate(x, F.lit(0.0), step)


def energy(x: Column) -> Column:
    return _fold(x, lambda a, v: a + v.cast("double") * v.cast("double"))


def rms(x: Column) -> Column:
    return F.when(F.size(x) > 0, F.sqrt(energy(x) / F.size(x))).otherwise(0.0)


def mean(x: Column) -> Column:
    return F.when(F.size(x) > 0, _fold(x, lambda a, v: a + v.cast("double")) / F.size(x))


def std(x: Column) -> Column:
    """Population standard deviation."""
    m = mean(x)
    return F.when(F.size(x) > 0, F.sqrt(_fold(F.transform(x, lambda v: F.pow(v.cast("double") - m, 2.0)), lambda a, v: a + v) / F.size(x)))


def row_stats(matrix: Column) -> tuple[Column, Column]:
    """Mean and population deviation of each row of an array of arrays."""
    return F.transform(matrix, mean), F.transform(matrix, std)


def zero_crossing_rate(x: Column) -> Column:
    """Share of neighbours whose signs differ, zero counting as positive."""
    rest = F.slice(x, 2, F.greatest(F.size(x) - 1, F.lit(1)))
    changes = F.zip_with(F.slice(x, 1, F.greatest(F.size(x) - 1, F.lit(1))), rest, lambda a, b: ((a < 0) != (b < 0)).cast("double"))
    return F.when(F.size(x) > 1, _fold(changes, lambda a, v: a + v) / F.size(x)).otherwise(0.0)


def valid(x: Column, rate: Column) -> Column:
    """Samples that can be analysed: some, at a positive rate, all finite numbers."""
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce((F.size(x) > 0) & (rate > 0) & ~bad, F.lit(False))


def downmix(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: (a + b) / 2)


def peak_normalize(x: Column, peak: float = 1.0) -> Column:
    most = F.array_max(F.transform(x, F.abs))
    return F.when(most > 0, F.transform(x, lambda v: v / most * peak)).otherwise(x)


def to_int16(x: Column) -> Column:
    """Clip to [-1, 1], scale by 32767, drop the fraction."""
    return F.transform(x, lambda v: (F.greatest(F.lit(-1.0), F.least(F.lit(1.0), v.cast("double"))) * 32767).cast("int"))


def from_int16(x: Column) -> Column:
    return F.transform(x, lambda v: v / 32768.0)


def decimate(x: Column, most: int = 100_000) -> Column:
    """Every k-th sample, so that at most about ``most`` are left."""
    k = F.greatest(F.lit(1), F.floor(F.size(x) / most)).cast("int")
    return F.filter(x, lambda v, i: F.pmod(i, k) == 0)
