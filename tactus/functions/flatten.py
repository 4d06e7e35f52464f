"""Nested records to flat columns and back, driven by the schema."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tactus.functions import signals


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], T.DataType]]:
    for f in schema:
        if isinstance(f.dataType, T.StructType):
            yield from _leaves(f.dataType, (*path, f.name))
        else:
            yield (*path, f.name), f.dataType


def _at(path: tuple[str, ...]) -> Column:
    out = F.col(f"`{path[0]}`")
    for p in path[1:]:
        out = out[p]
    return out


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """A column per leaf, named by its path; lists stay."""
    return df.select(*(_at(p).alias(sep.join(p)) for p, _ in _leaves(df.schema)))


def flatten_for_files(df: DataFrame, sep: str = "_") -> DataFrame:
    """A column per leaf; lists become comma-joined text."""
    shown = lambda p, t: F.array_join(F.transform(_at(p), lambda x: x.cast("string")), ",") if isinstance(t, T.ArrayType) else _at(p)
    return df.select(*(shown(p, t).alias(sep.join(p)) for p, t in _leaves(df.schema)))


def unflatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Structs from names with separators."""

    def build(names: list[tuple[tuple[str, ...], str]]) -> list[Column]:
        out, heads = [], dict.fromkeys(p[0] for p, _ in names)
        for h in heads:
            under = [(p[1:], c) for p, c in names if p[0] == h]
            out.append(F.col(f"`{under[0][1]}`").alias(h) if under[0][0] == () else F.struct(*build(under)).alias(h))
        return out

    return df.select(*build([(tuple(c.split(sep)), c) for c in df.columns]))


def expand_lists(df: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """Scalar columns, and ``key_00..`` for the listed array columns; other columns that aren't numbers or booleans go."""
    kept = [F.col(f.name) for f in df.schema if isinstance(f.dataType, (T.NumericType, T.BooleanType))]
    return df.select(*kept, *(F.get(c, F.lit(i)).alias(f"{c}_{i:02d}") for c, n in sizes.items() for i in range(n)))


def scalars(df: DataFrame, prefix: str = "") -> DataFrame:
    """Numbers and booleans under ``prefix`` and their name; mean and deviation of lists of numbers; other columns go."""
    out = []
    for f in df.schema:
        if isinstance(f.dataType, (T.NumericType, T.BooleanType)):
            out.append(F.col(f"`{f.name}`").alias(prefix + f.name))
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.NumericType):
            x = F.col(f"`{f.name}`")
            out += [signals.mean(x).alias(f"{prefix}{f.name}_mean"), signals.std(x).alias(f"{prefix}{f.name}_std")]
    return df.select(*out)
