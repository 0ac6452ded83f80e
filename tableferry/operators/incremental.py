"""Loading only what is new."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.nested import quoted


def _values(df: DataFrame, column: str, *wanted: Callable[[Column], Column]) -> list[Column | None]:
    """Aggregates of a column as literals, ``None`` where there is none; one job.

    Times travel as microseconds, as a Python datetime would pass through the
    driver's own time zone.
    """
    is_time = isinstance(df.schema[column].dataType, T.TimestampType)
    found = df.agg(*[(F.unix_micros(f(quoted(column))) if is_time else f(quoted(column))).alias(f"v{i}") for i, f in enumerate(wanted)]).first()
    return [None if v is None else F.timestamp_micros(F.lit(v)) if is_time else F.lit(v) for v in found]


def high_water_mark(target: DataFrame, column: str) -> Column | None:
    """The largest value the target holds, as a literal, or ``None`` when it holds none."""
    return _values(target, column, F.max)[0]


def rows_above(df: DataFrame, column: str, mark: Column | None) -> DataFrame:
    """Rows above a mark; all rows when there is none. A literal mark is pushed into the scan."""
    if mark is None:
        return df
    return df.filter(quoted(column) > mark.cast(df.schema[column].dataType))


def incremental(df: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """Source rows above the target's high-water mark. The mark is the one value fetched.

    A row without a value has no place above or below a mark and would never be
    loaded, so such a source is refused; ``incremental_by_key`` takes it.
    """
    mark = high_water_mark(target, column)
    if mark is not None and df.filter(quoted(column).isNull()).limit(1).count():
        raise ValueError(f"{column} holds nulls, which no high-water mark can pass; name a key as well")
    return rows_above(df, column, mark)


def incremental_by_key(df: DataFrame, target: DataFrame, column: str, key: list[str]) -> DataFrame:
    """Source rows at or above the mark, or without a value, whose key the target lacks: late rows that tie with the mark are loaded."""
    mark = high_water_mark(target, column)
    if mark is not None:
        df = df.filter((quoted(column) >= mark.cast(df.schema[column].dataType)) | quoted(column).isNull())
    return rows_not_in(df, target, key)


def key_range(df: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """The part of ``target`` whose ``column`` lies within the values of ``df``: two values are fetched, and they prune the scan."""
    low, high = _values(df, column, F.min, F.max)
    if low is None:
        return target.limit(0)
    return target.filter(quoted(column).between(low, high))


def rows_not_in(df: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """Source rows whose key the target lacks, so that a repeated append adds nothing.

    Rows with a null in the key can match nothing; they bypass the join, where
    they would all meet in one task.
    """
    keys = target.select(*[quoted(k).alias(f"__k{i}") for i, k in enumerate(key)])
    matches = reduce(lambda a, b: a & b, [quoted(k) == F.col(f"__k{i}") for i, k in enumerate(key)])
    whole_key = reduce(lambda a, b: a & b, [quoted(k).isNotNull() for k in key])
    missing = df.filter(whole_key).join(keys, matches, "left_anti")
    return missing.unionByName(df.filter(~whole_key))
