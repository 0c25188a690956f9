"""One row per key.

All forms cut each task's rows to one per key before the shuffle, so a key that
holds a third of the table sends one row per task, not a third of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _one_per_key(df: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    # ``row_number() = 1`` becomes a group limit on both sides of the shuffle.
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(ranked)).where("_row = 1").drop("_row")


def _row_hash(df: DataFrame) -> Column:
    """A hash over all columns but maps, which have no order."""
    return F.xxhash64(*[F.col(f"`{name}`") for name, kind in df.dtypes if "map<" not in kind])


def latest_per_key(df: DataFrame, keys: Sequence[str], time: str, ties: Sequence[str] = ()) -> DataFrame:
    """The newest row of every key; a null key is a key like any other.

    Equal times go to the highest ``ties``, in their order, and then to a hash over
    the row, so that the same row wins however rows were dealt.
    """
    return _one_per_key(df, keys, [*[F.desc(name) for name in (time, *ties)], F.desc(_row_hash(df))])


def first_per_key(df: DataFrame, keys: Sequence[str], time: str, ties: Sequence[str] = ()) -> DataFrame:
    """The row that came first; equal times go to the lowest ``ties``, then to a hash."""
    return _one_per_key(df, keys, [*[F.asc_nulls_first(name) for name in (time, *ties)], F.asc(_row_hash(df))])


def any_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Some row of every key; on a stream, use ``streaming.dedup`` instead."""
    return df.dropDuplicates(list(keys))
