"""Watermarks: what has been processed, and which rows are new.

A run takes the half-open window from the last mark, inclusive, to a fixed upper
bound, exclusive, and the bound becomes the next mark: rows that share a time are
either all in a window or all in a later one.  The bound must lie behind every
write still on its way; without ``as_of`` it is ``SETTLE`` ago.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.functions.clock import day
from hearthline.model import CONTROL_SCHEMA, FIRST_WATERMARK, MAX_DAYS_BACK
from hearthline.sources.tables import find_table, write_table


SETTLE = timedelta(hours=1)


def upper_bound(as_of: datetime | None) -> datetime:
    """The end of a window: ``as_of``, or the time by which writes have settled."""
    return as_of or datetime.now(timezone.utc) - SETTLE


def high_watermark(
    spark: SparkSession,
    table: str,
    column: str = "ingestion_timestamp",
    base: str | None = None,
    default: str = FIRST_WATERMARK,
) -> datetime:
    """Newest time in a table; the default if it is empty or not there yet."""
    found = find_table(spark, table, base)
    first = F.lit(default).cast("timestamp")
    if found is None:
        return spark.range(1).select(first).first()[0]
    return found.agg(F.coalesce(F.max(F.col(column).cast("timestamp")), first)).first()[0]


def newer_than(df: DataFrame, watermark: Column | datetime, column: str = "ingestion_timestamp") -> DataFrame:
    """Rows strictly newer than the watermark; the bound reaches the scan."""
    bound = watermark if isinstance(watermark, Column) else F.lit(watermark)
    return df.where(F.col(column) > bound)


def within(df: DataFrame, lower: Column | datetime, upper: datetime, column: str = "ingestion_timestamp") -> DataFrame:
    """Rows of the window from ``lower`` to just before ``upper``; both bounds reach the scan."""
    bound = lower if isinstance(lower, Column) else F.lit(lower)
    return df.where((F.col(column) >= bound) & (F.col(column) < F.lit(upper)))


def control_watermark(
    control: DataFrame, as_of: datetime | None = None, days_back: int = MAX_DAYS_BACK
) -> Column:
    """Where the last window ended, by the control table, or ``days_back`` days ago.

    A scalar subquery of one value: Spark runs it once and hands the result to
    the scan as a pushed filter, which it could not do with a ``coalesce``
    around the subquery.
    """
    fallback = F.date_sub(day(as_of), days_back).cast("timestamp")
    return control.agg(F.coalesce(F.max("last_processed_ts"), fallback).alias("bound")).scalar()


def new_listings(
    listings: DataFrame,
    features: DataFrame,
    control: DataFrame,
    as_of: datetime | None = None,
    days_back: int = MAX_DAYS_BACK,
) -> DataFrame:
    """Listings of the window not yet turned into vectors, with their features."""
    fresh = within(listings, control_watermark(control, as_of, days_back), upper_bound(as_of))
    return fresh.join(features.select("propertyId", "top_features"), "propertyId")


def oldest_waiting(
    listings: DataFrame,
    features: DataFrame,
    control: DataFrame,
    as_of: datetime | None = None,
    days_back: int = MAX_DAYS_BACK,
) -> datetime | None:
    """The time of the oldest listing of the window that has no features yet."""
    fresh = within(listings, control_watermark(control, as_of, days_back), upper_bound(as_of))
    waiting = fresh.join(features.select("propertyId"), "propertyId", "left_anti")
    return waiting.agg(F.min("ingestion_timestamp")).first()[0]


def empty_control(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CONTROL_SCHEMA)


def read_control(spark: SparkSession, name: str, base: str | None = None) -> DataFrame:
    found = find_table(spark, name, base)
    return empty_control(spark) if found is None else found


def record_push(
    spark: SparkSession,
    name: str,
    processed: datetime,
    pushed: datetime,
    base: str | None = None,
) -> int:
    """Append a control row; returns its batch id, one above the last."""
    last = read_control(spark, name, base).agg(F.coalesce(F.max("batch_id"), F.lit(0))).first()[0]
    row = spark.createDataFrame([(processed, pushed, last + 1)], CONTROL_SCHEMA)
    write_table(row.coalesce(1), name, base)
    return last + 1
