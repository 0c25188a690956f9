"""Counts that show the state of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _counts(distinct: dict[str, str], rows: str) -> list[Column]:
    counts = [F.count_distinct(F.col(f"`{column}`")).alias(name) for name, column in distinct.items()]
    return [F.count(F.lit(1)).alias(rows), *counts]


def profile(df: DataFrame, distinct: dict[str, str], rows: str = "row_count") -> DataFrame:
    """One row: all rows, and distinct values per ``{output name: column}``.

    Each distinct count is shuffled by value, so no single task sees them all.
    """
    return df.agg(*_counts(distinct, rows))


def profile_daily(df: DataFrame, time: str, distinct: dict[str, str], rows: str) -> DataFrame:
    """The same per day of ``time``."""
    return df.groupBy(F.to_date(time).alias("extracted_date")).agg(*_counts(distinct, rows))


def status_monitor(responses: DataFrame) -> DataFrame:
    """Requests and areas per day, hour and status code."""
    return responses.groupBy("processed_date", "processed_hour", "http_status_code").agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_distinct("zipcode").alias("total_zipcodes")
    )


def status_counts(responses: DataFrame) -> DataFrame:
    """Requests and areas per status code."""
    return responses.groupBy("http_status_code").agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_distinct("zipcode").alias("total_zipcodes")
    )


def count_by(df: DataFrame, column: str, rows: str = "row_count") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(rows))


def distinct_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """``n`` distinct values, the lowest ones, so that the answer is always the same."""
    return df.select(column).distinct().orderBy(column).limit(n)


LG_ENTRIES = 16  # sketches are exact up to 2^16 distinct values, then within 0.4 % (one sigma)
DAY = "day"


def daily_sketches(df: DataFrame, time: str, distinct: dict[str, str], rows: str, lg_entries: int = LG_ENTRIES) -> DataFrame:
    """Per day of ``time`` the rows and a mergeable sketch of the distinct values per
    ``{output name: column}``: one pass, one shuffle of a sketch per task and day."""
    sketches = [F.theta_sketch_agg(F.col(f"`{column}`"), lg_entries).alias(name) for name, column in distinct.items()]
    return df.groupBy(F.to_date(time).alias(DAY)).agg(F.count(F.lit(1)).alias(rows), *sketches)


def roll_up(sketches: DataFrame, by: dict[str, Column], distinct: dict[str, str], rows: str, lg_entries: int = LG_ENTRIES) -> DataFrame:
    """Rows and distinct counts over any span of days, from the sketches alone.

    ``by`` names what days are added up by, nothing for one row over all.  Counts are
    exact up to ``2^lg_entries`` distinct values, estimates beyond."""
    counts = [
        F.theta_sketch_estimate(F.theta_union_agg(F.col(f"`{name}`"), lg_entries)).cast("bigint").alias(name) for name in distinct
    ]
    return sketches.groupBy(*[c.alias(name) for name, c in by.items()]).agg(F.sum(rows).alias(rows), *counts)
