"""From parsed rows to reference listings."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.functions.clock import day
from hearthline.functions.text import is_number


def valid_zip(listings: DataFrame, kind: str = "double") -> DataFrame:
    """Keep rows whose zip is a number; see ``functions.text.is_number``."""
    return listings.where(is_number(F.col("zip"), kind))


def with_defaults(listings: DataFrame, as_of: date | datetime | None = None) -> DataFrame:
    """``mls#`` renamed, no fee means ``'0'``, and the age of the house."""
    return (
        listings.withColumnRenamed("mls#", "house_mls")
        .withColumn("hoa", F.coalesce("hoa", F.lit("0")))
        .withColumn("age", F.year(day(as_of)) - F.col("yearBuilt"))
    )


def reference_rows(
    listings: DataFrame, as_of: date | datetime | None = None, kind: str = "double"
) -> DataFrame:
    """Defaults and the zip filter; what is left is to keep one row per property."""
    return valid_zip(with_defaults(listings, as_of), kind)
