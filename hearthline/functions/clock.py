"""The time a step works with: given, so that results can be repeated, or now."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(as_of: datetime | None = None) -> Column:
    """A naive ``as_of`` is in the session's time zone."""
    return F.current_timestamp() if as_of is None else F.lit(as_of.isoformat(" ")).cast("timestamp")


def day(as_of: date | datetime | None = None) -> Column:
    if as_of is None:
        return F.current_date()
    return F.lit(f"{as_of:%Y-%m-%d}").cast("date")
