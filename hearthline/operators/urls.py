"""Which areas to search, and the URLs that search them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.functions.clock import instant
from hearthline.model import AREAS_PER_BATCH, DATE_HOUR

_KEPT = ("zip", "state_id", "state_name", "population")


def _top(areas: DataFrame, order: Column, n: int) -> DataFrame:
    # Sort and limit become one top-n: a task keeps n rows, nothing is sorted whole.
    return areas.where(F.col("population").isNotNull()).orderBy(order).limit(n).select(*_KEPT)


def sample_areas(areas: DataFrame, n: int = AREAS_PER_BATCH, seed: int | None = None) -> DataFrame:
    """``n`` populated areas, each as likely as any other."""
    return _top(areas, F.rand() if seed is None else F.rand(seed), n)


def sample_areas_by_hash(areas: DataFrame, n: int = AREAS_PER_BATCH, salt: str = "") -> DataFrame:
    """The repeatable form: the same areas every time, others for another salt."""
    return _top(areas, F.md5(F.concat(F.col("zip"), F.lit(salt))), n)


def build_urls(
    areas: DataFrame,
    api_url: str,
    referral_url: str,
    as_of: datetime | None = None,
    dashes: bool = True,
) -> DataFrame:
    """Add the request URL, the referring URL and the hour of processing.

    ``api_url`` has one ``%s`` for the zip; ``referral_url`` three, for zip,
    state id and state name (with dashes for spaces unless told otherwise).
    """
    now = instant(as_of)
    if dashes:
        areas = areas.withColumn("state_name", F.replace("state_name", F.lit(" "), F.lit("-")))
    zipcode, state = F.col("zip").cast("string"), F.col("state_id").cast("string")
    return areas.withColumns(
        {
            "api_url": F.format_string(api_url, zipcode),
            "refereral_url": F.format_string(referral_url, zipcode, state, F.col("state_name")),
            "processed_datehour": F.date_format(now, DATE_HOUR),
        }
    )


def build_batch_urls(
    batches: DataFrame, api_url: str, referral_url: str, as_of: datetime | None = None, dashes: bool = True
) -> DataFrame:
    """The same over CSV batches; ``batch_id`` becomes the time of processing."""
    now = instant(as_of)
    return build_urls(batches, api_url, referral_url, as_of, dashes).withColumn("batch_id", now)


def url_list(
    areas: DataFrame, api_url: str, referral_url: str, as_of: datetime | None = None, dashes: bool = True
) -> DataFrame:
    """The batch task's table: area, URLs and hour only."""
    return build_urls(areas, api_url, referral_url, as_of, dashes).select(
        "zip", "state_id", "state_name", "api_url", "refereral_url", "processed_datehour"
    )
