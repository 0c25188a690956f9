"""The batch tasks: make URLs, gather responses, parse what is new."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.model import FIRST_WATERMARK, NEARBY_HOMES
from hearthline.operators.increment import read_control, record_push, upper_bound, within
from hearthline.operators.parse import parse_listings
from hearthline.operators.urls import sample_areas, url_list
from hearthline.sources.responses import TIMEOUT, Transport, fetch_responses
from hearthline.sources.tables import read_table, replace_parts, write_table


def generate_urls(
    areas: DataFrame,
    target: str,
    api_url: str,
    referral_url: str,
    n: int = 20,
    seed: int | None = None,
    as_of: datetime | None = None,
    base: str | None = None,
) -> None:
    """Replace the URL table by ``n`` sampled areas, partitioned by hour."""
    urls = url_list(sample_areas(areas, n, seed), api_url, referral_url, as_of)
    write_table(urls, target, base, "overwrite", ("processed_datehour",))


def gather_responses(
    spark: SparkSession,
    urls: str,
    target: str,
    transport: Transport,
    as_of: datetime | None = None,
    base: str | None = None,
    tasks: int | None = None,
    threads: int = 1,
    timeout: float = TIMEOUT,
) -> None:
    """Fetch every URL in the executors and append the responses, by day."""
    wanted = read_table(spark, urls, base)
    fetched = fetch_responses(wanted, transport, as_of, tasks, threads, timeout)
    write_table(fetched, target, base, partition_by=("processed_date",))


def new_responses(raw: DataFrame, lower: datetime, upper: datetime) -> DataFrame:
    """Responses of the window; whole days outside it are not read."""
    days = F.col("processed_date").between(F.lit(lower.date()), F.lit(upper.date()))
    return within(raw.where(days), lower, upper)


def parse_new(
    spark: SparkSession,
    raw: str,
    target: str,
    homes_path: str = NEARBY_HOMES,
    as_of: datetime | None = None,
    base: str | None = None,
) -> None:
    """Parse the responses that have come since the last run and add their listings.

    The window starts where the last one ended, by the control table
    ``<target>_control``, and ends at ``as_of``.  A run's listings are one part of
    the target, which a run that is done again replaces; the control row comes last.
    """
    control, end = f"{target}_control", upper_bound(as_of)
    seen = read_control(spark, control, base)
    first = F.lit(FIRST_WATERMARK).cast("timestamp")
    mark, run = seen.agg(F.coalesce(F.max("last_processed_ts"), first), F.coalesce(F.max("batch_id"), F.lit(0)) + 1).first()
    fresh = new_responses(read_table(spark, raw, base), mark, end)
    listings = parse_listings(fresh, homes_path, ingested=F.col("ingestion_timestamp"))
    replace_parts(listings.withColumn("parse_run", F.lit(run)), target, ("parse_run",), base)
    record_push(spark, control, end, end, base)
