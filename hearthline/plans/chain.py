"""The whole chain, as one batch plan and as six streaming stages."""

from __future__ import annotations

from collections.abc import Collection
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.functions.clock import instant
from hearthline.model import LISTING_COLUMNS, NEARBY_HOMES
from hearthline.operators.clean import reference_rows
from hearthline.operators.dedup import latest_per_key
from hearthline.operators.features import TextModel, top_features
from hearthline.operators.joins import join_location
from hearthline.operators.parse import parse_listings
from hearthline.operators.urls import build_batch_urls
from hearthline.sources.areas import stream_area_batches
from hearthline.sources.responses import TIMEOUT, Transport, fetch_responses
from hearthline.sources.store import BATCH
from hearthline.sources.tables import MAX_BYTES, stream_table
from hearthline.streaming.dedup import run_first_arrival
from hearthline.streaming.stages import run_stage

# The order among rows of one property and time: several searches may find a home
# at one instant.  ``latest_per_key`` ends it with a hash over the row.
TIES = ("house_mls", "house_price", "listingId", "search_zipcode")
# Listing columns that cleaning and dedup look at.
NEEDED = ("search_zipcode", "mls#", "house_price", "hoa", "zip", "propertyId", "listingId", "yearBuilt")


def latest_listings(
    responses: DataFrame,
    as_of: datetime | None = None,
    homes_path: str = NEARBY_HOMES,
    kind: str = "double",
    columns: Collection[str] = LISTING_COLUMNS,
) -> DataFrame:
    """Responses -> reference listings, the latest row per property.

    ``columns`` must hold those of ``NEEDED``.
    """
    parsed = parse_listings(responses, homes_path, ingested=F.col("ingestion_timestamp"), columns=columns)
    return latest_per_key(reference_rows(parsed, as_of, kind), ["propertyId"], "ingestion_timestamp", TIES)


def located_listings(
    responses: DataFrame,
    locations: DataFrame,
    as_of: datetime | None = None,
    homes_path: str = NEARBY_HOMES,
    columns: Collection[str] = LISTING_COLUMNS,
) -> DataFrame:
    """The same with the statistics of each listing's zip."""
    return join_location(latest_listings(responses, as_of, homes_path, columns=columns), locations)


def run_stream_chain(
    spark: SparkSession,
    batches: str,
    base: str,
    areas: DataFrame,
    transport: Transport,
    api_url: str,
    referral_url: str,
    as_of: datetime | None = None,
    model: TextModel | None = None,
    tasks: int | None = None,
    threads: int = 1,
    timeout: float = TIMEOUT,
    max_bytes: int = MAX_BYTES,
) -> dict[str, DataFrame]:
    """Area batches -> URLs -> responses -> listings -> first per property ->
    located listings and features; returns the table of every stage.

    Each stage reads the table of the one before as a stream, in micro-batches of
    ``max_bytes``, processes what is there and stops; run it again and it handles
    what has come in since.  ``tasks``, ``threads`` and ``timeout`` are those of
    ``fetch_responses``.
    """

    tables: dict[str, DataFrame] = {}

    def stage(name: str, stream: DataFrame) -> DataFrame:
        tables[name] = run_stage(stream, name, base)
        return stream_table(spark, name, base, stream.schema, max_bytes)

    urls = stage("urls", build_batch_urls(stream_area_batches(spark, batches), api_url, referral_url, as_of))
    raw = stage("responses", fetch_responses(urls, transport, as_of, tasks, threads, timeout))
    parsed = stage("listings", parse_listings(raw, ingested=instant(as_of)))
    kept = reference_rows(parsed, as_of)
    tables["reference"] = run_first_arrival(kept, "reference", base, ["propertyId"])
    unique = stream_table(spark, "reference", base, tables["reference"].schema, max_bytes).drop(BATCH)
    stage("located", join_location(unique, areas))
    stage("features", top_features(unique, model))
    return tables
