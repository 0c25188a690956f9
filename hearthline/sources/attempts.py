"""Failed URLs tried again later: the responses are the log of attempts.

Each response row also carries its ``attempt`` number and ``next_attempt``, the
time from which its URL may be tried again; null where it was answered or given
up.  The state of a URL is what its rows say, so there is no second table that could
disagree after a crash: rows that were written count, others are fetched again.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.functions.clock import instant
from hearthline.sources.responses import TIMEOUT, Transport, fetch_responses
from hearthline.sources.tables import find_table, read_table, write_table

ATTEMPTS = 5
FIRST_WAIT = 60.0
LONGEST_WAIT = 6 * 3600.0
ANSWERED = 200


def _of_cycle(log: DataFrame, since: datetime) -> DataFrame:
    """Rows of a fetch cycle; days before it are not read."""
    in_days = F.col("processed_date") >= F.lit(since.date())
    return log.where(in_days & (F.col("ingestion_timestamp") >= instant(since)))


def url_states(log: DataFrame, since: datetime) -> DataFrame:
    """Per URL tried since ``since``: attempts, whether answered, when it is due again.

    Bodies are not read, and a URL's rows are folded before the shuffle.  Where rows
    were written twice, the later attempt tells.
    """
    tried = _of_cycle(log, since)
    return tried.groupBy("source_url").agg(
        F.max("attempt").alias("attempts"),
        F.max(F.col("http_status_code").eqNullSafe(ANSWERED)).alias("answered"),
        F.max_by("next_attempt", F.struct("attempt", "ingestion_timestamp")).alias("next_attempt"),
    )


def due_urls(urls: DataFrame, log: DataFrame | None, since: datetime, as_of: datetime) -> DataFrame:
    """URLs to try now, once each, with the number this attempt will have.

    Due are URLs not tried since ``since``, and failed ones whose time has come.  A URL
    listed more than once takes the least zip and referrer; a null URL is a URL.
    """
    listed = urls.groupBy("api_url").agg(F.min(F.struct(F.col("zip").cast("string").alias("zip"), "refereral_url")).alias("by"))
    listed = listed.select("by.zip", "api_url", "by.refereral_url")
    if log is None:
        return listed.withColumn("attempt", F.lit(1))
    states = url_states(log, since)
    waits = ~F.col("answered") & (F.col("next_attempt") <= instant(as_of))
    return (
        listed.join(states, F.col("api_url").eqNullSafe(F.col("source_url")), "left")
        .where(F.col("attempts").isNull() | waits)
        .select("zip", "api_url", "refereral_url", (F.coalesce("attempts", F.lit(0)) + 1).alias("attempt"))
    )


def with_next_attempt(
    responses: DataFrame, attempts: int = ATTEMPTS, first_wait: float = FIRST_WAIT, longest_wait: float = LONGEST_WAIT
) -> DataFrame:
    """When each response's URL is tried again: waits double, up to ``longest_wait`` seconds."""
    seconds = F.least(F.lit(float(longest_wait)), first_wait * F.pow(F.lit(2.0), F.col("attempt") - 1))
    again = (F.coalesce("http_status_code", F.lit(0)) != ANSWERED) & (F.col("attempt") < attempts)
    later = F.col("ingestion_timestamp") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    return responses.withColumn("next_attempt", F.when(again, later))


def gather_due(
    spark: SparkSession,
    urls: str,
    target: str,
    transport: Transport,
    since: datetime,
    as_of: datetime | None = None,
    base: str | None = None,
    attempts: int = ATTEMPTS,
    first_wait: float = FIRST_WAIT,
    longest_wait: float = LONGEST_WAIT,
    tasks: int | None = None,
    threads: int = 1,
    timeout: float = TIMEOUT,
    rate: float | None = None,
) -> None:
    """Fetch what is due of the cycle that began at ``since``, and append it, by day.

    To be called again and again, by one run at a time: a URL is tried at most
    ``attempts`` times and is answered once.  A run that was cut off leaves whole rows
    or none; the next one takes up what is missing.
    """
    now = as_of or datetime.now(timezone.utc).replace(tzinfo=None)
    due = due_urls(read_table(spark, urls, base), find_table(spark, target, base), since, now)
    fetched = fetch_responses(due, transport, as_of, tasks, threads, timeout, rate, carry=("attempt",))
    rows = with_next_attempt(fetched, attempts, first_wait, longest_wait)
    write_table(rows, target, base, partition_by=("processed_date",))


def answered(log: DataFrame, since: datetime) -> DataFrame:
    """The answer of every URL of the cycle that has one."""
    return _of_cycle(log, since).where(F.col("http_status_code") == ANSWERED)


def given_up(log: DataFrame, since: datetime) -> DataFrame:
    """URLs of the cycle that were tried as often as allowed without an answer."""
    return url_states(log, since).where(~F.col("answered") & F.col("next_attempt").isNull())
