"""One response row per URL, from a transport or from captured responses."""

from __future__ import annotations

import json
import queue
import threading
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.functions.clock import instant
from hearthline.functions.text import error_body
from hearthline.model import RESPONSE_SCHEMA

# (url, referer, timeout in seconds) -> (status code, body); may raise.
Transport = Callable[[str, str, float], tuple[int, str]]

FAILED = 500
TIMEOUT = 10.0
_ROWS_PER_FRAME = 64  # bodies are large: few of them are held at a time
HUNG = 16  # calls of a task that may hang besides those it waits for


def fetch_responses(
    urls: DataFrame,
    transport: Transport,
    as_of: datetime | None = None,
    tasks: int | None = None,
    threads: int = 1,
    timeout: float = TIMEOUT,
    rate: float | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Call ``transport`` once per row, in the executors.

    ``urls`` has ``zip, api_url, refereral_url``.  A call that raises gives
    status 500 and its message as JSON; other statuses are kept as they come.  So
    does one that is not back after ``timeout`` seconds, whatever it does with the
    timeout it is given: it costs its own row and a thread, not the task.  While
    ``threads + HUNG`` calls of a task are out, the next waits ``timeout`` seconds for
    one to end and fails, uncalled, if none does.

    URLs are dealt out to ``tasks`` tasks, two per core unless said otherwise: a row
    is small and its call is slow, so a scan would put far too many in one task.
    ``threads`` overlaps the waiting within a task.  A lost task fetches its rows
    again, as any retry does.

    With ``rate``, a host gets at most so many calls a second: each task takes its
    share, ``rate / tasks``, and spaces its calls to a host evenly.  A host's calls are
    dealt over all tasks, so one that has most of the URLs still gets its full rate.

    ``carry`` names integer columns of ``urls`` that are handed through.
    """
    tasks = tasks or 2 * urls.sparkSession.sparkContext.defaultParallelism
    names = [part.split()[0] for part in RESPONSE_SCHEMA.split(", ")] + list(carry)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slots = threading.BoundedSemaphore(threads + HUNG)
        pace = _Pace(rate / tasks) if rate else None

        def call(row: tuple) -> tuple:
            area, url, referer, *rest = row
            try:
                if pace:
                    pace.wait(url)
                status, text = _in_time(lambda: transport(url, referer, timeout), timeout, slots)
            except Exception as error:  # a failed request is a result, not a failed job
                status, text = FAILED, json.dumps({"error": str(error)})
            now = as_of or datetime.now(timezone.utc).replace(tzinfo=None)
            return area, url, text, status, now, now.date(), now.hour, *rest

        with ThreadPoolExecutor(threads) as pool:
            for frame in frames:
                rows = list(frame.itertuples(index=False, name=None))
                for start in range(0, len(rows), _ROWS_PER_FRAME):
                    done = pool.map(call, rows[start : start + _ROWS_PER_FRAME])
                    yield pd.DataFrame(list(done), columns=names)

    wanted = urls.select(F.col("zip").cast("string"), "api_url", "refereral_url", *carry)
    return wanted.repartition(tasks).mapInPandas(run, RESPONSE_SCHEMA + "".join(f", {name} int" for name in carry))


class _Pace:
    """Spaces calls to one host evenly, at most ``rate`` a second."""

    def __init__(self, rate: float) -> None:
        self.step, self.lock, self.free = 1 / rate, threading.Lock(), {}

    def wait(self, url: str | None) -> None:
        host = urlsplit(url or "").netloc
        with self.lock:
            now = time.monotonic()
            turn = max(now, self.free.get(host, now))
            self.free[host] = turn + self.step
        time.sleep(turn - now)


def _in_time(call: Callable, seconds: float, slots: threading.BoundedSemaphore):
    """The result of ``call``, or a TimeoutError; a call that hangs keeps its slot."""
    done: queue.SimpleQueue = queue.SimpleQueue()

    def run() -> None:
        try:
            done.put((call(), None))
        except Exception as error:
            done.put((None, error))
        finally:
            slots.release()

    if not slots.acquire(timeout=seconds):
        raise TimeoutError(f"too many calls hang; not called in {seconds:g} s")

    threading.Thread(target=run, daemon=True).start()
    try:
        result, error = done.get(timeout=seconds)
    except queue.Empty:
        raise TimeoutError(f"no response in {seconds:g} s") from None
    if error is not None:
        raise error
    return result


def captured_responses(urls: DataFrame, captures: DataFrame, as_of: datetime) -> DataFrame:
    """The same rows from a table of captured bodies (``url, body``).

    ``captures`` must have one row per url: every further one gives one more response.

    A plain outer join: Spark broadcasts the captures if they are small, and
    splits a hot url's partition if they are not.
    """
    now = instant(as_of)
    hit = F.col("url").isNotNull()
    return urls.join(captures.select("url", "body"), F.col("api_url") == F.col("url"), "left").select(
        F.col("zip").cast("string").alias("zipcode"),
        F.col("api_url").alias("source_url"),
        F.when(hit, F.col("body"))
        .otherwise(error_body(F.concat(F.lit("no response for "), F.col("api_url"))))
        .alias("raw_json"),
        F.when(hit, 200).otherwise(FAILED).alias("http_status_code"),
        now.alias("ingestion_timestamp"),
        F.to_date(now).alias("processed_date"),
        F.hour(now).alias("processed_hour"),
    )
