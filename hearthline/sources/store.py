"""A keyed store: the default target of upserts, and a writer for others.

An upsert appends its rows as one batch folder, and the newest batch of a key
wins when the store is read.  So an upsert costs what it writes, never a rewrite
of the store; doing a batch again replaces its own folder, so a crash between
push and control row does no harm.  ``compact`` folds batches into one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from hearthline.model import UPSERT_CHUNK
from hearthline.operators.dedup import latest_per_key

BATCH = "store_batch"

# Takes up to ``UPSERT_CHUNK`` records at a time; must itself upsert by ``_id``.
RecordWriter = Callable[[list[dict]], None]


def upsert(rows: DataFrame, path: str, batch: int) -> None:
    """Write ``rows`` as batch ``batch`` of the store.

    Rows must be one per key: of two in a batch either may be read."""
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{BATCH}={batch}")


def read_store(
    spark: SparkSession,
    path: str,
    keys: tuple[str, ...] = ("_id",),
    order: str = BATCH,
    ties: tuple[str, ...] = (),
) -> DataFrame:
    """Current row per key: of the newest batch, or the newest by ``order``."""
    last = () if order == BATCH else (BATCH,)
    return latest_per_key(spark.read.parquet(path), keys, order, (*ties, *last)).drop(BATCH)


def compact(
    spark: SparkSession,
    path: str,
    target: str,
    keys: tuple[str, ...] = ("_id",),
    order: str = BATCH,
    ties: tuple[str, ...] = (),
) -> None:
    """Write the current rows as the first batch of a new store.

    ``order`` and ``ties`` are those the store is read with.  Reads window over all
    batches, so a store is to be compacted when it holds some tens of them, and the
    new path used from then on.
    """
    upsert(read_store(spark, path, keys, order, ties), target, 0)


def chunked(rows: Iterator[dict], size: int = UPSERT_CHUNK) -> Iterator[list[dict]]:
    while chunk := list(islice(rows, size)):
        yield chunk


def push_records(records: DataFrame, writer: RecordWriter, size: int = UPSERT_CHUNK) -> None:
    """Hand records, one per ``_id``, to ``writer`` in chunks, from the executors.

    Records travel in Arrow batches; a chunk never spans two tasks."""

    def push(rows: Iterator[dict]) -> None:
        for chunk in chunked(rows, size):
            writer(chunk)

    def hand_over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        push(row for batch in batches for row in batch.to_pylist())
        yield from ()

    records.select("_id", "embedding_text").mapInArrow(hand_over, "_id string").write.format("noop").mode("append").save()
