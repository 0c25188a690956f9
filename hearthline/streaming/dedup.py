"""One row per key on a stream: the first to arrive, or the latest."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from hearthline.operators.dedup import latest_per_key
from hearthline.sources.store import BATCH, read_store, upsert
from hearthline.sources.tables import find_table, table_path

def run_first_arrival(stream: DataFrame, name: str, base: str, keys: Sequence[str]) -> DataFrame:
    """Keep the first row of every key ever seen, in the table ``base/name``.

    There is no stream state: a micro-batch is a batch, cut to one row per key
    before its shuffle, so a hot key sends one row per task.  Of those rows only
    keys not in the table yet are added, as one part named by the batch, which a
    batch that is run again replaces.  Which row of a micro-batch is kept is open.
    """
    spark, path = stream.sparkSession, table_path(name, base)
    schema = StructType([*stream.schema, StructField(BATCH, LongType())])

    def add(rows: DataFrame, batch: int) -> None:
        known = rows.sparkSession.read.schema(schema).parquet(path) if find_table(rows.sparkSession, name, base) else None
        rows = rows.dropDuplicates(list(keys))
        if known is not None:
            same = [rows[key].eqNullSafe(known[key]) for key in keys]
            rows = rows.join(known.where(F.col(BATCH) != batch), reduce(and_, same), "left_anti")
        upsert(rows, path, batch)

    (
        stream.writeStream.queryName(name)
        .foreachBatch(add)
        .option("checkpointLocation", table_path(f"_checkpoints/{name}", base))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    if find_table(spark, name, base) is None:
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(schema).parquet(path).drop(BATCH)


def run_first_arrival_keyed(stream: DataFrame, name: str, base: str, keys: Sequence[str]) -> DataFrame:
    """The same from keyed state: keys ever seen are in RocksDB, spread over the tasks.

    A micro-batch looks its own keys up and reads nothing of the table, so its cost does
    not grow with what came before; the state does, by one entry a key.  Each batch is
    one part of the table, named by the batch, which a batch that is run again replaces.
    All rows of a micro-batch are shuffled by key, those of a hot key to one task;
    ``run_first_arrival`` cuts them before, and suits few, large micro-batches.
    """
    spark, path = stream.sparkSession, table_path(name, base)
    schema = StructType([*stream.schema, StructField(BATCH, LongType())])

    def add(rows: DataFrame, batch: int) -> None:
        upsert(rows, path, batch)

    (
        stream.dropDuplicates(list(keys))
        .writeStream.queryName(name)
        .foreachBatch(add)
        .option("checkpointLocation", table_path(f"_checkpoints/{name}", base))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    if find_table(spark, name, base) is None:
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(schema).parquet(path).drop(BATCH)


def first_arrival_within(stream: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """The bounded form: a key is forgotten once ``time`` has moved on by ``delay``.

    Right as long as copies of a row come no further apart than that.
    """
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def start_latest(
    stream: DataFrame, name: str, base: str, keys: Sequence[str], time: str, ties: Sequence[str] = ()
) -> StreamingQuery:
    """Keep the latest row of every key in a keyed store.

    Each micro-batch writes its own latest rows as one batch of the store.  The
    batch id names the folder, so a micro-batch that is run again replaces what
    it wrote before.
    """

    def merge(rows: DataFrame, batch: int) -> None:
        upsert(latest_per_key(rows, keys, time, ties), table_path(name, base), batch)

    return (
        stream.writeStream.queryName(name)
        .foreachBatch(merge)
        .option("checkpointLocation", table_path(f"_checkpoints/{name}", base))
        .trigger(availableNow=True)
        .start()
    )


def read_latest(
    spark: SparkSession, name: str, base: str, keys: Sequence[str], time: str, ties: Sequence[str] = ()
) -> DataFrame:
    return read_store(spark, table_path(name, base), tuple(keys), time, tuple(ties))
