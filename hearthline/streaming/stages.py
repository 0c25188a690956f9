"""Running a stage: one append-mode ``writeStream`` with its own checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from hearthline.operators.joins import SALTS, hot_keys, join_location_salted
from hearthline.sources.store import BATCH, upsert
from hearthline.sources.tables import find_table, table_path


def start_stage(stream: DataFrame, name: str, base: str, partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Process all that is there now, in bounded micro-batches, then stop.

    The table goes to ``base/name`` and the checkpoint beside it, so a stage
    that is started again goes on where it stopped.
    """
    writer = (
        stream.writeStream.queryName(name)
        .outputMode("append")
        .format("parquet")
        .option("path", table_path(name, base))
        .option("checkpointLocation", table_path(f"_checkpoints/{name}", base))
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start()


def run_stage(stream: DataFrame, name: str, base: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Run a stage to its end and return the table it wrote, as a batch frame."""
    start_stage(stream, name, base, partition_by).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(table_path(name, base))


def run_location_join(
    stream: DataFrame, locations: DataFrame, name: str, base: str, columns: Callable[[DataFrame], DataFrame], salts: int = SALTS
) -> DataFrame:
    """Join a stream with the static lookup, hot zips salted by each micro-batch's counts.

    The zips that hold more than a task's share of a micro-batch are found from counts,
    then its rows are joined and ``columns`` of them written as the part of the table
    that the batch names; a batch that is run again replaces its part.  A micro-batch is
    computed once and kept on the executors' disks until it is joined.
    """
    spark, path = stream.sparkSession, table_path(name, base)

    def add(rows: DataFrame, batch: int) -> None:
        parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows.persist(StorageLevel.DISK_ONLY)
        try:
            hot = hot_keys(rows, "zip", 2 * parts)
            upsert(columns(join_location_salted(rows, locations, hot, min(salts, parts))), path, batch)
        finally:
            rows.unpersist()

    (
        stream.writeStream.queryName(name)
        .foreachBatch(add)
        .option("checkpointLocation", table_path(f"_checkpoints/{name}", base))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    if find_table(spark, name, base) is None:
        empty = stream.sparkSession.createDataFrame([], stream.schema)
        return columns(join_location_salted(empty, locations, []))
    return spark.read.parquet(path).drop(BATCH)
