"""Named tables: in the catalog, or as Parquet folders under a base path."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# A folder without files is a table that has had no rows yet.
_MISSING = {"PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def table_path(name: str, base: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def read_table(spark: SparkSession, name: str, base: str | None = None) -> DataFrame:
    return spark.read.table(name) if base is None else spark.read.parquet(table_path(name, base))


def find_table(spark: SparkSession, name: str, base: str | None = None) -> DataFrame | None:
    """The table, or None where there is none yet."""
    if base is None and not spark.catalog.tableExists(name):
        return None
    try:
        return read_table(spark, name, base)
    except AnalysisException as error:
        if error.getCondition() in _MISSING:
            return None
        raise


MAX_BYTES = 64 << 30


def stream_table(
    spark: SparkSession, name: str, base: str | None = None, schema=None, max_bytes: int = MAX_BYTES
) -> DataFrame:
    """The table as a stream; a micro-batch reads files of ``max_bytes`` at most, or one."""
    reader = spark.readStream.option("maxBytesPerTrigger", max_bytes)
    if base is None:
        return reader.table(name)
    return reader.schema(schema or read_table(spark, name, base).schema).parquet(table_path(name, base))


def write_table(
    df: DataFrame,
    name: str,
    base: str | None = None,
    mode: str = "append",
    partition_by: tuple[str, ...] = (),
) -> None:
    """Append to a table, or replace it (``mode="overwrite"``).

    With ``mode="overwrite"`` this is also how a materialized view is refreshed:
    compute it again and replace it.
    """
    writer = df.write.mode(mode).partitionBy(*partition_by) if partition_by else df.write.mode(mode)
    if base is None:
        writer.saveAsTable(name)
    else:
        writer.parquet(table_path(name, base))


def write_bucketed(
    df: DataFrame, name: str, key: str, buckets: int, path: str | None = None, mode: str = "overwrite"
) -> None:
    """Write a catalog table in ``buckets`` buckets of ``key``, one file each.

    Tables with equal buckets of an equally typed key are joined and grouped by it
    without a shuffle, as often as they are read; the one shuffle is paid here.  For
    keys that no row is hot in: a key's rows are in one bucket.  Choose buckets so that
    one holds some hundreds of megabytes.  With ``path`` the files lie there.
    """
    writer = df.repartition(buckets, key).write.mode(mode).bucketBy(buckets, key)
    (writer if path is None else writer.option("path", path)).saveAsTable(name)


def replace_parts(df: DataFrame, name: str, parts: tuple[str, ...], base: str | None = None) -> None:
    """Write the parts of a table that ``df`` has rows of, in place of what they held."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts)
    if base is not None:
        writer.parquet(table_path(name, base))
    elif df.sparkSession.catalog.tableExists(name):
        columns = df.sparkSession.table(name).columns
        df.select(*[f"`{c}`" for c in columns]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(name)
    else:
        writer.saveAsTable(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": name})
