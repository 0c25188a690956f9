"""Small helpers the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearthline.session import run_folder

# A word is a maximal run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
NO_WORD = r"[\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


FREE_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, free: bool = False) -> DataFrame:
    """The frame as a table in the shared folder: computed once, its lineage cut,
    and still there when an executor is lost.  With ``free``, what was shuffled for it
    goes from the disks at once, not when the driver happens to collect its garbage."""
    spark = df.sparkSession
    path = run_folder(spark, name)
    before = spark.conf.get(FREE_KEY)
    if free:
        spark.conf.set(FREE_KEY, "true")
    try:
        df.write.parquet(path)
    finally:
        if free:
            spark.conf.set(FREE_KEY, before)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body (or
    a lambda inside it) names it; plain columns are copied into each use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, key: str, order: list[str], name: str, bins: int | None = None) -> DataFrame:
    """Adds ``name``: 0, 1, 2, ... without gaps inside each ``key``.

    No key goes to one task: its rows are dealt by hash to ``bins`` bins, the bins
    are counted, and a row's number is its place in its bin plus the rows of the
    bins before.  The order is by bin, then by ``order``; rows that tie in all of
    ``order`` may swap their numbers.  ``df`` is read twice.
    """
    bins = bins or 4 * shuffle_partitions(df.sparkSession)
    dealt = df.withColumn("_bin", F.pmod(F.xxhash64(*order), F.lit(bins)).cast("int"))
    counts = dealt.groupBy(key, "_bin").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(key, "_bin", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy(key, "_bin").orderBy(*order)) - 1
    return (
        dealt.join(starts, [key, "_bin"])
        .withColumn(name, (F.col("_start") + place).cast("long"))
        .drop("_bin", "_start")
    )
