"""Inner joins of the chain: locations by zip, features by property."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.session import run_folder

SALTS = 32  # tasks a hot key is dealt to


def join_location(listings: DataFrame, locations: DataFrame) -> DataFrame:
    """Listings with their zip's position, population and density (inner).

    Spark broadcasts the lookup if its size is below the session's threshold, and
    then listings are not shuffled; if it is not, adaptive execution splits the
    partitions of busy zips.
    """
    return listings.join(_statistics(locations), "zip")


def _statistics(locations: DataFrame) -> DataFrame:
    return locations.select(
        "zip",
        F.col("lat").alias("zip_lat"),
        F.col("lng").alias("zip_lng"),
        F.col("population").alias("zip_population"),
        F.col("density").alias("zip_density"),
    )


def hot_keys(df: DataFrame, key: str, parts: int) -> list:
    """Keys that hold at least one in ``parts`` of the rows: at most ``parts`` of them,
    whatever the rows.  Counted exactly, in one pass; only counts are shuffled."""
    spark, path = df.sparkSession, run_folder(df.sparkSession, "key-counts")
    df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n")).write.parquet(path)
    counts = spark.read.parquet(path)
    total = counts.agg(F.sum("n")).first()[0] or 0
    return [row.key for row in counts.where((F.col("n") * parts >= total) & F.col("key").isNotNull()).collect()]


def join_location_salted(listings: DataFrame, locations: DataFrame, hot: Collection, salts: int = SALTS) -> DataFrame:
    """``join_location`` where no adaptive execution helps, as in a stream.

    Listings of a zip in ``hot`` are dealt to ``salts`` parts by a hash of the row; the
    locations of those zips, and only of those, are there once per part.
    """
    hot = list(hot)

    def is_hot(frame: DataFrame):
        return F.coalesce(frame["zip"].isin(hot), F.lit(False)) if hot else F.lit(False)

    row = F.xxhash64(*[F.col(f"`{c}`") for c, kind in listings.dtypes if "map<" not in kind])
    dealt = listings.withColumn("_salt", F.when(is_hot(listings), F.pmod(row, F.lit(salts)).cast("int")).otherwise(0))
    every = F.when(is_hot(locations), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    stats = _statistics(locations).withColumn("_salt", F.explode(every))
    return dealt.join(stats, ["zip", "_salt"]).drop("_salt")


def join_features(listings: DataFrame, features: DataFrame) -> DataFrame:
    """Listings with the ``top_features`` of their property (inner).

    Both sides hold one row per property, so no property is hot; whether the
    features are small enough to broadcast is left to Spark's size check.
    """
    return listings.join(features.select("propertyId", "top_features"), "propertyId")
