"""Search areas: the lookup table and the CSV batches made from it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.functions.clock import instant
from hearthline.model import AREA_BATCH_SCHEMA, AREA_SCHEMA, BATCH_STAMP


def read_area_csv(spark: SparkSession, path: str) -> DataFrame:
    """The uploaded lookup file; the schema is given, so nothing is inferred."""
    return spark.read.schema(AREA_SCHEMA).option("header", True).csv(path)


def export_area_batch(sample: DataFrame, folder: str, as_of: datetime) -> str:
    """Write a sample of areas as one CSV file in its own batch folder.

    Only for samples: one file means one task, and a sample has a fixed size.
    """
    stamp = F.date_format(instant(as_of), BATCH_STAMP)
    target = f"{folder.rstrip('/')}/zips/batch_{as_of:%Y%m%d_%H%M%S}"
    (
        sample.withColumn("batch_id", stamp)
        .coalesce(1)
        .write.mode("overwrite")
        .option("header", True)
        .csv(target)
    )
    return target


def read_area_batches(spark: SparkSession, folder: str) -> DataFrame:
    return (
        spark.read.schema(AREA_BATCH_SCHEMA)
        .option("header", True)
        .option("recursiveFileLookup", True)
        .csv(f"{folder.rstrip('/')}/zips")
    )


def stream_area_batches(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    """New batch files as they appear; batches lie in sub-folders."""
    return (
        spark.readStream.schema(AREA_BATCH_SCHEMA)
        .option("header", True)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .csv(f"{folder.rstrip('/')}/zips")
    )
