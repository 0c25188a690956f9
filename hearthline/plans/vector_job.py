"""The vector job: new listings -> texts -> records -> store -> control row."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.model import MAX_DAYS_BACK
from hearthline.operators.increment import new_listings, oldest_waiting, read_control, record_push, upper_bound
from hearthline.operators.vectors import embedding_texts, vector_records, vectorize
from hearthline.functions.vectors import VectorModel
from hearthline.operators.dedup import latest_per_key
from hearthline.session import drop_folder, run_folder
from hearthline.sources.store import RecordWriter, push_records, upsert
from hearthline.sources.tables import read_table, write_table


def push_new(
    spark: SparkSession,
    listings: DataFrame,
    features: DataFrame,
    control: str,
    store: str | RecordWriter,
    as_of: datetime | None = None,
    days_back: int = MAX_DAYS_BACK,
    base: str | None = None,
    model: VectorModel | None = None,
) -> int:
    """Push what is new and return how many records that were.

    ``store`` is the path of a keyed store, which gets vectors too, or a writer
    that takes chunks of text records.  The texts are written out first, so that
    the push, a push done again and the control row all speak of the same rows;
    they go when the push is over.  One record per property: of several the latest.

    The control row comes last.  Its mark is the end of the window, or the time of
    the oldest listing that still waits for features: that one and all after it
    are looked at again, and the upsert by key absorbs those pushed twice.  So does
    it a push repeated after a crash.
    """
    now, end = as_of or datetime.now(timezone.utc), upper_bound(as_of)
    seen = read_control(spark, control, base)
    fresh = latest_per_key(new_listings(listings, features, seen, end, days_back), ["propertyId"], "ingestion_timestamp")
    held = run_folder(spark, "push")
    try:
        write_table(embedding_texts(fresh), "texts", held)
        texts = read_table(spark, "texts", held)
        mark = oldest_waiting(listings, features, seen, end, days_back) or end
        rows = texts.count()
        if rows:
            records = vector_records(texts)
            if callable(store):
                push_records(records, store)
            else:
                batch = seen.agg(F.coalesce(F.max("batch_id"), F.lit(0)) + 1)
                upsert(vectorize(records, model), store, batch.first()[0])
            record_push(spark, control, mark, now, base)
        return rows
    finally:
        drop_folder(spark, held)
