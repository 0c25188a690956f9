"""Every operator as a query over the test tables.

Each query takes the session and the folder of tables, and reads whole tables.
Queries whose subject is a sink or a stream write under ``run_folder`` and
return what they read back.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import partial, reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline import testframes as tf
from hearthline.functions.text import feature_prompt, is_number, json_map, template_columns
from hearthline.model import CONTROL_SCHEMA, EXACT_HOMES, LISTING_COLUMNS, NEARBY_HOMES_OLD, UPSERT_CHUNK
from hearthline.operators import clean, dedup, features, increment, joins, profile, urls, vectors
from hearthline.operators.parse import parse_listings
from hearthline.plans import batch, chain, views
from hearthline.plans.vector_job import push_new
from hearthline.session import run_folder
from hearthline.sources import attempts
from hearthline.sources.areas import export_area_batch, read_area_batches, stream_area_batches
from hearthline.sources.responses import captured_responses, fetch_responses
from hearthline.sources.store import compact, push_records, read_store, upsert
from hearthline.sources.tables import read_table, replace_parts, stream_table, write_bucketed, write_table
from hearthline.streaming.dedup import first_arrival_within, read_latest, run_first_arrival, run_first_arrival_keyed, start_latest
from hearthline.streaming.stages import run_location_join, run_stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = datetime(2026, 1, 31, 13, 45, 0)
TODAY = date(2026, 1, 31)
API_URL = "https://api.example/search?zip=%s"
REFERRAL_URL = "https://www.example/zip/%s/%s/%s"
SAMPLE = 100
BUCKETS = 16
# Listing columns that the embedding texts are made of.
TEXT_COLUMNS = tuple(c for c in LISTING_COLUMNS if c in {*chain.NEEDED, *template_columns(), "listingRemarks"})

BRIEF = ("search_zipcode", "mls#", "house_price", "hoa", "baths", "zip", "propertyId", "yearBuilt", "isHot")


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _items(spark, sf_dir):
    return tf.table(spark, sf_dir, "lineitem")


def _parsed(spark, sf_dir, *columns):
    """Listings of all responses; only ``columns``, where some are named."""
    return parse_listings(
        tf.responses(spark, sf_dir),
        ingested=F.col("ingestion_timestamp"),
        columns=columns or LISTING_COLUMNS,
    )


def _latest(spark, sf_dir, columns=LISTING_COLUMNS):
    return chain.latest_listings(tf.responses(spark, sf_dir), AS_OF, columns=columns)


def _brief(listings: DataFrame) -> DataFrame:
    """Fields of every type, under names plain in both dialects."""
    return listings.select(*[f"`{name}`" for name in BRIEF]).withColumnRenamed("mls#", "mls")


# -- areas and URLs -----------------------------------------------------------


@query
def url_build(spark, sf_dir):
    return urls.build_urls(tf.areas(spark, sf_dir), API_URL, REFERRAL_URL, AS_OF).select(
        "zip", "state_id", "state_name", "api_url", "refereral_url", "processed_datehour"
    )


@query
def sample_random(spark, sf_dir):
    """Which areas is open: how many, how many different ones, and that all are
    populated areas of the table."""
    areas = tf.areas(spark, sf_dir)
    sample = urls.sample_areas(areas, SAMPLE, seed=7)
    known = areas.where("population IS NOT NULL").select("zip", F.lit(1).alias("known"))
    return sample.join(known, "zip", "left").agg(
        F.count(F.lit(1)).alias("areas"), F.count_distinct("zip").alias("different"), F.count("known").alias("populated")
    )


@query
def sample_by_hash(spark, sf_dir):
    return urls.sample_areas_by_hash(tf.areas(spark, sf_dir), SAMPLE)


@query
def area_batch_export(spark, sf_dir):
    """A sample written as one CSV file and read back."""
    folder = run_folder(spark, "areas")
    export_area_batch(urls.sample_areas_by_hash(tf.areas(spark, sf_dir), SAMPLE), folder, AS_OF)
    return read_area_batches(spark, folder)


@query
def partitioned_write(spark, sf_dir):
    """The URL list of all areas, written by hour and read back."""
    base = run_folder(spark, "urls")
    listed = urls.url_list(tf.areas(spark, sf_dir), API_URL, REFERRAL_URL, AS_OF)
    write_table(listed, "generated_urls", base, "overwrite", ("processed_datehour",))
    return read_table(spark, "generated_urls", base).withColumn(
        "processed_datehour", F.col("processed_datehour").cast("string")
    )


@query
def area_copy(spark, sf_dir):
    """The lookup as a materialized view, refreshed once, and as a named view."""
    base = run_folder(spark, "copy")
    for _ in range(2):
        write_table(tf.areas(spark, sf_dir), "areas_copy", base, "overwrite")
    read_table(spark, "areas_copy", base).createOrReplaceTempView("areas_copy")
    return spark.table("areas_copy")


# -- responses ----------------------------------------------------------------


def _transport(url: str, referer: str, timeout: float) -> tuple[int, str]:
    """Answers with the request itself; some areas fail, some are refused."""
    area = url.rsplit("=", 1)[1]
    if area.endswith("3"):
        raise TimeoutError(f"timed out: {area}")
    home = {"propertyId": int(area), "zip": area, "url": referer, "price": {"value": int(area) * 7}}
    return (404 if area.endswith("5") else 200), "{}&&" + json.dumps({"payload": {"homes": [home]}})


def _area_urls(spark, sf_dir):
    return urls.build_urls(tf.areas(spark, sf_dir), API_URL, REFERRAL_URL, AS_OF)


@query
def fetch_transport(spark, sf_dir):
    """Every area's URL through a transport that answers, refuses or raises."""
    return fetch_responses(_area_urls(spark, sf_dir), _transport, AS_OF)


def _late_answer(tried: int, url: str, referer: str, timeout: float) -> tuple[int, str]:
    """Answers an area after as many failures as its number leaves over by four."""
    area = int(url.rsplit("=", 1)[1])
    return (200, f"answer {tried}") if area % 4 <= tried else (503, "busy")


@query
def fetch_retried(spark, sf_dir):
    """Every area's URL, listed twice, tried up to three times: the last response of each.

    The runs at 30 and 90 seconds come too early for what failed last.
    """
    base = run_folder(spark, "attempts")
    listed = _area_urls(spark, sf_dir)
    write_table(listed.unionByName(listed), "urls", base)
    for tried, seconds in ((0, 0), (1, 30), (1, 60), (2, 90), (2, 180), (3, 900)):
        now = AS_OF + timedelta(seconds=seconds)
        transport = partial(_late_answer, tried)
        attempts.gather_due(spark, "urls", "responses", transport, AS_OF, now, base, attempts=3, first_wait=60)
    return read_table(spark, "responses", base).where("next_attempt IS NULL").select(
        "zipcode", "source_url", "raw_json", "http_status_code", "ingestion_timestamp", "attempt"
    )


@query
def fetch_captured(spark, sf_dir):
    """Pages as captured responses; areas were never captured and fail."""
    pages = tf.table(spark, sf_dir, "pages")
    known = pages.select(
        F.col("page_id").cast("string").alias("zip"), F.col("url").alias("api_url"), F.lit("").alias("refereral_url")
    )
    wanted = known.unionByName(_area_urls(spark, sf_dir).select("zip", "api_url", "refereral_url"))
    return captured_responses(wanted, pages.select("url", F.col("html").alias("body")), AS_OF)


# -- parse --------------------------------------------------------------------


@query
def parse_all_columns(spark, sf_dir):
    """All 44 columns."""
    parsed = _parsed(spark, sf_dir).withColumnRenamed("mls#", "mls")
    return parsed.withColumn("ingestion_timestamp", F.col("ingestion_timestamp").cast("timestamp_ntz"))


@query
def parse_alt_path(spark, sf_dir):
    """Two homes a response, under the path of the exact search."""
    return _brief(parse_listings(tf.pair_responses(spark, sf_dir, EXACT_HOMES), EXACT_HOMES, columns=BRIEF))


@query
def parse_old_path(spark, sf_dir):
    return _brief(parse_listings(tf.responses(spark, sf_dir, NEARBY_HOMES_OLD), NEARBY_HOMES_OLD, columns=BRIEF))


@query
def parse_dirty(spark, sf_dir):
    """Seven kinds of response, one per line number."""
    return _brief(parse_listings(tf.dirty_responses(spark, sf_dir), columns=BRIEF))


@query
def parse_listings_brief(spark, sf_dir):
    return _brief(parse_listings(tf.responses(spark, sf_dir), columns=BRIEF))


@query
def json_to_map(spark, sf_dir):
    events = tf.table(spark, sf_dir, "events")
    return events.select("event_id", json_map(F.col("props"))["k"].alias("k"))


# -- clean and dedup ----------------------------------------------------------


@query
def castable_filter(spark, sf_dir):
    """Zips in five spellings, kept where they are numbers."""
    key = F.col("c_custkey").cast("string")
    spelling = (
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", key)
        .when(F.col("c_mktsegment") == "BUILDING", F.concat(key, F.lit("-1234")))
        .when(F.col("c_mktsegment") == "FURNITURE", F.lit(""))
        .when(F.col("c_mktsegment") == "HOUSEHOLD", F.concat(F.lit("00"), key))
    )
    listed = tf.table(spark, sf_dir, "customer").select("c_custkey", spelling.alias("zip"))
    return clean.valid_zip(listed).withColumn("numeric_too", is_number(F.col("zip"), "numeric"))


@query
def clean_defaults(spark, sf_dir):
    rows = clean.reference_rows(_parsed(spark, sf_dir, *chain.NEEDED), TODAY)
    return rows.select("house_mls", "propertyId", "house_price", "hoa", "yearBuilt", "age", "zip")


@query
def latest_per_key(spark, sf_dir):
    return dedup.latest_per_key(
        _items(spark, sf_dir), ["l_partkey"], "l_shipdate", ("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    ).select("l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")


@query
def latest_found_twice(spark, sf_dir):
    """Every home found at one instant by two searches: the higher zip's row stays."""
    again = F.concat(F.lit("9"), F.substring("zipcode", 2, 8))
    # a union would make every body twice
    raw = tf.responses(spark, sf_dir).withColumn("zipcode", F.explode(F.array("zipcode", again)))
    latest = chain.latest_listings(raw, AS_OF, columns=chain.NEEDED)
    return latest.select("propertyId", "house_mls", "search_zipcode", "ingestion_timestamp").withColumn(
        "ingestion_timestamp", F.col("ingestion_timestamp").cast("timestamp_ntz")
    )


@query
def store_compact(spark, sf_dir):
    """A store whose newest row is decided by time, batches out of order, compacted."""
    path = run_folder(spark, "store")
    items = _items(spark, sf_dir).select("l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    ties = ("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    for number, line in enumerate((7, 1, 6, 2, 5, 3, 4)):
        rows = items.where(F.col("l_linenumber") == line)
        upsert(dedup.latest_per_key(rows, ["l_partkey"], "l_shipdate", ties), path, number)
    compact(spark, path, f"{path}-packed", ("l_partkey",), "l_shipdate", ties)
    return read_store(spark, f"{path}-packed", ("l_partkey",), "l_shipdate", ties)


@query
def push_chunks(spark, sf_dir):
    """Records handed to a writer: how many, and how many chunks were too large."""
    texts = tf.remarks(spark, sf_dir).select(
        F.col("propertyId").cast("string").alias("_id"), F.col("listingRemarks").alias("embedding_text")
    )
    context = spark.sparkContext
    records, chars, over = (context.accumulator(0) for _ in range(3))

    def write(chunk):
        records.add(len(chunk))
        chars.add(sum(len(row["embedding_text"] or "") for row in chunk))
        over.add(int(len(chunk) > UPSERT_CHUNK))

    push_records(texts, write)
    return spark.createDataFrame([(records.value, chars.value, over.value)], "records long, chars long, too_large long")


@query
def first_per_key(spark, sf_dir):
    return dedup.first_per_key(
        _items(spark, sf_dir), ["l_partkey"], "l_shipdate", ("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    ).select("l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")


@query
def any_per_key(spark, sf_dir):
    """Which row is kept is open: kept rows, keys, and kept rows that are in the table whole."""
    items = _items(spark, sf_dir)
    kept = dedup.any_per_key(items, ["l_partkey"])
    same = [kept[name].eqNullSafe(items[name]) for name in items.columns]
    found = kept.join(items, reduce(and_, same), "left_semi")
    counts = kept.agg(F.count(F.lit(1)).alias("kept"), F.count_distinct("l_partkey").alias("keys"))
    return counts.crossJoin(found.agg(F.count(F.lit(1)).alias("found")))


@query
def latest_view(spark, sf_dir):
    """The SQL view of latest listings."""
    return views.latest_listings_view(spark, _parsed(spark, sf_dir), TODAY)


# -- joins --------------------------------------------------------------------


@query
def join_location(spark, sf_dir):
    located = joins.join_location(_latest(spark, sf_dir, chain.NEEDED), tf.locations(spark, sf_dir))
    return located.select(
        "zip", "propertyId", "house_mls", "house_price", "zip_lat", "zip_lng", "zip_population", "zip_density"
    )


@query
def located_view(spark, sf_dir):
    """The SQL views, one over the other, through their names."""
    _, located = views.declare_views(spark, _parsed(spark, sf_dir), tf.locations(spark, sf_dir), TODAY)
    return spark.table(located).select("propertyId", "zip", "house_price", "age", "zip_lat", "zip_population")


@query
def join_features(spark, sf_dir):
    """Latest listings with the features found in the document of their id."""
    found = features.top_features(tf.remarks(spark, sf_dir))
    return joins.join_features(_latest(spark, sf_dir, chain.NEEDED), found).select(
        "propertyId", "house_mls", "house_price", "top_features"
    )


@query
def join_features_bucketed(spark, sf_dir):
    """The same join of two tables bucketed by property, which are not shuffled for it."""
    base = run_folder(spark, "bucketed")
    tag = base.rsplit("-", 1)[1]
    latest = _latest(spark, sf_dir, chain.NEEDED).select("propertyId", "house_mls", "house_price")
    sides = {f"latest_{tag}": latest, f"features_{tag}": features.top_features(tf.remarks(spark, sf_dir))}
    for name, rows in sides.items():
        write_bucketed(rows, name, "propertyId", BUCKETS, f"{base}/{name}")
    listings, found = map(spark.table, sides)
    return joins.join_features(listings, found).select("propertyId", "house_mls", "house_price", "top_features")


# -- profiles -----------------------------------------------------------------


@query
def profile_global(spark, sf_dir):
    return profile.profile(
        _parsed(spark, sf_dir, "search_zipcode", "propertyId", "listingId", "mls#"),
        {
            "total_zip_codes": "search_zipcode",
            "total_property": "propertyId",
            "total_listings": "listingId",
            "total_run_hour": "ingestion_timestamp",
            "mls_count": "mls#",
        },
    )


@query
def profile_rollup(spark, sf_dir):
    """Rows and distinct values per year, from daily sketches kept in two increments."""
    base, items, edge = run_folder(spark, "profile"), _items(spark, sf_dir), datetime(1996, 6, 1)
    distinct = {"total_parts": "l_partkey", "total_suppliers": "l_suppkey"}
    for part in (items.where(F.col("l_shipdate") < F.lit(edge)), items.where(F.col("l_shipdate") >= F.lit(edge))):
        sketches = profile.daily_sketches(part, "l_shipdate", distinct, "total_rows")
        replace_parts(sketches.withColumn("month", F.date_format(profile.DAY, "yyyy-MM")), "sketches", ("month",), base)
    kept = read_table(spark, "sketches", base)
    return profile.roll_up(kept, {"extracted_year": F.year(profile.DAY)}, distinct, "total_rows")


@query
def profile_daily(spark, sf_dir):
    return profile.profile_daily(
        _parsed(spark, sf_dir, "search_zipcode", "mls#", "zip", "propertyId"),
        "ingestion_timestamp",
        {
            "mls_unique_count": "mls#",
            "search_zip_count": "search_zipcode",
            "total_zip_of_homes": "zip",
            "total_properties": "propertyId",
        },
        "total_homes",
    )


@query
def profile_raw(spark, sf_dir):
    return profile.profile(
        tf.responses(spark, sf_dir), {"total_sources": "source_url", "total_zipcodes": "zipcode"}, "total_rows"
    )


@query
def profile_located(spark, sf_dir):
    """Rows against distinct properties after the dedup and the join."""
    located = chain.located_listings(tf.responses(spark, sf_dir), tf.locations(spark, sf_dir), AS_OF, columns=chain.NEEDED)
    return profile.profile(
        located, {"total_zip_codes": "zip", "total_property": "propertyId", "mls_count": "house_mls"}
    )


def _event_log(spark, sf_dir):
    when = F.col("ts").cast("timestamp")
    return tf.table(spark, sf_dir, "events").select(
        F.to_date(when).alias("processed_date"),
        F.hour(when).alias("processed_hour"),
        F.col("event_type").alias("http_status_code"),
        F.col("user_id").cast("string").alias("zipcode"),
    )


@query
def status_monitor(spark, sf_dir):
    return profile.status_monitor(_event_log(spark, sf_dir)).orderBy(F.desc("processed_date"))


@query
def status_counts(spark, sf_dir):
    return profile.status_counts(tf.dirty_responses(spark, sf_dir))


@query
def count_by_zip(spark, sf_dir):
    return profile.count_by(_latest(spark, sf_dir, chain.NEEDED), "zip").orderBy("row_count")


@query
def count_by_time(spark, sf_dir):
    counted = profile.count_by(_parsed(spark, sf_dir, "propertyId"), "ingestion_timestamp", "total")
    return counted.select(F.col("ingestion_timestamp").cast("timestamp_ntz").alias("ingested"), "total").orderBy(
        F.desc("ingested")
    )


@query
def distinct_limit(spark, sf_dir):
    return profile.distinct_values(_parsed(spark, sf_dir, "zip"), "zip", 10)


# -- increments ---------------------------------------------------------------


def _control(spark, rows):
    return spark.createDataFrame(rows, CONTROL_SCHEMA)


def _event_listings(spark, sf_dir):
    return tf.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("propertyId"),
        F.col("ts").cast("timestamp").alias("ingestion_timestamp"),
        F.col("user_id").alias("area"),
    )


def _event_features(spark, sf_dir):
    return tf.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("propertyId"), F.col("event_type").alias("top_features")
    )


@query
def select_new(spark, sf_dir):
    """Events after the newest of two control rows."""
    control = _control(
        spark,
        [(datetime(2024, 1, 9), datetime(2024, 1, 10), 1), (datetime(2024, 1, 14, 6, 30), datetime(2024, 1, 15), 2)],
    )
    listings, found = _event_listings(spark, sf_dir), _event_features(spark, sf_dir)
    return increment.new_listings(listings, found, control, AS_OF).select("propertyId", "area", "top_features")


@query
def select_new_first_run(spark, sf_dir):
    """With an empty control table: the last 20 days before a given day."""
    listings, found = _event_listings(spark, sf_dir), _event_features(spark, sf_dir)
    control = increment.empty_control(spark)
    return increment.new_listings(listings, found, control, datetime(2024, 1, 28, 9)).select(
        "propertyId", "area", "top_features"
    )


@query
def watermark_parse(spark, sf_dir):
    """Three parse runs: older responses, what has come in since, nothing.

    The first run ends at an instant that responses of both writes have."""
    base = run_folder(spark, "parse")
    # dealt by day before bodies are made: one file a day, not one a day and task
    days = F.to_date(F.col("l_shipdate").cast("timestamp"))
    raw = tf.as_responses(_items(spark, sf_dir).repartition(days))
    split = datetime(1998, 6, 1)
    at, late = F.col("ingestion_timestamp"), F.col("source_url").endswith("7")
    days = ("processed_date",)
    write_table(raw.where((at < split) | ((at == split) & ~late)), "raw_data", base, partition_by=days)
    batch.parse_new(spark, "raw_data", "parsed_data", as_of=split, base=base)
    write_table(raw.where((at > split) | ((at == split) & late)), "raw_data", base, partition_by=days)
    batch.parse_new(spark, "raw_data", "parsed_data", as_of=AS_OF, base=base)
    batch.parse_new(spark, "raw_data", "parsed_data", as_of=AS_OF, base=base)
    return _brief(read_table(spark, "parsed_data", base))


# -- features and vectors -----------------------------------------------------


@query
def top_features(spark, sf_dir):
    return features.top_features(tf.remarks(spark, sf_dir)).select("propertyId", "top_features")


@query
def feature_prompts(spark, sf_dir):
    return tf.remarks(spark, sf_dir).select("propertyId", feature_prompt(F.col("listingRemarks")).alias("prompt"))


@query
def model_features(spark, sf_dir):
    """Features from an injected model; this one tells how long its prompt is."""
    return features.top_features(tf.remarks(spark, sf_dir), lambda prompts: "chars " + prompts.str.len().astype(str)).select(
        "propertyId", "top_features"
    )


@query
def model_features_kept(spark, sf_dir):
    """The same with answers kept by prompt: half of the properties first, then all."""
    base, remarks = run_folder(spark, "answers"), tf.remarks(spark, sf_dir)

    def model(prompts):
        return "chars " + prompts.str.len().astype(str)

    features.ask_new_prompts(remarks.where("propertyId % 2 = 0"), model, "answers", base)
    return features.with_kept_features(remarks, model, "answers", base).select("propertyId", "top_features")


def _held(spark, df: DataFrame, name: str) -> DataFrame:
    """Written out and read again, as between two steps of the chain: what is
    read twice is then computed once."""
    base = run_folder(spark, name)
    write_table(df, name, base)
    return read_table(spark, name, base)


def _plain_density(located: DataFrame) -> DataFrame:
    """A whole number, which every engine prints alike."""
    return located.withColumn("zip_density", F.col("zip_population") * 2)


def _texts(spark, sf_dir):
    """Features as a column of the listing they come from: no join, one parse."""
    latest = features.with_features(_latest(spark, sf_dir, TEXT_COLUMNS))
    return vectors.embedding_texts(_plain_density(joins.join_location(latest, tf.locations(spark, sf_dir))))


@query
def embedding_text(spark, sf_dir):
    return _texts(spark, sf_dir).select("propertyId", "embedding_text")


@query
def vector_records(spark, sf_dir):
    return vectors.vector_records(_texts(spark, sf_dir)).withColumnRenamed("_id", "id")


@query
def vectorize(spark, sf_dir):
    """Document vectors, by their non-zero positions."""
    texts = tf.remarks(spark, sf_dir).toDF("doc_id", "embedding_text")
    spread = vectors.vectorize(texts).select("doc_id", F.posexplode("vector").alias("slot", "value"))
    return spread.where("value <> 0").select("doc_id", "slot", F.round(F.col("value").cast("double"), 5).alias("value"))


@query
def upsert_replay(spark, sf_dir):
    """Two batches pushed, the second done twice; its texts win."""
    path = run_folder(spark, "store")
    documents = tf.table(spark, sf_dir, "documents")
    key = F.col("doc_id").cast("string").alias("_id")
    upsert(documents.select(key, F.col("source").alias("embedding_text")), path, 1)
    later = documents.join(tf.table(spark, sf_dir, "labels").select("doc_id"), "doc_id").select(
        key, F.concat("lang", F.lit(":"), F.col("n_chars").cast("string")).alias("embedding_text")
    )
    upsert(later, path, 2)
    upsert(later, path, 2)
    return read_store(spark, path).withColumnRenamed("_id", "id")


@query
def vector_job(spark, sf_dir):
    """The job run three times over growing input, features late; what store and
    control hold then."""
    base = run_folder(spark, "vectors")
    latest = _held(spark, _latest(spark, sf_dir), "reference")
    write_table(_plain_density(joins.join_location(latest, tf.locations(spark, sf_dir))), "located", base)
    write_table(features.top_features(latest), "features", base)
    listings, found = read_table(spark, "located", base), read_table(spark, "features", base)
    store = f"{base}/store"
    middle = datetime(2001, 6, 1)
    early = listings.where(F.col("ingestion_timestamp") < F.lit(middle))
    some = found.where("propertyId % 7 <> 0")  # the features of the others are late
    for rows, known, at in ((early, some, middle), (listings, found, AS_OF), (listings, found, AS_OF)):
        push_new(spark, rows, known, "control", store, at, days_back=20_000, base=base)
    pushes = read_table(spark, "control", base).select(
        "batch_id", F.col("last_processed_ts").cast("date").alias("last_day")
    )
    held = read_store(spark, store).withColumn("size", F.size("vector")).groupBy("size")
    return held.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_distinct("_id").alias("ids"),
        F.sum(F.length("embedding_text")).alias("chars"),
        F.lit(pushes.agg(F.count(F.lit(1))).first()[0]).alias("pushes"),
        F.lit(pushes.agg(F.max("last_day")).first()[0]).alias("last_day"),
    )


@query
def cosine_topk(spark, sf_dir):
    """The five vectors closest to every fiftieth vector."""
    corpus = tf.table(spark, sf_dir, "embeddings")
    asked = corpus.where("vec_id % 50 = 0")
    columns = [F.col("vec_id").alias("id"), F.col("embedding").alias("vector")]
    found = vectors.cosine_topk(corpus.select(*columns), asked.select(*columns), 5)
    return found.withColumn("score", F.round("score", 5))


# -- streams ------------------------------------------------------------------


def _stream(spark, sf_dir, name):
    """A test table as a stream; the braces make its path a pattern, which may name a
    file as well as a folder."""
    return stream_table(spark, f"{{{name}.parquet}}", sf_dir, tf.table(spark, sf_dir, name).schema)


def _parsed_stream(spark, sf_dir, columns):
    raw = tf.as_responses(_stream(spark, sf_dir, "lineitem"))
    return parse_listings(raw, ingested=F.col("ingestion_timestamp"), columns=columns)


@query
def stream_urls(spark, sf_dir):
    """All areas as CSV batches, read as a stream of new files."""
    base = run_folder(spark, "stream")
    listed = tf.areas(spark, sf_dir).select("zip", "state_id", "state_name", "population")
    stamped = listed.withColumn("batch_id", F.lit("20260131_134500"))
    stamped.write.option("header", True).csv(f"{base}/zips/batch_20260131_134500")
    made = urls.build_batch_urls(stream_area_batches(spark, base), API_URL, REFERRAL_URL, AS_OF)
    done = run_stage(made, "urls", base)
    return done.select("zip", "state_id", "state_name", "population", "api_url", "refereral_url", "processed_datehour")


@query
def stream_fetch(spark, sf_dir):
    base = run_folder(spark, "stream")
    write_table(_area_urls(spark, sf_dir), "urls", base)
    return run_stage(fetch_responses(stream_table(spark, "urls", base), _transport, AS_OF), "responses", base)


@query
def stream_parse(spark, sf_dir):
    return _brief(run_stage(_parsed_stream(spark, sf_dir, BRIEF), "listings", run_folder(spark, "stream")))


@query
def stream_dedup(spark, sf_dir):
    """First arrival per property; which one that is, is open within a batch."""
    rows = clean.reference_rows(_parsed_stream(spark, sf_dir, chain.NEEDED), TODAY)
    done = run_first_arrival(rows, "reference", run_folder(spark, "stream"), ["propertyId"])
    return done.groupBy("propertyId").agg(F.count(F.lit(1)).alias("kept"))


@query
def stream_dedup_keyed(spark, sf_dir):
    """First arrival per property from keyed state; the table is not read."""
    rows = clean.reference_rows(_parsed_stream(spark, sf_dir, chain.NEEDED), TODAY)
    done = run_first_arrival_keyed(rows, "reference", run_folder(spark, "stream"), ["propertyId"])
    return done.groupBy("propertyId").agg(F.count(F.lit(1)).alias("kept"))


@query
def stream_dedup_bounded(spark, sf_dir):
    """The same with state bounded by event time."""
    seen = _stream(spark, sf_dir, "events").select(
        "user_id", F.col("ts").cast("timestamp").alias("ts")
    )
    done = run_stage(first_arrival_within(seen, ["user_id"], "ts", "60 days"), "users", run_folder(spark, "stream"))
    return done.groupBy("user_id").agg(F.count(F.lit(1)).alias("kept"))


@query
def stream_join(spark, sf_dir):
    """Stream of listings against the static lookup."""
    rows = clean.reference_rows(_parsed_stream(spark, sf_dir, chain.NEEDED), TODAY)
    joined = joins.join_location(rows, tf.locations(spark, sf_dir)).select(
        "zip", "house_mls", "propertyId", "house_price", "age", "zip_lat", "zip_population"
    )
    return run_stage(joined, "located", run_folder(spark, "stream"))


@query
def stream_join_salted(spark, sf_dir):
    """The same with hot zips dealt to several tasks of a micro-batch."""
    rows = clean.reference_rows(_parsed_stream(spark, sf_dir, chain.NEEDED), TODAY)
    columns = ("zip", "house_mls", "propertyId", "house_price", "age", "zip_lat", "zip_population")
    base = run_folder(spark, "stream")
    return run_location_join(rows, tf.locations(spark, sf_dir), "located", base, lambda joined: joined.select(*columns))


@query
def stream_features(spark, sf_dir):
    base = run_folder(spark, "stream")
    remarks = _stream(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("propertyId"), F.col("text").alias("listingRemarks")
    )
    return run_stage(features.top_features(remarks), "features", base).select("propertyId", "top_features")


@query
def stream_latest(spark, sf_dir):
    """Latest per property by merging every micro-batch into a keyed store."""
    base = run_folder(spark, "stream")
    rows = clean.reference_rows(_parsed_stream(spark, sf_dir, chain.NEEDED), TODAY)
    start_latest(rows, "latest", base, ["propertyId"], "ingestion_timestamp", chain.TIES).awaitTermination()
    merged = read_latest(spark, "latest", base, ["propertyId"], "ingestion_timestamp", chain.TIES)
    return merged.select("propertyId", "house_mls", "house_price", "zip", "age")


@query
def stream_chain(spark, sf_dir):
    """All six stages, from area batches to located listings and features."""
    base = run_folder(spark, "chain")
    listed = tf.areas(spark, sf_dir).select("zip", "state_id", "state_name", "population")
    stamped = listed.withColumn("batch_id", F.lit("20260131_134500"))
    stamped.write.option("header", True).csv(f"{base}/in/zips/batch_20260131_134500")
    made = chain.run_stream_chain(
        spark, f"{base}/in", base, tf.areas(spark, sf_dir), _transport, API_URL, REFERRAL_URL, AS_OF
    )
    return made["located"].join(made["features"].select("propertyId", "top_features"), "propertyId").select(
        "propertyId", "zip", "house_price", "url", "hoa", "zip_lat", "zip_population", "top_features"
    )


# -- the whole ----------------------------------------------------------------


@query
def flagship(spark, sf_dir):
    """Located latest listings, counted and summed by state."""
    located = chain.located_listings(tf.responses(spark, sf_dir), tf.locations(spark, sf_dir), AS_OF, columns=chain.NEEDED)
    by_zip = located.groupBy("zip").agg(
        F.count(F.lit(1)).alias("homes"),
        F.sum("house_price").alias("price"),
        F.max("house_price").alias("top"),
    )
    states = tf.locations(spark, sf_dir).select("zip", "state_name")
    return (
        by_zip.join(states, "zip")
        .groupBy("state_name")
        .agg(F.sum("homes").alias("homes"), F.sum("price").alias("total_price"), F.max("top").alias("max_price"))
        .orderBy("state_name")
    )
