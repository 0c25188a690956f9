"""What keeps work from growing: keyed streams, salted joins, kept answers, sketches."""

import glob
import json
from datetime import datetime, timedelta
from pathlib import Path

import pandas as pd
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from hearthline import registry, session
from hearthline import testframes as tf
from hearthline.operators import features, joins, profile
from hearthline.sources import tables
from hearthline.streaming import dedup, stages

PLACES = "zip string, lat double, lng double, population bigint, density double"


def place_rows(n):
    return [(str(i), float(i), -float(i), None if i % 5 == 0 else 10 * i, 1.0) for i in range(n)]


def listing_rows(n, zips, hot="7"):
    """Half of all rows in one zip; some zips without a place, some null."""
    return [(i, hot if i % 2 else (None if i % 40 == 0 else str(i % zips)), i) for i in range(n)]


@pytest.fixture
def no_help(spark):
    """As in a stream, beyond the size that is broadcast."""
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {key: spark.conf.get(key) for key in off}
    for key, value in off.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_salted_join(spark, no_help):
    listings = spark.createDataFrame(listing_rows(6000, 300), "propertyId long, zip string, zip_lat_own int")
    places = spark.createDataFrame(place_rows(290), PLACES)
    hot = joins.hot_keys(listings, "zip", 32)
    assert hot == ["7"]
    plain, salted = joins.join_location(listings, places), joins.join_location_salted(listings, places, hot)
    assert sorted(map(repr, plain.select(sorted(plain.columns)).collect())) == sorted(map(repr, salted.select(sorted(salted.columns)).collect()))

    def largest(df):
        sizes = sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        return sizes[-1] / sizes[len(sizes) // 2]

    assert largest(plain) > 5 and largest(salted) <= 3


def test_hot_keys_of_nothing(spark):
    empty = spark.createDataFrame([], "zip string, propertyId long")
    assert joins.hot_keys(empty, "zip", 4) == []
    assert joins.join_location_salted(empty, spark.createDataFrame(place_rows(3), PLACES), []).count() == 0


def test_stream_of_salted_batches(spark, folder, no_help):
    rows = spark.createDataFrame(listing_rows(900, 60), "propertyId long, zip string, at int")
    rows.repartition(3).write.parquet(f"{folder}/raw")
    places = spark.createDataFrame(place_rows(50), PLACES)
    stream = tables.stream_table(spark, "raw", folder, max_bytes=1)

    def run():
        return stages.run_location_join(stream, places, "located", folder, lambda j: j.select("propertyId", "zip", "zip_lat"))

    expected = sorted(map(repr, joins.join_location(rows, places).select("propertyId", "zip", "zip_lat").collect()))
    assert sorted(map(repr, run().collect())) == expected
    assert len(list(Path(folder, "located").glob("store_batch=*"))) == 3
    assert sorted(map(repr, run().collect())) == expected  # nothing new, nothing twice


def test_keyed_first_arrival(spark, folder):
    schema = "propertyId long, part int"
    for part, ids in enumerate([[1, 2, 2, None], [2, 3, None], [1, 4]]):
        spark.createDataFrame([(i, part) for i in ids], schema).coalesce(1).write.mode("append").parquet(f"{folder}/raw")
        stream = tables.stream_table(spark, "raw", folder)
        done = dedup.run_first_arrival_keyed(stream, "unique", folder, ["propertyId"])
    found = sorted(map(tuple, done.collect()), key=repr)
    assert found == sorted([(1, 0), (2, 0), (None, 0), (3, 1), (4, 2)], key=repr)


def test_each_prompt_is_asked_once(spark, folder):
    calls = Path(folder, "calls")
    calls.mkdir()

    def model(prompts: pd.Series) -> pd.Series:
        import uuid

        Path(calls, uuid.uuid4().hex).write_text("\n".join(p[-3:] for p in prompts))
        return prompts.str.len().astype(str)

    def asked():
        return sorted(line for file in calls.iterdir() for line in file.read_text().split("\n"))

    remarks = ["one", "two", "one", None, "two", "six"]
    listings = spark.createDataFrame(list(enumerate(remarks)), "propertyId long, listingRemarks string").repartition(4)
    first = listings.where("propertyId < 3")
    features.ask_new_prompts(first, model, "answers", folder)
    assert asked() == ["one", "two"]
    for _ in range(2):
        found = features.with_kept_features(listings, model, "answers", folder).collect()
        assert asked() == ["one", "six", "two"]
    answers = {r.propertyId: r.top_features for r in found}
    assert len(found) == 6 and answers[3] is None and answers[0] == answers[2] and all(answers[i] for i in (0, 1, 2, 4, 5))
    none = listings.where("propertyId < 0")
    assert features.with_kept_features(none, model, "other", folder).count() == 0


def test_sketches(spark, folder):
    days = spark.range(40_000).select(
        F.expr("timestamp'2026-01-01 12:00:00' + make_interval(0, 0, 0, cast(id % 60 AS int))").alias("at"),
        (F.col("id") * 7 % 3001).alias("few"),
        F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("many"),
    )
    distinct = {"few": "few", "many": "many"}
    for month in (1, 2, 2):  # a month that is done again replaces itself
        part = profile.daily_sketches(days.where(F.month("at") == month), "at", distinct, "n", 12)
        tables.replace_parts(part.withColumn("month", F.month("day")), "sketches", ("month",), folder)
    tables.replace_parts(
        profile.daily_sketches(days.where(F.month("at") > 2), "at", distinct, "n", 12).withColumn("month", F.month("day")), "sketches", ("month",), folder
    )
    kept = tables.read_table(spark, "sketches", folder)
    all_days = profile.roll_up(kept, {}, distinct, "n", 12).first()
    exact = days.agg(F.count(F.lit(1)), F.count_distinct("few"), F.count_distinct("many")).first()
    assert (all_days.n, all_days.few) == (exact[0], exact[1])  # below 2^12: exact
    assert abs(all_days.many / exact[2] - 1) < 0.08  # five standard errors
    by_month = {r.month: (r.n, r.few) for r in profile.roll_up(kept, {"month": F.month("day")}, distinct, "n", 12).collect()}
    assert by_month == {r[0]: (r[1], r[2]) for r in days.groupBy(F.month("at")).agg(F.count(F.lit(1)), F.count_distinct("few")).collect()}


ITEMS = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
)


def write_items(spark, folder, n=70):
    days = [datetime(1998, 5, 30) + timedelta(days=i % 5) for i in range(n)]
    rows = [(i, i % 9, i % 4, i % 7 + 1, 2.0, None if i % 10 == 0 else -50.0 + 3 * i, 0.02, "ARN"[i % 3], "FO"[i % 2], days[i]) for i in range(n)]
    spark.createDataFrame(rows, ITEMS).repartition(6).write.parquet(f"{folder}/lineitem.parquet")


def test_one_json_text_per_projection(spark, folder):
    """Two make a projection so long that the JVM does not compile it."""
    write_items(spark, folder)
    for frame in (tf.dirty_responses(spark, folder), tf.pair_responses(spark, folder, "payload.homes")):
        assert max(line.count("StructsToJson") for line in plan_of(frame).split("\n")) == 1


def test_second_home_is_the_first_at_half_the_price(spark, folder):
    write_items(spark, folder)
    found = tf.pair_responses(spark, folder, "payload.homes").collect()
    prices = set()
    for first, second in (json.loads(r.raw_json[4:])["payload"]["homes"] for r in found):
        price = first.pop("price").get("value")
        prices.add(price)
        assert second.pop("price").get("value") == (None if price is None else int(price / 2)) and first == second
    assert None in prices and min(p for p in prices if p is not None) < 0 and len(found) == 70


def test_homes_found_twice_are_made_once(spark, folder):
    write_items(spark, folder)
    assert plan_of(registry.QUERIES["latest_found_twice"](spark, folder)).count("FileScan") == 1


def test_responses_of_a_day_are_one_file(spark, folder):
    write_items(spark, folder)
    before = set(glob.glob(f"{session.shared_folder(spark)}/parse-*"))
    assert registry.QUERIES["watermark_parse"](spark, folder).count() == 70
    (made,) = set(glob.glob(f"{session.shared_folder(spark)}/parse-*")) - before
    files = {day: len(glob.glob(f"{day}/*.parquet")) for day in glob.glob(f"{made}/raw_data/processed_date=*")}
    split = f"{made}/raw_data/processed_date=1998-06-01"  # written twice
    assert len(files) == 5 and all(n == 1 for day, n in files.items() if day != split) and files[split] <= 2


def test_scan_tasks_are_small(spark):
    before = spark.conf.get(session.SPLIT_KEY)
    try:
        for given, kept in (("134217728b", "16m"), ("128m", "16m"), ("1m", "1m"), ("64k", "64k"), ("4096", "4096")):
            spark.conf.set(session.SPLIT_KEY, given)
            assert session.limit_splits(spark).conf.get(session.SPLIT_KEY) == kept
    finally:
        spark.conf.set(session.SPLIT_KEY, before)


def test_a_micro_batch_is_computed_once(spark, folder, no_help):
    rows = spark.createDataFrame(listing_rows(900, 60), "propertyId long, zip string, at int")
    rows.repartition(3).write.parquet(f"{folder}/raw")
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    stream = tables.stream_table(spark, "raw", folder).mapInArrow(counted, rows.schema)
    places = spark.createDataFrame(place_rows(50), PLACES)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    done = stages.run_location_join(stream, places, "located", folder, lambda j: j.select("propertyId", "zip", "zip_lat"))
    expected = sorted(map(repr, joins.join_location(rows, places).select("propertyId", "zip", "zip_lat").collect()))
    assert sorted(map(repr, done.collect())) == expected and made.value == 900
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_embedding_texts_read_only_their_columns(spark, folder, monkeypatch):
    asked, latest = [], registry.chain.latest_listings
    monkeypatch.setattr(registry.chain, "latest_listings", lambda *args, columns, **kw: asked.append(set(columns)) or latest(*args, columns=columns, **kw))
    write_items(spark, folder)
    spark.createDataFrame([(i, 0, 1.0 * i) for i in range(4)], "s_suppkey long, s_nationkey int, s_acctbal double").write.parquet(f"{folder}/supplier.parquet")
    spark.createDataFrame([(0, "A")], "n_nationkey int, n_name string").write.parquet(f"{folder}/nation.parquet")
    for name in ("embedding_text", "vector_records"):
        assert registry.QUERIES[name](spark, folder).count() > 0
    assert len(asked) == 2 and all(len(columns) == 22 and "listingRemarks" in columns for columns in asked)


def write_odd_items(spark, folder):
    """Items with a null, and with text that JSON escapes or numbers it has no word for, in each column in turn."""
    sound = (5, 11, 3, 7, 2.0, 40.5, 0.02, "N", "O", datetime(1998, 6, 1))
    odd = {6: (float("nan"), float("inf"), -1e-7, 1e22), 7: ('"\\', "\x01é\n"), 8: ('\t"', "F"), 2: (-4,), 1: (10**12,), 5: (-7.9,)}
    rows = [sound, *[(*sound[:at], None, *sound[at + 1 :]) for at in range(9)], (*[None] * 9, sound[9])]
    rows += [(*sound[:at], value, *sound[at + 1 :]) for at, values in odd.items() for value in values]
    rows += [(*sound[:3], line, *sound[4:7], flag, "F", sound[9]) for line in (1, 2) for flag in "ARN"]
    spark.createDataFrame(rows, ITEMS).write.parquet(f"{folder}/lineitem.parquet")
    return len(rows)


def test_home_text_is_the_home(spark, folder):
    n = write_odd_items(spark, folder)
    found = tf.items(spark, folder).select(F.to_json(tf.home()).alias("home"), tf.home_text().alias("text")).collect()
    assert len(found) == n and all(json.loads(r.home) == json.loads(r.text) and len(r.home) == len(r.text) for r in found)


def test_few_fields_go_through_to_json(spark, folder):
    """Only those with text of the table, which has to be escaped."""
    write_items(spark, folder)
    before = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    try:
        (line,) = (line for line in plan_of(tf.responses(spark, folder)).split("\n") if "StructsToJson" in line)
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", before)
    assert line.count("StructField(") <= 5


def test_bodies_are_joined_once(spark, folder):
    """Every further joining of parts copies the whole body again."""
    n = write_odd_items(spark, folder)
    before = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    try:
        (line,) = (line for line in plan_of(tf.responses(spark, folder)).split("\n") if "StructsToJson" in line)
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", before)
    assert line.count("concat_ws(") == 1  # that of the number of a listing
    items = tf.items(spark, folder)
    one, listed = (
        sorted(r.raw_json for r in tf.as_responses(items, homes=homes).collect()) for homes in (None, F.array(tf.home_text()))
    )
    assert len(one) == n and one == listed
