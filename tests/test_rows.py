"""Cleaning, dedup, joins, profiles, URLs and text functions."""

from datetime import date, datetime

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from hearthline.functions.text import error_body, fill_template, is_number, json_map, leading_phrases, template_columns
from hearthline.model import EMBEDDING_TEMPLATE
from hearthline.operators import clean, dedup, features, joins, profile, urls
from hearthline.sources import tables

AS_OF = datetime(2026, 1, 31, 13, 45)


def test_numbers_as_text(spark):
    words = ["77713", " 77713 ", "77713-1234", "", None, "NaN", "Infinity", "12D", "1e5", "12345678901", "abc"]
    df = spark.createDataFrame([(w,) for w in words], "zip string")
    passed = {row.zip for row in clean.valid_zip(df).collect()}
    assert passed == {"77713", " 77713 ", "NaN", "Infinity", "12D", "1e5", "12345678901"}
    strict = {row.zip for row in clean.valid_zip(df, "numeric").collect()}
    assert strict == {"77713", " 77713 ", "1e5"}
    assert df.select(is_number(F.col("zip")).alias("n")).where("n is null").count() == 0


def test_defaults_and_age(spark):
    df = spark.createDataFrame(
        [("m1", None, 1999, "1"), ("m2", "25", None, "2")], "`mls#` string, hoa string, yearBuilt int, zip string"
    )
    rows = clean.with_defaults(df, date(2026, 1, 31)).collect()
    assert rows[0].asDict() == {"house_mls": "m1", "hoa": "0", "yearBuilt": 1999, "zip": "1", "age": 27}
    assert (rows[1].hoa, rows[1].age) == ("25", None)


@pytest.fixture(scope="module")
def priced(spark):
    rows = [(1, datetime(2024, 1, d), d * 10) for d in (2, 3, 1)]
    rows += [(2, datetime(2024, 1, 1), 5), (2, datetime(2024, 1, 1), 6), (None, datetime(2024, 1, 1), 7), (None, datetime(2024, 1, 2), 8)]
    return spark.createDataFrame(rows, "id int, ts timestamp, price int")


def test_latest_and_first(spark, priced):
    latest = {r.id: r.price for r in dedup.latest_per_key(priced, ["id"], "ts", ["price"]).collect()}
    first = {r.id: r.price for r in dedup.first_per_key(priced, ["id"], "ts", ["price"]).collect()}
    assert latest == {1: 30, 2: 6, None: 8}
    assert first == {1: 10, 2: 5, None: 7}
    assert dedup.any_per_key(priced, ["id"]).count() == 3


def test_dedup_cuts_rows_before_the_shuffle(spark, priced):
    plan = plan_of(dedup.latest_per_key(priced, ["id"], "ts", ["price"]))
    before, after = plan.index("Partial"), plan.index("Exchange")
    assert "WindowGroupLimit" in plan and before > after  # printed top down


def _facts(spark, n=3000):
    """Two thirds of the rows on two keys, one of them in identical copies."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "copies").otherwise(F.concat(F.lit("k"), F.col("id") % 50))
    value = F.when(F.col("id") % 3 == 1, 0).otherwise(F.col("id"))
    return spark.range(0, n, 1, 8).select(key.alias("zip"), value.alias("v"))


def _lookup(spark):
    keys = [("hot",), ("copies",), ("nobody",)] + [(f"k{i}",) for i in range(40)]
    return spark.createDataFrame(keys, "zip string").select(
        "zip", F.lit(1.0).alias("lat"), F.lit(2.0).alias("lng"), F.length("zip").alias("population"), F.lit(3.0).alias("density")
    )


def test_location_is_broadcast_only_when_small(spark):
    facts, lookup = _facts(spark), _lookup(spark)
    small = joins.join_location(facts, lookup)
    rows = sorted(small.collect())
    assert "BroadcastHashJoin" in plan_of(small) and small.columns == ["zip", "v", "zip_lat", "zip_lng", "zip_population", "zip_density"]
    limits = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in limits:
        spark.conf.set(key, "-1")
    try:
        large = joins.join_location(facts, lookup)
        assert sorted(large.collect()) == rows and "BroadcastHashJoin" not in plan_of(large)
    finally:
        for key in limits:
            spark.conf.unset(key)


def test_latest_row_does_not_hang_on_the_order_of_input(spark):
    rows = [("a", 1, "m", zipcode) for zipcode in ("77713", "77714", "77715")]
    frame = spark.createDataFrame(rows, "id string, ts int, mls string, searched string")
    kept = {
        dedup.latest_per_key(part, ["id"], "ts", ["mls"]).first().searched
        for part in (frame, frame.orderBy("searched"), frame.orderBy(F.desc("searched")), frame.repartition(3))
    }
    assert len(kept) == 1


def test_feature_join_drops_null_properties(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "propertyId long, city string")
    right = spark.createDataFrame([(1, "r", "f"), (None, "r", "g")], "propertyId long, listingRemarks string, top_features string")
    assert [tuple(r) for r in joins.join_features(left, right).collect()] == [(1, "a", "f")]


def test_hot_join_partition_is_split_at_run_time(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        left = _facts(spark, 60_000).withColumnRenamed("zip", "propertyId")
        right = _lookup(spark).select(F.col("zip").alias("propertyId"), F.lit("r").alias("listingRemarks"), F.lit("f").alias("top_features"))
        joined = joins.join_features(left, right)
        joined.collect()
        assert "skew=true" in plan_of(joined)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_profiles(spark, priced):
    row = profile.profile(priced, {"ids": "id", "prices": "price"}).first()
    assert row.asDict() == {"row_count": 7, "ids": 2, "prices": 7}
    days = profile.profile_daily(priced, "ts", {"ids": "id"}, "rows")
    assert {(r.extracted_date.day, r.rows, r.ids) for r in days.collect()} == {(1, 4, 2), (2, 2, 1), (3, 1, 1)}
    latest = dedup.latest_per_key(priced, ["id"], "ts", ["price"]).where("id is not null")
    unique = profile.profile(latest, {"ids": "id"}).first()
    assert unique.row_count == unique.ids


def test_urls(spark):
    areas = spark.createDataFrame([("77713", "TX", "New Mexico", 5)], "zip string, state_id string, state_name string, population int")
    row = urls.build_urls(areas, "https://a/%s", "https://r/%s/%s/%s", AS_OF).first()
    assert (row.api_url, row.refereral_url, row.processed_datehour) == ("https://a/77713", "https://r/77713/TX/New-Mexico", "2026-01-31-13")
    assert urls.build_urls(areas, "%s", "%s%s%s", AS_OF, dashes=False).first().refereral_url == "77713TXNew Mexico"


def test_sampling(spark):
    areas = spark.range(1000).select(
        F.col("id").cast("string").alias("zip"), F.lit("TX").alias("state_id"), F.lit("T").alias("state_name"),
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("population"),
    )
    sample = urls.sample_areas(areas, 100, seed=3)
    assert sample.count() == 100 and sample.where("population is null").count() == 0
    assert sample.select("zip").distinct().count() == 100
    assert "TakeOrderedAndProject" in plan_of(sample)
    again = urls.sample_areas_by_hash(areas, 100)
    assert again.collect() == urls.sample_areas_by_hash(areas.repartition(7), 100).collect()
    assert again.collect() != urls.sample_areas_by_hash(areas, 100, salt="week 2").collect()
    assert urls.sample_areas(areas, 5000).count() == 500


def test_text_functions(spark):
    df = spark.createDataFrame(
        [('{"a": 1, "b": {"c": 2}}',), ("{'a': 1}",), ("[1]",), (None,), ("",)], "t string"
    ).select(json_map(F.col("t")).alias("m"))
    assert [r.m for r in df.collect()] == [{"a": "1", "b": '{"c":2}'}, None, None, None, None]
    assert spark.range(1).select(error_body(F.lit('say "no"'))).first()[0] == '{"error":"say \\"no\\""}'


def test_phrases(spark):
    texts = ["One, two. three\nfour, five", "only", "", None, " , .\n", "it's \"big\", a"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(leading_phrases(F.col("t")))
    assert [r[0] for r in df.collect()] == ["One, two, three, four", "only", "", None, "", "it's \"big\", a"]


def test_template(spark):
    names = template_columns()
    assert len(names) == 18
    full = spark.range(1).select(*[F.lit(f"<{n}>").alias(n) for n in names]).select(fill_template()).first()[0]
    assert full == EMBEDDING_TEMPLATE.format(**{n: f"<{n}>" for n in names})
    empty = spark.range(1).select(*[F.lit(None).cast("string").alias(n) for n in names]).select(fill_template()).first()[0]
    assert empty.count("N/A") == 18 and "$N/A" in empty


def test_model_sees_prompts_and_no_nulls(spark):
    df = spark.createDataFrame([(1, "nice, big"), (2, None), (3, "")], "propertyId long, listingRemarks string")
    rows = features.top_features(df, lambda prompts: prompts.str.slice(-9)).orderBy("propertyId").collect()
    assert [r.top_features for r in rows] == ["nice, big", None, "ed property\n"[-9:]]


def test_bucketed_tables_are_joined_without_a_shuffle(spark, folder):
    left = spark.range(200).select(F.col("id").alias("propertyId"), (F.col("id") * 2).alias("house_price"))
    right = spark.range(150, 400).select(F.col("id").alias("propertyId"), F.lit("f").alias("top_features"))
    names = ("bucketed_listings", "bucketed_features")
    for name, rows in zip(names, (left, right)):
        tables.write_bucketed(rows, name, "propertyId", 8, f"{folder}/{name}")
        tables.write_bucketed(rows, name, "propertyId", 8, f"{folder}/{name}")  # done again
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = joins.join_features(*map(spark.table, names))
        assert sorted(tuple(r) for r in joined.collect()) == [(i, i * 2, "f") for i in range(150, 200)]
        assert "Exchange" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
        assert "Exchange" in plan_of(joins.join_features(left, right))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for name in names:
            tables.drop_table(spark, name)
