"""Watermarks, control table, stores, fetch, vectors, streams."""

import json
import os
import shutil
import sys
import threading
import time
from datetime import datetime, timedelta

import numpy as np
import pytest
from conftest import plan_of
from pyspark import cloudpickle
from pyspark.sql import functions as F

from hearthline import session
from hearthline.model import AREA_SCHEMA, FIRST_WATERMARK
from hearthline.operators import clean, features, increment, joins, urls, vectors
from hearthline.operators.parse import parse_listings
from hearthline.plans import batch, chain
from hearthline.plans.vector_job import push_new
from hearthline.sources import areas as area_files
from hearthline.sources import attempts, responses, store, tables
from hearthline.streaming import dedup, stages

cloudpickle.register_pickle_by_value(sys.modules[__name__])

AS_OF = datetime(2026, 1, 31, 13, 45)


# -- tables and watermarks


def test_high_watermark(spark, folder):
    first = datetime.fromisoformat(FIRST_WATERMARK)
    assert increment.high_watermark(spark, "none", base=folder) == first
    assert increment.high_watermark(spark, "no_such_table") == first
    rows = spark.createDataFrame([(datetime(2024, 1, 1),), (datetime(2024, 1, 3),)], "ingestion_timestamp timestamp")
    tables.write_table(rows.where("1 = 0"), "empty", folder)
    assert increment.high_watermark(spark, "empty", base=folder) == first
    tables.write_table(rows, "full", folder)
    mark = increment.high_watermark(spark, "full", base=folder)
    assert mark == datetime(2024, 1, 3)
    assert increment.newer_than(rows, mark).count() == 0
    assert increment.newer_than(rows, datetime(2024, 1, 1)).count() == 1


def test_catalog_tables(spark):
    rows = spark.range(3)
    name = "hearthline_test_table"
    tables.drop_table(spark, name)
    try:
        assert tables.find_table(spark, name) is None
        tables.write_table(rows, name)
        tables.write_table(rows, name)
        assert tables.read_table(spark, name).count() == 6
        tables.write_table(rows, name, mode="overwrite")
        assert tables.find_table(spark, name).count() == 3
    finally:
        tables.drop_table(spark, name)


def test_control_bound_reaches_the_scan(spark, folder):
    rows = spark.range(100).select(
        F.col("id").alias("propertyId"), F.timestamp_seconds(F.lit(1.7e9) + F.col("id") * 86400).alias("ingestion_timestamp")
    )
    tables.write_table(rows, "listings", folder)
    listings = tables.read_table(spark, "listings", folder)
    mark = rows.where("id = 90").first().ingestion_timestamp
    tables.write_table(spark.createDataFrame([(mark, mark, 1)], increment.CONTROL_SCHEMA), "control", folder)
    control = increment.read_control(spark, "control", folder)
    fresh = increment.newer_than(listings, increment.control_watermark(control, AS_OF))
    assert sorted(r.propertyId for r in fresh.collect()) == list(range(91, 100))
    explained = fresh._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "GreaterThan(ingestion_timestamp,ScalarSubquery" in explained


def test_control_fallback(spark):
    rows = spark.createDataFrame([(datetime(2026, 1, 11, 0, 0),), (datetime(2026, 1, 11, 0, 1),)], "ingestion_timestamp timestamp")
    empty = increment.empty_control(spark)
    assert increment.newer_than(rows, increment.control_watermark(empty, AS_OF)).count() == 1
    assert increment.newer_than(rows, increment.control_watermark(empty, AS_OF, days_back=50)).count() == 2


def test_record_push(spark, folder):
    assert increment.record_push(spark, "control", AS_OF, AS_OF, folder) == 1
    assert increment.record_push(spark, "control", AS_OF, AS_OF, folder) == 2
    assert increment.read_control(spark, "control", folder).count() == 2


class _Cluster:
    """As much of a session as ``shared_folder`` looks at."""

    def __init__(self, master, settings):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = settings


def test_shared_folder_is_the_named_one():
    named = _Cluster("yarn", {session.CHECKPOINT_KEY: "hdfs://shared/tmp/"})
    assert session.run_folder(named, "x").startswith("hdfs://shared/tmp/x-")
    assert session.run_folder(named, "x") != session.run_folder(named, "x")
    with pytest.raises(ValueError, match=session.CHECKPOINT_KEY):
        session.shared_folder(_Cluster("yarn", {}))
    local = _Cluster("local[2]", {})
    assert session.shared_folder(local) == session.shared_folder(local)


def test_run_folders_go_together(spark):
    made = [session.run_folder(spark, "a"), session.run_folder(spark, "b")]
    kept = list(session._run_folders[:-2])
    session._run_folders[:] = made
    for path in made:
        spark.range(2).write.parquet(path)
    session.drop_run_folders(spark)
    assert not any(map(os.path.exists, made)) and session._run_folders == []
    session._run_folders[:] = kept


def test_dropped_folders_are_gone(spark):
    folder = session.run_folder(spark, "gone")
    spark.range(3).write.parquet(folder)
    session.drop_folder(spark, folder)
    assert not os.path.exists(folder)


# -- stores


@pytest.mark.parametrize("n,sizes", [(0, []), (1, [1]), (100, [100]), (101, [100, 1]), (250, [100, 100, 50])])
def test_chunks(n, sizes):
    assert [len(c) for c in store.chunked(iter([{"i": i} for i in range(n)]))] == sizes


def test_push_hands_over_every_record_once(spark):
    handed, largest = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def write(chunk):
        assert set(chunk[0]) == {"_id", "embedding_text"}
        handed.add(len(chunk))
        largest.add(len(chunk) > 100)

    records = spark.range(0, 1234, 1, 3).select(F.col("id").cast("string").alias("_id"), F.lit("t").alias("embedding_text"))
    store.push_records(records, write)
    assert (handed.value, largest.value) == (1234, 0)


def test_upsert_replay_and_compact(spark, folder):
    def batch_of(ids, text):
        return spark.createDataFrame([(str(i), text) for i in ids], "_id string, embedding_text string")

    path = f"{folder}/store"
    store.upsert(batch_of(range(10), "old"), path, 1)
    store.upsert(batch_of(range(5, 15), "new"), path, 2)
    once = sorted(store.read_store(spark, path).collect())
    store.upsert(batch_of(range(5, 15), "new"), path, 2)
    assert sorted(store.read_store(spark, path).collect()) == once
    assert dict(once) == {str(i): "old" if i < 5 else "new" for i in range(15)}
    store.compact(spark, path, f"{folder}/packed")
    assert sorted(store.read_store(spark, f"{folder}/packed").collect()) == once


def test_compact_keeps_the_newest_by_time(spark, folder):
    path = f"{folder}/store"
    for number, (day, price) in enumerate([(3, 30), (1, 10)]):
        store.upsert(spark.createDataFrame([("a", day, price)], "_id string, day int, price int"), path, number)
    assert store.read_store(spark, path, order="day").first().price == 30
    store.compact(spark, path, f"{folder}/packed", order="day")
    assert [r.price for r in store.read_store(spark, f"{folder}/packed", order="day").collect()] == [30]


def _listings(spark, rows):
    names = [n for n in vectors.template_columns() if n != "top_features"]
    return spark.createDataFrame(rows, "propertyId long, ingestion_timestamp timestamp").select(
        "*", *[F.lit("x").alias(n) for n in names]
    )


def _control(spark, folder):
    rows = sorted(increment.read_control(spark, "control", folder).collect())
    return [(r.last_processed_ts, r.last_pushed_ts, r.batch_id) for r in rows]


def test_vector_job(spark, folder):
    found = spark.range(10).select(F.col("id").alias("propertyId"), F.lit("f").alias("top_features"))
    day = [datetime(2026, 1, d) for d in range(1, 31)]
    one = _listings(spark, [(i, day[20 + i]) for i in range(3)])
    path = f"{folder}/store"
    assert push_new(spark, one, found, "control", path, day[24], base=folder) == 3
    assert push_new(spark, one, found, "control", path, day[24], base=folder) == 0
    two = one.union(_listings(spark, [(7, day[28]), (1, day[27])]))
    assert push_new(spark, two, found, "control", path, AS_OF, base=folder) == 2
    assert {r._id for r in store.read_store(spark, path).collect()} == {"0", "1", "2", "7"}
    assert _control(spark, folder) == [(day[24], day[24], 1), (AS_OF, AS_OF, 2)]


def test_late_features_are_not_lost(spark, folder):
    day = [datetime(2026, 1, d) for d in range(1, 31)]
    rows = _listings(spark, [(1, day[20]), (2, day[25]), (3, day[18])])
    found = spark.createDataFrame([(2, "f"), (3, "f")], "propertyId long, top_features string")
    path = f"{folder}/store"
    assert push_new(spark, rows, found, "control", path, day[26], base=folder) == 2
    assert _control(spark, folder) == [(day[20], day[26], 1)]  # waits for the features of 1
    late = found.union(spark.createDataFrame([(1, "late")], found.schema))
    assert push_new(spark, rows, late, "control", path, day[27], base=folder) == 2
    assert {r._id for r in store.read_store(spark, path).collect()} == {"1", "2", "3"}
    assert _control(spark, folder)[-1] == (day[27], day[27], 2)


def test_equal_times_are_not_lost(spark, folder):
    at, later = datetime(2026, 1, 20), datetime(2026, 1, 21)
    found = spark.range(10).select(F.col("id").alias("propertyId"), F.lit("f").alias("top_features"))
    path = f"{folder}/store"
    assert push_new(spark, _listings(spark, [(1, datetime(2026, 1, 19)), (2, at)]), found, "control", path, at, base=folder) == 1
    more = _listings(spark, [(1, datetime(2026, 1, 19)), (2, at), (3, at), (3, at)])
    assert push_new(spark, more, found, "control", path, later, base=folder) == 2
    assert sorted(r._id for r in store.read_store(spark, path).collect()) == ["1", "2", "3"]


def test_push_leaves_no_folder(spark, folder):
    found = spark.range(10).select(F.col("id").alias("propertyId"), F.lit("f").alias("top_features"))
    before = set(os.listdir(session.shared_folder(spark)))
    push_new(spark, _listings(spark, [(1, datetime(2026, 1, 19))]), found, "control", f"{folder}/store", AS_OF, base=folder)
    push_new(spark, _listings(spark, []), found, "control", f"{folder}/store", AS_OF, base=folder)
    assert {f for f in set(os.listdir(session.shared_folder(spark))) - before if f.startswith("push")} == set()


def test_failed_push_writes_no_control_row(spark, folder):
    found = spark.range(10).select(F.col("id").alias("propertyId"), F.lit("f").alias("top_features"))
    rows = _listings(spark, [(1, datetime(2026, 1, 30))])

    def broken(chunk):
        raise RuntimeError("store is down")

    with pytest.raises(Exception, match="store is down"):
        push_new(spark, rows, found, "control", broken, AS_OF, base=folder)
    assert increment.read_control(spark, "control", folder).count() == 0
    assert push_new(spark, rows, found, "control", f"{folder}/store", AS_OF, base=folder) == 1


# -- vectors


def test_vectors_have_length_one_and_follow_the_words(spark):
    texts = ["red house red", "RED, house; red!", "blue barn", "", None, "été 2024"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, embedding_text string")
    got = {r.i: r.vector for r in vectors.vectorize(df).collect()}
    assert got[0] == got[1] and got[4] is None and not any(got[3])
    for i in (0, 2, 5):
        assert len(got[i]) == 256 and abs(np.linalg.norm(got[i]) - 1) < 1e-6
    assert np.dot(got[0], got[2]) < 0.99


@pytest.mark.parametrize("block", [4096, 7])
def test_cosine_topk_is_exact(spark, block):
    rng = np.random.default_rng(5)
    points = rng.normal(size=(300, 8)).astype(np.float32)
    points[17] = points[3]
    points[40] = 0
    corpus = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, vector array<float>")
    asked = corpus.where("id < 20")
    nothing = spark.createDataFrame([(900, None), (5, None)], corpus.schema)
    got = vectors.cosine_topk(corpus.union(nothing).repartition(5), asked.union(nothing), 4, block)
    rows = {(r.query_id, r["rank"]): r.id for r in got.collect()}
    unit = points.astype(np.float64)
    norms = np.linalg.norm(unit, axis=1, keepdims=True)
    unit = unit / np.where(norms == 0, 1, norms)
    for query in range(20):
        scores = unit @ unit[query]
        best = sorted(range(300), key=lambda i: (-round(scores[i], 12), i))[:4]
        assert [rows[query, k + 1] for k in range(4)] == best


# -- fetch


def _wanted(spark, n=20):
    return spark.range(n).select(
        F.col("id").cast("string").alias("zip"), F.concat(F.lit("u"), F.col("id")).alias("api_url"), F.lit("r").alias("refereral_url")
    )


def _answer(url, referer, timeout):
    number = int(url[1:])
    if number % 5 == 0:
        raise ValueError(f'no "{url}"')
    return (404 if number % 7 == 0 else 200), f"{referer}:{url}"


@pytest.mark.parametrize("options", [{}, {"tasks": 3}, {"threads": 4}])
def test_fetch(spark, options):
    rows = {r.zipcode: r for r in responses.fetch_responses(_wanted(spark, 200), _answer, AS_OF, **options).collect()}
    assert len(rows) == 200
    assert (rows["5"].http_status_code, json.loads(rows["5"].raw_json)) == (500, {"error": 'no "u5"'})
    assert (rows["7"].http_status_code, rows["7"].raw_json) == (404, "r:u7")
    assert (rows["8"].http_status_code, rows["8"].source_url) == (200, "u8")
    assert (rows["8"].ingestion_timestamp, rows["8"].processed_date, rows["8"].processed_hour) == (AS_OF, AS_OF.date(), 13)


def test_fetch_uses_all_cores(spark):
    many = responses.fetch_responses(_wanted(spark, 15_000).coalesce(1), _answer, AS_OF)
    parts = many.groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) >= spark.sparkContext.defaultParallelism and max(r["count"] for r in parts) < 5_000


def test_a_hung_call_costs_one_row(spark):
    def hang(url, referer, timeout):
        assert timeout == 0.5
        if url == "u3":
            threading.Event().wait()
        return 200, url

    rows = {r.zipcode: r for r in responses.fetch_responses(_wanted(spark, 8), hang, AS_OF, tasks=1, timeout=0.5).collect()}
    assert len(rows) == 8 and [z for z, r in rows.items() if r.http_status_code != 200] == ["3"]
    assert json.loads(rows["3"].raw_json) == {"error": "no response in 0.5 s"}


def test_hung_calls_hold_a_bounded_number_of_threads(spark):
    def hang(url, referer, timeout):
        threading.Event().wait()

    urls_ = _wanted(spark, responses.HUNG + 3)
    texts = [r.raw_json for r in responses.fetch_responses(urls_, hang, AS_OF, tasks=1, timeout=0.1).collect()]
    assert sum("no response" in t for t in texts) == responses.HUNG + 1
    assert sum("too many calls hang" in t for t in texts) == 2


def test_calls_to_a_host_are_spaced():
    pace = responses._Pace(20)
    start = time.monotonic()
    for _ in range(5):
        pace.wait("http://one/x")
        pace.wait("http://two/x")
    assert 0.19 < time.monotonic() - start < 0.6
    pace.wait(None)


def _gather(spark, folder, answer, minutes, **options):
    now = AS_OF + timedelta(minutes=minutes)
    attempts.gather_due(spark, "urls", "log", answer, AS_OF, now, folder, tasks=2, **options)
    return tables.read_table(spark, "log", folder)


def test_failed_urls_are_tried_again(spark, folder):
    """Fails twice, then answers: one answer a URL, whatever is listed how often."""
    twice = _wanted(spark, 6).unionByName(_wanted(spark, 3)).unionByName(
        spark.createDataFrame([("9", None, "r")], "zip string, api_url string, refereral_url string")
    )
    tables.write_table(twice, "urls", folder)

    def fail(url, referer, timeout):
        raise ValueError("down")

    assert _gather(spark, folder, fail, 0).count() == 7
    assert _gather(spark, folder, fail, 0.5).count() == 7  # too early
    assert _gather(spark, folder, fail, 1).count() == 14
    assert _gather(spark, folder, lambda u, r, t: (200, u), 2).count() == 14  # the second wait is twice as long
    log = _gather(spark, folder, lambda u, r, t: (200, u), 3)
    assert log.count() == 21 and attempts.answered(log, AS_OF).select("source_url").distinct().count() == 7
    assert _gather(spark, folder, fail, 60).count() == 21  # nothing is left to do
    assert attempts.given_up(log, AS_OF).count() == 0
    states = {(r.attempts, r.answered, r.next_attempt) for r in attempts.url_states(log, AS_OF).collect()}
    assert states == {(3, True, None)}
    # a new cycle begins: all are due again
    later = AS_OF + timedelta(days=1)
    assert attempts.due_urls(tables.read_table(spark, "urls", folder), log, later, later).count() == 7


def test_urls_are_given_up(spark, folder):
    tables.write_table(_wanted(spark, 4), "urls", folder)
    for minutes in (0, 1, 3, 60):
        log = _gather(spark, folder, lambda u, r, t: (404, u), minutes, attempts=2)
    assert log.count() == 8 and attempts.given_up(log, AS_OF).count() == 4
    assert attempts.answered(log, AS_OF).count() == 0


def test_a_run_that_lost_rows_is_taken_up(spark, folder):
    """Rows of a run that were not written are fetched by the next run, the others are not."""
    tables.write_table(_wanted(spark, 4), "urls", folder)
    log = _gather(spark, folder, lambda u, r, t: (200, u), 0)
    kept = log.where("source_url <> 'u2'")
    due = attempts.due_urls(_wanted(spark, 4), kept, AS_OF, AS_OF).collect()
    assert [(r.api_url, r.attempt) for r in due] == [("u2", 1)]
    empty = attempts.due_urls(_wanted(spark, 0), kept, AS_OF, AS_OF)
    assert empty.count() == 0


def test_states_read_no_bodies_and_only_the_days_of_the_cycle(spark, folder):
    tables.write_table(_wanted(spark, 4), "urls", folder)
    log = _gather(spark, folder, lambda u, r, t: (200, u), 0)
    plan = plan_of(attempts.url_states(log, AS_OF))
    assert "raw_json" not in plan and "PartitionFilters: [isnotnull(processed_date" in plan


def test_captured(spark):
    captures = spark.createDataFrame([("u1", "one"), ("u3", None)], "url string, body string")
    rows = {r.zipcode: r for r in responses.captured_responses(_wanted(spark, 4), captures, AS_OF).collect()}
    assert (rows["1"].raw_json, rows["1"].http_status_code) == ("one", 200)
    assert (rows["3"].raw_json, rows["3"].http_status_code) == (None, 200)
    assert (json.loads(rows["2"].raw_json), rows["2"].http_status_code) == ({"error": "no response for u2"}, 500)


# -- area files


def test_area_files(spark, folder):
    with open(f"{folder}/uszips.csv", "w") as out:
        out.write("zip,lat,lng,state_id,state_name,population,density\n01001,42.1,-72.6,MA,Massachusetts,16064,563.6\n00601,18.2,-66.7,PR,Puerto Rico,,\n")
    known = area_files.read_area_csv(spark, f"{folder}/uszips.csv")
    assert known.schema.simpleString() == spark.createDataFrame([], AREA_SCHEMA).schema.simpleString()
    assert known.first().zip == "01001"
    written = area_files.export_area_batch(urls.sample_areas(known, 10), folder, AS_OF)
    assert written.endswith("/zips/batch_20260131_134500")
    assert len([f for f in os.listdir(written) if f.endswith(".csv")]) == 1
    rows = area_files.read_area_batches(spark, folder).collect()
    assert [tuple(r) for r in rows] == [("01001", "MA", "Massachusetts", "16064", "20260131_134500")]


# -- batch tasks


def _home(number, price, area="77713"):
    return {"propertyId": number, "price": {"value": price}, "zip": area, "mlsId": {"value": f"m{number}-{price}"}}


def _responses(spark, *rows):
    """``(time, homes)`` -> responses."""
    return spark.createDataFrame(
        [("77713", "u", "{}&&" + json.dumps({"payload": {"homes": homes}}), 200, time, time.date(), time.hour) for time, homes in rows],
        responses.RESPONSE_SCHEMA,
    )


def test_batch_tasks(spark, folder):
    known = spark.range(50).select(F.format_string("%05d", "id").alias("zip"), F.lit("TX").alias("state_id"), F.lit("T X").alias("state_name"), F.lit(1).alias("population"))
    batch.generate_urls(known, "urls", "https://a/%s", "https://r/%s/%s/%s", 20, 1, AS_OF, folder)
    assert os.path.isdir(f"{folder}/urls/processed_datehour=2026-01-31-13")

    def answer(url, referer, timeout):
        return 200, "{}&&" + json.dumps({"payload": {"homes": [_home(int(url[-5:]), 5)]}})

    batch.gather_responses(spark, "urls", "raw", answer, AS_OF, folder, tasks=2)
    day = ("processed_date",)
    assert os.path.isdir(f"{folder}/raw/processed_date=2026-01-31")
    batch.parse_new(spark, "raw", "parsed", as_of=AS_OF, base=folder)  # ends before the responses' time
    assert tables.find_table(spark, "parsed", folder) is None
    batch.parse_new(spark, "raw", "parsed", as_of=datetime(2026, 1, 31, 14), base=folder)
    batch.parse_new(spark, "raw", "parsed", as_of=datetime(2026, 1, 31, 14), base=folder)
    assert tables.read_table(spark, "parsed", folder).count() == 20
    end = datetime(2026, 2, 1)
    tables.write_table(_responses(spark, (datetime(2026, 1, 31, 14), [_home(1, 9), _home(2, 9)]), (end, [_home(3, 9)])), "raw", folder, partition_by=day)
    batch.parse_new(spark, "raw", "parsed", as_of=end, base=folder)
    assert tables.read_table(spark, "parsed", folder).count() == 22
    tables.write_table(_responses(spark, (end, [_home(4, 9)])), "raw", folder, partition_by=day)
    batch.parse_new(spark, "raw", "parsed", as_of=datetime(2026, 2, 2), base=folder)
    assert tables.read_table(spark, "parsed", folder).count() == 24
    raw = tables.read_table(spark, "raw", folder)
    plan = plan_of(batch.new_responses(raw, end, datetime(2026, 2, 2)))
    assert "PartitionFilters: [isnotnull(processed_date" in plan


def test_a_run_done_again_replaces_its_listings(spark, folder):
    tables.write_table(_responses(spark, (datetime(2026, 1, 5), [_home(1, 9), _home(2, 9)])), "raw", folder)
    batch.parse_new(spark, "raw", "parsed", as_of=AS_OF, base=folder)
    shutil.rmtree(f"{folder}/parsed_control")  # as if the run had ended before its last step
    batch.parse_new(spark, "raw", "parsed", as_of=AS_OF, base=folder)
    assert tables.read_table(spark, "parsed", folder).count() == 2


# -- streams


def _days(spark):
    day = [datetime(2026, 1, d) for d in (1, 2, 3)]
    return [
        _responses(spark, (day[0], [_home(1, 10), _home(2, 20)]), (day[2], [_home(1, 30)])),
        _responses(spark, (day[1], [_home(1, 99), _home(3, 5), _home(4, 1, "bad")])),
    ]


def _reference(raw):
    return clean.reference_rows(parse_listings(raw, ingested=F.col("ingestion_timestamp")), AS_OF)


def test_stream_is_batch_and_goes_on(spark, folder):
    for number, raw in enumerate(_days(spark), 1):
        tables.write_table(raw, "raw", folder)
        stream = tables.stream_table(spark, "raw", folder, max_bytes=1000)
        done = stages.run_stage(_reference(stream), "parsed", folder)
        whole = _reference(tables.read_table(spark, "raw", folder))
        assert sorted(map(str, done.collect())) == sorted(map(str, whole.collect()))
    assert done.count() == 5 and number == 2


def test_stream_dedup_keeps_the_first_to_arrive(spark, folder):
    for raw in _days(spark):
        tables.write_table(raw, "raw", folder)
        rows = _reference(tables.stream_table(spark, "raw", folder, max_bytes=1))
        done = dedup.run_first_arrival(rows, "unique", folder, ["propertyId"])
    kept = {r.propertyId: r.house_price for r in done.collect()}
    assert set(kept) == {1, 2, 3} and done.count() == 3 and kept[1] in (10, 30)


def test_micro_batches_are_bounded(spark, folder):
    for number in range(5):
        tables.write_table(_responses(spark, (datetime(2026, 1, 1 + number), [_home(1, 5), _home(number, 6)])), "raw", folder)
    seen = tables.stream_table(spark, "raw", folder, max_bytes=1)
    query = stages.start_stage(seen, "copied", folder)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p.numInputRows]) == 5
    done = dedup.run_first_arrival(_reference(tables.stream_table(spark, "raw", folder, max_bytes=1)), "unique", folder, ["propertyId"])
    assert sorted(r.propertyId for r in done.collect()) == [0, 1, 2, 3, 4]


def test_stream_dedup_within_a_delay(spark, folder):
    times = [datetime(2026, 1, 1, 0), datetime(2026, 1, 1, 1), datetime(2026, 1, 9), datetime(2026, 1, 20)]
    for time in times:
        tables.write_table(_responses(spark, (time, [_home(1, time.day)])), "raw", folder)
        seen = tables.stream_table(spark, "raw", folder).select("zipcode", "ingestion_timestamp")
        done = stages.run_stage(dedup.first_arrival_within(seen, ["zipcode"], "ingestion_timestamp", "1 day"), "seen", folder)
    # The copy an hour later is dropped.  That of the 9th meets the old state and
    # is dropped too, but moves the watermark on: that of the 20th is new again.
    assert sorted(r.ingestion_timestamp.day for r in done.collect()) == [1, 20]


def test_stream_latest_takes_the_newest_of_all_batches(spark, folder):
    for raw in _days(spark):
        tables.write_table(raw, "raw", folder)
        rows = _reference(tables.stream_table(spark, "raw", folder))
        dedup.start_latest(rows, "latest", folder, ["propertyId"], "ingestion_timestamp", chain.TIES).awaitTermination()
    merged = dedup.read_latest(spark, "latest", folder, ["propertyId"], "ingestion_timestamp", chain.TIES)
    assert {r.propertyId: r.house_price for r in merged.collect()} == {1: 30, 2: 20, 3: 5}
    latest = chain.latest_listings(tables.read_table(spark, "raw", folder), AS_OF)
    assert sorted(map(str, merged.collect())) == sorted(map(str, latest.collect()))


def test_stream_static_join(spark, folder):
    known = spark.createDataFrame([("77713", 1.0, 2.0, "TX", "T", 3, 4.0)], AREA_SCHEMA)
    tables.write_table(_days(spark)[0], "raw", folder)
    rows = _reference(tables.stream_table(spark, "raw", folder))
    done = stages.run_stage(joins.join_location(rows, known), "joined", folder)
    assert done.count() == 3 and done.first().zip_population == 3


def test_whole_chain_twice(spark, folder):
    known = spark.range(30).select(
        F.format_string("%05d", "id").alias("zip"), F.lit(1.0).alias("lat"), F.lit(2.0).alias("lng"), F.lit("TX").alias("state_id"),
        F.lit("T").alias("state_name"), F.col("id").alias("population"), F.lit(3.0).alias("density"),
    )

    def answer(url, referer, timeout):
        number = int(url[-5:])
        if number == 4:
            raise TimeoutError("slow")
        home = {**_home(number, 7, url[-5:]), "listingRemarks": "big, quiet"}
        return 200, "{}&&" + json.dumps({"payload": {"homes": [home, home]}})

    counts = []
    for hour, sample in ((1, known.where("zip < '00010'")), (2, known.where("zip < '00015'"))):
        picked = sample.select("zip", "state_id", "state_name", "population")
        area_files.export_area_batch(picked, f"{folder}/in", datetime(2026, 1, 31, hour))
        made = chain.run_stream_chain(spark, f"{folder}/in", folder, known, answer, "https://a/%s", "%s%s%s", AS_OF)
        counts.append({name: table.count() for name, table in made.items()})
    assert counts[0] == {"urls": 10, "responses": 10, "listings": 18, "reference": 9, "located": 9, "features": 9}
    assert counts[1] == {"urls": 25, "responses": 25, "listings": 46, "reference": 14, "located": 14, "features": 14}
    assert {r.top_features for r in made["features"].collect()} == {"big, quiet"}
