"""Mixing, packing, sharding and fingerprints against plain Python."""

import hashlib
import itertools
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import awkward, awkward_rows, empty, words
from hearthline.llm import fingerprints, mixing, packing, sharding
from hearthline.llm.common import numbered


def rows_of(df):
    return [row.asDict() for row in df.collect()]


def fill(sizes, weights, epochs):
    """Water-filling by repeated clamping."""
    targets, free, left = {}, set(sizes), float(sum(sizes.values()))
    while free:
        level = left / sum(weights[s] for s in free)
        over = {s for s in free if level * weights[s] >= epochs * sizes[s]}
        if not over:
            return targets | {s: level * weights[s] for s in free}
        for s in over:
            targets[s] = float(epochs * sizes[s])
            left -= targets[s]
        free -= over
    return targets


def test_mixing_is_water_filling(spark):
    rows = awkward_rows()
    got = rows_of(mixing.mix(awkward(spark)))
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter((r[0], r[3], len(words(r[1]))) for r in rows)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    order = sorted((s for s in sizes if s is not None)) + [None]
    want = fill(dict(sizes), {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 3)
    taken = Counter()
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["source_size"] == sizes[r["source"]]
        assert 0 <= r["taken"] <= 3 * r["size"]
        whole = int(r["target"] // r["source_size"])
        assert whole * r["size"] <= r["taken"] <= (whole + 1) * r["size"]
        taken[r["source"]] += r["taken"]
    for source, target in want.items():
        assert abs(taken[source] - target) <= 1
    again = rows_of(mixing.mix(awkward(spark).repartition(2)))
    assert Counter(map(str, got)) == Counter(map(str, again))


def test_mixing_clamps_in_several_steps(spark):
    sizes = {"a": 10, "b": 400, "c": 3, "d": 60, "e": 900, "f": 0}
    frame = spark.createDataFrame([(s, n, w) for (s, n), w in zip(sizes.items(), (5, 2, 1, 5, 2, 1))], "source string, source_size long, weight int")
    got = {r["source"]: r["target"] for r in rows_of(mixing.fill_targets(frame, 3))}
    assert got == pytest.approx(fill(sizes, dict(zip(sizes, (5, 2, 1, 5, 2, 1))), 3))
    assert mixing.mix(empty(spark)).count() == 0
    nothing = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert {r["taken"] for r in rows_of(mixing.mix(nothing))} == {0}


def least_padding(lengths, buckets):
    values = sorted(set(lengths))
    best = None
    for cut in itertools.combinations(values[:-1], min(buckets, len(values)) - 1):
        edges = [*cut, values[-1]]
        padding = sum(next(e for e in edges if e >= x) - x for x in lengths)
        best = padding if best is None else min(best, padding)
    return best


def test_boundaries_are_optimal():
    rng = np.random.default_rng(3)
    for _ in range(40):
        lengths = rng.integers(0, 60, rng.integers(1, 40))
        for buckets in (1, 2, 3, 4):
            values, counts = np.unique(lengths, return_counts=True)
            edges = packing.choose_boundaries(values, counts, buckets)
            assert len(edges) == min(buckets, len(values)) and edges == sorted(edges)
            assert sum(next(e for e in edges if e >= x) - x for x in lengths) == least_padding(lengths.tolist(), buckets)


def test_packing(spark):
    rows = awkward_rows()
    got = rows_of(packing.pack(awkward(spark), buckets=5, budget=300))
    assert Counter((r["doc_id"], r["length"]) for r in got) == Counter((r[0], len(words(r[1]))) for r in rows)
    batches = defaultdict(list)
    for r in got:
        assert r["length"] <= r["padded_to"]
        batches[r["bucket"], r["batch"]].append(r)
    last = {}
    for (bucket, batch), held in batches.items():
        last[bucket] = max(batch, last.get(bucket, 0))
        assert len(held) * held[0]["padded_to"] <= 300 or len(held) == 1
    for bucket, batch in last.items():
        assert {b for k, b in batches if k == bucket} == set(range(batch + 1))
        assert all(len(batches[bucket, b]) == batches[bucket, b][0]["batch_rows"] for b in range(batch))
    assert packing.pack(empty(spark)).count() == 0


def test_cells_keep_the_first_digits(spark):
    lengths = [0, 1, 1023, 1024, 1025, 1026, 40_001, 123_456_789]
    got = spark.createDataFrame([(x,) for x in lengths], "length long").select(packing.cell(F.col("length")).alias("c")).collect()
    want = [x - x % (1 << max(0, x.bit_length() - 10)) for x in lengths]
    assert [r["c"] for r in got] == want


def test_sharding(spark):
    rows = awkward_rows()
    got = rows_of(sharding.shard_documents(awkward(spark), 7))
    sizes = [len((r[1] or "").encode()) + 16 for r in rows]
    want = Counter((r[0], size, zlib.crc32((r[1] or "").encode())) for r, size in zip(rows, sizes))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots, texts = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        if r["text_crc32"]:
            texts[r["text_crc32"]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in texts.values())
    assert sharding.shard_documents(empty(spark), 7).count() == 0


def test_differencing_balances_and_chunks_agree(spark):
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 5000, 600)
    went, sums = sharding.difference(np.column_stack([sizes, *[np.zeros(600, dtype=np.int64)] * 4]))
    check = np.zeros(5, dtype=np.int64)
    np.add.at(check, went[:, 0], sizes)
    assert (check == sums).all() and sums.max() - sums.min() <= 5
    assert all(sorted(row) == list(range(5)) for row in went.tolist())
    frame = spark.createDataFrame([(f"k{i}", int(s)) for i, s in enumerate(sizes)], "key string, bytes long")
    placed = rows_of(sharding.balance_groups(frame, 5, chunk=20, fan_in=3))
    assert len(placed) == 600 and len({r["key"] for r in placed}) == 600
    total = Counter()
    for r in placed:
        total[r["shard"]] += int(sizes[int(r["key"][1:])])
    assert max(total.values()) - min(total.values()) < 5000


@pytest.mark.parametrize("fine", [1000, 100])
def test_all_groups_offset_a_large_one(spark, monkeypatch, fine):
    """One group of 24 % of a shard's share, in one of ten chunks; made into units or not."""
    monkeypatch.setattr(sharding, "FINE", fine, raising=False)
    sizes = np.random.default_rng(1).integers(50, 150, 4001).tolist()
    sizes[7] = sum(sizes) * 3 // 100
    frame = spark.createDataFrame([(f"k{i}", s) for i, s in enumerate(sizes)], "key string, bytes long")
    total = Counter()
    placed = rows_of(sharding.balance_groups(frame, 8, chunk=400))
    assert len(placed) == len({r["key"] for r in placed}) == 4001
    for r in placed:
        total[r["shard"]] += sizes[int(r["key"][1:])]
    assert max(total.values()) < 1.002 * sum(sizes) / 8


def test_units_are_bundled_more_than_once(spark, monkeypatch):
    monkeypatch.setattr(sharding, "FINE", 8, raising=False)
    sizes = [1 + i % 7 for i in range(3000)] + [0] * 50 + [400]
    frame = spark.createDataFrame([(f"k{i}", s) for i, s in enumerate(sizes)], "key string, bytes long")
    placed = rows_of(sharding.balance_groups(frame, 4, chunk=5, fan_in=3))
    assert len(placed) == len({r["key"] for r in placed}) == len(sizes)
    total = Counter()
    for r in placed:
        total[r["shard"]] += sizes[int(r["key"][1:])]
    assert max(total.values()) < 1.05 * sum(sizes) / 4


def test_numbers_have_no_gaps(spark):
    frame = spark.range(500).select(F.when(F.col("id") < 400, 1).otherwise(F.col("id") % 3).alias("k"), (F.col("id") % 90).alias("o"))
    by_key = defaultdict(list)
    for r in rows_of(numbered(frame, "k", ["o"], "place", bins=13)):
        by_key[r["k"]].append(r["place"])
    assert all(sorted(v) == list(range(len(v))) for v in by_key.values()) and sum(map(len, by_key.values())) == 500


def test_fingerprints_of_edits(spark):
    rows = awkward_rows()
    got = rows_of(fingerprints.edited_fingerprints(awkward(spark)))
    assert Counter((r["doc_id"], r["n_chars"]) for r in got) == Counter((r[0], len(r[1] or "")) for r in rows)
    clear = sorted({(r[0], r[1] or "") for r in rows if r[0] is not None}, reverse=True)
    alone = {i for i, n in Counter(i for i, _ in clear).items() if n == 1}
    expected = {}
    for (i, text), (j, other) in zip(clear, clear[1:]):
        if i in alone and j in alone:
            third = len(text) // 3
            expected[i] = hashlib.sha256((text[: len(text) - third] + other[:third]).encode()).hexdigest()
    assert len(expected) > 60
    seen = defaultdict(set)
    for r in got:
        if r["doc_id"] in expected:
            assert r["edited_sha256"] == expected[r["doc_id"]]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    by_text = defaultdict(set)
    texts = dict(clear)
    for r in got:
        if r["doc_id"] in alone:
            by_text[texts[r["doc_id"]]].add(r["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values())
    prints = [next(iter(v)) for t, v in by_text.items() if t.strip()]
    assert len(set(prints)) == len(prints)
    assert fingerprints.edited_fingerprints(empty(spark)).count() == 0


def test_one_document_is_next_to_itself(spark):
    one = spark.createDataFrame([(4, "ab. cd. ef")], "doc_id long, text string")
    [r] = rows_of(fingerprints.edited_fingerprints(one))
    assert r["edited_sha256"] == hashlib.sha256(b"ab. cd.ab.").hexdigest() and r["near_next"] == 1


def test_last_meets_first(spark):
    few = spark.createDataFrame([(i, f"text {i} " * 3) for i in range(40)], "doc_id long, text string").repartition(7)
    got = {r["doc_id"]: r["edited_sha256"] for r in rows_of(fingerprints.edited_fingerprints(few))}
    for i in range(40):
        text, other = f"text {i} " * 3, f"text {(i - 1) % 40} " * 3
        third = len(text) // 3
        assert got[i] == hashlib.sha256((text[: len(text) - third] + other[:third]).encode()).hexdigest()


def plain_vector(spark, *texts):
    frame = spark.createDataFrame([texts], ", ".join(f"t{i} string" for i in range(len(texts))))
    return frame.select(*[fingerprints.vector(F.col(f"t{i}")).alias(f"v{i}") for i in range(len(texts))])


def test_paragraphs_go_in_and_out(spark):
    frame = plain_vector(spark, "one a. two b. three c.", "three c.\none a.", "two b.", "three c.\ntwo b. one a.", None)
    r = frame.select(
        "v0",
        "v1",
        "v3",
        "v4",
        fingerprints.combine(F.col("v1"), F.col("v2")).alias("put"),
        fingerprints.combine(F.col("v0"), F.col("v2"), -1).alias("taken"),
        fingerprints.combine(F.col("v0"), F.col("v0"), -1).alias("none"),
        fingerprints.likeness(F.col("v0"), F.col("v3")).alias("same"),
    ).first()
    assert r["v0"] == r["v3"] == r["put"] and r["taken"] == r["v1"] and r["none"] == r["v4"] and r["same"] == 1


def test_lanes_are_sums_of_bits(spark):
    def lanes(words):
        return [w >> (20 * i) & (1 << 20) - 1 for w in words for i in range(3)]

    r = plain_vector(spark, "a b c. " * 40_000, "a b c. ").first()
    one, many = lanes(r["v1"][1:]), lanes(r["v0"][1:])
    assert (r["v1"][0], r["v0"][0]) == (1, 40_000) and len(one) == 120
    assert max(one) == 1 and sum(one) > 30 and many == [40_000 * x for x in one]
