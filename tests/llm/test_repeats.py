"""Both substring operators against plain Python."""

import hashlib
import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import SCHEMA, awkward, awkward_rows, empty, words
from hearthline.llm import lempel_ziv, repeats, suffix_buckets
from hearthline.llm.common import FREE_KEY, written


def told_apart(rows, spark):
    """Distinct (id, text) in the order the operators define."""
    frame = spark.createDataFrame(sorted({(r[0], r[1] or "") for r in rows}, key=str), "i long, t string")
    return [(r["i"], r["t"]) for r in frame.orderBy(F.col("i").asc_nulls_last(), F.xxhash64("t")).collect()]


def plain_removed(ordered, units, width):
    """For each (id, text) which units go, by a set of all windows seen."""
    seen, out = set(), {}
    for key in ordered:
        parts = units(key[1])
        gone = np.zeros(len(parts), dtype=bool)
        for i in range(len(parts) - width + 1):
            window = bytes(parts[i : i + width]) if isinstance(parts, bytes) else tuple(parts[i : i + width])
            if window in seen:
                gone[i : i + width] = True
            seen.add(window)
        out[key] = gone
    return out


def tricky(seed):
    """Texts that repeat in overlaps, at edges, in runs, and with one unit changed."""
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(50)]
    made = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(15, 120))) for _ in range(12)]
    made += [made[0] + " " + made[1], made[1][40:] + made[0][:300], made[2][:200] + "X" + made[2][201:]]
    made += ["z " * 90, "z " * 45 + "y " + "z " * 60, "ab" * 130, "a" * 99, "a" * 100, "a" * 101, "é" * 50, "é" * 51]
    words = made[3].split()
    made += [" ".join(words[:k]) for k in (19, 20, 21, 40)] + ["\n".join(words), "  " + "\t".join(words) + " "]
    for k in range(8):
        copy = made[4].split()
        copy[rng.randrange(len(copy))] = "changed"
        made.append(" ".join(copy[rng.randrange(5) :]))
    rng.shuffle(made)
    rows = [(i * 3, text) for i, text in enumerate(made)]
    return [(*r, "en", "a", 0, "x", 1, "y", 2) for r in rows]


CASES = [awkward_rows(many=40), tricky(1), tricky(2), tricky(3)]


@pytest.fixture(autouse=True, params=["small", "large"])
def sizes(request, monkeypatch):
    """Pieces and packs that cut everywhere, and those used in earnest."""
    if request.param == "small":
        monkeypatch.setattr(repeats, "PIECE", 256)
        monkeypatch.setattr(repeats, "ENTRIES", 64)


@pytest.mark.parametrize("case", range(len(CASES)))
def test_bytes(spark, case):
    rows = CASES[case]
    gone = plain_removed(told_apart(rows, spark), str.encode, 100)
    want = Counter()
    for i, text, *_ in rows:
        data, mask = (text or "").encode(), gone[i, text or ""]
        kept = bytes(b for b, g in zip(data, mask) if not g)
        spans = int((np.diff(np.r_[False, mask].astype(int)) == 1).sum())
        want[i, len(data), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = suffix_buckets.digest(suffix_buckets.remove_repeats(docs)).collect()
    assert Counter(tuple(r) for r in got) == want


@pytest.mark.parametrize("case", range(len(CASES)))
def test_words(spark, case):
    rows = CASES[case]
    gone = plain_removed(told_apart(rows, spark), words, 20)
    want = Counter()
    for i, text, *_ in rows:
        found, mask = words(text), gone[i, text or ""]
        kept = " ".join(w for w, g in zip(found, mask) if not g)
        want[i, len(found), int(mask.sum()), hashlib.sha256(kept.encode()).hexdigest()] += 1
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    made = lempel_ziv.remove_repeats(docs).cache()
    assert Counter(tuple(r) for r in lempel_ziv.digest(made).collect()) == want
    # every factor stands where it says, earlier
    texts = {}
    for i, text, *_ in rows:
        texts.setdefault(i, []).append(words(text))
    for r in made.where("doc_id IS NOT NULL").collect():
        if len(texts[r["doc_id"]]) > 1:
            continue
        [own] = texts[r["doc_id"]]
        for f in r["factors"]:
            part = own[f["start"] : f["start"] + f["length"]]
            assert len(part) == f["length"] >= 20
            assert (f["ref_id"], f["ref_start"]) < (r["doc_id"], f["start"])
            assert any(t[f["ref_start"] : f["ref_start"] + f["length"]] == part for t in texts[f["ref_id"]])


def test_empty(spark):
    assert suffix_buckets.remove_repeats(empty(spark)).count() == 0
    assert lempel_ziv.remove_repeats(empty(spark)).count() == 0


def test_copies_in_any_order(spark):
    rng = random.Random(9)
    rows = [(*r[:2], "en", "a", 0, "x", 1, "y", 2) for r in awkward_rows(7, 30)]
    copies = [(900 - i, rows[i][1], *rows[0][2:]) for i in range(0, 30, 2)] + [(-i, rows[i][1], *rows[0][2:]) for i in range(1, 30, 5)]
    rows += copies
    rng.shuffle(rows)
    gone = plain_removed(told_apart(rows, spark), words, 20)
    got = lempel_ziv.remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect()
    assert Counter((r["doc_id"], r["n_removed"]) for r in got) == Counter((r[0], int(gone[r[0], r[1] or ""].sum())) for r in rows)


@pytest.mark.parametrize("partitions", [1, 4])
def test_repeated_rows_with_a_shared_passage(spark, partitions):
    """Rows that repeat id and text, part of which another text has too."""
    passage = " ".join(f"p{i}" for i in range(30))

    def around(name):
        return " ".join(f"{name}{i}" for i in range(70)) + " " + passage + " " + " ".join(f"{name}{i}" for i in range(90, 160))

    first = [(5, around("a"))] * 3 + [(2, around("b")), (9, around("c"))]
    rows = [(*r, "en", "a", 0, "x", 1, "y", 2) for r in first]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    ordered = told_apart(rows, spark)
    gone = plain_removed(ordered, words, 20)
    got = lempel_ziv.remove_repeats(docs).collect()
    assert Counter((r["doc_id"], r["n_removed"]) for r in got) == Counter((i, int(gone[i, t].sum())) for i, t in first)
    gone = plain_removed(ordered, str.encode, 100)
    got = suffix_buckets.digest(suffix_buckets.remove_repeats(docs)).collect()
    assert Counter((r["doc_id"], r["n_removed"]) for r in got) == Counter((i, int(gone[i, t].sum())) for i, t in first)


def test_first_document_repeated(spark):
    """The rows that hold a passage first keep it, however often they are there."""
    passage = " ".join(f"p{i}" for i in range(30))
    first = [(1, "u v w " + passage + " x y z")] * 2 + [(2, "k l m " + passage + " n o")]
    docs = spark.createDataFrame([(*r, "en", "a", 0, "x", 1, "y", 2) for r in first], SCHEMA).repartition(1)
    assert Counter((r["doc_id"], r["n_removed"]) for r in lempel_ziv.remove_repeats(docs).collect()) == {(1, 0): 2, (2, 30): 1}


def open_runs(monkeypatch, spark, texts):
    """How many runs of ``texts`` op3 looks at window by window, bytes it removes, and at
    most how many places there are where a run is cut."""
    tables = {}
    monkeypatch.setattr(repeats, "written", lambda df, name, **more: tables.setdefault(name, written(df, name, **more)))
    rows = [(i, text, "en", "a", 0, "x", 1, "y", 2) for i, text in enumerate(texts)]
    got = suffix_buckets.digest(suffix_buckets.remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(3))).collect()
    gone = plain_removed(told_apart(rows, spark), str.encode, 100)
    assert Counter((r["doc_id"], r["n_removed"]) for r in got) == Counter((i, int(m.sum())) for (i, _), m in gone.items())
    return tables["repeat-runs"].agg(F.coalesce(F.sum("open"), F.lit(0))).first()[0], sum(int(m.sum()) for m in gone.values()), sum(map(len, texts)) // repeats.PIECE


def letters(rng, n):
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))


def test_phrases_shared_by_chance_open_no_runs(monkeypatch, spark):
    """Phrases of 45 bytes recur in all texts, but never the same two in a row."""
    rng = random.Random(4)
    phrases = [letters(rng, 45) for _ in range(40)]
    pairs = [(a, b) for a in range(40) for b in range(40) if a != b]
    rng.shuffle(pairs)
    texts = ["".join(phrases[a] + phrases[b] + letters(rng, 60) for a, b in pairs[k : k + 10]) for k in range(0, 200, 10)]
    found, gone, cuts = open_runs(monkeypatch, spark, texts)
    assert gone == 0 and found <= 2 * cuts


def test_passages_open_only_runs_at_their_edges(monkeypatch, spark):
    """A run that all texts have alike has no window to look at, nor has the first of them."""
    rng = random.Random(5)
    passage = letters(rng, 4000)
    texts = [letters(rng, 500) + passage + letters(rng, 500) for _ in range(4)]
    found, gone, cuts = open_runs(monkeypatch, spark, texts)
    assert gone >= 3 * 4000 and found <= 8 * len(texts) + 4 * cuts


def test_shuffles_of_a_written_table_go(spark, sizes):
    """Not when the driver happens to collect its garbage."""

    def shuffled():
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size())}

    def left_by(free):
        before = shuffled()
        frame = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
        assert written(frame, "free", free=free).count() == 7
        until = time.time() + 20
        while free and time.time() < until and any(x.startswith("shuffle") for x in shuffled() - before):
            time.sleep(0.1)
        return sum(x.startswith("shuffle") for x in shuffled() - before)

    setting = spark.conf.get(FREE_KEY)
    assert left_by(True) < left_by(False)
    assert spark.conf.get(FREE_KEY) == setting
