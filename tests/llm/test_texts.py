"""Quality counts, language and token counts against plain Python."""

import math
import re
import struct
from collections import Counter, defaultdict
from functools import reduce

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import awkward, awkward_rows, empty, words
from hearthline.llm import language, quality, tokens
from hearthline.llm.queries import QUERIES, TOKENIZERS

SF_DIR = "/root/testdata/sf0.001"


def plain_counts(text):
    text = text or ""
    found = words(text)
    windows = [tuple(found[i : i + 5]) for i in range(len(found) - 4)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if words(x)]
    return (
        len(found),
        sum(map(len, found)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
        len(lines),
        len(set(found)),
    )


TEXTS = [
    None,
    "",
    " \n\t\x0b\x0c\r ",
    "a b c d e a b c d e",
    "x x x x x x x x",
    "a b c d e f a b c d f",
    "one two three four five. " * 7 + "other",
    "l1 #*$\n\nl1 #*$\nl2\n \nl1 #*$ ",
    "nbsp stays one word \u0085",
    "é日本 😀😀 <b>|&%</b>",
    "a b c d e a b c d e f a b c d e a",
]


def test_counts(spark):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, text string")
    got = frame.select("i", quality.text_counts(F.col("text")).alias("c")).select("i", "c.*").collect()
    for r in got:
        assert tuple(r[c] for c in quality.COUNTS) == plain_counts(TEXTS[r["i"]]), TEXTS[r["i"]]


def plain_measure(name, c):
    n = max(c["n_words"], 1)
    return {
        "word_length": c["word_chars"] / n,
        "symbols": (c["n_symbols"] + 1) / (c["n_words"] + 50),
        "dup_lines": (c["n_dup_lines"] + 1) / (c["n_lines"] + 5),
        "sameness": 1 - math.log(max(c["n_distinct"], 1)) / math.log(n + 1),
    }[name]


def plain_limits(rows, prior):
    """Limits by sorting, in the cells that the sketch has."""

    def value(name, c):
        v, base = plain_measure(name, c), math.log(1 + quality.CELL)
        return 0.0 if v < quality.SMALLEST else (1 + quality.CELL) ** math.floor(math.log(v) / base)

    def at(values):
        values = sorted(values)
        return [values[math.ceil(len(values) * k / 4) - 1] for k in (1, 2, 3)]

    def blend(values, wider):
        n = len(values)
        return [(n * q + prior * w) / (n + prior) for q, w in zip(at(values), wider)]

    good = [r for r in rows if r["n_words"] >= 10 and 100 * r["n_repeat_words"] <= 20 * r["n_words"]]
    found = {}
    for name, has_low in quality.MEASURES.items():
        own, langs = defaultdict(list), defaultdict(list)
        for r in good:
            own[r["lang"], r["source"]].append(value(name, r))
            langs[r["lang"]].append(value(name, r))
        everything = [v for vs in langs.values() for v in vs]
        for key, values in own.items():
            l1, l2, l3 = wide = blend(langs[key[0]], at(everything))
            up, down = max(l2 - l1, 0.01 * l2), max(l3 - l2, 0.01 * l2)
            q1, q2, q3 = blend(values, wide)
            middle = min(max(q2, l2 - 6 * down), l2 + 6 * up)
            found[key, f"high_{name}"] = middle + 12 * min(max(q2 - q1, 0.01 * q2), 2 * up)
            if has_low:
                found[key, f"low_{name}"] = middle - 12 * min(max(q3 - q2, 0.01 * q2), 2 * down)
    return found


@pytest.mark.parametrize("prior", [0, 8, quality.PRIOR])
def test_limits(spark, prior):
    docs = awkward(spark)
    counted = docs.select("doc_id", "lang", "source", quality.text_counts(F.col("text")).alias("c")).select("doc_id", "lang", "source", "c.*").cache()
    rows = [r.asDict() for r in counted.collect()]
    want = plain_limits(rows, prior)
    got = quality.limits(quality.sketches(counted), prior).collect()
    assert {(r["lang"], r["source"]) for r in got} == {key for key, _ in want}
    for (key, column), limit in want.items():
        [r] = [r for r in got if (r["lang"], r["source"]) == key]
        assert r[column] == pytest.approx(limit)


def counted_documents(spark, groups):
    """Counts of documents: (source, how many, symbols a word), of 40 to 139 words."""
    parts = []
    for source, n, rate in groups:
        words = 40 + F.col("id") % 100
        parts.append(
            spark.range(n).select(
                F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.lit(source).alias("source"), words.alias("n_words"),
                (words * (4.5 + (F.col("id") % 11) / 10)).cast("long").alias("word_chars"),
                (words * rate).cast("long").alias("n_symbols"), F.lit(0).cast("long").alias("n_dup_lines"),
                F.lit(0).cast("long").alias("n_repeat_words"), (1 + F.col("id") % 7).alias("n_lines"),
                (words * (0.8 + (F.col("id") % 9) / 100)).cast("long").alias("n_distinct"),
            )
        )
    return reduce(lambda a, b: a.union(b), parts)


@pytest.mark.parametrize("others", [0, 1000])
@pytest.mark.parametrize("n", [40, 150, 250, 5000])
def test_junk_goes_whatever_the_size_of_its_source(spark, n, others):
    junk = n * 3 // 10
    counted = counted_documents(spark, [("a", n - junk, 0), ("a", junk, 0.6), ("b", others, 0)])
    kept = quality.judged(counted, quality.limits(quality.sketches(counted))).where("kept")
    assert kept.where("n_symbols > 0").count() == 0 and kept.count() == n - junk + others


def test_a_source_of_junk_does_not_lift_its_limits(spark):
    counted = counted_documents(spark, [("a", 100, 0), ("a", 900, 0.6), ("b", 1500, 0)])
    kept = quality.judged(counted, quality.limits(quality.sketches(counted))).where("kept")
    assert kept.where("n_symbols > 0").count() == 0 and kept.count() == 1600


def test_limits_come_from_the_sketch(spark):
    """On the test table, no least distance and no bound by the language is at work."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    counted = docs.select("lang", "source", quality.text_counts(F.col("text")).alias("c")).select("lang", "source", "c.*")
    sketch = quality.sketches(counted)
    own = quality.quartiles(sketch, ["lang", "source", "measure"]).collect()
    assert len(own) == 4 * 80
    assert sum(r["q2"] - r["q1"] > quality.LEAST * r["q2"] for r in own) / len(own) > 0.95


def test_verdicts(spark):
    docs = awkward(spark)
    rows = awkward_rows()
    got = [r.asDict() for r in quality.quality(docs).collect()]
    assert len(got) == len(rows)
    counts = Counter((r[0], *plain_counts(r[1])) for r in rows)
    assert Counter((r["doc_id"], *[r[c] for c in quality.COUNTS]) for r in got) == counts
    for r in got:
        failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in got if r["kept"]) == Counter(r["doc_id"] for r in kept.collect())
    assert quality.quality(empty(spark)).count() == 0 == quality.keep_good(empty(spark)).count()


def test_texts_are_not_shuffled(spark):
    plan = quality.keep_good(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Generate explode")]  # what happens to whole rows
    assert "BroadcastHashJoin" in above and "Exchange" not in above and "SortMergeJoin" not in plan


def test_noise_goes_and_clean_stays(spark):
    clean = [(i, f"word{i} is in a plain text of more than ten words, number {i * 7}", "en", "a") for i in range(60)]
    noisy = [(100 + i, " ".join(f"w{i}{k}%%% $$$" for k in range(12)), "en", "a") for i in range(6)]
    frame = spark.createDataFrame(clean + noisy, "doc_id long, text string, lang string, source string")
    assert {r["doc_id"] for r in quality.keep_good(frame).collect()} == set(range(60))


def test_languages_of_held_out_documents(spark):
    got = QUERIES["op6_language"](spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id"
    ).where("held_out AND lang IS NOT NULL")
    right, scores, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.avg("score"), F.count("*")).first()
    assert n > 250 and right > 0.97 and 0 < scores < 1


def test_languages_of_awkward_texts(spark):
    texts = {"en": "the cat sat on the mat and the dog ran off", "de": "der hund und die katze und das haus sind da"}
    frame = spark.createDataFrame(
        [(1, None, "x"), (2, "", "x"), (3, "12 34 !", "x"), (4, "the dog and the cat sat", "x"), (4, "the dog and the cat sat", "x"), (None, "das haus und der hund " * 3000, "x")],
        "doc_id long, text string, lang string",
    )
    got = sorted(((r["doc_id"] or 0, r["lang_pred"], r["rejected"]) for r in language.identify(frame, texts).collect()))
    assert got == [(0, "de", False), (1, "und", True), (2, "und", True), (3, "und", True), (4, "en", False), (4, "en", False)]
    assert {r["lang_pred"] for r in language.identify(frame, {}).collect()} == {"und"}
    assert {(r["lang_pred"], r["score"]) for r in language.identify(frame.where("doc_id = 4"), {"en": "the"}).collect()} == {("en", 1.0)}
    assert {r["rejected"] for r in language.identify(frame.where("doc_id = 4"), {"en": "abc", "de": "abc"}).collect()} == {True}
    assert language.identify(empty(spark), texts).count() == 0 and language.sample_texts(empty(spark)) == {}


def test_sample_is_bounded(spark):
    texts = language.sample_texts(awkward(spark), sample=3, piece=10)
    assert set(texts) == {"en", "de", "fr"} and all(len(t) <= 32 for t in texts.values())


def ranks():
    with open(f"{TOKENIZERS}/byte_bpe_multi_50k.tiktoken", "rb") as file:
        return file.read()


def test_token_counts(spark):
    coder = tokens.encoding(ranks(), tokens.PATTERN)
    want = Counter((r[0], len(coder.encode_ordinary(r[1] or ""))) for r in awkward_rows())
    for block_bytes in (64, 1 << 20):
        got = tokens.count_tokens(awkward(spark), ranks(), block_bytes=block_bytes)
        assert Counter((r["doc_id"], r["n_tokens"]) for r in got.collect()) == want
    assert tokens.count_tokens(empty(spark), ranks()).count() == 0


def plain_documents(ids, eod):
    lengths, run = [], 0
    for x in ids:
        if x == eod:
            lengths.append(run)
            run = 0
        else:
            run += 1
    return lengths + [run] * (run > 0)


def test_flat_files(spark, folder):
    rng = np.random.default_rng(2)
    streams = [rng.integers(0, 9, n).tolist() for n in (0, 1, 700, 1300)] + [[3] * 50, [0] * 70, [5] * 900 + [0] + [6] * 900]
    for width, kind in ((2, "H"), (4, "I")):
        for i, ids in enumerate(streams):
            with open(f"{folder}/f{width}_{i}.bin", "wb") as file:
                file.write(struct.pack(f"<{len(ids)}{kind}", *ids) + b"x" * (i % width))
        blocks = tokens.read_token_files(spark, f"{folder}/f{width}_*.bin", block_bytes=64)
        names = {r["file"]: int(re.search(r"_(\d+)\.bin", r["name"])[1]) for r in blocks.select("file", "name").distinct().collect()}
        for group in (1, 3, 1024):
            got = defaultdict(dict)
            for r in tokens.stitch(tokens.find_separators(blocks, 0, width), group).collect():
                assert r["document"] not in got[names[r["file"]]]
                got[names[r["file"]]][r["document"]] = r["n_tokens"]
            for i, ids in enumerate(streams):
                assert [got[i][k] for k in sorted(got[i])] == plain_documents(ids, 0) and sorted(got[i]) == list(range(len(got[i])))
