"""The pipeline's stages, each against plain Python on its own input."""

import os
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from helpers import awkward, awkward_rows, empty, words
from test_native import fill
from test_near import plain_classes
from test_repeats import plain_removed, told_apart
from test_texts import plain_limits, plain_measure
from hearthline.llm import quality

SF_DIR = "/root/testdata/sf0.001"
ORDER = ["quality rules", "MinHash near-dedup", "substring dedup", "mixing sources", "packing"]


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ORDER


def test_stages(spark, folder):
    docs = awkward(spark)
    columns = docs.columns
    before = rows_of(docs)
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SF_DIR)
        path = f"{folder}/{name}"
        made.write.parquet(path)
        docs = spark.read.parquet(path)
        after = rows_of(docs)
        if name != "packing":
            assert docs.columns == columns
        CHECKS[name](spark, before, after)
        before = after


def check_quality(spark, before, after):
    found = quality.quality(awkward(spark)).collect()
    assert Counter(r[0] for r in after) == Counter(r["doc_id"] for r in found if r["kept"])
    assert not Counter(map(str, after)) - Counter(map(str, before))
    rows = [r.asDict() for r in found]
    limits = plain_limits(rows, quality.PRIOR)
    for r in rows:
        failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        good = not failed
        for name, has_low in quality.MEASURES.items():
            value, key = plain_measure(name, r), (r["lang"], r["source"])
            good = good and value <= limits[key, f"high_{name}"] and (not has_low or value >= limits[key, f"low_{name}"])
        assert r["kept"] == good


def check_near(spark, before, after):
    classes = plain_classes([(r[0], r[1]) for r in before])
    heads = defaultdict(int)
    for (_, head, _), _ in classes.items():
        heads[head] += 1
    assert {r[0] for r in after} == set(heads)
    assert not Counter(map(str, after)) - Counter(map(str, before))


def check_substrings(spark, before, after):
    gone = plain_removed(told_apart(before, spark), words, 20)
    want = Counter()
    for r in before:
        mask = gone[r[0], r[1] or ""]
        text = " ".join(w for w, g in zip(words(r[1]), mask) if not g) if mask.any() else r[1]
        want[(r[0], text, r[2], r[3], len(text) if mask.any() else r[4], *r[5:])] += 1
    assert Counter(after) == want


def check_mix(spark, before, after):
    sizes = Counter()
    for r in before:
        sizes[r[3]] += len(words(r[1]))
    order = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    want = fill(dict(sizes), {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 3)
    taken, by_id = Counter(), Counter()
    for r in after:
        taken[r[3]] += len(words(r[1]))
        by_id[r[0]] += len(words(r[1]))
    for source, target in want.items():
        assert abs(taken[source] - target) <= 1
    whole = defaultdict(list)
    for r in before:
        whole[r[0]].append(words(r[1]))
    for r in after:
        assert any(own[: len(words(r[1]))] == words(r[1]) for own in whole[r[0]])
    for i, count in by_id.items():
        assert count <= 3 * sum(map(len, whole[i]))


def check_packing(spark, before, after):
    assert Counter((r[0], r[1]) for r in after) == Counter((r[0], len(words(r[1]))) for r in before)


CHECKS = dict(zip(ORDER, (check_quality, check_near, check_substrings, check_mix, check_packing)))


def test_empty(spark):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty(spark), SF_DIR).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_run(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert rows and np.all([r["length"] <= r["padded_to"] for r in rows])
