"""The vector index: exact, and what it skips."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthline.operators import vectors

SCHEMA = "id bigint, vector array<float>"


def clusters(n, kinds, width=16, seed=1, spread=0.15):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(kinds, width))
    middle /= np.linalg.norm(middle, axis=1, keepdims=True)
    return (middle[np.arange(n) % kinds] + spread * rng.normal(size=(n, width)) / np.sqrt(width)).astype(np.float32)


def frame(spark, found, first=0):
    return spark.createDataFrame([(first + i, row.tolist()) for i, row in enumerate(found)], SCHEMA).repartition(4)


def plain(found, asked, k):
    def unit(v):
        v = v.astype(np.float64)
        norms = np.linalg.norm(v, axis=1, keepdims=True)
        return v / np.where(norms == 0, 1, norms)

    scores = np.round(unit(asked) @ unit(found).T, 12)
    return {(q, r + 1, int(i)) for q, row in enumerate(scores) for r, i in enumerate(np.lexsort((np.arange(len(row)), -row))[:k])}


def listed(df):
    return {(r.query_id, r["rank"], r.id) for r in df.collect()}


@pytest.mark.parametrize("pivots", [1, 5, 40])
def test_exact(spark, pivots):
    found = clusters(300, 6)
    found[7] = found[13] = 0  # no direction
    found[20:120] = found[20]  # a third is one vector
    asked = np.concatenate([clusters(20, 6, seed=2), found[[7, 20, 250]], -found[[3]]])
    got = vectors.cosine_topk(frame(spark, found), frame(spark, asked), 4, 16, pivots)
    assert listed(got) == plain(found, asked, 4)


def test_fewer_than_k_and_none(spark):
    found, asked = clusters(3, 3), clusters(2, 2, seed=5)
    assert listed(vectors.cosine_topk(frame(spark, found), frame(spark, asked), 5)) == plain(found, asked, 5)
    none = spark.createDataFrame([], SCHEMA)
    assert vectors.cosine_topk(none, frame(spark, asked), 5).count() == 0
    assert vectors.cosine_topk(frame(spark, found), none, 5).count() == 0


def blocks_met(spark, n):
    """Blocks beside which blocks of queries are put after the first step, and blocks in all."""
    found, asked = clusters(n, n // 40), clusters(30, n // 40, seed=1)
    corpus, queries = frame(spark, found), frame(spark, asked)
    centers = vectors.choose_pivots(corpus, 256)
    index = vectors.build_index(corpus, centers, 16)
    reached = queries.select("id", F.lit(0.9).alias("reached"))
    met = vectors.candidate_pairs(index, centers, queries, reached, 16).count()
    assert listed(vectors.search_index(index, centers, queries, 3, 16)) == plain(found, asked, 3)
    return met, index.count() * vectors.build_index(queries, centers, 16).count()


def test_most_blocks_are_skipped(spark):
    met, every = blocks_met(spark, 800)
    met_4, every_4 = blocks_met(spark, 3200)
    assert met < every / 10 and met_4 < every_4 / 10
    assert met_4 < 3 * max(met, 10)  # four times the vectors, in more clusters
