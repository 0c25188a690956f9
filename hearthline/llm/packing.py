"""Packing into length buckets whose boundaries minimise padding.

The histogram of lengths covers every document.  Dynamic programming over it
chooses the ``buckets`` boundaries with the least total padding; documents of a
bucket are padded to its boundary and put together in batches of at most
``budget`` tokens.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import numbered, word_count, written

BUCKETS = 16
BUDGET = 16_384
EXACT_BITS = 10  # lengths below 2^10 are told apart exactly, longer ones to 1 in 2^9


def cell(length: Column) -> Column:
    """The histogram cell of a length: its first ``EXACT_BITS`` binary digits.

    At most 512 cells for each doubling, so the histogram has a few thousand rows
    for lengths up to millions and at most 28,000 for any length whatever.
    """
    shift = F.greatest(F.lit(0), F.length(F.bin(length)) - EXACT_BITS)
    return length - F.pmod(length, F.pow(F.lit(2.0), shift).cast("long"))


def choose_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """The boundaries (largest lengths) of at most ``buckets`` buckets with the
    least padding; ``lengths`` ascend.  Ties take the earlier cut.

    The padding of a run of cells obeys the quadrangle inequality, so the best cut
    never moves back, and each layer is solved by halving.
    """
    n = len(lengths)
    if n == 0:
        return []
    many = np.concatenate([[0], np.cumsum(counts, dtype=np.float64)])
    mass = np.concatenate([[0], np.cumsum(counts * lengths, dtype=np.float64)])

    def cost(start, end):  # cells start to end - 1 padded to the last of them
        return lengths[end - 1] * (many[end] - many[start]) - (mass[end] - mass[start])

    ends = np.arange(1, n + 1)
    best = np.concatenate([[0.0], cost(0, ends)])
    cuts = [np.zeros(n + 1, dtype=np.int64)]
    for used in range(2, min(buckets, n) + 1):
        layer, cut = np.full(n + 1, np.inf), np.zeros(n + 1, dtype=np.int64)
        todo = [(used, n, used - 1, n - 1)]
        while todo:
            low, high, first, last = todo.pop()
            if low > high:
                continue
            end = (low + high) // 2
            starts = np.arange(first, min(last, end - 1) + 1)
            totals = best[starts] + cost(starts, end)
            at = int(np.argmin(totals))
            layer[end], cut[end] = totals[at], starts[at]
            todo += [(low, end - 1, first, int(starts[at])), (end + 1, high, int(starts[at]), last)]
        best = layer
        cuts.append(cut)
    edges, end = [], n
    for cut in reversed(cuts):
        edges.append(int(lengths[end - 1]))
        end = int(cut[end])
    return edges[::-1]


def length_boundaries(rows: DataFrame, buckets: int) -> list[int]:
    """Boundaries for the column ``length`` of all rows.  The driver gets one row
    per histogram cell, a number that lengths bound and rows do not."""
    cells = rows.groupBy(cell(F.col("length")).alias("cell")).agg(
        F.max("length").alias("longest"), F.count(F.lit(1)).alias("n")
    )
    found = sorted((int(r["longest"]), int(r["n"])) for r in cells.collect())
    return choose_boundaries(np.array([x for x, _ in found], dtype=np.int64), np.array([n for _, n in found], dtype=np.int64), buckets)


def pack(docs: DataFrame, length: Column | None = None, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """doc_id, length, bucket, padded_to, batch, batch_rows.

    ``length`` is a column expression, the words of ``text`` unless given; null
    counts as 0.  A batch holds ``budget // padded_to`` documents of one bucket, at
    least one: a document longer than the budget is kept whole, in a batch of its
    own.  Only the last batch of a bucket may have fewer.  Empty and null texts
    have length 0 and take the shortest bucket; repeated rows are packed as often
    as they are there; an empty table gives no rows.  A bucket's documents are
    numbered in an order set by a hash of their id, over many tasks.
    """
    length = word_count(F.col("text")) if length is None else F.coalesce(length, F.lit(0)).cast("long")
    rows = written(docs.select("doc_id", length.alias("length")), "pack-rows")
    edges = length_boundaries(rows, buckets)
    bucket, edge = F.lit(len(edges) - 1), F.lit(edges[-1] if edges else 0)
    for i in range(len(edges) - 2, -1, -1):
        bucket = F.when(F.col("length") <= edges[i], i).otherwise(bucket)
        edge = F.when(F.col("length") <= edges[i], edges[i]).otherwise(edge)
    rows = rows.withColumn("bucket", bucket.cast("int")).withColumn("padded_to", edge.cast("long"))
    placed = numbered(rows, "bucket", ["doc_id", "length"], "place")
    each = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.col("padded_to"), F.lit(1)))).cast("long")
    return placed.select(
        "doc_id", "length", "bucket", "padded_to", F.floor(F.col("place") / each).cast("long").alias("batch"), each.alias("batch_rows")
    )
