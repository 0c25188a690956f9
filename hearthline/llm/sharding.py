"""Sharding by Karmarkar-Karp differencing.

Documents of equal text are one indivisible group.  The two partial partitions with
the largest spread are combined again and again, the large slots of one with the
small slots of the other, until one partition is left.  That is done in one task,
over at most some ``FINE`` units a shard whatever the input: a group of at least 1 in
``FINE`` of a shard's share is a unit by itself, and smaller groups are first made
into units of about that size.  They are dealt by hash to chunks of bounded size, and
each chunk is differenced into as many bundles as it has units of bytes; some small
groups stay single, to even out what bundles leave.  Bundles are far smaller than a
shard, so that all of the corpus can offset a large group; chunks that were flattened
over the shards could not.  A group of many copies is summed before it is shuffled.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import numbered, written

CHUNK = 8192  # groups differenced in one task
FAN_IN = 512  # bundles combined in one task, if chunks leave too many
FINE = 1000  # units a shard's share is made of
UNITS = 1 << 17  # units in all: many shards have fewer each
ROW_BYTES = 16  # what a row takes besides its text


def _combined(parts: list[tuple[np.ndarray, np.ndarray]], slots: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Combine partial partitions into one: the slot of each of ``count`` numbered
    pieces, and the sums of the slots in use.

    A partition is the sums of its slots, the largest first, and their pieces; slots
    that are not listed are empty.  Ties in spread are broken by position."""

    def spread(sums):
        return -int(sums[0] - (sums[-1] if len(sums) == slots else 0))

    heap = [(spread(sums), i) for i, (sums, _) in enumerate(parts)]
    heapq.heapify(heap)
    into = np.arange(2 * count)  # the piece that a piece became part of
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        (left, mine), (right, other) = parts[a], parts[b]
        parts[a] = parts[b] = None
        both = max(0, len(left) + len(right) - slots)
        i, j = len(left) - both, len(right) - both
        made = np.arange(count, count + both)
        count += both
        into[mine[i:]], into[other[j:][::-1]] = made, made
        sums = np.concatenate([left[:i], left[i:] + right[j:][::-1], right[:j]])
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        heapq.heappush(heap, (spread(sums), len(parts)))
        parts.append((sums, np.concatenate([mine[:i], made, other[:j]])[order]))
    while not np.array_equal(into, further := into[into]):
        into = further
    sums, pieces = parts[-1]
    slot = np.zeros(len(into), dtype=np.int64)
    slot[pieces] = np.arange(len(pieces))
    return slot[into], sums


def difference(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combine partial partitions (one per row, a sum per slot) into one.

    Returns where each slot of each row went, and the sums of the result.
    """
    count, slots = parts.shape
    orders = np.argsort(-parts, axis=1, kind="stable")
    slot, sums = _combined([(row[order], order + i * slots) for i, (row, order) in enumerate(zip(parts, orders))], slots, parts.size)
    return slot[: parts.size].reshape(count, slots), sums


def deal(sizes: np.ndarray, slots: int) -> np.ndarray:
    """The slot of each size, by differencing."""
    parts = [(sizes[i : i + 1], np.array([i])) for i in range(len(sizes))]
    return _combined(parts, slots, len(sizes))[0][: len(sizes)]


def _deal_plan(slots):
    """Differences the units of a group; ``slots`` may be a function of their bytes."""

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("unit")
        sizes = pdf["bytes"].to_numpy()
        at = deal(sizes, slots(int(sizes.sum())) if callable(slots) else slots)
        return pd.DataFrame({"unit": pdf["unit"], "chunk": pdf["chunk"], "bytes": sizes, "at": at})

    return plan


DEALT = "unit long, chunk long, bytes long, at long"


def balance_groups(groups: DataFrame, shards: int, chunk: int = CHUNK, fan_in: int = FAN_IN) -> DataFrame:
    """``groups`` (key string, bytes long; keys unique) -> key, shard int."""

    def summed(rows: DataFrame) -> DataFrame:
        # units whose names clash are one
        return written(rows.groupBy("unit").agg(F.sum("bytes").alias("bytes")), "shard-units")

    placed = written(groups.select("key", F.xxhash64("key").alias("unit"), "bytes"), "shard-groups")
    units = summed(placed)
    most = shards * max(8, min(FINE, UNITS // shards))
    bound = max(1, -(-(units.agg(F.sum("bytes")).first()[0] or 0) // most))
    small, size, level = F.col("bytes") < bound, chunk, 0
    # some stay as they are, to even out what is left between bundles of one size
    single = F.pmod(F.xxhash64(F.lit("single"), "unit"), F.lit(max(1, units.where(small).count()))) < most // 4
    while (count := units.where(small & ~single).count()) > 2 * most:
        chunks, level = -(-count // size), level + 1
        dealt = (
            units.where(small & ~single)
            .withColumn("chunk", F.pmod(F.xxhash64("unit"), F.lit(chunks)))
            .groupBy("chunk")
            .applyInPandas(_deal_plan(lambda total: max(1, total // bound)), DEALT)
        )
        dealt = written(dealt.withColumn("bundle", F.xxhash64(F.lit(level), "chunk", "at")), "shard-bundles")
        placed = placed.join(dealt.select("unit", "bundle"), "unit", "left").select(
            "key", F.coalesce("bundle", "unit").alias("unit")
        )
        bundles = dealt.select(F.col("bundle").alias("unit"), "bytes")
        units = summed(units.where(~small | single).union(bundles))
        size = max(3, fan_in)
    dealt = units.withColumn("chunk", F.lit(0).cast("long")).groupBy("chunk").applyInPandas(_deal_plan(shards), DEALT)
    dealt = written(dealt.select("unit", "at"), "shard-dealt")
    return placed.join(dealt, "unit").select("key", F.col("at").cast("int").alias("shard"))


def shard_documents(docs: DataFrame, shards: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with its ``shard`` (0 to ``shards`` - 1) and ``slot`` (0, 1, ...
    without gaps inside the shard), its size in bytes and the CRC-32 of its text.

    Equal texts share a shard.  A null text has no bytes (CRC-32 0) and is a group
    of its own with the rows of its id; an empty text is a text like any other.
    Repeated rows are kept, each with its own slot.  Other columns are not looked
    at and not returned; join them back by id.  An empty table gives no rows.
    """
    rows = docs.select(
        F.col(id).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.coalesce(F.crc32(F.encode(F.col(text), "UTF-8")), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.sha2(F.col(text), 256), F.concat(F.lit("null "), F.coalesce(F.col(id).cast("string"), F.lit("")))).alias("key"),
    )
    rows = written(rows, "shard-rows")
    groups = rows.groupBy("key").agg(F.sum("size").alias("bytes"))
    placed = rows.join(balance_groups(groups, shards), "key")
    return numbered(written(placed, "shard-of-rows"), "shard", ["key", "doc_id"], "slot").select(
        "doc_id", "size", "text_crc32", "shard", "slot"
    )
