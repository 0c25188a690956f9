"""The prefix trie of conversations, by truncation peeling.

A node is a distinct sequence of first turns; conversations that start with it are
its members.  Nodes are found from the deepest up: at each depth the conversations
that end there join the nodes that survived from below, rows of one sequence merge,
and a node with all its sums is written and stripped of its last turn to stand for
its parent one depth up.  Each turn is looked at once, nothing is counted again.

A sequence is known by its depth and 128 bits: the exclusive or of its turns' hashes,
each taken with its place.  So turns travel as narrow rows, never as texts, and a
running ``bit_xor`` gives all prefixes of a conversation.

Equal conversations are merged first.  Subtrees of at most ``CROWD`` distinct
conversations are peeled inside tasks, thousands of them together, however deep they
are; only above them, where a prefix has more, is each depth a regrouping by Spark
with partial sums, so no prefix, however common, gathers its rows in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.llm.common import word_count, written

CROWD = 512  # distinct conversations of a subtree that is peeled inside a task
BUFFER = 1 << 18  # turns peeled together
GROUP, HEAD = 20, 4  # conversations that share a head, and turns of it, when rebuilt
ID_BITS = 16  # member ids of a piece of a node's list
NODE = "depth long, a long, b long, pa long, pb long, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, parent_conv_id long, top boolean"


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), h1, h2 and words of every turn; needs conv_id, turn, role, text.

    Turns are ordered by turn, nulls first, then by role and text; null roles and
    texts are empty; rows without a conv_id belong to no conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text")
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return turns.select(
        "conv_id",
        F.row_number().over(order).cast("long").alias("pos"),
        F.xxhash64("role", "text").alias("h1"),
        F.xxhash64(F.lit("turn"), "role", "text").alias("h2"),
        word_count(F.col("text")).alias("words"),
    )


def rebuilt_turns(turns: DataFrame) -> DataFrame:
    """Turns of ``numbered_turns`` with a shared head: conversation c is the first h
    turns of c - c % 20, all if fewer, none if absent, and its own after its first h,
    where h is crc32(c) % 4."""
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD
    convs = turns.select("conv_id").distinct().select("conv_id", head.alias("h")).where("h > 0")
    convs = convs.select("conv_id", "h", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"))
    first = turns.where(F.col("pos") < HEAD).withColumnRenamed("conv_id", "base")
    heads = convs.join(first, "base").where("pos <= h").select("conv_id", F.lit(0).alias("part"), "pos", "h1", "h2", "words")
    own = turns.where(F.col("pos") > head).select("conv_id", F.lit(1).alias("part"), "pos", "h1", "h2", "words")
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("part", "pos")).cast("long")
    return heads.union(own).select("conv_id", place.alias("pos"), "h1", "h2", "words")


def prefixes(turns: DataFrame) -> DataFrame:
    """One row per conversation and depth: the node (depth, a, b), its parent's
    (pa, pb), the words of its last turn, and whether the conversation ends there."""
    upward = Window.partitionBy("conv_id").orderBy("pos")
    rows = turns.withColumns({"ha": F.xxhash64("pos", "h1", "h2"), "hb": F.xxhash64("h2", "pos", "h1")})
    rows = rows.select(
        "conv_id",
        F.col("pos").alias("depth"),
        F.bit_xor("ha").over(upward).alias("a"),
        F.bit_xor("hb").over(upward).alias("b"),
        "ha",
        "hb",
        "words",
        F.lead("pos").over(upward).isNull().alias("ended"),
    )
    return rows.select(
        "conv_id", "depth", "a", "b", F.col("a").bitwiseXOR(F.col("ha")).alias("pa"), F.col("b").bitwiseXOR(F.col("hb")).alias("pb"), "words", "ended"
    )


def peel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of whole subtrees.  Rows come by (ga, gb), the subtree, then by conv_id and
    depth, without gaps; the buffer is peeled when it is full, between two subtrees."""
    names = ("ga", "gb", "conv_id", "depth", "a", "b", "pa", "pb", "words", "n")
    out = [f.strip().split(" ")[0] for f in NODE.split(",")]

    def peeled(c: dict[str, np.ndarray]) -> pa.RecordBatch:
        rows = len(c["depth"])
        first = np.r_[True, c["conv_id"][1:] != c["conv_id"][:-1]]
        ended = np.flatnonzero(np.r_[first[1:], True])
        ended = ended[np.argsort(-c["depth"][ended], kind="stable")]
        ends_at = -c["depth"][ended]  # ascending
        found = {k: [] for k in out}
        empty = np.zeros(0, np.int64)
        alive = {k: empty for k in ("row", "conv_id", "n_convs", "n_leaves", "saved", "at")}
        made, taken, depth = 0, 0, int(c["depth"].max()) if rows else 0
        parents = []  # (place of the child among all nodes, its parent's conv_id)
        while taken < len(ended) or len(alive["row"]):
            new = ended[taken : taken + int(np.searchsorted(ends_at[taken:], -depth, "right"))]
            taken += len(new)
            row = np.r_[new, alive["row"]]
            if not len(row):
                depth = int(-ends_at[taken])
                continue
            zero, gone = np.zeros(len(new), np.int64), len(new)
            conv, n = np.r_[c["conv_id"][new], alive["conv_id"]], np.r_[c["n"][new], alive["n_convs"]]
            leaves, saved = np.r_[zero, alive["n_leaves"]], np.r_[zero, alive["saved"]]
            child = np.r_[zero, np.ones(len(row) - gone, np.int64)]
            order = np.lexsort((conv, c["b"][row], c["a"][row]))
            row, a, b = row[order], c["a"][row[order]], c["b"][row[order]]
            starts = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            lead = row[starts]
            conv = conv[order][starts]  # the smallest member comes first
            n, children = np.add.reduceat(n[order], starts), np.add.reduceat(child[order], starts)
            leaves = np.maximum(np.add.reduceat(leaves[order], starts), children == 0)
            saved = np.add.reduceat(saved[order], starts) + (n - 1) * c["words"][lead]
            group = np.zeros(len(row), np.int64)
            group[starts[1:]] = 1
            group = np.cumsum(group)
            old = order >= gone
            parents.append((alive["at"][order[old] - gone], conv[group[old]]))
            at = made + np.arange(len(lead))
            made += len(lead)
            top = first[lead]
            level = (np.full(len(lead), depth), a[starts], b[starts], c["pa"][lead], c["pb"][lead], conv, n, children, leaves, saved)
            for k, values in zip(out, (*level, None, top), strict=True):
                found[k].append(values)
            up = ~top
            alive = {"row": lead[up] - 1, "conv_id": conv[up], "n_convs": n[up], "n_leaves": leaves[up], "saved": saved[up], "at": at[up]}
            depth -= 1
        columns = {k: np.concatenate(v) for k, v in found.items() if k != "parent_conv_id"}
        above, known = np.zeros(made, np.int64), np.zeros(made, bool)
        for places, conv in parents:
            above[places], known[places] = conv, True
        columns["parent_conv_id"] = pa.array(above, mask=~known)
        return pa.RecordBatch.from_arrays([pa.array(columns[k]) for k in out], names=out)

    held, size = [], 0
    for batch in batches:
        held.append({k: batch.column(k).to_numpy(zero_copy_only=False) for k in names})
        size += batch.num_rows
        if size >= BUFFER:
            c = {k: np.concatenate([h[k] for h in held]) for k in names}
            last = (c["ga"] != c["ga"][-1]) | (c["gb"] != c["gb"][-1])
            cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
            if cut:
                yield peeled({k: v[:cut] for k, v in c.items()})
            held, size = [{k: v[cut:] for k, v in c.items()}], size - cut
    if size:
        yield peeled({k: np.concatenate([h[k] for h in held]) for k in names})


def list_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces joined by commas; pieces come in order.  Only the
    state of one hash is held, however long the list."""
    node, state = None, None
    done: list = []

    def table():
        keys = list(zip(*[k for k, _ in done], strict=True)) if done else [(), (), ()]
        columns = [pa.array(k, pa.int64()) for k in keys] + [pa.array([h for _, h in done], pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=["depth", "a", "b", "ends_sha256"])

    for batch in batches:
        keys = zip(*[batch.column(k).to_pylist() for k in ("depth", "a", "b")], strict=True)
        for key, piece in zip(keys, batch.column("piece").to_pylist(), strict=True):
            if key == node:
                state.update(b"," + piece.encode())
                continue
            if node is not None:
                done.append((node, state.hexdigest()))
            node, state = key, hashlib.sha256(piece.encode())
        yield table()
        done.clear()
    if node is not None:
        done.append((node, state.hexdigest()))
        yield table()


def end_lists(ends: DataFrame) -> DataFrame:
    """depth, a, b, ends_sha256 of the nodes where conversations end.  Ids are joined in
    pieces of neighbouring ids first, so a node with a third of them is many small groups."""
    piece = F.array_join(F.sort_array(F.collect_list("conv_id")), ",")
    pieces = ends.groupBy("depth", "a", "b", F.shiftright("conv_id", ID_BITS).alias("part")).agg(piece.alias("piece"))
    pieces = pieces.repartition("depth", "a", "b").sortWithinPartitions("depth", "a", "b", "part")
    return pieces.select("depth", "a", "b", "piece").mapInArrow(list_hashes, "depth long, a long, b long, ends_sha256 string")


def _merged(parts: DataFrame) -> DataFrame:
    return parts.groupBy("a", "b").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    )


def _as_children(nodes: DataFrame) -> DataFrame:
    return nodes.select(
        F.col("pa").alias("a"), F.col("pb").alias("b"), "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens"
    )


def _finished(merged: DataFrame, depth: int, words: Column) -> DataFrame:
    return merged.select(
        F.lit(depth).cast("long").alias("depth"),
        "a",
        "b",
        "pa",
        "pb",
        "conv_id",
        "n_convs",
        "n_children",
        F.greatest("n_leaves", F.when(F.col("n_children") == 0, 1).otherwise(0)).cast("long").alias("n_leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * words).alias("saved_tokens"),
    )


def trie(turns: DataFrame, conv_ids: DataFrame, crowd: int = CROWD) -> DataFrame:
    """All nodes of the trie of ``turns`` (conv_id, pos, h1, h2, words).

    ``conv_ids`` are all conversations, also those without a turn, which end at the
    root.  Returns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256 of each node.  Equal conversations are
    members of the same nodes; no conversations give no nodes, not even a root.  A
    conversation's turns are sorted in one task, as rows of 60 bytes; a depth is a job
    of its own only where a prefix has more than ``crowd`` distinct conversations.
    """
    paths = written(prefixes(turns), "trie-paths")
    ends = paths.where("ended").select("depth", "a", "b", "conv_id")
    classes = ends.groupBy("depth", "a", "b").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n"))
    classes = written(classes, "trie-classes")
    rows = paths.join(classes.select("conv_id", "n"), "conv_id")
    rows = written(rows, "trie-rows")

    node = ["depth", "a", "b"]
    shared = rows.groupBy(*node).agg(F.count(F.lit(1)).alias("kinds"), *[F.max(c).alias(c) for c in ("pa", "pb", "words")])
    crowded = written(shared.where(F.col("kinds") > crowd).drop("kinds"), "trie-crowded")

    marked = rows.join(crowded.select(*node, F.lit(True).alias("crowded")), node, "left")
    place = F.min(F.when(F.col("crowded").isNull(), F.struct(*node))).over(Window.partitionBy("conv_id"))
    below = marked.withColumn("top", place).where("crowded is null")
    below = below.select(F.col("top.a").alias("ga"), F.col("top.b").alias("gb"), "conv_id", *node, "pa", "pb", "words", "n")
    below = below.repartition("ga", "gb").sortWithinPartitions("ga", "gb", "conv_id", "depth")
    below = written(below.mapInArrow(peel, NODE), "trie-below")

    top = below.where("top").drop("top", "parent_conv_id")
    stops = classes.join(crowded, node, "left_semi").select(
        *node, "conv_id", F.col("n").alias("n_convs"), *[F.lit(0).cast("long").alias(c) for c in ("n_children", "n_leaves", "saved_tokens")]
    )
    stops = written(stops, "trie-stops")
    deepest = crowded.agg(F.max("depth")).first()[0] or 0
    level, levels = None, []
    for depth in range(deepest, 0, -1):
        parts = stops.where(F.col("depth") == depth).drop("depth").unionByName(_as_children(top.where(F.col("depth") == depth + 1)))
        if level is not None:
            parts = parts.unionByName(_as_children(level))
        known = crowded.where(F.col("depth") == depth).drop("depth")
        level = written(_finished(_merged(parts).join(known, ["a", "b"]), depth, F.col("words")), "trie-level")
        levels.append(level)

    zero = F.lit(0).cast("long")
    turnless = conv_ids.join(ends.select("conv_id"), "conv_id", "left_anti").select("conv_id")
    at_root = turnless.select(
        zero.alias("a"), zero.alias("b"), "conv_id", F.lit(1).cast("long").alias("n_convs"), *[zero.alias(c) for c in ("n_children", "n_leaves", "saved_tokens")]
    )
    parts = at_root.unionByName(_as_children(top.where("depth = 1")))
    if level is not None:
        parts = parts.unionByName(_as_children(level))
    root = _merged(parts).withColumns({"pa": zero, "pb": zero})
    upper = _finished(root, 0, zero)
    for level in levels:
        upper = upper.unionByName(level)
    upper = written(upper, "trie-upper")

    above = upper.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    hanging = upper.unionByName(top).join(above, ["depth", "pa", "pb"], "left")
    nodes = hanging.unionByName(below.where("not top").drop("top"))
    every_end = ends.unionByName(turnless.select(*[zero.alias(c) for c in node], "conv_id"))
    nodes = nodes.join(end_lists(every_end), node, "left")
    return nodes.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame, crowd: int = CROWD) -> DataFrame:
    """The trie of conversations as they are; needs conv_id, turn, role, text.

    Turns are ordered by turn (null first), then role and text; null roles and texts are
    empty, and so are very long ones no trouble: only their hashes travel.  Rows without
    conv_id are left out; repeated rows are turns of their own; columns of other names
    are not looked at; an empty table gives no rows."""
    turns = written(numbered_turns(conversations), "trie-turns")
    return trie(turns, turns.select("conv_id").distinct(), crowd)


def rebuilt_trie(conversations: DataFrame, crowd: int = CROWD) -> DataFrame:
    """As ``prefix_trie``, after every conversation got the head of its group
    (``rebuilt_turns``); conversations that lose all turns stay, as members of the root."""
    turns = written(numbered_turns(conversations), "trie-turns")
    return trie(rebuilt_turns(turns), turns.select("conv_id").distinct(), crowd)
