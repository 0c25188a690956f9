"""Near-duplicate documents by DartMinHash signatures and banded joining.

A document is the set of its five-word shingles, each with a weight (1 unless
counts are asked for).  Every element owns a strip of the plane weight x rank, on
which hashed darts fall at an even rate, the same for every document that has the
element.  A dart below the element's weight counts; it also names a coordinate of
the signature, which keeps its dart of least rank.  Ranks are gone through in
doubling slabs until all coordinates are filled, so the work follows the weight
and the signature, not their product.

Signatures are cut into bands.  Documents that agree in a band are candidates;
links are then decided on the exact Jaccard similarity of the shingle sets:

1. in each band's bucket every document meets the least one; the pair with the
   most bands per document is checked first, the other pairs if it is not
   already linked through others;
2. in buckets that still hold several components, every document outside the
   largest one is checked with all documents of other components, in blocks.

So every two candidates end up compared or in one class, however large the bucket,
and pairs are written for the first kind only, at most one per document and band.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.llm.common import let, written
from hearthline.llm.rolling import CHUNK, join_hashes, mix, span_hashes, text_buffer, whole_windows, window_hashes, words_of

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 36, 7  # two texts of similarity 0.8 meet with a chance of 0.9998
BLOCK, TARGETS = 64, 4096  # documents checked together with documents
FIRST_SLAB = 1 / 32  # rank at which the first slab ends
U64 = np.uint64


def _poisson_table(mean: float) -> np.ndarray:
    """Cumulative chances of 0, 1, 2, ... darts."""
    terms, k = [math.exp(-mean)], 0
    while terms[-1] > 1e-18 or k < mean:
        k += 1
        terms.append(terms[-1] * mean / k)
    return np.cumsum(terms)


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> U64(11)).astype(np.float64) * 2.0**-53


def _darts(elements, low, width, weight, owner, slab_low, slab_width, salt):
    """Darts in the cells of one slab: owner, rank (in the slab, as bits), identity.

    ``low`` and ``width`` are the strip's part of the weight axis.  Cells have an
    area of at most 1; their number of darts is Poisson, from a hash."""
    area = slab_width * width
    cells = np.maximum(1, np.ceil(area)).astype(np.int64)
    which = np.repeat(np.arange(len(elements)), cells)
    cell = np.arange(len(which)) - np.repeat(np.cumsum(cells) - cells, cells)
    seed = mix(elements[which] + mix((cell.astype(np.uint64) << U64(16)) + U64(salt)))
    chance, count = _unit(seed), np.zeros(len(which), dtype=np.int64)
    for mean in np.unique(area / cells):
        here = np.flatnonzero((area / cells)[which] == mean)
        count[here] = np.searchsorted(_poisson_table(mean), chance[here], side="right")
    hit = np.repeat(np.arange(len(which)), count)
    number = np.arange(len(hit)) - np.repeat(np.cumsum(count) - count, count)
    dart = mix(seed[hit] + (number.astype(np.uint64) + U64(1)) * U64(0x9E3779B97F4A7C15))
    at = which[hit]
    below = low[at] + _unit(mix(dart ^ U64(0x5851F42D4C957F2D))) * width[at] <= weight[at]
    hit, dart, at = hit[below], dart[below], at[below]
    inside = (cell[hit] + _unit(mix(dart ^ U64(0x14057B7EF767814F)))) / cells[at]
    return owner[at], slab_low + inside * slab_width, dart


def dart_signatures(elements: np.ndarray, weights: np.ndarray, owners: np.ndarray, n: int, k: int, seed: int = 1) -> np.ndarray:
    """Signatures (``n`` x ``k``) of weighted sets: element, weight > 0 and owner (0 to
    n - 1) of each entry, owners ascending.  An owner without entries has zeros.

    Two sets agree in a coordinate with the chance of their weighted Jaccard
    similarity, sum of minima over sum of maxima.
    """
    best = np.full(n * k, np.inf)
    sign = np.zeros(n * k, dtype=np.uint64)
    # strips of the weight axis: 0 to 1, 1 to 2, 2 to 4, ...
    strips = np.maximum(0, np.ceil(np.log2(np.maximum(weights, 1.0)))).astype(np.int64) + 1
    entry = np.repeat(np.arange(len(elements)), strips)
    strip = np.arange(len(entry)) - np.repeat(np.cumsum(strips) - strips, strips)
    low = np.where(strip == 0, 0.0, 2.0 ** (strip - 1.0))
    width = np.where(strip == 0, 1.0, low)
    names = mix(elements[entry] ^ mix(strip.astype(np.uint64) + U64(seed) * U64(0x632BE59BD9B4E019)))
    weight, owner = weights[entry], owners[entry]
    active = np.bincount(owners, minlength=n) > 0
    slab_low, slab_high, slab = 0.0, FIRST_SLAB, 0
    while active.any():
        here = active[owner]
        who, rank, dart = _darts(names[here], low[here], width[here], weight[here], owner[here], slab_low, slab_high - slab_low, slab)
        place = who * k + (mix(dart ^ U64(0xA0761D6478BD642F)) % U64(k)).astype(np.int64)
        order = np.lexsort((dart, rank, place))
        place, rank, dart = place[order], rank[order], dart[order]
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if len(place) else np.zeros(0, dtype=np.int64)
        free = np.isinf(best[place[first]])  # a lower slab has lower ranks
        best[place[first][free]], sign[place[first][free]] = rank[first][free], dart[first][free]
        active &= np.isinf(best.reshape(n, k)).any(axis=1)
        slab_low, slab_high, slab = slab_high, slab_high * 2, slab + 1
    return sign.reshape(n, k)


def _shingles(column: pa.Array, counted: bool):
    """Element, weight and owner of each row's shingles; fewer than five words make
    one shingle of all words."""
    data, offsets = text_buffer(column)
    starts, ends, rows = words_of(data, offsets)
    hashes = span_hashes(data, starts, ends)
    windows = window_hashes(hashes, SHINGLE)
    whole = np.flatnonzero(whole_windows(rows, SHINGLE, len(windows)))
    owner = np.searchsorted(rows, whole, side="right") - 1
    found = windows[whole]
    counts = np.diff(rows)
    for row in np.flatnonzero((counts > 0) & (counts < SHINGLE)):
        found = np.append(found, window_hashes(hashes[rows[row] : rows[row + 1]], int(counts[row])))
        owner = np.append(owner, row)
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    first = np.flatnonzero(np.r_[True, (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])]) if len(found) else np.zeros(0, np.int64)
    times = np.diff(np.r_[first, len(found)])
    weights = times.astype(np.float64) if counted else np.ones(len(first))
    return found[first], weights, owner[first], len(column)


def signature_bands(texts: DataFrame, bands: int = BANDS, rows: int = ROWS, counted: bool = False) -> DataFrame:
    """``texts`` (node long, text) -> node, bands: a hash per band of the signature,
    null for a text without words."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            column, node = batch.column(1), batch.column(0)
            at = 0
            sizes = np.diff(text_buffer(column)[1])
            while at < len(column):  # about a megabyte at a time
                many = max(1, int(np.searchsorted(np.cumsum(sizes[at:]), CHUNK, side="right")))
                elements, weights, owners, n = _shingles(column.slice(at, many), counted)
                sign = dart_signatures(elements, weights, owners, n, bands * rows).reshape(n * bands, rows)
                code = sign[:, 0]
                for r in range(1, rows):
                    code = join_hashes(code, sign[:, r])
                code = join_hashes(code, np.tile(np.arange(bands, dtype=np.uint64), n)).view(np.int64)
                none = np.bincount(owners, minlength=n) == 0
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(n + 1) * bands, pa.int32()), pa.array(code), mask=pa.array(none) if none.any() else None
                )
                yield pa.RecordBatch.from_arrays([node.slice(at, many), lists], names=["node", "bands"])
                at += many

    return texts.select("node", "text").mapInArrow(run, "node long, bands array<long>")


def shingle_set(text: Column) -> Column:
    """The distinct hashes of a text's shingles, by built-in functions."""

    def of(h):
        starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(h) - SHINGLE))
        # beyond the last word there is null, which does not change a hash
        return F.array_distinct(F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(SHINGLE)])))

    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return let(F.transform(words, lambda w: F.xxhash64(w)), of)


def similarity(left: Column, right: Column) -> Column:
    both = F.size(F.array_intersect(left, right))
    return both / (F.size(left) + F.size(right) - both)


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> node, label: the least node of its component.

    Each round a node takes the least label among its neighbours', then that
    label's own label; a hot node's neighbours are added up before the shuffle.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "near-edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("label"))
    labels = written(labels, "near-labels")
    while True:
        seen = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(seen, labels.node == seen.a).select("node", F.least("label", "near").alias("next"), F.col("label").alias("old"))
        lower = written(lower, "near-labels")
        of_label = lower.select(F.col("node").alias("n"), F.col("next").alias("jump"))
        moved = lower.join(of_label, lower.next == of_label.n).select("node", F.col("jump").alias("label"), "old")
        moved = written(moved, "near-labels")
        changed = moved.where("label <> old").limit(1).count()
        labels = moved.select("node", "label")
        if not changed:
            return labels


def _labelled(frame: DataFrame, column: str, labels: DataFrame) -> DataFrame:
    """The frame with ``<column>_label``; a node without a link is its own label."""
    named = labels.select(F.col("node").alias("_n"), F.col("label").alias("_l"))
    joined = frame.join(named, F.col(column) == F.col("_n"), "left")
    return joined.withColumn(f"{column}_label", F.coalesce("_l", column)).drop("_n", "_l")


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    return pairs.select("a", "b").join(right, "b").join(left, "a").where(similarity(F.col("sa"), F.col("sb")) >= least).select("a", "b")


def _check_block(least: float):
    """Links between the outsiders of a block (role 1) and its other documents (role 0)
    of another component, by the shingles that they share."""

    def run(table: pa.Table) -> pa.Table:
        node, label, role = (table.column(c).to_numpy() for c in ("node", "label", "role"))
        lists = table.column("shingles").combine_chunks()
        offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy()
        sizes = np.diff(offsets)
        owner = np.repeat(np.arange(len(node)), sizes)
        inside = role[owner] == 0
        elements, owner = values[offsets[0] : offsets[-1]][inside], owner[inside]
        order = np.argsort(elements, kind="stable")
        elements, owner = elements[order], owner[order]
        left, right = [], []
        for row in np.flatnonzero(role == 1):
            mine = values[offsets[row] : offsets[row + 1]]
            low, high = np.searchsorted(elements, mine, "left"), np.searchsorted(elements, mine, "right")
            many = high - low
            at = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())
            shared = np.bincount(owner[at], minlength=len(node))
            near = (shared > 0) & (label != label[row]) & (shared >= least * (sizes + len(mine) - shared))
            right.append(node[near])
            left.append(np.full(near.sum(), node[row]))
        found = [np.concatenate(side) if side else np.zeros(0, dtype=np.int64) for side in (left, right)]
        return pa.table({"a": pa.array(found[0], pa.int64()), "b": pa.array(found[1], pa.int64())})

    return run


def unlinked_in_buckets(members: DataFrame, labels: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Links between documents of different components in the same bucket.

    The largest component of a bucket is not compared with itself: only its
    outsiders are, ``BLOCK`` at a time, with ``TARGETS`` documents at a time, so a
    bucket's rows travel once per ``BLOCK`` outsiders, and no task gets a bucket whole.
    """
    rest = written(_labelled(members.where("n > 2"), "node", labels).withColumnRenamed("node_label", "label"), "near-rest")
    sizes = rest.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("k"))
    main = sizes.groupBy("bucket").agg(F.max(F.struct("k", "label")).alias("main"), F.sum("k").alias("n"))
    main = main.where("n > main.k").select("bucket", F.col("main.label").alias("main"), (F.col("n") - F.col("main.k")).alias("outside"))
    rest = rest.join(main, "bucket")
    last_i = F.floor((F.col("n") - 1) / TARGETS).cast("int")
    last_j = F.floor((F.col("outside") - 1) / BLOCK).cast("int")
    place = F.xxhash64("node")
    fields = ["bucket", "node", "label"]
    targets = rest.select(
        *fields, F.lit(0).alias("role"), F.pmod(place, last_i + 1).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), last_j)).alias("j")
    )
    outsiders = rest.where("label <> main").select(
        *fields, F.lit(1).alias("role"), F.explode(F.sequence(F.lit(0), last_i)).alias("i"), F.pmod(place, last_j + 1).cast("int").alias("j")
    )
    both = targets.union(outsiders).join(sets, "node")
    return both.groupBy("bucket", "i", "j").applyInArrow(_check_block(least), "a long, b long").distinct()


def text_node() -> Column:
    """A text's name, a 64-bit hash: n different texts share one with a chance of
    about n^2 / 2^65.  A null text is named by its row's id."""
    null = F.xxhash64(F.lit("null"), F.col("doc_id").cast("string"))
    return F.when(F.col("text").isNull(), null).otherwise(F.xxhash64("text"))


def near_links(docs: DataFrame, ids: DataFrame, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Components of near-duplicates among different texts: node, label.

    ``docs``: doc_id, node, text; ``ids``: their doc_id and node.  Only nodes with a
    link are returned.  Copies are signed like all texts and then dropped, which is
    less work than to shuffle the texts."""
    signed = signature_bands(docs.where("text IS NOT NULL"), bands, rows).where("bands IS NOT NULL")
    signed = written(signed.dropDuplicates(["node"]), "near-bands")
    placed = signed.select("node", F.explode("bands").alias("bucket"))
    buckets = placed.groupBy("bucket").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = written(buckets, "near-buckets")  # a table, so that the join can split a hot bucket
    members = written(placed.join(buckets, "bucket"), "near-members")  # only those with company
    wanted = members.select("node").distinct().join(ids, "node").groupBy("node").agg(F.min("doc_id").alias("first"))
    wanted = wanted.select(F.col("node").alias("of"), "first")
    sets = docs.join(wanted, (F.col("node") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("first")))
    sets = written(sets.select("node", shingle_set(F.col("text")).alias("shingles")).dropDuplicates(["node"]), "near-sets")
    stars = members.where("node <> head").groupBy(F.col("node").alias("a"), F.col("head").alias("b"))
    stars = written(stars.agg(F.count(F.lit(1)).alias("votes")), "near-stars")
    best = stars.groupBy("a").agg(F.max_by("b", F.struct("votes", "b")).alias("b"))
    links = written(_verified(best, sets, least), "near-links")
    labels = components(links)
    others = stars.join(best, ["a", "b"], "left_anti")
    others = _labelled(_labelled(others, "a", labels), "b", labels).where("a_label <> b_label")
    links = links.union(written(_verified(others, sets, least), "near-links"))
    labels = components(links)
    # two in a bucket are a star, checked above
    more = written(unlinked_in_buckets(members, labels, sets, least), "near-links")
    return components(links.union(more))


def near_duplicates(docs: DataFrame, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, class_id, class_rows, class_node, node of every row of ``docs`` (doc_id, text).

    A class holds equal texts and everything that links of similarity ``least`` or
    more connect; its id is its least doc_id.  A text of fewer than five words is
    one shingle; one without words only matches its copies; a null text only rows
    of its own id.  Repeated rows are all returned; other columns are not looked
    at; an empty table gives no rows.  ``node`` tells texts apart, ``class_node``
    classes.
    """
    named = docs.select("doc_id", "text", text_node().alias("node"))
    ids = written(named.select("doc_id", "node"), "near-ids")
    labels = near_links(named, ids, least, bands, rows)
    classed = written(_labelled(ids, "node", labels).withColumnRenamed("node_label", "class_node"), "near-classes")
    found = classed.groupBy(F.col("class_node").alias("c")).agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_rows"))
    found = written(found, "near-class-sizes")
    return classed.join(found, F.col("class_node") == F.col("c")).select("doc_id", "class_id", "class_rows", "class_node", "node")


def keep_one(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One document of each class, as it came: the one with the least id, a null id
    last; of rows that repeat id and text any one."""
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("node"))
    stay = near_duplicates(docs, least).groupBy("class_node").agg(F.min(order).alias("s"))
    stay = stay.select(F.col("s.doc_id").alias("_id"), F.col("s.node").alias("_n"))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", text_node().alias("_node"))
    kept = rows.join(stay, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_node") == F.col("_n")), "left_semi")
    return kept.dropDuplicates(["doc_id", "_node"]).select("_row.*")
