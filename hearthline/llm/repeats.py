"""Windows that start earlier in the corpus, found by refining buckets.

Both substring operators ask the same of a sequence of units (bytes or words):
which windows of ``4 q`` units also start earlier, in a document of a smaller id or
further left in the same one?  All windows of a corpus would be far too many rows,
so buckets are refined in three steps, and what one step settles the next leaves
out:

1. *Grams.*  Every window has an anchor: its least gram of ``q`` units, by hash,
   the leftmost on ties.  Equal windows have equal anchors in equal places, and an
   anchor serves a run of neighbouring windows, so that one unit in about 1.5 q is
   an anchor.  A run whose gram is nowhere else is unique and done.  Wide anchors
   have 2 q units: one unit in about q is one, but far fewer are shared by chance.
2. *Runs.*  The other runs are named by what their windows cover together.  A run
   whose name has come earlier is a repeat, all its windows with it.  If all runs of
   a gram have one name, the first of them is new as a whole and done.
3. *Windows.*  Only runs that differ but share a gram are looked at window by window.

A name of 2 k units is the hash of the names of k units at its start and k units
later, so each step reuses the names of the one before.  Names have 64 bits: n
windows make a false repeat with a chance of about n^2 / 2^65.

Names are dealt by hash to buckets.  A task first settles what its own documents
settle and sends one entry per name and batch, so a name that a third of all
documents have reaches its bucket once per batch, not once per document.  Entries
travel packed, some thousands to a row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import shuffle_partitions, written
from hearthline.llm.rolling import BYTE_VALUES, join_hashes, mix, powers, span_hashes, text_buffer, window_hashes, words_of

U64 = np.uint64
PIECE = 1 << 20  # windows looked at together
ENTRIES = 1 << 19  # entries packed together
FIELDS = ("key", "other", "oid", "node", "pos", "n")
TYPES = (np.uint64, np.uint64, np.int64, np.int64, np.int64, np.int32)
NO_ID = (1 << 63) - 1  # a null id comes last
GRAMS, RUNS, SETTLED = 0, 1, 2
PACKED = "bucket int, kind int, payload binary"

Entries = dict[str, np.ndarray]
# bytes and row offsets -> hashes of units and row offsets in units
Units = Callable[[np.ndarray, np.ndarray], tuple[Callable[[int, int], np.ndarray], np.ndarray]]


def byte_units(q: int):
    """Grams of ``q`` bytes: a function from a range of gram starts to their hashes."""

    def of(data: np.ndarray, offsets: np.ndarray):
        def grams(first: int, last: int) -> np.ndarray:
            part = data[first : last + q - 1]
            up, down = powers(len(part) + 1)
            sums = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum(BYTE_VALUES[part] * up[: len(part)], out=sums[1:])
            return mix((sums[q:] - sums[:-q]) * down[: len(part) - q + 1])

        return grams, offsets

    return of


def word_units(q: int):
    """Grams of ``q`` words."""

    def of(data: np.ndarray, offsets: np.ndarray):
        starts, ends, rows = words_of(data, offsets)
        hashes = span_hashes(data, starts, ends)

        def grams(first: int, last: int) -> np.ndarray:
            return window_hashes(hashes[first : last + q - 1], q)

        return grams, rows

    return of


def double(names: np.ndarray, k: int) -> np.ndarray:
    """Names of 2 k units from the names of k units."""
    return join_hashes(names[:-k], names[k:])


def empty_entries() -> Entries:
    return {name: np.zeros(0, dtype=kind) for name, kind in zip(FIELDS, TYPES)}


def gather(parts: list[Entries]) -> Entries:
    return {f: np.concatenate([p[f] for p in parts]) for f in FIELDS} if parts else empty_entries()


def take(entries: Entries, rows) -> Entries:
    return {f: v[rows] for f, v in entries.items()}


def pack(entries: Entries) -> bytes:
    """Names as they are, the rest as differences, which compress."""
    rest = [np.diff(entries[f], prepend=entries[f].dtype.type(0)).tobytes() for f in FIELDS[2:]]
    body = zstandard.ZstdCompressor(level=1).compress(b"".join(rest))
    count, other = len(entries["key"]), entries["other"].any()
    return np.array([count, other], dtype="<i8").tobytes() + entries["key"].tobytes() + (entries["other"].tobytes() if other else b"") + body


def unpack(payload: bytes) -> Entries:
    count, other = np.frombuffer(payload, dtype="<i8", count=2)
    at = 16
    out: Entries = {}
    out["key"] = np.frombuffer(payload, dtype=np.uint64, count=count, offset=at)
    at += 8 * count
    out["other"] = np.frombuffer(payload, dtype=np.uint64, count=count, offset=at) if other else np.zeros(count, dtype=np.uint64)
    at += 8 * count * bool(other)
    body = zstandard.ZstdDecompressor().decompress(payload[at:])
    at = 0
    for field, kind in zip(FIELDS[2:], TYPES[2:]):
        size = count * np.dtype(kind).itemsize
        out[field] = np.cumsum(np.frombuffer(body[at : at + size], dtype=kind), dtype=kind)
        at += size
    return out


def in_order(entries: Entries, key: str = "key") -> np.ndarray:
    """Rows by name, then as the corpus is ordered: id, text, position."""
    return np.lexsort((entries["pos"], entries["node"], entries["oid"], entries[key]))


def one_of_copies(entries: Entries) -> Entries:
    """Entries without those of copies of a text: of a text's same run the least id."""
    order = np.lexsort((entries["oid"], entries["pos"], entries["node"], entries["key"]))
    rows = take(entries, order)
    new = np.ones(len(order), dtype=bool)
    new[1:] = (rows["key"][1:] != rows["key"][:-1]) | (rows["node"][1:] != rows["node"][:-1]) | (rows["pos"][1:] != rows["pos"][:-1])
    return take(rows, new)


def runs_of(grams, rows: np.ndarray, q: int, wide: bool = False) -> Iterator[Entries]:
    """All runs of windows: key (the anchor), other (the run's name), pos and n, and the
    row in ``node``.  Anchors have ``q`` units, or twice as many if ``wide``.  Looked at
    in pieces; a cut only makes runs shorter."""
    width, total = 4 * q, int(rows[-1])
    bits = U64(PIECE.bit_length() + 1)
    low = (U64(1) << bits) - U64(1)
    for first in range(0, total, PIECE):
        last = min(first + PIECE, total)  # window starts first to last - 1
        end = min(last + width - 1, total)
        if end - first < width:
            break
        names = grams(first, end - q + 1)
        pairs = double(names, q)
        whole = double(pairs, 2 * q)
        names = pairs if wide else names
        least = (names & ~low) | np.arange(len(names), dtype=np.uint64)
        span, reach = width - (2 * q if wide else q) + 1, 1
        while reach * 2 <= span:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < span:
            least = np.minimum(least[: len(least) - (span - reach)], least[span - reach :])
        anchor = (least & low).astype(np.int64)
        # windows that cross the end of a row do not count
        ends = rows[(rows > first) & (rows < end)] - first
        crossing = np.zeros(len(anchor) + 1, dtype=np.int32)
        np.add.at(crossing, np.clip(ends - width + 1, 0, len(anchor)), 1)
        np.add.at(crossing, np.clip(ends, 0, len(anchor)), -1)
        at = np.flatnonzero(np.cumsum(crossing[:-1]) == 0)
        at = at[at < last - first]
        if not len(at):
            continue
        new = np.flatnonzero(np.r_[True, (np.diff(at) != 1) | (np.diff(anchor[at]) != 0)])
        n = np.diff(np.r_[new, len(at)])
        start = at[new]
        row = np.searchsorted(rows, start + first, side="right") - 1
        yield {
            "key": names[anchor[start]],
            "other": join_hashes(whole[start], whole[start + n - 1] + n.astype(np.uint64)),
            "oid": np.zeros(len(start), dtype=np.int64),
            "node": row,
            "pos": start + first - rows[row],
            "n": n.astype(np.int32),
        }


def window_names(grams, first: int, last: int, q: int) -> np.ndarray:
    """Names of the windows that start at ``first`` to ``last`` - 1."""
    return double(double(grams(first, last + 3 * q), q), 2 * q)


def packed(entries: Entries, kind: int, buckets: int) -> Iterator[tuple[int, int, bytes]]:
    """Rows of entries, by the bucket of their name; settled ones by that of their text."""
    by = mix(entries["node"].view(np.uint64)) if kind == SETTLED else entries["key"]
    bucket = (by % U64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for start, stop in zip(cuts, np.r_[cuts[1:], len(order)]):
        rows = order[start:stop]
        mine = take(entries, rows)
        yield int(bucket[rows[0]]), kind, pack(take(mine, np.lexsort((mine["pos"], mine["node"], mine["oid"]))))


def row_batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    for bucket, kind, payload in rows:
        arrays = [pa.array([bucket], pa.int32()), pa.array([kind], pa.int32()), pa.array([payload], pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, names=["bucket", "kind", "payload"])


def first_here(entries: Entries) -> tuple[Entries, Entries, np.ndarray]:
    """The first entry of each name, the others, and for those the row of their first."""
    rows = take(entries, in_order(entries))
    new = np.ones(len(rows["key"]), dtype=bool)
    new[1:] = rows["key"][1:] != rows["key"][:-1]
    group = np.cumsum(new) - 1
    return take(rows, new), take(rows, ~new), group[~new]


def by_gram(entries: Entries) -> tuple[Entries, np.ndarray, Entries, Entries]:
    """The first entry of each name of each gram and whether its gram has more names,
    in these entries or by a witness; the other entries, and for those their first."""
    real = entries["n"] > 0
    witnessed = np.unique(entries["key"][~real])
    rows = take(entries, real)
    rows = take(rows, np.lexsort((rows["pos"], rows["node"], rows["oid"], rows["other"], rows["key"])))
    gram = np.ones(len(rows["key"]), dtype=bool)
    gram[1:] = rows["key"][1:] != rows["key"][:-1]
    name = gram.copy()
    name[1:] |= rows["other"][1:] != rows["other"][:-1]
    of_gram, first = np.cumsum(gram) - 1, take(rows, name)
    mixed = (np.bincount(of_gram, name)[of_gram] > 1)[name] | np.isin(first["key"], witnessed)
    return first, mixed, take(rows, ~name), take(first, (np.cumsum(name) - 1)[~name])


def by_name(entries: Entries) -> Entries:
    """Runs under their own names."""
    return entries | {"key": entries["other"], "other": np.zeros_like(entries["other"])}


def send_runs(entries: Entries, buckets: int) -> Iterator[tuple[int, int, bytes]]:
    """What a batch sends.  Runs of a name after the first are settled here.  The first
    goes to its gram's bucket if the gram has that name only; a gram of more names
    needs no company: they go to the buckets of the names, with one witness to the
    gram's."""
    first, mixed, later, of = by_gram(one_of_copies(entries))
    alone, open_ = take(first, ~mixed), take(first, mixed)
    witness = np.ones(len(open_["key"]), dtype=bool)
    witness[1:] = open_["key"][1:] != open_["key"][:-1]
    witness = take(open_, witness)
    witness |= {"other": np.zeros_like(witness["other"]), "n": np.zeros_like(witness["n"]), "pos": np.full_like(witness["pos"], -1)}
    yield from packed(gather([alone, witness]), GRAMS, buckets)
    yield from packed(by_name(open_), RUNS, buckets)
    yield from packed(settled(later, of), SETTLED, buckets)


def send_names(entries: Entries, buckets: int) -> Iterator[tuple[int, int, bytes]]:
    """The first entry of each name to its bucket; the others are settled here: each is
    sent right behind the first it repeats, to be told to its document."""
    first, later, of = first_here(entries)
    yield from packed(first, RUNS, buckets)
    yield from packed(settled(later, take(first, of)), SETTLED, buckets)


def settled(later: Entries, first: Entries) -> Entries:
    """Repeats with the place they repeat: ``other`` holds the position there."""
    return later | {"key": first["oid"].view(np.uint64) if len(later["key"]) else later["key"], "other": first["pos"].astype(np.uint64)}


def scan_runs(units, q: int, buckets: int, wide: bool = False):
    """Rows (oid, node, text) -> packed runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            data, offsets = text_buffer(batch.column(2))
            oid, node = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            grams, rows = units(data, offsets)
            for part in runs_of(grams, rows, q, wide):
                row = part["node"]
                part["oid"], part["node"] = oid[row], node[row]
                held.append(part)
                count += len(row)
                if count >= ENTRIES:
                    yield from row_batches(send_runs(gather(held), buckets))
                    held, count = [], 0
        if held:
            yield from row_batches(send_runs(gather(held), buckets))

    return run


def _payloads(table: pa.Table, kind: int) -> list[bytes]:
    kinds, payloads = table.column("kind").to_pylist(), table.column("payload")
    return [payloads[i].as_py() for i, k in enumerate(kinds) if k == kind]


def match_grams(buckets: int):
    """Packed runs of one gram bucket -> those of grams of more than one name, to the
    buckets of the names; later runs of a name, settled.  A gram of one name has no
    windows to look at: the first of its runs is new as a whole, the others repeat it."""

    def run(table: pa.Table) -> pa.Table:
        out = []
        for kind in (RUNS, SETTLED):
            out += [(table.column("bucket")[0].as_py(), kind, payload) for payload in _payloads(table, kind)]
        payloads = _payloads(table, GRAMS)
        if payloads:
            first, mixed, later, of = by_gram(one_of_copies(gather([unpack(p) for p in payloads])))
            out += list(packed(by_name(take(first, mixed)), RUNS, buckets))
            out += list(packed(settled(later, of), SETTLED, buckets))
        return _table(out)

    return run


def _table(rows) -> pa.Table:
    return pa.table(
        {
            "bucket": pa.array([r[0] for r in rows], pa.int32()),
            "kind": pa.array([r[1] for r in rows], pa.int32()),
            "payload": pa.array([r[2] for r in rows], pa.binary()),
        }
    )


REPLIES = "oid long, node long, pos binary, n binary, ref binary, at binary, open long"


def tell(entries: Entries, ref: np.ndarray, at: np.ndarray) -> pa.Table:
    """One row per document: its runs (pos, n) and the place (ref, at) each repeats;
    a run that is new has -1 as ``at``."""
    order = np.lexsort((entries["pos"], entries["node"], entries["oid"]))
    rows, ref, at = take(entries, order), ref[order], at[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (rows["oid"][1:] != rows["oid"][:-1]) | (rows["node"][1:] != rows["node"][:-1])
    cuts = np.r_[np.flatnonzero(new), len(order)]

    def blobs(values, kind):
        values = values.astype(kind)
        return pa.Array.from_buffers(
            pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * values.itemsize).astype(np.int32)), pa.py_buffer(values)]
        )

    return pa.table(
        {
            "oid": rows["oid"][cuts[:-1]],
            "node": rows["node"][cuts[:-1]],
            "pos": blobs(rows["pos"], "<i4"),
            "n": blobs(rows["n"], "<i4"),
            "ref": blobs(ref, "<i8"),
            "at": blobs(at, "<i4"),
            "open": np.add.reduceat((at < 0).astype(np.int64), cuts[:-1]) if len(at) else np.zeros(0, np.int64),
        }
    )


def match_names(new_too: bool, places: bool):
    """Packed runs or windows of one bucket -> replies to their documents.

    Without ``places`` they only say what repeats, not where: zeros take no room."""

    def run(table: pa.Table) -> pa.Table:
        found = gather([unpack(p) for p in _payloads(table, RUNS)])
        first, later, of = first_here(one_of_copies(found))
        known = gather([unpack(p) for p in _payloads(table, SETTLED)])
        parts = [later, known]
        ref = [first["oid"][of], known["key"].view(np.int64)]
        at = [first["pos"][of], known["other"].astype(np.int64)]
        if new_too:
            parts.append(first)
            ref.append(first["oid"])
            at.append(np.full(len(first["key"]), -1))
        refs, ats = np.concatenate(ref), np.concatenate(at)
        if not places:
            refs, ats = np.zeros_like(refs), np.minimum(ats, 0)
        return tell(gather(parts), refs, ats)

    return run


def read_told(told) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """pos, n, ref, at of a document's replies, by position."""
    parts = [(f, kind, [np.frombuffer(t[f], dtype=kind) for t in told]) for f, kind in (("pos", "<i4"), ("n", "<i4"), ("ref", "<i8"), ("at", "<i4"))]
    pos, n, ref, at = (np.concatenate(v) if v else np.zeros(0, dtype=k) for _, k, v in parts)
    order = np.argsort(pos, kind="stable")
    return pos[order].astype(np.int64), n[order].astype(np.int64), ref[order], at[order].astype(np.int64)


def scan_windows(units, q: int, buckets: int):
    """Rows (oid, node, text, told) -> packed windows of the runs that are new."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                pos, n, _, at = read_told(batch.column(3)[i].as_py())
                pos, n = pos[at < 0], n[at < 0]
                if not len(pos):
                    continue
                data, offsets = text_buffer(batch.column(2).slice(i, 1))
                grams, _ = units(data, offsets)
                for low in range(0, int(pos[-1] + n[-1]), PIECE):
                    inside = (pos < low + PIECE) & (pos + n > low)
                    if not inside.any():
                        continue
                    begin, stop = np.maximum(pos[inside], low), np.minimum(pos[inside] + n[inside], low + PIECE)
                    names = window_names(grams, int(begin[0]), int(stop[-1]), q)
                    sizes = stop - begin
                    starts = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
                    held.append(
                        {
                            "key": names[starts - begin[0]],
                            "other": np.zeros(len(starts), dtype=np.uint64),
                            "oid": np.full(len(starts), batch.column(0)[i].as_py()),
                            "node": np.full(len(starts), batch.column(1)[i].as_py()),
                            "pos": starts,
                            "n": np.ones(len(starts), dtype=np.int32),
                        }
                    )
                    count += len(starts)
                # rows that repeat id and text are one document, and have their runs cut differently
                if count >= ENTRIES:
                    yield from row_batches(send_names(one_of_copies(gather(held)), buckets))
                    held, count = [], 0
        if held:
            yield from row_batches(send_names(one_of_copies(gather(held)), buckets))

    return run


def order_id(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(NO_ID))


def repeated_windows(docs: DataFrame, units, q: int, places: bool = True, wide: bool = False) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, and ``row``, which is handed through) as
    doc_id, text, copy_of, told, row.

    ``copy_of`` is the least id of the documents with the same text, if it is smaller;
    ``told`` lists the repeated runs of windows of any other document, and the places
    they repeat (all 0 without ``places``).  Anchors are wide on demand.  The texts are shuffled once, by id and text: the last refinement
    and the result read the same shuffle.
    """
    buckets = shuffle_partitions(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("node"), text.alias("text"), "row")
    oid = order_id(F.col("doc_id"))
    ids = written(named.select(oid.alias("oid"), "node").distinct(), "repeat-ids", free=True)
    least = ids.groupBy(F.col("node").alias("of")).agg(F.min("oid").alias("copy_of"))
    least = written(least, "repeat-least", free=True)  # a table, so that the join can split a hot text
    copies = ids.join(least, F.col("node") == F.col("of")).where("oid <> copy_of").select("oid", "node", "copy_of")
    scanned = named.select(oid.alias("oid"), "node", "text").mapInArrow(scan_runs(units, q, buckets, wide), PACKED)
    matched = scanned.groupBy("bucket").applyInArrow(match_grams(buckets), PACKED)
    replies = matched.groupBy("bucket").applyInArrow(match_names(True, places), REPLIES)
    # all replies to a document in one row, and how many of its runs are still open
    parts = F.collect_list(F.struct("pos", "n", "ref", "at"))
    runs = replies.groupBy("oid", "node").agg(parts.alias("told"), F.sum("open").alias("open"))
    runs = written(runs, "repeat-runs", free=True)

    def beside(side: DataFrame, how: str) -> DataFrame:
        return named.join(side, (order_id(F.col("doc_id")) == side.oid) & (named.node == side.node), how).drop(side.node)

    # with ``row``, for the same columns as below: only then one shuffle serves both
    unsettled = beside(runs.where("open > 0"), "inner").select("oid", "node", "text", "told", "row")
    windows = unsettled.mapInArrow(scan_windows(units, q, buckets), PACKED)
    more = windows.groupBy("bucket").applyInArrow(match_names(False, places), REPLIES)
    told = runs.select("oid", "node", F.explode("told").alias("t")).select("oid", "node", "t")
    told = told.union(more.select("oid", "node", F.struct("pos", "n", "ref", "at")))
    marked = told.withColumn("copy_of", F.lit(None).cast("long")).union(copies.select("oid", "node", F.lit(None), "copy_of"))
    marked = marked.groupBy("oid", "node").agg(F.collect_list("t").alias("told"), F.min("copy_of").alias("copy_of"))
    return beside(marked, "left").select("doc_id", "text", "copy_of", "told", "row")
