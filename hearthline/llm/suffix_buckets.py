"""Substring deduplication by bucket refinement, on bytes.

In place of suffix sorting by bucket pointers, anchors of the text are first put into
buckets by a gram of half a window, and what shares a bucket is told apart by hash names of two
and four grams, each made of two of the names before.  No position is sorted by the
buckets of later offsets, and no pointer is written back.  Only as much of the order is made as tells equal strings of
``4 * GRAM`` bytes from different ones, and buckets of one place are not refined
at all.  The rounds and the way buckets are dealt out are in ``repeats``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.repeats import byte_units, read_told, repeated_windows

GRAM = 25  # bytes; the first buckets go by two grams, strings of four count as repeated


def covered(pos: np.ndarray, n: np.ndarray, width: int) -> list[tuple[int, int]]:
    """The maximal spans that windows cover; runs of ``n`` windows start at ``pos``."""
    order = np.argsort(pos, kind="stable")
    begin, end = pos[order], (pos + n + width - 1)[order]
    reach = np.maximum.accumulate(end) if len(end) else end
    new = np.flatnonzero(np.r_[True, begin[1:] > reach[:-1]]) if len(begin) else np.zeros(0, dtype=np.int64)
    return list(zip(begin[new].tolist(), reach[np.r_[new[1:] - 1, len(reach) - 1]].tolist())) if len(new) else []


def _cut(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, kept, sizes = [], [], []
            for text, copy_of, told in zip(batch.column(1), batch.column(2), batch.column(3)):
                data = text.as_buffer().to_pybytes()
                found = [(0, len(data))] if copy_of.is_valid and len(data) >= width else []
                if not copy_of.is_valid and told.is_valid:
                    pos, n, _, at = read_told(told.as_py())
                    found = covered(pos[at >= 0], n[at >= 0], width)
                edges = [0, *[x for span in found for x in span], len(data)]
                kept.append(b"".join(data[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2)))
                spans.append([{"start": a, "end": b} for a, b in found])
                sizes.append(len(data))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            arrays = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_bytes", "spans", "kept"])

    return run


def remove_repeats(docs: DataFrame, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, spans (start, end of each maximal removed run) and kept (what is
    left) of every row of ``docs`` (doc_id, text).

    A byte goes if it lies in a string of ``4 * gram`` bytes that also starts earlier,
    in a document of a smaller id or further left in the same one; overlaps count,
    and strings are judged on the input.  A null text is empty; a null id comes
    after all others; rows that share an id are in the order of a hash of their
    text, and rows that repeat id and text are one document, each told the same.
    A cut may fall inside a character, so ``kept`` is binary.  Other columns are not
    looked at; an empty table gives no rows.
    """
    docs = docs.select("doc_id", "text", F.lit(0).alias("row"))
    found = repeated_windows(docs, byte_units(gram), gram, places=False, wide=True)
    schema = "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"
    return found.mapInArrow(_cut(4 * gram), schema)


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of ``remove_repeats``."""
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2(F.col("kept"), 256).alias("kept_sha256"),
    )
