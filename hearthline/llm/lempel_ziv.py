"""Substring deduplication by relative Lempel-Ziv parsing, on words.

The reference of a document is all that comes before it: documents of smaller ids,
and its own text further left.  The reference is indexed by its windows of
``4 * GRAM`` words, the index cut into blocks by hash, and every window of a document
is settled there (``repeats``): it is a hit if it also starts earlier.  Neighbouring hits
whose first places in the reference follow each other are merged into one factor.  As a
hit names the first place of its own window, factors are neither greedy nor the
longest; what they cover is exactly what the hits cover.  Every factor is long enough
to be a duplicate span; what lies between factors is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.repeats import read_told, repeated_windows, word_units
from hearthline.llm.rolling import text_buffer, words_of

GRAM = 5  # words; windows of four grams count as repeated
FACTORS = "array<struct<start: long, length: long, ref_id: long, ref_start: long>>"


def parse(pos: np.ndarray, n: np.ndarray, ref: np.ndarray, at: np.ndarray, width: int) -> list[tuple[int, int, int, int]]:
    """Factors (start, length, document, start there) from runs of ``n`` windows, by
    position, that repeat the windows at ``at`` of document ``ref``."""
    if not len(pos):
        return []
    follows = (pos[1:] == pos[:-1] + n[:-1]) & (ref[1:] == ref[:-1]) & (at[1:] == at[:-1] + n[:-1])
    new = np.flatnonzero(np.r_[True, ~follows])
    last = np.r_[new[1:] - 1, len(pos) - 1]
    length = pos[last] + n[last] - pos[new] + width - 1
    return list(zip(pos[new].tolist(), length.tolist(), ref[new].tolist(), at[new].tolist()))


def _factor(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            starts, ends, rows = words_of(data, offsets)
            raw = data.tobytes()
            factors, removed, kept = [], [], []
            for i, (copy_of, told) in enumerate(zip(batch.column(2), batch.column(3))):
                count, found = int(rows[i + 1] - rows[i]), []
                if copy_of.is_valid:
                    found = [(0, count, copy_of.as_py(), 0)] if count >= width else []
                elif told.is_valid:
                    pos, n, ref, at = read_told(told.as_py())
                    old = at >= 0
                    found = parse(pos[old], n[old], ref[old], at[old], width)
                stay = np.ones(count, dtype=bool)
                for start, length, _, _ in found:
                    stay[start : start + length] = False
                words = np.flatnonzero(stay) + rows[i]
                kept.append(b" ".join([raw[a:b] for a, b in zip(starts[words].tolist(), ends[words].tolist())]))
                removed.append(count - len(words))
                factors.append([dict(zip(("start", "length", "ref_id", "ref_start"), f)) for f in found])
            counts = np.diff(rows)
            fields = [(name, pa.int64()) for name in ("start", "length", "ref_id", "ref_start")]
            arrays = [
                batch.column(0),
                pa.array(counts, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(factors, pa.list_(pa.struct(fields))),
                pa.array(kept, pa.binary()).cast(pa.string()),
                batch.column(4),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "n_removed", "factors", "kept", "row"])

    return run


def _parsed(docs: DataFrame, gram: int) -> DataFrame:
    found = repeated_windows(docs, word_units(gram), gram)
    row = docs.schema["row"].dataType.simpleString()
    schema = f"doc_id long, n_words long, n_removed long, factors {FACTORS}, kept string, row {row}"
    return found.mapInArrow(_factor(4 * gram), schema)


def remove_repeats(docs: DataFrame, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, factors and kept (the words left, joined by a space)
    of every row of ``docs`` (doc_id, text).

    A word goes if it lies in a window of ``4 * gram`` words that also starts earlier,
    in a document of a smaller id or further left in the same one; windows are
    judged on the input.  A null text has no words; a null id comes after all
    others (``ref_id`` 2^63 - 1); rows that share an id are in the order of a hash of
    their text, and rows that repeat id and text are one document, each told the
    same.  Of copies only the one of the least id is factored, the others are one
    factor.  Other columns are not looked at; an empty table gives no rows.
    """
    return _parsed(docs.select("doc_id", "text", F.lit(0).alias("row")), gram).drop("row")


def cut_documents(docs: DataFrame, gram: int = GRAM) -> DataFrame:
    """The documents with their columns, ``text`` without its repeated windows and
    ``n_chars`` counted again.  A text that loses nothing stays as it is, any other is
    its kept words joined by a space, an empty text if none is left; no row goes."""
    inner = [F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]
    found = _parsed(docs.select("doc_id", "text", F.struct(*inner).alias("row")), gram)
    cut = F.col("n_removed") > 0
    columns = []
    for i, name in enumerate(docs.columns):
        column = F.col(f"row.c{i}")
        if name == "text":
            column = F.when(cut, F.col("kept")).otherwise(column)
        elif name == "n_chars":
            column = F.when(cut, F.char_length("kept").cast(docs.schema[name].dataType)).otherwise(column)
        columns.append(column.alias(name))
    return found.select(*columns)


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of ``remove_repeats``."""
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))
