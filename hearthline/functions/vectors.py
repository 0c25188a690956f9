"""Dense vectors from text, and their similarity."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

VECTOR_SIZE = 256
ROWS = 1024  # counted at a time

# A batch of texts in, one list of floats per text out.
VectorModel = Callable[[pd.Series], pd.Series]


def token_slots(text: Column, size: int = VECTOR_SIZE) -> Column:
    """Slot of every word: its MD5 modulo ``size``.  Words are runs of letters or digits."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(
        words,
        lambda w: (F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("bigint") % size).cast("int"),
    )


def slot_vector(slots: Column, size: int = VECTOR_SIZE) -> Column:
    """Slots counted into one vector of length 1 (all zeros without any slot)."""

    def count(batch: pa.Array) -> pa.Array:
        parts = [dense(batch.slice(start, ROWS)) for start in range(0, max(1, len(batch)), ROWS)]
        return pa.concat_arrays(parts)

    def dense(rows: pa.Array) -> pa.Array:
        lengths = rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(rows)), lengths)
        counts = np.bincount(row * size + rows.flatten().to_numpy(zero_copy_only=False), minlength=len(rows) * size)
        counts = counts.reshape(len(rows), size).astype(np.float64)
        norms = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
        unit = (counts / np.where(norms == 0, 1, norms)).astype(np.float32)
        offsets = pa.array(np.arange(len(rows) + 1) * size, pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.array(unit.ravel()), mask=rows.is_null())

    # Spark copies a deterministic call into the filters it infers, e.g. for an
    # explode of the vector, and would then run it twice.
    return F.arrow_udf(count, "array<float>").asNondeterministic()(slots)


def text_vector(text: Column, model: VectorModel | None = None, size: int = VECTOR_SIZE) -> Column:
    """``model``'s vector, or hashed word counts; the JVM hashes, numpy counts."""
    if model is None:
        return slot_vector(token_slots(text, size), size)
    return F.pandas_udf(model, "array<float>").asNondeterministic()(text)
