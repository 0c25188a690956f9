"""Embedding texts, vector records, and exact nearest neighbours."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearthline.functions.text import fill_template, template_columns
from hearthline.functions.vectors import VECTOR_SIZE, VectorModel, text_vector
from hearthline.session import run_folder

BLOCK = 1024  # vectors packed together; two blocks make a million scores
PIVOTS = 256  # vectors that the others are placed by
ROWS = 1024  # vectors placed at a time
SLACK = 1e-6  # radians; far above what rounding does to an angle near 0
SHELL = "cell int, low double, high double, least double, n int, ids binary, units binary, reached binary"
FOUND = "query_id bigint, id bigint, score double"


def embedding_texts(listings: DataFrame) -> DataFrame:
    """The 20 columns the job needs, and the text made from 18 of them."""
    return listings.select("propertyId", "ingestion_timestamp", *template_columns()).withColumn(
        "embedding_text", fill_template()
    )


def vector_records(texts: DataFrame) -> DataFrame:
    return texts.select(F.col("propertyId").cast("string").alias("_id"), "embedding_text")


def vectorize(
    records: DataFrame, model: VectorModel | None = None, size: int = VECTOR_SIZE, text: str = "embedding_text"
) -> DataFrame:
    """Records with the dense ``vector`` of their text."""
    return records.withColumn("vector", text_vector(F.col(text), model, size))


def cosine_topk(corpus: DataFrame, queries: DataFrame, k: int, block: int = BLOCK, pivots: int = PIVOTS) -> DataFrame:
    """The ``k`` corpus vectors closest to each query vector, exactly.

    Both sides are ``id bigint, vector array<float>``, all of one length; result
    ``query_id, rank, id, score``, ties to the lower id.  Null vectors are not
    compared.  Builds the index and searches it once; for more searches keep
    ``build_index``'s result.
    """
    centers = choose_pivots(corpus, pivots)
    return search_index(build_index(corpus, centers, block), centers, queries, k, block)


def choose_pivots(vectors: DataFrame, n: int = PIVOTS) -> np.ndarray:
    """At most ``n`` of the vectors, at length 1, by a hash of their id: a sample of
    bounded size.  Any choice gives exact results; pivots near the data skip more."""
    there = vectors.where("id IS NOT NULL AND vector IS NOT NULL")
    found = there.orderBy(F.xxhash64("id"), "id").limit(n).collect()
    return _units(np.array([row.vector for row in found], dtype=np.float64)) if found else np.zeros((1, 1))


def build_index(corpus: DataFrame, centers: np.ndarray, block: int = BLOCK, extra: str | None = None) -> DataFrame:
    """Blocks of at most ``block`` vectors of one cell, as a table.

    A vector's cell is its closest pivot; a block holds neighbours in the order of
    their angle to it, so it is a shell between ``low`` and ``high``.  Rows are dealt
    by ranges of cell, angle and id: a cell with a third of all vectors is many tasks.
    The least value of a column ``extra`` is kept with each block.
    """
    spark = corpus.sparkSession
    cells = _saved(_celled(corpus, centers, extra), spark, "vector-cells")
    order = ("cell", "angle", "id")
    return _saved(cells.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_shells(block), SHELL), spark, "vector-index")


def search_index(index: DataFrame, centers: np.ndarray, queries: DataFrame, k: int, block: int = BLOCK) -> DataFrame:
    """As ``cosine_topk``, on an index of ``build_index`` with the same ``centers``.

    Queries are packed like the corpus.  Each block of queries first meets the blocks
    of its own cell, which gives every query a score that ``k`` vectors reach.  By the
    triangle inequality of angles no vector of a shell is closer to a query than the
    query's angle to the pivot allows; only shells that may still reach the score
    are looked at, and in them only the queries for which they may.
    """
    asked = build_index(queries, centers, block)
    own = asked.withColumnsRenamed({c: f"q_{c}" for c in asked.columns}).join(index, F.col("q_cell") == F.col("cell"))
    near = _saved(own.mapInArrow(_best_of_blocks(k), FOUND), index.sparkSession, "vector-near")
    best = near.withColumn("rank", F.row_number().over(_closest())).where(F.col("rank") == k)
    reached = best.select(F.col("query_id").alias("id"), F.col("score").alias("reached"))
    rest = candidate_pairs(index, centers, queries, reached, block)
    far = rest.mapInArrow(_best_of_blocks(k, centers), FOUND)
    ranked = near.union(far).withColumn("rank", F.row_number().over(_closest())).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")


def candidate_pairs(
    index: DataFrame, centers: np.ndarray, queries: DataFrame, reached: DataFrame, block: int = BLOCK
) -> DataFrame:
    """Blocks of queries beside the blocks of other cells that may hold a closer vector.

    Whole cells are ruled out first: one row per pair of cells, of which there are at
    most the square of the pivots, whatever the corpus holds.  Then shells are.
    """
    spark = index.sparkSession
    scored = queries.join(reached, "id", "left").withColumn("reached", F.coalesce("reached", F.lit(-1.0)))
    asked = build_index(scored, centers, block, "reached")
    sizes = index.groupBy("cell").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()
    wanted = asked.groupBy("cell").agg(F.max("high").alias("high"), F.min("least").alias("least")).collect()
    between = np.arccos(np.clip(centers @ centers.T, -1, 1))
    pairs = [
        (q.cell, c.cell, float(between[q.cell, c.cell]))
        for q in wanted
        for c in sizes
        if q.cell != c.cell
        and max(between[q.cell, c.cell] - q.high - c.high, c.low - q.high - between[q.cell, c.cell]) <= np.arccos(np.clip(q.least, -1, 1)) + SLACK
    ]
    pairs = spark.createDataFrame(pairs, "q_cell int, cell int, between double")
    may = F.greatest(F.col("between") - F.col("q_high") - F.col("high"), F.col("low") - F.col("q_high") - F.col("between"))
    met = asked.withColumnsRenamed({c: f"q_{c}" for c in asked.columns}).join(pairs, "q_cell").join(index, "cell")
    return met.where(may <= F.acos(F.greatest("q_least", F.lit(-1.0))) + SLACK).drop("between")


def _closest():
    return Window.partitionBy("query_id").orderBy(F.desc("score"), "id")


def _saved(df: DataFrame, spark, name: str) -> DataFrame:
    path = run_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _units(vectors: np.ndarray) -> np.ndarray:
    norms = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return vectors / np.where(norms == 0, 1, norms)


def _angles(units: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ centers.T, -1, 1))


def _celled(vectors: DataFrame, centers: np.ndarray, extra: str | None = None) -> DataFrame:
    """cell, angle, id, unit (bytes) and ``extra`` (or 0) of each vector."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                values = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                units = _units(values.reshape(part.num_rows, -1))
                # without a corpus there are no pivots, and any cell will do
                angles = _angles(units, centers if centers.any() else np.zeros((1, units.shape[1])))
                cell = angles.argmin(axis=1)
                columns = [
                    pa.array(cell, pa.int32()),
                    pa.array(angles[np.arange(len(cell)), cell]),
                    part.column(0).cast(pa.int64()),
                    pa.array([u.tobytes() for u in units], pa.binary()),
                    part.column(2),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["cell", "angle", "id", "unit", "reached"])

    there = vectors.where("id IS NOT NULL AND vector IS NOT NULL")
    there = there.select("id", "vector", F.lit(0.0).alias("reached") if extra is None else F.col(extra))
    return there.mapInArrow(place, "cell int, angle double, id bigint, unit binary, reached double")


def _shells(block: int):
    """Neighbouring rows of one cell as one row."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []

        def shell():
            cell = held[0][0]
            angles, reached = np.array([h[1] for h in held]), np.array([h[4] for h in held])
            ids = np.array([h[2] for h in held], np.int64)
            row = [cell, angles.min(), angles.max(), reached.min(), len(held), ids.tobytes(), b"".join([h[3] for h in held]), reached.tobytes()]
            types = (pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            arrays = [pa.array([v], t) for v, t in zip(row, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=[f.split(" ")[0] for f in SHELL.split(", ")])

        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True):
                if held and (row[0] != held[0][0] or len(held) >= block):
                    yield shell()
                    held.clear()
                held.append(row)
        if held:
            yield shell()

    return pack


def _best_of_blocks(k: int, centers: np.ndarray | None = None):
    """The ``k`` best of a block for each query of the block beside it; with ``centers``
    only for queries whose angle to the block's pivot leaves a chance."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("q_ids", "q_units", "q_reached", "ids", "units", "cell", "low", "high")
        for batch in batches:
            for q_ids, q_units, reached, ids, units, cell, low, high in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                ids, asked = np.frombuffer(ids, np.int64), np.frombuffer(q_ids, np.int64)
                q_units = np.frombuffer(q_units).reshape(len(asked), -1)
                if centers is not None:
                    angle = _angles(q_units, centers[cell : cell + 1])[:, 0]
                    may = np.maximum(np.maximum(angle - high, low - angle), 0)
                    left = may <= np.arccos(np.clip(np.frombuffer(reached), -1, 1)) + SLACK
                    asked, q_units = asked[left], q_units[left]
                if not len(asked):
                    continue
                scores = q_units @ np.frombuffer(units).reshape(len(ids), -1).T
                order = np.argsort(ids, kind="stable")  # equal scores go to the lower id
                ids, scores = ids[order], scores[:, order]
                best = np.argsort(-scores, axis=1, kind="stable")[:, :k]
                columns = (np.repeat(asked, best.shape[1]), ids[best].ravel(), np.take_along_axis(scores, best, 1).ravel())
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "id", "score"])

    return search
