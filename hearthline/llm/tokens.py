"""Token counts from flat token files by a scan for separators.

A token file is nothing but token ids, two or four bytes each, little-endian, with
an end-of-document id after every document: no index and no lengths.  It is read
in blocks that end anywhere.  Each block is searched for the separator as one
array; then a prefix scan over the blocks of a file (their lengths, their number of
separators and the last separator seen) gives every document its number and its
length, however many blocks it spans.
"""

from __future__ import annotations

import base64
import re
from functools import partial

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearthline.llm.common import written

BLOCK_BYTES = 1 << 20
GROUP = 1024  # blocks that the inner prefix scan covers
EOD = 50_256  # free in the 50,256 ranks of the vocabulary
# Fixed value: the pattern the public vocabularies split texts by.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCKS = "file long, block long, payload binary"
LONG_RUN = 10_000  # blanks; the pattern matcher's stack does not hold some hundred thousand
# Fixed value: the characters that the pattern takes for blanks.
BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_RUN)


def encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    """A tokenizer from a public file of ranks."""
    table = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in ranks.splitlines() if line)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def encode_text(coder: tiktoken.Encoding, text: str) -> list[int]:
    """``coder.encode_ordinary`` for ``PATTERN``, also where blanks follow each other
    without end: such a run is one piece for the pattern, but for its last blank, which
    goes with what follows."""
    ids, at = [], 0
    for run in BLANKS.finditer(text):
        last = run.end() - (run.end() < len(text))
        ids += coder.encode_ordinary(text[at : run.start()])
        ids += coder._encode_single_piece(text[run.start() : last])
        at = last
    return ids + coder.encode_ordinary(text[at:])


def token_blocks(docs: DataFrame, ranks: bytes, pattern: str = PATTERN, eod: int = EOD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The token stream of each partition as a file in blocks: file, block, payload,
    and ``ids``, the doc_ids of the documents begun in the block's batch, in order.

    Blocks are cut at ``block_bytes`` without regard to documents.  Two bytes an
    id.  A null or empty text is a document without tokens; a very long one is encoded
    whole, by one task.
    """
    shared = docs.sparkSession.sparkContext.broadcast((ranks, pattern))

    def run(batches):
        coder, end = encoding(*shared.value), np.array([eod], dtype="<u2").tobytes()
        encode = partial(encode_text, coder) if shared.value[1] == PATTERN else coder.encode_ordinary
        file, block, rest = TaskContext.get().partitionId(), 0, bytearray()
        names = ["file", "block", "payload", "ids"]

        def row(payload, ids):
            nonlocal block
            block += 1
            arrays = [pa.array([file], pa.int64()), pa.array([block - 1], pa.int64())]
            arrays += [pa.array([payload], pa.binary()), pa.array([ids], pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        ids: list = []
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids.append(doc_id.as_py())
                text = text.as_py()
                if text:
                    rest += np.array(encode(text), dtype="<u2").tobytes()
                rest += end
                while len(rest) >= block_bytes:
                    yield row(bytes(rest[:block_bytes]), ids)
                    del rest[:block_bytes]
                    ids = []
        if rest:
            yield row(bytes(rest), ids)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"{BLOCKS}, ids array<long>")


def read_token_files(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Flat files as blocks: name, file (a hash of the name), block, payload.

    Files are read whole, so each must be below 2 GB."""
    blocks = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.length("content") - 1) / block_bytes)).cast("int"))
    files = spark.read.format("binaryFile").load(path).where("length > 0")
    cut = files.select("path", "content", F.explode(blocks).alias("block"))
    payload = F.substring("content", F.col("block") * block_bytes + 1, F.lit(block_bytes))
    return cut.select(F.col("path").alias("name"), F.xxhash64("path").alias("file"), F.col("block").cast("long").alias("block"), payload.alias("payload"))


def find_separators(blocks: DataFrame, eod: int, width: int = 2) -> DataFrame:
    """file, block, n_tokens, ends: where in the block the separators are.

    A block holds whole ids; odd bytes at the end of a file are not looked at."""
    if width not in (2, 4):
        raise ValueError("ids take 2 or 4 bytes")

    def run(batches):
        for batch in batches:
            lengths, ends = [], []
            for payload in batch.column(2):
                data = payload.as_buffer() if payload.is_valid else b""
                ids = np.frombuffer(data, dtype=f"<u{width}", count=len(data) // width)
                lengths.append(len(ids))
                ends.append(np.flatnonzero(ids == eod))
            arrays = [batch.column(0), batch.column(1), pa.array(lengths, pa.int64())]
            arrays.append(pa.array(ends, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(arrays, names=["file", "block", "n_tokens", "ends"])

    return blocks.select("file", "block", "payload").mapInArrow(run, "file long, block long, n_tokens long, ends array<long>")


def stitch(found: DataFrame, group: int = GROUP) -> DataFrame:
    """file, document (0, 1, ... in the file), n_tokens without the separator.

    A prefix scan in two steps, over groups of blocks and over the blocks of a
    group, so that one large file is not one task.  Tokens after the last separator
    of a file are a document without end, counted as one if there are any.
    """
    found = found.withColumn("g", F.floor(F.col("block") / group)).withColumn("n_ends", F.size("ends").cast("long"))
    found = found.withColumn("last", F.when(F.col("n_ends") > 0, F.element_at("ends", -1)))

    def before(column, window):
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    inner = Window.partitionBy("file", "g").orderBy("block")
    past = inner.rowsBetween(Window.unboundedPreceding, -1)
    rows = found.withColumn("start", before("n_tokens", past)).withColumn("documents", before("n_ends", past))
    rows = rows.withColumn("seen", F.max(F.col("start") + F.col("last")).over(past))
    sums = rows.groupBy("file", "g").agg(
        F.sum("n_tokens").alias("g_tokens"), F.sum("n_ends").alias("g_ends"), F.max(F.col("start") + F.col("last")).alias("g_last")
    )
    outer = Window.partitionBy("file").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("g_start", before("g_tokens", outer)).withColumn("g_documents", before("g_ends", outer))
    sums = sums.withColumn("g_seen", F.max(F.col("g_start") + F.col("g_last")).over(outer))
    joined = rows.join(sums.select("file", "g", "g_start", "g_documents", "g_seen"), ["file", "g"])
    start = F.col("g_start") + F.col("start")
    seen = F.coalesce(F.col("g_start") + F.col("seen"), F.col("g_seen"), F.lit(-1).cast("long"))
    # lengths from one separator to the next, the first from the last one seen before
    places = joined.select("file", (F.col("g_documents") + F.col("documents")).alias("first"), F.col("ends"), (seen - start).alias("prior"))
    ended = places.select("file", "first", F.posexplode(F.arrays_zip("ends", F.concat(F.array("prior"), F.col("ends")).alias("priors"))).alias("k", "e"), "prior")
    counts = ended.where("e.ends IS NOT NULL").select(
        "file", (F.col("first") + F.col("k")).alias("document"), (F.col("e.ends") - F.col("e.priors") - 1).alias("n_tokens")
    )
    files = sums.groupBy("file").agg(
        F.sum("g_tokens").alias("tokens"), F.sum("g_ends").alias("document"), F.max(F.col("g_start") + F.col("g_last")).alias("end")
    )
    left = F.col("tokens") - 1 - F.coalesce(F.col("end"), F.lit(-1).cast("long"))
    return counts.unionByName(files.where(left > 0).select("file", "document", left.alias("n_tokens")))


def count_tokens(
    docs: DataFrame, ranks: bytes, pattern: str = PATTERN, eod: int = EOD, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """doc_id, n_tokens of every document, by way of a written token stream.

    The stream is written once; counts come from its separators alone, and the
    n-th document of a file gets the n-th id that went into it.  Null and empty
    texts have 0 tokens; repeated rows are all returned; a null id stays null;
    other columns are not looked at; an empty table gives no rows.
    """
    blocks = written(token_blocks(docs, ranks, pattern, eod, block_bytes), "token-blocks")
    counts = stitch(find_separators(blocks, eod))
    ids = blocks.select("file", "block", "ids").withColumn("g", F.floor(F.col("block") / GROUP)).withColumn("n", F.size("ids").cast("long"))
    earlier = Window.partitionBy("file", "g").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    groups = ids.groupBy("file", "g").agg(F.sum("n").alias("g_n"))
    outer = Window.partitionBy("file").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("file", "g", F.coalesce(F.sum("g_n").over(outer), F.lit(0)).alias("g_first"))
    ids = ids.withColumn("first", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(groups, ["file", "g"])
    ids = ids.select("file", (F.col("g_first") + F.col("first")).alias("first"), F.posexplode("ids").alias("k", "doc_id"))
    ids = ids.select("file", (F.col("first") + F.col("k")).alias("document"), "doc_id")
    return counts.join(ids, ["file", "document"]).select("doc_id", "n_tokens")
