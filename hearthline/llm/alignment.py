"""Alignment of two tokenizers' tokens, by skipping along diagonals.

Both tokenizers cut the same bytes; their tokens' ends are two ascending arrays.  Where
tokens map one to one, the arrays agree at a fixed shift of their indices: the diagonal.
The walk compares ever longer stretches along it, twice as long each time, and jumps
over what agrees.  Where it stops, the side that is behind takes tokens until both end
together: an irregular group, after which the shift is a new one.

How many documents hold a pair of ids linked is counted over the corpus from one row
per pair and chunk of documents, and brought back to each chunk as one table of its own
pairs, so neither links nor texts are shuffled by pair.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearthline.llm.common import written

SPACE = "▁"
CHUNK = 1 << 22  # bytes of text in a chunk of documents
LONGEST = 4096  # tokens compared at once
BLANKS = 10_000  # a run of blanks that tiktoken is spared
KEPT = 1 << 22  # letters of the words whose ids a worker keeps
# Fixed value: how byte-level tokenizers cut a text before they merge.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
DOCUMENT = "chunk string, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"
COUNTED = "chunk string, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
FIXED = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def byte_values() -> dict[str, int]:
    """The byte each letter of a byte-level vocabulary stands for: visible Latin-1
    letters for themselves, the others, in order, from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [x for x in range(256) if x not in set(plain)]
    return {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(others)}


def align(ends_a: list[int], ends_b: list[int]) -> Iterator[tuple[bool, int, int, int, int]]:
    """Groups of two ascending lists of ends with the same last value, as stretches
    (straight, from_a, to_a, from_b, to_b): a straight one is so many groups of one to
    one, any other is one group."""
    i = j = 0
    n_a, n_b = len(ends_a), len(ends_b)
    while i < n_a and j < n_b:
        start, step = i, 1
        while ends_a[i : i + step] == ends_b[j : j + step]:  # agree, or both are at their end
            moved = min(step, n_a - i)
            i, j = i + moved, j + moved
            if i >= n_a or j >= n_b:
                break
            step = min(2 * step, LONGEST)
        else:
            while step > 1:  # what disagrees lies within the last step
                step //= 2
                if ends_a[i : i + step] == ends_b[j : j + step]:
                    i, j = i + step, j + step
        if i > start:
            yield True, start, i, j - (i - start), j
        if i >= n_a or j >= n_b:
            return
        from_a, from_b = i, j
        end_a, end_b = ends_a[i], ends_b[j]
        while end_a != end_b:
            if end_a < end_b:
                i += 1
                end_a = ends_a[i]
            else:
                j += 1
                end_b = ends_b[j]
        i, j = i + 1, j + 1
        yield False, from_a, i, from_b, j


def group_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token of either side whether it is the last of its group."""
    last_a, last_b = bytearray(len(ends_a)), bytearray(len(ends_b))
    for straight, i, to_a, j, to_b in align(ends_a.tolist(), ends_b.tolist()):
        if straight:
            last_a[i:to_a] = last_b[j:to_b] = b"\1" * (to_a - i)
        else:
            last_a[to_a - 1] = last_b[to_b - 1] = 1
    return np.frombuffer(last_a, bool), np.frombuffer(last_b, bool)


@cache
def decimals(digits: int) -> tuple[np.ndarray, np.ndarray]:
    """Of all numbers of up to so many digits: their digits and a place for a mark behind,
    and which of these are shown."""
    numbers, powers = np.arange(10**digits)[:, None], 10 ** np.arange(digits)[::-1]
    letters = np.zeros((10**digits, digits + 1), np.uint8)
    letters[:, :-1] = numbers // powers % 10 + ord("0")
    shown = np.ones(letters.shape, bool)
    shown[:, : digits - 1] = numbers >= powers[:-1]
    return letters, shown


def group_text(ids_a: np.ndarray, ids_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> bytes:
    """``a1,a2|b1;a3|b2,b3``: the ids of all groups, as decimals."""
    upto_a, upto_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
    at_a = np.arange(len(ids_a)) + np.r_[0, upto_b][np.cumsum(last_a) - last_a]
    at_b = np.arange(len(ids_b)) + upto_a[np.cumsum(last_b) - last_b]
    ids, marks = np.empty(len(ids_a) + len(ids_b), np.int64), np.full(len(ids_a) + len(ids_b), ord(","), np.uint8)
    ids[at_a], ids[at_b] = ids_a, ids_b
    marks[at_a[last_a]], marks[at_b[last_b]] = ord("|"), ord(";")
    letters, shown = (x.take(ids, axis=0) for x in decimals(len(str(ids.max()))))
    letters[:, -1] = marks
    return letters[shown][:-1].tobytes()


def linked(ids_a: np.ndarray, ids_b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids, on either side, of all pairs of tokens that share a byte: between two
    neighbouring cuts of either side lies one pair."""
    cuts = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
    cuts = cuts[np.r_[True, cuts[1:] != cuts[:-1]]]
    return ids_a[np.searchsorted(ends_a, cuts)], ids_b[np.searchsorted(ends_b, cuts)]


def byte_encoder(a_json: bytes) -> tuple[Callable, list[bytes]]:
    """A function from a text to the ids of a byte-level tokenizer, and each id's bytes.

    Where ids are in the order of the merges, as is usual, tiktoken gives the same ids
    several times faster; it cannot take very long runs of blanks, which the tokenizer's
    own library encodes."""
    import tiktoken
    from tokenizers import Tokenizer

    whole = Tokenizer.from_str(a_json.decode())
    whole.encode_special_tokens = True
    values = byte_values()
    vocabulary = whole.get_vocab()
    token_bytes = [b""] * (max(vocabulary.values()) + 1)
    for token, at in vocabulary.items():
        token_bytes[at] = bytes(values[c] for c in token) if all(c in values for c in token) else token.encode()

    def slow(text):
        return whole.encode(text, add_special_tokens=False).ids

    described = json.loads(a_json)
    model, before = described["model"], described.get("pre_tokenizer") or {}
    added = {x["content"] for x in described.get("added_tokens", ())}
    merged = ["".join(x.split(" ") if isinstance(x, str) else x) for x in model.get("merges", ())]
    plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    plain = plain and described.get("normalizer") is None and not model.get("ignore_merges")
    if not (plain and all(model["vocab"].get(x) == 256 + i for i, x in enumerate(merged))):
        return slow, token_bytes
    ranks = {token_bytes[at]: at for token, at in model["vocab"].items() if token not in added}
    fast = tiktoken.Encoding("bytes", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})
    blanks = re.compile(r"\s{%d}" % BLANKS)

    def encode(text):
        return slow(text) if blanks.search(text) else fast.encode_ordinary(text)

    return encode, token_bytes


def piece_encoder(b_model: bytes) -> tuple[Callable, list[bytes]]:
    """The same of a sentence-piece tokenizer."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=b_model)
    token_bytes = []
    for at in range(model.get_piece_size()):
        piece = model.id_to_piece(at)
        token_bytes.append(bytes([int(piece[3:5], 16)]) if model.is_byte(at) else piece.replace(SPACE, " ").encode())
    return model.encode, token_bytes


def by_words(encode: Callable, token_bytes: list[bytes]) -> Callable:
    """From a text to its ids by ``piece_encoder``, or none if they do not give back space
    and text.  Ids of words are kept, until the words have more than ``KEPT`` letters.

    Where no piece holds a space behind something else, none reaches from one word into
    the next, so a text's ids are those of its words, each with the space before it.  New
    words are encoded as one text, in which pieces with a space in front are first in
    their word.  Texts with two spaces in a row, or one at an end, are encoded whole."""
    known: dict[str, bytes] = {}
    held = 0
    first = np.array([x.startswith(b" ") for x in token_bytes])
    apart = not any(re.search(rb"[^ ] ", x) for x in token_bytes)

    def encoded(text: str) -> np.ndarray | None:
        ids = encode(text)
        same = b"".join(map(token_bytes.__getitem__, ids)) == b" " + text.encode()
        return np.array(ids, np.int64) if same else None

    def ids_of(text: str) -> np.ndarray | None:
        nonlocal held
        words = text.split(" ")
        if not apart or "" in words:
            return encoded(text)
        new = [*set(words).difference(known)]
        if new:
            joined = " ".join(new)
            ids = encoded(joined)
            starts = [] if ids is None else np.flatnonzero(first[ids]).tolist()
            if len(starts) != len(new):
                return encoded(text)
            whole, width = ids.tobytes(), ids.itemsize
            cuts = [at * width for at in (*starts, len(ids))]
            known.update(zip(new, map(whole.__getitem__, map(slice, cuts, cuts[1:])), strict=True))
            held += len(joined)
        found = np.frombuffer(b"".join(map(known.__getitem__, words)), np.int64)
        if held > KEPT:
            known.clear()
            held = 0
        return found

    return ids_of


@lru_cache(1)
def encoders(a_json: bytes, b_model: bytes) -> tuple[Callable, list[bytes], Callable, list[bytes]]:
    """Both sides' encoders and token bytes, which a worker keeps from task to task."""
    (encode_a, bytes_a), (encode_b, bytes_b) = byte_encoder(a_json), piece_encoder(b_model)
    return encode_a, bytes_a, by_words(encode_b, bytes_b), bytes_b


def aligned(docs: DataFrame, a_json: bytes, b_model: bytes) -> DataFrame:
    """Per row: counts, the hash of the groups and the distinct pairs with how often
    they are linked, in chunks of at most ``CHUNK`` bytes of text or one document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode_a, bytes_a, ids_b, bytes_b = encoders(a_json, b_model)
        len_a, len_b = np.array([len(x) for x in bytes_a]), np.array([len(x) for x in bytes_b])
        part, chunk, held = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            rows = []
            for doc_id, text in zip(ids, texts, strict=True):
                whole = b" " + text.encode() if text else b""
                if held and held + len(whole) > CHUNK:
                    chunk, held = chunk + 1, 0
                held += len(whole)
                row = (f"{part}-{chunk}", doc_id, 0, 0, 0, 0, "", [], [])
                if whole:
                    a, b = encode_a(" " + text), ids_b(text)
                    if b is not None and b"".join(map(bytes_a.__getitem__, a)) == whole:
                        a = np.array(a, np.int64)
                        ends_a, ends_b = np.cumsum(len_a[a]), np.cumsum(len_b[b])
                        last_a, last_b = group_ends(ends_a, ends_b)
                        of_a, of_b = linked(a, b, ends_a, ends_b)
                        pairs, times = np.unique(of_a << 32 | of_b, return_counts=True)
                        digest = hashlib.sha256(group_text(a, b, last_a, last_b)).hexdigest()
                        row = (*row[:2], len(a), len(b), int(last_a.sum()), len(of_a), digest, pairs, times.astype(np.int32))
                rows.append(row)
                if len(rows) >= 64 or held >= CHUNK:
                    yield packed(rows)
                    rows = []
            if rows:
                yield packed(rows)

    def packed(rows):
        types = [pa.string(), *[pa.int64()] * 5, pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())]
        names = [f.strip().split(" ")[0] for f in DOCUMENT.split(",")]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return written(docs.select("doc_id", "text").mapInArrow(run, DOCUMENT), "alignment-documents")


def chunk_pairs(documents: DataFrame) -> DataFrame:
    """chunk, pair, n: documents of a chunk that hold the pair."""
    return documents.select("chunk", F.explode("pairs").alias("pair")).groupBy("chunk", "pair").agg(F.count(F.lit(1)).alias("n"))


def pair_counts(per_chunk: DataFrame) -> DataFrame:
    """pair, a, b, n_docs, best: documents of the corpus that hold the pair linked, and
    whether that is the most for its id of the first tokenizer, ties included."""
    counts = per_chunk.groupBy("pair").agg(F.sum("n").alias("n_docs"))
    first = F.shiftright("pair", 32)
    most = F.max("n_docs").over(Window.partitionBy("a"))
    counts = counts.select("pair", first.alias("a"), F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b"), "n_docs")
    return counts.withColumn("best", F.col("n_docs") == most)


def counted(keys, documents: pa.Table, table: pa.Table) -> pa.Table:
    """The documents of one chunk with the sums of their pairs' counts."""
    pairs = table.column("pair").to_numpy()
    order = np.argsort(pairs)
    pairs = pairs[order]
    n_docs, best = table.column("n_docs").to_numpy()[order], table.column("best").to_numpy()[order]
    offsets = np.r_[0, np.cumsum(documents.column("pairs").combine_chunks().value_lengths().to_numpy())]
    at = np.searchsorted(pairs, documents.column("pairs").combine_chunks().flatten().to_numpy())
    times = documents.column("times").combine_chunks().flatten().to_numpy().astype(np.int64)

    def sums(values):
        upto = np.r_[0, np.cumsum(values)]
        return pa.array(upto[offsets[1:]] - upto[offsets[:-1]], pa.int64())

    found = documents.drop_columns(["pairs", "times"])
    if len(pairs):
        found = found.append_column("n_best", sums(times * best[at])).append_column("count_sum", sums(times * n_docs[at]))
    else:
        zeros = pa.array(np.zeros(found.num_rows, np.int64))
        found = found.append_column("n_best", zeros).append_column("count_sum", zeros)
    return found.select([f.strip().split(" ")[0] for f in COUNTED.split(",")])


def align_documents(docs: DataFrame, a_json: bytes, b_model: bytes) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_a, n_b, n_groups, n_links, n_best, count_sum
    and groups_sha256, from the files of a byte-level and of a sentence-piece tokenizer.

    A text is encoded whole, however long; null and empty texts, and those whose tokens
    do not give back the text's bytes, have no tokens: zeros and an empty hash.  Repeated
    rows are documents of their own, also in the counts; ties for the best are all best;
    columns of other names are not looked at; an empty table gives no rows."""
    documents = aligned(docs, a_json, b_model)
    per_chunk = written(chunk_pairs(documents), "alignment-pairs")
    counts = written(pair_counts(per_chunk).select("pair", "n_docs", "best"), "alignment-counts")
    tables = per_chunk.select("chunk", "pair").join(counts, "pair")
    found = documents.groupBy("chunk").cogroup(tables.groupBy("chunk")).applyInArrow(counted, COUNTED)
    return found.select(*FIXED)


def links_of(docs: DataFrame, a_json: bytes, b_model: bytes) -> DataFrame:
    """a, b, n_docs, best of every pair of ids that some document links."""
    return pair_counts(chunk_pairs(aligned(docs, a_json, b_model))).drop("pair")
