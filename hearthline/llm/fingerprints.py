"""Homomorphic multiset fingerprints of documents, natively.

A text is a multiset of paragraphs (runs between line breaks or sentence ends).
Each paragraph is hashed to a wide vector of ``LANES`` bits and a 1; the
fingerprint is the sum of the vectors.  The order of the
paragraphs does not matter, and a paragraph is put in or taken out by adding or
subtracting its vector, without the text.

Two uses: equal fingerprints mean equal multisets, but for a chance of about
2^-128 (no proof against texts built to collide); and lanes less half the number of
paragraphs are sums of random signs, so that the cosine of two fingerprints
estimates the share of paragraphs in common, with a standard error near
1 / sqrt(LANES), 0.09, which is 0 for equal texts.

Three lanes of 20 bits are packed into a word, and words are added modulo 2^60.
Beyond a million paragraphs a lane runs over into its neighbour: sums stay exact,
but the likeness of such texts is no estimate any more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.llm.common import let, shuffle_partitions, written

PARAGRAPH_END = r"(?<=[.!?])[\x20\x09-\x0D]+|\n+"
FIELD, FIELDS, SEEDS = 20, 3, 2  # bits of a lane, lanes of a word, hashes of a paragraph
SHIFTS = FIELD  # each hash gives a word for each shift of its bits
WORDS = SHIFTS * SEEDS
LANES = FIELDS * WORDS
ONES = sum(1 << (FIELD * i) for i in range(FIELDS))
LIMIT = (1 << (FIELD * FIELDS)) - 1
LANE_LIMIT = (1 << FIELD) - 1
WORD_HEX = FIELD * FIELDS // 4


def paragraphs(text: Column) -> Column:
    """The paragraphs of a text that are not empty; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), PARAGRAPH_END), lambda p: p != "")


def shifted_sum(hashes: Column, shift: int) -> Column:
    """The word of one shift, summed over the paragraphs' hashes."""

    def add(total, h):
        return (total + F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(ONES))).bitwiseAND(F.lit(LIMIT))

    return F.aggregate(hashes, F.lit(0).cast("long"), add)


def vector(text: Column) -> Column:
    """The fingerprint as an array of longs: the number of paragraphs, then the words."""

    def words(parts, seed):
        hashes = F.transform(parts, lambda p: F.xxhash64(p, F.lit(seed)))
        return let(hashes, lambda found: F.array(*[shifted_sum(found, i) for i in range(SHIFTS)]))

    def of_parts(parts):
        return F.concat(F.array(F.size(parts).cast("long")), *[words(parts, seed) for seed in range(SEEDS)])

    return let(paragraphs(text), of_parts)


def combine(left: Column, right: Column, sign: int = 1) -> Column:
    """The vector of both multisets together, or (sign -1) of what is left when the
    right one is taken out of the left."""

    def word(a, b):
        return (a + sign * b).bitwiseAND(F.lit(LIMIT))

    words = F.zip_with(F.slice(left, 2, WORDS), F.slice(right, 2, WORDS), word)
    return F.concat(F.array(F.get(left, F.lit(0)) + sign * F.get(right, F.lit(0))), words)


def to_text(words: Column) -> Column:
    """A vector as text: the number of paragraphs, then the words in hexadecimal."""
    hexes = F.transform(F.slice(words, 2, WORDS), lambda w: F.lpad(F.lower(F.hex(w)), WORD_HEX, "0"))
    return F.concat(F.get(words, F.lit(0)).cast("string"), F.lit(":"), F.array_join(hexes, ""))


def signs(words: Column) -> Column:
    """The lanes as sums of signs: twice the count of ones less the paragraphs."""

    def lanes(found, shift):
        def sign(word):
            return (2 * F.shiftrightunsigned(word, shift).bitwiseAND(F.lit(LANE_LIMIT)) - F.get(found, F.lit(0))).cast("double")

        return F.transform(F.slice(found, 2, WORDS), sign)

    def of(found):
        return F.concat(*[lanes(found, FIELD * i) for i in range(FIELDS)])

    return let(words, of)


def likeness(left: Column, right: Column) -> Column:
    """0 to 1: the cosine of two vectors' lanes, 1 for equal ones, empty ones too."""

    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    both = let(
        F.struct(signs(left).alias("a"), signs(right).alias("b")),
        lambda s: let(
            F.struct(dot(s["a"], s["b"]).alias("ab"), dot(s["a"], s["a"]).alias("aa"), dot(s["b"], s["b"]).alias("bb")),
            lambda d: F.when((d["aa"] > 0) & (d["bb"] > 0), d["ab"] / F.sqrt(d["aa"] * d["bb"])).otherwise(F.lit(0.0)),
        ),
    )
    return F.when(left == right, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), both)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint of every whole text; needs doc_id and text.

    A null text counts as empty, and both have no paragraph.  Repeated rows come
    back as often as they are there.  No shuffle.
    """
    return docs.select("doc_id", to_text(vector(F.col("text"))).alias("fingerprint"))


def order_id(doc_id: Column) -> Column:
    """The id to order and join by: a null one is below all others."""
    return F.coalesce(doc_id.cast("long"), F.lit(-(1 << 63)))


def next_documents(ids: DataFrame, bins: int) -> DataFrame:
    """``ids`` (id, mark; distinct, no nulls) with ``next_id``, ``next_mark``: the row
    after it by descending id, the first after the last.

    Rows are dealt to ranges of the order; only one row of each range meets those
    of the others, so no task sees all ids.
    """
    order = [F.col("id").desc(), F.col("mark").desc()]
    ranged = ids.repartitionByRange(bins, *order).select("id", "mark", F.spark_partition_id().alias("bin"))
    ranged = written(ranged, "next-ids")
    inside = Window.partitionBy("bin").orderBy(*order)
    row = F.struct("id", "mark")
    found = ranged.select("id", "mark", "bin", F.lead(row).over(inside).alias("next"), F.row_number().over(inside).alias("place"))
    found = written(found, "next-found")
    heads = found.where("place = 1").select("bin", F.struct("id", "mark").alias("head"))
    # one row per range: the head of the range after it, of the first for the last
    ring = Window.partitionBy(F.lit(0)).orderBy("bin")
    first = F.first("head").over(ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    after = heads.select("bin", F.coalesce(F.lead("head").over(ring), first).alias("after"))
    joined = found.join(after, "bin").select("id", "mark", F.coalesce("next", "after").alias("next"))
    return joined.select("id", "mark", F.col("next.id").alias("next_id"), F.col("next.mark").alias("next_mark"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Every document beside its edited text and beside the next document.

    The edited text replaces the last third of the code points (rounded down) by as
    many first ones of the next document by descending id, or all it has.  Returns
    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next.

    Rows are told apart by id and text: a row repeated with both is one document
    and comes back as often as it is there; rows that share only the id are next to
    each other in the order of a hash of their text.  A null text is an empty one,
    a null id comes last.  One document is next to itself.  An empty table gives no
    rows.  Texts are shuffled once, by id, and that shuffle serves both joins: only
    the part of the next text that is needed travels to its reader.
    """
    text = F.coalesce("text", F.lit(""))
    told = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("mark"))
    n_chars = F.char_length("text").cast("long")
    third = F.floor(n_chars / 3).cast("int")
    ids = told.select(order_id(F.col("doc_id")).alias("id"), "mark", third.alias("need")).distinct()
    ids = written(ids, "fingerprint-ids")
    after = next_documents(ids.select("id", "mark"), shuffle_partitions(docs.sparkSession))
    wanted = after.join(ids, ["id", "mark"]).select(F.col("id").alias("to_id"), F.col("mark").alias("to_mark"), "next_id", "next_mark", "need")
    wanted = written(wanted, "fingerprint-wanted")
    # both joins ask for the same columns of the same rows, so they share one shuffle
    full = told.withColumn("vector", vector(F.col("text")))
    key = order_id(F.col("doc_id"))
    given = full.join(wanted, (key == F.col("next_id")) & (F.col("mark") == F.col("next_mark"))).select(
        "to_id", "to_mark", F.when(F.col("need") > 0, F.left("text", "need")).otherwise("").alias("tail"), F.col("vector").alias("next_vector")
    )
    given = given.dropDuplicates(["to_id", "to_mark"])
    joined = full.join(given, (key == F.col("to_id")) & (F.col("mark") == F.col("to_mark")))
    keep = F.char_length("text") - third
    kept = F.when(keep > 0, F.left("text", keep)).otherwise("")
    edited = joined.select("doc_id", n_chars.alias("n_chars"), "vector", "next_vector", F.concat(kept, "tail").alias("edited"))
    measured = edited.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        "vector",
        "next_vector",
        vector(F.col("edited")).alias("edited_vector"),
    )
    return measured.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        to_text(F.col("vector")).alias("fingerprint"),
        to_text(F.col("edited_vector")).alias("edited_fingerprint"),
        likeness(F.col("vector"), F.col("edited_vector")).alias("near_edited"),
        likeness(F.col("vector"), F.col("next_vector")).alias("near_next"),
    )
