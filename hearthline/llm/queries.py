"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from hearthline.llm import (
    alignment,
    fingerprints,
    language,
    lempel_ziv,
    mixing,
    near,
    packing,
    phrase_index,
    prefix_trie,
    quality,
    sharding,
    suffix_buckets,
    tokens,
)
from hearthline.testframes import table

QUERIES = {}
TOKENIZERS = "/opt/tokenizers"


def query(build):
    QUERIES[build.__name__] = build
    return build


def documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


@query
def op1_substrings(spark, sf_dir):
    """All documents without the words of repeated windows of 20 words."""
    return lempel_ziv.digest(lempel_ziv.remove_repeats(documents(spark, sf_dir)))


@query
def op2_mixing(spark, sf_dir):
    """All documents mixed: sources weigh 5, 2, 1 in turn and give 3 epochs at most."""
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


@query
def op3_suffix_buckets(spark, sf_dir):
    """All documents without the bytes of repeated strings of 100 bytes."""
    return suffix_buckets.digest(suffix_buckets.remove_repeats(documents(spark, sf_dir)))


@query
def op4_quality(spark, sf_dir):
    """All documents under the base rules and the limits of their language and source."""
    return quality.quality(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op5_packing(spark, sf_dir):
    """All documents in 16 length buckets, in batches of 16,384 words."""
    return packing.pack(documents(spark, sf_dir))


@query
def op6_language(spark, sf_dir):
    """The language of all documents, learned from those that are not held out."""
    docs = documents(spark, sf_dir)
    texts = language.sample_texts(docs.where(~language.held_out(F.col("doc_id"))))
    found = language.identify(docs, texts)
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


@query
def op7_token_counts(spark, sf_dir):
    """Tokens of all documents, from the separators of their token stream."""
    ranks = Path(TOKENIZERS, "byte_bpe_multi_50k.tiktoken").read_bytes()
    return tokens.count_tokens(documents(spark, sf_dir), ranks)


@query
def op8_near_duplicates(spark, sf_dir):
    """All documents with the class of near-duplicates they are in."""
    return near.near_duplicates(documents(spark, sf_dir)).select("doc_id", "class_id", "class_rows")


@query
def op9_sharding(spark, sf_dir):
    """All documents in 40 shards of nearly equal bytes."""
    return sharding.shard_documents(documents(spark, sf_dir), 40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op10_fingerprints(spark, sf_dir):
    """All documents, each beside its edited text and the next document."""
    return fingerprints.edited_fingerprints(documents(spark, sf_dir))


@query
def op11_prefix_trie(spark, sf_dir):
    """The trie of all conversations, each rebuilt on the head of its group."""
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


@query
def op12_alignment(spark, sf_dir):
    """The tokens of all documents by two tokenizers, aligned, with corpus-wide counts."""
    a_json = Path(TOKENIZERS, "byte_bpe_50k.json").read_bytes()
    b_model = Path(TOKENIZERS, "piece_bpe_32k.model").read_bytes()
    return alignment.align_documents(documents(spark, sf_dir), a_json, b_model)


@query
def op13_decontamination(spark, sf_dir):
    """All documents with the words that windows of ten words of benchmark items cover."""
    return phrase_index.decontaminate(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
