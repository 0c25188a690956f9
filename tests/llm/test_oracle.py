"""The registered queries against their SQL, and the shapes of their results."""

import os

import pytest

import check
from hearthline.llm.oracle import ORACLE
from hearthline.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

COLUMNS = {
    "op1_substrings": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    "op2_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op3_suffix_buckets": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op4_quality": {
        "doc_id": "bigint",
        **dict.fromkeys(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), "bigint"),
        **dict.fromkeys(("base_failed", "kept"), "boolean"),
    },
    "op6_language": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op9_sharding": {
        "doc_id": "bigint",
        "size": "bigint",
        "text_crc32": "bigint",
        "law": "string",
        "shard": "int",
        "slot": "bigint",
        "grown_shard": "int",
    },
    "op10_fingerprints": {
        "doc_id": "bigint",
        "n_chars": "bigint",
        **dict.fromkeys(("edited_sha256", "fingerprint", "edited_fingerprint"), "string"),
        **dict.fromkeys(("near_edited", "near_next"), "double"),
    },
    "op11_prefix_trie": {
        **dict.fromkeys(("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"), "bigint"),
        "ends_sha256": "string",
    },
    "op12_alignment": {
        **dict.fromkeys(("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"), "bigint"),
        "groups_sha256": "string",
    },
    "op13_decontamination": {
        **dict.fromkeys(("doc_id", "n_words", "n_hit", "n_items"), "bigint"),
        "items_sha256": "string",
        "contaminated": "boolean",
    },
}


@pytest.mark.parametrize("name", list(ORACLE))
def test_sql(spark, name):
    outcome = check.compare(spark, SF_DIR, name)
    assert outcome.startswith("same"), outcome


def test_one_query_per_operator():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]


@pytest.mark.parametrize("name", list(COLUMNS))
def test_columns(spark, name):
    found = dict(QUERIES[name](spark, SF_DIR).dtypes)
    assert {k: found.get(k) for k in COLUMNS[name]} == COLUMNS[name]
