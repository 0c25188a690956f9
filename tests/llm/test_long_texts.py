"""Texts of millions of equal characters, for the tokenizer."""

import random
from pathlib import Path

import pytest

from hearthline.llm import tokens

RANKS = Path("/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
pytestmark = pytest.mark.skipif(not RANKS.exists(), reason="no tokenizers")


def test_cut_runs_encode_alike():
    coder, rng = tokens.encoding(RANKS.read_bytes(), tokens.PATTERN), random.Random(4)
    for blank in (" ", "\n", "\t\x0b", "  ", " \r\n"):
        for before in ("", "word", "don't ", "12", "!?", "\x1c", "été\n"):
            for after in ("", "x", "'s end", " y", "\x1f", "?", "\n"):
                run = "".join(rng.choice(blank) for _ in range(tokens.LONG_RUN + rng.randrange(3)))
                text = before + run + after + "tail " + run
                assert tokens.encode_text(coder, text) == coder.encode_ordinary(text)


def test_millions_of_one_character(spark):
    many = 5_000_000
    texts = [" " * many, "\n" * many, "a" * many, "x" + " " * many + "y", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r.doc_id: r.n_tokens for r in tokens.count_tokens(docs, RANKS.read_bytes()).collect()}
    coder = tokens.encoding(RANKS.read_bytes(), tokens.PATTERN)
    assert found[4] == found[5] == 0
    for i, text in enumerate(texts[:3]):
        assert found[i] == len(coder._encode_single_piece(text))
    assert found[3] == 1 + len(coder._encode_single_piece(" " * (many - 1))) + len(coder.encode_ordinary(" y"))
