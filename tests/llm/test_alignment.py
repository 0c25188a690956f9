"""Aligned tokens against plain Python, and the walk against all cuts."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from hearthline.llm import alignment
from tests.llm.helpers import SCHEMA, awkward_rows

FILES = Path("/opt/tokenizers")
A, B = FILES / "byte_bpe_50k.json", FILES / "piece_bpe_32k.model"
needs_files = pytest.mark.skipif(not A.exists(), reason="no tokenizers")


def plain_groups(ends_a, ends_b):
    cuts = sorted(set(ends_a) & set(ends_b))
    groups, low = [], 0
    for cut in cuts:
        groups.append(([i for i, e in enumerate(ends_a) if low < e <= cut], [j for j, e in enumerate(ends_b) if low < e <= cut]))
        low = cut
    return groups


def test_walk():
    rng = random.Random(2)
    for trial in range(400):
        total = rng.randrange(1, 120)
        kept = rng.choice([0.1, 0.5, 0.9, 1.0])
        cuts = [c for c in range(1, total) if rng.random() < kept]
        ends_a = [c for c in cuts if rng.random() < 0.9] + [total]
        ends_b = [c for c in cuts if rng.random() < 0.9] + [total]
        expected, found = plain_groups(ends_a, ends_b), []
        for straight, i, to_a, j, to_b in alignment.align(ends_a, ends_b):
            if straight:
                assert to_a - i == to_b - j
                found += [([i + k], [j + k]) for k in range(to_a - i)]
            else:
                found.append((list(range(i, to_a)), list(range(j, to_b))))
        assert found == expected
        ids_a, ids_b = [7 * i % 1200 for i in range(len(ends_a))], [13 * j % 1100 for j in range(len(ends_b))]
        starts_a, starts_b = [0, *ends_a], [0, *ends_b]
        shared = [
            (ids_a[i], ids_b[j])
            for i in range(len(ends_a))
            for j in range(len(ends_b))
            if max(starts_a[i], starts_b[j]) < min(ends_a[i], ends_b[j])
        ]
        sides = [np.array(x) for x in (ids_a, ids_b, ends_a, ends_b)]
        of_a, of_b = alignment.linked(*sides)
        assert sorted(zip(of_a.tolist(), of_b.tolist(), strict=True)) == sorted(shared)
        text = alignment.group_text(*sides[:2], *alignment.group_ends(*sides[2:])).decode()
        assert text.split(";") == [",".join(str(ids_a[i]) for i in a) + "|" + ",".join(str(ids_b[j]) for j in b) for a, b in expected]


def plain_documents(docs):
    import sentencepiece
    from tokenizers import Tokenizer, decoders

    first = Tokenizer.from_file(str(A))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=str(B))
    values = alignment.byte_values()
    rows, holding = [], Counter()
    for doc_id, text, *_ in docs:
        whole = b" " + text.encode() if text else b""
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        bytes_a = [bytes(values[c] for c in first.id_to_token(x)) for x in a]
        bytes_b = [bytes([int(second.id_to_piece(x)[3:5], 16)]) if second.is_byte(x) else second.id_to_piece(x).replace("▁", " ").encode() for x in b]
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            a, b, bytes_a, bytes_b = [], [], [], []
        owner = [[i for i, x in enumerate(side) for _ in x] for side in (bytes_a, bytes_b)]
        linked = list(dict.fromkeys(zip(*owner, strict=True)))
        pairs = [(a[i], b[j]) for i, j in linked]
        holding.update(set(pairs))
        groups, ga, gb, na, nb = [], [], [], 0, 0
        ia = ib = 0
        ends_a, ends_b = [], []
        for x in bytes_a:
            na += len(x)
            ends_a.append(na)
        for x in bytes_b:
            nb += len(x)
            ends_b.append(nb)
        both = set(ends_a) & set(ends_b)
        for cut in sorted(both):
            ga, gb = [], []
            while ia < len(a) and ends_a[ia] <= cut:
                ga.append(a[ia])
                ia += 1
            while ib < len(b) and ends_b[ib] <= cut:
                gb.append(b[ib])
                ib += 1
            groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
        rows.append((doc_id, len(a), len(b), groups, pairs))
    most = defaultdict(int)
    for (x, _), n in holding.items():
        most[x] = max(most[x], n)
    result = []
    for doc_id, n_a, n_b, groups, pairs in rows:
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        best = sum(holding[p] == most[p[0]] for p in pairs)
        result.append((doc_id, n_a, n_b, len(groups), len(pairs), best, sum(holding[p] for p in pairs), digest))
    return sorted(result, key=repr)


def odd_rows():
    texts = [
        "<|endoftext|> and <s> </s> <unk> [INST] <0x41>",
        "a▁b",
        "tab\tline\n\n  double  spaces \r\n end ",
        " leading",
        "😀👨‍👩‍👧 日本語 ﬁ ½   ​",
        "é é",
        "\x00\x01 nul",
        "x",
        " ",
        "   ",
    ]
    return [(800 + i, t, None, None, 0, "clash", 1, "clash", 2) for i, t in enumerate(texts)]


@needs_files
def test_documents(monkeypatch, spark):
    docs = awkward_rows(7) + odd_rows()
    frame = spark.createDataFrame(docs, SCHEMA).repartition(3)
    found = alignment.align_documents(frame, A.read_bytes(), B.read_bytes())
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_documents(docs)


@needs_files
def test_many_chunks(monkeypatch, spark):
    monkeypatch.setattr(alignment, "CHUNK", 3000)
    docs = awkward_rows(9)
    frame = spark.createDataFrame(docs, SCHEMA).repartition(2)
    found = alignment.align_documents(frame, A.read_bytes(), B.read_bytes())
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_documents(docs)


@needs_files
def test_long_runs(spark):
    texts = [" " * 1_000_000, "\n" * 1_000_000, "a" * 300_000, "word " * 200_000]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {r.doc_id: r for r in alignment.align_documents(frame, A.read_bytes(), B.read_bytes()).collect()}
    assert len(found) == 4 and found[3].n_a > 200_000 and found[3].n_groups > 200_000


@needs_files
def test_empty_table(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert alignment.align_documents(frame, A.read_bytes(), B.read_bytes()).count() == 0


@needs_files
def test_words_are_encoded_once(monkeypatch):
    encode, token_bytes = alignment.piece_encoder(B.read_bytes())
    asked = []
    ids_of = alignment.by_words(lambda text: asked.append(text) or encode(text), token_bytes)
    texts = ["one word and one more", "and more of one word", "word", "ends\n here;\r ", "two  spaces", "a▁b one", "a▁b", "\tone\n"]
    texts += [row[1] for row in awkward_rows(13) + odd_rows() if row[1]]
    for kept in (alignment.KEPT, 20):
        monkeypatch.setattr(alignment, "KEPT", kept)
        for text in texts * 2:
            found, whole = ids_of(text), encode(text)
            same = b"".join(token_bytes[x] for x in whole) == b" " + text.encode()
            assert (None if found is None else found.tolist()) == (whole if same else None)
    assert sorted(asked[0].split()) == ["and", "more", "one", "word"] and asked[1:3] == ["of", "ends\n here;\r "]


@needs_files
def test_pieces_that_reach_into_the_next_word():
    def encode(text):  # "b c" is one piece of this tokenizer
        return [{"b c": 1, " ": 0, "a": 2, "b": 3, "c": 4}[x] for x in re.findall("b c|.", " " + text)]

    ids_of = alignment.by_words(encode, [b" ", b"b c", b"a", b"b", b"c"])
    assert ids_of("a b").tolist() == encode("a b") and ids_of("a b c").tolist() == encode("a b c") == [0, 2, 0, 1]


@needs_files
def test_both_ways_to_encode():
    import json

    described = json.loads(A.read_bytes())
    described["model"]["merges"] = described["model"]["merges"][::-1][:1] + described["model"]["merges"]  # no longer in order
    fast, bytes_a = alignment.byte_encoder(A.read_bytes())
    for row in awkward_rows(11)[:30] + odd_rows():
        text = " " + (row[1] or "")
        assert b"".join(bytes_a[x] for x in fast(text)) == text.encode()
        assert fast(text) == _own_library(text)
    slow, _ = alignment.byte_encoder(json.dumps(described).encode())
    assert slow.__name__ == "slow"


def _own_library(text):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(str(A))
    whole.encode_special_tokens = True
    return whole.encode(text, add_special_tokens=False).ids
