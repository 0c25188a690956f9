"""The conversation trie against plain Python."""

import hashlib
import random
import zlib

import pytest

from hearthline.llm import prefix_trie
from tests.llm.helpers import words

SCHEMA = "conv_id long, turn long, role string, text string, words string, pos int, depth string"


def rows(seed=3, many=90):
    """Shared beginnings, equal and nested conversations, one long, ties and nulls."""
    rng = random.Random(seed)
    found = []
    for c in range(many):
        if c % 17 == 5:
            continue
        for turn in range(rng.randrange(1, 7)):
            role = "user" if turn % 2 == 0 else "assistant"
            found.append((c, turn, role, rng.choice(["yes", "no", "go on", "one two three"])))
    found += [(200 + c, t, "user", f"turn {t}") for c in range(30) for t in range(5)]  # equal ones
    found += [(300 + c, t, "user", f"turn {t}") for c in range(12) for t in range(c)]  # nested ones
    found += [(400 + c, t, "user", f"turn {t}") for c in (0, 7) for t in range(60 + c)]  # long ones
    found += [(500, None, None, None), (500, 1, "user", ""), (500, 1, "user", "b"), (500, 1, "user", "a"), (500, 1, "user", "a")]
    found += [(501, 0, "user", "long " * 300_000), (-7, 0, "user", "yes"), (None, 0, "user", "lost")]
    found += [(None, None, None, None), (540, 0, "a", "b"), (560, 0, "ab", ""), (-40, 3, "user", "yes")]
    rng.shuffle(found)
    return [(*row, "clash", 1, "clash") for row in found]


def plain_paths(found, rebuilt):
    own = {}
    for c, turn, role, text, *_ in found:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    if not rebuilt:
        return own
    paths = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        paths[c] = own.get(base, [])[:h] + own[c][h:]
    return paths


def plain_trie(paths):
    nodes = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            nodes.setdefault(tuple(path[:d]), []).append(c)
    result = set()
    for path, members in nodes.items():
        below = {p for p in nodes if p[: len(path)] == path}
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(q[: len(p)] == p and len(q) > len(p) for q in below)]
        saved = sum((len(nodes[p]) - 1) * len(words(p[-1][1])) for p in below if p)
        ends = ",".join(str(c) for c in sorted(members) if len(paths[c]) == len(path))
        parent = min(nodes[path[:-1]]) if path else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        result.add((min(members), len(path), parent, len(members), len(children), len(leaves), saved, digest))
    return result


def found_by(df):
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    listed = [tuple(r) for r in df.select(*columns).collect()]
    assert len(listed) == len(set(listed))
    return set(listed)


@pytest.mark.parametrize("crowd", [2, 512])  # most depths by Spark, or all inside tasks
@pytest.mark.parametrize("rebuilt", [False, True])
def test_trie(spark, crowd, rebuilt):
    made = rows()
    if crowd == 2:  # each depth is a job there
        made = [r for r in made if r[0] is None or r[0] < 305 or r[0] > 450]
    frame = spark.createDataFrame(made, SCHEMA).repartition(5)
    operator = prefix_trie.rebuilt_trie if rebuilt else prefix_trie.prefix_trie
    assert found_by(operator(frame, crowd)) == plain_trie(plain_paths(made, rebuilt))


def test_small_buffers(monkeypatch, spark):
    monkeypatch.setattr(prefix_trie, "BUFFER", 5)
    made = rows(seed=4, many=40)
    frame = spark.createDataFrame(made, SCHEMA).repartition(3)
    assert found_by(prefix_trie.prefix_trie(frame)) == plain_trie(plain_paths(made, False))


def test_long_lists_of_ends(monkeypatch, spark):
    monkeypatch.setattr(prefix_trie, "ID_BITS", 3)
    made = [(c, 0, "user", "same", "", 0, "") for c in range(-30, 500)]
    frame = spark.createDataFrame(made, SCHEMA).repartition(7)
    assert found_by(prefix_trie.prefix_trie(frame)) == plain_trie(plain_paths(made, False))


def test_no_conversations(spark):
    assert prefix_trie.rebuilt_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_only_turnless(spark):
    c = next(c for c in range(20, 40) if zlib.crc32(str(c).encode()) % 4 and c != 20)
    frame = spark.createDataFrame([(c, 0, "user", "gone", "", 0, "")], SCHEMA)
    assert [(r.depth, r.n_convs, r.n_leaves) for r in prefix_trie.rebuilt_trie(frame).collect()] == [(0, 1, 1)]
