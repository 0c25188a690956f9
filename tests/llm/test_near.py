"""Rolling hashes and near-duplicates against plain Python."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from helpers import awkward, awkward_rows, empty, words
from hearthline.llm import near, rolling


def test_words_and_hashes():
    texts = [r[1] for r in awkward_rows()] + ["a", " a", "a ", "", None, "a  b"]
    for column in (pa.array(texts), pa.array(texts, pa.large_string()), pa.array(["zz", None, *texts]).slice(2)):
        data, offsets = rolling.text_buffer(column)
        starts, ends, rows = rolling.words_of(data, offsets)
        raw = data.tobytes()
        hashes = rolling.span_hashes(data, starts, ends)
        by_word = {}
        for i, text in enumerate(texts):
            found = [raw[starts[k] : ends[k]].decode() for k in range(rows[i], rows[i + 1])]
            assert found == words(text)
            for k, word in zip(range(rows[i], rows[i + 1]), found):
                assert by_word.setdefault(word, hashes[k]) == hashes[k]
        assert len(set(by_word.values())) == len(by_word)
        windows = rolling.window_hashes(hashes, 5)
        ok = rolling.whole_windows(rows, 5, len(windows))
        assert ok.sum() == sum(max(0, len(words(t)) - 4) for t in texts)


def test_chunks_do_not_change_hashes(monkeypatch):
    data, offsets = rolling.text_buffer(pa.array([r[1] for r in awkward_rows()]))
    starts, ends, _ = rolling.words_of(data, offsets)
    whole = rolling.span_hashes(data, starts, ends)
    monkeypatch.setattr(rolling, "CHUNK", 7)
    assert (rolling.span_hashes(data, starts, ends) == whole).all()


def weighted_jaccard(a, b):
    keys = set(a) | set(b)
    return sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)


def test_signatures_estimate_weighted_similarity():
    rng = random.Random(4)
    for draw in (lambda: 1.0, lambda: float(rng.randrange(1, 9)), lambda: rng.random() * 3 + 0.01):
        sets = [{k: draw() for k in range(60)}]
        for change in (0, 5, 20, 50):
            other = dict(sets[0])
            for k in range(change):
                del other[k]
                other[1000 + k] = draw()
            other[59] = draw()
            sets.append(other)
        sets.append({7: draw()})
        owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        elements = rolling.mix(np.array([k for s in sets for k in s], dtype=np.uint64))
        weights = np.array([w for s in sets for w in s.values()])
        sign = near.dart_signatures(elements, weights, owners, len(sets), 3000)
        assert (sign != 0).all()
        for i in range(len(sets)):
            agree = (sign[0] == sign[i]).mean()
            assert abs(agree - weighted_jaccard(sets[0], sets[i])) < 0.04
        again = near.dart_signatures(elements[owners == 2], weights[owners == 2], np.zeros((owners == 2).sum(), dtype=int), 1, 3000)
        assert (again[0] == sign[2]).all()


def shingles(text):
    found = words(text)
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4)))


def plain_classes(rows, least=0.8):
    """Classes of (id, text) by comparing all pairs."""
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets = [shingles(t) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            if rows[i][1] is None or rows[j][1] is None:
                same = rows[i] == rows[j]
            else:
                both = len(sets[i] & sets[j])
                same = rows[i][1] == rows[j][1] or (both and both >= least * len(sets[i] | sets[j]))
            if same:
                parent[root(i)] = root(j)
    classes = defaultdict(list)
    for i in range(len(rows)):
        classes[root(i)].append(i)
    found = Counter()
    for members in classes.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        for i in members:
            found[rows[i][0], min(ids, default=None), len(members)] += 1
    return found


def classes(df):
    return Counter((r["doc_id"], r["class_id"], r["class_rows"]) for r in df.collect())


def test_near_duplicates(spark):
    rows = [(r[0], r[1]) for r in awkward_rows()]
    assert classes(near.near_duplicates(awkward(spark))) == plain_classes(rows)
    assert near.near_duplicates(empty(spark)).count() == 0


def family(seed, many, edits, size=150):
    """Texts that differ from one base by ``edits`` words each."""
    rng = random.Random(seed)
    base = [f"b{seed}w{i}" for i in range(size)]
    made = []
    for i in range(many):
        text = list(base)
        for k in rng.sample(range(size), edits):
            text[k] = f"e{i}k{k}"
        made.append(" ".join(text))
    return made


def test_families_with_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 4)
    monkeypatch.setattr(near, "TARGETS", 9)
    texts = family(1, 40, 1) + family(2, 40, 2) + family(3, 30, 3) + family(4, 20, 5) + family(5, 10, 15)
    rows = list(enumerate(texts))
    random.Random(1).shuffle(rows)
    got = classes(near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == plain_classes(rows)


def test_keep_one(spark):
    docs = awkward(spark)
    kept = near.keep_one(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    classes = near.near_duplicates(docs).select("class_node").distinct().count()
    assert len(got) == classes
    ids = {r["class_id"] for r in near.near_duplicates(docs).collect()}
    assert {r["doc_id"] for r in got} == ids
    assert near.keep_one(empty(spark)).count() == 0


def test_outsiders_meet_all_others(spark, monkeypatch):
    """Every link across components is found, whatever the blocks."""
    monkeypatch.setattr(near, "BLOCK", 3)
    monkeypatch.setattr(near, "TARGETS", 4)
    texts = family(6, 25, 4, 60) + family(7, 10, 1, 60)
    rows = [(i, 0, len(texts)) for i in range(len(texts))]
    members = spark.createDataFrame(rows, "node long, bucket long, n long")
    labels = spark.createDataFrame([(i, i // 6) for i in range(len(texts))], "node long, label long")
    docs = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    sets = docs.select("node", near.shingle_set(near.F.col("text")).alias("shingles"))
    got = {frozenset(r) for r in near.unlinked_in_buckets(members, labels, sets, 0.5).collect()}
    cut = [shingles(t) for t in texts]
    want = set()
    for i in range(len(texts)):
        for j in range(i):
            if i // 6 != j // 6 and len(cut[i] & cut[j]) >= 0.5 * len(cut[i] | cut[j]):
                want.add(frozenset((i, j)))
    assert got == want and want
