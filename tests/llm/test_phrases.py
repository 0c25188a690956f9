"""Phrases of benchmark items in documents, against plain Python."""

import hashlib
import random
import re

from hearthline.llm import phrase_index
from tests.llm.helpers import SCHEMA, awkward_rows

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, doc_id string, row int, pos string, term int, phrase string"


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def tables(seed=5):
    rng = random.Random(seed)
    docs = awkward_rows(seed)
    listed = [terms(row[1]) for row in docs]
    items = []
    for i, found in enumerate(listed[:20]):
        at = rng.randrange(max(1, len(found) - 20))
        items.append((i, " - ".join(found[at : at + rng.randrange(1, 25)]).upper()))
    items += [(50, "la la la la la la la la la la la la"), (51, "la"), (52, "ÉTÉ"), (53, "été"), (54, None), (55, ""), (56, " .,; ")]
    items += [(0, items[1][1]), (57, items[2][1]), (58, items[2][1] + " tail"), (None, items[3][1]), (None, None)]
    items += [(59, " ".join(["nowhere"] * 12)), (60, "w1"), (10, "w2 w3"), (9, "w1 w1")]
    long = "spot " * 200_000 + " ".join(listed[0][:40]) + "!" * 300_000
    docs += [(900, long, "en", "a", 0, "clash", 7, "clash", 3), (901, "la La\x7fLA 日本 W1", None, None, 0, None, 0, None, 0)]
    return docs, [(*row, "clash", 1, "clash", 2, "clash") for row in items]


def plain(docs, items):
    phrases = {}
    for item_id, text, *_ in items:
        found = terms(text)
        for i in range(max(1, len(found) - 9) if found else 0):
            phrases.setdefault(tuple(found[i : i + 10]), set()).add(item_id)
    rows = []
    for doc_id, text, *_ in docs:
        found, hit, named = terms(text), set(), set()
        for n in {len(p) for p in phrases}:
            for i in range(len(found) - n + 1):
                ids = phrases.get(tuple(found[i : i + n]))
                if ids:
                    hit.update(range(i, i + n))
                    named |= ids
        listed = sorted(str(x) for x in named if x is not None)
        digest = hashlib.sha256(",".join(listed).encode()).hexdigest()
        rows.append((doc_id, len(found), len(hit), len(listed), digest, bool(hit)))
    return sorted(rows, key=repr)


def test_decontaminate(spark):
    docs, items = tables()
    found = phrase_index.decontaminate(spark.createDataFrame(docs, SCHEMA).repartition(5), spark.createDataFrame(items, ITEMS))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain(docs, items)


def test_empty_tables(spark):
    docs, items = tables()
    no_docs, no_items = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], ITEMS)
    frame = spark.createDataFrame(docs[:9], SCHEMA)
    assert phrase_index.decontaminate(no_docs, spark.createDataFrame(items, ITEMS)).count() == 0
    found = phrase_index.decontaminate(frame, no_items)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain(docs[:9], [])


def test_near_matches(spark):
    rng = random.Random(8)
    vocabulary = [f"t{i}" for i in range(12)]
    docs = [(i, " ".join(rng.choice(vocabulary) for _ in range(60))) for i in range(40)] + [(90, None), (None, "t1 t2 t3")]
    items = [(i, " ".join(rng.sample(vocabulary, 3))) for i in range(8)] + [(8, "t1 t1"), (9, "t5"), (10, "t1 gone")]
    counts = {t: sum(terms(text).count(t) for _, text in docs) for t in vocabulary}

    def near(text, item, within):
        found, wanted = terms(text), terms(item)
        if any(not counts.get(t) for t in wanted):
            return False
        rare = min(range(len(wanted)), key=lambda k: (counts[wanted[k]], k))
        places = [p for p, t in enumerate(found) if t == wanted[rare]]
        return any(all(t in found[max(0, p - within) : p + within + 1] for t in wanted) for p in places)

    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for within in (1, 4):
        found = phrase_index.near_matches(frame, spark.createDataFrame(items, "item_id long, text string"), within)
        expected = {(d, i) for d, text in docs for i, item in items if near(text, item, within)}
        listed = [tuple(r) for r in found.collect()]
        assert len(listed) == len(set(listed)) and set(listed) == expected


def test_no_python_in_the_plan(spark):
    docs, items = tables()
    frame = phrase_index.decontaminate(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, ITEMS))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan and "Nested" not in plan and "Cartesian" not in plan
