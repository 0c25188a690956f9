"""Fixtures and plain-Python statements of the contracts."""

import random
import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parents[2]))

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, bucket int, key string, size long"


def words(text):
    return WORD.findall(text or "")


def awkward_rows(seed=1, many=60):
    """Nulls in every column, empty, long and repeated texts, ties, clashing names."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["été", "naïve", "日本", "😀"]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    rows = []
    for i in range(many):
        body = " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(5, 200)))
        if i % 4 == 0:
            body += "\n" + passage + "\n" + body[:50]
        if i % 9 == 0:
            body += ". " + body
        rows.append((i, body, rng.choice(["en", "fr", "de", None]), rng.choice(["b", "a", "a", "c", None, ""])))
    rows += [(many + i, rows[3][1], "en", "a") for i in range(6)]  # exact copies
    near = rows[4][1].split(" ")
    for i in range(6):  # near copies
        near[7 * i % len(near)] = f"x{i}"
        rows.append((many + 10 + i, " ".join(near), "en", "a"))
    rows += [(many + 20, None, None, None), (many + 21, "", "en", "a"), (many + 22, " \n\t ", "en", "b")]
    rows += [(many + 23, " ".join(rng.choice(vocabulary) for _ in range(9000)), "en", "c")]
    rows += [(many + 24, "ab" * 400, "de", "a"), (many + 25, "la la " * 300, "de", "a")]
    rows += [(5, rows[5][1], rows[5][2], rows[5][3])] * 2  # repeated rows
    rows += [(6, "same id, another text " + passage, "fr", "b"), (None, passage, "en", "a"), (None, None, None, None)]
    rng.shuffle(rows)
    return [(*row, len(row[1] or ""), "clash", 7, "clash", 3) for row in rows]


def awkward(spark, seed=1, many=60):
    return spark.createDataFrame(awkward_rows(seed, many), SCHEMA).repartition(5)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
