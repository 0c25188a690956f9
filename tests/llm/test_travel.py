"""Functions travel with the job: workers do without this package."""

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from hearthline.session import build
spark = build("local[1]", **{{"spark.sql.shuffle.partitions": "2", "spark.ui.showConsoleProgress": "false"}})
from hearthline.llm import language, lempel_ziv, near, sharding, suffix_buckets, tokens
text = " ".join(f"word{{i}}" for i in range(60))
docs = spark.createDataFrame([(1, text, "en"), (2, text + " more", "de")], "doc_id long, text string, lang string")
assert [r.n_removed for r in lempel_ziv.remove_repeats(docs).orderBy("doc_id").collect()] == [0, 60]
assert suffix_buckets.digest(suffix_buckets.remove_repeats(docs)).where("n_removed > 100").count() == 1
assert near.near_duplicates(docs).select("class_id").distinct().count() == 1
assert sharding.shard_documents(docs, 2).count() == 2
assert language.identify(docs, language.sample_texts(docs)).count() == 2
assert tokens.count_tokens(docs, b"YQ== 0\\nYg== 1", "[ab]").count() == 2
print("done")
"""


def test_workers_do_without_the_package(tmp_path):
    root = str(Path(__file__).parents[2])
    env = {"PATH": "/usr/bin:/bin", "HOME": str(tmp_path)}
    env |= {k: v for k, v in os.environ.items() if k in ("PATH", "JAVA_HOME", "LD_LIBRARY_PATH", "SPARK_LOCAL_IP")}
    made = subprocess.run([sys.executable, "-c", SCRIPT.format(root=root)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "done" in made.stdout, made.stderr[-2000:]
