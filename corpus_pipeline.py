"""Documents to training batches: quality, near-duplicates, substrings, mix, packing.

Each stage works on all that the one before kept, read again from Parquet:

1. documents that the quality rules reject go;
2. of each class of near-duplicates the document of the least id stays;
3. words in windows of 20 that also start earlier go from the texts;
4. sources are mixed to their target weights: documents are there as often as the
   mix takes them, once more cut short where it takes them in part;
5. the mix is packed into length buckets and batches.
"""

from __future__ import annotations

from hearthline.llm import lempel_ziv, mixing, near, packing, quality
from hearthline.llm.common import written


def quality_rules(spark, docs, sf_dir):
    return quality.keep_good(docs)


def near_duplicates(spark, docs, sf_dir):
    return near.keep_one(docs)


def substring_dedup(spark, docs, sf_dir):
    return lempel_ziv.cut_documents(docs)


def mix_sources(spark, docs, sf_dir):
    return mixing.mixed_documents(docs)


def pack_batches(spark, docs, sf_dir):
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_duplicates),
    ("substring dedup", substring_dedup),
    ("mixing sources", mix_sources),
    ("packing", pack_batches),
]

# Signatures, parsing and the choice of boundaries are no SQL; the tests hold the
# stages against plain Python.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
