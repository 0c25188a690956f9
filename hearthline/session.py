"""Session settings, and the one folder in which runs keep intermediate tables."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Runtime SQL settings every plan here relies on.  AQE splits hot join
# partitions, also where that costs one more shuffle; RocksDB keeps the state
# of the streaming dedup off the heap.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

# Line items become bodies of fifty times their size: a scan task of the usual 128 MB
# would sort several millions of wide listings, and spill.
SPLIT_KEY, SPLIT_MB = "spark.sql.files.maxPartitionBytes", 16

CHECKPOINT_KEY = "spark.checkpoint.dir"


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def limit_splits(spark: SparkSession, mb: int = SPLIT_MB) -> SparkSession:
    """Scan tasks of ``mb`` at most; a lower setting of the session stays."""
    units = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    number, unit = re.fullmatch(r"(\d+)\s*([bkmg]?)b?", spark.conf.get(SPLIT_KEY).strip().lower()).groups()
    if int(number) * units[unit or "b"] > mb << 20:
        spark.conf.set(SPLIT_KEY, f"{mb}m")
    return spark


def build(master: str = "local[*]", app: str = "hearthline", **conf: str) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {"spark.ui.enabled": "false", **SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, as named in ``spark.checkpoint.dir``.

    Only a local session may do without: there driver and executors are one
    process, and one temporary folder serves for as long as it lives.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors share")
        folder = _local_folder()
    return folder.rstrip("/")


@cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="hearthline-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


_run_folders: list[str] = []


def run_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    _run_folders.append(f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}")
    return _run_folders[-1]


def drop_run_folders(spark: SparkSession) -> None:
    """Remove all intermediate tables of this process; for when results are saved.

    A frame that an operator returned may still read them, so only the caller can
    tell when they are done with."""
    while _run_folders:
        drop_folder(spark, _run_folders.pop())


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of ``run_folder`` that nothing reads any more."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
