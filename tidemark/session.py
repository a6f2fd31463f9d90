"""Session defaults and the shared work folder."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cache
from typing import TypeVar

from pyspark.sql import SparkSession

T = TypeVar("T")

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    STATE_STORE: ROCKSDB,
    # The older 96-bit form has no statistics, so readers could not skip by a timestamp.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.ui.enabled": "false",
}

#: Seconds from one time that shuffled data are let go to the next, at least.
LET_GO_EVERY = 5.0
_let_go_at = float("-inf")


def build_session(name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def stateful_session(spark: SparkSession, parallelism: int | None = None) -> SparkSession:
    """A session of the same application for streams that keep state.

    ``parallelism`` is the number of shuffle and state partitions of the streams started in it.
    It is fixed with a stream's first batch (the checkpoint keeps it) and cannot be coalesced
    later, so unless given it follows the cluster's cores. State spills to local disk through
    RocksDB instead of filling the heap.
    """
    session = spark.newSession()
    session.conf.set(
        "spark.sql.shuffle.partitions", parallelism or spark.sparkContext.defaultParallelism)
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    session.conf.set(STATE_STORE, ROCKSDB)
    # State lies on the disks twice, where it is kept and in the checkpoint, in two versions.
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.compression", "zstd")
    return session


def at_once(*steps: Callable[[], T]) -> list[T]:
    """Run steps that do not depend on each other side by side; their results.

    The cluster works on the jobs of all of them together. If any fail, the first error is
    raised once all have come to an end.
    """
    with ThreadPoolExecutor(len(steps)) as pool:
        return [done.result() for done in [pool.submit(step) for step in steps]]


def let_go(spark: SparkSession) -> None:
    """Have what was shuffled for results that are written by now deleted from the executors' disks.

    Spark deletes it once the driver has collected its last mention; left alone, a driver with memory
    to spare collects too seldom, and all that a job has ever shuffled stays on the disks. Short steps
    shuffle little: it is done every few seconds at most.
    """
    global _let_go_at
    if time.monotonic() - _let_go_at > LET_GO_EVERY:
        gc.collect()  # mentions that Python holds
        for _ in range(2):  # what is found to be dropped the first time goes with the second
            spark._jvm.java.lang.System.gc()
        _let_go_at = time.monotonic()


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder for written intermediate tables, stream progress and results.

    It lies in the shared folder named by ``spark.checkpoint.dir``, so that every
    executor can reach it and a lost executor loses nothing. Only a local-mode
    session without that setting falls back to the machine's own temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = _local_folder()
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")
