"""Session defaults and the shared working folder."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "kilnmark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and the zone pinned.

    Sizes (shuffle partitions, memory, executors) stay with spark-submit; with
    adaptive execution a generous shuffle partition count is merged at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        # State on local disk with changes logged to the checkpoint, not on the heap.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        base = os.path.join(tempfile.gettempdir(), "kilnmark-shared")
        spark.conf.set("spark.checkpoint.dir", base)
        return base
    raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder (not created)."""
    return f"{shared_dir(spark)}/kilnmark/{label}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution on, whatever the session says; as before at the end."""
    name = "spark.sql.adaptive.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def adaptive_sink(sink: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """``sink`` for ``foreachBatch`` with adaptive execution, which streams turn off for their own plans.

    Without it the rebalance hint does nothing, and every task writes a file into every partition it has rows of.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        with adaptive(batch.sparkSession):
            sink(batch, batch_id)
    return run
