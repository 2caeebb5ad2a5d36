"""Session construction, the shared work folder, and running independent jobs side by side."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import cache
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

A, B = TypeVar("A"), TypeVar("B")

CHECKPOINT_DIR = "spark.checkpoint.dir"

BASE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Shuffles start with many partitions and are coalesced at run time; rebalanced
# writes aim at files of a few hundred megabytes rather than the default 64.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.scheduler.mode": "FAIR",
    # Statistics of the registered layers reach the planner.
    "spark.sql.cbo.enabled": "true",
}


def build_session(app: str = "riskmart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; keyword settings use ``__`` for dots.

    Unless the master is local, the settings for large clusters apply as well.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    local = bool(master) and master.startswith("local")
    settings = BASE_SETTINGS if local else BASE_SETTINGS | CLUSTER_SETTINGS
    settings = settings | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_folder() -> tempfile.TemporaryDirectory:
    """Removed when the process ends."""
    return tempfile.TemporaryDirectory(prefix="riskmart-", ignore_cleanup_errors=True)


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder of the cluster.

    The shared folder is the session's ``spark.checkpoint.dir``. Only a local
    session without that setting falls back to a temporary folder, since files
    written there by remote executors could not be read back.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        base = _local_folder().name
    return f"{base.rstrip('/')}/riskmart/{label}-{uuid.uuid4().hex}"


def side_by_side(spark: SparkSession, job: Callable[[A], B], items: Iterable[A]) -> list[B]:
    """Run one independent Spark job per item at the same time, so that the tail of one
    table leaves no executors idle. The first failure is raised once all have ended."""
    items = list(items)
    with ThreadPoolExecutor(max_workers=max(1, len(items))) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(job), i) for i in items]]
