"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

# Run-time settings every job relies on. Sizes (shuffle partitions, memory) stay with the cluster.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split by AQE, even where that costs one more shuffle afterwards.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Where no shuffled part of one side is larger than this (that of a hot key neither), that side is hashed and the other is not sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # rebalance hints (before writes) may split an oversized partition.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A recursive query may return as many rows as it has; levels stay limited.
    "spark.sql.cteRecursionRowLimit": "-1",
}


def build_session(app: str = "starloom", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above. ``settings`` uses ``__`` for the dots in a name."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for name, value in {**RUNTIME_SETTINGS, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session someone else has made."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a session of a single machine may go without it; it then gets a folder of its own there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return os.path.join(tempfile.gettempdir(), f"starloom-{context.applicationId}")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_folder(spark)}/starloom-{label}-{uuid.uuid4().hex}"


def run_together(jobs: list[Callable[[], object]]) -> list:
    """Run independent Spark jobs at the same time; their results in order."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]
