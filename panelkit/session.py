"""Session helpers for tests, the bench and the end-to-end study run.

Library operators never configure the session; only entry points do. The one
exception ends with the write it is made for (``shuffles_dropped``).
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(master: str | None = None, app: str = "panelkit",
                  shuffle_partitions: int = 8, driver_memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(master or "local[8]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # HotSpot does not JIT methods above 8000 bytes of bytecode; above
        # that, per-operator codegen (split methods) beats one huge method
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """A write in this block, or a query over a frame made in it, drops its shuffle files
    when it ends. Otherwise they lie on the executors' disks until the driver happens to collect
    its garbage, those of all steps beside each other. A setting the session already has is kept."""
    old = spark.conf.get(SHUFFLE_CLEANUP, None)
    if old is not None:
        yield
        return
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP)


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A deployment sets it to storage that all executors share; without it this
    raises. Only a local session (one machine) falls back to ``fallback`` or
    a fresh temporary folder.
    """
    cur = spark.conf.get("spark.checkpoint.dir", None)
    if not cur:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        cur = fallback or tempfile.mkdtemp(prefix="panelkit-ckpt-")
        spark.conf.set("spark.checkpoint.dir", cur)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(cur)
    return cur
