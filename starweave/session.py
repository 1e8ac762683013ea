"""Session helpers: a local session for tests/bench and the shared work folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "starweave") -> SparkSession:
    """Local session used by tests and the bench (the cluster supplies its own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("STARWEAVE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # single-machine tables are one small file each: smaller splits keep all cores reading
        .config("spark.sql.files.maxPartitionBytes", "4m")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Only a local session, whose executor is the driver, gets a scratch folder
    of its own when nothing is set. Anywhere else that folder would be a
    different one on every machine, so a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set: intermediates need a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="starweave-ckpt-")
        atexit.register(shutil.rmtree, conf_dir, ignore_errors=True)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written intermediates.

    Spark gives each application a folder of its own in the checkpoint folder, so
    what an application wrote can be removed as a whole when it has ended.
    """
    base = ensure_checkpoint_dir(spark)
    suffix = os.urandom(6).hex()
    return f"{base.rstrip('/')}/{name}-{suffix}"


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is executed inside gives its shuffle files back when it has ended, for a chain of writes that each read files.

    Spark keeps them otherwise until the driver happens to collect its garbage, so that a chain
    holds the shuffles of all its steps. Older versions of Spark ignore the setting.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
