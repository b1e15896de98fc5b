"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int = 8, app: str = "prefloom", memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        # no stack walk per column call while building plans
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder for an intermediate table.

    It lies under ``spark.checkpoint.dir``, which every executor can reach. Only
    a local master, where driver and tasks share one machine, may do without that
    setting; its folder goes when the process ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@functools.cache
def _local_folder() -> str:
    base = tempfile.mkdtemp(prefix="prefloom-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    return base
