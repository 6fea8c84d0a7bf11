"""Session settings the jobs expect, and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", name: str = "sitegrain", partitions: int = 8) -> SparkSession:
    """A local session for tests and benches; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SITEGRAIN_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Remembering the call site of every column expression costs more than building it.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # Pages are wide rows: keep the Arrow hand-over to Python small.
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
        .getOrCreate()
    )


@lru_cache(maxsize=1)
def _temporary_root() -> str:
    return tempfile.mkdtemp(prefix="sitegrain-")


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for one run below the cluster's shared checkpoint folder.

    The folder is the one named by ``spark.checkpoint.dir``. Only a local session may name none
    (tests, a laptop) and gets a temporary folder of this machine; a cluster's executors could
    not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    root = root or _temporary_root()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"
