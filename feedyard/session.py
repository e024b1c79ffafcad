"""Session helpers: a local session for tests/bench and the shared work folder.

On a cluster the session comes from the platform; the only thing we read
from it is ``spark.checkpoint.dir``, the shared folder used for lineage cuts,
landed fixtures and published tables. A folder of our own is set only when
the session has none (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

UTC = "UTC"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "feedyard") -> SparkSession:
    """A local session configured like the cluster one (AQE on, UTC, no UI)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", UTC)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("FEEDYARD_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> None:
    """Pin the session zone: every epoch conversion in this package assumes UTC."""
    spark.conf.set("spark.sql.session.timeZone", UTC)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared work folder (``spark.checkpoint.dir``).

    A local session without one gets a fresh local folder; a cluster session
    must name one, since executors could not see each other's local files.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or _LOCAL_DIRS.get(id(spark))
    if not configured:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="feedyard-ckpt-")
        _LOCAL_DIRS[id(spark)] = configured
    return configured.rstrip("/")


_LOCAL_DIRS: dict[int, str] = {}


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A new, unique folder under the shared work folder (never reused)."""
    return f"{shared_dir(spark)}/feedyard/{kind}/{uuid.uuid4().hex}"
