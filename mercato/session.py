"""Session settings the library expects, and the folder for written intermediates."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# AQE re-plans joins from real shuffle sizes, splits skewed partitions of
# sort-merge joins and merges small ones. The session zone is UTC so that
# zoned "now" values and the zone-less event times of the data compare.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def local_session(cores: int | str = 8, app_name: str = "mercato", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    settings = {
        **SESSION_CONF,
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": str(cores),
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession, label: str, folder: str | None = None) -> str:
    """A new path under `folder`, or under the shared folder named by `spark.checkpoint.dir`.

    A local session without that setting gets a temporary folder, which goes when Python ends.
    """
    base = folder or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="mercato-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
