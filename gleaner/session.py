"""Session settings and shared storage locations.

``build_session`` is for tests, benches and scripts; library operators never
create sessions, they take DataFrames.  On a cluster the session comes from
the platform and ``spark.checkpoint.dir`` names the shared folder used to cut
lineage and to keep streaming state.  Where it is absent, a session of one local
process gets a temporary folder; any other session is refused.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings the operators are written against.  AQE re-plans joins with the
# sizes it measures at run time (broadcast only below the threshold, split
# skewed partitions) and coalesces small shuffle partitions.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
}


def _default_driver_memory() -> str:
    """Half of the machine's memory, between 1 and 8 GiB (local mode runs
    everything in the driver JVM)."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    gib = max(1, min(8, int(total / 2 / 2**30)))
    return f"{gib}g"


def build_session(master: str | None = None, app: str = "gleaner",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    master = master or "local[%s]" % os.environ.get("BENCH_CPUS", "*")
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(SESSION_CONF)
    conf.update({
        "spark.sql.shuffle.partitions": str(shuffle_partitions or 8),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("GLEANER_DRIVER_MEMORY", _default_driver_memory()),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    })
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> None:
    """Timestamps are compared and printed in UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder under the cluster's checkpoint directory.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir).  Executors
    on other hosts cannot see a temporary folder of the driver, so without that
    setting only a master of one process (``local``, ``local[...]``) is served,
    and anything else is an error."""
    base = _configured_dir(spark)
    if not base:
        context = spark.sparkContext
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        own = tempfile.mkdtemp(prefix="gleaner-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)  # one process: nobody else reads it
        context.setCheckpointDir(own)
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/{name}"


def _configured_dir(spark: SparkSession) -> str | None:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        try:
            base = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - no SparkContext under Spark Connect
            base = None
    return base
