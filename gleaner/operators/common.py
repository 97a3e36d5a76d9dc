"""Small helpers shared by operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Of written tables that hold texts: two thirds of the size that Spark's default gives them.
CODEC = "zstd"

_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """Give CPU-heavy row-local work on a plain file scan one task per core.

    A table stored as one large row group is scanned by a single task; when a
    scan has fewer partitions than the default parallelism, its rows are hash
    partitioned on ``keys`` (deterministic, so a retried task sees the same
    rows).  A real data set has thousands of splits and no shuffle is planned.
    Only for scans: asking a plan with a shuffle for its partitions would run
    a job.
    """
    spark = scan.sparkSession
    try:
        target = spark.sparkContext.defaultParallelism
        have = scan.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - Spark Connect has no RDD access
        return scan
    if have >= target:
        return scan
    return scan.repartition(target, *keys) if keys else scan.repartition(target)


def materialize(df: DataFrame, name: str = "rows") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and continue from the
    written table.

    Used where one intermediate result feeds two branches of a plan, so the
    work under it (a sort, a window, a scan of wide text) runs once; lineage
    that a lost executor would replay stops here, and later branches read only
    the columns they need."""
    from gleaner.session import shared_dir

    path = f"{shared_dir(df.sparkSession, 'tables')}/{name}-{uuid.uuid4().hex}"
    if (made := _scratch.get()) is not None:
        made.append(path)
    df.write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that ``materialize`` writes inside the ``with`` are deleted at its end, so that a
    stream that runs for months does not fill the shared folder.  For bodies whose results
    are all written by then."""
    made: list[str] = []
    token = _scratch.set(made)
    try:
        yield
    finally:
        _scratch.reset(token)
        for path in made:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
