"""Article states of the job chain: append-only facts, latest per article (STR-02, STR-04).

A fact says that an article reached a state in an attempt: ``waiting`` (its prompt is
offered to the model), ``requested`` (its post is in the outbox), ``failed`` or
``sent``.  Attempts are numbered from 1 and states follow each other within one, so
(attempt, state) orders the facts of an article without a clock.  Each stage writes the
facts of a batch into that batch's own folder, overwritten whole, so a replayed batch
replaces its own facts; nothing is updated in place.

``compact_states`` folds the facts so far into one table of the articles that are not
sent yet; later reads take that table and the folders written since, chosen by their
partition values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STATES = ("waiting", "requested", "failed", "sent")
FACTS = "article_id string, attempt int, state string, prepared_in string, error string"


def state_rank(state: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in STATES]), state)


def latest_states(facts: DataFrame) -> DataFrame:
    """One row per article: its last fact (a partial aggregate, whatever the skew)."""
    row = F.struct("attempt", "state", "prepared_in", "error")
    return facts.groupBy("article_id").agg(F.max_by(row, F.struct("attempt", state_rank(F.col("state")))).alias("s")).select(
        "article_id", "s.*")


def write_states(facts: DataFrame, base: str, stage: str, batch_id: int) -> None:
    facts.select("article_id", F.col("attempt").cast("int").alias("attempt"), "state", "prepared_in", "error").write.mode(
        "overwrite").parquet(f"{base}/states/stage={stage}/batch_id={int(batch_id)}")


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table that may not be there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:  # noqa: BLE001 - only "path does not exist" is expected
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def _folded(spark: SparkSession, base: str) -> list:
    """(snapshot, stage, upto) of the last snapshot: one row per stage."""
    rows = read_or_empty(spark, f"{base}/states_folded", "stage string, upto long, snapshot long")
    last = rows.agg(F.max("snapshot")).first()[0]
    return [] if last is None else rows.where(F.col("snapshot") == last).collect()


def read_states(spark: SparkSession, base: str, stage: str | None = None, batch_id: int | None = None) -> DataFrame:
    """The latest state of every article; of ``stage`` only batches before ``batch_id``
    (a replayed batch does not see its own facts)."""
    folded = _folded(spark, base)
    facts = read_or_empty(spark, f"{base}/states", f"{FACTS}, stage string, batch_id long")
    if stage is not None:
        facts = facts.where((F.col("stage") != stage) | (F.col("batch_id") < F.lit(int(batch_id))))
    for r in folded:
        facts = facts.where((F.col("stage") != r.stage) | (F.col("batch_id") > F.lit(r.upto)))
    facts = facts.drop("stage", "batch_id")
    if folded:
        facts = facts.unionByName(spark.read.schema(FACTS).parquet(f"{base}/states_open/snapshot={folded[0].snapshot}"))
    return latest_states(facts)


def compact_states(spark: SparkSession, base: str) -> None:
    """Fold all facts written so far; call it while no batch of the chain runs.

    The table of open articles is written first, the row that makes it count last, so
    a crash in between leaves the facts as they are."""
    upto = read_or_empty(spark, f"{base}/states", f"{FACTS}, stage string, batch_id long").groupBy("stage").agg(
        F.max("batch_id").alias("upto")).collect()
    if not upto:
        return
    before = _folded(spark, base)
    snapshot = before[0].snapshot + 1 if before else 0
    read_states(spark, base).where("state <> 'sent'").write.mode("overwrite").parquet(f"{base}/states_open/snapshot={snapshot}")
    spark.createDataFrame([(r.stage, r.upto) for r in upto], "stage string, upto long").coalesce(1).write.mode(
        "overwrite").parquet(f"{base}/states_folded/snapshot={snapshot}")
