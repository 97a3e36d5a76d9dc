"""Sinks: ledger, drafts, runs and outcomes (SNK-01..04).

Every batch writes into its own ``batch_id=<n>`` folder and overwrites that
folder, so a batch that is retried after a failure replaces its own earlier
attempt, with nothing if nothing is left, instead of adding a second copy.  An
empty batch leaves a file without rows, so the folder keeps its schema.  Write order is
drafts/outbox first and ledger last: a crash in between leaves articles that
are retried, never articles marked done without their drafts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gleaner.operators.keys import distinct_articles
from gleaner.operators.screen import ledger_anti_join
from gleaner.sources.tables import LEDGER_PREFIX_CHARS, ledger_snapshot, read_ledger

LEDGER_COLUMNS = ["article_id", "url", "title", "published_at", "processed_at"]


def _write_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> None:
    df.drop("batch_id").write.mode("overwrite").format(fmt).save(f"{path}/batch_id={int(batch_id)}")


def ledger_rows(entries: DataFrame, ledger: DataFrame | None, batch_id: int,
                processed_at: Column | None = None, key: str = "article_id",
                order_col: str = "feed_pos") -> DataFrame:
    """SNK-01 rows: one per new key (earliest position in the batch wins),
    minus keys already in the ledger.  Rows the same batch wrote in an
    earlier attempt are ignored, so a replay rewrites the same rows."""
    ts = processed_at if processed_at is not None else F.current_timestamp()
    cols = [c for c in ("url", "title", "published_at") if c in entries.columns]
    e = entries.select(key, order_col, *cols)
    for c in ("url", "title"):
        if c not in cols:
            e = e.withColumn(c, F.lit(None).cast("string"))
    if "published_at" not in cols:
        e = e.withColumn("published_at", F.lit(None).cast("timestamp"))
    firsts = distinct_articles(e, key, order_col, count_col=None)
    if ledger is not None:
        prior = ledger.where(F.col("batch_id") != F.lit(int(batch_id))) if "batch_id" in ledger.columns else ledger
        firsts = ledger_anti_join(firsts, prior, key)
    return firsts.select(key, "url", "title", F.col("published_at").cast("timestamp"),
                         ts.cast("timestamp").alias("processed_at"))


def append_ledger(rows: DataFrame, path: str, batch_id: int, dry_run: bool = False,
                  prefix_chars: int = LEDGER_PREFIX_CHARS) -> None:
    """SNK-01: write this batch's ledger rows (nothing on a dry run), in folders by the
    first ``prefix_chars`` characters of the key: a later batch reads only the folders of
    its own keys (``sources.tables.ledger_of``).  Keys are hashes, so folders are even."""
    if not dry_run:
        rows = rows.select(*LEDGER_COLUMNS, F.substring("article_id", 1, prefix_chars).alias("prefix"))
        (rows.hint("rebalance", "prefix").write.mode("overwrite").partitionBy("prefix")
             .parquet(f"{path}/batch_id={int(batch_id)}"))


def compact_ledger(spark: SparkSession, path: str, upto: int, prefix_chars: int = LEDGER_PREFIX_CHARS) -> None:
    """Fold the folders of all batches up to ``upto`` (none of which may run again) into one
    table by prefix, so that a long-lived ledger stays a few large files a prefix.

    The table is written first and the row that makes it count last; readers take the
    last such table and the batches after it.  Batch folders are left to the owner."""
    last = ledger_snapshot(spark, path)
    if last is not None and last.upto >= upto:
        return
    number = 0 if last is None else last.snapshot + 1
    rows = read_ledger(spark, path).where((F.col("batch_id") <= F.lit(int(upto))) | F.col("batch_id").isNull())
    rows = rows.select(*LEDGER_COLUMNS, F.substring("article_id", 1, prefix_chars).alias("prefix"))
    (rows.hint("rebalance", "prefix").write.mode("overwrite").partitionBy("prefix")
         .parquet(f"{path}_compact/rows/snapshot={number}"))
    spark.createDataFrame([(int(upto),)], "upto long").coalesce(1).write.mode("overwrite").parquet(
        f"{path}_compact/upto/snapshot={number}")


def append_drafts(drafts: DataFrame, path: str, batch_id: int, dry_run: bool = False) -> None:
    """SNK-02: write this batch's draft rows."""
    if not dry_run:
        _write_batch(drafts, path, batch_id)


def write_run(run_row: DataFrame, path: str, batch_id: int) -> None:
    """SNK-03: the finished run row (no in-place update: the row is written
    once, complete)."""
    _write_batch(run_row, path, batch_id)


def write_outcomes(outcomes: DataFrame, path: str, batch_id: int) -> None:
    """SNK-04: per-article outcome facts, queryable by run."""
    _write_batch(outcomes, path, batch_id)


def write_observed(df: DataFrame, path: str, batch_id: int, **counters: Column) -> dict[str, int]:
    """Write a batch and return ``counters`` (aggregates over its rows) as the write itself
    saw them: nothing is read again.  They are counted in the write's own tasks, where a
    task that is run again counts once."""
    seen = Observation()
    _write_batch(df.observe(seen, *[c.alias(name) for name, c in counters.items()]), path, batch_id)
    return {name: int(seen.get[name] or 0) for name in counters}
