"""Structured Streaming jobs (STR-01..04).

One poll cycle of the reference is one micro-batch here: landed feed files
are picked up by a checkpointed file source (``trigger(availableNow=True)``
for cron-style runs, ``processingTime`` for a long-running job), and each
micro-batch is handled by ``foreachBatch`` with the batch operators:

* STR-01  poll cycle      -> micro-batch trigger
* STR-02  dedup for ever  -> the ledger table is the state; each batch is
                             anti-joined to it and appends its new keys
* STR-03  no overlap      -> one active query per checkpoint location
* STR-04  retry failures  -> failed rows go to a retry table that every
                             later batch unions back in until they succeed
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gleaner import sinks
from gleaner.operators.common import materialize, scratch_tables
from gleaner.operators.outcomes import ingest_outcomes
from gleaner.sources.tables import ledger_of


def _read_or_empty(spark, path: str, schema) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def numbered(batch: DataFrame) -> DataFrame:
    """The micro-batch written once, its rows numbered: streamed XML rows carry
    no position, and a number must not shift when a task is retried."""
    batch = batch.withColumn("_row", F.monotonically_increasing_id())
    if "feed_pos" in batch.columns:
        batch = batch.withColumn("feed_pos", F.coalesce("feed_pos", "_row"))
    return materialize(batch, "batch")


def handle_batch(batch: DataFrame, batch_id: int, ledger_path: str,
                 retry_path: str | None = None,
                 outcomes_path: str | None = None,
                 decide: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """One micro-batch: union pending retries, label outcomes against the
    ledger, write outcome facts, retries and finally the ledger rows.

    ``decide`` adds ``excluded`` / ``failed`` columns (author screen, body
    and model steps); without it every new entry is processed.  The retry table
    holds, per batch, the rows that still fail after it (possibly none); a batch
    takes up those of the batch before, ahead of its own entries."""
    with scratch_tables(batch.sparkSession):
        _handle(batch, batch_id, ledger_path, retry_path, outcomes_path, decide)


def _handle(batch: DataFrame, batch_id: int, ledger_path: str, retry_path: str | None, outcomes_path: str | None,
            decide: Callable[[DataFrame], DataFrame] | None) -> None:
    spark, names = batch.sparkSession, batch.columns
    entries = numbered(batch).withColumn("_new", F.lit(1))
    if retry_path is not None:
        pending = _read_or_empty(spark, f"{retry_path}/batch_id={int(batch_id) - 1}", batch.schema)
        entries = entries.unionByName(pending.withColumns({"_row": F.monotonically_increasing_id(), "_new": F.lit(0)}))
    ledger = ledger_of(spark, ledger_path, entries, but_batch=batch_id)
    if decide is not None:
        entries = decide(entries)
    else:
        entries = entries.withColumn("excluded", F.lit(False)).withColumn("failed", F.lit(False))
    # Read by the three writes below.
    labelled = materialize(ingest_outcomes(entries, order_col=["_new", "feed_pos", "_row"], ledger=ledger), "labelled")
    facts = labelled.drop("_new", "_row").withColumn("run_batch", F.lit(int(batch_id)))
    if outcomes_path is not None:
        sinks.write_outcomes(facts, outcomes_path, batch_id)
    if retry_path is not None:
        # A later copy in this batch may have settled a key that failed first.
        done = labelled.where(F.col("outcome").isin("processed", "excluded")).select("article_id").distinct()
        failed = labelled.where((F.col("outcome") == "failed") & F.col("article_id").isNotNull())
        failed = failed.join(done, "article_id", "left_anti").select(*names)
        sinks.write_outcomes(failed, retry_path, batch_id)
    rows = sinks.ledger_rows(labelled.where(F.col("outcome").isin("processed", "excluded")),
                             None, batch_id)
    sinks.append_ledger(rows, ledger_path, batch_id)


def bounded_dedup(feed: DataFrame, time_col: str, delay: str, key: str = "article_id") -> DataFrame:
    """STR-02 with bounded state, for feeds whose copies come close together.

    A streaming feed without the copies of a key that arrive while it is remembered: the
    state store holds a key until the watermark (the greatest ``time_col`` seen, less
    ``delay``) reaches the key's own time plus ``delay``; a copy after that passes again,
    and a row older than the watermark is dropped as late.  Among copies of one batch an
    arbitrary one passes.  A null key is a key like any other; rows without a time never
    advance the watermark."""
    return feed.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([key])


def start_feed_stream(feed: DataFrame, checkpoint: str, ledger_path: str,
                      retry_path: str | None = None, outcomes_path: str | None = None,
                      decide: Callable[[DataFrame], DataFrame] | None = None,
                      available_now: bool = True,
                      processing_time: str | None = None) -> StreamingQuery:
    """Start the ingest stream over a streaming feed DataFrame."""
    w = (feed.writeStream
             .option("checkpointLocation", checkpoint)
             .foreachBatch(lambda df, bid: handle_batch(df, bid, ledger_path, retry_path,
                                                        outcomes_path, decide)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "15 minutes")
    return w.start()


def start_prepare_stream(feed: DataFrame, pages: DataFrame, checkpoint: str, out_dir: str,
                         ledger_path: str, excluded_authors=(),
                         max_articles: int | None = None,
                         outcomes_path: str | None = None,
                         available_now: bool = True,
                         processing_time: str | None = None) -> StreamingQuery:
    """STR-01 for the first job: every micro-batch of landed feed entries is
    prepared against the ledger (dedup, author screen, bodies, clean text,
    key points, prompts) and saved under ``out_dir`` for the model step and
    ``plans.jobs.load_prepared``.

    Articles of earlier batches that wait for their delivery are not prepared
    again; those that ``outcomes_path`` shows as failed since are."""
    from gleaner.plans import jobs  # local import: plans depend on this package

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = numbered(batch).drop("_row")
        seen = ledger_of(spark, ledger_path, batch)
        waiting = _read_or_empty(spark, f"{out_dir}/articles", "article_id string, batch_id long").where(
            F.col("batch_id") < int(batch_id)).select("article_id")
        if outcomes_path is not None:
            failed = _read_or_empty(spark, outcomes_path, "article_id string, outcome string").where(
                "outcome = 'failed'").select("article_id")
            waiting = waiting.join(failed, "article_id", "left_anti")
        prep = jobs.prepare(batch, pages, seen.unionByName(waiting),
                            excluded_authors=excluded_authors, max_articles=max_articles)
        jobs.save_prepared(prep, out_dir, batch_id)

    def scratched(batch: DataFrame, batch_id: int) -> None:
        with scratch_tables(batch.sparkSession):
            run(batch, batch_id)

    w = feed.writeStream.option("checkpointLocation", checkpoint).foreachBatch(scratched)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "15 minutes")
    return w.start()
