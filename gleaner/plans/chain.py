"""The job chain as polls and streams: failed articles are tried again (STR-01, STR-04,
JOIN-03).

Three stages, each one batch function and one ``foreachBatch`` stream over landed files:

``poll_prepare``  new entries, and every failed article that has attempts left, are
                  offered to the model under the next attempt number
``poll_deliver``  landed model responses meet the articles that wait for them; posts go
                  to the outbox, invalid answers fail
``poll_confirm``  landed answers of the publishing service meet the requests; drafts and
                  ledger rows, or failures

What an article waits for is its last fact in ``operators.states``: an answer joins only
an article in the state and attempt that it answers, so late, doubled and unknown ones
are set aside with a reason and never send a post twice.  A failed article's prompt is
read back from the poll that prepared it; nothing is extracted again.  Every folder
belongs to one batch and is overwritten whole, states last but the ledger, so a batch
that dies is simply run again.

Folders under ``base``: ``articles`` and ``entries`` (by poll), ``outbox``, ``drafts``,
``outcomes`` and ``ignored`` (by stage and batch), ``states``, ``ledger``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gleaner import sinks
from gleaner.operators import states
from gleaner.operators.common import CODEC, materialize, scratch_tables
from gleaner.plans import jobs
from gleaner.sources.tables import ledger_of
from gleaner.streaming import numbered

STAGES = ("prepare", "retry", "deliver", "confirm")
#: What only the poll that prepared an article holds; the feed's body column comes first.
TEXTS = ("feed_content", "body", "clean_text", "extracted_insights", "prompt")


def _ledger_batch(stage: str, batch_id: int) -> int:
    """The stages share the ledger; each has folders of its own."""
    return len(STAGES) * int(batch_id) + STAGES.index(stage)


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", CODEC).parquet(path)


def _outcomes(df: DataFrame, base: str, stage: str, batch_id: int) -> None:
    cols = {"article_id": "string", "feed_pos": "long", "attempt": "int", "outcome": "string", "error": "string"}
    _write(df.select(*[F.col(c).cast(t).alias(c) for c, t in cols.items()]),
           f"{base}/outcomes/stage={stage}/batch_id={int(batch_id)}")


def _of_polls(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` of ``articles`` in the polls that ``keys`` name: other folders are not read."""
    polls = [r.prepared_in for r in keys.select("prepared_in").distinct().collect()]
    return rows.where(F.col("poll").isin(*polls) if polls else F.lit(False))


def _prepared_rows(spark, base: str, keys: DataFrame) -> DataFrame:
    """Article rows of ``keys`` (article_id, prepared_in, attempt) without their texts, from
    the polls that prepared them."""
    rows = _of_polls(spark.read.parquet(f"{base}/articles").drop("attempt", "prepared_in", *TEXTS), keys)
    return rows.join(keys, (rows["article_id"] == keys["article_id"]) & (rows["poll"] == keys["prepared_in"]), "inner").drop(
        keys["article_id"]).drop("poll")


def offered(spark, base: str, poll: str, body_col: str = TEXTS[0]) -> DataFrame:
    """What a poll (e.g. ``prepare-3``) offers to the model, with all texts: those of an article
    that is offered again are read from the poll that prepared it."""
    rows = spark.read.parquet(f"{base}/articles/poll={poll}")
    texts = [c for c in (body_col, *TEXTS[1:]) if c in rows.columns]
    again = rows.where(F.col("prepared_in") != poll).drop(*texts)
    held = _of_polls(spark.read.parquet(f"{base}/articles"), again).select(
        F.col("article_id").alias("_id"), F.col("poll").alias("_poll"), *texts)
    same = (F.col("article_id") == F.col("_id")) & (F.col("prepared_in") == F.col("_poll"))
    return rows.where(F.col("prepared_in") == poll).unionByName(again.join(held, same).drop("_id", "_poll"))


def poll_prepare(batch: DataFrame, batch_id: int, pages: DataFrame, base: str, excluded_authors=(),
                 max_attempts: int | None = None, stage: str = "prepare", feed_cols: tuple[str, ...] = ("feed_file",),
                 body_col: str = TEXTS[0], **limits) -> None:
    """Job 1 over one batch of feed entries (possibly none), with the retries that are due."""
    spark, poll = batch.sparkSession, f"{stage}-{int(batch_id)}"
    batch = numbered(batch).drop("_row")
    ledger = ledger_of(spark, f"{base}/ledger", batch, but_batch=_ledger_batch(stage, batch_id))
    known = materialize(states.read_states(spark, base, stage, batch_id), "known")
    prep = jobs.prepare(batch, pages, ledger.unionByName(known.select("article_id")),
                        excluded_authors=excluded_authors, feed_cols=feed_cols, body_col=body_col, **limits)
    due = known.where("state = 'failed'")
    if max_attempts is not None:
        due = due.where(F.col("attempt") < max_attempts)
    due = due.select("article_id", "prepared_in", (F.col("attempt") + 1).alias("attempt"))
    offered = prep.articles.withColumns({"attempt": F.lit(1), "prepared_in": F.lit(poll)})
    if not due.isEmpty():
        offered = offered.unionByName(_prepared_rows(spark, base, due).drop(body_col), allowMissingColumns=True)
    _write(offered, f"{base}/articles/poll={poll}")
    _write(prep.entries, f"{base}/entries/poll={poll}")
    place = ["feed_pos", *[c for c in feed_cols if c in offered.columns]]
    offered = spark.read.parquet(f"{base}/articles/poll={poll}").select("article_id", *place, "attempt", "prepared_in")

    # Entries that go no further: known, excluded, without a key, or a later copy.
    new, entries = offered.where("attempt = 1").alias("n"), spark.read.parquet(f"{base}/entries/poll={poll}").alias("e")
    same = F.col("e.article_id") == F.col("n.article_id")
    for c in place:
        same = same & F.col(f"e.{c}").eqNullSafe(F.col(f"n.{c}"))
    settled = entries.join(new, same, "left_anti").withColumns({
        "attempt": F.lit(None).cast("int"),
        "outcome": F.when(F.col("article_id").isNull(), "failed").otherwise(F.coalesce("pre_outcome", F.lit("duplicate"))),
        "error": F.when(F.col("article_id").isNull(), F.lit(jobs.ERR_NO_KEY))})
    _outcomes(settled, base, stage, batch_id)
    states.write_states(offered.select("article_id", "attempt", F.lit("waiting").alias("state"), "prepared_in",
                                       F.lit(None).cast("string").alias("error")), base, stage, batch_id)
    sinks.append_ledger(sinks.ledger_rows(settled.where("outcome = 'excluded'"), None, 0), f"{base}/ledger",
                        _ledger_batch(stage, batch_id))


def poll_retry(spark, base: str, pages: DataFrame, batch_id: int, **how) -> None:
    """A poll without new entries: offer again what failed (``batch_id`` counts these polls)."""
    schema = spark.read.parquet(f"{base}/entries").drop("poll", "excluded", "pre_outcome").schema
    body = T.StructField("feed_content", T.StringType())
    empty = spark.createDataFrame([], T.StructType([*[f for f in schema if f.name != "_row"], body]))
    poll_prepare(empty, batch_id, pages, base, stage="retry", **how)


def _matched(batch: DataFrame, value: str, awaited: DataFrame, base: str, stage: str, batch_id: int) -> DataFrame:
    """(article_id, value, attempt, prepared_in): one landed row per article that waits for
    it, the greatest text of doubled ones; all others are written to ``ignored``."""
    spark = batch.sparkSession
    landed = batch if "attempt" in batch.columns else batch.withColumn("attempt", F.lit(None).cast("int"))
    landed = materialize(landed.select("article_id", value, F.col("attempt").cast("int").alias("_said"),
                                       F.monotonically_increasing_id().alias("_no")), "landed")
    known = states.read_states(spark, base, stage, batch_id).select("article_id", "attempt", "state", "prepared_in")
    seen = materialize(landed.join(known, "article_id", "left"), "answered")
    fits = F.col("state").isin(*awaited) & (F.col("_said").isNull() | (F.col("_said") == F.col("attempt")))
    best = seen.where(fits).groupBy("article_id").agg(
        F.max(F.struct(value, "_no")).alias("best"), F.first("attempt").alias("attempt"), F.first("prepared_in").alias("prepared_in"))
    best = materialize(best.select("article_id", f"best.{value}", "best._no", "attempt", "prepared_in"), "matched")
    reason = (F.when(F.col("state").isNull(), "unknown").when(fits, "doubled")
               .when(F.col("_said") < F.col("attempt"), "late").otherwise("settled"))
    aside = seen.join(best.select("_no"), "_no", "left_anti").select(
        "article_id", F.col("_said").alias("attempt"), value, reason.alias("reason"))
    _write(aside, f"{base}/ignored/stage={stage}/batch_id={int(batch_id)}")
    return best.drop("_no")


def poll_deliver(batch: DataFrame, batch_id: int, base: str, publish_mode: str = "draft", now: Column | None = None,
                 queue: DataFrame | None = None, rewrites: DataFrame | None = None, response_col: str = "response", **how) -> None:
    """Job 2 over one batch of landed responses (article_id, response, attempt if known).

    In schedule mode the posts requested by earlier batches count as queued."""
    spark = batch.sparkSession
    mine = _matched(batch, response_col, ("waiting",), base, "deliver", batch_id)
    arts = _prepared_rows(spark, base, mine.select("article_id", "prepared_in", "attempt"))
    arts = materialize(arts, "answered_articles")
    if publish_mode == "schedule":
        earlier = states.read_or_empty(spark, f"{base}/outbox", "slot_text string, batch_id long").where(
            F.col("batch_id") < int(batch_id)).select(F.lit(0).alias("page"), F.to_json(F.struct(
                F.col("slot_text").alias("publish_at"))).alias("body"))
        queue = earlier if queue is None else queue.select("page", "body").unionByName(earlier)
    done = jobs.deliver(jobs.Prepared(entries=arts, articles=arts), mine.select("article_id", response_col), publish_mode, now=now,
                        queue=queue, rewrites=rewrites, response_col=response_col, **how)
    tries = arts.select("article_id", "attempt", "prepared_in")
    _write(done.outbox.join(tries, "article_id"), f"{base}/outbox/batch_id={int(batch_id)}")
    failed = materialize(done.failures.join(arts.select("article_id", "attempt", "prepared_in", "feed_pos"), "article_id"), "failed")
    _outcomes(failed.withColumns({"outcome": F.lit("failed"), "error": F.col("error_text")}), base, "deliver", batch_id)
    requested = spark.read.parquet(f"{base}/outbox/batch_id={int(batch_id)}").select(
        "article_id", "attempt", F.lit("requested").alias("state"), "prepared_in", F.lit(None).cast("string").alias("error"))
    states.write_states(requested.unionByName(failed.select(
        "article_id", "attempt", F.lit("failed").alias("state"), "prepared_in", F.col("error_text").alias("error"))),
        base, "deliver", batch_id)


def poll_confirm(batch: DataFrame, batch_id: int, base: str, now: Column | None = None, answer_col: str = "answer") -> None:
    """Job 3 over one batch of landed answers (article_id, answer, attempt if known; a null
    answer is a refusal): drafts, outcomes, states and, last, ledger rows."""
    spark = batch.sparkSession
    mine = _matched(batch, answer_col, ("requested",), base, "confirm", batch_id)
    arts = materialize(_prepared_rows(spark, base, mine.select("article_id", "prepared_in", "attempt")), "confirmed_articles")
    tries = arts.select("article_id", "attempt")
    requests = spark.read.parquet(f"{base}/outbox").join(tries, ["article_id", "attempt"], "left_semi").drop("batch_id")
    entries = arts.withColumn("pre_outcome", F.lit(None).cast("string")).withColumn("excluded", F.lit(False))
    none = spark.createDataFrame([], "article_id string, error_text string")
    out = jobs.confirm(jobs.Prepared(entries=entries, articles=arts), jobs.Delivered(outbox=requests, failures=none),
                       mine.select("article_id", answer_col), f"confirm-{int(batch_id)}", now=now, answer_col=answer_col)
    sinks.append_drafts(out.drafts, f"{base}/drafts", batch_id)
    _outcomes(out.outcomes.join(tries, "article_id"), base, "confirm", batch_id)
    facts = spark.read.parquet(f"{base}/outcomes/stage=confirm/batch_id={int(batch_id)}").join(
        arts.select("article_id", "prepared_in"), "article_id")
    states.write_states(facts.withColumn("state", F.when(F.col("outcome") == "failed", "failed").otherwise("sent")),
                        base, "confirm", batch_id)
    sinks.append_ledger(out.ledger, f"{base}/ledger", _ledger_batch("confirm", batch_id))


def _start(stream: DataFrame, checkpoint: str, run: Callable[[DataFrame, int], None], available_now: bool,
           processing_time: str | None) -> StreamingQuery:
    def scratched(batch: DataFrame, batch_id: int) -> None:
        with scratch_tables(batch.sparkSession):
            run(batch, batch_id)

    w = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(scratched)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "15 minutes")
    return w.start()


def start_prepare(feed: DataFrame, checkpoint: str, pages: DataFrame, base: str, available_now: bool = True,
                  processing_time: str | None = None, **how) -> StreamingQuery:
    """Landed feed entries as a stream of ``poll_prepare`` batches."""
    return _start(feed, checkpoint, lambda df, n: poll_prepare(df, n, pages, base, **how), available_now, processing_time)


def start_deliver(responses: DataFrame, checkpoint: str, base: str, available_now: bool = True,
                  processing_time: str | None = None, **how) -> StreamingQuery:
    """Landed model responses as a stream of ``poll_deliver`` batches."""
    return _start(responses, checkpoint, lambda df, n: poll_deliver(df, n, base, **how), available_now, processing_time)


def start_confirm(answers: DataFrame, checkpoint: str, base: str, available_now: bool = True,
                  processing_time: str | None = None, **how) -> StreamingQuery:
    """Landed answers of the publishing service as a stream of ``poll_confirm`` batches."""
    return _start(answers, checkpoint, lambda df, n: poll_confirm(df, n, base, **how), available_now, processing_time)
