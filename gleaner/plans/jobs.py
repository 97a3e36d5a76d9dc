"""The batch jobs, split where work outside Spark sits: the text
model and the publishing service are called on landed tables between them.

``prepare``  feed -> cap -> ledger dedup and author screen -> body ladder ->
             clean text and key points -> thread gate -> prompt table
``fact_check_table``, ``promo_rewrite_table``
             prompts of the model's second and third step, from its answers
``deliver``  model responses -> parse -> validate -> promo wording -> publish
             slots -> outbox
``confirm``  answers of the publishing service -> draft rows with their remote
             ids -> outcomes, ledger rows and the run row

All return DataFrames.  Nothing reaches the driver but one scalar (the latest
queued publish time); intermediate tables that several outputs read are written
once to the shared folder.  ``save_prepared`` / ``load_prepared`` hand the first
job over to a later session; ``write_outputs`` writes a batch in the safe order
(drafts first, ledger last).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner import sinks
from gleaner.functions import fixed
from gleaner.functions import signals as S
from gleaner.operators import article, keys, outbox, outcomes, packages, prompts, schedule, screen
from gleaner.operators.common import materialize, spread
from gleaner.sources.tables import parse_responses

ERR_NO_KEY = "entry has no id, guid or link"
ERR_NO_RESPONSE = "no model response"
ERR_NOT_REWRITTEN = "promotional wording not rewritten"
ERR_NO_ANSWER = "no answer from the publishing service"


def run_id(source: str, batch_id: int, started: datetime) -> str:
    """PRJ-15: the id of the run that handles one batch of one source (e.g. the
    checkpoint folder of a stream, or a feed folder).  A replay of the batch has
    the same digits, so its rows can be told from another run's."""
    digits = hashlib.sha256(f"{source}#{batch_id}".encode()).hexdigest()[:fixed.RUN_ID_HEX_DIGITS]
    return f"{fixed.RUN_ID_PREFIX}{started.astimezone(timezone.utc):{fixed.RUN_ID_TIME_FORMAT}}_{digits}"


class RunAccount:
    """The counters of one run, as its writes saw them (``accounted_run``)."""

    def __init__(self, run_id: str, base: str, batch_id: int) -> None:
        self.run_id, self.base, self.batch_id = run_id, base, batch_id
        self.counts = dict.fromkeys(outcomes.COUNTERS, 0)

    def save_prepared(self, prepared: Prepared) -> None:
        """``jobs.save_prepared``; from here on the run has found its entries."""
        got = sinks.write_observed(prepared.entries, f"{self.base}/entries", self.batch_id, found=F.count(F.lit(1)))
        self.counts["articles_found"] = got["found"]
        sinks.write_outcomes(prepared.articles, f"{self.base}/articles", self.batch_id)

    def write_outputs(self, out: Confirmed, dry_run: bool = False) -> None:
        """``jobs.write_outputs`` without its run row, which the end of the run writes."""
        sinks.append_drafts(out.drafts, f"{self.base}/drafts", self.batch_id, dry_run=dry_run)
        self.counts.update(sinks.write_observed(out.outcomes, f"{self.base}/outcomes", self.batch_id,
                                                **outcomes.outcome_counters()))
        sinks.append_ledger(out.ledger, f"{self.base}/ledger", self.batch_id, dry_run=dry_run)


@contextmanager
def accounted_run(spark, run_id: str, base: str, batch_id: int, started: datetime | None = None) -> Iterator[RunAccount]:
    """A run that always leaves its run row (AGG-01, AGG-02, SNK-03).

    The steps of the run are the body of the ``with``; the counters come from the writes
    made through the account.  A body that ends writes the row with its status; one that
    raises writes the counters so far, one more failure and the status ``failed``, and
    the error goes on."""
    started, account = started or datetime.now(timezone.utc), RunAccount(run_id, base, batch_id)

    def write(counts: dict[str, int], status: str) -> None:
        row = (run_id, *(counts[c] for c in outcomes.COUNTERS), status, started, datetime.now(timezone.utc))
        kinds = ", ".join(f"{c} long" for c in outcomes.COUNTERS)
        sinks.write_run(spark.createDataFrame(
            [row], f"run_id string, {kinds}, status string, started_at timestamp, completed_at timestamp"), f"{base}/runs", batch_id)

    try:
        yield account
    except BaseException:
        write({**account.counts, "articles_failed": account.counts["articles_failed"] + 1}, "failed")
        raise
    write(account.counts, "completed_with_errors" if account.counts["articles_failed"] else "completed")


@dataclass
class Prepared:
    entries: DataFrame   # every capped entry with ``pre_outcome`` (duplicate / excluded / null)
    articles: DataFrame  # entries to send to the model, with clean text, points, prompt


@dataclass
class Delivered:
    outbox: DataFrame    # requests for the publishing service, with the packages they came from
    failures: DataFrame  # (article_id, error_text) of articles that could not be sent


@dataclass
class Confirmed:
    drafts: DataFrame
    outcomes: DataFrame
    ledger: DataFrame
    run: DataFrame


def prepare(feed: DataFrame, pages: DataFrame, ledger: DataFrame | None = None,
            excluded_authors: Iterable[str] | DataFrame = (),
            max_articles: int | None = None,
            feed_cols: tuple[str, ...] = ("feed_file",),
            allow_threads: bool = True,
            min_points_for_thread: int = fixed.MIN_INSIGHTS_FOR_THREAD,
            min_chars_for_thread: int = fixed.MIN_CHARS_FOR_THREAD,
            cap_after_dedup: bool = False,
            body_col: str = "feed_content",
            key_point_cap: int | None = None,
            text_budget: int | None = None,
            prompt_points: int | None = None) -> Prepared:
    """Job 1.  ``feed`` is normalized (``sources.feed.read_feed``); ``pages``
    holds ``url`` and ``html``; ``ledger`` holds ``article_id``.

    All entries, points and text are used unless a limit is given
    (``max_articles`` per feed file, before dedup or, with ``cap_after_dedup``,
    after the ledger test).  Entries are told apart by (feed columns, position);
    only the first copy of a key in the batch is sent to the model, later copies
    are settled by ``confirm``."""
    part = [c for c in feed_cols if c in feed.columns]
    f = feed
    if cap_after_dedup and ledger is not None:
        f = screen.ledger_anti_join(f, ledger)
    if max_articles is not None:
        f = keys.batch_cap(f, max_articles, ["feed_pos"], part)
    # Decisions are taken on a thin copy of the entries (no body text), written
    # once: the author screen, the ledger test and the per-key minima read it.
    thin = materialize(f.drop(body_col), "entries")
    thin = screen.screen_authors(thin, "author", excluded_authors, out="excluded")
    seen = F.lit(False)
    if ledger is not None:
        batch_keys = thin.select("article_id").where(F.col("article_id").isNotNull()).distinct()
        led = (ledger.select("article_id").join(batch_keys, "article_id", "left_semi").distinct()
                     .withColumn("_seen", F.lit(True)))
        thin = thin.join(led, "article_id", "left")
        seen = F.coalesce(F.col("_seen"), F.lit(False))
    thin = thin.withColumn("pre_outcome", F.when(seen, "duplicate").when(F.col("excluded"), "excluded"))
    entries = materialize(thin.drop("_seen") if ledger is not None else thin, "decided")
    # A copy after an excluded copy of the same key is a duplicate (the
    # excluded one marks the ledger), so it is not sent to the model; of the
    # rest, the first copy of each key is.
    place = F.struct("feed_pos", *part)
    first_ex = (entries.where(F.col("pre_outcome") == "excluded")
                       .groupBy("article_id").agg(F.min(place).alias("_first_ex")))
    first_pos = (entries.where(F.col("pre_outcome").isNull() & F.col("article_id").isNotNull())
                        .join(first_ex, "article_id", "left")
                        .where(F.col("_first_ex").isNull() | (place < F.col("_first_ex")))
                        .groupBy("article_id").agg(F.min(place).alias("_at"))
                        .select(F.col("article_id").alias("_key"), F.col("_at.feed_pos").alias("_pos"),
                                *[F.col("_at")[c].alias(f"_at_{c}") for c in part]))
    # One more pass over the wide feed fetches the bodies of those copies; the
    # article set is written once since the body ladder reads it twice.
    same = (F.col("article_id") == F.col("_key")) & (F.col("feed_pos") == F.col("_pos"))
    for c in part:
        same = same & F.col(c).eqNullSafe(F.col(f"_at_{c}"))
    # ``first_pos`` has one place per key, so entries of one key are entries of one place:
    # told apart by the join's own keys, the bodies are not dealt out a second time.
    first = f.join(first_pos, same, "left_semi").dropDuplicates(["article_id", "feed_pos"])
    first = spread(materialize(first, "articles"), "article_id")
    bodies = article.body_ladder(first, pages, "url", "url", body_col)
    arts = article.assemble_articles(bodies, "body", cap=key_point_cap)
    allow = S.allow_thread(F.col("extracted_insights"), F.col("clean_text"), allow_threads,
                           min_points_for_thread, min_chars_for_thread)
    arts = (arts.withColumn("allow_thread", allow)
                .withColumn("prompt", prompts.generate_prompt(
                    "title", "author", "published_at", "clean_text", "extracted_insights",
                    F.col("allow_thread"), text_budget=text_budget, max_points=prompt_points)))
    return Prepared(entries=entries, articles=arts)


def save_prepared(prepared: Prepared, base: str, batch_id: int) -> None:
    """Write job 1 under ``base`` for a later session (the model step takes hours)."""
    sinks.write_outcomes(prepared.entries, f"{base}/entries", batch_id)
    sinks.write_outcomes(prepared.articles, f"{base}/articles", batch_id)


def load_prepared(spark, base: str, batch_id: int) -> Prepared:
    """What ``save_prepared`` (or the prepare stream) wrote for one batch."""
    read = lambda name: spark.read.parquet(f"{base}/{name}/batch_id={int(batch_id)}")
    return Prepared(entries=read("entries"), articles=read("articles"))


def latest_response(responses: DataFrame, response_col: str = "response", attempt_col: str | None = None) -> DataFrame:
    """One response per article: of the last attempt (``attempt_col``, a number
    or time), or without one the greatest text, so that the choice is the same
    on every run."""
    order = F.struct(*([attempt_col] if attempt_col else []), response_col)
    return responses.groupBy("article_id").agg(F.max_by(response_col, order).alias(response_col))


def _parsed(prepared: Prepared, responses: DataFrame, response_col: str, attempt_col: str | None,
            max_chars: int) -> DataFrame:
    """Articles with their package, its first error (also: none landed) and ``promo``."""
    arts = prepared.articles.join(latest_response(responses, response_col, attempt_col), "article_id", "left")
    arts = packages.validate_packages(parse_responses(arts, response_col), allow_thread=F.col("allow_thread"),
                                      max_chars=max_chars, out="error")
    return (arts.withColumn("error", F.when(F.col(response_col).isNull(), F.lit(ERR_NO_RESPONSE))
                            .otherwise(F.coalesce("parse_error", "error")))
                .withColumn("promo", packages.promo_flag("single_tweet", "thread")))


def fact_check_table(prepared: Prepared, responses: DataFrame, response_col: str = "response",
                     attempt_col: str | None = None, max_chars: int = fixed.MAX_POST_CHARS,
                     text_budget: int | None = None, max_points: int | None = None) -> DataFrame:
    """The model's second step: (article_id, prompt) for every valid draft."""
    ok = _parsed(prepared, responses, response_col, attempt_col, max_chars).where("error is null")
    return ok.select("article_id", prompts.fact_check_prompt(
        "clean_text", "extracted_insights", prompts.draft_json("delivery_mode", "single_tweet", "thread"),
        F.col("allow_thread"), text_budget=text_budget, max_points=max_points).alias("prompt"))


def promo_rewrite_table(prepared: Prepared, responses: DataFrame, response_col: str = "response",
                        attempt_col: str | None = None, max_chars: int = fixed.MAX_POST_CHARS,
                        text_budget: int | None = None) -> DataFrame:
    """The model's third step: (article_id, prompt) for every parsed package
    (``responses`` of the fact check) with promotional wording."""
    arts = _parsed(prepared, responses, response_col, attempt_col, max_chars)
    flagged = arts.where(F.col(response_col).isNotNull() & F.col("parse_error").isNull() & F.col("promo"))
    return flagged.select("article_id", prompts.promo_rewrite_prompt(
        "clean_text", prompts.draft_json("delivery_mode", "single_tweet", "thread"),
        F.col("allow_thread"), text_budget=text_budget).alias("prompt"))


def deliver(prepared: Prepared, responses: DataFrame, publish_mode: str = "draft", now: Column | None = None,
            queue: DataFrame | None = None, fixed_schedule: str | None = None,
            spacing_minutes: int = fixed.PUBLISH_SPACING_MINUTES,
            response_col: str = "response", attempt_col: str | None = None,
            rewrites: DataFrame | None = None, max_chars: int = fixed.MAX_POST_CHARS,
            feed_cols: tuple[str, ...] = ("feed_file",)) -> Delivered:
    """Job 2.  ``responses`` holds ``article_id`` and the JSON text of the fact
    check (or of the first step); ``rewrites`` that of the promo rewrite.

    An article fails when its response is missing, not JSON or invalid, or when
    it has promotional wording and no rewrite has landed.  In schedule mode every
    valid post gets a slot ``spacing`` after the previous one, starting after the
    latest queued post; posts follow (position, feed columns), as positions are
    unique only within a feed."""
    now = now if now is not None else F.lit(datetime.now(timezone.utc))
    part = [c for c in feed_cols if c in prepared.articles.columns]
    keep = ("article_id", "feed_pos", *part, "url", "delivery_mode", "single_tweet", "thread", "error", "promo")
    arts = _parsed(prepared, responses, response_col, attempt_col, max_chars).select(*keep, "parse_error")
    flagged = F.col("promo") & F.col("parse_error").isNull() & (F.coalesce("error", F.lit("")) != ERR_NO_RESPONSE)
    if rewrites is None:
        arts = arts.withColumn("error", F.coalesce("error", F.when(flagged, F.lit(ERR_NOT_REWRITTEN)))).select(*keep)
    else:
        arts = materialize(arts.withColumn("_flagged", flagged), "packages")
        again = _parsed(prepared, rewrites, response_col, attempt_col, max_chars).select(*keep)
        arts = arts.where(~F.col("_flagged")).select(*keep).unionByName(
            again.join(arts.where("_flagged").select("article_id"), "article_id", "left_semi")
                 .withColumn("error", F.when(F.col("error") == ERR_NO_RESPONSE, F.lit(ERR_NOT_REWRITTEN))
                             .otherwise(F.col("error"))))
    # Every output below reads these rows: write them once (no text, no prompt).
    arts = materialize(arts.drop("promo").withColumn("reply", outbox.read_more("url")), "packages")
    ok = arts.where(F.col("error").isNull())
    if publish_mode == "schedule" and fixed_schedule is None:
        latest = None
        if queue is not None:
            latest = schedule.latest_queued(queue, now).first()[0]
        # One ``now`` for the whole batch: slots follow feed position.
        ok = schedule.publish_slots(ok.withColumn("_arrival", now), "_arrival", "article_id", (), spacing_minutes,
                                    latest=F.lit(latest) if latest is not None else None,
                                    order_cols=["feed_pos", *part]).drop("_arrival")
        ok = ok.withColumn("slot_text", schedule.slot_text("slot"))
    else:
        ok = ok.withColumn("slot_text", F.lit(fixed_schedule).cast("string"))
    # An unknown publish mode or a schedule without a usable time fails the
    # article while building its request, as the send step would.
    ok = ok.withColumn("_perr", outbox.payload_error(F.lit(publish_mode), "slot_text"))
    posts = outbox.post_list("delivery_mode", "single_tweet", "thread", "reply")
    sent = ok.where(F.col("_perr").isNull()).select(
        "article_id", "feed_pos", "delivery_mode", "single_tweet", "thread", "reply", posts.alias("posts"),
        "slot_text", F.lit(publish_mode).alias("publish_mode"),
        outbox.outbox_payload(posts, F.lit(publish_mode), "slot_text").alias("payload"))
    failures = (arts.where(F.col("error").isNotNull()).select("article_id", F.col("error").alias("error_text"))
                .unionByName(ok.where(F.col("_perr").isNotNull())
                               .select("article_id", F.col("_perr").alias("error_text"))))
    return Delivered(outbox=sent, failures=failures)


def confirm(prepared: Prepared, delivered: Delivered, answers: DataFrame | None, run_id: str,
            now: Column | None = None, answer_col: str = "answer",
            feed_cols: tuple[str, ...] = ("feed_file",), attempt_col: str | None = None) -> Confirmed:
    """Job 3.  ``answers`` holds ``article_id`` and the publishing service's
    answer (JSON text, null for a refused request) for every request that went
    through, the one of the last attempt (``attempt_col``, a number or time; without it the
    greatest text); a request without one fails and stays out of the ledger, so the
    article is tried again.  ``answers=None`` is a dry run: nothing is sent,
    there are no drafts, and valid articles count as processed."""
    now = now if now is not None else F.lit(datetime.now(timezone.utc))
    spark = prepared.entries.sparkSession
    failures, drafts = delivered.failures, None
    if answers is not None:
        one = latest_response(answers, answer_col, attempt_col).withColumnRenamed(answer_col, "_answer")
        sent = materialize(delivered.outbox.join(one, "article_id", "left"), "sent")
        went = sent.where(F.col("_answer").isNotNull())
        failures = failures.unionByName(sent.where(F.col("_answer").isNull()).select(
            "article_id", F.lit(ERR_NO_ANSWER).alias("error_text")))
    else:
        went = delivered.outbox.limit(0).withColumn("_answer", F.lit(None).cast("string"))
    drafts = outbox.draft_rows(went, publish_mode="publish_mode", response_body="_answer", created_at=now)
    errors = materialize(failures, "failures")
    # A key fails once per batch: its copies share the first copy's model call.
    by_key = errors.groupBy("article_id").agg(F.min("error_text").alias("error_text"))
    part = [c for c in feed_cols if c in prepared.entries.columns]
    entries = prepared.entries.join(by_key, "article_id", "left").withColumn("failed", F.col("error_text").isNotNull())
    labelled = outcomes.ingest_outcomes(entries, "article_id", ["feed_pos", *part], excluded="excluded", failed="failed")
    # Only the ledger test is final here; whether a copy comes after an excluded
    # or processed one is for the outcome rule.
    labelled = materialize(labelled.withColumn("outcome", F.when(F.col("pre_outcome") == "duplicate", "duplicate")
                                               .otherwise(F.col("outcome"))), "labelled")
    facts = labelled.select(F.lit(run_id).alias("run_id"), "article_id", "feed_pos", *part, "outcome",
                            F.when(F.col("outcome") == "failed", F.when(F.col("article_id").isNull(), F.lit(ERR_NO_KEY))
                                   .otherwise(F.col("error_text"))).alias("error"))
    ledger_rows = sinks.ledger_rows(outcomes.ledger_additions(labelled), None, 0, processed_at=now)
    run = (outcomes.run_summary(facts, "run_id", runs=spark.createDataFrame([(run_id,)], "run_id string"))
           .withColumn("started_at", now).withColumn("completed_at", now))
    return Confirmed(drafts=drafts, outcomes=facts, ledger=ledger_rows, run=run)


def write_outputs(out: Confirmed, base: str, batch_id: int, dry_run: bool = False) -> None:
    """Write one batch: drafts, outcomes and run, ledger last."""
    sinks.append_drafts(out.drafts, f"{base}/drafts", batch_id, dry_run=dry_run)
    sinks.write_outcomes(out.outcomes, f"{base}/outcomes", batch_id)
    sinks.write_run(out.run, f"{base}/runs", batch_id)
    sinks.append_ledger(out.ledger, f"{base}/ledger", batch_id, dry_run=dry_run)
