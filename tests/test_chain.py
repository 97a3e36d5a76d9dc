"""The job chain as polls: retries, replays, late answers, slots across batches."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from gleaner.operators import states
from gleaner.plans import chain

FEED = ("article_id string, title string, author string, url string, published_at timestamp, feed_content string, "
        "feed_pos long, feed_file string")
GOOD = '{"delivery_mode":"single","single_tweet":"post"}'


@pytest.fixture()
def base(spark):
    """Poll 0: a and b wait, c's author is excluded, b's second copy and a missing key are settled."""
    base = tempfile.mkdtemp(prefix="gleaner-chain-")
    body = "x" * 600
    rows = [("a", "A", "ann", "u/a", None, body, 1, "f"), ("b", "B", "bob", "u/b", None, body, 2, "f"),
            ("c", "C", "eve", "u/c", None, body, 3, "f"), ("b", "B", "bob", "u/b", None, body, 4, "f"),
            (None, "N", "ann", "", None, body, 5, "f")]
    chain.poll_prepare(spark.createDataFrame(rows, FEED), 0, _pages(spark), base, excluded_authors=["eve"])
    return base


def _pages(spark):
    return spark.createDataFrame([], "url string, html string")


def _answers(spark, rows, value="response"):
    return spark.createDataFrame(rows, f"article_id string, {value} string, attempt int")


def _states(spark, base):
    return {r.article_id: (r.state, r.attempt) for r in states.read_states(spark, base).collect()}


def _outcomes(spark, base):
    return sorted(((r.stage, r.batch_id, r.article_id, r.attempt, r.outcome) for r in spark.read.parquet(f"{base}/outcomes").collect()), key=str)


def test_first_poll_settles_what_the_model_never_sees(spark, base):
    assert _states(spark, base) == {"a": ("waiting", 1), "b": ("waiting", 1)}
    assert [x[2:] for x in _outcomes(spark, base)] == sorted(
        [("b", None, "duplicate"), ("c", None, "excluded"), (None, None, "failed")], key=str)
    assert {r.article_id for r in spark.read.parquet(f"{base}/ledger").collect()} == {"c"}


def test_failed_articles_come_back_without_new_entries(spark, base):
    """a is invalid twice, b is refused once; a poll without entries offers them again."""
    chain.poll_deliver(_answers(spark, [("a", "no json", 1), ("b", GOOD, None)]), 0, base)
    chain.poll_confirm(_answers(spark, [("b", None, 1)], "answer"), 0, base)
    assert _states(spark, base) == {"a": ("failed", 1), "b": ("failed", 1)}
    chain.poll_retry(spark, base, _pages(spark), 0, max_attempts=3)
    assert _states(spark, base) == {"a": ("waiting", 2), "b": ("waiting", 2)}
    again = {r.article_id: r.attempt for r in spark.read.parquet(f"{base}/articles/poll=retry-0").collect()}
    assert again == {"a": 2, "b": 2}
    chain.poll_deliver(_answers(spark, [("a", "no json", 2), ("b", GOOD, 2)]), 1, base)
    chain.poll_confirm(_answers(spark, [("b", '{"id": 7}', 2)], "answer"), 1, base)
    chain.poll_retry(spark, base, _pages(spark), 1, max_attempts=3)
    chain.poll_deliver(_answers(spark, [("a", GOOD, 3)]), 2, base)
    chain.poll_confirm(_answers(spark, [("a", '{"id": 8}', 3)], "answer"), 2, base)
    assert _states(spark, base) == {"a": ("sent", 3), "b": ("sent", 2)}
    assert {r.article_id for r in spark.read.parquet(f"{base}/ledger").collect()} == {"a", "b", "c"}
    drafts = {r.article_id: r.draft_remote_id for r in spark.read.parquet(f"{base}/drafts").collect()}
    assert drafts == {"a": "8", "b": "7"}
    # Attempts run out: nothing is offered beyond max_attempts.
    chain.poll_retry(spark, base, _pages(spark), 2, max_attempts=3)
    assert spark.read.parquet(f"{base}/articles/poll=retry-2").count() == 0


def test_a_replayed_batch_changes_nothing(spark, base):
    landed = _answers(spark, [("a", GOOD, 1), ("a", GOOD, 1), ("b", "no json", 1), ("z", GOOD, None), ("a", GOOD, 0)])
    chain.poll_deliver(landed, 0, base)
    first = _states(spark, base), _outcomes(spark, base), sorted(r.reason for r in spark.read.parquet(f"{base}/ignored").collect())
    assert first[0] == {"a": ("requested", 1), "b": ("failed", 1)} and first[2] == ["doubled", "late", "unknown"]
    chain.poll_deliver(landed, 0, base)
    assert (_states(spark, base), _outcomes(spark, base),
            sorted(r.reason for r in spark.read.parquet(f"{base}/ignored").collect())) == first
    assert spark.read.parquet(f"{base}/outbox").count() == 1
    # The same responses in a later batch are late: no second post.
    chain.poll_deliver(landed, 1, base)
    assert spark.read.parquet(f"{base}/outbox").count() == 1
    # A replay of the first poll offers the same articles.
    before = _states(spark, base)
    known = spark.read.parquet(f"{base}/entries/poll=prepare-0")
    assert known.count() == 5 and before["a"] == ("requested", 1)


def test_states_survive_compaction(spark, base):
    chain.poll_deliver(_answers(spark, [("a", GOOD, 1), ("b", "no json", 1)]), 0, base)
    chain.poll_confirm(_answers(spark, [("a", '{"id": 1}', 1)], "answer"), 0, base)
    states.compact_states(spark, base)
    assert _states(spark, base) == {"b": ("failed", 1)}  # sent articles are in the ledger
    chain.poll_retry(spark, base, _pages(spark), 0)
    assert _states(spark, base) == {"b": ("waiting", 2)}
    states.compact_states(spark, base)
    chain.poll_deliver(_answers(spark, [("b", GOOD, 2), ("a", GOOD, None)]), 1, base)
    assert _states(spark, base) == {"b": ("requested", 2)}
    assert [r.reason for r in spark.read.parquet(f"{base}/ignored/stage=deliver/batch_id=1").collect()] == ["unknown"]
    plan = states.read_states(spark, base)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "batch_id" in plan


def test_slots_follow_those_of_earlier_batches(spark, base):
    how = {"publish_mode": "schedule", "now": F.lit("2030-01-01 00:00:00").cast("timestamp"), "spacing_minutes": 30}
    chain.poll_deliver(_answers(spark, [("b", GOOD, 1)]), 0, base, **how)
    chain.poll_deliver(_answers(spark, [("a", GOOD, 1)]), 1, base, **how)
    slots = {r.article_id: r.slot_text for r in spark.read.parquet(f"{base}/outbox").collect()}
    at = {k: dt.datetime.fromisoformat(v.replace("Z", "+00:00")) for k, v in slots.items()}
    assert at["b"] == dt.datetime(2030, 1, 1, tzinfo=dt.timezone.utc) and at["a"] - at["b"] == dt.timedelta(minutes=30)


def test_latest_state_needs_no_clock(spark):
    facts = [("a", 1, "waiting"), ("a", 2, "waiting"), ("a", 1, "failed"), ("b", 1, "sent"), ("b", 1, "requested"), ("c", 3, "failed")]
    df = spark.createDataFrame([(*f, "p", None) for f in facts], states.FACTS)
    got = {r.article_id: (r.state, r.attempt) for r in states.latest_states(df).collect()}
    assert got == {"a": ("waiting", 2), "b": ("sent", 1), "c": ("failed", 3)}
