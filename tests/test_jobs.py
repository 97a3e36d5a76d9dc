import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from gleaner import sinks
from gleaner.operators import article
from gleaner.operators.common import materialize
from gleaner.operators.keys import article_key
from gleaner.plans import jobs
from gleaner.session import shared_dir
from gleaner.sources import feed as feed_source


def _feed(spark, rows):
    df = spark.createDataFrame(rows, "guid string, author string, url string, feed_content string, feed_pos long")
    return df.select(article_key(None, "guid", "url").alias("article_id"), F.col("guid").alias("title"),
                     "author", "url", F.lit(None).cast("timestamp").alias("published_at"),
                     "feed_content", "feed_pos", F.lit("f.xml").alias("feed_file"))


ROWS = [  # guid, author, link, body, pos
    ("g1", "Staff", "https://x/1", "<p>" + "Long body 10-2 ATS trend. " * 40 + "</p>", 1),
    ("g2", "Jane Roe", "https://x/2", "short", 2),
    ("g3", "Staff", "https://x/3", "short", 3),
    ("g0", "Staff", "https://x/0", "short", 4),
    ("g1", "Staff", "https://x/1", "copy", 5),
    ("g4", "Staff", "https://x/4", "short", 6),
    (None, "Staff", None, "no key", 7),
]


@pytest.fixture
def prep(spark):
    feed = _feed(spark, ROWS)
    pages = spark.createDataFrame([("https://x/3", "<article><p>Page three 55-40</p></article>"),
                                   ("https://x/4", "<p>Four</p>")], "url string, html string")
    ledger = feed.where(F.col("title") == "g0").select("article_id")
    return jobs.prepare(feed, pages, ledger, excluded_authors=["jane roe"])


def _ids(prep):
    return {r.title: r.article_id for r in prep.articles.collect()}


def _responses(spark, rows):
    return spark.createDataFrame([(k, json.dumps(p) if isinstance(p, dict) else p) for k, p in rows],
                                 "article_id string, response string")


def _single(text):
    return {"delivery_mode": "single", "single_tweet": text, "thread": []}


def test_prepare_deliver_confirm(spark, prep):
    arts = {r.title: r for r in prep.articles.collect()}
    assert set(arts) == {"g1", "g3", "g4"}
    assert arts["g3"].clean_text == "Page three 55-40"
    assert arts["g1"].prompt.startswith("Headline: g1\nByline: Staff\nPublished: Unknown")
    ids = _ids(prep)
    resp = _responses(spark, [(ids["g1"], _single("Take the over.")), (ids["g3"], _single("x" * 300)),
                              (ids["g4"], _single("Four."))])
    now = F.lit(dt.datetime(2026, 1, 1, 10, 0))
    queue = spark.createDataFrame([(0, '{"publish_at": "2026-01-01T10:10:00Z"}')], "page int, body string")
    sent = jobs.deliver(prep, resp, publish_mode="schedule", now=now, queue=queue)
    ob = {r.article_id: json.loads(r.payload) for r in sent.outbox.collect()}
    assert set(ob) == {ids["g1"], ids["g4"]}
    assert ob[ids["g1"]]["publish_at"] == "2026-01-01T10:40:00Z" and ob[ids["g4"]]["publish_at"] == "2026-01-01T11:10:00Z"
    assert [p["text"] for p in ob[ids["g1"]]["platforms"]["x"]["posts"]] == ["Take the over.", "Read more: https://x/1"]
    answers = spark.createDataFrame([(ids["g1"], '{"id": 41}'), (ids["g4"], None)], "article_id string, answer string")
    out = jobs.confirm(prep, sent, answers, "run_1", now=now)
    facts = {r.feed_pos: (r.outcome, r.error) for r in out.outcomes.collect()}
    assert {p: o for p, (o, _) in facts.items()} == {1: "processed", 2: "excluded", 3: "failed", 4: "duplicate",
                                                     5: "duplicate", 6: "failed", 7: "failed"}
    assert facts[6][1] == jobs.ERR_NO_ANSWER and facts[7][1] == jobs.ERR_NO_KEY
    drafts = out.drafts.collect()
    assert [(d.article_id, d.draft_remote_id, d.publish_mode) for d in drafts] == [(ids["g1"], "41", "schedule")]
    run = out.run.first()
    assert (run.articles_found, run.articles_processed, run.articles_failed, run.status) == \
        (7, 1, 3, "completed_with_errors")
    # No ledger row without an answer.
    excluded = prep.entries.where("title = 'g2'").first().article_id
    assert sorted(r.article_id for r in out.ledger.collect()) == sorted([ids["g1"], excluded])
    base = tempfile.mkdtemp(prefix="gleaner-jobs-")
    jobs.write_outputs(out, base, 7)
    jobs.write_outputs(out, base, 7)  # a retried batch replaces its own rows
    assert spark.read.parquet(f"{base}/ledger").count() == 2
    assert os.path.isdir(f"{base}/ledger/batch_id=7")


def test_dry_run_sends_nothing_and_counts_as_processed(spark, prep):
    ids = _ids(prep)
    sent = jobs.deliver(prep, _responses(spark, [(ids["g1"], _single("ok"))]))
    out = jobs.confirm(prep, sent, None, "run_2")
    assert out.drafts.count() == 0
    assert {r.feed_pos: r.outcome for r in out.outcomes.collect()}[1] == "processed"


def test_bad_publish_mode_fails_articles(spark, prep):
    sent = jobs.deliver(prep, _responses(spark, [(_ids(prep)["g1"], _single("ok"))]), publish_mode="sometimes")
    assert sent.outbox.count() == 0
    out = jobs.confirm(prep, sent, spark.createDataFrame([], "article_id string, answer string"), "run_3")
    facts = {r.feed_pos: (r.outcome, r.error) for r in out.outcomes.collect()}
    assert facts[1] == ("failed", "Invalid publish mode") and out.drafts.count() == 0


def _labels(spark, rows, ok):
    """Outcomes by position of a batch whose articles in ``ok`` are answered."""
    feed = _feed(spark, rows)
    prep = jobs.prepare(feed, spark.createDataFrame([], "url string, html string"), None, excluded_authors=["ex"])
    resp = prep.articles.where(F.col("title").isin(ok)).select("article_id", F.lit(json.dumps(_single("ok"))).alias("response"))
    sent = jobs.deliver(prep, resp)
    answers = sent.outbox.select("article_id", F.lit('{"id": 1}').alias("answer"))
    return {r.feed_pos: r.outcome for r in jobs.confirm(prep, sent, answers, "r").outcomes.collect()}


def test_outcomes_of_copies_by_excluded_authors(spark):
    rows = [("a", "Staff", "u", "b", 1), ("a", "ex", "u", "b", 2), ("a", "Staff", "u", "b", 3),  # processed, then excluded
            ("b", "ex", "u", "b", 4), ("b", "ex", "u", "b", 5), ("b", "Staff", "u", "b", 6),  # two excluded copies
            ("c", "Staff", "u", "b", 7), ("c", "ex", "u", "b", 8), ("c", "Staff", "u", "b", 9)]  # failed, then excluded
    assert _labels(spark, rows, ["a", "b"]) == {
        1: "processed", 2: "duplicate", 3: "duplicate", 4: "excluded", 5: "duplicate", 6: "duplicate",
        7: "failed", 8: "excluded", 9: "duplicate"}


def test_empty_batch_has_a_run_row(spark):
    prep = jobs.prepare(_feed(spark, ROWS).limit(0), spark.createDataFrame([], "url string, html string"))
    sent = jobs.deliver(prep, spark.createDataFrame([], "article_id string, response string"))
    run = jobs.confirm(prep, sent, None, "run_0").run.first()
    assert (run.run_id, run.articles_found, run.status) == ("run_0", 0, "completed")


def test_fact_check_and_promo_rewrite_steps(spark, prep):
    ids = _ids(prep)
    drafts = _responses(spark, [(ids["g1"], _single("Check out this edge")), (ids["g3"], _single("Plain.")), (ids["g4"], "not json")])
    checks = {r.article_id: r.prompt for r in jobs.fact_check_table(prep, drafts).collect()}
    assert set(checks) == {ids["g1"], ids["g3"]} and '"single_tweet":"Plain."' in checks[ids["g3"]]
    flagged = jobs.promo_rewrite_table(prep, drafts).collect()
    assert [r.article_id for r in flagged] == [ids["g1"]]
    none = spark.createDataFrame([], "article_id string, response string")
    for rewrites in (None, none):
        errors = {r.article_id: r.error_text for r in jobs.deliver(prep, drafts, rewrites=rewrites).failures.collect()}
        assert errors[ids["g1"]] == jobs.ERR_NOT_REWRITTEN and set(errors) == {ids["g1"], ids["g4"]}
    done = jobs.deliver(prep, drafts, rewrites=_responses(spark, [(ids["g1"], _single("An edge."))])).outbox.collect()
    assert {r.article_id: r.single_tweet for r in done} == {ids["g1"]: "An edge.", ids["g3"]: "Plain."}


def test_the_last_attempt_wins(spark):
    r = spark.createDataFrame([("a", "zzz", 1), ("a", "abc", 2), ("b", "x", 1)], "article_id string, response string, n int")
    assert sorted(tuple(x) for x in jobs.latest_response(r, attempt_col="n").collect()) == [("a", "abc"), ("b", "x")]


def test_saved_prepared_is_the_same(spark, prep):
    base = tempfile.mkdtemp(prefix="gleaner-prep-")
    jobs.save_prepared(prep, base, 3)
    back = jobs.load_prepared(spark, base, 3)
    assert sorted(map(str, back.articles.collect())) == sorted(map(str, prep.articles.collect()))
    assert back.entries.count() == prep.entries.count()


def test_positions_may_repeat_across_feed_files(spark):
    one = _feed(spark, [("a", "Staff", "u1", "first", 0), ("b", "Staff", "u2", "x", 1)])
    two = _feed(spark, [("a", "Staff", "u1", "second", 0)]).withColumn("feed_file", F.lit("g.xml"))
    prep = jobs.prepare(one.unionByName(two), spark.createDataFrame([], "url string, html string"))
    assert prep.articles.count() == 2 and prep.entries.count() == 3


def test_an_rss_and_an_atom_file_get_one_slot_a_post(spark):
    d = tempfile.mkdtemp(prefix="gleaner-mixed-")
    rss = "".join(f"<item><guid>r{i}</guid><title>r{i}</title><link>https://r/{i}</link></item>" for i in range(3))
    atom = "".join(f'<entry><id>a{i}</id><title>a{i}</title><link href="https://a/{i}"/></entry>' for i in range(3))
    for name, text in (("one.xml", f"<rss><channel>{rss}</channel></rss>"),
                       ("two.xml", f'<feed xmlns="http://www.w3.org/2005/Atom">{atom}</feed>')):
        with open(f"{d}/{name}", "w") as f:
            f.write(text)
    spark.conf.set("spark.sql.files.minPartitionNum", "1")  # both files in one read partition
    try:
        prep = jobs.prepare(feed_source.read_feed(spark, d), spark.createDataFrame([], "url string, html string"))
        prep = jobs.Prepared(prep.entries, materialize(prep.articles, "mixed"))
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
    at = {r.article_id: (r.feed_pos, r.feed_file) for r in prep.articles.collect()}
    assert len(at) == 6 and len({p for p, _ in at.values()}) == 3
    resp = _responses(spark, [(k, _single("ok")) for k in at])
    sent = jobs.deliver(prep, resp, publish_mode="schedule", now=F.lit(dt.datetime(2026, 1, 1, 10, 0))).outbox.collect()
    assert [r.article_id for r in sorted(sent, key=lambda r: r.slot_text)] == sorted(at, key=at.get)
    first = dt.datetime(2026, 1, 1, 10, 0)
    assert sorted(r.slot_text for r in sent) == [f"{first + i * dt.timedelta(minutes=30):%Y-%m-%dT%H:%M:%SZ}" for i in range(6)]


def test_a_replay_with_an_empty_result_leaves_nothing(spark):
    base = tempfile.mkdtemp(prefix="gleaner-sink-")
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    sinks.write_outcomes(df, base, 0)
    sinks.write_outcomes(df, base, 1)
    sinks.write_outcomes(df.limit(0), base, 0)
    assert [r.batch_id for r in spark.read.parquet(base).collect()] == [1]
    sinks.write_outcomes(df.limit(0), f"{base}-empty", 0)
    assert spark.read.parquet(f"{base}-empty/batch_id=0").columns == ["k", "n"]


def test_run_id_names_its_batch():
    at = dt.datetime(2026, 5, 6, 7, 8, 9, tzinfo=dt.timezone.utc)
    a = jobs.run_id("s3://feed", 4, at)
    assert a.startswith("run_20260506T070809Z_") and len(a) == len("run_20260506T070809Z_") + 8
    assert a == jobs.run_id("s3://feed", 4, at) != jobs.run_id("s3://feed", 5, at)


def test_pages_crawled_twice_and_blank_urls(spark):
    feed = spark.createDataFrame([(1, "u1", "s"), (2, "u2", "s"), (3, " ", "s"), (4, None, "s"), (5, "u9", "s")], "id int, url string, b string")
    pages = spark.createDataFrame([("u1", "<p>404 not found</p>", 9), ("u1", "<article>Good</article>", 1),
                                   ("u2", "<article>Old</article>", 1), ("u2", "<article>New</article>", 2),
                                   (" ", "<p>blank</p>", 1)], "url string, html string, at int")
    got = {r.id: (r.body_source, r.body) for r in article.body_ladder(feed, pages, feed_body="b", crawl_col="at").collect()}
    assert got == {1: ("article", "Good"), 2: ("article", "New"), 3: ("missing", None), 4: ("missing", None), 5: ("missing", None)}


def test_shared_folder_must_be_set_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session(), "x")
