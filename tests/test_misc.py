import datetime as dt
import os
import re
import tempfile

import pytest

from pyspark.sql import functions as F

from gleaner.functions.timefmt import parse_feed_date
from gleaner.operators import prompts
from gleaner.plans import jobs
from gleaner.sources.feed import read_feed


def test_feed_dates(spark):
    rows = ["Tue, 05 Jan 2027 10:00:00 GMT", "05 Jan 2027 10:00:00 +0200", "2027-01-05T10:00:00Z",
            "2027-01-05 10:00:00", "bad date", "", None, "Tue, 5 Jan 2027 10:00 -0500"]
    df = spark.createDataFrame([(r,) for r in rows], "d string")
    got = [r.t for r in df.select(parse_feed_date("d").alias("t")).collect()]
    assert got == [dt.datetime(2027, 1, 5, 10), dt.datetime(2027, 1, 5, 8), dt.datetime(2027, 1, 5, 10),
                   dt.datetime(2027, 1, 5, 10), None, None, None, dt.datetime(2027, 1, 5, 15)]


def test_prompt_variants(spark):
    df = spark.createDataFrame([("t", None, None, "x" * 20, ["p1", "p2", "p3"])],
                               "title string, author string, pub timestamp, clean string, pts array<string>")
    g = df.select(prompts.generate_prompt("title", "author", "pub", "clean", "pts", False,
                                          text_budget=5, max_points=2).alias("p")).first().p
    assert "Byline: Unknown" in g and "Published: Unknown" in g
    assert "\nxxxxx\n" in g and "- p1\n- p2\n" in g and "- p3" not in g and g.endswith("false.")
    e = df.select(prompts.generate_prompt("title", "author", "pub", "clean", F.array().cast("array<string>"))
                  .alias("p")).first().p
    assert "- none extracted" in e
    draft = prompts.draft_json(F.lit("single"), F.lit("hi"), F.array().cast("array<string>"))
    fc = df.select(prompts.fact_check_prompt("clean", "pts", draft).alias("p")).first().p
    assert '{"delivery_mode":"single","single_tweet":"hi","thread":[]}' in fc
    pr = df.select(prompts.promo_rewrite_prompt("clean", draft).alias("p")).first().p
    assert "Draft as JSON" in pr and "Key data points" not in pr


def test_run_id():
    rid = jobs.run_id("feed", 0, dt.datetime(2026, 1, 2, 3, 4, 5, tzinfo=dt.timezone.utc))
    assert re.fullmatch(r"run_20260102T030405Z_[0-9a-f]{8}", rid)


def test_every_run_leaves_its_row(spark):
    """Counters come from the writes; a run that dies keeps what it had counted."""
    base = tempfile.mkdtemp(prefix="gleaner-runs-")
    cols = ["articles_found", "articles_processed", "articles_failed", "skipped_duplicate", "skipped_excluded", "status"]
    row = lambda n: tuple(spark.read.parquet(f"{base}/runs/batch_id={n}").select(*cols).first())
    entries = spark.range(5).select(F.col("id").cast("string").alias("article_id"))
    with jobs.accounted_run(spark, "r0", base, 0) as run:
        run.save_prepared(jobs.Prepared(entries=entries, articles=entries))
    assert row(0) == (5, 0, 0, 0, 0, "completed")
    with pytest.raises(ZeroDivisionError):
        with jobs.accounted_run(spark, "r1", base, 1) as run:
            run.save_prepared(jobs.Prepared(entries=entries, articles=entries))
            1 / 0
    assert row(1) == (5, 0, 1, 0, 0, "failed")
    with pytest.raises(Exception, match="in a task"):
        with jobs.accounted_run(spark, "r2", base, 2) as run:
            bad = entries.withColumn("x", F.raise_error(F.lit("in a task")).cast("string"))
            run.save_prepared(jobs.Prepared(entries=bad, articles=entries))
    assert row(2) == (0, 0, 1, 0, 0, "failed")


def test_xml_feed_as_stream(spark):
    d = tempfile.mkdtemp(prefix="gleaner-xmlstream-")
    with open(os.path.join(d, "a.xml"), "w") as f:
        f.write("<rss><channel><item><title>A</title><link>https://x/a</link></item>"
                "<item><title>B</title><link>https://x/b</link></item></channel></rss>")
    s = read_feed(spark, d, streaming=True)
    assert s.isStreaming
    out = tempfile.mkdtemp(prefix="gleaner-xmlstream-out-")
    q = (s.writeStream.format("parquet").option("path", f"{out}/data")
         .option("checkpointLocation", f"{out}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted(r.url for r in spark.read.parquet(f"{out}/data").collect())
    assert got == ["https://x/a", "https://x/b"]


def test_ledger_anti_join_prefilter(spark):
    from gleaner.operators.screen import ledger_anti_join
    feed = spark.createDataFrame([("a",), ("b",), ("c",)], "article_id string")
    ledger = spark.createDataFrame([("b",), ("z",)], "article_id string")
    for pre in (False, True):
        got = sorted(r.article_id for r in ledger_anti_join(feed, ledger, prefilter=pre).collect())
        assert got == ["a", "c"]


def test_body_ladder_main_rung(spark):
    from gleaner.operators.article import body_ladder
    feed = spark.createDataFrame([("u1", "short"), ("u2", "short")], "url string, feed_content string")
    pages = spark.createDataFrame([("u1", "<article>A</article>", "m" * 501),
                                   ("u2", "<article>B</article>", "m" * 500)],
                                  "url string, html string, main string")
    got = {r.url: (r.body_source, r.body) for r in body_ladder(feed, pages, main_col="main").collect()}
    assert got["u1"] == ("main", "m" * 501)
    assert got["u2"] == ("article", "B")


def test_latest_draft_overall(spark):
    from gleaner.operators.outbox import latest_draft
    df = spark.createDataFrame([(dt.datetime(2026, 1, 1),), (dt.datetime(2026, 3, 1),)], "created_at timestamp")
    assert latest_draft(df).first().latest == dt.datetime(2026, 3, 1)


def test_duplicate_pages_do_not_duplicate_rows(spark):
    from gleaner.operators.article import body_ladder
    feed = spark.createDataFrame([("u1", "short")], "url string, feed_content string")
    pages = spark.createDataFrame([("u1", "<article>B</article>"), ("u1", "<article>A</article>")],
                                  "url string, html string")
    got = [(r.body_source, r.body) for r in body_ladder(feed, pages).collect()]
    assert got == [("article", "B")]  # no crawl time: the greater text


def test_shared_dir_uses_the_session_checkpoint_dir(spark):
    from gleaner.session import shared_dir
    shared_dir(spark, "first")
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    got = shared_dir(spark, "x/y")
    assert base and got.rstrip("/").endswith("/x/y")
    assert got.replace("file:", "").startswith(base.replace("file:", "").rstrip("/"))
