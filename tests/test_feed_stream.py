import datetime as dt
import hashlib
import os
import re
import tempfile

from pyspark.sql import functions as F

from gleaner.operators.keys import article_key
from gleaner.sources.feed import read_feed
from gleaner.streaming import start_feed_stream

RSS = """<?xml version="1.0"?>
<rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/"
     xmlns:dc="http://purl.org/dc/elements/1.1/">
<channel><title>t</title>
<item><title>  First  </title><link>https://x/a</link><guid isPermaLink="false">g-1</guid>
  <dc:creator>Jane Roe</dc:creator><pubDate>Tue, 05 Jan 2027 10:00:00 +0200</pubDate>
  <content:encoded><![CDATA[<p>Body one</p>]]></content:encoded></item>
<item><title>Second</title><link>https://x/b</link><guid></guid>
  <pubDate>bad date</pubDate><description>Summary two</description></item>
</channel></rss>
"""


def _land(text: str, name: str) -> str:
    d = tempfile.mkdtemp(prefix="gleaner-feed-")
    with open(os.path.join(d, name), "w") as f:
        f.write(text)
    return d


def test_read_rss(spark):
    d = _land(RSS, "feed.xml")
    rows = {r.url: r for r in read_feed(spark, d).collect()}
    a, b = rows["https://x/a"], rows["https://x/b"]
    assert a.article_id == hashlib.sha256(b"g-1").hexdigest()
    assert b.article_id == hashlib.sha256(b"https://x/b").hexdigest()
    assert a.title == "First" and a.author == "Jane Roe"
    assert a.published_at == dt.datetime(2027, 1, 5, 8, 0)
    assert b.published_at is None
    assert a.feed_content == "<p>Body one</p>" and b.feed_content == "Summary two"
    assert a.feed_pos < b.feed_pos


def _docs_stream(spark, path, schema):
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
            .select(article_key(id_col=F.col("text")).alias("article_id"),
                    F.col("doc_id").cast("string").alias("url"), F.col("source").alias("title"),
                    F.lit(None).cast("timestamp").alias("published_at"),
                    F.col("doc_id").alias("feed_pos")))


def test_stream_pieces_equal_batch_and_replay_adds_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    land = tempfile.mkdtemp(prefix="gleaner-land-")
    for i in range(3):  # the same feed landed in three pieces
        docs.where(F.col("doc_id") % 3 == i).coalesce(1).write.parquet(f"{land}/piece={i}")
    base = tempfile.mkdtemp(prefix="gleaner-stream-")
    src = _docs_stream(spark, f"{land}/piece=*", docs.schema)
    q = start_feed_stream(src, f"{base}/ck", f"{base}/ledger")
    q.awaitTermination()
    ledger = spark.read.parquet(f"{base}/ledger")
    batch = docs.groupBy(F.sha2("text", 256).alias("article_id")).agg(F.min("doc_id").alias("d"))
    assert ledger.count() == batch.count()
    assert ledger.select("article_id").distinct().count() == ledger.count()
    # Replaying every file under a new checkpoint adds no ledger rows.
    q2 = start_feed_stream(_docs_stream(spark, f"{land}/piece=*", docs.schema), f"{base}/ck2",
                           f"{base}/ledger")
    q2.awaitTermination()
    assert spark.read.parquet(f"{base}/ledger").count() == batch.count()


def test_read_queue_pages(spark):
    import datetime as dt

    from gleaner.operators.schedule import latest_queued
    from gleaner.sources.tables import read_queue
    d = tempfile.mkdtemp(prefix="gleaner-queue-")
    pages = {
        "page_0.json": '{"results": [{"scheduled_date": "2027-01-05T10:00:00+02:00"}], "next": "p1"}',
        "page_1.json": '{"results": [{"publishAt": "2027-01-06T00:00:00Z"}]}',
        "page_12.json": '{"results": [{"publishAt": "2030-01-01T00:00:00Z"}]}',
        "page_2.json": '["not", "a", "dict"]',
        "page_3.json": '{"publishAt": "2031-01-01T00:00:00Z", broken',
    }
    for name, body in pages.items():
        with open(os.path.join(d, name), "w") as f:
            f.write(body)
    q = read_queue(spark, d)
    assert sorted(r.page for r in q.collect()) == [0, 1, 12]
    now = F.lit(dt.datetime(2026, 1, 1))
    assert latest_queued(q, now, max_pages=10).first().latest == dt.datetime(2027, 1, 6, 0, 0)
    assert latest_queued(q, now).first().latest == dt.datetime(2030, 1, 1, 0, 0)


def test_failed_rows_are_retried_next_batch(spark):
    """STR-04: a row that fails in one micro-batch is carried in a retry
    table and processed by a later batch."""
    land = tempfile.mkdtemp(prefix="gleaner-retry-land-")
    base = tempfile.mkdtemp(prefix="gleaner-retry-")
    schema = "article_id string, url string, title string, published_at timestamp, feed_pos long"
    spark.createDataFrame([("A", "u", "t", None, 1)], schema).coalesce(1).write.parquet(f"{land}/b0")
    spark.createDataFrame([("B", "u", "t", None, 2)], schema).coalesce(1).write.parquet(f"{land}/b1")
    calls = {"n": 0}

    def decide(df):
        calls["n"] += 1
        first = calls["n"] == 1  # the service is down during the first batch
        return df.withColumn("excluded", F.lit(False)).withColumn("failed", F.lit(first))

    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{land}/b*")
    q = start_feed_stream(src, f"{base}/ck", f"{base}/ledger", retry_path=f"{base}/retry",
                          outcomes_path=f"{base}/outcomes", decide=decide)
    q.awaitTermination()
    got = sorted(r.article_id for r in spark.read.parquet(f"{base}/ledger").collect())
    assert got == ["A", "B"]
    oc = {(r.article_id, r.batch_id): r.outcome for r in spark.read.parquet(f"{base}/outcomes").collect()}
    assert oc[("A", 0)] == "failed" and oc[("A", 1)] == "processed"


def test_prepare_stream_writes_prompts_per_batch(spark):
    from gleaner.streaming import start_prepare_stream
    land = tempfile.mkdtemp(prefix="gleaner-prep-land-")
    with open(os.path.join(land, "feed.xml"), "w") as f:
        f.write(RSS)
    pages = spark.createDataFrame([("https://x/b", "<article><p>Page b text</p></article>")],
                                  "url string, html string")
    base = tempfile.mkdtemp(prefix="gleaner-prep-")
    q = start_prepare_stream(read_feed(spark, land, streaming=True), pages, f"{base}/ck", base,
                             f"{base}/ledger", excluded_authors=["jane roe"])
    q.awaitTermination()
    prompts = spark.read.parquet(f"{base}/articles").collect()
    assert [r.url for r in prompts] == ["https://x/b"]
    assert prompts[0].body_source == "article" and "Page b text" in prompts[0].prompt
    entries = {r.url: r.pre_outcome for r in spark.read.parquet(f"{base}/entries").collect()}
    assert entries == {"https://x/a": "excluded", "https://x/b": None}


ATOM = """<?xml version="1.0"?>
<feed xmlns="http://www.w3.org/2005/Atom"><title>t</title>
<entry><title type="html">One</title><link rel="self" href="https://x/self"/><link href="https://x/1"/>
  <id>tag:1</id><author><name>Ann</name></author><updated>2027-01-05T10:00:00Z</updated>
  <content type="html">&lt;p&gt;Body&lt;/p&gt;</content><summary>short</summary></entry>
<entry><title>Two</title><link rel="self" href="https://x/2"/><summary>Only summary</summary></entry>
</feed>
"""


def test_read_atom_beside_rss(spark):
    d = _land(ATOM, "atom.xml")
    with open(os.path.join(d, "feed.xml"), "w") as f:
        f.write(RSS)
    rows = {r.title: r for r in read_feed(spark, d).collect()}
    assert set(rows) == {"First", "Second", "One", "Two"}
    one, two = rows["One"], rows["Two"]
    assert (one.url, one.author, one.feed_content) == ("https://x/1", "Ann", "<p>Body</p>")
    assert one.article_id == hashlib.sha256(b"tag:1").hexdigest() and one.published_at == dt.datetime(2027, 1, 5, 10)
    assert (two.url, two.author, two.feed_content) == ("https://x/2", None, "Only summary")


SCHEMA = "article_id string, url string, title string, published_at timestamp, feed_pos long"


def _batches(spark, base, batches, decide):
    from gleaner.streaming import handle_batch
    for i, keys in enumerate(batches):
        df = spark.createDataFrame([(k, "u", "t", None, p) for p, k in enumerate(keys)], SCHEMA)
        handle_batch(df, i, f"{base}/ledger", f"{base}/retry", f"{base}/outcomes", decide)
    facts = spark.read.parquet(f"{base}/outcomes").collect()
    return sorted((r.batch_id, r.article_id, r.outcome) for r in facts)


def test_retry_ends_after_success(spark):
    """Fail, succeed, and two later batches: no fact for the article after that."""
    base = tempfile.mkdtemp(prefix="gleaner-retry-")
    fails = lambda df: df.withColumn("excluded", F.lit(False)).withColumn("failed", (F.col("article_id") == "A") & (F.col("_new") == 1))
    got = _batches(spark, base, [["A"], ["B"], ["C"], ["D"]], fails)
    assert got == [(0, "A", "failed"), (1, "A", "processed"), (1, "B", "processed"), (2, "C", "processed"), (3, "D", "processed")]


def test_retry_and_new_copy_with_one_position(spark):
    base = tempfile.mkdtemp(prefix="gleaner-retry-")
    fails = lambda df: df.withColumn("excluded", F.lit(False)).withColumn("failed", (F.col("article_id") == "A") & (F.col("batch") == 0))
    from gleaner.streaming import handle_batch
    for i in range(2):
        df = spark.createDataFrame([("A", "u", "t", None, 0)], SCHEMA)
        handle_batch(df, i, f"{base}/ledger", f"{base}/retry", f"{base}/outcomes",
                     lambda d, i=i: fails(d.withColumn("batch", F.lit(i))).drop("batch"))
    facts = sorted((r.batch_id, r.outcome) for r in spark.read.parquet(f"{base}/outcomes").collect())
    assert facts == [(0, "failed"), (1, "duplicate"), (1, "processed")]


def test_waiting_articles_are_not_prepared_again(spark):
    from gleaner.streaming import start_prepare_stream
    land, base = tempfile.mkdtemp(prefix="gleaner-prep-land-"), tempfile.mkdtemp(prefix="gleaner-prep-")
    pages = spark.createDataFrame([], "url string, html string")
    for name in ("a.xml", "b.xml"):  # the same feed polled twice
        with open(os.path.join(land, name), "w") as f:
            f.write(RSS)
        start_prepare_stream(read_feed(spark, land, streaming=True), pages, f"{base}/ck", base, f"{base}/ledger").awaitTermination()
    assert spark.read.parquet(f"{base}/articles").groupBy("batch_id").count().collect()[0]["count"] == 2
    again = spark.read.parquet(f"{base}/entries").where("batch_id = 1").collect()
    assert {r.pre_outcome for r in again} == {"duplicate"}


def _ledger_rows(spark, ids):
    return spark.createDataFrame([(i, "u", "t", None, None) for i in ids],
                                 "article_id string, url string, title string, published_at timestamp, processed_at timestamp")


def test_a_batch_reads_only_the_ledger_folders_of_its_keys(spark):
    from gleaner import sinks
    from gleaner.sources.tables import ledger_of, read_ledger

    path = f"{tempfile.mkdtemp(prefix='gleaner-ledger-')}/ledger"
    keys = lambda n: [hashlib.sha256(f"{n}-{i}".encode()).hexdigest() for i in range(60)]
    for n in range(3):
        sinks.append_ledger(_ledger_rows(spark, keys(n)), path, n)
    mine = [k for k in keys(0) + keys(2) + keys(9) if k[0] in "3a"] + [None]
    batch = spark.createDataFrame([(k,) for k in mine], "article_id string")
    seen = ledger_of(spark, path, batch, but_batch=2)
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*prefix#\d+ IN \((3,a|a,3)\)", plan), plan
    got = {r.article_id for r in seen.collect()}
    assert got == {k for n in (0, 1) for k in keys(n) if k[0] in "3a"}
    # Folding keeps every row and its own batch out of a replay; nothing is read twice.
    sinks.compact_ledger(spark, path, upto=1)
    sinks.append_ledger(_ledger_rows(spark, keys(3)), path, 3)
    assert sorted(r.article_id for r in read_ledger(spark, path).collect()) == sorted(k for n in range(4) for k in keys(n))
    assert {r.article_id for r in ledger_of(spark, path, batch, but_batch=2).collect()} == {
        k for n in (0, 1, 3) for k in keys(n) if k[0] in "3a"}
    sinks.compact_ledger(spark, path, upto=3)
    assert read_ledger(spark, path).count() == 240
    empty = spark.createDataFrame([], "article_id string")
    assert ledger_of(spark, path, empty).collect() == []


def test_a_batch_leaves_no_tables_behind(spark):
    import glob

    from gleaner.session import shared_dir
    from gleaner.streaming import handle_batch

    base = tempfile.mkdtemp(prefix="gleaner-scratch-")
    tables = shared_dir(spark, "tables").removeprefix("file:")
    before = set(glob.glob(f"{tables}/*"))
    rows = spark.createDataFrame([("a", "u", "t", None, 1)], "article_id string, url string, title string, published_at timestamp, feed_pos long")
    handle_batch(rows, 0, f"{base}/ledger", f"{base}/retry", f"{base}/outcomes")
    assert spark.read.parquet(f"{base}/ledger").count() == 1
    assert set(glob.glob(f"{tables}/*")) == before


def test_bounded_dedup_restarts_from_its_checkpoint(spark):
    """State and watermark survive a restart: copies within the delay stay away."""
    from gleaner.streaming import bounded_dedup

    base = tempfile.mkdtemp(prefix="gleaner-bounded-")
    at = lambda h: dt.datetime(2027, 1, 1, h)
    pieces = [[("a", at(0)), (None, at(0))], [("a", at(1)), ("b", at(1)), (None, at(1))], [("b", at(2)), ("c", at(6))],
              [("d", at(1)), ("c", at(7)), ("a", at(7))]]
    got = []
    for k, rows in enumerate(pieces):
        spark.createDataFrame(rows, "article_id string, t timestamp").coalesce(1).write.parquet(f"{base}/in/{k}")
        src = spark.readStream.schema("article_id string, t timestamp").parquet(f"{base}/in/*")
        q = bounded_dedup(src, "t", "2 hours").writeStream.format("parquet").option("checkpointLocation", f"{base}/ck").option(
            "path", f"{base}/out").trigger(availableNow=True).start()
        q.awaitTermination()
        assert q.exception() is None
        now = [(r.article_id, r.t.hour) for r in spark.read.parquet(f"{base}/out").collect()]
        got.append(sorted(set(now) - {x for g in got for x in g}, key=str))
    # d is older than the watermark; a was forgotten after six o'clock less the delay.
    assert got == [[("a", 0), (None, 0)], [("b", 1)], [("c", 6)], [("a", 7)]]
