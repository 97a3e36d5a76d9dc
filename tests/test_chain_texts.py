"""Texts of the job chain are written once: by the poll that prepared them."""

import tempfile

from gleaner.operators import article, states
from gleaner.operators.common import materialize
from gleaner.plans import chain, jobs

FEED = ("article_id string, title string, author string, url string, published_at timestamp, feed_content string, "
        "feed_pos long, feed_file string")
GOOD = '{"delivery_mode":"single","single_tweet":"post"}'
BODY = "One long line of 40 percent, of words. " * 20


def _feed(spark, names="abc"):
    return spark.createDataFrame([(n, n, "ann", f"u/{n}", None, f"{n} {BODY}", i, "f") for i, n in enumerate(names)], FEED)


def _said(spark, rows, value="response"):
    return spark.createDataFrame(rows, f"article_id string, {value} string, attempt int")


def _kept(monkeypatch, *modules):
    """The columns of the tables that the stages write for themselves."""
    seen = {}
    for m in modules:
        monkeypatch.setattr(m, "materialize", lambda df, name="rows": seen.setdefault(name, df.columns) and materialize(df, name))
    return seen


def test_stages_behind_the_model_copy_no_texts(spark, monkeypatch):
    base = tempfile.mkdtemp(prefix="gleaner-chain-")
    chain.poll_prepare(_feed(spark), 0, spark.createDataFrame([], "url string, html string"), base)
    seen = _kept(monkeypatch, chain, jobs)
    chain.poll_deliver(_said(spark, [("a", GOOD, 1), ("b", GOOD, 1), ("c", "no json", 1)]), 0, base)
    chain.poll_confirm(_said(spark, [("a", '{"id": 1}', 1), ("b", None, 1)], "answer"), 0, base)
    assert {"answered_articles", "packages", "confirmed_articles", "labelled"} <= set(seen)
    assert not {c for cols in seen.values() for c in cols} & set(chain.TEXTS)
    assert {r.article_id: r.state for r in states.read_states(spark, base).collect()} == {"a": "sent", "b": "failed", "c": "failed"}


def test_an_article_offered_again_keeps_its_texts_where_they_were_written(spark):
    base, pages = tempfile.mkdtemp(prefix="gleaner-chain-"), spark.createDataFrame([], "url string, html string")
    chain.poll_prepare(_feed(spark, "ab"), 0, pages, base)
    first = {r.article_id: r for r in chain.offered(spark, base, "prepare-0").collect()}
    assert {k: r.attempt for k, r in first.items()} == {"a": 1, "b": 1}
    for batch, again in ((0, "prepare-1"), (1, "retry-0")):
        chain.poll_deliver(_said(spark, [("a", "no json", None)]), batch, base)
        if again == "prepare-1":
            chain.poll_prepare(_feed(spark, "ac"), 1, pages, base)
        else:
            chain.poll_retry(spark, base, pages, 0)
        rows = {r.article_id: r for r in spark.read.parquet(f"{base}/articles/poll={again}").collect()}
        assert rows["a"].prepared_in == "prepare-0" and rows["a"].attempt == batch + 2
        assert all(rows["a"][c] is None for c in chain.TEXTS)
        full = {r.article_id: r for r in chain.offered(spark, base, again).collect()}
        assert set(full) == set(rows) and all(full["a"][c] == first["a"][c] and full["a"][c] for c in ("prompt", "clean_text", "body"))
        assert all(full[k].prompt for k in full)


def test_bodies_are_dealt_out_once_to_find_first_copies(spark, monkeypatch):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    found = []

    def keep(df, name="rows"):
        if name == "articles":
            found.append(df._jdf.queryExecution().executedPlan().toString())
        return materialize(df, name)

    monkeypatch.setattr(jobs, "materialize", keep)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        feed = _feed(spark, "abca").drop("feed_file")
        prep = jobs.prepare(feed, spark.createDataFrame([], "url string, html string"))
        assert sorted((r.article_id, r.feed_pos) for r in prep.articles.collect()) == [("a", 0), ("b", 1), ("c", 2)]
        # Entries that are alike in key and place count once.
        twice = jobs.prepare(feed.unionByName(feed), spark.createDataFrame([], "url string, html string"))
        assert sorted(r.article_id for r in twice.articles.collect()) == ["a", "b", "c"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(found) == 2
    for plan in found:
        assert "SortMergeJoin" in plan and "Exchange" not in plan[:plan.index("SortMergeJoin")]


def test_wanted_pages_are_known_by_size(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(article, "materialize", lambda df, name="rows": seen.append(name) or materialize(df, name))
    feed = spark.createDataFrame([("u/a", "short"), ("u/b", "x" * 600), (None, "")], "url string, feed_content string")
    pages = spark.createDataFrame([("u/a", "<article>Page text</article>"), ("u/b", "<p>no</p>")], "url string, html string")
    out = article.body_ladder(feed, pages)
    assert seen == ["wanted"]
    assert sorted(r.body_source for r in out.collect()) == ["article", "feed", "missing"]
