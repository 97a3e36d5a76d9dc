"""Article bodies: page boilerplate removal, the body-source ladder, and the
assembled article table (SRC-02, JOIN-02, PRJ-05, PRJ-06, PRJ-07, PRJ-17)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions import fixed
from gleaner.functions import signals as S
from gleaner.functions import text as T
from gleaner.operators.common import materialize


def page_bodies(pages: DataFrame, html_col: str = "html",
                tags: Iterable[str] = fixed.BOILERPLATE_TAGS,
                classes: Iterable[str] = fixed.BOILERPLATE_CLASSES) -> DataFrame:
    """PRJ-06: add ``article_text`` (text of the first ``<article>``, null
    when the page has none) and ``page_text`` (text of the whole page), both
    after boilerplate removal (``functions.text.page_texts``), and drop the raw HTML.

    Row-local: run it before any join so that only extracted text, not raw
    HTML, is shuffled."""
    return (pages.withColumn("_texts", T.page_texts(F.col(html_col), tags, classes))
                 .withColumn("article_text", F.col("_texts.article_text"))
                 .withColumn("page_text", F.col("_texts.page_text"))
                 .drop("_texts", html_col))


def longer_than(body: F.Column, min_chars: int) -> F.Column:
    """PRJ-05 test ``len(strip_tags(body)) > min_chars`` without running the
    tag regex when the answer is already known: stripping only shortens, so
    a body of at most ``min_chars`` characters fails, and one without ``<``
    is its own stripped form.  Null is false."""
    n = F.length(body)
    return (F.when(body.isNull() | (n <= min_chars), F.lit(False))
             .when(F.instr(body, "<") == 0, F.lit(True))
             .otherwise(F.length(T.strip_tags(body)) > min_chars))


def choose_body(feed_body: F.Column, main_text: F.Column, article_text: F.Column,
                page_text: F.Column, min_chars: int = fixed.MIN_BODY_CHARS) -> F.Column:
    """PRJ-07 as a struct(body, body_source): the feed body when its
    tag-stripped length is over ``min_chars``; else main-content text when
    over ``min_chars``; else the ``<article>`` text; else the whole page."""
    feed_ok = longer_than(feed_body, min_chars)
    main_ok = F.coalesce(F.length(main_text) > min_chars, F.lit(False))
    return (F.when(feed_ok, F.struct(feed_body.alias("body"), F.lit("feed").alias("body_source")))
             .when(main_ok, F.struct(main_text.alias("body"), F.lit("main").alias("body_source")))
             .when(article_text.isNotNull(),
                   F.struct(article_text.alias("body"), F.lit("article").alias("body_source")))
             .when(page_text.isNotNull(),
                   F.struct(page_text.alias("body"), F.lit("page").alias("body_source")))
             .otherwise(F.struct(F.lit(None).cast("string").alias("body"),
                                 F.lit("missing").alias("body_source"))))


def body_ladder(feed: DataFrame, pages: DataFrame,
                feed_key: str = "url", page_key: str = "url",
                feed_body: str = "feed_content", main_col: str | None = None,
                min_chars: int = fixed.MIN_BODY_CHARS,
                html_col: str = "html", crawl_col: str | None = None) -> DataFrame:
    """PRJ-07 + JOIN-02: add ``body`` and ``body_source`` to the feed.

    Rows whose feed body is long enough, and rows without a page key, never
    touch the pages.  Of the pages only those that a short row asks for are
    kept (a semi join on the thin keys, written once: where their measured size
    allows it they go to the pages and no HTML is shuffled) before any text is extracted.  A page
    crawled several times counts once: a crawl with an article before one
    without, then the latest by ``crawl_col`` (if there is one), then the one
    with the greater text.  A row with no page gets ``body_source = 'missing'``."""
    long_enough = longer_than(F.col(feed_body), min_chars)
    blank = F.col(feed_key).isNull() | (F.trim(F.col(feed_key).cast("string")) == "")
    settled = feed.where(long_enough | blank)
    short = feed.where(~long_enough & ~blank)
    extra = [c for c in (main_col, crawl_col) if c]
    wanted = materialize(short.select(F.col(feed_key).alias(page_key)).distinct(), "wanted")
    bodies = page_bodies(pages.select(page_key, html_col, *extra).join(wanted, page_key, "left_semi"), html_col)
    text_cols = ["article_text", "page_text"] + ([main_col] if main_col else [])
    best = F.struct(F.col("article_text").isNotNull().alias("_has"),
                    *([F.col(crawl_col)] if crawl_col else []), *text_cols)
    bodies = (bodies.groupBy(F.col(page_key).alias("_page_key")).agg(F.max(best).alias("_b"))
                    .select("_page_key", *[F.col("_b")[c].alias(c) for c in text_cols]))

    none = F.lit(None).cast("string")
    done = settled.withColumn("_pick", choose_body(F.col(feed_body), none, none, none, min_chars))
    joined = short.join(bodies, short[feed_key] == bodies["_page_key"], "left")
    pick = choose_body(none, F.col(main_col) if main_col else none, F.col("article_text"),
                       F.col("page_text"), min_chars)
    found = joined.withColumn("_pick", pick).drop("_page_key", *text_cols)
    return (done.unionByName(found).withColumn("body", F.col("_pick.body"))
                .withColumn("body_source", F.col("_pick.body_source")).drop("_pick"))


def assemble_articles(df: DataFrame, body_col: str = "body",
                      cap: int | None = None,
                      disclaimers: Iterable[str] = fixed.DISCLAIMER_PATTERNS,
                      markup: bool = True, strict_cap: bool = False) -> DataFrame:
    """PRJ-17: add ``clean_text`` and ``extracted_insights`` (key points).

    The cleaned line array is computed once and feeds both columns."""
    lines = T.clean_lines(body_col, list(disclaimers), markup=markup)
    return (df.withColumn("_lines", lines)
              .withColumn("clean_text", F.array_join("_lines", "\n"))
              .withColumn("extracted_insights",
                          S.key_points("_lines", cap=cap, strict_cap=strict_cap))
              .drop("_lines"))
