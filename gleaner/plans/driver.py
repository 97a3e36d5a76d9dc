"""Registered queries over the driver's tables and their DuckDB
oracle SQL.

Each query maps a reference operator onto the given tables (the mapping is
written next to it), runs over the whole tables, and returns a DataFrame
with scalar columns whose names equal the oracle's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions import fixed
from gleaner.functions import signals as S
from gleaner.functions import text as T
from gleaner.functions.timefmt import iso_text
from gleaner.operators import article, keys, outbox, outcomes, packages, prompts, schedule, screen
from gleaner.operators.common import materialize, spread
from gleaner.plans import sqltext as Q
from gleaner.session import use_utc
from gleaner.sources.tables import parse_responses

# Fixture parameters.
KEY_POINT_CAP = 3
LICENSE_DISCLAIMERS = [r"Released under the MIT License", r"licensed under"]
EXCLUDED_PARTS = ["ring", "hot gear"]
EXCLUDED_SOURCES = ["src1"]
THREAD_MIN_POINTS = 2
THREAD_MIN_CHARS = 1000
BATCH_CAP = 10


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _docs(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    d = _t(spark, sf_dir, "documents")
    return spread(d.select(*cols) if cols else d, "doc_id")


# --------------------------------------------------------------------------
# Text: clean lines, flags, key points


def q_clean_documents(spark, sf_dir):
    d = _docs(spark, sf_dir, "doc_id", "text")
    lines = T.clean_lines("text")
    return (d.withColumn("_l", lines)
             .select("doc_id",
                     F.array_join("_l", "\n").alias("clean_text"),
                     F.size("_l").cast("bigint").alias("n_lines")))


def o_clean_documents():
    return f"""
    SELECT doc_id, array_to_string(l, chr(10)) AS clean_text, CAST(len(l) AS BIGINT) AS n_lines
    FROM (SELECT doc_id, {Q.clean_lines('text')} AS l FROM documents)"""


def q_key_points(spark, sf_dir):
    d = _docs(spark, sf_dir, "doc_id", "text")
    pts = S.key_points(T.clean_lines("text"), cap=KEY_POINT_CAP)
    return (d.select("doc_id", F.posexplode(pts).alias("_i", "point"))
             .select("doc_id", (F.col("_i") + 1).cast("bigint").alias("point_no"), "point"))


def o_key_points():
    src = f"SELECT doc_id, {Q.clean_lines('text')} AS arr FROM documents"
    return f"""
    WITH {Q.key_point_rows(src, KEY_POINT_CAP)}
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS point_no, l AS point
    FROM points"""


def q_key_points_all(spark, sf_dir):
    """WIN-01 without its cap: every hit of every document."""
    pts = S.key_points(T.clean_lines("text"))
    return (_docs(spark, sf_dir, "doc_id", "text").select("doc_id", F.posexplode(pts).alias("_i", "point"))
            .select("doc_id", (F.col("_i") + 1).cast("bigint").alias("point_no"), "point"))


def o_key_points_all():
    return f"""
    WITH l AS (SELECT doc_id, unnest(arr) AS point, generate_subscripts(arr, 1) AS i
               FROM (SELECT doc_id, {Q.clean_lines('text')} AS arr FROM documents))
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS point_no, point
    FROM l WHERE {Q.stat_any('point')} OR {Q.angle_any('point')}"""


# Lines appended to a document's first one, by its id: each statistic pattern is
# hit by some and missed by others.
STAT_SAMPLES = ["went 12-5 last year", "went 12-5b last year", "hit 55.25%x of them", "hit 55% of them",
                "opened at 110 flat", "a pk game", "stays under 45.5", "stayed Over 7 again", "nothing here", "1234-5678"]


def q_stat_lines(spark, sf_dir):
    """FLT-04 pattern by pattern on lines that hit every one of them."""
    d = _docs(spark, sf_dir, "doc_id", "source")
    sample = F.element_at(F.array(*[F.lit(x) for x in STAT_SAMPLES]), (F.col("doc_id") % len(STAT_SAMPLES) + 1).cast("int"))
    d = d.withColumn("line", F.concat_ws(" ", "source", sample))
    return d.select("doc_id", "line", *[c.alias(f"is_{n}") for n, c in S.stat_flags(F.col("line")).items()])


def o_stat_lines():
    # The four patterns as they read, in RE2 with ASCII word ends: the lines are ASCII.
    rx = {"record": r"\b[0-9]{1,3}-[0-9]{1,3}\b", "percentage": r"\b[0-9]{1,3}\.[0-9]+%\b",
          "odds": r"(?i)\b(-?[0-9]{3,4}|\+[0-9]{3,4}|PK)\b", "total": r"(?i)\b(Over|Under)\s*[0-9]{1,3}(\.[0-9])?\b"}
    samples = "[" + ", ".join(Q.q(x) for x in STAT_SAMPLES) + "]"
    flags = ", ".join(f"regexp_matches(line, {Q.q(p)}) AS is_{n}" for n, p in rx.items())
    return f"""
    WITH d AS (SELECT doc_id, source || ' ' || ({samples})[doc_id % {len(STAT_SAMPLES)} + 1] AS line FROM documents)
    SELECT doc_id, line, {flags} FROM d"""


def q_line_flags(spark, sf_dir):
    """FLT-02..06 counted per language.  Lines are exploded row-locally and
    reduced with a partial aggregate; nothing is collected per document."""
    d = _docs(spark, sf_dir, "doc_id", "lang", "text")
    lines = d.select("lang", F.explode(T.text_lines(F.col("text"))).alias("l"))
    l = F.col("l")
    disc = l.rlike(T.disclaimer_regex(LICENSE_DISCLAIMERS))
    kept = ~disc & (F.length(l) >= 2)
    flags = S.stat_flags(l)
    angle = S.is_angle(l)
    stat = F.lit(False)
    for c in flags.values():
        stat = stat | c
    agg = [F.count(F.lit(1)).alias("n_lines"),
           F.count_if(disc).alias("n_disclaimer"),
           F.count_if(~disc & (F.length(l) < 2)).alias("n_short"),
           F.count_if(kept).alias("n_kept")]
    for name, c in flags.items():
        agg.append(F.count_if(kept & c).alias(f"n_{name}"))
    agg += [F.count_if(kept & angle).alias("n_angle"),
            F.count_if(kept & (stat | angle)).alias("n_hit")]
    return lines.groupBy("lang").agg(*agg)


def o_line_flags():
    rx = Q.disclaimer_re2(LICENSE_DISCLAIMERS)
    stats = ", ".join(f"CAST(count_if(kept AND regexp_matches(l, {Q.q(p)})) AS BIGINT) AS n_{n}"
                      for n, p in Q.STAT_RE2.items())
    return f"""
    WITH ls AS (
      SELECT lang, unnest({Q.markup_lines(Q.remove_invisible('text'))}) AS l FROM documents
    ), f AS (
      SELECT lang, l, regexp_matches(l, {Q.q(rx)}) AS disc,
             NOT regexp_matches(l, {Q.q(rx)}) AND length(l) >= 2 AS kept FROM ls
    )
    SELECT lang, count(*) AS n_lines, CAST(count_if(disc) AS BIGINT) AS n_disclaimer,
           CAST(count_if(NOT disc AND length(l) < 2) AS BIGINT) AS n_short, CAST(count_if(kept) AS BIGINT) AS n_kept,
           {stats},
           CAST(count_if(kept AND {Q.angle_any('l')}) AS BIGINT) AS n_angle,
           CAST(count_if(kept AND ({Q.stat_any('l')} OR {Q.angle_any('l')})) AS BIGINT) AS n_hit
    FROM f GROUP BY lang"""


def _q_thread_gate(cap):
    def q(spark, sf_dir):
        d = _docs(spark, sf_dir, "doc_id", "text")
        a = article.assemble_articles(d, "text", cap=cap)
        return a.select(
            "doc_id",
            F.size("extracted_insights").cast("bigint").alias("n_points"),
            F.length("clean_text").cast("bigint").alias("n_chars"),
            S.allow_thread(F.col("extracted_insights"), F.col("clean_text"), True,
                           THREAD_MIN_POINTS, THREAD_MIN_CHARS).alias("allow_thread"))
    return q


def _o_thread_gate(cap):
    src = f"SELECT doc_id, {Q.clean_lines('text')} AS arr FROM documents"
    return lambda: f"""
    WITH {Q.key_point_rows(src, cap or 2**62)},
    np AS (SELECT doc_id, count(*) AS n FROM points GROUP BY doc_id),
    ct AS (SELECT doc_id, length(array_to_string(arr, chr(10))) AS n_chars FROM ({src}))
    SELECT ct.doc_id, CAST(coalesce(np.n, 0) AS BIGINT) AS n_points, CAST(n_chars AS BIGINT) AS n_chars,
           coalesce(np.n, 0) >= {THREAD_MIN_POINTS} AND n_chars >= {THREAD_MIN_CHARS} AS allow_thread
    FROM ct LEFT JOIN np USING (doc_id)"""


# --------------------------------------------------------------------------
# Pages and the body ladder


def q_page_text(spark, sf_dir):
    p = spread(_t(spark, sf_dir, "pages").select("page_id", "html"), "page_id")
    b = article.page_bodies(p)
    return b.select(
        "page_id",
        F.when(F.col("article_text").isNotNull(), "article").otherwise("page").alias("body_source"),
        F.coalesce("article_text", "page_text").alias("text"))


def _o_page_bodies() -> str:
    return Q.page_bodies("SELECT page_id, html FROM pages")


def _o_page_rows(bodies: str) -> str:
    return f"""
    WITH {bodies}
    SELECT page_id, CASE WHEN article_text IS NOT NULL THEN 'article' ELSE 'page' END AS body_source,
           coalesce(article_text, page_text) AS text FROM pb"""


def o_page_text():
    return _o_page_rows(_o_page_bodies())


# Menus, asides and advertisements with elements of their own name inside, ``{0}`` deep.
_NESTED_MENU = ('<div class="side menu">', "<div>in ", "deep", " out</div>", "still menu</div>")
_NESTED_ASIDE = ("<aside><p>a</p><aside>b</aside>c</aside><span class='ad big'>s<span>t</span>u<span>v</span>w</span>"
                 "<article>a note<article>in a note</article></article><div class=\"readme\">stays<div>whole</div></div>")


def q_page_text_nested(spark, sf_dir):
    """PRJ-06 on pages with nested menus (up to four deep, by page id) before, in and
    after the article, and nested asides, advertisements and articles inside it."""
    k = F.col("page_id") % 4 + 1
    a, b, c, d, e = (F.lit(x) for x in _NESTED_MENU)
    menu = F.concat(a, F.repeat(b, k.cast("int")), c, F.repeat(d, k.cast("int")), e)
    html = F.replace(F.replace(F.col("html"), F.lit("<article>"), F.concat(menu, F.lit("<article>"), menu)),
                     F.lit("</article>"), F.concat(F.lit(_NESTED_ASIDE), menu, F.lit("end</article>"), menu))
    p = spread(_t(spark, sf_dir, "pages").select("page_id", "html"), "page_id").select("page_id", html.alias("html"))
    return article.page_bodies(p).select(
        "page_id", F.when(F.col("article_text").isNotNull(), "article").otherwise("page").alias("body_source"),
        F.coalesce("article_text", "page_text").alias("text"), "page_text")


def o_page_text_nested():
    a, b, c, d, e = (Q.q(x) for x in _NESTED_MENU)
    menu = f"({a} || repeat({b}, CAST(page_id % 4 + 1 AS INT)) || {c} || repeat({d}, CAST(page_id % 4 + 1 AS INT)) || {e})"
    html = (f"replace(replace(html, '<article>', {menu} || '<article>' || {menu}), '</article>', "
            f"{Q.q(_NESTED_ASIDE)} || {menu} || 'end</article>' || {menu})")
    return _o_page_rows(Q.page_bodies(f"SELECT page_id, {html} AS html FROM pages")).replace(
        "AS text FROM pb", "AS text, page_text FROM pb")


def q_body_ladder(spark, sf_dir):
    """Documents act as feed bodies; each document's page is the page with
    the same id (left join, so bodies without a page are 'missing')."""
    d = _docs(spark, sf_dir, "doc_id", "text")
    pages = _t(spark, sf_dir, "pages")
    out = article.body_ladder(d, pages, feed_key="doc_id", page_key="page_id",
                              feed_body="text")
    return out.select("doc_id", "body_source", "body",
                      F.length("body").cast("bigint").alias("body_chars"))


def o_body_ladder():
    feed_ok = "coalesce(length(regexp_replace(d.text, '<[^>]+>', '', 'g')) > 500, false)"
    return f"""
    WITH {_o_page_bodies()},
    lad AS (
      SELECT d.doc_id,
             CASE WHEN {feed_ok} THEN 'feed' WHEN pb.article_text IS NOT NULL THEN 'article'
                  WHEN pb.page_text IS NOT NULL THEN 'page' ELSE 'missing' END AS body_source,
             CASE WHEN {feed_ok} THEN d.text WHEN pb.article_text IS NOT NULL THEN pb.article_text
                  ELSE pb.page_text END AS body
      FROM documents d LEFT JOIN pb ON d.doc_id = pb.page_id
    )
    SELECT doc_id, body_source, body, CAST(length(body) AS BIGINT) AS body_chars FROM lad"""


def q_body_ladder_main(spark, sf_dir):
    """All rungs of the ladder: every third document is a marked-up feed body (in
    every sixth long only by its tags), every fifth page has main text, every
    page was crawled again as an error page, every seventh document has no url."""
    d = _docs(spark, sf_dir, "doc_id", "text")
    body = F.when(F.col("doc_id") % 6 == 0, F.concat(F.lit("<p>short</p>"), F.repeat(F.lit("<br/>"), 200))) \
            .when(F.col("doc_id") % 3 == 0, F.concat(F.lit("<p class='a'>"), F.col("text"), F.lit("</p>"))) \
            .otherwise(F.substring("text", 1, 100))
    feed = d.select("doc_id", body.alias("feed_body"),
                    F.when(F.col("doc_id") % 7 == 0, F.lit(" ")).otherwise(F.col("doc_id").cast("string")).alias("url"))
    pages = _t(spark, sf_dir, "pages").select(
        F.col("page_id").cast("string").alias("url"), "html",
        F.when(F.col("page_id") % 5 == 0, F.repeat(F.col("url"), 20)).alias("main"), F.lit(1).alias("crawl"))
    again = pages.select("url", F.lit("<p>404 not found</p>").alias("html"), "main", F.lit(2).alias("crawl"))
    out = article.body_ladder(feed, pages.unionByName(again), feed_body="feed_body", main_col="main", crawl_col="crawl")
    return out.select("doc_id", "body_source", "body")


def o_body_ladder_main():
    ok = "length(regexp_replace(f.fb, '<[^>]+>', '', 'g')) > 500"
    return f"""
    WITH {_o_page_bodies()},
    f AS (SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN '<p>short</p>' || repeat('<br/>', 200)
                              WHEN doc_id % 3 = 0 THEN '<p class=''a''>' || text || '</p>'
                              ELSE substring(text, 1, 100) END AS fb, doc_id % 7 = 0 AS blank FROM documents),
    p AS (SELECT pb.page_id, article_text, CASE WHEN article_text IS NULL THEN '404 not found' ELSE page_text END AS page_text,
                 CASE WHEN pb.page_id % 5 = 0 THEN repeat(pages.url, 20) END AS main
          FROM pb JOIN pages ON pages.page_id = pb.page_id),
    j AS (SELECT f.doc_id, fb, {ok} AS ok, p.* EXCLUDE (page_id) FROM f LEFT JOIN p ON p.page_id = f.doc_id AND NOT f.blank)
    SELECT doc_id,
           CASE WHEN ok THEN 'feed' WHEN length(main) > 500 THEN 'main' WHEN article_text IS NOT NULL THEN 'article'
                WHEN page_text IS NOT NULL THEN 'page' ELSE 'missing' END AS body_source,
           CASE WHEN ok THEN fb WHEN length(main) > 500 THEN main ELSE coalesce(article_text, page_text) END AS body
    FROM j"""


# --------------------------------------------------------------------------
# Keys, ledger, authors, cap, outcomes


def _keyed_docs(spark, sf_dir, thin=False):
    """Documents as a feed: key = sha256 of the text, position = doc id.
    ``thin=True`` writes the key table once (no text) for plans that read
    it twice, so the wide text column is scanned and hashed once."""
    d = _t(spark, sf_dir, "documents").select("doc_id", "source", "text")
    k = d.select("doc_id", "source",
                 keys.article_key(id_col=F.col("text")).alias("article_id"),
                 F.col("doc_id").alias("feed_pos"))
    return materialize(k) if thin else k


def q_article_keys(spark, sf_dir):
    d = _keyed_docs(spark, sf_dir)
    u = keys.distinct_articles(d.select("article_id", "doc_id", "source", "feed_pos"))
    return u.select("article_id", "doc_id", "source", F.col("n_copies").cast("bigint"))


def o_article_keys():
    return """
    SELECT sha256(text) AS article_id, min(doc_id) AS doc_id, arg_min(source, doc_id) AS source,
           count(*) AS n_copies
    FROM documents GROUP BY sha256(text)"""


def q_ledger_anti(spark, sf_dir):
    """Documents not yet in the ledger; the ledger is the labelled doc ids."""
    d = _t(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    ledger = _t(spark, sf_dir, "labels")
    return screen.ledger_anti_join(d, ledger, key="doc_id")


def o_ledger_anti():
    return """
    SELECT doc_id, source, n_chars FROM documents d
    WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"""


def _o_author_match(col: str, names: list[str]) -> str:
    alt = "|".join(names)  # the fixture names are normalized as written
    norm = f"lower(trim(regexp_replace({col}, {Q.q(fixed.char_class(fixed.PY_WHITESPACE) + '+')}, ' ', 'g'), {Q.WS}))"
    return (f"coalesce(CASE WHEN {col} IS NULL OR {col} = '' THEN false ELSE "
            f"regexp_matches({norm}, {Q.q('(?:^|[^a-z])(?:' + alt + ')(?:[^a-z]|$)')}) END, false)")


def q_author_screen(spark, sf_dir):
    """Part names stand in for bylines; two names are excluded."""
    p = _t(spark, sf_dir, "part").select("p_partkey", "p_name")
    return screen.screen_authors(p, "p_name", EXCLUDED_PARTS)


def o_author_screen():
    return f"SELECT p_partkey, p_name, {_o_author_match('p_name', EXCLUDED_PARTS)} AS excluded FROM part"


def q_author_screen_table(spark, sf_dir):
    """JOIN-04 with the names as a table: the full names of size-1 parts are
    the excluded bylines, matched against every part name through the
    bounded boundary-aligned candidate join (no broadcast of the list)."""
    p = _t(spark, sf_dir, "part")
    names = p.where(F.col("p_size") == 1).select(F.col("p_name").alias("name"))
    return screen.screen_authors(p.select("p_partkey", "p_name"), "p_name", names)


def o_author_screen_table():
    norm = f"lower(trim(regexp_replace(@COL@, {Q.q(fixed.char_class(fixed.PY_WHITESPACE) + '+')}, ' ', 'g'), {Q.WS}))"
    a = norm.replace("@COL@", "p.p_name")
    n = norm.replace("@COL@", "x.p_name")
    return f"""
    WITH names AS (SELECT DISTINCT {n} AS name FROM part x WHERE x.p_size = 1 AND {n} <> '')
    SELECT p.p_partkey, p.p_name,
           coalesce(p.p_name <> '' AND EXISTS (
             SELECT 1 FROM names WHERE regexp_matches({a},
               '(?:^|[^a-z])' || regexp_escape(names.name) || '(?:[^a-z]|$)')), false) AS excluded
    FROM part p"""


def q_feed_positions(spark, sf_dir):
    """WIN-04: dense position of every document within its source (the
    feed), in id order, computed over sampled range blocks rather than a per-feed
    row_number."""
    d = _t(spark, sf_dir, "documents").select("doc_id", "source")
    return keys.feed_position(d, "doc_id", "feed_pos", ["source"])


def o_feed_positions():
    return """
    SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS feed_pos
    FROM documents"""


def q_batch_cap(spark, sf_dir):
    """Each source is a feed; its first entries by position make the batch."""
    d = _keyed_docs(spark, sf_dir)
    w = keys.batch_cap(d.select("source", "doc_id", "feed_pos"), BATCH_CAP,
                       order_cols=["feed_pos"], partition_cols=["source"])
    return w.select("source", "doc_id")


def o_batch_cap():
    return f"""
    SELECT source, doc_id FROM (
      SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn
      FROM documents) WHERE rn <= {BATCH_CAP}"""


def _outcomes(spark, sf_dir):
    d = _keyed_docs(spark, sf_dir, thin=True)
    lab = _t(spark, sf_dir, "labels").select("doc_id", "toxic")
    f = (d.join(lab, "doc_id", "left")
          .withColumn("excluded", screen.author_excluded("source", EXCLUDED_SOURCES))
          .withColumn("failed", F.coalesce(F.col("toxic") == 1, F.lit(False))))
    return outcomes.ingest_outcomes(f, key="article_id", order_col="feed_pos")


def q_ingest_outcomes(spark, sf_dir):
    """Documents form one feed in id order, keyed by sha256 of the text; the
    source is the author (``src1`` excluded, which also catches ``src10``..
    ``src19`` since digits are boundaries); a toxic label is a failure."""
    return _outcomes(spark, sf_dir).select("doc_id", "source", "article_id", "outcome")


def _o_outcome_rows() -> str:
    return f"""
    f AS (
      SELECT d.doc_id, d.source, sha256(d.text) AS article_id,
             {_o_author_match('d.source', EXCLUDED_SOURCES)} AS ex,
             coalesce(l.toxic = 1, false) AS fail
      FROM documents d LEFT JOIN labels l USING (doc_id)
    ),
    w AS (
      SELECT *, coalesce(max(CASE WHEN ex OR NOT fail THEN 1 ELSE 0 END) OVER (
                  PARTITION BY article_id ORDER BY doc_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done_before
      FROM f
    ),
    oc AS (
      SELECT doc_id, source, article_id,
             CASE WHEN done_before = 1 THEN 'duplicate' WHEN ex THEN 'excluded'
                  WHEN fail THEN 'failed' ELSE 'processed' END AS outcome
      FROM w
    )"""


def o_ingest_outcomes():
    return f"WITH {_o_outcome_rows()} SELECT doc_id, source, article_id, outcome FROM oc"


def q_run_summary(spark, sf_dir):
    """Outcomes grouped by source, each source taken as one run."""
    o = _outcomes(spark, sf_dir).withColumnRenamed("source", "run_id")
    return outcomes.run_summary(o, "run_id")


def o_run_summary():
    return f"""
    WITH {_o_outcome_rows()}
    SELECT source AS run_id, count(*) AS articles_found,
           CAST(count_if(outcome = 'processed') AS BIGINT) AS articles_processed,
           CAST(count_if(outcome = 'failed') AS BIGINT) AS articles_failed,
           CAST(count_if(outcome = 'duplicate') AS BIGINT) AS skipped_duplicate,
           CAST(count_if(outcome = 'excluded') AS BIGINT) AS skipped_excluded,
           CASE WHEN CAST(count_if(outcome = 'failed') AS BIGINT) = 0 THEN 'completed'
                ELSE 'completed_with_errors' END AS status
    FROM oc GROUP BY source"""


# --------------------------------------------------------------------------
# Packages: validation, promo wording, prompts, outbox


def _conv_items(spark, sf_dir):
    """Assistant turns of a conversation stand in for a model response: one turn
    is a single post, several turns are a thread in turn order.  One scan: the
    stripped texts and their lengths, written once."""
    text = T.py_strip(F.coalesce(F.col("text"), F.lit("")))
    return materialize(_t(spark, sf_dir, "conversations").where(F.col("role") == "assistant")
                       .select("conv_id", "turn", text.alias("t"), F.length(text).alias("n")), "items")


def _validated(items, max_chars):
    """(conv_id, delivery_mode, n_items, error) from the lengths alone."""
    pk = (items.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n"), F.max("n").alias("_len"))
               .select("conv_id", F.when(F.col("_n") == 1, "single").otherwise("thread").alias("delivery_mode"),
                       F.when(F.col("_n") == 1, F.col("_len")).otherwise(F.lit(0)).alias("single_len")))
    thread = items.join(pk.where("delivery_mode = 'thread'").select("conv_id"), "conv_id", "left_semi")
    return packages.validate_lengths(pk, thread, "conv_id", "turn", "n", max_chars=max_chars)


def _q_validate(max_chars):
    def q(spark, sf_dir):
        v = _validated(_conv_items(spark, sf_dir), max_chars)
        return v.select("conv_id", "delivery_mode", "n_items", "error",
                        F.col("error").isNull().alias("valid"))
    return q


def _o_validated(max_chars):
    too_long = f"single_tweet exceeds {max_chars} characters"
    head, tail = "thread tweet ", f" exceeds {max_chars} characters"
    return f"""
    a AS (SELECT conv_id, turn, trim(text, {Q.WS}) AS t FROM conversations WHERE role = 'assistant'),
    p AS (SELECT conv_id, CASE WHEN count(*) = 1 THEN 'single' ELSE 'thread' END AS delivery_mode,
                 CASE WHEN count(*) = 1 THEN max(t) ELSE '' END AS single_tweet
          FROM a GROUP BY conv_id),
    it AS (SELECT a.conv_id, a.t,
                  row_number() OVER (PARTITION BY a.conv_id ORDER BY a.turn) AS idx
           FROM a JOIN p USING (conv_id) WHERE p.delivery_mode = 'thread' AND a.t <> ''),
    st AS (SELECT conv_id, count(*) AS n_items,
                  coalesce(min(CASE WHEN length(t) > {max_chars} THEN idx END), 0) AS first_long
           FROM it GROUP BY conv_id),
    v AS (
      SELECT p.conv_id, p.delivery_mode, p.single_tweet,
             CAST(coalesce(st.n_items, 0) AS BIGINT) AS n_items,
             CASE WHEN p.delivery_mode = 'single' AND p.single_tweet = '' THEN {Q.q(fixed.ERR_SINGLE_MISSING)}
                  WHEN p.delivery_mode = 'single' AND length(p.single_tweet) > {max_chars} THEN {Q.q(too_long)}
                  WHEN p.delivery_mode = 'single' AND coalesce(st.n_items, 0) > 0 THEN {Q.q(fixed.ERR_SINGLE_HAS_THREAD)}
                  WHEN p.delivery_mode = 'single' THEN NULL
                  WHEN p.single_tweet <> '' THEN {Q.q(fixed.ERR_THREAD_HAS_SINGLE)}
                  WHEN coalesce(st.n_items, 0) <> {fixed.THREAD_SIZE} THEN {Q.q(fixed.ERR_THREAD_SIZE)}
                  WHEN st.first_long > 0 THEN {Q.q(head)} || CAST(st.first_long AS VARCHAR) || {Q.q(tail)}
             END AS error
      FROM p LEFT JOIN st USING (conv_id)
    )"""


def _o_validate(max_chars):
    def o():
        return f"""WITH {_o_validated(max_chars)}
        SELECT conv_id, delivery_mode, n_items, error, error IS NULL AS valid FROM v"""
    return o


PROMO_FIXTURE = {"hit_on": [r"\bon\b"], "hit_for": [r"\bfor\b"]}


def q_promo_flag(spark, sf_dir):
    """Every turn checked as a post: the fixture word lists ``on`` / ``for``
    (which do occur) and the default promotional list."""
    cols = [packages.promo_flag("text", None, pats).alias(name) for name, pats in PROMO_FIXTURE.items()]
    cols.append(packages.promo_flag("text").alias("promo_default"))
    return _t(spark, sf_dir, "conversations").select("conv_id", "turn", *cols)


# Words put behind a turn's role, by conversation and turn: each promotional
# pattern is hit by one and narrowly missed by another.
PROMO_SAMPLES = ["Check out this", "checkout", "READ more", "bread", "watch it", "watching", "Follow us", "followed", "subscribe now",
                 "subscribed", "visit", "visits", "a preview of", "previews", "previewed", "promo code", "promotion", "exclusive", "exclusively"]


def q_promo_words(spark, sf_dir):
    """FLT-08 with the default list, on posts that hit every pattern of it."""
    i = ((F.col("conv_id") * 7 + F.col("turn")) % len(PROMO_SAMPLES) + 1).cast("int")
    post = F.concat_ws(" ", "role", F.element_at(F.array(*[F.lit(x) for x in PROMO_SAMPLES]), i))
    c = _t(spark, sf_dir, "conversations").select("conv_id", "turn", post.alias("post"))
    return c.select("conv_id", "turn", "post", packages.promo_flag("post").alias("promo"))


def o_promo_words():
    samples = "[" + ", ".join(Q.q(x) for x in PROMO_SAMPLES) + "]"
    rx = r"\b(check out|read|watch|follow|subscribe|visit|preview|previews|promo|exclusive)\b"
    return f"""
    WITH c AS (SELECT conv_id, turn, role || ' ' || ({samples})[(conv_id * 7 + turn) % {len(PROMO_SAMPLES)} + 1] AS post
               FROM conversations)
    SELECT conv_id, turn, post, regexp_matches(lower(post), {Q.q(rx)}) AS promo FROM c"""


def _re2_word(p: str) -> str:
    """RE2 form of a ``\\b...\\b`` pattern whose ends are word characters."""
    assert p.startswith(r"\b") and p.endswith(r"\b")
    return Q.PRE + "(?:" + p[2:-2] + ")" + Q.POST


def o_promo_flag():
    cols = [f"regexp_matches(lower(coalesce(text, '')), {Q.q('|'.join(_re2_word(x) for x in pats))}) AS {name}"
            for name, pats in PROMO_FIXTURE.items()]
    dflt = "|".join(_re2_word(x) for x in fixed.PROMO_PATTERNS)
    cols.append(f"regexp_matches(lower(coalesce(text, '')), {Q.q(dflt)}) AS promo_default")
    return f"SELECT conv_id, turn, {', '.join(cols)} FROM conversations"


def _prompt_parts(spark, sf_dir, cap):
    d = _docs(spark, sf_dir, "doc_id", "source", "text")
    return (d.withColumn("_l", T.clean_lines("text"))
             .withColumn("clean_text", F.array_join("_l", "\n"))
             .withColumn("pts", S.key_points("_l", cap=cap))
             .withColumn("title", F.coalesce(F.element_at("_l", 1), F.lit("")))
             .withColumn("allow", S.allow_thread(F.col("pts"), F.col("clean_text"))))


def _q_prompts(kind, cap, budget, max_points):
    """Prompts for every document: the first clean line is the title, the source
    the author, no publish time; the draft of the later steps is a single post
    made of the title."""
    def q(spark, sf_dir):
        a = _prompt_parts(spark, sf_dir, cap)
        draft = prompts.draft_json(F.lit("single"), "title", F.array().cast("array<string>"))
        if kind == "generate":
            pr = prompts.generate_prompt("title", "source", F.lit(None).cast("timestamp"), "clean_text", "pts",
                                         F.col("allow"), text_budget=budget, max_points=max_points)
        elif kind == "fact_check":
            pr = prompts.fact_check_prompt("clean_text", "pts", draft, F.col("allow"), text_budget=budget, max_points=max_points)
        else:
            pr = prompts.promo_rewrite_prompt("clean_text", draft, F.col("allow"), text_budget=budget)
        return a.select("doc_id", pr.alias("prompt"), F.length(pr).cast("bigint").alias("prompt_chars"))
    return q


def _o_render(template: str, fields: dict[str, str]) -> str:
    import re as _re
    parts, pos = [], 0
    for m in _re.finditer(r"\{(\w+)\}", template):
        if m.start() > pos:
            parts.append(Q.q(template[pos:m.start()]))
        parts.append(f"coalesce({fields[m.group(1)]}, '')")
        pos = m.end()
    if pos < len(template):
        parts.append(Q.q(template[pos:]))
    return "concat(" + ", ".join(parts) + ")"


# The oracle's own copies of the templates' fixed lines.
_O_TEMPLATES = {
    "generate": ("Headline: {title}\nByline: {author}\nPublished: {published}\n\nArticle text (the only source of facts):\n{text}\n\n"
                 "Key data points:\n{points}\n\nWrite one post about the single strongest betting angle in the article. "
                 "A three-post thread is allowed: {thread_allowed}."),
    "fact_check": ("Article text (the only source of facts):\n{text}\n\nKey data points:\n{points}\n\nDraft as JSON:\n{draft}\n\n"
                   "Check every claim in the draft against the article, remove anything it does not support, and return the same "
                   "JSON shape. A three-post thread is allowed: {thread_allowed}."),
    "promo_rewrite": ("Article text (the only source of facts):\n{text}\n\nDraft as JSON:\n{draft}\n\nRemove promotional wording and "
                      "calls to action; keep the insight. Return the same JSON shape. A three-post thread is allowed: {thread_allowed}."),
}


def _o_prompts(kind, cap, budget, max_points):
    def o():
        src = f"SELECT doc_id, {Q.clean_lines('text')} AS arr FROM documents"
        some = f"pts[1:{max_points}]" if max_points else "pts"
        bullets = (f"CASE WHEN len(coalesce(pts, [])) = 0 THEN '- none extracted' "
                   f"ELSE array_to_string(list_transform({some}, lambda x: '- ' || x), chr(10)) END")
        text = "array_to_string(arr, chr(10))"
        allow = (f"CASE WHEN len(coalesce(pts, [])) >= {fixed.MIN_INSIGHTS_FOR_THREAD} AND "
                 f"length({text}) >= {fixed.MIN_CHARS_FOR_THREAD} THEN 'true' ELSE 'false' END")
        draft = ("""'{"delivery_mode":"single","single_tweet":' || to_json(coalesce(arr[1], ''))::VARCHAR || ',"thread":[]}'""")
        pr = _o_render(_O_TEMPLATES[kind], {
            "title": "coalesce(arr[1], '')", "author": "coalesce(nullif(source, ''), 'Unknown')", "published": "'Unknown'",
            "text": f"substring({text}, 1, {budget})" if budget else text, "points": bullets, "draft": draft,
            "thread_allowed": allow})
        return f"""
        WITH {Q.key_point_rows(src, cap or 10**9)},
        agg AS (SELECT doc_id, list(l ORDER BY i) AS pts FROM points GROUP BY doc_id),
        base AS (SELECT d.doc_id, d.source, c.arr, agg.pts FROM documents d
                 JOIN ({src}) c USING (doc_id) LEFT JOIN agg USING (doc_id)),
        pr AS (SELECT doc_id, {pr} AS prompt FROM base)
        SELECT doc_id, prompt, CAST(length(prompt) AS BIGINT) AS prompt_chars FROM pr"""
    return o


OUTBOX_MAX_CHARS = 1000


def q_outbox_rows(spark, sf_dir):
    """Posts of every valid package (checked at 1,000 characters so that some
    pass): the post list with the "Read more" reply built from the page whose id
    is the conversation id, one row per post.  Valid threads have exactly three
    items, so a valid package is gathered without an unbounded group."""
    items = _conv_items(spark, sf_dir)
    ok = _validated(items, OUTBOX_MAX_CHARS).where(F.col("error").isNull()).select("conv_id", "delivery_mode")
    pages = _t(spark, sf_dir, "pages").select(F.col("page_id").alias("conv_id"), "url")
    texts = (items.where("n > 0").join(ok, "conv_id").groupBy("conv_id", "delivery_mode")
                  .agg(F.sort_array(F.collect_list(F.struct("turn", "t")))["t"].alias("texts")))
    posts = outbox.post_list("delivery_mode", F.col("texts")[0], "texts", outbox.read_more("url"))
    return (texts.join(pages, "conv_id", "left")
                 .select("conv_id", F.col("delivery_mode").alias("draft_type"), F.posexplode(posts).alias("_i", "text"))
                 .select("conv_id", "draft_type", (F.col("_i") + 1).cast("bigint").alias("post_no"), "text"))


def o_outbox_rows():
    return f"""
    WITH {_o_validated(OUTBOX_MAX_CHARS)},
    ok AS (SELECT v.conv_id, v.delivery_mode, v.single_tweet,
                  CASE WHEN trim(pg.url, {Q.WS}) <> '' THEN {Q.q(fixed.READ_MORE_PREFIX)} || trim(pg.url, {Q.WS}) END AS reply
           FROM v LEFT JOIN pages pg ON pg.page_id = v.conv_id WHERE v.error IS NULL)
    SELECT ok.conv_id, 'thread' AS draft_type, it.idx AS post_no, it.t AS text
      FROM ok JOIN it USING (conv_id) WHERE ok.delivery_mode = 'thread'
    UNION ALL
    SELECT conv_id, 'single', CAST(1 AS BIGINT), single_tweet FROM ok WHERE delivery_mode = 'single'
    UNION ALL
    SELECT conv_id, delivery_mode, CAST(CASE WHEN delivery_mode = 'thread' THEN {fixed.THREAD_SIZE + 1} ELSE 2 END AS BIGINT), reply
      FROM ok WHERE reply IS NOT NULL"""


# --------------------------------------------------------------------------
# Scheduling


def q_publish_slots(spark, sf_dir):
    """Events are arrivals; each user is a channel; 30-minute spacing."""
    e = _t(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    s = schedule.publish_slots(e, "ts", "event_id", ["user_id"])
    return s.select("event_id", "user_id", schedule.slot_text("slot").alias("slot"),
                    (F.col("slot") > F.col("ts").cast("timestamp")).alias("delayed"))


def _o_iso(us: str, suffix: str = "Z") -> str:
    return (f"strftime(make_timestamp({us}), '%Y-%m-%dT%H:%M:%S') || "
            f"CASE WHEN ({us}) % 1000000 = 0 THEN '' ELSE '.' || lpad(CAST(({us}) % 1000000 AS VARCHAR), 6, '0') END"
            f" || {Q.q(suffix)}")


def o_publish_slots():
    d = fixed.PUBLISH_SPACING_MINUTES * 60_000_000
    return f"""
    WITH r AS (
      SELECT event_id, user_id, epoch_us(ts) AS t,
             row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM events
    ), m AS (
      SELECT *, i * {d} + max(t - i * {d}) OVER (PARTITION BY user_id ORDER BY t, event_id
                                                 ROWS UNBOUNDED PRECEDING) AS s FROM r
    )
    SELECT event_id, user_id, {_o_iso('s')} AS slot, s > t AS delayed FROM m"""


QUEUE_NOW = "2024-01-29 12:00:00"


def _queue_pages(spark, sf_dir):
    """Queue snapshots built from events: one JSON page per event, owned by
    the user; the page number comes from the event value.  Each page holds a
    naive ``scheduledAt``, an offset ``publish_at`` one value-minutes later,
    a numeric look-alike, and an escaped look-alike inside a note."""
    e = _t(spark, sf_dir, "events")
    later = F.col("ts").cast("timestamp") + F.make_dt_interval(
        F.lit(0), F.lit(2), F.floor(F.col("value")).cast("int"), F.lit(0))
    body = F.concat(
        F.lit('{"id":'), F.col("event_id").cast("string"),
        F.lit(',"type":"'), F.col("event_type"),
        F.lit('","drafts":[{"scheduledAt":"'), iso_text("ts", ""),
        F.lit('","meta":{"publish_at":"'), iso_text(later, "+02:00"),
        F.lit('","scheduled_date":'), F.col("user_id").cast("string"),
        F.lit('}}],"note":"\\"publish_at\\": \\"2099-01-01T00:00:00Z\\"","props":'), F.col("props"),
        F.lit("}"))
    return e.select("user_id", F.floor(F.col("value") / 5).cast("int").alias("page"), body.alias("body"))


def _q_queue_latest(max_pages):
    def q(spark, sf_dir):
        out = schedule.latest_queued(_queue_pages(spark, sf_dir), F.lit(QUEUE_NOW).cast("timestamp"), ["user_id"],
                                     max_pages=max_pages)
        return out.select("user_id", F.when(F.col("latest").isNotNull(), schedule.slot_text("latest")).alias("latest"))
    return q


def _o_queue_latest(max_pages):
    return lambda: _o_queue(max_pages)


def _o_queue(max_pages):
    keys = "|".join(fixed.SCHEDULE_KEYS)
    rx = '"(?:' + keys + r')"\s*:\s*"([^"\\]*)"'
    body = ("'{\"id\":' || CAST(event_id AS VARCHAR) || ',\"type\":\"' || event_type || "
            "'\",\"drafts\":[{\"scheduledAt\":\"' || " + _o_iso('epoch_us(ts)', '') + " || "
            "'\",\"meta\":{\"publish_at\":\"' || " +
            _o_iso('epoch_us(ts) + 7200000000 + CAST(floor(value) AS BIGINT) * 60000000', '+02:00') + " || "
            "'\",\"scheduled_date\":' || CAST(user_id AS VARCHAR) || "
            "'}}],\"note\":\"\\\"publish_at\\\": \\\"2099-01-01T00:00:00Z\\\"\",\"props\":' || props || '}'")
    parse = ("CASE WHEN regexp_matches(v, '(Z|[+-][0-9][0-9]:?[0-9][0-9])$') "
             "THEN epoch_us(try_cast(v AS TIMESTAMPTZ)) ELSE epoch_us(try_cast(v AS TIMESTAMP)) END")
    now = f"epoch_us(TIMESTAMP '{QUEUE_NOW}')"
    return f"""
    WITH pg AS (SELECT user_id, CAST(floor(value / 5) AS INTEGER) AS page, {body} AS body FROM events),
    vals AS (SELECT user_id, unnest(CASE WHEN len(x) = 0 THEN [NULL] ELSE x END) AS v
             FROM (SELECT user_id, regexp_extract_all(body, {Q.q(rx)}, 1) AS x FROM pg
                   {f'WHERE page < {max_pages}' if max_pages else ''})),
    p AS (SELECT user_id, {parse} AS us FROM vals),
    m AS (SELECT user_id, max(CASE WHEN us >= {now} THEN us END) AS latest FROM p GROUP BY user_id)
    SELECT user_id, CASE WHEN latest IS NOT NULL THEN {_o_iso('latest')} END AS latest FROM m"""


def _queue_variants(spark, sf_dir):
    """An event as one queue page, of seven kinds by event id: escaped signs, slashes and
    keys, lists, nesting of two to eight levels, look-alikes inside strings, other types."""
    e = _t(spark, sf_dir, "events").select("event_id", "user_id", iso_text("ts", "").alias("t"))
    bodies = [
        F.concat(F.lit('{"drafts":[{"publish_at":"'), F.col("t"), F.lit('\\u002b00:00"}]}')),
        F.concat(F.lit('{"publish\\u005fat" : "'), F.col("t"), F.lit('\\u005A","x":[[],{}]}')),
        F.concat(F.lit('{"pages":[[{"scheduledAt":"'), F.col("t"), F.lit('"},{"scheduled_at":"no\\/time"}],7,null]}')),
        F.concat(F.lit('{"publishAt":["'), F.col("t"), F.lit('","a\\\\"],"scheduleDate":{"schedule-date":null}}')),
        F.concat(F.lit('{"note":"\\"publish_at\\":\\"'), F.col("t"), F.lit('\\"","more":"\\\\","publish_at ":"'), F.col("t"), F.lit('"}')),
        F.concat(F.lit('{"scheduled_date":'), F.col("user_id").cast("string"), F.lit(',"s":"\\t","publishAt":true}')),
        F.concat(F.repeat(F.lit('{"in":[{"a":"\\"}]","scheduled_at":0,"b":'), (F.col("event_id") % 3 + 1).cast("int")),
                 F.lit('{"scheduled_at":"'), F.col("t"), F.lit('"}'), F.repeat(F.lit("}]}"), (F.col("event_id") % 3 + 1).cast("int")))]
    body = F.element_at(F.array(*bodies), (F.col("event_id") % len(bodies) + 1).cast("int"))
    return e.select("event_id", "user_id", body.alias("body"))


def q_queue_variant(spark, sf_dir):
    """FLT-10 + AGG-03 through VARIANT: every value found, and the latest time, by user."""
    q = _queue_variants(spark, sf_dir)
    found = q.select("user_id", F.explode(schedule.schedule_values("body")).alias("v")).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_values"), F.min("v").alias("least"), F.max("v").alias("greatest"))
    latest = schedule.latest_queued(q, F.lit(QUEUE_NOW).cast("timestamp"), ["user_id"])
    return latest.join(found, "user_id", "left").select(
        "user_id", F.coalesce("n_values", F.lit(0)).alias("n_values"), "least", "greatest",
        F.when(F.col("latest").isNotNull(), schedule.slot_text("latest")).alias("latest"))


def o_queue_variant():
    """Every node of the parsed document is a row (DuckDB's own JSON tree)."""
    t = _o_iso("epoch_us(ts)", "")
    k = "CAST(event_id % 3 + 1 AS INT)"
    bodies = [
        f"""'{{"drafts":[{{"publish_at":"' || {t} || '\\u002b00:00"}}]}}'""",
        f"""'{{"publish\\u005fat" : "' || {t} || '\\u005A","x":[[],{{}}]}}'""",
        f"""'{{"pages":[[{{"scheduledAt":"' || {t} || '"}},{{"scheduled_at":"no\\/time"}}],7,null]}}'""",
        f"""'{{"publishAt":["' || {t} || '","a\\\\"],"scheduleDate":{{"schedule-date":null}}}}'""",
        f"""'{{"note":"\\"publish_at\\":\\"' || {t} || '\\"","more":"\\\\","publish_at ":"' || {t} || '"}}'""",
        """'{"scheduled_date":' || CAST(user_id AS VARCHAR) || ',"s":"\\t","publishAt":true}'""",
        f"""repeat('{{"in":[{{"a":"\\"}}]","scheduled_at":0,"b":', {k}) || '{{"scheduled_at":"' || {t} || '"}}' || repeat('}}]}}', {k})"""]
    keys = ", ".join(Q.q(x) for x in fixed.SCHEDULE_KEYS)
    parse = ("CASE WHEN regexp_matches(v, '(Z|[+-][0-9][0-9]:?[0-9][0-9])$') "
             "THEN epoch_us(try_cast(v AS TIMESTAMPTZ)) ELSE epoch_us(try_cast(v AS TIMESTAMP)) END")
    return f"""
    WITH pg AS (SELECT event_id AS ev, user_id, CAST(([{', '.join(bodies)}])[event_id % {len(bodies)} + 1] AS JSON) AS body FROM events),
    v AS (SELECT user_id, json_extract_string(e.atom, '$') AS v FROM pg, json_tree(pg.body) e
          WHERE e.key IN ({keys}) AND e.type = 'VARCHAR'),
    m AS (SELECT user_id, count(*) AS n_values, min(v) AS least, max(v) AS greatest,
                 max(CASE WHEN us >= epoch_us(TIMESTAMP '{QUEUE_NOW}') THEN us END) AS latest
          FROM (SELECT *, {parse} AS us FROM v) GROUP BY user_id)
    SELECT u.user_id, coalesce(n_values, 0) AS n_values, least, greatest,
           CASE WHEN latest IS NOT NULL THEN {_o_iso('latest')} END AS latest
    FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN m USING (user_id)"""


QUEUE_FILE_EVENTS = 500
QUEUE_KEY_SPELLINGS = ["publish_at", "publishAt", "scheduled_at", "scheduledAt", "scheduled_date", "scheduledDate",
                       "schedule-date", "scheduleDate", "publishedAt"]


def q_queue_files(spark, sf_dir):
    """SRC-04: landed queue snapshots, one JSON file per 500 events, read back
    with ``read_queue``; each event is a draft whose time stands under one of the
    eight key spellings (or a ninth that is none of them)."""
    import uuid

    from gleaner.session import shared_dir
    from gleaner.sources.tables import read_queue

    e = _t(spark, sf_dir, "events").select("event_id", "ts", F.floor(F.col("event_id") / QUEUE_FILE_EVENTS).alias("page"))
    key = F.element_at(F.array(*[F.lit(k) for k in QUEUE_KEY_SPELLINGS]),
                       (F.col("event_id") % len(QUEUE_KEY_SPELLINGS) + 1).cast("int"))
    lines = e.select("page", F.col("event_id").alias("n"), F.concat(
        F.lit('{"'), key, F.lit('": "'), iso_text("ts", "Z"), F.lit('"},')).alias("value"))
    ends = e.select("page").distinct().select("page", F.explode(F.array(
        F.struct(F.lit(-1).cast("bigint").alias("n"), F.lit('{"drafts": [').alias("value")),
        F.struct(F.lit(2**62).alias("n"), F.lit("null]}").alias("value")))).alias("x")).select("page", "x.*")
    path = shared_dir(spark, f"queue_files/{uuid.uuid4().hex}")
    # All lines of a snapshot (502 at most) are in one partition, so it is one file.
    (lines.unionByName(ends).repartition("page").sortWithinPartitions("page", "n").select("page", "value")
          .write.partitionBy("page").text(path))
    q = read_queue(spark, f"{path}/*")
    out = schedule.latest_queued(q, F.lit(QUEUE_NOW).cast("timestamp"), ["page"])
    return out.select(F.col("page").cast("bigint").alias("page"),
                      F.when(F.col("latest").isNotNull(), schedule.slot_text("latest")).alias("latest"))


def o_queue_files():
    us = f"max(CASE WHEN event_id % 9 <> 8 AND ts >= TIMESTAMP '{QUEUE_NOW}' THEN epoch_us(ts) END)"
    return f"""
    WITH m AS (SELECT event_id // {QUEUE_FILE_EVENTS} AS page, {us} AS latest FROM events GROUP BY 1)
    SELECT page, CASE WHEN latest IS NOT NULL THEN {_o_iso('latest')} END AS latest FROM m"""


def q_latest_draft(spark, sf_dir):
    """Event times stand in for draft creation times; latest per user."""
    e = _t(spark, sf_dir, "events").select("user_id", "ts")
    return outbox.latest_draft_text(e, "ts", ("user_id",))


def o_latest_draft():
    return f"SELECT user_id, {_o_iso('epoch_us(max(ts))')} AS latest FROM events GROUP BY user_id"


# --------------------------------------------------------------------------
# Sources: RSS items and model responses derived from the tables


RSS_ROOT = "rss"


def _rss_items(spark, sf_dir):
    """Every document as one RSS ``<item>``: guid = doc id (left empty for
    English documents, so the key falls back to the link), padded title, source
    as ``creator``; dates in four forms (German documents carry an unparseable
    one); the text as one ``encoded`` value, as two, or as ``description``
    (Spark's XML writer takes no namespace prefixes; the reader accepts both)."""
    d = _t(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    i = F.col("doc_id") % 4
    ts = F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 3600)
    rfc = F.date_format(ts, "dd MMM yyyy HH:mm")
    pub = (F.when(F.col("lang") == "de", F.lit("not a date"))
            .when(i == 0, F.concat(F.date_format(ts, "EEE, "), rfc, F.lit(":00 +0000")))
            .when(i == 1, F.concat(rfc, F.lit(":00 GMT")))
            .when(i == 2, F.concat(rfc, F.lit(" +0000")))
            .otherwise(iso_text(ts, "Z")))
    guid = F.when(F.col("lang") == "en", F.lit("")).otherwise(F.col("doc_id").cast("string"))
    link = F.concat(F.lit("https://news.example.org/"), F.col("source"), F.lit("/"),
                    F.col("doc_id").cast("string"))
    return d.select(
        F.concat(F.lit("  "), F.col("source"), F.lit(" story "), F.col("doc_id").cast("string"),
                 F.lit("  ")).alias("title"),
        link.alias("link"),
        F.struct(guid.alias("_text"), F.lit("false").alias("_attr_isPermaLink")).alias("guid"),
        F.col("source").alias("creator"),
        pub.alias("pubDate"),
        F.when(i == 0, F.array("text")).when(i == 1, F.array("text", "source")).alias("encoded"),
        F.when(i >= 2, F.col("text")).otherwise(F.lit("not the body")).alias("description"))


def q_feed_scan(spark, sf_dir):
    """SRC-01 + PRJ-01..04: the RSS items are written as landed feed files
    in the shared folder, then read back with the XML source and
    normalized."""
    import uuid

    from gleaner.session import shared_dir
    from gleaner.sources.feed import read_feed

    use_utc(spark)
    path = shared_dir(spark, f"feed_scan/{uuid.uuid4().hex}")
    (_rss_items(spark, sf_dir).write.format("xml")
        .option("rootTag", RSS_ROOT).option("rowTag", "item")
        .option("attributePrefix", "_attr_").option("valueTag", "_text")
        .save(path))
    f = read_feed(spark, path)
    return f.select("article_id", "title", "author", "url",
                    F.when(F.col("published_at").isNotNull(),
                           iso_text("published_at", "Z")).alias("published"),
                    "feed_content")


def o_feed_scan():
    link = "'https://news.example.org/' || source || '/' || CAST(doc_id AS VARCHAR)"
    us = "(CAST(1704067200 + doc_id * 3600 AS BIGINT) * 1000000)"
    return f"""
    SELECT sha256(CASE WHEN lang = 'en' THEN {link} ELSE CAST(doc_id AS VARCHAR) END) AS article_id,
           source || ' story ' || CAST(doc_id AS VARCHAR) AS title,
           source AS author, {link} AS url,
           CASE WHEN lang = 'de' THEN NULL ELSE {_o_iso(us)} END AS published,
           CASE WHEN doc_id % 4 = 1 THEN text || chr(10) || source ELSE text END AS feed_content
    FROM documents"""


def q_atom_scan(spark, sf_dir):
    """SRC-01 for Atom: every document as an ``<entry>`` with a related and an
    alternate link, an author element, and its text as content or summary."""
    import uuid

    from gleaner.session import shared_dir
    from gleaner.sources.feed import read_feed

    d = _t(spark, sf_dir, "documents").select("doc_id", "source", "text")
    url = F.concat(F.lit("https://atom.example.org/"), F.col("doc_id").cast("string"))
    link = lambda href, rel: F.struct(href.alias("_attr_href"), rel.alias("_attr_rel"))
    ts = iso_text(F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 3600), "Z")
    path = shared_dir(spark, f"atom_scan/{uuid.uuid4().hex}")
    d.select(
        F.struct(F.concat(F.col("source"), F.lit(" entry")).alias("_text"), F.lit("text").alias("_attr_type")).alias("title"),
        F.array(link(F.lit("https://elsewhere.example.org/"), F.lit("related")), link(url, F.lit("alternate"))).alias("link"),
        F.concat(F.lit("tag:atom,"), F.col("doc_id").cast("string")).alias("id"),
        F.struct(F.col("source").alias("name")).alias("author"),
        F.when(F.col("doc_id") % 2 == 0, ts).alias("published"), ts.alias("updated"),
        F.when(F.col("doc_id") % 3 > 0, F.struct(F.col("text").alias("_text"), F.lit("html").alias("_attr_type"))).alias("content"),
        F.struct(F.col("text").alias("_text"), F.lit("text").alias("_attr_type")).alias("summary"),
    ).write.format("xml").option("rootTag", "feed").option("rowTag", "entry").option("attributePrefix", "_attr_") \
        .option("valueTag", "_text").save(path)
    f = read_feed(spark, path)
    return f.select("article_id", "title", "author", "url", iso_text("published_at", "Z").alias("published"), "feed_content")


def o_atom_scan():
    us = "(CAST(1704067200 + doc_id * 3600 AS BIGINT) * 1000000)"
    return f"""
    SELECT sha256('tag:atom,' || CAST(doc_id AS VARCHAR)) AS article_id, source || ' entry' AS title, source AS author,
           'https://atom.example.org/' || CAST(doc_id AS VARCHAR) AS url, {_o_iso(us)} AS published, text AS feed_content
    FROM documents"""


MIXED_FILES = 6


def q_feed_scan_mixed(spark, sf_dir):
    """SRC-01 + WIN-04: one folder with RSS and Atom files; every entry's position within
    its own file, dense and in document order."""
    import uuid

    from gleaner.session import shared_dir
    from gleaner.sources.feed import read_feed

    path = shared_dir(spark, f"feed_scan_mixed/{uuid.uuid4().hex}")
    d = _t(spark, sf_dir, "documents").select("doc_id", "source")
    d = d.withColumn("file", F.col("doc_id") % MIXED_FILES)
    n = F.col("doc_id").cast("string")
    rss = d.where("file % 2 = 0").select("file", "doc_id", F.concat(F.lit("<item><guid>"), n, F.lit("</guid><title>"), F.col(
        "source"), F.lit("</title></item>")).alias("value"))
    atom = d.where("file % 2 = 1").select("file", "doc_id", F.concat(F.lit("<entry><id>"), n, F.lit("</id><title>"), F.col(
        "source"), F.lit("</title></entry>")).alias("value"))
    ends = d.select("file").distinct().select("file", F.explode(F.array(
        F.struct(F.lit(-1).cast("bigint").alias("doc_id"), F.lit("<feed>").alias("value")),
        F.struct(F.lit(2**62).alias("doc_id"), F.lit("</feed>").alias("value")))).alias("x")).select("file", "x.*")
    # One file for each residue, in id order.
    (rss.unionByName(atom).unionByName(ends).repartition("file").sortWithinPartitions("file", "doc_id")
        .select("file", "value").write.partitionBy("file").text(path))
    f = read_feed(spark, f"{path}/*")
    return f.select(F.regexp_extract("feed_file", r"file=(\d+)", 1).cast("bigint").alias("file"), "feed_pos", "article_id", "title")


def o_feed_scan_mixed():
    return f"""
    SELECT doc_id % {MIXED_FILES} AS file, row_number() OVER (PARTITION BY doc_id % {MIXED_FILES} ORDER BY doc_id) AS feed_pos,
           sha256(CAST(doc_id AS VARCHAR)) AS article_id, source AS title FROM documents"""


RESPONSE_MAX_CHARS = 1000


def _response_packages(spark, sf_dir):
    """Each assistant turn as a model response JSON -- a multi-line turn as a
    thread of its lines, a one-line turn as a padded single post -- parsed,
    normalized and validated at 1,000 characters."""
    a = (_t(spark, sf_dir, "conversations").where(F.col("role") == "assistant")
         .select("conv_id", "turn", "text"))
    multi = F.instr(F.col("text"), "\n") > 0
    resp = F.to_json(F.struct(
        F.when(multi, F.lit("Thread")).otherwise(F.lit(" single ")).alias("delivery_mode"),
        F.when(multi, F.lit("")).otherwise(F.concat(F.lit(" "), F.col("text"), F.lit(" "))).alias("single_tweet"),
        F.when(multi, F.split(F.col("text"), "\n")).otherwise(F.array().cast("array<string>")).alias("thread")))
    parsed = parse_responses(a.select("conv_id", "turn", resp.alias("response")))
    return packages.validate_packages(parsed, max_chars=RESPONSE_MAX_CHARS).withColumn(
        "error", F.coalesce("parse_error", "error"))


def q_response_check(spark, sf_dir):
    """SRC-05 + FLT-07 (array form) over every assistant turn."""
    return _response_packages(spark, sf_dir).select(
        "conv_id", "turn", "delivery_mode", F.size("thread").cast("bigint").alias("n_items"), "error")


def _o_response_rows() -> str:
    m = RESPONSE_MAX_CHARS
    too_long = f"single_tweet exceeds {m} characters"
    head, tail = "thread tweet ", f" exceeds {m} characters"
    return f"""
    a AS (SELECT conv_id, turn, text, contains(text, chr(10)) AS multi
          FROM conversations WHERE role = 'assistant'),
    p AS (SELECT conv_id, turn,
                 CASE WHEN multi THEN 'thread' ELSE 'single' END AS delivery_mode,
                 CASE WHEN multi THEN '' ELSE trim(text, {Q.WS}) END AS single_tweet,
                 CASE WHEN multi THEN list_filter(list_transform(string_split(text, chr(10)),
                        lambda x: trim(x, {Q.WS})), lambda x: x <> '') ELSE [] END AS thread
          FROM a),
    f0 AS (SELECT *, len(thread) AS n,
                  coalesce(list_position(list_transform(thread, lambda x: length(x) > {m}), true), 0) AS first_long
           FROM p),
    f AS (SELECT *,
           CASE WHEN delivery_mode = 'single' AND single_tweet = '' THEN {Q.q(fixed.ERR_SINGLE_MISSING)}
                WHEN delivery_mode = 'single' AND length(single_tweet) > {m} THEN {Q.q(too_long)}
                WHEN delivery_mode = 'single' AND n > 0 THEN {Q.q(fixed.ERR_SINGLE_HAS_THREAD)}
                WHEN delivery_mode = 'single' THEN NULL
                WHEN single_tweet <> '' THEN {Q.q(fixed.ERR_THREAD_HAS_SINGLE)}
                WHEN n <> {fixed.THREAD_SIZE} THEN {Q.q(fixed.ERR_THREAD_SIZE)}
                WHEN first_long > 0 THEN {Q.q(head)} || CAST(first_long AS VARCHAR) || {Q.q(tail)}
           END AS error
          FROM f0)"""


def o_response_check():
    return f"""WITH {_o_response_rows()}
    SELECT conv_id, turn, delivery_mode, CAST(n AS BIGINT) AS n_items, error FROM f"""


def q_draft_rows(spark, sf_dir):
    """PRJ-11 + PRJ-14 + SNK-02 row shape: valid packages from
    ``response_check`` become draft rows; the reply comes from the page with
    the conversation's id; the publishing service's answer is simulated per
    row (top-level id on even turns, an empty id with a nested draft id on
    odd ones) and the remote id is picked from it."""
    ok = _response_packages(spark, sf_dir).where(F.col("error").isNull())
    pages = _t(spark, sf_dir, "pages").select(F.col("page_id").alias("conv_id"), "url")
    ok = ok.join(pages, "conv_id", "left").withColumn("reply", outbox.read_more("url"))
    body = F.when(F.col("turn") % 2 == 0, F.concat(F.lit('{"id": '), F.col("conv_id").cast("string"), F.lit("}"))) \
            .otherwise(F.concat(F.lit('{"id": "", "draft": {"id": "d'), F.col("conv_id").cast("string"),
                                F.lit("_"), F.col("turn").cast("string"), F.lit('"}}')))
    rows = outbox.draft_rows(ok.withColumn("article_id", F.col("conv_id").cast("string"))
                               .withColumn("_body", body),
                             response_body="_body", created_at=F.lit(RUN_NOW), keep=("conv_id", "turn"))
    return rows.select("conv_id", "turn", "draft_type", "payload", "draft_remote_id")


def o_draft_rows():
    return f"""
    WITH {_o_response_rows()},
    ok AS (SELECT f.conv_id, f.turn, f.delivery_mode, f.single_tweet, f.thread,
                  CASE WHEN trim(pg.url, {Q.WS}) <> '' THEN {Q.q(fixed.READ_MORE_PREFIX)} || trim(pg.url, {Q.WS}) END AS reply
           FROM f LEFT JOIN pages pg ON pg.page_id = f.conv_id WHERE f.error IS NULL)
    SELECT conv_id, turn, delivery_mode AS draft_type,
           CASE WHEN delivery_mode = 'thread' THEN json_object('thread', thread, 'reply', reply)
                ELSE json_object('single_tweet', single_tweet, 'reply', reply) END::VARCHAR AS payload,
           CASE WHEN turn % 2 = 0 THEN CAST(conv_id AS VARCHAR)
                ELSE 'd' || CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR) END AS draft_remote_id
    FROM ok"""


# --------------------------------------------------------------------------
# The batch jobs end to end


RUN_NOW = "2024-02-01 00:00:00"
RUN_SOURCES = ["src2"]
RUN_POINTS, RUN_CHARS = 1, 500


def _curation_inputs(spark, sf_dir):
    """Mapping: every document is a feed entry (key = sha256 of the text,
    position = doc id, author = source, url ``page:<id>``); the page with the
    same id is its web page; labelled documents are already in the ledger;
    ``src2`` is an excluded author."""
    docs = _t(spark, sf_dir, "documents")
    feed = docs.select(
        keys.article_key(id_col=F.col("text")).alias("article_id"),
        F.concat(F.col("source"), F.lit(" "), F.col("doc_id").cast("string")).alias("title"),
        F.col("source").alias("author"),
        F.concat(F.lit("page:"), F.col("doc_id").cast("string")).alias("url"),
        F.lit(None).cast("timestamp").alias("published_at"),
        F.col("text").alias("feed_content"),
        F.col("doc_id").alias("feed_pos"))
    pages = _t(spark, sf_dir, "pages").select(
        F.concat(F.lit("page:"), F.col("page_id").cast("string")).alias("url"), "html")
    labelled = _t(spark, sf_dir, "labels").select("doc_id")
    ledger = (docs.join(labelled, "doc_id", "left_semi")
                  .select(keys.article_key(id_col=F.col("text")).alias("article_id")))
    return feed, pages, ledger


def _model_answers(articles: DataFrame) -> DataFrame:
    """What the model says, by position: a single post, or (position mod 5 = 1) a
    thread; wording to rewrite (mod 7 = 3), no response (mod 11 = 5), a bad mode
    (mod 13 = 6).  An earlier attempt that is not JSON comes along."""
    p, said = F.col("feed_pos"), F.concat(F.lit("post "), F.col("feed_pos").cast("string"), F.lit(" "), F.col("title"))
    said = F.when(p % 7 == 3, F.concat(said, F.lit(" check out this"))).otherwise(said)
    thread = p % 5 == 1
    body = F.to_json(F.struct(
        F.when(p % 13 == 6, F.lit("poster")).when(thread, F.lit("thread")).otherwise(F.lit("single")).alias("delivery_mode"),
        F.when(thread, F.lit("")).otherwise(said).alias("single_tweet"),
        F.when(thread, F.array(said, F.lit("two"), F.lit("three"))).otherwise(F.array().cast("array<string>")).alias("thread")))
    good = articles.where(p % 11 != 5).select("article_id", body.alias("response"), F.lit(2).alias("attempt"))
    return good.unionByName(good.select("article_id", F.lit("{zzz not json").alias("response"), F.lit(1).alias("attempt")))


def _curation(spark, sf_dir, empty: bool = False, dies: str | None = None, base: str | None = None) -> str:
    """All jobs over whole tables, the outputs written per batch to the shared
    folder: prepare, saved and loaded; the model's answers; rewrites for flagged
    posts with an even position; schedule mode from a fixed ``now``; the publishing
    service answers all requests but those with position mod 17 = 8.  ``dies`` names
    the step in which a task of the run raises an error."""
    import uuid

    from gleaner.plans import jobs
    from gleaner.session import shared_dir

    base = base or shared_dir(spark, f"curation/{uuid.uuid4().hex}")
    feed, pages, ledger = _curation_inputs(spark, sf_dir)
    if empty:
        feed = feed.limit(0)

    def broken(step: str, col: str):
        return F.when(F.col("feed_pos") % 3 == 1, F.raise_error(F.lit(f"{step} broke"))).otherwise(F.col(col)) if dies == step else F.col(col)

    now = F.lit(RUN_NOW).cast("timestamp")
    with jobs.accounted_run(spark, f"run_{dies}" if dies else "run_fixture", base, 0) as run:
        run.save_prepared(jobs.prepare(feed.withColumn("title", broken("feed", "title")), pages, ledger, excluded_authors=RUN_SOURCES,
                                       min_points_for_thread=RUN_POINTS, min_chars_for_thread=RUN_CHARS))
        prep = jobs.load_prepared(spark, base, 0)
        responses = _model_answers(prep.articles)
        if dies == "responses":
            responses = responses.join(prep.articles.select("article_id", "feed_pos"), "article_id").withColumn(
                "response", broken("responses", "response")).drop("feed_pos")
        flagged = jobs.promo_rewrite_table(prep, responses, attempt_col="attempt")
        rewrites = (flagged.join(prep.articles.select("article_id", "feed_pos"), "article_id").where("feed_pos % 2 = 0")
                    .select("article_id", F.concat(F.lit('{"delivery_mode": "single", "single_tweet": "rewritten '),
                                                   F.col("feed_pos").cast("string"), F.lit('", "thread": []}')).alias("response"),
                            F.lit(1).alias("attempt")))
        sent = jobs.deliver(prep, responses, publish_mode="schedule", now=now, attempt_col="attempt", rewrites=rewrites)
        out = sent.outbox.withColumn("posts", F.to_json("posts")).select("article_id", "feed_pos", "posts", "payload")
        out.write.parquet(f"{base}/outbox")
        p = F.col("feed_pos").cast("string")
        answers = sent.outbox.where("feed_pos % 17 <> 8").select("article_id", F.when(
            F.col("feed_pos") % 2 == 0, F.concat(F.lit('{"id": 1'), p, F.lit("}"))).otherwise(
            F.concat(F.lit('{"id": "", "draft": {"id": "d'), p, F.lit('"}}'))).alias("answer"))
        run.write_outputs(jobs.confirm(prep, sent, answers, run.run_id, now=now))
    return base


def q_curation_failed_row(spark, sf_dir):
    """AGG-02 + SNK-03: runs whose tasks raise while the feed is scanned and while the
    responses are read.  Both leave a run row with what was counted until then."""
    import uuid

    from gleaner.session import shared_dir

    top = shared_dir(spark, f"curation/{uuid.uuid4().hex}")
    for step in ("feed", "responses"):
        try:
            _curation(spark, sf_dir, dies=step, base=f"{top}/{step}")
        except Exception as e:  # noqa: BLE001 - only the error that the fixture raises
            if f"{step} broke" not in str(e):
                raise
    feed, responses = (spark.read.parquet(f"{top}/{step}/runs") for step in ("feed", "responses"))
    return feed.unionByName(responses).select(
        "run_id", "articles_found", "articles_processed", "articles_failed", "skipped_duplicate", "skipped_excluded", "status")


def o_curation_failed_row():
    return """
    SELECT 'run_feed' AS run_id, CAST(0 AS BIGINT) AS articles_found, CAST(0 AS BIGINT) AS articles_processed,
           CAST(1 AS BIGINT) AS articles_failed, CAST(0 AS BIGINT) AS skipped_duplicate, CAST(0 AS BIGINT) AS skipped_excluded,
           'failed' AS status
    UNION ALL SELECT 'run_responses', count(*), 0, 1, 0, 0, 'failed' FROM documents"""


def q_curation_run(spark, sf_dir):
    """Outcome facts of the whole run."""
    facts = spark.read.parquet(f"{_curation(spark, sf_dir)}/outcomes")
    return facts.select("feed_pos", "article_id", "outcome", "error")


def q_curation_outbox(spark, sf_dir):
    return spark.read.parquet(f"{_curation(spark, sf_dir)}/outbox")


def q_curation_drafts(spark, sf_dir):
    drafts = spark.read.parquet(f"{_curation(spark, sf_dir)}/drafts")
    return drafts.select("article_id", "draft_remote_id", "draft_type", "payload", "publish_mode", "status")


def q_curation_ledger(spark, sf_dir):
    return spark.read.parquet(f"{_curation(spark, sf_dir)}/ledger").select("article_id", "url", "title")


def q_curation_run_row(spark, sf_dir):
    """The run rows of the run and of one without any entry."""
    cols = ["run_id", "articles_found", "articles_processed", "articles_failed", "skipped_duplicate", "skipped_excluded", "status"]
    full = spark.read.parquet(f"{_curation(spark, sf_dir)}/runs").select(*cols)
    none = spark.read.parquet(f"{_curation(spark, sf_dir, empty=True)}/runs").select(*cols)
    return full.unionByName(none.withColumn("run_id", F.concat("run_id", F.lit("_empty"))))


def _o_curation() -> str:
    """The run as the loop over entries in position order: already in the ledger,
    then excluded author, then the model and the publishing service; an entry
    that was excluded or sent puts its key into the ledger."""
    promo = "said LIKE '%check out%'"
    return f"""
    e AS (
      SELECT d.doc_id AS feed_pos, sha256(d.text) AS article_id, d.text, d.source || ' ' || CAST(d.doc_id AS VARCHAR) AS title,
             {_o_author_match("d.source", RUN_SOURCES)} AS ex,
             sha256(d.text) IN (SELECT sha256(x.text) FROM documents x JOIN labels l USING (doc_id)) AS in_ledger
      FROM documents d
    ),
    -- The model sees a key once: its first entry, unless that one is excluded (then all later ones are duplicates).
    art AS (SELECT article_id, min(feed_pos) AS pos FROM e WHERE NOT in_ledger
            GROUP BY article_id HAVING NOT arg_min(ex, feed_pos)),
    {_o_page_bodies()},
    body AS (
      SELECT art.article_id, art.pos AS doc_id, e.title,
             CASE WHEN length(e.text) > 500 THEN e.text WHEN pb.article_text IS NOT NULL THEN pb.article_text
                  ELSE pb.page_text END AS body
      FROM art JOIN e ON e.feed_pos = art.pos LEFT JOIN pb ON pb.page_id = art.pos
    ),
    cl AS (SELECT article_id, doc_id, title, {Q.clean_lines('body')} AS arr FROM body),
    gate AS (
      SELECT article_id, doc_id AS pos, title, length(array_to_string(arr, chr(10))) >= {RUN_CHARS}
             AND len(list_filter(arr, lambda l: {Q.stat_any('l')} OR {Q.angle_any('l')})) >= {RUN_POINTS} AS allow FROM cl
    ),
    drafted AS (
      SELECT *, 'post ' || CAST(pos AS VARCHAR) || ' ' || title || CASE WHEN pos % 7 = 3 THEN ' check out this' ELSE '' END AS said,
             pos % 5 = 1 AS is_thread FROM gate
    ),
    checked AS (
      SELECT *, {promo} AND pos % 11 <> 5 AS flagged,
             CASE WHEN pos % 11 = 5 THEN 'no model response'
                  WHEN {promo} THEN CASE WHEN pos % 2 = 1 THEN 'promotional wording not rewritten' END
                  WHEN pos % 13 = 6 THEN {Q.q("delivery_mode must be either 'single' or 'thread'")}
                  WHEN is_thread AND NOT allow THEN 'Thread returned while thread generation is disabled'
             END AS error
      FROM drafted
    ),
    package AS (
      SELECT article_id, pos, error, NOT flagged AND is_thread AS threaded,
             CASE WHEN flagged THEN ['rewritten ' || CAST(pos AS VARCHAR)] WHEN is_thread THEN [said, 'two', 'three'] ELSE [said] END AS own,
             'Read more: page:' || CAST(pos AS VARCHAR) AS reply
      FROM checked
    ),
    slot AS (
      SELECT *, list_append(own, reply) AS posts,
             epoch_us(TIMESTAMP '{RUN_NOW}') + (row_number() OVER (ORDER BY pos) - 1) * 1800000000 AS us
      FROM package WHERE error IS NULL
    ),
    verdict AS (
      SELECT article_id, coalesce(error, CASE WHEN pos % 17 = 8 THEN 'no answer from the publishing service' END) AS error FROM package
    ),
    f AS (SELECT e.*, v.error FROM e LEFT JOIN verdict v USING (article_id)),
    w AS (SELECT *, coalesce(max(CASE WHEN NOT in_ledger AND (ex OR error IS NULL) THEN 1 ELSE 0 END) OVER (
                  PARTITION BY article_id ORDER BY feed_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done_before
          FROM f),
    oc AS (SELECT feed_pos, article_id, title,
                  CASE WHEN in_ledger OR done_before = 1 THEN 'duplicate' WHEN ex THEN 'excluded'
                       WHEN error IS NOT NULL THEN 'failed' ELSE 'processed' END AS outcome, error
           FROM w)"""


def o_curation_run():
    return f"""WITH {_o_curation()}
    SELECT feed_pos, article_id, outcome, CASE WHEN outcome = 'failed' THEN error END AS error FROM oc"""


def o_curation_outbox():
    post = "json_object('text', x)"
    return f"""WITH {_o_curation()}
    SELECT article_id, pos AS feed_pos, CAST(to_json(posts) AS VARCHAR) AS posts,
           '{{"platforms":{{"x":{{"enabled":true,"posts":' || CAST(to_json(list_transform(posts, lambda x: {post})) AS VARCHAR)
             || '}}}},"publish_at":"' || {_o_iso('us')} || '"}}' AS payload
    FROM slot"""


def o_curation_drafts():
    return f"""WITH {_o_curation()}
    SELECT article_id, CASE WHEN pos % 2 = 0 THEN '1' || CAST(pos AS VARCHAR) ELSE 'd' || CAST(pos AS VARCHAR) END AS draft_remote_id,
           CASE WHEN threaded THEN 'thread' ELSE 'single' END AS draft_type,
           CASE WHEN threaded THEN json_object('thread', own, 'reply', reply)
                ELSE json_object('single_tweet', own[1], 'reply', reply) END::VARCHAR AS payload,
           'schedule' AS publish_mode, 'ok' AS status
    FROM slot WHERE pos % 17 <> 8"""


def o_curation_ledger():
    return f"""WITH {_o_curation()}
    SELECT article_id, 'page:' || CAST(min(feed_pos) AS VARCHAR) AS url, arg_min(title, feed_pos) AS title
    FROM oc WHERE outcome IN ('processed', 'excluded') GROUP BY article_id"""


def o_curation_run_row():
    n = lambda x: f"CAST(count_if(outcome = '{x}') AS BIGINT)"
    return f"""WITH {_o_curation()}
    SELECT 'run_fixture' AS run_id, count(*) AS articles_found, {n('processed')} AS articles_processed,
           {n('failed')} AS articles_failed, {n('duplicate')} AS skipped_duplicate, {n('excluded')} AS skipped_excluded,
           CASE WHEN {n('failed')} = 0 THEN 'completed' ELSE 'completed_with_errors' END AS status FROM oc
    UNION ALL SELECT 'run_fixture_empty', 0, 0, 0, 0, 0, 'completed'"""


CONFIRM_MODES = ("draft", "publish_now", "schedule")


def q_confirm_rows(spark, sf_dir):
    """PRJ-12 + PRJ-14: every conversation turn as one request in one of the three
    publish modes; the service answers two of three, and only those get a draft
    row with the remote id of the answer."""
    c = _t(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    mode = F.element_at(F.array(*[F.lit(m) for m in CONFIRM_MODES]), (F.col("turn") % 3 + 1).cast("int"))
    slot = F.when(mode == "schedule", F.lit("2024-02-01T00:00:00Z"))
    posts = outbox.post_list(F.lit("single"), "text", F.array().cast("array<string>"))
    key = F.concat_ws("_", "conv_id", "turn")
    sent = c.select("conv_id", "turn", key.alias("article_id"), F.lit("single").alias("delivery_mode"),
                    F.col("text").alias("single_tweet"), F.array().cast("array<string>").alias("thread"),
                    F.lit(None).cast("string").alias("reply"), mode.alias("publish_mode"),
                    outbox.outbox_payload(posts, mode, slot).alias("request"))
    answers = c.where((F.col("conv_id") + F.col("turn")) % 3 != 1).select(
        key.alias("article_id"), F.concat(F.lit('{"draft": {"id": "'), key, F.lit('"}}')).alias("answer"))
    went = sent.join(answers, "article_id")
    rows = outbox.draft_rows(went, publish_mode="publish_mode", response_body="answer",
                             created_at=F.lit(RUN_NOW), keep=("conv_id", "turn", "request"))
    return rows.select("conv_id", "turn", "request", "payload", "publish_mode", "draft_remote_id")


def o_confirm_rows():
    at = """CASE turn % 3 WHEN 1 THEN ',"publish_at":"now"' WHEN 2 THEN ',"publish_at":"2024-02-01T00:00:00Z"' ELSE '' END"""
    return f"""
    SELECT conv_id, turn,
           '{{"platforms":{{"x":{{"enabled":true,"posts":[' || CAST(json_object('text', text) AS VARCHAR) || ']}}}}' || {at} || '}}' AS request,
           CAST(json_object('single_tweet', text, 'reply', NULL) AS VARCHAR) AS payload,
           ['draft', 'publish_now', 'schedule'][turn % 3 + 1] AS publish_mode,
           CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR) AS draft_remote_id
    FROM conversations WHERE (conv_id + turn) % 3 <> 1"""


# --------------------------------------------------------------------------
# Streaming


STREAM_BATCHES = 4


def _stream_documents(spark, sf_dir, name, decide=None):
    """Documents land in four pieces (by id), each picked up by one run of the
    same checkpointed stream: four micro-batches with copies across them."""
    import uuid

    from gleaner.session import shared_dir
    from gleaner.streaming import start_feed_stream

    base = shared_dir(spark, f"{name}/{uuid.uuid4().hex}")
    docs = _t(spark, sf_dir, "documents")
    land = docs.select(keys.article_key(id_col=F.col("text")).alias("article_id"),
                       F.col("doc_id").cast("string").alias("url"), F.col("source").alias("title"),
                       F.lit(None).cast("timestamp").alias("published_at"), F.col("doc_id").alias("feed_pos"))
    for i in range(STREAM_BATCHES):
        land.where(F.col("feed_pos") % STREAM_BATCHES == i).write.parquet(f"{base}/landed/piece_{i}")
        src = spark.readStream.schema(land.schema).parquet(f"{base}/landed/*")
        q = start_feed_stream(src, f"{base}/checkpoint", f"{base}/ledger", f"{base}/retry", f"{base}/outcomes", decide)
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    return base


def q_stream_ledger(spark, sf_dir):
    """STR-01/02 + SNK-01 + SRC-03: each micro-batch is deduplicated against the
    ledger the earlier ones wrote, and appends its new keys: one row per distinct
    text, with the first document of the first piece that holds it."""
    base = _stream_documents(spark, sf_dir, "stream_ledger")
    return spark.read.parquet(f"{base}/ledger").select("article_id", "url", "title", F.col("batch_id").cast("bigint").alias("batch_id"))


def o_stream_ledger():
    at = f"doc_id % {STREAM_BATCHES} * 1000000000000 + doc_id"
    return f"""
    SELECT sha256(text) AS article_id, CAST(arg_min(doc_id, {at}) AS VARCHAR) AS url, arg_min(source, {at}) AS title,
           min(doc_id % {STREAM_BATCHES}) AS batch_id
    FROM documents GROUP BY sha256(text)"""


def q_stream_retry(spark, sf_dir):
    """STR-04: entries with id mod 10 = 3 fail in the batch they arrive in and
    would succeed in the next; the facts of every batch."""
    decide = lambda df: df.withColumn("excluded", F.lit(False)).withColumn(
        "failed", (F.col("_new") == 1) & (F.col("feed_pos") % 10 == 3))
    base = _stream_documents(spark, sf_dir, "stream_retry", decide)
    return spark.read.parquet(f"{base}/outcomes").select(
        F.col("run_batch").cast("bigint").alias("run_batch"), "feed_pos", "article_id", "outcome")


def o_stream_retry():
    # An attempt's place: its batch, retries before new entries, then the id.
    return f"""
    WITH d AS (SELECT doc_id AS p, sha256(text) AS k, doc_id % {STREAM_BATCHES} AS b, doc_id % 10 = 3 AS fails FROM documents),
    a AS (SELECT *, b * 10000000000 + 5000000000 + p AS seat, (b + 1) * 10000000000 + p AS again FROM d),
    k AS (SELECT k, min(CASE WHEN NOT fails THEN seat WHEN b < {STREAM_BATCHES - 1} THEN again END) AS done FROM a GROUP BY k),
    r AS (SELECT a.*, coalesce(done, 99 * 10000000000) AS done FROM a JOIN k USING (k))
    SELECT b AS run_batch, p AS feed_pos, k AS article_id,
           CASE WHEN seat > done THEN 'duplicate' WHEN seat = done THEN 'processed' ELSE 'failed' END AS outcome FROM r
    UNION ALL
    SELECT b + 1, p, k, CASE WHEN again > done THEN 'duplicate' ELSE 'processed' END FROM r
    WHERE fails AND seat < done AND b < {STREAM_BATCHES - 1} AND done >= (b + 1) * 10000000000"""


CHAIN_POLLS = 3


def _land(df: DataFrame, path: str) -> DataFrame:
    """``df`` as landed files: written, and read back as a stream of the whole folder."""
    df.write.parquet(path)
    folder = path.rsplit("/", 1)[0]
    return df.sparkSession.readStream.schema(df.schema).parquet(f"{folder}/*")


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


DEDUP_PIECES = 8
DEDUP_DELAY_HOURS = 1


def q_stream_bounded_dedup(spark, sf_dir):
    """STR-02 with bounded state: documents land in eight pieces, an hour apart; a key is
    forgotten once the stream has seen a time two delays after it, and then comes again.
    Each piece is a run of its own from the same checkpoint, so the state is restored."""
    import uuid

    from gleaner.session import shared_dir
    from gleaner.streaming import bounded_dedup

    base = shared_dir(spark, f"stream_bounded_dedup/{uuid.uuid4().hex}")
    piece = F.col("doc_id") % DEDUP_PIECES
    land = _t(spark, sf_dir, "documents").select(
        keys.article_key(id_col=F.col("text")).alias("article_id"), piece.alias("piece"),
        F.timestamp_seconds(F.lit(1704067200) + piece * 3600).alias("landed_at"))
    for k in range(DEDUP_PIECES):
        src = _land(land.where(F.col("piece") == k), f"{base}/landed/piece_{k}")
        new = bounded_dedup(src, "landed_at", f"{DEDUP_DELAY_HOURS} hours")
        _finish(new.writeStream.format("parquet").option("checkpointLocation", f"{base}/ck").option("path", f"{base}/new")
                .trigger(availableNow=True).start())
    return spark.read.parquet(f"{base}/new").select("article_id", F.col("piece").cast("bigint").alias("piece"))


def o_stream_bounded_dedup():
    # At the end of piece r the watermark is r less the delay; a key of piece p is kept until p plus the delay.
    gap = 2 * DEDUP_DELAY_HOURS + 1
    return f"""
    WITH RECURSIVE k AS (SELECT DISTINCT sha256(text) AS article_id, doc_id % {DEDUP_PIECES} AS piece FROM documents),
    seen AS (
      SELECT article_id, min(piece) AS piece FROM k GROUP BY article_id
      UNION ALL
      SELECT s.article_id, (SELECT min(k.piece) FROM k WHERE k.article_id = s.article_id AND k.piece >= s.piece + {gap})
      FROM seen s WHERE EXISTS (SELECT 1 FROM k WHERE k.article_id = s.article_id AND k.piece >= s.piece + {gap})
    )
    SELECT article_id, piece FROM seen"""


def q_curation_retry(spark, sf_dir):
    """STR-04 through the whole chain, as streams: documents land in three pieces, one a
    poll; the model's answer to an article is invalid in its first (position mod 4)
    attempts, and with position mod 5 = 2 the publishing service refuses the first valid
    one.  Every attempt of every poll, and the entries settled before the model."""
    import uuid

    from gleaner.plans import chain
    from gleaner.session import shared_dir

    base = shared_dir(spark, f"curation_retry/{uuid.uuid4().hex}")
    feed, pages, _ = _curation_inputs(spark, sf_dir)
    for k in range(CHAIN_POLLS):
        src = _land(feed.where(F.col("feed_pos") % CHAIN_POLLS == k), f"{base}/landed/feed/piece_{k}")
        _finish(chain.start_prepare(src, f"{base}/ck/feed", pages, base, max_attempts=CHAIN_POLLS))
        asked = spark.read.parquet(f"{base}/articles/poll=prepare-{k}")
        p = F.col("feed_pos")
        good = F.concat(F.lit('{"delivery_mode":"single","single_tweet":"post '), p.cast("string"), F.lit('"}'))
        src = _land(asked.select("article_id", "attempt", F.when(F.col("attempt") > p % 4, good).otherwise(
            F.lit('{"delivery_mode":"poster"}')).alias("response")), f"{base}/landed/responses/piece_{k}")
        _finish(chain.start_deliver(src, f"{base}/ck/responses", base))
        sent = spark.read.parquet(f"{base}/outbox/batch_id={k}")
        refused = (p % 5 == 2) & (F.col("attempt") == p % 4 + 1)
        src = _land(sent.select("article_id", "attempt", F.when(~refused, F.concat(
            F.lit('{"id":'), p.cast("string"), F.lit("}"))).alias("answer")), f"{base}/landed/answers/piece_{k}")
        _finish(chain.start_confirm(src, f"{base}/ck/answers", base))
    return spark.read.parquet(f"{base}/outcomes").select(
        F.col("batch_id").cast("bigint").alias("poll"), F.col("stage").cast("string").alias("stage"), "article_id",
        "feed_pos", F.col("attempt").cast("bigint").alias("attempt"), "outcome", "error")


def o_curation_retry():
    return f"""
    WITH d AS (SELECT doc_id AS p, sha256(text) AS k, doc_id % {CHAIN_POLLS} AS poll FROM documents),
    art AS (SELECT k, min(poll) AS poll, arg_min(p, poll * 1000000000000 + p) AS p FROM d GROUP BY k),
    -- Tries until the first valid answer, and one more where that one is refused.
    need AS (SELECT *, p % 4 + 1 AS valid, p % 4 + 1 + CASE WHEN p % 5 = 2 THEN 1 ELSE 0 END AS sent FROM art),
    tries AS (SELECT *, unnest(range(1, least(sent, {CHAIN_POLLS} - poll) + 1)) AS attempt FROM need)
    SELECT poll + attempt - 1 AS poll, CASE WHEN attempt < valid THEN 'deliver' ELSE 'confirm' END AS stage, k AS article_id,
           p AS feed_pos, attempt, CASE WHEN attempt = sent THEN 'processed' ELSE 'failed' END AS outcome,
           CASE WHEN attempt < valid THEN {Q.q("delivery_mode must be either 'single' or 'thread'")}
                WHEN attempt < sent THEN 'no answer from the publishing service' END AS error
    FROM tries
    UNION ALL
    SELECT d.poll, 'prepare', d.k, d.p, NULL, 'duplicate', NULL FROM d JOIN art USING (k) WHERE d.p <> art.p"""


def q_stream_deliver(spark, sf_dir):
    """JOIN-03 as a stream: every document waits for its response; responses land in
    three pieces by position, some twice in one piece (mod 5 = 1), some again in a later
    one (mod 7 = 2), some under an attempt that is over (mod 11 = 3) or for articles that
    nobody asked about.  Posts by batch, and the responses set aside with their reason."""
    import uuid

    from gleaner.plans import chain
    from gleaner.session import shared_dir

    base = shared_dir(spark, f"stream_deliver/{uuid.uuid4().hex}")
    feed, pages, _ = _curation_inputs(spark, sf_dir)
    _finish(chain.start_prepare(_land(feed, f"{base}/landed/feed/piece_0"), f"{base}/ck/feed", pages, base))
    asked = spark.read.parquet(f"{base}/articles").select("article_id", "feed_pos")
    p = F.col("feed_pos")

    def says(word: str):
        return F.concat(F.lit('{"delivery_mode":"single","single_tweet":"'), F.lit(word), p.cast("string"), F.lit('"}')).alias("response")

    one = F.lit(None).cast("int").alias("attempt")
    for k in range(CHAIN_POLLS):
        here, before = asked.where(p % CHAIN_POLLS == k), asked.where((p + 1) % CHAIN_POLLS == k)
        piece = here.where(p % 11 != 3).select("article_id", says("a "), one)
        piece = piece.unionByName(here.where(p % 5 == 1).select("article_id", says("b "), F.lit(1).alias("attempt")))
        piece = piece.unionByName(before.where(p % 7 == 2).select("article_id", says("c "), one))
        piece = piece.unionByName(here.where(p % 11 == 3).select("article_id", says("d "), F.lit(0).alias("attempt")))
        piece = piece.unionByName(here.where(p % 13 == 4).select(F.concat(F.lit("nobody "), p.cast("string")).alias("article_id"), says("e "), one))
        src = _land(piece, f"{base}/landed/responses/piece_{k}")
        _finish(chain.start_deliver(src, f"{base}/ck/responses", base))
    posts = spark.read.parquet(f"{base}/outbox").select(
        F.col("batch_id").cast("bigint").alias("batch"), "article_id", F.col("single_tweet").alias("said"), F.lit("sent").alias("what"))
    aside = spark.read.parquet(f"{base}/ignored/stage=deliver").select(
        F.col("batch_id").cast("bigint").alias("batch"), "article_id",
        F.get_json_object("response", "$.single_tweet").alias("said"), F.col("reason").alias("what"))
    return posts.unionByName(aside)


def o_stream_deliver():
    n = CHAIN_POLLS
    return f"""
    WITH a AS (SELECT sha256(text) AS k, min(doc_id) AS p FROM documents GROUP BY 1),
    landed AS (
      SELECT p % {n} AS b, k, 'a ' || p AS said, CAST(NULL AS INT) AS attempt, true AS asked FROM a WHERE p % 11 <> 3
      UNION ALL SELECT p % {n}, k, 'b ' || p, 1, true FROM a WHERE p % 5 = 1
      UNION ALL SELECT (p + 1) % {n}, k, 'c ' || p, NULL, true FROM a WHERE p % 7 = 2
      UNION ALL SELECT p % {n}, k, 'd ' || p, 0, true FROM a WHERE p % 11 = 3
      UNION ALL SELECT p % {n}, 'nobody ' || p, 'e ' || p, NULL, false FROM a WHERE p % 13 = 4),
    -- The first batch that holds a response to the waiting attempt, and its greatest text.
    first AS (SELECT k, min(b) AS b FROM landed WHERE asked AND coalesce(attempt, 1) = 1 GROUP BY k),
    best AS (SELECT l.k, l.b, max(said) AS said FROM landed l JOIN first f ON l.k = f.k AND l.b = f.b
             WHERE asked AND coalesce(attempt, 1) = 1 GROUP BY l.k, l.b)
    SELECT l.b AS batch, l.k AS article_id, l.said,
           CASE WHEN NOT asked THEN 'unknown' WHEN attempt = 0 THEN 'late' WHEN l.b > best.b THEN 'settled'
                WHEN l.said = best.said THEN 'sent' ELSE 'doubled' END AS what
    FROM landed l LEFT JOIN best ON best.k = l.k"""


# --------------------------------------------------------------------------

_CUT = (fixed.MAX_KEY_POINTS, fixed.PROMPT_TEXT_CHARS)

# Name -> (query, its oracle SQL).
_REGISTERED: dict[str, tuple[Callable[[SparkSession, str], DataFrame], Callable[[], str]]] = {
    "key_points": (q_key_points, o_key_points),
    "key_points_all": (q_key_points_all, o_key_points_all),
    "stat_lines": (q_stat_lines, o_stat_lines),
    "line_flags": (q_line_flags, o_line_flags),
    "clean_documents": (q_clean_documents, o_clean_documents),
    "page_text": (q_page_text, o_page_text),
    "page_text_nested": (q_page_text_nested, o_page_text_nested),
    "body_ladder": (q_body_ladder, o_body_ladder),
    "body_ladder_main": (q_body_ladder_main, o_body_ladder_main),
    "article_keys": (q_article_keys, o_article_keys),
    "ledger_anti": (q_ledger_anti, o_ledger_anti),
    "author_screen": (q_author_screen, o_author_screen),
    "author_screen_table": (q_author_screen_table, o_author_screen_table),
    "feed_positions": (q_feed_positions, o_feed_positions),
    "batch_cap": (q_batch_cap, o_batch_cap),
    "ingest_outcomes": (q_ingest_outcomes, o_ingest_outcomes),
    "run_summary": (q_run_summary, o_run_summary),
    "thread_gate": (_q_thread_gate(fixed.MAX_KEY_POINTS), _o_thread_gate(fixed.MAX_KEY_POINTS)),
    "thread_gate_all": (_q_thread_gate(None), _o_thread_gate(None)),
    "validate_packages": (_q_validate(fixed.MAX_POST_CHARS), _o_validate(fixed.MAX_POST_CHARS)),
    "validate_packages_1000": (_q_validate(1000), _o_validate(1000)),
    "promo_flag": (q_promo_flag, o_promo_flag),
    "promo_words": (q_promo_words, o_promo_words),
    **{name: (_q_prompts(*how), _o_prompts(*how)) for name, how in {
        "prompt_table": ("generate", *_CUT, fixed.PROMPT_POINTS_GENERATE),
        "prompt_table_full": ("generate", None, None, None),
        "fact_check_table": ("fact_check", None, fixed.PROMPT_TEXT_CHARS, fixed.PROMPT_POINTS_FACT_CHECK),
        "fact_check_table_full": ("fact_check", None, None, None),
        "promo_rewrite_table": ("promo_rewrite", *_CUT, None),
        "promo_rewrite_table_full": ("promo_rewrite", None, None, None)}.items()},
    "outbox_rows": (q_outbox_rows, o_outbox_rows),
    "publish_slots": (q_publish_slots, o_publish_slots),
    "queue_latest": (_q_queue_latest(fixed.MAX_QUEUE_PAGES), _o_queue_latest(fixed.MAX_QUEUE_PAGES)),
    "queue_latest_all": (_q_queue_latest(None), _o_queue_latest(None)),
    "queue_variant": (q_queue_variant, o_queue_variant),
    "queue_files": (q_queue_files, o_queue_files),
    "latest_draft": (q_latest_draft, o_latest_draft),
    "feed_scan": (q_feed_scan, o_feed_scan),
    "atom_scan": (q_atom_scan, o_atom_scan),
    "feed_scan_mixed": (q_feed_scan_mixed, o_feed_scan_mixed),
    "response_check": (q_response_check, o_response_check),
    "draft_rows": (q_draft_rows, o_draft_rows),
    "confirm_rows": (q_confirm_rows, o_confirm_rows),
    "curation_run": (q_curation_run, o_curation_run),
    "curation_outbox": (q_curation_outbox, o_curation_outbox),
    "curation_drafts": (q_curation_drafts, o_curation_drafts),
    "curation_ledger": (q_curation_ledger, o_curation_ledger),
    "curation_run_row": (q_curation_run_row, o_curation_run_row),
    "stream_ledger": (q_stream_ledger, o_stream_ledger),
    "stream_retry": (q_stream_retry, o_stream_retry),
    "curation_failed_row": (q_curation_failed_row, o_curation_failed_row),
    "stream_bounded_dedup": (q_stream_bounded_dedup, o_stream_bounded_dedup),
    "curation_retry": (q_curation_retry, o_curation_retry),
    "stream_deliver": (q_stream_deliver, o_stream_deliver),
}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {n: q for n, (q, _) in _REGISTERED.items()}
ORACLES: dict[str, Callable[[], str]] = {n: o for n, (_, o) in _REGISTERED.items()}
