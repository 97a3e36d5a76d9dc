"""Outbox and draft rows (PRJ-09, PRJ-11, PRJ-12, PRJ-14, SET-02, AGG-04)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions import fixed
from gleaner.functions.text import py_strip
from gleaner.functions.timefmt import iso_text

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def read_more(url: ColumnOrName) -> Column:
    """PRJ-09: ``Read more: <url>``, null when the url is missing or blank."""
    u = py_strip(_col(url))
    return F.when(u != "", F.concat(F.lit(fixed.READ_MORE_PREFIX), u))


def post_list(mode: ColumnOrName, single: ColumnOrName, thread: ColumnOrName,
              reply: ColumnOrName | None = None) -> Column:
    """SET-02: the thread (or the single post) with the reply appended when
    there is one."""
    posts = F.when(_col(mode) == "thread", _col(thread)).otherwise(F.array(_col(single)))
    if reply is None:
        return posts
    r = _col(reply)
    return F.when(r.isNull(), posts).otherwise(F.concat(posts, F.array(r)))


def publish_at(mode: ColumnOrName, slot_text: ColumnOrName | None) -> Column:
    """``now`` for publish_now, the slot for schedule, null for draft."""
    m = _col(mode)
    s = _col(slot_text) if slot_text is not None else F.lit(None).cast("string")
    return (F.when(m == "publish_now", F.lit("now"))
             .when(m == "schedule", s))


def payload_error(mode: ColumnOrName, slot_text: ColumnOrName | None) -> Column:
    """Errors raised while building an outbox payload: unknown mode, or
    schedule mode without a parseable slot."""
    m = _col(mode)
    s = _col(slot_text) if slot_text is not None else F.lit(None).cast("string")
    parsed = F.regexp_replace(s, "Z$", "+00:00").try_cast("timestamp")
    return (F.when(~m.isin(*fixed.PUBLISH_MODES), F.lit("Invalid publish mode"))
             .when((m == "schedule") & ((s.isNull()) | (s == "")),
                   F.lit("schedule_at is required for schedule mode"))
             .when((m == "schedule") & parsed.isNull(), F.lit("schedule_at is not an ISO time")))


def outbox_payload(posts: ColumnOrName, mode: ColumnOrName,
                   slot_text: ColumnOrName | None = None) -> Column:
    """PRJ-12: the draft request body as JSON text.  ``publish_at`` is left
    out in draft mode (``to_json`` drops null fields)."""
    body = F.struct(
        F.struct(F.struct(F.lit(True).alias("enabled"),
                          F.transform(_col(posts), lambda p: F.struct(p.alias("text"))).alias("posts"))
                 .alias("x")).alias("platforms"),
        publish_at(mode, slot_text).alias("publish_at"))
    return F.to_json(body)


def draft_payload(mode: ColumnOrName, single: ColumnOrName, thread: ColumnOrName,
                  reply: ColumnOrName) -> Column:
    """PRJ-11: the stored payload; a null reply is kept as ``null``."""
    opts = {"ignoreNullFields": "false"}
    th = F.to_json(F.struct(_col(thread).alias("thread"), _col(reply).alias("reply")), opts)
    si = F.to_json(F.struct(_col(single).alias("single_tweet"), _col(reply).alias("reply")), opts)
    return F.when(_col(mode) == "thread", th).otherwise(si)


def remote_id(body: ColumnOrName) -> Column:
    """PRJ-14: top-level ``id``, else ``draft.id``, else empty, as text.
    Falsy values (empty, 0, false, null) fall through as they would in a
    truthiness test."""
    def truthy(c: Column) -> Column:
        return F.when(~F.coalesce(c, F.lit("")).isin("", "0", "0.0", "false", "null"), c)
    b = _col(body)
    return F.coalesce(truthy(F.get_json_object(b, "$.id")),
                      truthy(F.get_json_object(b, "$.draft.id")), F.lit(""))


def draft_rows(df: DataFrame, article_id: str = "article_id", mode: str = "delivery_mode",
               single: str = "single_tweet", thread: str = "thread", reply: str = "reply",
               publish_mode: ColumnOrName | None = None, response_body: str | None = None,
               created_at: ColumnOrName | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """SNK-02 row shape: one draft row per delivered package (``keep``
    carries extra columns along)."""
    rid = remote_id(response_body) if response_body else F.lit(None).cast("string")
    ts = _col(created_at) if created_at is not None else F.current_timestamp()
    return df.select(
        F.col(article_id).alias("article_id"),
        rid.alias("draft_remote_id"),
        F.col(mode).alias("draft_type"),
        draft_payload(mode, single, thread, reply).alias("payload"),
        (F.lit("draft") if publish_mode is None else _col(publish_mode)).alias("publish_mode"),
        F.lit("ok").alias("status"),
        ts.cast("timestamp").alias("created_at"),
        *keep)


def latest_draft(drafts: DataFrame, time_col: str = "created_at",
                 group_cols: tuple[str, ...] = ()) -> DataFrame:
    """AGG-04: the latest draft time (overall or per group), a partial max."""
    agg = F.max(time_col).alias("latest")
    return drafts.groupBy(*group_cols).agg(agg) if group_cols else drafts.agg(agg)


def latest_draft_text(drafts: DataFrame, time_col: str, group_cols: tuple[str, ...] = ()) -> DataFrame:
    out = latest_draft(drafts, time_col, group_cols)
    return out.withColumn("latest", iso_text("latest", "Z"))
