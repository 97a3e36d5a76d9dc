"""Prompt tables for the external text model (PRJ-10, LIM-02, LIM-03).

The model call itself is outside Spark; these operators build one prompt
row per article (or per draft) from columns, with a template given as an
argument.  The templates below are this project's own wording; only the
structure (which fields, in which order, the "Unknown" and "none extracted"
fallbacks, the point and text budgets) follows the behaviour reproduced.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions import fixed
from gleaner.functions.timefmt import iso_text

ColumnOrName = Column | str

GENERATE_TEMPLATE = (
    "Headline: {title}\n"
    "Byline: {author}\n"
    "Published: {published}\n"
    "\n"
    "Article text (the only source of facts):\n"
    "{text}\n"
    "\n"
    "Key data points:\n"
    "{points}\n"
    "\n"
    "Write one post about the single strongest betting angle in the article. "
    "A three-post thread is allowed: {thread_allowed}."
)

FACT_CHECK_TEMPLATE = (
    "Article text (the only source of facts):\n"
    "{text}\n"
    "\n"
    "Key data points:\n"
    "{points}\n"
    "\n"
    "Draft as JSON:\n"
    "{draft}\n"
    "\n"
    "Check every claim in the draft against the article, remove anything it "
    "does not support, and return the same JSON shape. "
    "A three-post thread is allowed: {thread_allowed}."
)

PROMO_REWRITE_TEMPLATE = (
    "Article text (the only source of facts):\n"
    "{text}\n"
    "\n"
    "Draft as JSON:\n"
    "{draft}\n"
    "\n"
    "Remove promotional wording and calls to action; keep the insight. "
    "Return the same JSON shape. A three-post thread is allowed: {thread_allowed}."
)

_FIELD = re.compile(r"\{(\w+)\}")


def _budgeted(text: ColumnOrName, budget: int | None) -> Column:
    """The article text as placed into a prompt.  Every upstream step
    (cleaning, key points, thread gate) reads the whole text, and by default
    the whole text is placed; ``budget`` holds the copy handed to the model to
    its context size (LIM-03)."""
    t = F.coalesce(_col(text), F.lit(""))
    return t if budget is None else F.substring(t, 1, budget)


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def render(template: str, **fields: Column) -> Column:
    """Fill ``{name}`` fields of a template with columns (one ``concat``)."""
    parts: list[Column] = []
    pos = 0
    for m in _FIELD.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        parts.append(F.coalesce(fields[m.group(1)], F.lit("")))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


def bullet_points(points: ColumnOrName, limit: int | None = None) -> Column:
    """Points (the first ``limit``, if given) as ``- `` lines, or the "none extracted" line."""
    p = F.coalesce(_col(points), F.array().cast("array<string>"))
    head = p if limit is None else F.slice(p, 1, limit)
    return F.when(F.size(head) == 0, F.lit(fixed.NO_POINTS_LINE)).otherwise(
        F.array_join(F.transform(head, lambda x: F.concat(F.lit(fixed.POINT_BULLET), x)), "\n"))


def _flag_text(allow: Column | bool) -> Column:
    if isinstance(allow, bool):
        return F.lit(str(allow).lower())
    return F.when(allow, F.lit("true")).otherwise(F.lit("false"))


def generate_prompt(title: ColumnOrName, author: ColumnOrName, published: ColumnOrName,
                    clean_text: ColumnOrName, points: ColumnOrName,
                    allow_thread: Column | bool = True,
                    template: str = GENERATE_TEMPLATE,
                    text_budget: int | None = None,
                    max_points: int | None = None) -> Column:
    """Generation prompt: title, author or "Unknown", ISO time or "Unknown",
    the clean text within the model's text budget, the first points."""
    pub = _col(published)
    return render(
        template,
        title=F.coalesce(_col(title), F.lit("")),
        author=F.coalesce(F.nullif(_col(author), F.lit("")), F.lit(fixed.UNKNOWN)),
        published=F.when(pub.isNull(), F.lit(fixed.UNKNOWN)).otherwise(iso_text(pub, "+00:00")),
        text=_budgeted(clean_text, text_budget),
        points=bullet_points(points, max_points),
        thread_allowed=_flag_text(allow_thread))


def draft_json(mode: ColumnOrName, single: ColumnOrName, thread: ColumnOrName) -> Column:
    """The package as JSON text (compact separators; non-ASCII kept)."""
    return F.to_json(F.struct(_col(mode).alias("delivery_mode"),
                              _col(single).alias("single_tweet"),
                              _col(thread).alias("thread")))


def fact_check_prompt(clean_text: ColumnOrName, points: ColumnOrName, draft: ColumnOrName,
                      allow_thread: Column | bool = True,
                      template: str = FACT_CHECK_TEMPLATE,
                      text_budget: int | None = None,
                      max_points: int | None = None) -> Column:
    return render(
        template,
        text=_budgeted(clean_text, text_budget),
        points=bullet_points(points, max_points),
        draft=_col(draft),
        thread_allowed=_flag_text(allow_thread))


def promo_rewrite_prompt(clean_text: ColumnOrName, draft: ColumnOrName,
                         allow_thread: Column | bool = True,
                         template: str = PROMO_REWRITE_TEMPLATE,
                         text_budget: int | None = None) -> Column:
    return render(
        template,
        text=_budgeted(clean_text, text_budget),
        draft=_col(draft),
        thread_allowed=_flag_text(allow_thread))
