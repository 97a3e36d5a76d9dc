"""Row-local text expressions: trimming, line splitting, tag and boilerplate
removal, entity decoding and article cleaning (PRJ-05, PRJ-06, PRJ-08,
FLT-02, FLT-03, AGG-05).

Every function here returns a ``Column`` built only from Spark built-ins
(``regexp_replace``, ``split``, higher-order ``filter``/``transform``), so the
work stays inside the JVM, runs per row without any shuffle and keeps column
pruning and predicate pushdown intact.
"""

from __future__ import annotations

import html.entities
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions import fixed
from gleaner.functions.fixed import char_class
from gleaner.functions.memo import by_column_name

ColumnOrName = Column | str

LINE_SPLIT = char_class(fixed.PY_LINE_BREAKS) + "+"
TAG = r"<[^>]+>"
# Markup as an HTML tokenizer sees it: '<' then a letter, '/', '!' or '?',
# up to the first '>' outside a quoted attribute value.  A bare "a < b > c"
# stays text.
ANY_TAG = r"""<[A-Za-z/!?](?:"[^"]*"|'[^']*'|[^'">])*>"""
COMMENT = r"(?s)<!--.*?(?:-->|$)"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: ColumnOrName) -> Column:
    """``str.strip()``: remove Unicode whitespace at both ends."""
    return F.trim(_col(c), F.lit(fixed.PY_WHITESPACE))


def split_lines(c: ColumnOrName) -> Column:
    """Split on every line break ``str.splitlines`` knows; runs of breaks
    collapse, which is harmless because blank lines are dropped later."""
    return F.split(F.coalesce(_col(c), F.lit("")), LINE_SPLIT)


def nonblank_lines(c: ColumnOrName) -> Column:
    """Lines stripped, blank ones dropped."""
    return F.filter(F.transform(split_lines(c), py_strip), lambda l: l != "")


def disclaimer_regex(patterns: Iterable[str] = fixed.DISCLAIMER_PATTERNS) -> str | None:
    pats = list(patterns)
    if not pats:
        return None
    return "(?iU)" + "|".join("(?:" + p + ")" for p in pats)


def keep_line(line: Column, disclaimers: Iterable[str] = fixed.DISCLAIMER_PATTERNS,
              min_chars: int = 2) -> Column:
    """FLT-02 + FLT-03 on an already stripped, non-blank line."""
    rx = disclaimer_regex(disclaimers)
    cond = F.length(line) >= min_chars
    if rx is not None:
        cond = cond & ~line.rlike(rx)
    return cond


def strip_tags(c: ColumnOrName) -> Column:
    """PRJ-05: delete ``<...>`` runs (used only to measure body length)."""
    return F.regexp_replace(_col(c), TAG, "")


# Named character references: the HTML 4 table of Python's standard library
# plus ``apos``.
NAMED_ENTITIES: dict[str, str] = {n: chr(cp) for n, cp in html.entities.name2codepoint.items()}
NAMED_ENTITIES["apos"] = "'"

# Tokens that cover a text exactly: numeric and named character references,
# runs without '&', and a lone '&'.
ENTITY_TOKENS = (r"&#[0-9]{1,7};|&#[xX][0-9a-fA-F]{1,6};|&[A-Za-z][A-Za-z0-9]{0,31};"
                 r"|[^&]+|&")

_ENTITY_MAP: Column | None = None


def _entity_map() -> Column:
    global _ENTITY_MAP
    if _ENTITY_MAP is None:
        pairs = []
        for name, ch in sorted(NAMED_ENTITIES.items()):
            pairs += [F.lit(name), F.lit(ch)]
        _ENTITY_MAP = F.create_map(*pairs)
    return _ENTITY_MAP


def _entity_char(tok: Column) -> Column:
    n = F.length(tok)
    dec = (F.when(tok.rlike(r"^&#[0-9]+;$"), F.substring(tok, F.lit(3), n - 3).cast("int"))
            .when(tok.rlike(r"^&#[xX][0-9a-fA-F]+;$"),
                  F.conv(F.substring(tok, F.lit(4), n - 4), 16, 10).cast("int")))
    valid = (dec >= 1) & (dec <= 0x10FFFF) & ~dec.between(0xD800, 0xDFFF)
    numeric = F.decode(F.unhex(F.lpad(F.hex(dec), 8, "0")), "UTF-32")
    named = F.try_element_at(_entity_map(), F.substring(tok, F.lit(2), n - 2))
    return (F.when(F.coalesce(valid, F.lit(False)), numeric)
             .when(tok.rlike(r"^&[A-Za-z]"), F.coalesce(named, tok))
             .otherwise(tok))


def decode_entities(c: ColumnOrName) -> Column:
    """Decode character references in one pass: numeric ones (``&#8217;``,
    ``&#x2019;``) for valid Unicode scalar values, named ones from the HTML 4
    table; anything else stays as written.  One pass means text decodes
    exactly once (``&amp;lt;`` -> ``&lt;``).  Texts without ``&`` are
    returned untouched."""
    col = _col(c)
    toks = F.regexp_extract_all(col, F.lit(ENTITY_TOKENS), 0)
    return F.when(F.instr(col, "&") > 0,
                  F.array_join(F.transform(toks, _entity_char), "")).otherwise(col)


def _element_regex(tags: Iterable[str]) -> str:
    """Whole elements (open tag .. first close tag) of the given names."""
    parts = [rf"<{t}\b[^>]*>.*?(?:</{t}\s*>|$)" for t in tags]
    return "(?is)" + "|".join(parts)


# Elements that never have content (and never a close tag).
VOID_TAGS = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
             "source", "track", "wbr"]


# The value of a tag's first ``class`` attribute, quoted or not; values of other
# attributes are stepped over whole.
CLASS_VALUE = (r"""(?is)^<[a-z][^\s/>]*(?:(?![\s/]+class\s*=)[\s/]+[^\s=>/]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?)*"""
               r"""[\s/]+class\s*=\s*("[^"]*"|'[^']*'|[^\s"'>/]+)""")


def remove_invisible(c: ColumnOrName) -> Column:
    """Comments, script and style: text a DOM ``get_text`` never returns."""
    out = F.regexp_replace(_col(c), COMMENT, "")
    return F.regexp_replace(out, _element_regex(["script", "style", "template"]), "")


# A page as tokens that cover it exactly: comments, script and style with their
# content, tags, text, and a '<' that starts none of these.
RAW_TAGS = ["script", "style"]
PAGE_TOKENS = (r"(?is)<!--.*?(?:-->|$)|<(script|style)\b(?:\"[^\"]*\"|'[^']*'|[^'\">]+)*+>.*?(?:</\1\s*>|$)"
               r"|<[a-z/!?](?:\"[^\"]*\"|'[^']*'|[^'\">]+)*+>|[^<]+|<")
# Elements that a start tag of the same name ends.
SIBLING_TAGS = ["dd", "dt", "li", "option", "p", "td", "th", "tr"]

_PAGE_STATE = ("struct<stack:array<string>,cut:int,start:int,cuts:array<struct<s:int,e:int>>,"
               "art:int,art_s:int,art_e:int>")


def _is_markup(token: Column) -> Column:
    return token.startswith("<") & (F.length(token) > 1)


def _tag_marks(tokens: Column, tags: Iterable[str], classes: Iterable[str]) -> Column:
    """The tags of a page as (place, name, kind, doomed); kind 1 opens, -1 closes, 0 does neither."""
    doomed_names, classes = sorted({*tags, *RAW_TAGS, "template"}), list(classes)
    def mark(tok: Column, i: Column) -> Column:
        name = F.lower(F.regexp_extract(tok, r"^</?([A-Za-z][^\s/>]*)", 1))
        kind = (F.when(tok.startswith("</"), -1)
                 .when(name.isin(*VOID_TAGS, *RAW_TAGS) | tok.endswith("/>"), 0).otherwise(1))
        doomed = name.isin(*doomed_names)
        if classes:
            given = F.split(F.trim(F.regexp_extract(tok, CLASS_VALUE, 1), F.lit("\"' \t\r\n\f")), r"\s+")
            doomed = doomed | (F.lower(tok).contains("class") & F.arrays_overlap(given, F.array(*map(F.lit, classes))))
        return F.when(_is_markup(tok) & (name != ""), F.struct(
            i.alias("i"), name.alias("name"), kind.alias("kind"), doomed.alias("doomed")))

    return F.filter(F.transform(tokens, mark), lambda m: m.isNotNull())


def _page_step(state: Column, m: Column) -> Column:
    """One tag of the walk: the open elements, the element being removed, the first article."""
    stack, i, opens = state["stack"], m["i"], m["kind"] == 1
    n = F.size(stack)
    sibling = m["name"].isin(*SIBLING_TAGS) & (F.try_element_at(stack, F.lit(-1)) == m["name"])
    closes = F.array_position(F.reverse(stack), m["name"]).cast("int")  # from the innermost, 0: not open
    depth = (F.when(opens, n - F.when(sibling, 1).otherwise(0))
              .when((m["kind"] == -1) & (closes > 0), n - closes).otherwise(n))
    # An element ends with its own end tag or with that of an element around it.
    last = F.when(opens, i - 1).otherwise(i)
    ends_cut, ends_art = (state["cut"] > depth), (state["art"] > depth)
    cut = F.when(ends_cut, 0).otherwise(state["cut"])
    enters = opens & (cut == 0) & m["doomed"]
    article = opens & (cut == 0) & ~m["doomed"] & (state["art"] == 0) & (m["name"] == "article")
    single = (m["kind"] == 0) & (cut == 0) & m["doomed"]
    cuts = F.when(ends_cut, F.concat(state["cuts"], F.array(F.struct(state["start"].alias("s"), last.alias("e"))))).otherwise(
        state["cuts"])
    base = F.when(depth == n, stack).otherwise(F.slice(stack, F.lit(1), depth))
    return F.struct(
        F.when(opens, F.concat(base, F.array(m["name"]))).otherwise(base).alias("stack"),
        F.when(enters, depth + 1).otherwise(cut).cast("int").alias("cut"),
        F.when(enters, i).otherwise(state["start"]).cast("int").alias("start"),
        F.when(single, F.concat(cuts, F.array(F.struct(i.alias("s"), i.alias("e"))))).otherwise(cuts).alias("cuts"),
        F.when(article, depth + 1).when(ends_art, -1).otherwise(state["art"]).cast("int").alias("art"),
        F.when(article, i).otherwise(state["art_s"]).cast("int").alias("art_s"),
        F.when(ends_art, last).otherwise(state["art_e"]).cast("int").alias("art_e")).cast(_PAGE_STATE)


def page_texts(c: ColumnOrName, tags: Iterable[str] = fixed.BOILERPLATE_TAGS,
               classes: Iterable[str] = fixed.BOILERPLATE_CLASSES) -> Column:
    """PRJ-06 as a struct (article_text, page_text): text nodes, one a line, of the
    first ``<article>`` (null where the page has none) and of the whole page, without
    script, style, template, the elements named in ``tags`` and those with one of
    ``classes``, each removed whole.

    One pass over the page's tags keeps the names of the open elements.  A removed
    element ends at its own end tag, however deeply elements of its name are nested in
    it, or where an element around it ends, or with the page; an end tag of an element
    that is not open means nothing; void elements (``img``, ``br``, ...) and tags ending
    in ``/>`` have no content; ``li``, ``p`` and the like end where a sibling starts.
    Null gives null."""
    col = _col(c)
    tokens = F.regexp_extract_all(col, F.lit(PAGE_TOKENS), 0)
    nothing = F.struct(F.array().cast("array<string>").alias("stack"), F.lit(0).alias("cut"), F.lit(0).alias("start"),
                       F.array().cast("array<struct<s:int,e:int>>").alias("cuts"), F.lit(0).alias("art"),
                       F.lit(-1).alias("art_s"), F.lit(-1).alias("art_e")).cast(_PAGE_STATE)

    def texts(x: Column) -> Column:
        toks, state = x["tokens"], x["state"]
        n = F.size(toks)
        cuts = F.when(state["cut"] > 0, F.concat(state["cuts"], F.array(F.struct(
            state["start"].alias("s"), (n - 1).alias("e"))))).otherwise(state["cuts"])
        # Stretches that stay, between the cuts: from s up to, not including, e.
        stays = F.arrays_zip(F.concat(F.array(F.lit(0)), F.transform(cuts, lambda k: k["e"] + 1)).alias("s"),
                             F.concat(F.transform(cuts, lambda k: k["s"]), F.array(n)).alias("e"))

        def text(lo: Column, hi: Column) -> Column:
            inside = F.filter(F.transform(stays, lambda r: F.struct(
                F.greatest(r["s"], lo).alias("s"), F.least(r["e"], hi).alias("e"))), lambda r: r["s"] < r["e"])
            said = F.transform(inside, lambda r: F.array_join(F.transform(
                F.slice(toks, r["s"] + 1, r["e"] - r["s"]),
                lambda t: F.when(_is_markup(t), F.lit("\n")).otherwise(t)), ""))
            return F.array_join(nonblank_lines(decode_entities(F.array_join(said, "\n"))), "\n")

        art_end = F.when(state["art"] > 0, n).otherwise(state["art_e"])
        return F.struct(F.when(state["art_s"] >= 0, text(state["art_s"] + 1, art_end)).alias("article_text"),
                        text(F.lit(0), n).alias("page_text"))

    def walked(toks: Column) -> Column:
        return F.struct(toks.alias("tokens"), F.aggregate(_tag_marks(toks, tags, classes), nothing, _page_step).alias("state"))

    bound = F.transform(F.transform(F.array(tokens), walked), texts)
    return F.when(col.isNotNull(), F.element_at(bound, 1))


def markup_lines(c: ColumnOrName) -> Column:
    """Text nodes of an HTML fragment as stripped, non-blank lines: every tag
    (start, end, comment, doctype) becomes a line break, entities are decoded
    once."""
    text = decode_entities(F.regexp_replace(_col(c), ANY_TAG, "\n"))
    return nonblank_lines(text)


def markup_text(c: ColumnOrName) -> Column:
    """``get_text("\\n", strip=True)`` of an HTML fragment."""
    return F.array_join(markup_lines(c), "\n")


@by_column_name
def text_lines(c: ColumnOrName, markup: bool = True) -> Column:
    """Stripped, non-blank lines of a text that may hold markup: comments,
    script and style dropped, each tag a line break, entities decoded."""
    col = _col(c)
    if not markup:
        return nonblank_lines(col)
    # Text with neither '<' nor '&' has no tags or entities: skip the markup
    # passes (CASE evaluates only the branch it takes).
    has_markup = (F.instr(col, "<") > 0) | (F.instr(col, "&") > 0)
    return F.when(has_markup, markup_lines(remove_invisible(col))).otherwise(nonblank_lines(col))


@by_column_name
def clean_lines(c: ColumnOrName,
                disclaimers: Iterable[str] = fixed.DISCLAIMER_PATTERNS,
                min_chars: int = 2,
                markup: bool = True) -> Column:
    """PRJ-08 as an array: text nodes -> lines stripped -> blank, disclaimer
    and too-short lines dropped.  ``markup=False`` skips tag/entity handling
    for inputs known to be plain text."""
    lines = text_lines(c, markup)
    disclaimers = list(disclaimers)
    return F.filter(lines, lambda l: keep_line(l, disclaimers, min_chars))


def clean_text(c: ColumnOrName,
               disclaimers: Iterable[str] = fixed.DISCLAIMER_PATTERNS,
               min_chars: int = 2,
               markup: bool = True) -> Column:
    """PRJ-08 / AGG-05: kept lines joined by newline."""
    return F.array_join(clean_lines(c, disclaimers, min_chars, markup), "\n")
