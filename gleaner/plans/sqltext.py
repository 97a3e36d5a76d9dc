"""DuckDB (RE2) spellings of the text rules, used only to build oracle SQL.

RE2 has no look-around, no back-references and an ASCII ``\\b``.  Word
boundaries are therefore written out with an explicit Unicode word class
that mirrors Java's ``(?U)\\w`` (letters, marks, decimal and letter numbers,
connector punctuation, joiners), and boundary tests consume the neighbouring
character, which is harmless for a yes/no search.
"""

from __future__ import annotations

from gleaner.functions import fixed
from gleaner.functions.fixed import char_class

W = r"[\pL\p{Nl}\pM\p{Nd}\p{Pc}\x{200C}\x{200D}]"
NW = r"[^\pL\p{Nl}\pM\p{Nd}\p{Pc}\x{200C}\x{200D}]"
PRE = f"(?:^|{NW})"
POST = f"(?:{NW}|$)"
D = r"\p{Nd}"
SP = r"[\t-\r\x{85}\pZ]"

# The four statistic patterns, RE2 form (see the module docstring).  In the
# odds pattern the signed branches need a word character before the sign,
# so they are covered by the unsigned branch.
STAT_RE2 = {
    "record": f"{PRE}{D}{{1,3}}-{D}{{1,3}}{POST}",
    "percentage": f"{PRE}{D}{{1,3}}\\.{D}+%{W}",
    "odds": f"(?i){PRE}(?:{D}{{3,4}}|pk){POST}",
    "total": f"(?i){PRE}(?:over|under){SP}*{D}{{1,3}}(?:\\.{D})?{POST}",
}

LINE_SPLIT = char_class(fixed.PY_LINE_BREAKS) + "+"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


WS = q(fixed.PY_WHITESPACE)


def disclaimer_re2(patterns=fixed.DISCLAIMER_PATTERNS) -> str | None:
    pats = list(patterns)
    return "(?i)" + "|".join("(?:" + p + ")" for p in pats) if pats else None


def stat_any(x: str) -> str:
    return "(" + " OR ".join(f"regexp_matches({x}, {q(p)})" for p in STAT_RE2.values()) + ")"


def angle_any(x: str, hints=fixed.ANGLE_HINTS) -> str:
    return "(" + " OR ".join(f"contains(lower({x}), {q(h)})" for h in hints) + ")"


def decode_entities(x: str) -> str:
    from gleaner.functions.text import ENTITY_TOKENS, NAMED_ENTITIES
    dec = ("CASE WHEN regexp_matches(t, '^&#[0-9]+;$') THEN TRY_CAST(substr(t, 3, length(t) - 3) AS INTEGER) "
           "WHEN regexp_matches(t, '^&#[xX][0-9a-fA-F]+;$') "
           "THEN TRY_CAST('0x' || substr(t, 4, length(t) - 4) AS INTEGER) END")
    valid = f"coalesce(({dec}) BETWEEN 1 AND 1114111 AND NOT (({dec}) BETWEEN 55296 AND 57343), false)"
    m = "MAP {" + ", ".join(f"{q(k)}: {q(v)}" for k, v in sorted(NAMED_ENTITIES.items())) + "}"
    named = f"map_extract({m}, substr(t, 2, length(t) - 2))[1]"
    return (f"CASE WHEN contains({x}, '&') THEN array_to_string(list_transform("
            f"regexp_extract_all({x}, {q(ENTITY_TOKENS)}, 0), lambda t: "
            f"CASE WHEN {valid} THEN chr({dec}) "
            f"WHEN regexp_matches(t, '^&[A-Za-z]') THEN coalesce({named}, t) ELSE t END), '') "
            f"ELSE {x} END")


def nonblank_lines(x: str) -> str:
    return (f"list_filter(list_transform(regexp_split_to_array(coalesce({x}, ''), {q(LINE_SPLIT)}), "
            f"lambda s: trim(s, {WS})), lambda s: s <> '')")


def remove_invisible(x: str) -> str:
    out = f"regexp_replace({x}, {q(r'(?s)<!--.*?(?:-->|$)')}, '', 'g')"
    el = "(?is)" + "|".join(rf"<{t}\b[^>]*>.*?(?:</{t}\s*>|$)" for t in ["script", "style", "template"])
    return f"regexp_replace({out}, {q(el)}, '', 'g')"


def page_bodies(source: str, tags=fixed.BOILERPLATE_TAGS, classes=fixed.BOILERPLATE_CLASSES) -> str:
    """CTEs ending in ``pb(page_id, article_text, page_text)`` over ``source``, a query of
    (page_id, html).  Every token is a row; an element ends where the running count of its
    own name is back to what it was before (windows, no regex over elements)."""
    token = (r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<[a-z/!?][^>]*>|[^<]+|<")
    void = ", ".join(q(t) for t in ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
                                    "track", "wbr", "script", "style"])
    named = ", ".join(q(t) for t in [*tags, "template"])
    marked = ", ".join(q(c) for c in classes)
    return f"""
    pg_tok AS (SELECT page_id, unnest(ts) AS t, generate_subscripts(ts, 1) AS i, len(ts) AS n
            FROM (SELECT page_id, regexp_extract_all(html, {q(token)}) AS ts FROM ({source}))),
    pg_tag AS (SELECT page_id, i, n, t, lower(regexp_extract(t, '^</?([A-Za-z][^\\s/>]*)', 1)) AS name,
                   starts_with(t, '</') AS closes FROM pg_tok WHERE starts_with(t, '<') AND length(t) > 1),
    pg_lev AS (SELECT *, sum(CASE WHEN closes THEN -1 ELSE 1 END) OVER (PARTITION BY page_id, name ORDER BY i) AS d
            FROM pg_tag WHERE name <> '' AND name NOT IN ({void})),
    pg_ends AS (SELECT o.page_id, o.i, o.name, o.t, coalesce(min(c.i), any_value(o.n)) AS e
             FROM pg_lev o LEFT JOIN pg_lev c ON c.page_id = o.page_id AND c.name = o.name AND c.i > o.i AND c.closes AND c.d = o.d - 1
             WHERE NOT o.closes GROUP BY o.page_id, o.i, o.name, o.t),
    pg_cut AS (SELECT page_id, i AS s, e FROM pg_ends WHERE name IN ({named})
            OR list_has_any(string_split(regexp_extract(t, '\\sclass\\s*=\\s*["'']([^"'']*)["'']', 1), ' '), [{marked}])),
    pg_gone AS (SELECT DISTINCT pg_tok.page_id, pg_tok.i FROM pg_tok JOIN pg_cut ON pg_cut.page_id = pg_tok.page_id AND pg_tok.i BETWEEN s AND e),
    pg_art AS (SELECT page_id, min(i) AS s, arg_min(e, i) AS e FROM pg_ends WHERE name = 'article'
            AND (page_id, i) NOT IN (SELECT (page_id, i) FROM pg_gone) GROUP BY page_id),
    pg_said AS (SELECT pg_tok.page_id, pg_tok.i, CASE WHEN pg_gone.i IS NOT NULL OR starts_with(t, '<') AND length(t) > 1 THEN chr(10) ELSE t END AS t,
                    pg_art.s IS NOT NULL AS has, coalesce(pg_tok.i > pg_art.s AND pg_tok.i < pg_art.e, false) AS inside
             FROM pg_tok LEFT JOIN pg_gone ON pg_gone.page_id = pg_tok.page_id AND pg_gone.i = pg_tok.i LEFT JOIN pg_art ON pg_art.page_id = pg_tok.page_id),
    pg_raw AS (SELECT page_id, any_value(has) AS has, coalesce(string_agg(t, '' ORDER BY i) FILTER (inside), '') AS a,
                   string_agg(t, '' ORDER BY i) AS p FROM pg_said GROUP BY page_id),
    pb AS (SELECT page_id, CASE WHEN has THEN {lines_text('a')} END AS article_text, {lines_text('p')} AS page_text FROM pg_raw)"""


def lines_text(x: str) -> str:
    """Stripped, non-blank lines of a text whose markup is gone, entities decoded."""
    return f"array_to_string({nonblank_lines(decode_entities(x))}, chr(10))"


def markup_lines(x: str) -> str:
    from gleaner.functions.text import ANY_TAG
    return nonblank_lines(decode_entities(f"regexp_replace({x}, {q(ANY_TAG)}, chr(10), 'g')"))


def markup_text(x: str) -> str:
    return f"array_to_string({markup_lines(x)}, chr(10))"


def clean_lines(x: str, disclaimers=fixed.DISCLAIMER_PATTERNS, min_chars: int = 2) -> str:
    lines = markup_lines(remove_invisible(x))
    rx = disclaimer_re2(disclaimers)
    cond = f"length(s) >= {min_chars}"
    if rx:
        cond += f" AND NOT regexp_matches(s, {q(rx)})"
    return f"list_filter({lines}, lambda s: {cond})"


def key_point_rows(source_sql: str, cap: int) -> str:
    """SQL yielding (doc_id, i, l, s, a, n, stop_i) rows for the capped walk,
    written with window sums over exploded lines (independent of the
    engine's higher-order form).  ``source_sql`` yields (doc_id, arr)."""
    return f"""
    lines AS (
      SELECT doc_id, unnest(arr) AS l, generate_subscripts(arr, 1) AS i FROM ({source_sql})
    ),
    flags AS (
      SELECT doc_id, i, l, {stat_any('l')} AS s, {angle_any('l')} AS a FROM lines
    ),
    runs AS (
      SELECT *, sum(CASE WHEN s OR a THEN 1 ELSE 0 END)
                  OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS n
      FROM flags
    ),
    stops AS (
      SELECT doc_id, min(i) AS stop_i FROM runs WHERE NOT s AND n >= {cap} GROUP BY doc_id
    ),
    points AS (
      SELECT r.doc_id, r.i, r.l FROM runs r LEFT JOIN stops USING (doc_id)
      WHERE (r.s OR r.a) AND (stop_i IS NULL OR r.i <= stop_i)
    )"""
