"""Line-level signals and capped key points (FLT-04, FLT-05, FLT-06, WIN-01,
PRJ-16).

The key-point walk is written as higher-order array functions evaluated per
row: the lines of one article never leave their row, so extracting points
from billions of articles needs no shuffle at all.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions import fixed
from gleaner.functions.fixed import to_java
from gleaner.functions.memo import by_column_name


def stat_regexes(patterns: Mapping[str, str] = fixed.STAT_PATTERNS,
                 ignorecase: Mapping[str, bool] = fixed.STAT_IGNORECASE) -> dict[str, str]:
    """Java form of each named statistic pattern."""
    return {name: to_java(p, ignorecase.get(name, False)) for name, p in patterns.items()}


def stat_regex(patterns: Mapping[str, str] = fixed.STAT_PATTERNS,
               ignorecase: Mapping[str, bool] = fixed.STAT_IGNORECASE) -> str:
    """One alternation matching when any statistic pattern matches."""
    parts = []
    for name, p in patterns.items():
        parts.append(("(?i:" if ignorecase.get(name, False) else "(?:") + p + ")")
    return "(?U)" + "|".join(parts)


# A necessary condition of the default statistic patterns: every one of them
# needs a decimal digit, except the "PK" branch.  Lines failing this cheap
# single-class scan (most prose lines) skip the four-way alternation.
DEFAULT_STAT_PREFILTER = r"(?U)\d|(?i:pk)"
_DIGIT = r"(?U)\d"
DEFAULT_PATTERN_PREFILTERS = {"record": _DIGIT, "percentage": _DIGIT,
                              "odds": DEFAULT_STAT_PREFILTER, "total": _DIGIT}


def _stat_test(line: Column, patterns: Mapping[str, str],
               ignorecase: Mapping[str, bool]) -> Column:
    full = line.rlike(stat_regex(patterns, ignorecase))
    if patterns is fixed.STAT_PATTERNS and ignorecase is fixed.STAT_IGNORECASE:
        return line.rlike(DEFAULT_STAT_PREFILTER) & full
    return full


def _contains_any(lowered: Column, hints: list[str]) -> Column:
    """Plain substring tests (byte search, no regex) on a lower-cased line."""
    out = F.lit(False)
    for h in hints:
        out = out | F.contains(lowered, F.lit(h))
    return out


def stat_flags(line: Column, patterns: Mapping[str, str] = fixed.STAT_PATTERNS,
               ignorecase: Mapping[str, bool] = fixed.STAT_IGNORECASE) -> dict[str, Column]:
    """FLT-04 per pattern, as named boolean columns (for reporting)."""
    rxs = stat_regexes(patterns, ignorecase)
    if patterns is fixed.STAT_PATTERNS and ignorecase is fixed.STAT_IGNORECASE:
        return {name: line.rlike(DEFAULT_PATTERN_PREFILTERS[name]) & line.rlike(rx)
                for name, rx in rxs.items()}
    return {name: line.rlike(rx) for name, rx in rxs.items()}


def is_stat(line: Column, patterns: Mapping[str, str] = fixed.STAT_PATTERNS,
            ignorecase: Mapping[str, bool] = fixed.STAT_IGNORECASE) -> Column:
    return _stat_test(line, patterns, ignorecase)


def is_angle(line: Column, hints: Iterable[str] = fixed.ANGLE_HINTS) -> Column:
    """FLT-05: lower-cased line contains any hint."""
    hints = list(hints)
    if not hints:
        return F.lit(False)
    return _contains_any(F.lower(line), hints)


@by_column_name
def key_points(lines: Column | str,
               cap: int | None = None,
               patterns: Mapping[str, str] = fixed.STAT_PATTERNS,
               ignorecase: Mapping[str, bool] = fixed.STAT_IGNORECASE,
               hints: Iterable[str] = fixed.ANGLE_HINTS,
               strict_cap: bool = False) -> Column:
    """WIN-01: capped key points of an ordered array of clean lines.

    Walk semantics: a statistic line is always added and never checks the
    cap; an angle line is added, then (like a plain line) stops the walk when
    the count has reached ``cap``.  Set-based form: with ``n_i`` the running
    hit count, the walk stops at the first non-statistic line with
    ``n_i >= cap``; hits up to and including that line are kept.
    ``strict_cap=True`` lets statistic lines stop the walk as well.  Without a
    cap every hit is a point.
    """
    hints = list(hints)
    if isinstance(lines, str):
        lines = F.col(lines)

    def flag(x: Column) -> Column:
        s = _stat_test(x["l"], patterns, ignorecase)
        a = _contains_any(x["lo"], hints) if hints else F.lit(False)
        return F.struct(x["l"].alias("l"), s.alias("s"), (s | a).alias("h"))

    # Lower-case each line once, then flag it (lambda bodies get no common
    # subexpression elimination, so shared values are materialized first).
    lowered = F.transform(lines, lambda l: F.struct(l.alias("l"), F.lower(l).alias("lo")))
    flags = F.transform(lowered, flag)
    if cap is None:
        return F.transform(F.filter(flags, lambda f: f["h"]), lambda f: f["l"])
    init = F.struct(F.lit(0).alias("n"), F.lit(-1).alias("stop"), F.lit(0).alias("i"))

    def step(acc: Column, f: Column) -> Column:
        n2 = acc["n"] + F.when(f["h"], 1).otherwise(0)
        stops = n2 >= cap if strict_cap else (~f["s"]) & (n2 >= cap)
        return F.when(acc["stop"] >= 0, acc).otherwise(
            F.struct(n2.alias("n"),
                     F.when(stops, acc["i"]).otherwise(F.lit(-1)).alias("stop"),
                     (acc["i"] + 1).alias("i")))

    def pick(fl: Column) -> Column:
        stop = F.aggregate(fl, init, step, lambda acc: acc["stop"])
        # Bind ``stop`` once per row (a one-element transform acts as "let"),
        # so the filter below does not re-run the walk for every element.
        kept = F.transform(F.array(stop), lambda st: F.transform(
            F.filter(fl, lambda f, i: f["h"] & ((st < 0) | (i <= st))), lambda f: f["l"]))
        return F.element_at(kept, 1)

    # Same trick for the flags, so each line's regexes run once.
    return F.element_at(F.transform(F.array(flags), pick), 1)


def allow_thread(points: Column, clean: Column,
                 enabled: bool = True,
                 min_points: int = fixed.MIN_INSIGHTS_FOR_THREAD,
                 min_chars: int = fixed.MIN_CHARS_FOR_THREAD) -> Column:
    """PRJ-16: thread eligibility."""
    if not enabled:
        return F.lit(False)
    return (F.size(points) >= min_points) & (F.length(clean) >= min_chars)
