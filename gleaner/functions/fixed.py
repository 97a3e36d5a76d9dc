"""Fixed values that must equal the behaviour being reproduced.

Everything in this module is a literal: pattern lists, keyword lists, key
spellings, error texts and numeric defaults.  Operators take these as
default arguments; callers may pass their own lists instead.

The regular expressions are written in the Python ``re`` dialect they were
specified in.  ``to_java`` adds the inline flags that make Java's regex
engine (used by Spark's ``rlike`` / ``regexp_*``) treat ``\\b``, ``\\d``,
``\\w`` and ``\\s`` as Unicode classes, as Python does for ``str`` patterns.
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# FIXED VALUES (do not edit: results depend on them)
# --------------------------------------------------------------------------

# Disclaimer lines dropped from article text; searched case-insensitively.
DISCLAIMER_PATTERNS = [
    r"This site contains commercial content",
    r"Odds are subject to change",
    r"Gambling problem\?",
]

# Statistic-line patterns, in order: record, percentage, odds, total.
# The last two are searched case-insensitively.
STAT_PATTERNS = {
    "record": r"\b\d{1,3}-\d{1,3}\b",
    "percentage": r"\b\d{1,3}\.\d+%\b",
    "odds": r"\b(?:-?\d{3,4}|\+\d{3,4}|PK)\b",
    "total": r"\b(?:Over|Under)\s*\d{1,3}(?:\.\d)?\b",
}
STAT_IGNORECASE = {"record": False, "percentage": False, "odds": True, "total": True}

# Substrings of the lower-cased line that mark an analytical angle.
ANGLE_HINTS = [
    "trend",
    "record",
    "against the spread",
    "ats",
    "line move",
    "closing line",
    "edge",
    "value",
    "implied probability",
    "market",
]

# Promotional wording searched in the lower-cased post text.
PROMO_PATTERNS = [
    r"\bcheck out\b",
    r"\bread\b",
    r"\bwatch\b",
    r"\bfollow\b",
    r"\bsubscribe\b",
    r"\bvisit\b",
    r"\bpreviews?\b",
    r"\bpromo\b",
    r"\bexclusive\b",
]

# JSON keys whose string values are taken as scheduled publish times.
SCHEDULE_KEYS = [
    "publish_at",
    "publishAt",
    "scheduled_at",
    "scheduledAt",
    "scheduled_date",
    "scheduledDate",
    "schedule-date",
    "scheduleDate",
]

# Validation error texts, first failing check wins.
ERR_BAD_MODE = "delivery_mode must be either 'single' or 'thread'"
ERR_SINGLE_MISSING = "Missing single_tweet in single mode"
ERR_SINGLE_TOO_LONG = "single_tweet exceeds {max} characters"
ERR_SINGLE_HAS_THREAD = "thread must be empty in single mode"
ERR_THREAD_DISABLED = "Thread returned while thread generation is disabled"
ERR_THREAD_HAS_SINGLE = "single_tweet must be empty in thread mode"
ERR_THREAD_SIZE = "Thread must have exactly 3 tweets"
ERR_THREAD_ITEM_TOO_LONG = "thread tweet {idx} exceeds {max} characters"

DELIVERY_MODES = ["single", "thread"]
PUBLISH_MODES = ["draft", "schedule", "publish_now"]

READ_MORE_PREFIX = "Read more: "
# A run id: this prefix, the UTC time in this format, "_", this many hex digits.
RUN_ID_PREFIX = "run_"
RUN_ID_TIME_FORMAT = "%Y%m%dT%H%M%SZ"
RUN_ID_HEX_DIGITS = 8
UNKNOWN = "Unknown"
NO_POINTS_LINE = "- none extracted"
POINT_BULLET = "- "

# Tags and class removed before page text is taken.
BOILERPLATE_TAGS = ["script", "style", "nav", "header", "footer", "aside"]
BOILERPLATE_CLASSES = ["menu", "ad"]

# Numeric defaults.
MAX_ARTICLES_PER_RUN = 10
MAX_KEY_POINTS = 12
MIN_BODY_CHARS = 500
MAX_POST_CHARS = 280
THREAD_SIZE = 3
MIN_INSIGHTS_FOR_THREAD = 18
MIN_CHARS_FOR_THREAD = 7000
PROMPT_TEXT_CHARS = 14000
PROMPT_POINTS_GENERATE = 12
PROMPT_POINTS_FACT_CHECK = 20
MAX_QUEUE_PAGES = 10
PUBLISH_SPACING_MINUTES = 30

# Characters Python's str.strip() removes, and the ones str.splitlines()
# breaks on.
PY_WHITESPACE = (
    "\x09\x0a\x0b\x0c\x0d\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
PY_LINE_BREAKS = "\x0a\x0b\x0c\x0d\x1c\x1d\x1e\x85\u2028\u2029"

# --------------------------------------------------------------------------


def to_java(pattern: str, ignorecase: bool = False) -> str:
    """Python ``re`` pattern -> Java pattern with Unicode character classes."""
    return ("(?iU)" if ignorecase else "(?U)") + pattern


def char_class(chars: str) -> str:
    """Regex character class (Java and RE2 syntax) for a set of characters."""
    return "[" + "".join(r"\x{%X}" % ord(c) for c in chars) + "]"
