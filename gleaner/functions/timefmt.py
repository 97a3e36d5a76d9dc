"""Timestamp parsing and ISO text (PRJ-03, PRJ-13, AGG-03 parsing).

All expressions assume the session time zone is UTC (``session.use_utc``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_micros(c: ColumnOrName) -> Column:
    """Microseconds since the epoch of a TIMESTAMP or TIMESTAMP_NTZ (taken as
    UTC)."""
    return F.unix_micros(_col(c).cast("timestamp"))


def iso_text(c: ColumnOrName, suffix: str = "Z") -> Column:
    """PRJ-13: ISO 8601 text of a UTC instant, ``.ffffff`` only when the
    microseconds are not zero (as Python's ``isoformat``), then ``suffix``
    (``Z``, ``+00:00`` or empty for a naive value)."""
    ts = _col(c).cast("timestamp")
    us = F.unix_micros(ts)
    frac = F.pmod(us, F.lit(1000000))
    return F.concat(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(frac != 0, F.concat(F.lit("."), F.lpad(frac.cast("string"), 6, "0"))).otherwise(F.lit("")),
        F.lit(suffix))


def parse_iso(c: ColumnOrName) -> Column:
    """ISO 8601 text -> TIMESTAMP; text without an offset means UTC; text
    that is not a date-time gives null (no error)."""
    return _col(c).try_cast("timestamp")


# RSS dates: RFC 822 with or without weekday, numeric or named zone, then ISO.
RSS_FORMATS = [
    "d MMM yyyy HH:mm:ss Z",
    "d MMM yyyy HH:mm:ss z",
    "d MMM yyyy HH:mm Z",
    "d MMM yyyy HH:mm z",
]


def parse_feed_date(c: ColumnOrName) -> Column:
    """PRJ-03: a lenient date ladder.  The weekday prefix is removed first
    (Spark refuses ``EEE`` patterns), then RFC 822 shapes are tried, then an
    ISO cast; anything else is null."""
    col = _col(c)
    s = F.regexp_replace(F.trim(col), r"^[A-Za-z]{3,9},\s*", "")
    s = F.regexp_replace(s, r"\s+", " ")
    tries = [F.try_to_timestamp(s, F.lit(fmt)) for fmt in RSS_FORMATS]
    tries.append(s.try_cast("timestamp"))
    return F.when(F.trim(col) == "", F.lit(None).cast("timestamp")).otherwise(F.coalesce(*tries))
