"""Post packages: normalisation, validation and promotional-wording flags
(SRC-05 shaping, FLT-07, FLT-08).

Two shapes are supported:

* array form -- one row per package with ``delivery_mode``, ``single_tweet``
  and ``thread`` (``array<string>``), as parsed from model responses;
  validation is one row-local ``CASE``.
* long form -- packages in one table and their thread items as rows in
  another.  Validation then uses partial aggregates per package and never
  gathers a package's items into one array, whatever their number.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions import fixed
from gleaner.functions.text import py_strip
from gleaner.operators.common import materialize

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_package(mode: ColumnOrName, single: ColumnOrName, thread: ColumnOrName) -> Column:
    """Mode stripped and lower-cased, single stripped, thread items stripped
    with blank items dropped; missing values become empty."""
    th = F.coalesce(_col(thread), F.array().cast("array<string>"))
    return F.struct(
        F.lower(py_strip(F.coalesce(_col(mode), F.lit("")))).alias("delivery_mode"),
        py_strip(F.coalesce(_col(single), F.lit(""))).alias("single_tweet"),
        F.filter(F.transform(th, lambda x: py_strip(F.coalesce(x, F.lit("")))),
                 lambda x: x != "").alias("thread"))


def _too_long_msg(max_chars: int) -> str:
    return fixed.ERR_SINGLE_TOO_LONG.format(max=max_chars)


def _item_msg(idx: Column, max_chars: int) -> Column:
    head, tail = fixed.ERR_THREAD_ITEM_TOO_LONG.split("{idx}")
    return F.concat(F.lit(head), idx.cast("string"), F.lit(tail.format(max=max_chars)))


def _error(mode: Column, single_len: Column, n_items: Column, first_long: Column,
           allow_thread: Column | bool, max_chars: int, thread_size: int) -> Column:
    allow = F.lit(allow_thread) if isinstance(allow_thread, bool) else allow_thread
    return (F.when(~mode.isin(*fixed.DELIVERY_MODES), F.lit(fixed.ERR_BAD_MODE))
             .when((mode == "single") & (single_len == 0), F.lit(fixed.ERR_SINGLE_MISSING))
             .when((mode == "single") & (single_len > max_chars), F.lit(_too_long_msg(max_chars)))
             .when((mode == "single") & (n_items > 0), F.lit(fixed.ERR_SINGLE_HAS_THREAD))
             .when(mode == "single", F.lit(None).cast("string"))
             .when(~allow, F.lit(fixed.ERR_THREAD_DISABLED))
             .when(single_len > 0, F.lit(fixed.ERR_THREAD_HAS_SINGLE))
             .when(n_items != thread_size, F.lit(fixed.ERR_THREAD_SIZE))
             .when(first_long > 0, _item_msg(first_long, max_chars)))


def package_error(mode: ColumnOrName, single: ColumnOrName, thread: ColumnOrName,
                  allow_thread: Column | bool = True,
                  max_chars: int = fixed.MAX_POST_CHARS,
                  thread_size: int = fixed.THREAD_SIZE) -> Column:
    """FLT-07 on a normalized package: the first failing check's message,
    null when the package is valid."""
    th = _col(thread)
    first_long = F.array_position(F.transform(th, lambda t: F.length(t) > max_chars), True)
    return _error(_col(mode), F.length(_col(single)), F.size(th), first_long,
                  allow_thread, max_chars, thread_size)


def validate_packages(df: DataFrame, mode: str = "delivery_mode", single: str = "single_tweet",
                      thread: str = "thread", allow_thread: Column | bool = True,
                      max_chars: int = fixed.MAX_POST_CHARS,
                      thread_size: int = fixed.THREAD_SIZE, out: str = "error") -> DataFrame:
    """Normalize the three package columns in place and add ``out``."""
    df = df.withColumn("_pkg", normalize_package(mode, single, thread))
    df = (df.withColumn(mode, F.col("_pkg.delivery_mode"))
            .withColumn(single, F.col("_pkg.single_tweet"))
            .withColumn(thread, F.col("_pkg.thread")).drop("_pkg"))
    return df.withColumn(out, package_error(mode, single, thread, allow_thread,
                                            max_chars, thread_size))


def item_stats(items: DataFrame, key: str, pos: str, length: str,
               max_chars: int = fixed.MAX_POST_CHARS) -> DataFrame:
    """Per package: number of non-blank items and the 1-based index (among
    non-blank items) of the first item over ``max_chars`` (0 when none), from
    the items' stripped lengths.

    Two partial aggregates and one key join; a package with millions of items is
    still reduced map-side.  ``items`` is read twice: pass a written table."""
    it = items.where(F.col(length) > 0)
    first = (it.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_items"),
        F.min(F.when(F.col(length) > max_chars, F.col(pos))).alias("_first_pos")))
    before = (it.join(first.where(F.col("_first_pos").isNotNull()).select(key, "_first_pos"), key)
                .groupBy(key).agg(F.count_if(F.col(pos) < F.col("_first_pos")).alias("_before")))
    return (first.join(before, key, "left")
                 .select(key, "n_items",
                         F.when(F.col("_first_pos").isNull(), F.lit(0))
                          .otherwise(F.col("_before") + 1).alias("first_long")))


def validate_lengths(packages: DataFrame, items: DataFrame, key: str, pos: str, length: str,
                     mode: str = "delivery_mode", single_len: str = "single_len",
                     allow_thread: Column | bool = True, max_chars: int = fixed.MAX_POST_CHARS,
                     thread_size: int = fixed.THREAD_SIZE, out: str = "error") -> DataFrame:
    """FLT-07 where only lengths are known: ``packages`` has one row per key with
    its normalized mode and the length of its single text, ``items`` one row per
    thread item with its stripped length.  Adds ``n_items`` and ``out``."""
    stats = item_stats(items, key, pos, length, max_chars)
    p = (packages.join(stats, key, "left")
                 .withColumn("n_items", F.coalesce(F.col("n_items"), F.lit(0)).cast("bigint"))
                 .withColumn("first_long", F.coalesce(F.col("first_long"), F.lit(0))))
    err = _error(F.col(mode), F.col(single_len), F.col("n_items"), F.col("first_long"),
                 allow_thread, max_chars, thread_size)
    return p.withColumn(out, err).drop("first_long")


def validate_long(packages: DataFrame, items: DataFrame, key: str, pos: str, text: str,
                  mode: str = "delivery_mode", single: str = "single_tweet",
                  allow_thread: Column | bool = True,
                  max_chars: int = fixed.MAX_POST_CHARS,
                  thread_size: int = fixed.THREAD_SIZE, out: str = "error") -> DataFrame:
    """FLT-07 for long-form packages: ``packages`` has one row per key with
    mode and single text, ``items`` one row per thread item.  Item texts are
    read once; only (key, position, length) is written and aggregated."""
    n = F.length(py_strip(F.coalesce(F.col(text), F.lit(""))))
    thin = materialize(items.select(key, pos, n.alias("_len")), "items")
    p = (packages.withColumn(mode, F.lower(py_strip(F.coalesce(F.col(mode), F.lit("")))))
                 .withColumn(single, py_strip(F.coalesce(F.col(single), F.lit(""))))
                 .withColumn("_single", F.length(single)))
    return validate_lengths(p, thin, key, pos, "_len", mode, "_single", allow_thread, max_chars,
                            thread_size, out).drop("_single")


def promo_regex(patterns: Iterable[str] = fixed.PROMO_PATTERNS) -> str | None:
    pats = list(patterns)
    if not pats:
        return None
    return "(?U)" + "|".join("(?:" + p + ")" for p in pats)


def promo_flag(single: ColumnOrName, thread: ColumnOrName | None = None,
               patterns: Iterable[str] = fixed.PROMO_PATTERNS) -> Column:
    """FLT-08: promotional wording in ``single + ' ' + thread items``,
    lower-cased, searched with word-bounded patterns."""
    rx = promo_regex(patterns)
    if rx is None:
        return F.lit(False)
    parts = [F.coalesce(_col(single), F.lit(""))]
    if thread is not None:
        parts.append(F.coalesce(_col(thread), F.array().cast("array<string>")))
    return F.lower(F.concat_ws(" ", *parts)).rlike(rx)
