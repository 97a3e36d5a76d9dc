"""Ledger dedup and author screening (SRC-03, JOIN-01, FLT-01, JOIN-04)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.fixed import PY_WHITESPACE, char_class
from gleaner.functions.text import py_strip

ColumnOrName = Column | str

_WS_RUN = char_class(PY_WHITESPACE) + "+"


def ledger_anti_join(feed: DataFrame, ledger: DataFrame, key: str = "article_id",
                     prefilter: bool = False) -> DataFrame:
    """JOIN-01: entries whose key is not in the ledger yet.

    Only the key column of the ledger is read (parquet column pruning).
    AQE picks the strategy with measured sizes: a small batch against a big
    ledger becomes a broadcast of whichever side fits, otherwise a
    sort-merge anti join, whose skewed partitions AQE splits.
    ``prefilter=True`` first reduces the ledger to keys of this batch with a
    semi join (useful when the ledger is orders of magnitude larger and the
    runtime bloom filter is off)."""
    keys = ledger.select(key)
    if prefilter:
        keys = keys.join(feed.select(key), key, "left_semi")
    return feed.join(keys, key, "left_anti")


def normalize_author(c: ColumnOrName) -> Column:
    """Author or excluded name with white-space runs collapsed, stripped and
    case-folded (lower case, the sharp s as ``ss``, one form of sigma)."""
    col = F.col(c) if isinstance(c, str) else c
    text = F.lower(py_strip(F.regexp_replace(col, _WS_RUN, " ")))
    return F.translate(F.replace(text, F.lit("\u00df"), F.lit("ss")), "\u03c2", "\u03c3")


def author_excluded(c: ColumnOrName, names: Iterable[str | None]) -> Column:
    """FLT-01: true when a normalized excluded name occurs in the author with
    a non ``[a-z]`` character (or the edge) on both sides.  Null or empty
    author, a blank name or an empty list never excludes.

    Names go through the same rule as authors; their patterns are constants
    that Spark folds."""
    col = F.col(c) if isinstance(c, str) else c
    author, out = normalize_author(col), F.lit(False)
    for n in names:
        name = normalize_author(F.lit(n).cast("string"))
        pattern = F.concat(F.lit(r"(?:^|[^a-z])(?:\Q"), name, F.lit(r"\E)(?:[^a-z]|$)"))
        out = out | F.when(name != "", F.regexp_like(author, pattern)).otherwise(F.lit(False))
    return F.when(col.isNull() | (col == ""), F.lit(False)).otherwise(F.coalesce(out, F.lit(False)))


def _first_word(text: Column) -> Column:
    """The letters that a text begins with, or its first character."""
    return F.regexp_extract(text, "(?s)^(?:[a-z]+|.)", 0)


def _places(author: Column) -> Column:
    """Where a name may begin in a normalized author (at the start or after a non ``[a-z]``
    character), as (at, word): two texts that agree from there on share that first word."""
    is_letter = lambda i: F.substring(author, i, 1).rlike("[a-z]")
    starts = F.filter(F.sequence(F.lit(1), F.length(author)), lambda i: (i == 1) | ~is_letter(i - 1))
    return F.transform(starts, lambda i: F.struct(
        i.alias("at"), _first_word(F.substring(author, i, F.length(author))).alias("word")))


def name_spans(authors: DataFrame, names: DataFrame) -> DataFrame:
    """The spans of each ``_author`` that may be one of the names (``_cand``): those that begin
    with a name's first word, have its length, and end before a non ``[a-z]`` character.

    The names stand in an index of (first word, length); only places whose word is in it
    are cut out, once for each length it has there."""
    index = names.select(_first_word(F.col("_cand")).alias("word"), F.length("_cand").alias("n")).distinct()
    places = authors.select("_author", F.explode(_places(F.col("_author"))).alias("p")).select("_author", "p.at", "p.word")
    end = F.col("at") + F.col("n")
    fits = (end == F.length("_author") + 1) | ~F.substring(F.col("_author"), end, F.lit(1)).rlike("[a-z]")
    return places.join(index, "word").where((end <= F.length("_author") + 1) & fits).select(
        "_author", F.substring(F.col("_author"), F.col("at"), F.col("n")).alias("_cand"))


#: Names of a Python list that are tested as one Column rule; a longer list is joined.
LISTED_NAMES = 100


def screen_authors(df: DataFrame, author_col: str, names: DataFrame | Iterable[str],
                   name_col: str = "name", out: str = "excluded") -> DataFrame:
    """JOIN-04: add ``out`` = author matches any excluded name.

    ``names`` is a Python list or a DataFrame of names, of any size.  A short list is a rule
    on the row (``author_excluded``).  A table is matched by its index of first words: the
    few spans of an author that can be a name are cut out and equi-joined to the names,
    exact and without a broadcast whose size would grow with the table."""
    if not isinstance(names, DataFrame):
        names = list(names)
        if len(names) <= LISTED_NAMES:
            return df.withColumn(out, author_excluded(author_col, names))
        names = df.sparkSession.createDataFrame([(n,) for n in names], f"{name_col} string")
    names = names.select(normalize_author(name_col).alias("_cand")).where(F.col("_cand") != "").distinct()
    # Work on distinct normalized authors (bylines repeat), then join the
    # verdict back on that value: deterministic under task retries, and a
    # byline carried by a third of all rows is one row on the match side.
    authors = (df.select(normalize_author(author_col).alias("_author"))
                 .where(F.col("_author").isNotNull() & (F.col("_author") != ""))
                 .distinct())
    hits = (name_spans(authors, names).join(names, "_cand", "left_semi").select("_author").distinct()
            .withColumn(out, F.lit(True)))
    return (df.withColumn("_author", normalize_author(author_col))
              .join(hits, "_author", "left")
              .withColumn(out, F.coalesce(F.col(out), F.lit(False)))
              .drop("_author"))
