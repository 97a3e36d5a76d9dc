"""Feed scan and normalisation (SRC-01, PRJ-01..04, WIN-04 position).

Feeds are landed as files first (the HTTP download is outside Spark).  RSS
``<item>`` elements are read with Spark's built-in XML source using a fixed
all-string schema, so ``guid`` with attributes still reads as its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.functions.text import py_strip
from gleaner.functions.timefmt import parse_feed_date
from gleaner.operators.common import materialize
from gleaner.operators.keys import article_key, feed_position

# One RSS item as landed (all strings; ``content`` collects every
# ``content:encoded`` element of the item).
RSS_ITEM_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("guid", T.StructType([T.StructField("_text", T.StringType()),
                                        T.StructField("_attr_isPermaLink", T.StringType())])),
    T.StructField("id", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("creator", T.StringType()),
    T.StructField("pubDate", T.StringType()),
    T.StructField("published", T.StringType()),
    T.StructField("updated", T.StringType()),
    T.StructField("encoded", T.ArrayType(T.StringType())),
    T.StructField("description", T.StringType()),
    T.StructField("summary", T.StringType()),
])

# One Atom entry as landed; only what an entry has of the RSS item's fields.
_TEXT = T.StructType([T.StructField("_text", T.StringType()), T.StructField("_attr_type", T.StringType())])
ATOM_ENTRY_SCHEMA = T.StructType([
    T.StructField("title", _TEXT),
    T.StructField("link", T.ArrayType(T.StructType([T.StructField("_text", T.StringType()),
                                                    T.StructField("_attr_href", T.StringType()),
                                                    T.StructField("_attr_rel", T.StringType())]))),
    T.StructField("id", T.StringType()),
    T.StructField("author", T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))),
    T.StructField("published", T.StringType()),
    T.StructField("updated", T.StringType()),
    T.StructField("content", T.ArrayType(_TEXT)),
    T.StructField("summary", _TEXT),
])

FEED_SCHEMA = T.StructType([
    T.StructField("article_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("published_at", T.TimestampType()),
    T.StructField("feed_content", T.StringType()),
    T.StructField("feed_pos", T.LongType()),
    T.StructField("feed_file", T.StringType()),
])


def _reader(spark: SparkSession, streaming: bool):
    return spark.readStream if streaming else spark.read


def read_rss_items(spark: SparkSession, path: str, streaming: bool = False,
                   row_tag: str = "item") -> DataFrame:
    """Raw RSS items with their file and in-file position.

    Namespace prefixes (``content:encoded``, ``dc:creator``) are dropped by
    the XML source's local-name handling, so they arrive as ``encoded`` and
    ``creator``."""
    r = (_reader(spark, streaming).format("xml")
         .option("rowTag", row_tag)
         .option("ignoreNamespace", "true")
         .option("attributePrefix", "_attr_")
         .option("valueTag", "_text")
         .schema(RSS_ITEM_SCHEMA))
    return _placed(r.load(path), streaming)


def _placed(df: DataFrame, streaming: bool) -> DataFrame:
    """The file of each row and its place in it: ``_block``, where its split starts, and
    ``_pos``, which rises along the split.  A stream has no stable row ids; its
    micro-batches number their rows (``streaming.numbered``)."""
    pos = F.lit(None).cast("bigint") if streaming else F.monotonically_increasing_id()
    return df.withColumn("feed_file", F.col("_metadata.file_path")).withColumn(
        "_block", F.col("_metadata.file_block_start")).withColumn("_pos", pos)


def read_atom_entries(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Atom entries in the columns of RSS items: the link is the alternate one
    (or the first), the author the first author's name, ``encoded`` the contents."""
    r = (_reader(spark, streaming).format("xml")
         .option("rowTag", "entry").option("ignoreNamespace", "true")
         .option("attributePrefix", "_attr_").option("valueTag", "_text")
         .schema(ATOM_ENTRY_SCHEMA))
    df = _placed(r.load(path), streaming)
    links = F.coalesce(F.col("link"), F.array().cast(ATOM_ENTRY_SCHEMA["link"].dataType))
    alternate = F.filter(links, lambda x: F.coalesce(x["_attr_rel"], F.lit("alternate")) == "alternate")
    return df.select(
        F.col("title._text").alias("title"),
        F.coalesce(F.get(alternate, 0)["_attr_href"], F.get(links, 0)["_attr_href"]).alias("link"), "id",
        F.get("author", 0)["name"].alias("author"), "published", "updated",
        F.filter(F.transform("content", lambda x: x["_text"]), lambda x: x.isNotNull()).alias("encoded"),
        F.col("summary._text").alias("summary"), "feed_file", "_block", "_pos")


def normalize_feed(items: DataFrame, pos_col: str = "_pos", extra: tuple[str, ...] = ()) -> DataFrame:
    """Feed entries in the shape the rest of the engine uses.

    * article_id: sha256 of id, else guid, else link (PRJ-01)
    * title, url: missing -> "", stripped (PRJ-02); author may be null
    * published_at: published else updated, null when unparseable (PRJ-03)
    * feed_content: all ``content`` values joined by newline, else the
      summary/description, else "" (PRJ-04)
    * feed_pos: the item's position in landing order (WIN-04)
    """
    def c(name: str) -> Column:
        if name not in items.columns:
            return F.lit(None).cast("string")
        col = F.col(name)
        # Elements that may carry attributes are read as (text, attributes).
        return col["_text"] if isinstance(items.schema[name].dataType, T.StructType) else col

    content = F.col("encoded") if "encoded" in items.columns else F.lit(None).cast("array<string>")
    summary = F.coalesce(F.nullif(c("summary"), F.lit("")), c("description"))
    body = (F.when(F.size(F.coalesce(content, F.array().cast("array<string>"))) > 0,
                   F.array_join(content, "\n"))
             .otherwise(F.coalesce(summary, F.lit(""))))
    pub_src = F.coalesce(F.nullif(F.coalesce(c("published"), c("pubDate")), F.lit("")),
                         F.nullif(c("updated"), F.lit("")))
    return items.select(
        article_key(c("id"), c("guid"), c("link")).alias("article_id"),
        py_strip(F.coalesce(c("title"), F.lit(""))).alias("title"),
        F.coalesce(c("author"), c("creator")).alias("author"),
        py_strip(F.coalesce(c("link"), F.lit(""))).alias("url"),
        parse_feed_date(pub_src).alias("published_at"),
        body.alias("feed_content"),
        F.col(pos_col).cast("bigint").alias("feed_pos"),
        c("feed_file").alias("feed_file"), *extra)


def _entries(items: DataFrame) -> DataFrame:
    return normalize_feed(items, extra=("_block", "_pos", "_kind"))


def _with_positions(parts: list[DataFrame]) -> DataFrame:
    """Entries of several scans with one dense position per file, from 1, in document
    order: by the start of the split, then the order within it."""
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    rows = materialize(rows, "feed").withColumn("_place", F.struct("_block", "_kind", "_pos"))
    return feed_position(rows.drop("feed_pos"), "_place", "feed_pos", ["feed_file"]).select(*FEED_SCHEMA.names)


def read_feed(spark: SparkSession, path: str, fmt: str = "xml",
              streaming: bool = False) -> DataFrame:
    """SRC-01: landed feed files -> normalized entries.

    ``fmt='xml'`` reads RSS items and Atom entries (a file holds one kind);
    ``'rss'`` / ``'atom'`` only those, and streams name the one they read;
    ``'parquet'`` / ``'json'`` read files already in the normalized shape
    (``FEED_SCHEMA``)."""
    if fmt in ("xml", "rss", "atom"):
        kinds = {"rss": [read_rss_items], "atom": [read_atom_entries]}.get(
            fmt, [read_rss_items] if streaming else [read_rss_items, read_atom_entries])
        parts = [read(spark, path, streaming) for read in kinds]
        if not streaming:
            # Ranked once over the files' rows without their texts; joined back below.
            parts = [p.withColumn("_kind", F.lit(k)) for k, p in enumerate(parts)]
            return _with_positions([_entries(p) for p in parts])
        return normalize_feed(parts[0])
    r = _reader(spark, streaming).format(fmt).schema(FEED_SCHEMA)
    return r.load(path)
