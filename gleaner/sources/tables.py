"""Table scans: pages, ledger, queue snapshots, model responses (SRC-02,
SRC-03, SRC-04, SRC-05)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.operators.packages import normalize_package

LEDGER_SCHEMA = T.StructType([
    T.StructField("article_id", T.StringType(), False),
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("published_at", T.TimestampType()),
    T.StructField("processed_at", T.TimestampType()),
])

#: Characters of the key that name a ledger folder: 16 folders a batch for hex keys; two
#: (256) or three suit a ledger that is orders of magnitude larger than a batch.
LEDGER_PREFIX_CHARS = 1

RESPONSE_SCHEMA = T.StructType([
    T.StructField("delivery_mode", T.StringType()),
    T.StructField("single_tweet", T.StringType()),
    T.StructField("thread", T.ArrayType(T.StringType())),
    T.StructField("_corrupt_record", T.StringType()),
])


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """SRC-02: landed article pages (``url``, ``html``)."""
    return spark.read.format(fmt).load(path)


_LEDGER_READ = T.StructType(LEDGER_SCHEMA.fields + [T.StructField("prefix", T.StringType()),
                                                    T.StructField("batch_id", T.LongType())])


def _read_if_there(spark: SparkSession, schema: T.StructType | str, path: str) -> DataFrame | None:
    try:
        # An explicit schema also covers a folder that holds no files yet.
        return spark.read.schema(schema).parquet(path)
    except Exception as e:  # noqa: BLE001 - only "path does not exist" is expected
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        return None


def ledger_snapshot(spark: SparkSession, path: str):
    """(snapshot, upto) of the last folded part of a ledger, or None."""
    rows = _read_if_there(spark, "upto long, snapshot long", f"{path}_compact/upto")
    return None if rows is None else rows.orderBy(F.col("snapshot").desc()).first()


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """SRC-03: the ledger of handled articles; an absent ledger is empty.

    Ledger files are written per batch under ``batch_id=`` and ``prefix=`` folders.
    Both partition columns are kept: a replayed batch leaves its own rows out, and a batch
    reads the folders of its keys only.  Rows that ``sinks.compact_ledger`` has folded
    carry no batch id."""
    rows = _read_if_there(spark, _LEDGER_READ, path)
    if rows is None:
        return spark.createDataFrame([], _LEDGER_READ)
    last = ledger_snapshot(spark, path)
    if last is None:
        return rows
    folded = spark.read.schema(T.StructType(_LEDGER_READ.fields[:-1])).parquet(f"{path}_compact/rows/snapshot={last.snapshot}")
    return rows.where(F.col("batch_id") > F.lit(last.upto)).unionByName(
        folded.withColumn("batch_id", F.lit(None).cast("long")))


def ledger_of(spark: SparkSession, path: str, keys: DataFrame, key: str = "article_id",
              but_batch: int | None = None, prefix_chars: int = LEDGER_PREFIX_CHARS) -> DataFrame:
    """SRC-03 + JOIN-01: the keys of the ledger that may be among ``keys``, without those of
    batch ``but_batch``: only folders whose prefix occurs in ``keys`` are read.

    The prefixes, at most 16 ** ``prefix_chars`` short texts for hex keys, are literals in the
    plan, so the scan chooses its folders by them; files without a prefix are always read."""
    ledger = read_ledger(spark, path)
    ours = keys.select(F.substring(key, 1, prefix_chars).alias("p")).where("p is not null").distinct().collect()
    here = F.col("prefix").isin(*[r.p for r in ours]) if ours else F.lit(False)
    ledger = ledger.where(F.col("prefix").isNull() | here)
    if but_batch is not None:
        ledger = ledger.where(F.col("batch_id").isNull() | (F.col("batch_id") != F.lit(int(but_batch))))
    return ledger.select(key)


def read_queue(spark: SparkSession, path: str, page_pattern: str = r"page[-_=]?(\d+)") -> DataFrame:
    """SRC-04: landed queue snapshots, one JSON document per file.

    Each file is read whole; its page number comes from the file name (e.g.
    ``page_3.json``); bodies that are not JSON objects (arrays, scalars,
    broken text) are dropped: only object bodies are scanned for times."""
    df = spark.read.text(path, wholetext=True)
    fname = F.col("_metadata.file_path")
    page = F.regexp_extract(fname, page_pattern, 1)
    return (df.select(fname.alias("file"),
                      F.when(page != "", page.cast("int")).otherwise(F.lit(0)).alias("page"),
                      F.col("value").alias("body"))
              .where(F.trim(F.col("body")).startswith("{")
                     & F.get_json_object(F.col("body"), "$").isNotNull()))


def parse_responses(df: DataFrame, json_col: str = "response") -> DataFrame:
    """SRC-05: model response JSON -> normalized package columns.

    Missing keys become empty, values are stripped, the mode lower-cased and
    blank thread items dropped.  Text that is not a JSON object, or a
    ``thread`` that is not a list, gives ``parse_error`` (the package then
    fails validation instead of stopping the job); a null thread is empty."""
    parsed = F.from_json(F.col(json_col), RESPONSE_SCHEMA,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    raw_thread = F.get_json_object(F.col(json_col), "$.thread")
    thread_bad = raw_thread.isNotNull() & ~F.trim(raw_thread).startswith("[")
    bad = parsed.isNull() | parsed["_corrupt_record"].isNotNull()
    pkg = normalize_package(parsed["delivery_mode"], parsed["single_tweet"], parsed["thread"])
    err: Column = (F.when(F.col(json_col).isNull(), F.lit("response is not a JSON object"))
                    .when(thread_bad, F.lit("thread is not a list"))
                    .when(bad, F.lit("response is not a JSON object")))
    return (df.withColumn("_pkg", pkg)
              .withColumn("delivery_mode", F.col("_pkg.delivery_mode"))
              .withColumn("single_tweet", F.col("_pkg.single_tweet"))
              .withColumn("thread", F.col("_pkg.thread"))
              .withColumn("parse_error", err)
              .drop("_pkg"))
