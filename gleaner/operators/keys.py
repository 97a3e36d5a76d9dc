"""Article keys, distinct articles and the per-run batch cap (PRJ-01, AGG-06,
WIN-04, LIM-01)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.operators.common import materialize

ColumnOrName = Column | str


def _col(c: ColumnOrName | None) -> Column:
    if c is None:
        return F.lit(None).cast("string")
    return F.col(c) if isinstance(c, str) else c


def article_key(id_col: ColumnOrName | None = None,
                guid_col: ColumnOrName | None = None,
                link_col: ColumnOrName | None = None) -> Column:
    """PRJ-01: sha256 hex of the first non-empty of id, guid, link.

    A row with none of them gets a null key (it becomes a ``failed``
    outcome instead of aborting the whole run)."""
    src = F.coalesce(F.nullif(_col(id_col), F.lit("")),
                     F.nullif(_col(guid_col), F.lit("")),
                     _col(link_col))
    return F.sha2(src, 256)


def feed_position(df: DataFrame, order_col: str = "_pos", out: str = "feed_pos",
                  partition_cols: Sequence[str] = (), blocks: int | None = None) -> DataFrame:
    """WIN-04: dense 1-based position within each feed, in ``order_col``
    order (unique integers, e.g. the id a source attaches at scan time).

    A plain ``row_number()`` per feed would sort a feed holding most rows in
    one task.  Instead a sampled range partitioning on (feed, order) cuts the
    rows into ``blocks`` similarly sized stretches, however sparse or skewed the
    ids are; a stretch is numbered locally and offset by the row counts of the
    stretches before it.  Block counts are at most ``blocks`` rows per feed.
    Only (feed, order) is shuffled and written; other columns are joined back."""
    part = list(partition_cols)
    n = blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    thin = materialize(df.select(*part, order_col).repartitionByRange(n, *part, order_col)
                         .withColumn("_blk", F.spark_partition_id()), "feed_blocks")
    local = F.row_number().over(Window.partitionBy(*part, "_blk").orderBy(order_col))
    counts = thin.groupBy(*part, "_blk").agg(F.count(F.lit(1)).alias("_n"))
    wc = (Window.partitionBy(*part) if part else Window.partitionBy()).orderBy("_blk") \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(c).alias(f"_o_{c}") for c in part], F.col("_blk").alias("_o_blk"),
                            F.coalesce(F.sum("_n").over(wc), F.lit(0)).alias("_off"))
    rows = thin.withColumn("_local", local)
    same = F.col("_blk") == F.col("_o_blk")
    for c in part:
        same = same & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    pos = rows.join(offsets, same).select(*part, order_col, (F.col("_off") + F.col("_local")).cast("bigint").alias(out))
    others = [c for c in df.columns if c not in (*part, order_col, out)]
    if not others:
        return pos
    pos = pos.select(*[F.col(c).alias(f"_p_{c}") for c in part], F.col(order_col).alias("_p_order"), out)
    same = F.col(order_col) == F.col("_p_order")
    for c in part:
        same = same & F.col(c).eqNullSafe(F.col(f"_p_{c}"))
    return df.drop(out).join(pos, same).select(*part, order_col, *others, out)


def batch_cap(df: DataFrame, n: int, order_cols: Sequence[str] = ("feed_pos",),
              partition_cols: Sequence[str] = ()) -> DataFrame:
    """LIM-01: the first ``n`` entries of each feed, taken before dedup.

    Per feed this is ``row_number() <= n``, which Spark plans as a
    WindowGroupLimit: every map task keeps only its local top ``n`` per feed
    before the shuffle, so a feed holding most rows still moves at most
    ``n`` rows per task.  A single feed is a plain top-k."""
    if not partition_cols:
        return df.orderBy(*order_cols).limit(n)
    w = Window.partitionBy(*partition_cols).orderBy(*order_cols)
    return (df.withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") <= n).drop("_rn"))


def distinct_articles(df: DataFrame, key: str = "article_id",
                      order_col: str = "feed_pos",
                      count_col: str | None = "n_copies") -> DataFrame:
    """AGG-06: one row per key, the earliest feed position wins.

    ``min_by`` is a partial aggregate: each map task reduces its rows to one
    per key before the shuffle, so a key with a third of all rows costs one
    row per task on the wire."""
    others = [c for c in df.columns if c != key]
    agg = [F.min_by(F.struct(*others), F.col(order_col)).alias("_first")]
    if count_col:
        agg.append(F.count(F.lit(1)).alias(count_col))
    out = df.groupBy(key).agg(*agg)
    cols = [key] + [F.col("_first")[c].alias(c) for c in others]
    if count_col:
        cols.append(count_col)
    return out.select(*cols)
