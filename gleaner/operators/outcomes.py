"""Per-article outcomes and run accounting (WIN-03, AGG-01, AGG-02, SET-01,
SNK-04 rows)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def ingest_outcomes(feed: DataFrame,
                    key: str = "article_id",
                    order_col: str | Sequence[str] = "feed_pos",
                    excluded: ColumnOrName | None = "excluded",
                    failed: ColumnOrName | None = "failed",
                    ledger: DataFrame | None = None,
                    scope: Sequence[str] = ()) -> DataFrame:
    """WIN-03: label every entry ``duplicate``, ``excluded``, ``failed`` or
    ``processed``, in that order of precedence.

    An entry is a duplicate when its key is already in the ledger, or when
    an earlier entry with the same key was processed or excluded (both write
    the ledger); after a failure the next copy is tried again.  Because
    "done" does not depend on earlier labels, this equals

        dup_i = in_ledger OR pos_i > min(pos_j : key_j = key_i, ok_j)
        ok_j  = excluded_j OR NOT failed_j

    computed as a partial aggregate (min per key, reduced map-side) joined
    back on the key: no window sorts a hot key's rows in one task, and AQE
    splits a skewed join partition.  A null key is ``failed``.
    ``scope`` columns (e.g. a feed id) restrict the "earlier copy" rule to
    entries of the same scope.  ``order_col`` may name several columns (e.g.
    batch, position, row id) where one alone has ties: entries that tie on all
    of them count as the same entry."""
    order = F.struct(*([order_col] if isinstance(order_col, str) else order_col))
    ex = _flag(excluded)
    fa = _flag(failed)
    df = feed.withColumn("_ex", ex).withColumn("_fail", fa)
    keys = [*scope, key]
    first_ok = (df.where(F.col(key).isNotNull() & (F.col("_ex") | ~F.col("_fail")))
                  .groupBy(*keys).agg(F.min(order).alias("_first_ok")))
    df = df.join(first_ok, keys, "left")
    in_ledger = F.lit(False)
    if ledger is not None:
        # Only ledger keys that occur in this feed matter: a semi join against
        # the feed's keys shrinks the (ever-growing) ledger before the
        # distinct and the join back.
        batch_keys = feed.select(key).where(F.col(key).isNotNull()).distinct()
        seen = (ledger.select(key).join(batch_keys, key, "left_semi").distinct()
                      .withColumn("_in_ledger", F.lit(True)))
        df = df.join(seen, key, "left")
        in_ledger = F.coalesce(F.col("_in_ledger"), F.lit(False))
    dup = in_ledger | F.coalesce(order > F.col("_first_ok"), F.lit(False))
    outcome = (F.when(F.col(key).isNull(), F.lit("failed"))
                .when(dup, F.lit("duplicate"))
                .when(F.col("_ex"), F.lit("excluded"))
                .when(F.col("_fail"), F.lit("failed"))
                .otherwise(F.lit("processed")))
    drop = ["_ex", "_fail", "_first_ok"] + (["_in_ledger"] if ledger is not None else [])
    return df.withColumn("outcome", outcome).drop(*drop)


def _flag(c: ColumnOrName | None) -> Column:
    if c is None:
        return F.lit(False)
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.cast("boolean"), F.lit(False))


COUNTERS = ("articles_found", "articles_processed", "articles_failed", "skipped_duplicate", "skipped_excluded")


def outcome_counters(outcome_col: str = "outcome") -> dict[str, Column]:
    """AGG-01: the counters as aggregates over outcome rows."""
    kinds = ("processed", "failed", "duplicate", "excluded")
    return {COUNTERS[0]: F.count(F.lit(1)),
            **{name: F.count_if(F.col(outcome_col) == kind) for name, kind in zip(COUNTERS[1:], kinds)}}


def run_summary(outcomes: DataFrame, run_col: str = "run_id",
                outcome_col: str = "outcome", runs: DataFrame | None = None) -> DataFrame:
    """AGG-01 + AGG-02: one row per run with the counters and the status.

    found counts every entry inside the cap; duplicates and excluded entries
    count only there.  ``runs`` (a table with ``run_col``) lists the runs that
    must have a row: one without entries is completed with zeros."""
    agg = outcomes.groupBy(run_col).agg(*[c.alias(name) for name, c in outcome_counters(outcome_col).items()])
    if runs is not None:
        agg = runs.select(run_col).distinct().join(agg, run_col, "left").fillna(0, list(COUNTERS))
    status = F.when(F.col("articles_failed") == 0, F.lit("completed")).otherwise(
        F.lit("completed_with_errors"))
    return agg.withColumn("status", status)


def ledger_additions(outcomes: DataFrame, outcome_col: str = "outcome") -> DataFrame:
    """SET-01: entries that write the ledger (excluded or processed)."""
    return outcomes.where(F.col(outcome_col).isin("excluded", "processed"))
