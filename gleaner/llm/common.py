"""Helpers shared by the operators of this subpackage.

Nothing here keeps state in a machine-local folder: tables that are used
twice are written under ``spark.checkpoint.dir`` (see
``gleaner.session.shared_dir``) and read back, which also cuts lineage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.session import shared_dir

#: Rows of one Arrow batch handed to Python; keeps a batch of very long texts small.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the rows of an Arrow batch (a smaller setting of the user's stays)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark, 'llm')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def order_key(id_col: str = "doc_id") -> Column:
    """The integer id that decides who is first; a null id comes after all."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit(2**63 - 1))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest reachable node of every node that occurs in ``edges(a, b)``.

    Star contraction: each round a node adopts the smallest label among its
    own and its neighbours' labels, and edges are re-pointed from nodes to
    those labels, so trees collapse in logarithmically many rounds.  Only
    counts reach the driver; every round is written to the shared folder.
    A hub (one node with very many edges) is pre-aggregated by ``min``.
    Returns ``(node, root)``; self loops and nulls are ignored, an empty
    input gives an empty result.
    """
    e = edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = written(e, "edges")
    maps: list[DataFrame] = []  # each: node -> smaller label, for nodes that vanish
    for _ in range(max_rounds):
        if e.isEmpty():
            break
        # Every node points to its smallest smaller neighbour (roots stay).
        up = written(e.groupBy("a").agg(F.min("b").alias("up")), "up")
        # Follow pointers to the end: chains are halved until none is left.
        while True:
            nxt = up.alias("x").join(up.alias("y"), F.col("x.up") == F.col("y.a"), "left").select(
                F.col("x.a").alias("a"), F.coalesce("y.up", "x.up").alias("up"),
                F.col("y.up").isNotNull().alias("moved"))
            nxt = written(nxt, "jump")
            up = nxt.select("a", "up")
            if nxt.where("moved").isEmpty():
                break
        maps.append(up)
        la = e.join(up.withColumnRenamed("up", "ra"), "a", "left")
        lb = la.join(up.select(F.col("a").alias("b"), F.col("up").alias("rb")), "b", "left")
        e2 = lb.select(F.coalesce("ra", "a").alias("p"), F.coalesce("rb", "b").alias("q"))
        e = written(e2.where("p <> q").select(F.greatest("p", "q").alias("a"), F.least("p", "q").alias("b"))
                    .distinct(), "edges")
    else:
        raise RuntimeError("connected components did not settle")
    spark = edges.sparkSession
    if not maps:
        kind = e.schema["a"].dataType.simpleString()
        return spark.createDataFrame([], f"node {kind}, root {kind}")
    out = maps[0].select(F.col("a").alias("node"), F.col("up").alias("root"))
    for m in maps[1:]:
        out = out.join(m.select(F.col("a").alias("root"), F.col("up").alias("r2")), "root", "left").select(
            "node", F.coalesce("r2", "root").alias("root")).unionByName(
            m.select(F.col("a").alias("node"), F.col("up").alias("root")))
    # A node vanishes in exactly one round, so each is listed once; later maps
    # re-point the roots of earlier ones.
    return out
