"""Hard negatives by exact integer inner products, multiplied with Strassen's recursion.

Vectors become integers (``floor(scale * x)``).  Anchors and all rows are dealt into
stripes and every (anchor stripe, row stripe) pair is one task: it multiplies tiles
of anchors and rows with Strassen's seven products (odd sides are padded with
zeros), in 64-bit integers, where sums wrap and so the product is exact whenever it
fits; a bound on the norms proves that it does.  A first pass keeps, per anchor, the
``n_positives`` best rows of its label; a second keeps, per anchor and positive, the
``n_negatives`` best rows of other labels within the positive's window of scores.
Both are top lists that merge: of a tile into its task's, of the tasks' into the
result.  No task holds more than one stripe of each side, whatever the skew.

Order: higher score, then smaller id (null last), then the row's number.

Defined cases: rows with a null label, a null vector or a null or non-finite
component take no part; a shorter vector counts as filled up with zeros; every row
is a row of its own, so repeated rows are all listed, a repeated anchor is mined
for each of its rows (its repeat is one of its positives) and a null id is never an
anchor but may be found; scores beyond the exact range are an error, never a wrong
number; an anchor without positives or negatives gives no rows, an empty table an
empty one; further columns are not looked at, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleaner.llm.common import partitions, written

#: Rows of a stripe at most: what one task holds of either side.
ANCHOR_STRIPE = 16384
ROW_STRIPE = 32768
#: Sides of the tiles that are multiplied at once, and of Strassen's smallest blocks.
ANCHOR_TILE, ROW_TILE, LEAF = 256, 1024, 32
#: Scores stay below this, so that 100 times a score fits 64 bits.
EXACT = 2.0**56
NONE = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b.T`` of int64 matrices (rows are vectors on both sides)."""
    m, k, n = a.shape[0], a.shape[1], b.shape[0]
    if min(m, k, n) <= leaf:
        return np.einsum("ik,jk->ij", a, b)
    if m % 2 or k % 2 or n % 2:
        even = lambda x: np.pad(x, ((0, x.shape[0] % 2), (0, x.shape[1] % 2)))
        return strassen(even(a), even(b), leaf)[:m, :n]
    m, k, n = m // 2, k // 2, n // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    # Blocks of the transposed right side: b12 of the product is the lower left here.
    b11, b21, b12, b22 = b[:n, :k], b[:n, k:], b[n:, :k], b[n:, k:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * m, 2 * n), np.int64)
    out[:m, :n] = p1 + p4 - p5 + p7
    out[:m, n:] = p3 + p5
    out[m:, :n] = p2 + p4
    out[m:, n:] = p1 - p2 + p3 + p6
    return out


def _matrix(col: pa.ChunkedArray) -> np.ndarray:
    """List rows as an int64 matrix, shorter ones filled up with zeros."""
    col = pa.concat_arrays(col.chunks) if isinstance(col, pa.ChunkedArray) else col
    size = np.diff(col.offsets.to_numpy())
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    out = np.zeros((len(col), int(size.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < size[:, None]] = flat
    return out


def _sides(anchors: pa.Table, rows: pa.Table):
    """Both matrices of one width; rows in the order that decides ties."""
    rows = rows.sort_by([("id_null", "ascending"), ("id", "ascending"), ("no", "ascending")])
    a, b = _matrix(anchors.column("av")), _matrix(rows.column("v"))
    wide = max(a.shape[1], b.shape[1], 1)
    a, b = (np.pad(x, ((0, 0), (0, wide - x.shape[1]))) for x in (a, b))
    reach = [np.sqrt((x.astype(float) ** 2).sum(axis=1).max(initial=0)) for x in (a, b)]
    if reach[0] * reach[1] >= EXACT:
        raise ArithmeticError("scores of these vectors do not fit 64-bit integers exactly")
    return a, b, rows


class Tops:
    """Top lists of ``k`` (score, row) for each of ``n`` owners, merged tile by tile."""

    def __init__(self, n: int, k: int) -> None:
        self.score, self.row = np.full((n, k), NONE), np.full((n, k), -1)

    def merge(self, owners: np.ndarray, score: np.ndarray, row: np.ndarray) -> None:
        """Entries (``NONE``: no entry) of later rows than those merged before."""
        s = np.concatenate([self.score[owners], score], axis=1)
        r = np.concatenate([self.row[owners], row], axis=1)
        order = np.argsort(np.where(s == NONE, np.iinfo(np.int64).max, -s), axis=1, kind="stable")
        order = order[:, :self.score.shape[1]]
        self.score[owners] = np.take_along_axis(s, order, 1)
        self.row[owners] = np.take_along_axis(r, order, 1)

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        owner, at = np.nonzero(self.row >= 0)
        return owner, self.row[owner, at], self.score[owner, at]


def _first(score: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per line, the first ``k`` allowed places by score and place, with their scores."""
    s = np.where(allowed, score, NONE)
    wide = s.shape[1]
    if wide > 4 * k:
        # Everything above the k-th score, and the first places that equal it.
        least = np.partition(s, wide - k, axis=1)[:, wide - k:wide - k + 1]
        above = s > least
        room = k - above.sum(axis=1, keepdims=True)
        equal = s == least
        keep = above | (equal & (np.cumsum(equal, axis=1) <= room))
        place = np.nonzero(keep)[1].reshape(len(s), k)
    else:
        place = np.broadcast_to(np.arange(wide), s.shape)
    got = np.take_along_axis(s, place, 1)
    return got, np.where(got == NONE, -1, place)


def _tiles(a: np.ndarray, b: np.ndarray):
    for i in range(0, len(a), ANCHOR_TILE):
        for j in range(0, len(b), ROW_TILE):
            yield np.arange(i, min(i + ANCHOR_TILE, len(a))), j, strassen(a[i:i + ANCHOR_TILE], b[j:j + ROW_TILE])


POSITIVES = "anchor_no long, no long, id long, score long"
NEGATIVES = "anchor_no long, positive_no long, no long, id long, score long"


def _find_positives(k: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = {"anchor_no": [], "no": [], "id": [], "score": []}
        if anchors.num_rows and rows.num_rows:
            a, b, rows = _sides(anchors, rows)
            kinds, labels = anchors.column("kind").to_numpy(), rows.column("label").to_numpy()
            own, no = anchors.column("anchor_no").to_numpy(), rows.column("no").to_numpy()
            tops = Tops(len(a), k)
            for at, j, s in _tiles(a, b):
                here = slice(j, j + s.shape[1])
                score, place = _first(s, (kinds[at][:, None] == labels[here]) & (own[at][:, None] != no[here]), k)
                tops.merge(at, score, np.where(place < 0, -1, place + j))
            owner, row, score = tops.entries()
            out = {"anchor_no": own[owner], "no": no[row], "id": rows.column("id").take(pa.array(row)), "score": score}
        return pa.table(out, schema=pa.schema([(c, pa.int64()) for c in ("anchor_no", "no", "id", "score")]))

    return run


def _find_negatives(k: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        names = ("anchor_no", "positive_no", "no", "id", "score")
        out = {c: [] for c in names}
        if anchors.num_rows and rows.num_rows:
            a, b, rows = _sides(anchors, rows)
            kinds, labels = anchors.column("kind").to_numpy(), rows.column("label").to_numpy()
            own, no = anchors.column("anchor_no").to_numpy(), rows.column("no").to_numpy()
            wins, pos, low, high = (_matrix(anchors.column(c)) for c in ("win", "positive_no", "low", "high"))
            tops = Tops(wins.size, k)
            for at, j, s in _tiles(a, b):
                other = kinds[at][:, None] != labels[j:j + s.shape[1]]
                for w in range(wins.shape[1]):
                    held = other & (wins[at, w:w + 1] > 0) & (s >= low[at, w:w + 1]) & (s <= high[at, w:w + 1])
                    some = np.flatnonzero(held.any(axis=1))
                    if len(some):
                        score, place = _first(s[some], held[some], k)
                        tops.merge(at[some] * wins.shape[1] + w, score, np.where(place < 0, -1, place + j))
            owner, row, score = tops.entries()
            line, w = np.divmod(owner, max(1, wins.shape[1]))
            out = {"anchor_no": own[line], "positive_no": pos[line, w], "no": no[row],
                   "id": rows.column("id").take(pa.array(row)), "score": score}
        return pa.table(out, schema=pa.schema([(c, pa.int64()) for c in names]))

    return run


def _best(found: DataFrame, owner: list[str], k: int) -> DataFrame:
    """The tasks' lists merged: the first ``k`` of each owner, with their ``rank``."""
    order = Window.partitionBy(*owner).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "no")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, anchor: Column | None = None, id_col: str = "vec_id", vector_col: str = "embedding",
         label_col: str = "label", n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90,
         scale: int = 256) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchor`` says which rows are anchors (a condition on the input's columns; by
    default every row).  A negative's score lies between ``low`` and ``high``
    hundredths of the positive's, ends included."""
    spark = rows.sparkSession
    x, n = F.col(vector_col), partitions(spark)
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    kept = written(rows.where(F.col(label_col).isNotNull() & x.isNotNull()).where(sound).select(
        F.monotonically_increasing_id().alias("no"), F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("long").alias("label"),
        F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long")).alias("v"),
        F.coalesce(F.lit(True) if anchor is None else anchor, F.lit(False)).alias("anchor")), "vectors")
    count = kept.agg(F.count(F.lit(1)).alias("rows"), F.count_if("anchor").alias("anchors")).first()
    cell = min(ROW_STRIPE, max(64, -(-count["rows"] // (4 * n))))
    n_row = max(1, -(-count["rows"] // cell))
    n_anchor = max(1, -(-count["anchors"] // ANCHOR_STRIPE))
    deal = lambda parts: F.pmod(F.xxhash64("no"), F.lit(parts)).cast("int")
    stripes = kept.select(deal(n_row).alias("row_stripe"), F.explode(F.sequence(F.lit(0), F.lit(n_anchor - 1))).alias(
        "anchor_stripe"), "no", "id", F.col("id").isNull().alias("id_null"), "label", "v")
    grid = lambda a: a.select(deal(n_anchor).alias("anchor_stripe"), F.explode(F.sequence(
        F.lit(0), F.lit(n_row - 1))).alias("row_stripe"), "*").withColumnsRenamed({"no": "anchor_no", "label": "kind", "v": "av"})
    pairs = lambda a: a.groupBy("anchor_stripe", "row_stripe").cogroup(
        stripes.groupBy("anchor_stripe", "row_stripe"))
    anchors = kept.where("anchor").select("no", "label", "v")

    positives = written(_best(pairs(grid(anchors)).applyInArrow(_find_positives(n_positives), POSITIVES),
                              ["anchor_no"], n_positives), "positives")
    # 100 * negative between low * positive and high * positive, as whole numbers.
    up = F.expr(f"-floor(cast(-{low} * cast(score as decimal(20,0)) as decimal(24,0)) / 100)").cast("long")
    down = F.expr(f"floor(cast({high} * cast(score as decimal(20,0)) as decimal(24,0)) / 100)").cast("long")
    windows = positives.groupBy("anchor_no").agg(F.collect_list(F.struct(
        "no", up.alias("low"), down.alias("high"))).alias("w")).select(
        F.col("anchor_no").alias("no"), F.col("w.no").alias("positive_no"), F.col("w.low").alias("low"),
        F.col("w.high").alias("high"), F.transform("w", lambda _: F.lit(1).cast("long")).alias("win"))
    found = pairs(grid(anchors.join(windows, "no"))).applyInArrow(_find_negatives(n_negatives), NEGATIVES)
    best = _best(found, ["anchor_no", "positive_no"], n_negatives)
    ids = kept.where("anchor").select(F.col("no").alias("anchor_no"), F.col("id").alias("anchor_id"))
    return best.join(positives.select("anchor_no", F.col("no").alias("positive_no"), F.col("id").alias("positive_id"),
                                      F.col("score").alias("positive_score")), ["anchor_no", "positive_no"]).join(
        ids, "anchor_no").select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
                                 "positive_score", F.col("score").alias("negative_score"))
