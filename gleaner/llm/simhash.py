"""SimHash near-duplicates over a Gray-order hierarchical index.

Fingerprints: a text is lower-cased (A-Z only), split into words at ASCII white
space, and every ``shingle``-word run, repeats included, is hashed with XXH64
(seed 42); a bit is set when it is set in over half of the hashes.  A text with
fewer words is one shingle, one without words has fingerprint zero.

Search: equal fingerprints are one index entry.  Two fingerprints within ``k``
bits agree in at least two of ``k + 2`` bit blocks, so each entry is routed once
for every pair of blocks, to the partition of those blocks' bits.  A partition
is sorted by (routing bits, Gray rank): Gray order puts fingerprints with few
differing bits side by side.  The index over it is a tree; a node keeps the bits
all its entries share (mask and pattern).  Nodes are compared top down: the
differences on newly shared bits are added to those found above, a pair of
nodes with more than ``k`` is pruned with everything below it, and a pair that
cannot exceed ``k`` any more is linked whole without looking at its leaves.

Each task reduces its links to a forest before anything leaves it; components
are then joined by star contraction.  A routing group beyond ``part_rows``
entries is cut along the Gray order into parts; pairs of parts are first pruned
by their own top nodes and the rest are searched as tasks of two parts each.

Defined cases: null text is empty; a null id is an ordinary row whose id counts
as larger than all others (a component of null ids only has a null id); repeated
rows each get a row; an empty table gives an empty table; further columns are
kept, but input columns named like outputs are replaced.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.llm.arrays import U64, ranges
from gleaner.llm.common import connected_components, order_key, partitions, small_batches, written

SEED = 42
FAN = 8
PART_ROWS = 32768
#: Node pairs compared at once in a task.
STEP = 1 << 19


def fingerprint(text: bytes, shingle: int = 3) -> int:
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    n = max(1, len(words) - shingle + 1)
    if n == 1:
        return xxhash.xxh64_intdigest(line, SEED)
    begin = [0, *(gaps[: n - 1] + 1).tolist()]
    end = [*gaps[shingle - 1:].tolist(), len(line)]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(line[a:b], SEED) for a, b in zip(begin, end)), "<u8", n)
    votes = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        bits = np.unpackbits(h[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text_col: str = "text", shingle: int = 3, keep_text: bool = False) -> DataFrame:
    """``docs`` plus ``fp`` (the fingerprint's 64 bits as a signed bigint)."""
    small_batches(docs.sparkSession)
    docs = docs.select(*[c for c in docs.columns if c not in ("fp",)])
    fields = [f for f in docs.schema.fields if keep_text or f.name != text_col]
    schema = T.StructType(fields + [T.StructField("fp", T.LongType())])

    def run(batches):
        for b in batches:
            col = b.column(text_col).cast(pa.large_binary())
            fps = np.fromiter((fingerprint(x.as_py() or b"", shingle) for x in col), U64, len(col)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in fields), pa.array(fps)], names=schema.names)

    return docs.mapInArrow(run, schema)


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def gray_rank(x: Column) -> Column:
    """Place of a bit pattern in the reflected Gray sequence (a 64-bit pattern)."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x.bitwiseXOR(F.shiftrightunsigned(x, s))
    return x


def block_masks(k: int) -> list[int]:
    """For each pair of the k + 2 bit blocks, the mask of their bits (signed)."""
    cuts = [round(i * 64 / (k + 2)) for i in range(k + 3)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    masks = [x | y for x, y in combinations(blocks, 2)]
    return [m - 2**64 if m >= 2**63 else m for m in masks]


class Forest:
    """Smallest-label components of entries 0..n-1, united in batches."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.root[a], self.root[b]
            open_ = ra != rb
            if not open_.any():
                return
            a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


class GrayIndex:
    """Levels of nodes over entries in (group, Gray) order; level 0 are entries."""

    def __init__(self, fp: np.ndarray, group: np.ndarray) -> None:
        n = len(fp)
        self.lo, self.hi = [fp], [fp]  # AND and OR of the entries
        self.first, self.last = [group], [group]
        while n > FAN:
            at = np.arange(0, n, FAN)
            self.lo.append(np.bitwise_and.reduceat(self.lo[-1], at))
            self.hi.append(np.bitwise_or.reduceat(self.hi[-1], at))
            self.first.append(self.first[-1][at])
            self.last.append(self.last[-1][np.minimum(at + FAN, n) - 1])
            n = len(at)

    @property
    def top(self) -> int:
        return len(self.lo) - 1

    def span(self, level: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First entry and number of entries of nodes."""
        size = FAN**level
        start = node * size
        return start, np.minimum(size, len(self.lo[0]) - start)

    def children(self, level: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start = node * FAN
        return start, np.minimum(FAN, len(self.lo[level - 1]) - start)


def search(x: GrayIndex, y: GrayIndex, k: int, forest: Forest, ids_x: np.ndarray, ids_y: np.ndarray) -> None:
    """Unite all entries of x and y of one group within k bits (x may be y)."""
    same, top = x is y, max(x.top, y.top)
    lx, ly = x.top, y.top
    a, b = (v.ravel() for v in np.meshgrid(np.arange(len(x.lo[lx])), np.arange(len(y.lo[ly])), indexing="ij"))
    stack = [(lx, ly, a, b, np.zeros(len(a), U64), np.zeros(len(a), np.uint8))]
    while stack:
        lx, ly, a, b, seen, acc = stack.pop()
        if len(a) > STEP:
            half = len(a) // 2
            stack.append((lx, ly, a[:half], b[:half], seen[:half], acc[:half]))
            stack.append((lx, ly, a[half:], b[half:], seen[half:], acc[half:]))
            continue
        keep = (x.last[lx][a] >= y.first[ly][b]) & (y.last[ly][b] >= x.first[lx][a])
        if same and lx == ly:
            keep &= a <= b
            if lx == 0:
                keep &= a != b
        a, b, seen, acc = a[keep], b[keep], seen[keep], acc[keep]
        # Bits that all entries of both nodes share, and the differences on the new ones.
        shared = ~((x.lo[lx][a] ^ x.hi[lx][a]) | (y.lo[ly][b] ^ y.hi[ly][b]))
        acc = acc + np.bitwise_count((x.lo[lx][a] ^ y.lo[ly][b]) & shared & ~seen)
        keep = acc <= k
        a, b, seen, acc = a[keep], b[keep], shared[keep], acc[keep]
        if not len(a):
            continue
        whole = (acc + np.bitwise_count(~seen) <= k) & (x.first[lx][a] == x.last[lx][a]) & (
            y.first[ly][b] == y.last[ly][b]) & (x.first[lx][a] == y.first[ly][b])
        if whole.any():
            (sa, na), (sb, nb) = x.span(lx, a[whole]), y.span(ly, b[whole])
            forest.unite(ids_x[np.repeat(sa, nb)], ids_y[ranges(sb, nb)])
            forest.unite(ids_x[ranges(sa, na)], ids_y[np.repeat(sb, na)])
        a, b, seen, acc = a[~whole], b[~whole], seen[~whole], acc[~whole]
        if not len(a) or lx == ly == 0:
            continue
        # Open the deeper side first, then both.
        if lx >= ly and lx > 0:
            s, n = x.children(lx, a)
            b, seen, acc, a = np.repeat(b, n), np.repeat(seen, n), np.repeat(acc, n), ranges(s, n)
            nx = lx - 1
        else:
            nx = lx
        if ly >= lx and ly > 0:
            s, n = y.children(ly, b)
            a, seen, acc, b = np.repeat(a, n), np.repeat(seen, n), np.repeat(acc, n), ranges(s, n)
            ny = ly - 1
        else:
            ny = ly
        stack.append((nx, ny, a, b, seen, acc))


EDGES = "a long, b long"
_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _forest_rows(values: np.ndarray, forest: Forest) -> dict:
    at = np.flatnonzero(forest.root != np.arange(len(values)))
    return {"a": values[at].view(np.int64), "b": values[forest.root[at]].view(np.int64)}


def _np_gray(x: np.ndarray) -> np.ndarray:
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> U64(s))
    return x


def _search_groups(k: int):
    """All routing groups of a partition: rows (table, key, fp)."""

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held)
        no, key, fp = (t.column(c).to_numpy() for c in ("no", "key", "fp"))
        fp = fp.view(U64)
        by = np.lexsort((_np_gray(fp), key, no))
        no, key, fp = no[by], key[by], fp[by]
        new = np.ones(len(fp), bool)
        new[1:] = (no[1:] != no[:-1]) | (key[1:] != key[:-1])
        group = np.cumsum(new) - 1
        keep = np.bincount(group)[group] > 1
        fp, group = fp[keep], group[keep]
        if not len(fp):
            return
        values, ids = np.unique(fp, return_inverse=True)
        forest = Forest(len(values))
        index = GrayIndex(fp, group)
        search(index, index, k, forest, ids, ids)
        yield pa.RecordBatch.from_pydict(_forest_rows(values, forest), schema=_EDGES)

    return run


def _cut_parts(size: int):
    """Rows of large groups, range-partitioned in Gray order, numbered in parts."""

    def run(batches):
        task, last, n, part = TaskContext.get().partitionId(), None, 0, -1
        for b in batches:
            no, key = b.column("no").to_numpy(), b.column("key").to_numpy()
            out = np.zeros(len(no), np.int64)
            for i in range(len(no)):
                here = (no[i], key[i])
                if here != last or n >= size:
                    last, n, part = here, 0, part + 1
                n += 1
                out[i] = task * 2**32 + part
            yield pa.RecordBatch.from_arrays([b.column("no"), b.column("key"), b.column("fp"), pa.array(out)],
                                             names=["no", "key", "fp", "part"])

    return run


def _search_pair(k: int):
    def run(_key, left: pa.Table, right: pa.Table) -> pa.Table:
        x = np.sort(_np_gray(left.column("fp").to_numpy().view(U64)))
        y = np.sort(_np_gray(right.column("fq").to_numpy().view(U64)))
        x, y = x ^ (x >> U64(1)), y ^ (y >> U64(1))  # Gray code of the rank: the fingerprint
        values, ids = np.unique(np.concatenate([x, y]), return_inverse=True)
        forest = Forest(len(values))
        search(GrayIndex(x, np.zeros(len(x), np.int64)), GrayIndex(y, np.zeros(len(y), np.int64)), k, forest,
               ids[:len(x)], ids[len(x):])
        return pa.Table.from_pydict(_forest_rows(values, forest), schema=_EDGES)

    return run


def links(fps: DataFrame, k: int = 3, part_rows: int = PART_ROWS) -> DataFrame:
    """A forest ``(a, b)`` whose components are those of all links at k or fewer
    differing bits; ``fps`` has distinct non-null ``fp``."""
    spark = fps.sparkSession
    n = partitions(spark)
    routes = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("no"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
        for i, m in enumerate(block_masks(k))])).alias("r")).select("r.no", "r.key", "fp")
    large = written(routes.groupBy("no", "key").count().where(F.col("count") > part_rows).select("no", "key"), "large")
    if large.isEmpty():
        return routes.repartition(n, "no", "key").mapInArrow(_search_groups(k), EDGES)
    small = routes.join(large, ["no", "key"], "left_anti")
    out = small.repartition(n, "no", "key").mapInArrow(_search_groups(k), EDGES)
    rows = routes.join(large, ["no", "key"], "left_semi").withColumn("g", gray_rank(F.col("fp")).bitwiseXOR(F.lit(-2**63)))
    parts = written(rows.repartitionByRange(n, "no", "key", "g").sortWithinPartitions("no", "key", "g")
                    .select("no", "key", "fp").mapInArrow(_cut_parts(part_rows), "no int, key long, fp long, part long"),
                    "parts")
    top = parts.groupBy("no", "key", "part").agg(F.bit_and("fp").alias("lo"), F.bit_or("fp").alias("hi"))
    a, b = top.alias("a"), top.alias("b")
    free = F.col("a.lo").bitwiseXOR(F.col("a.hi")).bitwiseOR(F.col("b.lo").bitwiseXOR(F.col("b.hi")))
    apart = F.bit_count(F.col("a.lo").bitwiseXOR(F.col("b.lo")).bitwiseAND(F.bitwise_not(free)))
    pairs = written(a.join(b, (F.col("a.no") == F.col("b.no")) & (F.col("a.key") == F.col("b.key"))
                           & (F.col("a.part") <= F.col("b.part")) & (apart <= k)).select(
        F.col("a.part").alias("pa"), F.col("b.part").alias("pb")), "pairs")
    left = pairs.join(parts, F.col("pa") == F.col("part")).select("pa", "pb", "fp")
    right = pairs.join(parts, F.col("pb") == F.col("part")).select(
        F.col("pa").alias("qa"), F.col("pb").alias("qb"), F.col("fp").alias("fq"))
    return out.unionByName(left.groupBy("pa", "pb").cogroup(right.groupBy("qa", "qb")).applyInArrow(
        _search_pair(k), EDGES))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    k: int = 3, part_rows: int = PART_ROWS) -> DataFrame:
    """``docs`` without its text, plus ``fp``, ``component_id`` (the smallest id
    reachable over links of at most ``k`` differing bits, itself included) and
    ``component_fp`` (a fingerprint that names the component)."""
    docs = docs.select(*[c for c in docs.columns if c not in ("fp", "component_id", "component_fp")])
    marked = written(with_fingerprint(docs, text_col, shingle), "fps")
    entries = marked.groupBy("fp").agg(F.min(order_key(id_col)).alias("least"))
    comp = connected_components(links(entries.select("fp"), k, part_rows))
    classes = entries.join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    least = classes.groupBy("root").agg(F.min("least").alias("class_least"))
    by_fp = classes.join(least, "root").select(
        "fp", F.when(F.col("class_least") < 2**63 - 1, F.col("class_least")).alias("component_id"),
        F.col("root").alias("component_fp"))
    return marked.join(written(by_fp, "classes"), "fp").select(*marked.columns, "component_id", "component_fp")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                k: int = 3) -> DataFrame:
    """``docs`` with one row of every component: that of the smallest id (of
    equal ids, the one with the smallest hash of the row)."""
    names = docs.columns
    keyed = docs.withColumns({"_sh_ord": order_key(id_col), "_sh_row": F.xxhash64(*names)})
    classes = near_duplicates(keyed.select(id_col, text_col, "_sh_ord", "_sh_row"), id_col, text_col, shingle, k)
    first = classes.groupBy("component_fp").agg(F.min(F.struct("_sh_ord", "_sh_row")).alias("f")).select(
        F.col("f._sh_ord").alias("_sh_ord"), F.col("f._sh_row").alias("_sh_row"))
    return keyed.join(first, ["_sh_ord", "_sh_row"], "left_semi").dropDuplicates(["_sh_ord", "_sh_row"]).select(*names)
