"""MinHash near-duplicates by a chosen-path similarity join, confirmed on full sets.

Sets: a text is lower-cased (A-Z only) and split at ASCII white space; its set is that
of its distinct ``shingle``-word runs (64-bit hashes; with fewer words the whole sequence
is one).  Texts with equal sets are one class, and only classes are compared.

Candidates: a class has ``HASHES`` minwise tokens.  Each of several independent trees
branches recursively: a node chooses coordinates at random (``RATE / threshold`` of them
on average) and a class goes on to the children named by its tokens there, so two
classes share a child more likely than not at every level if they are similar.
Children are numbered in a table and met by one shuffle per level.  A node of one class
ends; up to ``SMALL`` classes are compared exhaustively by sketches (8 bits of each
token); a larger node first compares a pivot with all its classes, then branches on.
Candidates only have to join what may belong together: their components are the
families.  So a node whose classes are all of one kin, joined by a pivot above it, ends
too, and a large group of copies is settled at the first level.  At the last level what
is left of a large node is held together.  ``TREES`` trees bring the chance that a pair
at the threshold meets in none below one in a hundred thousand (exp(-TREES * RATE)).

Confirmation: families are compared on full sets.  A family that fits a task is done by
one: a set's intersections with all others are counted at once, and sets that are already
joined are not compared again.  A larger family is first compared with pivots, row by row;
then it is cut into parts, and pairs of parts are compared as tasks of two parts each,
without those whose sizes rule a link out or that a pivot has joined.

Defined cases: null and empty texts and texts without words have an empty set and are
linked with nothing; a null id counts as larger than all others; repeated rows each get
a row; an empty table gives an empty table; further columns are kept, but input columns
named like outputs are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.llm.arrays import GOLD, U64, hash_runs, mix64, ranges, runs_of, starts_of, utf8
from gleaner.llm.common import connected_components, order_key, partitions, small_batches, written
from gleaner.llm.simhash import Forest

HASHES, TREES, RATE, LEVELS = 64, 6, 2.0, 3
#: Classes of a node that are compared exhaustively.
SMALL = 64
#: Shingles of a family, or of a part of one, that a task holds at most, and that it may
#: hold however small the table is; pivots of a large family.
PART, LEAST_PART, PIVOTS = 1 << 19, 1 << 14, 3
#: Bits of the filter that finds the rows of families, at most.
FILTER_BITS = 1 << 27
STEP = 1 << 18  # pairs of sketches compared at once

_TIMES = mix64(np.arange(1, HASHES + 1, dtype=U64) * GOLD) | U64(1)
_PLACE_SEEDS = np.arange(1, HASHES + 1, dtype=U64) * GOLD
_PLACES = mix64(np.arange(101, 118, dtype=U64) * GOLD) | U64(1)
_BYTE = mix64(np.arange(1, 257, dtype=U64))
_BYTE[65:91] = _BYTE[97:123]
_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True


def _word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of words, about a megabyte at a time."""
    out, i = np.empty(len(start), U64), 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + (1 << 20))))
        a = start[i]
        out[i:j] = hash_runs(_BYTE[data[a:end[j - 1]]], start[i:j] - a, end[i:j] - a)
        i = j
    return out


def shingle_sets(texts: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the sorted distinct shingles of each text."""
    data, off = utf8(texts)
    start, end = runs_of(~_GAP[data], off)
    word = _word_hashes(data, start, end)
    first = np.searchsorted(start, off)  # words of text i: first[i] .. first[i + 1]
    sets = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        w, n = word[a:b], max(1, b - a - shingle + 1)
        if not len(w):
            sets.append(w)
            continue
        used = min(shingle, len(w))
        h = np.full(n, U64(used), U64)
        for d in range(used):
            h += w[d:d + n] * _PLACES[d % len(_PLACES)] * U64(2 * (d // len(_PLACES)) + 1)
        sets.append(np.unique(mix64(h)))
    return (np.concatenate(sets) if sets else np.zeros(0, U64)), starts_of(np.array([len(s) for s in sets], np.int64))


def minwise(h: np.ndarray, off: np.ndarray) -> np.ndarray:
    """HASHES minwise tokens (32 bits) of each non-empty set; zeros for empty ones."""
    out = np.zeros((len(off) - 1, HASHES), np.uint32)
    some = np.flatnonzero(np.diff(off))
    if len(some):
        at = off[some]
        for i in range(HASHES):
            out[some, i] = np.minimum.reduceat(h * _TIMES[i], at) >> U64(32)
    return out


def _rows(a: np.ndarray) -> pa.Array:
    """The lines of a matrix as binary values."""
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(a.itemsize * a.shape[1]), len(a),
                                                [None, pa.py_buffer(np.ascontiguousarray(a))]).cast(pa.binary())


def _lines(col, dtype, width: int) -> np.ndarray:
    data, _ = utf8(col)
    return data.view(dtype).reshape(-1, width)


def _describe(fields: list, shingle: int):
    names = [f.name for f in fields]

    def run(batches):
        for b in batches:
            h, off = shingle_sets(b.column("_cp_text"), shingle)
            sums = [np.concatenate([[U64(0)], np.cumsum(mix64(h + U64(k)))]) for k in (1, 2)]
            digest = [pa.array((s[off[1:]] - s[off[:-1]]).view(np.int64)) for s in sums]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in names), pa.array(np.diff(off)), *digest, _rows(minwise(h, off))],
                names=[*names, "_cp_n", "_cp_d1", "_cp_d2", "_cp_sig"])

    return run


def _branch(trees: int, chance: float):
    """Children (node, c, kin) of rows (c, kin, sig), which start in the roots,
    or (node, c, kin, sig)."""
    bound = U64(min(chance, 1.0) * (2**64 - 1024))
    roots = mix64(np.arange(1, trees + 1, dtype=U64) * GOLD)

    def run(batches):
        for b in batches:
            sig, c, kin = _lines(b.column("sig"), np.uint32, HASHES).astype(U64), b.column("c"), b.column("kin")
            starts = ([b.column("node").to_numpy().view(U64)] if "node" in b.schema.names
                      else [np.full(len(sig), root) for root in roots])
            for node in starts:  # one batch of children each, not one a coordinate
                go, i = np.nonzero(mix64(node[:, None] + _PLACE_SEEDS) < bound)
                if len(go):
                    child, at = mix64(mix64(node[go] ^ _TIMES[i]) + sig[go, i]), pa.array(go)
                    yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), c.take(at), kin.take(at)],
                                                     names=["node", "c", "kin"])

    return run


def _sketches(batches):
    """Rows with the lowest byte of each token of their ``sig``: the sketch."""
    for b in batches:
        low = _lines(b.column("sig"), np.uint32, HASHES).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([*b.columns, _rows(low)], names=[*b.schema.names, "sketch"])


LINKS = "a long, b long"
_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _forest(c: np.ndarray, forest: Forest) -> pa.RecordBatch:
    at = np.flatnonzero(forest.root != np.arange(len(c)))
    return pa.RecordBatch.from_arrays([pa.array(c[at]), pa.array(c[forest.root[at]])], schema=_LINKS)


def _runs_in_order(batches, key: str, rows: int):
    """Tables of about ``rows`` rows that end with the end of a key's run (input sorted by key)."""
    held, size = [], 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        size += b.num_rows
        if size < rows:
            continue
        t = pa.Table.from_batches(held)
        k = t.column(key).to_numpy()
        cut = int(np.searchsorted(k, k[-1]))
        if cut:
            yield t.slice(0, cut).combine_chunks()
            held, size = t.slice(cut).combine_chunks().to_batches(), t.num_rows - cut
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _compare_small(least: int):
    """Links of rows (node, c, sketch), sorted by node, within their nodes."""

    def run(batches):
        for t in _runs_in_order(batches, "node", 1 << 15):
            node, c = t.column("node").to_numpy(), t.column("c").to_numpy()
            sketch = _lines(t.column("sketch"), np.uint8, HASHES)
            values, ids = np.unique(c, return_inverse=True)
            forest = Forest(len(values))
            end = np.searchsorted(node, node, "right")
            n = end - np.arange(len(node)) - 1  # partners behind each row
            upto = np.cumsum(n)
            i = 0
            while i < len(n):
                j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + STEP)))
                x, y = np.repeat(np.arange(i, j), n[i:j]), ranges(np.arange(i, j) + 1, n[i:j])
                alike = (sketch[x] == sketch[y]).sum(axis=1) >= least
                if alike.any():
                    forest.unite(ids[x[alike]], ids[y[alike]])
                i = j
            yield _forest(values, forest)

    return run


def _matches(batches):
    """Matching places of the sketches of rows (node, c, kin, sketch, pivot, pivot_kin, pivot_sketch)."""
    names = ["node", "c", "kin", "pivot", "pivot_kin"]
    for b in batches:
        same = (_lines(b.column("sketch"), np.uint8, HASHES) == _lines(b.column("pivot_sketch"), np.uint8, HASHES)).sum(axis=1)
        yield pa.RecordBatch.from_arrays([*(b.column(k) for k in names), pa.array(same)], names=[*names, "same"])


def _families(classes: DataFrame, percent: int, trees: int, small: int) -> DataFrame:
    """``(node, root)``: the family of each class (c, sig, sketch) that may have a link."""
    n, j = partitions(classes.sparkSession), percent / 100
    least = int(HASHES * j - 5 * (HASHES * j * (1 - j)) ** 0.5)
    chance = RATE / j / HASHES
    sketches = classes.select("c", "sketch")
    rows = written(classes.select("c", F.col("c").alias("kin"), "sig").mapInArrow(_branch(trees, chance), "node long, c long, kin long"), "children")
    links = []
    for level in range(1, LEVELS + 1):
        sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.min("kin").alias("k1"), F.max("kin").alias("k2"),
                                         F.min(F.struct(F.xxhash64("node", "c"), "c", "kin")).alias("p"))
        sizes = sizes.where("k1 < k2").select("node", "size", F.col("p.c").alias("pivot"), F.col("p.kin").alias("pivot_kin"))
        met = written(rows.join(sizes, "node"), "nodes")
        little = met.where(F.col("size") <= small).select("node", "c").join(sketches, "c").select("node", "c", "sketch")
        links.append(written(little.repartition(n, "node").sortWithinPartitions("node").mapInArrow(
            _compare_small(least), LINKS), "links"))
        large = met.where(F.col("size") > small).drop("size")
        if large.isEmpty():
            break
        heads = large.select("pivot").distinct().join(sketches.withColumnsRenamed(
            {"c": "pivot", "sketch": "pivot_sketch"}), "pivot")
        seen = written(large.join(sketches, "c").join(heads, "pivot").select(
            "node", "c", "kin", "sketch", "pivot", "pivot_kin", "pivot_sketch").mapInArrow(
            _matches, "node long, c long, kin long, pivot long, pivot_kin long, same long"), "seen")
        near = F.col("same") >= least
        links.append(seen.where(near if level < LEVELS else F.lit(True)).select(
            F.col("c").alias("a"), F.col("pivot").alias("b")).distinct())
        if level < LEVELS:
            rest = seen.select("node", "c", F.when(near, F.col("pivot_kin")).otherwise(F.col("kin")).alias("kin"))
            rows = written(rest.join(classes.select("c", "sig"), "c").select("node", "c", "kin", "sig").mapInArrow(
                _branch(trees, chance), "node long, c long, kin long"), "children")
    edges = links[0]
    for more in links[1:]:
        edges = edges.unionByName(more)
    return written(connected_components(edges), "families")


class Sets:
    """Full sets of some classes, coded so that intersections are counted by lookup."""

    def __init__(self, blobs, percent: int) -> None:
        h, off = utf8(blobs)
        self.off, self.percent = off // 8, percent
        values, self.ids = np.unique(h.view(U64), return_inverse=True)
        self.size, self.flag = np.diff(self.off), np.zeros(len(values), bool)

    def linked(self, i: int, others: np.ndarray) -> np.ndarray:
        """Those of ``others`` whose set is similar enough to set i."""
        n = self.size[others]
        fit = (100 * np.minimum(n, self.size[i]) >= self.percent * np.maximum(n, self.size[i])) & (n > 0)
        others, n = others[fit], n[fit]
        if not len(others) or not self.size[i]:
            return others[:0]
        own = self.ids[self.off[i]:self.off[i + 1]]
        self.flag[own] = True
        got = np.add.reduceat(self.flag[self.ids[ranges(self.off[others], n)]], starts_of(n)[:-1], dtype=np.int64)
        self.flag[own] = False
        return others[100 * got >= self.percent * (n + self.size[i] - got)]


def join_sets(sets: Sets, forest: Forest, left: np.ndarray, right: np.ndarray | None = None) -> None:
    """Unite all linked sets of ``left`` (or of left with right) that are not united yet."""
    if right is not None:
        few, many = (left, right) if len(left) <= len(right) else (right, left)
        for i in few.tolist():
            hit = sets.linked(i, many[forest.root[many] != forest.root[i]])
            if len(hit):
                forest.unite(np.full(len(hit), i), hit)
        return
    todo = np.ones(len(left), bool)
    while True:
        # Only sets outside the largest component need to be compared with all others.
        roots = forest.root[left]
        values, counts = np.unique(roots, return_counts=True)
        if len(values) == 1:
            return
        open_ = np.flatnonzero(todo & (roots != values[counts.argmax()])) if not todo.all() else np.array([0])
        if not len(open_):
            return
        at = int(open_[0])
        todo[at] = False
        hit = sets.linked(int(left[at]), left[roots != roots[at]])
        if len(hit):
            forest.unite(np.full(len(hit), left[at]), hit)


def _confirm_families(percent: int):
    """Links within whole families: rows (family, c, shingles), sorted by family."""

    def run(batches):
        for t in _runs_in_order(batches, "family", 1 << 10):
            family, c = t.column("family").to_numpy(), t.column("c").to_numpy()
            cuts = np.flatnonzero(np.append(True, family[1:] != family[:-1]))
            for a, b in zip(cuts.tolist(), np.append(cuts[1:], len(family)).tolist()):
                forest = Forest(b - a)
                join_sets(Sets(t.column("shingles").slice(a, b - a), percent), forest, np.arange(b - a))
                yield _forest(c[a:b], forest)

    return run


def _confirm_pivot(percent: int):
    """Which rows (family, c, shingles, pivot, pivot_shingles) are linked to their pivot."""

    def run(batches):
        for b in batches:
            hit = []
            for x, y in zip(b.column("shingles"), b.column("pivot_shingles")):
                x, y = (np.frombuffer(v.as_py(), U64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                hit.append(100 * both >= percent * (len(x) + len(y) - both))
            at = np.flatnonzero(hit)
            yield pa.RecordBatch.from_arrays([b.column(k).take(pa.array(at)) for k in ("family", "c", "pivot")],
                                             names=["family", "c", "pivot"])

    return run


def _cut_parts(size: int):
    """Rows (family, kin, n, c) in order get the number of a part that they fill up to ``size``."""

    def run(batches):
        from pyspark import TaskContext

        task, last, held, part = TaskContext.get().partitionId(), None, 0, -1
        for b in batches:
            out = []
            for family, kin, n in zip(*(b.column(k).to_pylist() for k in ("family", "kin", "n"))):
                if (family, kin) != last or held + n > size:
                    last, held, part = (family, kin), 0, part + 1
                held += n
                out.append(task * 2**32 + part)
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in ("family", "kin", "n", "c")), pa.array(out, pa.int64())],
                                             names=["family", "kin", "n", "c", "part"])

    return run


def _confirm_parts(percent: int):
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        own = key[0].as_py() == key[1].as_py()
        t = left if own else pa.concat_tables([left, right.rename_columns(left.column_names)])
        forest, kin = Forest(t.num_rows), t.column("kin").to_numpy()
        values, same = np.unique(kin, return_inverse=True)
        for v in np.flatnonzero(values >= 0):  # joined by a pivot before
            at = np.flatnonzero(same == v)
            forest.unite(np.full(len(at), at[0]), at)
        n = left.num_rows
        join_sets(Sets(t.column("shingles"), percent), forest, np.arange(n), None if own else np.arange(n, t.num_rows))
        return pa.Table.from_batches([_forest(t.column("c").to_numpy(), forest)])

    return run


def _confirm_large(sets: DataFrame, percent: int, part_rows: int) -> list[DataFrame]:
    """Links of families beyond one task: pivots first, then pairs of parts."""
    spark = sets.sparkSession
    links, kin = [], sets.select("family", "c", "n", F.lit(-1).cast("long").alias("kin"))
    for k in range(PIVOTS):
        loose = kin.where("kin = -1")
        heads = loose.groupBy("family").agg(F.min(F.struct(F.xxhash64("c", F.lit(k)), "c")).alias("p")).select(
            "family", F.col("p.c").alias("pivot"))
        heads = heads.join(sets.select(F.col("c").alias("pivot"), F.col("shingles").alias("pivot_shingles")), "pivot")
        near = written(sets.join(heads, "family").select("family", "c", "shingles", "pivot", "pivot_shingles").mapInArrow(
            _confirm_pivot(percent), "family long, c long, pivot long"), "pivots")
        links.append(near.select(F.col("c").alias("a"), F.col("pivot").alias("b")))
        kin = written(kin.join(near.select("c", "pivot"), "c", "left").select(
            "family", "c", "n", F.when(F.col("kin") >= 0, F.col("kin")).otherwise(F.coalesce("pivot", F.lit(-1))).alias("kin")), "kin")
    n = partitions(spark)
    parts = written(kin.select("family", "kin", "n", "c").repartitionByRange(n, "family", "kin", "n", "c").sortWithinPartitions(
        "family", "kin", "n", "c").mapInArrow(_cut_parts(part_rows), "family long, kin long, n long, c long, part long"), "parts")
    held = written(parts.join(sets.select("c", "shingles"), "c").select("part", "c", "kin", "shingles"), "held")
    tops = written(parts.groupBy("family", "kin", "part").agg(F.min("n").alias("lo"), F.max("n").alias("hi")), "tops")
    a, b = tops.alias("a"), tops.alias("b")
    open_ = (F.col("a.part") <= F.col("b.part")) & ((F.col("a.kin") != F.col("b.kin")) | (F.col("a.kin") == -1))
    near = (F.col("a.hi") * 100 >= F.col("b.lo") * percent) & (F.col("b.hi") * 100 >= F.col("a.lo") * percent)
    pairs = written(a.join(b, (F.col("a.family") == F.col("b.family")) & open_ & near).select(
        F.col("a.part").alias("pa"), F.col("b.part").alias("pb")), "pairs")
    side = lambda own, x, y: pairs.join(held.withColumnRenamed("part", own), own).select(
        F.col("pa").alias(x), F.col("pb").alias(y), F.col("c").alias(f"c{x}"), F.col("kin").alias(f"kin{x}"),
        F.col("shingles").alias(f"shingles{x}"))
    left, right = side("pa", "xa", "xb"), side("pb", "ya", "yb")
    names = {"cxa": "c", "kinxa": "kin", "shinglesxa": "shingles"}
    links.append(left.withColumnsRenamed(names).groupBy("xa", "xb").cogroup(right.groupBy("ya", "yb")).applyInArrow(
        _confirm_parts(percent), LINKS))
    return links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 85,
                    trees: int = TREES, small: int = SMALL, part: int = PART) -> DataFrame:
    """``docs`` without its text, plus ``n_shingles``, ``component_id`` (the smallest id
    reachable over links, itself included) and ``kept`` (whether that is the row's own).

    Two sets are linked where 100 * intersection >= ``percent`` * union."""
    spark = docs.sparkSession
    small_batches(spark)
    outputs = ("n_shingles", "component_id", "kept")
    names = [c for c in docs.columns if c not in (text_col, *outputs)]
    keyed = docs.select(*names, F.col(text_col).cast("string").alias("_cp_text"), order_key(id_col).alias("_cp_ord"),
                        F.xxhash64(F.col(text_col).cast("string")).alias("_cp_t"))
    fields = [f for f in keyed.schema.fields if f.name != "_cp_text"]
    schema = T.StructType([*fields, *(T.StructField(c, T.LongType()) for c in ("_cp_n", "_cp_d1", "_cp_d2")),
                           T.StructField("_cp_sig", T.BinaryType())])
    marked = written(keyed.mapInArrow(_describe(fields, shingle), schema), "sets")
    by = ["_cp_d1", "_cp_d2", "_cp_n"]
    classes = written(marked.where("_cp_n > 0").groupBy(*by).agg(
        F.min(F.struct("_cp_ord", "_cp_t")).alias("first"), F.first("_cp_sig").alias("sig")).select(
        F.monotonically_increasing_id().alias("c"), *by, "first.*", "sig").mapInArrow(
        _sketches, "c long, _cp_d1 long, _cp_d2 long, _cp_n long, _cp_ord long, _cp_t long, sig binary, sketch binary"), "classes")

    families = _families(classes, percent, trees, small).select(F.col("node").alias("c"), F.col("root").alias("family"))
    members = families.unionByName(families.select(F.col("family").alias("c"), "family").distinct()).distinct()
    members = written(members.join(classes.select("c", F.col("_cp_n").alias("n"), "_cp_ord", "_cp_t"), "c"), "members")
    sizes = written(members.groupBy("family").agg(F.sum("n").alias("total")), "sizes")
    members = written(members.join(sizes, "family"), "members")
    whole = sizes.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    held = min(part, max(LEAST_PART, whole // (2 * partitions(spark)))) if part == PART else part
    # Only rows that a bounded filter lets through are shingled again and shuffled.
    bits = min(FILTER_BITS, 1 << max(15, 3 + members.count().bit_length()))
    place = F.pmod(F.xxhash64("_cp_ord", "_cp_t"), F.lit(bits))
    known = spark.sparkContext.broadcast(_filter(members.select(place.alias("bit")), bits))
    texts = keyed.select("_cp_ord", "_cp_t", place.alias("bit"), "_cp_text")
    sets = texts.mapInArrow(_full_sets(shingle, known), "_cp_ord long, _cp_t long, shingles binary")
    # A row that occurs several times stands for its class once; repeats go before the shuffle.
    sets = written(sets.dropDuplicates(["_cp_ord", "_cp_t"]).join(members, ["_cp_ord", "_cp_t"]).select(
        "family", "c", "n", "shingles", "total"), "full")
    known.destroy()
    little = sets.where(F.col("total") <= held)
    links = [little.select("family", "c", "shingles").repartition(partitions(spark), "family").sortWithinPartitions(
        "family").mapInArrow(_confirm_families(percent), LINKS)]
    large = sets.where(F.col("total") > held).drop("total")
    if not large.isEmpty():
        links += _confirm_large(large, percent, held)
    confirmed = links[0]
    for more in links[1:]:
        confirmed = confirmed.unionByName(more)
    comp = connected_components(written(confirmed, "confirmed")).withColumnsRenamed({"node": "c"})
    rooted = classes.select("c", *by, "_cp_ord").join(comp, "c", "left").withColumn("root", F.coalesce("root", "c"))
    least = rooted.groupBy("root").agg(F.min("_cp_ord").alias("_cp_least"))
    named = written(rooted.join(least, "root").select(*by, "_cp_least"), "named")
    own = F.coalesce("_cp_least", "_cp_ord")
    return marked.join(named, by, "left").select(
        *names, F.col("_cp_n").alias("n_shingles"), F.when(own < 2**63 - 1, own).alias("component_id"),
        (own == F.col("_cp_ord")).alias("kept"))


def _filter(places: DataFrame, bits: int) -> np.ndarray:
    """The set bits of ``places(bit)``, as bytes; at most ``bits`` of them reach the driver."""
    maps = places.groupBy(F.expr("bit div 32768").alias("no")).agg(
        F.call_function("bitmap_construct_agg", F.pmod("bit", F.lit(32768))).alias("bits")).collect()
    out = np.zeros(bits // 8, np.uint8)
    for r in maps:
        out[4096 * r["no"]:4096 * (r["no"] + 1)] = np.frombuffer(r["bits"], np.uint8)
    return out


def _full_sets(shingle: int, known):
    def run(batches):
        for b in batches:
            bit = b.column("bit").to_numpy()
            at = pa.array(np.flatnonzero(known.value[bit >> 3] >> (bit & 7).astype(np.uint8) & 1))
            h, off = shingle_sets(b.column("_cp_text").take(at), shingle)
            blobs = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(off * 8), pa.py_buffer(h)])
            yield pa.RecordBatch.from_arrays([b.column("_cp_ord").take(at), b.column("_cp_t").take(at), blobs.cast(pa.binary())],
                                             names=["_cp_ord", "_cp_t", "shingles"])

    return run
