"""Document fingerprints by locally consistent parsing.

A text is parsed into phrases, the phrases into larger phrases, and so on.  At
each level a run of one symbol counts as one symbol; deterministic coin tossing
then gives every symbol a small label from itself and its left neighbour (the
lowest bit in which they differ and its value there, applied again to the labels
until few are left), neighbours always differ, and phrases begin at local maxima
of the labels (and at local minima away from a maximum).  Where a phrase ends
therefore depends on a few symbols around it only, so equal substrings have equal
phrases inside, wherever they stand.  A phrase's name is a hash of its symbols.

The fingerprint keeps, for each of LEVELS, a one-permutation min-hash of the
names in BINS bins (one byte each, 0 for an empty bin).  The likeness of two
fingerprints estimates, per level, the share of names in common (Dice), averaged
over the levels: 1 for equal texts, near 0 for unrelated ones.

Defined cases: null text is empty; the fingerprint of an empty text is all zero,
alike (1) to another empty text and unlike (0) any other; documents are ordered
by descending id, null ids last, equal ids by descending text; a table of one
document is its own next; an empty table gives an empty table; columns named like
an output are replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.llm.arrays import GOLD, U64, hash_runs, mix64, starts_of
from gleaner.llm.common import partitions, small_batches

LEVELS = (2, 3, 4)
BINS = 64
#: Bytes parsed at once inside a task.
CHUNK = 1 << 20


def _toss(left: np.ndarray, own: np.ndarray) -> np.ndarray:
    """2 * (lowest differing bit) + own bit there, as a small integer."""
    d = left ^ own
    k = np.bitwise_count((d & (~d + U64(1))) - U64(1)).astype(U64)
    return (2 * k + ((own >> np.minimum(k, U64(63))) & U64(1))).astype(np.uint8)


_A, _B = (x.ravel().astype(U64) for x in np.meshgrid(np.arange(256), np.arange(256), indexing="ij"))
_TOSS = _toss(_A, _B)


def phrases(symbols: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level: (names of the phrases of all texts, their offsets)."""
    n = len(symbols)
    if n == 0:
        return np.zeros(0, U64), offsets
    begin = offsets[:-1][np.diff(offsets) > 0]
    head = np.ones(n, bool)
    head[1:] = symbols[1:] != symbols[:-1]
    head[begin] = True
    at = np.flatnonzero(head)
    run = np.diff(np.append(at, n))
    sym = symbols[at]
    offsets = np.searchsorted(at, offsets)
    begin = offsets[:-1][np.diff(offsets) > 0]
    if sym.dtype == np.uint8:
        label = np.empty(len(sym), np.uint8)
        label[1:] = _TOSS[(sym[:-1].astype(np.int32) << 8) + sym[1:]]
        values = mix64(sym.astype(U64) + U64(1))
    else:
        label = np.empty(len(sym), np.uint8)
        label[1:] = _toss(sym[:-1], sym[1:])
        values = sym
    label[begin] = 2 * 63 + 1
    for _ in range(2):
        again = np.empty_like(label)
        again[1:] = _TOSS[(label[:-1].astype(np.int32) << 8) + label[1:]]
        again[begin] = 15
        label = again
    # Neighbours outside the text are larger than any label.
    last = offsets[1:][np.diff(offsets) > 0] - 1
    up = np.empty(len(label), bool)
    up[1:] = label[1:] > label[:-1]
    up[begin] = False
    down = np.empty(len(label), bool)
    down[:-1] = label[:-1] > label[1:]
    down[last] = False
    top = up & down
    low = ~up & ~down
    low[begin] = low[last] = False
    low[1:] &= ~top[:-1]
    low[:-1] &= ~top[1:]
    cut = top | low
    cut[begin] = True
    start = np.flatnonzero(cut)
    end = np.append(start[1:], len(label))
    many = run > 1
    values[many] = mix64(values[many] + run[many].astype(U64) * GOLD)
    return hash_runs(values, start, end), np.searchsorted(start, offsets)


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """A row of len(LEVELS) * BINS bytes for every text."""
    out = np.zeros((len(texts), len(LEVELS), BINS), np.uint8)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    at = 0
    while at < len(texts):
        total, to = 0, at
        while to < len(texts) and (to == at or total + size[to] <= CHUNK):
            total += size[to]
            to += 1
        symbols = np.frombuffer(b"".join(texts[at:to]), np.uint8)
        offsets = starts_of(size[at:to])
        for level in range(1, max(LEVELS) + 1):
            symbols, offsets = phrases(symbols, offsets)
            if level in LEVELS:
                h = mix64(symbols ^ U64(level))
                place = np.repeat(np.arange(to - at), np.diff(offsets)) * BINS + (h & U64(BINS - 1)).astype(np.int64)
                least = np.full((to - at) * BINS, U64(2**64 - 1))
                np.minimum.at(least, place, h >> U64(6))
                byte = (mix64(least) % U64(255) + U64(1)).astype(np.uint8)
                byte[least == U64(2**64 - 1)] = 0
                out[at:to, LEVELS.index(level)] = byte.reshape(-1, BINS)
        at = to
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """From 0 to 1 for each pair of rows of two fingerprint arrays."""
    both = (a > 0) | (b > 0)
    n = both.sum(axis=2)
    share = ((a == b) & both).sum(axis=2) / np.maximum(n, 1)
    share = np.clip((share - 1 / 255) / (1 - 1 / 255), 0, 1)
    dice = np.where(n > 0, 2 * share / (1 + share), 1.0)
    return dice.mean(axis=1)


def hexes(fp: np.ndarray) -> list[str]:
    return [r.tobytes().hex() for r in fp]


def from_hex(texts: list[str]) -> np.ndarray:
    return np.frombuffer(bytes.fromhex("".join(texts)), np.uint8).reshape(len(texts), len(LEVELS), BINS)


def with_fingerprint(docs: DataFrame, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of its text as a hex string."""
    small_batches(docs.sparkSession)
    docs = docs.select(*[c for c in docs.columns if c != out_col]).withColumn(
        text_col, F.col(text_col).cast("string"))
    schema = T.StructType([*docs.schema.fields, T.StructField(out_col, T.StringType())])

    def run(batches):
        for b in batches:
            fp = fingerprints([(t or "").encode() for t in b.column(text_col).to_pylist()])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(hexes(fp), pa.string())], names=schema.names)

    return docs.mapInArrow(run, schema)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, text, tail) so that sorted by ``part, tail, order`` each row is
    followed by its next document: rows that begin a part come again as the tail
    of the part before, the first of all as the tail of the last."""
    n_parts = 4 * partitions(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                      F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("ord"))
    # n_parts + 1 actual ids: the largest of every part.
    cuts = src.select(F.percentile_approx("ord", [i / n_parts for i in range(1, n_parts)], 100 * n_parts).alias("q"),
                      F.max("ord").alias("most")).first()
    ids = np.array(sorted({*(cuts["q"] or []), *([] if cuts["most"] is None else [cuts["most"]])}), np.int64)

    def run(batches):
        for b in batches:
            order = b.column("ord").to_numpy()
            part = np.searchsorted(ids, order, "left")  # ascending parts, descending order inside
            first = np.flatnonzero(ids[np.minimum(part, len(ids) - 1)] == order)
            before = (part[first] + 1) % len(ids)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(part), pa.array(np.zeros(len(order), np.int32))], names=names)
            if len(first):
                again = b.take(pa.array(first))
                yield pa.RecordBatch.from_arrays([*again.columns, pa.array(before), pa.array(np.ones(len(first), np.int32))], names=names)

    names = ["id", "text", "ord", "part", "tail"]
    small_batches(docs.sparkSession)
    return (src.mapInArrow(run, "id long, text string, ord long, part long, tail int")
            .repartition(partitions(docs.sparkSession), "part")
            .sortWithinPartitions("part", "tail", F.desc("ord"), F.desc("text")))


EDITED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()),
                       T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
                       T.StructField("edited_fingerprint", T.StringType()), T.StructField("near_edited", T.DoubleType()),
                       T.StructField("near_next", T.DoubleType())])
_EDITED = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                     ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
                     ("near_next", pa.float64())])


def half_swapped(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of another text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def edit_study(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of the text with its last half replaced by the
    start of the next document's, and their likenesses."""

    def rows(items):
        """items: (id, text, next text)."""
        texts = [t.encode() for _, t, _ in items]
        edited = [half_swapped(t, x).encode() for _, t, x in items]
        fp, fe = fingerprints(texts), fingerprints(edited)
        # The next text mostly is the next item's own, whose fingerprint is there already.
        fx = np.roll(fp, -1, axis=0)
        new = [k for k, (*_, x) in enumerate(items) if k + 1 == len(items) or x is not items[k + 1][1]]
        fx[new] = fingerprints([items[k][2].encode() for k in new])
        return pa.RecordBatch.from_arrays(
            [pa.array([i for i, *_ in items], pa.int64()), pa.array([len(t) for _, t, _ in items], pa.int64()),
             pa.array([hashlib.sha256(e).hexdigest() for e in edited]), pa.array(hexes(fp), pa.string()),
             pa.array(hexes(fe), pa.string()), pa.array(likeness(fp, fe)), pa.array(likeness(fp, fx))],
            schema=_EDITED)

    def run(batches):
        held = None  # the row that waits for its next: (part, id, text)
        out, size = [], 0
        for b in batches:
            for part, tail, i, text in zip(*(b.column(c).to_pylist() for c in ("part", "tail", "id", "text"))):
                if held is not None and held[0] == part:
                    out.append((held[1], held[2], text))
                    size += len(held[2])
                held = None if tail else (part, i, text)
                if size >= CHUNK:
                    yield rows(out)
                    out, size = [], 0
        if out:
            yield rows(out)

    return with_next(docs, id_col, text_col).mapInArrow(run, EDITED)
