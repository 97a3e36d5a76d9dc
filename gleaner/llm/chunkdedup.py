"""Substring dedup by content-defined chunks.

A gear rolling hash runs over the UTF-8 bytes; a chunk ends where the hash's top
``bits`` bits are zero, at least ``least`` bytes after the last cut, or after
``most`` bytes.  The hash depends on the last 32 bytes only, so cuts fall at the
same places in equal passages whatever stands before them: an insertion changes
the chunks around it and no others.

Chunks are known by a 128-bit digest of their bytes.  The end of a text may be
shorter than ``least`` bytes; it is known by the chunk before it and itself, so
that it goes only where both have occurred together, and a whole text below
``least`` only where a whole text repeats it.  Every digest is kept once,
where it occurs first (smallest document id, then place); all other chunks are
removed, in the same document as well.  Only the keepers are told: a digest that
a third of all documents share is reduced to its first place before and in the
shuffle, and nothing is joined back to its other places.  What a document keeps is
then found block of ids by block of ids.

Defined cases: null text is empty and has no chunks; a null id comes after all
ids; rows with equal ids are ordered by a hash of the text, and a repeated row
keeps nothing that its first copy has kept unless both are the very first, which
then share it (they are the same document twice); an empty table gives an empty
table; columns named like an output are replaced, others pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.llm.arrays import ranges, starts_of, utf8
from gleaner.llm.common import order_key, partitions, small_batches, written

BITS, LEAST, MOST = 5, 16, 512
#: Bytes hashed at once inside a task.
CHUNK = 1 << 20

# The gear table: 256 fixed random numbers from a seeded rule.
GEAR = np.random.RandomState(20240229).randint(0, 2**32, 256, dtype=np.uint64).astype(np.uint32)


def gear_hash(data: np.ndarray) -> np.ndarray:
    """h[i] = sum over j < 32 of GEAR[data[i - j]] << j, modulo 2**32."""
    h = GEAR[data]
    width = 1
    while width < 32 and width < len(h):
        step = h.copy()
        step[width:] += h[:-width] << np.uint32(width)
        h, width = step, width * 2
    return h


def cuts(data: np.ndarray, offsets: np.ndarray, bits: int = BITS, least: int = LEAST,
         most: int = MOST) -> tuple[np.ndarray, np.ndarray]:
    """(end of every chunk, chunks of every text); hashes start anew in each text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    may = (gear_hash(data) >> np.uint32(32 - bits)) == 0
    # The first 31 hashes of a text would depend on the text before it.
    head = offsets[:-1]
    may[ranges(head, np.minimum(np.diff(offsets), max(31, least - 1)))] = False
    places = (np.flatnonzero(may) + 1).tolist()
    out, n, k = [], [], 0
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        first, last = len(out), a
        while k < len(places) and places[k] <= b:
            p = places[k]
            k += 1
            if p - last >= least:
                while p - last > most:
                    last += most
                    out.append(last)
                if p - last >= least:
                    out.append(p)
                    last = p
        while b - last > most:
            last += most
            out.append(last)
        if last < b:
            out.append(b)
        n.append(len(out) - first)
    return np.asarray(out, np.int64), np.asarray(n, np.int64)


def _groups(batch: pa.RecordBatch, offsets: np.ndarray):
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, "right")) - 1)
        yield at, min(to, batch.num_rows)
        at = to


PLACES = "hi long, lo long, ord long, tag long, place long"
_PLACES = ["hi", "lo", "ord", "tag", "place"]


def _spans(begin: np.ndarray, end: np.ndarray, n: np.ndarray, least: int) -> np.ndarray:
    """Where the bytes begin by which every chunk is known: a last chunk below
    ``least`` takes the one before it along."""
    out, first = begin.copy(), starts_of(n)
    last = first[1:][n > 1] - 1
    short = last[end[last] - begin[last] < least]
    out[short] = begin[short - 1]
    return out


def _digests(bits, least, most):
    def run(batches):
        for b in batches:
            data, offsets = utf8(b.column("text"))
            order, tag = b.column("ord"), b.column("tag")
            for at, to in _groups(b, offsets):
                part, off = data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
                end, n = cuts(part, off, bits, least, most)
                raw = part.tobytes()
                begin = np.concatenate([[0], end[:-1]]) if len(end) else end
                known = _spans(begin, end, n, least)
                digest = xxhash.xxh3_128_digest
                both = np.frombuffer(b"".join([digest(raw[x:y]) for x, y in zip(known.tolist(), end.tolist())]),
                                     ">i8").reshape(-1, 2).astype(np.int64)
                both[known < begin, 0] ^= 1  # not the digest of a chunk with the same bytes
                doc = np.repeat(np.arange(at, to), n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(both[:, 0]), pa.array(both[:, 1]), order.take(pa.array(doc)), tag.take(pa.array(doc)),
                     pa.array(ranges(np.zeros(len(n), np.int64), n))], names=_PLACES)

    return run


OUT = [T.StructField("n_bytes", T.LongType()), T.StructField("n_chunks", T.LongType()),
       T.StructField("n_removed_chunks", T.LongType()), T.StructField("n_removed", T.LongType()),
       T.StructField("kept", T.BinaryType())]


def _cut(fields, text_col, bits, least, most):
    def run(_key, docs: pa.Table, keeps: pa.Table) -> pa.Table:
        data, offsets = utf8(docs.column(text_col))
        end, n = cuts(data, offsets, bits, least, most)
        first = starts_of(n)
        begin = np.concatenate([[0], end[:-1]]) if len(end) else end
        mine: dict[tuple[int, int], list[int]] = {}
        for i, key in enumerate(zip(docs.column("_cd_ord").to_pylist(), docs.column("_cd_tag").to_pylist())):
            mine.setdefault(key, []).append(i)
        kept = np.zeros(len(end), bool)
        for o, t, places in zip(*(keeps.column(c).to_pylist() for c in ("ord", "tag", "places"))):
            for i in mine.get((o, t), ()):
                kept[first[i] + np.asarray(places, np.int64)] = True
        size = end - begin
        left = data[ranges(begin[kept], size[kept])]
        before = starts_of(np.where(kept, size, 0))
        at = before[first]
        col = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(at.tobytes()),
                                                                            pa.py_buffer(left.tobytes())])
        n_kept = starts_of(kept)[first]
        out = {"n_bytes": pa.array(np.diff(offsets)), "n_chunks": pa.array(n),
               "n_removed_chunks": pa.array(n - np.diff(n_kept)), "n_removed": pa.array(np.diff(offsets) - np.diff(at)),
               "kept": col.cast(pa.binary())}
        return pa.table({f: out[f] if f in out else docs.column(f) for f in fields})

    return run


def drop_repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS,
                         least: int = LEAST, most: int = MOST, keep_text: bool = True) -> DataFrame:
    """``docs`` with OUT: ``kept`` is the text without chunks that occur earlier."""
    spark = docs.sparkSession
    small_batches(spark)
    src = docs.select(*[F.col(c).cast("string").alias(c) if c == text_col else F.col(c) for c in docs.columns
                        if c not in {f.name for f in OUT} and not c.startswith("_cd_")])
    src = src.withColumns({"_cd_ord": order_key(id_col), "_cd_tag": F.xxhash64(text_col)})
    thin = src.select(F.col("_cd_ord").alias("ord"), F.col("_cd_tag").alias("tag"), F.col(text_col).alias("text"))
    places = thin.mapInArrow(_digests(bits, least, most), PLACES)
    first = places.groupBy("hi", "lo").agg(F.min(F.struct("ord", "tag", "place")).alias("at"))
    n = partitions(spark)
    blocks = 16 * n
    # One row per keeping document: its kept places (as many as it has chunks at most).
    keeps = (first.groupBy(F.col("at.ord").alias("ord"), F.col("at.tag").alias("tag"))
             .agg(F.collect_list("at.place").alias("places"))
             .withColumn("block", F.pmod(F.xxhash64("ord"), F.lit(blocks))))
    src = src.withColumn("_cd_block", F.pmod(F.xxhash64("_cd_ord"), F.lit(blocks)))
    fields = [c for c in src.columns if not c.startswith("_cd_") and (keep_text or c != text_col)]
    schema = T.StructType([src.schema[c] for c in fields] + OUT)
    return src.groupBy("_cd_block").cogroup(written(keeps, "keeps").groupBy("block")).applyInArrow(
        _cut(schema.names, text_col, bits, least, most), schema)
