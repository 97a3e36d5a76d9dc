"""Suffix-array dedup of exact byte repeats, by deep-shallow sorting.

A byte is removed when it lies in a ``match``-byte string (50 by default)
that also starts in a document with a smaller id.  Matches never cross
documents, overlaps count, and strings are judged on the input.

How the suffixes reach a sort without shuffling 50 bytes per position:

1. Every ``match``-byte window elects an *anchor*: the leftmost of its
   ``q``-grams with the smallest hash.  Equal windows elect the same anchor, so
   consecutive windows with one anchor form a *segment* and only segments whose
   anchor q-gram occurs elsewhere can hold a repeat.  The first job ships 6+6
   bytes of hash per segment, finds equal segments (all but the one with the
   smallest id are removed whole) and lists the segments whose anchor occurs in
   different surroundings.
2. The texts of those listed segments go to the bucket of their anchor.  There
   the suffixes of all their windows are sorted: multikey quicksort with 8-byte
   characters down to the shallow depth, then blind (path-compressed) tries
   order the groups that still share that prefix.  Leaves of one trie node of
   depth ``match`` are equal windows; all but those of the smallest id go.
3. Removed runs meet the documents again by blocks of ids.

Hot groups: equal segments of one task are reduced to the smallest id before
the shuffle (the others are decided there and then).  Anchors that hold more
than a fixed share of all segments are found by a first pass (a bounded
heavy-hitter list); their segments are dealt by segment instead of anchor, and
in step 2 by window instead of anchor, so no q-gram fills one task.

Defined cases: null text is empty and keeps nothing; a null id comes after all
ids; rows with one id never remove bytes of each other (they are told apart by
a checksum of the text, so repeated rows get the same result); texts shorter
than ``match`` bytes lose nothing; an empty table gives an empty table.  Columns
of the input named like an output column (``kept``, ``n_bytes``, ``n_removed``,
``n_spans``) are replaced; all other columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.llm.arrays import (GOLD, U64, expand, mix64, pack, power_tables, ranges, squeeze, starts_of, unpack,
                                utf8, xxhash64_long)
from gleaner.llm.common import order_key, partitions, small_batches, written

MATCH = 50
QGRAM = 20
SHALLOW = 16
#: Text bytes handled at once inside a task, and per block of ids.
CHUNK = 1 << 20
BLOCK = 2 << 20
#: An anchor is hot from this share of all segments on; at most 2/HOT_SHARE are listed.
HOT_SHARE = 1 / 4096
#: ... and at least this many.
HOT_LEAST = 64
MAX_ID = 2**63 - 1

_ODD = U64(0xD6E8FEB86659FD93)
def _grams(data: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of the q-gram (8 <= q <= 24) at every position that has one."""
    raw, n = data.tobytes(), len(data) - q + 1
    h = np.ndarray((n,), "<u8", raw, 0, (1,)) * GOLD
    for at in {min(8, q - 8), q - 8} - {0}:
        h ^= h >> U64(32)
        h += np.ndarray((n,), "<u8", raw, at, (1,))
        h *= _ODD
    h ^= h >> U64(29)
    h *= GOLD
    h ^= h >> U64(32)
    return h


def segments(data: np.ndarray, offsets: np.ndarray, match: int = MATCH, q: int = QGRAM):
    """Segments of a batch: (document, first window relative to it, windows,
    anchor hash, segment hash), ordered by document and place."""
    none = np.zeros(0, np.int64)
    lengths = np.diff(offsets)
    if len(data) < match or not (lengths >= match).any():
        return none, none, none, none.astype(U64), none.astype(U64)
    h = _grams(data, q)
    n = len(h)
    best = (h & U64(0xFFFFFFFF00000000)) | np.arange(n, dtype=U64)
    width, size = 1, match - q + 1
    while width * 2 <= size:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    if size > width:
        best = np.minimum(best[:width - size], best[size - width:])
    n_win = np.maximum(lengths - match + 1, 0)
    places = ranges(offsets[:-1], n_win)
    anchor = (best[places] & U64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(places), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (places[1:] != places[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(places)))
    at = places[first]
    doc = np.searchsorted(offsets, at, "right") - 1
    up, down = power_tables(n + 1)
    total = np.zeros(n + 1, U64)
    np.cumsum(h * up[:n], out=total[1:])
    end = at + count + match - q  # one past the last q-gram
    content = mix64((total[end] - total[at]) * down[at] + count.astype(U64))
    return doc, at - offsets[doc], count, h[anchor[first]], content


def _chunks(batches):
    """(order key, checksum, bytes, offsets) of about CHUNK text bytes at a time."""
    held, size = [], 0
    for b in batches:
        if b.num_rows == 0:
            continue
        at = 0
        lens = np.diff(utf8(b.column("text"))[1])
        ends = np.cumsum(lens)
        while at < b.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + CHUNK - size, "right")))
            held.append(b.slice(at, to - at))
            size += int(ends[to - 1] - base)
            at = to
            if size >= CHUNK:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held):
    t = pa.Table.from_batches(held)
    data, offsets = utf8(t.column("text"))
    return (t.column("_sa_ord").to_numpy(), t.column("_sa_tag").to_numpy().astype(np.uint32), data, offsets)


def _firsts(order: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort by keys, then id: (permutation, group of each, smallest id of each group)."""
    by = np.lexsort((order, *keys[::-1]))
    new = np.ones(len(by), bool)
    if len(by):
        new[1:] = False
        for k in keys:
            s = k[by]
            new[1:] |= s[1:] != s[:-1]
    group = np.cumsum(new) - 1
    return by, group, order[by][new]


def _block(order: np.ndarray, n_blocks: int) -> np.ndarray:
    """``pmod(xxhash64(order), n_blocks)`` as the documents are grouped by."""
    return xxhash64_long(order) % np.int64(n_blocks)


RUNS = T.StructType([T.StructField("block", T.LongType()), T.StructField("kind", T.IntegerType()),
                     T.StructField("runs", T.BinaryType())])
_RUNS = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("runs", pa.binary())])
PARTS = "bucket long, kind int, blob binary, text binary"
_PARTS = pa.schema([("bucket", pa.int64()), ("kind", pa.int32()), ("blob", pa.binary()), ("text", pa.binary())])


def _by(groups: np.ndarray, n: int):
    """Indices of each group that occurs, in stable order."""
    order = np.argsort(groups.astype(np.uint32), kind="stable")
    s = groups[order]
    cut = np.flatnonzero(np.diff(s)) + 1
    for part in np.split(order, cut):
        if len(part):
            yield int(groups[part[0]]), part


def _run_rows(order, tag, lo, count, kind, n_blocks):
    """Rows (block, kind, runs) of window runs, packed by block of ids."""
    rows = []
    if len(order):
        for b, i in _by(_block(order, n_blocks), n_blocks):
            rows.append({"block": b, "kind": kind, "runs": pack(order[i], tag[i], lo[i].astype(np.uint32),
                                                                count[i].astype(np.uint32))})
    return rows


def _census(match, q, hot_share, hot_least):
    """Pass 1: bytes and segments of a task, and anchors that hold many of them."""

    def run(batches):
        size = n = 0
        for _order, _tag, data, offsets in _chunks(batches):
            size += len(data)
            _doc, _lo, _n, key, content = segments(data, offsets, match, q)
            n += len(key)
            _, one = np.unique(content, return_index=True)
            k, c = np.unique(key[one] & _KEY, return_counts=True)
            keep = c >= max(hot_least / 8, len(one) * hot_share / 2)
            yield pa.RecordBatch.from_pydict(
                {"key": k[keep].astype(np.int64), "n": c[keep].astype(np.int64), "size": [0] * int(keep.sum())},
                schema=_CENSUS)
        yield pa.RecordBatch.from_pydict({"key": [None], "n": [n], "size": [size]}, schema=_CENSUS)

    return run


_CENSUS = pa.schema([("key", pa.int64()), ("n", pa.int64()), ("size", pa.int64())])
_KEY = U64(0xFFFFFFFFFFFF)


def _ship_hashes(match, q, hot, n_buckets, n_blocks):
    """Pass 2, map side: hashes of segments by bucket, copies decided at once."""
    hot = np.asarray(sorted(hot), np.int64).astype(U64)

    def run(batches):
        for order, tag, data, offsets in _chunks(batches):
            doc, lo, n, key, content = segments(data, offsets, match, q)
            if not len(doc):
                continue
            own = order[doc]
            by, group, least = _firsts(own, content)
            copy = np.zeros(len(doc), bool)
            copy[by] = own[by] > least[group]
            rows = [{"bucket": r["block"], "kind": 1, "blob": r["runs"], "text": None}
                    for r in _run_rows(own[copy], tag[doc][copy], lo[copy], n[copy], 0, n_blocks)]
            left = np.flatnonzero(~copy)
            is_hot = np.isin(key[left] & _KEY, hot)
            where = np.where(is_hot, mix64(content[left] + GOLD), mix64(key[left])) % U64(n_buckets)
            for b, i in _by(where.astype(np.int64), n_buckets):
                s = left[i]
                docs, idx = np.unique(doc[s], return_inverse=True)
                blob = pack((key[s] & _KEY) | (is_hot[i].astype(U64) << U64(48)), content[s] & _KEY,
                            np.diff(idx, prepend=0).astype(np.uint32), lo[s].astype(np.uint32),
                            n[s].astype(np.uint16))
                rows.append({"bucket": b, "kind": 0, "blob": blob, "text": pack(order[docs], tag[docs])})
            yield pa.RecordBatch.from_pylist(rows, schema=_PARTS)

    return run


def _judge_hashes(n_blocks):
    """Pass 2, reduce side: equal segments, and segments that share an anchor."""

    def run(batches):
        blobs, keys = [], []
        for b in batches:
            for row in b.to_pylist():
                if row["kind"] == 1:
                    yield pa.RecordBatch.from_pylist(
                        [{"block": row["bucket"], "kind": 0, "runs": row["blob"]}], schema=_RUNS)
                    continue
                blobs.append((row["blob"], row["text"]))
                keys.append(unpack(row["blob"], "u8")[0])
        if not blobs:
            return
        # Most anchors occur once and are done with: only the others are unpacked
        # further, and the hot ones, whose other segments are in other buckets.
        keys = np.sort(np.concatenate(keys))
        again = np.unique(np.concatenate([keys[1:][keys[1:] == keys[:-1]], keys[keys > _KEY]]))
        del keys
        if not len(again):
            return
        found = []
        for blob, docs in blobs:
            k, s, idx, lo, n = unpack(blob, "u8", "u8", "u4", "u4", "u2")
            do, dt = unpack(docs, "i8", "u4")
            i = np.flatnonzero(again[np.minimum(np.searchsorted(again, k), len(again) - 1)] == k)
            at = np.cumsum(idx.astype(np.int64))[i]
            found.append((k[i], s[i], do[at], dt[at], lo[i], n[i]))
        del blobs
        key, seg, order, tag, lo, n = (np.concatenate(x) for x in zip(*found))
        del found
        hot = (key >> U64(48)).astype(bool)
        by, group, least = _firsts(order, key, seg)
        key, hot, order, tag, lo, n = key[by], hot[by], order[by], tag[by], lo[by], n[by]
        later = order > least[group]
        rows = _run_rows(order[later], tag[later], lo[later], n[later], 0, n_blocks)
        yield pa.RecordBatch.from_pylist(rows, schema=_RUNS)
        del seg, by, group
        key, hot, order, tag, lo, n = (x[~later] for x in (key, hot, order, tag, lo, n))
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(new)
        differs = np.minimum.reduceat(order, first) != np.maximum.reduceat(order, first)
        open_ = differs[np.cumsum(new) - 1] | hot
        for kind, pick in ((1, open_ & ~hot), (2, open_ & hot)):
            rows = _run_rows(order[pick], tag[pick], lo[pick], n[pick], kind, n_blocks)
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_RUNS)

    return run


def _rows_of(table: pa.Table, runs: pa.Table, kinds: tuple[int, ...]):
    """Runs of the wanted kinds as (row of the block, first window, windows)."""
    blobs = [(r["kind"], unpack(r["runs"], "i8", "u4", "u4", "u4"))
             for r in runs.select(["kind", "runs"]).to_pylist() if r["kind"] in kinds and r["runs"] is not None]
    if not blobs or not table.num_rows:
        z = np.zeros(0, np.int64)
        return z, z, z, z
    kind = np.concatenate([np.full(len(b[0]), k) for k, b in blobs])
    order, tag, lo, n = (np.concatenate([b[i] for _, b in blobs]) for i in range(4))
    o, t = table.column("_sa_ord").to_numpy(), table.column("_sa_tag").to_numpy().astype(np.uint32)
    mine = (o.astype(U64) * GOLD) ^ t.astype(U64)
    want = (order.astype(U64) * GOLD) ^ tag.astype(U64)
    by = np.argsort(mine, kind="stable")
    left = np.searchsorted(mine[by], want, "left")
    many = np.searchsorted(mine[by], want, "right") - left  # repeated rows get the same runs
    rep = np.repeat(np.arange(len(want)), many)
    return by[ranges(left, many)], lo[rep].astype(np.int64), n[rep].astype(np.int64), kind[rep]


def _ship_texts(match, q, n_buckets, n_blocks, text):
    """Pass 3, by blocks of ids: texts of the open segments to their buckets."""

    def run(_key, docs: pa.Table, runs: pa.Table) -> pa.Table:
        row, lo, n, kind = _rows_of(docs, runs, (1, 2))
        if not len(row):
            return _PARTS.empty_table()
        data, offsets = utf8(docs.column(text))
        order, tag = docs.column("_sa_ord").to_numpy(), docs.column("_sa_tag").to_numpy().astype(np.uint32)
        # A segment of a hot anchor is dealt window by window.
        hot = kind == 2
        more = ranges(lo[hot], n[hot])
        single = np.repeat([False, True], [int((~hot).sum()), len(more)])
        row = np.concatenate([row[~hot], np.repeat(row[hot], n[hot])])
        lo = np.concatenate([lo[~hot], more])
        n = np.concatenate([n[~hot], np.ones(len(more), np.int64)])
        size = n + match - 1
        piece = data[ranges(offsets[row] + lo, size)]
        cut = starts_of(size)
        h = _grams(piece, q)
        up, down = power_tables(len(h) + 1)
        total = np.zeros(len(h) + 1, U64)
        np.cumsum(h * up[:len(h)], out=total[1:])
        content = mix64((total[cut[1:] - q + 1] - total[cut[:-1]]) * down[cut[:-1]] + n.astype(U64))
        # The anchor again: the smallest among the q-grams that all windows of a segment hold.
        best = np.append(h & U64(0xFFFFFFFF00000000), U64(2**64 - 1))
        span = np.stack([cut[:-1] + n - 1, cut[:-1] + match - q + 1], 1).ravel()
        key = np.minimum.reduceat(best, span)[::2]
        # Equal segments of this block: only those of the smallest id travel.
        own, marks, rows = order[row], tag[row], []
        by, group, least = _firsts(own, content, n)
        copy = np.zeros(len(row), bool)
        copy[by] = own[by] > least[group]
        for r in _run_rows(own[copy], marks[copy], lo[copy], n[copy], 0, n_blocks):
            rows.append({"bucket": r["block"], "kind": 1, "blob": r["runs"], "text": None})
        left = np.flatnonzero(~copy)
        where = np.where(single[left], content[left], mix64(key[left])) % U64(n_buckets)
        for b, i in _by(where.astype(np.int64), n_buckets):
            s = left[i]
            rows.append({"bucket": b, "kind": 0, "blob": pack(own[s], marks[s], lo[s].astype(np.uint32),
                                                              n[s].astype(np.uint16)),
                         "text": squeeze(piece[ranges(cut[s], size[s])])})
        return pa.Table.from_pylist(rows, schema=_PARTS)

    return run


def deep_shallow_groups(text: np.ndarray, at: np.ndarray, depth: int = MATCH, shallow: int = SHALLOW):
    """Sort the suffixes that start at ``at`` by their first ``depth`` bytes.

    Returns (order, label): suffixes in lexicographic order and, along it, a
    group number that is shared by suffixes equal to ``depth`` bytes.
    """
    n = len(at)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    raw = np.concatenate([text, np.zeros(16, np.uint8)]).tobytes()
    big = np.ndarray((len(text) + 8,), ">u8", raw, 0, (1,))
    # Shallow: multikey quicksort with 8-byte characters; all open groups of a
    # character depth are partitioned together.
    order = np.argsort(big[at].astype(U64), kind="stable")
    char = big[at[order]]
    new = np.ones(n, bool)
    new[1:] = char[1:] != char[:-1]
    for d in range(8, shallow, 8):
        group = np.cumsum(new) - 1
        size = np.bincount(group)
        open_ = np.flatnonzero(size[group] > 1)
        if not len(open_):
            break
        c = big[at[order[open_]] + d].astype(U64)
        sub = np.lexsort((c, group[open_]))
        order[open_] = order[open_[sub]]
        c, g = c[sub], group[open_]
        new[open_[1:]] |= (c[1:] != c[:-1]) & (g[1:] == g[:-1])
    # Deep: one blind trie for each group that still shares `shallow` bytes.  A
    # trie node skips the bytes all its leaves share and branches on the next.
    group = np.cumsum(new) - 1
    open_ = np.flatnonzero(np.bincount(group)[group] > 1)
    flat = np.concatenate([text, np.zeros(depth, np.uint8)])
    while len(open_):
        g = group[open_]
        head = np.ones(len(open_), bool)
        head[1:] = g[1:] != g[:-1]
        first = np.flatnonzero(head)
        rep = order[open_[first]][np.cumsum(head) - 1]
        here = order[open_]
        skip = _lcp(flat, at[rep], at[here], shallow, depth)
        node = np.minimum.reduceat(skip, first)[np.cumsum(head) - 1]  # branching depth of the trie node
        live = node < depth
        if not live.any():
            break
        open_, g, here, node = open_[live], g[live], here[live], node[live]
        byte = flat[at[here] + node]
        sub = np.lexsort((byte, g))
        order[open_] = here[sub]
        byte = byte[sub]
        new[open_[1:]] |= (byte[1:] != byte[:-1]) & (g[1:] == g[:-1])
        group = np.cumsum(new) - 1
        size = np.bincount(group)
        open_ = open_[size[group[open_]] > 1]
    return order, np.cumsum(new) - 1


def _lcp(flat: np.ndarray, a: np.ndarray, b: np.ndarray, start: int, depth: int) -> np.ndarray:
    """Common prefix lengths, known to be at least ``start``, up to ``depth``."""
    out = np.full(len(a), depth, np.int64)
    todo = np.flatnonzero(a != b)
    for d in range(start, depth):
        if not len(todo):
            break
        same = flat[a[todo] + d] == flat[b[todo] + d]
        out[todo[~same]] = d
        todo = todo[same]
    return out


def _sort_texts(match, n_blocks):
    """Pass 3, reduce side, rows sorted by bucket: equal windows of a bucket."""

    def run(batches):
        bucket, meta, texts = None, [], []
        for b in batches:
            for row in b.to_pylist():
                if row["kind"] == 1:
                    yield pa.RecordBatch.from_pylist(
                        [{"block": row["bucket"], "kind": 0, "runs": row["blob"]}], schema=_RUNS)
                    continue
                if row["bucket"] != bucket and meta:
                    yield pa.RecordBatch.from_pylist(_repeated(meta, texts, match, n_blocks), schema=_RUNS)
                    meta, texts = [], []
                bucket = row["bucket"]
                meta.append(unpack(row["blob"], "i8", "u4", "u4", "u2"))
                texts.append(expand(row["text"]))
        if meta:
            yield pa.RecordBatch.from_pylist(_repeated(meta, texts, match, n_blocks), schema=_RUNS)

    return run


def _repeated(meta, texts, match, n_blocks):
    """Runs of windows that a smaller id also has, among the segments of a bucket."""
    order, tag, lo, n = (np.concatenate([m[i] for m in meta]) for i in range(4))
    text = np.concatenate(texts)
    n = n.astype(np.int64)
    start = starts_of(n + match - 1)[:-1]
    seg = np.repeat(np.arange(len(n), dtype=np.int32), n)
    at = ranges(start, n)
    sorted_, label = deep_shallow_groups(text, at, match)
    own = order[seg[sorted_]]
    least = np.minimum.reduceat(own, np.flatnonzero(np.diff(label, prepend=-1)))[label]
    gone = np.sort(sorted_[own > least])
    if not len(gone):
        return []
    s = seg[gone]
    win = lo[s] + (at[gone] - start[s])
    new = np.ones(len(gone), bool)
    new[1:] = (s[1:] != s[:-1]) | (win[1:] != win[:-1] + 1)
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(gone)))
    return _run_rows(order[s[head]], tag[s[head]], win[head], count, 0, n_blocks)


def _cut(match, fields, text, whole):
    """Last pass, by blocks of ids: what is left of every document."""

    def run(_key, docs: pa.Table, runs: pa.Table) -> pa.Table:
        data, offsets = utf8(docs.column(text))
        row, lo, n, _ = _rows_of(docs, runs, (0,))
        step = np.zeros(len(data) + 1, np.int32)
        at = offsets[row] + lo
        np.add.at(step, at, 1)
        np.add.at(step, at + n + match - 1, -1)
        gone = np.cumsum(step[:-1]) > 0
        before = starts_of(gone)
        rise = gone.copy()
        rise[1:] &= ~gone[:-1]
        heads = offsets[:-1][np.diff(offsets) > 0]
        rise[heads] = gone[heads]  # a run never continues from the document before
        spans = starts_of(rise)
        removed = before[offsets[1:]] - before[offsets[:-1]]
        left = data[~gone]
        kept_at = offsets - before[offsets]
        kept = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(kept_at.tobytes()), pa.py_buffer(left.tobytes())])
        out = {"n_bytes": pa.array(np.diff(offsets)), "n_removed": pa.array(removed),
               "n_spans": pa.array(spans[offsets[1:]] - spans[offsets[:-1]]), "kept": kept.cast(pa.binary())}
        if whole:
            # Characters with a removed byte go as a whole, so the rest is valid text.
            heads = np.flatnonzero((data & 0xC0) != 0x80)
            if len(heads):
                gone = np.repeat(np.logical_or.reduceat(gone, heads), np.diff(np.append(heads, len(data))))
            at = (offsets - starts_of(gone)[offsets]).astype(np.int64)
            out[text] = pa.LargeStringArray.from_buffers(
                len(offsets) - 1, pa.py_buffer(at.tobytes()), pa.py_buffer(data[~gone].tobytes())).cast(pa.string())
        return pa.table({f: out[f] if f in out else docs.column(f) for f in fields})

    return run


OUT = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
                    T.StructField("n_spans", T.LongType()), T.StructField("kept", T.BinaryType())])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", match: int = MATCH,
                   q: int = QGRAM, block_bytes: int = BLOCK, keep_text: bool = True,
                   whole_chars: bool = False, hot_share: float = HOT_SHARE, hot_least: int = HOT_LEAST) -> DataFrame:
    """``docs`` with ``kept`` (remaining bytes), ``n_bytes``, ``n_removed`` and
    ``n_spans`` (maximal removed runs) added.

    ``block_bytes`` is the text aimed at per block of ids in the last pass;
    ``keep_text=False`` leaves the input text out of the result; ``whole_chars``
    replaces it by what is left of it without split characters.  ``hot_share``
    and ``hot_least`` say from where on an anchor is dealt by its segments; they
    move work, never results.
    """
    spark = docs.sparkSession
    small_batches(spark)
    src = docs.select(*[F.col(c).cast("string").alias(c) if c == text_col else F.col(c) for c in docs.columns
                        if c not in OUT.names and not c.startswith("_sa_")])
    src = src.withColumns({"_sa_ord": order_key(id_col),
                           "_sa_tag": F.crc32(F.coalesce(F.col(text_col), F.lit("")))})
    thin = src.select("_sa_ord", "_sa_tag", F.col(text_col).alias("text"))

    census = written(thin.mapInArrow(_census(match, q, hot_share, hot_least), "key long, n long, size long").groupBy("key").agg(
        F.sum("n").alias("n"), F.sum("size").alias("size")), "census")
    all_ = census.where("key is null").first()
    n_segments, size = (all_["n"], all_["size"]) if all_ else (0, 0)
    # Proven bound: the counts add up to at most n_segments, so 1/hot_share keys at most.
    hot = [r["key"] for r in census.where((F.col("n") >= max(hot_least, n_segments * hot_share))
                                          & F.col("key").isNotNull()).collect()]
    n_buckets = partitions(spark)
    n_blocks = max(n_buckets, -(-size // block_bytes))

    parts = thin.mapInArrow(_ship_hashes(match, q, hot, n_buckets, n_blocks), PARTS)
    runs = written(parts.repartition(n_buckets, "bucket").mapInArrow(_judge_hashes(n_blocks), RUNS), "runs")

    src = src.withColumn("_sa_block", F.pmod(F.xxhash64("_sa_ord"), F.lit(n_blocks)))
    blocks = src.repartition(n_buckets, "_sa_block").groupBy("_sa_block")
    texts = blocks.cogroup(runs.groupBy("block")).applyInArrow(
        _ship_texts(match, q, 4 * n_blocks, n_blocks, text_col), PARTS)
    later = texts.repartition(n_buckets, "bucket").sortWithinPartitions("kind", "bucket").mapInArrow(_sort_texts(match, n_blocks), RUNS)
    fields = [c for c in src.columns if not c.startswith("_sa_") and (keep_text or c != text_col)]
    schema = T.StructType([src.schema[c] for c in fields] + OUT.fields)
    return blocks.cogroup(runs.where("kind = 0").unionByName(later).groupBy("block")).applyInArrow(
        _cut(match, schema.names, text_col, whole_chars), schema)
