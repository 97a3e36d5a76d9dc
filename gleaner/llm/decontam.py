"""Benchmark decontamination with a distributed positional inverted index.

Words are maximal runs of letters, digits and non-ASCII characters, A-Z
lower-cased.  The training side is indexed in shards of documents: a shard row
holds its distinct terms, and for every term the ascending list of positions in
the shard (positions of neighbouring documents are ``GAP`` apart, so no phrase
crosses).  The index is an ordinary DataFrame and can be written and reused.

Test items are cut into windows of ``window`` consecutive words (a shorter item,
if it has words, is one window).  A window is looked up from its rarest term in
the shard: the position list, shifted by the term's place in the window, gives
candidate starts, which are intersected with the shifted lists of the other
terms from rare to frequent.  ``slop > 0`` lets every other term stand up to
that many words off its place (a proximity match).

Test items pass through the driver as a stream and reach the tasks in blocks of
at most ``BLOCK_WINDOWS`` windows (about 80 bytes each), the bound of what is
broadcast; every block is searched in all shards.  No document is shuffled.

Defined cases: null texts have no words, no hits and are not contaminated; items
without words are skipped; a null item id is written as the empty string; equal
item ids are one item; repeated documents each get a row; an empty table on
either side gives no hits.  Columns named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.llm.arrays import U64, hash_runs, mix64, ranges, runs_of, starts_of, utf8
from gleaner.llm.common import small_batches, written

WINDOW = 10
GAP = 64
BLOCK_WINDOWS = 50_000
#: Blocks searched in one pass over the shards.
ONE_PASS = 8
#: Text bytes of a shard (one document at least).
SHARD = 2 << 20
#: Candidate starts compared at once.
STEP = 1 << 20

_BYTE = np.arange(256)
_LOWER = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE)
_VALUE = mix64(_LOWER.astype(U64) + U64(1))
_IS_WORD = ((_BYTE >= 0x30) & (_BYTE <= 0x39)) | ((_LOWER >= 0x61) & (_LOWER <= 0x7A)) | (_BYTE >= 0x80)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, words of every text)."""
    start, end = runs_of(_IS_WORD[data], offsets)
    words = hash_runs(_VALUE[data], start, end)
    return words, np.diff(np.searchsorted(start, offsets))


INDEX = T.StructType([T.StructField(c, T.BinaryType()) for c in
                      ("docs", "words", "terms", "counts", "places", "found")])
_INDEX = pa.schema([(f.name, pa.binary()) for f in INDEX.fields])


def _to_ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def build_index(docs: DataFrame, text_col: str = "text", keep_text: bool = False, shard: int = SHARD) -> DataFrame:
    """One row per shard of documents; other columns travel with the shard."""
    small_batches(docs.sparkSession)
    return docs.mapInArrow(_build(text_col, [c for c in docs.columns if keep_text or c != text_col], shard), INDEX)


def _build(text_col: str, carried: list[str], shard: int):
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            data, offsets = utf8(b.column(text_col))
            at = 0
            while at < b.num_rows:
                to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + shard, "right")) - 1)
                to = min(to, b.num_rows)
                words, n = word_hashes(data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at])
                place = np.arange(len(words)) + np.repeat(np.arange(len(n)), n) * GAP
                by = np.argsort(words, kind="stable")
                terms, counts = np.unique(words[by], return_counts=True)
                part = b.slice(at, to - at).select(carried)
                yield pa.RecordBatch.from_pydict(
                    {"docs": [_to_ipc(part)], "words": [n.astype(np.uint32).tobytes()], "terms": [terms.tobytes()],
                     "counts": [counts.astype(np.uint32).tobytes()], "places": [place[by].astype(np.uint32).tobytes()],
                     "found": [b""]}, schema=_INDEX)
                at = to

    return run


def _windows(rows, window: int) -> Iterator[tuple[str, np.ndarray]]:
    for r in rows:
        data = np.frombuffer((r["text"] or "").encode(), np.uint8)
        words, _ = word_hashes(data, np.array([0, len(data)]))
        name = "" if r["item"] is None else str(r["item"])
        if 0 < len(words) < window:
            yield name, words
        for i in range(len(words) - window + 1):
            yield name, words[i:i + window]


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, size: int):
    """Blocks of at most ``size`` distinct windows: (words, lengths, item lists)."""
    rows = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).cast("string").alias("text"))
    seen: dict[bytes, set[str]] = {}

    def block():
        keys = list(seen)
        lengths = np.array([len(k) // 8 for k in keys])
        return np.frombuffer(b"".join(keys), U64), lengths, [sorted(seen[k]) for k in keys]

    for name, words in _windows(rows.toLocalIterator(), window):
        seen.setdefault(words.tobytes(), set()).add(name)
        if len(seen) >= size:
            yield block()
            seen = {}
    if seen:
        yield block()


class Postings:
    """The lists of a shard, found by term number and position."""

    def __init__(self, terms: np.ndarray, counts: np.ndarray, places: np.ndarray) -> None:
        self.terms, self.counts, self.places = terms, counts.astype(np.int64), places.astype(np.int64)
        self.at = starts_of(self.counts)
        self.keys = (np.repeat(np.arange(len(terms)), self.counts) << 33) + self.places

    def number(self, words: np.ndarray) -> np.ndarray:
        """Number of each term, -1 where the shard hasn't it."""
        i = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        return np.where(self.terms[i] == words, i, -1)

    def holds(self, term: np.ndarray, place: np.ndarray, slop: int) -> np.ndarray:
        want = (term << 33) + place
        i = np.searchsorted(self.keys, want - slop)
        near = self.keys[np.minimum(i, len(self.keys) - 1)]
        return (i < len(self.keys)) & (near <= want + slop) & (place + slop >= 0)


def phrase_matches(post: Postings, vocab: np.ndarray, word: np.ndarray, lengths: np.ndarray, slop: int = 0):
    """(window, start) of all matches; ``word`` numbers words of ``vocab`` window by window."""
    found_w, found_p = [], []
    if not len(post.terms):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    number = post.number(vocab)[word]
    start = starts_of(lengths)
    for size in np.unique(lengths):
        window = np.flatnonzero(lengths == size)
        term = number[start[window][:, None] + np.arange(size)]
        whole = (term >= 0).all(axis=1)
        window, term = window[whole], term[whole]
        if not len(window):
            continue
        rare = np.argsort(post.counts[term], axis=1, kind="stable")  # places in the window, rarest first
        lists = post.counts[term[np.arange(len(term)), rare[:, 0]]]
        cuts = np.searchsorted(np.cumsum(lists), np.arange(STEP, int(lists.sum()) + STEP, STEP))
        for part in np.split(np.arange(len(window)), np.unique(cuts[cuts < len(window)])):
            if not len(part):
                continue
            t0 = term[part, rare[part, 0]]
            n = post.counts[t0]
            who = np.repeat(part, n)
            at = post.places[ranges(post.at[t0], n)] - np.repeat(rare[part, 0], n)
            for j in range(1, size):
                off = rare[who, j]
                ok = post.holds(term[who, off], at + off, slop)
                who, at = who[ok], at[ok]
                if not len(who):
                    break
            found_w.append(window[who])
            found_p.append(at)
    if not found_w:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_w), np.concatenate(found_p)


_FOUND = np.dtype([("start", "<i8"), ("length", "<i4"), ("item", "<i4")])


def search(index: DataFrame, benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text",
           window: int = WINDOW, slop: int = 0, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The index with every match of every window added to its shards.

    With ``slop`` each other word may stand that many places off (at most GAP / 2).
    """
    if not 0 <= slop <= GAP // 2:
        raise ValueError(f"slop must be between 0 and {GAP // 2}")
    blocks = 0
    for shared in _shared_blocks(index.sparkSession, benchmark, item_col, text_col, window, block_windows):
        if blocks == 1 or blocks and blocks % ONE_PASS == 0:
            index = written(index, "index")  # more than one pass over the shards: store them
        index = index.mapInArrow(_search_block(shared, slop), INDEX)
        blocks += 1
    return index


def _shared_blocks(spark, benchmark, item_col, text_col, window, block_windows):
    for words, lengths, items in _blocks(benchmark, item_col, text_col, window, block_windows):
        vocab, word = np.unique(words, return_inverse=True)
        yield spark.sparkContext.broadcast((vocab, word, lengths, items))


def _search_block(shared, slop: int):
    def run(batches):
        vocab, word, lengths, items = shared.value
        for b in batches:
            for row in b.to_pylist():
                post = Postings(np.frombuffer(row["terms"], U64), np.frombuffer(row["counts"], np.uint32),
                                np.frombuffer(row["places"], np.uint32))
                w, at = phrase_matches(post, vocab, word, lengths, slop)
                if len(w):
                    found = np.empty(len(w), _FOUND)
                    found["start"], found["length"], found["item"] = at, lengths[w], w
                    names = [items[i] for i in np.unique(w)]
                    found["item"] = np.searchsorted(np.unique(w), w)
                    row["found"] = (row["found"] or b"") + _entry(found, names)
                yield pa.RecordBatch.from_pylist([row], schema=_INDEX)

    return run


def _entry(found: np.ndarray, names: list[list[str]]) -> bytes:
    head = pa.array(names, pa.list_(pa.string()))
    side = _to_ipc(pa.RecordBatch.from_arrays([head], names=["items"]))
    return len(found).to_bytes(8, "little") + len(side).to_bytes(8, "little") + found.tobytes() + side


def _entries(blob: bytes):
    at = 0
    while at < len(blob):
        n, m = int.from_bytes(blob[at:at + 8], "little"), int.from_bytes(blob[at + 8:at + 16], "little")
        at += 16
        found = np.frombuffer(blob, _FOUND, n, at)
        at += n * _FOUND.itemsize
        names = pa.ipc.open_stream(blob[at:at + m]).read_all().column("items").to_pylist()
        at += m
        yield found, names


def _docs_of(row: dict) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """(carried columns, words per document, first position of each)."""
    n = np.frombuffer(row["words"], np.uint32).astype(np.int64)
    return pa.ipc.open_stream(row["docs"]).read_all(), n, starts_of(n + GAP)[:-1]


REPORT = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
          T.StructField("n_items", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())),
          T.StructField("contaminated", T.BooleanType())]


def report(index: DataFrame, carried: T.StructType) -> DataFrame:
    """One row per document: its columns, words, words inside matches, and the
    sorted ids of the items with matches."""
    fields = [f for f in carried.fields if f.name not in {r.name for r in REPORT}]
    return index.mapInArrow(_report([f.name for f in fields]), T.StructType(fields + REPORT))


def _report(fields: list[str]):
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                docs, n, first = _docs_of(row)
                size = int((n + GAP).sum())
                step = np.zeros(size + 1, np.int32)
                items: dict[int, set[str]] = {}
                for found, names in _entries(row["found"] or b""):
                    np.add.at(step, found["start"], 1)
                    np.add.at(step, found["start"] + found["length"], -1)
                    doc = np.searchsorted(first, found["start"], "right") - 1
                    for d, i in set(zip(doc.tolist(), found["item"].tolist())):
                        items.setdefault(d, set()).update(names[i])
                hit = starts_of(np.cumsum(step[:-1]) > 0)
                n_hit = hit[first + n] - hit[first] if len(n) else n
                mine = [sorted(items.get(d, ())) for d in range(len(n))]
                out = {"n_words": pa.array(n), "n_hit": pa.array(n_hit),
                       "n_items": pa.array([len(x) for x in mine], pa.int64()),
                       "items": pa.array(mine, pa.list_(pa.string())), "contaminated": pa.array(n_hit > 0)}
                yield from pa.table({f: docs.column(f) for f in fields} | out).to_batches()

    return run


def matches(index: DataFrame, id_type: T.DataType, id_col: str = "doc_id") -> DataFrame:
    """Every match as (id, item, place of its first word in the document, words)."""
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("item", T.StringType()),
                           T.StructField("word", T.LongType()), T.StructField("n_words", T.IntegerType())])

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                docs, _n, first = _docs_of(row)
                ids = docs.column(id_col).to_pylist()
                for found, names in _entries(row["found"] or b""):
                    doc = np.searchsorted(first, found["start"], "right") - 1
                    out = [{id_col: ids[d], "item": name, "word": int(s - first[d]), "n_words": int(k)}
                           for d, (s, k, i) in zip(doc, found.tolist()) for name in names[i]]
                    if out:
                        yield from pa.Table.from_pylist(out, schema=_match_schema(id_col, docs)).to_batches()

    return index.mapInArrow(run, schema)


def _match_schema(id_col: str, docs: pa.Table) -> pa.Schema:
    return pa.schema([(id_col, docs.schema.field(id_col).type), ("item", pa.string()), ("word", pa.int64()),
                      ("n_words", pa.int32())])


def contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, keep_text: bool = False) -> DataFrame:
    """``docs`` with the columns of ``report``.

    The index is built, searched and reported in one pass over the documents; with
    more test items than ONE_PASS blocks hold it is stored and searched on."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(*[c for c in docs.columns if c not in {r.name for r in REPORT}])
    carried = T.StructType([f for f in docs.schema.fields if keep_text or f.name != text_col])
    blocks = list(islice(_shared_blocks(spark, benchmark, item_col, item_text, window, BLOCK_WINDOWS), ONE_PASS + 1))
    if len(blocks) > ONE_PASS:
        return report(search(build_index(docs, text_col, keep_text), benchmark, item_col, item_text, window), carried)
    steps = [_build(text_col, carried.names, SHARD), *(_search_block(b, 0) for b in blocks), _report(carried.names)]

    def run(batches):
        for step in steps:
            batches = step(batches)
        yield from batches

    return docs.mapInArrow(run, T.StructType(carried.fields + REPORT))
