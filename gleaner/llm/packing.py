"""Best-fit packing of token sequences by minimum bin slack.

A text becomes the ids of a tokenizer file plus an end id; only sequences longer
than the capacity are cut, into whole-capacity pieces and a rest.  Pieces are
then packed into as few sequences as possible: the largest length left opens a
bin, a bitset subset-sum over all lengths left (bounded by how many pieces have
them) finds the fullest combination that still fits, and that combination is
taken out, as often as its lengths allow.

The combinations depend only on how many pieces have each length, so they are
found from a histogram of at most ``capacity`` rows, however many documents
there are.  Each combination uses up at least one length's room to be used
again, so there are at most sum(capacity / length) of them: that bounds the
table sent to the tasks.  A piece finds its sequence by its rank among the
pieces of its length; ranks are counted in salted sub-groups with running
totals, so a length that a third of all pieces share is not ranked in one task.

Ids are put together from white-space units: the tokenizer drops white space and
never merges across it, so a text's ids are those of its units in turn.  The texts of
a few batches are split and their units numbered at once; distinct units are looked
up in a memory of ids, and the ids of all units are gathered from it.  New words of
plain letters go through the file's merge rules many at a time, all other new units
through the tokenizer itself.

Defined cases: null text is empty and becomes the end id alone; null document
ids are packed like others; repeated rows are separate documents; an empty table
gives an empty table; other input columns named like an output are replaced.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from gleaner.llm.arrays import ranges, runs_of, starts_of, utf8
from gleaner.llm.common import partitions, small_batches, written

CAPACITY = 4096
END_ID = 1
#: Units remembered by a worker; beyond it only those of the texts at hand are kept.
MEMORY = 400_000
#: Bytes of text that a task works on at once.
CHUNK = 4 << 20
#: ASCII marks that the tokenizer's pattern always parts from a letter before them.
MARKS = ".,!?;:*%$&#|()\"-"


class Merges:
    """The merge rules of a tokenizer file, applied to many words at once."""

    NONE = np.int64(2**62)

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, self.suffix = model["vocab"], model["end_of_word_suffix"] or ""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        key = np.array([(vocab[a] << 20) + vocab[b] for a, b in pairs], np.int64)
        into = np.array([vocab[a + b] for a, b in pairs], np.int32)
        by = np.argsort(key, kind="stable")
        self.key, self.rank, self.into = key[by], by.astype(np.int64), into[by]
        # Bytes as the characters of byte-level vocabularies: printable Latin-1
        # stands for itself, the others follow from U+0100 on in order.
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = iter(range(256, 512))
        chars = [chr(b) if b in own else chr(next(rest)) for b in range(256)]
        self.inner = np.array([vocab.get(c, -1) for c in chars], np.int64)
        self.final = np.array([vocab.get(c + self.suffix, -1) for c in chars], np.int64)

    def words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all words, where each word's begin, how many it has); words are
        lower-cased UTF-8, not empty."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(size) - 1
        sym = self.inner[data]
        sym[ends] = self.final[data[ends]]
        who = np.arange(len(words))
        ids, start_of, size_of, at_end = [np.zeros(0, np.uint32)], np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), 0
        while len(who):
            start = np.cumsum(size) - size
            pair = np.empty(len(sym), np.int64)
            pair[:-1] = (sym[:-1] << 20) + sym[1:]
            pair[-1] = -1
            at = np.minimum(np.searchsorted(self.key, pair), len(self.key) - 1)
            rank = np.where(self.key[at] == pair, (self.rank[at] << 32) + np.arange(len(sym)), self.NONE)
            rank[start + size - 1] = self.NONE
            best = np.minimum.reduceat(rank, start)
            done = best == self.NONE
            where = best[~done] & np.int64(0xFFFFFFFF)
            sym[where] = self.into[at[where]]
            keep = np.repeat(~done, size)
            if done.any():
                ids.append(sym[~keep].astype(np.uint32))
                size_of[who[done]] = size[done]
                start_of[who[done]] = at_end + np.cumsum(size[done]) - size[done]
                at_end += len(ids[-1])
            keep[where + 1] = False
            sym, who, size = sym[keep], who[~done], size[~done] - 1
        return np.concatenate(ids), start_of, size_of


class Units:
    """Ids of white-space units, remembered by their parts: one array of ids, and where in
    it the ids of each part stand."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer, self.merges = Tokenizer.from_file(path), Merges(path)
        self._start_anew()

    def _start_anew(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.start, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _remember(self, words: list[bytes], ids: np.ndarray, size: np.ndarray) -> None:
        """Parts with their ids one after another."""
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(size) - size])
        self.size, self.ids = np.concatenate([self.size, size]), np.concatenate([self.ids, ids])

    def _by_tokenizer(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def learn(self, parts: list[bytes]) -> None:
        """Remember new parts: lower-cased words of ASCII or Latin-1 letters are one word of
        the tokenizer's pattern each."""
        plain = np.fromiter((p.isalpha() or _letters(p) for p in parts), bool, len(parts))
        size = np.zeros(len(parts), np.int64)
        start, ids = np.zeros(len(parts), np.int64), np.zeros(0, np.uint32)
        words = [parts[i] for i in np.flatnonzero(plain).tolist()]
        if words:
            ids, start[plain], size[plain] = self.merges.words(words)
        odd = [self._by_tokenizer(parts[i].decode()) for i in np.flatnonzero(~plain).tolist()]
        size[~plain] = [len(x) for x in odd]
        start[~plain] = len(ids) + np.cumsum(size[~plain]) - size[~plain]
        pool = np.concatenate([ids, *odd])
        self._remember(parts, pool[ranges(start, size)], size)

    def places(self, words: list[bytes]) -> np.ndarray:
        """The numbers of distinct parts, learnt if need be."""
        at = np.fromiter((self.known.get(w, -1) for w in words), np.int64, len(words))
        new = np.flatnonzero(at < 0)
        if len(new):
            if len(self.known) + len(new) > MEMORY:
                old = np.flatnonzero(at >= 0)
                kept = self.ids[ranges(self.start[at[old]], self.size[at[old]])], self.size[at[old]]
                self._start_anew()
                self._remember([words[i] for i in old.tolist()], *kept)
                at[old] = np.arange(len(old))
            begin = len(self.known)
            self.learn([words[i] for i in new.tolist()])
            at[new] = np.arange(begin, begin + len(new))
        return at

    def all_ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in turn, where each text's begin); a null text has none.

        A unit of Latin-1 letters with MARKS behind them is two parts, letters (lower-cased)
        and marks; any other unit is one part."""
        data, off = utf8(texts)
        inside = (data != 0x20) & (data != 0x0A)
        start, end = runs_of(inside, off)
        # Letters: ASCII, or 0xC3 and the byte behind it.
        wide = np.zeros(len(data), bool)
        wide[1:] = (data[:-1] == 0xC3) & _LATIN[data[1:]]
        letter = _ASCII[data] | wide
        letter[:-1] |= wide[1:]
        strange = np.zeros(len(data) + 1, np.int32)
        np.cumsum(~letter, out=strange[1:])
        behind = np.maximum.accumulate(np.where(_MARK[data], np.int32(-1), np.arange(len(data), dtype=np.int32)))
        head = np.maximum(behind[end - 1] + 1, start) if len(start) else end
        plain = (head > start) & (strange[head] == strange[start])
        lower = np.where(wide, _LATIN_LOWER[data], _ASCII_LOWER[data])
        data = np.where(np.repeat(plain, end - start), lower[inside], data[inside])
        # Parts in turn: the units' bytes with one more cut before the marks.
        two = plain & (head < end)
        n = np.stack([np.where(plain, head, end) - start, np.where(two, end - head, 0)], axis=1)
        n = n.ravel()[np.stack([np.ones(len(two), bool), two], axis=1).ravel()]
        parts = pa.Array.from_buffers(pa.large_binary(), len(n), [
            None, pa.py_buffer(starts_of(n)), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        at = self.places(parts.dictionary.to_pylist())[parts.indices.to_numpy()]
        upto, of_unit = starts_of(self.size[at]), np.concatenate([[0], np.cumsum(1 + two)])
        return self.ids[ranges(self.start[at], self.size[at])], upto[of_unit[np.searchsorted(start, off)]]


_BYTE = np.arange(256, dtype=np.uint8)
_ASCII = ((_BYTE | 32) >= 0x61) & ((_BYTE | 32) <= 0x7A) & (_BYTE < 0x80)
_MARK = np.isin(_BYTE, np.frombuffer(MARKS.encode(), np.uint8))
#: Second bytes of the Latin-1 letters behind 0xC3, and their small forms.
_LATIN = (_BYTE >= 0x80) & (_BYTE <= 0xBF) & (_BYTE != 0x97) & (_BYTE != 0xB7)
_ASCII_LOWER = np.where((_BYTE >= 0x41) & (_BYTE <= 0x5A), _BYTE + 32, _BYTE).astype(np.uint8)
_LATIN_LOWER = np.where((_BYTE >= 0x80) & (_BYTE <= 0x9E) & _LATIN, _BYTE + 32, _BYTE).astype(np.uint8)


def _letters(part: bytes) -> bool:
    """Latin-1 letters only."""
    text = part.decode()
    return text.isalpha() and max(text) < "\u0100" and text == text.lower()


_UNITS: dict[str, Units] = {}


def units(path: str) -> Units:
    if path not in _UNITS:
        _UNITS[path] = Units(path)
    return _UNITS[path]


PIECE = [T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
         T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())]
PLACE = ["sequence_id", "offset"]


def token_pieces(docs: DataFrame, tokenizer: str, text_col: str = "text", capacity: int = CAPACITY,
                 end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: the other columns of ``docs`` and PIECE (plus ``ids``,
    little-endian 32-bit, if asked for)."""
    small_batches(docs.sparkSession)
    new = PIECE + ([T.StructField("ids", T.BinaryType())] if with_ids else [])
    drop = {f.name for f in new} | {*PLACE, text_col}
    fields = [f for f in docs.schema.fields if f.name not in drop]
    src = docs.select(*[f.name for f in fields], F.col(text_col).cast("string").alias("_pk_text"))
    schema = T.StructType(fields + new)

    def chunks(batches):
        held, size = [], 0
        for b in batches:
            held.append(b)
            size += b.column("_pk_text").nbytes
            if size >= CHUNK:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
        if held:
            yield pa.Table.from_batches(held).combine_chunks()

    def run(batches):
        known = units(tokenizer)
        for t in chunks(batches):
            if not t.num_rows:
                continue
            ids, begin = known.all_ids(t.column("_pk_text"))
            length = np.diff(begin) + 1  # with the end id
            whole = np.insert(ids, begin[1:], np.uint32(end_id)).astype("<u4", copy=False)
            pieces = -(-length // capacity)
            row = np.repeat(np.arange(t.num_rows), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            size = np.minimum(capacity, length[row] - start)
            at = (np.cumsum(length) - length)[row] + start
            cut = list(zip(at.tolist(), (at + size).tolist()))
            taken = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [*(t.column(f.name).combine_chunks().take(taken) for f in fields), pa.array(piece.astype(np.int32)),
                 pa.array(start), pa.array(size), pa.array([zlib.crc32(whole[a:b]) for a, b in cut], pa.int64()),
                 *([pa.array([whole[a:b].tobytes() for a, b in cut], pa.binary())] if with_ids else [])],
                names=schema.names)

    return src.mapInArrow(run, schema)


def fullest(counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """The subset of lengths (each at most ``counts`` times) with the largest
    sum up to ``room``: bitset subset-sum, then the way back."""
    mask, goal = (1 << (room + 1)) - 1, 1 << room
    bits, steps = 1, []
    for size in sorted((s for s, n in counts.items() if n and s <= room), reverse=True):
        left, copies = min(counts[size], room // size), 1
        while left:
            take = min(copies, left)
            steps.append((size, take, bits))
            bits |= (bits << (size * take)) & mask
            left -= take
            copies *= 2
        if bits & goal:
            break
    total, used = bits.bit_length() - 1, {}
    for size, take, before in reversed(steps):
        if total >= size * take and not (before >> total) & 1:
            used[size] = used.get(size, 0) + take
            total -= size * take
    return sorted(used.items(), reverse=True)


def bin_plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Minimum-bin-slack packing as (how many bins, [(length, copies), ...])."""
    counts = {s: n for s, n in histogram.items() if n > 0}
    plan = []
    while counts:
        first = max(counts)
        rest = dict(counts)
        rest[first] -= 1
        combo = dict(fullest(rest, capacity - first))
        combo[first] = combo.get(first, 0) + 1
        times = min(counts[s] // c for s, c in combo.items())
        for s, c in combo.items():
            counts[s] -= c * times
            if not counts[s]:
                del counts[s]
        plan.append((times, sorted(combo.items(), reverse=True)))
    return plan


def _slots(plan):
    """Arrays by (length, first rank): sequence base, copies per bin, offset."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for times, combo in plan:
        at = 0
        for size, copies in combo:
            rows.append((size, used.get(size, 0), base, copies, at))
            used[size] = used.get(size, 0) + copies * times
            at += size * copies
        base += times
    rows.sort()
    return np.array(rows, np.int64).reshape(-1, 5)


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (written or cheap: it is read twice) plus ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    pieces = pieces.select(*[c for c in pieces.columns if c not in (*PLACE, "_pk_salt", "_pk_rank")])
    salts = max(8, partitions(spark))
    others = [c for c in ("doc_id", "piece", "start", "ids_crc32") if c in pieces.columns]
    salted = pieces.withColumn("_pk_salt", F.pmod(F.xxhash64(*others), F.lit(salts)).cast("int"))
    counts = written(salted.groupBy("length", "_pk_salt").agg(F.count("*").alias("n")), "counts")
    # At most `capacity` rows: one per length.
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = spark.sparkContext.broadcast(_slots(bin_plan(histogram, capacity)))
    before = counts.select("length", "_pk_salt", F.coalesce(F.sum("n").over(
        Window.partitionBy("length").orderBy("_pk_salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_pk_before"))
    in_salt = F.row_number().over(Window.partitionBy("length", "_pk_salt").orderBy(*others)) - 1
    ranked = salted.withColumn("_pk_in", in_salt).join(before, ["length", "_pk_salt"]).select(
        *pieces.columns, (F.col("_pk_in") + F.col("_pk_before")).cast("long").alias("_pk_rank"))
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def run(batches):
        table = slots.value
        key = (table[:, 0] << 40) + table[:, 1]
        for b in batches:
            size, rank = b.column("length").to_numpy(), b.column("_pk_rank").to_numpy()
            s = table[np.searchsorted(key, (size << 40) + rank, "right") - 1]
            nth = rank - s[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in schema.names[:-2]), pa.array(s[:, 2] + nth // s[:, 3]),
                 pa.array(s[:, 4] + nth % s[:, 3] * size)], names=schema.names)

    return ranked.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer: str, text_col: str = "text", capacity: int = CAPACITY,
                   end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """``docs`` as placed pieces: its other columns, PIECE, ``sequence_id``, ``offset``."""
    return pack_pieces(written(token_pieces(docs, tokenizer, text_col, capacity, end_id, with_ids), "pieces"), capacity)
