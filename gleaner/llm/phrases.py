"""Phrase collocations from truncated suffix subtrees, built group by group.

Texts are lower-cased (A-Z only), cut into pieces at ``[.,;:!?\\n\\v\\f\\r]`` and those
into words at spaces and tabs.  Every word starts a suffix of its piece, truncated to
``max_words`` words.  The suffix tree over all of them is partitioned vertically:

1. a first pass counts how often each one-word prefix (per language) starts a suffix;
2. prefixes beyond the memory budget of a group are extended by a word and counted
   again, and those still beyond it by further words, up to whole suffixes;
3. prefixes are packed into groups of at most twice the budget, in order of their hash;
4. a last pass sends every suffix to the group of its prefix, equal ones of a chunk
   of text as one with a count;
5. each group sorts its suffixes on its own; runs of equal leading words are the nodes
   of its subtree, and the totals of their leaves are the counts of the phrases.

A node above a group's prefixes has its leaves in several groups; such parts are summed.
Hashes only say which group a suffix goes to; words are compared whole.  The plan of the
groups is bounded: the budget is at least 2**-20 of all words, so no more than 2**20
prefixes of a length are beyond it.

Defined cases: a null text is empty and counts nothing; a null language is ``und``;
repeated rows count again; ties are settled by count and phrase; an empty table gives
an empty table; further columns are not looked at, whatever their names.  A text is
held whole by its task.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleaner.llm.arrays import U64, expand, hash_runs, mix64, runs_of, squeeze, starts_of, utf8
from gleaner.llm.common import partitions, small_batches, written

#: Suffixes of a group, and the part of all words that a budget is at least.
GROUP_WORDS, FINEST = 1 << 19, 1 << 20
#: Bytes of text that a task works on at once.
CHUNK = 4 << 20
#: Suffixes whose texts a task puts together at once, and bytes that it gathers for the groups.
TEXTS, PENDING = 1 << 17, 8 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)  # 0: of a word, 1: between words, 2: between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2


def _binary(lengths: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(lengths),
                                 [None, pa.py_buffer(starts_of(lengths)), pa.py_buffer(np.ascontiguousarray(data))])


def _hashes(words: pa.Array) -> np.ndarray:
    data, off = utf8(words)
    return hash_runs(mix64(data.astype(U64) + U64(1)), off[:-1], off[1:])


class Suffixes:
    """The distinct truncated suffixes of some texts: languages, word ids, counts.

    ``ids`` has a column for each depth; ids count from 1, 0 stands for no word."""

    def __init__(self, langs: pa.Array, texts: pa.Array, depth: int) -> None:
        data, off = utf8(texts)
        low = _LOWER[data]
        kind = _KIND[low]
        start, end = runs_of(kind == 0, off)
        coded = _binary(end - start, low[kind == 0]).dictionary_encode()
        self.words = coded.dictionary
        word = coded.indices.to_numpy().astype(np.int64) + 1
        doc = np.searchsorted(off, start, "right") - 1
        piece = np.cumsum(kind == 2, dtype=np.int64)[start] if len(start) else start
        spoken = langs.dictionary_encode()
        self.langs, lang = spoken.dictionary, spoken.indices.to_numpy().astype(np.int64)[doc]
        n, base = len(word), len(self.words) + 1
        ids = np.zeros((n, depth), np.int64)
        ids[:, 0] = word
        for d in range(1, min(depth, n)):
            same = (piece[d:] == piece[:-d]) & (doc[d:] == doc[:-d])
            ids[:-d, d] = np.where(same, word[d:], 0)
        key, reach = lang, max(1, len(self.langs))
        for d in range(depth):
            if reach * base >= 2**62:
                values, key = np.unique(key, return_inverse=True)
                reach = len(values)
            key, reach = key * base + ids[:, d], reach * base
        _, at, self.count = np.unique(key, return_index=True, return_counts=True)
        self.lang, self.ids = lang[at], ids[at]

    def prefixes(self) -> np.ndarray:
        """A hash of the first d words with their language, for each depth d."""
        word = np.concatenate([np.zeros(1, U64), _hashes(self.words)])
        h, out = mix64(_hashes(self.langs.cast(pa.large_binary())))[self.lang], []
        for d in range(self.ids.shape[1]):
            h = mix64(h * U64(0x9E3779B97F4A7C15) + word[self.ids[:, d]])
            out.append(h.view(np.int64))
        return np.stack(out, axis=1)

    def texts(self, rows: np.ndarray) -> pa.Array:
        """The suffixes of these rows, words joined by a space."""
        data, off = utf8(self.words)
        size = np.concatenate([[0], np.diff(off)])
        ids = self.ids[rows]
        lengths = size[ids] + (ids > 0)  # with a space or, at the end, a new line
        flat, begin = lengths.ravel(), np.concatenate([[0], off[:-1]])[ids].ravel()
        total = int(flat.sum())
        out = np.full(total, 0x20, np.uint8)
        ends = np.cumsum(flat)
        src = np.repeat(begin - (ends - flat), flat) + np.arange(total)
        mark = np.zeros(total, bool)
        mark[ends[flat > 0] - 1] = True
        out[~mark] = data[src[~mark]]
        whole = lengths.sum(axis=1)
        out[np.cumsum(whole)[whole > 0] - 1] = 0x0A
        return _binary(whole, out)


def _chunks(batches, depth: int):
    """Suffixes of about CHUNK bytes of text at a time."""
    held, size = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            size += b.column("text").nbytes
        if size >= CHUNK:
            yield _suffixes(held, depth)
            held, size = [], 0
    if held:
        yield _suffixes(held, depth)


def _suffixes(held: list, depth: int) -> Suffixes:
    t = pa.Table.from_batches(held).combine_chunks()
    return Suffixes(t.column("lang").chunk(0), t.column("text").chunk(0), depth)


def _routes(s: Suffixes, hot: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Depth and hash of the prefix that decides each suffix's group."""
    h = s.prefixes()
    depth = np.ones(len(h), np.int64)
    for d, large in enumerate(hot):
        if d + 1 < h.shape[1]:
            depth[(depth == d + 1) & np.isin(h[:, d], large)] = d + 2
    return depth, h[np.arange(len(h)), depth - 1]


def _census(hot, level: int):
    """Counts of the prefixes of ``level`` words below those that are beyond the budget."""

    def merged(rows):
        lang, h, n = (np.concatenate(x) for x in zip(*rows))
        order = np.lexsort((h, lang))
        lang, h, n = lang[order], h[order], n[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (lang[1:] != lang[:-1])
        return lang[new], h[new], np.add.reduceat(n, np.flatnonzero(new))

    def run(batches):
        names, rows, size = {}, [], 0

        def out():
            lang, h, n = merged(rows)
            by = np.array([*names], object)
            for i in range(0, len(h), 10000):
                yield pa.RecordBatch.from_arrays([pa.array(by[lang[i:i + 10000]], pa.string()), pa.array(h[i:i + 10000]),
                                                  pa.array(n[i:i + 10000])], names=["lang", "h", "n"])

        for s in _chunks(batches, level):
            at, h = _routes(s, hot.value if hot else [])
            here = at == level
            if not here.any():
                continue
            code = np.array([names.setdefault(x, len(names)) for x in s.langs.to_pylist()])
            rows.append((code[s.lang[here]], h[here], s.count[here]))
            rows = [merged(rows)]
            if len(rows[0][0]) > GROUP_WORDS:
                yield from out()
                rows = []
        if rows:
            yield from out()

    return run


def _packed(langs: list[str], lang: np.ndarray, level: np.ndarray, count: np.ndarray, text: np.ndarray) -> bytes:
    """Suffixes (in the order of language and level) as one compressed value."""
    names, lang = np.unique(lang, return_inverse=True)
    said = json.dumps([langs[i] for i in names]).encode()
    head = np.array([len(said), len(lang)], np.int64)
    parts = (head, np.frombuffer(said, np.uint8), count.astype(np.int64), lang.astype(np.int32), level.astype(np.uint8), text)
    return squeeze(np.concatenate([np.ascontiguousarray(x).view(np.uint8) for x in parts]))


def _unpacked(blob: bytes):
    """((language, level), counts, text) of each run of suffixes in a packed value."""
    raw = expand(blob)
    size, n = raw[:16].copy().view(np.int64).tolist()
    langs, at = json.loads(raw[16:16 + size].tobytes()), 16 + size
    count = raw[at:at + 8 * n].copy().view(np.int64)
    lang = raw[at + 8 * n:at + 12 * n].copy().view(np.int32)
    level, text = raw[at + 12 * n:at + 13 * n], raw[at + 13 * n:]
    off = np.concatenate([[0], np.flatnonzero(text == 0x0A) + 1])
    begin = np.flatnonzero(np.concatenate([[True], (lang[1:] != lang[:-1]) | (level[1:] != level[:-1])]))
    for a, b in zip(begin.tolist(), [*begin[1:].tolist(), n]):
        yield (langs[lang[a]], int(level[a])), count[a:b], text[off[a]:off[b]]


def _send(depth: int, plan):
    """(group, packed suffixes) of a task's texts: one row a group, more where they are many."""
    schema = pa.schema([("grp", pa.int64()), ("parts", pa.list_(pa.binary()))])

    def rows(held: dict):
        groups = sorted(held)
        for i in range(0, len(groups), 16):
            yield pa.RecordBatch.from_arrays([pa.array(groups[i:i + 16], pa.int64()), pa.array(
                [held.pop(g) for g in groups[i:i + 16]], pa.list_(pa.binary()))], schema=schema)

    def run(batches):
        hot, cuts = plan.value
        held, size = {}, 0
        for s in _chunks(batches, depth):
            if not len(s.count):
                continue
            level, h = _routes(s, hot)
            group = np.searchsorted(cuts, h, "right")
            order = np.lexsort((level, s.lang, group))
            group, lang, level, count = group[order], s.lang[order], level[order], s.count[order]
            begin = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            end = np.append(begin[1:], len(group))
            langs, i = s.langs.to_pylist(), 0
            while i < len(begin):
                j = max(i + 1, int(np.searchsorted(end, begin[i] + TEXTS)))
                first = begin[i]
                data, off = utf8(s.texts(order[first:end[j - 1]]))
                for a, b in zip(begin[i:j].tolist(), end[i:j].tolist()):
                    blob = _packed(langs, lang[a:b], level[a:b], count[a:b], data[off[a - first]:off[b - first]])
                    held.setdefault(int(group[a]), []).append(blob)
                    size += len(blob)
                i = j
            if size > PENDING:
                yield from rows(held)
                held, size = {}, 0
        yield from rows(held)

    return run


NODES = "lang string, phrase string, words int, n long, whole boolean"
_NODES = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("n", pa.int64()),
                    ("whole", pa.bool_())])


def subtree(leaves: np.ndarray, counts: np.ndarray, depth: int):
    """Nodes of the subtree over suffixes (each ended by a new line) with counts: per
    depth the phrases, as a binary array, with the totals of their leaves."""
    kind = (leaves == 0x20) + 2 * (leaves == 0x0A)
    start, end = runs_of(kind == 0, np.array([0, len(leaves)]))
    coded = _binary(end - start, leaves[kind == 0]).dictionary_encode()
    word, closes = coded.indices.to_numpy().astype(np.int64) + 1, leaves[end] == 0x0A
    leaf = np.cumsum(closes) - closes
    first = starts_of(np.bincount(leaf, minlength=len(counts)))[:-1]
    ids = np.zeros((len(counts), depth), np.int64)
    ids[leaf, np.arange(len(word)) - first[leaf]] = word
    order = np.lexsort(ids.T[::-1])
    ids, counts, first = ids[order], counts[order], first[order]
    differs = np.zeros(len(ids), bool)
    for d in range(depth):  # leaves that share d + 1 words stand side by side
        differs[1:] |= ids[1:, d] != ids[:-1, d]
        if len(ids):
            differs[0] = True
        at = np.flatnonzero(differs)
        total = np.add.reduceat(counts, at) if len(at) else counts
        there = ids[at, d] > 0
        at, total = at[there], total[there]
        a, b = start[first[at]], end[first[at] + d]
        yield d + 1, a, b, total


def _grow(depth: int, least: int):
    def run(rows: pa.Table) -> pa.Table:
        out, runs = [], {}
        for parts in rows.column("parts").to_pylist():
            for blob in parts:
                for code, count, text in _unpacked(blob):
                    runs.setdefault(code, []).append((count, text))
        for lang, level in sorted(runs):
            counts, leaves = (np.concatenate(x) for x in zip(*runs.pop((lang, level))))
            for words, a, b, total in subtree(leaves, counts, depth):
                if words >= level:
                    a, b, total = a[total >= least], b[total >= least], total[total >= least]
                if not len(a):
                    continue
                lengths = b - a
                ends = np.cumsum(lengths)
                text = leaves[np.repeat(a - (ends - lengths), lengths) + np.arange(ends[-1])]
                n = len(a)
                out.append(pa.table([
                    pa.array([lang] * n, pa.string()), _binary(lengths, text).cast(pa.binary()).cast(pa.string()),
                    pa.array(np.full(n, words, np.int32)), pa.array(total), pa.array(np.full(n, words >= level))], schema=_NODES))
        return pa.concat_tables(out) if out else _NODES.empty_table()

    return run


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 3,
                  min_count: int = 10, group_words: int | None = None) -> tuple[DataFrame, DataFrame]:
    """All phrases of up to ``max_words`` words that occur ``min_count`` times or more,
    ``(lang, phrase, words, n)``, and the words of each language, ``(lang, n)``."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.col(text_col).alias("text")).where("text is not null")

    def census(level: int, hot) -> DataFrame:
        found = texts.mapInArrow(_census(hot, level), "lang string, h long, n long")
        return written(found.groupBy("lang", "h").agg(F.sum("n").alias("n")), f"prefixes{level}")

    counted = census(1, None)
    totals = written(counted.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    total = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    budget = group_words or max(-(-total // FINEST), min(GROUP_WORDS, total // (2 * partitions(spark))), 1)

    hot: list[np.ndarray] = []
    pool = None
    for level in range(1, max_words):
        by_hash = counted.groupBy("h").agg(F.sum("n").alias("n"))
        fit = by_hash.where(F.col("n") <= budget)
        pool = fit if pool is None else pool.unionByName(fit)
        beyond = by_hash.where(F.col("n") > budget).select("h").toArrow().column("h").to_numpy()
        if not len(beyond):
            break
        hot.append(np.sort(beyond))
        if level + 1 < max_words:
            known = spark.sparkContext.broadcast(hot)
            counted = census(level + 1, known)
            known.destroy()
    bits = min(16, max(0, (total // budget).bit_length()))
    pool = pool.withColumn("cell", F.shiftright("h", 64 - bits) if bits else F.lit(0))
    sofar = F.sum("n").over(Window.partitionBy("cell").orderBy("h").rowsBetween(Window.unboundedPreceding, -1))
    heads = pool.withColumn("grp", F.floor(F.coalesce(sofar, F.lit(0)) / F.lit(budget))).groupBy("cell", "grp").agg(
        F.min("h").alias("h"))
    cuts = np.sort(heads.select("h").toArrow().column("h").to_numpy())

    plan = spark.sparkContext.broadcast((hot, cuts))
    sent = texts.mapInArrow(_send(max_words, plan), "grp long, parts array<binary>")
    nodes = written(sent.groupBy("grp").applyInArrow(_grow(max_words, min_count), NODES), "nodes")
    plan.destroy()
    parts = nodes.where(~F.col("whole")).groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))
    return nodes.where("whole").select("lang", "phrase", "words", "n").unionByName(
        parts.where(F.col("n") >= min_count)), totals


def _left(phrase: Column, k: Column) -> Column:
    return F.call_function("substring_index", phrase, F.lit(" "), k)


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 3,
                 min_count: int = 10, covered: int = 50, first: int = 2000, group_words: int | None = None) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's best phrases.

    A phrase of ``a`` occurrences scores the least floor(1000000 * a * a / (l * r)) over
    its cuts in two (the smallest cut of equal ones); it is left out where a longer
    candidate holds it and has ``covered`` hundredths of its occurrences or more."""
    counts, totals = phrase_counts(docs, text_col, lang_col, max_words, min_count, group_words)
    known = written(counts, "phrases")
    cand = known.where(F.col("words") >= 2).withColumnRenamed("n", "a")
    split = F.split("phrase", " ")
    inner = cand.where(F.col("words") > 2).select("lang", "a", F.col("words").alias("m"), split.alias("w")).select(
        "lang", "a", "m", "w", F.explode(F.sequence(F.lit(2), F.col("m") - 1)).alias("size")).select(
        "lang", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("m") - F.col("size") + 1)).alias("at")).select(
        "lang", F.array_join(F.slice("w", F.col("at"), F.col("size")), " ").alias("phrase"), "a")
    longest = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    free = cand.join(longest, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(covered) * F.col("a"))).drop("longer")
    cuts = free.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).withColumn(
        "left", _left(F.col("phrase"), F.col("k"))).withColumn(
        "right", F.expr("substring(phrase, char_length(left) + 2)"))
    part = lambda side, n: known.select("lang", F.col("phrase").alias(side), F.col("n").alias(n))
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    scored = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"]).withColumns(
        {"above": F.lit(1000000).cast("decimal(7,0)") * (whole("a") * whole("a")).cast("decimal(31,0)"),
         "below": whole("l") * whole("r")}).withColumn("score", F.expr("above div below"))
    best = scored.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), F.col("phrase"))
    top = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
    return top.join(totals, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", F.col("cut.l").alias("l"),
                                           F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
