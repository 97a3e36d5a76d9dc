"""Operators 1, 2 and 5 against brute force, and their defined cases."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from gleaner.llm import chunkdedup, simhash, suffixes
from gleaner.llm.common import connected_components
from tests.llm.conftest import by_text


# -- suffix-array dedup -----------------------------------------------------

def removed_by_hand(rows, m=50):
    first, key = {}, lambda i: (i is None, i or 0)
    for i, t in sorted(rows, key=lambda r: key(r[0])):
        b = (t or "").encode()
        for p in range(len(b) - m + 1):
            first.setdefault(b[p:p + m], key(i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - m + 1):
            if first[b[p:p + m]] < key(i):
                gone[p:p + m] = b"\1" * m
        kept = bytes(x for x, y in zip(b, gone) if not y)
        out.append((i, len(b), sum(gone), len(bytes(gone).replace(b"\0", b" ").split()), hashlib.sha256(kept).hexdigest()))
    return by_text(out)


def removed(docs, **how):
    df = suffixes.remove_repeats(docs, keep_text=False, **how)
    return by_text(tuple(r) for r in df.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept")).collect())


def test_suffix_dedup_equals_brute_force(sf_docs, odd_docs, odd_rows):
    rows = [tuple(r) for r in sf_docs.collect()]
    assert removed(sf_docs) == removed_by_hand(rows)
    want = removed_by_hand(odd_rows)
    assert removed(odd_docs) == want
    assert sum(r[2] for r in want) > 500


def test_suffix_dedup_hot_anchors_do_not_change_results(odd_docs, odd_rows):
    assert removed(odd_docs, hot_share=1e-9, hot_least=2, block_bytes=2000) == removed_by_hand(odd_rows)


def test_suffix_dedup_whole_characters_and_other_columns(spark):
    a = "é" * 40
    rows = [(1, "x" + a, 5, "k"), (2, "yy" + a[:39] + "zé", 6, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_spans int, kept_not string")
    got = {r.doc_id: r for r in suffixes.remove_repeats(df, whole_chars=True).collect()}
    assert got[1].text == rows[0][1] and got[2].text == "yyzé"
    assert got[2].n_spans == 1 and got[2].kept_not is None  # a clashing column is replaced, others stay


def test_suffix_dedup_empty_table(no_docs):
    assert removed(no_docs) == []


def test_deep_shallow_sorts_like_sorted():
    rnd = random.Random(3)
    text = "".join(rnd.choice("ab") for _ in range(300)) + "ab" * 60 + "".join(rnd.choice("ab") for _ in range(300))
    data = np.frombuffer(text.encode(), np.uint8)
    at = np.arange(len(text) - 50)
    order, label = suffixes.deep_shallow_groups(data, at, 50)
    keys = [text[i:i + 50] for i in order]
    assert keys == sorted(text[i:i + 50] for i in at)
    assert [a == b for a, b in zip(label, label[1:])] == [a == b for a, b in zip(keys, keys[1:])]


# -- SimHash ----------------------------------------------------------------

def fingerprint_by_hand(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    shingles = [" ".join(words[j:j + 3]) for j in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def components_by_hand(fps, k=3):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    a = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(a[i] ^ a[i + 1:]) <= k) + i + 1:
            x, y = find(i), find(int(j))
            root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("part_rows", [32768, 60])
def test_links_equal_brute_force_with_dense_groups(spark, part_rows):
    rnd = random.Random(3)
    base = [rnd.getrandbits(64) for _ in range(60)]
    fps = set(base)
    for _ in range(600):
        x = rnd.choice(base[:12])
        for _ in range(rnd.randint(0, 6)):
            x ^= 1 << rnd.randrange(64)
        fps.add(x)
    fps |= {base[0] ^ (rnd.getrandbits(9) << 20) for _ in range(300)}
    fps = sorted(fps)
    df = spark.createDataFrame([(x - 2**64 if x >= 2**63 else x,) for x in fps], "fp long")
    comp = {r.node % 2**64: r.root % 2**64 for r in connected_components(simhash.links(df, 3, part_rows)).collect()}
    got, want = [comp.get(x, x) for x in fps], components_by_hand(fps)
    pairs = set(zip(got, want))
    assert len(pairs) == len(set(got)) == len(set(want))


def test_near_duplicates_equal_brute_force(odd_docs, odd_rows):
    fps = [fingerprint_by_hand(t) for _, t in odd_rows]
    comp = components_by_hand(fps)
    least = {}
    for (i, _), c in zip(odd_rows, comp):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    want = by_text((i, f, least.get(c)) for (i, _), f, c in zip(odd_rows, fps, comp))
    got = by_text((r.doc_id, r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(odd_docs).collect())
    assert got == want


def test_one_of_each_keeps_the_smallest_id_once(spark, no_docs):
    rows = [(3, "same words here again", "c"), (1, "same words here again", "a"), (1, "same words here again", "a"),
            (None, "something else altogether now", "n"), (9, None, "x"), (8, "", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    assert by_text(tuple(r) for r in simhash.one_of_each(df).collect()) == by_text(
        [(1, "same words here again", "a"), (None, "something else altogether now", "n"), (8, "", "y")])
    assert simhash.one_of_each(no_docs).count() == 0


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 2000 + i) for i in range(300)] + [(5, 5), (None, 3)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, **{2000 + i: 1000 for i in range(300)}}


# -- content-defined chunks ---------------------------------------------------

def cuts_by_hand(b):
    out, last = [], 0
    for i in range(len(b)):
        p = i + 1
        if p - last >= 16 and i >= 31 and sum(int(chunkdedup.GEAR[b[i - j]]) << j for j in range(32)) % 2**32 >> 27 == 0:
            out.append(p)
            last = p
        elif p - last == 512:
            out.append(p)
            last = p
    return out + ([len(b)] if last < len(b) else [])


def test_chunk_dedup_equals_brute_force(odd_docs, odd_rows):
    tags = {r[0]: r[1] for r in odd_docs.select("text", F.xxhash64("text")).distinct().collect()}
    place = lambda i, t: (i is None, i or 0, tags[t])
    chunks, first = {}, {}
    for i, t in odd_rows:
        b = (t or "").encode()
        ends = cuts_by_hand(b)
        chunks[i, t] = [b[x:y] for x, y in zip([0, *ends], ends)]
        for n, c in enumerate(chunks[i, t]):
            first[c] = min(first.get(c, (place(i, t), n)), (place(i, t), n))
    want = by_text((i, len((t or "").encode()), len(chunks[i, t]), b"".join(
        c for n, c in enumerate(chunks[i, t]) if first[c] == (place(i, t), n))) for i, t in odd_rows)
    got = by_text((r.doc_id, r.n_bytes, r.n_chunks, bytes(r.kept)) for r in
                  chunkdedup.drop_repeated_chunks(odd_docs).collect())
    assert got == want


def test_short_ends_go_only_with_what_stands_before_them(spark):
    rnd = random.Random(9)

    def body():  # ends where a chunk ends
        text = "".join(chr(rnd.randrange(97, 123)) for _ in range(600))
        return text[:cuts_by_hand(text.encode())[-2]]

    a, b, end = body(), body(), "The end."
    rows = [(1, a + end), (2, b + end), (3, a + end), (4, a + "Other."), (5, end), (6, end), (7, "x" + end)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.kept.decode(), r.n_removed_chunks) for r in chunkdedup.drop_repeated_chunks(df).collect()}
    n = len(cuts_by_hand(a.encode()))
    assert got == {1: (a + end, 0), 2: (b + end, 0), 3: ("", n + 1), 4: ("Other.", n), 5: (end, 0), 6: ("", 1), 7: ("x" + end, 0)}


def test_no_chunk_below_the_least_after_a_longest_one():
    rnd = random.Random(10)
    for n in range(480, 530):
        b = b"a" * n + bytes(rnd.randrange(97, 123) for _ in range(300))
        ends = chunkdedup.cuts(np.frombuffer(b, np.uint8), np.array([0, len(b)]))[0].tolist()
        assert ends == cuts_by_hand(b) and min(np.diff([0, *ends[:-1]])) >= chunkdedup.LEAST


def test_chunks_find_their_places_again_after_an_insertion():
    rnd = random.Random(8)
    body = bytes(rnd.randrange(97, 123) for _ in range(4000))
    cut = lambda b: chunkdedup.cuts(np.frombuffer(b, np.uint8), np.array([0, len(b)]))[0]
    a, b = cut(body), cut(b"some words before" + body) - 17
    assert len(set(a) & set(b)) > 0.95 * len(a)


def test_chunk_dedup_empty_table(no_docs):
    assert chunkdedup.drop_repeated_chunks(no_docs).count() == 0
