"""Operators 11, 12 and 13 against brute force, and their defined cases."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.llm import chosenpath, negatives, phrases
from tests.llm.conftest import by_text

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# -- hard negatives ---------------------------------------------------------

def test_strassen_is_exact_for_any_shape():
    rnd = np.random.default_rng(4)
    for m, k, n in [(1, 1, 1), (3, 5, 7), (64, 64, 64), (65, 33, 129), (100, 7, 2), (37, 200, 91)]:
        a, b = rnd.integers(-2**40, 2**40, (m, k)), rnd.integers(-2**15, 2**15, (n, k))
        want = (a.astype(object) @ b.T.astype(object)).astype(np.int64)
        assert (negatives.strassen(a, b, leaf=4) == want).all()


def mined_by_hand(rows, is_anchor, n_pos=5, n_neg=10):
    kept = [(i, v, lab) for i, v, lab in rows if lab is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v)]
    whole = [[math.floor(256 * x) for x in v] for _, v, _ in kept]
    rank = lambda s, k: (-s, kept[k][0] is None, kept[k][0] or 0, k)
    out = []
    for a, (i, _, lab) in enumerate(kept):
        if not is_anchor(i):
            continue
        s = [sum(x * y for x, y in zip(whole[a], w)) for w in whole]
        pos = sorted((k for k in range(len(kept)) if k != a and kept[k][2] == lab), key=lambda k: rank(s[k], k))[:n_pos]
        for p in pos:
            neg = sorted((k for k in range(len(kept)) if kept[k][2] != lab and 30 * s[p] <= 100 * s[k] <= 90 * s[p]),
                         key=lambda k: rank(s[k], k))[:n_neg]
            out += [(i, kept[p][0], r + 1, kept[k][0], s[p], s[k]) for r, k in enumerate(neg)]
    return by_text(out)


def _vectors():
    rnd = random.Random(6)
    rows = [(i, [rnd.choice([rnd.uniform(-1, 1), 0.5, 0.25]) for _ in range(5)], rnd.randint(0, 3)) for i in range(150)]
    same = [0.5, 0.5, 0.5, 0.5, 0.5]
    rows += [(i, same, 1) for i in range(200, 260)] + [(i, [0.25] * 5, 2) for i in range(300, 340)]  # ties
    rows += [(400, same, 1), (400, same, 1), (None, same, 1), (None, [0.25] * 5, 3), (401, None, 1), (402, same, None),
             (403, [0.5, None], 1), (404, [0.5, float("nan")], 1), (405, [float("inf")], 1), (406, [], 1), (407, [0.5], 2),
             (410, same, 9), (-10, same, 1)]
    return rows


@pytest.mark.parametrize("tiles", [(256, 1024), (3, 7)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, tiles):
    monkeypatch.setattr(negatives, "ANCHOR_TILE", tiles[0])
    monkeypatch.setattr(negatives, "ROW_TILE", tiles[1])
    monkeypatch.setattr(negatives, "ANCHOR_STRIPE", 9)
    rows = _vectors()
    df = spark.createDataFrame([(*r, "no", 5) for r in rows], "vec_id long, embedding array<float>, label int, score string, anchor int")
    got = by_text(tuple(r) for r in negatives.mine(df.repartition(3), F.col("vec_id") % 10 == 0).collect())
    want = mined_by_hand(rows, lambda i: i is not None and i % 10 == 0)
    assert got == want and len(want) > 300


def test_hard_negatives_defined_cases(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert negatives.mine(empty).collect() == []
    lone = spark.createDataFrame([(0, [1.0], 1), (1, [1.0], 2)], "vec_id long, embedding array<double>, label int")
    assert negatives.mine(lone).collect() == []
    huge = spark.createDataFrame([(0, [1e9], 1), (1, [1e9], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="do not fit"):
        negatives.mine(huge).collect()


# -- phrase collocations ----------------------------------------------------

def phrases_by_hand(rows, max_words=3, min_count=10, covered=50, first=2000):
    from collections import Counter, defaultdict

    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, max_words + 1):
                for i in range(len(w) - m + 1):
                    f[lang][tuple(w[i:i + m])] += 1
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) >= 2 and a >= min_count}
        rows = []
        for p, a in cand.items():
            if any(100 * b >= covered * a for q, b in cand.items() if len(q) > len(p)
                   and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))):
                continue
            score, k = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:first])]
    return by_text(out)


def _said():
    rnd = random.Random(9)
    words = ["the", "The", "of", "a", "new", "york", "city", "é", "ß", "日", "x y", "\x01", "\x1c", "a\x00b", "in", "on"]
    text = lambda k: "".join(rnd.choice(words) + rnd.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "!"]) for _ in range(k))
    rows = [(rnd.choice(["en", "de", None, "und", ""]), text(rnd.randint(0, 90))) for _ in range(60)]
    rows += [("en", "new york city " * 40), ("en", None), (None, ""), ("de", "one"), ("xx", "the " * 500), ("xx", "..., \n")]
    return rows + rows[:5]


@pytest.mark.parametrize("how", [{}, {"group_words": 1}, {"group_words": 60}, {"max_words": 4, "group_words": 25}, {"max_words": 2}])
def test_phrases_equal_brute_force_for_any_partitioning(spark, how):
    rows = _said()
    df = spark.createDataFrame([(*r, 7, "z") for r in rows], "lang string, text string, phrase int, n string").repartition(3)
    cols = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = by_text(tuple(r) for r in phrases.collocations(df, min_count=4, **how).select(*cols).collect())
    want = phrases_by_hand(rows, how.get("max_words", 3), 4)
    assert got == want and len(want) > 40


def test_phrases_defined_cases(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(empty).collect() == []
    blank = spark.createDataFrame([("en", None), (None, ""), ("en", "..")], "lang string, text string")
    assert phrases.collocations(blank).collect() == []
    long = spark.createDataFrame([("en", "x" * 3_000_000 + " y " + "a b. " * 400_000)], "lang string, text string")
    assert [tuple(r) for r in phrases.collocations(long).collect()] == [
        ("en", 1, "a b", 400_000, 400_000, 400_000, 800_002, 1_000_000)]


def test_phrase_scores_are_exact_beyond_64_bits(spark):
    """One text of 3 million repeats: 1000000 * a * a passes 64 bits."""
    a = 3_100_000
    df = spark.createDataFrame([("en", "a b." * a + "a c.")], "lang string, text string")
    r = phrases.collocations(df).collect()
    assert [tuple(x) for x in r] == [("en", 1, "a b", a, a + 1, a, 2 * a + 2, 1000000 * a * a // ((a + 1) * a))]
    assert 1000000 * a * a > 2**63


# -- MinHash near-duplicates ------------------------------------------------

def components_by_hand(rows, shingle=5, percent=85):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets.append({tuple(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    ids = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            ids[find(k)] = min(ids.get(find(k), i), i)
    return by_text((i, len(sets[k]), ids.get(find(k)), i == ids.get(find(k))) for k, (i, _) in enumerate(rows))


def near(docs, **how):
    got = chosenpath.near_duplicates(docs, **how).select("doc_id", "n_shingles", "component_id", "kept")
    return by_text(tuple(r) for r in got.collect())


def _copies(edits, n, seed=2):
    """Groups of near copies with ``edits`` changed words, chains among them, and a common passage."""
    rnd = random.Random(seed)
    word = lambda: rnd.choice("abcdefghij") + rnd.choice("klmnop") + rnd.choice("qrstuvwxyz")
    common, rows = [word() for _ in range(60)], []
    for g in range(4):
        base = [word() for _ in range(rnd.randint(80, 120))]
        for k in range(n):
            w = list(base)
            for _ in range(rnd.choice(edits)):
                w[rnd.randrange(len(w))] = word()
            base = w if k % 7 == 0 else base
            rows.append((len(rows), " ".join(w)))
    rows += [(len(rows) + k, " ".join(common + [word() for _ in range(20 + k)])) for k in range(30)]
    return rows


def test_near_duplicates_equal_brute_force(spark, odd_docs, odd_rows):
    assert near(odd_docs) == components_by_hand(odd_rows)
    rows = _copies([0, 1, 2, 3], 25)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = components_by_hand(rows)
    assert near(docs) == want
    assert 4 < sum(r[3] for r in want) < len(rows) - 40


def test_large_nodes_and_families_do_not_change_results(spark):
    """Nodes of two and parts of a few sets: pivots, deeper levels and pairs of parts do the work."""
    rows = _copies([0, 1, 2, 3], 20, seed=7)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert near(docs, small=2, part=400) == components_by_hand(rows)


def test_near_duplicates_defined_cases(spark, no_docs):
    assert near(no_docs) == []
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (None, "one"), (3, "ONE"), (3, "one"), (4, None), (5, "")]
    df = spark.createDataFrame([(*r, 8, "x", False) for r in rows], "doc_id long, text string, n_shingles int, sig string, kept boolean")
    got = chosenpath.near_duplicates(df)
    assert got.columns == ["doc_id", "sig", "n_shingles", "component_id", "kept"]
    assert by_text(tuple(r) for r in got.drop("sig").collect()) == by_text([
        (None, 2, None, True), (None, 2, None, True), (None, 1, 3, False), (3, 1, 3, True), (3, 1, 3, True), (4, 0, 4, True), (5, 0, 5, True)])
    long = " ".join(str(k) for k in range(300_000))
    rows = [(1, long), (2, long + " z"), (3, long[: len(long) // 2])]
    assert near(spark.createDataFrame(rows, "doc_id long, text string")) == components_by_hand(rows)
