"""Operators 3, 4, 6, 7 and 9 against brute force, and their defined cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from gleaner.llm import decontam, licenses, parsing, quality, tokencount
from tests.llm.conftest import SF, WORDS, by_text


# -- licences -----------------------------------------------------------------

def test_licences_own_inherited_and_none(spark):
    long = "word " * 60
    rows = [("a/LICENSE", f"Released under the MIT License.\n{long}"), ("a/b/c.txt", None), ("a/b/c.txt", None),
            ("a/b/d/e.txt", "nothing said"), ("a/b/d/COPYING", "Licensed under CC BY-NC 4.0."), ("q/r.txt", ""),
            ("top.txt", "x"), (None, "Released under the MIT License"), ("a/z.txt", f"{long}\nReleased under the MIT License.\n{long}"),
            ("a/bb/x", "It is licensed, they say"), ("ab/x", "y")]
    df = spark.createDataFrame([(p, t, 1, "old") for p, t in rows], "path string, text string, score int, extra string")
    got = by_text((r.path, r.license, r.how, r.from_path, r.extra) for r in licenses.scan(df).collect())
    assert got == by_text([
        ("a/LICENSE", "MIT", "own", "a/LICENSE", "old"), ("a/b/c.txt", "MIT", "inherited", "a/LICENSE", "old"),
        ("a/b/c.txt", "MIT", "inherited", "a/LICENSE", "old"),
        ("a/b/d/e.txt", "CC-BY-NC-4.0", "inherited", "a/b/d/COPYING", "old"),
        ("a/b/d/COPYING", "CC-BY-NC-4.0", "own", "a/b/d/COPYING", "old"), ("q/r.txt", "unknown", "none", None, "old"),
        ("top.txt", "unknown", "none", None, "old"), (None, "MIT", "own", None, "old"), ("a/z.txt", "MIT", "own", "a/z.txt", "old"),
        ("a/bb/x", "MIT", "inherited", "a/LICENSE", "old"), ("ab/x", "unknown", "none", None, "old")])
    assert licenses.scan(df.limit(0)).count() == 0


def test_licence_cosine_by_hand(spark):
    names, vectors, idf, unknown = licenses.template_vectors()
    text = "Licensed under the Apache licence, version two: the version of foo"
    terms = re.findall("[a-z0-9]+", text.lower())
    weight = {t: (1 + np.log(terms.count(t))) * idf[t] if t in idf else unknown for t in set(terms)}
    norm = np.sqrt(sum(w * w for w in weight.values()))
    score = [sum(w * vectors[t][i] for t, w in weight.items() if t in vectors) / norm for i in range(len(names))]
    best = int(np.argmax(score))
    got = spark.createDataFrame([(text,)], "text string").select(licenses.closest(F.col("text")).alias("c")).first().c
    assert got.name == names[best] and abs(got.score - score[best]) < 1e-6


def test_licence_headers_tags_and_wrapped_notices(spark):
    gnu = ("/* This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU{} General "
           "Public License as published by\n * the Free Software Foundation, either version {} of the License, or\n"
           " * (at your option) any later version.\n *\n * This program is distributed in the hope\n */\nint main();")
    bsd = ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the "
           "following conditions are met:\n\n1. Redistributions of source code must retain the notice.\n")
    cases = {"All rights reserved.": "All-Rights-Reserved", "Copyright (c) 2020 A. Body. All rights reserved.\n\ncode": "All-Rights-Reserved",
             "# SPDX-License-Identifier: MIT": "MIT", "// SPDX-License-Identifier: Apache-2.0\ncode": "Apache-2.0",
             "SPDX-License-Identifier: GPL-2.0-or-later": "GPL-2.0", "SPDX-License-Identifier: (MIT OR Apache-2.0)": "MIT OR Apache-2.0",
             gnu.format("", 3): "GPL-3.0", gnu.format("", 2): "GPL-2.0", gnu.format(" Lesser", 3): "LGPL-3.0",
             gnu.format(" Affero", 3): "AGPL-3.0",
             "prose before it\nThis work is licensed under the GNU General\nPublic License, version 3\nand prose after it": "GPL-3.0",
             "All rights reserved.\n" + bsd: "BSD-2-Clause",
             bsd + "\n3. Neither the name of X nor the names may be used to endorse or\npromote products": "BSD-3-Clause",
             "All rights are reserved for those who wait": "unknown", "You have permission to use the table": "unknown"}
    df = spark.createDataFrame([(f"d{i}/x", t) for i, t in enumerate(cases)], "path string, text string")
    got = {r.path: r.license for r in licenses.scan(df).collect()}
    assert {t: got[f"d{i}/x"] for i, t in enumerate(cases)} == cases


def test_licence_prefilter_loses_no_match():
    for templates in (licenses.TEMPLATES, licenses.NOTICES):
        marks, vectors = set(licenses.mark_terms(templates)), licenses.template_vectors(templates)[1]
        for i, (_, text) in enumerate(templates):
            rest = set(licenses._terms(text)) - marks
            assert sum(vectors[t][i] ** 2 for t in rest) < licenses.LINE_SCORE ** 2


def test_licence_scan_has_no_python(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").withColumn("path", F.concat_ws("/", "source", "doc_id"))
    plan = licenses.scan(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


# -- locally consistent parsing --------------------------------------------------

def study_by_hand(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()), reverse=True)
    out = []
    for k, (i, t) in enumerate(order):
        t, x = t or "", order[(k + 1) % len(order)][1] or ""
        e = t[:len(t) - len(t) // 2] + x[:len(t) // 2]
        a, b, c = (parsing.fingerprints([v.encode()]) for v in (t, e, x))
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), parsing.hexes(a)[0], parsing.hexes(b)[0],
                    float(parsing.likeness(a, b)[0]), float(parsing.likeness(a, c)[0])))
    return by_text(out)


def test_edit_study_equals_brute_force(spark, odd_docs, odd_rows, sf_docs):
    study = lambda df: by_text(tuple(r) for r in parsing.edit_study(df).collect())
    assert study(odd_docs) == study_by_hand(odd_rows)
    assert study(spark.createDataFrame([(7, "only one")], "doc_id long, text string")) == study_by_hand([(7, "only one")])
    assert study(odd_docs.limit(0)) == []
    rows = [r for r in study(sf_docs) if r[1] > 300]
    assert np.mean([r[5] for r in rows]) > 0.4 and np.mean([r[6] for r in rows]) < 0.1


def test_equal_substrings_share_names_at_any_offset():
    rnd = random.Random(5)
    body = " ".join(rnd.choice(WORDS) + str(rnd.randrange(50)) for _ in range(900)).encode()
    a, b, c, d = (parsing.fingerprints([x]) for x in (body, b"#" * 13 + body, body[700:] + body[:700], bytes(reversed(body))))
    assert parsing.likeness(a, a)[0] == 1 and parsing.likeness(a, b)[0] > 0.95 and parsing.likeness(a, c)[0] > 0.9
    assert parsing.likeness(a, d)[0] < 0.3
    names = lambda x: set(parsing.phrases(np.frombuffer(x, np.uint8), np.array([0, len(x)]))[0])
    assert len(names(body) & names(b"??" + body)) >= 0.95 * len(names(body))


def test_fingerprint_does_not_depend_on_the_batch():
    texts = [b"", b"a", b"aaaaaaa", "é日😀".encode() * 30, b"abc" * 50, b"", b"xyz uvw"]
    assert (parsing.from_hex(parsing.hexes(parsing.fingerprints(texts))) == parsing.fingerprints(texts)).all()
    assert (parsing.fingerprints(texts) == np.concatenate([parsing.fingerprints([t]) for t in texts])).all()


# -- quality -------------------------------------------------------------------

def test_quality_held_out_accuracy_and_inputs(spark):
    docs = spark.read.parquet(f"{SF}/../sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/../sf0.01/labels.parquet")
    weights = quality.fit(docs, labels)
    score = {r.doc_id: r.score for r in quality.score(docs, weights).collect()}
    held = [(r.doc_id, r.quality) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 50 and np.mean([(score[i] >= quality.THRESHOLD) == q for i, q in held]) > 0.93
    # Held-out labels change nothing.
    turned = labels.withColumn("quality", F.when(quality.checksum_part() == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert (quality.fit(docs, turned) == weights).all()
    assert (quality.fit(docs.repartition(7), labels.repartition(5)) == weights).all()


def test_quality_defined_cases(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    weights = quality.fit(odd_docs, none)
    assert {r.score for r in quality.score(odd_docs, weights).collect()} == {0.5}
    some = spark.createDataFrame([(1, 1), (5, 1), (7, 0), (None, 1), (8, None)], "doc_id long, quality int")
    weights = quality.fit(odd_docs, some)
    rows = quality.score(odd_docs.withColumn("score", F.lit("x")), weights, keep_text=True).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    assert quality.score(no_docs, weights).count() == 0


# -- token counts ----------------------------------------------------------------

def test_token_counts_equal_the_library(odd_docs, no_docs, sf_docs):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = SentencePieceProcessor(model_file=path)
    for docs in (odd_docs, sf_docs):
        got = by_text(tuple(r) for r in tokencount.token_counts(docs, path, limit=100).collect())
        want = [(i, len((t or "").encode()), len(model.encode(t or ""))) for i, t in docs.collect()]
        assert got == by_text((*w, w[2] > 100) for w in want)
    assert tokencount.token_counts(no_docs, path).count() == 0


def test_pre_tokens_on_awkward_texts():
    counts = tokencount.piece_counts(public_tokenizers.path("piece_bpe_32k.model"))
    assert counts.separable and all(n == 1 for n in counts.proved.values()) and len(counts.proved) > 10_000
    rnd = random.Random(1)
    bits = ["a", "the", " ", "  ", "\n", "\n\n", "▁", "▁▁", "<s>", "</s>", "<unk>", "é", "日", "\t", "\r", ".", "\x00", "<0x0A>", "😀"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 12))) for _ in range(3000)]
    assert counts.count(texts) == [len(x) for x in counts.model.encode(texts)]


# -- decontamination ---------------------------------------------------------------

def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def hits_by_hand(docs, items):
    windows = {}
    for i, t in items:
        w = words_of(t)
        for x in [w] if 0 < len(w) < 10 else [w[j:j + 10] for j in range(len(w) - 9)]:
            windows.setdefault(tuple(x), set()).add("" if i is None else str(i))
    sizes, out = {len(x) for x in windows}, []
    for i, t in docs:
        w, hit, found = words_of(t), set(), set()
        for n in sizes:
            for j in range(len(w) - n + 1):
                if tuple(w[j:j + n]) in windows:
                    hit.update(range(j, j + n))
                    found |= windows[tuple(w[j:j + n])]
        out.append((i, len(w), len(hit), len(found), sorted(found), bool(hit)))
    return by_text(out)


@pytest.fixture(scope="module")
def items(odd_rows):
    passage = words_of(dict(odd_rows)[10])
    return [(1, " ".join(passage[5:30])), (1, "zz"), (None, " ".join(passage[8:18])), (4, None), (5, ""), (6, "..."),
            (7, "x9 éa"), (8, " ".join(passage[20:40]) + " not there at all " + " ".join(passage[:12])), (8, "ZZ")]


def test_contamination_equals_brute_force(spark, odd_docs, odd_rows, items, sf_docs, no_docs):
    bench = spark.createDataFrame(items, "item_id long, text string")
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items", "contaminated"]
    got = lambda df: by_text(tuple(r) for r in df.select(*cols).collect())
    want = hits_by_hand(odd_rows, items)
    assert got(decontam.contamination(odd_docs.withColumn("n_hit", F.lit("x")), bench)) == want and any(r[5] for r in want)
    # Several blocks of windows and many shards give the same.
    shards = decontam.build_index(odd_docs, shard=500)
    assert got(decontam.report(decontam.search(shards, bench, block_windows=7), odd_docs.select("doc_id").schema)) == want
    sf_bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert got(decontam.contamination(sf_docs, sf_bench)) == hits_by_hand(
        [tuple(r) for r in sf_docs.collect()], [tuple(r) for r in sf_bench.collect()])
    assert got(decontam.contamination(odd_docs, bench.limit(0))) == hits_by_hand(odd_rows, [])
    assert got(decontam.contamination(no_docs, bench)) == []


def test_proximity_matches_allow_words_off_their_place(spark):
    docs = spark.createDataFrame([(1, "one two three four"), (2, "one two really three four"), (3, "one x y z w two three four")],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(9, "one two three four")], "item_id long, text string")
    near = lambda slop: {r.doc_id for r in decontam.matches(
        decontam.search(decontam.build_index(docs), bench, slop=slop), docs.schema["doc_id"].dataType).collect()}
    assert near(0) == {1} and near(1) == {1, 2} and near(4) == {1, 2, 3}
