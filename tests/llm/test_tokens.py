"""Operators 8 and 10 and the pipeline."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from gleaner.llm import chat, packing, quality, queries
from tests.llm.conftest import SF, by_text
from tests.llm.test_dedup import components_by_hand, fingerprint_by_hand, removed_by_hand
from tests.llm.test_texts import hits_by_hand

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")


# -- packing --------------------------------------------------------------------

@pytest.mark.parametrize("capacity", [64, 4096])
def test_packing_pieces_and_places(odd_docs, odd_rows, capacity):
    tok, want = Tokenizer.from_file(WORD), []
    for i, t in odd_rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a:a + capacity]
            want.append((i, k, a, len(part), zlib.crc32(np.asarray(part, "<u4").tobytes())))
    rows = packing.pack_documents(odd_docs.withColumn("offset", F.lit("x")), WORD, capacity=capacity).collect()
    assert by_text((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == by_text(want)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for v in bins.values():
        v.sort()
        assert [o for o, _ in v] == np.cumsum([0, *(n for _, n in v[:-1])]).tolist() and sum(n for _, n in v) <= capacity
    total = sum(w[3] for w in want)
    assert len(bins) <= 1 + int(np.ceil(total / capacity) * 1.05)


def test_fullest_combination_equals_exhaustive_search():
    rnd = random.Random(2)
    for _ in range(200):
        counts = {rnd.randint(1, 12): rnd.randint(1, 3) for _ in range(rnd.randint(0, 5))}
        room = rnd.randint(0, 30)
        sums = {0}
        for s, n in counts.items():
            sums = {a + s * k for a in sums for k in range(n + 1) if a + s * k <= room}
        got = packing.fullest(counts, room)
        assert sum(s * n for s, n in got) == max(sums) and all(n <= counts[s] for s, n in got)


def test_bin_plan_uses_every_piece_once_and_few_bins():
    rnd = random.Random(4)
    for _ in range(20):
        hist = {rnd.randint(1, 100): rnd.randint(1, 60) for _ in range(rnd.randint(1, 40))}
        used = {}
        plan = packing.bin_plan(hist, 100)
        for times, combo in plan:
            assert sum(s * n for s, n in combo) <= 100
            for s, n in combo:
                used[s] = used.get(s, 0) + n * times
        assert used == hist and len(plan) <= sum(100 // s for s in hist)


def test_units_equal_the_tokenizer_on_awkward_texts():
    tok, known = Tokenizer.from_file(WORD), packing.units(WORD)
    texts = ["It's 'stuff <|endoftext|>x́ é. ªº ÀÉß µm \t a\x1cb c ﬁ ΑΣ ΣΑΣ. İI x.́y", "", "   ", "\n\n", "a.'s b!'t", "A-b (c) |d|",
             "日本語 テスト。 123.45 x²", "e.́ <|startoftext|><|endoftext|>.", "x" * 500, "ÿ Ā ā. ſ K K."]
    ids, begin = known.all_ids(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(begin, begin[1:])] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("memory", [400_000, 50])
def test_units_equal_the_tokenizer_on_random_marks(monkeypatch, memory):
    """Parts of units, upper case, Latin-1 and other letters, and a memory that overflows."""
    monkeypatch.setattr(packing, "MEMORY", memory)
    rnd = random.Random(12)
    tok, known = Tokenizer.from_file(WORD), packing.Units(WORD)
    chars = list("abcXYZéÉßÿÀ×÷ªµ") + list(packing.MARKS) + ["'", "_", "1", "\u0301", "ﬁ", "Ā", "日", "\t", "\x1c", " ", " ", "\n"]
    for _ in range(6):
        texts = ["".join(rnd.choice(chars) for _ in range(rnd.randint(0, 60))) for _ in range(150)] + [None]
        ids, begin = known.all_ids(pa.array(texts))
        for t, a, b in zip(texts, begin, begin[1:]):
            assert ids[a:b].tolist() == tok.encode(t or "", add_special_tokens=False).ids, t


def test_packing_empty_table(no_docs):
    assert packing.pack_documents(no_docs, WORD).count() == 0


# -- chat ------------------------------------------------------------------------

def turns_by_hand(rows):
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((t, r or "", x or ""))
    out = []
    for c, v in by.items():
        v.sort(key=lambda z: (z[0] is not None, z[0] or 0, z[1].encode(), z[2].encode()))
        loss = "".join(x for _, r, x in v if r == "assistant")
        out.append((c, len(v), hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in v).encode()).hexdigest(), len(loss),
                    hashlib.sha256(loss.encode()).hexdigest()))
    return by_text(out)


def test_chat_reads_back_what_went_in(spark):
    rnd = random.Random(5)
    bits = ["<|im_end|>", "<\\|", "<", "|", "\\", "<\\\\|im_start|>", "é", "\n", " ", "x", "<|endoftext|>", "😀", "<|im_sep|>"]
    rows = [(rnd.choice([None, 1, 2, 3]), rnd.choice([None, 0, 1, 2, 3]), rnd.choice([None, "assistant", "user", "a\nb<|im_sep|>"]),
             rnd.choice([None, "", "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 15)))])) for _ in range(200)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, ids string")
    back = lambda d: by_text(tuple(r)[:5] for r in chat.read_back(chat.format_conversations(d, BYTE), BYTE).collect())
    assert back(df) == turns_by_hand(rows) and back(df.limit(0)) == []


def test_chat_output_has_control_ids_only_where_the_template_puts_them(spark):
    said = "<|im_end|><|im_start|>assistant ok"
    df = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    c = chat.codec(BYTE)
    turns = chat.format_conversations(df, BYTE).orderBy("turn_no").collect()
    for t in turns:
        assert [i for i in t.ids if i >= c.start] == [c.start, c.sep, c.end]
    text = "".join(chat.render(t.ids, c) for t in turns)
    assert text.count("<|im_start|>") == 2 and "<\\|im_start|>assistant ok" in text
    row = chat.read_back(chat.format_conversations(df, BYTE), BYTE).first()
    assert row.formatted_chars == len(text) and row.loss_chars == len(said)
    assert turns[1].start == len(turns[0].ids) and turns[0].loss_start == turns[0].loss_end


# -- pipeline ---------------------------------------------------------------------

def test_pipeline_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    weights = quality.fit(docs, labels)
    score = {r.doc_id: r.score for r in quality.score(docs, weights).collect()}
    rows = {i: t for i, t in rows.items() if score[i] >= quality.THRESHOLD}
    ids = sorted(rows)
    comp = components_by_hand([fingerprint_by_hand(rows[i]) for i in ids])
    rows = {i: rows[i] for n, i in enumerate(ids) if comp[n] == n}
    stages = dict(corpus_pipeline.STAGES)
    one = stages["quality_classifier"](spark, docs, SF)
    two = stages["simhash_near_dedup"](spark, one, SF)
    assert {r.doc_id: r.text for r in two.collect()} == rows and two.columns == docs.columns
    three = stages["suffix_array_dedup"](spark, two, SF)
    left = {r.doc_id: r for r in three.collect()}
    removed = {r[0]: r[2] for r in removed_by_hand(list(rows.items()))}
    for i, r in left.items():
        gone = len(rows[i].encode()) - len(r.text.encode())
        assert removed[i] <= gone <= removed[i] + 6 * 4 * max(1, removed[i] // 50) and r.n_chars == len(r.text)
    four = stages["benchmark_decontamination"](spark, three, SF)
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r[0] for r in hits_by_hand([(i, r.text) for i, r in left.items()], bench) if not r[5]}
    assert {r.doc_id for r in four.collect()} == clean and four.columns == docs.columns
    five = stages["best_fit_packing"](spark, four, SF)
    assert {r.doc_id for r in five.select("doc_id").collect()} == clean
    assert corpus_pipeline.run(spark, SF).count() == five.count()


CLASHING = ("score", "kept", "n_hit", "fp", "component_id", "n_removed", "items", "contaminated", "_sa_ord", "_sh_row", "n_words",
            "shards", "_doc_0", "piece")


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_a_users_columns(spark, odd_docs, name):
    """Null, empty, repeated and very long rows; every other column comes back as it was."""
    stage = dict(corpus_pipeline.STAGES)[name]
    own = {c: F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in CLASHING}
    docs = odd_docs.withColumns({"n_chars": F.length("text").cast("int"), **own})
    out = stage(spark, docs, SF)
    assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    rows = out.collect()
    assert all(r[c] == f"{c} of {'none' if r.doc_id is None else r.doc_id}" for r in rows for c in CLASHING)
    plain = by_text((r.doc_id, r.text) for r in stage(spark, odd_docs, SF).select("doc_id", "text").collect())
    assert by_text((r.doc_id, r.text) for r in rows) == plain and plain
    assert stage(spark, docs.limit(0), SF).collect() == []


def _features_by_hand(text):
    """Words and pairs as texts; the hash only names them."""
    import re

    words = re.findall(rb"[0-9A-Za-z\x80-\xff]+|[!-/:-@\[-`{-~]+", (text or "").encode())
    out = []
    for i, w in enumerate(words):
        out.append((w,))
        if i + 1 < len(words):
            out.append((w, w) if w == words[i + 1] else (w, words[i + 1]))
    return out


def test_quality_features_are_words_and_pairs(odd_rows):
    """Hashed features fall together exactly as the words and pairs do."""
    texts = [t for _, t in odd_rows]
    data, off = quality.utf8(pa.array(texts, pa.string()))
    feat, n = quality.features(data, off, bits=31)
    want = [_features_by_hand(t) for t in texts]
    assert n.tolist() == [len(x) for x in want]
    name = {}
    for f, w in zip(feat.tolist(), [x for row in want for x in row]):
        w = ("again",) + () if len(w) == 2 and w[0] == w[1] else w
        assert name.setdefault(f, w) == w
    assert len(set(name.values())) == len(name)


def test_quality_training_equals_a_plain_loop():
    """FTRL-proximal, one coordinate at a time, with and without L1."""
    import math

    rnd = random.Random(3)
    rows = [(np.array(sorted(rnd.sample(range(16), 4))), np.array([rnd.random() for _ in range(4)]), rnd.randint(0, 1)) for _ in range(60)]
    for l1 in (0.0, 40.0):
        z, n = [0.0] * 17, [0.0] * 17

        def weight(i):
            if abs(z[i]) <= l1:
                return 0.0
            return (math.copysign(l1, z[i]) - z[i]) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)

        for _ in range(2):
            for at, share, label in rows:
                x = {int(i): float(v) * quality.SCALE for i, v in zip(at, share)} | {16: 1.0}
                w = {i: weight(i) for i in x}
                p = 1 / (1 + math.exp(-max(-35, min(35, sum(w[i] * x[i] for i in x)))))
                for i, v in x.items():
                    g = (p - label) * v
                    z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA * w[i]
                    n[i] += g * g
        got = quality.train(rows, bits=4, epochs=2, l1=l1)
        assert np.allclose(got, [weight(i) for i in range(17)], rtol=1e-9, atol=1e-12)
        assert (l1 == 0) or (got == 0).any()


def test_equal_texts_score_equal_bit_for_bit(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 1000))
    weights = np.random.default_rng(5).normal(size=(1 << quality.BITS) + 1)
    scores = [{r.doc_id: r.score for r in quality.score(d, weights).collect()} for d in (
        docs.repartition(1), docs.repartition(7), docs.orderBy(F.col("text").desc()), docs.repartition(50, "doc_id"))]
    assert all(s == scores[0] for s in scores)
    assert all(scores[0][i] == scores[0][i + 1000] for i in scores[0] if i < 1000)


def test_quality_fit_collects_a_bounded_sample(spark):
    """Repeated labelled rows and ids do not widen what reaches the driver."""
    rows = [(i % 3, f"word{i % 7} good text") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(3)] * 5, "doc_id long, quality int, toxic int")
    assert quality.sample(docs, labels, max_train=9).count() == 9


def test_registered_queries_return_every_row(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op3_license_scan", "op6_quality_classifier", "op7_token_counts"):
        assert queries.QUERIES[name](spark, SF).count() == n
