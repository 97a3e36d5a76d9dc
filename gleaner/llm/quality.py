"""Quality classifier: logistic regression on hashed word n-grams, trained with
follow-the-regularised-leader updates.

Words are runs of letters, digits and non-ASCII characters, and runs of other
visible characters; case counts.  Features are the hashed words and pairs of
neighbouring words (a word after itself is one feature of its own); a feature's
value is its share of the text's features.  The score is the logistic function
of the bias plus the sparse dot product with the weights.

Training reads at most ``max_train`` labelled texts (the documented bound): those
of the training part with the smallest hashes of their ids, in that order, so the
sample does not depend on where rows lie.  Nothing but the text enters a score.

Defined cases: null text is empty, an empty text scores the bias; rows with a
null label are not learnt from, and without any labels all scores are 0.5; a null
id counts as the empty id (its checksum is 0: held out); an empty table gives an
empty table; columns named like an output are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.llm.arrays import GOLD, U64, hash_runs, mix64, runs_of, starts_of, utf8
from gleaner.llm.common import small_batches

BITS = 18
MAX_TRAIN = 8000
EPOCHS = 3
#: Follow-the-regularised-leader settings: rate, its offset, L1 and L2.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.0, 0.02
SCALE = 100.0
#: Texts that score less are rejected.
THRESHOLD = 0.3

_BYTE = np.arange(256)
_WORD = ((_BYTE >= 0x30) & (_BYTE <= 0x39)) | (((_BYTE | 32) >= 0x61) & ((_BYTE | 32) <= 0x7A)) | (_BYTE >= 0x80)
_MARK = ~_WORD & (_BYTE > 0x20) & (_BYTE != 0x7F)
_VALUE = mix64(_BYTE.astype(U64) + U64(1))
_AGAIN = U64(0x5851F42D4C957F2D)


def features(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(hashed features of all texts in turn, features of each text)."""
    s1, e1 = runs_of(_WORD[data], offsets)
    s2, e2 = runs_of(_MARK[data], offsets)
    start, end = np.concatenate([s1, s2]), np.concatenate([e1, e2])
    by = np.argsort(start, kind="stable")
    start, end = start[by], end[by]
    words = hash_runs(_VALUE[data], start, end)
    at = np.searchsorted(start, offsets)
    n = np.diff(at)
    pair = np.zeros(len(words), U64)
    pair[:-1] = np.where(words[:-1] == words[1:], _AGAIN, mix64(words[:-1] * GOLD + words[1:]))
    has = np.ones(len(words), bool)
    has[at[1:][n > 0] - 1] = False  # the last word of a text has no neighbour
    both = np.stack([words, pair], 1).ravel()
    keep = np.stack([np.ones(len(words), bool), has], 1).ravel()
    return (both[keep] >> U64(64 - bits)).astype(np.int32), 2 * n - (n > 0)


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], bits: int = BITS, epochs: int = EPOCHS,
          l1: float = L1) -> np.ndarray:
    """Weights (the bias last) from (features, shares, label) rows, in order."""
    size = (1 << bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    w = np.zeros(size)
    for _ in range(epochs):
        for at, share, label in rows:
            at = np.append(at, size - 1)
            x = np.append(share * SCALE, 1.0)
            zi, ni = z[at], n[at]
            wi = np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((BETA + np.sqrt(ni)) / ALPHA + L2))
            g = (1 / (1 + np.exp(-np.clip(wi @ x, -35, 35))) - label) * x
            z[at] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * wi
            n[at] = ni + g * g
    live = np.abs(z) > l1
    w[live] = (np.sign(z[live]) * l1 - z[live]) / ((BETA + np.sqrt(n[live])) / ALPHA + L2)
    return w


def checksum_part(id_col: str = "doc_id", parts: int = 5) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(parts))


def sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           label_col: str = "quality", max_train: int = MAX_TRAIN, bits: int = BITS) -> DataFrame:
    """``(place, id, label, features, shares)`` of at most ``max_train`` labelled texts outside
    the held-out part, in order: those with the smallest hashes of their ids.  Neither
    repeated rows nor long texts (2**bits features at most) widen it."""
    small_batches(docs.sparkSession)
    chosen = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (checksum_part(id_col) != 0))
              .select(F.col(id_col).alias("_q_id"), F.col(label_col).cast("int").alias("label"),
                      F.xxhash64(F.col(id_col)).alias("place"))
              .orderBy("place", "_q_id", "label").limit(max_train))
    # Bounded by max_train rows of three numbers, so it may be broadcast.
    texts = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_q_text")).join(
        F.broadcast(chosen), F.col(id_col) == F.col("_q_id")).select("place", "_q_id", "label", "_q_text")

    def run(batches):
        for b in batches:
            feat, n = features(*utf8(b.column("_q_text")), bits)
            rows = []
            for x in np.split(feat, starts_of(n)[1:-1]) if len(n) else []:
                f, c = np.unique(x, return_counts=True)
                rows.append((f.astype("<i4").tobytes(), (c / max(1, c.sum())).astype("<f4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [b.column("place"), b.column("_q_id").cast(pa.int64()), b.column("label"),
                 pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary())],
                names=["place", "id", "label", "features", "shares"])

    return texts.mapInArrow(run, "place long, id long, label int, features binary, shares binary").orderBy(
        "place", "id", "label", "features").limit(max_train)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", max_train: int = MAX_TRAIN, bits: int = BITS) -> np.ndarray:
    """Weights learnt from the labelled rows outside the held-out part (``sample``)."""
    got = sample(docs, labels, id_col, text_col, label_col, max_train, bits).collect()
    return train([(np.frombuffer(r["features"], "<i4"), np.frombuffer(r["shares"], "<f4").astype(float), r["label"])
                  for r in got], bits)


def score(docs: DataFrame, weights: np.ndarray, text_col: str = "text", keep_text: bool = False,
          bits: int = BITS) -> DataFrame:
    """``docs`` with ``score``: how likely label 1 is, from 0 to 1."""
    small_batches(docs.sparkSession)
    fields = [f for f in docs.schema.fields if f.name != "score" and (keep_text or f.name != text_col)]
    src = docs.withColumn("_q_text", F.col(text_col).cast("string")).drop(*([] if keep_text else [text_col]))
    schema = T.StructType(fields + [T.StructField("score", T.DoubleType())])
    # 2**bits numbers: the bound of what is broadcast.
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        w = shared.value
        for b in batches:
            feat, n = features(*utf8(b.column("_q_text")), bits)
            # Each text's own sum, in the order of its own features: what stands before it in the
            # batch does not enter.
            dot, some = np.zeros(len(n)), np.flatnonzero(n)
            for i, x in zip(some.tolist(), np.split(w[feat], starts_of(n[some])[1:-1]) if len(some) else []):
                dot[i] = x.sum()
            dot = dot / np.maximum(n, 1) * SCALE + w[-1]
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in fields),
                                              pa.array(1 / (1 + np.exp(-np.clip(dot, -35, 35))))], names=schema.names)

    return src.mapInArrow(run, schema)
