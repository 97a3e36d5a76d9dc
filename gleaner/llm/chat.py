"""Chat formatting by token-level assembly.

A turn becomes: the reserved id that opens a turn, the role's ids, the reserved id
before the content, the content's ids, the reserved id that ends the turn.  Role
and content are encoded separately and the reserved ids are spliced in, so no
merge ever joins text and control marks; the loss mask covers exactly the ids of
an assistant's content, its place in the conversation being a prefix sum of the
lengths before it.

Control strings inside texts are escaped so that the rendered form cannot be
misread either: ``<|`` becomes ``<\\|``, and each ``<\\...|`` gains one backslash,
which is undone on reading.

A conversation is a sequence of rows (one per turn, in order), never one value:
a conversation with very many turns streams through a task in constant memory.

Defined cases: null role and text are empty; turns are ordered by (turn, role,
text), nulls first; a null conversation id is a conversation of its own; repeated
rows are repeated turns; an empty table gives an empty table; further input
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from gleaner.llm.common import partitions, small_batches

#: The template's control strings, in the order of the ids reserved for them
#: after the tokenizer's own.
CONTROL = ("<|im_start|>", "<|im_sep|>", "<|im_end|>")
TRAINED_ROLE = "assistant"
_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


class Codec:
    """A byte-level tokenizer file plus the reserved ids."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.start, self.sep, self.end = range(size, size + len(CONTROL))
        # Bytes as the characters of byte-level vocabularies: printable Latin-1
        # stands for itself, the others follow from U+0100 on in order.
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = iter(range(256, 512))
        byte = {chr(b) if b in own else chr(next(rest)): b for b in range(256)}
        self.bytes = []
        for i in range(size):
            token = self.tokenizer.id_to_token(i) or ""
            self.bytes.append(bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def decode(self, ids: list[int]) -> str:
        return b"".join([self.bytes[i] for i in ids]).decode("utf-8")


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


TURNS = ("turn", "role", "text")


def format_conversations(conversations: DataFrame, tokenizer: str, conv_col: str = "conv_id") -> DataFrame:
    """One row per turn: ``conv_id``, ``turn_no`` (from 0), ``ids`` (the turn's
    token ids), ``start`` (its first id's place in the conversation), and the
    half-open span ``loss_start``, ``loss_end`` of trained ids (empty: equal)."""
    small_batches(conversations.sparkSession)
    src = conversations.select(F.col(conv_col).alias("conv_id"), F.col("turn"),
                               F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                               F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    schema = T.StructType([*src.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("n_ids", T.LongType()), T.StructField("loss_from", T.LongType()),
                           T.StructField("loss_n", T.LongType())])

    def run(batches):
        c = codec(tokenizer)
        for b in batches:
            roles = b.column("role").to_pylist()
            head = c.encode([escape(r) for r in roles])
            body = c.encode([escape(t) for t in b.column("text").to_pylist()])
            ids = [[c.start, *h, c.sep, *x, c.end] for h, x in zip(head, body)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(ids, pa.list_(pa.int32())), pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([len(h) + 2 for h in head], pa.int64()),
                 pa.array([len(x) if r == TRAINED_ROLE else 0 for r, x in zip(roles, body)], pa.int64())],
                names=schema.names)

    turns = src.repartition(partitions(src.sparkSession), "conv_id").mapInArrow(run, schema)
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    return turns.select(
        "conv_id", (F.row_number().over(in_order) - 1).cast("long").alias("turn_no"), "ids",
        F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"), "loss_from", "loss_n").select(
        "conv_id", "turn_no", "ids", "start", (F.col("start") + F.col("loss_from")).alias("loss_start"),
        (F.col("start") + F.col("loss_from") + F.col("loss_n")).alias("loss_end"))


def render(ids: list[int], c: Codec) -> str:
    """Ids as text, the reserved ones as their control strings."""
    out, held = [], []
    for i in ids:
        if i < c.start:
            held.append(i)
        else:
            out += [c.decode(held), CONTROL[i - c.start]]
            held = []
    return "".join([*out, c.decode(held)])


SUMMARY = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("n_turns", T.LongType()),
                        T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
                        T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())])
_SUMMARY = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                      ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


class _Reader:
    """Digests of one conversation, fed with its formatted turns in order."""

    def __init__(self, conv_id) -> None:
        self.conv_id, self.n, self.loss_chars, self.chars, self.at = conv_id, 0, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def feed(self, ids: list[int], start: int, loss_start: int, loss_end: int, c: Codec) -> None:
        if start != self.at or ids[0] != c.start or ids[-1] != c.end:
            raise ValueError(f"turn {self.n} of conversation {self.conv_id} is out of place")
        sep = ids.index(c.sep)
        role, text = (unescape(c.decode(x)) for x in (ids[1:sep], ids[sep + 1:-1]))
        self.turns.update(f"{role}\n{text}\n".encode())
        if loss_end > loss_start:
            trained = unescape(c.decode(ids[loss_start - start:loss_end - start]))
            self.loss.update(trained.encode())
            self.loss_chars += len(trained)
        self.chars += len(render(ids, c))
        self.n += 1
        self.at += len(ids)

    def row(self) -> dict:
        return {"conv_id": self.conv_id, "n_turns": self.n, "turns_sha256": self.turns.hexdigest(),
                "loss_chars": self.loss_chars, "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.chars}


def read_back(formatted: DataFrame, tokenizer: str) -> DataFrame:
    """Turns and trained text of every conversation, recovered from the ids alone."""

    def run(batches):
        c, now = codec(tokenizer), None
        for b in batches:
            done = []
            for r in b.to_pylist():
                if now is None or now.conv_id != r["conv_id"]:
                    if now is not None:
                        done.append(now.row())
                    now = _Reader(r["conv_id"])
                now.feed(r["ids"], r["start"], r["loss_start"], r["loss_end"], c)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=_SUMMARY)
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.row()], schema=_SUMMARY)

    return (formatted.select(F.col("conv_id").cast("long").alias("conv_id"), "turn_no", "ids", "start", "loss_start", "loss_end")
            .repartition(partitions(formatted.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn_no")
            .mapInArrow(run, SUMMARY))
