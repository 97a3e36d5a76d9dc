"""Token counts of a BPE piece model, with a whole-token shortcut.

Before any text is read, the vocabulary is searched for two facts:

* no piece holds the space mark after another character, and none holds a line
  feed, so merges never cross from a word into the spaces before the next one
  nor over a line feed, and a text's tokens are those of its pre-tokens (a run of
  spaces with what follows, or a line feed with what follows) in turn;
* which vocabulary strings, given as a text, encode as exactly one token.

A pre-token of the second kind counts one without any merging; only the rest is
given to the library, and remembered.  A model without the first property is
counted text by text.

Defined cases: null and empty texts have no tokens; repeated rows each get a row;
an empty table gives an empty table; columns named like an output are replaced.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.llm.common import small_batches

#: Pre-tokens remembered by a worker besides the vocabulary's; then it starts anew.
MEMORY = 200_000
SPACE = "▁"
#: A run of spaces (the first is the model's own) or a line feed, and what follows.
PRE_TOKEN = re.compile(r" +[^ \n]*|\n[^ \n]*")


class PieceCounts(dict):
    """Tokens of a pre-token, without its first space."""

    def __init__(self, path: str) -> None:
        super().__init__()
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        m = self.model
        pieces = [m.id_to_piece(i) for i in range(m.get_piece_size())
                  if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
        # A model that rewrites texts or adds no space in front cannot be cut either.
        plain = m.encode("  a ", out_type=str) and "".join(m.encode("  a ", out_type=str)) == SPACE * 3 + "a" + SPACE
        self.separable = bool(plain) and not any(re.search(f"[^{SPACE}]{SPACE}|\n", p) for p in pieces)
        self.proved = {"": 1}
        words = [p[1:] for p in pieces if p[0] == SPACE and SPACE not in p[1:]]
        self.proved |= {w: 1 for w, ids in zip(words, m.encode(words, num_threads=1)) if len(ids) == 1 and w}
        self.update(self.proved)

    def learn(self, units: set[str]) -> None:
        new = units.difference(self)
        if len(self) + len(new) > MEMORY + len(self.proved):
            self.clear()
            self.update(self.proved)
            new = units.difference(self)
        new = list(new)
        for u, ids in zip(new, self.model.encode(new, num_threads=1)):
            # After a line feed there is no space: the library's own one is not counted.
            self[u] = len(ids) - (u[0] == "\n")

    def count(self, texts: list[str]) -> list[int]:
        if not self.separable:
            return [len(x) for x in self.model.encode(texts, num_threads=1)]
        lists = [self._units(t) for t in texts]
        self.learn(set().union(*lists))
        return [sum(map(self.__getitem__, x)) for x in lists]

    @staticmethod
    def _units(text: str) -> list[str]:
        if not text:
            return []
        if SPACE in text:
            text = text.replace(SPACE, " ")
        if "  " in text or text[0] == " ":
            return [u if u[0] == "\n" else u[1:] for u in PRE_TOKEN.findall(" " + text)]
        # No two spaces in a row: an empty unit is a space with nothing after it.
        return text.replace("\n", " \n").split(" ")


_COUNTS: dict[str, PieceCounts] = {}


def piece_counts(path: str) -> PieceCounts:
    if path not in _COUNTS:
        _COUNTS[path] = PieceCounts(path)
    return _COUNTS[path]


OUT = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
       T.StructField("over_limit", T.BooleanType())]


def token_counts(docs: DataFrame, model: str, text_col: str = "text", limit: int = 4096) -> DataFrame:
    """The other columns of ``docs`` with bytes, tokens and whether over ``limit``."""
    small_batches(docs.sparkSession)
    fields = [f for f in docs.schema.fields if f.name not in {text_col, *(o.name for o in OUT)}]
    src = docs.select(*[f.name for f in fields], F.col(text_col).cast("string").alias("_tc_text"))
    schema = T.StructType(fields + OUT)

    def run(batches):
        known = piece_counts(model)
        for b in batches:
            texts = [t or "" for t in b.column("_tc_text").to_pylist()]
            n = known.count(texts)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(f.name) for f in fields), pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], names=schema.names)

    return src.mapInArrow(run, schema)
