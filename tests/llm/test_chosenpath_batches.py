"""What a batch of the near-duplicate join hands back to the JVM: few whole batches, no long expressions."""

import numpy as np
import pyarrow as pa

from gleaner.llm import chosenpath
from gleaner.llm.arrays import GOLD, U64, mix64

ROWS, TREES, CHANCE = 50, 6, 0.04


def _batch(**more):
    sig = np.random.default_rng(3).integers(0, 2**32, (ROWS, chosenpath.HASHES), dtype=np.uint32)
    columns = {"c": pa.array(range(ROWS)), "kin": pa.array(range(100, 100 + ROWS)),
               "sig": pa.array([row.tobytes() for row in sig], pa.binary()), **more}
    return sig, pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _children(node, row, sig):
    """By hand: (child, c, kin) of one class in one node."""
    with np.errstate(over="ignore"):
        for i in range(chosenpath.HASHES):
            if mix64(np.array([node + chosenpath._PLACE_SEEDS[i]]))[0] < U64(CHANCE * (2**64 - 1024)):
                child = mix64(mix64(np.array([node ^ chosenpath._TIMES[i]])) + sig[row, i])
                yield int(child.view(np.int64)[0]), row, 100 + row


def _same(batches, want):
    got = [t for b in batches for t in zip(*(b.column(k).to_pylist() for k in ("node", "c", "kin")))]
    assert sorted(got) == sorted(want) and len(got) > ROWS


def test_a_tree_gives_one_batch_of_children():
    sig, batch = _batch()
    out = list(chosenpath._branch(TREES, CHANCE)([batch]))
    assert len(out) <= TREES
    roots = mix64(np.arange(1, TREES + 1, dtype=U64) * GOLD)
    _same(out, [x for root in roots for row in range(ROWS) for x in _children(root, row, sig)])


def test_a_lower_level_gives_one_batch_of_children():
    nodes = mix64(np.arange(1, ROWS + 1, dtype=U64))
    sig, batch = _batch(node=pa.array(nodes.view(np.int64)))
    out = list(chosenpath._branch(TREES, CHANCE)([batch, batch.slice(0, 0)]))
    assert len(out) == 1
    _same(out, [x for row in range(ROWS) for x in _children(nodes[row], row, sig)])


def test_sketches_are_the_lowest_bytes():
    sig, batch = _batch()
    whole, none = chosenpath._sketches([batch, batch.slice(0, 0)])
    assert none.num_rows == 0 and whole.schema.names == ["c", "kin", "sig", "sketch"]
    assert whole.column("sketch").to_pylist() == [bytes(t & 255 for t in row) for row in sig.tolist()]
