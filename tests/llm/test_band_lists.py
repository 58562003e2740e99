"""Band keys meet block by block: few rows in Spark, and the lists that a window over each key would give."""

from collections import defaultdict

import numpy as np
import pyarrow as pa

from tableflow.llm import line_dedup
from tableflow.llm.textbytes import slices


def as_rows(keys, nodes):
    return {"keys": np.array(keys, dtype=np.int64).tobytes(), "nodes": np.array(nodes, dtype=np.int64).tobytes()}


def test_lists_of_a_block():
    kinds = pa.schema([("block", pa.int64()), ("keys", pa.binary()), ("nodes", pa.binary())])
    rows = [{"block": 0, **as_rows([1, 1, 2, 3, 4], [9, -5, 7, 6, 2])}, {"block": 0, **as_rows([1, 2, 3, 4], [9, 7, 1, 3])}]
    found = [tuple(r.values()) for r in line_dedup._lists(pa.Table.from_pylist(rows, kinds)).to_pylist()]
    assert sorted(found) == [(1, -5, -5), (1, 9, -5), (3, 1, 1), (3, 6, 1), (4, 2, 2), (4, 3, 2)]
    for few in (rows[:0], [{"block": 0, **as_rows([], [])}], [{"block": 0, **as_rows([5], [1])}], [{"block": 0, **as_rows([5, 5], [1, 1])}]):
        assert line_dedup._lists(pa.Table.from_pylist(few, kinds)).num_rows == 0


def test_blocks_hold_all_band_keys():
    texts = ["one line of words\nanother line of words", None, "one line of words\n\nwörter in einer zeile", "x"] * 3
    plain = defaultdict(set)
    for part in slices(pa.array(texts), hashed=False):
        for node, keys in zip(*line_dedup.band_keys(line_dedup.judged_lines(part, 1))):
            for key in keys.tolist():
                plain[key].add(int(node))
    for bits in (1, 6):
        [rows] = line_dedup._bands(pa.RecordBatch.from_pydict({"text": texts}), bits)
        found = defaultdict(set)
        for block, keys, nodes in zip(rows["block"].tolist(), rows["keys"], rows["nodes"]):
            keys = np.frombuffer(keys, dtype=np.uint64)
            assert set((keys >> np.uint64(64 - bits)).tolist()) == {block} and (np.diff(keys.astype(object)) >= 0).all()
            for key, node in zip(keys.tolist(), np.frombuffer(nodes, dtype=np.uint64).tolist()):
                found[key].add(node)
        assert found == plain and len(rows["block"]) == len(set(rows["block"].tolist()))
