"""What the language model shuffles and stores is as short as it can be, and comes back whole."""

from collections import Counter

import numpy as np
import pytest

from helpers import stored
from tableflow.llm import backoff_lm
from tableflow.llm.textbytes import mix, slices, unmix
from pyspark.sql import functions as F

TEXTS = ["a b c d e a b", "a b c x", None, "q a b y", "", "b c d"] * 5


@pytest.mark.parametrize("weights", [[], [1.0], [0.25], [1.0] * 17 + [0.0, 1e-12, 3.5] + [1.0] * 4, [0.5] * 16])
def test_weights_come_back(weights):
    found = backoff_lm._from_planes(backoff_lm._planes(np.array(weights)), np.float64)
    assert found.dtype == np.float64 and found.tolist() == weights


def test_a_weight_of_one_takes_a_bit():
    weights = np.ones(8000)
    weights[::80] = 0.3
    assert len(backoff_lm._planes(weights)) < 8000 / 8 + 100 * 8 + 64


def test_the_right_part_follows_from_the_key_and_the_left_one():
    left, right = np.random.default_rng(1).integers(0, 2**64, (2, 1000), dtype=np.uint64)
    assert (unmix(mix(left)) == left).all()
    assert (backoff_lm._right(backoff_lm._joined(left, right), left) == right).all()


@pytest.mark.parametrize("bits", [1, 6])
@pytest.mark.parametrize("find", [backoff_lm._pairs, backoff_lm._triples])
def test_counts_meet_in_blocks(spark, folder, monkeypatch, bits, find):
    docs = stored(spark, spark.createDataFrame([(t,) for t in TEXTS], "text string"), folder)
    monkeypatch.setattr("tableflow.llm.textbytes.SLICE", 16)
    monkeypatch.setattr(backoff_lm, "CHUNK", 12)
    plain = Counter()
    for part in slices(docs.toArrow()["text"]):
        plain.update(zip(*(x.view(np.int64).tolist() for x in find(*backoff_lm._tokens(part)))))
    blocks = backoff_lm._in_blocks(docs, find, bits)
    assert "right" not in blocks.columns
    rows = backoff_lm._named(blocks, 6).collect()
    assert len(rows) == len({r.key for r in rows})
    assert {(r.key, r.left, r.right): r.n for r in rows} == {k: n for k, n in plain.items() if n >= 6} != {}


def test_entries_are_packed_by_block(spark, monkeypatch):
    monkeypatch.setattr(backoff_lm, "CHUNK", 50)
    rows = spark.range(500).select(F.xxhash64("id").alias("key"), (F.col("id") % 9).alias("n"),
                                   F.when(F.col("id") % 3 == 0, F.col("id") / 7).alias("weight"))
    blocks = backoff_lm._packed(rows, 4).collect()
    found = {}
    for row in blocks:
        keys = backoff_lm._keys(bytes(row.keys))
        assert (keys >> np.uint64(60) == row.block).all()
        found |= dict(zip(keys.view(np.int64).tolist(), zip(backoff_lm._from_planes(bytes(row.n), np.int64).tolist(),
                                                            backoff_lm._from_planes(bytes(row.weight), np.float64).tolist())))
    assert found == {r.key: (r.n, 1.0 if r.weight is None else r.weight) for r in rows.collect()}
