"""Counting holds a chunk of the tokens at a time; questions by group meet the entries by block of keys."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from helpers import stored
from tableflow.llm import backoff_lm
from tableflow.llm.frames import ROW, membership, numbered
from tableflow.llm.textbytes import slices
from pyspark.sql import functions as F

TEXTS = ["a b c d e a b", "a b c x", None, "q a b y", "", "b c d"] * 5


@pytest.fixture
def docs(spark, folder):
    return stored(spark, spark.createDataFrame([(t,) for t in TEXTS], "text string"), folder).coalesce(1)


def test_a_task_counts_chunk_by_chunk(monkeypatch):
    monkeypatch.setattr("tableflow.llm.textbytes.SLICE", 16)
    monkeypatch.setattr(backoff_lm, "CHUNK", 12)
    chunks = list(backoff_lm._chunks(pa.RecordBatch.from_pydict({"text": TEXTS}), backoff_lm._pairs))
    assert len(chunks) > 3 and max(len(key) for key, _, _ in chunks) < 24
    assert sum(len(key) for key, _, _ in chunks) == sum(len((t or "").split()) + 1 for t in TEXTS)


def test_pairs_are_counted_with_their_parts(docs):
    plain = Counter()
    for part in slices(pa.array(TEXTS)):
        plain.update(zip(*(x.tolist() for x in backoff_lm._pairs(*backoff_lm._tokens(part)))))
    rows = backoff_lm._count(docs, backoff_lm._pairs, 6).collect()
    found = {tuple(int(np.int64(x).view(np.uint64)) for x in (r.key, r.left, r.right)): r.n for r in rows}
    assert found == {k: n for k, n in plain.items() if n >= 6} and found


@pytest.mark.parametrize("bits", [1, 5])
def test_answers_come_in_the_order_of_the_questions(spark, docs, monkeypatch, bits):
    monkeypatch.setattr(backoff_lm, "CHUNK", 9)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # groups go on in the next batch
    try:
        source = numbered(docs).withColumn("group", F.shiftright(ROW, 2))
        counts = backoff_lm._count(docs, backoff_lm._pairs, 2)
        kept = spark.sparkContext.broadcast(membership(counts, "key"))
        entries = counts.select("key", "n", (F.col("n") / 7).alias("weight"))
        rows = backoff_lm._answers(backoff_lm._asked(source, kept, bits), entries, bits).collect()
        texts = source.select("group", "text").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    n_of = {np.int64(r.key).view(np.uint64): r.n for r in counts.collect()}
    assert len({r.group for r in rows}) == 8 and len(rows) == len({(r.group, r.block) for r in rows})
    for group in range(8):
        keys = backoff_lm._group_keys([backoff_lm._tokens(p) for p in slices(pa.array([r.text for r in texts if r.group == group]))], kept)
        own = sorted((r for r in rows if r.group == group), key=lambda r: r.block)
        n = np.concatenate([backoff_lm._from_planes(bytes(r.n), np.int64) for r in own])
        weight = np.concatenate([backoff_lm._from_planes(bytes(r.weight), np.float64) for r in own])
        assert n.tolist() == [n_of.get(k, 0) for k in keys]
        assert weight.tolist() == [n_of[k] / 7 if k in n_of else 1 for k in keys]


def test_entries_are_found_by_their_first_bits():
    rng = np.random.default_rng(0)
    for size in (0, 1, 2, 3000):
        keys = np.unique(np.append(rng.integers(0, 2**64, size, dtype=np.uint64), np.array([2**64 - 1, 0][:size], dtype=np.uint64)))
        entries = backoff_lm.Entries(keys, np.arange(len(keys)) + 5, np.arange(len(keys)) / 7)
        wanted = np.concatenate([keys, keys[:50] + np.uint64(1), np.array([0, 2**64 - 1], dtype=np.uint64)])
        place = {k: i for i, k in enumerate(keys.tolist())}
        counts, weights = entries.find(wanted)
        assert counts.tolist() == [place[k] + 5 if k in place else 0 for k in wanted.tolist()]
        assert weights.tolist() == [place[k] / 7 if k in place else 1 for k in wanted.tolist()]
