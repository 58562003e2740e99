"""Every stage of the pipeline on what the one before has kept, against plain Python."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from helpers import brute_lines, brute_tiles, shingle_groups, words
from tableflow.llm import packing, quality_classifier
from tableflow.llm.textbytes import hash_bytes
from tableflow.session import materialise

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What goes into each stage and what comes out of it."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(materialise(stage(spark, seen[-1], FOLDER)))
    return seen


def rows(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def test_names_and_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "packing"]
    for frame in stages[1:-1]:
        assert frame.columns == stages[0].columns


def test_quality(spark, stages):
    model = quality_classifier.fit(stages[0], spark.read.parquet(f"{FOLDER}/labels.parquet"))
    before = rows(stages[0])
    scores = model.scores(pa.array([text for _, text in before]))
    assert sorted(rows(stages[1])) == sorted(x for x, score in zip(before, scores) if score >= 0.3)


def test_lines(stages):
    before = rows(stages[1])
    lost, judged = brute_lines(before, 80)
    expected = [(doc, "\n".join(line for n, line in enumerate(text.split("\n")) if n not in lost[i]))
                for i, (doc, text) in enumerate(before) if not judged[i] or len(lost[i]) < judged[i]]
    assert rows(stages[2]) == expected or sorted(rows(stages[2])) == sorted(expected)


def test_similar(stages):
    before = rows(stages[2])
    sets, group = shingle_groups(before, 5, 80)
    best = {}
    for (doc, _), number in zip(before, group):
        best[number] = min(doc, best.get(number, doc))
    assert sorted(rows(stages[3])) == sorted(x for i, x in enumerate(before) if not sets[i] or best[group[i]] == x[0])


def test_benchmark(spark, stages):
    items = [[hash_bytes(w.encode()) for w in words(r.text)] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    def holds(text):
        own = [hash_bytes(w.encode()) for w in words(text)]
        return any(len(set(item) & set(own)) * 2 >= len(set(item))
                   and 100 * sum(n for *_, n in brute_tiles(item, own, min(5, len(item)))) >= 80 * len(item) for item in items if item)
    before = rows(stages[3])
    assert sorted(rows(stages[4])) == sorted(x for x in before if not holds(x[1]))


def test_packing(stages):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, filled = defaultdict(list), defaultdict(int)
    for r in stages[5].collect():
        pieces[r.doc_id].append(r)
        filled[r.sequence_id] += r.length
    before = rows(stages[4])
    assert len(pieces) == len(before)
    for doc, text in before:
        ids, at = tokenizer.encode(text, add_special_tokens=False).ids + [packing.END_ID], 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            assert r.start == at and r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], dtype="<u4").tobytes())
            at += r.length
        assert at == len(ids)
    assert max(filled.values()) <= 2048 and sum(filled.values()) > 0.9 * 2048 * len(filled)


def test_run_gives_the_last_stage(spark, stages):
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "offset"]
    one, other = (sorted(map(tuple, f.select(*columns).collect())) for f in (corpus_pipeline.run(spark, FOLDER), stages[-1]))
    assert one == other
