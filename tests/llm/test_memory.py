"""Python workers live on after a task, so a task has to give back the memory that it freed."""

import numpy as np
import pyarrow as pa
import pytest

from tableflow.llm import packing, quality_classifier
from tableflow.llm.frames import list_of


@pytest.fixture
def given_back(monkeypatch):
    calls = []
    for module in (packing, quality_classifier):
        monkeypatch.setattr(module, "give_back", lambda name=module.__name__: calls.append(name.rsplit(".", 1)[1]), raising=False)
    return calls


def test_a_packing_task_gives_memory_back_at_its_end(given_back):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["one two three", None]})
    pieces = packing.packed(iter([batch, batch]), public_tokenizers.path("word_bpe_49k.json"), 8, 0)
    rows = [row for part in pieces for row in part.to_pylist()]
    assert sum(r["length"] for r in rows if r["doc_id"] == 2) == 2 and given_back == ["packing"]


def test_the_learning_task_gives_memory_back_at_its_end(given_back):
    bounds = np.array([0, 2, 4])
    batch = pa.RecordBatch.from_arrays(
        [pa.array([2, 1]), pa.array([1, 0]), list_of(np.array([0, 5, 0, 6], dtype=np.int32), bounds),
         list_of(np.array([.5, .5, .5, .5], dtype=np.float32), bounds)], names=["doc_id", "label", "features", "shares"])
    [model] = list(quality_classifier.learn(iter([batch])))
    assert len(model.column(0)[0].as_py()) == 4 << quality_classifier.BITS and given_back == ["quality_classifier"]
