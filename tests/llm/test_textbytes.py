"""Words, hashes and shingles against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tableflow.llm import textbytes as tb

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet=" \t\n\x0b\rabAZé'.-0　", max_size=40)), max_size=8)


def words(text, lower=True):
    text = text or ""
    return re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER) if lower else text)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_and_hashes(texts):
    seen = 0
    for part in tb.slices(pa.array(texts, pa.string())):
        for row, a, b in part.texts():
            seen += 1
            plain = words(texts[row])
            assert [part.data[s:e].tobytes().decode() for s, e in zip(part.starts[a:b], part.ends[a:b])] == plain
            assert part.hashes[a:b].tolist() == [tb.hash_bytes(w.encode()) for w in plain]
    assert seen == len(texts)


def test_slices_keep_texts_whole_and_hash_very_long_words(monkeypatch):
    monkeypatch.setattr(tb, "SLICE", 50)
    texts = ["a b " * 30, "", None, "x" * (3 * tb.PIECE) + " y", "c"]
    counts, hashes = [], []
    for part in tb.slices(pa.array(texts)):
        counts += np.diff(part.first).tolist()
        hashes += part.hashes.tolist()
    assert counts == [60, 0, 0, 2, 1]
    assert hashes[60] == int(tb.mix(np.array([tb._long_hash(np.frombuffer(texts[3].split()[0].encode(), np.uint8))]))[0])
    assert len(set(hashes)) == 5


def test_shingles_of_short_and_long_texts():
    texts = ["a b c d e", "a b", "", None, "b a", "a b c d"]
    part = next(tb.slices(pa.array(texts)))
    rows, found = tb.shingles(part, 4)
    assert rows.tolist() == [0, 0, 1, 4, 5]
    assert found[0] == found[4] and found[2] != found[3]
    values, bounds = tb.distinct_by_row(rows, found, len(texts))
    assert np.diff(bounds).tolist() == [2, 1, 0, 0, 1, 1]


def test_letter_runs_split_at_signs():
    part = next(tb.slices(pa.array(["It's 12 ab,cd é-x"]), tb.LETTER_RUNS))
    assert [part.data[s:e].tobytes().decode() for s, e in zip(part.starts, part.ends)] == ["it's", "12", "ab", ",", "cd", "é-", "x"]
