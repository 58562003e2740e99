"""Lines are signed part by part, without hashes of their words, and compared once a pair."""

import pyarrow as pa

from tableflow.llm import line_dedup
from tableflow.llm.textbytes import slices

TEXTS = ["Ein  schöner Tag am See\n\nein schöner tag am see\n\U0001f600 smile, one more line of words", None, "x\ny z\n" + "word " * 20_000]


def lines_of(texts):
    [part] = slices(pa.array(texts), hashed=False)
    return line_dedup.judged_lines(part, 1)


def test_lines_need_no_hashes_of_words():
    lines = lines_of(TEXTS)
    assert [(r, n) for r, n in zip(lines.row.tolist(), lines.number.tolist())] == [(0, 0), (0, 2), (0, 3), (2, 0), (2, 1), (2, 2)]
    assert lines.node[0] == lines.node[1] and len(set(lines.node.tolist())) == 5
    assert lines.text(0).decode() == "ein schöner tag am see"


def test_parts_do_not_change_signatures(monkeypatch):
    nodes, whole = line_dedup.band_keys(lines_of(TEXTS))
    monkeypatch.setattr(line_dedup, "PART", 8)
    again, parts = line_dedup.band_keys(lines_of(TEXTS))
    assert nodes.tolist() == again.tolist() and (whole == parts).all() and len(nodes) == 4


def test_prepared_lines_meet_once_a_pair():
    alike = line_dedup.SimilarLines(80)
    texts = [b"one two three four five six seven", b"one two three four five six sevens", b"nothing like the other lines"]
    sets = alike.prepare(texts)
    assert list(alike.search(sets, sets)) == [(0, 1)] and list(alike.search(texts, texts)) == [(0, 1)]
    assert sorted(alike.search(sets[:2], sets[2:] + sets[:1])) == [(1, 0), (1, 1)]
