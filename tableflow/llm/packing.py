"""Packing of token streams into sequences by dynamic programming that keeps their order.

The texts of a partition, in the order of the table, are one stream of token ids. It may be cut
where a document or a sentence ends (and every ``HARD`` tokens inside a longer sentence). The cuts
chosen minimise the padding of all sequences plus a penalty for each document that is cut. The cost
of the best cuts up to a place depends on the best of the places at most one length before it, which
a queue with rising costs gives at once. A stream is worked off in blocks, so memory is bounded; the
end of a block is the best cut in its last sequence and the tokens after it go to the next block.
"""

from __future__ import annotations

import os
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.frames import column, give_back, reach
from tableflow.llm.textbytes import LETTER_RUNS, SPACED, slices, text_column

SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")
END_ID = 1
HARD = 256
BLOCK_TOKENS = 1 << 19
CACHE_WORDS = 250_000
#: Padding tokens that a cut inside a document is worth, after a sentence and anywhere else.
SENTENCE_PENALTY, HARD_PENALTY = 8, 128
_STOPS = np.zeros(256, dtype=bool)
_STOPS[[ord(c) for c in ".!?"]] = True


class WordTokenizer:
    """Token ids of many texts, through a bounded cache of words.

    The tokenizer makes letters small and splits texts at white space and between letters and
    other signs before it merges anything, so the ids of a text are the ids of these parts, one
    after the other.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.words = np.empty(0, dtype=np.uint64)
        self.at = np.empty(0, dtype=np.int64)
        self.sizes = np.empty(0, dtype=np.int64)
        self.ids = np.empty(0, dtype=np.uint32)

    def encode(self, part) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each word) of a slice."""
        distinct, place, inverse = np.unique(part.hashes, return_index=True, return_inverse=True)
        if len(self.words) > CACHE_WORDS:
            self._forget()
        found = np.searchsorted(self.words, distinct)
        known = found < len(self.words)
        known[known] = self.words[found[known]] == distinct[known]
        if not known.all():
            self._learn(part, distinct[~known], place[~known])
        entry = np.searchsorted(self.words, distinct)[inverse]
        sizes = self.sizes[entry]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        source = np.arange(total) + np.repeat(self.at[entry] - (ends - sizes), sizes)
        return self.ids[source], sizes

    def _learn(self, part, hashes: np.ndarray, place: np.ndarray) -> None:
        raw = part.data.tobytes()
        texts = [raw[a:b].decode("utf-8", "replace")
                 for a, b in zip(part.starts[place].tolist(), part.ends[place].tolist())]
        encoded = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.array([len(x) for x in encoded], dtype=np.int64)
        ids = np.array([i for x in encoded for i in x], dtype=np.uint32)
        at = len(self.ids) + np.cumsum(sizes) - sizes
        order = np.argsort(words := np.concatenate([self.words, hashes]), kind="stable")
        self.words = words[order]
        self.at = np.concatenate([self.at, at])[order]
        self.sizes = np.concatenate([self.sizes, sizes])[order]
        self.ids = np.concatenate([self.ids, ids])


_TOKENIZERS: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    """One for each Python worker, so its cache serves all tasks of the worker."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def token_streams(texts: pa.Array, path: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For slices of texts: all ids, each text's ids closed by the end id; the number of ids of each
    text; and the places behind ids that end a sentence."""
    tokenizer = _tokenizer(path)
    for part in _parts(texts):
        ids, sizes = tokenizer.encode(part)
        before = np.zeros(len(sizes) + 1, dtype=np.int64)
        np.cumsum(sizes, out=before[1:])
        of_text = before[part.first]
        counts = np.diff(of_text)
        closed = np.full(len(ids) + len(counts), END_ID, dtype=np.uint32)
        shift = np.repeat(np.arange(len(counts)), counts)
        closed[np.arange(len(ids)) + shift] = ids
        behind = part.data[part.ends]
        stops = np.flatnonzero((behind == 10) | _STOPS[part.data[part.ends - 1]] & ~SPACED[behind].astype(bool))
        yield closed, counts + 1, before[stops + 1] + part.owner()[stops]


def _parts(texts: pa.Array):
    """Slices into parts that the tokenizer keeps apart. Where a text may hold the name of a special
    token, which is one id as it is written, only white space splits it."""
    texts = text_column(texts)
    special = pc.any(pc.match_substring(texts, "<|")).as_py()
    return slices(texts, SPACED, lower=False) if special else slices(texts, LETTER_RUNS)


def best_cuts(places: list[int], penalties: list[int], length: int, final: bool) -> list[int]:
    """Chosen places, the first of them ``places[0]``, at most ``length`` apart; gaps between places
    are at most ``length``. Unless ``final``, the last one is the cheapest within the last length."""
    cost, back = [0], [0]
    queue = deque([(places[0], 0)])  # (cost + place, number) with rising first parts
    for j in range(1, len(places)):
        at = places[j]
        while places[queue[0][1]] < at - length:
            queue.popleft()
        least, i = queue[0]
        value = least + length - at + penalties[j]
        cost.append(value)
        back.append(i)
        key = value + at
        while queue and queue[-1][0] > key:
            queue.pop()
        queue.append((key, j))
    last = len(places) - 1
    if not final:
        late = [j for j in range(1, len(places)) if places[j] > places[-1] - length]
        last = min(late, key=lambda j: (cost[j], -j)) if late else last
    chosen = []
    while last:
        chosen.append(places[last])
        last = back[last]
    return [places[0], *reversed(chosen)]


class _Packer:
    """The open part of one partition's stream; places are counted from its start."""

    def __init__(self, length: int, partition: int):
        self.length, self.next_id = length, partition << 33
        self.base, self.ids = 0, np.empty(0, dtype=np.uint32)
        self.docs = np.empty((3, 0), dtype=np.int64)   # number, start, tokens
        self.names: list = []
        self.stops = np.empty(0, dtype=np.int64)
        self.waiting: list = []
        self.held = 0

    def add(self, names: list, ids: np.ndarray, counts: np.ndarray, stops: np.ndarray) -> None:
        self.waiting.append((names, ids, counts, stops))
        self.held += len(ids)

    def pack(self, final: bool) -> dict | None:
        end = self.base + len(self.ids)
        all_ids, starts, tokens, stops = [self.ids], [self.docs[1]], [self.docs[2]], [self.stops]
        for names, ids, counts, marks in self.waiting:
            all_ids.append(ids)
            starts.append(end + np.cumsum(counts) - counts)
            tokens.append(counts)
            stops.append(marks + end)
            self.names.extend(names)
            end += len(ids)
        self.waiting, self.held = [], 0
        ids, starts, tokens = map(np.concatenate, (all_ids, starts, tokens))
        stops = np.concatenate(stops)
        if not len(ids):
            return None
        places, penalties = self._candidates(starts + tokens, stops, end)
        cuts = np.array(best_cuts(places, penalties, self.length, final), dtype=np.int64)
        done = int(cuts[-1])
        out = self._pieces(ids, starts, tokens, cuts)
        keep = starts + tokens > done
        self.ids = ids[done - self.base:].copy()
        self.names = [x for x, k in zip(self.names, keep.tolist()) if k]
        self.docs = np.stack([np.zeros(keep.sum(), dtype=np.int64), starts[keep], tokens[keep]])
        self.stops = stops[stops > done]
        self.base = done
        self.next_id += len(cuts) - 1
        return out

    def _candidates(self, ends: np.ndarray, stops: np.ndarray, end: int) -> tuple[list, list]:
        ends = ends[ends > self.base]
        places = np.concatenate([[self.base], ends, stops[stops > self.base]])
        penalties = np.full(len(places), SENTENCE_PENALTY)
        penalties[:1 + len(ends)] = 0
        order = np.lexsort((penalties, places))
        places, penalties = places[order], penalties[order]
        new = np.concatenate([[True], places[1:] != places[:-1]])
        places, penalties = places[new], penalties[new]
        gaps = np.flatnonzero(np.diff(places) > HARD)
        extra = [np.arange(places[g] + HARD, places[g + 1], HARD) for g in gaps]
        if extra:
            more = np.concatenate(extra)
            order = np.argsort(places := np.concatenate([places, more]), kind="stable")
            penalties = np.concatenate([penalties, np.full(len(more), HARD_PENALTY)])[order]
            places = places[order]
        return places.tolist(), penalties.tolist()

    def _pieces(self, ids, starts, tokens, cuts) -> dict:
        done = cuts[-1]
        places = np.unique(np.concatenate([cuts, starts[(starts >= cuts[0]) & (starts < done)]]))
        begin, stop = places[:-1], places[1:]
        doc = np.searchsorted(starts, begin, side="right") - 1
        sequence = np.searchsorted(cuts, begin, side="right") - 1
        raw = memoryview(np.ascontiguousarray(ids, dtype="<u4")).cast("B")
        crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip((begin - self.base).tolist(),
                                                            (stop - self.base).tolist())]
        return {"doc_id": [self.names[d] for d in doc.tolist()], "start": begin - starts[doc],
                "length": stop - begin, "ids_crc32": np.array(crc, dtype=np.int64),
                "doc_tokens": tokens[doc], "sequence_id": self.next_id + sequence,
                "offset": begin - cuts[sequence]}


def packed(batches: Iterator[pa.RecordBatch], tokenizer_path: str, length: int, partition: int) -> Iterator[pa.RecordBatch]:
    """The pieces of one partition's texts; memory goes back at the end, as workers and their tokenizers live on."""
    packer = _Packer(length, partition)
    for batch in batches:
        names, at = column(batch, "doc_id").to_pylist(), 0
        for ids, counts, stops in token_streams(column(batch, "text"), tokenizer_path):
            packer.add(names[at:at + len(counts)], ids, counts, stops)
            at += len(counts)
            if packer.held >= BLOCK_TOKENS:
                yield from _batches(packer.pack(False))
    yield from _batches(packer.pack(True))
    packer = batch = names = ids = counts = stops = None
    give_back()


def pack_documents(docs: DataFrame, tokenizer_path: str, length: int = 2048,
                   text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row for each piece of a document: where it starts in the document, its sequence and the
    offset there.

    A null or empty text is the end id alone. Repeated rows and rows with null ids are packed like
    others; a text of any length is cut as often as needed. Other columns are not used, whatever
    their names. An empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return packed(batches, tokenizer_path, length, TaskContext.get().partitionId())

    return reach(docs).select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.col(text).cast("string").alias("text")).mapInArrow(run, SCHEMA)


def _batches(columns: dict | None) -> Iterator[pa.RecordBatch]:
    if columns is not None:
        arrays = [pa.array(columns[name], type=pa.int64()) for name in columns]
        yield pa.RecordBatch.from_arrays(arrays, names=list(columns))
