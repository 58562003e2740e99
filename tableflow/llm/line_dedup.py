"""Fuzzy removal of repeated lines.

A line is the sequence of its words, A-Z made small; case and spaces do not tell lines apart. Every
line with a word is judged. Equal lines are one, however short. Lines of ``SHINGLE`` characters or more
are signed by MinHash over their shingles of so many characters (code points, not bytes), lines that agree in a band of their
signatures are compared by the exact Jaccard similarity of their shingles, and of every component
of similar lines the first one in the table is kept.

A signature has ``HASHES`` minima, and each of the ``BANDS`` is a fixed choice of ``ROWS`` of them, so
more bands take no more hashing. Bands of seven let through a share of 3 in 10^9 of the pairs at similarity
0.06, which any two lines of one language have: such pairs grow with the square of the table. Equal
lines always meet: they are one node.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.frames import ROW, arrow_map, column, is_member, membership, numbered
from tableflow.llm.linking import link_components
from tableflow.llm.textbytes import SPACED, hash_ranges, mix, slices
from tableflow.session import materialise, release

SHINGLE, HASHES, BANDS, ROWS = 5, 48, 20, 7
PERCENT = 80
#: Lines that are compared with each other in one block.
BLOCK = 1024
#: So many lines are compared one by one, without an index.
FEW = 12
#: Lines of about so many bytes are signed at a time.
PART = 1 << 15
#: Judged lines by which the number of blocks of band keys grows.
BLOCK_LINES = 1 << 13
#: ``judged_lines`` gives lines of so many words unless told otherwise; the operator judges all with a word.
LEAST_WORDS, ANY = 5, 1

_FACTORS = np.random.default_rng(5).integers(1 << 20, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_CHOSEN = [np.random.default_rng(band).choice(HASHES, ROWS, replace=False) for band in range(BANDS)]
_POWER = 0xD1342543DE82EF95


@dataclass
class Lines:
    """Judged lines of a slice: row in the slice, number in the text, node, and byte range in
    ``data``, where words are parted by one space."""

    row: np.ndarray
    number: np.ndarray
    node: np.ndarray
    low: np.ndarray
    high: np.ndarray
    data: np.ndarray

    def text(self, i: int) -> bytes:
        return self.data[self.low[i]:self.high[i]].tobytes()


def judged_lines(part, least_words: int = LEAST_WORDS) -> Lines:
    """Of a slice; the hashes of its words are not needed."""
    feeds = np.flatnonzero(part.data == 10)  # also the one that closes each text
    before = np.append(0, np.searchsorted(part.starts, feeds))
    counts = np.diff(before)
    line = np.flatnonzero(counts)
    first, last = before[line], before[line + 1]
    at = np.append(0, np.cumsum(part.ends - part.starts + 1))
    keep = SPACED[part.data]
    keep[part.ends] = True
    data = part.data[keep]
    data[at[1:] - 1] = 32
    low, high = at[first], at[last] - 1
    row = np.searchsorted(part.bounds, feeds[line], side="right") - 1
    number = line - np.searchsorted(feeds, part.bounds[row])
    long = counts[line] >= least_words
    low, high = low[long], high[long]
    return Lines(row[long], number[long], hash_ranges(data, low, high), low, high, data)


def _shingles(data: np.ndarray, kind: type = np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the characters, and hashes of the shingles from each of them on."""
    more = np.flatnonzero(data & 0xC0 == 0x80)
    at = np.delete(np.arange(len(data)), more)
    values = data[at].astype(kind)
    owner = more - np.arange(len(more)) - 1  # the character that each further byte belongs to
    place = more - at[owner] if len(more) else more
    for k in range(1, 4 if len(more) else 1):
        own = place == k
        values[owner[own]] |= data[more[own]].astype(kind) << kind(8 * k)
    n = max(len(at) - SHINGLE + 1, 0)
    total = values[:n].copy()
    for k in range(1, SHINGLE):
        total *= kind(_POWER & np.iinfo(kind).max)
        total += values[k:k + n]
    return at, total


def line_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each line (hashes of 40 bits and more), one line after another, and the
    bounds of the lines; a line shorter than a shingle is padded to one."""
    padded = [text if len(text) > 4 * SHINGLE else text + b"\0" * max(0, SHINGLE - len(text.decode())) for text in texts]
    ends = np.cumsum([len(text) for text in padded])
    at, values = _shingles(np.frombuffer(b"".join(padded), dtype=np.uint8))
    first = np.searchsorted(at, np.concatenate([[0], ends]))
    row = np.repeat(np.arange(len(padded), dtype=np.uint64), np.diff(first))[:len(values)]
    inside = np.arange(len(values)) + SHINGLE <= np.repeat(first[1:], np.diff(first))[:len(values)]
    bits = np.uint64(64 - min(24, len(padded).bit_length()))
    keys = np.sort(row[inside] << bits | mix(values[inside]) >> (np.uint64(64) - bits))  # rows, then shingles
    keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys
    bounds = np.searchsorted(keys, np.arange(len(padded), dtype=np.uint64) << bits)
    return keys & ((np.uint64(1) << bits) - np.uint64(1)), np.append(bounds, len(keys))


def _side_by_side(items: list) -> tuple[np.ndarray, np.ndarray]:
    """As ``line_sets``, of lines or of their sets."""
    if not items or isinstance(items[0], bytes):
        return line_sets(items)
    return np.concatenate(items), np.cumsum([0, *map(len, items)])


def line_shingles(text: bytes) -> np.ndarray:
    return line_sets([text])[0]


def _mix32(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return h ^ (h >> np.uint32(16))


def band_keys(lines: Lines) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the lines with a shingle, and (lines, bands) keys of their MinHash signatures."""
    nodes, least = [lines.node[:0]], [np.empty((HASHES, 0), dtype=np.uint32)]
    parts = np.flatnonzero(np.diff(lines.low // PART, prepend=-1))
    for a, b in zip(parts, np.append(parts[1:], len(lines.low))):  # so that the minima stay in cache
        start = lines.low[a]
        long, found = _minima(lines.data[start:lines.high[b - 1]], lines.low[a:b] - start, lines.high[a:b] - start)
        nodes.append(lines.node[a:b][long])
        least.append(found)
    nodes, least = np.concatenate(nodes), np.concatenate(least, axis=1)
    out = np.empty((len(nodes), BANDS), dtype=np.uint64)
    for band, chosen in enumerate(_CHOSEN):
        key = np.full(len(nodes), band, dtype=np.uint64)
        for i in chosen:
            key = mix(key * np.uint64(_POWER) + least[i])
        out[:, band] = key
    return nodes, out


def _minima(data: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the byte ranges with a shingle, and (hashes, ranges) their least hashes."""
    at, values = _shingles(data, np.uint32)
    low, high = np.searchsorted(at, low), np.searchsorted(at, high)
    long = np.flatnonzero(high - low >= SHINGLE)
    out = np.empty((HASHES, len(long)), dtype=np.uint32)
    if len(long):
        # every other range lies between lines
        ends = np.stack([low[long], high[long] - SHINGLE + 1], axis=1).ravel()
        values = np.append(_mix32(values), np.uint32(0))
        turned = np.empty_like(values)
        for i, factor in enumerate(_FACTORS):
            np.multiply(values, factor, out=turned)
            out[i] = np.minimum.reduceat(turned, ends)[::2]
    return long, out


class SimilarLines:
    """Finds lines with 100 * common shingles >= percent * all shingles of both."""

    def __init__(self, percent: int):
        self.percent = percent

    def _like(self, one: np.ndarray, values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Numbers of the sets that are like the set ``one``; the sets follow each other in ``values``."""
        place = np.minimum(np.searchsorted(one, values), len(one) - 1)
        both = np.add.reduceat((one[place] == values).astype(np.int64), bounds[:-1])
        return np.flatnonzero(100 * both >= self.percent * (len(one) + np.diff(bounds) - both))

    def stars(self, items: list[bytes], starts: list[int]) -> Iterator[tuple[int, int]]:
        """For blocks of lines that start with a pivot, the places of the lines that are like it."""
        values, bounds = line_sets(items)
        for low, high in zip(starts[:-1], starts[1:]):
            if high - low > 1:
                own = bounds[low + 1:high + 1]
                for found in self._like(values[bounds[low]:bounds[low + 1]], values[own[0]:own[-1]], own - own[0]).tolist():
                    yield low + 1 + found, low

    def prepare(self, items: list[bytes]) -> list[np.ndarray]:
        """What ``search`` takes as well: the sets of the lines, of many blocks at once."""
        values, bounds = line_sets(items)
        return [values[low:high] for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist())]

    def search(self, indexed: list, queries: list) -> Iterator[tuple[int, int]]:
        """Of a few lines by comparing with each, of more in an inverted index: the lists of a query's
        shingles are counted together. A few lines that are their own queries meet once a pair."""
        values, bounds = _side_by_side(indexed)
        own, own_bounds = (values, bounds) if queries is indexed else _side_by_side(queries)
        sets = zip(own_bounds[:-1].tolist(), own_bounds[1:].tolist())
        if len(indexed) <= FEW:
            for number, (low, high) in enumerate(sets):
                skip = number + 1 if queries is indexed else 0
                if skip < len(indexed):
                    others = bounds[skip:]
                    for found in self._like(own[low:high], values[others[0]:], others - others[0]).tolist():
                        yield number, skip + found
            return
        sizes = np.diff(bounds)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        start = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        names, length = values[start], np.diff(start, append=len(values))
        place = np.minimum(np.searchsorted(names, own), len(names) - 1)
        there = names[place] == own
        for number, (low, high) in enumerate(sets):
            lists = place[low:high][there[low:high]]
            if 100 * len(lists) < self.percent * (high - low):
                continue
            many = length[lists]
            ends = np.cumsum(many)
            both = np.bincount(owner[np.arange(ends[-1]) + np.repeat(start[lists] - (ends - many), many)], minlength=len(sizes))
            for found in np.flatnonzero(100 * both >= self.percent * ((high - low) + sizes - both)).tolist():
                yield number, found


def _places(rows: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """A hash of each place of a line in the table."""
    return mix(rows.astype(np.uint64) * np.uint64(_POWER) + numbers.astype(np.uint64))


def _occurrences(batch: pa.RecordBatch):
    for part in slices(column(batch, "text"), hashed=False):
        lines = judged_lines(part, ANY)
        rows = column(batch, ROW).to_numpy()[part.low + lines.row]
        yield {ROW: rows, "line": lines.number, "node": lines.node, "place": _places(rows, lines.number)}


def _new(nodes: np.ndarray, seen: set) -> np.ndarray:
    """Places of the nodes that are new to this batch."""
    places = []
    for i, node in enumerate(nodes.tolist()):
        if node not in seen:
            seen.add(node)
            places.append(i)
    return np.array(places, dtype=np.int64)


def _pick(lines: Lines, at: np.ndarray) -> Lines:
    return Lines(lines.row[at], lines.number[at], lines.node[at], lines.low[at], lines.high[at], lines.data)


def _bands(batch: pa.RecordBatch, bits: int):
    """(block, keys, nodes): the sorted band keys of the lines of a batch and their nodes, as the bytes of 64-bit
    numbers, by block of the range of keys; a block is named by the first ``bits`` of its keys."""
    seen: set = set()
    nodes, keys = [], []
    for part in slices(column(batch, "text"), hashed=False):
        lines = judged_lines(part, ANY)
        own, found = band_keys(_pick(lines, _new(lines.node, seen)))
        nodes.append(np.repeat(own, BANDS))
        keys.append(found.ravel())
    if nodes:
        nodes, keys = np.concatenate(nodes), np.concatenate(keys)
        order = np.argsort(keys)
        nodes, keys = nodes[order], keys[order]
        blocks = (keys >> np.uint64(64 - bits)).astype(np.int64)
        starts = np.flatnonzero(np.diff(blocks, prepend=-1))
        bounds = list(zip(starts.tolist(), [*starts[1:].tolist(), len(keys)]))
        yield {"block": blocks[starts], **{name: [x[low:high].tobytes() for low, high in bounds] for name, x in (("keys", keys), ("nodes", nodes))}}


def _lists(block: pa.Table) -> pa.Table:
    """(key, node, pivot) of the band keys of a block that several nodes have, once each; the pivot is the smallest."""
    keys, nodes = (np.frombuffer(b"".join(block[name].to_pylist()), dtype=np.int64) for name in ("keys", "nodes"))
    order = np.argsort(keys)
    keys, nodes = keys[order], nodes[order]
    same = np.concatenate([[False], keys[1:] == keys[:-1], [False]])[-len(keys) - 1:]
    often = same[1:] | same[:-1]  # most keys stand once
    keys, nodes = keys[often], nodes[often]
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
    keys, nodes = keys[new], nodes[new]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
    size = np.diff(starts, append=len(keys))
    pivots, size = np.repeat(nodes[starts], size), np.repeat(size, size)
    shared = size > 1
    return pa.table({"key": keys[shared], "node": nodes[shared], "pivot": pivots[shared]})


def _band_lists(source: DataFrame, lines: int) -> DataFrame:
    """Lists of lines that agree in a band. A block takes so many keys of about ``BLOCK_LINES`` lines, however many there are."""
    bits = (max(lines, 1) // BLOCK_LINES + 1).bit_length()
    blocks = arrow_map(source.select("text"), "block bigint, keys binary, nodes binary", lambda batch: _bands(batch, bits))
    return blocks.groupBy("block").applyInArrow(_lists, "key bigint, node bigint, pivot bigint")


def repeated_lines(source: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(row, line, node) of all judged lines, and (row, dropped, judged) of the rows that lose lines:
    the numbers of the lines that are not the first of their component."""
    occurrences = materialise(arrow_map(source.select(ROW, "text"), f"{ROW} bigint, line bigint, node bigint, place bigint", _occurrences))
    lists = materialise(_band_lists(source, occurrences.count()))
    # most lines stand once and are in no list: nothing more is asked about them
    nodes = (occurrences.groupBy("node").agg(F.count("*").alias("n")).where("n > 1").select("node")
             .unionByName(listed := lists.select("node").distinct()).distinct())
    shared = materialise(occurrences.join(nodes, "node", "left_semi"))
    # the text of a line in a list is taken from its first place only
    first = materialise(shared.join(listed, "node", "left_semi").groupBy("node")
                        .agg(F.min_by(F.struct("place", ROW), F.struct(ROW, "line")).alias("first"))
                        .select("first.place", F.xxhash64(f"first.{ROW}").alias("bit")))
    send = source.sparkSession.sparkContext.broadcast
    rows, places = send(membership(first, "bit")), send(membership(first, "place"))

    def wanted(batch: pa.RecordBatch):
        holds = np.flatnonzero(is_member(rows.value, column(batch, "bit").to_numpy().view(np.uint64)))
        numbers = column(batch, ROW).to_numpy()[holds]
        for part in slices(column(batch, "text").take(pa.array(holds)), hashed=False):
            lines = judged_lines(part, ANY)
            at = np.flatnonzero(is_member(places.value, _places(numbers[part.low + lines.row], lines.number)))
            yield {"node": lines.node[at], "items": [lines.text(i) for i in at]}

    texts = materialise(arrow_map(source.select(ROW, F.xxhash64(ROW).alias("bit"), "text"), "node bigint, items binary", wanted))
    rows.destroy()
    places.destroy()
    alike = SimilarLines(PERCENT)
    labels = link_components(lists, texts, alike.search, BLOCK, alike.stars, alike.prepare)
    release(lists, first, texts)
    named = shared.join(labels, "node", "left").select(ROW, "line", F.coalesce("label", "node").alias("label"))
    # written out, so that the join with it can be split where many lines have one label
    first = materialise(named.groupBy("label").agg(F.min(F.struct(ROW, "line")).alias("first"), F.count("*").alias("n"))
                        .where("n > 1").select("label", "first"))
    dropped = (named.join(first, "label").where(F.struct(ROW, "line") != F.col("first"))
               .groupBy(ROW).agg(F.sort_array(F.collect_list("line")).alias("dropped")))
    return occurrences, dropped


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The documents without repeated lines; ``text`` has the kept ones, and ``judged_lines`` and
    ``dropped_lines`` count. Line feeds part lines.

    Lines without words are kept and not counted. A null text stays null, an
    empty one empty. Of repeated rows the later ones lose all judged lines. Any other columns are
    kept, but for clashes with the added ones, which are an error.
    """
    clash = {"judged_lines", "dropped_lines"} & set(docs.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are taken")
    source = numbered(docs.withColumn("text", F.col("text").cast("string")))
    occurrences, dropped = repeated_lines(source)
    counts = occurrences.groupBy(ROW).agg(F.count("*").alias("judged_lines"))
    changes = counts.join(dropped, ROW, "left")
    kept = F.expr("array_join(filter(split(text, '\\n'), (x, i) -> NOT array_contains(dropped, cast(i AS BIGINT))), '\\n')")
    # a row has one change at most, so the texts need not be sorted to meet them
    return (source.join(changes.hint("shuffle_hash"), ROW, "left")
            .withColumn("text", F.when(F.col("dropped").isNull(), F.col("text")).otherwise(kept))
            .withColumns({"dropped_lines": F.coalesce(F.size("dropped"), F.lit(0)).cast("long"),
                          "judged_lines": F.coalesce("judged_lines", F.lit(0)).cast("long")})
            .select(*docs.columns, "judged_lines", "dropped_lines"))


def without_repetitions(docs: DataFrame) -> DataFrame:
    """The documents without repeated lines, less those that had lines with a word and kept none."""
    # every line with a word is judged, so one that is left is one that was not dropped
    return dedup_lines(docs).where("judged_lines = 0 OR dropped_lines < judged_lines").drop("judged_lines", "dropped_lines")
