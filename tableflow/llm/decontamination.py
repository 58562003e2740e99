"""Benchmark decontamination by greedy string tiling.

Windows of ``SEED`` words that a document and a benchmark item share are seeds; Spark joins them and
counts which item could be covered far enough. Those pairs are tiled: the longest common runs of
words that do not overlap are marked, longest first, found by running Karp-Rabin hashes for a run
length that is halved until it is that of a seed. An item whose words are covered by tiles to at
least ``PERCENT`` stands in the document, in whatever order its passages come.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.frames import ROW, arrow_map, column, is_member, list_of, membership, numbered
from tableflow.llm.textbytes import Rolling, Slice, slices, windows
from tableflow.session import materialise

SEED, PERCENT = 5, 80
_START = 32  # first run length of the search


def greedy_tiles(item: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Tiles (place in the item, place in the text, length), longest first, none overlapping."""
    own, other = item.tolist(), text.tolist()
    used_own, used_other = bytearray(len(own)), bytearray(len(other))
    hashes, tiles = (Rolling(item), Rolling(text)), []
    length = max(least, min(_START, len(own)))
    while True:
        matches = _matches(*hashes, own, other, used_own, used_other, length)
        longest = max((n for *_, n in matches), default=0)
        if longest > 2 * length:
            length = longest
            continue
        _mark(matches, tiles, used_own, used_other, length)
        if length <= least:
            return tiles
        length = max(least, length // 2)


def _unmarked(used: bytearray, length: int) -> np.ndarray:
    """Whether each window of so many words has no marked one."""
    sums = np.concatenate([[0], np.cumsum(np.frombuffer(bytes(used), dtype=np.uint8), dtype=np.int64)])
    return sums[length:] == sums[:-length]


def _matches(item: Rolling, text: Rolling, own, other, used_own, used_other, length: int) -> list[tuple[int, int, int]]:
    """Unmarked common runs of at least ``length`` that cannot be longer to the left."""
    places = defaultdict(list)
    windows = item.windows(length)
    for place in np.flatnonzero(_unmarked(used_own, length)).tolist():
        places[int(windows[place])].append(place)
    found = []
    whole = text.windows(length)
    known = np.isin(whole, np.fromiter(places, np.uint64, len(places)))
    for b in np.flatnonzero(known & _unmarked(used_other, length)).tolist():
        for a in places[int(whole[b])]:
            if a and b and own[a - 1] == other[b - 1] and not used_own[a - 1] and not used_other[b - 1]:
                continue
            n = 0
            while (a + n < len(own) and b + n < len(other) and own[a + n] == other[b + n]
                   and not used_own[a + n] and not used_other[b + n]):
                n += 1
            if n >= length:
                found.append((a, b, n))
    return found


def _mark(matches, tiles, used_own, used_other, length: int) -> None:
    """Mark the longest first; what earlier tiles leave of a run takes its turn by its length."""
    waiting = [(-n, a, b) for a, b, n in matches]
    heapq.heapify(waiting)
    while waiting:
        n, a, b = heapq.heappop(waiting)
        n = -n
        if used_own.find(0, a, a + n) < 0 or used_other.find(0, b, b + n) < 0:
            continue  # nothing of it is left
        taken = [i for i in range(n) if used_own[a + i] or used_other[b + i]]
        if not taken:
            used_own[a:a + n] = used_other[b:b + n] = b"\1" * n
            tiles.append((a, b, n))
            continue
        for low, high in zip([-1, *taken], [*taken, n]):
            if high - low - 1 >= length:
                heapq.heappush(waiting, (low + 1 - high, a + low + 1, b + low + 1))


def is_a_line(item: np.ndarray, part: Slice, low: int, high: int) -> bool:
    """Whether a line of a text (words ``low`` to ``high`` - 1 of the slice) has the words of the item, and no other."""
    line = np.searchsorted(np.flatnonzero(part.data == 10), part.starts[low:high])
    first = np.flatnonzero(np.diff(line, prepend=-1))
    fits = np.flatnonzero(np.diff(first, append=len(line)) == len(item))
    return any((part.hashes[low + at:low + at + len(item)] == item).all() for at in first[fits].tolist())


def _seeds(items: DataFrame) -> DataFrame:
    """(gram, size, item, words) of every window of an item; a shorter item is one window."""
    def find(batch: pa.RecordBatch):
        names = column(batch, ROW)
        for part in slices(column(batch, "text")):
            for row, a, b in part.texts():
                size = min(SEED, b - a)
                if size:
                    grams = windows(part.hashes[a:b], size)
                    n = len(grams)
                    yield {"gram": grams, "size": np.full(n, size), "item": pa.array([names[row].as_py()] * n, pa.int64()),
                           "words": np.full(n, b - a)}

    return arrow_map(items.select(ROW, "text"), "gram bigint, size bigint, item bigint, words bigint", find)


def contaminated(docs: DataFrame, benchmark: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """(row number, doc_id, item_id, item_words, covered_words, n_tiles) of every document and item
    that stands in it.

    An item of fewer than ``SEED`` words stands in a document only as a whole line, so that a short answer
    does not mark every text with its words. Null and empty texts on either side match nothing. Repeated rows on either side give a row each.
    Words are parted by white space, A-Z made small. Other columns are not used.
    """
    source = numbered(docs) if source is None else source
    source = source.select(ROW, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = numbered(benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")))
    send = docs.sparkSession.sparkContext.broadcast
    seeds = materialise(_seeds(items))
    sizes = [row["size"] for row in seeds.select("size").distinct().collect()]  # at most SEED
    bits = send(membership(seeds, "gram"))

    def hits(batch: pa.RecordBatch):
        for part in slices(column(batch, "text")):
            rows, grams = [], []
            for size in sizes:
                whole = windows(part.hashes, size)
                owner = part.owner()
                fits = is_member(bits.value, whole) & (owner[:len(whole)] == owner[size - 1:size - 1 + len(whole)])
                rows.append(owner[:len(whole)][fits])
                grams.append(whole[fits])
            if not rows or not len(rows := np.concatenate(rows)):
                continue
            both = np.unique(np.stack([rows.astype(np.uint64), np.concatenate(grams)], axis=1), axis=0)
            found, start = np.unique(both[:, 0].astype(np.int64), return_index=True)
            yield {ROW: column(batch, ROW).slice(part.low, part.high - part.low).take(pa.array(found)),
                   "grams": list_of(np.ascontiguousarray(both[:, 1]), np.append(start, len(both)))}

    shared = materialise(arrow_map(source.select(ROW, "text"), f"{ROW} bigint, grams array<bigint>", hits))
    bits.destroy()
    pairs = materialise(
        shared.select(ROW, F.explode("grams").alias("gram")).join(seeds, "gram")
        .groupBy(ROW, "item", "words", "size").agg(F.count("*").alias("n"))
        .where(F.col("n") * F.col("size") * 100 >= F.col("words") * PERCENT).select(ROW, "item"))
    wanted = send(membership(pairs.select(F.xxhash64(ROW).alias("bit")), "bit"))

    def texts(batch: pa.RecordBatch) -> dict:
        keep = pa.array(is_member(wanted.value, column(batch, "bit").to_numpy().view(np.uint64)))
        return {name: column(batch, name).filter(keep) for name in (ROW, "doc_id", "text")}

    candidates = arrow_map(source.withColumn("bit", F.xxhash64(ROW)), f"{ROW} bigint, doc_id bigint, text string", texts)
    both = candidates.join(pairs, ROW).join(
        items.select(F.col(ROW).alias("item"), "item_id", F.col("text").alias("item_text")), "item")

    def tile(batch: pa.RecordBatch):
        found = []
        own = {}
        for part in slices(column(batch, "item_text")):
            own.update((row, part.hashes[a:b].copy()) for row, a, b in part.texts())
        for part in slices(column(batch, "text")):
            for row, a, b in part.texts():
                item = own[row]
                if len(item) < SEED and not is_a_line(item, part, a, b):
                    continue
                tiles = greedy_tiles(item, part.hashes[a:b], min(SEED, len(item)))
                covered = sum(n for *_, n in tiles)
                if 100 * covered >= PERCENT * len(item):
                    found.append((row, len(item), covered, len(tiles)))
        rows = pa.array([x[0] for x in found], pa.int64())
        return {**{name: column(batch, name).take(rows) for name in (ROW, "doc_id", "item_id")},
                **{name: [x[i] for x in found] for i, name in ((1, "item_words"), (2, "covered_words"), (3, "n_tiles"))}}

    return arrow_map(both.select(ROW, "doc_id", "item_id", "text", "item_text"),
                     f"{ROW} bigint, doc_id bigint, item_id bigint, item_words bigint, covered_words bigint, n_tiles bigint", tile)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no benchmark item stands, with all their columns."""
    source = numbered(docs)
    found = materialise(contaminated(docs, benchmark, source).select(ROW).distinct())
    return source.join(found, ROW, "left_anti").drop(ROW)
