"""Similarity join of documents on word n-grams by T-occurrence search.

Two sets that link have so many shingles in common that they share some of their rarest ones: of
the n - ceil(share * n) + l rarest of each, at least l. A set for which fewer of these stand in any
other set links with none. What is rare is read from counts of all shingles in a table of fixed size;
any order would do for right results. Sets that meet under rare shingles are compared by a search in an inverted index: a set that links with a query is on at least T
of the query's lists. The longest lists are set aside (DivideSkip), the short ones are merged run by
run, and what they name often enough is looked up in the long ones by bisection. Sets that are found
are verified exactly.

Documents with equal sets are one node, named by a 64-bit hash of the set.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.frames import ROW, arrow_map, column, is_member, list_of, membership, numbered, reach
from tableflow.llm.linking import link_components, shared_lists
from tableflow.llm.textbytes import distinct_by_row, mix, shingles, slices
from tableflow.session import materialise, release

#: The table of counts has 2^24 cells (16 MB as levels) in 2^8 blocks.
_CELL_BITS, _BLOCK_BITS = 24, 8
#: Weight of the lists' length in the number of lists set aside (DivideSkip); a look-up in a list costs
#: as much as merging many entries here, so few are.
_MU = 20


def shingle_sets(texts: pa.Array, k: int):
    """For slices: (first row, end, sorted distinct shingles of each row, row bounds, nodes)."""
    for part in slices(texts):
        n = part.high - part.low
        values, bounds = distinct_by_row(*shingles(part, k), n)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(values ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
        nodes = mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64))
        yield part.low, part.high, values, bounds, nodes


def _once(nodes: np.ndarray, sizes: np.ndarray, seen: set) -> np.ndarray:
    """Whether a node with shingles is new to this batch."""
    new = np.zeros(len(nodes), dtype=bool)
    for i, (node, size) in enumerate(zip(nodes.tolist(), sizes.tolist())):
        if size and node not in seen:
            seen.add(node)
            new[i] = True
    return new


def shingle_levels(source: DataFrame, k: int) -> np.ndarray:
    """Rounded logarithm of the count in each cell of a hashed table of all shingles: 16 MB."""
    per_block = 1 << (_CELL_BITS - _BLOCK_BITS)

    def count(batch: pa.RecordBatch) -> dict:
        seen: set = set()
        cells = []
        for _, _, values, bounds, nodes in shingle_sets(column(batch, "text"), k):
            new = np.repeat(_once(nodes, np.diff(bounds), seen), np.diff(bounds))
            cells.append(values[new] >> np.uint64(64 - _CELL_BITS))
        cells, counts = np.unique(np.concatenate(cells or [np.empty(0, np.uint64)]).astype(np.int64), return_counts=True)
        bounds = np.searchsorted(cells, np.arange((1 << _BLOCK_BITS) + 1) * per_block)
        ids, blobs = [], []
        for block, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
            if b > a:
                ids.append(block)
                blobs.append((cells[a:b] - block * per_block).astype("<u2").tobytes() + np.minimum(counts[a:b], 255).astype(np.uint8).tobytes())
        return {"block": ids, "cells": blobs}

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(per_block, dtype=np.int64)
        for blob in table["cells"].to_pylist():
            n = len(blob) // 3
            total[np.frombuffer(blob, dtype="<u2", count=n)] += np.frombuffer(blob, dtype=np.uint8, offset=2 * n)
        levels = np.minimum(4 * np.log2(np.maximum(total, 1)), 255).astype(np.uint8)
        return pa.table({"block": pa.array([table["block"][0].as_py()], pa.int32()), "levels": pa.array([levels.tobytes()], pa.binary())})

    counted = arrow_map(source.select("text"), "block int, cells binary", count)
    whole = np.zeros((1 << _BLOCK_BITS, per_block), dtype=np.uint8)
    for row in reach(counted).groupBy("block").applyInArrow(add, "block int, levels binary").collect():
        whole[row.block] = np.frombuffer(bytes(row.levels), dtype=np.uint8)
    return whole.ravel()


def needed(size: int, percent: int) -> int:
    """Least overlap of a set of this size with any set that links."""
    return -(-percent * size // 100)


def _spare(sizes: np.ndarray, percent: int) -> np.ndarray:
    """How many rare shingles have to be shared at least (l), for sets of some sizes."""
    return np.maximum((sizes - -(-percent * sizes // 100) + 1) // 3, 1)


def _rarest(values: np.ndarray, bounds: np.ndarray, levels: np.ndarray, percent: int):
    """Places in ``values`` of the rarest shingles of each row, and their rows."""
    sizes = np.diff(bounds)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((values, levels[(values >> np.uint64(64 - _CELL_BITS)).astype(np.int64)], rows))
    rank = np.arange(len(values)) - bounds[rows]
    keep = rank < (sizes - -(-percent * sizes // 100) + _spare(sizes, percent))[rows]
    return order[keep], rows[keep]


def _sharing(lists: DataFrame) -> DataFrame:
    """Rows (key, node, pivot) of the sets that share as many rare shingles as a link takes. A set
    that goes can take that from others, so this is done twice."""
    for _ in range(2):
        old = lists
        enough = lists.groupBy("node").agg(F.count("*").alias("n"), F.first("least").alias("need")).where("n >= need").select("node")
        lists = materialise(shared_lists(old.join(enough, "node"), "least"))
        release(old)
    return lists


def _sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    return [values[a:b] for _, _, values, bounds, _ in shingle_sets(pa.array(texts, pa.binary()), k)
            for a, b in zip(bounds[:-1], bounds[1:])]


class InvertedIndex:
    """Lists of the numbers of sets, by item."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(x) for x in sets])
        items = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(items, kind="stable")  # owners stay in order
        items, self.numbers = items[order], owner[order]
        start = np.flatnonzero(np.concatenate([[True], items[1:] != items[:-1]]))
        self.items, self.low = items[start], start
        self.high = np.append(start[1:], len(items))

    def search(self, query: np.ndarray, percent: int) -> list[int]:
        """Numbers of the sets with 100 * overlap >= percent * union."""
        at = np.minimum(np.searchsorted(self.items, query), len(self.items) - 1)
        at = at[self.items[at] == query]
        least = needed(len(query), percent)
        if len(at) < least:
            return []
        low, sizes = self.low[at], (self.high - self.low)[at]
        order = np.argsort(sizes, kind="stable")
        low, sizes = low[order], sizes[order]
        aside = min(least - 1, int(least / (_MU * log2(sizes[-1] + 1) + 1)))
        names, counts = self._merge(low[:len(low) - aside], sizes[:len(low) - aside])
        both = len(query) + self.sizes[names]
        target = -(-percent * both // (100 + percent))
        live = (counts >= np.maximum(target - aside, 1))
        names, counts, target = names[live], counts[live], target[live]
        for left, (start, n) in zip(range(aside, 0, -1), zip(low[len(low) - aside:].tolist(), sizes[len(low) - aside:].tolist())):
            live = counts + left >= target
            if not live.all():
                names, counts, target = names[live], counts[live], target[live]
            if not len(names):
                return []
            one = self.numbers[start:start + n]
            counts += one[np.minimum(np.searchsorted(one, names), n - 1)] == names
        return names[counts >= target].tolist()

    def _merge(self, low: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers on the lists, each with how many lists it is on. The lists are sorted runs that follow
        each other, which a stable sort finds and merges, as a heap does."""
        ends = np.cumsum(sizes)
        merged = np.sort(self.numbers[np.arange(ends[-1]) + np.repeat(low - (ends - sizes), sizes)], kind="stable")
        start = np.flatnonzero(np.concatenate([[True], merged[1:] != merged[:-1]]))
        return merged[start], np.diff(start, append=len(merged))


def occurrence_search(k: int, percent: int):
    """A search for texts with 100 * overlap >= percent * union of their sets."""
    def search(indexed: list[bytes], queries: list[bytes]) -> Iterator[tuple[int, int]]:
        index = InvertedIndex(_sets(indexed, k))
        for query, items in enumerate(_sets(queries, k)):
            for found in index.search(items, percent):
                yield query, found
    return search


def join_similar(docs: DataFrame, k: int, percent: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row number, doc_id, n_shingles, component_id) for every document.

    ``component_id`` is the smallest id in the component. Rows without words have no shingles, link
    with nothing and keep their own id. Rows with equal sets are one component, also with null ids;
    if all its ids are null the component's is. Other columns are not used, whatever their names.
    """
    source = numbered(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")))
    send = docs.sparkSession.sparkContext.broadcast

    def names(batch: pa.RecordBatch):
        for low, high, _, bounds, nodes in shingle_sets(column(batch, "text"), k):
            yield {ROW: column(batch, ROW).slice(low, high - low), "doc_id": column(batch, "doc_id").slice(low, high - low),
                   "n_shingles": np.diff(bounds), "node": nodes}

    named = materialise(arrow_map(source, f"{ROW} bigint, doc_id bigint, n_shingles bigint, node bigint", names))
    levels = send(shingle_levels(source, k))

    def rare(batch: pa.RecordBatch):
        seen: set = set()
        for _, _, values, bounds, nodes in shingle_sets(column(batch, "text"), k):
            at, rows = _rarest(values, bounds, levels.value, percent)
            sizes = np.diff(bounds)
            new = _once(nodes, sizes, seen)[rows]
            least = _spare(-(-percent * sizes // 100), percent)  # of the smallest set that can link
            yield {"key": values[at[new]], "node": nodes[rows[new]], "least": least[rows[new]]}

    rows = arrow_map(source.select("text"), "key bigint, node bigint, least int", rare)
    lists = _sharing(materialise(shared_lists(rows, "least")))
    levels.destroy()
    first = named.where("n_shingles > 0").groupBy("node").agg(F.min(ROW).alias(ROW))
    wanted = materialise(first.join(lists.select("node").distinct(), "node"))
    bits = send(membership(wanted.withColumn("bit", F.xxhash64(ROW)), "bit"))

    def full(batch: pa.RecordBatch) -> dict:
        keep = pa.array(is_member(bits.value, column(batch, "bit").to_numpy().view(np.uint64)))
        texts = column(batch, "text").filter(keep)
        nodes = [x for *_, part in shingle_sets(texts, k) for x in part.view(np.int64).tolist()]
        return {"node": nodes, "items": texts.cast(pa.binary())}

    texts = materialise(arrow_map(source.select(F.xxhash64(ROW).alias("bit"), "text"), "node bigint, items binary", full))
    bits.destroy()
    labels = link_components(lists, texts, occurrence_search(k, percent))
    release(lists, wanted, texts)
    grouped = named.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    # written out, so that the join with it can be split where many rows have one label
    least = materialise(grouped.where("n_shingles > 0").groupBy("label")
                        .agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n"))
    return (grouped.join(least, "label", "left")
            .select(ROW, "doc_id", "n_shingles",
                    F.when(F.col("n_shingles") > 0, F.coalesce("least", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
                    F.when(F.col("n_shingles") > 0, F.col("label")).alias("component")))


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents less all but one of each component: the one with the smallest id stays (null
    ids last, then the first row). Rows without words all stay."""
    joined = join_similar(docs, k, percent).where(F.col("component").isNotNull())
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", ROW)
    several = (joined.groupBy("component").agg(F.min(order).alias("kept"), F.count("*").alias("n"))
               .where("n > 1").select("component", F.col(f"kept.{ROW}").alias("kept")))
    several = materialise(several)
    dropped = materialise(joined.join(several, "component").where(F.col(ROW) != F.col("kept")).select(ROW))
    return numbered(docs).join(dropped, ROW, "left_anti").drop(ROW)
