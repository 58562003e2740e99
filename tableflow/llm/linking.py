"""From lists of sets that may be alike to the components of those that are.

A list names sets (64-bit nodes) that share something: a rare shingle, a band of a signature. All
pairs of a list have to be looked at, but not emitted:

1. Every set of a list is compared with one of them, the pivot: at most one pair for each row.
2. Linked sets get the smallest pivot that is two links away at most as a label, which they share
   with none that they are not tied to. Most lists have one label now, and nothing is left to do.
3. In the others every pair of different labels is compared inside a task, in blocks of at most ``BLOCK`` by ``BLOCK`` sets, so a list of any length is split; links that join nothing new
   are not given out.

No link is lost: a pair of a list is compared in
step 1 or 3, or both sides are tied by links already.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableflow.llm.components import connected_components
from tableflow.llm.frames import give_back, reach
from tableflow.session import materialise, release

BLOCK, STARS, PREPARED = 256, 256, 2048

#: Given the items of indexed sets and of queries, yields the numbers (query, indexed set) of those
#: that link.
Search = Callable[[list[bytes], list[bytes]], Iterator[tuple[int, int]]]
#: Given the items of many blocks, what ``search`` takes for each of them.
Prepare = Callable[[list[bytes]], list]
#: Given the items of blocks that follow each other, each with its pivot first, and where they start,
#: yields the places (query, pivot) of those that link.
Stars = Callable[[list[bytes], list[int]], Iterator[tuple[int, int]]]


def shared_lists(rows: DataFrame, *more: str) -> DataFrame:
    """Of (key, node) rows those of keys with several nodes, once each, with the smallest as pivot;
    columns ``more`` go with the node."""
    whole = Window.partitionBy("key")
    return (rows.select("key", "node", *more, F.min("node").over(whole).alias("pivot"),
                        F.max("node").over(whole).alias("last"))
            .where("pivot <> last").drop("last").distinct())


def link_components(lists: DataFrame, sets: DataFrame, search: Search, block: int | None = None,
                    stars: Stars | None = None, prepare: Prepare | None = None) -> DataFrame:
    """(node, label) of the nodes that have a link; other nodes are alone.

    ``lists`` holds key, node, pivot and ``sets`` node, items (binary: what is compared); both are read several
    times, so they should be written out. ``stars`` may compare many sets with their pivots faster than ``search``, and
    ``prepare`` may work on the items of several blocks at once, before ``search`` gets those of one.
    """
    block = block or BLOCK
    tied = _links(_star_blocks(lists, block), sets, search, stars, prepare)
    near = materialise(_near_labels(tied))
    rest = materialise(_unsettled(lists, near, block))
    more = _links(_pair_blocks(rest), sets, search, prepare=prepare)
    labels = _all_labels(tied.unionByName(more), near)
    release(rest, tied, more, near)
    return labels


def _all_labels(edges: DataFrame, near: DataFrame) -> DataFrame:
    """Labels of the components of all links; those that the near labels settle are one node."""
    nodes = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    nodes = materialise(nodes.join(near, "node", "left").select("node", F.coalesce("label", "node").alias("near")))
    ends = [nodes.select(F.col("node").alias(side), F.col("near").alias(f"near_{side}")) for side in "ab"]
    left = edges.join(ends[0], "a").join(ends[1], "b").select(F.col("near_a").alias("a"), F.col("near_b").alias("b"))
    labels = connected_components(left).withColumnRenamed("node", "near")
    return nodes.join(labels, "near", "left").select("node", F.coalesce("label", "near").alias("label"))


def _star_blocks(lists: DataFrame, size: int) -> DataFrame:
    """(block, part, node, label, side): the pivot of a block is indexed, the others are queries."""
    pairs = lists.where("node <> pivot").select("pivot", "node").distinct()
    parts = pairs.groupBy("pivot").agg(F.ceil(F.count("*") / size).cast("int").alias("parts"))
    queries = pairs.join(parts, "pivot").select(
        F.col("pivot").alias("block"), F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"),
        "node", F.col("node").alias("label"), F.lit(1).alias("side"))
    pivots = parts.select(F.col("pivot").alias("block"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                          F.col("pivot").alias("node"), F.col("pivot").alias("label"), F.lit(0).alias("side"))
    return queries.unionByName(pivots)


def _near_labels(stars: DataFrame) -> DataFrame:
    one = stars.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
    two = one.select(F.col("node").alias("label"), F.col("label").alias("next"))
    return one.join(two, "label", "left").select("node", F.least("label", F.coalesce("next", "label")).alias("label"))


def _unsettled(lists: DataFrame, labels: DataFrame, size: int) -> DataFrame:
    """Members (key, node, label, parts) of the lists with several labels. Lists with one pivot
    mostly have the same members; they are one list from here on, named by the pivot."""
    named = lists.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = (named.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most"))
             .where("least <> most").select("key"))
    members = named.join(mixed, "key").select(F.col("pivot").alias("key"), "node", "label").distinct()
    parts = members.groupBy("key").agg(F.ceil(F.count("*") / size).cast("int").alias("parts"))
    return members.join(parts, "key")


def _pair_blocks(rest: DataFrame) -> DataFrame:
    """Blocks of chunks i <= j of a list: chunk i is indexed (side 0), chunk j asks (side 1); a
    chunk with itself is both (side 2)."""
    chunk = rest.withColumn("chunk", F.pmod(F.xxhash64(F.lit(2), "node"), F.col("parts")).cast("int"))
    other = chunk.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    return other.select(
        F.col("key").alias("block"),
        (F.least("chunk", "other") * F.col("parts") + F.greatest("chunk", "other")).alias("part"), "node", "label",
        F.when(F.col("chunk") == F.col("other"), 2).when(F.col("chunk") < F.col("other"), 0).otherwise(1).alias("side"))


def _links(blocks: DataFrame, sets: DataFrame, search: Search, stars: Stars | None = None,
           prepare: Prepare | None = None) -> DataFrame:
    """Links (a, b) that join components inside each block; with ``stars``, all with the pivot."""
    def compare(table: pa.Table, starts: list[int]) -> Iterator[tuple[list, list]]:
        """Block by block; the items of about ``PREPARED`` rows are prepared at once, for memory."""
        sides = table["side"].to_numpy()
        nodes, labels = (table[name].to_pylist() for name in ("node", "label"))
        low = 0
        while low < len(starts) - 1:
            high = max(bisect_right(starts, starts[low] + PREPARED) - 1, low + 1)
            a, b = starts[low], starts[high]
            items = table["items"].slice(a, b - a).to_pylist()
            items = prepare(items) if prepare else items
            for x, y in zip(starts[low:high], starts[low + 1:high + 1]):
                yield one(sides[x:y], items[x - a:y - a], nodes[x:y], labels[x:y])
            low = high

    def one(side: np.ndarray, own: list, nodes: list, labels: list) -> tuple[list, list]:
        indexed, asking = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        joined = _Union(labels)
        a, b = [], []
        found_links = ()
        if len(indexed) and len(asking):
            sets = [own[i] for i in indexed]
            found_links = search(sets, sets if (side == 2).all() else [own[i] for i in asking])
        for query, found in found_links:
            query, found = asking[query], indexed[found]
            if joined.tie(labels[query], labels[found]):
                a.append(nodes[query])
                b.append(nodes[found])
        return a, b

    def with_pivots(table: pa.Table, starts: list[int]) -> tuple[list, list]:
        nodes = table["node"].to_numpy()
        found = np.array(list(stars(table["items"].to_pylist(), starts)), dtype=np.int64).reshape(-1, 2)
        a, b = nodes[found[:, 0]], nodes[found[:, 1]]
        return a[a != b].tolist(), b[a != b].tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks come one after the other; the last one of a batch may go on in the next."""
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            starts = _block_starts(table)
            if stars and len(starts) > 1:
                for low in range(0, len(starts) - 1, STARS):  # so many blocks at a time, for memory
                    own = starts[low:low + STARS + 1]
                    yield _as_links([with_pivots(table.slice(own[0], own[-1] - own[0]), [x - own[0] for x in own])])
            else:
                yield _as_links(compare(table, starts))
            held = table.slice(starts[-1]) if len(starts) else None
        if held is not None and len(held):
            whole = [0, len(held)]
            yield _as_links([with_pivots(held, whole)] if stars else compare(held, whole))
        held = table = None
        give_back()

    full = (reach(blocks).join(sets, "node").select("block", "part", "label", "node", "side", "items")
            .repartition("block", "part").sortWithinPartitions("block", "part", "side"))
    return materialise(full.mapInArrow(run, "a bigint, b bigint"))


def _block_starts(table: pa.Table) -> list[int]:
    block, part = table["block"].to_numpy(), table["part"].to_numpy()
    new = (block[1:] != block[:-1]) | (part[1:] != part[:-1])
    return [0, *(np.flatnonzero(new) + 1).tolist()] if len(block) else []


def _as_links(found) -> pa.RecordBatch:
    a, b = [], []
    for more_a, more_b in found:
        a += more_a
        b += more_b
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


class _Union:
    def __init__(self, labels):
        self.up = {x: x for x in labels}

    def top(self, x):
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def tie(self, a, b) -> bool:
        a, b = self.top(a), self.top(b)
        self.up[max(a, b)] = min(a, b)
        return a != b
