"""Near duplicates by SimHash: fingerprints of 64 bits that link where few bits differ.

Fingerprints are points in Hamming space, and a sample of them are references. For every fingerprint
the distances to all references are worked out, the pivot table: by the triangle inequality no
coordinate of the rows of two linked points differs by more than the radius. That bound is used twice.

1. Cells. Each point is at home in the cell of its nearest reference, at distance a. A linked point
   whose own nearest reference is at b >= a is at a + radius at most from there, so a point visits all
   cells with references up to b + radius away, and meets every point that it may link with.
2. In a cell, pairs of a home point and another are discarded by the largest difference of their
   coordinates to ``COORDINATES`` references; the survivors are verified bit by bit.

Points within the radius of a reference are tied to it, and references to each other; pairs that are
tied already are not compared. What is left of a cell is compared in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.components import connected_components
from tableflow.llm.frames import ROW, arrow_map, column, numbered, reach
from tableflow.llm.textbytes import SPACED, slices
from tableflow.session import materialise

#: Fixed values of the fingerprint.
SEED, WORDS, RADIUS = 42, 3, 3
#: References at most (a table of them is 128 KB), and how many there are for each root of the points.
MOST_REFERENCES, PER_ROOT = 1 << 14, 4
#: References of cells are further apart than this, so that a dense spot is not cut into many cells.
APART = 8
#: Coordinates that pairs are discarded by; points in one side of a block.
COORDINATES, CHUNK = 24, 4096

_BLOB, _STEP = 1 << 16, 255  # shingles hashed at a time; rows that a lane of a byte can count
_LANE = np.uint64(0x0101010101010101)


def shingle_hashes(text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """XXH64 of byte ranges."""
    digest, found = xxhash.xxh64_intdigest, np.empty(len(starts), dtype=np.uint64)
    for at in range(0, len(starts), _BLOB):
        low, high = starts[at:at + _BLOB].tolist(), ends[at:at + _BLOB].tolist()
        found[at:at + _BLOB] = [digest(text[a:b], SEED) for a, b in zip(low, high)]
    return found


def majority_bits(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For rows of hashes (row i has bounds[i] to bounds[i + 1]) the bits that are set in over half; 0
    for a row without any."""
    sizes = np.diff(bounds)
    pieces = -(-sizes // _STEP)
    first = np.concatenate([[0], np.cumsum(pieces)])
    at = np.repeat(bounds[:-1] - first[:-1] * _STEP, pieces) + np.arange(first[-1]) * _STEP
    full = sizes > 0
    out = np.zeros(len(sizes), dtype=np.uint64)
    if not full.any():
        return out
    counts = np.empty((len(at), 64), dtype=np.int64)
    for bit in range(8):  # bits 0, 8, 16, ... are counted in the eight bytes of one number
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & _LANE, at)
        counts[:, bit::8] = lanes.view(np.uint8).reshape(-1, 8)
    counts = np.add.reduceat(counts, first[:-1][full], axis=0)
    out[full] = np.packbits(2 * counts > sizes[full, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def text_fingerprints(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, end, fingerprints) for slices of a column of texts."""
    for part in slices(texts, hashed=False):
        keep = SPACED[part.data]
        keep[part.ends] = True
        spaced = part.data.copy()
        spaced[part.ends] = 0x20  # one space after each word, and no other
        place = np.cumsum(keep) - 1
        starts, ends = place[part.starts], place[part.ends]
        words = np.diff(part.first)
        sizes = np.where(words < WORDS, np.minimum(words, 1), words - WORDS + 1)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(part.first[:-1] - bounds[:-1], sizes) + np.arange(bounds[-1])
        last = np.minimum(at + WORDS, np.repeat(part.first[1:], sizes)) - 1
        hashes = shingle_hashes(spaced[keep].tobytes(), starts[at], ends[last])
        yield part.low, part.high, majority_bits(hashes, bounds)


def distances(points: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Hamming distances, one row a point."""
    return np.bitwise_count(points[:, None] ^ references[None, :])


class References:
    """Sampled points, with the component of each (by links between references), and those among
    them that have a cell."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.component = np.full(len(points), -1)
        for i in range(len(points)):
            if self.component[i] < 0:
                self.component[i] = i
                self._spread(i)
        free = np.ones(len(points), dtype=bool)
        cells = []
        while free.any():
            cells.append(int(free.argmax()))
            free &= distances(points[cells[-1:]], points)[0] > APART
        self.cells = points[np.array(cells, dtype=np.int64)]

    def _spread(self, i: int) -> None:
        waiting = [i]
        while waiting:
            near = distances(self.points[[waiting.pop()]], self.points)[0] <= RADIUS
            new = np.flatnonzero(near & (self.component < 0))
            self.component[new] = i
            waiting += new.tolist()

    def place(self, points: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(place in ``points``, cell, label, whether at home) of every stay of a point in a cell. The
        label is the reference that the point is tied to, or the point itself."""
        rows = max(1, (1 << 20) // len(self.points))
        for low in range(0, len(points), rows):
            own = points[low:low + rows]
            table = distances(own, self.points)
            nearest = table.argmin(axis=1)
            tied = table[np.arange(len(own)), nearest] <= RADIUS
            label = np.where(tied, self.points[self.component[nearest]], own)
            table = distances(own, self.cells)
            home = table.argmin(axis=1)
            point, cell = np.nonzero(table <= table[np.arange(len(own)), home][:, None] + RADIUS)
            yield low + point, cell, label[point], home[point] == cell


def sample_references(nodes: DataFrame) -> np.ndarray:
    """References by the smallest hash, some for each root of the number of points."""
    count = nodes.count()
    many = min(MOST_REFERENCES, int(PER_ROOT * count ** 0.5) + 1)
    rows = nodes.orderBy(F.xxhash64("node"), "node").limit(many).select("node").collect()  # bounded by MOST_REFERENCES
    return np.array([row.node for row in rows], dtype=np.int64).view(np.uint64)


def near_pairs(ask: np.ndarray, own: np.ndarray, table_ask: np.ndarray, table_own: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the linked pairs: no coordinate differs by more than the radius, then verified."""
    dense = min(4, table_own.shape[1])  # on whole matrices; the others look at survivors only
    rows = max(1, (1 << 20) // max(len(own), 1))
    for low in range(0, len(ask), rows):
        part = table_ask[low:low + rows]
        live = np.ones((len(part), len(own)), dtype=bool)
        for at in range(dense):
            live &= (part[:, None, at] - table_own[None, :, at] + RADIUS).view(np.uint8) <= 2 * RADIUS
        x, y = np.nonzero(live)
        for at in range(dense, table_own.shape[1]):
            keep = np.abs(part[x, at] - table_own[y, at]) <= RADIUS
            x, y = x[keep], y[keep]
        keep = np.bitwise_count(ask[low + x] ^ own[y]) <= RADIUS
        yield low + x[keep], y[keep]


def _ties(node: np.ndarray, label: np.ndarray, home: np.ndarray, side: np.ndarray, references: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of labels that the links of one block join."""
    table = distances(node, references).astype(np.int8)
    names, at = np.unique(label, return_inverse=True)
    top = np.arange(len(names))
    found = []
    first, second = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    for ask, own in ((first[home[first]], second), (first[~home[first]], second[home[second]])):
        for x, y in near_pairs(node[ask], node[own], table[ask], table[own]):
            a, b = at[ask[x]], at[own[y]]
            while len(a):
                apart = top[a] != top[b]
                a, b = a[apart], b[apart]
                if len(a):
                    low, high = sorted((int(top[a[0]]), int(top[b[0]])))
                    top[top == high] = low
                    found.append((int(names[a[0]]), int(names[b[0]])))
    return found


def link_points(nodes: DataFrame) -> DataFrame:
    """(node, label) of distinct fingerprints ``node`` (long): the label is one point of the component.

    ``nodes`` is read several times, so it should be written out. No pair within the radius is lost.
    """
    points = sample_references(nodes)
    if not len(points):
        return nodes.select("node", F.col("node").alias("label"))
    references = nodes.sparkSession.sparkContext.broadcast(References(points))
    pivots = points[:COORDINATES]

    def place(batch: pa.RecordBatch):
        own = column(batch, "node").to_numpy().view(np.uint64)
        for at, cell, label, home in references.value.place(own):
            yield {"cell": cell, "node": own[at], "label": label, "home": home}

    stays = materialise(arrow_map(nodes.select("node"), "cell int, node bigint, label bigint, home boolean", place))
    labels = stays.where("home").select("node", "label")

    def compare(block: pa.Table) -> pa.Table:
        node, label = (block[name].to_numpy().view(np.uint64) for name in ("node", "label"))
        found = _ties(node, label, block["home"].to_numpy(zero_copy_only=False), block["side"].to_numpy(), pivots)
        ends = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        return pa.table({"a": pa.array(ends[:, 0]), "b": pa.array(ends[:, 1])})

    edges = materialise(reach(_blocks(stays)).groupBy("cell", "block").applyInArrow(compare, "a bigint, b bigint"))
    joined = connected_components(edges).select(F.col("node").alias("label"), F.col("label").alias("whole"))
    return labels.join(joined, "label", "left").select("node", F.coalesce("whole", "label").alias("label"))


def _blocks(stays: DataFrame) -> DataFrame:
    """(cell, block, node, label, home, side). A cell is cut into the points with its most frequent label, which
    need not be compared with each other, and the loose rest; blocks pair a chunk of loose points (side 0) with
    another chunk (side 1) or with itself (side 2). A cell with one label has no block."""
    most = (stays.groupBy("cell", "label").agg(F.count("*").alias("n"))
            .groupBy("cell").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.max("n").alias("n"), F.sum("n").alias("whole")))
    parts = (most.where("whole > n")  # one row a cell, so at most MOST_REFERENCES
             .select("cell", "main", F.ceil(F.col("n") / CHUNK).cast("int").alias("mains"),
                     F.ceil((F.col("whole") - F.col("n")) / CHUNK).cast("int").alias("looses")))
    rows = stays.join(F.broadcast(parts), "cell").withColumn("loose", F.col("label") != F.col("main"))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("node"), F.when(F.col("loose"), F.col("looses")).otherwise(F.col("mains"))).cast("int"))
    # blocks of a loose chunk: with all main chunks, then with all loose ones; of a main chunk: with all loose ones
    to = F.explode(F.sequence(F.lit(0), F.when(F.col("loose"), F.col("mains") + F.col("looses")).otherwise(F.col("looses")) - 1))
    rows = rows.withColumn("to", to).withColumn("with", F.col("to") - F.col("mains"))
    with_main = (F.when(F.col("loose"), F.col("chunk")).otherwise(F.col("to")) * F.col("mains")
                 + F.when(F.col("loose"), F.col("to")).otherwise(F.col("chunk")))
    among = F.col("mains") * F.col("looses") + F.least("chunk", "with") * F.col("looses") + F.greatest("chunk", "with")
    other = F.col("loose") & (F.col("with") >= 0)
    return rows.select(
        "cell", F.when(other, among).otherwise(with_main).alias("block"), "node", "label", "home",
        F.when(~F.col("loose"), 1).when(~other, 0).when(F.col("chunk") == F.col("with"), 2)
        .when(F.col("chunk") < F.col("with"), 0).otherwise(1).alias("side"))


def fingerprint_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row number, doc_id, node) with the fingerprint as a long."""
    source = numbered(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")))

    def sign(batch: pa.RecordBatch):
        for low, high, found in text_fingerprints(column(batch, "text")):
            own = slice(low, high)
            yield {ROW: column(batch, ROW)[own], "doc_id": column(batch, "doc_id")[own], "node": found}

    return arrow_map(source, f"{ROW} bigint, doc_id bigint, node bigint", sign)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every document.

    ``component_id`` is the smallest id that links lead to, the own one included; null ids count only
    where a component has no other. Null texts and texts without words have fingerprint 0, which links
    like any other. Repeated rows stay, in one component. An empty table gives no rows. Other columns
    are not used, whatever their names.
    """
    signed = materialise(fingerprint_documents(docs, doc_id, text))
    nodes = materialise(signed.groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")))
    labels = materialise(nodes.join(link_points(nodes), "node"))
    whole = labels.groupBy("label").agg(F.min("least").alias("least"), F.sum("copies").alias("copies")).where("copies > 1")
    # written out, so that its size is known and the join with it can be split at a fingerprint with many copies
    linked = materialise(labels.select("node", "label").join(whole, "label").select("node", "least"))
    return (signed.join(linked, "node", "left")
            .select("doc_id", F.lpad(F.lower(F.hex("node")), 16, "0").alias("fingerprint"),
                    F.coalesce("least", "doc_id").alias("component_id")))
