"""Codes for vectors: each is cut into parts, and a part is named by the nearest entry of a codebook.

Everything is whole numbers, so every run on every cluster gives the same codes. The distinct parts of
each position are counted once (equal parts are one row with a weight, however many vectors hold
them), sorted and written in that order. A round reads them in order as a lexicographic trie, one
dimension a level: the distances to all entries, summed over the dimensions of a prefix, are one
vector that all parts below share. A leaf takes the nearest entry and adds its part, times its weight,
to the sums of that entry; only those sums leave a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.frames import arrow_map, column, reach
from tableflow.session import materialise

#: Fixed values of the code: parts of a vector, entries of a codebook (two hex digits), rounds, and
#: what a component is multiplied by.
PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Largest component: squared distances of any usual number of dimensions fit a long.
MOST = 1 << 27
#: Leaves whose levels are walked together.
BLOCK = 1024

_HEX = np.array([f"{i:02x}" for i in range(ENTRIES)])


def whole_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, label, v) with whole numbers floor(1024 x); vectors that are null, empty, or hold a null or
    non-finite component are left out."""
    bad = F.exists("raw", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return (vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"),
                           F.col(vector).cast("array<double>").alias("raw"))
            .where((F.size("raw") > 0) & ~bad)
            .select("vec_id", "label", F.transform("raw", lambda x: F.floor(x * SCALE)).alias("v")))


def _dimensions(whole: DataFrame) -> int | None:
    """The most frequent length (of equally frequent ones the largest), None for no vectors."""
    largest = F.greatest(F.array_max("v"), -F.array_min("v"))
    row = (whole.groupBy(F.size("v").alias("length")).agg(F.count("*").alias("n"), F.max(largest).alias("most"))
           .orderBy(F.desc("n"), F.desc("length")).first())
    if row is None:
        return None
    if row.length % PARTS:
        raise ValueError(f"vectors of {row.length} components cannot be cut into {PARTS} equal parts")
    if row.most > MOST:
        raise ValueError(f"components of more than {MOST} / {SCALE} are not supported")
    return row.length


def nearest_entries(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of each of the sorted distinct ``parts``; ties go to the lower entry.

    The trie is walked depth first. A node holds its summed distances to all entries; a child with more
    than ``BLOCK`` leaves gets its own, smaller children that follow each other are finished together,
    level by level, from the sums of their parent on.
    """
    n, width = parts.shape
    most = max((int(np.abs(x).max()) for x in (parts, entries) if x.size), default=0)
    kind = np.int32 if 4 * width * (most + 1) ** 2 < 1 << 31 else np.int64
    parts, entries = parts.astype(kind), entries.astype(kind)
    nearest, distance = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    if not n:
        return nearest, distance
    split = np.zeros(n, dtype=np.int64)  # first level at which a part leaves the path of the one before
    split[1:] = (parts[1:] != parts[:-1]).argmax(axis=1)

    def finish(low: int, high: int, level: int, sums: np.ndarray) -> None:
        above, sums = np.array([low]), sums[None, :]
        for at in range(level, width):
            nodes = np.concatenate([[low], low + 1 + np.flatnonzero(split[low + 1:high] <= at)])
            if len(nodes) > len(above):
                sums = sums[np.searchsorted(above, nodes, side="right") - 1]
            off = parts[nodes, at][:, None] - entries[None, :, at]
            sums = sums + off * off
            above = nodes
        nearest[low:high] = sums.argmin(axis=1)
        distance[low:high] = sums.min(axis=1)

    stack = [(0, n, 0, np.zeros(len(entries), dtype=kind))]
    while stack:
        low, high, level, sums = stack.pop()
        if high - low <= BLOCK:
            finish(low, high, level, sums)
            continue
        starts = np.concatenate([[low], low + 1 + np.flatnonzero(split[low + 1:high] <= level), [high]]).tolist()
        run = low
        for child, after in zip(starts[:-1], starts[1:]):
            if after - run > BLOCK and child > run:
                finish(run, child, level, sums)
                run = child
            if after - child > BLOCK:
                off = parts[child, level] - entries[:, level]
                stack.append((child, after, level + 1, sums + off * off))
                run = after
        if run < high:
            finish(run, high, level, sums)
    return nearest, distance


def _first_codebooks(whole: DataFrame, dims: int) -> np.ndarray:
    """Parts of the first vectors by id (nulls last; equal ids by their components)."""
    rows = whole.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(ENTRIES).select("v").collect()
    return np.array([row.v for row in rows], dtype=np.int64).reshape(len(rows), PARTS, dims // PARTS).transpose(1, 0, 2)


def _distinct_parts(whole: DataFrame, dims: int) -> DataFrame:
    """(place, part, weight) in lexicographic order, cut into ranges."""
    width = dims // PARTS
    cut = F.array(*[F.slice("v", 1 + place * width, width) for place in range(PARTS)])
    return materialise(whole.select(F.posexplode(cut).alias("place", "part")).groupBy("place", "part")
                       .agg(F.count("*").alias("weight"))
                       .repartitionByRange("place", "part").sortWithinPartitions("place", "part"))


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _moved(distinct: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks after one round."""
    width = codebooks.shape[2]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of a task, of the parts (at 0 to width - 1) and their number (at width)."""
        total = np.zeros((*codebooks.shape[:2], width + 1), dtype=np.int64)
        for batch in batches:
            place, weight = (column(batch, name).to_numpy() for name in ("place", "weight"))
            parts = _matrix(column(batch, "part"), width)
            for at in np.unique(place):
                own = place == at
                entry, _ = nearest_entries(parts[own], codebooks[at])
                many = weight[own][:, None]
                np.add.at(total[at], entry, np.concatenate([parts[own] * many, many], axis=1))
        place, entry, at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array(entry, pa.int32()),
                                          pa.array(at, pa.int32()), pa.array(total[place, entry, at], pa.int64())],
                                         names=["place", "entry", "at", "total"])

    sums = reach(distinct).mapInArrow(add, "place int, entry int, at int, total bigint")
    whole = np.zeros((*codebooks.shape[:2], width + 1), dtype=np.int64)
    for row in sums.groupBy("place", "entry", "at").agg(F.sum("total").alias("total")).collect():  # one row a number
        whole[row.place, row.entry, row.at] = row.total
    counts = whole[:, :, width:]
    return np.where(counts > 0, whole[:, :, :width] // np.maximum(counts, 1), codebooks)


def digest(codebooks: np.ndarray) -> str:
    """SHA-256 of all numbers of the codebooks, by part, entry and place in the part."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def encode_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) for every whole vector.

    Vectors that are null, empty, or hold null or non-finite components are left out, and so are those
    of another length than most have. Ids and labels may repeat or be null: every row gets a code, null
    labels are one label. Fewer than 256 vectors make codebooks of fewer entries. An empty table gives
    no rows. Other columns are not used, whatever their names.
    """
    whole = whole_vectors(vectors, vec_id, vector, label)
    dims = _dimensions(whole)
    whole = whole.where(F.size("v") == (dims or 0))
    codebooks = np.zeros((PARTS, 0, 0), dtype=np.int64)
    if dims:
        codebooks = _first_codebooks(whole, dims)
        distinct = _distinct_parts(whole, dims)
        for _ in range(ROUNDS):
            codebooks = _moved(distinct, codebooks)

    def code(batch: pa.RecordBatch) -> dict:
        parts = _matrix(column(batch, "v"), dims).reshape(batch.num_rows, PARTS, -1)
        codes, error = np.full(batch.num_rows, "", dtype="<U8"), np.zeros(batch.num_rows, dtype=np.int64)
        for place in range(PARTS):
            own, back = np.unique(parts[:, place], axis=0, return_inverse=True)
            entry, distance = nearest_entries(own, codebooks[place])
            codes = np.char.add(codes, _HEX[entry[back.ravel()]])
            error += distance[back.ravel()]
        return {"vec_id": column(batch, "vec_id"), "label": column(batch, "label"), "code": pa.array(codes.tolist(), pa.string()),
                "error": error}

    kinds = {field.name: field.dataType.simpleString() for field in whole.schema}
    coded = materialise(arrow_map(whole, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint", code))
    sums = materialise(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")))
    return (coded.join(sums, F.col("label").eqNullSafe(F.col("of")))
            .select("vec_id", "label", "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256")))
