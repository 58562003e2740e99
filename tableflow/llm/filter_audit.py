"""What each of several filters removes, in every order that they can be applied in.

A document is known by the filters it fails, a mask of one bit each. Spark counts the documents of
every part and mask, so that a part comes down to one cell for each mask, 32 with five filters. From
there on no document is looked at again: a Gray code visits all subsets of filters, toggling one
filter at a time. Each cell keeps the number of active filters it fails; a cell whose number leaves 0
is taken from the running survivors, one whose number returns to 0 is added. The survivors of each
subset are stored, and all steps of all orders are differences of two of them.
"""

from __future__ import annotations

import hashlib
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.frames import arrow_map, column, reach
from tableflow.llm.textbytes import distinct_by_row, slices, text_column
from tableflow.session import materialise

#: Words that a text has at least, percent of its words that are distinct at least,
#: percent of its code points that are capitals at most, and signs that it must not hold.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10
SIGNS = b"#$%&*|"
FILTERS = "ABCDE"
_COPY = 1 << FILTERS.index("E")

_SIGN = np.isin(np.arange(256), list(SIGNS))
_CAPITAL = (np.arange(256) >= 0x41) & (np.arange(256) <= 0x5A)
_LEADING = (np.arange(256) & 0xC0) != 0x80  # first bytes of characters

STEPS = ("part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
         "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint")


def _judge(batch: pa.RecordBatch):
    """Masks of the filters A to D, which look at one text, and a digest of the text for E."""
    texts = text_column(column(batch, "text"))
    for part in slices(texts, lower=False):
        n = part.high - part.low
        words = np.diff(part.first)
        distinct = np.diff(distinct_by_row(part.owner(), part.hashes, n)[1])

        def count(kind: np.ndarray) -> np.ndarray:
            return np.add.reduceat(kind[part.data], part.bounds[:-1], dtype=np.int64)

        points = count(_LEADING) - 1  # a line feed follows each text
        fails = (words < LEAST_WORDS, 100 * distinct < LEAST_DISTINCT * words,
                 100 * count(_CAPITAL) > MOST_CAPITALS * points, count(_SIGN) > 0)
        own = slice(part.low, part.high)
        yield {"doc_id": column(batch, "doc_id")[own], "part": column(batch, "part")[own],
               "mask": sum(f.astype(np.int32) << bit for bit, f in enumerate(fails)),
               "digest": [hashlib.sha256(x.as_buffer()).digest() for x in texts[own]]}


def failed_filters(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(doc_id, part, mask) of every document; bit i of the mask stands for filter i of ``FILTERS``.

    Filter E fails if any smaller id has the same text, wherever it is. A null text is the empty one,
    a null part the empty string. A null id is neither smaller nor larger than another, so its row
    passes E; rows with the smallest id all pass. Other columns are not used, whatever their names.
    """
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                         F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"))
    judged = materialise(arrow_map(source, "doc_id bigint, part string, mask int, digest binary", _judge))
    # written out, so that its size is known and the join with it can be split at a text with many copies
    copied = materialise(judged.groupBy("digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
                         .where("least < most").select("digest", "least"))
    later = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))
    return (judged.join(copied, "digest", "left")
            .select("doc_id", "part", F.when(later, F.col("mask") + _COPY).otherwise(F.col("mask")).alias("mask")))


def cells(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each cell, and those that ``labels`` (doc_id, quality,
    toxic) call good or toxic. Of several labels of one id, one that says so is enough."""
    said = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    return (failed.join(said, "doc_id", "left").groupBy("part", "mask")
            .agg(F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
                 F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")))


def survivors(masks: np.ndarray, weights: np.ndarray, filters: int) -> np.ndarray:
    """Weights (cells by columns) left under every subset of filters, by a walk in Gray-code order."""
    left = np.empty((1 << filters, weights.shape[1]), dtype=np.int64)
    failing = np.zeros(len(masks), dtype=np.int64)  # active filters that each cell fails
    running = weights.sum(axis=0)
    left[0] = running
    for i in range(1, 1 << filters):
        active = i ^ (i >> 1)
        toggled = active ^ ((i - 1) ^ ((i - 1) >> 1))
        cell = (masks & toggled) != 0
        if active & toggled:
            running = running - weights[cell & (failing == 0)].sum(axis=0)
            failing[cell] += 1
        else:
            failing[cell] -= 1
            running = running + weights[cell & (failing == 0)].sum(axis=0)
        left[active] = running
    return left


def all_orders(left: np.ndarray, letters: str = FILTERS) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for every step of
    every order, from the survivors (n, good, toxic) of every subset."""
    filters, whole = len(letters), (1 << len(letters)) - 1
    n = left[:, 0]
    fails = [int(n[0] - n[1 << f]) for f in range(filters)]
    unique = [int(n[whole ^ (1 << f)] - n[whole]) for f in range(filters)]
    shapley = [sum(factorial(s.bit_count()) * factorial(filters - 1 - s.bit_count()) * int(n[s] - n[s | 1 << f])
                   for s in range(whole + 1) if not s >> f & 1) for f in range(filters)]
    rows = []
    for order in permutations(range(filters)):
        before, name = 0, "".join(letters[f] for f in order)
        for step, f in enumerate(order, 1):
            after = before | 1 << f
            removed, good, toxic = (left[before] - left[after]).tolist()
            rows.append((name, step, int(n[after]), removed, fails[f] - removed, unique[f], good, toxic, shapley[f]))
            before = after
    return rows


def audit_filters(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """Every step of every order of the filters, for every part (``STEPS``).

    Documents with null or empty texts fail A alone, and E where they are not the first. An empty
    table has no parts and gives no rows; a step that removes nothing is a row of zeros.
    """
    def walk(table: pa.Table) -> pa.Table:
        weights = np.stack([table[name].to_numpy() for name in ("n", "good", "toxic")], axis=1)
        rows = all_orders(survivors(table["mask"].to_numpy().astype(np.int64), weights, len(FILTERS)))
        order, step, *counts = zip(*rows)
        return pa.table([pa.array([table["part"][0].as_py()] * len(rows), pa.string()), pa.array(order, pa.string()),
                         pa.array(step, pa.int32()), *[pa.array(x, pa.int64()) for x in counts]],
                        names=[field.split()[0] for field in STEPS.split(", ")])

    counted = materialise(cells(failed_filters(docs, part=part), labels))
    return reach(counted).groupBy("part").applyInArrow(walk, STEPS)
