"""Two-pass external shuffle.

Pass one scatters rows over buckets that fit in memory, by a seeded hash of the whole row. Pass two
takes one bucket at a time and puts its rows in random order (Fisher-Yates with a seed of its own).
The buckets, one after the other, are then a random order of the whole table, which is cut into
shards. Every step depends on the rows and the seed only, so a task that runs again after the loss
of an executor gives the same rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableflow.llm.frames import reach
from tableflow.session import materialise

BUCKET, PLACE, SHARD, SLOT = "__bucket", "__place", "__shard", "__slot"
_HASH = "__hash"
ROW_BYTES = 16


def record_bytes(text: Column) -> Column:
    """Bytes that a record takes: its UTF-8 text and a fixed share."""
    return F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES


def fisher_yates(n: int, seed: int) -> np.ndarray:
    """A random order of 0 .. n-1: from the end on, each place is swapped with one not after it."""
    order = list(range(n))
    if n > 1:
        draws = np.random.default_rng(seed).integers(0, np.arange(n, 1, -1)).tolist()
        for place, other in zip(range(n - 1, 0, -1), draws):
            order[place], order[other] = order[other], order[place]
    return np.array(order, dtype=np.int64)


def shuffle_rows(docs: DataFrame, seed: int = 7, bucket_bytes: int = 32 << 20,
                 text: str = "text") -> DataFrame:
    """All rows with their bucket and their random place in it (gapless from 0), written out.

    A row scatters by a hash of its columns and of its place in the stored table, so rows scatter evenly,
    also those that are equal in every column, and a task that runs again gives the same buckets. Null
    texts count as no bytes. An empty table gives no rows. Column names of the table may be any but those that are added here.
    """
    taken = {BUCKET, PLACE, _HASH} & set(docs.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are taken")
    size = docs.agg(F.sum(record_bytes(F.col(text)).cast("long")).alias("n")).first().n or 0
    buckets = max(1, math.ceil(size / bucket_bytes))
    row = [F.col(f"`{c}`") for c in docs.columns]
    scattered = docs.withColumn(_HASH, F.xxhash64(F.lit(seed), F.monotonically_increasing_id(), *row))
    scattered = scattered.withColumn(BUCKET, F.pmod(F.xxhash64(F.lit(seed), F.col(_HASH)), F.lit(buckets)).cast("int"))
    scattered = scattered.repartitionById(buckets, F.col(BUCKET))  # a bucket is a partition
    schema = ", ".join([*(f"`{name}` {kind}" for name, kind in docs.dtypes), f"{BUCKET} int, {PLACE} bigint"])
    names = [*docs.columns, BUCKET]

    def shuffle_bucket(table: pa.Table) -> pa.Table:
        table = table.take(pa.array(np.argsort(table[_HASH].to_numpy(), kind="stable")))
        bucket = table[BUCKET][0].as_py()
        order = fisher_yates(len(table), seed * 1_000_003 + bucket)
        return table.select(names).take(pa.array(order)).append_column(
            PLACE, pa.array(np.arange(len(order), dtype=np.int64)))

    return materialise(reach(scattered).groupBy(BUCKET).applyInArrow(shuffle_bucket, schema))


def assign_shards(shuffled: DataFrame, shards: int) -> DataFrame:
    """Cut the random order into shards whose row counts differ by one at most.

    The first shards take the larger share. ``__slot`` is the place in the shard, gapless from 0.
    """
    counts = shuffled.groupBy(BUCKET).agg(F.count("*").alias("__n"))
    before = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col(BUCKET), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
                            F.sum("__n").over(Window.partitionBy()).alias("__rows"))
    at = F.col("__before") + F.col(PLACE)
    low = F.expr(f"__rows div {shards}")
    larger = F.expr(f"__rows % {shards}")
    cut = larger * (low + 1)
    shard = F.when(F.col("__at") < F.col("__cut"), F.expr("__at div (__low + 1)")).otherwise(
        F.expr("__larger + (__at - __cut) div greatest(__low, 1)"))
    slot = F.when(F.col("__at") < F.col("__cut"), F.expr("__at % (__low + 1)")).otherwise(
        F.expr("(__at - __cut) % greatest(__low, 1)"))
    return (shuffled.join(offsets, BUCKET).withColumns({"__at": at, "__low": low, "__larger": larger})
            .withColumn("__cut", cut)
            .withColumns({SHARD: shard.cast("int"), SLOT: slot.cast("long")})
            .drop("__before", "__rows", "__at", "__low", "__larger", "__cut"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write one folder for each shard, in the order of the slots, without the bucket columns."""
    (sharded.repartition(F.col(SHARD)).sortWithinPartitions(SHARD, SLOT)
     .drop(BUCKET, PLACE, SLOT).write.partitionBy(SHARD).parquet(path))
