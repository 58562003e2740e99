"""Supervised subword embeddings.

A text is a bag of hashed features: its words, whether a word repeats the one before, the n-grams of
its characters (code points), and a feature that all texts share and that steadies short ones. Every
feature has a learned vector; the mean of them goes through a linear layer and a softmax. Vectors and
layer are trained by stochastic gradient descent in numpy on a bounded sample of labelled documents,
in one task. As the layer is linear, the score of a text needs only one learned number for each
feature: the mean of the vectors' products with the layer is the product of the mean.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.llm.frames import arrow_map, column, give_back, list_of, reach
from tableflow.llm.textbytes import SPACED, Slice, slices

BITS = 17
#: At most so many labelled documents are learned from: those with the smallest hash of their id.
SAMPLE = 3000
DIMENSIONS, EPOCHS, RATE = 16, 10, 0.5
THRESHOLD = 0.3
#: Numbers of the shared feature and of those for a word that is (not) the one before; how often
#: the shared feature counts; the most that a feature's step is scaled up.
SHARED, REPEATED, NEW = 0, 1, 2
SHARED_COUNT, MOST = 30, 4.0
#: Lengths of the n-grams.
NGRAMS = (3, 4)
_TURN, _MIX = 0x9E3779B1, (0x85EBCA6B, 0xC2B2AE35)


def _features(part: Slice) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in the slice's bytes, feature numbers), one pair for each kind of feature.

    Only the last character of an n-gram may be a line feed, so none reaches into the next text.
    """
    yield part.starts, (part.hashes >> np.uint64(64 - BITS)).astype(np.int32)
    again = np.zeros(len(part.hashes), dtype=bool)
    again[1:] = part.hashes[1:] == part.hashes[:-1]
    again[part.first[:-1][part.first[:-1] < len(again)]] = False
    yield part.starts, np.where(again, REPEATED, NEW).astype(np.int32)
    at, sizes = characters(part.data)
    values = part.data[at].astype(np.uint32)
    for more in range(1, 4 if len(at) < len(part.data) else 1):
        long = np.flatnonzero(sizes > more)
        values[long] |= part.data[at[long] + more].astype(np.uint32) << np.uint32(8 * more)
    grams, inside = values, np.ones(len(values), dtype=bool)
    for n in range(2, NGRAMS[-1] + 1):
        inside = inside[:-1] & (values[n - 2:-1] != 10)
        grams = grams[:-1] * np.uint32(_TURN) + values[n - 1:]
        if n in NGRAMS:
            mixed = (grams ^ (grams >> np.uint32(15))) * np.uint32(_MIX[n - NGRAMS[0]])
            mixed ^= mixed >> np.uint32(13)
            own = np.flatnonzero(inside)
            yield at[own], ((mixed[own] * np.uint32(_TURN)) >> np.uint32(32 - BITS)).astype(np.int32)


def characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the characters in UTF-8 bytes, and their lengths."""
    at = np.flatnonzero(data & 0xC0 != 0x80)
    return at, np.diff(at, append=len(data))


def bags(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end, features, shares, row bounds) for slices of texts."""
    for part in slices(texts, SPACED, lower=False):
        n = part.high - part.low
        keys = [np.repeat(np.arange(n, dtype=np.int64) << BITS | SHARED, SHARED_COUNT)]
        for at, feature in _features(part):
            row = np.searchsorted(part.bounds, at, side="right") - 1
            keys.append(row.astype(np.int64) << BITS | feature)
        keys, counts = np.unique(np.concatenate(keys), return_counts=True)
        rows = keys >> BITS
        totals = np.bincount(rows, weights=counts, minlength=n)
        yield (part.low, part.high, (keys & ((1 << BITS) - 1)).astype(np.int64),
               counts / totals[rows], np.searchsorted(rows, np.arange(n + 1)))


@dataclass
class Model:
    weights: np.ndarray  # of a feature on the log odds of label 1
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        found = []
        for part in slices(texts, SPACED, lower=False):
            n = part.high - part.low
            total = np.full(n, SHARED_COUNT * float(self.weights[SHARED]))
            count = np.full(n, SHARED_COUNT)
            for at, feature in _features(part):
                sums = np.concatenate([[0.0], np.cumsum(self.weights[feature], dtype=np.float64)])
                bounds = np.searchsorted(at, part.bounds)
                total += np.diff(sums[bounds])
                count += np.diff(bounds)
            odds = self.bias + total / count
            found.append(1 / (1 + np.exp(-np.clip(odds, -30, 30))))
        return np.concatenate(found) if found else np.empty(0)


def train(documents: list[tuple[np.ndarray, np.ndarray]], labels: list[int], seed: int = 11) -> Model:
    """Stochastic gradient descent, one document after the other in a new order each epoch."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, (1 << BITS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    layer = np.zeros((DIMENSIONS, 2), dtype=np.float32)
    bias = np.zeros(2, dtype=np.float32)
    steps, step = max(1, EPOCHS * len(labels)), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(labels)):
            features, shares = documents[i]
            rate = RATE * (1 - step / steps)
            step += 1
            own = vectors[features]
            hidden = shares @ own
            logits = hidden @ layer + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[labels[i]] -= 1
            back = layer @ error
            layer -= rate * np.outer(hidden, error)
            bias -= rate * error
            # a feature steps by its share, scaled by the number of features, within bounds
            vectors[features] = own - rate * np.minimum(len(features) * shares, MOST)[:, None] * back
    if not labels:
        return Model(np.zeros(1 << BITS, dtype=np.float32), 0.0)
    return Model(vectors @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0]))


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The model of all bags, in the order of ids, so that it is the same however the rows arrive."""
    held = [(row, batch, at) for batch in batches for at, row in enumerate(column(batch, "doc_id").to_pylist())]
    held.sort(key=lambda x: x[0])
    bags_of = [tuple(column(batch, name)[at].values.to_numpy() for name in ("features", "shares")) for _, batch, at in held]
    model = train(bags_of, [column(batch, "label")[at].as_py() for _, batch, at in held])
    yield pa.RecordBatch.from_arrays([pa.array([model.weights.astype("<f4").tobytes()], pa.binary()), pa.array([model.bias])],
                                     names=["weights", "bias"])
    held = bags_of = model = None
    give_back()


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Model:
    """Learn from documents with a label of 0 or 1 whose id is not held out.

    The sample is bounded by ``sample`` documents; their whole texts are used. Of several labels of
    an id the smallest counts, of several texts of an id the one with the smallest hash, so the model
    depends on the rows alone and not on their order. Rows with a null id or label are left out; a null
    text is the empty one. Without labels the model gives 0.5 to all.
    """
    ids = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("label"))
           .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (remainder(F.col("doc_id"), 5) != 0))
           .groupBy("doc_id").agg(F.min("label").cast("bigint").alias("label"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), body.alias("text"))
             .join(F.broadcast(ids), "doc_id")  # at most ``sample`` ids
             .groupBy("doc_id").agg(F.min("label").alias("label"), F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")))

    def count(batch: pa.RecordBatch):
        for low, high, features, shares, bounds in bags(column(batch, "text")):
            yield {"doc_id": column(batch, "doc_id").slice(low, high - low),
                   "label": column(batch, "label").slice(low, high - low),
                   "features": list_of(features.astype(np.int32), bounds),
                   "shares": list_of(shares.astype(np.float32), bounds)}

    counted = arrow_map(texts, "doc_id bigint, label bigint, features array<int>, shares array<float>", count)
    row = reach(counted).repartition(1).mapInArrow(learn, "weights binary, bias double").first()  # the bounded sample
    return Model(np.frombuffer(bytes(row.weights), dtype="<f4"), row.bias)


def scorer(docs: DataFrame, model: Model):
    """A column function that scores texts; null and empty ones have the shared feature only."""
    shared = reach(docs).sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        scores = pa.array(shared.value.scores(texts))
        give_back()  # a batch is the only end that a column function sees
        return scores

    return score


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with ``score`` and ``predicted``; every row is scored alone, repeated rows
    alike."""
    clash = {"score", "predicted"} & set(docs.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are taken")
    scored = docs.withColumn("score", scorer(docs, model)(F.col("text").cast("string")))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def of_quality(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that the model does not reject, with their columns."""
    scored = docs.withColumn("__score", scorer(docs, model)(F.col("text").cast("string")))
    return scored.where(F.col("__score") >= THRESHOLD).drop("__score")
