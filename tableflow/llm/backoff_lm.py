"""Language-model scores by a weighted backoff automaton.

The model is a trigram model with absolute discounting over the counts of the training part; pairs and
triples that stand there ``LEAST`` times or more are kept, however large the corpus is. An n-gram that
others follow is a state. From a state, a token that follows it has an arc; any other token goes along
the failure arc, which costs the state's backoff weight, to the state of the context that is one token
shorter, at last to the root. There every token has its smoothed count.

Counts and weights stay in one table that grows with the corpus. Each group of texts asks for the
entries of its own words, pairs and triples; questions and entries meet in blocks of the range of keys,
and the answers come in the order of the questions, without the keys. A task then builds the part of the
automaton that the texts of a group can reach, and walks it once from left to right.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.frames import ROW, arrow_map, column, give_back, is_member, membership, numbered, reach
from tableflow.llm.textbytes import hash_bytes, mix, slices, unmix
from tableflow.session import materialise, release

#: Pairs and triples that stand less often in the training part are no n-grams of the model.
LEAST = 2
DISCOUNT = 0.6
SMOOTHING = 0.1
#: Bits of a row's number in its group: texts that stand next to each other share their entries.
GROUP_BITS = 12
#: About so many tokens, or keys asked for, are held by a task at a time.
CHUNK = 1 << 20
#: Training tokens, and blocks of a group of texts, by which the number of blocks of keys grows.
BLOCK_BITS, GROUP_BLOCKS = 19, 4
_WIDTH = 24  # bits of a word's number in a slice of texts
#: A word that no text has, since it holds a space: the end of a text.
END = np.uint64(hash_bytes(b" end"))
#: The context of the first token of a text, and the pair before it.
START, OPEN = np.uint64(hash_bytes(b" start")), np.uint64(hash_bytes(b" open"))
_STEPS = 64
_FACTOR = np.uint64(0xD1342543DE82EF95)


def _tokens(part) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a slice with an end after each text, and each text's first token."""
    n = part.high - part.low
    ends = part.first[1:] + np.arange(n)
    tokens = np.empty(len(part.hashes) + n, dtype=np.uint64)
    inner = np.ones(len(tokens), dtype=bool)
    inner[ends] = False
    tokens[inner], tokens[ends] = part.hashes, END
    return tokens, part.first + np.arange(n + 1)


@dataclass
class Totals:
    """Of the training part."""

    tokens: int
    kinds: int     # distinct tokens
    texts: int


def log_share(count, tokens: int, kinds: int):
    """log10 of the smoothed share of a token with so many occurrences."""
    return np.log10((count + SMOOTHING) / (tokens + SMOOTHING * (kinds + 1)))


def _lookup(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place in sorted keys, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1)
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[place] == wanted, place, -1)


def _context(numbers: np.ndarray, first: np.ndarray, start) -> np.ndarray:
    """What stands before each token; the start before the first of a text."""
    before = np.empty_like(numbers)
    before[1:] = numbers[:-1]
    before[first[:-1]] = start
    return before


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * _FACTOR + right)


def _right(key: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The right part of a key, which was joined from this left one."""
    return unmix(key) - left * _FACTOR


def _words(tokens: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    return (tokens,)


def _pairs(tokens: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """The pair that each token ends, and its two parts."""
    before = _context(tokens, first, START)
    return _joined(before, tokens), before, tokens


def _triples(tokens: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """The triple that each token ends, its first pair and its last pair; the first token of a text
    ends none, as the start has its arc."""
    pairs = _pairs(tokens, first)[0]
    outer = _context(pairs, first, OPEN)
    inside = outer != OPEN
    return _joined(outer[inside], pairs[inside]), outer[inside], pairs[inside]


def _chunks(batch: pa.RecordBatch, find) -> Iterator[list[np.ndarray]]:
    """What ``find`` gives for the tokens of a batch, about ``CHUNK`` of them at a time, for memory."""
    found, size = [], 0
    for part in slices(column(batch, "text")):
        tokens, first = _tokens(part)
        found.append(find(tokens, first))
        size += len(tokens)
        if size >= CHUNK:
            yield [np.concatenate(x) for x in zip(*found)]
            found, size = [], 0
    if found:
        yield [np.concatenate(x) for x in zip(*found)]


def _count(training: DataFrame, keys, least: int = 1, bits: int = 1) -> DataFrame:
    """Occurrences of the keys that ``keys`` finds in tokens, if there are ``least``; keys with parts come with them."""
    if keys is not _words:
        return _named(_in_blocks(training, keys, bits), least)

    def count(batch: pa.RecordBatch):
        for tokens, in _chunks(batch, keys):
            key, n = np.unique(tokens, return_counts=True)
            yield {"key": key, "n": n}

    rows = arrow_map(training, "key bigint, n bigint", count)
    return rows.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _count_triples(training: DataFrame, pairs, bits: int = 1) -> DataFrame:
    """Counts in blocks of the triples whose two pairs the filter ``pairs`` knows. A triple stands no more often
    than its pairs, so if these are all pairs that stand ``LEAST`` times, none of the triples that do is passed over."""
    def find(tokens: np.ndarray, first: np.ndarray):
        key, left, right = _triples(tokens, first)
        at = np.flatnonzero(is_member(pairs.value, left))
        at = at[is_member(pairs.value, right[at])]
        return key[at], left[at]

    return _in_blocks(training, find, bits)


def _in_blocks(training: DataFrame, find, bits: int) -> DataFrame:
    """(block, keys, left, n): distinct keys that ``find`` gives, their left parts and how often they stand, chunk by
    chunk of tokens. The right part follows from the others, so it is not shuffled."""
    def count(batch: pa.RecordBatch):
        for keys, left, *_ in _chunks(batch, find):
            order = np.argsort(keys)
            keys = keys[order]
            starts = _starts(keys)
            yield _by_block(keys[starts], bits, left=left[order[starts]], n=np.diff(starts, append=len(keys)))

    return arrow_map(training, "block bigint, keys binary, left binary, n binary", count)


def _named(counts: DataFrame, least: int = 1) -> DataFrame:
    """(key, left, right, n) of counts in blocks, summed up, if there are ``least``."""
    def add(block: pa.Table) -> pa.Table:
        keys = _keys_of(block["keys"])
        order = np.argsort(keys, kind="stable")  # sorted runs follow each other
        keys = keys[order]
        starts = _starts(keys)
        n = np.add.reduceat(_numbers_of(block["n"], np.int64)[order], starts)
        starts, n = starts[n >= least], n[n >= least]
        key, left = keys[starts], _numbers_of(block["left"], np.uint64)[order[starts]]
        return pa.table({"key": key.view(np.int64), "left": left.view(np.int64), "right": _right(key, left).view(np.int64), "n": n})

    return reach(counts).groupBy("block").applyInArrow(add, "key bigint, left bigint, right bigint, n bigint")


def _starts(keys: np.ndarray) -> np.ndarray:
    """Where the distinct ones of sorted keys begin."""
    return np.flatnonzero(np.concatenate([np.ones(min(len(keys), 1), dtype=bool), keys[1:] != keys[:-1]]))


def _by_block(keys: np.ndarray, bits: int, **more: np.ndarray) -> dict:
    """Columns block, keys and ``more``: sorted keys and what goes with them as planes, by block of the range of keys;
    a block is named by the first ``bits`` of its keys."""
    blocks = (keys >> np.uint64(64 - bits)).astype(np.int64)
    starts = np.flatnonzero(np.diff(blocks, prepend=-1))
    bounds = list(zip(starts, np.append(starts[1:], len(keys))))
    return {"block": blocks[starts], "keys": [_planes(np.diff(keys[a:b], prepend=np.uint64(0))) for a, b in bounds],
            **{name: [_planes(values[a:b]) for a, b in bounds] for name, values in more.items()}}


def _keys(planes: bytes) -> np.ndarray:
    return np.cumsum(_from_planes(planes, np.uint64), dtype=np.uint64)


def _keys_of(rows: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([np.empty(0, dtype=np.uint64), *(_keys(x.as_py()) for x in rows)])


def _numbers_of(rows: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.concatenate([np.empty(0, dtype=kind), *(_from_planes(x.as_py(), kind) for x in rows)])


@dataclass
class Automaton:
    """State 0 is the root, then come the words and the start, then the pairs."""

    start: int            # number of the start, which follows the words
    arcs: np.ndarray      # state << 24 | word, sorted
    costs: np.ndarray     # log10 probability of each arc
    targets: np.ndarray
    backoff: np.ndarray   # log10 weight of each state's failure arc
    failure: np.ndarray
    root: np.ndarray      # log10 probability of each word at the root

    def traverse(self, numbers: np.ndarray, first: np.ndarray) -> np.ndarray:
        """What each token of a stream of texts adds.

        The stream is cut into lanes that are walked side by side, from left to right. A lane
        begins two tokens early, from the root: no state holds more than two tokens, so it is in
        the right one when its own tokens come.
        """
        n = len(numbers)
        gained = np.zeros(n)
        opens = np.zeros(n, dtype=bool)
        opens[first[:-1]] = True
        lanes = np.arange(0, n, _STEPS)
        state = np.zeros(len(lanes), dtype=np.int64)
        for step in range(-2, _STEPS):
            at = lanes + step
            live = np.flatnonzero((at >= 0) & (at < n))
            at = at[live]
            now = np.where(opens[at], 1 + self.start, state[live])
            word = numbers[at]
            cost = np.zeros(len(at))
            target = np.zeros(len(at), dtype=np.int64)
            open_ = np.arange(len(at))
            while len(open_):
                s, w = now[open_], word[open_]
                place = _lookup(self.arcs, s << _WIDTH | w)
                hit = place >= 0
                cost[open_[hit]] += self.costs[place[hit]]
                target[open_[hit]] = self.targets[place[hit]]
                root = open_[~hit & (s == 0)]
                cost[root] += self.root[word[root]]
                target[root] = 1 + word[root]
                open_ = open_[~hit & (s != 0)]
                cost[open_] += self.backoff[now[open_]]
                now[open_] = self.failure[now[open_]]
            state[live] = target
            if step >= 0:
                gained[at] = cost
        return gained


@dataclass
class Entries:
    """Counts and backoff weights of words, pairs and triples by key, as found for some texts."""

    keys: np.ndarray      # sorted, once each
    counts: np.ndarray
    weights: np.ndarray   # 1 where nothing follows

    @staticmethod
    def of(keys: np.ndarray, counts: np.ndarray, weights: np.ndarray) -> Entries:
        keys, at = np.unique(keys, return_index=True)
        return Entries(keys, counts[at], weights[at])

    @cached_property
    def _starts(self) -> tuple[np.ndarray, np.ndarray, np.uint64]:
        """Keys are hashes, so their first bits tell nearly where they are: the places where those begin, the keys
        with one more behind them, and how many bits are left out."""
        shift = np.uint64(65 - max(len(self.keys).bit_length(), 2))
        many = np.bincount((self.keys >> shift).astype(np.int64), minlength=1 << 64 - int(shift))
        return np.cumsum(many) - many, np.append(self.keys, np.uint64(2**64 - 1)), shift

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, weight), 0 and 1 for a key without entry."""
        if not len(self.keys):
            return np.zeros(len(keys), dtype=np.int64), np.ones(len(keys))
        starts, own, shift = self._starts
        place = starts[(keys >> shift).astype(np.int64)]
        behind = np.flatnonzero(own[place] < keys)
        while len(behind):
            place[behind] += 1
            behind = behind[own[place[behind]] < keys[behind]]
        there = own[place] == keys
        there &= place < len(self.keys)
        place = np.minimum(place, len(self.keys) - 1)
        return np.where(there, self.counts[place], 0), np.where(there, self.weights[place], 1.0)


def local_automaton(tokens: np.ndarray, first: np.ndarray, entries: Entries, totals: Totals):
    """(automaton, number of each token, count of each token): what a stream of texts can reach."""
    names, numbers = np.unique(tokens, return_inverse=True)
    counts, weight1 = entries.find(np.append(names, START))
    start, n = len(names), len(names) + 1
    whole = np.append(counts[:-1], totals.texts)
    before = _context(numbers, first, start)
    key, _, _ = _pairs(tokens, first)
    codes, at, place = np.unique(before << _WIDTH | numbers, return_index=True, return_inverse=True)
    pair_counts, weight2 = entries.find(key[at])
    kept = pair_counts > 0
    place = (np.cumsum(kept) - 1)[place]  # of the pair that each token ends, if it is kept
    codes, pair_counts, weight2 = codes[kept], pair_counts[kept], weight2[kept]
    p2 = (pair_counts - DISCOUNT) / whole[codes >> _WIDTH]
    triple, _, _ = _triples(tokens, first)
    ends = np.setdiff1d(np.arange(len(tokens)), first[:-1], assume_unique=True)  # tokens that end a triple
    triple, at = np.unique(triple, return_index=True)
    triple_counts, _ = entries.find(triple)
    at, triple_counts = ends[at[triple_counts > 0]], triple_counts[triple_counts > 0]
    outer, inner = place[at - 1], place[at]  # both are kept, as they stand as often as the triple
    p3 = (triple_counts - DISCOUNT) / pair_counts[outer]
    arcs = np.concatenate([1 + (codes >> _WIDTH) << _WIDTH | (codes & ((1 << _WIDTH) - 1)), 1 + n + outer << _WIDTH | numbers[at]])
    order = np.argsort(arcs)
    return Automaton(
        start, arcs[order], np.log10(np.concatenate([p2, p3]))[order],
        np.concatenate([1 + n + np.arange(len(codes)), 1 + n + inner])[order],
        np.log10(np.concatenate([[1.0], weight1, weight2])),
        np.concatenate([np.zeros(1 + n, dtype=np.int64), 1 + (codes & ((1 << _WIDTH) - 1))]),
        log_share(counts[:-1], totals.tokens, totals.kinds)), numbers, counts[numbers]


def model_entries(_training, vocabulary: DataFrame, pairs: DataFrame, triples: DataFrame, totals: Totals, _kept=None,
                  finish=lambda rows: rows, done=lambda *frames: None) -> DataFrame:
    """(key, n, weight) of all words, the start, and the n-grams that are kept, which come with their parts: the
    training part is not read again. ``finish`` changes the rows before they are written; ``done`` is told what nothing
    here will read again."""
    end, start = (F.lit(int(x.view(np.int64))) for x in (END, START))
    # a text has one end and one start, and no word follows the end
    often = vocabulary.where(F.col("n") >= LEAST)  # a word of a pair that is kept stands as often as the pair
    whole = often.select(F.when(F.col("key") == end, start).otherwise(F.col("key")).alias("left"), F.col("n").alias("whole"))
    share = (F.col("n") + SMOOTHING) / (totals.tokens + SMOOTHING * (totals.kinds + 1))
    words = often.select(F.col("key").alias("right"), share.alias("lower"))
    arcs = materialise(pairs.join(whole, "left").join(words, "right")
                       .select("key", "left", "n", "lower", ((F.col("n") - DISCOUNT) / F.col("whole")).alias("p2")))
    done(pairs)
    inner = arcs.select(F.col("key").alias("right"), F.col("p2").alias("lower"))
    contexts = vocabulary.select("key", "n").unionByName(vocabulary.where(F.col("key") == end).select(start.alias("key"), "n"))
    entries = materialise(finish(
        _with_weight(contexts, arcs)
        .unionByName(_with_weight(arcs, triples.select("left", "right", "n").join(inner, "right")))
        .unionByName(triples.select("key", "n", F.lit(None).cast("double").alias("weight")))), codec="zstd")
    release(arcs)
    done(vocabulary, triples)
    return entries


def _with_weight(contexts: DataFrame, arcs: DataFrame) -> DataFrame:
    """(key, n, weight) of contexts: what is left for words without an arc, over what the shorter context gives them,
    from exact sums of the counts; null where nothing follows."""
    followed = arcs.groupBy(F.col("left").alias("key")).agg(
        F.sum("n").alias("taken"), F.count("*").alias("arcs"), F.sum("lower").alias("lower"))
    left = (F.col("n") - F.col("taken") + DISCOUNT * F.col("arcs")) / F.col("n")
    weight = F.greatest(left, F.lit(1e-12)) / F.greatest(1 - F.col("lower"), F.lit(1e-12))
    return (contexts.select("key", "n").join(followed, "key", "left")
            .select("key", "n", F.when(F.col("arcs").isNotNull(), weight).alias("weight")))


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers of 64 bits, their first bytes first, then the second ones: most places hold few values, so
    they compress well. Of weights, which are floats, only those that are not 1, and a bit for each that tells which."""
    if numbers.dtype == np.float64:
        odd = numbers != 1
        return np.int64(len(odd)).tobytes() + np.packbits(odd).tobytes() + _planes(numbers[odd].view(np.uint64))
    return numbers.view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(planes: bytes, kind: type) -> np.ndarray:
    if kind is np.float64:
        n = int(np.frombuffer(planes, dtype=np.int64, count=1)[0])
        rest = 8 + (n + 7) // 8
        numbers = np.ones(n)
        odd = np.unpackbits(np.frombuffer(planes[8:rest], dtype=np.uint8), count=n).view(bool)
        numbers[odd] = _from_planes(planes[rest:], np.uint64).view(np.float64)
        return numbers
    return np.ascontiguousarray(np.frombuffer(planes, dtype=np.uint8).reshape(8, -1).T).view(kind).ravel()


def _distinct(found: list[np.ndarray]) -> np.ndarray:
    keys = np.sort(np.concatenate(found))
    return keys[_starts(keys)]


def _group_keys(streams: Iterable[tuple[np.ndarray, np.ndarray]], kept) -> np.ndarray:
    """Sorted keys of all words of some texts and of the start, and of the pairs and triples that may be kept;
    the order and the cut of the texts change nothing."""
    found, size = [np.array([START])], 0
    for tokens, first in streams:
        grams = np.concatenate([_pairs(tokens, first)[0], _triples(tokens, first)[0]])
        found += [tokens, grams[is_member(kept.value, grams)]]
        size += len(tokens)
        if size >= CHUNK:
            found, size = [_distinct(found)], 0
    return _distinct(found)


def _asked(source: DataFrame, kept, bits: int) -> DataFrame:
    """(group, block, keys): what each group of texts asks for, by block of the range of keys."""
    def ask(texts: pa.Table, group: int) -> pa.RecordBatch:
        keys = _group_keys((_tokens(part) for part in slices(texts["text"])), kept)
        rows = _by_block(keys, bits)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(rows["keys"]), group)), pa.array(rows["block"]), pa.array(rows["keys"], pa.binary())],
                                          names=["group", "block", "keys"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts of a group follow each other; the last group of a batch may go on in the next."""
        held = None
        for batch in batches:
            held = pa.concat_tables([*([held] if held is not None else []), pa.Table.from_batches([batch])])
            groups = held["group"].to_numpy()
            starts = np.flatnonzero(np.diff(groups, prepend=-1)).tolist()
            for low, high in zip(starts, starts[1:]):
                yield ask(held.slice(low, high - low), groups[low])
            held = held.slice(starts[-1]) if starts else None
        if held is not None:
            yield ask(held, held["group"][0].as_py())
        held = None
        give_back()

    return reach(source.select("group", "text")).mapInArrow(run, "group bigint, block bigint, keys binary")


def _packed(entries: DataFrame, bits: int) -> DataFrame:
    """(block, keys, n, weight): rows of entries by block of the range of keys, about ``CHUNK`` of a task at a time."""
    def pack(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        keys = rows["key"].to_numpy().view(np.uint64)
        order = np.argsort(keys)
        found = _by_block(keys[order], bits, n=rows["n"].to_numpy()[order], weight=np.nan_to_num(rows["weight"].to_numpy(), nan=1.0)[order])
        return pa.RecordBatch.from_arrays([pa.array(found["block"]), *(pa.array(found[x], pa.binary()) for x in ("keys", "n", "weight"))],
                                          names=["block", "keys", "n", "weight"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= CHUNK:
                yield pack(held)
                held, size = [], 0
        if size:
            yield pack(held)
        held = []
        give_back()

    return reach(entries).mapInArrow(run, "block bigint, keys binary, n binary, weight binary")


def _answers(asked: DataFrame, entries: DataFrame, bits: int) -> DataFrame:
    """(group, block, n, weight): counts and weights of the keys of a question, in their order; 0 and 1 for a key
    without entry. Entries come as rows, or packed by the same ``bits``."""
    def find(asked: pa.Table, entries: pa.Table) -> pa.Table:
        rest = np.uint64(bits)  # the bits that all keys of a block have would tell nothing of their places
        own = Entries.of(_keys_of(entries["keys"]) << rest, _numbers_of(entries["n"], np.int64), _numbers_of(entries["weight"], np.float64))
        counts, weights = [], []
        for keys in asked["keys"]:
            n, weight = own.find(_keys(keys.as_py()) << rest)
            counts.append(_planes(n))
            weights.append(_planes(weight))
        return pa.table({"group": asked["group"], "block": asked["block"], "n": pa.array(counts, pa.binary()),
                         "weight": pa.array(weights, pa.binary())})

    blocks = entries if "block" in entries.columns else _packed(entries, bits)
    return reach(asked).groupBy("block").cogroup(blocks.groupBy("block")).applyInArrow(
        find, "group bigint, block bigint, n binary, weight binary")


def score_documents(docs: DataFrame, held_out, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of all texts by a model of those that are not ``held_out`` (a column that is not null).

    A null or empty text is one end. Repeated rows count and are scored each. Without training rows
    every token has probability 1. Other columns are not used, whatever their names.
    """
    source = numbered(docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out.alias("held_out"),
                                  F.col(text).cast("string").alias("text")))
    source = source.withColumn("group", F.shiftright(ROW, GROUP_BITS))
    training = source.where(~F.col("held_out")).select("text")
    vocabulary = materialise(_count(training, _words))
    texts = F.sum(F.when(F.col("key") == int(END.view(np.int64)), F.col("n")))
    totals = Totals(*vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(texts, F.lit(0))).first())
    # a block gets few keys from each group, however often the corpus says the same
    bits = max(totals.tokens >> BLOCK_BITS, (source.count() >> GROUP_BITS) * GROUP_BLOCKS, 1).bit_length()
    pairs = materialise(_count(training, _pairs, LEAST, bits))
    send = docs.sparkSession.sparkContext.broadcast
    frequent = send(membership(pairs, "key"))
    triples = materialise(_named(_count_triples(training, frequent, bits), LEAST))
    frequent.destroy()
    kept = send(membership(pairs.select("key").unionByName(triples.select("key")), "key"))
    entries = model_entries(training, vocabulary, pairs, triples, totals, finish=lambda rows: _packed(rows, bits), done=release)
    found = materialise(_answers(_asked(source, kept, bits), entries, bits), codec="zstd")
    release(entries)

    def score(texts: pa.Table, found: pa.Table) -> pa.Table:
        streams = [_tokens(part) for part in slices(texts["text"])]
        found = found.sort_by("block")
        answers = (np.concatenate([_from_planes(x.as_py(), kind) for x in found[name]]) for name, kind in (("n", np.int64), ("weight", np.float64)))
        own = Entries(_group_keys(streams, kept), *answers)
        names = ("n_tokens", "n_known", "base_score", "score")
        columns: dict[str, list] = {name: [] for name in names}
        for tokens, first in streams:
            model, numbers, known = local_automaton(tokens, first, own, totals)
            figures = (np.diff(first), np.add.reduceat((known > 0).astype(np.int64), first[:-1]),
                       np.add.reduceat(model.root[numbers], first[:-1]), np.add.reduceat(model.traverse(numbers, first), first[:-1]))
            for name, values in zip(names, figures):
                columns[name].append(values)
        table = pa.table({"doc_id": texts["doc_id"], "held_out": texts["held_out"],
                          **{name: np.concatenate(columns[name]) for name in names}})
        give_back()
        return table

    scored = (reach(source).groupBy("group").cogroup(found.groupBy("group"))
              .applyInArrow(score, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(totals.tokens).cast("long").alias("train_tokens"),
                         "base_score", "score")
