"""Each operator on odd rows, on an empty table, and on small fixtures against plain Python."""

import math
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import (ODD, SCHEMA, brute_components, brute_tiles, empty_documents, odd_documents, stored,
                     words)
from tableflow.llm import (backoff_lm, decontamination, frames, license_scan, line_dedup, ngram_join, packing,
                           quality_classifier, quality_rules, sharding, url_filter)
from tableflow.llm.components import connected_components

TOKENIZER = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


@pytest.fixture
def odd(spark, folder):
    return stored(spark, odd_documents(spark), folder)


@pytest.fixture
def none(spark, folder):
    return stored(spark, empty_documents(spark), folder, "none")


# 1 sharding

def test_fisher_yates_is_a_seeded_permutation():
    assert sorted(sharding.fisher_yates(50, 3)) == list(range(50))
    assert sharding.fisher_yates(50, 3).tolist() == sharding.fisher_yates(50, 3).tolist()
    assert sharding.fisher_yates(50, 3).tolist() != sharding.fisher_yates(50, 4).tolist()
    assert sharding.fisher_yates(0, 1).tolist() == [] and sharding.fisher_yates(1, 1).tolist() == [0]


@pytest.mark.parametrize("shards", [1, 4, 40])
def test_shards_hold_every_row_once(spark, odd, shards):
    rows = sharding.assign_shards(sharding.shuffle_rows(odd, bucket_bytes=200_000), shards).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter(ODD)
    slots = defaultdict(list)
    for r in rows:
        slots[r[sharding.SHARD]].append(r[sharding.SLOT])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    sizes = [len(slots.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(slots) <= set(range(shards))


def test_equal_rows_are_scattered(spark, folder):
    """A third of the rows are one row: no bucket holds much more than its share."""
    rows = [(1, "same text " * 20)] * 400 + [(i, f"text {i} " * 20) for i in range(800)]
    docs = stored(spark, spark.createDataFrame(rows, SCHEMA), folder)
    shuffled = sharding.shuffle_rows(docs, bucket_bytes=20_000).collect()
    sizes = Counter(r[sharding.BUCKET] for r in shuffled)
    assert Counter((r.doc_id, r.text) for r in shuffled) == Counter(rows)
    assert len(sizes) > 5 and max(sizes.values()) < 2 * len(rows) / len(sizes)
    assert len({r[sharding.BUCKET] for r in shuffled if r.doc_id == 1}) == len(sizes)


def test_query_columns_of_shards(spark):
    from tableflow.llm.queries import QUERIES
    found = QUERIES["op1_sharding"](spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in found:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)
    places = sorted((r.shard, r.slot) for r in found)
    sizes = Counter(shard for shard, _ in places)
    assert places == [(s, i) for s in range(40) for i in range(sizes[s])] and max(sizes.values()) - min(sizes.values()) <= 1


def test_write_shards_round_trip(spark, odd, folder):
    sharding.write_shards(sharding.assign_shards(sharding.shuffle_rows(odd), 3), f"{folder}/out")
    back = spark.read.parquet(f"{folder}/out")
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter(ODD)
    assert back.columns == [*odd.columns, sharding.SHARD]


def test_sharding_of_nothing(none):
    assert sharding.assign_shards(sharding.shuffle_rows(none), 4).count() == 0


# 2 language model

def plain_scores(rows):
    """The model without automaton: probabilities from dictionaries, by recursion."""
    low = [(i, words(t) + ["</s>"]) for i, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in rows]
    train = [w for (_, w), h in zip(low, held) if not h]
    uni = Counter(w for t in train for w in t)
    total, kinds = sum(uni.values()), len(uni)
    two = Counter((a, b) for t in train for a, b in zip(["<s>", *t], t))
    two = {x: c for x, c in two.items() if c >= 2}
    three = Counter((a, b, c) for t in train for a, b, c in zip(["<s>", *t], t, t[1:]))
    three = {x: c for x, c in three.items() if c >= 2}
    before = {**uni, "<s>": len(train)}
    d = backoff_lm.DISCOUNT

    def p1(w):
        return (uni[w] + 0.1) / (total + 0.1 * (kinds + 1))

    after = defaultdict(list)
    for *h, w in [*two, *three]:
        after[tuple(h)].append(w)

    def p(h, w):
        if not h:
            return p1(w)
        counts, whole = (two, before[h[0]]) if len(h) == 1 else (three, two.get(h))
        if (*h, w) in counts:
            return (counts[(*h, w)] - d) / whole
        if h not in after:
            return p(h[1:], w)
        left = 1 - sum((counts[(*h, x)] - d) / whole for x in after[h])
        below = 1 - sum(p(h[1:], x) for x in after[h])
        return left / below * p(h[1:], w)

    for (i, t), h in zip(low, held):
        score, state = 0.0, ("<s>",)
        for w in t:
            score += math.log10(p(state, w))
            state = (*state, w)[-2:]
            if state not in two:
                state = (w,) if w in uni else ()
        yield i, h, len(t), sum(uni[w] > 0 for w in t), total, sum(math.log10(p1(w)) for w in t), score


@pytest.mark.parametrize("bits", [0, 3, 10])
def test_scores_equal_those_of_plain_backoff(spark, folder, monkeypatch, bits):
    """Whatever texts share a group; a text of one word, and a word in most places (a hot pair and triple)."""
    monkeypatch.setattr(backoff_lm, "GROUP_BITS", bits)
    monkeypatch.setattr(backoff_lm, "_STEPS", 7)
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(rng.choice(list("abcdefgh"), rng.integers(0, 30), p=[.4, .2, .1, .1, .05, .05, .05, .05])) + (f" Rare{i}" if i % 3 == 0 else ""))
            for i in range(40)] + ODD + [(77, "a b c " * 50), (78, "a " * 500), (79, "a a a")]
    docs = stored(spark, spark.createDataFrame(rows, SCHEMA), folder)
    held = quality_classifier.remainder(F.col("doc_id"), 10) == 0
    found = backoff_lm.score_documents(docs, held).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[6], 5))
    for ours, plain in zip(sorted(map(tuple, found), key=key), sorted(plain_scores(rows), key=key), strict=True):
        assert ours[:5] == plain[:5]
        assert ours[5:] == pytest.approx(plain[5:], abs=1e-6)


def test_rare_ngrams_are_kept_in_a_large_corpus(spark, folder):
    """2^21 training tokens, in which a pair and a triple that stand once or twice have to count."""
    rows = [(i, "a " * ((1 << 18) - 1)) for i in range(1, 10)] + [(20, "x y z"), (22, "x y z"), (30, "x y z"), (31, "z y x")]
    docs = stored(spark, spark.createDataFrame(rows, SCHEMA), folder)
    found = {r.doc_id: r for r in backoff_lm.score_documents(docs, F.col("doc_id") >= 30).collect()}
    d = backoff_lm.DISCOUNT
    # x after 11 starts, then y, z and the end stand twice after their contexts
    assert found[30].score == pytest.approx(math.log10((2 - d) / 11) + 3 * math.log10((2 - d) / 2), abs=1e-6)
    assert found[31].score < found[30].score


def test_arcs_and_backoff_sum_to_one(spark, folder):
    """At every state of the automaton of a whole corpus, over all words of it and the unknown one."""
    texts = ["a b c a b", "a b b a", "c a b c", "b a b c a b", "c c a"] * 2
    training = stored(spark, spark.createDataFrame([(t,) for t in texts], "text string"), folder)
    vocabulary = backoff_lm._count(training, backoff_lm._words)
    pairs, triples = (backoff_lm._count(training, keys).where("n >= 2") for keys in (backoff_lm._pairs, backoff_lm._triples))
    totals = backoff_lm.Totals(sum(len(t.split()) + 1 for t in texts), 4, len(texts))
    kept = spark.sparkContext.broadcast(frames.membership(pairs.union(triples).select("key"), "key"))
    rows = backoff_lm.model_entries(training, vocabulary, pairs, triples, totals, kept).collect()
    entries = backoff_lm.Entries.of(np.array([r.key for r in rows]).view(np.uint64), np.array([r.n for r in rows]),
                                    np.array([1.0 if r.weight is None else r.weight for r in rows]))
    part = next(backoff_lm.slices(__import__("pyarrow").array(texts)))
    model, _, _ = backoff_lm.local_automaton(*backoff_lm._tokens(part), entries, totals)
    unknown = 0.1 / (totals.tokens + 0.1 * 5)

    def cost(word, state):
        place = backoff_lm._lookup(model.arcs, np.array([state << backoff_lm._WIDTH | word]))[0]
        if place >= 0:
            return 10 ** model.costs[place]
        return 10 ** model.root[word] if state == 0 else 10 ** model.backoff[state] * cost(word, model.failure[state])

    for state in range(len(model.backoff)):
        rest, s = unknown, state
        while s:
            rest, s = rest * 10 ** model.backoff[s], model.failure[s]
        assert sum(cost(w, state) for w in range(4)) + rest == pytest.approx(1)


def test_language_model_of_nothing(spark, none, folder):
    assert backoff_lm.score_documents(none, F.lit(False)).count() == 0
    docs = stored(spark, spark.createDataFrame([(1, "a b")], SCHEMA), folder)
    row = backoff_lm.score_documents(docs, F.lit(True)).first()
    assert (row.n_known, row.train_tokens, row.base_score, row.score) == (0, 0, 0.0, 0.0)


# 3 url filter

def test_most_specific_rule_decides():
    trie = url_filter.UrlTrie([("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
                               ("net/es/", "block"), ("a.net/es/x", "allow"), ("com/en/deep/er/", "block"), ("b.org", "block"),
                               ("b.org", "allow"), ("/any/", "block")])
    def find(url):
        return trie.find(*url_filter.split_url(url))[0]
    assert find("http://EXAMPLE.com/en/1") == "example.com/en/"
    assert find("http://x.www.example.com/en/") == "www.example.com/en/"
    assert find("http://example.com/en") == "com/"
    assert find("http://example.com") is None and find("http://com/") == "com/"
    assert find("http://notexample.com/fr/?q=://") == "com/"
    assert find("https://s.a.net/es/xyz#f") == "a.net/es/x" and find("https://s.a.net/es/y") == "net/es/"
    assert find("ftp://b.org") == "b.org" and trie.find("b.org", "")[1] == "block"
    assert find("http://q.example.com/en/deep/er/1") == "example.com/en/"
    assert find("http://x.io/any/1") == "/any/"
    assert find(None) is None and find("") is None and find("com/en/") is None


def test_urls_of_odd_rows(spark):
    pages = spark.createDataFrame([(1, None, "a"), (None, "http://a.com/", "b"), (None, "http://a.com/", "b"), (2, "", "c")],
                                  "page_id long, url string, host string")
    rows = url_filter.judge_urls(pages, [("com/", "block")], keep=("page_id",)).collect()
    assert Counter(map(tuple, rows)) == Counter([(1, "", "", None, "allow"), (2, "", "", None, "allow")]
                                                + 2 * [(None, "a.com", "/", "com/", "block")])
    assert url_filter.judge_urls(pages.limit(0), [], keep=("page_id",)).count() == 0
    with pytest.raises(ValueError):
        url_filter.judge_urls(pages, [], keep=("host",))


# 4 lines

def test_lines_of_odd_rows(spark, odd, none):
    rows = line_dedup.dedup_lines(odd).collect()
    assert len(rows) == len(ODD) and line_dedup.dedup_lines(none).count() == 0
    kept = sorted(r.text for r in rows if r.judged_lines and r.text and r.text.lower().startswith("one"))
    assert len(kept) == 2 and kept[1] == "one"  # a short line that is like no other stays
    assert [r.text for r in rows if r.doc_id == 3] == [None] and [r.text for r in rows if r.doc_id == 5] == [" \n\t"]
    assert line_dedup.dedup_lines(odd).columns == [*odd.columns, "judged_lines", "dropped_lines"]
    left = line_dedup.without_repetitions(odd).collect()
    assert len(left) == len(ODD) - 3


def test_lines_are_judged_by_their_words():
    part = next(line_dedup.slices(__import__("pyarrow").array(["A  b c d e\nx\n\na b c d\te", None, "a b c d e"])))
    lines = line_dedup.judged_lines(part)
    assert lines.row.tolist() == [0, 0, 2] and lines.number.tolist() == [0, 3, 0]
    assert len(set(lines.node.tolist())) == 1 and {lines.text(i) for i in range(3)} == {b"a b c d e"}


def test_short_lines_and_lines_without_spaces_are_judged(spark, folder):
    rows = [(1, "Home\nfirst text of one\n你好世界今天天气很好\n\na"), (2, "home\n second\n你好世界今天天气很好\n\nb"),
            (3, "HOME \nthird\na\nb\nHome")]
    docs = stored(spark, spark.createDataFrame(rows, SCHEMA).coalesce(1), folder)
    found = {r.doc_id: tuple(r)[1:] for r in line_dedup.dedup_lines(docs).collect()}
    assert found == {1: (rows[0][1], 4, 0), 2: (" second\n\nb", 4, 2), 3: ("third", 5, 4)}


def test_documents_stay_for_their_short_lines(spark, folder):
    notice = "All rights reserved by the people who wrote this page"
    rows = [(1, notice), (2, f"{notice}\nrose\nred\n"), (3, f"{notice}\n\n red"), (4, "\n"), (5, notice.upper())]
    docs = stored(spark, spark.createDataFrame(rows, SCHEMA).coalesce(1), folder)
    left = {r.doc_id: r.text for r in line_dedup.without_repetitions(docs).collect()}
    assert left == {1: notice, 2: "rose\nred\n", 4: "\n"}


def plain_shingles(line):
    return {line[j:j + 5] for j in range(max(1, len(line) - 4))}


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшя", "天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收"])
def test_planted_near_copies_are_found(spark, folder, letters):
    """Lines of 60 characters with one of them changed: similar by characters, not by 8 bytes."""
    rng = np.random.default_rng(6)
    lines, copies = [], []
    for i in range(60):
        line = ["".join(rng.choice(list(letters), 9)) for _ in range(6)]
        lines.append(" ".join(line))
        line[2] = line[2][:4] + "0" + line[2][5:]
        copies.append(" ".join(line))
        assert 100 * len(plain_shingles(lines[-1]) & plain_shingles(copies[-1])) >= 80 * len(plain_shingles(lines[-1]) | plain_shingles(copies[-1]))
    docs = stored(spark, spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(copies))], SCHEMA).coalesce(1), folder)
    found = {r.doc_id: r.dropped_lines for r in line_dedup.dedup_lines(docs).collect()}
    assert found[1] == 0 and found[2] >= 58


def test_shingles_are_characters():
    for text in ["abcdefg", "aaaaaaa", "größer als", "天地玄黄宇宙", "a😀b😀c😀d", "ab", "é"]:
        assert len(line_dedup.line_shingles(text.encode())) == len(plain_shingles(text))
    part = next(line_dedup.slices(__import__("pyarrow").array(["天地玄黄宇宙 x\nab\nabcde\nétés"])))
    nodes, keys = line_dedup.band_keys(lines := line_dedup.judged_lines(part, 1))
    assert nodes.tolist() == lines.node[[0, 2]].tolist() and keys.shape == (2, line_dedup.BANDS)


# 5 classifier

def test_classifier_learns_and_scores_odd_rows(spark, odd, folder, none):
    good = [(i, f"the quick brown fox number {i} jumps over the lazy dog and runs") for i in range(100, 160)]
    poor = [(i, f"buy!! now$$$ {i} %%% click### here&&& win***") for i in range(200, 260)]
    docs = stored(spark, spark.createDataFrame(good + poor, SCHEMA), folder, "labelled")
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in poor] + [(None, 1), (100, None), (100, 7)],
                                   "doc_id long, quality int")
    model = quality_classifier.fit(docs, labels)
    rows = {r.doc_id: r for r in quality_classifier.score_documents(docs, model).collect()}
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    assert all(rows[i].predicted == 1 for i, _ in good if held(i)) and all(rows[i].score < 0.5 for i, _ in poor if held(i))
    scored = quality_classifier.score_documents(odd, model).collect()
    assert len(scored) == len(ODD) and all(0 <= r.score <= 1 for r in scored)
    assert len({r.score for r in scored if not r.text}) == 1
    assert quality_classifier.score_documents(none, model).count() == 0
    blank = quality_classifier.fit(docs, labels.limit(0))
    assert blank.scores(__import__("pyarrow").array(["a"])).tolist() == [0.5]


# 6 decontamination

def test_tiles_equal_brute_force():
    rng = np.random.default_rng(3)
    for case in range(120):
        item = rng.integers(0, 4 if case % 2 else 30, rng.integers(1, 40)).astype(np.uint64)
        text = rng.integers(0, 4 if case % 2 else 30, 60).astype(np.uint64)
        for at in range(0, 50, 17):
            part = item[rng.integers(0, len(item)):][:12]
            text[at:at + len(part)] = part
        ours = decontamination.greedy_tiles(item, text, min(3, len(item)))
        plain = brute_tiles(item.tolist(), text.tolist(), min(3, len(item)))
        if case % 2 == 0:  # few ties: the same cover
            assert sum(n for *_, n in ours) == sum(n for *_, n in plain)
        spans = [x for a, _, n in ours for x in range(a, a + n)]
        assert len(spans) == len(set(spans)) and all((item[a:a + n] == text[b:b + n]).all() for a, b, n in ours)


def test_repetitive_texts_are_tiled_fast():
    """200 equal words against 5,000: one run of the item, and no pair of places twice."""
    began = time.perf_counter()
    word = np.full(5000, 7, dtype=np.uint64)
    assert sum(n for *_, n in decontamination.greedy_tiles(word[:200], word, 5)) == 200
    assert time.perf_counter() - began < 3


def test_short_items_have_to_be_a_line(spark, folder):
    docs = stored(spark, spark.createDataFrame([(1, "well yes indeed"), (2, "well\n YES \nindeed"), (3, "yes"), (4, "yes yes")], SCHEMA), folder)
    items = spark.createDataFrame([(9, "Yes"), (8, "indeed well"), (7, "")], "item_id long, text string")
    found = decontamination.contaminated(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(2, 9), (3, 9)}


def test_contaminated_documents(spark, folder):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho sigma tau upsilon"
    w = item.split()
    rows = [(1, "x y z " + item.upper() + " tail"), (2, " ".join(w[10:] + ["and"] + w[:10])),
            (3, " ".join(w[:15])), (4, " ".join(x for y in w for x in (y, "and"))), (5, None), (None, item), (6, "short item"), (7, "")]
    docs = stored(spark, spark.createDataFrame(rows, SCHEMA), folder)
    bench = stored(spark, spark.createDataFrame([(10, item), (10, item), (11, None), (12, ""), (13, "short item"), (None, "no such words here at all")],
                                                "item_id long, text string"), folder, "benchmark")
    found = decontamination.contaminated(docs, bench).collect()
    assert Counter((r.doc_id, r.item_id, r.n_tiles) for r in found) == Counter(
        {(1, 10, 1): 2, (2, 10, 2): 2, (None, 10, 1): 2, (6, 13, 1): 1})
    left = decontamination.decontaminate(docs, bench)
    assert sorted(r.doc_id for r in left.collect()) == [3, 4, 5, 7] and left.columns == docs.columns
    assert decontamination.contaminated(docs.limit(0), bench).count() == 0
    assert decontamination.contaminated(docs, bench.limit(0)).count() == 0


# 7 join

@pytest.mark.parametrize("block", [256, 3])
def test_join_equals_brute_force(spark, folder, monkeypatch, block):
    from tableflow.llm import linking
    monkeypatch.setattr(linking, "BLOCK", block)
    rng = np.random.default_rng(7)
    base = rng.integers(0, 400, 90)
    rows = [x for x in ODD if x[0] != 7]
    for i in range(100, 160):  # near copies of one text, with links between few of them
        copy = base.copy()
        copy[rng.integers(0, 90, rng.integers(0, 5))] = rng.integers(400, 900)
        rows.append((i, " ".join(map(str, copy))))
    shared = " ".join(map(str, range(1000, 1060)))
    rows += [(i, shared + " " + " ".join(map(str, rng.integers(2000, 9000, 50)))) for i in range(200, 230)]
    docs = stored(spark, spark.createDataFrame(rows, SCHEMA), folder)
    found = ngram_join.join_similar(docs, 4, 85).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute_components(rows, 4, 85)


def test_occurrence_search_with_long_lists_aside(monkeypatch):
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(60)]
    plain = [[j for j, y in enumerate(sets) if 100 * len(np.intersect1d(x, y)) >= 60 * len(np.union1d(x, y))] for x in sets]
    index = ngram_join.InvertedIndex(sets)
    for mu in (0.001, 0.05, 20):
        monkeypatch.setattr(ngram_join, "_MU", mu)
        assert [index.search(x, 60) for x in sets] == plain


def test_one_of_each(spark, odd, none):
    kept = ngram_join.one_of_each(odd)
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 3, 4, 5, 6, None, 7, 8])
    assert kept.columns == odd.columns and ngram_join.one_of_each(none).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (101, 100), (5, 5), (300, 200), (200, 250)]
    found = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {**{i: 1 for i in range(1, 61)}, 100: 100, 101: 100, 200: 200, 250: 200, 300: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# 8 licenses

def test_licenses(spark, folder, odd, none):
    rows = [(1, "Under the GNU  General-Public License. The MIT License, mit license!"), (2, "cc\nBY cc by-nc 4.0 x"),
            (3, "This work is licensed under the GNU General Public License, version 3."),
            (4, "Redistribution and use in source or binary forms, with or without any modification, are permitted provided that the following conditions are met"),
            (5, "gnu general license"), (6, "nothing here")]
    docs = stored(spark, spark.createDataFrame(rows, SCHEMA), folder, "licensed")
    found = {r.doc_id: r for r in license_scan.scan_licenses(docs).collect()}
    assert (found[1].n_base, found[1].first_word, found[1].last_word, found[1].base_labels) == (3, 2, 9, "gpl,mit")
    assert (found[2].n_base, found[2].base_labels, found[2].first_word, found[2].last_word) == (2, "cc-by", 0, 2)
    assert found[3].labels == "gpl,gpl-3.0" and found[3].score == 1.0
    assert found[4].labels == "bsd" and found[4].base_labels == "" and 0.7 <= found[4].score < 1 and found[4].n_base == 0
    assert found[4].first_word is None
    assert found[5].labels == "" and found[6].score == 0.0
    assert license_scan.scan_licenses(odd).count() == len(ODD) and license_scan.scan_licenses(none).count() == 0


def brute_labels(text):
    """Labels of the notices in a text by trying every window of every template."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
    labels = set()
    for one in license_scan.NOTICES:
        k, n = one.window, len(one.words)
        votes = sorted({(i - j, j) for i in range(len(w) - k + 1) for j in range(n - k + 1) if tuple(w[i:i + k]) == one.words[j:j + k]})
        spans = []
        for diagonal, j in votes:
            if not spans or diagonal - spans[-1][-1][0] > license_scan.GAP:
                spans.append([])
            spans[-1].append((diagonal, j))
        for span in spans:
            covered = {j + x for _, j in span for x in range(k)}
            beside = {j + x for _, j in span for x in range(k - 1)}
            places = [diagonal + j for diagonal, j in span]
            wide = max(places) + k - min(places)
            decides = {p for p in range(n) if one.deciding >> p & 1}
            if len(covered) >= license_scan.COVERED * n and decides <= beside and wide <= 1.5 * n + license_scan.GAP:
                labels.add(one.label)
    return labels


def test_license_texts_equal_brute_force(spark, folder):
    """Whole sentences of licenses without a notice line, with words added, left out and changed."""
    chance = np.random.default_rng(8)
    texts = []
    for one in license_scan.NOTICES:
        words_ = list(one.words)
        texts.append(" ".join(words_))
        for _ in range(2):
            own = words_[:]
            for _ in range(int(chance.integers(1, 4))):
                at = int(chance.integers(0, len(own)))
                own[at:at + int(chance.integers(0, 2))] = ["foo"] * int(chance.integers(0, 3))
            texts.append("bar " * int(chance.integers(0, 9)) + " ".join(own) + " the end. " + " ".join(words_[:5]))
    texts += [a + " " + b for a, b in zip(texts[::7], texts[3::7])] + ["", "nothing here"]
    docs = stored(spark, spark.createDataFrame(list(enumerate(texts)), SCHEMA), folder, "license_texts")
    phrases = [(" " + " ".join(p.words) + " ", p.label) for p in license_scan.PHRASES]
    for row in license_scan.scan_licenses(docs).collect():
        flat = " " + " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", texts[row.doc_id].lower())) + " "
        base = {label for phrase, label in phrases if phrase in flat}
        assert row.labels == ",".join(sorted(base | brute_labels(texts[row.doc_id]))), texts[row.doc_id]


@pytest.mark.parametrize("label, text", [
    ("mit", "x. The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("bsd", "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd-3-clause", "3. Neither the name of Example Corp nor the names of its contributors may be used to endorse or promote products derived "
                     "from this software without specific prior written permission."),
    ("isc", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that "
            "the above copyright notice and this permission notice appear in all copies."),
    ("", "This software may be used by anyone, and the above copyright notice is not needed in a copy."),
    ("zlib", "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software."),
])
def test_license_bodies(label, text):
    assert brute_labels(text) == ({label} if label else set())


def test_neighbouring_licenses_are_told_apart(spark, folder):
    gnu = "under the terms of the GNU {}General Public License as published by the Free Software Foundation; either version {} of the License"
    work = "This work is licensed under a Creative Commons Attribution{} 4.0 International License"
    cases = [(gnu.format("", 2), "gpl,gpl-2.0"), (gnu.format("", 3), "gpl,gpl-3.0"), (gnu.format("Lesser ", "2.1"), "lgpl-2.1"),
             (gnu.format("Lesser ", 3), "lgpl-3.0"), (gnu.format("Affero ", 3), "agpl-3.0"), (work.format(""), "cc-by-4.0"),
             (work.format("-NonCommercial"), "cc-by-nc-4.0"), (work.format("-ShareAlike"), "cc-by-sa-4.0"),
             (work.format("-NoDerivatives"), "cc-by-nd-4.0"), (work.format("-NonCommercial-ShareAlike"), "cc-by-nc-sa-4.0"),
             ("Licensed under CC BY-NC-ND 4.0", "cc-by,cc-by-nc-nd-4.0"),
             ("Licensed under the Apache License, Version 1.1", "apache,apache-1.1"),
             ("Licensed under the Apache License, Version 2.0", "apache,apache-2.0"), (gnu.format("Other ", 9), "")]
    docs = stored(spark, spark.createDataFrame([(i, f"x {text}. y") for i, (text, _) in enumerate(cases)], SCHEMA), folder, "neighbours")
    found = {r.doc_id: r.labels for r in license_scan.scan_licenses(docs).collect()}
    assert [found[i] for i in range(len(cases))] == [labels for _, labels in cases]


def test_base_places_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for row, (text,) in zip(license_scan.scan_licenses(docs).orderBy("doc_id").collect(), docs.orderBy("doc_id").select("text").collect()):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(lower))
        places = [(j, one.label) for one in license_scan.PHRASES for j in range(len(w)) if tuple(w[j:j + len(one.words)]) == one.words]
        assert row.n_words == len(w) and row.n_base == len(places)
        assert row.first_word == min((j for j, _ in places), default=None) and row.last_word == max((j for j, _ in places), default=None)
        assert row.base_labels == ",".join(sorted({x for _, x in places}))
        assert {x for _, x in places} <= set(row.labels.split(","))


# 9 packing

def best_cost(places, penalties, length):
    cost = [0] + [math.inf] * (len(places) - 1)
    for j in range(1, len(places)):
        for i in range(j):
            if places[j] - places[i] <= length:
                cost[j] = min(cost[j], cost[i] + length - (places[j] - places[i]) + penalties[j])
    return cost[-1]


def test_cuts_are_the_cheapest():
    rng = np.random.default_rng(4)
    for _ in range(60):
        places = [0, *np.cumsum(rng.integers(1, 9, 40)).tolist()]
        penalties = rng.integers(0, 4, len(places)).tolist()
        cuts = packing.best_cuts(places, penalties, 20, True)
        assert cuts[0] == 0 and cuts[-1] == places[-1] and max(np.diff(cuts)) <= 20
        where = dict(zip(places, penalties))
        cost = sum(20 - (b - a) + where[b] for a, b in zip(cuts, cuts[1:]))
        assert cost == best_cost(places, penalties, 20)


@pytest.mark.parametrize("block", [1 << 19, 500])
def test_pieces_hold_every_token_once(spark, odd, none, monkeypatch, block):
    from tokenizers import Tokenizer
    monkeypatch.setattr(packing, "BLOCK_TOKENS", block)
    rows = packing.pack_documents(odd.withColumn("doc_id", F.coalesce("doc_id", F.lit(99))), TOKENIZER, 256).collect()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    for doc, text in ODD:
        if ODD.count((doc, text)) > 1 or doc is None:
            continue
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], dtype="<u4").tobytes())
            at += r.length
        assert at == len(ids)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert packing.pack_documents(none, TOKENIZER).count() == 0


def test_ids_of_odd_words():
    import pyarrow as pa
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(TOKENIZER)
    texts = ["It's they're 'smith x!'s éa  b　c", "a<|endoftext|>b <|START|>", "1a2b,c…!? “q”", "ΑΣ Σ İx ſ", "\x1c\x1d a\x00b", "don't_stop--now", ""]
    for text in texts:
        ids, *_ = next(packing.token_streams(pa.array([text]), TOKENIZER))
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [1], text


# 10 rules

def plain_figures(text):
    text = text or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + j for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for j in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_figures_equal_plain_python(spark, odd, none):
    more = [(20, "a a a a a"), (21, "x y z x y z q x y z"), (22, "one\ntwo\none\n\none \nthree|#"), (23, "é ü　ß a b c a b c " * 30)]
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame(more, SCHEMA))
    rows = quality_rules.judge_quality(docs, ["doc_id"]).collect()
    expected = Counter((i, *plain_figures(t)) for i, t in ODD + more)
    assert Counter(tuple(r)[:6] for r in rows) == expected
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert quality_rules.judge_quality(none, ["doc_id"]).count() == 0


def test_estimate_equals_plain_em(spark):
    patterns = [((1, 1, 1), 700), ((1, 1, 0), 150), ((-1, 1, 1), 20), ((-1, -1, 1), 60), ((-1, -1, -1), 50), ((0, -1, -1), 20)]
    frame = spark.createDataFrame([(*v, n) for v, n in patterns], "a int, b int, c int, n long")
    prior, rules = quality_rules.estimate(frame, ["a", "b", "c"])
    p, good, bad = 0.9, [0.95] * 3, [0.5] * 3
    for _ in range(quality_rules.ROUNDS):
        post = []
        for v, n in patterns:
            odds = math.log(p / (1 - p)) + sum(math.log(g / (1 - b)) if x == 1 else math.log((1 - g) / b) if x == -1 else 0 for x, g, b in zip(v, good, bad))
            post.append(1 / (1 + math.exp(-odds)))
        ns = [n for _, n in patterns]
        p = min(max(sum(n * q for n, q in zip(ns, post)) / sum(ns), .01), .99)
        def share(j, vote, weight):
            hit = sum(x for (v, _), x in zip(patterns, weight) if v[j] == vote)
            return (hit + 1) / (sum(x for (v, _), x in zip(patterns, weight) if v[j]) + 2)
        good_w, bad_w = [n * q for n, q in zip(ns, post)], [n * (1 - q) for n, q in zip(ns, post)]
        good = [min(max(share(j, 1, good_w), .9), .9999) for j in range(3)]
        bad = [min(max(share(j, -1, bad_w), .01), .99) for j in range(3)]
    assert prior == pytest.approx(p)
    assert [rules[x].good for x in "abc"] == pytest.approx(good) and [rules[x].bad for x in "abc"] == pytest.approx(bad)
