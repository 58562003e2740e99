"""Filter audit, vector codes and SimHash on odd rows, on empty tables, and against plain Python."""

import hashlib
import itertools
import math
import random
import struct
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from helpers import LONG, ODD, empty_documents, odd_documents, stored, words
from tableflow.llm import filter_audit, simhash, vector_codes


@pytest.fixture
def odd(spark, folder):
    return stored(spark, odd_documents(spark), folder)


# 11 vector codes

VECTORS = "vec_id long, embedding array<float>, label int"


def whole(vector):
    return tuple(math.floor(1024 * x) for x in vector)


def plain_codes(rows):
    """(vec_id, label, code, error) and the codebooks, with plain numbers."""
    kept = sorted(((i, whole(v), label) for i, v, label in rows
                   if v and all(x is not None and math.isfinite(x) for x in v)), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // 4
    parts = [[v[p * width:(p + 1) * width] for p in range(4)] for _, v, _ in kept]
    books = [[x[p] for x in parts[:256]] for p in range(4)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), at) for at, entry in enumerate(book))

    for _ in range(4):
        for p in range(4):
            own = defaultdict(list)
            for x in parts:
                own[nearest(x[p], books[p])[1]].append(x[p])
            books[p] = [tuple(sum(c) // len(own[at]) for c in zip(*own[at])) if at in own else entry for at, entry in enumerate(books[p])]
    found = []
    for (i, _, label), x in zip(kept, parts):
        best = [nearest(x[p], books[p]) for p in range(4)]
        found.append((i, label, "".join(f"{at:02x}" for _, at in best), sum(d for d, _ in best)))
    return found, books


def checked_codes(spark, folder, rows, name="vectors"):
    frame = stored(spark, spark.createDataFrame([(*r, 7, "x") for r in rows], VECTORS + ", code int, `of` string"), folder, name)
    expected, books = plain_codes(rows)
    sums = Counter()
    for _, label, _, error in expected:
        sums[label] += error
    numbers = ",".join(str(c) for book in books for entry in book for c in entry)
    sha = hashlib.sha256(numbers.encode()).hexdigest()
    got = vector_codes.encode_vectors(frame).collect()
    assert Counter(tuple(r) for r in got) == Counter((i, label, code, e, sums[label], sha) for i, label, code, e in expected)


def test_codes_of_odd_vectors(spark, folder):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.25, 0.0, 1.0], 1), (1, [0.5, -0.25, 0.0, 1.0], 1), (1, [0.25, -0.25, 0.0, 1.0], None),
            (2, None, 1), (3, [0.1, None, 0.2, 0.3], 1), (4, [nan, 0.0, 0.0, 0.0], 2), (5, [0.0, inf, 0.0, 0.0], 2),
            (6, [0.0, -inf, 0.0, 0.0], 2), (None, [-0.0001, 0.9999, -0.5, 0.125], None), (7, [-1.0, 1.0, -1.0, 1.0], 3), (8, [], 3)]
    checked_codes(spark, folder, rows)


def test_codes_with_ties_shared_prefixes_and_unused_entries(spark, folder):
    rng = random.Random(11)
    rows = [(i, [rng.randrange(-3, 4) / 1024 for _ in range(12)], i % 3) for i in range(700)]
    rows += [(1000 + i, rows[5][1], 9) for i in range(400)]  # one vector in a third of the rows
    checked_codes(spark, folder, rows)


def test_fewer_vectors_than_entries_and_no_vectors(spark, folder):
    checked_codes(spark, folder, [(3, [0.1] * 8, 0)])
    assert vector_codes.encode_vectors(spark.createDataFrame([], VECTORS)).collect() == []
    assert vector_codes.encode_vectors(spark.createDataFrame([(1, None, 2)], VECTORS)).collect() == []


def test_vectors_of_another_length_are_left_out(spark, folder):
    rows = [(i, [i / 7] * 8, 0) for i in range(5)]
    frame = stored(spark, spark.createDataFrame([*rows, (9, [0.5] * 4, 0)], VECTORS), folder)
    assert sorted(r.vec_id for r in vector_codes.encode_vectors(frame).collect()) == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("vector", [[0.5] * 6, [3e38, 0.0, 0.0, 0.0]])
def test_vectors_that_cannot_be_coded_are_an_error(spark, vector):
    with pytest.raises(ValueError):
        vector_codes.encode_vectors(spark.createDataFrame([(1, vector, 0)], VECTORS))


@pytest.mark.parametrize("block", [1, 7, 5000])
def test_trie_walk_equals_all_distances(monkeypatch, block):
    """Whatever is walked together, and in any order of the parts."""
    monkeypatch.setattr(vector_codes, "BLOCK", block)
    rng = np.random.default_rng(block)
    for width, spread in ((1, 400), (5, 3), (16, 2), (16, 1 << 26)):
        parts = np.unique(rng.integers(-spread, spread, (900, width)), axis=0)
        entries = rng.integers(-spread, spread, (40, width))
        far = ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)
        for order in (np.arange(len(parts)), rng.permutation(len(parts))):
            nearest, distance = vector_codes.nearest_entries(parts[order], entries)
            assert (nearest == far[order].argmin(axis=1)).all() and (distance == far[order].min(axis=1)).all()


# 12 filter audit

LABELS = "doc_id long, quality int, toxic int, part string"


def plain_audit(rows, labels):
    """Every step of every order, by going through all documents; rows are (doc_id, text, lang)."""
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    docs = []
    for i, text, lang in rows:
        text = text or ""
        w = [x for x in text.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\v", " ").replace("\f", " ").split(" ") if x]
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w),
                 "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text), "D": any(c in "#$%&*|" for c in text),
                 "E": i is not None and first[text] < i}
        docs.append((lang or "", {f for f in fails if fails[f]}, any(d == i and q == 1 for d, q, _ in labels if i is not None),
                     any(d == i and t == 1 for d, _, t in labels if i is not None)))
    found, shapley = {}, Counter()
    for part in {lang for lang, *_ in docs}:
        own = [d for d in docs if d[0] == part]
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[part, f] += len(gone)
                found[part, "".join(order), step] = (
                    len(left), len(gone), sum(f in d[1] for d in own) - len(gone), sum(d[1] == {f} for d in own),
                    sum(d[2] for d in gone), sum(d[3] for d in gone))
    return {key: (*counts, shapley[key[0], key[1][key[2] - 1]]) for key, counts in found.items()}


def checked_audit(spark, folder, rows, labels):
    docs = stored(spark, spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, lang string, mask int, digest string"), folder)
    known = spark.createDataFrame([(*r, "x") for r in labels], LABELS)
    got = filter_audit.audit_filters(docs, known).collect()
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got} == plain_audit(rows, labels)
    assert len(got) == 120 * 5 * len({lang or "" for *_, lang in rows})


def test_audit_of_odd_rows(spark, folder):
    rows = [(i, t, lang) for (i, t), lang in zip(ODD, itertools.cycle(["en", None, "", "de"]))]
    checked_audit(spark, folder, rows, [(1, 1, 0), (1, 0, 1), (2, 1, 1), (3, None, None), (None, 1, 1), (7, 1, 1)])


def test_audit_of_all_mixtures_of_failures(spark, folder):
    rng, rows = random.Random(12), []
    for i in range(200):
        text = " ".join(f"word{rng.randrange(400)}" for _ in range(rng.choice([40, 99, 100, 130])))
        text = text.upper() if rng.random() < 0.3 else text
        text = " ".join([*text.split()[:100]] + ["again"] * 30) if rng.random() < 0.3 else text
        text += rng.choice(["", "", " #", "|"])
        rows += [(i, text, rng.choice(["a", "b"]))]
        rows += [(1000 + j * 200 + i, text, "b") for j in range(rng.choice([0, 0, 0, 1, 30]))]
    labels = [(i, rng.choice([0, 1]), rng.choice([0, 1])) for i, *_ in rows[::2]]
    checked_audit(spark, folder, rows, labels)


def test_audit_of_empty_tables(spark, folder):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert filter_audit.audit_filters(docs, spark.createDataFrame([], LABELS)).collect() == []
    checked_audit(spark, folder, [(1, "a b", "x")], [])


def test_gray_walk_equals_each_subset_alone():
    rng = np.random.default_rng(5)
    masks, weights = rng.integers(0, 32, 50), rng.integers(0, 9, (50, 3))
    left = filter_audit.survivors(masks, weights, 5)
    for subset in range(32):
        assert (left[subset] == weights[(masks & subset) == 0].sum(axis=0)).all()


# 13 SimHash

def plain_fingerprint(text):
    w = words(text)
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(points):
    """Number of the component of each point, by comparing all pairs."""
    up = list(range(len(points)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(points):
        for j in range(i):
            if (a ^ points[j]).bit_count() <= 3:
                up[max(top(i), top(j))] = min(top(i), top(j))
    return [top(i) for i in range(len(points))]


def checked_duplicates(docs, rows):
    points = [plain_fingerprint(text) for _, text in rows]
    group = plain_components(points)
    ids = defaultdict(list)
    for (i, _), g in zip(rows, group):
        ids[g].append(i)
    expected = Counter((i, f"{p:016x}", min((x for x in ids[g] if x is not None), default=None)) for (i, _), p, g in zip(rows, points, group))
    assert Counter(tuple(r) for r in simhash.near_duplicates(docs).collect()) == expected


def test_near_duplicates_of_odd_rows(spark, odd):
    checked_duplicates(odd, ODD)


def test_near_duplicates_of_no_rows(spark, folder):
    assert simhash.near_duplicates(stored(spark, empty_documents(spark), folder)).collect() == []


def test_near_copies_are_found(spark, folder):
    rng, rows = random.Random(13), []
    for i in range(60):
        text = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([1, 2, 3, 60, 400]))]
        rows.append((i, " ".join(text)))
        for j in range(rng.choice([0, 1, 6])):
            changed = list(text)
            changed[rng.randrange(len(text))] = "Other"
            rows.append((100 + 10 * i + j, "  ".join(changed)))
    rows += [(900, LONG), (901, LONG + " more")]
    frame = stored(spark, spark.createDataFrame(rows, "doc_id long, text string"), folder)
    checked_duplicates(frame, rows)
    assert len(set(r.component_id for r in simhash.near_duplicates(frame).collect())) < len(rows)


@pytest.mark.parametrize("chunk, most", [(4096, 1 << 14), (16, 1 << 14), (16, 5)])
def test_links_equal_all_pairs(spark, folder, monkeypatch, chunk, most):
    """Dense clouds, chains, far points, and a cloud with a third of all points; small blocks, few references."""
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    monkeypatch.setattr(simhash, "MOST_REFERENCES", most)
    rng = random.Random(chunk + most)
    points = {rng.getrandbits(64) for _ in range(150)} | {0, (1 << 64) - 1}

    def near(point, bits):
        for b in rng.sample(range(64), bits):
            point ^= 1 << b
        return point

    hot = rng.getrandbits(64)
    points |= {near(hot, rng.randrange(7)) for _ in range(300)}
    for start in [rng.getrandbits(64) for _ in range(20)]:
        for _ in range(15):
            points.add(start := near(start, rng.choice([2, 3, 3, 4])))
    points = sorted(points)
    signed = [struct.unpack("q", struct.pack("Q", p))[0] for p in points]
    nodes = stored(spark, spark.createDataFrame([(x,) for x in signed], "node long"), folder, "nodes")
    labels = {r.node: r.label for r in simhash.link_points(nodes).collect()}
    group = plain_components(points)
    assert set(labels) == set(signed)
    assert len(set(zip(group, (labels[x] for x in signed)))) == len(set(group)) == len(set(labels.values()))


def test_fingerprints_of_many_equal_shingles():
    """More shingles than a byte can count."""
    import pyarrow as pa
    texts = ["a " * 1000, "a b " * 700 + "c", "", "x", None, " ".join(map(str, range(3000)))]
    found = np.concatenate([f for *_, f in simhash.text_fingerprints(pa.array(texts))])
    assert found.tolist() == [plain_fingerprint(t) for t in texts]
