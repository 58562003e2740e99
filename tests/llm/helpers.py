"""Frames of odd rows that every operator has to take."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


LONG = " ".join(f"wort{i % 977}" for i in range(60_000))
#: Nulls in each column, empty and blank texts, ties, repeated rows, a very long text.
ODD = [
    (1, "One two three four five six seven eight nine ten."),
    (1, "One two three four five six seven eight nine ten."),
    (2, "ONE two  three four\tfive six seven eight nine ten."),
    (None, "One two three four five six seven eight nine ten."),
    (3, None), (4, ""), (5, " \n\t"), (6, "one"), (None, None),
    (7, LONG), (8, "Ünïcödé wörds – and signs %%% | and\n\n\nlines\r\nof text é"),
]
SCHEMA = "doc_id long, text string"


def odd_documents(spark):
    """With columns whose names could clash with helper columns."""
    return spark.createDataFrame([(i, t, "x", 1, 2, 3, 4) for i, t in ODD],
                                 SCHEMA + ", source string, node long, label long, key long, n long")


def stored(spark, frame, folder, name="documents"):
    path = f"{folder}/{name}.parquet"
    frame.write.parquet(path)
    return spark.read.parquet(path)


def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def brute_tiles(item, text, least):
    """Greedy string tiling by trying every pair of places again and again."""
    used_i, used_t, tiles = set(), set(), []
    while True:
        best = (0, 0, 0)
        for a in range(len(item)):
            for b in range(len(text)):
                n = 0
                while a + n < len(item) and b + n < len(text) and item[a + n] == text[b + n] \
                        and a + n not in used_i and b + n not in used_t:
                    n += 1
                if n > best[0]:
                    best = (n, a, b)
        n, a, b = best
        if n < least:
            return tiles
        used_i |= set(range(a, a + n))
        used_t |= set(range(b, b + n))
        tiles.append((a, b, n))


def shingle_groups(rows, k, percent):
    """(sets, group number of each row) by comparing every pair."""
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                up[max(top(i), top(j))] = min(top(i), top(j))
    return sets, [top(i) for i in range(len(rows))]


def brute_components(rows, k, percent):
    sets, group = shingle_groups(rows, k, percent)
    groups = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        groups[group[i]].append(doc)
    return Counter((doc, len(sets[i]), min((x for x in groups[group[i]] if x is not None), default=None) if sets[i] else doc)
                   for i, (doc, _) in enumerate(rows))


def brute_lines(rows, percent):
    """Numbers of the lines with a word that each row loses, those that are like an earlier one, and how
    many it has: lines are compared by their sets of five characters, shorter ones by equality."""
    lines = [(i, n, " ".join(w)) for i, (_, text) in enumerate(rows)
             for n, line in enumerate((text or "").split("\n")) if (w := words(line))]
    number = {}
    for *_, text in lines:
        number.setdefault(text, len(number))
    sets = [{text[j:j + 5] for j in range(len(text) - 4)} for text in number]
    holders, up = defaultdict(list), list(range(len(sets)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, own in enumerate(sets):
        common = Counter(j for gram in own for j in holders[gram])
        for j, n in common.items():
            if 100 * n >= percent * (len(own) + len(sets[j]) - n):
                up[max(top(i), top(j))] = min(top(i), top(j))
        for gram in own:
            holders[gram].append(i)
    first, lost, judged = {}, defaultdict(set), Counter()
    for i, n, text in lines:
        judged[i] += 1
        if first.setdefault(top(number[text]), (i, n)) != (i, n):
            lost[i].add(n)
    return lost, judged
