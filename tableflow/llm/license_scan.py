"""License scan by diagonal voting.

Every window of k words of a text votes for the places of the same window in the templates. Votes on
one offset (place in the text minus place in the template: a diagonal) belong to one alignment, and
diagonals beside each other to one with words added or left out. A merged span is verified by the
share of the template's words that its votes cover, and by the words that tell the license from its
neighbours (name, version, lesser, noncommercial, ...): they have to stand there side by side. Short phrases are templates whose every window
has to vote on one diagonal; those places are the base places.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableflow.llm.frames import ROW, arrow_map, column, list_of, numbered
from tableflow.llm.textbytes import ALPHANUMERIC, hash_bytes, slices, windows
from tableflow.session import materialise
from tableflow.sources.tables import seed_frame

#: Diagonals this far apart are one alignment; the share of a template's words that makes a match.
GAP, COVERED = 3, 0.7
PHRASE_WINDOW, NOTICE_WINDOW = 2, 4


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    phrase: bool = False
    deciding: int = 0  # a bit for each place whose word and the next one must stand side by side

    @property
    def window(self) -> int:
        return PHRASE_WINDOW if self.phrase else NOTICE_WINDOW


def _words(text: str) -> tuple[str, ...]:
    return tuple(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower()))


def template(label: str, text: str, phrase: bool = False, deciding: Sequence[str] = ()) -> Template:
    """``deciding`` are runs of at least two words of the text, which must match without insertions."""
    words, bits = _words(text), 0
    if len(words) < (PHRASE_WINDOW if phrase else NOTICE_WINDOW):
        raise ValueError(f"{label}: too few words")
    for run in map(_words, deciding):
        at = next((i for i in range(len(words)) if words[i:i + len(run)] == run), None)
        if at is None or len(run) < 2 or at + len(run) > 62:
            raise ValueError(f"{label}: {' '.join(run)} can not decide")
        bits |= ((1 << len(run) - 1) - 1) << at
    return Template(label, words, phrase, bits)


# Phrases with their labels, and the usual words of license notices.
PHRASES = tuple(template(label, text, True) for label, text in (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
))
_FAMILIES = (("", ""), ("-nc", "NonCommercial"), ("-sa", "ShareAlike"), ("-nd", "NoDerivatives"),
             ("-nc-sa", "NonCommercial ShareAlike"), ("-nc-nd", "NonCommercial NoDerivatives"))
_GNU = (("gpl", "GNU General Public License", ("2", "3")), ("agpl", "GNU Affero General Public License", ("3",)),
        ("lgpl", "GNU Lesser General Public License", ("2.1", "3")), ("lgpl", "GNU Library General Public License", ("2",)))


def _creative_commons():
    for version, ending in (("4.0", "International"), ("3.0", "Unported")):
        for short, words in _FAMILIES:
            for name in dict.fromkeys((words, words.replace("ShareAlike", "Share Alike"), words.replace("NoDerivatives", "NoDerivs"))):
                run = f"Creative Commons Attribution {name} {version}"
                yield template(f"cc-by{short}-{version}", f"This work is licensed under a {run} {ending} License", False, (run,))
            run = f"CC BY{short} {version}"
            yield template(f"cc-by{short}-{version}", f"Licensed under {run}", False, (run,))


def _gnu():
    for short, name, versions in _GNU:
        for version in versions:
            label = f"{short}-{version if '.' in version else version + '.0'}"
            yield template(label, f"This work is licensed under the {name}, version {version}", False, (name, f"version {version}"))
            yield template(label, f"under the terms of the {name} as published by the Free Software Foundation, either "
                                  f"version {version} of the License", False, (name, f"version {version} of"))
            yield template(label, f"under the terms of the {name} as published by the Free Software Foundation, "
                                  f"version {version} of the License", False, (name, f"version {version} of"))


# Headings and sentences of the license texts themselves, for files without a notice.
BODIES = tuple(template(label, text, False, deciding) for label, text, *deciding in (
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the Software", "above copyright notice and this permission notice shall be included"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
            "following disclaimer", "Redistributions of source code must retain"),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
            "following disclaimer in the documentation and/or other materials provided with the distribution",
     "Redistributions in binary form must reproduce"),
    ("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                     "promote products derived from this software without specific prior written permission",
     "may be used to endorse or promote products"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies",
     "for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain", "free and unencumbered software"),
    ("unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source "
                  "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means",
     "Anyone is free to copy modify publish"),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
             "liable for any damages arising from the use of this software",
     "provided as is without any express or implied warranty", "will the authors be held liable"),
    ("zlib", "The origin of this software must not be misrepresented; you must not claim that you wrote the original software",
     "origin of this software must not be misrepresented"),
    ("epl-1.0", "Eclipse Public License - v 1.0", "Eclipse Public License - v 1.0"),
    ("epl-2.0", "Eclipse Public License - v 2.0", "Eclipse Public License - v 2.0"),
    ("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
     "Eclipse Public License 2.0"),
    ("epl", "The accompanying program is provided under the terms of this Eclipse Public License", "this Eclipse Public License"),
    ("apache-2.0", "Apache License, Version 2.0, January 2004", "Apache License, Version 2.0, January 2004"),
    ("apache-2.0", "Terms and conditions for use, reproduction, and distribution",
     "Terms and conditions for use, reproduction, and distribution"),
    ("apache-2.0", "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, "
                   "worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare "
                   "Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work",
     "each Contributor hereby grants to You"),
    ("mpl-2.0", "Mozilla Public License, Version 2.0", "Mozilla Public License, Version 2.0"),
    ("gpl-2.0", "GNU General Public License, Version 2, June 1991", "GNU General Public License, Version 2, June 1991"),
    ("gpl-3.0", "GNU General Public License, Version 3, 29 June 2007", "GNU General Public License, Version 3, 29 June 2007"),
    ("agpl-3.0", "GNU Affero General Public License, Version 3, 19 November 2007",
     "GNU Affero General Public License, Version 3, 19 November 2007"),
    ("lgpl-2.1", "GNU Lesser General Public License, Version 2.1, February 1999",
     "GNU Lesser General Public License, Version 2.1, February 1999"),
    ("lgpl-3.0", "GNU Lesser General Public License, Version 3, 29 June 2007",
     "GNU Lesser General Public License, Version 3, 29 June 2007"),
))

NOTICES = tuple(template(label, text, False, deciding) for label, text, *deciding in (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", "Apache License, Version 2.0"),
    ("apache-1.1", "Licensed under the Apache License, Version 1.1", "Apache License, Version 1.1"),
    ("apache-1.1", "The Apache Software License, Version 1.1", "Apache Software License, Version 1.1"),
    ("apache-2.0", "you may not use this file except in compliance with the License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are "
            "permitted provided that the following conditions are met"),
    ("bsl-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy "
                "of the software and accompanying documentation", "person or organization obtaining"),
    ("mit", "Released under the MIT License", "MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files", "any person obtaining a copy"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
     "Mozilla Public License, v. 2.0"),
    ("mpl-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1",
     "Mozilla Public License Version 1.1"),
)) + BODIES + tuple(_creative_commons()) + tuple(_gnu())


def _grams(templates: Sequence[Template]) -> list[tuple[int, int, int, int]]:
    """(window, hash, number of the template, place in it)."""
    found = []
    for number, one in enumerate(templates):
        hashes = np.array([hash_bytes(w.encode()) for w in one.words], dtype=np.uint64)
        for place, gram in enumerate(windows(hashes, one.window).view(np.int64).tolist()):
            found.append((one.window, gram, number, place))
    return found


def scan_licenses(docs: DataFrame, templates: Sequence[Template] = PHRASES + NOTICES,
                  doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its words, base places, labels and the best share of a template.

    A null or empty text, or one without words, has no places, empty labels and score 0. Repeated
    rows are scanned alike; other columns are not used, whatever their names. An empty table gives
    no rows.
    """
    spark = docs.sparkSession
    grams = _grams(templates)
    wanted = {k: np.unique(np.array([g for w, g, *_ in grams if w == k], dtype=np.int64).view(np.uint64))
              for k in {w for w, *_ in grams}}

    def find(batch: pa.RecordBatch):
        rows, ids = column(batch, ROW), column(batch, "doc_id")
        for part in slices(column(batch, "text"), ALPHANUMERIC):
            owner, hits = part.owner(), []
            for k, hashes in wanted.items():
                whole = windows(part.hashes, k)
                if not len(whole):
                    continue
                place = np.minimum(np.searchsorted(hashes, whole), len(hashes) - 1)
                at = np.flatnonzero((hashes[place] == whole) & (owner[:len(whole)] == owner[k - 1:]))
                hits.append((at, whole[at], np.full(len(at), k)))
            at, gram, k = (np.concatenate(x) for x in zip(*hits)) if hits else (np.empty(0, int),) * 3
            order = np.argsort(at, kind="stable")
            bounds = np.searchsorted(at[order], part.first)
            place = (at - part.first[owner[at]])[order]
            n = part.high - part.low
            yield {ROW: rows.slice(part.low, n), "doc_id": ids.slice(part.low, n),
                   "n_words": np.diff(part.first), "places": list_of(place, bounds),
                   "grams": list_of(gram[order].astype(np.uint64), bounds), "sizes": list_of(k[order].astype(np.int64), bounds)}

    source = numbered(docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                                  F.col(text).cast("string").alias("text")))
    scanned = materialise(arrow_map(
        source, f"{ROW} bigint, doc_id bigint, n_words bigint, places array<bigint>, "
                "grams array<bigint>, sizes array<bigint>", find))
    table = seed_frame(spark, [(k, gram, number, place, templates[number].label, len(templates[number].words),
                                templates[number].phrase, templates[number].deciding) for k, gram, number, place in grams],
                       "size bigint, gram bigint, template int, template_place bigint, label string, "
                       "template_words bigint, phrase boolean, deciding bigint")
    votes = (scanned.select(ROW, F.explode(F.arrays_zip("places", "grams", "sizes")).alias("hit"))
             .select(ROW, F.col("hit.places").alias("place"), F.col("hit.grams").alias("gram"),
                     F.col("hit.sizes").alias("size"))
             .join(table, ["gram", "size"])
             .withColumn("diagonal", F.col("place") - F.col("template_place")))
    one = [ROW, "template", "label", "template_words", "phrase", "deciding", "size"]
    diagonals = votes.groupBy(*one, "diagonal").agg(
        F.collect_set("template_place").alias("voted"),
        F.min("place").alias("low"), F.max("place").alias("high"))
    found = _base(diagonals).unionByName(_spans(diagonals, one))
    labels = found.groupBy(ROW).agg(
        F.sum(F.col("phrase").cast("long")).alias("n_base"),
        F.min(F.when(F.col("phrase"), F.col("low"))).alias("first_word"),
        F.max(F.when(F.col("phrase"), F.col("low"))).alias("last_word"),
        F.sort_array(F.collect_set(F.when(F.col("phrase"), F.col("label")))).alias("base_labels"),
        F.sort_array(F.collect_set("label")).alias("labels"), F.max("share").alias("score"))
    text_of = {name: F.coalesce(F.array_join(name, ","), F.lit("")).alias(name) for name in ("base_labels", "labels")}
    return scanned.select(ROW, "doc_id", "n_words").join(labels, ROW, "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word",
        "last_word", text_of["base_labels"], text_of["labels"],
        F.coalesce("score", F.lit(0.0)).alias("score"))


def _base(diagonals: DataFrame) -> DataFrame:
    """Phrases whose every window votes on one diagonal: their words stand there."""
    whole = F.size("voted") == F.col("template_words") - F.col("size") + 1
    return diagonals.where(F.col("phrase") & whole).select(
        ROW, "label", "phrase", "low", F.lit(1.0).alias("share"))


def _spans(diagonals: DataFrame, one: list[str]) -> DataFrame:
    """Spans of neighbouring diagonals that cover enough of their template and all that decides."""
    in_order = Window.partitionBy(ROW, "template").orderBy("diagonal")
    far = F.col("diagonal") - F.lag("diagonal").over(in_order) > GAP
    spans = (diagonals.where(~F.col("phrase"))
             .withColumn("new", F.coalesce(far.cast("int"), F.lit(0)))
             .withColumn("span", F.sum("new").over(in_order))
             .groupBy(*one, "span")
             .agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("voted")))).alias("voted"),
                  F.min("low").alias("low"), F.max("high").alias("high")))
    covered = F.expr("""aggregate(voted, named_struct('last', -size, 'n', cast(0 as bigint)), (a, x) ->
        named_struct('last', x, 'n', a.n + least(size, x - a.last)), a -> a.n)""")
    beside = F.expr("""aggregate(voted, 0L, (a, x) ->
        a | shiftleft(shiftleft(1L, cast(size as int) - 1) - 1L, cast(x as int)))""")
    decided = beside.bitwiseAND(F.col("deciding")) == F.col("deciding")
    share = covered / F.col("template_words")
    fits = F.col("high") + F.col("size") - F.col("low") <= 1.5 * F.col("template_words") + GAP
    return spans.select(ROW, "label", "phrase", "low", share.alias("share"), (fits & decided).alias("fits")).where(
        F.col("fits") & (F.col("share") >= COVERED)).drop("fits")
