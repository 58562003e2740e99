"""Triples are counted only where both their pairs are frequent, and none that is frequent is lost."""

from collections import Counter

import numpy as np

from helpers import stored
from tableflow.llm import backoff_lm
from tableflow.llm.frames import membership
from tableflow.llm.textbytes import slices


def test_counted_triples(spark, folder):
    texts = ["a b c d e", "a b c x", "q a b y", "b c d", None, "once only here", "a b"]
    docs = stored(spark, spark.createDataFrame([(t,) for t in texts], "text string"), folder).coalesce(1)
    pairs = backoff_lm._count(docs, backoff_lm._pairs).where(f"n >= {backoff_lm.LEAST}")
    frequent = spark.sparkContext.broadcast(membership(pairs, "key"))
    rows = backoff_lm._named(backoff_lm._count_triples(docs, frequent)).collect()
    found = {np.int64(r.key).view(np.uint64): r.n for r in rows}
    plain = Counter()
    for part in slices(docs.toArrow()["text"]):
        plain.update(backoff_lm._triples(*backoff_lm._tokens(part))[0])
    assert {k: n for k, n in found.items() if n >= backoff_lm.LEAST} == {k: n for k, n in plain.items() if n >= backoff_lm.LEAST}
    assert len(found) < len(plain) and set(found) <= set(plain)
