"""URL filter: a trie over reversed host labels and path segments, sent to every task.

The most specific rule decides: more host labels first, then the longer path; if one place has an
allow and a block entry, block wins. A rule's path is a prefix of the url's path, so the part of it
after its last slash may end inside a segment.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.frames import arrow_map, column

MAX_RULES = 1_000_000
_PARTS = re.compile(r"([^/?#]*)([^?#]*)", re.DOTALL)
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path); both empty without a scheme."""
    at = -1 if url is None else url.find("://")
    if at < 0:
        return "", ""
    host, path = _PARTS.match(url, at + 3).groups()
    return host.translate(_LOWER), path


def split_rule(rule: str) -> tuple[str, str]:
    host, slash, rest = rule.partition("/")
    return host.translate(_LOWER), slash + rest


class UrlTrie:
    """Nodes are dicts: a label or segment leads to the next node, ``None`` holds what ends here.

    A host node holds the root of its paths; a path node holds (tail, rule, verdict), where the next
    segment of the url has to start with the tail.
    """

    def __init__(self, rules: Iterable[tuple[str, str]]):
        self.root: dict = {}
        for number, (rule, verdict) in enumerate(rules):
            if number >= MAX_RULES:
                raise ValueError(f"more than {MAX_RULES} rules; split them by domain")
            if verdict not in ("allow", "block"):
                raise ValueError(f"{rule}: {verdict} is no verdict")
            self._add(rule, verdict)

    def _add(self, rule: str, verdict: str) -> None:
        host, path = split_rule(rule)
        node = self.root
        for label in reversed(host.split(".") if host else []):
            node = node.setdefault(label, {})
        *segments, tail = path.split("/")
        node = node.setdefault(None, {})
        for segment in segments:
            node = node.setdefault(segment, {})
        entries = node.setdefault(None, {})
        if entries.get(tail, ("", ""))[1] != "block":
            entries[tail] = (rule, verdict)

    def find(self, host: str, path: str) -> tuple[str | None, str | None]:
        """(rule, verdict) of the most specific rule that fits, or two None."""
        stops, node = [], self.root
        if None in node:
            stops.append(node[None])
        for label in reversed(host.split(".") if host else []):
            node = node.get(label)
            if node is None:
                break
            if None in node:
                stops.append(node[None])
        segments = path.split("/")
        for paths in reversed(stops):
            found = self._longest(paths, segments)
            if found:
                return found
        return None, None

    @staticmethod
    def _longest(node: dict, segments: list[str]) -> tuple[str, str] | None:
        best = None
        for segment in segments:
            tails = node.get(None)
            if tails:
                fits = [tail for tail in tails if segment.startswith(tail)]
                if fits:
                    best = tails[max(fits, key=len)]
            node = node.get(segment)
            if node is None:
                break
        return best


def judge_urls(pages: DataFrame, rules: Iterable[tuple[str, str]], default: str = "allow",
               url: str = "url", keep: tuple[str, ...] = ()) -> DataFrame:
    """Host, path, the deciding rule and the verdict for every row, beside the columns ``keep``.

    A url that is null, empty or without ``://`` has an empty host and path, fits only rules
    without a host, and else gets ``default`` with a null rule. Repeated rows are judged alike.
    """
    trie = pages.sparkSession.sparkContext.broadcast(UrlTrie(rules))
    kinds = dict(pages.dtypes)
    clash = {"host", "path", "rule", "verdict"} & set(keep)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are taken")
    schema = ", ".join([*(f"`{name}` {kinds[name]}" for name in keep),
                        "host string, path string, rule string, verdict string"])

    def judge(batch: pa.RecordBatch) -> dict:
        parts = [split_url(x) for x in column(batch, "__url").to_pylist()]
        found = [trie.value.find(*x) for x in parts]
        return {**{name: column(batch, name) for name in keep},
                "host": [x[0] for x in parts], "path": [x[1] for x in parts],
                "rule": [x[0] for x in found], "verdict": [x[1] or default for x in found]}

    return arrow_map(pages.select(*keep, F.col(url).cast("string").alias("__url")), schema, judge)
