"""URL filters: a trie over reversed host labels, then path segments, with the longest match.

A rule names a host and a path. It fits that host and all its subdomains, if the path of the URL
starts with the path of the rule. Rules meet in one trie: from the root along the host labels from
the last to the first, and from the node of a host along the path segments; the last segment of a
rule's path is kept at its node as a prefix. A URL follows its own labels and segments and takes
the verdict of the longest rule it meets: the one with most host labels, then the longest path.

The trie is broadcast with the function. It holds at most ``TRIE_RULES`` rules; more rules are
cut into several tries that pass over the data one after the other, each leaving the longest rule
so far, so a broadcast stays bounded and the result is the same.

Defined results: a null URL and one without ``://`` have an empty host and path and the default
verdict; if a rule is listed as allow and as block, block wins; repeated rules and rows are fine;
URLs of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRIE_RULES = 200_000
BIG = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
Rule = tuple[str, str]  # "allow" or "block", and host with path, like "example.net/en/"


def host(url: Column) -> Column:
    """After the first ``://`` up to a slash, question mark, hash or the end, A-Z lowered."""
    found = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(found, BIG, BIG.lower())


def path(url: Column) -> Column:
    """After the host up to a question mark, hash or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


class Trie:
    """Nodes are dicts of children; a host's node keeps its path trie under ``PATHS``."""

    PATHS, TAILS = ("paths",), ("tails",)

    def __init__(self, rules: Sequence[Rule]):
        self.root: dict = {}
        for verdict, text in rules:
            if verdict not in ("allow", "block"):
                raise ValueError(f"verdict {verdict!r} of rule {text!r} is neither allow nor block")
            name, slash, rest = text.partition("/")
            if not name:
                raise ValueError(f"rule {text!r} names no host")
            node = self.root
            for label in reversed(name.lower().split(".")):
                node = node.setdefault(label, {})
            node = node.setdefault(self.PATHS, {})
            *whole, tail = (slash + rest).split("/")
            for segment in whole:
                node = node.setdefault(segment, {})
            tails = node.setdefault(self.TAILS, {})
            if tails.get(tail, ("",))[0] != "block":
                tails[tail] = (verdict, text)

    def longest(self, name: str, rest: str) -> tuple[str, str] | None:
        """The verdict and text of the longest rule that fits a host and path."""
        best, node = None, self.root
        segments = rest.split("/")
        for label in reversed(name.split(".")):
            node = node.get(label)
            if node is None:
                break
            best = self._in_paths(node.get(self.PATHS), segments) or best
        return best

    def _in_paths(self, node: dict | None, segments: list[str]) -> tuple[str, str] | None:
        best = None
        for segment in segments:
            if node is None:
                break
            tails = node.get(self.TAILS)
            if tails:
                fits = [t for t in tails if segment.startswith(t)]
                best = tails[max(fits, key=len)] if fits else best
            node = node.get(segment)
        return best


def _rank(rule: str | None) -> tuple[int, int]:
    name, slash, rest = (rule or "").partition("/")
    return (name.count(".") + bool(name), len(slash + rest))


def verdicts(pages: DataFrame, rules: Sequence[Rule], default: str = "allow") -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of every row's ``url``."""
    block_last = sorted(set(rules), key=lambda r: (r[1], r[0]))
    tries = [
        Trie(block_last[i : i + TRIE_RULES]) for i in range(0, len(block_last), TRIE_RULES)
    ] or [Trie(())]
    out = pages.select(
        "page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"),
        F.lit(None).cast("struct<rule:string,verdict:string>").alias("found"),
    )
    for trie in tries:
        out = out.withColumn("found", _match(trie)("host", "path", "found.rule", "found.verdict"))
    return out.select(
        "page_id", "host", "path", "found.rule",
        F.coalesce("found.verdict", F.lit(default)).alias("verdict"),
    )


def _match(trie: Trie):
    @F.pandas_udf("rule string, verdict string")
    def match(hosts: pd.Series, paths: pd.Series, rules: pd.Series, before: pd.Series) -> pd.DataFrame:
        found = []
        for name, rest, rule, verdict in zip(hosts, paths, rules, before, strict=True):
            hit = trie.longest(name, rest)
            if hit is None or (rule is not None and _rank(rule) >= _rank(hit[1])):
                found.append((rule, verdict))
            else:
                found.append((hit[1], hit[0]))
        return pd.DataFrame(found, columns=["rule", "verdict"], dtype=object)

    return match
