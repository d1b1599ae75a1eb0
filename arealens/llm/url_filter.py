"""URL filter: allow and block rules in one trie, longest match first.

A rule is a host and a path prefix.  The trie is keyed first by the host's
labels from the right (``org``, ``example``, ...), then by whole path
segments; the text after the rule path's last slash is a partial segment
kept at its node.  A look-up walks the host once and, below every host node
that carries rules, the path; the longest rule (host and path together) wins,
of rules as long as each other that of the longer host.  The trie is broadcast: its size is the rule list's,
which ``build`` bounds by ``max_rules``.

Defined cases: a null url or one without ``://`` has an empty host and path
and meets no rule; a url that no rule fits gets the verdict ``default``; a
host and path given both as allow and as block is blocked; empty rule lists
give every url the default.  Rows that repeat are judged one by one.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import ascii_lower, fresh_name

HERE = "\0"       # paths below this host node
PARTIAL = "\1"    # (partial segment, verdict, rule) at this path node


def build(rules, max_rules: int = 1_000_000) -> dict:
    """Nested dicts from ``(verdict, "host/path")`` rules."""
    rules = list(rules)
    if len(rules) > max_rules:
        raise ValueError(f"{len(rules)} rules; the broadcast trie holds at most {max_rules}")
    root: dict = {}
    for verdict, rule in rules:
        host, _, path = rule.partition("/")
        node = root
        for label in reversed(host.lower().split(".")):
            node = node.setdefault(label, {})
        node = node.setdefault(HERE, {})
        *whole, rest = f"/{path}".split("/")
        for segment in whole:
            node = node.setdefault(f"/{segment}", {})
        ends = node.setdefault(PARTIAL, {})
        if ends.get(rest, ("",))[0] != "block":
            ends[rest] = (verdict, f"{host}/{path}")
    return root


def match(root: dict, host: str, path: str) -> tuple[str, str] | None:
    """(verdict, rule) of the longest rule that fits, or None."""
    best = None
    node = root
    for label in reversed(host.split(".")):
        node = node.get(label)
        if node is None:
            break
        if HERE in node:
            found = _path(node[HERE], path)
            if found and (best is None or len(found[1]) >= len(best[1])):
                best = found
    return best


def _path(node: dict, path: str) -> tuple[str, str] | None:
    best = None
    for segment in path.split("/"):
        ends = node.get(PARTIAL)
        if ends:
            for k in range(len(segment), -1, -1):
                if segment[:k] in ends:
                    best = ends[segment[:k]]
                    break
        node = node.get(f"/{segment}")
        if node is None:
            break
    return best


def parts(url):
    """Host and path columns of a url column (empty without ``://``)."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(url, "://", 1))
    after = F.when(rest.isNull(), "").otherwise(F.substr(url, F.length(rest) + 4))
    host = F.regexp_extract(after, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def judge(pages: DataFrame, rules, *, url_col: str = "url", default: str = "allow") -> DataFrame:
    """Every input column plus ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``."""
    names = [fresh_name(pages, c) for c in ("host", "path", "rule", "verdict")]
    host, path = parts(F.col(url_col))
    split = pages.withColumns({names[0]: host, names[1]: path})
    trie = pages.sparkSession.sparkContext.broadcast(build(rules))

    @F.arrow_udf("struct<rule: string, verdict: string>")
    def looked_up(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        got = [match(trie.value, h, p) for h, p in zip(hosts.to_pylist(), paths.to_pylist())]
        return pa.StructArray.from_arrays(
            [pa.array([g and g[1] for g in got], pa.string()),
             pa.array([g[0] if g else default for g in got], pa.string())], names=["rule", "verdict"])

    got = fresh_name(split, "_looked_up")
    return (split.withColumn(got, looked_up(F.col(names[0]), F.col(names[1])))
            .withColumns({names[2]: F.col(got)["rule"], names[3]: F.col(got)["verdict"]}).drop(got))
