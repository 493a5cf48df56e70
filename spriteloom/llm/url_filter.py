"""URL allow and block lists: a trie over reversed host labels and path segments.

The rules are compiled into one trie, keyed first by host labels from the top
level domain down and then by path segments, and broadcast.  A rule fits its
host and every subdomain of it, if the url's path starts with the rule's path;
of the rules that fit, the one with the most host labels, then with the
longest path, decides, and block beats allow on a tie.

Only lists of at most ``max_broadcast_rules`` are broadcast.  Longer ones take
an equi-join instead: every url asks for its host suffixes, and only rules of
these hosts are compared.

Cases: a null url, or one without ``://``, has an empty host and path; it fits
no rule and gets the default verdict; so does an empty one.  Repeated rows are
judged alike; urls of any length are read as a whole; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import UPPER, LOWER, lower_ascii

#: (action, host, path)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
MAX_BROADCAST_RULES = 200_000
_DOWN = str.maketrans(UPPER, LOWER)
_OUT = "host string, path string, rule string, verdict string"


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path of a url, by the first ``://`` and the first of ``/?#`` after it."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    ends = [i for i in (rest.find(c) for c in "/?#") if i >= 0]
    at = min(ends, default=len(rest))
    tail = rest[at:]
    for c in "?#":
        tail = tail.partition(c)[0]
    return rest[:at].translate(_DOWN), tail


def _pieces(path: str) -> list[str]:
    """Path segments, each with the slash that ends it: ``/en/7`` is ``/ en/ 7``."""
    parts = path.split("/")
    return [p + "/" for p in parts[:-1]] + ([parts[-1]] if parts[-1] else [])


class HostTrie:
    """Nodes are dicts: host labels under their own names, the path trie under ``""``."""

    def __init__(self, rules: Iterable[tuple[str, str, str]] = ()):
        self.root: dict = {}
        for action, host, path in rules:
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault(label, {})
            node = node.setdefault("", {})
            pieces = _pieces(path)
            rest = "" if not pieces or pieces[-1].endswith("/") else pieces.pop()
            for piece in pieces:
                node = node.setdefault(piece, {})
            ends = node.setdefault(None, {})  # what the next segment must start with: its rule
            if ends.get(rest, ("allow",))[0] != "block":
                ends[rest] = (action, host + path)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        best, node, pieces = None, self.root, _pieces(path)
        for label in reversed(host.split(".")):
            node = node.get(label) if label else None
            if node is None:
                break
            best = self._longest(node.get(""), pieces) or best
        return best

    @staticmethod
    def _longest(node: dict | None, pieces: list[str]) -> tuple[str, str] | None:
        best = None
        for piece in [*pieces, ""]:
            if node is None:
                break
            fits = [rest for rest in node.get(None, ()) if piece.startswith(rest)]
            if fits:
                best = node[None][max(fits, key=len)]
            node = node.get(piece)
        return best


def _by_trie(pages: DataFrame, rules: list, id_col: str, url_col: str, default: str) -> DataFrame:
    trie = pages.sparkSession.sparkContext.broadcast(HostTrie(rules))

    @F.pandas_udf(_OUT)
    def judge(urls: pd.Series) -> pd.DataFrame:
        rows = []
        for url in urls:
            host, path = split_url(url)
            found = trie.value.find(host, path)
            rows.append((host, path, found and found[1], found[0] if found else default))
        return pd.DataFrame(rows, columns=["host", "path", "rule", "verdict"], dtype=object)

    return pages.select(F.col(id_col), judge(F.col(url_col)).alias("found")).select(id_col, "found.*")


def _by_join(pages: DataFrame, rules: DataFrame, id_col: str, url_col: str, default: str) -> DataFrame:
    """For lists beyond the broadcast bound; ``rules`` has action, host and path."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    host = lower_ascii(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1))
    path = F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)
    rows = pages.select(F.col(id_col), host.alias("host"), path.alias("path")).withColumn("row_no", F.monotonically_increasing_id())
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    asked = rows.select("row_no", "path", F.explode(suffixes).alias("rule_host"))
    fits = asked.join(
        rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "action"), "rule_host"
    ).where(F.col("path").startswith(F.col("rule_path")))
    rank = F.struct(F.size(F.split("rule_host", r"\.", -1)), F.length("rule_path"), F.col("action") == "block")
    best = fits.groupBy("row_no").agg(F.max_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), "action"), rank).alias("best"))
    return rows.join(best, "row_no", "left").select(
        id_col, "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict")
    )


def url_filter(
    pages: DataFrame,
    rules: Iterable[tuple[str, str, str]] | DataFrame = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    max_broadcast_rules: int = MAX_BROADCAST_RULES,
) -> DataFrame:
    """One row per page: its id, host, path, the deciding rule (or null) and the verdict."""
    if isinstance(rules, DataFrame):
        few = rules.select("action", "host", "path").limit(max_broadcast_rules + 1).collect()
        if len(few) > max_broadcast_rules:
            return _by_join(pages, rules, id_col, url_col, default)
        rules = [tuple(r) for r in few]
    rules = list(rules)
    if len(rules) > max_broadcast_rules:
        raise ValueError("give long rule lists as a DataFrame (action, host, path)")
    return _by_trie(pages, rules, id_col, url_col, default)


OP3_SQL = r"""
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url FROM pages),
p AS (
  SELECT page_id,
         translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
  FROM u),
r(action, rule_host, rule_path) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
best AS (
  SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(action, length(rule_host || rule_path)) AS action
  FROM p JOIN r ON (host = rule_host OR host LIKE '%.' || rule_host) AND starts_with(path, rule_path)
  GROUP BY page_id)
SELECT p.page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM p LEFT JOIN best ON p.page_id = best.page_id
"""
