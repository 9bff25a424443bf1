"""URL rules in a trie over reversed host labels, then path segments.

A rule is (action, host, path prefix). It fits its host and every subdomain of
it, if the url's path starts with the rule's path. Of the rules that fit, the
longest (host and path together) decides; of equally long ones the one with
the longer host, and block before allow if both lists hold the same rule. A
url that no rule fits gets the default verdict.

The trie is built once on the driver and broadcast, which is allowed up to
``MAX_TRIE_BYTES`` of rule text. Longer lists are joined instead: each host
suffix with the rules for it (``judge_by_join``); the verdicts are the same.

Defined cases: a null url, or one without ``://``, has an empty host and path,
which no rule fits; ports, user names and trailing dots belong to the host as
they stand; an empty path starts with no rule's ``/``; a repeated row gets a
repeated verdict; without rules every url gets the default; columns other than
id and url play no part.
"""

from __future__ import annotations

from bisect import insort
from collections.abc import Iterable, Iterator
from functools import lru_cache
from operator import neg

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Rule = tuple[str, str, str]
#: a node takes some 400 bytes in each Python worker
MAX_TRIE_NODES = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


class Node:
    """A place in the trie. ``under`` leads on by host label, ``paths`` starts the
    path trie of the host that ends here, whose nodes lead on by whole segment.
    ``tails`` holds what rules end with after their last slash, ``lengths`` how long
    those are, longest first."""

    __slots__ = ("under", "paths", "tails", "lengths")

    def __init__(self):
        self.under: dict[str, Node] = {}
        self.paths: Node | None = None
        self.tails: dict[str, Rule] = {}
        self.lengths: list[int] = []


def build_trie(rules: Iterable[Rule]) -> Node:
    root = Node()
    for action, host, path in rules:
        node = root
        for label in reversed(host.split(".")):
            node = node.under.setdefault(label, Node())
        node.paths = node.paths or Node()
        node = node.paths
        *segments, tail = path.split("/")
        for segment in segments:
            node = node.under.setdefault(segment, Node())
        if node.tails.get(tail, ("allow",))[0] != "block":
            node.tails[tail] = (action, host, path)
        if len(tail) not in node.lengths:
            insort(node.lengths, len(tail), key=neg)
    return root


@lru_cache(maxsize=2)
def _trie(rules: tuple[Rule, ...]) -> Node:
    """Built once in each Python worker."""
    return build_trie(rules)


def _longest_path(node: Node, path: str) -> Rule | None:
    """The rule with the longest path under one host."""
    found = None
    segments = path.split("/")
    for i, segment in enumerate(segments):
        for end in node.lengths:
            if end <= len(segment) and segment[:end] in node.tails:
                found = node.tails[segment[:end]]
                break
        if i + 1 < len(segments) and segment in node.under:
            node = node.under[segment]
        else:
            break
    return found


def find_rule(root: Node, host: str, path: str) -> Rule | None:
    """The rule that decides, by one walk down the labels of the host."""
    best, node = None, root
    for label in reversed(host.split(".")):
        node = node.under.get(label)
        if node is None:
            break
        if node.paths is not None:
            rule = _longest_path(node.paths, path)
            # later ones have the longer host, so they win a tie
            if rule and (best is None or len(rule[1] + rule[2]) >= len(best[1] + best[2])):
                best = rule
    return best


def host_and_path(url: Column) -> tuple[Column, Column]:
    found = lambda group: F.coalesce(F.regexp_extract(url, _URL, group), F.lit(""))
    return F.translate(found(1), UPPER, LOWER), found(2)


def _parts(pages: DataFrame, id_col: str, url_col: str) -> DataFrame:
    host, path = host_and_path(pages[url_col])
    return pages.select(pages[id_col], host.alias("host"), path.alias("path"))


def judge_by_trie(
    pages: DataFrame, rules: list[Rule], default: str = "allow",
    id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    parts = _parts(pages, id_col, url_col)
    spark = pages.sparkSession
    trie = spark.sparkContext.broadcast(tuple(rules))  # nodes nest too deeply to pickle
    kind = parts.schema[id_col].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root = _trie(trie.value)
        for batch in batches:
            found = [
                find_rule(root, host, path)
                for host, path in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            ]
            names = [rule and rule[1] + rule[2] for rule in found]
            verdicts = [rule[0] if rule else default for rule in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(verdicts, pa.string())],
                [*batch.schema.names, "rule", "verdict"],
            )

    return parts.mapInArrow(
        judge, f"`{id_col}` {kind}, host string, path string, rule string, verdict string"
    )


def judge_by_join(
    pages: DataFrame, rules: DataFrame, default: str = "allow",
    id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """The same verdicts for rule lists beyond the broadcast bound. ``rules`` has
    columns action, host, path. Different (host, path) are judged once each."""
    parts = _parts(pages, id_col, url_col)
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    asked = parts.select("host", "path").distinct().withColumn("suffix", F.explode(suffixes))
    listed = rules.select(
        F.col("host").alias("suffix"), F.col("path").alias("prefix"), "action"
    ).groupBy("suffix", "prefix").agg(F.max("action").alias("action"))  # block after allow
    order = Window.partitionBy("host", "path").orderBy(
        F.desc(F.length("suffix") + F.length("prefix")), F.desc(F.length("suffix"))
    )
    best = (
        asked.join(listed, "suffix").filter(F.startswith("path", "prefix"))
        .withColumn("n", F.row_number().over(order)).filter("n = 1")
        .select(F.col("host").alias("h"), F.col("path").alias("p"),
                F.concat("suffix", "prefix").alias("rule"), "action")
    )
    return parts.join(
        best, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")), "left"
    ).select(
        id_col, "host", "path", "rule", F.coalesce("action", F.lit(default)).alias("verdict")
    )


def judge_urls(
    pages: DataFrame, rules: list[Rule], default: str = "allow",
    id_col: str = "page_id", url_col: str = "url", max_trie_nodes: int = MAX_TRIE_NODES,
) -> DataFrame:
    """Id, host, path, the rule that decides (null: none) and the verdict of every row."""
    nodes = sum(host.count(".") + path.count("/") + 2 for _, host, path in rules)
    if nodes <= max_trie_nodes:
        rules = [tuple(rule) for rule in rules]
        return judge_by_trie(pages, rules, default, id_col, url_col)
    listed = pages.sparkSession.createDataFrame(rules, "action string, host string, path string")
    return judge_by_join(pages, listed, default, id_col, url_col)
