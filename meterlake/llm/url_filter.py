"""URL filter: a trie over reversed host labels and path segments, broadcast to the tasks.

A rule ``(verdict, host, path)`` fits a URL whose host is the rule's host or a subdomain of it and
whose path starts with the rule's path. The rule with the most host labels wins, then the one with
the longest path; of two equal rules ``block`` wins.

Cases: a null URL or one without ``://`` has empty host and path; a URL without a path fits only
rules with an empty path; no fitting rule gives a null rule and the default verdict; repeated rows
are judged one by one; an empty table or rule list gives an empty or all-default result; input
columns other than the id and the URL are not read.
"""
from __future__ import annotations

import string
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table

BROADCAST_RULES = 200_000


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = ""

    @property
    def name(self) -> str:
        return self.host + self.path


class RuleTrie:
    """Nodes are dictionaries: host labels from the right, then under ``/`` complete path segments.
    A node keeps the rules that end there, with the rest of their last segment."""

    def __init__(self, rules: Iterable[Rule]):
        self.root: dict = {}
        for rule in sorted(rules, key=lambda r: r.verdict == "block"):  # a block entry overwrites its equal
            node = self.root
            for label in reversed(rule.host.split(".")):
                node = node.setdefault(("host", label), {})
            if rule.path:
                *whole, last = rule.path.split("/")
                for segment in whole:
                    node = node.setdefault(("path", segment), {})
            else:
                last = ""
            node.setdefault("ends", {})[last] = rule

    def longest(self, host: str, path: str) -> Rule | None:
        best, node, labels = None, self.root, host.split(".")
        for label in reversed(labels):
            node = node.get(("host", label))
            if node is None:
                break
            best = self._in_path(node, path) or best  # more labels win over any path
        return best

    @staticmethod
    def _in_path(node: dict, path: str) -> Rule | None:
        best, rest = None, path
        while node is not None:
            for end in sorted(node.get("ends", ()), key=len):
                if rest.startswith(end):
                    best = node["ends"][end]
            segment, slash, rest = rest.partition("/")
            node = node.get(("path", segment)) if slash else None
        return best


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_verdicts(pages: DataFrame, rules: list[Rule], *, id_col: str = "page_id", url_col: str = "url",
                 default: str = "allow", broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """``id, host, path, rule, verdict`` for every row of ``pages``. Up to ``broadcast_rules`` rules
    travel as a broadcast trie; a longer list is joined instead (:func:`joined_verdicts`)."""
    rows = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    if len(rules) > broadcast_rules:
        return joined_verdicts(rows, rules, default)
    trie = pages.sparkSession.sparkContext.broadcast(RuleTrie(rules))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [trie.value.longest(h, p) for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([r and r.name for r in found], pa.string()),
                 pa.array([r.verdict if r else default for r in found], pa.string())],
                names=[id_col, "host", "path", "rule", "verdict"])

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(judge, f"`{id_col}` {kind}, host string, path string, rule string, verdict string")


def joined_verdicts(rows: DataFrame, rules: list[Rule], default: str = "allow") -> DataFrame:
    """The same for rule lists too long to broadcast: every distinct (host, path) meets the rules of
    its host suffixes in a shuffle join and keeps the longest."""
    spark = rows.sparkSession
    listed = spark.createDataFrame([(r.host, r.path, r.name, r.verdict) for r in rules],
                                   "suffix string, prefix string, rule string, judged string")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    rank = F.struct(F.size(F.split("suffix", r"\.")), F.length("prefix"), (F.col("judged") == "block").cast("int"))
    best = (rows.select("host", "path").distinct().withColumn("suffix", F.explode(suffixes))
            .join(listed.hint("shuffle_hash"), "suffix").filter(F.expr("startswith(path, prefix)"))
            .groupBy("host", "path").agg(F.max_by(F.struct("rule", "judged"), rank).alias("found")))
    return (rows.join(best, ["host", "path"], "left")
            .select(rows.columns[0], "host", "path", F.col("found.rule").alias("rule"),
                    F.coalesce("found.judged", F.lit(default)).alias("verdict")))


RULES = [Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"),
         Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/")]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(read_table(spark, sf_dir, "pages"), RULES)


SQL = r"""
WITH split AS (
  SELECT page_id, url, strpos(url, '://') AS sep FROM pages
), parts AS (
  SELECT page_id,
    CASE WHEN sep > 0 THEN translate(regexp_extract(substr(url, sep + 3), '^[^/?#]*'),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN sep > 0 THEN regexp_extract(substr(url, sep + 3), '(?s)^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM split
), rules(verdict, rhost, rpath) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), fits AS (
  SELECT page_id, rhost || rpath AS rule, verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY len(string_split(rhost, '.')) DESC, length(rpath) DESC) AS nth
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON f.page_id = p.page_id AND f.nth = 1
"""
