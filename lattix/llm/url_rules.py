"""URL filters: a sorted sweep of URLs over nested host rules."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lattix.llm.batches import mapped

#: Between the reversed labels of a host; sorts below every character that a host may hold.
_STOP = "\x01"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rules up to this many, and up to this many characters, are sent to all tasks.
BROADCAST_RULES, BROADCAST_CHARS = 200_000, 16_000_000

PRODUCTION_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host with A-Z in lower case, and path; both empty without ``://`` or for null."""
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    known = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(known, shape, 1), _UPPER, _LOWER), F.regexp_extract(known, shape, 2)


def host_key(host: Column) -> Column:
    """Labels from last to first, each closed by a stop: a host's subdomains are the keys that begin with its own."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), _STOP), F.lit(_STOP))


class _HostRules:
    """The path rules of one host; the longest path that a given path starts with."""

    def __init__(self, host: str, rules: list[tuple[str, str]]):
        self.host, self.key = host, _STOP.join(reversed(host.split("."))) + _STOP
        self.verdicts = dict(rules)
        self.lengths = sorted({len(p) for p in self.verdicts}, reverse=True)

    def longest(self, path: str) -> str | None:
        return next((path[:n] for n in self.lengths if path[:n] in self.verdicts), None)


class _Sweep:
    """Hosts in ascending order of key against rules in the same order; a stack holds the rules around the key."""

    def __init__(self, rules: list[tuple[str, str, str]]):
        by_host: dict[str, list[tuple[str, str]]] = {}
        for host, path, verdict in rules:
            by_host.setdefault(host, []).append((path, verdict))
        self.rules = sorted((_HostRules(h, r) for h, r in by_host.items()), key=lambda r: r.key)
        self.keys = [r.key for r in self.rules]
        self.by_key = {r.key: r for r in self.rules}
        self.stack: list[_HostRules] = []
        self.next = -1
        self.at: str | None = None

    def move(self, key: str) -> None:
        if key == self.at:
            return
        self.at = key
        if self.next < 0:  # a partition starts amid the order: the rules around its first key are prefixes of it
            parts = key.split(_STOP)[:-1]
            chain = (_STOP.join(parts[:n]) + _STOP for n in range(1, len(parts) + 1))
            self.stack = [self.by_key[k] for k in chain if k in self.by_key]
            self.next = bisect_right(self.keys, key)
            return
        while self.next < len(self.rules) and self.keys[self.next] <= key:
            rule = self.rules[self.next]
            self._leave(rule.key)
            self.stack.append(rule)
            self.next += 1
        self._leave(key)

    def _leave(self, key: str) -> None:
        while self.stack and not key.startswith(self.stack[-1].key):
            self.stack.pop()

    def judge(self, host: str, path: str) -> tuple[str | None, str | None]:
        best, verdict = None, None
        for rule in reversed(self.stack):  # longer hosts first: they win among rules of one length
            fits = rule.longest(path) if host == rule.host or host.endswith("." + rule.host) else None
            if fits is not None and (best is None or len(rule.host) + len(fits) > len(best)):
                best, verdict = rule.host + fits, rule.verdicts[fits]
        return best, verdict


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per page: id, host, path, the longest rule that fits and its verdict.

    ``rules`` has host, path and verdict; a rule fits its host and all subdomains where the path starts with its own;
    of several, the one with most characters wins, among those the one with the longer host. Pages are dealt by range
    of their key and, within a hot host, by id, so that no host has to fit one task. Each task sweeps its sorted pages
    over the sorted rules; those are broadcast after their size was checked, and beyond the bound pages meet them in
    a shuffled join on host suffixes. A null or malformed URL has an empty host and path and gets ``default``; repeated rows
    are judged each; other columns are not read; an empty table gives an empty result. Rules repeated for one host
    and path must agree.
    """
    spark = pages.sparkSession
    host, path = url_parts(F.col(url_col))
    keyed = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    size = rules.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("host") + F.length("path")), F.lit(0)).alias("chars")).first()
    if size["n"] > BROADCAST_RULES or size["chars"] > BROADCAST_CHARS:
        return _by_suffix_join(keyed, rules, default)
    sent = spark.sparkContext.broadcast([tuple(r) for r in rules.select("host", "path", "verdict").distinct().collect()])
    ordered = keyed.withColumn("key", host_key(F.col("host"))).repartitionByRange("key", "page_id").sortWithinPartitions("key")

    def swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sweep = _Sweep(sent.value)
        for batch in batches:
            found = []
            for key, host, path in zip(batch["key"].to_pylist(), batch["host"].to_pylist(), batch["path"].to_pylist(), strict=True):
                sweep.move(key)
                found.append(sweep.judge(host, path))
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["host"], batch["path"], pa.array([r for r, _ in found], pa.string()), pa.array([v or default for _, v in found], pa.string())],
                ["page_id", "host", "path", "rule", "verdict"],
            )

    return mapped(ordered, swept, f"page_id {keyed.schema['page_id'].dataType.simpleString()}, host string, path string, rule string, verdict string")


def _by_suffix_join(keyed: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """The same rows for rule lists of any size: only distinct (host, path) pairs meet the rules, by equal host suffix."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(F.slice(labels, n, F.size(labels)), "."))
    pairs = keyed.select("host", "path").distinct()
    own = rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict")).distinct()
    rank = F.struct(F.length("rule_host") + F.length("rule_path"), F.length("rule_host"))
    best = (
        pairs.withColumn("rule_host", F.explode(suffixes)).join(own, "rule_host").where(F.col("path").startswith(F.col("rule_path")))
        .groupBy("host", "path").agg(F.max_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), F.col("rule_verdict").alias("verdict")), rank).alias("best"))
    )
    return keyed.join(best, ["host", "path"], "left").select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(PRODUCTION_RULES, "host string, path string, verdict string")
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules)


OP1_SQL = r"""
WITH rules(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
parts AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path
  FROM pages)
SELECT p.page_id, p.host, p.path,
  (SELECT r.host || r.path FROM rules r WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
   ORDER BY length(r.host || r.path) DESC LIMIT 1) AS rule,
  coalesce((SELECT r.verdict FROM rules r WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
   ORDER BY length(r.host || r.path) DESC LIMIT 1), 'allow') AS verdict
FROM parts p
"""
