"""URL rules applied by a sort-merge range join of hosts.

A host's labels, reversed and each closed by a separator, make a canonical key in which a
rule's host and all its subdomains are one interval of keys. Rules and urls are dealt to
ranges of keys; a rule goes to every range that its interval meets, so that neither side is
broadcast and any number of rules will do. In a range both are sorted, and one sweep keeps
the stack of the rules whose intervals are open: nested, since key intervals are. Of each open
host the path finds its rule by lookups, one for each length that the host's rules have, so
their number doesn't matter; the longest rule wins.

Verdict: that of the winning rule; without one, `allow`.

Defined results: a null url, or one without `://`, has an empty host and path and no rule;
of several rules with the same host and path the first in (verdict, order) wins; repeated
rows are judged one by one; an empty table, or no rules, does no harm; a rule longer than
another wins by its length in characters, host and path together, then by host.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import small_batches

#: Less than any character of a label that a key keeps apart, and more than all of them.
CLOSE, BEYOND = "\x01", "\U0010ffff"
#: The rules of the registered query (host, path, verdict).
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
DEFAULT = "allow"
#: Keys that are looked at to choose ranges; ranges are for balance only.
SAMPLED = 4000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """com, example, www for www.example.com, each label closed."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), CLOSE), F.lit(CLOSE)))


def rule_table(spark: SparkSession, rules) -> DataFrame:
    rows = [(k, h, p, v) for k, (h, p, v) in enumerate(rules)]
    return spark.createDataFrame(rows, "ord int, host string, path string, verdict string")


def _ranges(urls: DataFrame, ranges: int) -> list[tuple[str, int]]:
    """Bounds (key, spread) between ranges, from a sample of about SAMPLED keys; a hot key is parted by spread."""
    n = urls.count()
    sample = urls if n <= SAMPLED else urls.sample(min(1.0, SAMPLED / n), 11)
    keys = sorted((r.key, r.spread) for r in sample.select("key", "spread").limit(4 * SAMPLED).collect())
    return sorted({keys[k * len(keys) // ranges] for k in range(1, ranges)}) if keys else []


class _Open:
    """The rules of one host whose interval is open, by path; a url looks up its path's beginnings of the lengths that they have."""

    def __init__(self, key: str) -> None:
        self.key, self.rules, self.lengths = key, {}, []

    def add(self, rule: tuple) -> None:
        path = rule[4]
        if len(path) not in self.lengths:
            bisect.insort(self.lengths, len(path))
        self.rules[path] = min(rule, self.rules.get(path, rule))

    def longest(self, path: str) -> tuple | None:
        """The rule with the longest path that begins this one; the host is the same for all."""
        for n in reversed(self.lengths[: bisect.bisect_right(self.lengths, len(path))]):
            if found := self.rules.get(path[:n]):
                return found
        return None


def judge_urls(urls: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = DEFAULT, ranges: int | None = None) -> DataFrame:
    """(key, host, path, rule, verdict) of every row; rules has ord, host, path and verdict."""
    spark = urls.sparkSession
    small_batches(spark, 5000)
    ranges = ranges or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    kind = urls.schema[key].dataType.simpleString()
    address = F.col(f"`{url}`")
    hosted = urls.select(F.col(f"`{key}`").alias("id"), host_of(address).alias("host"), path_of(address).alias("path"))
    keyed = hosted.select("id", "host", "path", host_key(F.col("host")).alias("key"), F.xxhash64("id", "path").alias("spread"))
    bounds = _ranges(keyed, ranges)

    def dealt(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [bisect.bisect_right(bounds, pair) for pair in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *batch.columns[:4]], names=["range", "id", "host", "path", "key"])

    placed = keyed.mapInArrow(dealt, f"range int, id {kind}, host string, path string, key string")
    rule = rules.select("ord", "host", "path", "verdict", host_key(F.translate("host", _UPPER, _LOWER)).alias("key"))

    def copied(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[] for _ in range(6)]
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                low, high = (row[4], -(1 << 63)), (row[4] + BEYOND, 1 << 63)
                for k in range(bisect.bisect_right(bounds, low), bisect.bisect_right(bounds, high) + 1):
                    for column, value in zip(out, (k, *row), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int32(), pa.int32(), *[pa.string()] * 4), strict=True)], names=["range", "ord", "host", "path", "verdict", "key"])

    spread = rule.mapInArrow(copied, "range int, ord int, host string, path string, verdict string, key string")
    left = spread.select("range", "key", F.lit(0).alias("side"), "ord", F.lit(None).cast(kind).alias("id"), "host", "path", "verdict")
    right = placed.select("range", "key", F.lit(1).alias("side"), F.lit(0).alias("ord"), "id", "host", "path", F.lit(None).cast("string").alias("verdict"))

    def sweep(batches) -> Iterator[pa.RecordBatch]:
        stack: list[_Open] = []
        now = None
        for batch in batches:
            ids, hosts, paths, named, verdicts = [], [], [], [], []
            for k, at, side, order, number, host, path, verdict in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != now:
                    now, stack = k, []
                while stack and not at.startswith(stack[-1].key):
                    stack.pop()
                if side == 0:
                    if not stack or stack[-1].key != at:
                        stack.append(_Open(at))
                    stack[-1].add((-len(host) - len(path), host, verdict, order, path))
                    continue
                fits = min((r for rules in stack if host and (r := rules.longest(path))), default=None)
                ids.append(number)
                hosts.append(host)
                paths.append(path)
                named.append(fits and fits[1] + fits[4])
                verdicts.append(fits[2] if fits else default)
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field("id").type), *(pa.array(c, pa.string()) for c in (hosts, paths, named, verdicts))], names=[key, "host", "path", "rule", "verdict"])

    both = left.unionByName(right).repartitionById(ranges, "range").sortWithinPartitions("range", "key", "side", "ord")
    return both.mapInArrow(sweep, f"`{key}` {kind}, host string, path string, rule string, verdict string")


#: The registered query in SQL: the first fitting rule, the longest first.
ORACLE = r"""
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '^[\s\S]*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^[\s\S]*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
rules(rhost, rpath, rverdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits AS (
  SELECT page_id, host, path, rhost || rpath AS rule, rverdict,
         row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rhost || rpath) DESC) AS place
  FROM parts JOIN rules ON (host = rhost OR suffix(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.rverdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON p.page_id = f.page_id AND p.host = f.host AND p.path = f.path AND f.place = 1
"""


def url_digest(pages: DataFrame) -> DataFrame:
    return judge_urls(pages, rule_table(pages.sparkSession, RULES))
