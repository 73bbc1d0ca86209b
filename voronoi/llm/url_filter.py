"""URL filtering by a cascade of Bloom filters, with DataFrame functions only.

A rule is a host and a path prefix, ``example.com/en/``. The keys of a url are all its rule candidates: each suffix of its host, joined
with the start of its path at each length a rule's path has. Level 1 of the cascade encodes the listed keys, level 2 the keys of
the corpus that pass level 1 without being listed, level 3 the listed keys that pass level 2, and so on until a level passes
nothing wrongly. A key of the corpus is listed exactly if the first level that rejects it is an even one, so that urls are judged
row by row, without a join.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable

#: False-positive rates: the first level meets the whole universe of keys, the later ones few keys.
FIRST_RATE, NEXT_RATE = 0.01, 0.3
#: The list's bound: its keys, and a few bits for each in the levels, travel with the query as constants.
MAX_RULES = 200_000
MAX_LEVELS = 64


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there up to ``?``, ``#`` or the end."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def candidates(host: Column, path: Column, path_lengths: list[int]) -> Column:
    """The keys of a url, the longest host first and for each host the longest path first."""
    labels = F.split(host, r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    starts = F.filter(F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in sorted(path_lengths, reverse=True)]), lambda s: s.isNotNull())
    return F.when(host != "", F.flatten(F.transform(suffixes, lambda s: F.transform(starts, lambda p: F.concat(s, p))))).otherwise(F.array().cast("array<string>"))


class Level:
    """One Bloom filter: its bits as a constant, probed by two hashes of the key."""

    def __init__(self, bits: bytes, m: int, k: int, salt: int):
        self.bits, self.m, self.k, self.salt = bits, m, k, salt

    @staticmethod
    def places(key: Column, m: int, k: int, salt: int) -> list[Column]:
        a, b = F.xxhash64(key, F.lit(2 * salt)), F.xxhash64(key, F.lit(2 * salt + 1))
        return [F.pmod(a.bitwiseXOR(F.shiftleft(b, i % 64)) if i else a, F.lit(m).cast("long")) for i in range(k)]

    @classmethod
    def of(cls, keys: DataFrame, n: int, rate: float, salt: int) -> Level:
        m = max(64, 8 * math.ceil(n * -math.log(rate) / math.log(2) ** 2 / 8))
        k = max(1, round(m / n * math.log(2)))
        words = (
            keys.select(F.explode(F.array(*cls.places(F.col("key"), m, k, salt))).alias("at"))
            .groupBy((F.col("at") / 8).cast("long").alias("byte")).agg(F.bit_or(F.expr("shiftleft(1, cast(at % 8 as int))")).alias("v"))
        )
        out = bytearray(m // 8)
        for byte, v in words.collect():  # as many rows at most as the level has bytes
            out[byte] = v
        return cls(bytes(out), m, k, salt)

    def has(self, key: Column) -> Column:
        found = None
        for at in self.places(key, self.m, self.k, self.salt):
            byte = F.conv(F.hex(F.substring(F.lit(self.bits), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
            bit = F.bit_get(byte, (at % 8).cast("int")) == 1
            found = bit if found is None else found & bit
        return found


class Cascade:
    """Exact membership of the corpus's keys in a list."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    def listed(self, key: Column) -> Column:
        """Whether a key of the universe is listed: the number of levels passed in a row is odd."""
        out = F.lit(len(self.levels) % 2 == 1)
        for i in range(len(self.levels) - 1, -1, -1):
            out = F.when(self.levels[i].has(key), out).otherwise(F.lit(i % 2 == 1))
        return out if self.levels else F.lit(False)

    @classmethod
    def build(cls, listed: DataFrame, universe: DataFrame, first_rate: float = FIRST_RATE, next_rate: float = NEXT_RATE) -> Cascade:
        """``listed`` and ``universe`` have a column key; the universe may repeat keys, and needs no listed ones."""
        listed = listed.select("key").distinct()
        n = listed.count()
        if n > MAX_RULES:
            raise ValueError(f"{n} listed keys; the cascade travels as a constant and takes {MAX_RULES} at most")
        levels: list[Level] = []
        inside, outside = listed, None
        while n and len(levels) < MAX_LEVELS:
            level = Level.of(inside, n, next_rate if levels else first_rate, len(levels))
            levels.append(level)
            if outside is None:  # the one pass over the universe; few keys are left of it
                outside = durable(universe.select("key").where(level.has(F.col("key"))).distinct().join(F.broadcast(listed), "key", "left_anti"))
                passed = outside
            else:
                passed = durable(outside.where(level.has(F.col("key"))))
            inside, outside, n = passed, inside, passed.count()
        if n:
            raise ValueError("the cascade does not end")
        return cls(levels)


def rule_table(spark, rules: list[tuple[str, str]]) -> tuple[DataFrame, list[int], dict[str, str]]:
    """(listed keys, lengths of the rules' paths, verdict by key) of rules (verdict, host/path)."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; {MAX_RULES} at most")
    verdicts = {rule: verdict for verdict, rule in rules}
    lengths = sorted({len(rule) - rule.index("/") for rule in verdicts})
    return spark.createDataFrame([(r,) for r in verdicts], "key string"), lengths, verdicts


def judge(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per row: page_id, host, path, rule (the longest that fits, else null), verdict (the rule's, else ``default``).

    A rule fits its host and all its subdomains where the url's path starts with the rule's. Null urls and urls without ``://`` have an
    empty host and path, which no rule fits."""
    host, path = host_and_path(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    listed, lengths, verdicts = rule_table(pages.sparkSession, rules)
    keys = candidates(F.col("host"), F.col("path"), lengths or [1])
    cascade = Cascade.build(listed, urls.select(F.explode(keys).alias("key")))
    hits = F.filter(F.col("keys"), lambda k: cascade.listed(k))
    # of the fitting rules the longest; two of one length can't fit the same url unless they are equal
    longest = F.reduce("hits", F.lit(None).cast("string"), lambda best, k: F.when(best.isNull() | (F.length(k) > F.length(best)), k).otherwise(best))
    blocked = sorted(r for r, v in verdicts.items() if v != default)
    other = {v for r, v in verdicts.items() if v != default}
    verdict = F.lit(default)
    for v in sorted(other):
        verdict = F.when(F.col("rule").isin([r for r in blocked if verdicts[r] == v]), v).otherwise(verdict)
    return (
        urls.withColumn("keys", keys).withColumn("hits", hits).withColumn("rule", longest)
        .select("page_id", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "rule", verdict.alias("verdict"))
    )


RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]

SQL = """
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's') AS path FROM u),
r(verdict, rhost, rpath) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
m AS (SELECT h.page_id, h.host, h.path, r.*, row_number() OVER (PARTITION BY h.page_id, h.host, h.path ORDER BY length(rhost || rpath) DESC NULLS LAST) AS n
      FROM h LEFT JOIN r ON (h.host = rhost OR ends_with(h.host, '.' || rhost)) AND starts_with(h.path, rpath))
SELECT page_id, host, path, rhost || rpath AS rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE n = 1
"""
