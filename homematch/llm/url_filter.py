"""Exact URL rules and host lists without joins, by cascades of Bloom filters.

The key universe is every (host suffix, path prefix) that the corpus' urls can
match, and every host for a list of hosts. Level 0 of a cascade encodes the listed keys, level 1 the other keys of
the universe that level 0 lets through, level 2 the listed keys that level 1
lets through, and so on until nothing is left over. A key of the universe is
listed exactly if the first level that rejects it is an odd one (counted from
0), so membership is a few bit tests in the row, exact, and needs no join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from homematch.llm.common import ascii_lower
from homematch.session import saved

WORD_BITS = 64
DEEPEST = 60


@dataclass
class Level:
    """One Bloom filter: a written table of (word, bits) that readers get as one array in column ``name``."""

    name: str
    number: int
    bits: int
    hashes: int
    table: DataFrame

    def positions(self, key: Column) -> list[Column]:
        return bit_positions(key, self.number, self.bits, self.hashes)

    def words(self) -> Column:
        """All 64-bit words in order, worked out once for a plan and sent to its tasks."""
        every = self.table.sparkSession.range(self.bits // WORD_BITS).join(self.table, F.col("id") == F.col("word"), "left")
        held = every.agg(F.array_sort(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits")))).alias("w"))
        return held.select(F.col("w")["bits"].alias("w")).scalar()

    def has(self, key: Column) -> Column:
        tests = [F.bit_get(F.get(F.col(self.name), F.floor(p / WORD_BITS).cast("int")), F.pmod(p, F.lit(WORD_BITS)).cast("int")) == 1 for p in self.positions(key)]
        found = tests[0]
        for test in tests[1:]:
            found = found & test
        return found


def bit_positions(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(f"{level}:{i}"), key), F.lit(bits).cast("bigint")) for i in range(hashes)]


def filter_of(keys: DataFrame, name: str, number: int, count: int, miss_rate: float) -> Level:
    """Bloom filter of ``count`` keys with a chance of ``miss_rate`` to let another key through.

    Bits are set by an aggregation over 64-bit words, about 1.44
    log2(1/miss_rate) bits a key, and written.
    """
    hashes = max(1, round(math.log2(1 / miss_rate)))
    bits = WORD_BITS * max(1, math.ceil(1.45 * count * hashes / WORD_BITS))
    at = keys.select(F.explode(F.array(*bit_positions(F.col("key"), number, bits, hashes))).alias("p"))
    word = F.floor(F.col("p") / WORD_BITS).cast("int")
    held = at.select(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("p", F.lit(WORD_BITS)).cast("int")).alias("bit"))
    return Level(name, number, bits, hashes, saved(held.groupBy("word").agg(F.bit_or("bit").alias("bits")), "url-filter"))


def with_filters(df: DataFrame, levels: Sequence[Level]) -> DataFrame:
    """Adds the array of each level under its name."""
    for level in levels:
        df = df.withColumn(level.name, level.words())
    return df


def cascade(universe: DataFrame, name: str = "filter") -> list[Level]:
    """Levels for a frame of distinct ``key`` with boolean ``listed``; their columns start with ``name``.

    Level 0 lets about as many other keys through as are listed, each later
    level half of what the level before left, so the cascade's size follows the
    listed keys and the logarithm of the universe, not the universe.
    """
    listed, other = universe.where("listed").select("key"), universe.where("NOT listed").select("key")
    inside, outside = listed.count(), other.count()
    levels: list[Level] = []
    current, opposite, count = listed, other, inside
    rate = min(0.5, max(inside, 1) / max(outside, 1) / math.sqrt(2))
    while count:
        if len(levels) == DEEPEST:
            raise RuntimeError("the cascade does not end: is the universe distinct?")
        level = filter_of(current, f"{name}_{len(levels)}", len(levels), count, rate)
        levels.append(level)
        current, opposite = saved(with_filters(opposite, [level]).where(level.has(F.col("key"))).select("key"), "cascade"), current
        count, rate = current.count(), 0.5
    return levels


def is_listed(levels: Sequence[Level], key: Column) -> Column:
    """Exact membership for keys of the universe the cascade was built over, on a frame that has its filters."""
    result = F.lit(len(levels) % 2 == 1)
    for level in reversed(levels):
        result = F.when(~level.has(key), F.lit(level.number % 2 == 1)).otherwise(result)
    return result


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    text = F.coalesce(url, F.lit(""))
    host = ascii_lower(F.regexp_extract(text, r"(?s)^.*?://([^/?#]*)", 1))
    return host, F.regexp_extract(text, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_path(rule: str) -> str:
    return rule[rule.index("/"):] if "/" in rule else ""


def rule_keys(host: Column, path: Column, lengths: Sequence[int]) -> Column:
    """Every rule text that could fit: host suffixes by path prefixes of the rules' lengths."""
    labels = F.split(host, r"\.")
    size = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), size), lambda i: F.concat_ws(".", F.slice(labels, i, size)))
    keys = [F.when(F.length(path) >= n, F.transform(suffixes, lambda s: F.concat(s, F.substring(path, 1, n)))).otherwise(F.array().cast("array<string>")) for n in lengths]
    return F.flatten(F.array(*keys))


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str]], listed_hosts: DataFrame | None = None, key: str = "page_id", url: str = "url", default: str = "allow",
) -> DataFrame:
    """Longest fitting rule and verdict of every url.

    ``rules`` are (verdict, rule) such as ``("block", "net/es/")``. Allowed and
    blocked rules are each listed in a cascade over the corpus' whole key
    universe. A url that no rule fits is blocked if its host is among
    ``listed_hosts`` (rows of ``host``), which is a cascade over all hosts of
    the corpus, and else gets ``default``, also a null or empty one. Repeated
    rows are judged each; an empty table gives no rows; other columns, whatever
    their names, are ignored. Filters grow with the listed keys, 2 to 30 bits
    for each, not with the corpus.
    """
    spark = pages.sparkSession
    host, path = url_parts(F.col(url))
    parts = pages.select(F.col(key).alias("page_id"), host.alias("host"), path.alias("path"))
    lengths = sorted({len(rule_path(rule)) for _, rule in rules})
    split = parts.withColumn("_keys", rule_keys(F.col("host"), F.col("path"), lengths))
    universe = saved(split.select(F.explode("_keys").alias("key")).distinct(), "url-keys")
    given = spark.createDataFrame([(rule, verdict) for verdict, rule in rules], "key string, _verdict string")
    known = universe.join(F.broadcast(given), "key", "left")
    levels = {v: cascade(known.select("key", F.coalesce(F.col("_verdict") == v, F.lit(False)).alias("listed")), f"_{v}") for v in ("allow", "block")}
    hosts = []
    if listed_hosts is not None:
        every = parts.select(F.col("host").alias("key")).distinct()
        named = listed_hosts.select(F.col("host").alias("key")).distinct().withColumn("listed", F.lit(True))
        hosts = cascade(saved(every.join(named, "key", "left").select("key", F.coalesce("listed", F.lit(False)).alias("listed")), "url-hosts"), "_host")
    ready = with_filters(split, [*levels["allow"], *levels["block"], *hosts])
    fitting = F.filter("_keys", lambda k: is_listed(levels["allow"], k) | is_listed(levels["block"], k))
    longest = F.reduce(fitting, F.lit(None).cast("string"), lambda best, k: F.when(F.length(best) >= F.length(k), best).otherwise(k))
    ruled = ready.withColumn("rule", longest)
    unruled = F.when(is_listed(hosts, F.col("host")), F.lit("block")).otherwise(F.lit(default)) if hosts else F.lit(default)
    verdict = F.when(F.col("rule").isNull(), unruled).when(is_listed(levels["block"], F.col("rule")), F.lit("block")).otherwise(F.lit("allow"))
    return ruled.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
