"""Exact URL verdicts from cascades of Bloom filters, in DataFrame operations only.

The keys that a URL can match (suffixes of its host, with and without a leading part of its path) are known for the
whole corpus, so membership of a key in a list need not be joined: level 1 of a cascade encodes the listed keys,
level 2 the corpus's other keys that level 1 lets through, level 3 the listed keys that level 2 lets through, and so
on until a level lets nothing wrong through. A key is listed if the number of levels it passes in a row is odd.

Cases: a null url, or one without ``://``, has an empty host and path and no key, so it gets no rule and the default
verdict; lists are parameters, and one whose filters would be over MAX_LEVEL_BITS is refused; an empty table or list gives cascades without levels; equal urls get equal rows; other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The rules of the contract, and registered names listed whole.
RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))
LISTED_NAMES = ("ads-track", "free-bets", "cheap-pills", "spam-farm", "casino-win", "adult-x")
LISTED_HOSTS = tuple(f"{name}.example.{end}" for name in LISTED_NAMES for end in ("com", "net", "org"))

#: A level is sent to every task, so lists whose filters would be larger than this many bits are refused.
MAX_LEVEL_BITS = 1 << 25


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, host, path. The host has A-Z lower-cased."""
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    rows = pages.select("page_id", F.coalesce(rest, F.lit("")).alias("rest"))
    host = F.regexp_extract("rest", r"^([^/?#]*)", 1)
    return rows.select("page_id", F.translate(host, UPPER, LOWER).alias("host"), F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1).alias("path"))


def rule_parts(key: str) -> tuple[int, int]:
    """Of a rule ``host/path`` or a bare host: how many labels and how many characters of path it has."""
    host, slash, path = key.partition("/")
    return host.count(".") + 1, len(slash + path)


def candidate_keys(keys: list[str]) -> Column:
    """Of columns host and path, every key shaped as one of ``keys``, longest first.

    Shapes are pairs of a number of host labels and a length of path, so nothing that could be listed is left out.
    """
    shapes = sorted({rule_parts(k) for k in keys})
    made = []
    for labels, length in shapes:
        suffix = F.substring_index("host", ".", -labels)
        fits = (F.size(F.split("host", r"\.")) >= labels) & (F.col("host") != "") & (F.length("path") >= length)
        made.append(F.when(fits, F.concat(suffix, F.substring("path", 1, length)) if length else suffix))
    return F.transform(F.array_sort(F.transform(F.array_compact(F.array(*made)), lambda k: F.struct((-F.length(k)).alias("n"), k.alias("k")))), lambda s: s["k"])


@dataclass
class Level:
    bits: int
    hashes: int
    salt: int
    data: bytes = b""

    def places(self, key: Column) -> Column:
        first, second = (F.pmod(F.xxhash64(F.lit(self.salt), F.lit(i), key), F.lit(self.bits)) for i in (1, 2))
        return F.array(*[F.pmod(first + F.lit(i) * second, F.lit(self.bits)) for i in range(self.hashes)])

    def passes(self, key: Column) -> Column:
        data = F.lit(bytearray(self.data))
        byte = lambda p: F.ascii(F.decode(F.substring(data, (F.shiftright(p, 3) + 1).cast("int"), F.lit(1)), "ISO-8859-1"))
        return F.forall(self.places(key), lambda p: F.getbit(byte(p), p.bitwiseAND(F.lit(7)).cast("int")) == 1)


def build_level(keys: DataFrame, n: int, rate: float, salt: int) -> Level:
    """A filter of column key's n values that lets others through at about ``rate``. Collects bits/8 bytes at most."""
    bits = max(64, -(-int(-n * math.log(rate) / math.log(2) ** 2) // 64) * 64)
    if bits > MAX_LEVEL_BITS:
        raise ValueError(f"a level of {bits} bits is over MAX_LEVEL_BITS = {MAX_LEVEL_BITS}: split the list")
    level = Level(bits, max(1, round(bits / n * math.log(2))) if n else 1, salt)
    level.hashes = min(level.hashes, 30)
    places = keys.select(F.explode(level.places(F.col("key"))).alias("p"))
    parts = places.groupBy(F.shiftright("p", 3).alias("at")).agg(F.bit_or(F.expr("shiftleft(1, cast(p & 7 as int))")).alias("byte"))
    data = bytearray(bits // 8)
    for r in parts.collect():
        data[r["at"]] = r["byte"]
    level.data = bytes(data)
    return level


@dataclass
class Cascade:
    levels: list[Level]

    def has(self, key: Column) -> Column:
        """Exact for every key of the universe that the cascade was built over."""
        found: Column = F.lit(False)
        for depth in reversed(range(len(self.levels))):
            found = self.levels[depth].passes(key) & (~found if depth + 1 < len(self.levels) else F.lit(True))
        return found


def build_cascade(listed: DataFrame, universe: DataFrame, salt: int = 0) -> Cascade:
    """Both have distinct values in column key. Level 1's rate leaves about as many wrong keys as there are listed."""
    listed = listed.join(universe, "key", "left_semi").cache()
    n_listed, n_all = listed.count(), universe.count()
    if not n_listed:
        listed.unpersist()
        return Cascade([])
    encode, against, n = listed, universe.join(listed, "key", "left_anti"), n_listed
    rate, levels, held = min(0.5, n_listed / (1.5 * max(1, n_all - n_listed))), [], [listed]
    while n:
        level = build_level(encode, n, rate, salt * 100 + len(levels))
        levels.append(level)
        through = against.filter(level.passes(F.col("key"))).cache()
        held.append(through)
        encode, against, n, rate = through, encode, through.count(), 0.5
    for table in held:
        table.unpersist()
    return Cascade(levels)


def judge(pages: DataFrame, rules: tuple = RULES, listed_hosts: tuple = LISTED_HOSTS) -> DataFrame:
    """page_id, host, path, rule, verdict. The longest fitting rule decides; else a listed host or its parent blocks."""
    spark = pages.sparkSession
    keys = [k for _, k in rules] + list(listed_hosts)
    urls = parsed(pages).withColumn("keys", candidate_keys(keys))
    universe = urls.select(F.explode("keys").alias("key")).distinct().cache()
    lists = {"block": [k for v, k in rules if v == "block"], "allow": [k for v, k in rules if v == "allow"], "listed": list(listed_hosts)}
    tables = {name: spark.createDataFrame([(k,) for k in dict.fromkeys(some)], "key string") for name, some in lists.items()}
    has = {name: build_cascade(table, universe, salt).has for salt, (name, table) in enumerate(tables.items())}
    universe.unpersist()
    found = urls.withColumns({name: F.filter("keys", member) for name, member in has.items()})
    key = F.filter("keys", lambda k: F.array_contains("block", k) | F.array_contains("allow", k))
    ruled = found.withColumn("rule", F.get(key, F.lit(0)))
    verdict = F.when(F.col("rule").isNotNull(), F.when(F.array_contains("block", F.col("rule")), "block").otherwise("allow"))
    return ruled.select("page_id", "host", "path", "rule", F.coalesce(verdict, F.when(F.size("listed") > 0, "block").otherwise("allow")).alias("verdict"))
