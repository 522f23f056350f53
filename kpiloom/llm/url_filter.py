"""URL filters by a Bloom filter cascade, in DataFrame functions only.

A list of rules (host and path prefix, verdict) becomes two lists of keys, those
that block and those that allow. The keys that a URL could meet on a list are the
suffixes of its host joined with the prefixes of its path (of the lengths that the
list has). All distinct such keys of the corpus are the key universe. A cascade
decides "is this key listed" without error for every key of the universe and
without a join: level 1 is a Bloom filter of the listed keys; level 2 one of the
universe's keys that pass level 1 without being listed; level 3 one of the listed
keys that pass level 2; and so on until no key passes wrongly. A key is listed if
the number of levels it passes from the first on is odd.

Sizes: level 1 has a false positive rate of about (listed / universe), so level 2
has about as many keys as the list and every later level fewer; all levels
together take some log2(universe / listed) bits for each listed key, in the query's
literals. ``max_listed`` bounds the list, and so the literals; only the filters'
words, never keys of the corpus, come to the driver.

Null URLs and those without ``://`` have an empty host and path and meet no rule. A
URL that no rule fits is allowed: neither cascade lists any of its keys. Repeated
rows get the same verdict each; URLs of any length are split whole; an empty table gives
no rows, and an empty list of rules fits nothing; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from kpiloom.llm.common import save

MAX_LISTED = 1_000_000
BITS = 7  # of each byte of a filter, so that every byte is an ASCII character


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 2)
    upper, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return (F.coalesce(F.translate(rest, upper, small), F.lit("")), F.coalesce(path, F.lit("")))


def candidate_keys(host: Column, path: Column, lengths: Iterable[int]) -> Column:
    """Every host suffix joined with every path prefix of the given lengths."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.array_distinct(F.array(*[
        F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in sorted(lengths)]))
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(
        F.filter(prefixes, lambda p: p.isNotNull()), lambda p: F.concat(s, p))))
    return F.when(host != "", keys).otherwise(F.array().cast("array<string>"))


class Level:
    """One Bloom filter: its bytes, number of hashes and hash seeds."""

    def __init__(self, keys: DataFrame, column: str, n: int, rate: float, seed: int):
        bits = max(64, math.ceil(n * -math.log(rate) / math.log(2) ** 2))
        self.seed, self.size = seed, -(-bits // BITS)
        self.hashes = max(1, round(-math.log2(rate)))
        # blocks of 4 KB of bits, put together by Spark; positions there count from 1
        at = keys.select(F.explode(F.array(*self._bits(F.col(column)))).alias("bit")).withColumn("place", F.col("bit") + 1)
        filled = at.groupBy(F.bitmap_bucket_number("place").alias("block")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
        value = 0
        for row in filled.collect():  # a row for each 4 KB of the filter, whose size ``max_listed`` bounds
            value |= int.from_bytes(row["bits"], "little") << 32768 * (row["block"] - 1)
        raw = value.to_bytes(4096 * (BITS * self.size // 32768 + 1), "little")
        self.bytes = bytearray(
            (int.from_bytes(raw[i * BITS // 8:i * BITS // 8 + 2], "little") >> i * BITS % 8) & (1 << BITS) - 1
            for i in range(self.size))

    def _bits(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.seed), F.lit(i)), F.lit(BITS * self.size).cast("long"))
                for i in range(self.hashes)]

    def passes(self, key: Column) -> Column:
        def is_set(bit):
            byte = F.substring(F.lit(self.bytes), (F.floor(bit / BITS) + 1).cast("int"), F.lit(1))
            return F.call_function("shiftright", F.ascii(byte.cast("string")),
                                   F.pmod(bit, F.lit(BITS)).cast("int")).bitwiseAND(F.lit(1)) == 1
        return reduce(Column.__and__, map(is_set, self._bits(key)))


def cascade(universe: DataFrame, listed: DataFrame, column: str, n_universe: int,
            max_listed: int = MAX_LISTED) -> list[Level]:
    """Levels that together tell the ``listed`` keys from the rest of ``universe``."""
    n = listed.count()
    if n > max_listed:
        raise ValueError(f"{n} listed keys; the filters are sized for {max_listed}")
    levels: list[Level] = []
    inside, outside = listed, universe
    rate = min(0.5, n / max(1, n_universe) / math.sqrt(2))
    while n:
        level = Level(inside, column, n, rate, len(levels))
        passed = outside.filter(level.passes(F.col(column)))
        if not levels:  # the few that pass the first level, without the listed ones
            passed = passed.join(listed, column, "left_anti")
        levels.append(level)
        inside, outside, rate = save(passed, "cascade-level"), inside, 0.5
        n = inside.count()
    return levels


def is_listed(key: Column, levels: list[Level]) -> Column:
    """Whether the number of levels passed from the first on is odd."""
    out = F.lit(False)
    for level in reversed(levels):
        out = level.passes(key) & ~out
    return out


def url_filter(pages: DataFrame, rules: DataFrame, max_listed: int = MAX_LISTED) -> DataFrame:
    """``pages`` (page_id, url) with host, path, rule and verdict; ``rules`` has
    host, path and verdict (block or allow). The longest rule that fits wins."""
    own = save(rules.select(F.concat("host", "path").alias("key"), F.length("path").alias("n"),
                            "verdict").distinct(), "url-rules")
    lengths = [r["n"] for r in own.select("n").distinct().collect()]  # no more than rules
    host, path = split_url(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    parts = save(parts.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), lengths)), "url-keys")
    universe = save(parts.select(F.explode("keys").alias("key")).distinct(), "url-universe")
    n_universe = universe.count()
    block, allow = [cascade(universe, own.filter(F.col("verdict") == v).select("key"), "key", n_universe, max_listed)
                    for v in ("block", "allow")]
    found = F.filter(F.transform("keys", lambda k: F.struct(
        F.length(k).alias("n"), k.alias("rule"),
        F.when(is_listed(k, block), "block").when(is_listed(k, allow), "allow").alias("verdict"))),
        lambda s: s["verdict"].isNotNull())
    return (parts.withColumn("best", F.array_max(found))
            .select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit("allow")).alias("verdict")))
