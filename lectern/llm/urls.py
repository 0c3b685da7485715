"""URL rules by a cascade of Bloom filters, in DataFrame functions only."""

from __future__ import annotations

from math import ceil, log, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.words import ascii_lower
from lectern.runtime import materialise

#: Bits of one filter at most; 32 MB, which every task holds once. Longer lists are looked up by a join.
MOST_BITS = 1 << 28
#: Bits a key and hashes a key, on the first level at least and on those below it.
FIRST, BELOW = (10, 7), (4, 3)


def first_level(keys: int, universe: int) -> tuple[int, int]:
    """Bits a key and hashes a key of the first level: so many that it takes about as many keys of the universe wrongly
    as there are listed. So every further level is about as small as the list, however large the universe.
    """
    hashes = max(FIRST[1], ceil(log2(max(2.0, universe / max(1, keys)))))
    return max(FIRST[0], ceil(hashes / log(2))), hashes


class TooLong(ValueError):
    """A level would exceed ``MOST_BITS``."""


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty for null or without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


class Level:
    """One Bloom filter: its bits as one row of longs, read as a scalar subquery, so that probing is no join."""

    def __init__(self, keys: DataFrame, number: int, count: int, measure: tuple[int, int] = BELOW):
        per_key, self.hashes = measure
        self.number, self.bits = number, 64 * max(1, -(-count * per_key // 64))
        if self.bits > MOST_BITS:
            raise TooLong(f"{count} keys exceed one filter")
        spots = keys.select(F.explode(F.array(*self._spots(F.col("key")))).alias("at"))
        words = spots.select((F.col("at").bitwiseAND(F.lit(63))).cast("int").alias("b"), F.shiftright("at", 6).alias("w"))
        words = words.groupBy("w").agg(F.expr("bit_or(shiftleft(1L, b))").alias("x"))
        every = keys.sparkSession.range(self.bits // 64).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("x"))
        whole = words.unionByName(every).groupBy("w").agg(F.expr("bit_or(x)").alias("x"))
        # bits / 64 entries, of at most MOST_BITS bits
        row = whole.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "x"))), lambda e: e["x"]).alias("bits"))
        self.row = materialise(row, "bloom")

    def _spots(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(self.number), F.lit(i), key), F.lit(self.bits)) for i in range(self.hashes)]

    def has(self, key: Column) -> Column:
        bits, hit = self.row.scalar(), F.lit(True)
        for at in self._spots(key):
            word = F.get(bits, F.shiftright(at, 6).cast("int"))
            hit = hit & (F.getbit(word, at.bitwiseAND(F.lit(63)).cast("int")) == 1)
        return hit


class Cascade:
    """Exact membership in a list, for the keys of a known universe.

    Level 1 encodes the listed keys, level 2 those keys of the universe that level 1 takes for listed, level 3 the
    listed keys that level 2 takes for those, and so on until none is taken wrongly. A key that passes an odd number
    of levels before one turns it away is listed. Only the keys that a level takes wrongly are ever written down.
    """

    def __init__(self, listed: DataFrame, universe: DataFrame, size: int | None = None):
        """``listed(key)`` and ``universe(key)``; nulls and repeats are ignored. ``size``: no fewer than the universe's keys, by which the first level is measured."""
        yes = materialise(listed.where("key is not null").select("key").distinct(), "listed")
        self.levels: list[Level] = []
        if not (n := yes.count()):
            return
        self.levels.append(Level(yes, 1, n, first_level(n, size) if size else FIRST))
        # what the first level takes wrongly: asked for and not listed, as an aggregate over both
        wrong = universe.where(self.levels[0].has(F.col("key"))).select("key", F.lit(False).alias("l"))
        wrong = wrong.union(yes.select("key", F.lit(True))).groupBy("key").agg(F.max("l").alias("l"))
        into, other = materialise(wrong.where("NOT l").select("key"), "wrong"), yes
        while n := into.count():
            self.levels.append(level := Level(into, len(self.levels) + 1, n))
            into, other = materialise(other.where(level.has(F.col("key"))), "wrong"), into

    def has(self, key: Column) -> Column:
        """Whether a key of the universe is listed."""
        passed, odd = F.lit(False), len(self.levels) % 2 == 1
        for i in range(len(self.levels) - 1, -1, -1):
            # past level i + 1 and turned away by the next: listed if i + 1 is odd
            passed = F.when(self.levels[i].has(key), F.lit(odd) if i == len(self.levels) - 1 else passed)
            passed = passed.otherwise(F.lit(i % 2 == 1))
        return passed


def candidates(host: Column, path: Column, labels: list[int], lengths: list[int]) -> list[Column]:
    """All rule keys that could fit: the host's last labels, then the path's first characters, of the rules' own measures."""
    parts = F.split(host, r"\.")
    return [
        F.when(
            (host != "") & (F.size(parts) >= n) & (F.length(path) >= m),
            F.concat(F.array_join(F.slice(parts, -n, n), "."), F.substring(path, 1, m)),
        )
        for n in labels
        for m in lengths
    ]


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages(page_id, url)``.

    ``rules(host, path, action)``: a rule fits its host and all subdomains where the url's path starts with the
    rule's. The longest fitting rule decides, of equal length the one with the longer host; a rule listed as both
    allow and block blocks. No rule: null and ``default``, as the url is on no list. Null urls and those without
    ``://`` have empty host and path, which no rule fits. Urls of any length are read whole. Rows are judged by
    themselves; repeated rows and other columns change nothing; an empty table gives an empty result.

    Two cascades hold the rules: all rule keys against every key that the corpus's urls could ask for, and the
    blocking ones among the rules. Each url asks for its own few candidates, without a join. A list too long for one
    filter is joined instead, with the same result.
    """
    rules = materialise(
        rules.select(F.concat(ascii_lower(F.col("host")), F.col("path")).alias("key"), F.length("host").alias("h"),
                     F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("length"), "action")
        .where("key is not null"), "rules",
    )
    shape = rules.agg(F.sort_array(F.collect_set("labels")), F.sort_array(F.collect_set("length"))).first()
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    if not shape[0]:
        return urls.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    asked = candidates(F.col("host"), F.col("path"), list(shape[0]), list(shape[1]))
    keys, blocking = rules.select("key"), rules.where("action = 'block'").select("key")
    every = urls.select(F.explode(F.array(*asked)).alias("key")).where("key is not null")

    def ranked(key: Column) -> Column:
        return F.struct(F.length(key).alias("n"), F.instr(key, "/").alias("h"), key.alias("k"))

    try:
        n = rules.count()
        listed, blocks = Cascade(keys, every, n + pages.count() * len(asked)), Cascade(blocking, keys, n)
    except TooLong:
        pass
    else:
        fits = [F.when(listed.has(k), ranked(k)) for k in asked]
        found = urls.select("*", F.greatest(*fits, *fits[:1])["k"].alias("rule"))
        verdict = F.when(F.col("rule").isNull(), F.lit(default)).when(blocks.has(F.col("rule")), "block").otherwise("allow")
        return found.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
    by_key = rules.groupBy("key").agg(F.max(F.col("action") == "block").alias("blocks"))
    known = every.distinct().join(by_key, "key")
    asks = urls.select("host", "path").distinct().select("host", "path", F.explode(F.array(*asked)).alias("key")).join(known, "key")
    best = asks.groupBy("host", "path").agg(F.max(F.struct(ranked(F.col("key"))["n"], ranked(F.col("key"))["h"], F.col("key").alias("k"), "blocks")).alias("b"))
    verdict = F.when(F.col("b").isNull(), F.lit(default)).when(F.col("b.blocks"), "block").otherwise("allow")
    return urls.join(best, ["host", "path"], "left").select("page_id", "host", "path", F.col("b.k").alias("rule"), verdict.alias("verdict"))
