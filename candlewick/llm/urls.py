"""URL filters: rules looked up in Bloom filter cascades, with DataFrame functions only.

A cascade answers exactly for every key of a known universe. Its first level is a Bloom filter of
the listed keys, the second one of those other keys of the universe that pass the first, the third
of the listed keys that pass the second, and so on until a level lets no wrong key through. The
first level is sized by the ratio of both sets, so that the second is no larger than the list; the
bits are bounded by the list, whatever the size of the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, log, sqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Listed keys in one cascade, about; a longer list is split by key hash over more cascades.
MOST_KEYS = 1_000_000
MOST_LEVELS = 64


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The parts of an url as rules see them; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    whole = F.regexp_extract(rest, r"(?s)^([^?#]*)", 1)
    host = F.regexp_extract(whole, r"(?s)^([^/]*)", 1)
    return F.translate(host, UPPER, LOWER), F.substring(whole, F.length(host) + 1, F.length(whole))


def candidate_keys(host: Column, path: Column, labels: int, lengths: list[int]) -> Column:
    """Every rule text that could fit: the host and its parents, with prefixes of the path.

    Only as many labels, and only path lengths, as some listed rule has. Longest texts are not
    ordered here. An empty host fits no rule.
    """
    parts = F.split(host, r"\.", -1)
    size = F.size(parts)
    first = F.greatest(size - labels + 1, F.lit(1))
    names = F.transform(F.sequence(first, size), lambda i: F.array_join(F.slice(parts, i, size), "."))
    fitting = F.filter(F.lit(lengths), lambda n: n <= F.length(path))
    keys = F.transform(names, lambda name: F.transform(fitting, lambda n: F.concat(name, F.substring(path, F.lit(1), n))))
    return F.when(host != "", F.flatten(keys)).otherwise(F.array().cast("array<string>"))


@dataclass(frozen=True)
class Level:
    """One Bloom filter: bits as bytes, and how many of them a key sets."""

    number: int
    size: int
    probes: int
    bits: bytes

    def holds(self, key: Column) -> Column:
        found = F.lit(True)
        for at in _places(key, self.number, self.size, self.probes):
            byte = F.conv(F.hex(F.substring(F.lit(self.bits), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
            found = found & (F.getbit(byte, (at % 8).cast("int")) == 1)
        return found


def _places(key: Column, level: int, size: int, probes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(size)) for i in range(probes)]


def _build(keys: DataFrame, number: int, size: int, probes: int) -> Level:
    """Set the bits of all keys: bytes are or-ed together where the keys are, then joined."""
    places = keys.select(F.explode(F.array(*_places(F.col("key"), number, size, probes))).alias("place"))
    byte = places.select((F.col("place") / 8).cast("int").alias("at"), F.call_function("shiftleft", F.lit(1), (F.col("place") % 8).cast("int")).alias("bit"))
    body = bytearray(-(-size // 8))
    for at, bits in byte.groupBy("at").agg(F.bit_or("bit").alias("bits")).collect():  # bounded by the list
        body[at] = bits
    return Level(number, size, probes, bytes(body))


class Cascade:
    """Exact membership of a list for all keys of a universe."""

    def __init__(self, levels: list[Level], sure: bool):
        self.levels, self.sure = levels, sure

    @staticmethod
    def of(listed: DataFrame, universe: DataFrame) -> Cascade | Buckets:
        """``listed`` and ``universe`` have one column ``key``; keys outside both are undefined."""
        listed = listed.select("key").where("key IS NOT NULL").distinct()
        others = universe.select("key").where("key IS NOT NULL")
        n = listed.count()
        return Cascade._of(listed, others, n) if n <= MOST_KEYS else Buckets.of(listed, others, ceil(n / MOST_KEYS))

    @staticmethod
    def _of(listed: DataFrame, others: DataFrame, n: int) -> Cascade:
        levels: list[Level] = []
        if not n:
            return Cascade(levels, False)
        rest = max(1, others.count() - n)
        wrong = min(0.5, n / (sqrt(2) * rest))
        encoded, opposite, count = listed, others, n
        while count and len(levels) < MOST_LEVELS:
            number = len(levels)
            size, probes = max(64, ceil(-count * log(wrong) / log(2) ** 2)), max(1, round(-log(wrong, 2)))
            levels.append(_build(encoded, number, size, probes))
            passed = opposite.where(levels[-1].holds(F.col("key"))).distinct()
            if number == 0:
                passed = passed.join(listed, "key", "left_anti")
            encoded, opposite, wrong = passed, encoded, 0.5
            count = encoded.count()
        if count:
            raise RuntimeError("the cascade does not end")
        return Cascade(levels, True)

    def holds(self, key: Column) -> Column:
        """A key that stops at an odd level is listed, at an even one it is not."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for at in range(len(self.levels) - 1, -1, -1):
            answer = F.when(self.levels[at].holds(key), answer).otherwise(F.lit(at % 2 == 1))
        return answer if self.levels else F.lit(False)


class Buckets:
    """One cascade for each bucket of the key's hash, over the keys of the universe in that bucket."""

    def __init__(self, cascades: list[Cascade]):
        self.cascades = cascades

    @staticmethod
    def of(listed: DataFrame, others: DataFrame, count: int) -> Buckets:
        made = []
        for number in range(count):
            mine = listed.where(_bucket(F.col("key"), count) == number)
            made.append(Cascade._of(mine, others.where(_bucket(F.col("key"), count) == number), mine.count()))
        return Buckets(made)

    def holds(self, key: Column) -> Column:
        bucket, answer = _bucket(key, len(self.cascades)), F.lit(False)
        for number, cascade in enumerate(self.cascades):
            answer = F.when(bucket == number, cascade.holds(key)).otherwise(answer)
        return answer


def _bucket(key: Column, count: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(count))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every url.

    ``rules`` has ``host``, ``path`` and ``verdict`` (allow or block). A rule fits its host and all
    subdomains if the url's path starts with the rule's; the longest rule wins. Each verdict's
    rules are one cascade over all candidate keys of the corpus, so no join is needed. Without a
    listed key the verdict is ``default``: the cascade says that nothing lists the url.

    Null urls and urls without ``://`` have empty host and path and fit no rule. A rule text listed
    with both verdicts blocks. Rows are judged each on its own, repeated and without id too; other
    columns are ignored; empty tables of pages or rules are allowed. Any number of rules is
    allowed; over MOST_KEYS of a verdict, each bucket of them reads the keys of the corpus again.
    Lengths and label counts of rules are bounded by those of an url.
    """
    host, path = host_and_path(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    listed = rules.where("host IS NOT NULL AND host <> ''").select(F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    shape = listed.agg(F.max(F.size(F.split("host", r"\.", -1))), F.sort_array(F.collect_set(F.length("path")))).first()
    labels, lengths = shape[0] or 0, list(shape[1] or [])
    if not labels:
        return parts.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    keyed = parts.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), labels, lengths))
    universe = keyed.select(F.explode("keys").alias("key"))
    block, allow = (Cascade.of(listed.where(F.col("verdict") == v).select(F.concat("host", "path").alias("key")), universe) for v in ("block", "allow"))
    verdict = lambda key: F.when(block.holds(key), "block").when(allow.holds(key), "allow")
    found = F.transform("keys", lambda key: F.struct(F.length(key).alias("size"), key.alias("key"), verdict(key).alias("verdict")))
    best = F.array_max(F.filter(found, lambda x: x["verdict"].isNotNull()))
    judged = keyed.withColumn("best", best)
    return judged.select("page_id", "host", "path", F.col("best.key").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")
