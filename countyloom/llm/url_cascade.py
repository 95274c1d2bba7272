"""Rules for urls, held in a cascade of Bloom filters that is exact over every key the corpus can ask for."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countyloom.llm.common import checkpointed, mix

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Size of one filter at most, in bits (16 MB); fuller filters let more through, and the next level takes it up.
MOST_BITS = 1 << 27
MOST_LEVELS = 64


def fingerprint(key: Column) -> tuple[Column, Column]:
    """128 bits of a key, as two longs; keys are told apart by these."""
    return F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second"), key).alias("h2")


@dataclass(frozen=True)
class Filter:
    """One Bloom filter."""

    words: np.ndarray
    bits: int
    hashes: int
    seed: int

    def holds(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        found = np.ones(len(h1), bool)
        for at in _places(h1, h2, self.bits, self.hashes, self.seed):
            found &= (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0
        return found


def _places(h1: np.ndarray, h2: np.ndarray, bits: int, hashes: int, seed: int):
    salt = mix(np.array([seed + 1], np.uint64))
    first, step = mix(h1.view(np.uint64) ^ salt), mix(h2.view(np.uint64) + salt) | np.uint64(1)
    for i in range(hashes):
        yield ((first + np.uint64(i) * step) % np.uint64(bits)).astype(np.int64)


def build_filter(keys: DataFrame, count: int, seed: int, bits_per_key: int = 10) -> Filter:
    """A filter of the keys' fingerprints (h1, h2), from each task's own bits; at most `MOST_BITS` reach the driver."""
    bits = min(max(64, bits_per_key * count), MOST_BITS)
    hashes = max(1, min(16, round(math.log(2) * bits / max(1, count))))

    def own(frames):
        words = np.zeros(bits // 64 + 1, np.uint64)
        for frame in frames:
            h1, h2 = frame["h1"].to_numpy(np.int64), frame["h2"].to_numpy(np.int64)
            for at in _places(h1, h2, bits, hashes, seed):
                np.bitwise_or.at(words, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
        used = np.flatnonzero(words)
        yield pd.DataFrame({"place": used, "word": words[used].view(np.int64)})

    found = keys.select("h1", "h2").mapInPandas(own, "place long, word long").groupBy("place").agg(F.bit_or("word").alias("word")).toArrow()
    words = np.zeros(bits // 64 + 1, np.uint64)
    words[found["place"].to_numpy()] = found["word"].to_numpy().view(np.uint64)
    return Filter(words, bits, hashes, seed)


def _held(keys: DataFrame, newest: Filter) -> Column:
    shared = keys.sparkSession.sparkContext.broadcast(newest)

    @F.pandas_udf("boolean")
    def holds(h1: pd.Series, h2: pd.Series) -> pd.Series:
        return pd.Series(shared.value.holds(h1.to_numpy(np.int64), h2.to_numpy(np.int64)))

    return holds("h1", "h2")


@dataclass(frozen=True)
class Cascade:
    """Filters that alternately hold listed keys and the other keys that passed so far."""

    filters: tuple[Filter, ...]

    def listed(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Membership: a key is decided by the first filter that doesn't hold it."""
        answer, open_ = np.zeros(len(h1), bool), np.arange(len(h1))
        for level, each in enumerate(self.filters):
            open_ = open_[each.holds(h1[open_], h2[open_])]
            answer[open_] = level % 2 == 0
        return answer


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """A cascade that answers exactly for all fingerprints of `universe` and `listed` (columns h1, h2; repeats are harmless).

    Level by level, the keys of the other side that the newest filter lets through make the next filter, until none are
    left. An empty list gives a cascade without filters, which lists nothing.
    """
    inside = checkpointed(listed.select("h1", "h2").distinct())
    outside = universe.select("h1", "h2").distinct()
    filters: list[Filter] = []
    while count := inside.count():
        if len(filters) == MOST_LEVELS:
            raise ValueError("the cascade does not end")
        newest = build_filter(inside, count, seed=len(filters))
        filters.append(newest)
        passed = outside.where(_held(outside, newest))
        if len(filters) == 1:
            passed = passed.join(inside, ["h1", "h2"], "left_anti")
        inside, outside = checkpointed(passed), inside
    return Cascade(tuple(filters))


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a url; both empty for null and without "://"."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def keys_of(host: Column, path: Column, lengths: list[int], labels: list[int]) -> Column:
    """All rules that could fit: ends of the host of as many labels as a rule has, each with each path start, longest first."""
    parts = F.split(host, "\\.")
    suffixes = F.filter(F.array(*[F.when(F.size(parts) >= n, F.array_join(F.slice(parts, -n, n), ".")) for n in labels]), lambda s: s.isNotNull())
    starts = F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths])
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(F.filter(starts, lambda p: p.isNotNull()), lambda p: F.concat(s, p))))
    ordered = F.array_sort(F.transform(F.array_distinct(keys), lambda k: F.struct((-F.length(k)).alias("order"), k.alias("key"))))
    return F.transform(ordered, lambda k: k["key"])


def judge(pages: DataFrame, rules: list[Rule], default: str = "allow") -> DataFrame:
    """Each page's host, path, longest fitting rule (null if none) and verdict; `default` is the verdict on unlisted urls.

    Null urls and urls without "://" have no host and fit no rule. Repeated rows are judged alike. No page is joined: the
    cascades answer for every key of every page, so they are exact.
    """
    spark = pages.sparkSession
    host, path = parts(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    lengths, labels = sorted({len(r.path) for r in rules}), sorted({r.host.count(".") + 1 for r in rules})
    asked = rows.withColumn("keys", keys_of(F.col("host"), F.col("path"), lengths, labels))
    universe = asked.select(F.explode("keys").alias("key")).distinct().select(*fingerprint(F.col("key")))
    table = spark.createDataFrame([(r.key, r.verdict) for r in rules], "key string, verdict string")
    listed = build_cascade(table.select(*fingerprint(F.col("key"))), universe)
    blocked = build_cascade(table.where("verdict = 'block'").select(*fingerprint(F.col("key"))), table.select(*fingerprint(F.col("key"))))
    shared = spark.sparkContext.broadcast((listed, blocked))

    @F.pandas_udf("struct<at int, block boolean>")
    def first_rule(h1: pd.Series, h2: pd.Series) -> pd.DataFrame:
        listed, blocked = shared.value
        sizes = np.array([len(x) for x in h1], np.int64)
        a, b = (np.concatenate([np.empty(0, np.int64), *x]).astype(np.int64) for x in (h1, h2))
        row = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(a)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        hit = np.flatnonzero(listed.listed(a, b))
        at, block = np.full(len(sizes), -1, np.int32), np.zeros(len(sizes), bool)
        rows, firsts = np.unique(row[hit], return_index=True)
        at[rows] = place[hit[firsts]]
        block[rows] = blocked.listed(a[hit[firsts]], b[hit[firsts]])
        return pd.DataFrame({"at": at, "block": block})

    first, second = F.transform("keys", lambda k: fingerprint(k)[0]), F.transform("keys", lambda k: fingerprint(k)[1])
    found = asked.withColumn("found", first_rule(first, second))
    fits = F.col("found.at") >= 0
    return found.select(
        "page_id",
        "host",
        "path",
        F.when(fits, F.get("keys", F.col("found.at"))).alias("rule"),
        F.when(~fits, F.lit(default)).when(F.col("found.block"), F.lit("block")).otherwise(F.lit("allow")).alias("verdict"),
    )
