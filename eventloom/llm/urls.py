"""URL rules by a cascade of Bloom filters: exact membership for a known universe of keys."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.base import lower_ascii, written

#: Bits of all levels that one broadcast holds (32 MiB). A longer list is split by key hash into several cascades.
CASCADE_BITS = 1 << 28


def host_of(url: str | Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, in lower case; empty without ``://``."""
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: str | Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_keys(host: str, path: str, path_lengths: Sequence[int], most_labels: int) -> Column:
    """Every rule that could fit: the domain suffixes of the host with up to ``most_labels`` labels, each with each prefix of the path of a listed length."""
    labels = F.length(host) - F.length(F.replace(F.col(host), F.lit("."), F.lit(""))) + 1
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(labels, F.lit(most_labels))),
        lambda i: F.call_function("substring_index", F.col(host), F.lit("."), -i),
    )
    long_enough = F.filter(F.array(*[F.lit(n) for n in path_lengths]), lambda n: n <= F.length(path))
    keys = F.transform(
        suffixes, lambda s: F.transform(long_enough, lambda n: F.concat(s, F.substring(F.col(path), F.lit(1), n)))
    )
    return F.when(F.col(host) != "", F.array_distinct(F.flatten(keys))).otherwise(F.array().cast("array<string>"))


@dataclass(frozen=True)
class Level:
    """One Bloom filter: ``n_bits`` bits packed in 64-bit words, ``n_hashes`` places for a key."""

    words: np.ndarray
    n_bits: int
    n_hashes: int
    seed: int

    def holds(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), dtype=bool)
        for i in range(self.n_hashes):
            place = _place(keys, i, self.n_bits, self.seed)
            found &= (self.words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) > 0
        return found


def _place(keys: np.ndarray, i: int, n_bits: int, seed: int) -> np.ndarray:
    """The i-th bit of every 64-bit key; each level has places of its own."""
    step = np.uint64((0x9E3779B97F4A7C15 * (2 * (seed * 64 + i) + 1)) % 2**64)
    x = (keys ^ step) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))) % np.uint64(n_bits)


def member(levels: list[Level], keys: np.ndarray) -> np.ndarray:
    """Flags of the listed keys: the first level that lacks a key decides, and its parity is the answer."""
    listed = np.zeros(len(keys), dtype=bool)
    open_ = np.arange(len(keys))
    for depth, level in enumerate(levels):
        holds = level.holds(keys[open_])
        listed[open_[~holds]] = depth % 2 == 1
        open_ = open_[holds]
    # What passes all levels belongs to what the last one encodes.
    listed[open_] = len(levels) % 2 == 1
    return listed


def _encoded(keys: DataFrame, count: int, rate: float, seed: int) -> Level:
    """A filter of ``count`` keys (column ``key``): tasks find the bits, map-side combine unites them."""
    n_bits = max(64, 64 * math.ceil(count * -math.log(rate) / math.log(2) ** 2 / 64))
    n_hashes = max(1, round(n_bits / max(count, 1) * math.log(2)))
    n_hashes = min(n_hashes, 24)

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            places = np.unique(np.concatenate([_place(values, i, n_bits, seed) for i in range(n_hashes)]))
            at, first = np.unique(places >> np.uint64(6), return_index=True)
            words = np.bitwise_or.reduceat(np.uint64(1) << (places & np.uint64(63)), first) if len(at) else at
            yield pa.RecordBatch.from_arrays(
                [pa.array(at.astype(np.int64)), pa.array(words.view(np.int64))], names=["at", "word"]
            )

    found = keys.mapInArrow(bits, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word")).toPandas()
    words = np.zeros(n_bits // 64, dtype=np.uint64)
    words[found["at"].to_numpy()] = found["word"].to_numpy().astype(np.int64).view(np.uint64)
    return Level(words, n_bits, n_hashes, seed)


def build_cascade(listed: DataFrame, universe: DataFrame, max_levels: int = 60) -> list[Level]:
    """Levels that tell the ``listed`` keys of the ``universe`` from all its other keys, without error.

    Both have one 64-bit column ``key`` of distinct values, and the universe holds every key that will be asked.
    Level 0 encodes the listed keys. Level 1 encodes the other keys of the universe that level 0 wrongly
    holds, level 2 the listed keys that level 1 wrongly holds, and so on until no key is wrongly held. The first
    level has the error rate listed / (universe * sqrt 2), later ones one half, so the bits of all levels are
    about 1.44 log2(universe / listed) + 4.2 for a listed key, however large the universe is.
    """
    inside = written(universe.join(listed, "key", "left_semi"))
    outside = universe.join(listed, "key", "left_anti")
    n_in = inside.count()
    if n_in == 0:
        return []
    n_out = outside.count()
    rate = min(0.5, n_in / (math.sqrt(2) * max(n_out, 1)))
    levels = [_encoded(inside, n_in, rate, 0)]
    # The keys on either side that all levels so far hold: the ones the next level must decide.
    now, other = inside, outside
    while len(levels) < max_levels:
        other = written(_held(other, levels[-1]))
        wrong = other.count()
        if wrong == 0:
            return levels
        levels.append(_encoded(other, wrong, 0.5, len(levels)))
        now, other = other, now
    raise RuntimeError(f"keys left undecided after {max_levels} levels: two keys with one 64-bit hash")


def _held(keys: DataFrame, level: Level) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value.holds(batch.column(0).to_numpy().view(np.uint64))))

    return keys.mapInArrow(hold, "key long")


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Rules given as (verdict, host with path), such as ``("block", "net/")``."""
    schema = "verdict string, host string, path string"
    split = [(v, r.partition("/")[0].lower(), "/" + r.partition("/")[2]) for v, r in rules]
    return spark.createDataFrame(split, schema)


def judge_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", keep: tuple[str, ...] = ("page_id",), otherwise: str = "allow"
) -> DataFrame:
    """The verdict of the longest fitting rule for every url, by cascades instead of a join with the rules.

    ``rules`` has ``verdict`` (``block`` or ``allow``), ``host`` and ``path``; a rule fits its host and all
    subdomains of it if the path of the url starts with its own. The universe is every key that a url of
    ``pages`` could match (each domain suffix of no more labels than a rule has, with each path prefix of a length that a rule has). Per verdict one
    cascade encodes the keys listed under it; as the cascades were built over the same universe that is asked,
    membership is exact, but for two keys with one 64-bit hash (a chance of k * k / 2 ** 65 for k keys). A listed key under both verdicts is blocked.

    Result: ``keep`` columns, ``host``, ``path``, ``rule`` (host and path of the rule, else null) and ``verdict``
    (``otherwise`` without a rule). Rules of equal length that fit one url are the same rule, since both are
    suffixes of one host with prefixes of one path; of different splits of one text, the longer host is taken.

    The list may have any size: it is split by key hash into slices whose levels fit one broadcast each, and
    the pages pass once over each slice. The universe is deduplicated with map-side combine.

    Defined cases: a null url, or one without ``://``, has an empty host and path, no keys and the verdict
    ``otherwise``; repeated pages and rules are harmless; rules with a null field are left out; without rules or
    pages there is nothing to build.
    """
    spark = pages.sparkSession
    known = rules.where("verdict is not null and host is not null and path is not null").distinct()
    lengths = sorted(r.n for r in known.select(F.length("path").alias("n")).distinct().collect())
    labels = known.agg(F.max(F.size(F.split("host", r"\.", -1)))).first()[0] or 1
    kept = [F.col(c).alias(f"kept{i}") for i, c in enumerate(keep)]
    asked = pages.select(*kept, host_of(url).alias("host"), path_of(url).alias("path"))
    asked = asked.withColumn("keys", rule_keys("host", "path", lengths, labels) if lengths else F.array().cast("array<string>"))
    asked = asked.withColumn("hashes", F.transform("keys", lambda k: F.xxhash64(k)))
    universe = asked.select(F.explode("hashes").alias("key")).distinct()
    listed = known.select("verdict", F.xxhash64(F.concat("host", "path")).alias("key")).distinct()
    count = listed.count()
    slices = max(1, math.ceil(count * 64 / CASCADE_BITS))
    universe = written(universe)

    fits = asked.withColumns({v: F.transform("keys", lambda k: F.lit(False)) for v in ("block", "allow")})
    for verdict in ("block", "allow"):
        for number in range(slices):
            own = F.pmod(F.col("key"), F.lit(slices)) == number
            levels = build_cascade(
                listed.where((F.col("verdict") == verdict) & own).select("key"), universe.where(own)
            )
            fits = _asked(fits, verdict, levels, slices, number) if levels else fits

    # The longest key wins; under both verdicts at once, block.
    choices = F.transform(
        F.filter(
            F.arrays_zip("keys", "block", "allow"), lambda x: x["block"] | x["allow"]
        ),
        lambda x: F.struct(
            F.length(x["keys"]).alias("n"), x["block"].alias("block"), x["keys"].alias("rule")
        ),
    )
    best = F.array_max("choices")
    return fits.withColumn("choices", choices).select(
        *[F.col(f"kept{i}").alias(c) for i, c in enumerate(keep)],
        "host",
        "path",
        best["rule"].alias("rule"),
        F.when(best["rule"].isNull(), F.lit(otherwise)).when(best["block"], "block").otherwise("allow").alias("verdict"),
    )


def _asked(fits: DataFrame, verdict: str, levels: list[Level], slices: int, number: int) -> DataFrame:
    """Set the flags of the keys that the cascade of slice ``number`` lists."""
    shared = fits.sparkSession.sparkContext.broadcast(levels)
    place = fits.columns.index(verdict)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, flags = batch.column("hashes"), batch.column(verdict)
            keys = hashes.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            found = flags.flatten().to_numpy(zero_copy_only=False).copy()
            own = np.flatnonzero(keys.view(np.int64) % slices == number)
            found[own] |= member(shared.value, keys[own])
            sizes = pa.compute.list_value_length(hashes).to_numpy(zero_copy_only=False)
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            columns = list(batch.columns)
            columns[place] = pa.ListArray.from_arrays(offsets, pa.array(found))
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return fits.mapInArrow(ask, T.StructType(fits.schema.fields))
