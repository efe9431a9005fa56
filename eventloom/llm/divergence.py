"""Source divergence audit: which sources of a language differ, and by which terms."""

from __future__ import annotations

import re
import zlib
from collections import Counter, OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm import spans
from eventloom.llm.base import written
from eventloom.llm.parcels import pack, squeezed, unpack, unsqueezed

#: Documents of a language that a term must occur in; ranks of terms that are reported for a group.
LEAST_DOCUMENTS, TOP_TERMS = 10, 10

#: Shares are whole billionths, and a count has this much added to it.
SCALE, ADDED = 1_000_000_000, 2

#: Distinct (group, term) entries that a counting task holds before it sends them, and numbers that a merge holds unsummed.
HELD_ENTRIES = 1_000_000

#: Bytes of a text that are looked at together; a longer text is cut between terms.
PIECE_BYTES = 1 << 20

#: Bytes of decoded arrays that a pricing task remembers.
REMEMBERED_BYTES = 64 << 20

_TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_BREAK = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")
_LOWER = bytes(spans.LOWER.tolist())

_PARTS = pa.schema(
    [
        ("lang", pa.string()),
        ("slice", pa.int32()),
        ("terms", pa.binary()),
        ("spread", pa.binary()),
        ("sources", pa.list_(pa.string())),
        ("sizes", pa.list_(pa.int64())),
        ("entries", pa.binary()),
    ]
)
_PARTS_DDL = "lang string, slice int, terms binary, spread binary, sources array<string>, sizes array<long>, entries binary"
_MERGED = pa.schema(
    [
        ("lang", pa.string()),
        ("slice", pa.int32()),
        ("source", pa.string()),
        ("n_terms", pa.int64()),
        ("total", pa.int64()),
        ("counts", pa.binary()),
        ("terms", pa.binary()),
    ]
)
_MERGED_DDL = "lang string, slice int, source string, n_terms long, total long, counts binary, terms binary"


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _terms_of(text: str | None, limit: int) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of bounded length (a single longer term stays whole)."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER)
    at = 0
    while at < len(raw):
        gap = _BREAK.search(raw, at + limit) if len(raw) - at > limit else None
        stop = gap.start() if gap else len(raw)
        yield _TERM.findall(raw, at, stop)
        at = stop + 1


class _Counts:
    """Occurrences per (language, source, term) and documents per (language, term) of some documents."""

    def __init__(self, slices: int, piece: int) -> None:
        self.slices, self.piece = slices, piece
        self.spread: dict[str, Counter] = {}
        self.groups: dict[tuple[str, str], Counter] = {}

    def add(self, lang: str, source: str, text: str | None) -> None:
        group = self.groups.setdefault((lang, source), Counter())
        seen: set[bytes] = set()
        for terms in _terms_of(text, self.piece):
            group.update(terms)
            seen.update(terms)
        self.spread.setdefault(lang, Counter()).update(seen)

    def size(self) -> int:
        return sum(map(len, self.groups.values()))

    def sent(self) -> Iterator[tuple]:
        """A row for each language and slice of its terms; the slice of a term is decided by its crc32."""
        for lang, spread in self.spread.items():
            if not spread:
                continue
            terms = list(spread)
            slices = np.fromiter(map(zlib.crc32, terms), dtype=np.int64, count=len(terms)) % self.slices
            order = np.argsort(slices, kind="stable")
            place = np.empty(len(order), dtype=np.int64)
            place[order] = np.arange(len(order))
            where = dict(zip(terms, place.tolist(), strict=True))
            documents = np.fromiter(spread.values(), dtype=np.int64, count=len(terms))[order]
            edges = np.searchsorted(slices[order], np.arange(self.slices + 1))
            own = [(source, group) for (of, source), group in self.groups.items() if of == lang and group]
            at = [np.fromiter(map(where.__getitem__, g), dtype=np.int64, count=len(g)) for _, g in own]
            n = [np.fromiter(g.values(), dtype=np.int64, count=len(g)) for _, g in own]
            sort = [np.argsort(x) for x in at]
            at, n = [x[s] for x, s in zip(at, sort, strict=True)], [x[s] for x, s in zip(n, sort, strict=True)]
            cuts = [np.searchsorted(x, edges) for x in at]
            for k in np.flatnonzero(np.diff(edges)).tolist():
                a, b = int(edges[k]), int(edges[k + 1])
                held = [i for i in range(len(own)) if cuts[i][k] < cuts[i][k + 1]]
                entries = [(at[i][cuts[i][k] : cuts[i][k + 1]] - a, n[i][cuts[i][k] : cuts[i][k + 1]]) for i in held]
                ids = np.concatenate([e[0] for e in entries]).astype(np.uint32)
                yield (
                    lang,
                    k,
                    squeezed(b"\n".join(terms[i] for i in order[a:b].tolist())),
                    pack(n=documents[a:b]),
                    [own[i][0] for i in held],
                    [len(e[0]) for e in entries],
                    pack(term=np.diff(ids, prepend=np.uint32(0)), n=np.concatenate([e[1] for e in entries])),
                )


class _Merge:
    """All entries of one language and slice, summed as they come."""

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.where: dict[bytes, int] = {}
        self.spread = np.zeros(1024, dtype=np.int64)
        self.parts: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.held = 0

    def add(self, terms: bytes, spread: bytes, sources: list[str], sizes: list[int], entries: bytes) -> None:
        where = self.where
        ids = np.array([where.setdefault(t, len(where)) for t in unsqueezed(terms).split(b"\n")], dtype=np.int64)
        if len(where) > len(self.spread):
            self.spread = np.concatenate([self.spread, np.zeros(len(where), dtype=np.int64)])
        self.spread[ids] += unpack([spread], n="i8")["n"]
        got = unpack([entries], ("term",), term="u4", n="i8")
        at = 0
        for source, size in zip(sources, sizes, strict=True):
            self.parts.setdefault(source, []).append((ids[got["term"][at : at + size]], got["n"][at : at + size]))
            at += size
        self.held += at
        if self.held > self.limit:
            self.parts = {s: [self._summed(s)] for s in self.parts}
            self.held = 0

    def _summed(self, source: str) -> tuple[np.ndarray, np.ndarray]:
        ids, n = (np.concatenate(x) for x in zip(*self.parts[source], strict=True))
        order = np.argsort(ids, kind="stable")
        ids, n = ids[order], n[order]
        first = np.flatnonzero(np.diff(ids, prepend=-1))
        return ids[first], np.add.reduceat(n, first) if len(first) else n

    def rows(self, lang: str, number: int, least: int) -> Iterator[tuple]:
        """The language's own row (no source) with its kept terms in order, and a row for each source that has any of them."""
        terms = list(self.where)
        kept = np.flatnonzero(self.spread[: len(terms)] >= least).tolist()
        kept.sort(key=terms.__getitem__)
        if not kept:
            return
        new = np.full(len(terms), -1, dtype=np.int64)
        new[kept] = np.arange(len(kept))
        every = np.zeros(len(kept), dtype=np.int64)
        for source in self.parts:
            ids, n = self._summed(source)
            ids = new[ids]
            ids, n = ids[ids >= 0], n[ids >= 0]
            if len(ids):
                order = np.argsort(ids)
                ids, n = ids[order], n[order]
                every[ids] += n
                yield lang, number, source, len(kept), int(n.sum()), _counts_blob(ids, n), None
        names = squeezed(b"\n".join(terms[i] for i in kept))
        yield lang, number, None, len(kept), int(every.sum()), _counts_blob(np.arange(len(kept)), every), names


def _counts_blob(ids: np.ndarray, n: np.ndarray) -> bytes:
    return pack(term=np.diff(ids.astype(np.uint32), prepend=np.uint32(0)), n=n)


def counted_terms(
    documents: DataFrame, least: int = LEAST_DOCUMENTS, lang: str = "lang", source: str = "source", text: str = "text"
) -> DataFrame:
    """Sorted (term id, count) arrays of every group, in slices of the language's kept terms.

    A term belongs to the slice that its hash names, and its id is its place among the kept terms of that slice, in
    the order of UTF-8. One row per (``lang``, ``slice``, ``source``) with any kept term, one more without a source for
    the language itself: ``n_terms`` kept terms, ``total`` occurrences, ``counts`` (the arrays), ``terms`` (the language's row).

    Tasks count their own documents and send, per language and slice, each term once with its counts by source. One task
    merges a slice as its parts come in, so it holds what the merged slice holds and not the parts.
    """
    spark = documents.sparkSession
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    limit, piece = HELD_ENTRIES, PIECE_BYTES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, since = _Counts(slices, piece), 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts.add(*row)
                since += len(row[2] or "")
                if since > 8 * piece:
                    since = 0
                    if counts.size() > limit:
                        yield from _batches(counts.sent(), _PARTS)
                        counts = _Counts(slices, piece)
        yield from _batches(counts.sent(), _PARTS)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, state = None, _Merge(limit)
        for batch in batches:
            for name, number, *part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != (name, number):
                    if own:
                        yield from _batches(state.rows(*own, least), _MERGED)
                    own, state = (name, number), _Merge(limit)
                state.add(*part)
        if own:
            yield from _batches(state.rows(*own, least), _MERGED)

    def filled(name: str):
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")).alias(name)

    parts = documents.select(filled(lang), filled(source), F.col(f"`{text}`").cast("string").alias("body")).mapInArrow(count, _PARTS_DDL)
    return parts.repartition("lang", "slice").sortWithinPartitions("lang", "slice").mapInArrow(merge, _MERGED_DDL)


def _batches(rows: Iterator[tuple], schema: pa.Schema, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    some, size = [], 0
    for row in rows:
        some.append(row)
        size += sum(len(x) for x in row if isinstance(x, bytes)) + 100
        if size > limit:
            yield _rows(some, schema)
            some, size = [], 0
    if some:
        yield _rows(some, schema)


def shares(counts: np.ndarray, whole: int) -> np.ndarray:
    """``1 + floor(SCALE * (count + ADDED) / whole)``, exact for counts up to ``whole`` < 9e15.

    Where the product would not fit 64 bits, the quotient is made three digits at a time.
    """
    parts = counts + ADDED
    if whole < 2**63 // SCALE:
        return 1 + SCALE * parts // whole
    quotient, rest = np.zeros_like(parts), parts
    for _ in range(3):
        step, rest = np.divmod(rest * 1000, whole)
        quotient = quotient * 1000 + step
    return 1 + quotient


def gap(p: np.ndarray | int, q: np.ndarray | int) -> np.ndarray | int:
    """``floor((p - q) ** 2 / (p + q))``; shares are at most about 1e9, so the square fits 64 bits."""
    return (p - q) * (p - q) // (p + q)


def gallop(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the common ids in both sorted arrays.

    All ids of the shorter array search at once. Each starts where it would stand if the longer one were even, strides that
    double carry it past its place on either side, and the last stride is halved until the place is found.
    """
    n, m = len(short), len(long)
    if not n or not m:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    start = np.arange(n) * m // n
    low, high = start.copy(), start.copy()
    stride, behind, before = 1, np.arange(n), np.arange(n)
    while len(behind) or len(before):
        # ``low`` ends at or before the place, ``high`` at or behind it.
        behind = behind[(low[behind] > 0) & (long[np.minimum(low[behind], m - 1)] > short[behind])]
        low[behind] = np.maximum(low[behind] - stride, 0)
        before = before[(high[before] < m) & (long[np.minimum(high[before], m - 1)] < short[before])]
        high[before] = np.minimum(high[before] + stride, m)
        stride *= 2
    while True:
        open_ = low < high
        if not open_.any():
            break
        middle = (low + high) // 2
        less = open_ & (long[np.minimum(middle, m - 1)] < short)
        low = np.where(less, middle + 1, low)
        high = np.where(open_ & ~less, middle, high)
    found = (low < m) & (long[np.minimum(low, m - 1)] == short)
    return np.flatnonzero(found), low[found]


class _Decoded:
    """The arrays of the groups seen last, with their shares."""

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.memory: OrderedDict[tuple, tuple] = OrderedDict()
        self.bytes = 0

    def __call__(self, key: tuple, blob: bytes | None, whole: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if key in self.memory:
            self.memory.move_to_end(key)
            return self.memory[key]
        got = unpack([blob] if blob else [], ("term",), term="u4", n="i8")
        ids, n = got["term"].astype(np.int64), got["n"]
        value = ids, n, shares(n, whole)
        self.memory[key] = value
        self.bytes += 24 * len(ids)
        while self.bytes > self.limit and len(self.memory) > 1:
            self.bytes -= 24 * len(self.memory.popitem(last=False)[1][0])
        return value


def pair_value(a: np.ndarray, p: np.ndarray, p0: int, b: np.ndarray, q: np.ndarray, q0: int, n_terms: int) -> int:
    """Gaps of two groups summed over all ``n_terms`` terms of a slice: common ones, those of one group only, and absent ones."""
    if len(a) > len(b):
        return pair_value(b, q, q0, a, p, p0, n_terms)
    i, j = gallop(a, b)
    only_p, only_q = np.ones(len(a), dtype=bool), np.ones(len(b), dtype=bool)
    only_p[i], only_q[j] = False, False
    common = gap(p[i], q[j]).sum()
    absent = n_terms - len(a) - len(b) + len(i)
    return int(common + gap(p[only_p], q0).sum() + gap(q[only_q], p0).sum()) + absent * int(gap(p0, q0))


def _price_pairs(batches: Iterator[pa.RecordBatch], remembered: int) -> Iterator[pa.RecordBatch]:
    decoded = _Decoded(remembered)
    for batch in batches:
        values = []
        for lang, number, n_terms, a, b, counts_a, counts_b, whole_a, whole_b in zip(
            *(c.to_pylist() for c in batch.columns), strict=True
        ):
            ids_a, _, p = decoded((lang, number, a), counts_a, whole_a)
            ids_b, _, q = decoded((lang, number, b), counts_b, whole_b)
            none = np.zeros(1, dtype=np.int64)
            p0, q0 = int(shares(none, whole_a)[0]), int(shares(none, whole_b)[0])
            values.append(pair_value(ids_a, p, p0, ids_b, q, q0, n_terms))
        columns = [batch.column(k) for k in (0, 3, 4)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(values, pa.int64())], names=["lang", "a", "b", "value"])


def _price_terms(top: int, remembered: int):
    """The ``top`` terms of each group and slice in which the group is above its language."""

    def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoded, names, held = _Decoded(remembered), None, []
        for batch in batches:
            out = []
            for lang, number, source, counts, every, terms, whole, whole_lang in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                ids, _, p = decoded((lang, number, source), counts, whole)
                q = decoded((lang, number, None), every, whole_lang)[2][ids]
                over = np.flatnonzero(p > q)
                value = gap(p[over], q[over])
                best = np.lexsort((over, -value))[:top]
                if len(best) and names != (lang, number):
                    names, held = (lang, number), unsqueezed(terms).split(b"\n")
                out += [(lang, source, held[ids[over[i]]].decode("utf-8", "surrogatepass"), int(value[i])) for i in best]
            if out:
                yield _rows(out, _TERMS)

    return price


_TERMS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def audit_sources(
    documents: DataFrame,
    least: int = LEAST_DOCUMENTS,
    top: int = TOP_TERMS,
    lang: str = "lang",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """How far the sources of each language are from each other, and the terms that set each source apart.

    Terms are runs of letters (every non-ASCII character counts as one, only A-Z are lower-cased). A language keeps the
    terms of at least ``least`` of its documents. A group's share of a kept term with ``count`` occurrences is
    ``1 + floor(1e9 * (count + 2) / (N + 2 V))``, and two shares differ by ``floor((p - q)^2 / (p + q))``.

    Result: ``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``. Part ``pair``: each other source with the gaps summed over all
    kept terms. Part ``term``: the ``top`` terms of which the source has some and more than its language. Ranks start at 1
    for every group and part, by falling value, then by item.

    The groups' sorted arrays meet once per unordered pair and slice of terms: an equi-join on (language, slice) puts
    the two arrays side by side, so an array is shuffled once and not once for every partner, and a galloping
    intersection prices common, one-sided and absent terms. The gap is the same both ways, so each sum is used for both.
    Slices bound what a task holds of a group; their sums are added by Spark.

    Defined cases: null texts, languages and sources count as empty ones; a group without kept terms has a row for
    each other source (value 0 if the language keeps no term) and none of part ``term``; repeated rows are separate
    documents; a language with one source has no pairs; an empty table gives an empty result. Other columns are left out.
    """
    names = documents.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")).alias("source"),
    )
    remembered = REMEMBERED_BYTES
    merged = written(counted_terms(documents, least, lang, source, text))
    own = merged.where("source is null")
    arrays = merged.where("source is not null").select("lang", "slice", "source", "counts")
    of_lang = own.groupBy("lang").agg((F.sum("total") + ADDED * F.sum("n_terms")).alias("whole_lang"), F.sum("n_terms").alias("v"))
    totals = merged.where("source is not null").groupBy("lang", "source").agg(F.sum("total").alias("n"))
    groups = names.distinct()
    kept = (
        groups.join(of_lang, "lang")
        .join(totals, ["lang", "source"], "left")
        .select("lang", "source", (F.coalesce("n", F.lit(0)) + ADDED * F.col("v")).alias("whole"), "whole_lang")
    )
    kept = written(kept)

    sides = (
        own.select("lang", "slice", "n_terms")
        .join(kept.select("lang", "source", "whole"), "lang")
        .join(arrays, ["lang", "slice", "source"], "left")
    )
    left = sides.select("lang", "slice", "n_terms", F.col("source").alias("a"), F.col("counts").alias("of_a"), F.col("whole").alias("whole_a"))
    right = sides.select("lang", "slice", F.col("source").alias("b"), F.col("counts").alias("of_b"), F.col("whole").alias("whole_b"))
    met = left.join(right, ["lang", "slice"]).where("a < b")
    met = met.select("lang", "slice", "n_terms", "a", "b", "of_a", "of_b", "whole_a", "whole_b")
    sums = met.mapInArrow(lambda batches: _price_pairs(batches, remembered), "lang string, a string, b string, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    others = groups.select("lang", F.col("source").alias("b"))
    pairs = (
        groups.withColumnRenamed("source", "a")
        .join(others, "lang")
        .where("a < b")
        .join(sums, ["lang", "a", "b"], "left")
        .select("lang", "a", "b", F.coalesce("value", F.lit(0)).alias("value"))
    )
    ways = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    pairs = pairs.select("lang", F.explode(ways).alias("way"), "value").select("lang", "way.*", F.lit("pair").alias("part"), "value")

    terms = (
        arrays.join(kept, ["lang", "source"])
        .join(own.select("lang", "slice", F.col("counts").alias("every"), "terms"), ["lang", "slice"])
        .select("lang", "slice", "source", "counts", "every", "terms", "whole", "whole_lang")
        .mapInArrow(_price_terms(top, remembered), "lang string, source string, item string, value long")
    )
    falling = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = terms.withColumn("rank", F.row_number().over(falling)).where(F.col("rank") <= top)
    pairs = pairs.withColumn("rank", F.row_number().over(falling))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(columns).unionByName(terms.withColumn("part", F.lit("term")).select(columns))
