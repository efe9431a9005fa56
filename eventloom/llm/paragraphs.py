"""Substring dedup by paragraph MinHash banding.

Passages that repeat rarely coincide with lines, so paragraphs are cut by content: of every 16 consecutive five-word
shingles the one with the smallest hash opens a paragraph of 25 words. Any passage of 40 words or more holds a whole paragraph
wherever it stands, and the same one in every text; a passage of 60 words with one word changed has 30 equal words on one side of it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm import spans
from eventloom.llm.base import written
from eventloom.llm.components import components
from eventloom.llm.parcels import BLOBS, dealt, emitted, runs_of, spread, unpack

#: Words of a shingle and of a paragraph, and shingles of which the smallest opens one.
SHINGLE, PARAGRAPH, REACH = 5, 25, 16

#: Jaccard similarity of the shingles from which two paragraphs are the same.
SIMILARITY = 0.8

#: Rows of a band and bands. At a similarity of 0.8 a pair meets in a band with 0.64, and is missed with 0.36 ** 4 =
#: 0.02; a passage of 100 words has about nine paragraphs, and one of them is enough.
ROWS, BANDS = 2, 4

#: Bytes of text for one bucket of band values, and bytes whose values a task unites before it sends them.
BUCKET_BYTES, SEND_BYTES = 4 << 20, 8 << 20

#: Of a band value the low half is sent. ``bits`` has a bit for each shingle, ``size`` their number; ``many`` tells paragraphs of several documents.
_BAND = {"value": "<u4", "code": "<i8", "doc": "<i8", "bits": "<u8", "size": "u1", "many": "u1"}

#: Members of a band value of which all candidate pairs are sent; in a larger one with more than ``DENSE`` pairs for a member, only one pair
#: for each at first. Members of such a value that meet in one block later.
MEET, DENSE, BLOCK = 64, 16, 2000

#: Places on which a paragraph's shingles are marked where members of a value meet, and pairs that are verified at once there.
MARKS, VERIFY = 1024, 50_000


class Paragraphs:
    """The paragraphs of a block of packed texts: text, first word, number of words, and a code of the words."""

    def __init__(self, buf: np.ndarray, starts: np.ndarray) -> None:
        low = spans.LOWER[buf]
        begin, end, firsts = spans.word_spans(low, starts, spans.ALNUM)
        words = spans.span_hash(spans.prefix_sums(low), begin, end)
        self.n_words = np.diff(firsts)
        self.grams = spans.run_hash(words, SHINGLE)
        inside = spans.inside(firsts, REACH + SHINGLE - 1)
        first = np.empty(0, dtype=np.int64)
        if len(inside):
            least, width = self.grams, 1
            while 2 * width <= REACH:
                least = np.minimum(least[:-width], least[width:])
                width *= 2
            least = np.minimum(least[: len(least) - (REACH - width)], least[REACH - width :])
            # A gram opens a paragraph if a window of its text has it as its minimum.
            wins = np.zeros(len(self.grams), dtype=bool)
            windows = np.flatnonzero(inside)
            for shift in range(REACH):
                at = windows + shift
                wins[at[self.grams[at] == least[windows]]] = True
            opens = np.flatnonzero(wins)
            ends = firsts[np.searchsorted(firsts, opens, side="right")]
            first = opens[opens + PARAGRAPH <= ends]
        text = np.searchsorted(firsts, first, side="right") - 1
        size = np.full(len(first), PARAGRAPH)
        # A text without one, but with a shingle, is a paragraph by itself.
        bare = np.flatnonzero((np.bincount(text, minlength=len(self.n_words)) == 0) & (self.n_words >= SHINGLE))
        self.text = np.concatenate([text, bare])
        first = np.concatenate([first, firsts[bare]])
        self.size = np.concatenate([size, self.n_words[bare]])
        self.place = first - firsts[self.text]
        self.first = first
        sums = np.concatenate([[np.uint64(0)], np.cumsum(words * spans.powers(spans._BASE, len(words)))])
        raw = (sums[first + self.size] - sums[first]) * spans.powers(spans._INVERSE, len(sums))[first]
        self.code = spans.mixed(raw + self.size.astype(np.uint64)).view(np.int64)

    def _least(self, row: int) -> np.ndarray:
        """The smallest shingle of every paragraph in the order that ``row`` stands for."""
        bounds = np.empty(2 * len(self.first), dtype=np.int64)
        bounds[0::2], bounds[1::2] = self.first, self.first + self.size - SHINGLE + 1
        seed = spans.mixed(np.array([row + 1], dtype=np.uint64))
        rank = np.append(spans.mixed(self.grams ^ seed), np.uint64(2**64 - 1))
        return np.minimum.reduceat(rank, bounds)[0::2] if len(bounds) else rank[:0]

    def bands(self) -> list[np.ndarray]:
        """The band values of all paragraphs: hashes of ``ROWS`` minima over their shingles."""
        values = []
        for band in range(BANDS):
            value = np.full(len(self.first), band + 1, dtype=np.uint64)
            for row in range(ROWS):
                value = spans.mixed(value * np.uint64(0x9E3779B97F4A7C15) + self._least(band * ROWS + row))
            values.append(value)
        return values

    def bits(self) -> np.ndarray:
        """64 bits for every paragraph, of which each of its shingles sets one."""
        bounds = np.empty(2 * len(self.first), dtype=np.int64)
        bounds[0::2], bounds[1::2] = self.first, self.first + self.size - SHINGLE + 1
        ones = np.append(np.uint64(1) << (spans.mixed(self.grams) >> np.uint64(58)), np.uint64(0))
        return np.bitwise_or.reduceat(ones, bounds)[0::2] if len(bounds) else ones[:0]

    def shingles(self, at: int) -> np.ndarray:
        first = int(self.first[at])
        return np.unique(self.grams[first : first + int(self.size[at]) - SHINGLE + 1])


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, buf, starts in spans.blocks(batches):
        p = Paragraphs(buf, starts)
        columns = [p.code, part.column("doc").to_numpy()[p.text], p.place.astype(np.int32), p.size.astype(np.int32)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["code", "doc", "place", "size"])


def _bander(buckets: int):
    """Documents -> band values for the buckets; equal paragraphs of a task are sent once."""

    def united(found: list[dict[str, np.ndarray]]) -> Iterator[tuple[int, int, bytes]]:
        r = {k: np.concatenate([f[k] for f in found]) for k in _BAND}
        order = np.lexsort((r["doc"], r["code"], r["value"]))
        r = {k: v[order] for k, v in r.items()}
        r, once = _united(r)
        once = once[np.argsort(r["doc"][once], kind="stable")]
        target = (r["value"][once] >> np.uint64(20)) % np.uint64(buckets)
        yield from dealt(target, 0, {k: r[k][once].astype(_BAND[k]) for k in _BAND}, ("doc",))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes]]:
        found, size = [], 0
        for part, buf, starts in spans.blocks(batches, limit=spans.BLOCK_BYTES // 2):
            p = Paragraphs(buf, starts)
            doc = part.column("doc").to_numpy()[p.text]
            own = {"code": p.code, "doc": doc, "bits": p.bits(), "size": p.size - SHINGLE + 1, "many": np.zeros(len(doc), dtype=np.uint8)}
            found += [{"value": v, **own} for v in p.bands()]
            size += len(buf)
            if size >= SEND_BYTES:
                yield from united(found)
                found, size = [], 0
        if found:
            yield from united(found)

    return lambda batches: emitted(rows(batches))


#: Pairs, and (without ``lead``) members of a value whose pairs are not all there.
_PAIR = ("lead", "lead_doc", "code", "doc", "value", "bits", "size", "many")
_PAIR_ARROW = pa.schema([(n, pa.int64()) for n in _PAIR])


def _united(r: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Records sorted by value, code and document -> the first of each (value, code), which then knows whether other documents have it too."""
    once = runs_of(r["value"], r["code"])
    if not len(once):
        return r, once
    high = np.maximum.reduceat(r["doc"], once)
    many = np.maximum.reduceat(r["many"], once) | (high != r["doc"][once])
    r = {**r, "many": r["many"].copy()}
    r["many"][once] = many
    return r, once


def _close(r: dict[str, np.ndarray], a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """Whether paragraphs can have a Jaccard similarity of ``least``, and matter.

    Of n shingles in both together at most n * (1 - least) / (1 + least) are in one alone, and each of those changes one bit at most. So no
    pair that is similar is left out. Paragraphs of one document overlap and collide with each other; only those of different documents matter.
    """
    most = (r["size"][a].astype(np.float64) + r["size"][b]) * ((1 - least) / (1 + least)) + 1e-9
    apart = (r["doc"][a] != r["doc"][b]) | (r["many"][a] > 0) | (r["many"][b] > 0)
    return (np.bitwise_count(r["bits"][a] ^ r["bits"][b]) <= most) & apart & (r["code"][a] != r["code"][b])


def _pairs_behind(begins: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each place from ``begins`` with all behind it up to its end, about a million pairs at a time."""
    behind = ends - begins - 1
    sums, at = np.cumsum(behind), 0
    while at < len(begins):
        upto = max(at + 1, int(np.searchsorted(sums, (sums[at - 1] if at else 0) + 1_000_000, side="right")))
        n = behind[at:upto]
        a = np.repeat(begins[at:upto], n)
        yield a, a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
        at = upto


def _pairer(table: pa.Table, least: float = SIMILARITY) -> pa.Table:
    """The paragraphs of a bucket -> all pairs of a band value that can be similar, see :func:`_close`.

    A value of very many paragraphs that are like each other would have the square of their number. There each is sent with the first one
    that it can be similar to, and all are sent once more as members, for :func:`_across` to find what pairs their classes leave.
    """
    r = unpack(table.column("blob").to_pylist(), ("doc",), **_BAND)
    order = np.lexsort((r["doc"], r["code"], r["value"]))
    r, once = _united({k: v[order] for k, v in r.items()})
    r = {k: v[once] for k, v in r.items()}
    n = len(once)
    one = runs_of(r["value"])
    begins, ends = spread(one, one, n), spread(np.append(one[1:], n)[: len(one)], one, n)
    found = []
    for a, b in _pairs_behind(*(x[ends - begins <= MEET] for x in (np.arange(n), ends))):
        close = _close(r, a, b, least)
        found.append((a[close], b[close]))
    members = []
    for begin, end in zip(one.tolist(), [*one[1:].tolist(), n]):
        if end - begin <= MEET:
            continue
        first, own, sent = np.full(end - begin, -1, dtype=np.int64), [], 0
        for a, b in _pairs_behind(np.arange(begin, end), np.full(end - begin, end)):
            close = _close(r, a, b, least)
            a, b = a[close], b[close]
            sent += len(a)
            if sent <= DENSE * (end - begin):
                own.append((a, b))
            new, where = np.unique(b, return_index=True)
            unset = first[new - begin] < 0
            first[new[unset] - begin] = a[where[unset]]
        if sent > DENSE * (end - begin):
            members.append(np.arange(begin, end))
            own = [(first[first >= 0], begin + np.flatnonzero(first >= 0))]
        found += own
    a, b = (np.concatenate([f[i] for f in found] or [one[:0]]) for i in (0, 1))
    a, b = np.where(r["code"][a] < r["code"][b], a, b), np.where(r["code"][a] < r["code"][b], b, a)
    order = np.lexsort((r["code"][b], r["code"][a]))
    a, b = a[order], b[order]
    new = runs_of(r["code"][a], r["code"][b])
    a, b = a[new], b[new]
    m = np.concatenate(members or [one[:0]])
    none = pa.nulls(len(m), pa.int64()), pa.nulls(len(a), pa.int64())
    columns = [(r["code"][a], none[0]), (r["doc"][a], none[0]), (r["code"][b], r["code"][m]), (r["doc"][b], r["doc"][m])]
    columns += [(none[1], r[k][m].astype(np.uint64).view(np.int64)) for k in ("value", "bits", "size", "many")]
    return pa.Table.from_arrays([pa.chunked_array([pa.array(x, pa.int64()) for x in c]) for c in columns], schema=_PAIR_ARROW)


def _across(table: pa.Table, least: float = SIMILARITY) -> pa.Table:
    """The members of a block, with their ``shingles`` -> links (``a``, ``b``) that join their classes; of two parts, only those between them.

    All pairs of different classes are looked at; those that :func:`_close` and marks of all shingles on ``MARKS`` places do not rule out are
    verified. A pair whose classes have been joined before adds nothing, so there are fewer links than members.
    """
    r = {k: table.column(k).to_numpy() for k in ("code", "doc", "bits", "size", "many", "class", "part", "other")}
    r["bits"] = r["bits"].view(np.uint64)
    sets = table.column("shingles").combine_chunks()
    marks = _marked(sets)
    names, own = np.unique(r["class"], return_inverse=True)
    top, links = np.arange(len(names)), [np.empty(0, dtype=np.int64)] * 2
    for a, b in _pairs_behind(np.arange(len(own)), np.full(len(own), len(own))):
        near = (top[own[a]] != top[own[b]]) & ((r["part"][a] == r["other"][a]) | (r["part"][a] != r["part"][b]))
        a, b = a[near], b[near]
        close = _close(r, a, b, least)
        a, b = a[close], b[close]
        for i in range(0, len(a), VERIFY):
            x, y = a[i : i + VERIFY], b[i : i + VERIFY]
            near = top[own[x]] != top[own[y]]
            x, y = x[near], y[near]
            most = (r["size"][x].astype(np.float64) + r["size"][y]) * ((1 - least) / (1 + least)) + 1e-9
            near = np.bitwise_count(marks[x] ^ marks[y]).sum(axis=1, dtype=np.int64) <= most
            x, y = x[near], y[near]
            shared, sizes = _shared(sets.take(pa.array(x)), sets.take(pa.array(y)))
            alike = shared >= least * (sizes - shared)
            joins = _joined(top, own[x[alike]], own[y[alike]])
            links = [np.append(l, r["code"][ends[alike][joins]]) for l, ends in zip(links, (x, y))]
    return pa.table({"a": links[0], "b": links[1]})


def _marked(sets: pa.ListArray) -> np.ndarray:
    """For each list ``MARKS`` bits (one row of 8 bytes a column), of which each of its values sets one."""
    n = pa.compute.list_value_length(sets).to_numpy(zero_copy_only=False).astype(np.int64)
    place = (spans.mixed(sets.flatten().to_numpy(zero_copy_only=False).view(np.uint64)) >> np.uint64(40)).astype(np.int64) % MARKS
    set_ = np.zeros((len(n), MARKS), dtype=np.uint8)
    set_[np.repeat(np.arange(len(n)), n), place] = 1
    return np.packbits(set_, axis=1).view(np.uint64)


def _joined(top: np.ndarray, one: np.ndarray, other: np.ndarray) -> list[int]:
    """Joins in ``top``, the first of each one's class, what each pair links; the places of the pairs that joined two classes."""
    to, joins = {}, []

    def first(c: int) -> int:
        while (d := to.get(c, c)) != c:
            to[c] = to.get(d, d)
            c = d
        return c

    for i, (a, b) in enumerate(zip(top[one].tolist(), top[other].tolist())):
        a, b = first(a), first(b)
        if a != b:
            to[max(a, b)] = min(a, b)
            joins.append(i)
    if to:
        moved = np.arange(len(top))
        for c in to:
            moved[c] = first(c)
        top[:] = moved[top]
    return joins


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, buf, starts in spans.blocks(batches):
        p = Paragraphs(buf, starts)
        wanted = part.column("codes").to_pylist()
        codes, sets = [], []
        bounds = np.argsort(p.text, kind="stable")
        edges = np.searchsorted(p.text[bounds], np.arange(len(starts)))
        for i, own in enumerate(wanted):
            for at in bounds[edges[i] : edges[i + 1]].tolist():
                if int(p.code[at]) in own:
                    codes.append(int(p.code[at]))
                    sets.append(p.shingles(at).view(np.int64))
        flat = pa.array(np.concatenate(sets) if sets else np.empty(0, dtype=np.int64))
        offsets = pa.array(np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [pa.array(codes, pa.int64()), pa.ListArray.from_arrays(offsets, flat)], names=["code", "shingles"]
        )


def similar_paragraphs(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Links (``a``, ``b``) between the codes of different paragraphs that share a band and are similar."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bands = docs.mapInArrow(_bander(max(1, math.ceil(total / BUCKET_BYTES))), BLOBS)
    made = written(bands.groupBy("target").applyInArrow(lambda t: _pairer(t, least), ", ".join(f"{n} long" for n in _PAIR)))
    links = _alike(made.where("lead is not null").select("lead", "lead_doc", "code", "doc"), docs, least)
    members = made.where("lead is null")
    if members.isEmpty():
        return links
    links = written(links)
    # Values of very many paragraphs that are alike: what is still of different classes, in blocks, so that no task holds a whole value.
    classes = components(links).select(F.col("node").alias("code"), F.col("component").alias("class"))
    members = members.select("value", "code", "doc", "bits", "size", "many").hint("merge").join(classes, "code", "left")
    members = written(members.withColumn("class", F.coalesce("class", "code")))
    mixed = members.groupBy("value").agg(F.count(F.lit(1)).alias("n"), F.min("class").alias("low"), F.max("class").alias("high"))
    mixed = mixed.where("low < high").select("value", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts"))
    rows = written(members.join(mixed, "value"))
    told = _told(rows.select("code", "doc"), docs)
    rows = rows.hint("merge").join(told, "code").withColumn("part", F.pmod(F.xxhash64("code"), F.col("parts")).cast("int"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    block = F.struct("value", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"))
    return links.unionByName(rows.groupBy(block.alias("block")).applyInArrow(lambda t: _across(t, least), "a long, b long"))


def _told(ends: DataFrame, docs: DataFrame) -> DataFrame:
    """The shingles of every paragraph of ``ends`` (its ``code``, and a ``doc`` that has it)."""
    # Any document that has a paragraph can tell its shingles.
    asked = ends.groupBy("code").agg(F.min("doc").alias("doc")).groupBy("doc").agg(F.collect_set("code").alias("codes"))
    # No list of documents or codes has a proven bound, so none is broadcast, at any size.
    told = docs.hint("merge").join(asked, "doc").select("codes", "text").mapInArrow(_shingles, "code long, shingles array<long>")
    return written(told.dropDuplicates(["code"]))


def _alike(pairs: DataFrame, docs: DataFrame, least: float) -> DataFrame:
    """Those of the pairs (``lead``, ``code``, each with a document that has it) whose shingles are alike: (``a``, ``b``)."""
    ends = pairs.select(
        F.explode(F.array(F.struct("code", "doc"), F.struct(F.col("lead").alias("code"), F.col("lead_doc").alias("doc")))).alias("e")
    ).select("e.*")
    told = _told(ends, docs)
    lead = told.select(F.col("code").alias("lead"), F.col("shingles").alias("lead_shingles"))
    both = pairs.select("lead", "code").distinct().hint("merge").join(told, "code").hint("merge").join(lead, "lead")

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared, sizes = _shared(batch.column("shingles"), batch.column("lead_shingles"))
            near = pa.array(shared >= least * (sizes - shared))
            yield pa.RecordBatch.from_arrays([batch.column("lead").filter(near), batch.column("code").filter(near)], names=["a", "b"])

    return both.select("lead", "code", "shingles", "lead_shingles").mapInArrow(alike, "a long, b long")


def _shared(one: pa.ListArray, other: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """For each row, the values that both lists of distinct values have, and the lengths of both lists together."""
    lengths = [pa.compute.list_value_length(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in (one, other)]
    row = np.concatenate([np.repeat(np.arange(len(n)), n) for n in lengths])
    value = np.concatenate([x.flatten().to_numpy(zero_copy_only=False) for x in (one, other)])
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    twice = (row[1:] == row[:-1]) & (value[1:] == value[:-1])
    return np.bincount(row[1:][twice], minlength=len(one)), lengths[0] + lengths[1]


def repeated_passages(
    documents: DataFrame, document: str = "doc_id", text: str = "text", least: float = SIMILARITY
) -> DataFrame:
    """Every document with the word spans of paragraphs that an earlier document has too.

    Equal paragraphs have one code. Different ones that collide in a band of minima are verified by the exact Jaccard
    similarity of their five-word shingles; linked codes form components. Of each component the document with the
    smallest id keeps its paragraphs, all others lose theirs.

    Result: ``doc_id``, ``n_paragraphs`` (removed), ``spans`` (first word and end of the maximal runs of removed words)
    ``kept_in`` (the documents that keep them) and ``repeated`` (whether any is removed). Words are runs of letters and digits in lower case.

    Scale: paragraphs are about one for 8 words; their codes are summed with map-side combine, so a passage in very many
    documents is one row for each task. Band values travel as packed columns in buckets of about 4 MB of text each. In a
    bucket all pairs of a band value are looked at by 64 bits of each paragraph, which costs the square of the different paragraphs of a value at some
    50 ns a pair; those that the bits do not rule out are verified, see :func:`_pairer`. The texts are shuffled once, by document.

    Defined cases: a null text, or one of fewer than five words, has no paragraph; a null document id is not compared
    and has no spans; repetition inside one document, or between rows with one id, is left alone;
    an empty table gives an empty result; other columns are not read.
    """
    every = documents.select(F.col(f"`{document}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text"))
    docs = every.where("doc is not null")
    units = written(docs.mapInArrow(_places, "code long, doc long, place int, size int"))
    links = similar_paragraphs(docs, least)
    classes = components(links).select(F.col("node").alias("code"), F.col("component").alias("class"))
    codes = units.groupBy("code").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
    shared = codes.hint("merge").join(classes, "code", "left").where("class is not null or low <> high")
    shared = written(shared.withColumn("class", F.coalesce("class", "code")))
    keeper = shared.groupBy("class").agg(F.min("low").alias("keeper"))
    kept = shared.join(keeper, "class").select("code", "keeper")
    gone = units.hint("merge").join(kept, "code").where("doc > keeper")
    removed = gone.groupBy("doc").agg(
        F.array_sort(F.collect_set(F.struct(F.col("place").cast("long").alias("a"), (F.col("place") + F.col("size")).cast("long").alias("b")))).alias("places"),
        F.array_sort(F.collect_set("keeper")).alias("kept_in"),
    )
    out = every.select("doc").hint("merge").join(removed, "doc", "left")
    none = F.array().cast("array<array<bigint>>")
    # Paragraphs overlap: unite them in the order of their places.
    merged = F.aggregate(
        F.coalesce("places", F.array().cast("array<struct<a:bigint,b:bigint>>")),
        none,
        lambda runs, p: F.when(
            (F.size(runs) > 0) & (F.element_at(F.element_at(runs, -1), 2) >= p["a"]),
            F.concat(
                F.slice(runs, F.lit(1), F.size(runs) - 1),
                F.array(F.array(F.element_at(F.element_at(runs, -1), 1), F.greatest(F.element_at(F.element_at(runs, -1), 2), p["b"]))),
            ),
        ).otherwise(F.concat(runs, F.array(F.array(p["a"], p["b"])))),
    )
    return out.select(
        F.col("doc").alias("doc_id"),
        F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_paragraphs"),
        merged.alias("spans"),
        F.coalesce("kept_in", F.array().cast("array<bigint>")).alias("kept_in"),
        F.col("places").isNotNull().alias("repeated"),
    )
