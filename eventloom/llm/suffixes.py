"""Exact substring dedup: every byte inside a string of some length that an earlier document also has.

Suffixes of a corpus cannot all be shuffled, so equal strings are brought together by content. Every window of
50 bytes names one of its 20-byte grams, the first one with the smallest hash, and consecutive windows with the same
choice form a *region*. Equal windows choose equal grams at the same place, so they lie in regions with the same gram, and
of the 30 bytes around the gram at least 15 stand before or behind it. So the regions of two equal windows also
agree in the 15 bytes before the gram, or in those behind it:

1. Tasks send a small record per distinct region (codes of the gram with either side, region code, smallest document), and
   the owner of a gram learns which regions are repeated whole by a later document, and which differ although they
   share the gram and one side. The more text, the more grams meet by chance; grams with a side of 15 bytes hardly do.
2. Only the latter send their bytes, once for each distinct region. The bytes that meet for a range of grams
   are suffix-sorted in two stages, and adjacent common prefixes of 50 bytes show the equal windows.
3. The answers go back to the documents, and each document cuts its spans.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm import spans
from eventloom.llm.base import written
from eventloom.llm.parcels import (
    BLOBS,
    BLOBS_ARROW,
    batch_of,
    dealt,
    emitted,
    opened,
    pack,
    runs_of,
    sealed,
    spread,
    squeezed,
    unpack,
    unsqueezed,
)

#: Bytes of a string that counts as repeated.
LENGTH = 50

#: Bytes of the gram that a window names.
GRAM = 20

#: Bytes of text for one bucket of grams and for one group of documents.
BUCKET_BYTES = 4 << 20

#: Bytes of text whose regions a task unites before it sends them.
SEND_BYTES = 8 << 20

#: Every group sends a blob to every bucket. Beyond this many bytes of text, buckets, groups and what a task unites grow with the square root
#: of the text, so that the blobs grow with the text and not with its square; up to ``MOST_CUTS`` times (what a task unites: twice).
#: A bucket is then compared in cuts of ``BUCKET_BYTES``, one after the other.
ROOT_BYTES = 1 << 28
MOST_CUTS = 8

#: Bytes of text whose regions are found at once; the arrays of a smaller block stay in a core's cache.
REGION_BYTES = 1 << 18

#: Regions of one gram and side that are compared in one bucket; beyond that, its windows are dealt by their own content.
SPREAD_REGIONS = 20_000

_EMPTY = np.empty(0, dtype=np.int64)
#: States of a region: repeated whole, or its bytes are asked for: whole, window by window, or (their sum) both.
_REPEATED, _COMPARE, _SPREAD = 1, 2, 4


# --- two-stage suffix sorting -------------------------------------------------------------------------------


def words_of(text: np.ndarray, depth: int) -> np.ndarray:
    """The eight bytes from every position as one big-endian number (zeros beyond the end)."""
    padded = np.concatenate([text, np.zeros(depth + 16, dtype=np.uint8)]).astype(np.uint64)
    words = np.zeros(len(padded) - 7, dtype=np.uint64)
    for j in range(8):
        words |= padded[j : j + len(words)] << np.uint64(56 - 8 * j)
    return words


def _sorted(words: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes ``at`` in the order of their first ``depth`` bytes.

    They are sorted by eight bytes; only those that agree so far are sorted on, by the eight bytes behind these.
    """
    order = at
    ties = np.arange(len(at))
    run = np.zeros(len(at), dtype=np.int64)
    for k in range(0, depth, 8):
        key = words[order[ties] + k]
        if depth - k < 8:
            key &= ~np.uint64((1 << (64 - 8 * (depth - k))) - 1)
        by = np.lexsort((key, run)) if k else np.argsort(key)
        key, run = key[by], run[by]
        order[ties] = order[ties][by]
        new = np.ones(len(ties), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (run[1:] != run[:-1])
        alone = new & np.append(new[1:], True)
        run = np.cumsum(new)[~alone]
        ties = ties[~alone]
        if not len(ties):
            break
    return order


def suffix_array(text: np.ndarray, words: np.ndarray, depth: int, wanted: np.ndarray | None = None) -> np.ndarray:
    """Positions of ``text`` in the order of their suffixes, compared by ``depth`` bytes at least. ``words``: see :func:`words_of`.

    With flags ``wanted`` only those positions are ordered, and what induction needs for them: from each wanted one on, the positions
    up to the next suffix that is smaller than its successor. Others may be left out of the result.

    First stage: the suffixes that are smaller than their successors are sorted directly. Second stage: all
    others are induced. Scanning the buckets of first bytes from the smallest, the position before a sorted
    suffix takes the next free place of its own bucket, if its suffix is larger than the one scanned. A scan
    takes a whole bucket at once, since it fills only larger buckets, or its own one in rounds for a run of one byte.
    """
    n = len(text)
    if n == 0:
        return _EMPTY
    # smaller[i]: the suffix at i is smaller than the one at i + 1. In a run of one byte the end of the run decides.
    step = np.zeros(n, dtype=np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1])
    step[-1] = -1
    place = np.where(step != 0, np.arange(n), n)
    smaller = step[np.minimum.accumulate(place[::-1])[::-1]] > 0

    if wanted is None:
        taken = np.ones(n, dtype=bool)
    else:
        # A position is needed if a wanted one stands at it or before it, with none of the smaller kind in between.
        since = np.maximum.accumulate(np.where(wanted, np.arange(n), -1))
        kind = np.concatenate([[0], np.cumsum(smaller)])
        taken = (since >= 0) & (kind[:-1] == kind[np.maximum(since, 0)])
    direct = _sorted(words, np.flatnonzero(smaller & taken), depth)
    larger = taken & ~smaller

    counts = np.bincount(text[taken], minlength=256)
    ends = np.cumsum(counts)
    heads = ends - counts
    small = np.bincount(text[direct], minlength=256)
    cuts = ends - small  # where the directly sorted part of a bucket begins
    order = np.empty(int(taken.sum()), dtype=np.int64)
    first = 0
    for c in range(256):
        order[cuts[c] : ends[c]] = direct[first : first + small[c]]
        first += small[c]

    def induce(scanned: np.ndarray, own: int) -> np.ndarray:
        """Place what stands before the scanned suffixes; return what falls into bucket ``own`` itself."""
        before = scanned[scanned > 0] - 1
        before = before[larger[before]]
        into = text[before]
        for c in np.unique(into[into != own]):
            some = before[into == c]
            order[heads[c] : heads[c] + len(some)] = some
            heads[c] += len(some)
        return before[into == own]

    induce(np.array([n]), -1)
    for c in range(256):
        if not counts[c]:
            continue
        begin = ends[c] - counts[c]
        scanned = order[begin : heads[c]].copy()
        while len(scanned):
            scanned = induce(scanned, c)
            order[heads[c] : heads[c] + len(scanned)] = scanned
            heads[c] += len(scanned)
        induce(order[cuts[c] : ends[c]], c)
    return order


def common_prefixes(words: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Bytes that each suffix of ``order`` shares with the one before it, ``depth`` at most (0 for the first)."""
    shared = np.zeros(len(order), dtype=np.int64)
    alive = np.arange(1, len(order))
    for k in range(0, depth, 8):
        differ = words[order[alive] + k] ^ words[order[alive - 1] + k]
        if depth - k < 8:
            differ &= ~np.uint64((1 << (64 - 8 * (depth - k))) - 1)
        same = differ == 0
        ended, differ = alive[~same], differ[~same]
        shared[ended] = k
        for j in range(7):
            shared[ended] += differ >> np.uint64(56 - 8 * j) == 0
        alive = alive[same]
    shared[alive] = depth
    return shared


# --- regions ------------------------------------------------------------------------------------------------


class Regions:
    """The regions of a block of texts, in text order."""

    def __init__(self, buf: np.ndarray, starts: np.ndarray, length: int, gram: int) -> None:
        sums = spans.prefix_sums(buf)
        n, reach = len(buf), length - gram + 1
        self.first = self.last = self.text = self.place = _EMPTY
        self.sums, self.length, self.size = sums, length, gram
        self.gram = self.code = np.empty(0, dtype=np.uint64)
        if n < length:
            self.number = _EMPTY
            return
        begin = np.arange(n - gram + 1)
        # The lowest bits hold how far behind the window's start its smallest gram stands: of equal grams the first one is taken.
        bits = np.uint64(reach.bit_length())
        low = spans.span_hash(sums, begin, begin + gram) >> bits << bits
        width = 1
        while 2 * width <= reach:  # sliding minimum over ``reach`` grams by doubling
            low = np.minimum(low[:-width], low[width:] + np.uint64(width))
            width *= 2
        if width < reach:
            low = np.minimum(low[: len(low) - (reach - width)], low[reach - width :] + np.uint64(reach - width))
        # A window lies in one text: it does not reach the line feed behind it.
        inside = np.ones(len(low), dtype=bool)
        for end in starts[1:].tolist():
            inside[max(end - length, 0) : end] = False
        window = np.flatnonzero(inside)
        if not len(window):
            self.number = _EMPTY
            return
        low = low[window]
        new = np.ones(len(window), dtype=bool)
        # The next window has the same place if it is one nearer to its start.
        new[1:] = (low[1:] + np.uint64(1) != low[:-1]) | (np.diff(window) != 1)
        at = np.flatnonzero(new)
        self.first, self.last = window[at], window[np.append(at[1:], len(window)) - 1]
        self.text = np.searchsorted(starts, self.first, side="right") - 1
        self.place = self.first + (low[at] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        self.gram = spans.mixed(low[at] >> bits)
        self.code = spans.mixed(
            spans.span_hash(sums, self.first, self.last + length) ^ (self.last - self.first).astype(np.uint64)
        )
        opening = np.searchsorted(self.text, np.arange(len(starts) - 1))
        self.number = np.arange(len(at)) - opening[self.text]

    def sides(self) -> dict[str, np.ndarray]:
        """Codes of each region's gram with what stands before it, and behind it; 0 where the region has less on that side.

        Equal windows have a gram at the same place, and what is left of a window is on its two sides, so at least half of it
        is on one of them: two regions with a common window have the same code, not 0, on that side.
        """
        half = (self.length - self.size + 1) // 2
        behind = self.place + self.size
        told = {}
        for name, begin, there in (
            ("left", self.place - half, self.place - self.first >= half),
            ("right", behind, self.last + self.length - behind >= half),
        ):
            code = np.zeros(len(self.first), dtype=np.uint64)
            at = begin[there]
            code[there] = (spans.mixed(spans.span_hash(self.sums, at, at + half) ^ self.gram[there]) >> np.uint64(32)) | np.uint64(1)
            told[name] = code.astype(np.uint32)
        return told

    def first_alike(self) -> np.ndarray:
        """For every region, the number of the first region of its text with the same gram and content."""
        if not len(self.first):
            return _EMPTY
        # One number for text, gram and content; equal ones keep their order, so the first one comes first.
        key = spans.mixed(self.code ^ spans.mixed(self.gram + spans.mixed(self.text.astype(np.uint64) + np.uint64(1))))
        order = np.argsort(key, kind="stable")
        new = np.ones(len(order), dtype=bool)
        new[1:] = key[order][1:] != key[order][:-1]
        at = np.flatnonzero(new)
        alike = np.empty(len(order), dtype=np.int64)
        alike[order] = np.repeat(self.number[order[at]], np.diff(np.append(at, len(order))))
        return alike


#: Columns that travel. Regions are told apart by their code, 64 bits, and those of both sides. Of a side 32 bits are enough: two regions that agree
#: in them are compared by their bytes. The gram does not travel; it names the bucket.
#: ``sum``, 63 bits of a hash of the whole text, tells texts with one document id apart; it is zero (and packs to nothing) where no id is repeated.
_SENT = {"left": "<u4", "right": "<u4", "code": "<u8", "doc": "<i8", "sum": "<i8", "number": "<u4"}
_ANSWER = {"doc": "<i8", "sum": "<i8", "number": "<u4", "state": "u1"}
_MARKS = {"doc": "<i8", "sum": "<i8", "number": "<u4", "bits": "<u8"}
#: Columns that are sorted in a blob.
_STEPPED = ("doc",)


def _home(doc: np.ndarray, groups: int) -> np.ndarray:
    """The group of a document."""
    return (spans.mixed(doc.astype(np.int64).view(np.uint64)) >> np.uint64(16)) % np.uint64(groups)


# --- the three exchanges ------------------------------------------------------------------------------------


def _sender(length: int, gram: int, buckets: int, groups: int, repeated: bool, unite: int | None = None):
    """Documents -> records for the buckets of grams, and answers that the task itself can give, for ``unite`` bytes of text at a time."""

    def united(found: list[dict[str, np.ndarray]]) -> Iterator[tuple[int, int, bytes]]:
        r = {k: np.concatenate([f[k] for f in found]) for k in found[0] if k not in ("text", "doc", "sum")}
        doc, sums = (np.concatenate([f[k] for f in found]) for k in ("doc", "sum"))
        texts = np.cumsum([0, *(len(f["doc"]) for f in found)])
        text = np.concatenate([f["text"] + n for f, n in zip(found, texts[:-1], strict=True)])
        # Regions by document and text, in the order of their numbers; a stable sort by content keeps that order.
        place = np.empty(len(doc), dtype=np.int64)
        place[np.lexsort((sums, doc))] = np.arange(len(doc))
        by = np.argsort(place[text], kind="stable")
        r, text = {k: v[by] for k, v in r.items()}, text[by]
        r["doc"], r["sum"] = doc[text], sums[text]
        n = len(text)
        order = np.argsort(r["code"], kind="stable")
        keys = [r[k][order] for k in ("gram", "code", "doc", "sum")]
        if len(runs_of(*keys[:2])) != len(runs_of(keys[1])):  # equal codes of different grams
            order = np.lexsort((r["code"], r["gram"]))
            keys = [r[k][order] for k in ("gram", "code", "doc", "sum")]
        same = runs_of(*keys[:2])
        least = spread(keys[2][same], same, n)
        # A document repeats its own region: its first one speaks for all.
        once = np.zeros(n, dtype=bool)
        once[runs_of(*keys)] = True
        later = once & (keys[2] > least)
        sent = np.sort(order[once & ~later])
        target = (r["gram"][sent] >> np.uint64(32)) % np.uint64(buckets)
        columns = {k: r[k][sent].astype(_SENT[k]) for k in _SENT}
        yield from dealt(target, 0, columns, _STEPPED)
        if later.any():
            own = np.sort(order[later])
            known = {k: r[k][own].astype(_ANSWER[k]) for k in ("doc", "sum", "number")}
            known["state"] = np.full(len(own), _REPEATED, dtype=np.uint8)
            # These travel with the records, so that both come from one evaluation of the task.
            yield from dealt(_home(r["doc"][own], groups) % np.uint64(buckets), 1, known, _STEPPED)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes]]:
        found, size = [], 0
        for part, buf, starts in spans.blocks(batches, limit=REGION_BYTES):
            regions = Regions(buf, starts, length, gram)
            found.append(
                {
                    "gram": regions.gram,
                    "code": regions.code,
                    **regions.sides(),
                    "number": regions.number.astype(np.uint32),
                    "text": regions.text,
                    "doc": part.column("doc").to_numpy(),
                    "sum": np.array(_sums(buf, starts, repeated), dtype=np.int64),
                }
            )
            size += len(buf)
            if size >= (unite or SEND_BYTES):
                yield from united(found)
                found, size = [], 0
        if found:
            yield from united(found)

    return lambda batches: emitted(rows(batches))


def _asked_for(side: np.ndarray, least: np.ndarray) -> np.ndarray:
    """What is asked of different regions with the codes ``side`` (0: none) and the smallest documents ``least``.

    Where regions share a code and belong to different documents, their bytes must be compared.
    """
    ask = np.zeros(len(side), dtype=np.uint8)
    order = np.argsort(side, kind="stable")
    order = order[side[order] > 0]
    if len(order):
        one = runs_of(side[order])
        kinds = np.diff(np.append(one, len(order)))
        differ = np.minimum.reduceat(least[order], one) != np.maximum.reduceat(least[order], one)
        ask[order] = spread(np.where(kinds > SPREAD_REGIONS, _SPREAD, _COMPARE) * differ, one, len(order))
    return ask


def _decider(groups: int):
    """Records of a bucket of grams -> answers for the groups of documents."""

    def rows(table: pa.Table) -> Iterator[tuple[int, int, bytes]]:
        kinds = table.column("kind").to_numpy()
        blobs = table.column("blob").to_pylist()
        r = unpack([b for b, k in zip(blobs, kinds, strict=True) if k == 0], _STEPPED, **_SENT)
        known = unpack([b for b, k in zip(blobs, kinds, strict=True) if k == 1], _STEPPED, **_ANSWER)
        order = np.lexsort((r["doc"], r["right"], r["left"], r["code"]))
        r = {k: v[order] for k, v in r.items()}
        n = len(order)
        if n:
            same = runs_of(r["code"], r["left"], r["right"])
            kind = spread(np.arange(len(same)), same, n)
            least = r["doc"][same]
            state = np.where(r["doc"] > least[kind], _REPEATED, 0).astype(np.uint8)
            ask = np.bitwise_or(*[_asked_for(r[side][same], least) for side in ("left", "right")])
            state = np.where(state == 0, ask[kind], state).astype(np.uint8)
            told = np.flatnonzero(state)
            known = {
                k: np.concatenate([known[k], (state if k == "state" else r[k])[told].astype(_ANSWER[k])]) for k in _ANSWER
            }
        order = np.lexsort((known["number"], known["doc"]))
        known = {k: v[order] for k, v in known.items()}
        yield from dealt(_home(known["doc"], groups), 0, known, _STEPPED)

    def decide(table: pa.Table) -> pa.Table:
        found = list(rows(table))
        return pa.Table.from_batches([batch_of(found)] if found else [], BLOBS_ARROW)

    return decide


_OPEN_ARROW = pa.schema(
    [("doc", pa.int64()), ("text", pa.string()), ("marks", pa.binary()), ("numbers", pa.binary()), ("begins", pa.binary())]
)
_STATE = (
    "doc long, spans array<array<long>>, kept_sha256 string, n_bytes long, target long, bucket long, blob binary"
)
_STATE_ARROW = pa.schema(
    [
        ("doc", pa.int64()),
        ("spans", pa.list_(pa.list_(pa.int64()))),
        ("kept_sha256", pa.string()),
        ("n_bytes", pa.int64()),
        ("target", pa.int64()),
        ("bucket", pa.int64()),
        ("blob", pa.binary()),
    ]
)


def _sums(buf: np.ndarray, starts: np.ndarray, wanted: bool) -> list[int]:
    if not wanted:
        return [0] * (len(starts) - 1)
    return [xxhash.xxh64_intdigest(buf[a : b - 1]) >> 1 for a, b in zip(starts[:-1], starts[1:], strict=True)]


def _table(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, _STATE_ARROW)


def _finished(doc: int, body: np.ndarray, gone: np.ndarray) -> dict:
    edges = np.flatnonzero(np.diff(gone, prepend=False, append=False)).tolist()
    return {
        "doc": doc,
        "spans": [[a, b] for a, b in zip(edges[0::2], edges[1::2], strict=True)],
        "kept_sha256": hashlib.sha256(body[~gone].tobytes()).hexdigest(),
        "n_bytes": len(body),
    }


def _answers_by_text(told: dict[str, np.ndarray], doc: np.ndarray, sums: list[int]) -> list[slice]:
    """Where the answers, sorted by (doc, sum), of every text stand."""
    key = told["doc"].astype(np.int64), told["sum"].astype(np.int64)
    begins = runs_of(*key) if len(key[0]) else _EMPTY
    ends = np.append(begins[1:], len(key[0]))
    where = {(int(key[0][a]), int(key[1][a])): slice(int(a), int(b)) for a, b in zip(begins, ends, strict=False)}
    return [where.get((int(d), int(s)), slice(0, 0)) for d, s in zip(doc, sums, strict=True)]


def _text_blocks(docs: pa.Table, repeated: bool):
    for part, buf, starts in spans.blocks(opened(docs.column("blob").to_pylist()), limit=REGION_BYTES):
        yield part, buf, starts, _sums(buf, starts, repeated)


def _marker(length: int, gram: int, buckets: int, repeated: bool, cuts: int = 1):
    """A group of documents with its answers -> finished documents, open ones, and bytes to compare."""

    def asked(buf: np.ndarray, regions: Regions, at: np.ndarray, names: dict[str, np.ndarray]) -> Iterator[tuple]:
        """Bucket, bytes and names of the regions ``at``; those with a very common side go window by window."""
        whole, some = (np.flatnonzero(names["state"] & x) for x in (_COMPARE, _SPREAD))
        windows = regions.last[at[some]] - regions.first[at[some]] + 1
        source = np.concatenate([whole, np.repeat(some, windows)])
        offset = np.zeros(len(source), dtype=np.int64)
        offset[len(whole) :] = np.arange(len(source) - len(whole)) - np.repeat(np.cumsum(windows) - windows, windows)
        first = regions.first[at[source]] + offset
        size = regions.last[at[source]] + length - first
        size[len(whole) :] = length
        meet = regions.gram[at[source]]
        meet[len(whole) :] = spans.span_hash(regions.sums, first[len(whole) :], first[len(whole) :] + length)
        bucket = (meet >> np.uint64(32)) % np.uint64(buckets)
        cut = (meet & np.uint64(2**32 - 1)) % np.uint64(cuts)
        names = {k: v[source] for k, v in names.items()}
        order = np.argsort(bucket, kind="stable")
        bucket, first, size, offset, cut = bucket[order], first[order], size[order], offset[order], cut[order]
        names = {k: names[k][order] for k in ("doc", "sum", "number")}
        ends = np.cumsum(size)
        raw = buf[np.repeat(first - (ends - size), size) + np.arange(ends[-1])]
        begins = runs_of(bucket)
        for a, b in zip(begins, np.append(begins[1:], len(bucket)), strict=True):
            head = pack(
                doc=names["doc"][a:b].astype("<i8"),
                sum=names["sum"][a:b].astype("<i8"),
                number=names["number"][a:b].astype("<u4"),
                offset=offset[a:b].astype("u1"),
                size=size[a:b].astype("<u4"),
                cut=cut[a:b].astype("u1"),
            )
            yield int(bucket[a]), head, raw[ends[a] - size[a] : ends[b - 1]].tobytes()

    def mark(docs: pa.Table, answers: pa.Table) -> pa.Table:
        told = unpack(answers.column("blob").to_pylist(), _STEPPED, **_ANSWER)
        order = np.lexsort((told["number"], told["sum"], told["doc"]))
        told = {k: v[order] for k, v in told.items()}
        out: list[dict] = []
        kept_open: list[dict] = []
        home = docs.column("target")[0].as_py()
        sent: dict[int, list[tuple[bytes, bytes]]] = {}
        for part, buf, starts, sums in _text_blocks(docs, repeated):
            doc = part.column("doc").to_numpy()
            regions = Regions(buf, starts, length, gram)
            alike = regions.first_alike()
            bounds = np.searchsorted(regions.text, np.arange(len(starts)))
            # The state of every region's first equal in its text, and from there its own.
            told_at = np.zeros(len(regions.first), dtype=np.uint8)
            for i, own in enumerate(_answers_by_text(told, doc, sums)):
                told_at[bounds[i] + told["number"][own].astype(np.int64)] = told["state"][own]
            state = told_at[bounds[regions.text] + alike]
            whole = np.flatnonzero(state == _REPEATED)
            gone = spans.covered(regions.first[whole], regions.last[whole] + length - regions.first[whole], len(buf))
            waits = np.flatnonzero(state >= _COMPARE)
            cuts = np.searchsorted(regions.text[waits], np.arange(len(starts)))
            for i in range(len(doc)):
                body = slice(starts[i], starts[i + 1] - 1)
                if cuts[i] == cuts[i + 1]:
                    out.append(_finished(int(doc[i]), buf[body], gone[body]))
                    continue
                own = waits[cuts[i] : cuts[i + 1]]
                kept_open.append(
                    {
                        "doc": int(doc[i]),
                        "text": part.column("text")[i].as_py(),
                        "marks": np.packbits(gone[body]).tobytes(),
                        "numbers": alike[own].astype("<u4").tobytes(),
                        "begins": (regions.first[own] - starts[i]).astype("<u8").tobytes(),
                    }
                )
            at = np.flatnonzero(told_at >= _COMPARE)
            if len(at):
                names = {
                    "doc": doc[regions.text[at]],
                    "sum": np.array(sums, dtype=np.int64)[regions.text[at]],
                    "number": regions.number[at],
                    "state": told_at[at],
                }
                for bucket, head, raw in asked(buf, regions, at, names):
                    sent.setdefault(bucket, []).append((head, raw))
        if kept_open:
            out.append({"target": home, "blob": sealed(pa.Table.from_pylist(kept_open, _OPEN_ARROW))})
        for bucket, pieces in sorted(sent.items()):
            parts = b"".join(x for head, raw in pieces for x in (len(head).to_bytes(8, "little"), len(raw).to_bytes(8, "little"), head, raw))
            out.append({"bucket": bucket, "blob": squeezed(parts)})
        return _table(out)

    return mark


def _asked_of(blob: bytes) -> Iterator[tuple[bytes, np.ndarray]]:
    """The heads and bytes that a group of documents sent to a bucket."""
    raw, at = unsqueezed(blob), 0
    while at < len(raw):
        head, body = (int.from_bytes(raw[at + k : at + k + 8], "little") for k in (0, 8))
        at += 16
        yield raw[at : at + head], np.frombuffer(raw, np.uint8, count=body, offset=at + head)
        at += head + body


def _comparer(length: int, groups: int):
    """The regions that meet in a bucket -> the windows that an earlier document also has."""
    kinds = {"doc": "<i8", "sum": "<i8", "number": "<u4", "offset": "u1", "size": "<u4", "cut": "u1"}

    def compare(table: pa.Table) -> pa.Table:
        heads, bodies = [], []
        for blob in table.column("blob").to_pylist():
            for head, body in _asked_of(blob):
                heads.append(head)
                bodies.append(body)
        r = unpack(heads, **kinds)
        raw = np.concatenate(bodies)
        ends = np.cumsum(r["size"].astype(np.int64))
        marks = []
        for cut in np.unique(r["cut"]):
            own = np.flatnonzero(r["cut"] == cut)
            size = r["size"][own].astype(np.int64)
            where = np.repeat(ends[own] - np.cumsum(size), size) + np.arange(size.sum())
            marks.append(marked({k: v[own] for k, v in r.items()}, raw[where]))
        found = {k: np.concatenate([m[k] for m in marks]) for k in _MARKS}
        if not len(found["doc"]):
            return pa.Table.from_batches([], BLOBS_ARROW)
        return pa.Table.from_batches([batch_of(list(dealt(_home(found["doc"], groups), 0, found)))])

    def marked(r: dict[str, np.ndarray], bodies: np.ndarray) -> dict[str, np.ndarray]:
        # No UTF-8 text has the byte 255: it parts the regions.
        size = r["size"].astype(np.int64)
        begins = np.concatenate([[0], np.cumsum(size + 1)])
        region = np.repeat(np.arange(len(size)), size + 1)
        place = np.arange(begins[-1]) - begins[region]
        text = np.full(begins[-1], 255, dtype=np.uint8)
        text[place < size[region]] = bodies
        words = words_of(text, length)
        starts = place + length <= size[region]
        order = suffix_array(text, words, length, starts)
        order = order[starts[order]]
        shared = common_prefixes(words, order, length)
        begins_at = np.flatnonzero(shared < length)
        doc = r["doc"][region[order]]
        least = spread(np.minimum.reduceat(doc, begins_at), begins_at, len(order))
        hit = order[doc > least]
        bits = np.uint64(1) << (place[hit] + r["offset"][region[hit]]).astype(np.uint64)
        by = np.argsort(region[hit], kind="stable")
        own = region[hit][by]
        at = runs_of(own)
        marks = {k: r[k][own[at]] for k in ("doc", "sum", "number")}
        marks["bits"] = np.bitwise_or.reduceat(bits[by], at) if len(at) else bits
        return marks

    return compare


def _finisher(length: int, repeated: bool):
    """Open documents with the windows found -> finished documents."""

    def finish(docs: pa.Table, answers: pa.Table) -> pa.Table:
        told = unpack(answers.column("blob").to_pylist(), **_MARKS)
        order = np.lexsort((told["number"], told["sum"], told["doc"]))
        told = {k: v[order] for k, v in told.items()}
        out = []
        for part, buf, starts, sums in _text_blocks(docs, repeated):
            doc = part.column("doc").to_numpy()
            marks, numbers, begins = (part.column(k) for k in ("marks", "numbers", "begins"))
            for i, own in enumerate(_answers_by_text(told, doc, sums)):
                body = buf[starts[i] : starts[i + 1] - 1]
                gone = np.unpackbits(np.frombuffer(marks[i].as_py(), np.uint8), count=len(body)) > 0
                if own.stop > own.start:
                    number = np.frombuffer(numbers[i].as_py(), "<u4")
                    bits = np.zeros(int(number.max()) + 1, dtype=np.uint64)
                    np.bitwise_or.at(bits, told["number"][own], told["bits"][own])
                    windows = (bits[number][:, None] >> np.arange(length, dtype=np.uint64)) & np.uint64(1)
                    region, offset = np.nonzero(windows)
                    at = np.frombuffer(begins[i].as_py(), "<u8").astype(np.int64)[region] + offset
                    gone |= spans.covered(at, length, len(body))
                out.append(_finished(int(doc[i]), body, gone))
        return _table(out)

    return finish


#: Stands for a null document id, and sorts before all others.
_NULL_ID = -(2**63)


def repeated_spans(documents: DataFrame, document: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """For every document, the byte spans that lie in a ``length``-byte string of a document with a smaller id.

    Result: ``doc_id``, ``n_bytes``, ``spans`` (begin and end in UTF-8 bytes of the maximal runs to remove) and
    ``kept_sha256`` (of the other bytes, concatenated). Strings are judged on the input and never cross
    documents. The id must be a whole number.

    Scale: two exchanges of the documents' texts, compressed, one of about 22 bytes for each distinct region of a task (about
    one for 16 bytes of text, whole copies within a task sent once), and one of the bytes of regions that share
    a gram and one side of it and differ. Copies, however many, meet as at most one record per task. Buckets and groups
    have about 4 MB of text each up to 256 MB of text, beyond that they grow with its root up to 32 MB; a gram and side in very
    many different regions has its windows dealt by content.

    Defined cases: a null text is empty; an empty or short text keeps all its bytes; a null id counts as smaller
    than all others; rows with one id do not count as earlier than each other; an empty table gives an empty
    result; other columns are not read.
    """
    gram = max(1, min(GRAM, length - 1))
    docs = documents.select(
        F.coalesce(F.col(document).cast("long"), F.lit(_NULL_ID)).alias("doc"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    repeated = bool(docs.groupBy("doc").count().where("count > 1").limit(1).count())
    grown = min(MOST_CUTS, max(1.0, math.sqrt(total / ROOT_BYTES)))
    buckets = groups = max(1, math.ceil(total / (BUCKET_BYTES * grown)))
    unite = int(SEND_BYTES * min(2, grown))
    records = docs.mapInArrow(_sender(length, gram, buckets, groups, repeated, unite), BLOBS)
    answers = records.groupBy("target").applyInArrow(_decider(groups), BLOBS)

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[int, int, bytes]]:
            for part, _, _ in spans.blocks(batches, limit=unite):
                target = _home(part.column("doc").to_numpy(), groups)
                order = np.argsort(target, kind="stable")
                begins = runs_of(target[order])  # a part has a row at least
                for a, b in zip(begins, np.append(begins[1:], len(order)), strict=True):
                    yield int(target[order[a]]), 0, sealed(part.take(pa.array(order[a:b])))

        yield from emitted(rows())

    placed = docs.mapInArrow(home, BLOBS)
    state = written(
        placed.groupBy("target")
        .cogroup(answers.groupBy("target"))
        .applyInArrow(_ordered(_marker(length, gram, buckets, repeated, math.ceil(grown))), _STATE)
    )
    found = state.where("bucket is not null").select("bucket", "blob").groupBy("bucket")
    marks = found.applyInArrow(_comparer(length, groups), BLOBS)
    opened = state.where("target is not null").select("target", "blob")
    closed = (
        opened.groupBy("target")
        .cogroup(marks.groupBy("target"))
        .applyInArrow(_ordered(_finisher(length, repeated)), _STATE)
    )
    done = ["doc", "n_bytes", "spans", "kept_sha256"]
    out = state.where("kept_sha256 is not null").select(*done).unionByName(closed.select(*done))
    return out.withColumn("doc_id", F.when(F.col("doc") != _NULL_ID, F.col("doc"))).select("doc_id", *done[1:])


def _ordered(work):
    """A cogrouped function of (documents, answers); a group without documents has nothing to do."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        return work(docs, answers) if docs.num_rows else _table([])

    return run


def without_spans(documents: DataFrame, found: DataFrame, document: str = "doc_id", text: str = "text") -> DataFrame:
    """The remaining bytes of every document of :func:`repeated_spans`, as a binary column ``kept``.

    A span may end inside a character, so the rest is bytes.
    """
    raw = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    edges = F.concat(F.array(F.lit(0).cast("long")), F.flatten("spans"), F.array(F.col("n_bytes")))
    pieces = F.transform(
        F.sequence(F.lit(0), F.size("spans")),
        lambda i: F.substring(
            raw,
            F.element_at(edges, 2 * i + 1).cast("int") + 1,
            (F.element_at(edges, 2 * i + 2) - F.element_at(edges, 2 * i + 1)).cast("int"),
        ),
    )
    joined = documents.select(document, text).join(found.withColumnRenamed("doc_id", document), document)
    return joined.select(document, F.aggregate(pieces, F.lit(b""), lambda a, b: F.concat(a, b)).alias("kept"))


def span_digest(found: DataFrame) -> DataFrame:
    """The per-document figures of :func:`repeated_spans`."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )
