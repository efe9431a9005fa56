"""Word n-grams of a batch of texts, interned in an open-addressed table of NumPy arrays."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import xxhash

from eventloom.llm import spans

#: Bytes of a text that are looked at together. A longer text is cut between words and goes on with its last words.
PIECE_BYTES = 1 << 20

#: From this length on, keys come from the xxhash library one by one; shorter ones are computed for all spans of a length at once.
LONG = 1024

# The primes of xxhash64.
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
)

_WORD = re.compile(rb"[0-9a-z\x80-\xFF]+")
_BREAK = re.compile(rb"[^0-9a-z\x80-\xFF]")
_LOWER = bytes(spans.LOWER.tolist())


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _turned(acc + lane * _P2, 31) * _P1


def xxhash64(windows: np.ndarray, begin: np.ndarray, length: int) -> np.ndarray:
    """xxhash64 (seed 0) of the spans of one ``length`` that start at ``begin``.

    ``windows[i]`` holds the eight bytes from ``i`` on as a little-endian number.
    """
    at, left = 0, length
    zero = np.zeros(len(begin), dtype=np.uint64)
    if length >= 32:
        accs = [zero + _P1 + _P2, zero + _P2, zero.copy(), zero - _P1]
        while left >= 32:
            accs = [_round(acc, windows[begin + at + 8 * k]) for k, acc in enumerate(accs)]
            at, left = at + 32, left - 32
        out = sum((_turned(acc, bits) for acc, bits in zip(accs, (1, 7, 12, 18), strict=True)), zero)
        for acc in accs:
            out = (out ^ _round(zero, acc)) * _P1 + _P4
    else:
        out = zero + _P5
    out = out + np.uint64(length)
    while left >= 8:
        out = _turned(out ^ _round(zero, windows[begin + at]), 27) * _P1 + _P4
        at, left = at + 8, left - 8
    if left >= 4:
        out = _turned(out ^ ((windows[begin + at] & np.uint64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
        at, left = at + 4, left - 4
    for k in range(left):
        out = _turned(out ^ ((windows[begin + at + k] & np.uint64(0xFF)) * _P5), 11) * _P1
    out = (out ^ (out >> np.uint64(33))) * _P2
    out = (out ^ (out >> np.uint64(29))) * _P3
    return out ^ (out >> np.uint64(32))


def windows_of(buf: np.ndarray) -> np.ndarray:
    """For each byte the eight bytes from there on (zeros behind the end) as one number."""
    padded = np.concatenate([buf, np.zeros(16, dtype=np.uint8)])
    out = np.empty((len(buf) // 8 + 1) * 8, dtype=np.uint64)
    for k in range(8):
        out[k::8] = np.frombuffer(padded, dtype="<u8", count=len(buf) // 8 + 1, offset=k)
    return out


def _crc_table() -> np.ndarray:
    """The effect of each byte on a crc32, from its polynomial."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(0xEDB88320), out >> 1).astype(np.uint32)
    return out


_CRC = _crc_table()


def by_length(length: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each length that occurs, and where."""
    narrow = length.astype(np.uint16) if len(length) and length.max() < 1 << 16 else length
    order = np.argsort(narrow, kind="stable")
    edges = np.flatnonzero(np.diff(length[order], prepend=-1, append=-1))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield int(length[order[a]]), order[a:b]


def crc32(buf: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Unsigned crc32 of every span."""
    out = np.empty(len(begin), dtype=np.uint32)
    for size, own in by_length(length):
        at = begin[own]
        if size >= LONG:
            out[own] = [zlib.crc32(buf[a : a + size]) for a in at]
            continue
        crc = np.full(len(own), 0xFFFFFFFF, dtype=np.uint32)
        for k in range(size):
            crc = _CRC[(crc ^ buf[at + k]) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
        out[own] = ~crc
    return out


class Interned:
    """Distinct spans of a buffer, each with a slot of one open-addressed table.

    The table has at least twice as many places as there are spans. A span starts at the place that the low bits of
    its xxhash64 name. It takes an empty place, stays where its own bytes stand already, or goes on to
    the next place. A key alone never decides: spans are equal if their lengths, keys and bytes agree.

    ``slot`` is the place of every occurrence; ``owner`` is, per place, the first occurrence to take it, or -1.
    """

    def __init__(self, buf: np.ndarray, begin: np.ndarray, length: np.ndarray) -> None:
        self.buf, self.begin, self.length = buf, begin, length
        size = 1 << max(2 * len(begin), 16).bit_length()
        self.owner = np.full(size, -1, dtype=np.int64)
        self.keys = np.zeros(size, dtype=np.uint64)
        self.slot = np.empty(len(begin), dtype=np.int64)
        windows = windows_of(buf)
        for size_of, own in by_length(length):
            self._take(windows, own, size_of)

    def _take(self, windows: np.ndarray, own: np.ndarray, length: int) -> None:
        """Find places for the occurrences ``own``, all of one length."""
        begin = self.begin[own]
        if length < LONG:
            keys = xxhash64(windows, begin, length)
        else:
            keys = np.array([xxhash.xxh64_intdigest(self.buf[b : b + length]) for b in begin], dtype=np.uint64)
        mask = np.uint64(len(self.owner) - 1)
        place = (keys & mask).astype(np.int64)
        todo = np.arange(len(own))
        while len(todo):
            at = place[todo]
            free = self.owner[at] < 0
            # Of several that want one empty place, the one written last has it; the others look at it as a taken one.
            self.owner[at[free]] = own[todo[free]]
            self.keys[at[free]] = keys[todo[free]]
            holder = self.owner[at]
            same = (self.length[holder] == length) & (self.keys[at] == keys[todo])
            other = self.begin[holder]
            mine = begin[todo]
            for k in range(0, length, 8):
                part = windows[mine + k] ^ windows[np.where(same, other, mine) + k]
                if length - k < 8:
                    part &= np.uint64((1 << (8 * (length - k))) - 1)
                same &= part == 0
            self.slot[own[todo[same]]] = at[same]
            todo = todo[~same]
            place[todo] = (place[todo] + 1) & (len(self.owner) - 1)

    def taken(self) -> np.ndarray:
        return np.flatnonzero(self.owner >= 0)


class Grams:
    """The n-grams of some pieces of texts: buckets and counts per slot, and the slot of every occurrence.

    ``row`` is, for every occurrence, the row its text stands in.
    """

    def __init__(self, pieces: list[tuple[int, bytes, int]], longest: int, buckets: int) -> None:
        joined = np.frombuffer(b"\n".join([*(p for _, p, _ in pieces), b""]), dtype=np.uint8)
        sizes = np.fromiter((len(p) + 1 for _, p, _ in pieces), dtype=np.int64, count=len(pieces))
        starts = np.concatenate([[0], np.cumsum(sizes)])
        begin, end, firsts = spans.word_spans(joined, starts, spans.ALNUM)
        # All words behind each other with one blank after each, so that an n-gram is one span of bytes.
        keep = spans.ALNUM[joined]
        keep[end] = True
        buf = joined[keep]
        size = end - begin
        at = np.cumsum(size + 1) - size - 1
        buf[at + size] = 32
        piece = np.repeat(np.arange(len(pieces)), np.diff(firsts))
        rows = np.fromiter((r for r, _, _ in pieces), dtype=np.int64, count=len(pieces))
        known = np.fromiter((k for _, _, k in pieces), dtype=np.int64, count=len(pieces))
        fresh = np.arange(len(begin)) >= (firsts[:-1] + known)[piece]
        self.words = np.bincount(rows[piece[fresh]], minlength=int(rows.max()) + 1 if len(rows) else 0)
        first, last = [], []
        for n in range(1, longest + 1):
            i = np.arange(max(len(begin) - n + 1, 0))
            i = i[(piece[i] == piece[i + n - 1]) & fresh[i + n - 1]]
            first.append(i)
            last.append(i + n - 1)
        a, b = np.concatenate(first), np.concatenate(last)
        self.row = rows[piece[a]]
        table = Interned(buf, at[a], at[b] + size[b] - at[a])
        self.slot = table.slot
        self.taken = table.taken()
        held = table.owner[self.taken]
        self.bucket = np.zeros(len(table.owner), dtype=np.int64)
        self.bucket[self.taken] = crc32(buf, table.begin[held], table.length[held]) % np.uint32(buckets)
        self.count = np.bincount(self.slot, minlength=len(table.owner))

    def histogram(self, buckets: int) -> np.ndarray:
        """Occurrences per bucket, from the counts of the slots."""
        out = np.zeros(buckets, dtype=np.int64)
        np.add.at(out, self.bucket[self.taken], self.count[self.taken])
        return out

    def gathered(self, values: np.ndarray) -> np.ndarray:
        """The value of its bucket for every occurrence."""
        return values[self.bucket][self.slot]


def pieces_of(texts: list[str | None], longest: int, limit: int = PIECE_BYTES) -> Iterator[list[tuple[int, bytes, int]]]:
    """Lists of (row, lower-case bytes, words known from the piece before) with about ``limit`` bytes each.

    A text beyond the limit is cut where no word stands (a single longer word stays whole).
    """
    some: list[tuple[int, bytes, int]] = []
    held = 0
    for row, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER)
        known: list[bytes] = []
        at = 0
        while True:
            gap = _BREAK.search(raw, at + limit) if len(raw) - at > limit else None
            stop = gap.start() if gap else len(raw)
            piece = b" ".join([*known, raw[at:stop]])
            some.append((row, piece, len(known)))
            held += len(piece)
            if held >= limit:
                yield some
                some, held = [], 0
            if stop == len(raw):
                break
            known = _WORD.findall(piece)[-(longest - 1) :] if longest > 1 else []
            at = stop
    if some:
        yield some
