"""Byte blocks, word spans and rolling hashes shared by the corpus operators.

Everything here works on one bounded block of texts inside a task. Spark decides which texts meet in
a task; nothing in this module gathers rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that one numpy step handles at once. A longer single text forms a block of its own.
BLOCK_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_ALPHABET = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    """base**0 .. base**(count-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < count:
        steps = np.full(max(count, 1 << 16), base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps)
    return have[:count]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def table_of(pattern: str) -> np.ndarray:
    """256 flags: which bytes belong to the class written as hexadecimal ranges, such as ``30-39 61-7A``."""
    flags = np.zeros(256, dtype=bool)
    for part in pattern.split():
        low, _, high = part.partition("-")
        flags[int(low, 16) : int(high or low, 16) + 1] = True
    return flags


#: ASCII upper case to lower case, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Words of letters and digits; every byte of a non-ASCII character counts as a letter.
ALNUM = table_of("30-39 61-7A 80-FF")

#: Words between white space.
GRAPHIC = ~table_of("09-0D 20")


def packed(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, each followed by a line feed, and the start of every text (one more at the end)."""
    encoded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded))
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    return np.frombuffer(b"\n".join([*encoded, b""]), dtype=np.uint8), starts


def blocks(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with at most ``limit`` bytes of text (one text at least), and their packed bytes."""
    for batch in batches:
        texts = batch.column(column).to_pylist()
        first, size = 0, 0
        for i, text in enumerate(texts):
            own = len(text or "")
            if i > first and size + own > limit:
                yield batch.slice(first, i - first), *packed(texts[first:i])
                first, size = i, 0
            size += own
        if first < len(texts):
            yield batch.slice(first), *packed(texts[first:])


def word_spans(buf: np.ndarray, starts: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every maximal run of bytes of ``kind``, and the first word of every text (one more at the end).

    The line feed between texts must not be of that kind.
    """
    edges = np.flatnonzero(np.diff(kind[buf], prepend=False, append=False))
    begin, end = edges[0::2], edges[1::2]
    return begin, end, np.searchsorted(begin, starts)


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    """Running polynomial sums of a byte array; see :func:`span_hash`."""
    sums = np.empty(len(buf) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_ALPHABET[buf] * powers(_BASE, len(buf)), out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans; equal spans have equal hashes wherever they stand."""
    return mixed((sums[end] - sums[begin]) * powers(_INVERSE, len(sums))[begin])


def run_hash(values: np.ndarray, length: int) -> np.ndarray:
    """A hash of every ``length`` consecutive 64-bit values (fewer values than that: none)."""
    if len(values) < length:
        return np.empty(0, dtype=np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(values * powers(_BASE, len(values)))])
    return mixed((sums[length:] - sums[:-length]) * powers(_INVERSE, len(values))[: len(sums) - length])


def inside(firsts: np.ndarray, length: int) -> np.ndarray:
    """Flags for window starts: the ``length`` items from there lie in one text. ``firsts`` as in :func:`word_spans`."""
    total = int(firsts[-1])
    flags = np.zeros(max(total - length + 1, 0), dtype=bool)
    for a, b in zip(firsts[:-1], firsts[1:], strict=True):
        if b - a >= length:
            flags[a : b - length + 1] = True
    return flags


def covered(begin: np.ndarray, length: int | np.ndarray, total: int) -> np.ndarray:
    """Flags of the ``total`` places that lie in any of the spans ``[begin, begin + length)``."""
    steps = np.zeros(total + 1, dtype=np.int64)
    np.add.at(steps, begin, 1)
    np.add.at(steps, begin + length, -1)
    return np.cumsum(steps[:-1]) > 0


def per_text(flags: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` (or numbers) for every text whose items are ``firsts[i] .. firsts[i+1]``."""
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[firsts[1:]] - sums[firsts[:-1]]
