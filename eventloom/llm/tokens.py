"""Public tokenizers over blocks of texts, with the ids of repeated pieces looked up."""

from __future__ import annotations

import os

import numpy as np

from eventloom.llm import spans

#: Pieces (or units) that a worker remembers: about 100 bytes each. When it is full, the memory starts anew. A little under a power of two, at
#: which the arrays are doubled.
REMEMBERED = 450_000

_SOLID_ASCII = spans.table_of("21-7E")
_LEAD = spans.table_of("C3-DF")
_FOLLOW = spans.table_of("80-BF")
_GAP = spans.table_of("0A 20")

#: Letters, digits and signs of ASCII; the apostrophe has none of these kinds, since it may join letters.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[spans.table_of("41-5A 61-7A")] = 1
_KIND[spans.table_of("30-39")] = 2
_KIND[spans.table_of("21-26 28-2F 3A-40 5B-60 7B-7E")] = 3
_OTHER_BASE = 0xC2B2AE3D27D4EB4F
_OTHER_UNDO = pow(_OTHER_BASE, -1, 2**64)


def public_path(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Pieces that the library gets in one text, parted by line feeds.
JOINED = 2000


class Memory:
    """Numbers (slots, from 0 in the order added) of keys of two independent 64-bit hashes.

    An open-addressed table that is doubled as it fills, so a look-up costs the same however many keys are remembered.
    """

    def __init__(self) -> None:
        self.size = 0
        self.first, self.second = (np.empty(1 << 12, dtype=np.uint64) for _ in range(2))
        self.places = np.full(1 << 13, -1, dtype=np.int64)

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The slots of the keys, -1 for unknown ones."""
        slots = np.full(len(first), -1, dtype=np.int64)
        mask = len(self.places) - 1
        todo, at = np.arange(len(first)), (first & np.uint64(mask)).astype(np.int64)
        while len(todo):
            held = self.places[at]
            same = (held >= 0) & (self.first[held] == first[todo]) & (self.second[held] == second[todo])
            slots[todo[same]] = held[same]
            on = (held >= 0) & ~same
            todo, at = todo[on], (at[on] + 1) & mask
        return slots

    def add(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Slots for distinct keys that are not known yet."""
        slots = np.arange(self.size, self.size + len(first))
        self.size += len(first)
        self.first, self.second = (grown(x, self.size) for x in (self.first, self.second))
        self.first[slots], self.second[slots] = first, second
        if 2 * self.size > len(self.places):
            while 2 * self.size > len(self.places):
                self.places = np.empty(2 * len(self.places), dtype=np.int64)
            self.places[:] = -1
            self._place(np.arange(self.size))
        else:
            self._place(slots)
        return slots

    def _place(self, slots: np.ndarray) -> None:
        mask = len(self.places) - 1
        at = (self.first[slots] & np.uint64(mask)).astype(np.int64)
        while len(slots):
            free = self.places[at] < 0
            self.places[at[free]] = slots[free]
            on = self.places[at] != slots
            slots, at = slots[on], (at[on] + 1) & mask


def grown(array: np.ndarray, size: int) -> np.ndarray:
    """The array, with room for ``size`` values: its own length is doubled as often as needed."""
    if size <= len(array):
        return array
    out = np.empty(max(2 * len(array), size), dtype=array.dtype)
    out[: len(array)] = array
    return out


def span_keys(buf: np.ndarray, begin: np.ndarray, end: np.ndarray, sums: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of the byte spans."""
    codes = spans.span_hash(spans.prefix_sums(buf) if sums is None else sums, begin, end)
    other = np.empty(len(buf) + 1, dtype=np.uint64)
    other[0] = 0
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * spans.powers(_OTHER_BASE, len(buf)), out=other[1:])
    undo = spans.powers(_OTHER_UNDO, len(buf) + 1)
    return codes, (other[end] - other[begin]) * undo[begin]


def distinct_keys(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct key stands first, and the number of its key for every place."""
    order = np.lexsort((second, first))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (first[order][1:] != first[order][:-1]) | (second[order][1:] != second[order][:-1])
    which = np.empty(len(order), dtype=np.int64)
    which[order] = np.cumsum(new) - 1
    return order[new], which


_encoders: dict[str, PieceEncoder] = {}


def piece_encoder(path: str) -> PieceEncoder:
    """The encoder of this process for a vocabulary; the tasks that a worker runs one after the other share what it remembers."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


class PieceEncoder:
    """The ``tokenizers`` library over blocks of texts, for vocabularies that split texts at white space first.

    A byte-level pre-tokenizer never joins what stands before a single space or line feed between two visible
    characters with what stands behind it, nor ASCII letters, digits and signs (but for the apostrophe), so a text can be cut there and the ids of its pieces concatenated.
    Pieces repeat a lot: the library encodes each new piece once, and the ids of a known piece are looked up by
    two independent 64-bit hashes (see :class:`Memory`). Where a character next to a gap is not surely visible (anything
    beyond two bytes of UTF-8), the text is not cut there; a text that contains the text of a special token is not cut at all.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.remembered = remembered
        probe = self._library_ids(["\n", "a\n b\n\nc\nd", "a", " b", "c", "d"])
        self.feed = probe[0][0]
        want = [*probe[2], self.feed, *probe[3], self.feed, self.feed, *probe[4], self.feed, *probe[5]]
        #: Whether a line feed is a token of its own between pieces.
        self.parts = len(probe[0]) == 1 and probe[1].tolist() == want
        self._forget()

    def _forget(self) -> None:
        self.memory = Memory()
        self.begins, self.counts = (np.empty(1 << 12, dtype=np.int64) for _ in range(2))
        self.ids, self.used = np.empty(1 << 14, dtype=np.uint32), 0

    def _pieces(self, buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        solid_after = _SOLID_ASCII[buf] | _LEAD[buf]
        solid_before = _SOLID_ASCII[buf]
        solid_before[1:] |= _FOLLOW[buf[1:]] & _LEAD[buf[:-1]]
        cut = _GAP[buf]
        cut[0] = False
        cut[1:] &= solid_before[:-1]
        cut[:-1] &= solid_after[1:]
        kind = _KIND[buf]
        cut[1:] |= (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
        cut[starts[1:] - 1] = False
        raw = buf.tobytes()
        for mark in self.special:
            at = raw.find(mark)
            while at >= 0:
                text = int(np.searchsorted(starts, at, side="right")) - 1
                cut[starts[text] : starts[text + 1]] = False
                at = raw.find(mark, int(starts[text + 1]))
        cut[starts[:-1]] = True  # empty texts begin at their own line feed and make an empty piece
        begin = np.flatnonzero(cut)
        end = np.append(begin[1:], len(buf))
        end[np.searchsorted(begin, starts[1:-1]) - 1] -= 1
        end[-1] -= 1
        return begin, end

    def __call__(self, buf: np.ndarray, starts: np.ndarray, sums: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all packed texts, one after the other, and their number for every text."""
        if len(starts) < 2:
            return np.empty(0, dtype=np.uint32), np.empty(0, dtype=np.int64)
        begin, end = self._pieces(buf, starts)
        codes, checks = span_keys(buf, begin, end, sums)
        if self.memory.size > self.remembered:
            self._forget()
        slots = self.memory.find(codes, checks)
        unknown = np.flatnonzero(slots < 0)
        if len(unknown):
            where, which = distinct_keys(codes[unknown], checks[unknown])
            new = unknown[where]
            added = self.memory.add(codes[new], checks[new])
            slots[unknown] = added[which]
            ids, counts = self._encoded(buf, begin[new], end[new])
            self.begins, self.counts = (grown(x, self.memory.size) for x in (self.begins, self.counts))
            self.counts[added] = counts
            self.begins[added] = self.used + np.cumsum(counts) - counts
            self.ids = grown(self.ids, self.used + len(ids))
            self.ids[self.used : self.used + len(ids)] = ids
            self.used += len(ids)
        counts = self.counts[slots]
        at = np.cumsum(counts) - counts
        out = self.ids[np.repeat(self.begins[slots] - at, counts) + np.arange(int(counts.sum()))]
        firsts = np.searchsorted(begin, starts)
        return out, spans.per_text(counts, firsts)

    def _encoded(self, buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces, one after the other, and their number for every piece.

        Visible pieces behind one blank or line feed at most can stand in one text, parted by line feeds: white
        space of a line feed before a blank, a line feed or a visible character is split off one by one. That saves
        the library a call for every piece; the feeds are found again by their id.
        """
        raw = buf.tobytes()
        solid = _SOLID_ASCII[buf] | _LEAD[buf] | _FOLLOW[buf]
        hollow = np.concatenate([[0], np.cumsum(~solid)])
        gap = _GAP[buf[np.minimum(begin, len(buf) - 1)]] & (end > begin)
        plain = (end - begin > gap) & (hollow[end] == hollow[np.minimum(begin + gap, end)]) & self.parts
        if any(mark in raw for mark in self.special):
            plain &= [not any(mark in raw[a:b] for mark in self.special) for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
        joined, odd = np.flatnonzero(plain), np.flatnonzero(~plain)
        feeds = buf[begin[joined]] == 10
        parts: list[np.ndarray] = []
        counts = np.zeros(len(begin), dtype=np.int64)
        texts, cuts = [], range(0, len(joined), JOINED)
        a, b = begin[joined].tolist(), end[joined].tolist()
        for k in cuts:
            texts.append(b"\n".join([raw[x:y] for x, y in zip(a[k : k + JOINED], b[k : k + JOINED], strict=True)]).decode("utf-8"))
        for k, found in zip(cuts, self._library_ids(texts), strict=True):
            own = joined[k : k + JOINED]
            ids = np.append(found, self.feed)
            stops = np.flatnonzero(ids == self.feed)[np.cumsum(1 + feeds[k : k + JOINED]) - 1]
            sizes = np.diff(stops, prepend=-1) - 1
            ids = np.delete(ids, stops)
            parts.append(ids)
            counts[own] = sizes
        a, b = begin[odd].tolist(), end[odd].tolist()
        singly = self._library_ids([raw[x:y].decode("utf-8") for x, y in zip(a, b, strict=True)])
        counts[odd] = [len(x) for x in singly]
        # Back to the order of the pieces.
        flat = np.concatenate([np.empty(0, dtype=np.uint32), *parts, *singly])
        order = np.concatenate([joined, odd])
        sizes = counts[order]
        source = np.empty(len(begin), dtype=np.int64)
        source[order] = np.cumsum(sizes) - sizes
        out = np.cumsum(counts) - counts
        return flat[np.repeat(source - out, counts) + np.arange(int(counts.sum()))], counts

    def _library_ids(self, texts: list[str]) -> list[np.ndarray]:
        encode = getattr(self.library, "encode_batch_fast", self.library.encode_batch)
        return [np.array(e.ids, dtype=np.uint32) for e in encode(texts, add_special_tokens=False)]


class FallbackCounter:
    """Tokens of a sentencepiece vocabulary, and those of them that spell bytes, for every text of a block.

    Such a vocabulary writes a blank as its own mark, and its pieces have that mark at their begin only; a line feed
    is no part of any longer piece. So texts can be cut before every run of blanks and before every line feed, and the numbers of the units add
    up. Each new unit is encoded once, see :class:`Memory`. A unit behind a blank is encoded without it, since the library
    puts the mark before every text; one behind a line feed has one token too many for that. A vocabulary with other pieces
    encodes whole texts.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        import sentencepiece

        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.vocab_size())]
        gaps = {f"<0x{b:02X}>" for b in (*range(9, 14), 32)}
        #: White space is spelt in bytes by some vocabularies; that says nothing about the text.
        self.spelt = np.array([self.pieces.is_byte(i) and n not in gaps for i, n in enumerate(names)])
        mark = "\u2581"
        self.mark = mark.encode()
        self.parts = not any(mark in n.lstrip(mark) or ("\n" in n and n != "\n") for n in names)
        self.parts = self.parts and [len(x) for x in self.pieces.encode(["a", " a", "\na", "a\na  a "])] == [1, 2, 3, 6]
        self.remembered = remembered
        self._forget()

    def _forget(self) -> None:
        self.memory = Memory()
        self.numbers = np.empty((1 << 12, 2), dtype=np.int64)

    def _counted(self, texts: list[str]) -> np.ndarray:
        """Tokens and spelt bytes of every text."""
        found = self.pieces.encode(texts, num_threads=1)
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        flat = self.spelt[np.fromiter((i for x in found for i in x), dtype=np.int64, count=int(sizes.sum()))]
        sums = np.concatenate([[0], np.cumsum(flat)])
        ends = np.cumsum(sizes)
        return np.stack([sizes, sums[ends] - sums[ends - sizes]], axis=1).astype(np.int64)

    def __call__(self, buf: np.ndarray, starts: np.ndarray, sums: np.ndarray | None = None) -> np.ndarray:
        """A row (tokens, spelt bytes) for every packed text."""
        if len(starts) < 2:
            return np.zeros((0, 2), dtype=np.int64)
        raw = buf.tobytes()
        if not self.parts:
            return self._counted([raw[a : b - 1].decode("utf-8") for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)])
        cut = buf == 32
        cut[1:] &= buf[:-1] != 32
        cut |= buf == 10
        cut[starts[1:] - 1] = False  # the line feeds behind the texts
        at = raw.find(self.mark)
        while at >= 0:  # a text that has the mark itself stays whole
            text = int(np.searchsorted(starts, at, side="right")) - 1
            cut[starts[text] : starts[text + 1]] = False
            at = raw.find(self.mark, int(starts[text + 1]))
        cut[starts[:-1]] = True
        begin = np.flatnonzero(cut)
        end = np.append(begin[1:], len(buf))
        firsts = np.searchsorted(begin, starts)
        end[firsts[1:] - 1] -= 1
        opens = np.zeros(len(begin), dtype=bool)
        opens[firsts[:-1]] = True
        fed = ~opens & (buf[begin] == 10)
        behind = ~opens & ~fed  # these begin with a blank that is left out
        first, second = span_keys(buf, begin + behind, end, sums)
        second = second ^ fed.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        if self.memory.size > self.remembered:
            self._forget()
        slots = self.memory.find(first, second)
        unknown = np.flatnonzero(slots < 0)
        if len(unknown):
            where, which = distinct_keys(first[unknown], second[unknown])
            new = unknown[where]
            added = self.memory.add(first[new], second[new])
            slots[unknown] = added[which]
            a, b = (begin + behind)[new].tolist(), end[new].tolist()
            found = self._counted([raw[x:y].decode("utf-8") for x, y in zip(a, b, strict=True)])
            found[:, 0] -= fed[new]
            if self.memory.size > len(self.numbers):
                room = np.empty((max(2 * len(self.numbers), self.memory.size), 2), dtype=np.int64)
                room[: len(self.numbers)] = self.numbers
                self.numbers = room
            self.numbers[added] = found
        numbers = self.numbers[slots]
        # A blank alone, before a line feed or at the end, is a token that the empty unit does not show.
        numbers[behind & (end == begin + 1), 0] = 1
        return np.stack([spans.per_text(numbers[:, k], firsts) for k in (0, 1)], axis=1)


_counters: dict[str, FallbackCounter] = {}


def fallback_counter(path: str) -> FallbackCounter:
    """The counter of this process for a vocabulary, see :func:`piece_encoder`."""
    if path not in _counters:
        _counters[path] = FallbackCounter(path)
    return _counters[path]
