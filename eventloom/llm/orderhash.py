"""Near-duplicate documents by order MinHash, verified by banded alignment."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm import spans
from eventloom.llm.base import written
from eventloom.llm.components import components

#: Words of a k-mer, and the edit similarity from which two texts are near duplicates.
KMER, SIMILARITY = 5, 0.8

#: K-mers that one sketch value holds in text order, and the number of random orders. Each order gives two values: one of its
#: smallest k-mers in text order, and one of the smallest alone. Two texts with a Jaccard similarity j of their labelled k-mers
#: agree in a value of two k-mers with about j * j, and in one of a single k-mer with j. At edit similarity s a k-mer survives
#: with s ** 5, so that j is 0.42 at 0.9 and 0.20 at 0.8: there the single k-mers miss a pair with 0.8 ** 20 = 0.01.
ORDERED, SKETCHES = 2, 20

#: Fewest and most bytes of a text's bag of words, members of a bucket that meet in one block, and rows of one group of blocks, about.
BAG, BAG_MOST, BLOCK, GROUP_ROWS = 64, 4096, 1000, 10_000

#: Ids of asked texts that one broadcast holds (about 20 MB), and the portions of so many ids for each of which the texts are scanned once.
ASKED, PORTIONS = 500_000, 8


def sketch_values(buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of words, two hashes of all words, and the sketch values (one row each) of every packed text.

    Each k-mer is labelled with the number of equal k-mers before it in its text. Under each of the random orders
    the smallest labelled k-mers are taken and hashed in the order in which they stand in the text; the second half of
    the values are hashes of the smallest alone.
    A text of fewer words than a k-mer has its whole text as its only k-mer.
    """
    return _sketch(*_words(buf, starts))


def _words(buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where the words of each text begin."""
    low = spans.LOWER[buf]
    begin, end, firsts = spans.word_spans(low, starts, spans.ALNUM)
    return spans.span_hash(spans.prefix_sums(low), begin, end), firsts


def _bags(words: np.ndarray, firsts: np.ndarray) -> list[bytes]:
    """Whether the words of every text that fall on each of some places by their hash are odd in number, a bit for each place.

    Each word is labelled with the number of equal words before it in its text, so that repeated words count as often as they stand there.
    There are four places or more for a word, a power of two, so a bag is folded to one with fewer places by the exclusive or
    of what falls together.
    """
    n = np.diff(firsts)
    own = words ^ spans.mixed(np.repeat(np.arange(1, len(n) + 1, dtype=np.uint64), n))
    order = np.argsort(own, kind="stable")
    opening = np.flatnonzero(np.append(True, own[order][1:] != own[order][:-1])) if len(own) else order
    label = np.empty(len(own), dtype=np.uint64)
    label[order] = np.arange(len(own)) - np.repeat(opening, np.diff(np.append(opening, len(own))))
    words = words + label * np.uint64(0x9E3779B97F4A7C15)
    places = np.clip(2 ** np.ceil(np.log2(np.maximum(n, 1) * 4)).astype(np.int64), 8 * BAG, 8 * BAG_MOST)
    begins = np.cumsum(places) - places
    at = np.repeat(begins, n) + (spans.mixed(words) >> np.uint64(40)).astype(np.int64) % np.repeat(places, n)
    odd = np.packbits((np.bincount(at, minlength=int(places.sum())) & 1).astype(np.uint8), bitorder="little")
    return [odd[i : i + m].tobytes() for i, m in zip((begins // 8).tolist(), (places // 8).tolist())]


def _folded(bags: np.ndarray, size: int) -> np.ndarray:
    """Bags (one row each, of 8 bytes a column) over fewer places: of ``size`` bytes."""
    if bags.shape[1] * 8 == size:
        return bags
    return np.bitwise_xor.reduce(bags.reshape(len(bags), -1, size // 8), axis=1)


def _stacked(bags: list[bytes], size: int) -> np.ndarray:
    """Bags of several sizes, folded to ``size`` bytes."""
    out = np.empty((len(bags), size // 8), dtype=np.uint64)
    sizes = np.array([len(b) for b in bags], dtype=np.int64)
    for many in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == many)
        out[rows] = _folded(np.frombuffer(b"".join(bags[i] for i in rows), dtype=np.uint64).reshape(-1, many // 8), size)
    return out


def _most_apart(one: np.ndarray, other: np.ndarray, least: float) -> np.ndarray:
    """The places in which the bags of two texts of so many words differ at most at a similarity of ``least``; below 0 if no such texts are.

    A replaced word changes two places of a bag at most, an inserted or removed one changes one, and lengths that differ need as many of the
    latter.
    """
    gap = np.abs(one - other)
    most = ((1.0 - least) * np.maximum(one, other) + 1e-9).astype(np.int64)
    return np.where(gap <= most, 2 * most - gap, -1)


def _sketch(words: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n_words = np.diff(firsts)
    whole = _whole(words, firsts), _whole(spans.mixed(words + np.uint64(0x5851F42D4C957F2D)), firsts)

    place = np.flatnonzero(spans.inside(firsts, KMER))
    kmer = spans.run_hash(words, KMER)[place]
    short = np.flatnonzero((n_words > 0) & (n_words < KMER))
    place, kmer = np.concatenate([place, firsts[short]]), np.concatenate([kmer, whole[0][short]])
    text = np.searchsorted(firsts, place, side="right") - 1
    order = np.argsort(place, kind="stable")
    place, kmer, text = place[order], kmer[order], text[order]
    values = np.zeros((len(n_words), 2 * SKETCHES), dtype=np.uint64)
    if not len(place):
        return n_words, *whole, values

    order = np.lexsort((place, kmer, text))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (np.diff(text[order]) != 0) | (kmer[order][1:] != kmer[order][:-1])
    opening = np.flatnonzero(new)
    label = np.empty_like(kmer)
    label[order] = np.arange(len(order)) - np.repeat(opening, np.diff(np.append(opening, len(order))))
    label = spans.mixed(kmer ^ spans.mixed(label + np.uint64(1)))

    own = np.flatnonzero(n_words > 0)
    opening = np.searchsorted(text, own)
    at = np.arange(len(place))
    row = np.repeat(np.arange(len(own)), np.diff(np.append(opening, len(place))))
    highest = np.uint64(2**64 - 1)
    for j in range(SKETCHES):
        rank = spans.mixed(label ^ spans.mixed(np.array([j + 1], dtype=np.uint64)))
        taken = np.empty((ORDERED, len(own)), dtype=np.int64)
        for i in range(ORDERED):
            least = np.minimum.reduceat(rank, opening)
            # The first place of the minimum; a text with fewer k-mers than that repeats its last one.
            where = np.minimum.reduceat(np.where(rank == least[row], at, len(at)), opening)
            taken[i] = where if i == 0 else np.where(least == highest, taken[i - 1], where)
            rank[taken[i]] = highest
        values[own, SKETCHES + j] = spans.mixed(label[taken[0]] ^ spans.mixed(np.array([SKETCHES + j + 1], dtype=np.uint64)))
        taken.sort(axis=0)
        value = np.full(len(own), j, dtype=np.uint64)
        for i in range(ORDERED):
            value = spans.mixed(value * np.uint64(0x9E3779B97F4A7C15) + kmer[taken[i]])
        values[own, j] = value
    return n_words, *whole, values


def _whole(words: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """A hash of all words of every text."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(words * spans.powers(spans._BASE, len(words)))])
    rest = spans.powers(spans._INVERSE, len(sums))
    return spans.mixed((sums[firsts[1:]] - sums[firsts[:-1]]) * rest[firsts[:-1]] + np.diff(firsts).astype(np.uint64))


def banded_distance(a: list, b: list, most: int) -> int | None:
    """Edits (insert, delete, replace) between two sequences if they are ``most`` or fewer, else None.

    Only the diagonals within ``most`` of the main one are computed. A column of that band is held as two
    whole numbers, whose bits say where the distance rises or falls by one, and the columns are stepped through with
    word operations; the band moves down one row with each column.
    """
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > most:
        return None
    width = 2 * most + 1
    full = (1 << width) - 1
    where: dict = {}
    for i, item in enumerate(a):
        where[item] = where.get(item, 0) | 1 << i
    # In column j (from 0), bit r stands for item j - most + r of ``a``. Above the first item nothing rises or
    # falls, so that the distance grows by one with each column there.
    rises, falls = full ^ ((1 << most) - 1), 0
    distance = min(most, len(a))  # at the foot of the band, or at the end of ``a``
    low_bit = 1 << (width - 1)
    for j, item in enumerate(b):
        start = j - most
        bits = where.get(item, 0)
        match = (bits >> start if start >= 0 else bits << -start) & full
        diagonal = ((((match & rises) + rises) ^ rises) | match | falls) & full
        up = falls | (full & ~(diagonal | rises))
        down = diagonal & rises
        lowest = j + most + 1
        if lowest <= len(a):
            distance += 0 if diagonal & low_bit else 1
        else:
            # The last row of a is above the foot of the band: follow it to the right.
            bit = 1 << (len(a) - 1 - start)
            distance += 1 if up & bit else -1 if down & bit else 0
        shifted = diagonal >> 1
        rises = (down | (full & ~(shifted | up))) & full
        falls = shifted & up
    return distance if distance <= most else None


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float | None:
    """1 - edits / words of the longer text, by banded alignment of the word hashes, if it is ``least`` or more."""
    longest = max(len(a), len(b))
    most = int((1.0 - least) * longest + 1e-9)
    if abs(len(a) - len(b)) > most:
        return None
    # Equal beginnings and ends need no alignment.
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[:short] != b[:short])
    front = int(differ[0]) if len(differ) else short
    a, b = a[front:], b[front:]
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[len(a) - short :] != b[len(b) - short :])
    back = short - 1 - int(differ[-1]) if len(differ) else short
    a, b = a[: len(a) - back], b[: len(b) - back]
    # Words without a partner must be edited: texts of one topic mostly end here.
    items = np.unique(np.concatenate([a, b]), return_inverse=True)[1]
    mine, theirs = (np.bincount(x, minlength=int(items.max(initial=-1)) + 1) for x in (items[: len(a)], items[len(a) :]))
    if max(len(a), len(b)) - int(np.minimum(mine, theirs).sum()) > most:
        return None
    edits = banded_distance(items[: len(a)].tolist(), items[len(a) :].tolist(), most)
    return None if edits is None else 1.0 - edits / longest


def _sketched(documents: DataFrame) -> DataFrame:
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, buf, starts in spans.blocks(batches):
            words, firsts = _words(buf, starts)
            n_words, one, two, values = _sketch(words, firsts)
            bags = pa.array(_bags(words, firsts), pa.binary())
            flat = pa.array(values.reshape(-1).view(np.int64))
            offsets = pa.array(np.arange(0, values.size + 1, 2 * SKETCHES, dtype=np.int32))
            columns = [part.column("doc"), pa.array(n_words), *[pa.array(x.view(np.int64)) for x in (one, two)]]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.ListArray.from_arrays(offsets, flat), bags],
                names=["doc", "n_words", "one", "two", "sketch", "bag"],
            )

    return documents.mapInArrow(sketch, "doc long, n_words long, one long, two long, sketch array<long>, bag binary")


def _verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (``lead``, ``doc``) with their similarity, null if it is below ``least``."""
    lead = texts.select(F.col("doc").alias("lead"), F.col("text").alias("lead_text"))
    # Neither side has a proven bound, so neither is broadcast, at any size.
    both = pairs.hint("merge").join(lead, "lead").hint("merge").join(texts, "doc").select("lead", "doc", "lead_text", "text")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, buf, starts in spans.blocks(batches):
            mine = _word_hashes(buf, starts)
            theirs = _word_hashes(*spans.packed(part.column("lead_text").to_pylist()))
            found = [similarity(a, b, least) for a, b in zip(mine, theirs, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("lead"), part.column("doc"), pa.array(found, pa.float64())],
                names=["lead", "doc", "similarity"],
            )

    return both.mapInArrow(verify, "lead long, doc long, similarity double")


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is one of ``ids`` (``doc``, distinct).

    Most texts are not asked for, so the ids go to the texts and only asked texts are shuffled later. More than ``ASKED`` ids go in portions,
    with one scan of the texts for each; more than ``PORTIONS`` of them meet the texts in a shuffle of both.
    """
    ids = written(ids)
    portions = max(1, -(-ids.count() // ASKED))
    if portions > PORTIONS:
        return docs.hint("merge").join(ids, "doc", "left_semi")
    own = F.pmod(F.xxhash64("doc"), F.lit(portions))
    return reduce(DataFrame.unionByName, [docs.join(F.broadcast(ids.where(own == i)), "doc", "left_semi") for i in range(portions)])


def _word_hashes(buf: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    low = spans.LOWER[buf]
    begin, end, firsts = spans.word_spans(low, starts, spans.ALNUM)
    return np.split(spans.span_hash(spans.prefix_sums(low), begin, end), firsts[1:-1])


def _possible(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (``lead``, ``doc``), and whether the lengths and bags of words of ``texts`` allow a similarity of ``least``.

    A pair of documents with several texts comes once for each pair of them.
    """
    lead = texts.select(F.col("doc").alias("lead"), F.col("n_words").alias("lead_words"), F.col("bag").alias("lead_bag"))
    both = pairs.hint("merge").join(lead, "lead").hint("merge").join(texts.select("doc", "n_words", "bag"), "doc")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            limit = _most_apart(*(batch.column(n).to_numpy() for n in ("n_words", "lead_words")), least)
            mine, theirs = batch.column("bag").to_pylist(), batch.column("lead_bag").to_pylist()
            sizes = np.array([min(len(a), len(b)) for a, b in zip(mine, theirs, strict=True)], dtype=np.int64)
            near = np.zeros(len(limit), dtype=bool)
            for size in np.unique(sizes[limit >= 0]).tolist():
                own = np.flatnonzero((sizes == size) & (limit >= 0))
                one, other = (_stacked([bags[i] for i in own], size) for bags in (mine, theirs))
                near[own] = np.bitwise_count(one ^ other).sum(axis=1, dtype=np.int64) <= limit[own]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lead"), batch.column("doc"), pa.array(near)], names=["lead", "doc", "possible"]
            )

    return both.mapInArrow(judge, "lead long, doc long, possible boolean")


def _led(keyed: DataFrame) -> DataFrame:
    """Every document of a bucket (``value``) with the smallest one: pairs (``lead``, ``doc``)."""
    lead = keyed.groupBy("value").agg(F.min("doc").alias("lead"), F.max("doc").alias("last")).where("lead <> last")
    return keyed.hint("merge").join(lead.select("value", "lead"), "value").where("doc <> lead").select("lead", "doc").distinct()


def _apart(keyed: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs of a bucket (``value``) whose members are of different classes and can be similar: (``lead``, ``doc``), with the classes of
    both (``lead_class``, ``class``) and the places in which their bags differ (``apart``).

    ``texts`` has ``doc``, ``class``, ``n_words`` and ``bag``. Texts of ``least`` or more differ in length by a factor of ``least``
    at most, so members meet in cells of the logarithm of their lengths, each with those of its own and of the next smaller
    cell. A cell of many members is cut into parts, and each pair of parts is a block of its own, so that no task holds a whole cell.
    In a block every pair is looked at: see :func:`_alike`.
    """
    # Cells are a little wider than that factor, so that no error of a logarithm parts a pair.
    width = math.log(1 / min(max(least, 1e-6), 1 - 1e-6)) * (1 + 1e-9)
    texts = texts.withColumn("own", F.floor(F.log("n_words") / width).cast("int"))
    homes = F.array(F.struct(F.col("own").alias("cell"), F.lit(True).alias("home")), F.struct((F.col("own") + 1).alias("cell"), F.lit(False).alias("home")))
    members = keyed.hint("merge").join(texts.drop("bag"), "doc").select("value", "doc", "class", F.inline(homes))
    sizes = members.groupBy("value", "cell").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("home").alias("homes"), F.min("class").alias("low"), F.max("class").alias("high")
    )
    sizes = sizes.where("low < high and homes > 0")
    sizes = written(sizes.select("value", "cell", "n", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts")))
    total = sizes.agg(F.sum(F.col("n") * F.col("parts"))).first()[0] or 0
    rows = members.select("value", "doc", "home", "cell").distinct().hint("merge").join(sizes, ["value", "cell"])
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc", "value"), F.col("parts")).cast("int"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    block = F.xxhash64("value", "cell", F.least("part", "other"), F.greatest("part", "other"))
    rows = rows.select("doc", "value", "home", "part", (F.col("part") != F.col("other")).alias("two"), block.alias("block"))
    # The bags come last, so that they are sent once; with them all values of a document, of which two documents meet in the smallest common one.
    held = keyed.groupBy("doc").agg(F.collect_set("value").alias("held"))
    rows = rows.hint("merge").join(texts.select("doc", "class", "n_words", "bag").hint("merge").join(held, "doc"), "doc")
    group = F.pmod("block", F.lit(max(1, -(-total // GROUP_ROWS)))).alias("group")
    found = rows.groupBy(group).applyInArrow(lambda t: _alike(t, least), "lead long, doc long, lead_class long, class long, apart long")
    return found.groupBy("lead", "doc", "lead_class", "class").agg(F.min("apart").alias("apart"))


def _alike(table: pa.Table, least: float) -> pa.Table:
    """All pairs of a block, of different classes, whose lengths and bags of words allow a similarity of ``least``, see :func:`_most_apart`.

    Documents that share several values come from the block of the smallest one only.
    """
    table = table.take(pa.compute.sort_indices(table.column("block")))
    block, doc, group, words, part = (table.column(n).to_numpy() for n in ("block", "doc", "class", "n_words", "part"))
    home, two = (table.column(n).to_numpy(zero_copy_only=False) for n in ("home", "two"))
    value, raw = table.column("value").to_pylist(), table.column("bag").to_pylist()
    held = [set(v) for v in table.column("held").to_pylist()]
    places = np.array([len(b) for b in raw], dtype=np.int64)
    begins = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
    fewest = np.repeat(np.minimum.reduceat(places, begins), np.diff(np.append(begins, len(block))))
    ends = np.searchsorted(block, block, side="right")
    found: list[np.ndarray] = []
    for size in np.unique(fewest).tolist():
        # The bags of blocks with one number of places.
        own = np.flatnonzero(fewest == size)
        bags = _stacked([raw[i] for i in own], size)
        coarse = _folded(bags, BAG)
        # Each row with those behind it in its block, about a million pairs at a time.
        behind = ends[own] - own - 1
        sums = np.cumsum(behind)
        at = 0
        while at < len(own):
            upto = max(at + 1, int(np.searchsorted(sums, (sums[at - 1] if at else 0) + 1_000_000, side="right")))
            n = behind[at:upto]
            a = np.repeat(np.arange(at, upto), n)
            b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
            x, y = own[a], own[b]
            limit = _most_apart(words[x], words[y], least)
            keep = (group[x] != group[y]) & (doc[x] != doc[y]) & (home[x] | home[y]) & (limit >= 0) & (~two[x] | (part[x] != part[y]))
            a, b, limit = a[keep], b[keep], limit[keep]
            apart = limit
            for some in (coarse, bags):
                apart = np.zeros(len(a), dtype=np.int64)
                step = max(1, (1 << 20) // some.shape[1])
                for i in range(0, len(a), step):
                    apart[i : i + step] = np.bitwise_count(some[a[i : i + step]] ^ some[b[i : i + step]]).sum(axis=1, dtype=np.int64)
                near = apart <= limit
                a, b, limit, apart = a[near], b[near], limit[near], apart[near]
            x, y = own[a], own[b]
            once = np.array([value[i] == min(held[i] & held[j]) for i, j in zip(x.tolist(), y.tolist())], dtype=bool)
            x, y, apart = x[once], y[once], apart[once]
            x, y = np.where(doc[x] < doc[y], x, y), np.where(doc[x] < doc[y], y, x)
            found.append(np.stack([doc[x], doc[y], group[x], group[y], apart]))
            at = upto
    pairs = np.concatenate(found, axis=1) if found else np.empty((5, 0), dtype=np.int64)
    return pa.table(dict(zip(("lead", "doc", "lead_class", "class", "apart"), pairs)))


def near_duplicates(
    documents: DataFrame, document: str = "doc_id", text: str = "text", least: float = SIMILARITY
) -> DataFrame:
    """Every document with the class of its near duplicates: ``doc_id``, ``class_id`` and ``is_first``.

    Words are runs of letters and digits in lower case. Texts with the same words are one text from the start.
    The others get 20 order-MinHash values of two k-mers and 20 of one; documents that share a value meet in a bucket. There each is
    first compared with the smallest id, by an edit distance over words in a band of ``1 - least`` of the longer text, unless lengths and
    bags of words rule it out. Where a bucket then holds several classes, all its pairs of different classes are looked at, and those not
    ruled out are compared too: no pair that shares a value and is similar stays in two classes. Linked documents, at
    ``least`` or more, form a class named by its smallest id.

    Scale: sketches of about 350 bytes a document; one sum and one join on the values, both with few columns;
    the texts of candidates only are shuffled and joined to the pairs. The pairs of buckets with several classes are made
    in blocks of about 1,000 members, so memory is bounded and the work of one bucket is spread over tasks; it grows with the square of the number of
    different texts of a cell of lengths that share a value, at some 100 ns a pair. The smallest of a bucket comes from a sum with
    map-side combine, and joins on hot values or leads are plain joins that adaptive execution splits.

    Defined cases: null or empty texts, and texts without a word, are classes of their own; documents with a null id are not compared
    and have a null class; rows with one id are one document, which is similar to what any of its texts
    is similar to; an empty table gives an empty result; other columns are not read.
    """
    docs = documents.select(F.col(f"`{document}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text"))
    sketched = written(_sketched(docs.where("doc is not null")))
    # Texts with the same words: the smallest id stands for all.
    copies = sketched.where("n_words > 0").groupBy("one", "two").agg(F.min("doc").alias("first"))
    firsts = copies.select("one", "two", F.col("first").alias("doc"))
    single = written(sketched.join(firsts, ["doc", "one", "two"], "left_semi").select("doc", "n_words", "sketch", "bag"))
    keyed = single.select("doc", F.explode("sketch").alias("value"))
    tried = written(_possible(_led(keyed), sketched.where("n_words > 0"), least))
    pairs = tried.where("possible").select("lead", "doc").distinct()
    named = pairs.select(F.explode(F.array("lead", "doc")).alias("doc")).distinct()
    judged = written(_verified(pairs, _texts_of(docs, named), least))
    links = judged.where("similarity is not null").select(F.col("lead").alias("a"), F.col("doc").alias("b"))
    # Copies of one text link through the first of them, and so do the texts of one document.
    same = sketched.join(copies, ["one", "two"]).where("doc <> first").select(F.col("doc").alias("a"), F.col("first").alias("b"))
    classes = written(_classes(links, same))

    # The buckets of documents that are not similar to their lead; a document has the values it shares with it.
    failed = judged.where("similarity is null").select("doc").unionByName(tried.where("not possible").select("doc")).distinct()
    classed = single.join(classes, F.col("doc") == F.col("node"), "left").withColumn("class", F.coalesce("component", "doc"))
    open_values = keyed.join(failed, "doc", "left_semi").select("value").distinct()
    opened = classed.select("doc", "class", F.explode("sketch").alias("value")).hint("merge").join(open_values, "value")
    mixed = opened.groupBy("value").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high").select("value")
    rest = written(opened.select("doc", "value").distinct().hint("merge").join(mixed, "value", "left_semi"))
    more = _apart(rest, classed.select("doc", "class", "n_words", "bag"), least)
    more = written(more.join(judged.select("lead", "doc"), ["lead", "doc"], "left_anti"))
    # Of two classes first the pair that is closest; the others, if that leaves them apart.
    both = F.least("lead_class", "class").alias("low"), F.greatest("lead_class", "class").alias("high")
    closest = more.groupBy(*both).agg(F.min(F.struct("apart", "lead", "doc")).alias("p")).select("p.lead", "p.doc")
    asked = written(closest)
    joined = _links(asked, docs, least)
    if not joined.isEmpty():
        classes = written(_united(classes, joined))
        for end, group in (("lead", "lead_class"), ("doc", "class")):
            of = classes.select(F.col("node").alias(end), F.col("component").alias("__now"))
            more = more.hint("merge").join(of, end, "left").withColumn(group, F.coalesce("__now", end)).drop("__now")
    others = written(more.where("lead_class <> class").select("lead", "doc").join(asked, ["lead", "doc"], "left_anti"))
    if not others.isEmpty():
        joined = _links(others, docs, least)
        if not joined.isEmpty():
            classes = _united(classes, joined)
    named = sketched.select("doc").distinct().join(classes, F.col("doc") == F.col("node"), "left")
    out = named.select(F.col("doc").alias("doc_id"), F.coalesce("component", "doc").alias("class_id"))
    nameless = docs.where("doc is null").select(F.col("doc").alias("doc_id"), F.lit(None).cast("long").alias("class_id"))
    return out.unionByName(nameless).withColumn("is_first", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))


def _classes(links: DataFrame, same: DataFrame) -> DataFrame:
    return components(links.unionByName(same))


def _links(pairs: DataFrame, docs: DataFrame, least: float) -> DataFrame:
    """The pairs (``lead``, ``doc``) that are similar, verified by the texts of ``docs``."""
    asked = pairs.select(F.explode(F.array("lead", "doc")).alias("doc")).distinct()
    found = _verified(pairs, _texts_of(docs, asked), least)
    return written(found.where("similarity is not null").select("lead", "doc"))


def _united(classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The classes after the links (``lead``, ``doc``) between members of different ones."""
    ends = pairs
    for end in ("lead", "doc"):
        of = classes.select(F.col("node").alias(end), F.col("component").alias("__class"))
        ends = ends.join(of, end, "left").withColumn(end, F.coalesce("__class", end)).drop("__class")
    wider = written(components(ends.select(F.col("lead").alias("a"), F.col("doc").alias("b"))))
    to = wider.select(F.col("node").alias("component"), F.col("component").alias("__to"))
    moved = classes.join(to, "component", "left").select("node", F.coalesce("__to", "component").alias("component"))
    return moved.unionByName(wider.join(classes, "node", "left_anti").select("node", "component"))


def one_of_each(documents: DataFrame, document: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of every class of :func:`near_duplicates`, with its columns: the one with the smallest id.

    Of rows with one id, one stays. Rows without an id all stay.
    """
    found = near_duplicates(documents, document, text, **options).where("is_first and doc_id is not null")
    own = documents.withColumn("__doc", F.col(f"`{document}`").cast("long"))
    kept = own.hint("merge").join(found.select(F.col("doc_id").alias("__doc")), "__doc", "left_semi")
    repeated = own.where("__doc is not null").groupBy("__doc").count().where("count > 1").select("__doc")
    if repeated.limit(1).count():
        kept = written(kept)
        once = kept.join(repeated, "__doc", "left_anti")
        kept = once.unionByName(kept.join(repeated, "__doc", "left_semi").dropDuplicates(["__doc"]))
    return kept.unionByName(own.where("__doc is null")).drop("__doc")
