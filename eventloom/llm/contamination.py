"""Benchmark decontamination: scan token windows for the n-grams of test items."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm import spans
from eventloom.llm.base import written

#: Words of a window; an item with fewer words is one window by itself.
WINDOW = 10

#: Windows that one broadcast holds: about 150 bytes each, so 60 MB at most. A benchmark with more windows
#: is scanned in several passes over the documents, each with its own broadcast, and the hits are united.
WINDOWS_PER_PASS = 400_000

#: Text of the items (characters) from which one pass is built, for the same bound on the driver.
CHARS_PER_PASS = 24_000_000


class Grams:
    """The distinct windows of some items: hashes by window length, and what is needed to verify a hit."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW) -> None:
        self.by_length: dict[int, dict[int, list[tuple[bytes, tuple[int, ...]]]]] = {}
        self.names: list[str] = []
        found: dict[tuple[int, bytes], set[int]] = {}
        for name, text in items:
            words = normal_words(text)
            if not words:
                continue
            number = len(self.names)
            self.names.append(name)
            length = min(window, len(words))
            for i in range(len(words) - length + 1):
                found.setdefault((length, b" ".join(words[i : i + length])), set()).add(number)
        for (length, phrase), numbers in found.items():
            buf, starts = spans.packed([phrase.decode("utf-8", "surrogatepass")])
            begin, end, _ = spans.word_spans(buf, starts, spans.ALNUM)
            code = int(spans.run_hash(spans.span_hash(spans.prefix_sums(buf), begin, end), length)[0])
            self.by_length.setdefault(length, {}).setdefault(code, []).append((phrase, tuple(sorted(numbers))))
        self.codes = {n: np.sort(np.fromiter(c, dtype=np.uint64, count=len(c))) for n, c in self.by_length.items()}

    def scan(self, buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
        """Word begins, word ends, first words of texts, flags of hit words, and the (text, item) pairs of a block."""
        low = spans.LOWER[buf]
        begin, end, firsts = spans.word_spans(low, starts, spans.ALNUM)
        hit = np.zeros(len(begin), dtype=bool)
        pairs: set[tuple[int, int]] = set()
        words = spans.span_hash(spans.prefix_sums(low), begin, end)
        for length, codes in self.codes.items():
            runs = spans.run_hash(words, length)
            if not len(runs):
                continue
            at = np.minimum(np.searchsorted(codes, runs), len(codes) - 1)
            places = np.flatnonzero((codes[at] == runs) & spans.inside(firsts, length))
            texts = np.searchsorted(firsts, places, side="right") - 1
            sure = []
            for place, text in zip(places.tolist(), texts.tolist(), strict=True):
                # The hash names the candidate; the words themselves decide.
                own = b" ".join(low[begin[i] : end[i]].tobytes() for i in range(place, place + length))
                for phrase, numbers in self.by_length[length][int(runs[place])]:
                    if phrase == own:
                        sure.append(place)
                        pairs.update((text, number) for number in numbers)
            if sure:
                hit |= spans.covered(np.array(sure), length, len(begin))
        return begin, end, firsts, hit, pairs


def normal_words(text: str | None) -> list[bytes]:
    """Lower-case (A-Z) words of letters, digits and non-ASCII characters, as UTF-8."""
    buf, starts = spans.packed([text])
    low = spans.LOWER[buf]
    begin, end, _ = spans.word_spans(low, starts, spans.ALNUM)
    return [low[a:b].tobytes() for a, b in zip(begin.tolist(), end.tolist(), strict=True)]


def _passes(benchmark: DataFrame, item: str, text: str, per_pass: int, chars: int) -> Iterator[list[tuple[str, str]]]:
    """The items in portions of bounded size, streamed to the driver one after the other."""
    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    portion: list[tuple[str, str]] = []
    windows = size = 0
    for row in rows.where(F.col("item").isNotNull()).toLocalIterator():
        # A word takes two characters at least, with the one that parts it from the next.
        if portion and (windows + len(row.text) // 2 > per_pass or size + len(row.text) > chars):
            yield portion
            portion, windows, size = [], 0, 0
        portion.append((row.item, row.text))
        windows += len(row.text) // 2
        size += len(row.text)
    if portion:
        yield portion


def _spans_of(hit: np.ndarray, begin: np.ndarray, end: np.ndarray, first: int, last: int, base: int) -> list[list[int]]:
    """Byte spans, in the text, of the maximal runs of hit words."""
    edges = np.flatnonzero(np.diff(hit[first:last], prepend=False, append=False)) + first
    return [[int(begin[a] - base), int(end[b - 1] - base)] for a, b in zip(edges[0::2], edges[1::2], strict=True)]


def find_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    document: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    keep: tuple[str, ...] = (),
    windows_per_pass: int = WINDOWS_PER_PASS,
    chars_per_pass: int = CHARS_PER_PASS,
) -> DataFrame:
    """Every document with the words and byte spans that occur in benchmark items.

    A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one window.
    The hashes of all windows go to every task as a broadcast of bounded size (a larger benchmark is scanned
    portion by portion, and what a scan has found is written with the documents for the next one); a task hashes
    the word runs of its documents with running sums, looks them up, and compares the words of every hit with
    those of the item. Nothing is shuffled.

    Result: ``keep`` columns, ``doc_id``, ``n_words``, ``n_hit`` (words inside an occurrence), ``items`` (ids of
    the items with an occurring window, as strings, sorted), ``spans`` (byte begin and end of the runs of hit
    words) and ``contaminated``.

    Defined cases: a null text has no words; a null item text has no window; items without an id are left
    out, as they could not be named; items with the same id count once; an empty benchmark leaves every
    document clean; repeated documents are judged each by itself.
    """
    spark = documents.sparkSession
    kept = [F.col(c).alias(f"kept{i}") for i, c in enumerate(keep)]
    rows = documents.select(
        *kept,
        F.col(document).alias("doc_id"),
        F.col(text).alias("text"),
        F.lit(None).cast("binary").alias("marks"),
        F.array().cast("array<string>").alias("items"),
    )
    carried = rows.schema
    result = T.StructType(
        [
            *[f for f in carried if f.name not in ("text", "marks", "items")],
            T.StructField("n_words", T.LongType()),
            T.StructField("n_hit", T.LongType()),
            T.StructField("items", T.ArrayType(T.StringType())),
            T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
        ]
    )

    def scanned(df: DataFrame, portion: list[tuple[str, str]], last: bool) -> DataFrame:
        """``marks`` and ``items`` hold what earlier portions have hit."""
        shared = spark.sparkContext.broadcast(Grams(portion, window))
        plain = len(df.columns) - 3

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            grams = shared.value
            for part, buf, starts in spans.blocks(batches):
                begin, end, firsts, hit, pairs = grams.scan(buf, starts)
                items = [set(x) for x in part.column("items").to_pylist()]
                for at, number in pairs:
                    items[at].add(grams.names[number])
                for at, marks in enumerate(part.column("marks").to_pylist()):
                    if marks is not None:
                        own = slice(firsts[at], firsts[at + 1])
                        hit[own] |= np.unpackbits(np.frombuffer(marks, np.uint8), count=own.stop - own.start) > 0
                named = pa.array([sorted(s) for s in items], pa.list_(pa.string()))
                columns = part.columns[:plain]
                if last:
                    counts = spans.per_text(hit, firsts)
                    runs: list[list[list[int]]] = [[] for _ in items]
                    for at in np.flatnonzero(counts).tolist():
                        runs[at] = _spans_of(hit, begin, end, firsts[at], firsts[at + 1], starts[at])
                    columns += [pa.array(np.diff(firsts)), pa.array(counts), named]
                    columns += [pa.array(runs, pa.list_(pa.list_(pa.int64())))]
                else:
                    bits = [np.packbits(hit[a:b]).tobytes() for a, b in zip(firsts[:-1], firsts[1:], strict=True)]
                    columns += [part.column("text"), pa.array(bits, pa.binary()), named]
                yield pa.RecordBatch.from_arrays(columns, names=(result if last else carried).fieldNames())

        return df.mapInArrow(scan, result if last else carried)

    portions = _passes(benchmark, item, item_text, windows_per_pass, chars_per_pass)
    portion = next(portions, [])
    for following in portions:
        rows = written(scanned(rows, portion, last=False))
        portion = following
    found = scanned(rows, portion, last=True).withColumn("contaminated", F.col("n_hit") > 0)
    return found.select(
        *[F.col(f"kept{i}").alias(c) for i, c in enumerate(keep)],
        "doc_id",
        "n_words",
        "n_hit",
        "items",
        "spans",
        "contaminated",
    )


def contamination_digest(found: DataFrame) -> DataFrame:
    """The per-document figures of :func:`find_contamination` with a digest of the items."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def decontaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    document: str = "doc_id",
    text: str = "text",
    max_hit_share: float = 0.5,
    **options,
) -> DataFrame:
    """The documents without benchmark passages, with their columns.

    The hit spans are cut out of a text; a document whose hit words are at least ``max_hit_share`` of all is
    left out altogether. A column ``n_chars`` (if any, of a whole number) is set to the new number of characters
    of the texts that change. Documents without a hit are returned as they are. Defined cases are those of
    :func:`find_contamination`.
    """
    columns = documents.columns
    # Under names of their own, so that no column of the input can clash with a figure.
    own = documents.select(*[F.col(f"`{c}`").alias(f"in{i}") for i, c in enumerate(columns)])
    at = {c: f"in{i}" for i, c in enumerate(columns)}
    text_as = at[text]
    found = find_contamination(own, benchmark, at[document], text_as, keep=tuple(own.columns), **options)
    stays = found.where((F.col("n_hit") == 0) | (F.col("n_hit") < max_hit_share * F.col("n_words")))
    # Spans count bytes: cut the UTF-8 form at their edges, then read it as text again.
    raw = F.encode(text_as, "UTF-8")
    edges = F.concat(F.array(F.lit(0).cast("long")), F.flatten("spans"), F.array(F.octet_length(raw).cast("long")))
    pieces = F.transform(
        F.sequence(F.lit(0), F.size("spans")),
        lambda i: F.substring(
            raw,
            F.element_at(edges, 2 * i + 1).cast("int") + 1,
            (F.element_at(edges, 2 * i + 2) - F.element_at(edges, 2 * i + 1)).cast("int"),
        ),
    )
    joined = F.aggregate(pieces, F.lit(b""), lambda a, b: F.concat(a, b))
    hit = F.size("spans") > 0
    out = {c: F.col(n) for c, n in at.items()}
    out[text] = F.when(hit, F.decode(joined, "UTF-8")).otherwise(F.col(text_as))
    if "n_chars" in columns:
        kind = documents.schema["n_chars"].dataType
        out["n_chars"] = F.when(hit, F.length(out[text]).cast(kind)).otherwise(F.col(at["n_chars"]))
    return stays.select(*[value.alias(c) for c, value in out.items()])
