"""Quality rules from tokeniser fertility: how well public vocabularies fit a text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm import spans
from eventloom.llm.tokens import fallback_counter, piece_encoder, public_path

#: Words of a window that counts as repeated, fewest words, and the largest share of repeated words, in percent.
REPEAT_WORDS, FEWEST_WORDS, MOST_REPEATED = 5, 10, 20

#: Tokens over which an entropy is taken. Windows of one size make long and short texts comparable.
ENTROPY_TOKENS = 64


@dataclass(frozen=True)
class Band:
    """What a text may have. The entropy floor is lower for short texts, whose mean scatters more."""

    chars_per_token: tuple[float, float]
    fallback: float
    entropy: float

    def floor(self, tokens: np.ndarray) -> np.ndarray:
        return self.entropy - 0.035 - 0.09 / np.sqrt(np.maximum(tokens / ENTROPY_TOKENS, 1.0))


# Bands per language (code of two letters), and per script for all other languages. Entropy is the
# usual mean of normalised window entropies; texts of the language lie within the floor taken from it.
LANGUAGE_BANDS = {
    "en": Band((1.9, 8.0), 0.15, 0.890),
    "de": Band((1.6, 8.0), 0.15, 0.883),
    "fr": Band((1.6, 8.0), 0.15, 0.872),
    "es": Band((1.5, 8.0), 0.15, 0.860),
}
SCRIPT_BANDS = {
    "latin": Band((1.2, 8.0), 0.25, 0.850),
    "other": Band((0.2, 8.0), 1.00, 0.700),
}

_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_FOLLOW = spans.table_of("80-BF")
_LATIN = spans.table_of("41-5A 61-7A C3-C9")
_FOREIGN = spans.table_of("CA-F4")


def _repeated(buf: np.ndarray, begin: np.ndarray, end: np.ndarray, firsts: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Flags of the words in windows that the text has twice or more."""
    runs = spans.run_hash(spans.span_hash(sums, begin, end), REPEAT_WORDS)
    places = np.flatnonzero(spans.inside(firsts, REPEAT_WORDS))
    text = np.searchsorted(firsts, places, side="right") - 1
    _, which, counts = np.unique(
        runs[places] ^ spans.mixed(text.astype(np.uint64)), return_inverse=True, return_counts=True
    )
    return spans.covered(places[counts[which] > 1], REPEAT_WORDS, len(begin))


def _repeated_lines(buf: np.ndarray, starts: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """For every text, its lines with a word that are equal to an earlier line."""
    end = np.flatnonzero(buf == 10)
    begin = np.concatenate([[0], end[:-1] + 1]) if len(end) else end
    visible = np.concatenate([[0], np.cumsum(spans.GRAPHIC[buf])])
    own = visible[end] > visible[begin]
    begin, end = begin[own], end[own]
    text = np.searchsorted(starts, begin, side="right") - 1
    code = spans.span_hash(sums, begin, end)
    order = np.lexsort((code, text))
    again = (np.diff(text[order]) == 0) & (np.diff(code[order]) == 0)
    return np.bincount(text[order][1:][again], minlength=len(starts) - 1)


def _entropies(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Mean entropy of the token windows of every text, as a share of the largest possible one (1 below two tokens)."""
    windows = np.maximum(counts // ENTROPY_TOKENS, 1)
    opening = np.cumsum(windows) - windows
    first = np.cumsum(counts) - counts
    text = np.repeat(np.arange(len(counts)), counts)
    at = np.minimum((np.arange(len(ids)) - first[text]) // ENTROPY_TOKENS, windows[text] - 1)
    window = opening[text] + at
    _, code, number = np.unique(window * (1 << 32) + ids.astype(np.int64), return_inverse=True, return_counts=True)
    of = np.zeros(len(number), dtype=np.int64)
    of[code] = window
    total = np.bincount(window, minlength=int(windows.sum())).astype(float)
    spread = np.bincount(of, weights=number * np.log2(number), minlength=len(total))
    safe = np.maximum(total, 2)
    share = np.where(total >= 2, (np.log2(safe) - spread / safe) / np.log2(safe), 1.0)
    return np.add.reduceat(share, opening) / windows if len(counts) else share


class _Measure:
    """Figures of a block of texts, from both vocabularies."""

    def __init__(self, vocabulary: str, fallback_vocabulary: str) -> None:
        self.encoder = piece_encoder(vocabulary)
        self.fallback = fallback_counter(fallback_vocabulary)

    def __call__(self, langs: list[str | None], buf, starts) -> dict[str, np.ndarray]:
        sums = spans.prefix_sums(buf)
        begin, end, firsts = spans.word_spans(buf, starts, spans.GRAPHIC)
        visible = spans.GRAPHIC[buf]
        words = np.diff(firsts)
        found = {
            "n_words": words,
            "word_chars": spans.per_text(visible & ~_FOLLOW[buf], starts),
            "n_symbols": spans.per_text(_SYMBOLS[buf], starts),
            "n_dup_lines": _repeated_lines(buf, starts, sums),
            "n_repeat_words": spans.per_text(_repeated(buf, begin, end, firsts, sums), firsts),
        }
        found["base_failed"] = (words < FEWEST_WORDS) | (100 * found["n_repeat_words"] > MOST_REPEATED * words)
        ids, counts = self.encoder(buf, starts, sums)
        chars = spans.per_text(~_FOLLOW[buf], starts) - 1  # without the line feed behind each text
        pieces = self.fallback(buf, starts, sums)
        found["chars_per_token"] = chars / np.maximum(counts, 1)
        found["fallback_share"] = pieces[:, 1] / np.maximum(pieces[:, 0], 1)
        found["token_entropy"] = _entropies(ids, counts)
        foreign = spans.per_text(_FOREIGN[buf], starts) > spans.per_text(_LATIN[buf], starts)
        reasons = []
        bands = [
            LANGUAGE_BANDS.get((lang or "")[:2].lower()) or SCRIPT_BANDS["other" if other else "latin"]
            for lang, other in zip(langs, foreign, strict=True)
        ]
        floors = np.array([b.floor(n) for b, n in zip(bands, counts, strict=True)])
        for i, band in enumerate(bands):
            low, high = band.chars_per_token
            if found["base_failed"][i]:
                reasons.append("few or repeated words")
            elif not low <= found["chars_per_token"][i] <= high:
                reasons.append("characters per token")
            elif found["fallback_share"][i] > band.fallback:
                reasons.append("byte fallback")
            elif found["token_entropy"][i] < floors[i]:
                reasons.append("token entropy")
            else:
                reasons.append(None)
        found["reason"] = reasons
        return found


def judge_quality(
    documents: DataFrame,
    text: str = "text",
    lang: str = "lang",
    keep: tuple[str, ...] = ("doc_id",),
    vocabulary: str | None = None,
    fallback_vocabulary: str | None = None,
) -> DataFrame:
    """Figures and verdict for every document: ``keep`` columns, then the columns below.

    ``n_words`` to ``base_failed`` are counts over the whole text (words are runs without white space):
    ``word_chars``, ``n_symbols`` (of ``#*$%&|<>``), ``n_dup_lines`` and ``n_repeat_words``. A text fails the base
    rule with fewer than 10 words, or if more than 20 % of its words lie in repeated five-word windows.
    ``chars_per_token`` and ``token_entropy`` are those of the byte-level vocabulary, ``fallback_share`` is
    the share of tokens that the piece vocabulary spells in bytes. ``kept`` is false outside the band of
    the language, or of the script for languages without one; ``reason`` names the first rule that failed.

    One pass in the scan's own tasks, no shuffle; blocks of about 1 MB bound the memory. The vocabularies
    are paths that every executor can open.

    Defined cases: a null or empty text has no words and fails the base rule; a null language, or a table
    without that column, takes the band of the script; repeated rows are judged each by itself; an empty table
    gives an empty result; ``keep`` may name any columns, the others are not read.
    """
    first = vocabulary or public_path("byte_bpe_50k.json")
    second = fallback_vocabulary or public_path("piece_bpe_32k.model")
    rows = documents.select(
        *[F.col(f"`{c}`").alias(f"kept{i}") for i, c in enumerate(keep)],
        F.col(text).alias("text"),
        (F.col(lang).cast("string") if lang in documents.columns else F.lit(None).cast("string")).alias("lang"),
    )
    longs = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    doubles = ("chars_per_token", "fallback_share", "token_entropy")
    result = T.StructType(
        [
            *[f for f in rows.schema if f.name.startswith("kept")],
            *[T.StructField(c, T.LongType()) for c in longs],
            T.StructField("base_failed", T.BooleanType()),
            *[T.StructField(c, T.DoubleType()) for c in doubles],
            T.StructField("reason", T.StringType()),
        ]
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = _Measure(first, second)
        for part, buf, starts in spans.blocks(batches):
            found = measure(part.column("lang").to_pylist(), buf, starts)
            columns = [
                *part.columns[: len(keep)],
                *[pa.array(np.asarray(found[c], dtype=np.int64)) for c in longs],
                pa.array(found["base_failed"]),
                *[pa.array(np.asarray(found[c], dtype=np.float64)) for c in doubles],
                pa.array(found["reason"], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=result.fieldNames())

    judged = rows.mapInArrow(judge, result).withColumn("kept", F.col("reason").isNull())
    given = result.fieldNames()[len(keep) :]
    return judged.select(*[F.col(f"kept{i}").alias(c) for i, c in enumerate(keep)], *given, "kept")


def of_quality(documents: DataFrame, text: str = "text", lang: str = "lang", **options) -> DataFrame:
    """The documents that :func:`judge_quality` keeps, with their columns."""
    columns = documents.columns
    # Under names of their own, so that no column of the input can clash with a figure.
    own = documents.select(*[F.col(f"`{c}`").alias(f"in{i}") for i, c in enumerate(columns)])
    names = [f"in{i}" for i in range(len(columns))]
    text_as = f"in{columns.index(text)}"
    lang_as = f"in{columns.index(lang)}" if lang in columns else "lang"
    judged = judge_quality(own, text_as, lang_as, keep=tuple(names), **options)
    return judged.where("kept").select(*[F.col(n).alias(c) for n, c in zip(names, columns, strict=True)])
