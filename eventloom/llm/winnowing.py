"""Document fingerprints by winnowing, in DataFrame functions only."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.base import lower_ascii

#: Words of a gram and grams of a window: every run of GRAM + WINDOW - 1 equal words in two texts has a common fingerprint.
GRAM, WINDOW = 5, 4

#: Between words: everything of ASCII but letters and digits.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Slices of the table for each shuffle partition.
SLICES_PER_PARTITION = 4


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _beside(a: Column, b: Column, shift: int, join: Callable[[Column, Column], Column]) -> Column:
    """``join(a[i], b[i + shift])`` for every place where both are there."""
    size = F.greatest(F.size(b) - shift, F.lit(0))
    return F.zip_with(F.slice(a, 1, size), F.slice(b, shift + 1, size), lambda x, y: join(x, y))


def _grams(codes: Column, length: int, use: Callable[[Column], Column]) -> Column:
    """Hashes of all runs of ``length`` codes, rolled from shorter runs.

    The hash of 2 n codes comes from the hashes of both halves, so every hash of a shorter run serves several longer ones
    and a place costs about log2(length) steps, whatever the length.
    """

    def step(level: Column, size: int, done: Column | None, done_size: int) -> Column:
        if length & size:
            done = level if done is None else _beside(done, level, done_size, F.xxhash64)
            done_size += size
        if done_size == length:
            return _let(done, use)
        return _let(_beside(level, level, size, F.xxhash64), lambda longer: step(longer, 2 * size, done, done_size))

    return _let(codes, lambda c: step(c, 1, None, 0))


def _lows(grams: Column, window: int, use: Callable[[Column], Column]) -> Column:
    """The least of every ``window`` consecutive numbers, by windows of doubled length."""

    def step(level: Column, size: int) -> Column:
        if 2 * size <= window:
            return _let(_beside(level, level, size, F.least), lambda longer: step(longer, 2 * size))
        return _let(level if size == window else _beside(level, level, window - size, F.least), use)

    return step(grams, 1)


def winnow(text: str | Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """The fingerprint of a text: a struct of ``hashes`` and ``positions`` (number of the gram's first word, from 0), by position.

    Words are runs of letters and digits, A-Z in lower case, every non-ASCII character a letter. Of every ``window`` consecutive
    grams the one with the least hash is chosen, of equal ones the rightmost; a gram chosen by several windows stands there once.
    A text of fewer words than a gram is one gram; a text of fewer grams than a window is one window. Null
    or a text without words: empty arrays.
    """
    words = F.array_remove(F.split(lower_ascii(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))), GAPS), "")
    codes = F.transform(words, lambda w: F.xxhash64(w))

    def chosen(grams: Column) -> Column:
        def place(low: Column, at: Column) -> Column:
            out = at
            for behind in range(1, window):  # the last branch that applies is asked first: the rightmost
                out = F.when(F.get(grams, at + behind) == low, at + behind).otherwise(out)
            return out

        lows = _lows(grams, window, lambda x: F.when(F.size(grams) >= window, x).otherwise(F.slice(grams, 1, 0)))
        short = F.when((F.size(grams) > 0) & (F.size(grams) < window), F.array(F.array_min(grams)))
        positions = _let(F.coalesce(short, lows), lambda x: F.array_distinct(F.transform(x, place)))
        return _let(
            positions, lambda p: F.struct(F.transform(p, lambda i: F.get(grams, i)).alias("hashes"), p.cast("array<int>").alias("positions"))
        )

    def of_codes(own: Column) -> Column:
        few = (F.size(own) > 0) & (F.size(own) < gram)
        whole = F.array(F.aggregate(own, F.lit(0).cast("long"), lambda a, x: F.xxhash64(a, x)))
        return _grams(own, gram, lambda g: _let(F.when(few, whole).otherwise(g), chosen))

    return _let(codes, of_codes)


def likeness(a: Column, b: Column) -> Column:
    """Share of the distinct hashes of either fingerprint that both have; 1 for two empty ones."""
    both, either = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def fingerprints(
    documents: DataFrame, document: str = "doc_id", text: str = "text", gram: int = GRAM, window: int = WINDOW
) -> DataFrame:
    """``doc_id``, ``hashes``, ``positions`` of every row; one projection, no shuffle.

    If two texts share ``gram + window - 1`` consecutive words, the window over them chooses the same gram in both, so
    its hash is in both fingerprints and the positions say where; shorter runs than ``gram`` are never found.
    """
    marks = documents.select(F.col(f"`{document}`").alias("doc_id"), winnow(F.col(f"`{text}`").cast("string"), gram, window).alias("mark"))
    return marks.select("doc_id", "mark.hashes", "mark.positions")


def _slices(rows: DataFrame, count: int) -> list[tuple]:
    """The first key of each of about ``count`` even slices of the order, falling; it reads ids and hashes only."""
    ranged = rows.select("doc_id", "tie").repartitionByRange(count, F.desc("doc_id"), F.desc("tie"))
    firsts = ranged.groupBy(F.spark_partition_id().alias("slice")).agg(F.max(F.struct("doc_id", "tie")).alias("first"))
    return [tuple(r.first) for r in firsts.orderBy(F.desc("first")).collect()]


def with_next(documents: DataFrame, document: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``text`` and ``next_text``, the text of the next document by falling id; after the last one, of the first.

    One shuffle of the texts. The order is cut into slices with even numbers of rows; a slice is a group of a window, and
    the first row of each is sent to the slice before as well, so that no row looks beyond its slice. Rows with one id go by
    the hash of their text, null ids come last. ``slice`` and ``order`` columns stay for further windows
    over the same groups (see :func:`edit_audit`); rows with ``extra`` are the copies.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col(f"`{document}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    firsts = _slices(rows, SLICES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")))
    if not firsts:
        return rows.select("*", F.lit(0).alias("slice"), F.lit(False).alias("extra"), F.lit("").alias("next_text"))
    # Two steps of about the root of their number find the slice of a row.
    run = max(int(len(firsts) ** 0.5), 1)
    runs = [firsts[i : i + run] for i in range(0, len(firsts), run)]
    key = F.struct("doc_id", "tie")
    kind = f"struct<doc_id:{documents.schema[document].dataType.simpleString()},tie:bigint>"

    def known(value: list, form: str) -> Column:
        return F.from_json(F.lit(json.dumps(value)), form)

    def named(first: tuple) -> dict:
        return {"doc_id": first[0], "tie": first[1]}

    starts = known([named(r[0]) for r in runs], f"array<{kind}>")
    within = known([[named(f) for f in r] for r in runs], f"array<array<{kind}>>")
    rows = rows.withColumn("run", F.size(F.filter(starts, lambda f: f >= key)) - 1)
    rows = rows.withColumn("step", F.size(F.filter(F.get(within, F.col("run")), lambda f: f >= key)) - 1)
    own = F.col("run") * run + F.col("step")
    before = F.pmod(own + (len(firsts) - 1), F.lit(len(firsts)))
    opens = F.get(F.get(within, F.col("run")), F.col("step")).eqNullSafe(key)
    places = F.array(F.struct(own.alias("slice"), F.lit(False).alias("extra")))
    twice = F.array(F.struct(own.alias("slice"), F.lit(False).alias("extra")), F.struct(before.alias("slice"), F.lit(True).alias("extra")))
    dealt = rows.select("doc_id", "text", "tie", F.explode(F.when(opens, twice).otherwise(places)).alias("p"))
    dealt = dealt.select("doc_id", "text", "tie", "p.slice", "p.extra")
    return dealt.withColumn("next_text", F.lead("text").over(_along()))


def _along():
    return Window.partitionBy("slice").orderBy("extra", F.desc("doc_id"), F.desc("tie"))


def edit_audit(
    documents: DataFrame, document: str = "doc_id", text: str = "text", gram: int = GRAM, window: int = WINDOW
) -> DataFrame:
    """How the fingerprint of each text compares with that of an edited text and of the next document.

    In the edited text the last ``floor(n_chars / 2)`` characters are replaced by the first as many (or all) of the next document, see
    :func:`with_next`. Result: ``doc_id``, ``n_chars``, ``edited`` (text), ``hashes``, ``positions``, ``edited_hashes``,
    ``edited_positions``, ``near_edited``, ``near_next`` (see :func:`likeness`).

    The texts are shuffled once; a fingerprint is computed once per document and per edited text, after the shuffle,
    and handed to the document before by a second window over the groups of the first.

    Defined cases: a null text counts as an empty one, whose fingerprint is empty; two empty fingerprints have likeness 1; a table of one
    row is followed by itself; repeated rows and rows with one id are separate documents in the order of :func:`with_next`; an
    empty table gives an empty result; a text's memory is about 20 times its size. Other columns are left out.
    """
    rows = with_next(documents, document, text).withColumn("mark", winnow("text", gram, window))
    rows = rows.withColumn("next_hashes", F.lead("mark.hashes").over(_along())).where("not extra")
    half = F.expr("length(text) div 2").cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half))
    rows = rows.withColumn("edited", edited).withColumn("edited_mark", winnow("edited", gram, window))
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        "edited",
        "mark.hashes",
        "mark.positions",
        F.col("edited_mark.hashes").alias("edited_hashes"),
        F.col("edited_mark.positions").alias("edited_positions"),
        likeness(F.col("mark.hashes"), F.col("edited_mark.hashes")).alias("near_edited"),
        likeness(F.col("mark.hashes"), F.col("next_hashes")).alias("near_next"),
    )


def written_out(hashes: str, positions: str) -> Column:
    """A fingerprint as text: hash in hexadecimal digits, ``@`` and position, parted by blanks."""
    return F.array_join(F.zip_with(hashes, positions, lambda h, p: F.concat(F.lower(F.hex(h)), F.lit("@"), p.cast("string"))), " ")
