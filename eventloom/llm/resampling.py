"""Importance resampling: documents drawn so that their n-grams are distributed like those of a target."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.base import written
from eventloom.llm.interning import Grams, pieces_of

#: Words of the longest n-gram, number of hash buckets, percentage drawn, fewest words of a document that can be drawn.
WORDS, BUCKETS, SHARE, LEAST_WORDS = 2, 10_000, 25, 20
SEED = 7

#: Scores are whole thousandths of log likelihoods, see :func:`drawn`.
SCALE = 1000


def bucket_counts(texts: DataFrame, text: str = "text", words: int = WORDS, buckets: int = BUCKETS) -> DataFrame:
    """``bucket`` and ``n``: how often n-grams of each bucket occur in all texts.

    Every task counts its own rows and sends one row for each bucket, so the shuffle does not grow with a task's input.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for some in pieces_of(batch.column(0).to_pylist(), words):
                total += Grams(some, words, buckets).histogram(buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], names=["bucket", "n"])

    counted = texts.select(F.col(f"`{text}`").cast("string")).mapInArrow(count, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket``, ``gain`` for every bucket: thousandths of the log ratio of its smoothed shares in target and raw texts."""
    spark = raw.sparkSession
    every = spark.range(buckets).select(F.col("id").alias("bucket"))
    both = (
        every.join(raw.withColumnRenamed("n", "s"), "bucket", "left")
        .join(target.withColumnRenamed("n", "t"), "bucket", "left")
        .select("bucket", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("t", F.lit(0)).alias("t"))
    )
    whole = Window.partitionBy()  # one row per bucket
    both = both.withColumns({"all_s": F.sum("s").over(whole), "all_t": F.sum("t").over(whole)})
    size = F.lit(float(buckets))

    def real(name: str) -> Column:
        return F.col(name).cast("double")

    ratio = ((real("t") + 1) * (real("all_s") + size)) / ((real("s") + 1) * (real("all_t") + size))
    return both.select("bucket", F.floor(F.lit(float(SCALE)) * F.log(ratio)).alias("gain"))


def weigh(documents: DataFrame, gains: np.ndarray, document: str, text: str, words: int) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight`` of every row: the floored mean of the gains of its n-grams."""
    kind = documents.schema[document].dataType.simpleString()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.num_rows
            n_words, n_grams, total = (np.zeros(size, dtype=np.int64) for _ in range(3))
            for some in pieces_of(batch.column(1).to_pylist(), words):
                grams = Grams(some, words, len(gains))
                n_words[: len(grams.words)] += grams.words
                n_grams += np.bincount(grams.row, minlength=size)
                np.add.at(total, grams.row, grams.gathered(gains))
            weight = np.floor_divide(total, np.maximum(n_grams, 1))
            numbers = [pa.array(x, pa.int64()) for x in (n_words, n_grams, weight)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *numbers], names=["doc_id", "n_words", "n_features", "weight"])

    rows = documents.select(F.col(f"`{document}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(measure, f"doc_id {kind}, n_words long, n_features long, weight long")


def noise(document: str | Column, seed: int = SEED) -> Column:
    """Gumbel noise in whole thousandths, from a hash of the seed and the id (a null id counts as an empty text)."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(document).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(SCALE)) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def drawn(scored: DataFrame, share: int = SHARE, least_words: int = LEAST_WORDS) -> DataFrame:
    """``rank`` (1, 2, 3 ... by falling score, ties by id, null ids last) of the documents drawn, null for the others.

    Scores are whole numbers: a mean of log ratios of counts (below 1000 * ln(2**64) either way) plus noise between
    -3,140 and 22,900, so there are fewer than 120,000 of them at any size. The places above each score come from the number
    of documents per score; only rows of one score are ever sorted together, and only for scores that are drawn.
    """
    can = F.col("n_words") >= least_words
    levels = scored.where(can).groupBy("score").agg(F.count(F.lit(1)).alias("here"))
    falling = Window.orderBy(F.desc("score"))
    levels = levels.select(
        F.col("score").alias("level"),
        (F.sum("here").over(falling) - F.col("here")).alias("above"),
        F.expr(f"(sum(here) over () * {int(share)}) div 100").alias("wanted"),
    ).where("above < wanted")
    placed = scored.join(F.broadcast(levels), can & (F.col("score") == F.col("level")), "left")
    ranks = Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"))
    own = placed.where("level is not null").withColumn("rank", F.col("above") + F.row_number().over(ranks))
    own = own.withColumn("rank", F.when(F.col("rank") <= F.col("wanted"), F.col("rank")))
    rest = placed.where("level is null").withColumn("rank", F.lit(None).cast("long"))
    return own.unionByName(rest).select(*scored.columns, F.col("rank").cast("long").alias("rank"))


def importance_resample(
    documents: DataFrame,
    target: DataFrame,
    document: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    words: int = WORDS,
    buckets: int = BUCKETS,
    share: int = SHARE,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """Draw ``share`` percent of the documents so that they resemble ``target``, without replacement.

    Features are all runs of 1 to ``words`` consecutive words (letters and digits, A-Z in lower case, every non-ASCII
    character a letter), joined by one blank; their crc32 modulo ``buckets`` is the bucket. A bucket's gain
    is the log ratio of its smoothed shares in the target and in all documents; a document's weight is the mean gain of its
    features. Adding Gumbel noise and taking the highest scores draws without replacement by these weights.

    Result: ``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score``, ``rank`` (null where not drawn), a row per document.

    Two passes over the texts. In each, the n-grams of a batch are interned in an open-addressed table (see
    :mod:`eventloom.llm.interning`): a bucket is computed once per distinct n-gram, the first pass adds the counts of the
    slots, the second gathers a gain for every occurrence by its slot. Between the passes only one number per bucket travels.

    Defined cases: null and empty texts have no features, weight 0, and are never drawn with ``least_words`` above 0; a
    null id has noise of its own and comes last among equal scores; repeated rows are separate
    documents; an empty target has all counts 0; an empty table gives an empty result. Texts beyond
    1 MiB are looked at piece by piece, so memory is bounded by a batch and 30 times a piece (or the longest word).
    Other columns of the input are left out, so none can clash.
    """
    raw = bucket_counts(documents, text, words, buckets)
    wanted = bucket_counts(target, target_text, words, buckets)
    rows = bucket_gains(raw, wanted, buckets).collect()  # one row per bucket
    gains = np.zeros(buckets, dtype=np.int64)
    gains[[r.bucket for r in rows]] = [r.gain for r in rows]
    weighed = weigh(documents, gains, document, text, words)
    scored = written(weighed.withColumn("score", F.col("weight") + noise("doc_id", seed)))
    return drawn(scored, share, least_words)
