"""Sketches that can be kept per day and merged later: distinct counts (HLL) and quantiles (KLL).

A day's sketch is a few kilobytes per group, so a count or a quantile over any span of days is an aggregation of
that many rows instead of one over all events. What is kept is a plain binary column of a Parquet table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: log2 of the registers of an HLL sketch: the relative standard error is about 1.04 / sqrt(2 ** LG), 1.6 % for 12.
LG = 12

#: Size of a KLL sketch: a returned quantile's rank is off by less than about 1.33 % (99 of 100 times) for 200.
K = 200

DISTINCT, QUANTILES = "distinct_sketch", "quantile_sketch"


def daily_sketches(
    df: DataFrame, keys: Sequence[str], distinct: str | None = None, numeric: str | None = None, lg: int = LG, k: int = K
) -> DataFrame:
    """One row per group (name the day among the ``keys``) with a sketch of the values of ``distinct`` and of ``numeric``.

    Partial sketches are built in the scan's tasks, so a hot group sends one small row per task. Missing values are not counted; a
    group without any value has an empty distinct sketch and no quantile sketch.
    """
    parts = []
    if distinct:
        parts.append(F.hll_sketch_agg(F.col(distinct), F.lit(lg)).alias(DISTINCT))
    if numeric:
        parts.append(F.kll_sketch_agg_double(F.col(numeric).cast("double"), F.lit(k)).alias(QUANTILES))
    return df.groupBy(*keys).agg(*parts)


def merged(sketches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The sketches of all rows of a group as one, for instance of all days of a month."""
    parts = []
    if DISTINCT in sketches.columns:
        parts.append(F.hll_union_agg(DISTINCT).alias(DISTINCT))
    if QUANTILES in sketches.columns:
        parts.append(F.kll_merge_agg_double(QUANTILES).alias(QUANTILES))
    return sketches.groupBy(*keys).agg(*parts)


def distinct_estimate(sketch: str | Column = DISTINCT) -> Column:
    """The number of distinct values. It depends on the set of values only, not on how their sketches were merged.

    A sketch that has never been merged also remembers in which order its values came and estimates from that; the union
    with itself makes it forget, so that a whole table and the merged days of it agree to the last digit.
    """
    own = F.col(sketch) if isinstance(sketch, str) else sketch
    return F.hll_sketch_estimate(F.hll_union(own, own))


def quantile_estimates(probabilities: Sequence[float], sketch: str | Column = QUANTILES) -> Column:
    """Estimated quantiles, as an array in the order of ``probabilities``; missing for a group without values."""
    own = F.col(sketch) if isinstance(sketch, str) else sketch
    return F.when(F.kll_sketch_get_n_double(own) > 0, F.kll_sketch_get_quantile_double(own, F.array(*[F.lit(float(p)) for p in probabilities])))
