"""Appending, aligning, filtering by other tables, and row selection by position."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from eventloom.operators.ordered import position


def append_by_name(frames: Sequence[DataFrame], rank: str | None = "src_rank") -> DataFrame:
    """Append by column name, missing columns filled with NULL; ``rank`` remembers the source."""
    if rank:
        frames = [f.withColumn(rank, F.lit(i)) for i, f in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def split_back(df: DataFrame, source: int, rank: str = "src_rank") -> DataFrame:
    """The rows of one source of :func:`append_by_name`."""
    return df.filter(F.col(rank) == source).drop(rank)


def align_mean(test: DataFrame, scored: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Give each test row the mean score of the scored rows with the same keys.

    The scored side is combined to one row per key before the join, so no test row is multiplied.
    """
    means = scored.groupBy(*keys).agg(F.avg(value).alias(value))
    return test.join(means, list(keys), "left")


def align_features(test: DataFrame, features: DataFrame, key: str = "click_id") -> DataFrame:
    """Give each test row the features of the row equal in all common columns but the id.

    Of several rows of ``features`` that are equal in the common columns, the one with the smallest ``key`` counts
    (and the smallest values, where keys repeat), whatever the partitions are.
    """
    common = [c for c in test.columns if c != key and c in features.columns]
    added = [c for c in features.columns if c != key and c not in common]
    if not added:
        return test
    order = F.struct(*[F.col(c) for c in (*([key] if key in features.columns else []), *added)])
    first = features.groupBy(*common).agg(F.min(order).alias("__first"))
    return test.join(first, common, "left").select(*test.columns, *[F.col(f"__first.{c}").alias(c) for c in added])


def keys_seen_again(df: DataFrame, key: str) -> DataFrame:
    """Drop rows whose key occurs once."""
    repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select(key)
    return df.join(repeated, key, "left_semi")


def overlap_count(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """How many rows of ``left`` have a key that occurs in ``right``."""
    return left.join(right.select(key), key, "left_semi").agg(F.count(F.lit(1)).alias("n"))


def row_at(df: DataFrame, order: Sequence[str], n: int, descending: bool = False) -> Row | None:
    """The order values of the n-th row (from 1). Only the order columns are sorted."""
    narrow = df.select(*order)
    sort_by = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    found = position(narrow, [], sort_by, "__n").filter(F.col("__n") == n).drop("__n").collect()
    return found[0] if found else None


def not_before(order: Sequence[str], edge: Row) -> Column:
    """Lexicographic ``order >= edge``; the leading column is compared on its own as well, so that
    the condition can be pushed to the scan."""
    later, equal = F.lit(False), F.lit(True)
    for c in order:
        later = later | (equal & (F.col(c) > F.lit(edge[c])))
        equal = equal & (F.col(c) == F.lit(edge[c]))
    return (F.col(order[0]) >= F.lit(edge[order[0]])) & (later | equal)


def not_after(order: Sequence[str], edge: Row) -> Column:
    earlier, equal = F.lit(False), F.lit(True)
    for c in order:
        earlier = earlier | (equal & (F.col(c) < F.lit(edge[c])))
        equal = equal & (F.col(c) == F.lit(edge[c]))
    return (F.col(order[0]) <= F.lit(edge[order[0]])) & (earlier | equal)


def row_range(df: DataFrame, order: Sequence[str], first: int, last: int) -> DataFrame:
    """Rows ``first`` to ``last`` (from 1, inclusive) in ``order``.

    Two edge rows are located on the order columns alone; the table itself is only filtered.
    """
    narrow = df.select(*order)
    numbered = position(narrow, [], list(order), "__n")
    edges = {r["__n"]: r for r in numbered.filter(F.col("__n").isin(first, last)).collect()}
    if first not in edges:
        return df.limit(0)
    kept = df.filter(not_before(order, edges[first]))
    return kept.filter(not_after(order, edges[last])) if last in edges else kept


def tail_flag(df: DataFrame, order: Sequence[str], size: int, name: str = "is_valid") -> DataFrame:
    """Mark the last ``size`` rows in ``order`` (hold-out from the end of the training log)."""
    edge = row_at(df, order, size, descending=True)
    return df.withColumn(name, not_before(order, edge) if edge else F.lit(True))


def encode_labels(df: DataFrame, column: str, name: str) -> DataFrame:
    """Code of each value: its place among the sorted distinct values, from 0."""
    values = position(df.select(column).filter(F.col(column).isNotNull()).distinct(), [], [column], "__n")
    return df.join(values, column, "left").withColumn(name, F.col("__n") - 1).drop("__n")


def rows_of_kth_key(df: DataFrame, key: str, k: int) -> DataFrame:
    """Rows of the k-th smallest distinct key (from 1)."""
    keys = position(df.select(key).distinct(), [], [key], "__n")
    chosen = keys.filter(F.col("__n") == k).select(key)  # one row
    return df.join(F.broadcast(chosen), key, "left_semi")


def column_maxima(frames: Sequence[DataFrame], columns: Sequence[str], extra: int = 1) -> DataFrame:
    """Largest value of each column over all frames plus ``extra``, one row per column (vocabulary sizes)."""
    both = append_by_name([f.select(*columns) for f in frames], rank=None)
    row = both.agg(*[(F.max(c) + extra).cast("bigint").alias(c) for c in columns])
    return row.unpivot([], list(columns), "column", "size")


def param_grid(spark: SparkSession, values: dict[str, Sequence]) -> DataFrame:
    """All combinations of the listed parameter values, built by exploding constant arrays."""
    grid = spark.range(1).drop("id")
    for name, options in values.items():
        grid = grid.withColumn(name, F.explode(F.array(*[F.lit(o) for o in options])))
    return grid
