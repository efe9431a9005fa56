"""Positions, neighbours and running sums over a total order, safe for groups of any size.

A Spark window evaluates one group inside one task. That is the right plan for ordinary groups
(one shuffle, one sort), but a group holding a large share of the table would pin one executor, and
a window without PARTITION BY would pull the whole table into one task. The functions here measure
the largest group first. Groups above the limit are cut into pieces by ``repartitionByRange`` on
(keys, order), the window runs inside each piece, and the values that cross a piece edge come from a
small table with one row per (group, piece).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.session import checkpointed

# A group of this many rows is still comfortable for one task (the sort of a window spills).
GROUP_ROWS = 2_000_000
# The limit rises with the table so that the number of oversized groups, and of pieces, stays
# bounded by a constant; both bound what is broadcast.
MAX_PIECES = 50_000

# Rows of a task after a shuffle whose number of partitions follows the table.
TASK_ROWS = 250_000

# A table up to this many rows of keys and values is broadcast; beyond it the join is left to Spark,
# which splits skewed partitions at run time.
BROADCAST_GROUPS = 200_000

PIECE = "__piece"


@dataclass(frozen=True)
class Ordered:
    """One output column: ``kind`` is position (from 1), lag, lead or running_sum."""

    kind: str
    name: str
    value: str | None = None


@dataclass(frozen=True)
class GroupStats:
    rows: int
    groups: int
    largest: int


def group_limit(df: DataFrame, rows: int) -> int:
    base = int(df.sparkSession.conf.get("eventloom.groupRows", str(GROUP_ROWS)))
    return max(base, rows // MAX_PIECES)


def group_stats(df: DataFrame, key_lists: Sequence[Sequence[str]]) -> list[GroupStats]:
    """Row count, group count and largest group for each key list, in one job.

    Only the key columns are read and counts are combined before the shuffle.
    """
    summaries = [
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.lit(i).alias("i"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.count(F.lit(1)).alias("groups"),
            F.coalesce(F.max("n"), F.lit(0)).alias("largest"),
        )
        for i, keys in enumerate(key_lists)
    ]
    found = {r["i"]: r for r in reduce(DataFrame.unionAll, summaries).collect()}
    return [GroupStats(r["rows"], r["groups"], r["largest"]) for _, r in sorted(found.items())]


def oversized_groups(df: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """Keys with more than ``limit`` rows: at most rows / limit of them, hence safe to broadcast."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > limit).drop("__n")


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality on all keys (a window treats NULL as one group)."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def split_oversized(
    df: DataFrame, keys: Sequence[str], limit: int, groups: int
) -> tuple[DataFrame | None, DataFrame]:
    """Rows of ordinary groups (None where all of the ``groups`` are oversized) and of oversized groups.

    The list of oversized keys is small; it is checkpointed so that it is found once.
    """
    hot = checkpointed(oversized_groups(df, keys, limit))
    if hot.count() == groups:
        return None, df
    hot = F.broadcast(hot)
    condition = same_keys(df, hot, keys)
    return df.join(hot, condition, "left_anti"), df.join(hot, condition, "left_semi")


def spread(df: DataFrame, keys: Sequence[str], rows: int, always: bool = True) -> DataFrame:
    """Shuffle on ``keys``, into partitions whose number rises with ``rows``, so that a task keeps its size.

    Adaptive execution unites the partitions of the session's setting until as few are left as there are cores; a stated number it
    leaves alone. With ``always`` False nothing happens where the cores suffice (a later window shuffles by itself).
    """
    wanted = max(rows // group_limit(df, rows), -(-rows // TASK_ROWS))
    if wanted > df.sparkSession.sparkContext.defaultParallelism:
        return df.repartition(wanted, *keys)
    return df.repartition(*keys) if always else df


def dealt(df: DataFrame, keys: Sequence[str], rows: int | None = None, task_rows: int = TASK_ROWS) -> DataFrame:
    """Shuffle on ``keys`` into partitions whose number rises with ``rows`` (counted where not given), so that a task keeps its size.

    What is grouped, joined or windowed on these keys afterwards needs no further shuffle. Adaptive execution, which unites
    partitions until as few are left as there are cores, leaves a stated number alone.
    """
    rows = df.count() if rows is None else rows
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // task_rows)), *keys)


def window_value(step: Ordered, window) -> Column:
    if step.kind == "position":
        return F.row_number().over(window).cast("bigint")
    if step.kind == "lag":
        return F.lag(step.value).over(window)
    if step.kind == "lead":
        return F.lead(step.value).over(window)
    if step.kind == "running_sum":
        return F.sum(step.value).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    raise ValueError(step.kind)


def by_window(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], steps: Sequence[Ordered]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns({s.name: window_value(s, window) for s in steps})


def by_pieces(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], steps: Sequence[Ordered], pieces: int
) -> DataFrame:
    """The same columns as :func:`by_window`, with each group spread over many tasks.

    The range-partitioned rows are checkpointed: both the rows and the edge table below must see
    the same piece of each row, also when an executor is lost in between.
    """
    sort_by = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = df.repartitionByRange(pieces, *[F.col(k) for k in keys], *sort_by)
    ranged = checkpointed(ranged.withColumn(PIECE, F.spark_partition_id()))

    window = Window.partitionBy(*keys, PIECE).orderBy(*sort_by)
    local = {f"__local_{s.name}": window_value(s, window) for s in steps}
    rows = ranged.withColumns(
        {"__rank": F.row_number().over(window), "__last": F.lead(F.lit(1)).over(window).isNull(), **local}
    )

    first_last = []
    for s in steps:
        if s.kind == "lag":
            first_last.append(F.max_by(s.value, "__rank").alias(f"__edge_{s.name}"))
        elif s.kind == "lead":
            first_last.append(F.min_by(s.value, "__rank").alias(f"__edge_{s.name}"))
        elif s.kind == "position":
            first_last.append(F.count(F.lit(1)).alias(f"__edge_{s.name}"))
        else:
            first_last.append(F.sum(s.value).alias(f"__edge_{s.name}"))
    edges = rows.groupBy(*keys, PIECE).agg(*first_last)

    along = Window.partitionBy(*keys).orderBy(PIECE)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    carried = {"__parts": F.count(F.lit(1)).over(Window.partitionBy(*keys))}
    for s in steps:
        edge = f"__edge_{s.name}"
        if s.kind == "lag":
            carried[f"__carry_{s.name}"] = F.lag(edge).over(along)
        elif s.kind == "lead":
            carried[f"__carry_{s.name}"] = F.lead(edge).over(along)
        else:
            carried[f"__carry_{s.name}"] = F.sum(edge).over(before)
    # A range boundary cuts at most one group, so groups that span several pieces have fewer than
    # 2 * pieces entries together: the broadcast is bounded by the number of pieces.
    edges = edges.withColumns(carried).filter("__parts > 1").select(*keys, PIECE, *[f"__carry_{s.name}" for s in steps])
    edges = F.broadcast(edges.withColumnsRenamed({k: f"__k_{k}" for k in keys} | {PIECE: "__p"}))

    condition = F.col(PIECE) == F.col("__p")
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    joined = rows.join(edges, condition, "left")

    result = {}
    for s in steps:
        here, carry = F.col(f"__local_{s.name}"), F.col(f"__carry_{s.name}")
        if s.kind == "lag":
            result[s.name] = F.when(F.col("__rank") == 1, carry).otherwise(here)
        elif s.kind == "lead":
            result[s.name] = F.when(F.col("__last"), carry).otherwise(here)
        else:
            result[s.name] = here + F.coalesce(carry, F.lit(0))
    return joined.select(*[F.col(c) for c in df.columns], *[v.alias(n) for n, v in result.items()])


def piece_count(rows: int, limit: int) -> int:
    return 2 * (rows // limit) + 2


def ordered_columns(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    steps: Sequence[Ordered],
    stats: GroupStats | None = None,
) -> DataFrame:
    """Add the columns of ``steps`` over ``keys`` in ``order`` (which must be a total order).

    ``stats`` saves a job where the caller has measured the groups already.
    """
    stats = stats or group_stats(df, [keys])[0]
    limit = group_limit(df, stats.rows)
    if stats.largest <= limit:
        return by_window(spread(df, keys, stats.rows, always=False) if keys else df, keys, order, steps)
    pieces = piece_count(stats.rows, limit)
    if not keys:
        return by_pieces(df, keys, order, steps, pieces)
    ordinary, oversized = split_oversized(df, keys, limit, stats.groups)
    cut = by_pieces(oversized, keys, order, steps, pieces)
    if ordinary is None:
        return cut
    return by_window(spread(ordinary, keys, stats.rows, always=False), keys, order, steps).unionByName(cut)


def position(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str) -> DataFrame:
    """1-based position of each row in its group (or in the whole table for no keys)."""
    return ordered_columns(df, keys, order, [Ordered("position", name)])
