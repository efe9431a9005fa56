"""Per-group features attached to every row, planned together.

``add_features`` takes a list of feature specifications and decides how to compute them:

* Key lists that share columns form a family. Rows are shuffled once on the columns that all lists
  of the family have in common; every window of the family then needs only local sorts.
* A family of plain aggregates with few groups is aggregated first (combined before the shuffle)
  and joined back by broadcast; the number of groups is measured, not assumed.
* Groups too large for one task leave the window plan: their aggregates come from a partial
  aggregation joined back, their order-dependent features from range-partitioned pieces.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from eventloom.functions.timeparts import gap_seconds, micros
from eventloom.operators.ordered import (
    BROADCAST_GROUPS,
    GroupStats,
    Ordered,
    by_pieces,
    group_limit,
    group_stats,
    piece_count,
    split_oversized,
    spread,
    window_value,
)

TIME = "__micros"


@dataclass(frozen=True)
class Feature:
    kind: str
    keys: tuple[str, ...]
    name: str
    column: str | None = None
    options: dict = field(default_factory=dict, hash=False)

    @property
    def is_ordered(self) -> bool:
        return self.kind in ("running_count", "next_gap", "previous_gap")


def group_size(keys: Sequence[str], name: str | None = None, narrow_bits: int | None = None) -> Feature:
    """Number of rows in the group."""
    return Feature("size", tuple(keys), name or "_".join(keys) + "count", options={"narrow_bits": narrow_bits})


def non_null_count(keys: Sequence[str], column: str, name: str) -> Feature:
    """Number of rows in the group where ``column`` is present."""
    return Feature("non_null", tuple(keys), name, column)


def distinct_count(
    keys: Sequence[str], column: str, name: str | None = None, narrow_bits: int | None = None
) -> Feature:
    return Feature(
        "distinct", tuple(keys), name or f"{'_'.join(keys)}_by_{column}_countuniq", column, {"narrow_bits": narrow_bits}
    )


def group_mean(keys: Sequence[str], column: str, name: str | None = None) -> Feature:
    return Feature("mean", tuple(keys), name or f"{'_'.join(keys)}_by_{column}_mean", column)


def group_variance(keys: Sequence[str], column: str, name: str | None = None) -> Feature:
    """Sample variance; missing for a group of one row."""
    return Feature("variance", tuple(keys), name or f"{'_'.join(keys)}_by_{column}_var", column)


def running_count(keys: Sequence[str], column: str | None = None, name: str | None = None, base: int = 0) -> Feature:
    """Earlier rows of the group (``base`` 0) or position in it (``base`` 1).

    ``column`` only shapes the name: the value depends on keys and order alone.
    """
    return Feature(
        "running_count", tuple(keys), name or f"{'_'.join(keys)}_by_{column}_cumcount", None, {"base": base}
    )


def next_gap(keys: Sequence[str], name: str | None = None, mode: str = "component", fill=None) -> Feature:
    """Time to the next row of the group."""
    return Feature("next_gap", tuple(keys), name or "_".join(keys) + "_nextClick", None, {"mode": mode, "fill": fill})


def previous_gap(
    keys: Sequence[str], name: str | None = None, mode: str = "component", fill=None, sign: int = 1
) -> Feature:
    """Time since the previous row of the group; ``sign`` -1 gives previous minus current."""
    return Feature(
        "previous_gap",
        tuple(keys),
        name or "_".join(keys) + "_prevClick",
        None,
        {"mode": mode, "fill": fill, "sign": sign},
    )


# ---------------------------------------------------------------------------------------------------


@dataclass
class Family:
    root: tuple[str, ...]
    features: list[Feature]


def families(features: Sequence[Feature]) -> list[Family]:
    """Group the features so that each family can be served by one shuffle on its root columns."""
    left = list(features)
    result = []
    while left:
        uses = Counter(k for f in left for k in f.keys)
        # the column used most; ties go to the one named first
        best = max(uses, key=lambda k: uses[k])
        inside = [f for f in left if best in f.keys]
        root = tuple(k for k in inside[0].keys if all(k in f.keys for f in inside))
        result.append(Family(root, inside))
        left = [f for f in left if best not in f.keys]
    return result


def _aggregate(f: Feature) -> Column:
    if f.kind == "size":
        return F.count(F.lit(1))
    if f.kind == "non_null":
        return F.count(f.column)
    if f.kind == "mean":
        return F.avg(f.column)
    if f.kind == "variance":
        return F.var_samp(f.column)
    if f.kind == "distinct":
        return F.count_distinct(f.column)
    raise ValueError(f.kind)


def _narrowed(f: Feature, value: Column) -> Column:
    bits = f.options.get("narrow_bits")
    return F.pmod(value, F.lit(2**bits)) if bits else value


def _by_keys(features: Sequence[Feature]) -> dict[tuple[str, ...], list[Feature]]:
    lists: dict[tuple[str, ...], list[Feature]] = {}
    for f in features:
        lists.setdefault(f.keys, []).append(f)
    return lists


def _attach_aggregates(
    df: DataFrame, source: DataFrame, features: Sequence[Feature], groups: dict[tuple[str, ...], GroupStats]
) -> DataFrame:
    """Aggregate ``source`` per key list and join the values back to the rows of ``df``.

    ``source`` holds the same rows before they were shuffled for other features; ``groups`` tells which
    key lists have few enough groups for a broadcast. Each distinct count gets its own aggregation:
    several in one would multiply the rows.
    """
    for keys, wanted in _by_keys(features).items():
        plain = [f for f in wanted if f.kind != "distinct"]
        bundles = ([plain] if plain else []) + [[f] for f in wanted if f.kind == "distinct"]
        for bundle in bundles:
            side = source.groupBy(*[F.col(k).alias(f"__k_{k}") for k in keys]).agg(
                *[_narrowed(f, _aggregate(f)).alias(f.name) for f in bundle]
            )
            condition = [df[k].eqNullSafe(side[f"__k_{k}"]) for k in keys]
            few = groups[keys].groups <= BROADCAST_GROUPS
            df = df.join(F.broadcast(side) if few else side, condition, "left").drop(*[f"__k_{k}" for k in keys])
    return df


def _gap_columns(features: Sequence[Feature]) -> tuple[list[Ordered], dict[str, Column]]:
    """Steps over the order, and the expressions that turn them into the features."""
    steps: dict[str, Ordered] = {}
    values: dict[str, Column] = {}
    for f in features:
        if f.kind == "running_count":
            steps["__position"] = Ordered("position", "__position")
            values[f.name] = F.col("__position") + F.lit(f.options["base"] - 1)
            continue
        if f.kind == "next_gap":
            steps["__next"] = Ordered("lead", "__next", TIME)
            gap = gap_seconds(F.col(TIME), F.col("__next"), f.options["mode"])
        else:
            steps["__previous"] = Ordered("lag", "__previous", TIME)
            earlier, later = F.col("__previous"), F.col(TIME)
            if f.options["sign"] < 0:
                earlier, later = later, earlier
            gap = gap_seconds(earlier, later, f.options["mode"])
        if f.options["fill"] is not None:
            gap = F.coalesce(gap, F.lit(f.options["fill"]))
        values[f.name] = gap
    return list(steps.values()), values


def _finish(df: DataFrame, steps: Sequence[Ordered], values: dict[str, Column]) -> DataFrame:
    return df.withColumns(values).drop(*[s.name for s in steps])


@dataclass
class Chain:
    """Features that one sort order can serve.

    ``sets`` are key sets ordered by inclusion: sorting by the columns of the smallest set, then by
    those the next one adds, and so on, makes the rows of every group of every set adjacent.
    ``top`` is set where order-dependent features need the row order right after their keys.
    """

    sets: list[frozenset[str]]
    top: frozenset[str] | None
    features: list[Feature]

    def accepts(self, wanted: Sequence[frozenset[str]]) -> bool:
        nested = all(s <= w or w <= s for w in wanted for s in self.sets)
        return nested and (self.top is None or all(w <= self.top for w in wanted))

    def add(self, feature: Feature, wanted: Sequence[frozenset[str]]) -> None:
        self.features.append(feature)
        self.sets += [w for w in wanted if w not in self.sets]

    def columns(self) -> list[str]:
        named = [k for f in self.features for k in (*f.keys, f.column) if k]
        result: list[str] = []
        for s in sorted(self.sets, key=len):
            result += [k for k in dict.fromkeys(named) if k in s and k not in result]
        return result


def chains(features: Sequence[Feature]) -> list[Chain]:
    """Distribute the features over few sort orders."""
    result: list[Chain] = []
    for f in features:
        if f.is_ordered:
            keys = frozenset(f.keys)
            chain = next((c for c in result if c.top == keys), None)
            if chain is None:
                chain = Chain([], keys, [])
                result.append(chain)
            chain.add(f, [keys])
    # the most demanding ones first: distinct counts with many keys
    rest = sorted((f for f in features if not f.is_ordered), key=lambda f: (f.kind != "distinct", -len(f.keys)))
    for f in rest:
        keys = frozenset(f.keys)
        wanted = [keys, keys | {f.column}] if f.kind == "distinct" else [keys]
        chain = next((c for c in result if c.accepts(wanted)), None)
        if chain is None:
            chain = Chain([], None, [])
            result.append(chain)
        chain.add(f, wanted)
    return result


def _chain_columns(df: DataFrame, chain: Chain, order: Sequence[str]) -> DataFrame:
    """All features of a chain. Every window asks for the same complete sort order, so the rows are
    sorted once however the windows are arranged."""
    columns = chain.columns()
    sort_by = columns + (list(order) if chain.top is not None else [])

    def over(keys: Sequence[str]) -> WindowSpec:
        return Window.partitionBy(*sort_by[: len(set(keys))]).orderBy(*sort_by[len(set(keys)) :])

    def whole(keys: Sequence[str]) -> WindowSpec:
        return over(keys).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    ordered = [f for f in chain.features if f.is_ordered]
    distinct = [f for f in chain.features if f.kind == "distinct"]
    plain = [f for f in chain.features if not f.is_ordered and f.kind != "distinct"]

    steps, values = _gap_columns(ordered)
    first = {s.name: window_value(s, over(ordered[0].keys)) for s in steps}
    # Equal values of the counted column are adjacent in their group: a value counts where it
    # differs from the row before.
    for i, f in enumerate(distinct):
        first[f"__before_{i}"] = F.lag(f.column).over(over(f.keys))
    if first:
        df = df.withColumns(first)
    second = {f.name: _narrowed(f, _aggregate(f).over(whole(f.keys))) for f in plain}
    for i, f in enumerate(distinct):
        new = F.col(f.column).isNotNull() & ~F.col(f.column).eqNullSafe(F.col(f"__before_{i}"))
        second[f.name] = _narrowed(f, F.count_if(new).over(whole(f.keys)))
    kept = [c for c in df.columns if c not in first]
    return df.select(*kept, *[v.alias(n) for n, v in {**values, **second}.items()])


def _windows(df: DataFrame, family: Family, order: Sequence[str], rows: int) -> DataFrame:
    """Ordinary groups: one shuffle on the root, then one local sort per chain."""
    df = spread(df, family.root, rows, always=len(_by_keys(family.features)) > 1)
    groups = chains(family.features)
    for chain in groups:
        if len(groups) > 1:
            # without an explicit sort Catalyst moves windows with fewer keys below the others, which
            # mixes the chains and sorts the rows again for each piece
            df = df.sortWithinPartitions(*chain.columns(), *(order if chain.top is not None else []))
        df = _chain_columns(df, chain, order)
    return df


def _oversized(df: DataFrame, family: Family, order: Sequence[str], pieces: int) -> DataFrame:
    """Groups too large for one task."""
    plain = [f for f in family.features if not f.is_ordered]
    if plain:
        lists = list(_by_keys(plain))
        df = _attach_aggregates(df, df, plain, dict(zip(lists, group_stats(df, lists))))
    for keys, wanted in _by_keys([f for f in family.features if f.is_ordered]).items():
        steps, values = _gap_columns(wanted)
        df = _finish(by_pieces(df, keys, order, steps, pieces), steps, values)
    return df


def _add_family(df: DataFrame, family: Family, stats: GroupStats, order: Sequence[str]) -> DataFrame:
    limit = group_limit(df, stats.rows)
    if stats.largest <= limit:
        return _windows(df, family, order, stats.rows)
    ordinary, oversized = split_oversized(df, family.root, limit, stats.groups)
    cut = _oversized(oversized, family, order, piece_count(stats.rows, limit))
    return cut if ordinary is None else _windows(ordinary, family, order, stats.rows).unionByName(cut)


def add_features(
    df: DataFrame,
    features: Sequence[Feature],
    order: Sequence[str] = ("click_time", "click_id"),
    time: str = "click_time",
) -> DataFrame:
    """Attach all ``features`` to ``df``; ``order`` must be a total order of the rows."""
    groups = families(features)
    # One job measures every key list that could be broadcast and every root that could be skewed.
    plain = [not any(f.is_ordered for f in g.features) for g in groups]
    lists: list[tuple[str, ...]] = []
    for g, is_plain in zip(groups, plain):
        lists += [g.root] + (list(_by_keys(g.features)) if is_plain else [])
    lists = list(dict.fromkeys(lists))
    measured = dict(zip(lists, group_stats(df, lists)))

    columns = list(df.columns)
    source = df
    if any(f.kind in ("next_gap", "previous_gap") for f in features):
        df = df.withColumn(TIME, micros(time))
    small: list[Feature] = []
    for g, is_plain in zip(groups, plain):
        few = is_plain and all(measured[k].groups <= BROADCAST_GROUPS for k in _by_keys(g.features))
        # a broadcast join pays only where it saves the shuffle of the rows: not for tables of
        # about one row per group
        if few and all(measured[k].groups * 4 <= measured[k].rows for k in _by_keys(g.features)):
            small += g.features
        else:
            df = _add_family(df, g, measured[g.root], order)
    if small:
        df = _attach_aggregates(df, source, small, measured)
    return df.select(*columns, *[f.name for f in features])

