"""Frequency tables, exact quantiles, correlation and test statistics."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations, combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.distributions import atanh, normal_two_sided, t_quantile, t_two_sided
from eventloom.operators.ordered import BROADCAST_GROUPS, Ordered, group_stats, ordered_columns


def frequency_table(df: DataFrame, column: str) -> DataFrame:
    """Count and share per value."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(F.sum("n").alias("__all")).select(F.lit(1).alias("__one"), "__all")
    joined = counts.withColumn("__one", F.lit(1)).join(F.broadcast(totals), "__one")
    return joined.select(column, "n", (F.col("n") / F.col("__all")).alias("share"))


def two_way_table(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def level_shares(df: DataFrame, level: str, label: str) -> DataFrame:
    """Count per (level, label) and its share within the level."""
    counts = df.groupBy(level, label).agg(F.count(F.lit(1)).alias("n"))
    # the window runs over the counts: one row per (level, label)
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(level)))


def exact_quantiles(df: DataFrame, column: str, probabilities: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Quantiles with linear interpolation: one row per group, array column ``quantiles``.

    Exact, but without collecting the values of a group: equal values are counted first, running
    counts locate the two values around each position.
    """
    return _from_counts(df, column, probabilities, by).select(*by, "quantiles")


def _from_counts(df: DataFrame, column: str, probabilities: Sequence[float], by: Sequence[str]) -> DataFrame:
    """Quantiles, minimum, mean and maximum of each group, all from one table of (group, value, count)."""
    keys = list(by) or ["__all"]
    base = df if by else df.withColumn("__all", F.lit(0))
    counts = (
        base.filter(F.col(column).isNotNull())
        .groupBy(*keys, F.col(column).alias("__v"))
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    stats = group_stats(counts, [list(by)])[0]
    running = ordered_columns(counts, list(by), ["__v"], [Ordered("running_sum", "__upto", "__n")], stats)
    sizes = counts.groupBy(*[F.col(k).alias(f"__g_{k}") for k in keys]).agg(F.sum("__n").alias("__size"))
    condition = [F.col(k).eqNullSafe(F.col(f"__g_{k}")) for k in keys]
    joined = running.join(F.broadcast(sizes) if stats.groups <= BROADCAST_GROUPS else sizes, condition)

    def at(place: Column) -> Column:
        return F.min(F.when(F.col("__upto") > place, F.col("__v")))

    parts = []
    for i, p in enumerate(probabilities):
        place = (F.col("__size") - 1) * F.lit(float(p))
        parts += [at(F.floor(place)).alias(f"__lo{i}"), at(F.ceil(place)).alias(f"__hi{i}")]
        parts.append(F.max(place - F.floor(place)).alias(f"__f{i}"))
    values = [
        F.col(f"__lo{i}") + (F.col(f"__hi{i}") - F.col(f"__lo{i}")) * F.col(f"__f{i}")
        for i in range(len(probabilities))
    ]
    value = F.col("__v")
    summary = [
        F.min(value).alias("min"),
        (F.sum(value * F.col("__n")) / F.sum("__n")).alias("mean"),
        F.max(value).alias("max"),
    ]
    return joined.groupBy(*keys).agg(*parts, *summary).select(*by, F.array(*values).alias("quantiles"), "min", "mean", "max")


def five_numbers(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Minimum, quartiles, mean and maximum, per group or overall."""
    found = _from_counts(df, column, (0.25, 0.5, 0.75), by)
    q = lambda i: F.col("quantiles")[i]
    return found.select(*by, "min", q(0).alias("q1"), q(1).alias("median"), "mean", q(2).alias("q3"), "max")


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair, from one pass over the table."""
    pairs = list(combinations_with_replacement(columns, 2))
    row = df.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        cells.append(F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), F.col(f"r{i}").alias("r")))
        if a != b:
            cells.append(F.struct(F.lit(b).alias("var1"), F.lit(a).alias("var2"), F.col(f"r{i}").alias("r")))
    return row.select(F.inline(F.array(*cells)))


def correlation_test(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pearson correlation, its t statistic and degrees of freedom (pairs with both values)."""
    both = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    r = both.agg(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias("r"), F.count(F.lit(1)).alias("n"))
    df_ = F.col("n") - 2
    return r.select("r", (F.col("r") * F.sqrt(df_ / (1 - F.col("r") * F.col("r")))).alias("t"), df_.alias("df"))


def welch_t(df: DataFrame, value: str, group: str, first: object = 0, second: object = 1) -> DataFrame:
    """Welch's two-sample t statistic and degrees of freedom."""
    v = F.col(value).cast("double")

    def stats(level: object, i: int) -> list[Column]:
        inside = F.when(F.col(group) == F.lit(level), v)
        return [
            F.avg(inside).alias(f"mean{i}"),
            F.var_samp(inside).alias(f"var{i}"),
            F.count(inside).alias(f"n{i}"),
        ]

    row = df.agg(*stats(first, 1), *stats(second, 2))
    e1, e2 = F.col("var1") / F.col("n1"), F.col("var2") / F.col("n2")
    t = (F.col("mean1") - F.col("mean2")) / F.sqrt(e1 + e2)
    freedom = (e1 + e2) * (e1 + e2) / (e1 * e1 / (F.col("n1") - 1) + e2 * e2 / (F.col("n2") - 1))
    return row.select("mean1", "mean2", t.alias("t"), freedom.alias("df"))


def correlation(a: Column, b: Column) -> Column:
    """Pearson correlation of the rows with both values; missing where one does not vary."""
    spread = F.stddev_pop(F.when(b.isNotNull(), a)) * F.stddev_pop(F.when(a.isNotNull(), b))
    return F.covar_pop(a, b) / F.nullif(spread, F.lit(0.0))


def correlation_tests(df: DataFrame, columns: Sequence[str], level: float = 0.95) -> DataFrame:
    """Correlation test of every pair of columns: ``var1``, ``var2``, ``n``, ``r``, ``t``, ``df``, ``p``, ``low``, ``high``.

    One pass with map-side combine, whatever the number of pairs; pairs of values with a missing one are left out of their pair
    only. ``p`` is two-sided. The bounds are those of Fisher's transformation; they are missing below four
    rows, and all but ``n`` is missing where a column does not vary.
    """
    pairs = list(combinations(columns, 2))
    row = df.agg(
        *[
            x
            for i, (a, b) in enumerate(pairs)
            for x in (
                correlation(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}"),
                F.count_if(F.col(a).isNotNull() & F.col(b).isNotNull()).alias(f"n{i}"),
            )
        ]
    )
    cells = [
        F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), F.col(f"n{i}").alias("n"), F.col(f"r{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)
    ]
    found = row.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
    r, freedom = F.col("r"), (F.col("n") - 2).cast("double")
    found = found.withColumn("t", F.when(freedom > 0, r * F.sqrt(freedom / F.nullif(1 - r * r, F.lit(0.0)))))
    reach = F.when(F.col("n") > 3, F.lit(normal_two_sided(1 - level)) / F.sqrt(F.col("n") - F.lit(3.0)))
    return found.select(
        "var1",
        "var2",
        "n",
        "r",
        "t",
        (F.col("n") - 2).alias("df"),
        t_two_sided(F.col("t"), freedom).alias("p"),
        F.tanh(atanh(r) - reach).alias("low"),
        F.tanh(atanh(r) + reach).alias("high"),
    )


def welch_tests(
    df: DataFrame, values: Sequence[str], group: str, first: object = 0, second: object = 1, level: float = 0.95
) -> DataFrame:
    """Welch's test of every column of ``values`` between two groups: ``value``, ``mean1``, ``mean2``, ``t``, ``df``, ``p``, ``low``, ``high``.

    One pass with map-side combine. ``p`` is two-sided, the bounds are those of the difference of the means. A
    group of fewer than two values, or two groups without any spread, have no test.
    """

    def stats(column: str, i: int) -> list[Column]:
        out = []
        for side, one in ((1, first), (2, second)):
            inside = F.when(F.col(group) == F.lit(one), F.col(column).cast("double"))
            out += [F.avg(inside).alias(f"m{side}_{i}"), F.var_samp(inside).alias(f"v{side}_{i}"), F.count(inside).alias(f"n{side}_{i}")]
        return out

    row = df.agg(*[x for i, c in enumerate(values) for x in stats(c, i)])
    cells = [
        F.struct(
            F.lit(c).alias("value"),
            *[F.col(f"m{s}_{i}").alias(f"mean{s}") for s in (1, 2)],
            *[(F.col(f"v{s}_{i}") / F.nullif(F.col(f"n{s}_{i}"), F.lit(0))).alias(f"e{s}") for s in (1, 2)],
            *[F.col(f"n{s}_{i}").alias(f"n{s}") for s in (1, 2)],
        )
        for i, c in enumerate(values)
    ]
    found = row.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
    e1, e2 = F.col("e1"), F.col("e2")
    whole = F.nullif(e1 + e2, F.lit(0.0))
    freedom = whole * whole / (e1 * e1 / (F.col("n1") - 1) + e2 * e2 / (F.col("n2") - 1))
    gap = F.col("mean1") - F.col("mean2")
    found = found.withColumns({"error": F.sqrt(whole), "df": freedom, "t": gap / F.sqrt(whole)})
    found = found.withColumn("reach", t_quantile(1 - level, F.col("df")) * F.col("error"))
    return found.select(
        "value", "mean1", "mean2", "t", "df", t_two_sided(F.col("t"), F.col("df")).alias("p"), (gap - F.col("reach")).alias("low"), (gap + F.col("reach")).alias("high")
    )


#: Points of the grid of :func:`class_density`.
GRID = 512


def class_density(df: DataFrame, column: str, by: str, points: int = GRID) -> DataFrame:
    """Gaussian kernel density of ``column`` in each class at ``points`` places from its smallest to its largest value over all classes.

    Result: ``by``, ``place`` (from 0), ``x``, ``density``, ``bandwidth``. The bandwidth of a class is
    0.9 * min(sd, IQR / 1.34) * n ** -0.2 (the standard deviation alone where the quartiles agree, 1 where nothing varies).

    Each value is shared between the two places of the grid around it in proportion to its distance (linear binning). Spark
    sums these shares with map-side combine, so at most ``points`` numbers remain of a class, however large it is; the kernel
    is laid over them as a convolution within one row. Missing values and classes of value null: left out, and a class
    of their own. An empty column gives an empty result.
    """
    values = df.where(F.col(column).isNotNull()).select(F.col(by).alias("__by"), F.col(column).cast("double").alias("__x"))
    ends = values.agg(F.min("__x").alias("__lo"), F.max("__x").alias("__hi")).first()
    if ends[0] is None:
        return df.select(F.col(by), F.lit(0).alias("place"), *[F.lit(0.0).alias(n) for n in ("x", "density", "bandwidth")]).limit(0)
    low, step = ends[0], (ends[1] - ends[0]) / (points - 1) or 1.0
    at = (F.col("__x") - F.lit(low)) / F.lit(step)
    cell = F.least(F.floor(at), F.lit(points - 2)).cast("int")
    shares = F.array(
        F.struct(F.col("__cell").alias("place"), (1 - F.col("__part")).alias("share")),
        F.struct((F.col("__cell") + 1).alias("place"), F.col("__part").alias("share")),
    )
    binned = (
        values.select("__by", cell.alias("__cell"), (at - cell).alias("__part"))
        .select("__by", F.explode(shares).alias("s"))
        .groupBy("__by", "s.place")
        .agg(F.sum("s.share").alias("share"))
        .groupBy("__by")
        .agg(F.map_from_entries(F.collect_list(F.struct("place", "share"))).alias("shares"))
    )
    spread = values.groupBy("__by").agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("__x").alias("sd"))
    quarters = exact_quantiles(values, "__x", (0.25, 0.75), ["__by"])
    known = spread.join(quarters.select(F.col("__by").alias("__of"), "quantiles"), F.col("__by").eqNullSafe(F.col("__of"))).drop("__of")
    iqr = (F.col("quantiles")[1] - F.col("quantiles")[0]) / 1.34
    narrow = F.coalesce(F.nullif(F.least(F.col("sd"), iqr), F.lit(0.0)), F.nullif(F.col("sd"), F.lit(0.0)), F.lit(1.0))
    known = known.withColumn("bandwidth", 0.9 * narrow * F.pow(F.col("n"), F.lit(-0.2)))
    joined = known.join(binned.withColumnRenamed("__by", "__of"), F.col("__by").eqNullSafe(F.col("__of")))

    places = F.sequence(F.lit(0), F.lit(points - 1))
    filled = F.transform(places, lambda i: F.coalesce(F.col("shares")[i], F.lit(0.0)))
    kernel = F.transform(places, lambda i: F.exp(-0.5 * F.pow(i * F.lit(step) / F.col("bandwidth"), F.lit(2.0))))
    joined = joined.select("__by", "n", "bandwidth", filled.alias("filled"), kernel.alias("kernel"))

    def laid(i: Column) -> Column:
        return F.aggregate(
            F.zip_with("filled", places, lambda c, j: F.when(c > 0, c * F.get("kernel", F.abs(i - j))).otherwise(0.0)), F.lit(0.0), lambda a, v: a + v
        )

    dense = joined.select("__by", "n", "bandwidth", F.posexplode(F.transform(places, laid)).alias("place", "sum"))
    return dense.select(
        F.col("__by").alias(by),
        "place",
        (F.lit(low) + F.col("place") * F.lit(step)).alias("x"),
        (F.col("sum") / (F.col("n") * F.col("bandwidth") * F.sqrt(F.lit(2.0) * F.pi()))).alias("density"),
        "bandwidth",
    )


def z_scores(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """(x - mean) / sample deviation, fitted on ``fit_on`` (default: the table itself)."""
    source = df if fit_on is None else fit_on
    fitted = source.agg(
        *[F.avg(c).alias(f"__m_{c}") for c in columns], *[F.stddev_samp(c).alias(f"__s_{c}") for c in columns]
    ).withColumn("__one", F.lit(1))
    joined = df.withColumn("__one", F.lit(1)).join(F.broadcast(fitted), "__one")
    scaled = {c: (F.col(c) - F.col(f"__m_{c}")) / F.col(f"__s_{c}") for c in columns}
    return joined.select(*[scaled[c].alias(c) if c in scaled else F.col(c) for c in df.columns])


def fill_median(df: DataFrame, column: str) -> DataFrame:
    """Missing values replaced by the exact median."""
    median = exact_quantiles(df, column, (0.5,)).select(F.lit(1).alias("__one"), F.col("quantiles")[0].alias("__m"))
    joined = df.withColumn("__one", F.lit(1)).join(F.broadcast(median), "__one", "left")
    return joined.withColumn(column, F.coalesce(F.col(column), F.col("__m"))).drop("__one", "__m")
