"""The best reference for every visit by the access points both have seen: a weighted set-similarity join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.session import checkpointed

#: Readings below this many dBm are left out; from there on a reading weighs one more for every further ten.
FLOOR, BAND = -80, 10

#: Scores that are asked for one after the other. A visit whose best reference reaches a score needs no lower one;
#: at a half or less every common access point counts.
STEPS = (0.8, 0.65, 0.5)

#: Pairs of entries of one access point that meet in one task, about.
MEETING = 4_000_000

#: Access points of references that are sent to every task, at most; beyond that both sides are shuffled.
KNOWN_POINTS = 200_000

#: Subsets that are looked up for each entry of the tables, at most, and points of the largest set that is looked up by subsets.
SUBSETS, MOST_POINTS = 16, 14


def signal_weights(
    readings: DataFrame, keys: Sequence[str] = ("visit",), point: str = "bssid", signal: str = "rssi", floor: float = FLOOR, band: float = BAND
) -> DataFrame:
    """``keys``, ``point``, ``weight`` (whole number from 1) of each access point of a visit, by its strongest reading of at least ``floor``."""
    strongest = readings.where(F.col(signal) >= floor).groupBy(*keys, point).agg(F.max(signal).alias("__best"))
    return strongest.select(*keys, point, (1 + F.floor((F.col("__best") - floor) / band)).cast("long").alias("weight"))


def _entries(sets: DataFrame, rarity: DataFrame, within: Sequence[str]) -> DataFrame:
    """The entries with the weight of their whole set and the weight of the entries behind them, rare points first."""
    along = Window.partitionBy(*within, "id").orderBy("__seen", "point")
    whole = Window.partitionBy(*within, "id")
    placed = sets.join(rarity, [*within, "point"])
    # Where only the points that can be common are entries, the weight of the whole set comes with them.
    total = F.col("total") if "total" in sets.columns else F.sum("weight").over(whole)
    return placed.select(
        *within, "id", "point", "weight", "__sides", total.alias("total"), (total - F.sum("weight").over(along)).alias("behind")
    )


def _prefix(entries: DataFrame, score: float) -> DataFrame:
    """The entries one of which is common to a pair that reaches ``score``.

    The score is the mean of the two matched shares and neither exceeds 1, so both are at least 2 * score - 1. Common
    entries of that weight cannot all lie where less weight than that is left, so the rarest common one stands before.
    """
    need = 2 * score - 1
    if need <= 0:
        return entries
    return entries.where((F.col("weight") + F.col("behind")) >= F.col("total") * need - 1e-9)


def best_references(
    visits: DataFrame,
    references: DataFrame,
    key: str = "visit",
    point: str = "bssid",
    weight: str = "weight",
    within: Sequence[str] = (),
    steps: Sequence[float] = STEPS,
) -> DataFrame:
    """For every visit the reference with the best score: ``within``, ``visit``, ``reference``, ``score``, ``matched``, ``new``.

    Both tables have one row per (``key``, ``point``) with a positive weight. Half of the score is the share of the
    reference's weight that the visit has seen (``matched``); the other half is 1 minus the share of the visit's weight that
    the reference does not know (``new``). Ties go to the smallest key of a reference. A visit is no reference of itself. With ``within``
    only references with equal values there count. A visit without any common point has no reference and score 0.

    Sets of few points are not paired at all, however many of them share a point. The common points of a pair are a subset of
    both sets, and among the references that have a subset the one it makes up most of is the best for every visit that has it. So an index over
    subsets holds the two best references of each (one may be the visit itself), and a visit looks up its own subsets: rows grow with the
    tables, not with the pairs. A score needs shares of a certain size on both sides, which leaves out most
    subsets: high scores come first, then lower ones for the visits still without a reference that reaches the score before.
    What counts as few is measured, so that subsets stay within ``SUBSETS`` times the entries of the tables.

    Of a visit only the points that some reference (with equal ``within``) has can be common, so only these go on, with the weight of the
    whole visit; a visit without any goes no further.

    Larger sets meet in an inverted index over access points that holds only the rarest ones of each set (prefix filtering).
    An access point that meets too often is split: its references are copied to several parts among which its visits are
    spread, by the measured numbers of both.

    Defined cases: null keys and points are left out; repeated rows of a point count once, with the largest weight; an empty table of
    references gives every visit score 0.
    """
    names = [*within]

    def sets(df: DataFrame, common: DataFrame | None = None) -> DataFrame:
        own = df.select(*names, F.col(key).alias("id"), F.col(point).alias("point"), F.col(weight).cast("long").alias("weight"))
        own = own.dropna().groupBy(*names, "id", "point").agg(F.max("weight").alias("weight"))
        entry = F.struct("point", "weight")
        if common is not None:
            own = own.join(common.withColumn("__common", F.lit(True)), [*names, "point"], "left")
            entry = F.when(F.col("__common"), entry)
        # A scan has a bounded number of points.
        points = F.array_sort(F.collect_list(entry))
        return own.groupBy(*names, "id").agg(points.alias("points"), F.sum("weight").alias("total"))

    known = checkpointed(sets(references))
    common = checkpointed(known.select(*names, F.explode("points.point").alias("point")).distinct())
    every_asked = checkpointed(sets(visits, F.broadcast(common) if common.count() <= KNOWN_POINTS else common))
    asked = every_asked.where(F.size("points") > 0)
    few = _few_points(asked, known)
    small, large = (F.size("points") <= few), (F.size("points") > few)
    pairings = []
    for one, other in ((asked.where(large), known), (asked.where(small), known.where(large))):
        if not one.isEmpty() and not other.isEmpty():
            pairings.append(_pairing(one, other, names))

    found: DataFrame | None = None
    left = asked
    for score in steps:
        last = score == steps[-1]
        met = _by_subsets(left.where(small), known.where(small), score, names)
        waiting = left.select(*names, "id")
        for one, other in pairings:
            met = met.unionByName(_by_pairs(one.join(waiting, [*names, "id"], "left_semi"), other, score, names))
        best = checkpointed(_best(met, score, names, last))
        found = best if found is None else found.unionByName(best)
        left = left.join(best.select(*names, "id"), [*names, "id"], "left_anti")
    rest = left.select(*names, "id").unionByName(every_asked.where(F.size("points") == 0).select(*names, "id"))
    missing = rest.select("*", *[F.lit(None).cast(t).alias(n) for n, t in (("reference", references.schema[key].dataType.simpleString()),)])
    missing = missing.select("*", F.lit(0.0).alias("score"), F.lit(0.0).alias("matched"), F.lit(1.0).alias("new"))
    every = found.unionByName(missing)
    return every.withColumnRenamed("id", key)


def _few_points(asked: DataFrame, known: DataFrame) -> int:
    """The number of points up to which a set is looked up by its subsets."""
    sizes = asked.select(F.size("points").alias("n")).unionAll(known.select(F.size("points").alias("n"))).groupBy("n").count()
    # One sum per number of points that is small enough, and one over the rest.
    rows = {r.n: r["count"] for r in sizes.where(F.col("n") <= MOST_POINTS).collect()}
    entries = sizes.agg(F.sum(F.col("n") * F.col("count"))).first()[0] or 0
    few, subsets = 0, 0
    for n in range(1, MOST_POINTS + 1):
        subsets += rows.get(n, 0) * 2**n
        if subsets <= SUBSETS * entries:
            few = n
    return few


def _subsets(sets: DataFrame, score: float, names: Sequence[str]) -> DataFrame:
    """A row for each subset of the points whose share of the whole weight lets a pair reach ``score``: ``subset`` and ``share``."""
    # Each point is written with its length before it, so that no two subsets read alike.
    every = F.aggregate(
        "points",
        F.array(F.struct(F.lit("").alias("subset"), F.lit(0).cast("long").alias("weight"))),
        lambda made, p: F.concat(
            made,
            F.transform(
                made,
                lambda s: F.struct(
                    F.concat(s["subset"], F.length(p["point"].cast("string")).cast("string"), F.lit(":"), p["point"].cast("string")).alias("subset"),
                    (s["weight"] + p["weight"]).alias("weight"),
                ),
            ),
        ),
    )
    need = F.col("total") * max(0.0, 2 * score - 1) - 1e-9
    wanted = F.filter(every, lambda s: (s["weight"] > 0) & (s["weight"] >= need))
    return sets.select(*names, "id", "total", F.inline(wanted)).select(*names, "id", "subset", (F.col("weight") / F.col("total")).alias("share"))


def _by_subsets(asked: DataFrame, known: DataFrame, score: float, names: Sequence[str]) -> DataFrame:
    """For each subset of a visit the best other reference that has it: ``id``, ``reference``, ``matched``, ``seen``.

    A reference may have more points in common than the subset; it then comes again, with a higher score, for the larger one.
    """
    top = Window.partitionBy(*names, "subset").orderBy(F.desc("share"), "id")
    first = _subsets(known, score, names).withColumn("__place", F.row_number().over(top)).where("__place <= 2")

    def placed(column: str, place: int) -> Column:
        return F.max(F.when(F.col("__place") == place, F.col(column)))

    index = first.groupBy(*names, "subset").agg(
        placed("id", 1).alias("first"), placed("share", 1).alias("first_share"),
        placed("id", 2).alias("second"), placed("share", 2).alias("second_share"),
    )
    met = _subsets(asked, score, names).join(index, [*names, "subset"])
    own = F.col("id") == F.col("first")
    met = met.select(
        *names, "id", F.when(own, F.col("second")).otherwise(F.col("first")).alias("reference"),
        F.when(own, F.col("second_share")).otherwise(F.col("first_share")).alias("matched"), F.col("share").alias("seen"),
    )
    return met.where("reference is not null")


def _pairing(asked: DataFrame, known: DataFrame, names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The entries of both sides, see :func:`_entries`."""
    asked, known = (d.select(*names, "id", "total", F.inline("points")) for d in (asked, known))
    counted = asked.groupBy(*names, "point").agg(F.count(F.lit(1)).alias("__asked"))
    counted = counted.join(known.groupBy(*names, "point").agg(F.count(F.lit(1)).alias("__known")), [*names, "point"], "full")
    pairs = F.coalesce("__asked", F.lit(0)) * F.coalesce("__known", F.lit(0))
    rarity = counted.select(
        *names, "point", pairs.alias("__seen"), F.ceil(F.greatest(pairs, F.lit(1)) / F.lit(MEETING)).cast("int").alias("__sides")
    )
    return checkpointed(_entries(asked, rarity, names)), checkpointed(_entries(known, rarity, names))


def _by_pairs(asked: DataFrame, known: DataFrame, score: float, names: Sequence[str]) -> DataFrame:
    """The pairs of which one of the rarer points is common, with what they have in common: ``id``, ``reference``, ``matched``, ``seen``."""
    side = F.pmod(F.xxhash64("id"), F.col("__sides")).cast("int")
    index = _prefix(known, score).select(
        *names, "point", F.col("id").alias("reference"), F.explode(F.sequence(F.lit(0), F.col("__sides") - 1)).alias("__side")
    )
    met = (
        _prefix(asked, score)
        .select(*names, "point", "id", side.alias("__side"))
        .join(index, [*names, "point", "__side"])
        .where("id <> reference")
        .select(*names, "id", "reference")
        .distinct()
    )
    # Both whole sets of a candidate pair: a scan has a bounded number of points.
    points = F.map_from_entries(F.collect_list(F.struct("point", "weight")))
    of_asked = asked.groupBy(*names, "id", "total").agg(points.alias("own"))
    of_known = known.groupBy(*names, F.col("id").alias("reference"), F.col("total").alias("whole")).agg(points.alias("other"))
    both = met.join(of_asked, [*names, "id"]).join(of_known, [*names, "reference"])
    common = F.array_intersect(F.map_keys("own"), F.map_keys("other"))

    def weighed(side: str) -> Column:
        return F.aggregate("common", F.lit(0).cast("long"), lambda a, p: a + F.col(side)[p])

    both = both.withColumn("common", common)
    return both.select(*names, "id", "reference", (weighed("other") / F.col("whole")).alias("matched"), (weighed("own") / F.col("total")).alias("seen"))


def _best(met: DataFrame, score: float, names: Sequence[str], last: bool) -> DataFrame:
    """The best reference of each visit that has one of at least ``score`` (in the last step: any with a common point)."""
    both = met.withColumn("score", 0.5 * F.col("matched") + 0.5 * F.col("seen"))
    if not last:
        both = both.where(F.col("score") >= score)
    top = Window.partitionBy(*names, "id").orderBy(F.desc("score"), "reference")
    first = both.withColumn("__place", F.row_number().over(top)).where("__place = 1")
    return first.select(*names, "id", "reference", "score", "matched", (1 - F.col("seen")).alias("new"))
