"""Wi-Fi scans and store visits: unpacking, series, matrices, bridges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.operators.ordered import (
    dealt,
    group_limit,
    group_stats,
    position,
)

# Record width and delimiter of a packed scan by visit type (0 log, 1 survey).
SCAN_FORMATS = {0: (",", 4), 1: ("\t", 5)}
# Place of each kept field in a record, from 1.
SCAN_FIELDS = {"bssid": 1, "rssi": 3, "frequency": 4}
# Fixed value: frequencies below this many MHz belong to the 2.4 GHz band.
BAND_LIMIT = 3000

VISIT_ORDER = ("date", "visit")


def with_terminator(wifi: str | Column) -> Column:
    """The packed text with the trailing separator that survey scans carry."""
    return F.concat(F.col(wifi) if isinstance(wifi, str) else wifi, F.lit(" \t"))


def _format_of(kind: str, place: int) -> Column:
    """Delimiter (place 0) or width (place 1) of the scan format of each row."""
    chosen = None
    for code, fmt in SCAN_FORMATS.items():
        here = F.col(kind) == code
        chosen = F.when(here, F.lit(fmt[place])) if chosen is None else chosen.when(here, F.lit(fmt[place]))
    return chosen


def _with_tokens(df: DataFrame, wifi: str, kind: str) -> DataFrame:
    """Fields of each scan in ``__tokens`` (one trailing empty field dropped), record width in ``__width``."""
    split = df.withColumn("__parts", F.split(F.col(wifi), _format_of(kind, 0)))
    last = F.trim(F.element_at("__parts", -1))
    kept = F.when(last == "", F.slice("__parts", 1, F.size("__parts") - 1)).otherwise(F.col("__parts"))
    return split.withColumn("__tokens", kept).withColumn("__width", _format_of(kind, 1)).drop("__parts")


def unpack_scans(
    df: DataFrame,
    wifi: str = "wifi",
    kind: str = "type",
    drop_single: bool = False,
    part: str | None = None,
    visit: Sequence[str] = ("visit",),
) -> DataFrame:
    """One row per access point. An incomplete record at the end of a scan is dropped
    (see :func:`leftover_fields`); ``drop_single`` leaves out scans of one access point.

    With a ``part`` column, a scan is all rows of one ``visit`` in the order of their parts: positions count over
    all parts, and a scan is single if all its parts together hold one record. The part column is left out.
    """
    others = [c for c in df.columns if c not in (wifi, part)]
    packed = _with_tokens(df, wifi, kind)
    packed = packed.withColumn("__whole", F.floor(F.size("__tokens") / F.col("__width")).cast("int"))
    before, total = F.lit(0).cast("bigint"), F.col("__whole")
    if part is not None:
        parts = Window.partitionBy(*visit)
        earlier = parts.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
        packed = packed.withColumns(
            {"__before": F.coalesce(F.sum("__whole").over(earlier), F.lit(0)), "__total": F.sum("__whole").over(parts)}
        )
        before, total = F.col("__before"), F.col("__total")

    def record(k: Column) -> Column:
        field = lambda place: F.trim(F.element_at("__tokens", k * F.col("__width") + place))
        return F.struct(
            (before + k + 1).cast("bigint").alias("pos"),
            field(SCAN_FIELDS["bssid"]).alias("bssid"),
            field(SCAN_FIELDS["rssi"]).try_cast("int").alias("rssi"),
            field(SCAN_FIELDS["frequency"]).try_cast("int").alias("frequency"),
        )

    # a sequence to -1 would count down: scans without a whole record leave here
    packed = packed.filter((F.col("__whole") > 0) & (total > (1 if drop_single else 0)))
    return packed.select(*others, F.inline(F.transform(F.sequence(F.lit(0), F.col("__whole") - 1), record)))


def leftover_fields(df: DataFrame, wifi: str = "wifi", kind: str = "type", name: str = "leftover") -> DataFrame:
    """Add the number of fields after the last whole record of each scan."""
    counted = _with_tokens(df, wifi, kind)
    return counted.withColumn(name, F.pmod(F.size("__tokens"), F.col("__width"))).drop("__tokens", "__width")


def mean_readings(readings: DataFrame, keys: Sequence[str] = ("pid", "date", "visit", "bssid")) -> DataFrame:
    """Repeated readings of an access point within a visit combined to their mean."""
    return readings.groupBy(*keys).agg(F.avg("rssi").alias("rssi"), F.avg("frequency").alias("frequency"))


def mean_readings_typed(readings: DataFrame, keys: Sequence[str] = ("pid", "date", "visit", "bssid")) -> DataFrame:
    """:func:`mean_readings` that keeps the visit type (constant within a visit)."""
    return readings.groupBy(*keys).agg(
        F.avg("rssi").alias("rssi"), F.avg("frequency").alias("frequency"), F.min("type").alias("type")
    )


def daily(visits: DataFrame, how: str = "mean") -> DataFrame:
    """Mean or largest similarity and mean threshold per (date, rank, pid)."""
    similarity = F.avg("similarity") if how == "mean" else F.max("similarity")
    return visits.groupBy("date", "rank", "pid").agg(
        similarity.alias("similarity"), F.avg("threshold").alias("threshold")
    )


# Output names that later steps of the workload refer to (rank_1_cnt, similarity_up, hit_rate,
# high_rssi_bssid_cnt, and the names of the moving averages).


def hit_rate(visits: DataFrame, keys: Sequence[str] = ("pid", "date")) -> DataFrame:
    """Visits, visits above the threshold, and their quotient."""
    hits = F.count_if(F.col("similarity") > F.col("threshold"))
    return visits.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rank_1_cnt"),
        hits.alias("similarity_up"),
        (hits / F.count(F.lit(1))).alias("hit_rate"),
    )


def survey_dates(visits: DataFrame) -> DataFrame:
    return visits.filter("type = 1").select("pid", "date").distinct()


def strong_bssid_count(readings: DataFrame, floor: float = -50) -> DataFrame:
    """Distinct strongly received access points per place."""
    pairs = readings.filter(F.col("rssi") > floor).groupBy("pid", "bssid").agg(F.count(F.lit(1)).alias("__n"))
    return pairs.groupBy("pid").agg(F.count(F.lit(1)).alias("high_rssi_bssid_cnt"))


def top_places(readings: DataFrame, n: int = 230) -> DataFrame:
    counts = strong_bssid_count(readings)
    return counts.orderBy(F.desc("high_rssi_bssid_cnt"), "pid").limit(n)


# --- series ----------------------------------------------------------------------------------------


def centred_mean(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], outputs: Sequence[tuple[str, int, str]]
) -> DataFrame:
    """Centred moving averages; ``outputs`` holds (column, width, name).

    An even width leans forward: rows -(n-1-n//2) to +(n//2). The value is missing at both edges of a group
    and where any value of the frame is missing.
    """
    (stats,) = group_stats(df, [keys])
    if stats.largest <= group_limit(df, stats.rows):
        return _mean_over(df, keys, order, outputs)
    # Oversized groups: number the rows, cut each group into cells of consecutive rows and lend
    # every cell the neighbouring rows that its frames reach into.
    reach = max(n for _, n, _ in outputs)
    cell_rows = max(group_limit(df, stats.rows) // 2, 2 * reach)
    numbered = position(df, keys, order, "__n").withColumn("__n", F.col("__n") - 1)
    cell = F.floor(F.col("__n") / cell_rows)
    offset = F.pmod(F.col("__n"), F.lit(cell_rows))
    homes = F.array_compact(
        F.array(
            cell,
            F.when((offset < reach) & (cell > 0), cell - 1),
            F.when(offset >= cell_rows - reach, cell + 1),
        )
    )
    lent = numbered.withColumn("__home", cell).withColumn("__cell", F.explode(homes))
    result = _mean_over(lent, [*keys, "__cell"], ["__n"], outputs)
    return result.filter("__home = __cell").drop("__n", "__home", "__cell")


def _mean_over(df, keys, order, outputs) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    values = {}
    for column, n, name in outputs:
        frame = window.rowsBetween(-(n - 1 - n // 2), n // 2)
        values[name] = F.when(F.count(column).over(frame) == n, F.avg(column).over(frame))
    return df.withColumns(values)


MOVING_AVERAGES = (("similarity", 10, "similar_mav_10"), ("similarity", 20, "similar_mav_20"), ("threshold", 20, "thres_mav_20"))


def visit_index(visits: DataFrame, order: Sequence[str] = VISIT_ORDER) -> DataFrame:
    """Sequence number of each visit within its place."""
    return position(visits, ["pid"], order, "index")


def nth_surveys(visits: DataFrame) -> DataFrame:
    """First to fourth and last surveyed visit per place (visit numbers in ascending order)."""
    surveyed = visits.filter("type = 1").select("pid", "visit").distinct()
    numbered = position(surveyed, ["pid"], ["visit"], "__n")
    nth = [F.max(F.when(F.col("__n") == i, F.col("visit"))).alias(f"survey_{i}") for i in range(1, 5)]
    return numbered.groupBy("pid").agg(*nth, F.max("visit").alias("survey_last"))


def survey_bssids(readings: DataFrame, n: int = 1) -> DataFrame:
    """Access points seen in the n-th surveyed visit of each place: (pid, bssid)."""
    surveyed = readings.filter("type = 1")
    visits = position(surveyed.select("pid", "visit").distinct(), ["pid"], ["visit"], "__n")
    chosen = visits.filter(F.col("__n") == n).select("pid", "visit")
    return surveyed.join(chosen, ["pid", "visit"], "left_semi").select("pid", "bssid").distinct()


def seen_in_survey(readings: DataFrame, n: int = 1) -> DataFrame:
    """Readings of access points that the n-th survey of the place saw."""
    return readings.join(survey_bssids(readings, n), ["pid", "bssid"], "left_semi")


def survey_flag(readings: DataFrame, n: int = 1, name: str = "checked_wifi") -> DataFrame:
    """1 where the n-th survey of the place saw the access point, else 0."""
    known = survey_bssids(readings, n).withColumn("__known", F.lit(True))
    joined = readings.join(known, ["pid", "bssid"], "left")
    return joined.withColumn(name, F.col("__known").isNotNull().cast("int")).drop("__known")


def tile_class(readings: DataFrame, n: int = 1, other: int = 4, name: str = "checked_wifi_type") -> DataFrame:
    """1 survey reading, 2 log reading of a surveyed access point, ``other`` everything else."""
    flagged = survey_flag(readings, n, "__in")
    code = F.when(F.col("type") == 1, 1).when((F.col("__in") == 1) & (F.col("type") == 0), 2).otherwise(other)
    return flagged.withColumn(name, code).drop("__in")


# --- order of access points, matrices, bridges ---------------------------------------------------------


def mean_rssi(readings: DataFrame, keys: Sequence[str] = ("bssid",)) -> DataFrame:
    return readings.groupBy(*keys).agg(F.avg("rssi").alias("mean_rssi"))


def bssid_order(readings: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rank of each access point by mean signal, strongest first."""
    means = mean_rssi(readings, [*by, "bssid"])
    return position(means, by, [F.desc("mean_rssi"), F.asc("bssid")], "bssid_rank")


def heatmap_cells(readings: DataFrame) -> DataFrame:
    """Mean signal per (date, bssid) with the rank of the access point."""
    cells = mean_rssi(readings, ["date", "bssid"]).withColumnRenamed("mean_rssi", "rssi")
    ranks = bssid_order(readings).select("bssid", "bssid_rank")
    return cells.join(ranks, "bssid")


#: Columns that one pivot may make; Spark's own limit is of the same size.
PIVOT_COLUMNS = 10_000


def _pivot_values(df: DataFrame, column: str) -> list:
    """The distinct values of a column, if they can become columns."""
    values = [r[0] for r in df.select(column).distinct().limit(PIVOT_COLUMNS + 1).collect()]
    if len(values) > PIVOT_COLUMNS:
        raise ValueError(f"{column} has more than {PIVOT_COLUMNS} values; keep it as rows")
    return sorted(v for v in values if v is not None)


def pivot_bssid(
    readings: DataFrame,
    bssids: Sequence[str] | None = None,
    keys: Sequence[str] = ("visit",),
    leave_out: bool = False,
) -> DataFrame:
    """One row per visit, one column of mean signal per access point.

    Without ``bssids`` the access points are those of the data. A given list that does not name all of them
    is refused, unless ``leave_out`` says that the others are not wanted.
    """
    found = None if bssids is not None and leave_out else _pivot_values(readings, "bssid")
    missing = set(found or ()) - set(bssids if bssids is not None else found)
    if missing:
        raise ValueError(f"access points without a column: {sorted(missing)[:5]} and others ({len(missing)} in all)")
    return readings.groupBy(*keys).pivot("bssid", list(found if bssids is None else bssids)).agg(F.avg("rssi"))


def number_visits(df: DataFrame, name: str = "visit_no") -> DataFrame:
    """Add the number of each visit within its place, to packed scans or to readings."""
    visits = df.select("pid", "date", "visit").distinct()
    numbers = position(visits, ["pid"], VISIT_ORDER, name)
    return df.join(numbers.select("pid", "visit", name), ["pid", "visit"])


def pivot_visit(readings: DataFrame, value: str = "rssi", visits: int | None = None, block: int | None = None) -> DataFrame:
    """One row per (place, access point), one column per visit of the place, in visit order.

    There are as many columns as the place with most visits has, or ``visits`` of them on request. A table has no room for
    the columns of very many visits: with ``block`` a row holds that many visits, a further row the next ones, and
    ``first_visit`` tells the number of the visit in column ``visit_1``; rows without a reading are left out.
    """
    numbered = number_visits(readings)
    found, rows = numbered.agg(F.max("visit_no"), F.count(F.lit(1))).first()
    last = found or 0 if visits is None else visits
    if block is None and last > PIVOT_COLUMNS:
        raise ValueError(f"a place has {last} visits; lay them out in blocks")
    keys, width = ["pid", "bssid"], last
    if block is not None:
        numbered, width = numbered if visits is None else numbered.where(F.col("visit_no") <= visits), min(block, last)
        first = F.col("visit_no") - F.pmod(F.col("visit_no") - 1, F.lit(block))
        numbered = numbered.withColumn("first_visit", first).withColumn("visit_no", F.col("visit_no") - F.col("first_visit") + 1)
        # All visits of a row meet before they are laid out, so that no wide row is sent.
        keys = [*keys, "first_visit"]
        numbered = dealt(numbered, keys, rows)
    if not width:
        return numbered.select(*keys).distinct()
    wide = numbered.groupBy(*keys).pivot("visit_no", list(range(1, width + 1))).agg(F.avg(value))
    return wide.select(*keys, *[F.col(f"`{i}`").alias(f"visit_{i}") for i in range(1, width + 1)])


def bridge_table(numbered: DataFrame) -> DataFrame:
    """Per (place, access point): vanished and returned, 2.4 GHz band, mean signal.

    An access point bridges a gap if it is seen in fewer visits than lie between its first and last
    sighting. ``numbered`` holds readings with ``visit_no``.
    """
    per_visit = numbered.groupBy("pid", "bssid", "visit_no").agg(
        F.avg("rssi").alias("rssi"), F.avg("frequency").alias("frequency")
    )
    return per_visit.groupBy("pid", "bssid").agg(
        (F.max("visit_no") - F.min("visit_no") + 1 > F.count(F.lit(1))).cast("int").alias("bridge"),
        (F.avg("frequency") < BAND_LIMIT).cast("int").alias("frequency_24"),
        F.avg("rssi").alias("rssi"),
    )


def bridges(readings: DataFrame, visits: int | None = None) -> DataFrame:
    """:func:`bridge_table` of readings over all visits of a place; ``visits`` limits it to the first ones."""
    numbered = number_visits(readings)
    return bridge_table(numbered if visits is None else numbered.filter(F.col("visit_no") <= visits))
