"""Queries of the Wi-Fi visit workload."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom import views
from eventloom.catalog.base import query, rounded
from eventloom.operators import similarity as sim
from eventloom.operators import visits as v
from eventloom.plans import pipelines


@query("scan_unpack", "SELECT visit, pid, type, date, pos, bssid, rssi, frequency FROM readings")
def _(spark, folder):
    return v.unpack_scans(views.scans(spark, folder), part="part")


@query(
    "scan_drop_single",
    """SELECT visit, pid, type, date, pos, bssid, rssi, frequency FROM readings
       WHERE visit IN (SELECT visit FROM readings GROUP BY visit HAVING count(*) > 1)""",
)
def _(spark, folder):
    # survey scans carry a terminator
    wifi = F.when(F.col("type") == 1, v.with_terminator("wifi")).otherwise(F.col("wifi"))
    packed = views.scans(spark, folder).withColumn("wifi", wifi)
    return v.unpack_scans(packed, part="part", drop_single=True)


@query(
    "scan_dedup_mean",
    """SELECT pid, date, visit, bssid, round(rssi, 6) AS rssi, round(frequency, 6) AS frequency FROM deduped""",
)
def _(spark, folder):
    return rounded(v.mean_readings(views.readings(spark, folder)), "rssi", "frequency")


@query(
    "scan_dedup_first",
    """SELECT pid, date, visit, bssid, round(avg(rssi), 6) AS rssi, round(avg(frequency), 6) AS frequency,
       min(type) AS type FROM readings GROUP BY pid, date, visit, bssid""",
)
def _(spark, folder):
    return rounded(v.mean_readings_typed(views.readings(spark, folder)), "rssi", "frequency")


def _daily_sql(how: str) -> str:
    return f"""SELECT date, rank, pid, round({how}(similarity), 6) AS similarity, round(avg(threshold), 6) AS threshold
        FROM visit_log GROUP BY date, rank, pid"""


@query("visit_daily_mean", _daily_sql("avg"))
def _(spark, folder):
    return rounded(v.daily(views.visit_log(spark, folder), "mean"), "similarity", "threshold")


@query("visit_daily_max", _daily_sql("max"))
def _(spark, folder):
    return rounded(v.daily(views.visit_log(spark, folder), "max"), "similarity", "threshold")


@query(
    "visit_hit_rate",
    """SELECT pid, date, count(*) AS rank_1_cnt, count(*) FILTER (similarity > threshold) AS similarity_up,
       round(count(*) FILTER (similarity > threshold) / CAST(count(*) AS DOUBLE), 6) AS hit_rate
       FROM visit_log WHERE rank = 1 GROUP BY pid, date""",
)
def _(spark, folder):
    return rounded(v.hit_rate(views.visit_log(spark, folder).filter("rank = 1")), "hit_rate")


@query("survey_dates", "SELECT DISTINCT pid, date FROM visit_log WHERE type = 1")
def _(spark, folder):
    return v.survey_dates(views.visit_log(spark, folder))


@query(
    "strong_bssid_count",
    "SELECT pid, count(DISTINCT bssid) AS high_rssi_bssid_cnt FROM deduped WHERE rssi > -50 GROUP BY pid",
)
def _(spark, folder):
    return v.strong_bssid_count(v.mean_readings(views.readings(spark, folder)))


@query(
    "top_places",
    """SELECT pid, count(DISTINCT bssid) AS high_rssi_bssid_cnt FROM deduped WHERE rssi > -50 GROUP BY pid
       ORDER BY high_rssi_bssid_cnt DESC, pid LIMIT 230""",
)
def _(spark, folder):
    return v.top_places(v.mean_readings(views.readings(spark, folder)), 230)


@query("bssid_mean_rssi", "SELECT bssid, round(avg(rssi), 6) AS mean_rssi FROM readings GROUP BY bssid")
def _(spark, folder):
    return rounded(v.mean_rssi(views.readings(spark, folder)), "mean_rssi")


# --- series -----------------------------------------------------------------------------------------


def _moving(column: str, n: int, name: str) -> str:
    frame = f"(PARTITION BY pid ORDER BY {{order}} ROWS BETWEEN {n - 1 - n // 2} PRECEDING AND {n // 2} FOLLOWING)"
    return f"round(CASE WHEN count({column}) OVER {frame} = {n} THEN avg({column}) OVER {frame} END, 6) AS {name}"


_SERIES = ", ".join(_moving(*o) for o in v.MOVING_AVERAGES)
_NAMES = [o[2] for o in v.MOVING_AVERAGES]


def series_sql(source: str, order: str, columns: str) -> str:
    return f"SELECT {columns}, {_SERIES.format(order=order)} FROM {source}"


@query("moving_avg_10_20", series_sql("(SELECT * FROM visit_log WHERE rank = 1)", "date, visit", "visit, pid, date"))
def _(spark, folder):
    log = views.visit_log(spark, folder).filter("rank = 1")
    done = v.centred_mean(log, ["pid"], v.VISIT_ORDER, v.MOVING_AVERAGES)
    return rounded(done.select("visit", "pid", "date", *_NAMES), *_NAMES)


@query(
    "moving_avg_hits",
    series_sql("(SELECT * FROM visit_log WHERE rank = 1 AND similarity > threshold)", "date, visit", "visit, pid, date"),
)
def _(spark, folder):
    log = views.visit_log(spark, folder).filter("rank = 1 AND similarity > threshold")
    done = v.centred_mean(log, ["pid"], v.VISIT_ORDER, v.MOVING_AVERAGES)
    return rounded(done.select("visit", "pid", "date", *_NAMES), *_NAMES)


def _daily_series(how: str) -> str:
    source = f"""(SELECT date, rank, pid, {how}(similarity) AS similarity, avg(threshold) AS threshold FROM visit_log
        WHERE rank = 1 GROUP BY date, rank, pid)"""
    return series_sql(source, "date", "pid, date")


for _how, _fn in (("mean", "avg"), ("max", "max")):

    def _run(spark, folder, how=_how):
        daily = v.daily(views.visit_log(spark, folder).filter("rank = 1"), how)
        done = v.centred_mean(daily, ["pid"], ["date"], v.MOVING_AVERAGES)
        return rounded(done.select("pid", "date", *_NAMES), *_NAMES)

    query("moving_avg_daily" if _how == "mean" else "moving_avg_daily_max", _daily_series(_fn))(_run)


@query(
    "nth_survey_visit",
    """SELECT pid, max(CASE WHEN n = 1 THEN visit END) AS survey_1, max(CASE WHEN n = 2 THEN visit END) AS survey_2,
       max(CASE WHEN n = 3 THEN visit END) AS survey_3, max(CASE WHEN n = 4 THEN visit END) AS survey_4, max(visit) AS survey_last
       FROM (SELECT pid, visit, row_number() OVER (PARTITION BY pid ORDER BY visit) AS n FROM visit_log WHERE type = 1) GROUP BY pid""",
)
def _(spark, folder):
    return v.nth_surveys(views.visit_log(spark, folder))


@query(
    "visit_index",
    'SELECT visit, pid, date, row_number() OVER (PARTITION BY pid ORDER BY date, visit) AS "index" FROM visit_log',
)
def _(spark, folder):
    return v.visit_index(views.visit_log(spark, folder)).select("visit", "pid", "date", "index")


# --- order of access points, matrices, flags ----------------------------------------------------------

_BY_MEAN = "ORDER BY avg(rssi) DESC, bssid"


@query(
    "bssid_order",
    f"SELECT bssid, round(avg(rssi), 6) AS mean_rssi, row_number() OVER ({_BY_MEAN}) AS bssid_rank FROM readings GROUP BY bssid",
)
def _(spark, folder):
    return rounded(v.bssid_order(views.readings(spark, folder)), "mean_rssi")


@query(
    "bssid_order_visit",
    f"""SELECT visit, bssid, round(avg(rssi), 6) AS mean_rssi,
        row_number() OVER (PARTITION BY visit {_BY_MEAN}) AS bssid_rank FROM readings GROUP BY visit, bssid""",
)
def _(spark, folder):
    return rounded(v.bssid_order(views.readings(spark, folder), ["visit"]), "mean_rssi")


@query(
    "heatmap_cells",
    f"""WITH o AS (SELECT bssid, row_number() OVER ({_BY_MEAN}) AS bssid_rank FROM readings GROUP BY bssid)
        SELECT date, bssid, round(avg(rssi), 6) AS rssi, bssid_rank FROM readings JOIN o USING (bssid) GROUP BY date, bssid, bssid_rank""",
)
def _(spark, folder):
    return rounded(v.heatmap_cells(views.readings(spark, folder)), "rssi")


_BSSIDS = [f"b{i}" for i in range(40)]


@query(
    "pivot_bssid",
    "SELECT visit, "
    + ", ".join(f"round(avg(rssi) FILTER (bssid = '{b}'), 6) AS {b}" for b in _BSSIDS)
    + " FROM readings GROUP BY visit",
)
def _(spark, folder):
    return rounded(v.pivot_bssid(views.readings(spark, folder)), *_BSSIDS)


_NUMBERED = """WITH numbered AS (SELECT r.pid, r.bssid, r.rssi, r.frequency, k.n FROM readings r JOIN (
    SELECT pid, visit, row_number() OVER (PARTITION BY pid ORDER BY date, visit) AS n
    FROM (SELECT DISTINCT pid, date, visit FROM readings)) k ON r.pid = k.pid AND r.visit = k.visit)"""


#: Columns of the pivot by visits; further visits of a place take further rows.
VISIT_BLOCK = 500


@query(
    "pivot_visit",
    f"{_NUMBERED} SELECT pid, bssid, n AS visit_no, round(avg(rssi), 6) AS rssi FROM numbered GROUP BY pid, bssid, n",
)
def _(spark, folder):
    # All columns, however many the data have, laid down as rows again: a fixed form that shows every value.
    wide = v.pivot_visit(views.readings(spark, folder), block=VISIT_BLOCK)
    columns = [c for c in wide.columns if c.startswith("visit_")]
    cells = F.posexplode(F.array(*columns)) if columns else F.posexplode(F.array().cast("array<double>"))
    rows = wide.select("pid", "bssid", "first_visit", cells.alias("place", "rssi")).where("rssi IS NOT NULL")
    return rounded(rows.select("pid", "bssid", (F.col("first_visit") + F.col("place")).cast("bigint").alias("visit_no"), "rssi"), "rssi")


_BRIDGED = f"""{_NUMBERED}, per AS (SELECT pid, bssid, n, avg(rssi) AS rssi, avg(frequency) AS frequency FROM numbered
        GROUP BY pid, bssid, n),
    steps AS (SELECT *, n - lag(n) OVER (PARTITION BY pid, bssid ORDER BY n) AS step FROM per),
    wide AS (SELECT pid, bssid, max(CASE WHEN step > 1 THEN 1 ELSE 0 END) AS bridge,
        avg(frequency) AS frequency, avg(rssi) AS rssi FROM steps GROUP BY pid, bssid)"""


@query("bridge_flag", f"{_BRIDGED} SELECT pid, bssid, bridge FROM wide")
def _(spark, folder):
    return v.bridges(views.readings(spark, folder)).select("pid", "bssid", "bridge")


@query(
    "band_flag",
    f"{_BRIDGED} SELECT pid, bssid, CAST(frequency < 3000 AS INT) AS frequency_24, round(rssi, 6) AS rssi FROM wide",
)
def _(spark, folder):
    return rounded(v.bridges(views.readings(spark, folder)).select("pid", "bssid", "frequency_24", "rssi"), "rssi")


@query(
    "bridge_flag_all_visits",
    f"""{_NUMBERED}, seen AS (SELECT DISTINCT pid, bssid, n FROM numbered),
        steps AS (SELECT pid, bssid, n - lag(n) OVER (PARTITION BY pid, bssid ORDER BY n) AS step FROM seen)
        SELECT pid, bssid, max(CASE WHEN step > 1 THEN 1 ELSE 0 END) AS bridge FROM steps GROUP BY pid, bssid""",
)
def _(spark, folder):
    return v.bridges(views.readings(spark, folder)).select("pid", "bssid", "bridge")


@query(
    "scan_features",
    f"""{_BRIDGED} SELECT pid, bssid, bridge, CAST(frequency < 3000 AS INT) AS frequency_24, round(rssi, 6) AS rssi FROM wide""",
)
def _(spark, folder):
    return rounded(pipelines.scan_features(views.scans(spark, folder)), "rssi")


_KNOWN = "(SELECT DISTINCT s.pid, s.bssid, 1 AS known FROM readings s JOIN surveys v ON s.pid = v.pid AND s.visit = v.visit AND v.n = {n})"


@query(
    "checked_wifi",
    f"""SELECT visit, pid, bssid, rssi, CASE WHEN known = 1 THEN 1 ELSE 0 END AS checked_wifi
        FROM readings LEFT JOIN {_KNOWN.format(n=1)} k USING (pid, bssid)""",
)
def _(spark, folder):
    return v.survey_flag(views.readings(spark, folder), 1).select("visit", "pid", "bssid", "rssi", "checked_wifi")


@query(
    "checked_wifi_type",
    f"""SELECT visit, pid, bssid, rssi, CASE WHEN type = 1 THEN 1 WHEN known = 1 AND type = 0 THEN 2 ELSE 4 END AS checked_wifi_type
        FROM readings LEFT JOIN {_KNOWN.format(n=2)} k USING (pid, bssid)""",
)
def _(spark, folder):
    return v.tile_class(views.readings(spark, folder), 2).select("visit", "pid", "bssid", "rssi", "checked_wifi_type")


_SCORED = """WITH sets AS (SELECT visit, pid, type, bssid, 1 + (max(rssi) + 80) // 10 AS w FROM readings WHERE rssi >= -80 GROUP BY ALL),
    totals AS (SELECT visit, pid, sum(w) AS w FROM sets GROUP BY visit, pid),
    pairs AS (SELECT a.visit, b.visit AS reference, sum(b.w) AS theirs, sum(a.w) AS own FROM sets a JOIN sets b
        ON a.bssid = b.bssid AND a.visit <> b.visit AND b.type = 1 {same} GROUP BY a.visit, b.visit),
    scored AS (SELECT p.visit, p.reference, p.theirs / CAST(r.w AS DOUBLE) AS matched, p.own / CAST(t.w AS DOUBLE) AS seen
        FROM pairs p JOIN totals t ON p.visit = t.visit JOIN totals r ON p.reference = r.visit),
    best AS (SELECT *, row_number() OVER (PARTITION BY visit ORDER BY 0.5 * matched + 0.5 * seen DESC, reference) AS place FROM scored)
    SELECT {pid} t.visit, b.reference, round(coalesce(0.5 * b.matched + 0.5 * b.seen, 0), 6) AS score,
        round(coalesce(b.matched, 0), 6) AS matched, round(1 - coalesce(b.seen, 0), 6) AS new
    FROM totals t LEFT JOIN best b ON t.visit = b.visit AND b.place = 1"""


@query("visit_best_survey", _SCORED.format(same="", pid=""))
def _(spark, folder):
    """Every visit against the surveys of all places."""
    seen = sim.signal_weights(views.readings(spark, folder), ("visit", "type"))
    return rounded(sim.best_references(seen, seen.where("type = 1")), "score", "matched", "new")


@query("visit_best_survey_of_place", _SCORED.format(same="AND a.pid = b.pid", pid="t.pid,"))
def _(spark, folder):
    """Every visit against the surveys of its own place."""
    seen = sim.signal_weights(views.readings(spark, folder), ("visit", "pid", "type"))
    return rounded(sim.best_references(seen, seen.where("type = 1"), within=["pid"]), "score", "matched", "new")
