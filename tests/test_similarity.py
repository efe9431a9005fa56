"""The best reference of every visit, against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from eventloom.operators import similarity as sim


def brute(visits, references, within=False):
    def sets(rows):
        out = {}
        for key, place, point, weight in rows:
            if key is not None and point is not None:
                own = out.setdefault((place, key), {})
                own[point] = max(own.get(point, 0), weight)
        return out

    known = sets(references)
    result = []
    for (place, key), own in sets(visits).items():
        best = None
        for (where, ref), other in known.items():
            common = own.keys() & other.keys()
            if not common or ref == key or (within and where != place):
                continue
            matched = sum(other[p] for p in common) / sum(other.values())
            seen = sum(own[p] for p in common) / sum(own.values())
            score = 0.5 * matched + 0.5 * seen
            if best is None or (score, -ref) > (best[1], -best[0]):
                best = (ref, score, matched, 1 - seen)
        result.append((place, key, *(best or (None, 0.0, 0.0, 1.0))))
    return sorted(result)


def rows_of(draw, keys, points, size, places=3):
    out = []
    for key in keys:
        place = key % places
        for _ in range(draw.randrange(1, size)):
            point = "hot" if draw.random() < 0.3 else f"p{draw.randrange(points)}"
            out.append((key, place, point, draw.randrange(1, 6)))
    return out


SCHEMA = "visit long, pid long, bssid string, weight long"


@pytest.mark.parametrize(("points", "size", "steps"), [(8, 6, sim.STEPS), (40, 12, sim.STEPS), (40, 12, (0.5,)), (300, 5, (0.9, 0.7, 0.6, 0.5))])
def test_equals_all_pairs(spark, monkeypatch, points, size, steps):
    """With an access point that meets so often that it is split."""
    monkeypatch.setattr(sim, "MEETING", 50)
    draw = random.Random(points + size)
    visits = rows_of(draw, range(120), points, size) + [(None, 0, "p1", 3), (500, 1, None, 2), (501, 1, "nowhere", 2)]
    visits += [(502, 0, "p0", 4), (502, 0, "p0", 1)]
    references = rows_of(draw, range(60, 160), points, size)
    left, right = (spark.createDataFrame(x, SCHEMA).repartition(4) for x in (visits, references))
    for within in (False, True):
        keys = ["pid"] if within else []
        left_, right_ = (left, right) if within else (left.drop("pid"), right.drop("pid"))
        got = sim.best_references(left_, right_, within=keys, steps=steps).collect()
        def placed(rows, within=within):
            return rows if within else [(k, 0, p, w) for k, _, p, w in rows]

        want = brute(placed(visits), placed(references), within)
        found = sorted((r.pid if within else 0, r.visit, r.reference, r.score, r.matched, r.new) for r in got)
        assert [x[:3] for x in found] == [x[:3] for x in want]
        for a, b in zip(found, want, strict=True):
            assert a[3:] == pytest.approx(b[3:], abs=1e-12)


def test_without_references_and_without_visits(spark):
    rows = spark.createDataFrame([(1, 0, "a", 2), (2, 0, "b", 1)], SCHEMA)
    none = rows.limit(0)
    assert sorted((r.visit, r.reference, r.score, r.new) for r in sim.best_references(rows, none).collect()) == [(1, None, 0.0, 1.0), (2, None, 0.0, 1.0)]
    assert sim.best_references(none, rows).collect() == []


def test_weights_count_tens_above_the_floor(spark):
    readings = spark.createDataFrame([(1, "a", -80), (1, "a", -71), (1, "b", -70), (1, "c", -81), (2, "a", -35)], "visit long, bssid string, rssi int")
    got = {(r.visit, r.bssid): r.weight for r in sim.signal_weights(readings).collect()}
    assert got == {(1, "a"): 1, (1, "b"): 2, (2, "a"): 5}


def test_only_rare_points_meet_for_high_scores(spark):
    """A high score is looked for among the rare access points of a set; the common one is not in the index."""
    entries = [(1, "rare", 5, 1), (1, "mid", 4, 5), (1, "hot", 1, 900)]
    sets = spark.createDataFrame([e[:3] for e in entries], "id long, point string, weight long")
    rarity = spark.createDataFrame([(p, n, 1) for _, p, _, n in entries], "point string, __seen long, __sides int")
    placed = sim._entries(sets, rarity, [])
    assert {r.point for r in sim._prefix(placed, 0.9).collect()} == {"rare"}
    assert {r.point for r in sim._prefix(placed, 0.7).collect()} == {"rare", "mid"}
    assert {r.point for r in sim._prefix(placed, 0.5).collect()} == {"rare", "mid", "hot"}


def meeting(spark, n):
    """Sets of a common access point and two others, all of them references of each other, in the form that the index takes."""
    draw = random.Random(n)
    rows = [(v, v % 2, p, draw.randrange(1, 4)) for v in range(n) for p in {"hot", f"p{draw.randrange(9)}", f"p{draw.randrange(9)}"}]
    return rows, spark.createDataFrame(rows, SCHEMA).groupBy("pid", F.col("visit").alias("id")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("bssid").alias("point"), "weight"))).alias("points"), F.sum("weight").alias("total")
    )


def test_sets_with_a_common_point_are_not_paired_within_a_place(spark):
    rows, sets = meeting(spark, 400)
    assert sim._few_points(sets, sets) >= 3
    met = sim._by_subsets(sets, sets, 0.5, ["pid"])
    # 40,000 pairs of a place share the point; a set of three points has seven subsets.
    assert met.count() <= 7 * 400
    frame = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.pid, r.visit, r.reference, round(r.score, 9)) for r in sim.best_references(frame, frame, within=["pid"]).collect())
    assert got == [(*r[:3], round(r[3], 9)) for r in brute(rows, rows, within=True)]


def test_sets_with_a_common_point_are_not_paired_across_places(spark):
    rows, sets = meeting(spark, 600)
    sets = sets.drop("pid")
    assert sim._by_subsets(sets, sets, 0.5, []).count() <= 7 * 600
    frame = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.visit, r.reference, round(r.score, 9)) for r in sim.best_references(frame, frame).collect())
    assert got == [(*r[1:3], round(r[3], 9)) for r in brute([(k, 0, *r) for k, _, *r in rows], [(k, 0, *r) for k, _, *r in rows])]


def test_only_points_of_references_go_on(spark, monkeypatch):
    """A place without references, and points that no reference of the place has, are not looked up; both ways of finding them give the best of all pairs."""
    draw = random.Random(77)
    visits = rows_of(draw, range(200), 60, 10, places=20) + [(v, v % 20, f"own{v}x{i}", 2) for v in range(200) for i in range(9)]
    references = [r for r in rows_of(draw, range(1000, 1040), 60, 10, places=20) if r[1] % 4 == 0]
    looked_up = []
    subsets, pairs = sim._by_subsets, sim._by_pairs

    def by_subsets(asked, known, score, names):
        looked_up.extend(asked.select("id", "pid", "points.point").collect())
        return subsets(asked, known, score, names)

    def by_pairs(asked, known, score, names):
        looked_up.extend(asked.groupBy("id", "pid").agg(F.collect_set("point").alias("point")).collect())
        return pairs(asked, known, score, names)

    monkeypatch.setattr(sim, "_by_subsets", by_subsets)
    monkeypatch.setattr(sim, "_by_pairs", by_pairs)
    left, right = (spark.createDataFrame(x, SCHEMA).repartition(4) for x in (visits, references))
    there = {(place, point) for _, place, point, _ in references}
    for limit in (200_000, 0):
        monkeypatch.setattr(sim, "KNOWN_POINTS", limit)
        looked_up.clear()
        got = sorted((r.pid, r.visit, r.reference) for r in sim.best_references(left, right, within=["pid"]).collect())
        assert got == [x[:3] for x in brute(visits, references, within=True)]
        assert looked_up and all((r.pid, p) in there for r in looked_up for p in r.point)
