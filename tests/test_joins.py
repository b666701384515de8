import math
import random

import pytest
from pyspark.sql import functions as F

from geoloom.functions import geometry as geo
from geoloom.operators import changes, joins


def shapes(spark, n, seed, prefix, spread=60.0):
    """Points, lines and boxes from tiny to huge."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x, y = rng.uniform(-spread, spread), rng.uniform(-spread, spread)
        size = 10 ** rng.uniform(-5, 1.7)
        kind = rng.randrange(3)
        if kind == 0:
            wkt = f"POINT ({x} {y})"
        elif kind == 1:
            wkt = f"LINESTRING ({x} {y}, {x + size} {y + size / 2}, {x + size / 3} {y + size})"
        else:
            wkt = f"POLYGON (({x} {y}, {x + size} {y}, {x + size} {y + size}, {x} {y + size}, {x} {y}))"
        rows.append((i, wkt))
    rows.append((n, None))
    rows.append((n + 1, "BROKEN"))
    return spark.createDataFrame(rows, f"{prefix}_id int, geometry_wkt string")


def brute(left, right, predicate):
    l = left.withColumn("_a", F.expr(geo.parse_wkt("geometry_wkt"))).drop("geometry_wkt")  # noqa: E741
    r = right.withColumn("_b", F.expr(geo.parse_wkt("geometry_wkt"))).drop("geometry_wkt")
    return {tuple(x) for x in l.join(r, F.expr(predicate("_a", "_b"))).drop("_a", "_b").collect()}


@pytest.fixture(scope="module")
def sides(spark):
    return shapes(spark, 150, 1, "l"), shapes(spark, 120, 2, "r")


@pytest.mark.parametrize("kind", ["intersects", "within", "contains"])
@pytest.mark.parametrize("options", [{}, {"salts": 3}, {"broadcast_right": True}])
def test_grid_join_equals_brute_force(spark, sides, kind, options):
    left, right = sides
    pairs = joins.spatial_join(left, right, join_type=kind, **options).select("l_id", "r_id").collect()
    want = brute(left, right, joins.PREDICATES[kind])
    assert len(pairs) == len({tuple(p) for p in pairs})
    assert {tuple(p) for p in pairs} == want
    assert kind != "intersects" or len(want) > 50


def test_swapped_sides_give_the_same_pairs(spark, sides):
    left, right = sides
    a = {tuple(p) for p in joins.spatial_join(left, right).select("l_id", "r_id").collect()}
    b = {tuple(p) for p in joins.spatial_join(right.repartition(3), left).select("l_id", "r_id").collect()}
    assert a == b


def test_distance_join_equals_brute_force(spark, sides):
    left, right = sides
    pairs = joins.distance_join(left, right, 3.0).select("l_id", "r_id").collect()
    assert {tuple(p) for p in pairs} == brute(left, right, lambda a, b: f"{geo.distance(a, b)} <= 3D")
    assert len(pairs) == len({tuple(p) for p in pairs})


def test_one_place_holding_a_third_of_the_points(spark):
    hot = spark.range(3000).selectExpr(
        "id as l_id", "concat('POINT (', if(id % 3 = 0, 10.5, (id * 37 % 3000) / 100D), ' ', if(id % 3 = 0, 10.5, (id * 91 % 3000) / 100D), ')') as geometry_wkt")
    boxes = spark.range(9).selectExpr("id as r_id", "(id % 3) * 10D as x", "(id div 3) * 10D as y").selectExpr(
        "r_id", f"{geo.let(geo.box('x', 'y', 'x + 9D', 'y + 9D'), geo.to_wkt)} as geometry_wkt")
    for options in ({}, {"salts": 8}):
        got = joins.spatial_join(hot, boxes, join_type="within", **options).groupBy("r_id").count().collect()
        got = {r["r_id"]: r["count"] for r in got}
        want = brute(hot, boxes, geo.within)
        assert got == {b: sum(1 for p in want if p[1] == b) for b in {p[1] for p in want}}
        assert got[4] >= 1000


def test_no_cross_product_in_the_plan(spark, sides):
    left, right = sides
    plan = joins.spatial_join(left, right)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_unknown_join_type_and_column_names(spark, sides):
    left, right = sides
    with pytest.raises(ValueError):
        joins.spatial_join(left, right, join_type="touches")
    assert joins.spatial_join(left, right).columns == ["l_id", "geometry_wkt", "r_id", "geometry_wkt_right"]


def test_broadcast_needs_a_small_side(spark):
    df = spark.range(100).selectExpr("id", "'POINT (0 0)' as geometry_wkt")
    assert joins.small_enough(df, rows=100)
    assert not joins.small_enough(df, rows=99)
    assert not joins.small_enough(df, size=10)


def test_what_is_broadcast_is_measured(spark, monkeypatch):
    """A right side that is small as it comes and large as it is filed under its cells is shuffled."""
    left = spark.createDataFrame([(1, "POLYGON ((0 0, 100 0, 100 60, 0 60, 0 0))"), (2, "POINT (1 1)")], "a int, geometry_wkt string")
    right = spark.range(40).selectExpr("id as b", "concat('POINT (', id, ' ', id, ')') as geometry_wkt")
    monkeypatch.setattr(joins.small_enough, "__defaults__", (45, joins.BROADCAST_BYTES))
    assert joins.small_enough(right)
    plan = joins.spatial_join(left, right, broadcast_right=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan


def test_conflate_takes_the_nearest_name(spark):
    a = spark.createDataFrame([(1, "Cafe Rio", "POINT (0 0)"), (2, "Bank", "POINT (5 5)")], "osm_id int, name string, geometry_wkt string")
    b = spark.createDataFrame([(7, "Café Rio", "POINT (0 0.001)"), (8, "Cafe Rino", "POINT (0.001 0)"), (9, "Cafe Rio", "POINT (1 1)"), (10, "Bar", "POINT (5 5)")],
                              "osm_id int, name string, geometry_wkt string")
    assert [tuple(r) for r in changes.conflate(a, b, 0.01, 1).collect()] == [(1, 7, 1)]


def test_conflate_matches_copies_once(spark):
    a = spark.range(500).selectExpr("id as osm_id", "'Kiosk' as name", "'POINT (1 1)' as geometry_wkt")
    b = spark.range(700).selectExpr("id + 1000 as osm_id", "'Kiosk' as name", "'POINT (1 1)' as geometry_wkt")
    got = changes.conflate(a, b, 0.1, 0)
    assert got.count() == 500 and {r["match_id"] for r in got.collect()} == {1000}


def test_conflation_equals_greedy_matching(spark):
    """Crowded places of few names, so that most want a partner somebody else wants too."""
    rng = random.Random(19)
    place = lambda i: (i, rng.choice(["Cafe Rio", "Cafe Rion", "Cafe Riox", "Bar"]), rng.randint(0, 30) / 1024, rng.randint(0, 30) / 1024)
    lefts, rights = [place(i) for i in range(60)], [place(100 + i) for i in range(50)]
    lefts.append((60, *lefts[0][1:]))  # a copy shares the match
    frame = lambda rows: spark.createDataFrame([(i, n, f"POINT ({x} {y})") for i, n, x, y in rows], "osm_id int, name string, geometry_wkt string")
    edits = lambda a, b: next(k for k in range(9) if k >= abs(len(a) - len(b)) and sum(p != q for p, q in zip(a, b)) + abs(len(a) - len(b)) <= k)
    groups = lambda rows: {(n, x, y): min(i for i, *k in rows if tuple(k) == (n, x, y)) for _, n, x, y in rows}
    pairs = []
    for (n, x, y), i in groups(lefts).items():
        for (m, u, v), j in groups(rights).items():
            d, away = edits(n, m), round(math.hypot(x - u, y - v), 12)
            if away <= 10 / 1024 and d <= 1:
                pairs.append((d, away, i, j))
    used, want = set(), {}
    for d, _, i, j in sorted(pairs):
        if not {("l", i), ("r", j)} & used:
            used |= {("l", i), ("r", j)}
            want[i] = (j, d)
    got = {r.osm_id: (r.match_id, r.name_distance) for r in changes.conflate(frame(lefts), frame(rights), 10 / 1024, 1).collect()}
    same = {i: groups(lefts)[tuple(k)] for i, *k in lefts}
    assert got == {i: want[g] for i, g in same.items() if g in want}
    assert len({j for j, _ in want.values()}) == len(want) > 15


@pytest.mark.parametrize("kind", ["intersects", "within", "contains", "distance"])
def test_filed_sides_are_not_broadcast(spark, kind):
    """Rows filed under cells look few to the optimizer; only a right side measured as small is broadcast."""
    left = spark.range(300).selectExpr("id as l_id", "concat('POINT (', id % 17, ' ', id % 13, ')') as geometry_wkt")
    box = "concat('POLYGON ((', x, ' 0, ', x + 5, ' 0, ', x + 5, ' 9, ', x, ' 9, ', x, ' 0))')"
    right = spark.range(40).selectExpr("id as r_id", "id % 11 as x").selectExpr("r_id", f"{box} as geometry_wkt")
    if kind == "contains":
        left, right = right, left
    joined = lambda **more: (
        joins.distance_join(left, right, 0.5, **more) if kind == "distance" else joins.spatial_join(left, right, join_type=kind, **more)
    )
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan(joined()) and "SortMergeJoin" in plan(joined())
    assert "BroadcastHashJoin" in plan(joined(broadcast_right=True))
    want = sorted(joined(broadcast_right=True).select("l_id", "r_id").collect())
    assert want and sorted(joined().select("l_id", "r_id").collect()) == want
