import math
import random
import time

import pytest
from pyspark.sql import functions as F

from geoloom.functions import geometry as geo
from geoloom.functions import simplify, tilemath
from geoloom.functions.sql import register


def value(spark, text, **columns):
    row = [tuple(columns.values())]
    types = ", ".join(f"{k} {'string' if isinstance(v, (str, type(None))) else 'double'}" for k, v in columns.items())
    df = spark.createDataFrame(row, types) if columns else spark.range(1)
    return df.select(F.expr(text).alias("v")).first()["v"]


@pytest.mark.parametrize(
    "wkt, out",
    [
        ("POINT(1 2)", "POINT (1.0 2.0)"),
        (" linestring ( 0 0 , 1.5 -2e0 )", "LINESTRING (0.0 0.0, 1.5 -2.0)"),
        ("POLYGON ((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 2, 1 1))",
         "POLYGON ((0.0 0.0, 4.0 0.0, 4.0 4.0, 0.0 0.0), (1.0 1.0, 2.0 1.0, 2.0 2.0, 1.0 1.0))"),
        ("POLYGON ((0 0, 4 0, 4 4, 0 1))", None),
        ("POLYGON ((0 0, 4 0, 0 0))", None),
        ("LINESTRING (0 0)", None),
        ("LINESTRING (0 0, x 1)", None),
        ("POINT Z (1 2 3)", "POINT (1.0 2.0)"),
        ("LINESTRING ZM (1 2 3 4, 5 6 7 8)", "LINESTRING (1.0 2.0, 5.0 6.0)"),
        ("MULTIPOINT (1 2, 3 4)", "MULTIPOINT ((1.0 2.0), (3.0 4.0))"),
        ("MULTIPOINT ((1 2), (3 4))", "MULTIPOINT ((1.0 2.0), (3.0 4.0))"),
        ("multilinestring ((0 0, 1 1), (2 2, 3 3, 4 4))", "MULTILINESTRING ((0.0 0.0, 1.0 1.0), (2.0 2.0, 3.0 3.0, 4.0 4.0))"),
        ("MULTIPOLYGON (((0 0, 9 0, 9 9, 0 0), (3 1, 4 1, 4 2, 3 1)), ((20 0, 21 0, 21 1, 20 0)))",
         "MULTIPOLYGON (((0.0 0.0, 9.0 0.0, 9.0 9.0, 0.0 0.0), (3.0 1.0, 4.0 2.0, 4.0 1.0, 3.0 1.0)), ((20.0 0.0, 21.0 0.0, 21.0 1.0, 20.0 0.0)))"),
        ("MULTILINESTRING ((0 0), (2 2, 3 3))", None),
        ("POINT (1 2 3 4 5)", None),
        ("POLYGON EMPTY", None),
        ("GEOMETRYCOLLECTION (POINT (1 1))", None),
        ("POINT (nan 2)", None),
        ("BROKEN", None),
        ("", None),
        (None, None),
    ],
)
def test_wkt_round_trip(spark, wkt, out):
    assert value(spark, geo.let(geo.parse_wkt("w"), geo.to_wkt), w=wkt) == out


def test_null_rules_of_sql_functions(spark):
    register(spark)
    one = spark.sql(
        "SELECT geometry_area(NULL) a, geometry_length('') l, geometry_area('BROKEN') b, "
        "calculate_distance('POINT(0 0)', NULL) d, geometries_intersect('POINT(0 0)', 'x') i, "
        "simplify_geometry('BROKEN', 1D) s, simplify_geometry('', 1D) e, buffer_geometry('x', 1D) u, "
        "point_to_wkt(0D, 0D) p, point_to_wkt(NULL, 1D) q"
    ).first()
    assert tuple(one) == (None, None, None, None, False, "BROKEN", None, None, "POINT(0.0 0.0)", None)


def test_measures_with_hole(spark):
    w = "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))"
    assert value(spark, geo.wkt_area("w"), w=w) == pytest.approx(15)
    assert value(spark, geo.wkt_length("w"), w=w) == pytest.approx(20)
    assert value(spark, geo.wkt_length("w"), w="POINT (1 1)") == 0
    assert value(spark, geo.wkt_area("w"), w="LINESTRING (0 0, 3 4)") == 0
    assert value(spark, geo.wkt_length("w"), w="LINESTRING (0 0, 3 4)") == 5


SQUARE = "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))"
DONUT = "POLYGON ((0 0, 9 0, 9 9, 0 9, 0 0), (3 3, 6 3, 6 6, 3 6, 3 3))"
U_SHAPE = "POLYGON ((0 0, 6 0, 6 6, 4 6, 4 2, 2 2, 2 6, 0 6, 0 0))"


@pytest.mark.parametrize(
    "a, b, intersects, within",
    [
        ("POINT (1 1)", SQUARE, True, True),
        ("POINT (0 1)", SQUARE, True, False),
        ("POINT (5 5)", SQUARE, False, False),
        ("POINT (4 4)", DONUT, False, False),
        ("POINT (3 4)", DONUT, True, False),
        ("POINT (1 1)", "POINT (1 1)", True, True),
        ("POINT (1 1)", "LINESTRING (0 0, 2 2)", True, True),
        ("POINT (0 0)", "LINESTRING (0 0, 2 2)", True, False),
        ("LINESTRING (1 1, 3 3)", SQUARE, True, True),
        ("LINESTRING (0 0, 4 0)", SQUARE, True, False),
        ("LINESTRING (-1 2, 5 2)", SQUARE, True, False),
        ("LINESTRING (1 5, 5 5)", U_SHAPE, True, False),
        ("LINESTRING (0.5 5, 0.5 1)", U_SHAPE, True, True),
        ("LINESTRING (0 0, 1 1)", "LINESTRING (0 1, 1 0)", True, False),
        ("LINESTRING (0 0, 1 1)", "LINESTRING (0 0, 2 2)", True, True),
        ("LINESTRING (0 0, 1 0)", "LINESTRING (0 1, 1 1)", False, False),
        (SQUARE, DONUT, True, False),
        ("POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))", DONUT, True, True),
        ("POLYGON ((2 2, 7 2, 7 7, 2 7, 2 2))", DONUT, True, False),
        ("POLYGON ((4 4, 5 4, 5 5, 4 5, 4 4))", DONUT, False, False),
        ("POLYGON ((4 0, 8 0, 8 4, 4 4, 4 0))", SQUARE, True, False),
        (SQUARE, SQUARE, True, True),
        (SQUARE, "LINESTRING (0 0, 9 9)", True, False),
    ],
)
def test_predicates(spark, a, b, intersects, within):
    assert value(spark, geo.wkt_intersects("a", "b"), a=a, b=b) is intersects
    assert value(spark, geo.wkt_intersects("b", "a"), a=a, b=b) is intersects
    assert value(spark, geo.wkt_within("a", "b"), a=a, b=b) is within
    assert value(spark, geo.wkt_contains("b", "a"), a=a, b=b) is within


@pytest.mark.parametrize(
    "a, b, d",
    [
        ("POINT (0 0)", "POINT (3 4)", 5),
        ("POINT (5 2)", SQUARE, 1),
        ("POINT (4 4)", DONUT, 1),
        ("LINESTRING (0 5, 4 5)", SQUARE, 1),
        ("LINESTRING (6 0, 6 9)", "LINESTRING (0 4, 3 4)", 3),
        ("POINT (0 0)", "LINESTRING (1 1, 1 1)", math.sqrt(2)),
        ("POLYGON ((7 8, 9 8, 9 9, 7 9, 7 8))", SQUARE, 5),
    ],
)
def test_distance(spark, a, b, d):
    assert value(spark, geo.wkt_distance("a", "b"), a=a, b=b) == pytest.approx(d)
    assert value(spark, geo.wkt_distance("b", "a"), a=a, b=b) == pytest.approx(d)


@pytest.mark.parametrize(
    "wkt, ok",
    [
        (SQUARE, True),
        (DONUT, True),
        ("POLYGON ((0 0, 4 4, 4 0, 0 4, 0 0))", False),
        ("POLYGON ((0 0, 4 0, 8 0, 0 0))", False),
        ("POLYGON ((0 0, 4 0, 4 0, 4 4, 0 0))", True),
        ("LINESTRING (1 1, 1 1)", False),
        ("LINESTRING (1 1, 1 2, 1 1)", True),
        ("POINT (1 1)", True),
        ("BROKEN", False),
        (None, False),
    ],
)
def test_is_valid(spark, wkt, ok):
    assert value(spark, geo.wkt_is_valid("w"), w=wkt) is ok


BIG = "(0 0, 10 0, 10 10, 0 10, 0 0)"


@pytest.mark.parametrize(
    "wkt, ok",
    [
        (f"POLYGON ({BIG}, (2 2, 2 4, 4 4, 4 2, 2 2), (6 6, 6 8, 8 8, 8 6, 6 6))", True),
        (f"POLYGON ({BIG}, (12 2, 12 4, 14 4, 14 2, 12 2))", False),  # outside
        (f"POLYGON ({BIG}, (8 2, 8 4, 12 4, 12 2, 8 2))", False),  # crosses
        (f"POLYGON ({BIG}, (-1 -1, -1 11, 11 11, 11 -1, -1 -1))", False),  # around the shell
        (f"POLYGON ({BIG}, {BIG})", False),
        (f"POLYGON ({BIG}, (0 4, 2 6, 2 2, 0 4))", True),  # touches once
        (f"POLYGON ({BIG}, (10 10, 7 9, 9 7, 10 10))", True),  # touches once, in a corner
        (f"POLYGON ({BIG}, (0 4, 5 6, 10 4, 5 2, 0 4))", False),  # cuts the inside in two
        (f"POLYGON ({BIG}, (0 2, 0 4, 2 4, 2 2, 0 2))", False),  # shares a part of an edge
        (f"POLYGON ({BIG}, (2 2, 2 8, 8 8, 8 2, 2 2), (4 4, 4 5, 5 5, 5 4, 4 4))", False),  # nested
        (f"POLYGON ({BIG}, (2 2, 2 4, 4 4, 4 2, 2 2), (4 4, 4 6, 6 6, 6 4, 4 4))", True),  # holes touch once
        (f"POLYGON ({BIG}, (2 2, 2 4, 4 4, 4 2, 2 2), (3 3, 3 6, 6 6, 6 3, 3 3))", False),
        (f"MULTIPOLYGON (({BIG}), ((20 0, 30 0, 30 10, 20 10, 20 0)))", True),
        (f"MULTIPOLYGON (({BIG}), ((5 5, 15 5, 15 15, 5 15, 5 5)))", False),
        (f"MULTIPOLYGON (({BIG}), ((2 2, 4 2, 4 4, 2 4, 2 2)))", False),
        (f"MULTIPOLYGON (({BIG}, (2 2, 2 8, 8 8, 8 2, 2 2)), ((4 4, 5 4, 5 5, 4 5, 4 4)))", True),  # island
        (f"MULTIPOLYGON (({BIG}, (2 2, 2 8, 8 8, 8 2, 2 2)), ((2 5, 5 2, 8 5, 5 8, 2 5)))", True),  # island, touches
        (f"MULTIPOLYGON (({BIG}), ((10 10, 20 10, 20 20, 10 20, 10 10)))", True),  # corner to corner
        (f"MULTIPOLYGON (({BIG}), ((10 0, 20 0, 20 10, 10 10, 10 0)))", False),  # a common edge
        (f"MULTIPOLYGON (({BIG}), ((0 5, 5 0, 10 5, 5 10, 0 5)))", False),  # inscribed
    ],
)
def test_is_valid_across_rings(spark, wkt, ok):
    assert value(spark, geo.wkt_is_valid("w"), w=wkt) is ok


def test_large_rings_are_checked_in_strips(spark):
    """A circle of 4,000 vertices is valid; swapping two far vertices makes it cross itself."""
    circle = [(math.cos(2 * math.pi * i / 4000), math.sin(2 * math.pi * i / 4000)) for i in range(4000)]
    crossed = list(circle)
    crossed[700], crossed[2900] = crossed[2900], crossed[700]
    ring = lambda pts: "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in [*pts, pts[0]]) + "))"
    start = time.time()
    assert value(spark, geo.wkt_is_valid("w"), w=ring(circle)) is True
    assert value(spark, geo.wkt_is_valid("w"), w=ring(crossed)) is False
    assert time.time() - start < 30


def test_validity_equals_comparing_all_pairs(spark):
    """Random rings: strips find a crossing exactly when some pair of edges crosses."""
    rng = random.Random(9)
    rows, want = [], {}
    for i in range(300):
        n = rng.choice((4, 6, 20, 40))
        angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
        pts = [(round(rng.uniform(3, 9) * math.cos(a), 3), round(rng.uniform(3, 9) * math.sin(a), 3)) for a in angles]
        if i % 2:
            a, b = rng.sample(range(n), 2)
            pts[a], pts[b] = pts[b], pts[a]
        if len(set(pts)) < n:
            continue
        edge = list(zip(pts, pts[1:] + pts[:1]))
        turn = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
        cross = any(
            turn(*edge[j], edge[k][0]) * turn(*edge[j], edge[k][1]) < 0 and turn(*edge[k], edge[j][0]) * turn(*edge[k], edge[j][1]) < 0
            for j in range(n) for k in range(j + 2, n) if (j, k) != (0, n - 1)
        )
        want[i] = not cross
        rows.append((i, "POLYGON ((" + ", ".join(f"{x} {y}" for x, y in [*pts, pts[0]]) + "))"))
    df = spark.createDataFrame(rows, "i int, w string")
    got = {r["i"]: r["v"] for r in df.select("i", F.expr(geo.wkt_is_valid("w")).alias("v")).collect()}
    assert got == want and 20 < sum(want.values()) < len(want) - 20


def _douglas_peucker(points, tol):
    (x0, y0), (x1, y1) = points[0], points[-1]
    best, at = -1.0, 0
    n2 = (x1 - x0) ** 2 + (y1 - y0) ** 2
    for i, (x, y) in enumerate(points[1:-1], 1):
        t = max(0, min(1, ((x - x0) * (x1 - x0) + (y - y0) * (y1 - y0)) / n2)) if n2 else 0
        d = math.hypot(x - x0 - t * (x1 - x0), y - y0 - t * (y1 - y0))
        if d > best:
            best, at = d, i
    if best <= tol:
        return [points[0], points[-1]]
    return _douglas_peucker(points[: at + 1], tol)[:-1] + _douglas_peucker(points[at:], tol)


def test_simplify_matches_recursive_definition(spark):
    rng = random.Random(7)
    lines = [[(rng.randint(0, 1000) / 10, rng.randint(0, 1000) / 10) for _ in range(rng.randint(3, 40))] for _ in range(40)]
    wkt = lambda pts: "LINESTRING (" + ", ".join(f"{x} {y}" for x, y in pts) + ")"
    open_lines = [p for p in lines if p[0] != p[-1]]
    for tol in (0.0, 5.0, 30.0):
        df = spark.createDataFrame([(i, wkt(p), tol) for i, p in enumerate(open_lines)], "i int, w string, t double")
        df = df.withColumn("g", F.expr(geo.parse_wkt("w")))
        df = simplify.with_weights(df, "g", "k").withColumn("s", F.expr(geo.let(simplify.simplified("g", "k", "t"), geo.to_wkt)))
        register(spark)
        df = simplify.simplify_text(df.withColumn("u", F.expr("simplify_geometry(w, t)")), "w", "t", "x")
        for row in df.collect():
            want = wkt(_douglas_peucker(open_lines[row["i"]], tol))
            assert row["s"] == want
            assert row["u"] == row["x"] == want


def test_simplify_keeps_rings(spark):
    w = "POLYGON ((0 0, 10 0, 10 10, 5 10.01, 0 10, 0 0))"
    df = spark.createDataFrame([(w,)], "w string").withColumn("g", F.expr(geo.parse_wkt("w")))
    df = simplify.with_weights(df, "g", "k")
    kept = lambda t: df.select(F.expr(f"size(({simplify.simplified('g', 'k', t)}).parts[0])").alias("n")).first()["n"]
    assert kept("0D") == 6 and kept("1D") == 5 and kept("100D") == 4


def test_simplify_function_equals_the_weighing_pass(spark):
    """On lines, rings, holes, multi-part shapes, Z and equal distances, with an argument made by a lambda."""
    rng = random.Random(11)

    def ring(n, x):
        pts = [(x + rng.randint(0, 12), rng.randint(0, 12)) for _ in range(n)]
        return [*pts, pts[0]]

    text = lambda pts, z="": "(" + ", ".join(f"{x} {y}{z}" for x, y in pts) + ")"
    shapes = [f"LINESTRING {text(ring(rng.randint(1, 30), 0)[: rng.randint(2, 40)])}" for _ in range(60)]
    shapes += [f"LINESTRING Z {text(ring(9, 0), ' 7')}", "POINT (1 2)", "BROKEN", "LINESTRING EMPTY", "MULTIPOINT ((1 2), (3 4))"]
    shapes += [f"POLYGON ({text(ring(rng.randint(3, 25), 0))}, {text(ring(4, 50))})" for _ in range(40)]
    shapes += [f"MULTILINESTRING ({text(ring(8, 0))}, {text(ring(7, 5)[:5])})" for _ in range(10)]
    shapes += [f"MULTIPOLYGON (({text(ring(8, 0))}), ({text(ring(9, 50))}, {text(ring(5, 90))}))" for _ in range(10)]
    shapes += ["LINESTRING (0 0, 1 1, 2 0, 3 1, 4 0)", "POLYGON ((0 0, 0 1, 1 1, 1 0, 0 0))", "LINESTRING (86.245 5.125, 86.24 5.13, 86.233 5.141)"]
    register(spark)
    df = spark.createDataFrame([(i, w, t) for i, w in enumerate(shapes) for t in (-1.0, 0.0, 1.5, 4.0, float("nan"), None)], "i int, w string, t double")
    df = df.withColumn("w", F.expr(geo.let("concat(w, '')", lambda v: f"trim({v})")))
    df = simplify.simplify_text(df.withColumn("s", F.expr("simplify_geometry(w, t)")), "w", "t", "x")
    rows = df.collect()
    assert len(rows) == 6 * len(shapes)
    assert [r for r in rows if r["s"] != r["x"]] == []
    assert any(r["s"] != r["w"] for r in rows if r["t"] == 4.0)


def test_tile_round_trip(spark):
    """The tile of a tile's centre is the tile itself."""
    df = spark.range(0, 400).selectExpr("cast(id % 20 as int) z", "id").selectExpr(
        "z", "cast((id * 7919) % cast(pow(2, z) as bigint) as int) x", "cast((id * 104729) % cast(pow(2, z) as bigint) as int) y"
    )
    df = df.withColumn("b", F.expr(tilemath.tile_box("z", "x", "y")))
    back = df.select(
        "x", "y",
        F.expr(tilemath.tile_x("(b.x0 + b.x1) / 2", "z")).alias("bx"),
        F.expr(tilemath.tile_y("(b.y0 + b.y1) / 2", "z")).alias("by"),
    )
    assert back.filter("x <> bx").isEmpty()
    # The middle latitude is not the middle of a tile near the poles of very low zooms only.
    assert back.filter("abs(y - by) > 0").isEmpty()


def test_tile_address_is_clamped(spark):
    df = spark.sql("SELECT 180D lon, 89.9D lat UNION ALL SELECT -180D, -89.9D")
    rows = df.select(F.expr(tilemath.tile_x("lon", "3")), F.expr(tilemath.tile_y("lat", "3"))).collect()
    assert [tuple(r) for r in rows] == [(7, 0), (0, 7)]


def test_reproject_rejects_other_systems():
    with pytest.raises(ValueError):
        tilemath.reproject("g", 4326, 32633)


def test_morton_orders_quadrants(spark):
    df = spark.sql("SELECT explode(array((0, 0), (1, 0), (0, 1), (1, 1), (2, 0))) AS t")
    keys = [r[0] for r in df.select(F.expr(tilemath.morton("t.col1", "t.col2", 3))).collect()]
    assert keys == [0, 1, 2, 3, 4]


DONUTS = "MULTIPOLYGON (((0 0, 10 0, 10 10, 0 10, 0 0), (2 2, 2 4, 4 4, 4 2, 2 2)), ((20 0, 20 5, 25 5, 25 0, 20 0)))"


def test_multi_part_measures_and_predicates(spark):
    assert value(spark, geo.wkt_area("w"), w=DONUTS) == pytest.approx(100 - 4 + 25)
    assert value(spark, geo.wkt_length("w"), w="MULTILINESTRING ((0 0, 3 4), (0 0, 0 2))") == pytest.approx(7)
    assert value(spark, geo.wkt_is_valid("w"), w=DONUTS)
    tests = [
        ("POINT (22 1)", True, True), ("POINT (3 3)", False, False), ("POINT (15 1)", False, False),
        ("MULTIPOINT ((1 1), (22 1))", True, True), ("MULTIPOINT ((1 1), (15 1))", True, False),
        ("LINESTRING (5 1, 22 1)", True, False), ("POLYGON ((21 1, 22 1, 22 2, 21 2, 21 1))", True, True),
        ("MULTIPOLYGON (((100 100, 101 100, 101 101, 100 100)), ((-5 -5, 30 -5, 30 30, -5 30, -5 -5)))", True, False),
    ]
    for wkt, meets, inside in tests:
        assert value(spark, geo.wkt_intersects("w", "v"), w=wkt, v=DONUTS) is meets, wkt
        assert value(spark, geo.wkt_intersects("v", "w"), w=wkt, v=DONUTS) is meets, wkt
        assert value(spark, geo.wkt_within("w", "v"), w=wkt, v=DONUTS) is inside, wkt
    assert value(spark, geo.wkt_distance("w", "v"), w="MULTIPOINT ((15 1), (40 1))", v=DONUTS) == pytest.approx(5)


@pytest.mark.parametrize("predicate", ["intersects", "within", "contains", "distance"])
def test_edges_at_hand_and_far_edges(spark, predicate):
    """Shapes without an edge near the other are decided by a vertex; boxes that reach everything hide no edge."""
    ring = lambda x, y, n: f"({x} {y}, {x + n} {y}, {x + n} {y + n}, {x} {y + n}, {x} {y})"
    texts = [f"POLYGON ({ring(0, 0, 20)}, {ring(5, 5, 6)})", DONUTS, "POINT (2 2)", "POINT (7 7)", "POINT (20 3)", "POINT (40 40)"]
    texts += ["POLYGON ((0 0, 20 0, 10 20, 0 0))", f"POLYGON ({ring(1, 1, 2)})", f"POLYGON ({ring(6, 6, 2)})", f"POLYGON ({ring(-9, -9, 60)})"]
    texts += ["LINESTRING (2 2, 3 3)", "LINESTRING (6 6, 8 7)", "LINESTRING (0 0, 20 0)", "MULTIPOINT ((2 2), (7 7))", "MULTIPOINT ((2 2), (3 3))"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", F.expr(geo.parse_wkt("t")).alias("g"))
    df = df.withColumns({"e": F.expr(f"CASE WHEN g.kind <> 'POINT' THEN {geo.edges('g')} END"), "b": F.expr(geo.bbox("g"))})
    wide = "named_struct('x0', -999D, 'y0', -999D, 'x1', 999D, 'y1', 999D)"
    test = getattr(geo, predicate)
    # ``within`` rules out by boxes, so only those of the container may be wider there.
    boxes = {"within": ("a.b", wide), "contains": (wide, "b.b")}.get(predicate, (wide, wide))
    rows = df.alias("a").crossJoin(df.alias("b")).selectExpr(
        "a.i", "b.i as j", f"{test('a.g', 'b.g')} as found", f"{test('a.g', 'b.g', 'a.b', 'b.b', 'a.e', 'b.e')} as given",
        f"{test('a.g', 'b.g', *boxes)} as whole",
    ).collect()
    for r in rows:
        want = pytest.approx(r.whole, abs=1e-12) if predicate == "distance" else r.whole
        assert r.found == want and r.given == want, (texts[r.i], texts[r.j])
    at = {(r.i, r.j): r.found for r in rows}
    if predicate == "intersects":  # a point in a hole, on a shell, a box in a hole
        assert [at[k] for k in ((2, 0), (3, 0), (4, 0), (7, 0), (8, 0), (0, 9), (11, 0))] == [True, False, True, True, False, True, False]
    if predicate == "within":
        assert [at[k] for k in ((2, 0), (3, 0), (4, 0), (7, 0), (8, 0), (0, 9), (12, 0))] == [True, False, False, True, False, True, False]


def test_plain_texts_read_like_others(spark):
    """Texts split by single characters give what the same texts give with tabs for blanks, NULL included."""
    shapes = ["POINT (1 2)", "POINT(1 2)", "POINT (1 2 3)", "POINT (1 2 3 4)", "POINT (1 2 3 4 5)", "POINT (1)", "POINT ()", "POINT (1 2, 3 4)", "POINT (-0 +5)"]
    shapes += ["POINT (1e2 -.5E-1)", "POINT (1e999 2)", "POINT (e 2)", "POINT (1-2 2)", "POINT ( 1 2 )", "POINT (1 2 )", "POINT (1,2 3)", "POINT (5. 007)"]
    shapes += ["LINESTRING (0 0, 1 1)", "LINESTRING (0 0,1 1)", "LINESTRING (0 0 , 1 1)", "LINESTRING (0  0, 1 1)", "LINESTRING (0 0,  1 1)"]
    shapes += ["LINESTRING (0 0, 1 1,)", "LINESTRING (, 0 0, 1 1)", "LINESTRING (0 0)", "LINESTRING ((0 0, 1 1))", "LINESTRING (0 0, 1 1) "]
    shapes += ["POLYGON ((0 0, 4 0, 4 4, 0 0))", "POLYGON (( 0 0,4 0, 4 4,0 0 ))", "POLYGON ((0 0, 4 0, 4 4, 0 1))", "POLYGON ((0 0, 4 0, 0 0))", "POLYGON (0 0, 4 0, 4 4, 0 0)"]
    shapes += ["POLYGON ((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 2, 1 1))", "POLYGON((0 0, 9 0, 9 9, 0 0),(1 1, 2 1, 2 2, 1 1))", "POLYGON ((0 0, 4 0, 4 4, 0 0)", "point (1 2)", "POINT Z (1 2 3)"]
    rows = [(i, t, t.replace(" ", "\t").replace("(\t", "( ").replace("\t)", " )")) for i, t in enumerate(shapes)]
    df = spark.createDataFrame(rows, "i int, t string, u string")
    got = df.select("t", F.expr(geo.parse_wkt("t")).alias("g"), F.expr(geo.parse_wkt("u")).alias("h")).collect()
    read = {r["t"]: r["g"] for r in got}
    for r in got:
        assert str(r["g"]) == str(r["h"]), r["t"]  # as text, so that -0.0 is not 0.0
    unreadable = {t for t, g in read.items() if g is None}
    assert unreadable == {
        "POINT (1 2 3 4 5)", "POINT (1)", "POINT ()", "POINT (1 2, 3 4)", "POINT (1e999 2)", "POINT (e 2)", "POINT (1-2 2)", "POINT (1,2 3)",
        "LINESTRING (0 0, 1 1,)", "LINESTRING (, 0 0, 1 1)", "LINESTRING (0 0)", "LINESTRING ((0 0, 1 1))", "POLYGON ((0 0, 4 0, 4 4, 0 1))",
        "POLYGON ((0 0, 4 0, 0 0))", "POLYGON (0 0, 4 0, 4 4, 0 0)", "POLYGON ((0 0, 4 0, 4 4, 0 0)",
    }
    assert [(p.x, p.y) for p in read["LINESTRING (0  0, 1 1)"].parts[0]] == [(0, 0), (1, 1)]
