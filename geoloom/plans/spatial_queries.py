"""Geometry functions and spatial joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoloom.functions import geometry as geo
from geoloom.functions import simplify, tilemath
from geoloom.functions.sql import register
from geoloom.operators import changes, joins, layers
from geoloom.plans import fixtures as fx
from geoloom.plans.layer_queries import AREA_M2, WEIGHTS, way_lengths
from geoloom.plans.registry import CHECKS, query

_IDS = ["l_orderkey", "l_linenumber"]


def _pairs(spark, sf_dir):
    """A point p and boxes a, b per line item, as WKT text and as geometry."""
    df = fx.frame(spark, sf_dir, "fx_pairs")
    return df.selectExpr(
        "*",
        f"{geo.point('px', 'py')} as p",
        f"{geo.box('ax0', 'ay0', 'ax1', 'ay1')} as a",
        f"{geo.box('bx0', 'by0', 'bx1', 'by1')} as b",
    )


@query("f0_parse_wkt", fx.sql(
    f"with lengths as ({way_lengths()}) select id, wkt, n_points, false as broken from lengths union all "
    "select -1 - id, null, null, true from fx_ways where id % 5 = 0", "fx_ways", "fx_vertices"))
def parse_wkt(spark, sf_dir):
    """Text to geometry and back; truncated texts give NULL."""
    ways = fx.ways(spark, sf_dir).select("id", "geometry")
    cut = ways.filter("id % 5 = 0").selectExpr("-1 - id as id", "left(geometry, length(geometry) - 1) as geometry")
    df = ways.unionByName(cut).withColumn("g", F.expr(geo.parse_wkt("geometry")))
    return df.select(
        "id", F.expr(geo.to_wkt("g")).alias("wkt"),
        F.expr("cast(size(g.parts[0]) as bigint)").alias("n_points"), F.col("g").isNull().alias("broken"),
    ).withColumn("n_points", F.when(~F.col("broken"), F.col("n_points")))


@query("f1_point_to_wkt", fx.sql(
    "select id, case when id % 9 <> 0 then concat('POINT(', lon, ' ', case when id % 8 = 0 then 0.0::double else lat end, ')') end as wkt from fx_pois", "fx_pois"))
def point_to_wkt(spark, sf_dir):
    """Missing coordinates give NULL, zero does not."""
    register(spark)
    df = fx.frame(spark, sf_dir, "fx_pois").selectExpr(
        "id", "if(id % 9 = 0, null, lon) as lon", "if(id % 8 = 0, 0D, lat) as lat"
    )
    return df.select("id", F.expr("point_to_wkt(lon, lat)").alias("wkt"))


_DX, _DY = "greatest(ax0 - px, 0, px - ax1)", "greatest(ay0 - py, 0, py - ay1)"
_BDX, _BDY = "greatest(ax0 - bx1, 0, bx0 - ax1)", "greatest(ay0 - by1, 0, by0 - ay1)"


@query("f2_calculate_distance", fx.sql(
    "select l_orderkey, l_linenumber, round(sqrt(pow(px - ax0, 2) + pow(py - ay0, 2)), 6) as point_point, "
    f"round(sqrt(pow({_DX}, 2) + pow({_DY}, 2)), 6) as point_box, round(sqrt(pow({_BDX}, 2) + pow({_BDY}, 2)), 6) as box_box from fx_pairs", "fx_pairs"))
def calculate_distance(spark, sf_dir):
    df = _pairs(spark, sf_dir).withColumn("q", F.expr(geo.point("ax0", "ay0")))
    d = lambda x, y: F.round(F.expr(geo.distance(x, y)), 6)
    register(spark)
    text = df.select(*_IDS, *[F.expr(geo.to_wkt(g)).alias(g) for g in ("p", "q", "a", "b")])
    d = lambda x, y: F.round(F.expr(f"calculate_distance({x}, {y})"), 6)
    return text.select(*_IDS, d("p", "q").alias("point_point"), d("p", "a").alias("point_box"), d("a", "b").alias("box_box"))


_BOX_HIT = "(ax0 <= bx1 and bx0 <= ax1 and ay0 <= by1 and by0 <= ay1)"
_PT_HIT = "(px between ax0 and ax1 and py between ay0 and ay1)"


@query("f3_geometries_intersect", fx.sql(
    f"select l_orderkey, l_linenumber, {_PT_HIT} as point_box, {_BOX_HIT} as box_box from fx_pairs", "fx_pairs"))
def geometries_intersect(spark, sf_dir):
    df = _pairs(spark, sf_dir)
    register(spark)
    text = df.select(*_IDS, *[F.expr(geo.to_wkt(g)).alias(g) for g in ("p", "a", "b")])
    return text.select(
        *_IDS, F.expr("geometries_intersect(p, a)").alias("point_box"), F.expr("geometries_intersect(a, b)").alias("box_box")
    )


_IN = "(px > ax0 and px < ax1 and py > ay0 and py < ay1)"
_A_IN_B = "(ax0 >= bx0 and ax1 <= bx1 and ay0 >= by0 and ay1 <= by1)"


@query("f4_within", fx.sql(
    f"select l_orderkey, l_linenumber, {_IN} as point_box, {_A_IN_B} as box_box from fx_pairs", "fx_pairs"))
def within(spark, sf_dir):
    df = _pairs(spark, sf_dir)
    return df.select(
        *_IDS, F.expr(geo.within("p", "a")).alias("point_box"), F.expr(geo.within("a", "b")).alias("box_box")
    )


@query("f5_contains", fx.sql(
    f"select l_orderkey, l_linenumber, {_IN} as box_point, {_A_IN_B} as box_box from fx_pairs", "fx_pairs"))
def contains(spark, sf_dir):
    df = _pairs(spark, sf_dir)
    return df.select(
        *_IDS, F.expr(geo.contains("a", "p")).alias("box_point"), F.expr(geo.contains("b", "a")).alias("box_box")
    )


@query("f6_geometry_area", fx.sql(
    f"select id, round((x1 - x0) * (y1 - y0) * 1e9, 4) as area_scaled, round({AREA_M2}, 3) as area_m2 from fx_buildings", "fx_buildings"))
def geometry_area(spark, sf_dir):
    register(spark)
    df = fx.building_ways(spark, sf_dir)
    return df.select(
        "id", F.round(F.expr("geometry_area(geometry)") * 1e9, 4).alias("area_scaled"),
        F.round(F.expr(geo.let(geo.parse_wkt("geometry"), geo.area_m2)), 3).alias("area_m2"),
    )


@query("f7_geometry_length", fx.sql(
    f"with lengths as ({way_lengths()}) select id, round(planar, 6) as planar, round(meters, 3) as meters from lengths", "fx_vertices"))
def geometry_length(spark, sf_dir):
    register(spark)
    df = fx.ways(spark, sf_dir)
    return df.select(
        "id", F.round(F.expr("geometry_length(geometry)"), 6).alias("planar"),
        F.round(F.expr(geo.let(geo.parse_wkt("geometry"), geo.length_m)), 3).alias("meters"),
    )


def _kept(t: float, name: str) -> str:
    return f"cast(2 + greatest(count(w) filter (w > {t}), case when bool_or(ring) then 2 else 0 end) as int) as {name}"


@query("f8_simplify_geometry", fx.sql(
    f"with {WEIGHTS} select l.id, {_kept(0.001, 'kept_fine')}, {_kept(0.02, 'kept_medium')}, {_kept(0.05, 'kept_coarse')} "
    "from lines l left join weights w on w.id = l.id group by l.id", "fx_vertices"))
def simplify_geometry(spark, sf_dir):
    """Vertices kept at three tolerances, all from one weighing pass."""
    df = fx.ways(spark, sf_dir).select("id", F.expr(geo.parse_wkt("geometry")).alias("geom"))
    weighed = simplify.with_weights(df)
    kept = [
        F.expr(f"size(({simplify.simplified('geom', 'weights', f'{t}D')}).parts[0])").alias(name)
        for name, t in (("kept_fine", 0.001), ("kept_medium", 0.02), ("kept_coarse", 0.05))
    ]
    return weighed.select("id", *kept)


@query("f8_simplify_geometry_sql", fx.sql(
    f"with {WEIGHTS}, ranked as (select *, row_number() over (partition by id order by w desc, level, i) as best from weights) "
    "select v.id, concat('LINESTRING (', string_agg(concat(lon, ' ', lat), ', ' order by v.i), ')') as simplified "
    "from fx_ways f join fx_vertices v on v.id = f.id left join ranked r on r.id = v.id and r.i = v.i "
    "where v.i = 0 or v.i = f.n - 1 or w > 0.02 or (ring and best <= 2) group by v.id", "fx_ways", "fx_vertices"))
def simplify_geometry_sql(spark, sf_dir):
    """The SQL function on text."""
    register(spark)
    return fx.ways(spark, sf_dir).select("id", F.expr("simplify_geometry(geometry, 0.02D)").alias("simplified"))


@query("f8_simplify_geometry_text", CHECKS["f8_simplify_geometry_sql"])
def simplify_geometry_text(spark, sf_dir):
    """The same by parsed columns."""
    return simplify.simplify_text(fx.ways(spark, sf_dir).select("id", "geometry"), "geometry", "0.02D", "simplified").drop("geometry")


@query("f9_buffer_geometry", fx.sql(
    "select id, cast(33 as int) as n_points, round(16 * sin(2 * pi() / 32) * 0.25 * 1000, 4) as area_scaled, "
    "round(lon + 0.5, 6) as x_max, round(lat - 0.5, 6) as y_min from fx_pois", "fx_pois"))
def buffer_geometry(spark, sf_dir):
    """Disc of half a degree around each point, as a 32-sided polygon."""
    register(spark)
    df = fx.frame(spark, sf_dir, "fx_pois").withColumn("w", F.expr("buffer_geometry(point_to_wkt(lon, lat), 0.5D)"))
    g = df.select("id", F.expr(geo.parse_wkt("w")).alias("g")).withColumn("b", F.expr(geo.bbox("g")))
    return g.select(
        "id", F.expr("size(g.parts[0])").alias("n_points"),
        F.round(F.expr(geo.area("g")) * 1000, 4).alias("area_scaled"),
        F.round("b.x1", 6).alias("x_max"), F.round("b.y0", 6).alias("y_min"),
    )


@query("f10_is_valid", fx.sql("select id, id % 20 <> 0 as is_valid from fx_buildings", "fx_buildings"))
def is_valid(spark, sf_dir):
    df = fx.building_ways(spark, sf_dir)
    return df.select("id", F.expr(geo.wkt_is_valid("geometry")).alias("is_valid"))


_EIGHTH = "(x0 * (8 - ({k})) / 8 + x1 * ({k}) / 8)"
_HOLE = [_EIGHTH.format(k=f"id % 9 + {i}") for i in (-2, 2)]
_SECOND = [_EIGHTH.format(k=f"id % 9 + {i}") for i in (4, 12)]


@query("f10_is_valid_rings", fx.sql(
    f"select id, {_HOLE[0]} > x0 and {_HOLE[1]} < x1 as hole, {_SECOND[0]} > x1 as second from fx_zones", "fx_zones"))
def is_valid_rings(spark, sf_dir):
    """Zones with a hole that is moved along until it lies outside, and with a second polygon moved away."""
    corner = lambda x, y: f"cast({x} as string), ' ', cast({y} as string)"
    ring = lambda x0, x1, y0, y1: "concat('(', " + ", ', ', ".join(
        corner(x, y) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))
    ) + ", ')')"
    shell, low, high = ring("x0", "x1", "y0", "y1"), "(y0 * 3 + y1) / 4", "(y0 + y1 * 3) / 4"
    df = fx.frame(spark, sf_dir, "fx_zones").selectExpr(
        "id",
        f"concat('POLYGON (', {shell}, ', ', {ring(*_HOLE, low, high)}, ')') as holed",
        f"concat('MULTIPOLYGON ((', {shell}, '), (', {ring(*_SECOND, low, high)}, '))') as double",
    )
    return df.select(
        "id", F.expr(geo.wkt_is_valid("holed")).alias("hole"), F.expr(geo.wkt_is_valid("double")).alias("second")
    )


@query("f11_simplify_tolerance", fx.sql(
    "select id, zoom, round(case when zoom > 1 then 0.001::double / pow(2, zoom - 1) else 0.001::double end * 1e6, 6) as tolerance_scaled "
    "from (select id, cast(id % 19 as int) as zoom from fx_pois) z", "fx_pois"))
def simplify_tolerance(spark, sf_dir):
    df = fx.frame(spark, sf_dir, "fx_pois").selectExpr("id", "cast(id % 19 as int) as zoom")
    return df.select("id", "zoom", F.round(F.expr(tilemath.pyramid_tolerance("zoom")) * 1e6, 6).alias("tolerance_scaled"))


@query("f12_bbox", fx.sql(
    "select id, min(lon) as x0, min(lat) as y0, max(lon) as x1, max(lat) as y1 from fx_vertices group by id", "fx_vertices"))
def bbox(spark, sf_dir):
    df = fx.ways(spark, sf_dir).select("id", F.expr(geo.let(geo.parse_wkt("geometry"), geo.bbox)).alias("b"))
    return df.select("id", "b.*")


@query("f13_reproject", fx.sql(
    "select id, round(radians(lon) * 6378137.0::double, 3) as x, round(asinh(tan(radians(lat))) * 6378137.0::double, 3) as y, "
    "round(lon, 6) as lon, round(lat, 6) as lat from fx_pois", "fx_pois"))
def reproject(spark, sf_dir):
    """To Mercator metres and back."""
    df = fx.frame(spark, sf_dir, "fx_pois").withColumn("g", F.expr(geo.point("lon", "lat")))
    df = df.withColumn("m", F.expr(tilemath.reproject("g", 4326, 3857)))
    df = df.withColumn("r", F.expr(tilemath.reproject("m", 3857, 4326)))
    at = lambda g, c, n: F.round(F.expr(f"{g}.parts[0][0].{c}"), n)
    return df.select(
        "id", at("m", "x", 3).alias("x"), at("m", "y", 3).alias("y"), at("r", "x", 6).alias("lon"), at("r", "y", 6).alias("lat")
    )


# --- joins ----------------------------------------------------------------------------------


@query("g1_node_lookup_join", fx.sql(
    "select way_id, pos, ref, lon, lat from fx_refs join fx_nodes on id = ref", "fx_refs", "fx_nodes"))
def node_lookup_join(spark, sf_dir):
    return layers.node_lookup_join(
        fx.frame(spark, sf_dir, "fx_refs"), fx.frame(spark, sf_dir, "fx_nodes")
    ).select("way_id", "pos", "ref", "lon", "lat")


def _poi_points(spark, sf_dir):
    return fx.frame(spark, sf_dir, "fx_pois").selectExpr("id as poi_id", f"{geo.point_wkt('lon', 'lat')} as geometry_wkt")


_ZONE_HIT = "lon between x0 and x1 and lat between y0 and y1"
_ZONE_IN = "lon > x0 and lon < x1 and lat > y0 and lat < y1"


@query("g2_join_intersects", fx.sql(
    f"select p.id as poi_id, z.id as zone_id from fx_pois p join fx_zones z on {_ZONE_HIT}", "fx_pois", "fx_zones"))
def join_intersects(spark, sf_dir):
    pairs = joins.spatial_join(_poi_points(spark, sf_dir), fx.zones(spark, sf_dir))
    return pairs.select("poi_id", "zone_id")


@query("g2_join_intersects_boxes", fx.sql(
    "select a.id as zone_id, b.id as zone_id_right from fx_zones a join fx_zones b "
    "on a.x0 <= b.x1 and b.x0 <= a.x1 and a.y0 <= b.y1 and b.y0 <= a.y1", "fx_zones"))
def join_intersects_boxes(spark, sf_dir):
    """Zones against zones, boxes of very different size."""
    z = fx.zones(spark, sf_dir)
    return joins.spatial_join(z, z).select("zone_id", "zone_id_right")


_WAY_BOX = "(select id, min(lon) as wx0, max(lon) as wx1, min(lat) as wy0, max(lat) as wy1 from fx_vertices group by id)"


@query("g3_join_within", fx.sql(
    f"select w.id as way_id, z.id as zone_id from {_WAY_BOX} w join fx_zones z on wx0 >= x0 and wx1 <= x1 and wy0 >= y0 and wy1 <= y1",
    "fx_vertices", "fx_zones"))
def join_within(spark, sf_dir):
    """Ways that lie in a zone."""
    ways = fx.ways(spark, sf_dir).select(F.col("id").alias("way_id"), F.col("geometry").alias("geometry_wkt"))
    return joins.spatial_join(ways, fx.zones(spark, sf_dir), join_type="within").select("way_id", "zone_id")


@query("g4_join_contains", fx.sql(
    f"select z.id as zone_id, p.id as poi_id from fx_zones z join fx_pois p on {_ZONE_IN}", "fx_pois", "fx_zones"))
def join_contains(spark, sf_dir):
    pairs = joins.spatial_join(
        fx.zones(spark, sf_dir), _poi_points(spark, sf_dir), join_type="contains", salts=4
    )
    return pairs.select("zone_id", "poi_id")


@query("g5_join_broadcast", fx.sql(
    f"select p.id as poi_id, z.id as zone_id from fx_pois p join fx_zones z on {_ZONE_IN}", "fx_pois", "fx_zones"))
def join_broadcast(spark, sf_dir):
    """Right side broadcast, because it was measured as small."""
    pairs = joins.spatial_join(
        _poi_points(spark, sf_dir), fx.zones(spark, sf_dir), join_type="within", broadcast_right=True
    )
    return pairs.select("poi_id", "zone_id")


@query("f9_within_distance", fx.sql(
    "select p.id as poi_id, z.id as zone_id from fx_pois p join fx_zones z on "
    "pow(greatest(x0 - lon, 0, lon - x1), 2) + pow(greatest(y0 - lat, 0, lat - y1), 2) <= 0.75 * 0.75 "
    "and lon between x0 - 1 and x1 + 1 and lat between y0 - 1 and y1 + 1", "fx_pois", "fx_zones"))
def within_distance(spark, sf_dir):
    """Points within three quarters of a degree of a zone: the join form of a buffer."""
    pairs = joins.distance_join(_poi_points(spark, sf_dir), fx.zones(spark, sf_dir), 0.75)
    return pairs.select("poi_id", "zone_id")


@query("g6_tile_candidates", fx.sql(
    "select id, cast(5 as int) as z, cast(floor((lon + 180) / 360 * 32) as int) as x, "
    "cast(greatest(0, least(31, floor((1 - asinh(tan(radians(greatest(-85.05112878, least(85.05112878, lat))))) / pi()) / 2 * 32))) as int) as y from fx_pois "
    "where lat between -85.0511287 and 85.0511287", "fx_pois"))
def tile_candidates(spark, sf_dir):
    """Box candidates and exact test without a buffer: each point's own tile."""
    from geoloom.operators import tiles

    df = fx.frame(spark, sf_dir, "fx_pois").withColumn("geom", F.expr(geo.point("lon", "lat")))
    df = df.withColumns({"box": F.expr(geo.bbox("geom")), "z": F.lit(5)})
    return tiles.cover(df, buffer=0).select("id", "z", "x", "y")


@query("g7_member_join", fx.sql(
    "select id as relation_id, u.seq, id*4 + u.e as way_id, cast(2 as int) as n_points from (select id, "
    "unnest([{'seq': 0, 'e': 0}, {'seq': 1, 'e': 2}, {'seq': 2, 'e': 1}, {'seq': 3, 'e': 3}]) as u from fx_areas) a", "fx_areas"))
def member_join(spark, sf_dir):
    rel, ways, nodes = fx.areas(spark, sf_dir)
    df = layers.member_join(rel, layers.way_points(ways, nodes))
    return df.select("relation_id", "seq", "way_id", F.size("points").alias("n_points"))


@query("h21_spatial_partition", fx.sql(
    "select highway as road_type, count(*) as n from fx_ways where highway <> 'footway' group by 1", "fx_ways"))
def spatial_partition(spark, sf_dir):
    df = layers.roads(layers.spatial_partition(fx.ways(spark, sf_dir), "geometry"))
    return df.groupBy("road_type").agg(F.count(F.lit(1)).alias("n"))


# --- changes, conflation, junctions ---------------------------------------------------------


@query("m1_apply_changes", fx.sql(
    "select id, cast(case when id % 4 = 0 then 3 when id % 5 = 0 then null else 1 end as int) as version, "
    "case when id % 4 = 0 then concat('new ', id) else nullif(name, '') end as name from fx_pois where id % 6 <> 5", "fx_pois"))
def apply_changes(spark, sf_dir):
    """Every fourth element has two newer versions, every sixth a deletion."""
    t = layers.tag("name").alias("name")
    # Every fifth element has no version, which is older than any; deletions win over equal versions.
    current = fx.nodes(spark, sf_dir).select("id", F.expr("if(id % 5 = 0, null, version)").alias("version"), t)
    newer = current.selectExpr(
        "id", "version", "concat('new ', id) as name", "explode(array(2, 3)) as v"
    ).filter("id % 4 = 0").selectExpr("id", "v as version", "name", "false as deleted")
    gone = current.filter("id % 6 = 5").selectExpr("id", "if(id % 4 = 0, 3, version) as version", "name", "true as deleted")
    return changes.apply_changes(current, newer.unionByName(gone))


@query("m2_conflate", fx.sql(
    "select id as osm_id, id as match_id, cast(1 as int) as name_distance from fx_pois where coalesce(name, '') <> ''", "fx_pois"))
def conflate(spark, sf_dir):
    """A source against a copy moved by a little, with one letter more in the name.

    Beside each copy lies a place of quite another, short name, and one without any.
    """
    left = fx.frame(spark, sf_dir, "fx_pois").selectExpr(
        "id as osm_id", "name", f"{geo.point_wkt('lon', 'lat')} as geometry_wkt"
    )
    right = fx.frame(spark, sf_dir, "fx_pois").selectExpr(
        "id as osm_id",
        "explode(array(if(name <> '', concat(name, '+'), name), 'Zoo', '', null)) as name",
        f"{geo.point_wkt('lon + 0.0001D', 'lat')} as geometry_wkt",
    )
    return changes.conflate(left, right, 0.0002, 3)


@query("m3_road_junctions", fx.sql(
    "select ref, count(distinct way_id) as ways from fx_refs group by ref having count(distinct way_id) >= 2", "fx_refs"))
def road_junctions(spark, sf_dir):
    return changes.road_junctions(fx.frame(spark, sf_dir, "fx_refs"))
