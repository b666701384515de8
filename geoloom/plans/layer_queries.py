"""Layers and their classification rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoloom import schemas, session
from geoloom.functions import classify
from geoloom.functions import geometry as geo
from geoloom.operators import ingest as ingest_op
from geoloom.operators import layers
from geoloom.plans import fixtures as fx
from geoloom.plans.registry import query
from geoloom.rules import EARTH_RADIUS_M
from geoloom.sources import elements, sinks

# --- shared pieces of the checks ------------------------------------------------------------

STRICT_POI = (
    "case when amenity in ('restaurant','hospital','school','bank','pharmacy') then concat('amenity:', amenity) "
    "when shop in ('supermarket','bakery') then concat('shop:', shop) "
    "when tourism = 'hotel' then concat('tourism:', tourism) end"
)
ROAD_CLASS = (
    "case when highway in ('motorway','trunk') then 'highway' when highway in ('primary','secondary') then 'arterial' "
    "when highway in ('tertiary','unclassified') then 'collector' else 'local' end"
)
WIDE = (
    "(amenity in ('restaurant','hospital','school','bank','pharmacy') or shop in ('supermarket','bakery') "
    "or tourism is not null)"
)
CATEGORY = "coalesce(amenity, shop, tourism, 'other')"
SCORE = (
    f"cast(case when {CATEGORY} in ('hospital','school','university') then 10 when {CATEGORY} in ('restaurant','fuel','bank') then 8 "
    f"when {CATEGORY} in ('supermarket','pharmacy') then 7 else 5 end as int)"
)
B_CLASS = (
    "case when building in ('house','detached','residential') then 'residential' "
    "when building in ('commercial','retail','office') then 'commercial' "
    "when building in ('industrial','warehouse') then 'industrial' "
    "when building in ('school','hospital','church') then 'institutional' else 'other' end"
)
HEIGHT = "case when regexp_full_match(height, '[0-9]+([.][0-9]+)?') then cast(height as double) end"
LEVELS = "case when regexp_full_match(levels, '[0-9]+') then cast(levels as int) end"
AREA_M2 = (
    f"abs({EARTH_RADIUS_M * EARTH_RADIUS_M!r}::double * radians(x1 - x0) * (sin(radians(y1)) - sin(radians(y0))))"
)
_HAV = (
    f"{2 * EARTH_RADIUS_M!r}::double * asin(sqrt(least(1.0, pow(sin(radians(lat - plat) / 2), 2) + "
    "cos(radians(plat)) * cos(radians(lat)) * pow(sin(radians(lon - plon) / 2), 2))))"
)


def way_lengths(vertices: str = "fx_vertices", where: str = "true") -> str:
    """CTE body: metres and planar length per way."""
    return (
        f"select id, count(*) as n_points, coalesce(sum(case when plon is not null then {_HAV} end), 0) as meters, "
        "coalesce(sum(sqrt(pow(lon - plon, 2) + pow(lat - plat, 2))), 0) as planar, "
        "concat('LINESTRING (', string_agg(concat(lon, ' ', lat), ', ' order by i), ')') as wkt "
        f"from (select *, lag(lon) over w as plon, lag(lat) over w as plat from {vertices} where {where} "
        "window w as (partition by id order by i)) s group by id"
    )


# Weight of each inner vertex: the recursive split of a line at its farthest vertex.
_AT, _LO, _HI = "p[cast(j as int)]", "p[lo]", "p[hi]"
_N2 = f"(pow({_HI}.x - {_LO}.x, 2) + pow({_HI}.y - {_LO}.y, 2))"
_ALONG = (
    f"coalesce(greatest(0, least(1, (({_AT}.x - {_LO}.x) * ({_HI}.x - {_LO}.x) + ({_AT}.y - {_LO}.y) * ({_HI}.y - {_LO}.y)) "
    f"/ nullif({_N2}, 0))), 0)"
)
_FAR = (
    f"sqrt(pow({_AT}.x - {_LO}.x - {_ALONG} * ({_HI}.x - {_LO}.x), 2) + pow({_AT}.y - {_LO}.y - {_ALONG} * ({_HI}.y - {_LO}.y), 2))"
)
_DISTANCES = f"list_transform(range(lo + 1, hi), lambda j: {_FAR})"
_FIRST = f"list_position(list_transform({_DISTANCES}, lambda d: d >= list_max({_DISTANCES}) * (1 - 1e-9::double)), true)"
WEIGHTS = (
    "lines as (select id, list({'x': lon, 'y': lat} order by i) as p from fx_vertices group by id), "
    "segs as (select id, p, cast(1 as bigint) as lo, cast(len(p) as bigint) as hi, cast(1e300 as double) as lim, 1 as level from lines union all "
    "select id, p, case s.s when 0 then lo else k end, case s.s when 0 then k else hi end, w, level + 1 from "
    f"(select id, p, lo, hi, level, lo + {_FIRST} as k, least(lim, list_max({_DISTANCES})) as w "
    "from segs where hi - lo > 1) m, (values (0), (1)) s(s)), "
    f"weights as (select id, lo + {_FIRST} - 1 as i, least(lim, list_max({_DISTANCES})) as w, level, "
    "len(p) >= 4 and p[1] = p[-1] as ring from segs where hi - lo > 1)"
)


def _wide_pois(spark, sf_dir):
    return layers.pois(fx.nodes(spark, sf_dir))


# --- layers ---------------------------------------------------------------------------------


@query("flagship_road_classes", fx.sql(
    f"with lengths as ({way_lengths(where='node_id % 37 <> 0')}) "
    f"select {ROAD_CLASS} as road_class, count(*) as roads, round(sum(meters) / 1000, 3) as total_km "
    "from fx_ways join lengths using (id) where highway <> 'footway' and n_points >= 2 group by 1",
    "fx_ways", "fx_vertices"))
def flagship_road_classes(spark, sf_dir):
    """Ways assembled from their nodes, classified, and summed by road class."""
    lines = layers.road_lines(fx.ways(spark, sf_dir), fx.way_nodes(spark, sf_dir))
    return (
        lines.select(
            classify.road_class(F.col("road_type")).alias("road_class"),
            F.expr(geo.length_m("geom")).alias("m"),
        )
        .groupBy("road_class")
        .agg(F.count(F.lit(1)).alias("roads"), F.round(F.sum("m") / 1000, 3).alias("total_km"))
    )


@query("d1_poi_nodes", fx.sql(
    f"select id as osm_id, poi_type, coalesce(name, '') as name, lon, lat from (select *, {STRICT_POI} as poi_type from fx_pois) p "
    "where poi_type is not null", "fx_pois"))
def poi_nodes(spark, sf_dir):
    df = layers.poi_nodes(fx.nodes(spark, sf_dir))
    return df.select(
        "osm_id", "poi_type", "name",
        F.expr("geom.parts[0][0].x").alias("lon"), F.expr("geom.parts[0][0].y").alias("lat"),
    )


@query("d2_pois", fx.sql(
    f"select id as osm_id, lat, lon, name, amenity, shop, tourism, phone, concat('POINT(', lon, ' ', lat, ')') as geometry_wkt, "
    f"{CATEGORY} as poi_category, case when amenity is not null then 'amenity' when shop is not null then 'shop' else 'tourism' end as poi_type, "
    f"{SCORE} as importance_score, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts "
    f"from fx_pois where {WIDE} and coalesce(name, '') <> ''", "fx_pois"))
def pois(spark, sf_dir):
    return _wide_pois(spark, sf_dir).select(
        "osm_id", "lat", "lon", "name", "amenity", "shop", "tourism", "phone", "geometry_wkt",
        "poi_category", "poi_type", "importance_score", F.col("timestamp").cast("string").alias("ts"),
    )


@query("d3_road_ways", fx.sql(
    "select id, highway as road_type, coalesce(name, '') as name, coalesce(maxspeed, '') as maxspeed, "
    "coalesce(surface, '') as surface, n as n_nodes from fx_ways where highway <> 'footway'", "fx_ways"))
def road_ways(spark, sf_dir):
    return layers.road_ways(fx.ways(spark, sf_dir)).select(
        "id", "road_type", "name", "maxspeed", "surface", F.size("nodes").alias("n_nodes")
    )


@query("d4_road_lines", fx.sql(
    f"with lengths as ({way_lengths(where='node_id % 37 <> 0')}) "
    "select id as osm_id, highway as road_type, wkt as geometry_wkt from fx_ways join lengths using (id) "
    "where highway <> 'footway' and n_points >= 2", "fx_ways", "fx_vertices"))
def road_lines(spark, sf_dir):
    df = layers.road_lines(fx.ways(spark, sf_dir), fx.way_nodes(spark, sf_dir))
    return df.select("osm_id", "road_type", "geometry_wkt")


@query("d4_road_lines_complete", fx.sql(
    f"with lengths as ({way_lengths(where='node_id % 37 <> 0')}) "
    "select id as osm_id, wkt as geometry_wkt from fx_ways join lengths using (id) "
    "where highway <> 'footway' and n_points = n", "fx_ways", "fx_vertices"))
def road_lines_complete(spark, sf_dir):
    """Only ways all of whose references resolve."""
    df = layers.road_lines(fx.ways(spark, sf_dir), fx.way_nodes(spark, sf_dir), "drop")
    return df.select("osm_id", "geometry_wkt")


@query("d5_roads", fx.sql(
    f"with lengths as ({way_lengths()}) "
    f"select id as osm_id, highway as road_type, name, maxspeed, surface, lanes, wkt as geometry_wkt, "
    f"strftime(ts, '%Y-%m-%d %H:%M:%S') as ts, round(meters, 4) as length_meters, {ROAD_CLASS} as road_class "
    "from fx_ways join lengths using (id) where highway <> 'footway'", "fx_ways", "fx_vertices"))
def roads(spark, sf_dir):
    df = layers.roads(fx.ways(spark, sf_dir))
    return df.select(
        "osm_id", "road_type", "name", "maxspeed", "surface", "lanes", "geometry_wkt",
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("ts"),
        F.round("length_meters", 4).alias("length_meters"), "road_class",
    )


@query("d6_buildings", fx.sql(
    f"select id as osm_id, building as building_type, name, nullif(height, '') as height, levels, round({AREA_M2}, 3) as area_sqm, "
    f"{B_CLASS} as building_class, {HEIGHT} as height_meters, {LEVELS} as num_levels, "
    f"coalesce({HEIGHT}, {LEVELS} * 3.0::double) as estimated_height from fx_buildings "
    f"where building is not null and building <> 'no' and {AREA_M2} > 10", "fx_buildings"))
def buildings(spark, sf_dir):
    df = layers.buildings(fx.building_ways(spark, sf_dir))
    return df.select(
        "osm_id", "building_type", "name", "height", "levels", F.round("area_sqm", 3).alias("area_sqm"),
        "building_class", "height_meters", "num_levels", "estimated_height",
    )


def _closed_ways(spark, sf_dir):
    """One closed way per area around its four corners; some are buildings, some stay open."""
    _, _, corners = fx.areas(spark, sf_dir)
    ways = fx.frame(spark, sf_dir, "fx_areas").selectExpr(
        "id",
        "concat(transform(sequence(0, 3), c -> id*4 + c), "
        "case when id % 7 = 0 then cast(array() as array<bigint>) else array(id*4) end) as nodes",
        "map('building', case id % 5 when 0 then 'yes' when 1 then 'house' when 2 then 'barn' when 3 then 'commercial' else 'apartments' end, "
        "'name', name) as tags",
        "cast(null as string) as geometry", "cast(1 as int) as version", "cast(null as timestamp) as timestamp",
    )
    return ways, corners


@query("d7_building_ways", fx.sql(
    "select id as osm_id, case id % 5 when 0 then 'yes' when 1 then 'house' when 3 then 'commercial' else 'apartments' end as building_type, "
    "name, round(w * h, 6) as area, cast(5 as int) as n_points from fx_areas where id % 5 <> 2 and id % 7 <> 0", "fx_areas"))
def building_ways(spark, sf_dir):
    ways, corners = _closed_ways(spark, sf_dir)
    df = layers.building_ways(ways, corners)
    return df.select(
        "osm_id", "building_type", "name", F.round(F.expr(geo.area("geom")), 6).alias("area"),
        F.expr("size(geom.parts[0])").alias("n_points"),
    )


@query("d8_admin_boundaries", fx.sql(
    "select id as osm_id, name, cast(0 as int) as ring_no, round(w * h, 6) as area, cast(5 as int) as n_points, "
    "round(2 * (w + h), 6) as perimeter from fx_areas where boundary = 'administrative'", "fx_areas"))
def admin_boundaries(spark, sf_dir):
    df = layers.admin_boundaries(*fx.areas(spark, sf_dir))
    return df.select(
        "osm_id", "name", "ring_no", F.round(F.expr(geo.area("geom")), 6).alias("area"),
        F.expr("size(geom.parts[0])").alias("n_points"),
        F.round(F.expr(geo.length("geom")), 6).alias("perimeter"),
    )


@query("d9_process_layers", fx.sql(
    f"select 'roads' as feature_type, count(*) as record_count from fx_ways where highway <> 'footway' union all "
    f"select 'pois', count(*) from fx_pois where {WIDE} and coalesce(name, '') <> '' union all "
    f"select 'buildings', count(*) from fx_buildings where building <> 'no' and {AREA_M2} > 10",
    "fx_ways", "fx_pois", "fx_buildings"))
def process_layers(spark, sf_dir):
    """Elements written as Parquet, then every layer built from there and written."""
    root, out = session.new_path(spark, "elements"), session.new_path(spark, "layers")
    fx.nodes(spark, sf_dir).write.parquet(f"{root}/nodes")
    every = fx.ways(spark, sf_dir).unionByName(fx.building_ways(spark, sf_dir))
    every.write.parquet(f"{root}/ways")
    done = layers.process_layers(spark, root, out, ["roads", "pois", "buildings", "rivers"])
    return done.select("feature_type", "record_count")


@query("d10_ingest_layers", fx.sql(
    f"with lengths as ({way_lengths(where='node_id % 37 <> 0')}) "
    f"select 'pois' as feature_type, count(*) as record_count from fx_pois where ({STRICT_POI}) is not null union all "
    "select 'roads', count(*) from fx_ways join lengths using (id) where highway <> 'footway' and n_points >= 2",
    "fx_pois", "fx_ways", "fx_vertices"))
def ingest_layers(spark, sf_dir):
    rel, _, _ = fx.areas(spark, sf_dir)
    nodes = fx.nodes(spark, sf_dir).unionByName(fx.way_nodes(spark, sf_dir).withColumn("id", -F.col("id") - 1))
    ways = fx.ways(spark, sf_dir).withColumn("nodes", F.expr("transform(nodes, n -> -n - 1)"))
    built = layers.ingest_layers(elements.Elements(nodes, ways, rel.filter("id IS NULL"), rel))
    return layers.layer_counts(built).filter("record_count > 0")


@query("d11_ingest", fx.sql(
    f"select 'completed' as status, count(*) as records_processed from fx_pois where ({STRICT_POI}) is not null", "fx_pois"))
def ingest(spark, sf_dir):
    """The whole workflow from XML files to layers and a run row."""
    xml, out, runs = (session.new_path(spark, n) for n in ("osm", "out", "runs"))
    text = fx.frame(spark, sf_dir, "fx_pois").selectExpr(
        "concat('<node id=\"', id, '\" lat=\"', lat, '\" lon=\"', lon, '\" version=\"1\">', "
        "'<tag k=\"amenity\" v=\"', coalesce(amenity, ''), '\"/><tag k=\"shop\" v=\"', coalesce(shop, ''), "
        "'\"/><tag k=\"tourism\" v=\"', coalesce(tourism, ''), '\"/></node>') as value"
    )
    sinks.write_xml(text, f"{xml}.osm")
    ingest_op.ingest(spark, f"{xml}.osm", out, run_table=runs)
    return spark.read.schema(schemas.RUN).parquet(runs).select("status", "records_processed")


# --- the whole input of d8, d10 and d11 ------------------------------------------------------


def _ringed_areas(spark, sf_dir):
    """Areas with a hole (every second), a second shell (two of four) and an unclosed first one (every fifth)."""
    rel, edges, corners = fx.areas(spark, sf_dir)
    member = "named_struct('type', 'way', 'ref', cast({} + id as bigint), 'role', '{}')"
    some = lambda when, m: f"case when {when} then array({m}) else filter(array({m}), m -> false) end"
    rel = rel.withColumn("members", F.expr(
        "concat(filter(members, m -> id % 5 <> 0 or m.ref % 4 <> 3), "
        f"{some('id % 2 = 0', member.format(1000000000, 'inner'))}, {some('id % 4 < 2', member.format(2000000000, 'outer'))})"
    ))
    ring = lambda base: fx.frame(spark, sf_dir, "fx_areas").selectExpr(
        f"cast({base} + id as bigint) as id",
        f"transform(array(0, 1, 2, 3, 0), c -> cast({base * 4} + id * 4 + c as bigint)) as nodes",
        "cast(map() as map<string, string>) as tags", "cast(null as string) as geometry",
        "cast(1 as int) as version", "cast(null as timestamp) as timestamp",
    )
    spot = lambda base, lon, lat: fx.frame(spark, sf_dir, "fx_corners").selectExpr(
        f"cast({base * 4} + id as bigint) as id", f"{lat} as lat", f"{lon} as lon",
        "cast(map() as map<string, string>) as tags", "cast(1 as int) as version", "cast(null as timestamp) as timestamp",
    )
    inner = spot(
        1000000000,
        "lon + case when c in (1, 2) then -1 else 1 end * (10 + area_id % 50) / 4000D",
        "lat + case when c in (2, 3) then -1 else 1 end * (10 + area_id % 30) / 4000D",
    )
    ways = edges.unionByName(ring(1000000000)).unionByName(ring(2000000000))
    return rel, ways, corners.unionByName(inner).unionByName(spot(2000000000, "lon + 1", "lat"))


@query("d8_admin_boundaries_rings", fx.sql(
    "with admin as (select * from fx_areas where boundary = 'administrative'), shells as ("
    "select id, name, w, h, 0 as ring_no, id % 2 = 0 as hole from admin where id % 5 <> 0 union all "
    "select id, name, w, h, case when id % 5 = 0 then 0 else 1 end, false from admin where id % 4 < 2) "
    "select id as osm_id, name, cast(ring_no as int) as ring_no, cast(case when hole then 2 else 1 end as int) as n_rings, "
    "round(w * h * case when hole then 0.75::double else 1.0::double end, 6) as area from shells", "fx_areas"))
def admin_boundaries_rings(spark, sf_dir):
    """Relations with inner rings, two shells and chains that do not close, which give no row."""
    df = layers.admin_boundaries(*_ringed_areas(spark, sf_dir))
    return df.select(
        "osm_id", "name", "ring_no", F.expr("size(geom.parts)").alias("n_rings"),
        F.round(F.expr(geo.area("geom")), 6).alias("area"),
    )


def _flawed_areas(spark, sf_dir):
    """Ringed areas of which every third hole lies beside its shell and every seventh refers to an unknown way."""
    rel, ways, nodes = _ringed_areas(spark, sf_dir)
    stray = "id >= 4000000000 AND id < 8000000000 AND floor((id - 4000000000) / 4) % 3 = 0"
    nodes = nodes.withColumn("lon", F.expr(f"lon + case when {stray} then 3D else 0D end"))
    unknown = "case when id % 7 = 0 then array(named_struct('type', 'way', 'ref', -id - 1, 'role', 'outer')) else filter(members, m -> false) end"
    return rel.withColumn("members", F.expr(f"concat(members, {unknown})")), ways, nodes


@query("d8_rejected", fx.sql(
    "with admin as (select *, case when id % 5 = 0 then 3 else 4 end as edges from fx_areas where boundary = 'administrative'), "
    "lost as (select id, unnest([0, 1, 2]) as seq, id * 4 + unnest([0, 2, 1]) as way_id, 'outer' as role, 'unclosed' as reason "
    "from admin where id % 5 = 0 union all "
    "select id, edges, 1000000000 + id, 'inner', 'hole without shell' from admin "
    "where id % 2 = 0 and (id % 3 = 0 or id % 5 = 0) union all "
    "select id, edges + case when id % 2 = 0 then 1 else 0 end + case when id % 4 < 2 then 1 else 0 end, -id - 1, "
    "'outer', 'missing way' from admin where id % 7 = 0) "
    "select id as osm_id, cast(seq as int) as seq, cast(way_id as bigint) as way_id, role, reason from lost", "fx_areas"))
def rejected_boundaries(spark, sf_dir):
    """Members that reach no polygon: open chains, holes beside their shell and unknown ways."""
    return layers.rejected_boundaries(*_flawed_areas(spark, sf_dir))


def _every_element(spark, sf_dir):
    """Points of interest, way nodes and corners; roads, buildings and edges; all relations."""
    rel, edges, corners = fx.areas(spark, sf_dir)
    closed, _ = _closed_ways(spark, sf_dir)
    moved = lambda df: df.withColumn("id", F.col("id") + 3000000000)
    refs = lambda df, to: df.withColumn("nodes", F.expr(f"transform(nodes, n -> {to})"))
    nodes = fx.nodes(spark, sf_dir).unionByName(fx.way_nodes(spark, sf_dir).withColumn("id", -F.col("id") - 1))
    ways = refs(fx.ways(spark, sf_dir), "-n - 1").unionByName(moved(refs(edges, "n + 3000000000")))
    ways = ways.unionByName(refs(closed, "n + 3000000000").withColumn("id", F.col("id") + 4000000000))
    members = "transform(members, m -> named_struct('type', m.type, 'ref', m.ref + 3000000000, 'role', m.role))"
    return nodes.unionByName(moved(corners)), ways, rel.withColumn("members", F.expr(members))


_LAYER_COUNTS = (
    f"select 'pois' as feature_type, count(*) as record_count from fx_pois where ({STRICT_POI}) is not null union all "
    "select 'roads', count(*) from fx_ways join lengths using (id) where highway <> 'footway' and n_points >= 2 union all "
    "select 'buildings', count(*) from fx_areas where id % 5 <> 2 and id % 7 <> 0 union all "
    "select 'admin_boundaries', count(*) from fx_areas where boundary = 'administrative'"
)


@query("d10_ingest_layers_all", fx.sql(
    f"with lengths as ({way_lengths(where='node_id % 37 <> 0')}) {_LAYER_COUNTS}",
    "fx_pois", "fx_ways", "fx_vertices", "fx_areas"))
def ingest_layers_all(spark, sf_dir):
    """All four layers over all nodes, ways and relations."""
    nodes, ways, rel = _every_element(spark, sf_dir)
    return layers.layer_counts(layers.ingest_layers(elements.Elements(nodes, ways, rel, rel)))


def _xml_tags():
    value = "replace(replace(replace(t.value, '&', '&amp;'), '<', '&lt;'), '\"', '&quot;')"
    return f"array_join(transform(map_entries(tags), t -> concat('<tag k=\"', t.key, '\" v=\"', {value}, '\"/>')), '')"


@query("d11_ingest_all", fx.sql(
    f"with lengths as ({way_lengths(where='node_id % 37 <> 0')}), counts as ({_LAYER_COUNTS}) "
    "select 'completed' as status, cast((select sum(record_count) from counts) as bigint) as records_processed, "
    "feature_type, record_count from counts", "fx_pois", "fx_ways", "fx_vertices", "fx_areas"))
def ingest_all(spark, sf_dir):
    """The whole workflow over XML with nodes, ways and relations: the run row beside every written layer."""
    xml, out, runs = (session.new_path(spark, n) for n in ("osm", "out", "runs"))
    nodes, ways, rel = _every_element(spark, sf_dir)
    refs = "array_join(transform(nodes, n -> concat('<nd ref=\"', n, '\"/>')), '')"
    members = (
        "array_join(transform(members, m -> "
        "concat('<member type=\"', m.type, '\" ref=\"', m.ref, '\" role=\"', m.role, '\"/>')), '')"
    )
    text = nodes.selectExpr(
        f"concat('<node id=\"', id, '\" lat=\"', lat, '\" lon=\"', lon, '\" version=\"1\">', {_xml_tags()}, '</node>') as value"
    )
    for df, kind, inner in ((ways, "way", refs), (rel, "relation", members)):
        text = text.unionByName(df.selectExpr(
            f"concat('<{kind} id=\"', id, '\" version=\"1\">', {inner}, {_xml_tags()}, '</{kind}>') as value"
        ))
    sinks.write_xml(text, f"{xml}.osm")
    done = ingest_op.ingest(spark, f"{xml}.osm", out, run_table=runs)
    run = spark.read.schema(schemas.RUN).parquet(runs).select("status", "records_processed")
    written = {name: spark.read.parquet(f"{out}/{name}") for name in done["stats"]["layers"]}
    return run.crossJoin(layers.layer_counts(written)) if written else run


# --- classification rules -------------------------------------------------------------------


@query("e1_road_class", fx.sql(
    f"select highway, {ROAD_CLASS} as road_class, count(*) as n from fx_ways group by 1, 2", "fx_ways"))
def road_class(spark, sf_dir):
    df = fx.frame(spark, sf_dir, "fx_ways")
    return df.groupBy("highway", classify.road_class(F.col("highway")).alias("road_class")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _tag_columns():
    return F.col("amenity"), F.col("shop"), F.col("tourism")


@query("e2_poi_category", fx.sql(f"select id, {CATEGORY} as poi_category from fx_pois", "fx_pois"))
def poi_category(spark, sf_dir):
    df = fx.frame(spark, sf_dir, "fx_pois")
    return df.select("id", classify.poi_category(*_tag_columns()).alias("poi_category"))


@query("e3_poi_type", fx.sql(
    "select id, case when amenity is not null then 'amenity' when shop is not null then 'shop' "
    "when tourism is not null then 'tourism' else 'other' end as poi_type from fx_pois", "fx_pois"))
def poi_type(spark, sf_dir):
    df = fx.frame(spark, sf_dir, "fx_pois")
    return df.select("id", classify.poi_type(*_tag_columns()).alias("poi_type"))


@query("e4_importance_score", fx.sql(f"select id, {SCORE} as importance_score from fx_pois", "fx_pois"))
def importance_score(spark, sf_dir):
    df = fx.frame(spark, sf_dir, "fx_pois")
    category = classify.poi_category(*_tag_columns())
    return df.select("id", classify.importance_score(category).alias("importance_score"))


@query("e5_named_only", fx.sql("select id, name from fx_pois where coalesce(name, '') <> ''", "fx_pois"))
def named_only(spark, sf_dir):
    return fx.frame(spark, sf_dir, "fx_pois").filter(classify.named(F.col("name"))).select("id", "name")


@query("e6_building_class", fx.sql(f"select id, {B_CLASS} as building_class from fx_buildings", "fx_buildings"))
def building_class(spark, sf_dir):
    df = fx.frame(spark, sf_dir, "fx_buildings")
    return df.select("id", classify.building_class(F.col("building")).alias("building_class"))


@query("e7_height_meters", fx.sql(f"select id, {HEIGHT} as height_meters from fx_buildings", "fx_buildings"))
def height_meters(spark, sf_dir):
    df = fx.frame(spark, sf_dir, "fx_buildings")
    return df.select("id", classify.height_meters(F.col("height")).alias("height_meters"))


@query("e8_num_levels", fx.sql(f"select id, {LEVELS} as num_levels from fx_buildings", "fx_buildings"))
def num_levels(spark, sf_dir):
    df = fx.frame(spark, sf_dir, "fx_buildings")
    return df.select("id", classify.num_levels(F.col("levels")).alias("num_levels"))


@query("e9_estimated_height", fx.sql(
    f"select id, coalesce({HEIGHT}, {LEVELS} * 3.0::double) as estimated_height from fx_buildings", "fx_buildings"))
def estimated_height(spark, sf_dir):
    df = fx.frame(spark, sf_dir, "fx_buildings")
    estimate = classify.estimated_height(
        classify.height_meters(F.col("height")), classify.num_levels(F.col("levels"))
    )
    return df.select("id", estimate.alias("estimated_height"))


@query("e10_min_area", fx.sql(
    f"select id, round({AREA_M2}, 3) as area_sqm from fx_buildings where {AREA_M2} > 10", "fx_buildings"))
def min_area(spark, sf_dir):
    df = fx.frame(spark, sf_dir, "fx_buildings").withColumn(
        "area_sqm", F.expr(geo.let(geo.box("x0", "y0", "x1", "y1"), geo.area_m2))
    )
    return df.filter(classify.large_enough(F.col("area_sqm"))).select(
        "id", F.round("area_sqm", 3).alias("area_sqm")
    )
