"""Tile operators and catalog queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoloom import schemas, session
from geoloom.functions import geometry as geo
from geoloom.functions import mvt, tilemath
from geoloom.operators import catalog, incremental, joins, layers, skipping, tiles
from geoloom.plans import fixtures as fx
from geoloom.plans.layer_queries import CATEGORY, SCORE, STRICT_POI, WEIGHTS, WIDE, way_lengths
from geoloom.plans.registry import CHECKS, query
from geoloom.sources import elements, parts, sinks

# --- shared pieces of the checks ------------------------------------------------------------

_LAT = "greatest(-85.05112878, least(85.05112878, {lat}))"


def _sx(z: str, lon: str = "lon") -> str:
    return f"cast(greatest(0, least(pow(2, {z}) - 1, floor(({lon} + 180) / 360 * pow(2, {z})))) as int)"


def _sy(z: str, lat: str = "lat") -> str:
    inner = f"asinh(tan(radians({_LAT.format(lat=lat)})))"
    return f"cast(greatest(0, least(pow(2, {z}) - 1, floor((1 - {inner} / pi()) / 2 * pow(2, {z})))) as int)"


def _left(x: str, z: str = "z") -> str:
    return f"({x} / pow(2, {z}) * 360 - 180)"


def _top(y: str, z: str = "z") -> str:
    return f"degrees(atan(sinh(pi() * (1 - 2 * ({y}) / pow(2, {z})))))"


_TILE_COLUMNS = f"{_left('x')} as tx0, {_left('(x + 1)')} as tx1, {_top('y + 1')} as ty0, {_top('y')} as ty1"
_GROWN = (
    "select *, tx0 - 0.25 * (tx1 - tx0) as gx0, tx1 + 0.25 * (tx1 - tx0) as gx1, "
    "ty0 - 0.25 * (ty1 - ty0) as gy0, ty1 + 0.25 * (ty1 - ty0) as gy1"
)


def point_tiles(zooms: str, where: str = "true") -> str:
    """Rows of fx_pois in every tile whose grown box holds them."""
    return (
        f"select * from ({_GROWN} from (select *, {_TILE_COLUMNS} from (select p.*, z.z, dx.dx + {_sx('z.z')} as x, dy.dy + {_sy('z.z')} as y "
        f"from (select * from fx_pois where {where}) p, (values {zooms}) z(z), (values (-1), (0), (1)) dx(dx), (values (-1), (0), (1)) dy(dy)) c "
        "where x between 0 and pow(2, z) - 1 and y between 0 and pow(2, z) - 1) b) g "
        "where lon between gx0 and gx1 and lat between gy0 and gy1"
    )


def box_tiles(zooms: str, source: str = "fx_zones") -> str:
    """The same for boxes; polygons below a minimum area are left out at zoom 8 and less."""
    return (
        f"select * from ({_GROWN} from (select *, {_TILE_COLUMNS} from (select *, unnest(range(greatest(0, ylo - 1), least(pow(2, z)::int - 1, yhi + 1) + 1)) as y "
        f"from (select *, unnest(range(greatest(0, xlo - 1), least(pow(2, z)::int - 1, xhi + 1) + 1)) as x "
        f"from (select s.*, z.z, {_sx('z.z', 'x0')} as xlo, {_sx('z.z', 'x1')} as xhi, {_sy('z.z', 'y1')} as ylo, {_sy('z.z', 'y0')} as yhi "
        f"from {source} s, (values {zooms}) z(z) where z.z > 8 or (x1 - x0) * (y1 - y0) >= 1e-6) r) rx) ry) b) g "
        "where x0 <= gx1 and x1 >= gx0 and y0 <= gy1 and y1 >= gy0"
    )


POIS = tiles.Layer("pois", "fx_pois", 0, 8, "geom", ["name", "amenity", "shop"], id_column="id")
ZONES = tiles.Layer("zones", "fx_zones", 0, 12, "geometry_wkt", ["zone_name"], id_column="zone_id")
ROADS = tiles.Layer("roads", "fx_ways", 0, 14, "geometry_wkt", ["name", "road_type"],
                    {"road_type": ["motorway", "trunk", "primary", "secondary"]}, 0.001)


def _pois(spark, sf_dir):
    return fx.frame(spark, sf_dir, "fx_pois").withColumn("geom", F.expr(geo.point("lon", "lat")))


def _sources(spark, sf_dir):
    return {"pois": _pois(spark, sf_dir), "zones": fx.zones(spark, sf_dir)}


# --- addresses ------------------------------------------------------------------------------


@query("h1_deg_to_tile", fx.sql(
    f"select id, z, {_sx('z')} as x, {_sy('z')} as y from fx_pois, (values (0), (4), (12), (18)) z(z)", "fx_pois"))
def deg_to_tile(spark, sf_dir):
    df = fx.frame(spark, sf_dir, "fx_pois").withColumn("z", F.explode(F.array(*map(F.lit, (0, 4, 12, 18)))))
    return df.select("id", "z", F.expr(tilemath.tile_x("lon", "z")).alias("x"), F.expr(tilemath.tile_y("lat", "z")).alias("y"))


@query("h2_tile_to_bbox", fx.sql(
    f"select id, z, x, y, round({_left('x')}, 6) as west, round({_top('y + 1')}, 6) as south, round({_left('(x + 1)')}, 6) as east, round({_top('y')}, 6) as north "
    f"from (select id, cast(id % 15 as int) as z, {_sx('(id % 15)')} as x, {_sy('(id % 15)')} as y from fx_pois) t", "fx_pois"))
def tile_to_bbox(spark, sf_dir):
    df = fx.frame(spark, sf_dir, "fx_pois").withColumn("z", F.expr("cast(id % 15 as int)"))
    df = df.withColumns({"x": F.expr(tilemath.tile_x("lon", "z")), "y": F.expr(tilemath.tile_y("lat", "z"))})
    df = df.withColumn("b", F.expr(tilemath.tile_box("z", "x", "y")))
    side = lambda c, name: F.round(f"b.{c}", 6).alias(name)
    return df.select("id", "z", "x", "y", side("x0", "west"), side("y0", "south"), side("x1", "east"), side("y1", "north"))


@query("h3_tile_grid", fx.sql(
    f"select id, cast(6 as int) as z, x, unnest(range(ylo, yhi + 1)) as y from (select *, unnest(range(xlo, xhi + 1)) as x from "
    f"(select id, {_sx('6', 'x0')} as xlo, {_sx('6', 'x1')} as xhi, {_sy('6', 'y1')} as ylo, {_sy('6', 'y0')} as yhi from fx_zones) r) g", "fx_zones"))
def tile_grid(spark, sf_dir):
    """All tiles of zoom 6 in each zone's box."""
    df = fx.frame(spark, sf_dir, "fx_zones").withColumn("box", F.expr("named_struct('x0', x0, 'y0', y0, 'x1', x1, 'y1', y1)"))
    return tiles.tile_grid(df, 6).select("id", "z", "x", "y")


@query("h4_buffered_bbox", fx.sql(
    f"select id, round(gx0, 6) as x0, round(gy0, 6) as y0, round(gx1, 6) as x1, round(gy1, 6) as y1 from ({_GROWN} from (select id, {_TILE_COLUMNS} "
    f"from (select id, 9 as z, {_sx('9')} as x, {_sy('9')} as y from fx_pois) t) b) g", "fx_pois"))
def buffered_bbox(spark, sf_dir):
    df = fx.frame(spark, sf_dir, "fx_pois").withColumns(
        {"x": F.expr(tilemath.tile_x("lon", "9")), "y": F.expr(tilemath.tile_y("lat", "9"))}
    )
    b = geo.let(tilemath.tile_box("9", "x", "y"), tilemath.buffered_box)
    return df.withColumn("b", F.expr(b)).select("id", *[F.round(f"b.{c}", 6).alias(c) for c in ("x0", "y0", "x1", "y1")])


# --- layer preparation ----------------------------------------------------------------------


@query("h5_layer_filters", fx.sql(
    "select id from fx_pois where amenity in ('restaurant', 'bank', 'bench') and lat >= -60 and lat <= 60.5 and shop = 'bakery'", "fx_pois"))
def layer_filters(spark, sf_dir):
    df = fx.frame(spark, sf_dir, "fx_pois")
    wanted = {"amenity": ["restaurant", "bank", "bench"], "lat": {"min": -60, "max": 60.5}, "shop": "bakery", "colour": "red"}
    return df.filter(tiles.layer_filter(df.columns, wanted)).select("id")


@query("h6_zoom_visible", fx.sql(
    "select layer, z, count(*) as features from (select 'pois' as layer, z from fx_pois, (values (0), (7), (8)) z(z) union all "
    "select 'zones', z from fx_zones, (values (0), (7), (8), (10), (12)) z(z)) v group by layer, z", "fx_pois", "fx_zones"))
def zoom_visible(spark, sf_dir):
    zooms = [0, 7, 8, 10, 12, 14]
    parts = [
        tiles.features_by_zoom(tiles.prepare_source(df, layer), layer, zooms).select("layer", "z")
        for layer, df in ((POIS, _pois(spark, sf_dir)), (ZONES, fx.zones(spark, sf_dir)))
    ]
    return parts[0].unionByName(parts[1]).groupBy("layer", "z").agg(F.count(F.lit(1)).alias("features"))


@query("h11_prune_attributes", fx.sql(
    "select id as feature_id, cast(json_object('name', name, 'shop', shop) as varchar) as properties from fx_pois", "fx_pois"))
def prune_attributes(spark, sf_dir):
    layer = tiles.Layer("pois", "fx_pois", 0, 8, "geom", ["name", "shop", "colour"], id_column="id")
    return tiles.prepare_source(_pois(spark, sf_dir), layer).select("feature_id", "properties")


@query("h12_layer_data", fx.sql(
    "select 'pois' as layer, id as feature_id, cast(json_object('name', name, 'amenity', amenity, 'shop', shop) as varchar) as properties, "
    "cast(4096 as int) as extent, cast(2 as int) as version from fx_pois where id % 10 <> 3", "fx_pois"))
def layer_data(spark, sf_dir):
    """Features with their properties; those without geometry are left out."""
    df = _pois(spark, sf_dir).withColumn("geom", F.expr("if(id % 10 = 3, null, geom)"))
    return tiles.prepare_source(df, POIS).select(
        "layer", "feature_id", "properties", F.lit(tilemath.EXTENT).alias("extent"), F.lit(2).alias("version")
    )


@query("h20_prepare_sources", fx.sql(
    "select id as feature_id, round(lon, 6) as lon, round(lat, 6) as lat from fx_pois where amenity in ('restaurant', 'hospital', 'school')", "fx_pois"))
def prepare_sources(spark, sf_dir):
    """A layer delivered in Mercator metres, filtered and brought to degrees."""
    layer = tiles.Layer("pois", "fx_pois", 8, 16, "geom", ["name"], {"amenity": ["restaurant", "hospital", "school"]}, id_column="id")
    metres = _pois(spark, sf_dir).withColumn("geom", F.expr(tilemath.reproject("geom", 4326, 3857)))
    df = tiles.prepare_source(metres, layer, epsg=3857)
    return df.select("feature_id", F.round("box.x0", 6).alias("lon"), F.round("box.y1", 6).alias("lat"))


# --- features of tiles ----------------------------------------------------------------------


@query("h7_tile_features", fx.sql(
    f"select z, x, y, 'pois' as layer, id as feature_id from ({point_tiles('(0), (4), (8)')}) t union all "
    f"select z, x, y, 'zones', id from ({box_tiles('(0), (4), (8)')}) t", "fx_pois", "fx_zones"))
def tile_features(spark, sf_dir):
    df = tiles.tile_features(_sources(spark, sf_dir), [POIS, ZONES], [0, 4, 8])
    return df.select("z", "x", "y", "layer", "feature_id")


_SEGMENTS = (
    "select id, lag(lon) over w as ax, lag(lat) over w as ay, lon as cx, lat as cy from fx_vertices window w as (partition by id order by i)"
)


def _turn(x: str, y: str) -> str:
    return f"sign((cx - ax) * ({y} - ay) - (cy - ay) * ({x} - ax))"


_TURNS = ", ".join(_turn(x, y) for x in ("gx0", "gx1") for y in ("gy0", "gy1"))
_WAY_BOXES = "select id, min(lon) as x0, max(lon) as x1, min(lat) as y0, max(lat) as y1 from fx_vertices group by id"


@query("h7_tile_features_lines", fx.sql(
    f"with segments as ({_SEGMENTS}), boxes as ({_WAY_BOXES}), cand as ({box_tiles('(10)', 'boxes')}) "
    f"select distinct z, x, y, c.id as feature_id from cand c join segments s on s.id = c.id and ax is not null join fx_ways w on w.id = c.id "
    "where highway in ('motorway', 'trunk', 'primary', 'secondary') "
    "and greatest(ax, cx) >= gx0 and least(ax, cx) <= gx1 and greatest(ay, cy) >= gy0 and least(ay, cy) <= gy1 "
    f"and least({_TURNS}) <= 0 and greatest({_TURNS}) >= 0", "fx_vertices", "fx_ways"))
def tile_features_lines(spark, sf_dir):
    """Road lines in the tiles of zoom 10 they really cross."""
    df = tiles.tile_features({"roads": layers.roads(fx.ways(spark, sf_dir))}, [ROADS], [10])
    return df.select("z", "x", "y", "feature_id")


@query("h8_zoom_size_filter", fx.sql(
    f"with lengths as ({way_lengths()}) select kind, z, count(*) as n from ("
    "select 'POLYGON' as kind, z from fx_buildings, (values (7), (9)) z(z) where z > 8 or (x1 - x0) * (y1 - y0) >= 1e-6 union all "
    "select 'LINESTRING', z from lengths, (values (7), (9)) z(z) where z > 8 or planar >= 1e-4 union all "
    "select 'POINT', z from fx_pois, (values (7), (9)) z(z)) v group by kind, z", "fx_buildings", "fx_vertices", "fx_pois"))
def zoom_size_filter(spark, sf_dir):
    shapes = (
        fx.building_ways(spark, sf_dir).select(F.expr(geo.parse_wkt("geometry")).alias("geom"))
        .unionByName(fx.ways(spark, sf_dir).select(F.expr(geo.parse_wkt("geometry")).alias("geom")))
        .unionByName(_pois(spark, sf_dir).select("geom"))
    )
    df = shapes.withColumn("z", F.explode(F.array(F.lit(7), F.lit(9)))).filter(tiles.size_filter())
    return df.groupBy(F.col("geom.kind").alias("kind"), "z").agg(F.count(F.lit(1)).alias("n"))


@query("h9_tile_tolerance", fx.sql(
    "select id, z, round(0.0001::double * pow(2, 14 - z) * 1e6, 6) as tolerance_scaled from (select id, cast(id % 23 as int) as z from fx_pois) t", "fx_pois"))
def tile_tolerance(spark, sf_dir):
    df = fx.frame(spark, sf_dir, "fx_pois").selectExpr("id", "cast(id % 23 as int) as z")
    return df.select("id", "z", F.round(F.expr(tilemath.tile_tolerance("0.0001D", "z")) * 1e6, 6).alias("tolerance_scaled"))


@query("h10_to_tile_coords", fx.sql(
    f"select id, round((lon - tx0) / (tx1 - tx0) * 4096, 4) as tx, round((1 - (lat - ty0) / (ty1 - ty0)) * 4096, 4) as ty, "
    "round((asinh(tan(radians(ty1))) - asinh(tan(radians(lat)))) / (asinh(tan(radians(ty1))) - asinh(tan(radians(ty0)))) * 4096, 4) as my "
    f"from (select *, {_TILE_COLUMNS} from (select *, 6 as z, {_sx('6')} as x, {_sy('6')} as y from fx_pois) a) t", "fx_pois"))
def to_tile_coords(spark, sf_dir):
    """Points in the units of their zoom-6 tile, linear and in Mercator."""
    df = _pois(spark, sf_dir).withColumns({"x": F.expr(tilemath.tile_x("lon", "6")), "y": F.expr(tilemath.tile_y("lat", "6"))})
    df = df.withColumn("b", F.expr(tilemath.tile_box("6", "x", "y")))
    df = df.withColumns({
        "linear": F.expr(tilemath.to_tile_coords("geom", "b")),
        "mercator": F.expr(tilemath.to_tile_coords("geom", "b", "mercator")),
    })
    at = lambda g, c: F.round(F.expr(f"{g}.parts[0][0].{c}"), 4)
    return df.select("id", at("linear", "x").alias("tx"), at("linear", "y").alias("ty"), at("mercator", "y").alias("my"))


_COUNTS = (
    f"select z, x, y, count(*) as feature_count, count(distinct layer) as layers from (select z, x, y, 'pois' as layer from ({point_tiles('(2), (5)')}) t union all "
    f"select z, x, y, 'zones' from ({box_tiles('(2), (5)')}) t) f group by z, x, y"
)


def _low_tiles(spark, sf_dir):
    return tiles.tile_features(_sources(spark, sf_dir), [POIS, ZONES], [2, 5])


@query("h13_tile_geojson", fx.sql(
    f"select z, x, y, feature_count, feature_count as features_in_text, layers > 1 as has_layers, true as parses from ({_COUNTS}) c", "fx_pois", "fx_zones"))
def tile_geojson(spark, sf_dir):
    """Payloads of two zooms, with what can be read back from their text."""
    text = F.col("data").cast("string")
    df = tiles.tile_geojson(_low_tiles(spark, sf_dir))
    return df.select(
        "z", "x", "y", "feature_count",
        F.expr("cast(size(split(cast(data as string), '\"type\":\"Feature\",')) - 1 as bigint)").alias("features_in_text"),
        text.startswith('{"pois"').alias("has_layers"),
        F.get_json_object(text, "$").isNotNull().alias("parses"),
    )


def _decoded(zooms: str) -> str:
    """Layer, id and least tile coordinates of every feature of a tile, as its bytes should hold them."""
    at = lambda lon, lat: (
        f"cast(round(({lon} - tx0) / (tx1 - tx0) * 4096) as int) as tx, cast(round((1 - ({lat} - ty0) / (ty1 - ty0)) * 4096) as int) as ty"
    )
    return (
        f"select z, x, y, 'pois' as layer, id, {at('lon', 'lat')} from ({point_tiles(zooms)}) t union all "
        f"select z, x, y, 'zones', id, {at('x0', 'y1')} from ({box_tiles(zooms)}) t"
    )


def _read_back(df):
    return mvt.read_features(df).select("z", "x", "y", "layer", "id", F.array_min("xs").alias("tx"), F.array_min("ys").alias("ty"))


@query("h14_tile_mvt", fx.sql(_decoded("(2), (5)"), "fx_pois", "fx_zones"))
def tile_mvt(spark, sf_dir):
    """Every feature with its least coordinates, read back from the bytes."""
    return _read_back(tiles.tile_mvt(_low_tiles(spark, sf_dir)))


@query("h14_tile_mvt_parts", fx.sql(
    f"select z, x, y, feature_count from ({_COUNTS}) c", "fx_pois", "fx_zones"))
def tile_mvt_parts(spark, sf_dir):
    """Chunks of a crowded tile end up in one row, whose count is that of the bytes."""
    return tiles.tile_mvt(_low_tiles(spark, sf_dir)).select("z", "x", "y", "feature_count")


@query("h15_single_tile", fx.sql(
    f"select z, x, y, count(*) as feature_count from (select z, x, y from ({point_tiles('(3)')}) t union all select z, x, y from ({box_tiles('(3)')}) t) f "
    "where z = 3 and x = 4 and y = 2 group by z, x, y", "fx_pois", "fx_zones"))
def single_tile(spark, sf_dir):
    df = tiles.single_tile(_sources(spark, sf_dir), [POIS, ZONES], 3, 4, 2)
    return df.select("z", "x", "y", "feature_count")


def _indexed(spark, sf_dir):
    """The layers written along the curve with their boxes, and read back."""
    out = {}
    for name, df in _sources(spark, sf_dir).items():
        path = session.new_path(spark, f"indexed-{name}")
        skipping.write_indexed(df, path, "geom" if name == "pois" else "geometry_wkt", row_group_bytes=1 << 16)
        out[name] = spark.read.parquet(path)
    return out


@query("h15_pruned", CHECKS["h15_single_tile"])
def pruned_tile(spark, sf_dir):
    """One tile of layers laid out for it: the scan leaves out row groups that lie elsewhere."""
    return tiles.single_tile(_indexed(spark, sf_dir), [POIS, ZONES], 3, 4, 2).select("z", "x", "y", "feature_count")


# Every 40th way node moves, every 33rd way goes, every 21st becomes a primary road; points alike.
_MOVED = (
    "moved as (select * replace (case when node_id % 40 = 3 then lat + 0.25 else lat end as lat) from fx_vertices where id % 33 <> 5), "
    "renamed as (select * replace (case when id % 21 = 4 then 'primary' else highway end as highway) from fx_ways), "
    "places as (select * replace (case when id % 4 = 0 then lat + 0.25 else lat end as lat) from fx_pois where id % 6 <> 5)"
)


def _after_changes(sql: str) -> str:
    return sql.replace("fx_vertices", "moved").replace("fx_ways", "renamed").replace("fx_pois", "places")


_ROAD_TILES = _after_changes(
    f"select distinct z, x, y, 'roads' as layer, c.id as feature_id from cand c join segments s on s.id = c.id and ax is not null join fx_ways w on w.id = c.id "
    "where highway in ('motorway', 'trunk', 'primary', 'secondary') "
    "and greatest(ax, cx) >= gx0 and least(ax, cx) <= gx1 and greatest(ay, cy) >= gy0 and least(ay, cy) <= gy1 "
    f"and least({_TURNS}) <= 0 and greatest({_TURNS}) >= 0"
)
CHANGED_TILES = fx.sql(
    f"with {_MOVED}, segments as ({_after_changes(_SEGMENTS)}), boxes as ({_after_changes(_WAY_BOXES)}), cand as ({box_tiles('(9)', 'boxes')}) "
    f"select z, x, y, count(*) as feature_count from ({_ROAD_TILES} union all "
    f"select z, x, y, 'pois', id from ({_after_changes(point_tiles('(4)', f'({STRICT_POI}) is not null'))}) t) f group by z, x, y", "fx_vertices", "fx_ways", "fx_pois")


@query("m1_changed_tiles", CHANGED_TILES)
def changed_tiles(spark, sf_dir):
    """Stored tiles after a change set: nodes move, ways go or change, points move or go."""
    no_relations = spark.createDataFrame([], schemas.RELATION)
    nodes = fx.frame(spark, sf_dir, "fx_vertices").selectExpr(
        "node_id as id", "lat", "lon", "cast(map() as map<string, string>) as tags", "1 as version", "cast(null as timestamp) as timestamp"
    )
    far = 1 << 40  # points are nodes too, beyond the ids of way nodes
    nodes = nodes.unionByName(fx.nodes(spark, sf_dir).withColumn("id", F.col("id") + far))
    data = elements.Elements(nodes, fx.ways(spark, sf_dir), no_relations, None)
    newer = {"version": F.lit(2), "deleted": F.lit(False)}
    place = F.col("id") >= far
    number = F.col("id") - far
    moved = data.nodes.filter((~place & (F.col("id") % 40 == 3)) | (place & (number % 4 == 0))).withColumn("lat", F.col("lat") + 0.25)
    gone = data.nodes.filter(place & (number % 6 == 5)).withColumns({"version": F.lit(3), "deleted": F.lit(True)})
    primary = F.expr("map_concat(map_filter(tags, (k, v) -> k <> 'highway'), map('highway', 'primary'))")
    named = data.ways.filter("id % 21 = 4").withColumn("tags", primary).withColumns(newer)
    removed = data.ways.filter("id % 33 = 5").withColumns({"version": F.lit(3), "deleted": F.lit(True)})
    change_set = {"node": moved.withColumns(newer).unionByName(gone), "way": named.unionByName(removed)}
    shown = [
        tiles.Layer("roads", "roads", 9, 9, "geometry_wkt", ["name"], {"road_type": ["motorway", "trunk", "primary", "secondary"]}),
        tiles.Layer("pois", "pois", 4, 4, "geom", ["name"]),
    ]
    root = session.new_path(spark, "tileset")
    incremental.build_tiles(spark, root, layers.ingest_layers(data), shown, [4, 9], "geojson")
    incremental.refresh_tiles(spark, root, data, change_set, shown, [4, 9], "geojson")
    return parts.read(spark, root, "tiles").select("z", "x", "y", "feature_count")


@query("h16_tileset", fx.sql(
    f"select z, count(*) as tiles_generated, sum(n) as features, cast(pow(4, z) as bigint) as total_tile_specs from ("
    f"select z, x, y, count(*) as n from (select z, x, y from ({point_tiles('(0), (3), (6)')}) t union all "
    f"select z, x, y from ({box_tiles('(0), (3), (6)')}) t) f group by z, x, y) c group by z", "fx_pois", "fx_zones"))
def tileset(spark, sf_dir):
    return tiles.tileset_summary(tiles.tile_features(_sources(spark, sf_dir), [POIS, ZONES], [0, 3, 6]))


@query("h16_tileset_payloads", fx.sql(_decoded("(0), (3)"), "fx_pois", "fx_zones"))
def tileset_payloads(spark, sf_dir):
    """The tileset itself, read back."""
    return _read_back(tiles.tileset(_sources(spark, sf_dir), [POIS, ZONES], [0, 3]))


_AREA = "x between 16 and 39 and y between 20 and 40"


@query("h16_tileset_bbox", fx.sql(
    f"select z, count(*) as tiles_generated, sum(n) as features, cast(24 * 21 as bigint) as total_tile_specs from ("
    f"select z, x, y, count(*) as n from (select z, x, y from ({point_tiles('(6)')}) t union all select z, x, y from ({box_tiles('(6)')}) t) f "
    f"where {_AREA} group by z, x, y) c group by z", "fx_pois", "fx_zones"))
def tileset_bbox(spark, sf_dir):
    """Only the tiles of a box: columns 16-39 and rows 20-40 of zoom 6."""
    box = (-89.0, -43.0, 44.0, 55.0)
    return tiles.tileset_summary(tiles.tile_features(_sources(spark, sf_dir), [POIS, ZONES], [6], box), box)


@query("h16_pruned_bbox", CHECKS["h16_tileset_bbox"])
def pruned_bbox(spark, sf_dir):
    box = (-89.0, -43.0, 44.0, 55.0)
    return tiles.tileset_summary(tiles.tile_features(_indexed(spark, sf_dir), [POIS, ZONES], [6], box), box)


@query("h17_tile_feature_count", fx.sql(
    f"select z, x, y, format, feature_count from ({_COUNTS}) c, (values ('mvt'), ('geojson')) f(format)", "fx_pois", "fx_zones"))
def tile_feature_count(spark, sf_dir):
    """Features counted in the payloads of both formats."""
    features = _low_tiles(spark, sf_dir)
    return tiles.payload_counts(tiles.tile_mvt(features).unionByName(tiles.tile_geojson(features)))


@query("h18_zoom_pyramid", fx.sql(
    f"select id as osm_id, zoom, {SCORE} as importance_score, concat('POINT(', lon, ' ', lat, ')') as geometry_simplified "
    f"from fx_pois, (values (6), (10), (14)) z(zoom) where {WIDE} and coalesce(name, '') <> '' "
    f"and (zoom > 12 or (zoom > 8 and {SCORE} >= 6) or {SCORE} >= 8)", "fx_pois"))
def zoom_pyramid(spark, sf_dir):
    df = tiles.zoom_pyramid(layers.pois(fx.nodes(spark, sf_dir)), [6, 10, 14], points_only=True)
    return df.select("osm_id", "zoom", "importance_score", "geometry_simplified")


@query("h18_zoom_pyramid_lines", fx.sql(
    f"with {WEIGHTS}, ranked as (select *, row_number() over (partition by id order by w desc, i) as best from weights) "
    "select v.id as osm_id, zoom, concat('LINESTRING (', string_agg(concat(lon, ' ', lat), ', ' order by v.i), ')') as geometry_simplified "
    "from fx_ways f join fx_vertices v on v.id = f.id left join ranked r on r.id = v.id and r.i = v.i, (values (1), (5), (9), (13)) z(zoom) "
    "where highway <> 'footway' and (zoom > 12 or (zoom > 8 and (f.id % 4 + 1) * 3 >= 6) or (f.id % 4 + 1) * 3 >= 8) "
    "and (v.i = 0 or v.i = n - 1 or w > 0.001 / pow(2, zoom - 1) or (ring and best <= 2)) group by v.id, zoom", "fx_ways", "fx_vertices"))
def zoom_pyramid_lines(spark, sf_dir):
    """Roads scored by lane count, simplified per zoom from one weighing pass."""
    scored = layers.roads(fx.ways(spark, sf_dir)).withColumn("importance_score", F.expr("cast(lanes as int) * 3"))
    df = tiles.zoom_pyramid(scored, [1, 5, 9, 13])
    return df.select("osm_id", "zoom", "geometry_simplified")


_SCORED = f"select *, {SCORE} as score from ({point_tiles('(0), (2)')}) t"


@query("h19_max_features_per_tile", fx.sql(
    f"select z, x, y, id as feature_id from (select *, row_number() over (partition by z, x, y order by score desc, id) as rn from ({_SCORED}) s) r where rn <= 20", "fx_pois"))
def max_features_per_tile(spark, sf_dir):
    df = tiles.tile_features({"pois": _pois(spark, sf_dir).withColumn("category", F.expr(CATEGORY))},
                             [tiles.Layer("pois", "fx_pois", 0, 8, "geom", ["category"], id_column="id")], [0, 2])
    score = layers.classify.importance_score(F.get_json_object("properties", "$.category"))
    return tiles.limit_features(df, 20, score).select("z", "x", "y", "feature_id")


@query("a11_write_tiles", fx.sql(
    f"select z, count(*) as tiles, sum(feature_count) as features from ({_COUNTS}) c group by z", "fx_pois", "fx_zones"))
def write_tiles(spark, sf_dir):
    path = session.new_path(spark, "tiles")
    sinks.write_tiles(tiles.tile_mvt(_low_tiles(spark, sf_dir)), path)
    stored = spark.read.parquet(path)
    return stored.groupBy("z").agg(F.count(F.lit(1)).alias("tiles"), F.sum("feature_count").alias("features"))


@query("h22_tile_catalog", fx.sql(
    f"select concat(z, '/', x, '/', y) as tile_id, z as zoom_level, x as tile_x, y as tile_y, 'geojson' as format, feature_count, true as sized, "
    f"round({_left('x')}, 6) as west from ({_COUNTS}) c", "fx_pois", "fx_zones"))
def tile_catalog(spark, sf_dir):
    df = tiles.tile_catalog(tiles.tile_geojson(_low_tiles(spark, sf_dir)))
    path = session.new_path(spark, "catalog")
    sinks.append_rows(df, schemas.TILE_META, path)
    box = geo.let(geo.parse_wkt("bbox"), geo.bbox)
    return spark.read.schema(schemas.TILE_META).parquet(path).select(
        "tile_id", "zoom_level", "tile_x", "tile_y", "format", "feature_count",
        (F.col("size_bytes") > 0).alias("sized"), F.round(F.expr(f"{box}.x0"), 6).alias("west"),
    )


# --- catalog --------------------------------------------------------------------------------

_TILES = (
    "select z, x, y, f.format, count(*) as feature_count, count(*) * 64 as size_bytes from ("
    f"select z, {_sx('z')} as x, {_sy('z')} as y from fx_pois, (values (0), (4), (8), (12)) z(z)) t, "
    "(values (0, 'mvt'), (0, 'geojson'), (1, 'pbf'), (2, 'geojson')) f(k, format) where x % 3 = f.k group by z, x, y, f.format"
)


def catalog_rows(spark, sf_dir):
    """Catalog rows of the point tiles, in up to two formats per tile."""
    df = fx.frame(spark, sf_dir, "fx_pois").withColumn("z", F.explode(F.array(*map(F.lit, (0, 4, 8, 12)))))
    df = df.select("z", F.expr(tilemath.tile_x("lon", "z")).alias("x"), F.expr(tilemath.tile_y("lat", "z")).alias("y"))
    counted = df.groupBy("z", "x", "y").agg(F.count(F.lit(1)).alias("feature_count"))
    formats = F.expr("explode(case x % 3 when 0 then array('mvt', 'geojson') when 1 then array('pbf') else array('geojson') end)")
    return counted.select("z", "x", "y", formats.alias("format"), "feature_count", (F.col("feature_count") * 64).alias("size_bytes"))


@query("j1_catalog_page", fx.sql(
    f"with tiles as ({_TILES}) select z, x, y, format, feature_count, size_bytes, (select count(*) from tiles) as total_tiles, "
    "(select count(*) from tiles where z = 4) as filtered_tiles, least(100, (select count(*) from tiles where z = 4)) as returned_tiles "
    "from tiles where z = 4 order by z, x, y, format limit 100", "fx_pois"))
def catalog_page(spark, sf_dir):
    return catalog.catalog_page(catalog_rows(spark, sf_dir), 4, 100)


@query("j2_catalog_stats", fx.sql(
    f"with tiles as ({_TILES}) select case when grouping(z) = 0 then 'zoom' when grouping(format) = 0 then 'format' else 'total' end as level, "
    "z, format, count(*) as tiles, sum(size_bytes) as size_bytes, round(sum(size_bytes) / 1048576.0, 2) as size_mb "
    "from tiles group by grouping sets ((z), (format), ())", "fx_pois"))
def catalog_stats(spark, sf_dir):
    return catalog.catalog_stats(catalog_rows(spark, sf_dir))


@query("j3_catalog_zoom", fx.sql(
    f"with tiles as ({_TILES}) select z, x, y, format, concat('/tiles/', z, '/', x, '/', y, '.', format) as url from tiles where z = 8", "fx_pois"))
def catalog_zoom(spark, sf_dir):
    return catalog.catalog_zoom(catalog_rows(spark, sf_dir), 8)


_ASKED = f"select distinct z, x, y from (select 4 as z, ({_sx('4')} + 1) % 16 as x, {_sy('4')} as y from fx_pois) q"


@query("j4_catalog_lookup", fx.sql(
    f"with tiles as ({_TILES}), asked as ({_ASKED}) select a.z, a.x, a.y, b.format, b.size_bytes, b.format is not null as found from asked a left join ("
    "select * from (select *, row_number() over (partition by z, x, y order by case format when 'mvt' then 1 when 'pbf' then 2 else 3 end) as rn from tiles) r where rn = 1) b "
    "on a.z = b.z and a.x = b.x and a.y = b.y", "fx_pois"))
def catalog_lookup(spark, sf_dir):
    asked = fx.frame(spark, sf_dir, "fx_pois").select(
        F.lit(4).alias("z"), F.expr(f"({tilemath.tile_x('lon', '4')} + 1) % 16").alias("x"), F.expr(tilemath.tile_y("lat", "4")).alias("y")
    )
    return catalog.catalog_lookup(catalog_rows(spark, sf_dir), asked)


@query("j4_catalog_lookup_mvt", fx.sql(
    f"with tiles as ({_TILES}), asked as ({_ASKED}) select a.z, a.x, a.y, b.format, b.size_bytes, b.format is not null as found from asked a left join "
    "(select * from tiles where format in ('mvt', 'pbf')) b on a.z = b.z and a.x = b.x and a.y = b.y", "fx_pois"))
def catalog_lookup_mvt(spark, sf_dir):
    """A request for mvt also accepts pbf, but not geojson."""
    asked = fx.frame(spark, sf_dir, "fx_pois").select(
        F.lit(4).alias("z"), F.expr(f"({tilemath.tile_x('lon', '4')} + 1) % 16").alias("x"), F.expr(tilemath.tile_y("lat", "4")).alias("y")
    )
    return catalog.catalog_lookup(catalog_rows(spark, sf_dir), asked, "mvt")


# --- multi-part geometries ------------------------------------------------------------------

_DX = "case when x1 > 140 then -15 else 15 end"
_TWINS = (
    f"twins as (select id, x0, y0, x1, y1 from fx_zones union all select id, x0 + {_DX}, y0, x1 + {_DX}, y1 from fx_zones)"
)


def _twins(spark, sf_dir):
    """Every zone together with a copy of it 15 degrees aside, as one MULTIPOLYGON."""
    corner = lambda x, y: f"{x}, ' ', {y}"
    ring = lambda a, b: f"concat('((', {', \', \', '.join([corner(a, 'y0'), corner(b, 'y0'), corner(b, 'y1'), corner(a, 'y1'), corner(a, 'y0')])}, '))')"
    text = f"concat('MULTIPOLYGON (', {ring('x0', 'x1')}, ', ', {ring(f'(x0 + {_DX})', f'(x1 + {_DX})')}, ')')"
    return fx.frame(spark, sf_dir, "fx_zones").selectExpr("id", f"{text} as geometry_wkt")


@query("f0_multi", fx.sql("select id, cast(2 as bigint) as parts, true as same from fx_zones", "fx_zones"))
def multi_text(spark, sf_dir):
    """Read, written and read again."""
    df = geo.once(_twins(spark, sf_dir), g=geo.parse_wkt("geometry_wkt"))
    again = geo.once(df.withColumn("w", F.expr(geo.to_wkt("g"))), h=geo.parse_wkt("w"))
    return again.select("id", F.expr("cast(size(g.parts) as bigint)").alias("parts"), F.expr("g = h").alias("same"))


@query("f6_multi", fx.sql("select id, round(2 * (x1 - x0) * (y1 - y0), 6) as area, true as valid from fx_zones", "fx_zones"))
def multi_area(spark, sf_dir):
    df = _twins(spark, sf_dir)
    return df.select("id", F.round(F.expr(geo.wkt_area("geometry_wkt")), 6).alias("area"), F.expr(geo.wkt_is_valid("geometry_wkt")).alias("valid"))


@query("g2_multi", fx.sql(
    f"with {_TWINS} select distinct p.id as poi_id, t.id as zone_id from fx_pois p join twins t on lon between x0 and x1 and lat between y0 and y1",
    "fx_pois", "fx_zones"))
def multi_join(spark, sf_dir):
    """Points against two-part zones, each pair once."""
    points = fx.frame(spark, sf_dir, "fx_pois").selectExpr("id as poi_id", f"{geo.point_wkt('lon', 'lat')} as geometry_wkt")
    zones = _twins(spark, sf_dir).withColumnRenamed("id", "zone_id")
    return joins.spatial_join(points, zones).select("poi_id", "zone_id")


@query("f3_multi", fx.sql(
    f"with {_TWINS}, hits as (select distinct a.id as left_id, b.id as right_id from twins a join twins b on a.id < b.id "
    "and a.x0 <= b.x1 and b.x0 <= a.x1 and a.y0 <= b.y1 and b.y0 <= a.y1) select * from hits", "fx_zones"))
def multi_intersects(spark, sf_dir):
    zones = _twins(spark, sf_dir)
    pairs = joins.spatial_join(zones.withColumnRenamed("id", "left_id"), zones.withColumnRenamed("id", "right_id"))
    return pairs.filter("left_id < right_id").select("left_id", "right_id")


@query("h7_multi", fx.sql(
    f"with {_TWINS} select distinct z, x, y, id as feature_id from ({box_tiles('(4)', 'twins')}) t", "fx_zones"))
def multi_tiles(spark, sf_dir):
    """The tiles of both parts, each once."""
    layer = tiles.Layer("twins", "fx_zones", 0, 8, "geometry_wkt", id_column="id")
    return tiles.tile_features({"twins": _twins(spark, sf_dir)}, [layer], [4]).select("z", "x", "y", "feature_id")


@query("h20_rejected", fx.sql(
    "select case when id % 4 = 0 then 'empty geometry' when id % 4 = 1 then 'no geometry' else 'unreadable geometry' end as reject_reason, count(*) as n "
    "from fx_zones where id % 4 < 3 group by 1", "fx_zones"))
def rejected_sources(spark, sf_dir):
    """What a layer cannot use is reported with its reason."""
    broken = F.expr("CASE id % 4 WHEN 0 THEN 'POLYGON EMPTY' WHEN 1 THEN '' WHEN 2 THEN 'POLYGON ((1 1' ELSE geometry_wkt END")
    layer = tiles.Layer("twins", "fx_zones", 0, 8, "geometry_wkt", id_column="id")
    out = tiles.rejected(_twins(spark, sf_dir).withColumn("geometry_wkt", broken), layer)
    return out.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


@query("c6_validate_tileset", fx.sql(
    "select 'layer lakes has no source' as warning union all "
    "select 'layer pois has an empty source' from fx_pois having count(*) filter (amenity = 'nowhere') = 0", "fx_pois"))
def validate_tileset(spark, sf_dir):
    """Warnings about layers without a source or without rows."""
    nowhere = _pois(spark, sf_dir).filter("amenity = 'nowhere'")
    sources = {**_sources(spark, sf_dir), "pois": nowhere}
    warnings = tiles.validate_tileset(sources, [POIS, ZONES, tiles.Layer("lakes", "l", 0, 5)], [0, 4])
    return spark.createDataFrame([(w,) for w in sorted(warnings)], "warning string")
