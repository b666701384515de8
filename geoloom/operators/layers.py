"""Layers: points of interest, roads, buildings and boundaries."""

from __future__ import annotations

import logging
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom import rules, schemas, session
from geoloom.functions import classify
from geoloom.functions import geometry as geo
from geoloom.functions import tilemath
from geoloom.sources import elements, sinks

log = logging.getLogger(__name__)


def tag(key: str):
    return F.col("tags")[key]


# --- geometry of ways -----------------------------------------------------------------------


def way_vertices(ways: DataFrame) -> DataFrame:
    """One row per node reference: way_id, shape, pos, ref.

    ``shape`` is a hash of the reference list, so that (way_id, shape) stands for one list even
    where a way id occurs in many rows.
    """
    return ways.select(
        F.col("id").alias("way_id"),
        F.xxhash64("nodes").alias("shape"),
        F.posexplode("nodes").alias("pos", "ref"),
    )


def node_lookup_join(vertices: DataFrame, nodes: DataFrame, how: str = "inner") -> DataFrame:
    """Coordinates for every reference.

    ``nodes`` is unique by id, so a reference used by very many ways repeats on one side only
    and adaptive skew handling can split it.
    """
    coords = nodes.select(F.col("id").alias("ref"), "lon", "lat").filter(
        "lon IS NOT NULL AND lat IS NOT NULL"
    )
    return vertices.join(session.shuffled(coords), "ref", how)


def way_points(ways: DataFrame, nodes: DataFrame, missing_nodes: str = "skip") -> DataFrame:
    """``id, shape, points``: coordinates in reference order, at least two of them.

    A group is one reference list: copies of a row collapse into the same set of vertices
    before the shuffle, so no group outgrows the longest ``nodes`` array of the input.
    ``missing_nodes`` says whether unresolved references are skipped or drop the way.
    """
    if missing_nodes not in ("skip", "drop"):
        raise ValueError(f"missing_nodes must be 'skip' or 'drop', not {missing_nodes!r}")
    how = "inner" if missing_nodes == "skip" else "left"
    found = node_lookup_join(way_vertices(ways), nodes, how)
    vertex = F.struct("pos", F.col("lon").alias("x"), F.col("lat").alias("y"))
    grouped = found.groupBy(F.col("way_id").alias("id"), "shape").agg(
        F.array_sort(F.collect_set(vertex)).alias("vs")
    )
    if missing_nodes == "drop":
        grouped = grouped.filter("forall(vs, v -> v.x IS NOT NULL)")
    points = F.expr("transform(vs, v -> named_struct('x', v.x, 'y', v.y))")
    return grouped.filter(F.size("vs") >= 2).select("id", "shape", points.alias("points"))


def _with_shapes(ways: DataFrame, shapes: DataFrame) -> DataFrame:
    """Join way rows back to what was built from their reference list."""
    marked = ways.withColumn("shape", F.xxhash64("nodes"))
    return marked.join(session.shuffled(shapes), ["id", "shape"]).drop("shape")


def with_lines(ways: DataFrame, nodes: DataFrame, missing_nodes: str = "skip") -> DataFrame:
    """Ways joined back to their line geometry."""
    lines = way_points(ways, nodes, missing_nodes).select(
        "id", "shape", F.expr(geo.line("points")).alias("geom")
    )
    return _with_shapes(ways, lines)


# --- strict layers of the ingest path -------------------------------------------------------


def poi_nodes(nodes: DataFrame) -> DataFrame:
    """Strict points of interest: first of amenity, shop, tourism with a listed value."""
    kind = classify.strict_poi_type(tag("amenity"), tag("shop"), tag("tourism"))
    return (
        elements.tagged(nodes)
        .filter("lat IS NOT NULL AND lon IS NOT NULL")
        .withColumn("poi_type", kind)
        .filter("poi_type IS NOT NULL")
        .select(
            F.col("id").alias("osm_id"),
            "poi_type",
            F.coalesce(tag("name"), F.lit("")).alias("name"),
            "tags",
            "version",
            "timestamp",
            F.expr(geo.point("lon", "lat")).alias("geom"),
        )
    )


def road_ways(ways: DataFrame) -> DataFrame:
    text = lambda key: F.coalesce(tag(key), F.lit("")).alias(key)
    return ways.filter(tag("highway").isin(rules.ROAD_TYPES)).select(
        "id",
        "nodes",
        tag("highway").alias("road_type"),
        text("name"),
        text("maxspeed"),
        text("surface"),
        "tags",
        "version",
        "timestamp",
    )


def road_lines(ways: DataFrame, nodes: DataFrame, missing_nodes: str = "skip") -> DataFrame:
    """Road ways with the line through their nodes."""
    lined = with_lines(road_ways(ways), nodes, missing_nodes)
    return (
        lined.withColumn("geometry_wkt", F.expr(geo.to_wkt("geom")))
        .withColumnRenamed("id", "osm_id")
        .drop("nodes")
    )


def building_ways(ways: DataFrame, nodes: DataFrame, missing_nodes: str = "skip") -> DataFrame:
    """Closed building ways as polygons."""
    listed = ways.filter(tag("building").isin(rules.BUILDING_WAY_TYPES))
    rings = way_points(listed, nodes, missing_nodes).filter(
        "size(points) >= 4 AND points[0] = element_at(points, -1)"
    )
    shaped = _with_shapes(
        listed, rings.select("id", "shape", F.expr(geo.polygon("points")).alias("geom"))
    )
    return shaped.select(
        F.col("id").alias("osm_id"),
        tag("building").alias("building_type"),
        F.coalesce(tag("name"), F.lit("")).alias("name"),
        "tags",
        "version",
        "timestamp",
        "geom",
        F.expr(geo.to_wkt("geom")).alias("geometry_wkt"),
    )


def member_join(relations: DataFrame, lines: DataFrame) -> DataFrame:
    """Way members of each relation with their line.

    Columns relation_id, shape (hash of the members list), seq, role, way_id, points.
    """
    members = relations.select(
        F.col("id").alias("relation_id"),
        F.xxhash64("members").alias("shape"),
        F.posexplode("members").alias("seq", "m"),
    ).filter("m.type IN ('way', 'w')")
    return members.select(
        "relation_id", "shape", "seq", F.col("m.role").alias("role"), F.col("m.ref").alias("way_id")
    ).join(session.shuffled(lines.select(F.col("id").alias("way_id"), "points")), "way_id")


def _stitch(lines: list) -> list:
    """Rings and loose lines of lines that share end points: (places of its lines, ring or None).

    A chain that comes back to one of its own ends closes a ring there, so rings that touch in a
    point come out apart; a line that leads nowhere is taken back, so a spur opens no ring.
    """
    out, by_end, used = [], {}, [False] * len(lines)
    for i, pts in enumerate(lines):
        by_end.setdefault(pts[0], []).append(i)
        by_end.setdefault(pts[-1], []).append(i)
    for start in range(len(lines)):
        if used[start]:
            continue
        used[start] = True
        chain, ends = [(start, lines[start])], [lines[start][0]]  # ends[k] is where line k begins
        at = {ends[0]: 0}
        while chain:
            end = chain[-1][1][-1]
            if end in at:
                k = at[end]
                ring = [end] + [p for _, pts in chain[k:] for p in pts[1:]]
                out.append(([i for i, _ in chain[k:]], ring if len(ring) >= 4 else None))
                for e in ends[k:]:
                    del at[e]
                del chain[k:], ends[k:]
                continue
            candidates = by_end[end]
            while candidates and used[candidates[-1]]:
                candidates.pop()
            if candidates:
                i = candidates.pop()
                used[i] = True
                at[end] = len(chain)
                ends.append(end)
                chain.append((i, lines[i] if lines[i][0] == end else lines[i][::-1]))
            else:
                out.append(([chain.pop()[0]], None))
                del at[ends.pop()]
    return out


_STITCHED = T.ArrayType(T.StructType([
    T.StructField("seqs", T.ArrayType(T.IntegerType())),
    T.StructField("ring", T.ArrayType(schemas.POINT)),
]))


@F.pandas_udf(_STITCHED)
def stitch_rings(lines: pd.Series) -> pd.Series:
    """Per chain the places of its members and its closed ring, NULL for a member in no ring."""

    def one(members):
        found = _stitch([[(p["x"], p["y"]) for p in m["points"]] for m in members])
        return [
            {"seqs": [int(members[i]["seq"]) for i in at], "ring": ring and [{"x": x, "y": y} for x, y in ring]}
            for at, ring in found
        ]

    return pd.Series([one(m) for m in lines], dtype=object)


def _boundary_rings(admin: DataFrame, ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """relation_id, shape and the stitched ``outer`` and ``inner`` members of administrative relations.

    A group is one members list (copies of a relation collapse into it), so it is as bounded as
    that list.
    """
    wanted = admin.select(F.explode("members").alias("m")).filter("m.type IN ('way', 'w')")
    used = ways.join(session.shuffled(wanted.select(F.col("m.ref").alias("id"))), "id", "left_semi")
    members = member_join(admin, way_points(used, nodes))
    side = F.when(F.col("role") == "inner", "inner").otherwise("outer")
    chains = members.groupBy("relation_id", "shape").agg(
        *[
            F.array_sort(
                F.collect_set(F.when(side == s, F.struct("seq", "points")))
            ).alias(s)
            for s in ("outer", "inner")
        ]
    )
    return chains.select(
        "relation_id", "shape", stitch_rings("outer").alias("outer"), stitch_rings("inner").alias("inner")
    )


def _closed(side: str) -> str:
    return f"transform(filter({side}, c -> c.ring IS NOT NULL), c -> c.ring)"


def _holds(shell: str, hole: str) -> str:
    return geo.let(geo.polygon(shell), lambda s: geo.let(geo.polygon(hole), lambda h: geo.within(h, s)))


def admin_boundaries(relations: DataFrame, ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """Administrative relations as polygons, one row per closed outer ring.

    Inner rings stay with the outer ring that holds them; see ``rejected_boundaries`` for the rest.
    """
    admin = relations.filter(tag("boundary") == "administrative")
    shells = _boundary_rings(admin, ways, nodes).select(
        "relation_id", "shape", F.posexplode(F.expr(_closed("outer"))).alias("ring_no", "shell"),
        F.expr(_closed("inner")).alias("holes"),
    )
    geom = (
        "named_struct('kind', 'POLYGON', 'parts', "
        f"concat(array(shell), filter(holes, h -> {_holds('shell', 'h')})))"
    )
    polygons = shells.select("relation_id", "shape", "ring_no", F.expr(geom).alias("geom"))
    names = admin.select(
        F.col("id").alias("relation_id"),
        F.xxhash64("members").alias("shape"),
        F.coalesce(tag("name"), F.lit("")).alias("name"),
        tag("admin_level").alias("admin_level"),
        "tags",
    )
    joined = names.join(session.shuffled(polygons), ["relation_id", "shape"]).drop("shape")
    return joined.withColumnRenamed("relation_id", "osm_id")


def rejected_boundaries(relations: DataFrame, ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """Way members of administrative relations that reach no polygon: osm_id, seq, way_id, role, reason.

    ``missing way``: no line with two points is known; ``unclosed``: its chain closes no ring;
    ``hole without shell``: its inner ring lies in no outer ring of the relation.  Copies of a
    relation give one row.
    """
    admin = relations.filter(tag("boundary") == "administrative")
    rings = _boundary_rings(admin, ways, nodes)
    shells = _closed("outer")
    judged = [
        "transform(outer, c -> named_struct('seqs', c.seqs, 'reason', CASE WHEN c.ring IS NULL THEN 'unclosed' END))",
        f"transform(inner, c -> named_struct('seqs', c.seqs, 'reason', CASE WHEN c.ring IS NULL THEN 'unclosed' "
        f"WHEN NOT exists({shells}, s -> {_holds('s', 'c.ring')}) THEN 'hole without shell' END))",
    ]
    fate = rings.select(
        "relation_id", "shape", F.explode(F.expr(f"concat({', '.join(judged)})")).alias("c")
    ).select("relation_id", "shape", F.explode("c.seqs").alias("seq"), F.col("c.reason").alias("reason"))
    members = admin.select(
        F.col("id").alias("relation_id"), F.xxhash64("members").alias("shape"), F.posexplode("members").alias("seq", "m")
    ).filter("m.type IN ('way', 'w')")
    members = members.select(
        "relation_id", "shape", "seq", F.col("m.ref").alias("way_id"), F.col("m.role").alias("role")
    ).distinct()
    known = fate.withColumn("known", F.lit(True))
    joined = members.join(session.shuffled(known), ["relation_id", "shape", "seq"], "left")
    return joined.select(
        F.col("relation_id").alias("osm_id"), "seq", "way_id", "role",
        F.when(F.col("known").isNull(), "missing way").otherwise(F.col("reason")).alias("reason"),
    ).filter("reason IS NOT NULL")


def ingest_layers(data: elements.Elements) -> dict[str, DataFrame]:
    """All strict layers over the same element frames; writers leave out the empty ones."""
    return {
        "pois": poi_nodes(data.nodes),
        "roads": road_lines(data.ways, data.nodes),
        "buildings": building_ways(data.ways, data.nodes),
        "admin_boundaries": admin_boundaries(data.relations, data.ways, data.nodes),
    }


# --- wide layers of the processing path -----------------------------------------------------


def pois(nodes: DataFrame) -> DataFrame:
    """Named points with a listed amenity, a listed shop or any tourism tag."""
    keys = ("name", "amenity", "shop", "tourism", "phone", "website", "opening_hours")
    amenity, shop, tourism = (F.col(k) for k in ("amenity", "shop", "tourism"))
    wide = nodes.filter(
        tag("amenity").isin(rules.POI_AMENITIES)
        | tag("shop").isin(rules.POI_SHOPS)
        | tag("tourism").isNotNull()
    ).filter(classify.named(tag("name")))
    return wide.select(
        F.col("id").alias("osm_id"),
        "lat",
        "lon",
        *[tag(k).alias(k) for k in keys],
        "timestamp",
    ).withColumns(
        {
            "geometry_wkt": F.expr(geo.point_wkt("lon", "lat")),
            "poi_category": classify.poi_category(amenity, shop, tourism),
            "poi_type": classify.poi_type(amenity, shop, tourism),
            "importance_score": classify.importance_score(
                classify.poi_category(amenity, shop, tourism)
            ),
        }
    )


def _measure(kind: str, measure: str) -> str:
    choices = {
        ("length", "sphere"): geo.length_m,
        ("length", "planar"): geo.length,
        ("area", "sphere"): geo.area_m2,
        ("area", "planar"): geo.area,
    }
    if (kind, measure) not in choices:
        raise ValueError(f"measure must be 'sphere' or 'planar', not {measure!r}")
    return geo.let(geo.parse_wkt("geometry_wkt"), choices[kind, measure])


def roads(ways: DataFrame, measure: str = "sphere") -> DataFrame:
    """Road layer from ways that carry their WKT geometry.

    ``measure='planar'`` gives lengths in coordinate units instead of metres.
    """
    return (
        ways.filter(tag("highway").isin(rules.ROAD_TYPES))
        .select(
            F.col("id").alias("osm_id"),
            tag("highway").alias("road_type"),
            *[tag(k).alias(k) for k in ("name", "maxspeed", "surface", "lanes")],
            F.col("geometry").alias("geometry_wkt"),
            "timestamp",
        )
        .withColumn("length_meters", F.expr(_measure("length", measure)))
        .withColumn("road_class", classify.road_class(F.col("road_type")))
    )


def buildings(ways: DataFrame, measure: str = "sphere") -> DataFrame:
    """Building layer from ways that carry their WKT geometry."""
    chosen = (
        ways.filter(tag("building").isNotNull() & (tag("building") != "no"))
        .select(
            F.col("id").alias("osm_id"),
            tag("building").alias("building_type"),
            tag("name").alias("name"),
            tag("addr:housenumber").alias("house_number"),
            tag("addr:street").alias("street"),
            tag("addr:city").alias("city"),
            tag("addr:postcode").alias("postcode"),
            tag("height").alias("height"),
            tag("levels").alias("levels"),
            F.col("geometry").alias("geometry_wkt"),
            "timestamp",
        )
    )
    return (
        geo.once(chosen, area_sqm=_measure("area", measure))
        .filter(classify.large_enough(F.col("area_sqm")))
        .withColumn("building_class", classify.building_class(F.col("building_type")))
        .withColumn("height_meters", classify.height_meters(F.col("height")))
        .withColumn("num_levels", classify.num_levels(F.col("levels")))
        .withColumn(
            "estimated_height",
            classify.estimated_height(F.col("height_meters"), F.col("num_levels")),
        )
    )


def spatial_partition(
    df: DataFrame,
    geometry_column: str = "geometry_wkt",
    zoom: int = 10,
    partitions: int | None = None,
    id_column: str | None = None,
) -> DataFrame:
    """Range-partition rows along the Morton curve of the tile their first vertex lies in.

    Row groups then cover small areas, and range sampling keeps partitions even where the
    data is dense.  A tie-break on the geometry text and the id (``id_column``, by default the
    column ``id`` or ``osm_id``) splits cells, equal geometries and rows without a geometry.
    Only the first coordinate is read, because sampling evaluates the key twice; derive
    geometry columns after this step.
    """
    first = lambda i: (
        rf"try_cast(regexp_extract(`{geometry_column}`, r'\([\s(]*([^\s,()]+)\s+([^\s,()]+)', {i}) AS DOUBLE)"
    )
    z = str(zoom)
    address = f"named_struct('x', {tilemath.tile_x(first(1), z)}, 'y', {tilemath.tile_y(first(2), z)})"
    cell = geo.let(address, lambda t: tilemath.morton(f"{t}.x", f"{t}.y", zoom))
    named = id_column or next((c for c in ("id", "osm_id") if c in df.columns), None)
    order = [F.expr(cell), F.xxhash64(geometry_column), *([F.xxhash64(named)] if named else [])]
    ranged = (
        df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    )
    return ranged.sortWithinPartitions(*order)


LAYERS = {"roads": ("ways", roads), "pois": ("nodes", pois), "buildings": ("ways", buildings)}


def process_layers(
    spark: SparkSession, input_path: str, output_path: str, feature_types: list[str] | None = None
) -> DataFrame:
    """Build and write the chosen layers: feature_type, record_count, output_path."""
    results = []
    for name in feature_types or list(LAYERS):
        if name not in LAYERS:
            log.warning("no layer is called %s", name)
            continue
        element, build = LAYERS[name]
        source = elements.scan(spark, input_path, element)
        if name == "roads":
            # Filters move below the shuffle, measures stay above it.
            source = spatial_partition(source, "geometry")
        target = f"{output_path}/{name}"
        results.append((name, sinks.write_layer(build(source), target), target))
    return spark.createDataFrame(
        results, "feature_type string, record_count long, output_path string"
    )


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Rows per layer without writing them."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("record_count")).select(
            F.lit(name).alias("feature_type"), "record_count"
        )
        for name, df in layers.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def register_views(layers: dict[str, DataFrame], prefix: str = "") -> None:
    """Offer the layers to ad-hoc SQL."""
    for name, df in layers.items():
        df.createOrReplaceTempView(prefix + name)


