"""Change sets carried through to stored tiles: only what depends on a change is made anew.

Elements depend on one another by reference: ways on nodes, relations on nodes, ways and relations. From the
changed elements the closure along the reversed references gives all whose geometry may have changed. Their
features are built again, taken out of the tiles they were in and put into those they are in now. Only these
tiles are encoded, and only the partitions that hold them are rewritten.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom import session
from geoloom.operators import changes, layers, tiles
from geoloom.sources import elements, parts

#: Layers that the elements of a kind are features of.
FEATURES = {"node": ["pois"], "way": ["roads", "buildings"], "relation": ["admin_boundaries"]}
#: Tiles are stored by blocks: tiles of this zoom and those above it are one partition each zoom.
BLOCK_ZOOM = 3
TILE = ["z", "x", "y"]


def reference_index(ways: DataFrame, relations: DataFrame) -> DataFrame:
    """ref_type, ref, type, id: which element (type, id) refers to which other one. Distinct."""
    of_ways = ways.select(
        F.lit("node").alias("ref_type"), F.explode("nodes").alias("ref"), F.lit("way").alias("type"), "id"
    )
    short = F.when(F.col("m.type").isin("n", "w", "r"), F.expr("element_at(map('n', 'node', 'w', 'way', 'r', 'relation'), m.type)"))
    of_relations = relations.select("id", F.explode("members").alias("m")).select(
        F.coalesce(short, F.col("m.type")).alias("ref_type"), F.col("m.ref").alias("ref"), F.lit("relation").alias("type"), "id"
    )
    return of_ways.unionByName(of_relations).distinct()


def _stored(df: DataFrame, name: str, scratch: list[str]) -> DataFrame:
    path = session.new_path(df.sparkSession, name)
    df.write.parquet(path)
    scratch.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dirty_elements(index: DataFrame, changed: DataFrame, scratch: list[str] | None = None) -> DataFrame:
    """type, id of the changed elements and of all that depend on them.

    One round takes in the users of what the round before found: ways of nodes, relations of both, then
    relations of relations, until there are no new ones, so as many rounds as relations are nested, and two.
    """
    scratch = [] if scratch is None else scratch
    found = last = _stored(changed.select("type", "id").distinct(), "dirty", scratch)
    while True:
        users = index.join(last.select(F.col("type").alias("ref_type"), F.col("id").alias("ref")), ["ref_type", "ref"])
        last = _stored(users.select("type", "id").distinct().join(found, ["type", "id"], "left_anti"), "dirty", scratch)
        if last.isEmpty():
            return found
        found = found.unionByName(last)


def apply_change_set(data: elements.Elements, change_set: dict[str, DataFrame]) -> elements.Elements:
    """The elements after the changes (``node``, ``way``, ``relation``: rows with ``deleted``)."""
    held = {"node": data.nodes, "way": data.ways, "relation": data.relations}
    for kind, rows in change_set.items():
        held[kind] = changes.apply_changes(held[kind], rows)
    return elements.Elements(held["node"], held["way"], held["relation"], data.metadata)


def changed_elements(change_set: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [df.select(F.lit(kind).alias("type"), "id") for kind, df in change_set.items()])


def dirty_layers(data: elements.Elements, dirty: DataFrame) -> dict[str, DataFrame]:
    """The strict layers, of the dirty elements alone. Clean nodes and ways still lend their coordinates."""
    of = lambda df, kind: df.join(dirty.filter(F.col("type") == kind).select("id"), "id", "left_semi")
    ways = of(data.ways, "way")
    return {
        "pois": layers.poi_nodes(of(data.nodes, "node")),
        "roads": layers.road_lines(ways, data.nodes),
        "buildings": layers.building_ways(ways, data.nodes),
        "admin_boundaries": layers.admin_boundaries(of(data.relations, "relation"), data.ways, data.nodes),
    }


def dirty_features(dirty: DataFrame) -> DataFrame:
    """layer and feature_id of what the dirty elements are, or were, features of."""
    names = F.expr("CASE type " + " ".join(f"WHEN '{k}' THEN array({', '.join(map(repr, v))})" for k, v in FEATURES.items()) + " END")
    return dirty.select(F.explode(names).alias("layer"), F.col("id").alias("feature_id"))


def _part():
    shift = f"greatest(0, z - {BLOCK_ZOOM})"
    return F.expr(f"concat_ws('-', z, shiftright(x, {shift}), shiftright(y, {shift}))").alias(parts.PART)


def build_tiles(
    spark: SparkSession, root: str, sources: dict[str, DataFrame], tile_layers: list[tiles.Layer], zooms: list[int], output_format: str = "mvt"
) -> None:
    """Store the features of all tiles, and the tiles."""
    shown = [layer for layer in tile_layers if layer.name in sources]
    features = parts.stage(tiles.tile_features(sources, shown, zooms).withColumn(parts.PART, _part()), root, "features")
    payloads = tiles.ENCODERS[output_format](parts.staged_rows(spark, root, features))
    parts.commit(spark, root, features, parts.stage(payloads.withColumn(parts.PART, _part()), root, "tiles"))


def refresh_tiles(
    spark: SparkSession,
    root: str,
    data: elements.Elements,
    change_set: dict[str, DataFrame],
    tile_layers: list[tiles.Layer],
    zooms: list[int],
    output_format: str = "mvt",
    index: DataFrame | None = None,
) -> elements.Elements:
    """Bring stored tiles up to date with a change set of ``data``; the elements after it.

    ``index`` is the reference index of the elements after the change, if it is kept. Features and tiles are
    swapped in together; a run that is lost before leaves both as they were and can be repeated.
    """
    scratch: list[str] = []
    after = apply_change_set(data, change_set)
    index = index if index is not None else reference_index(after.ways, after.relations)
    dirty = _stored(dirty_elements(index, changed_elements(change_set), scratch), "dirty-all", scratch)
    features = dirty_features(dirty)
    sources = dirty_layers(after, dirty)
    shown = [layer for layer in tile_layers if layer.name in sources]
    new = _stored(tiles.tile_features(sources, shown, zooms), "features", scratch)
    old = parts.read(spark, root, "features")
    key = ["layer", "feature_id"]
    left = old.join(features, key, "left_semi").select(*TILE)
    touched = _stored(left.unionByName(new.select(*TILE)).distinct().withColumn(parts.PART, _part()), "touched", scratch)
    # As many names as partitions are rewritten.
    hit = [r[0] for r in touched.select(parts.PART).distinct().collect()]
    stay = parts.read(spark, root, "features", hit).join(features, key, "left_anti")
    staged = parts.stage(stay.unionByName(new).withColumn(parts.PART, _part()), root, "features", hit)
    of_touched = parts.staged_rows(spark, root, staged).join(touched.select(*TILE), TILE, "left_semi")
    made = tiles.ENCODERS[output_format](of_touched)
    others = parts.read(spark, root, "tiles", hit).join(touched.select(*TILE), TILE, "left_anti")
    payloads = parts.stage(others.unionByName(made).withColumn(parts.PART, _part()), root, "tiles", hit)
    parts.commit(spark, root, staged, payloads)
    for path in scratch:
        session.discard(spark, path)
    return after
