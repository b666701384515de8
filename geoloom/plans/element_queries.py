"""Sources, sinks, element projections and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoloom import schemas, session
from geoloom.operators import layers, metrics, validate
from geoloom.plans import fixtures as fx
from geoloom.plans.registry import query
from geoloom.sources import elements, sinks
from geoloom.streaming import arrivals

_STAMP = "2024-01-31T00:00:00Z"


def _ts(c: str = "timestamp"):
    return F.col(c).cast("string").alias("ts")


def _stored(spark, sf_dir, kind: str, df) -> str:
    """Elements written as Parquet below a fresh folder."""
    root = session.new_path(spark, "elements")
    df.write.parquet(f"{root}/{kind}")
    return root




@query("a1_scan_elements", fx.sql(
    "select id, lat, lon, amenity, shop, nullif(name, '') as name, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts from fx_pois",
    "fx_pois"))
def scan_elements(spark, sf_dir):
    root = _stored(spark, sf_dir, "nodes", fx.nodes(spark, sf_dir))
    t = layers.tag
    return elements.scan(spark, root, "nodes").select(
        "id", "lat", "lon", t("amenity").alias("amenity"), t("shop").alias("shop"),
        t("name").alias("name"), _ts(),
    )


def _attr(v: str) -> str:
    """Escape text for an XML attribute."""
    return f"replace(replace(replace(coalesce({v}, ''), '&', '&amp;'), '<', '&lt;'), '\"', '&quot;')"


def _xml_tags(*keys: str) -> str:
    return "concat(" + ", ".join(
        f"'<tag k=\"{k}\" v=\"', {_attr(k)}, '\"/>'" for k in keys
    ) + ")"


def _node_xml(spark, sf_dir):
    """Node elements as XML text; every 41st has an unreadable latitude."""
    return fx.frame(spark, sf_dir, "fx_pois").selectExpr(
        "concat('<node id=\"', id, '\" lat=\"', if(id % 41 = 0, 'north', cast(lat as string)), "
        "'\" lon=\"', cast(lon as string), '\" version=\"1\" timestamp=\"" + _STAMP + "\">', "
        + _xml_tags("amenity", "shop", "name")
        + ", '<tag k=\"note\" v=\"first\"/><tag k=\"note\" v=\"last\"/></node>') as value"
    )


def _write_xml(spark, df, gz: bool = False) -> str:
    path = session.new_path(spark, "xml")
    sinks.write_xml(df, path, compression="gzip" if gz else "none")
    return path


_NODE_CHECK = fx.sql(
    "select id, lat, lon, coalesce(amenity, '') as amenity, coalesce(shop, '') as shop, "
    "coalesce(name, '') as name, 'last' as note, cast(1 as int) as version, "
    "'2024-01-31 00:00:00' as ts from fx_pois where id % 41 <> 0",
    "fx_pois",
)


def _node_columns(df):
    text = lambda k: F.coalesce(layers.tag(k), F.lit("")).alias(k)
    return df.select("id", "lat", "lon", text("amenity"), text("shop"), text("name"), text("note"), "version", _ts())


@query("a2_xml_nodes", _NODE_CHECK)
def xml_nodes(spark, sf_dir):
    path = _write_xml(spark, _node_xml(spark, sf_dir))
    return _node_columns(elements.accepted(elements.read_xml(spark, path, "node")))


@query("a5_xml_gz", _NODE_CHECK)
def xml_gz(spark, sf_dir):
    path = _write_xml(spark, _node_xml(spark, sf_dir), gz=True)
    return _node_columns(elements.accepted(elements.read_xml(spark, f"{path}/*.gz", "node")))


def _way_xml(spark, sf_dir):
    nd = "array_join(transform(sequence(0, n - 1), i -> concat('<nd ref=\"', id*10 + i, '\"/>')), '')"
    return fx.frame(spark, sf_dir, "fx_ways").selectExpr(
        "concat('<way id=\"', id, '\" version=\"1\" timestamp=\"" + _STAMP + f"\"><nd ref=\"\"/>', {nd}, "
        + _xml_tags("highway", "name", "lanes") + ", '</way>') as value"
    )


_WAY_CHECK = fx.sql(
    "select w.id, v.refs, coalesce(highway, '') as highway, coalesce(name, '') as name, lanes "
    "from fx_ways w join (select id, string_agg(cast(node_id as varchar), ',' order by i) as refs "
    "from fx_vertices group by id) v on v.id = w.id",
    "fx_ways", "fx_vertices",
)


@query("a3_xml_ways", _WAY_CHECK)
def xml_ways(spark, sf_dir):
    path = _write_xml(spark, _way_xml(spark, sf_dir))
    text = lambda k: F.coalesce(layers.tag(k), F.lit("")).alias(k)
    ways = elements.accepted(elements.read_xml(spark, path, "way"))
    return ways.select(
        "id", F.expr("array_join(transform(nodes, n -> cast(n as string)), ',')").alias("refs"),
        text("highway"), text("name"), text("lanes"),
    )


def _relation_xml(spark, sf_dir):
    member = (
        "array_join(transform(array(0, 2, 1, 3), e -> concat('<member type=\"way\" ref=\"', id*4 + e, '\"', "
        "if(e = 3, '', ' role=\"outer\"'), '/>')), '')"
    )
    return fx.frame(spark, sf_dir, "fx_areas").selectExpr(
        f"concat('<relation id=\"', id, '\" version=\"1\"><member type=\"\" ref=\"1\"/>', {member}, "
        + _xml_tags("boundary", "name") + ", '</relation>') as value"
    )


@query("a4_xml_relations", fx.sql(
    "select id, concat('way:', id*4, ':outer,way:', id*4+2, ':outer,way:', id*4+1, ':outer,way:', id*4+3, ':') as members, "
    "boundary, name from fx_areas", "fx_areas"))
def xml_relations(spark, sf_dir):
    path = _write_xml(spark, _relation_xml(spark, sf_dir))
    rel = elements.accepted(elements.read_xml(spark, path, "relation"))
    return rel.select(
        "id",
        F.expr("array_join(transform(members, m -> concat(m.type, ':', m.ref, ':', m.role)), ',')").alias("members"),
        layers.tag("boundary").alias("boundary"), layers.tag("name").alias("name"),
    )


@query("a7_multi_source", fx.sql(
    "select source, priority, count(*) as elements, sum(id) as id_sum from ("
    "select 'planet' as source, cast(1 as int) as priority, id from fx_pois union all "
    "select 'extracts', 2, node_id from fx_vertices where node_id % 37 <> 0) u group by source, priority",
    "fx_pois", "fx_vertices"))
def multi_source(spark, sf_dir):
    planet = _stored(spark, sf_dir, "nodes", fx.nodes(spark, sf_dir))
    extracts = _stored(spark, sf_dir, "nodes", fx.way_nodes(spark, sf_dir))
    rows = elements.read_sources(
        spark,
        [{"name": "planet", "url": planet, "format": "parquet", "priority": 1},
         {"name": "extracts", "url": extracts, "format": "parquet", "priority": 2}],
        "node",
    )
    return rows.groupBy("source", "priority").agg(
        F.count(F.lit(1)).alias("elements"), F.sum("id").alias("id_sum")
    )


@query("a8_write_layer", fx.sql(
    "select road_type, count(*) as roads, max(written) as written from ("
    "select highway as road_type, count(*) over () as written from fx_ways where highway <> 'footway') r group by road_type",
    "fx_ways"))
def write_layer(spark, sf_dir):
    """The written layer read back, beside the row count observed while writing."""
    target = session.new_path(spark, "layer")
    written = sinks.write_layer(layers.roads(fx.ways(spark, sf_dir)), target)
    stored = spark.read.parquet(target)
    return stored.groupBy("road_type").agg(
        F.count(F.lit(1)).alias("roads"), F.lit(written).cast("bigint").alias("written")
    )


@query("a9_load", fx.sql(
    "select f.format, count(*) as n, sum(id) as id_sum, count(amenity) as n_amenity, count(name) as n_name, "
    "count(*) filter (name = '') as n_empty from fx_pois, "
    "(values ('csv'), ('geojson'), ('json'), ('parquet')) f(format) group by f.format",
    "fx_pois"))
def load(spark, sf_dir):
    """The same rows, NULL and empty texts among them, through every file format the loader routes to."""
    base = fx.frame(spark, sf_dir, "fx_pois").select("id", "amenity", "name", "lon", "lat")
    geom = base.withColumn("geom", F.expr(layers.geo.point("lon", "lat")))
    root = session.new_path(spark, "load")
    sinks.load(base, f"{root}/p.csv")
    sinks.load(base, f"{root}/p.json")
    sinks.load(geom, f"{root}/p.geojson")
    sinks.load(base, f"{root}/p")
    schema = "id bigint, amenity string, name string, lon double, lat double"
    feature = "properties struct<id: bigint, amenity: string, name: string>"
    read = {
        "csv": spark.read.schema(schema).options(header="true", nullValue=sinks.CSV_NULL).csv(f"{root}/p.csv"),
        "json": spark.read.schema(schema).json(f"{root}/p.json"),
        "geojson": spark.read.schema(feature).json(f"{root}/p.geojson").select("properties.*"),
        "parquet": spark.read.schema(schema).parquet(f"{root}/p.parquet"),
    }
    rows = None
    for name, df in read.items():
        df = df.select(F.lit(name).alias("format"), "id", "amenity", "name")
        rows = df if rows is None else rows.unionByName(df)
    return rows.groupBy("format").agg(
        F.count(F.lit(1)).alias("n"), F.sum("id").alias("id_sum"), F.count("amenity").alias("n_amenity"),
        F.count("name").alias("n_name"), F.count_if(F.col("name") == "").alias("n_empty"),
    )


@query("a12_export_metrics", fx.sql(
    "select count(*) as metrics_count, round(sum(value), 6) as value_sum, "
    "strftime((select max(ts) from fx_metrics), '%Y-%m-%dT%H:%M:%S.%f') as export_timestamp, '1 hour' as time_range "
    "from fx_metrics where ts >= (select max(ts) from fx_metrics) - interval 1 hour", "fx_metrics"))
def export_metrics(spark, sf_dir):
    """Exported sample lines, parsed back and set against the header."""
    df = fx.metric_samples(spark, sf_dir).withColumns(
        {"labels": F.from_json("label_key", schemas.TAGS), "description": F.lit("")}
    )
    path = session.new_path(spark, "export")
    metrics.export_rows(df, metrics.as_of(df, "timestamp")).write.text(path)
    lines = spark.read.schema("name string, value double").json(path)
    header = metrics.export_envelope(df, metrics.as_of(df, "timestamp"))
    return header.withColumn(
        "value_sum", lines.agg(F.round(F.sum("value"), 6)).scalar()
    )


@query("a13_run_tables", fx.sql(
    "select run_id, status, strftime(start_time, '%Y-%m-%d %H:%M:%S') as start_time, records_processed, "
    "cast(0 as bigint) as tiles_generated from fx_runs", "fx_runs"))
def run_tables(spark, sf_dir):
    path = session.new_path(spark, "runs")
    runs = fx.frame(spark, sf_dir, "fx_runs").withColumn("tiles_generated", F.lit(0))
    sinks.append_rows(runs, schemas.RUN, path)
    return spark.read.schema(schemas.RUN).parquet(path).select(
        "run_id", "status", F.col("start_time").cast("string").alias("start_time"),
        "records_processed", "tiles_generated",
    )


@query("a14_sql_surface", fx.sql(
    "select case when highway in ('motorway', 'trunk') then 'highway' when highway in ('primary', 'secondary') then 'arterial' "
    "when highway in ('tertiary', 'unclassified') then 'collector' else 'local' end as road_class, count(*) as n "
    "from fx_ways where highway <> 'footway' group by 1", "fx_ways"))
def sql_surface(spark, sf_dir):
    layers.register_views({"roads": layers.roads(fx.ways(spark, sf_dir))}, "osm_")
    return spark.sql("SELECT road_class, count(*) AS n FROM osm_roads GROUP BY road_class")


_STRICT = (
    "case when amenity in ('restaurant','hospital','school','bank','pharmacy') then concat('amenity:', amenity) "
    "when shop in ('supermarket','bakery') then concat('shop:', shop) "
    "when tourism in ('hotel') then concat('tourism:', tourism) end"
)


@query("a15_arrival_stream", fx.sql(
    f"select poi_type, count(*) as n from (select {_STRICT} as poi_type from fx_pois) p where poi_type is not null group by poi_type",
    "fx_pois"))
def arrival_stream(spark, sf_dir):
    """Node files that have landed, turned into the strict layer by a streaming run."""
    root = _stored(spark, sf_dir, "nodes", fx.nodes(spark, sf_dir))
    target, checkpoint = session.new_path(spark, "arrivals"), session.new_path(spark, "arrivals-cp")
    run = arrivals.watch(spark, f"{root}/nodes", schemas.NODE, layers.poi_nodes, target, checkpoint)
    run.awaitTermination()
    stored = spark.read.parquet(f"{target}/batch_id=*")
    return stored.groupBy("poi_type").agg(F.count(F.lit(1)).alias("n"))


# --- projections of raw rows ----------------------------------------------------------------


def _raw_nodes(spark, sf_dir):
    """Raw node rows as a reader delivers them, some of them malformed."""
    return fx.frame(spark, sf_dir, "fx_pois").selectExpr(
        "if(id % 43 = 0, 'n' || id, cast(id as string)) as _id",
        "if(id % 41 = 0, 'north', cast(lat as string)) as _lat",
        "if(id % 47 = 0, null, cast(lon as string)) as _lon",
        "'1' as _version", "'2024-01-31T00:00:00Z' as _timestamp",
        "array(named_struct('_k', 'amenity', '_v', amenity), named_struct('_k', 'name', '_v', 'old'), "
        "named_struct('_k', '', '_v', 'x'), named_struct('_k', 'name', '_v', name)) as tag",
    )


@query("b1_tags_map", fx.sql(
    "select id, amenity, case when coalesce(name, '') = '' then 'old' else name end as name, "
    "cast(case when amenity is null then 1 else 2 end as int) as n_tags from fx_pois where id % 43 <> 0", "fx_pois"))
def tags_map(spark, sf_dir):
    raw = _raw_nodes(spark, sf_dir)
    df = raw.select(F.col("_id").try_cast("bigint").alias("id"), elements.tags_map().alias("tags"))
    return df.filter("id IS NOT NULL").select(
        "id", layers.tag("amenity").alias("amenity"), layers.tag("name").alias("name"),
        F.size("tags").alias("n_tags"),
    )


@query("b2_tagged_nodes", fx.sql(
    "select id, lon, lat from fx_pois where amenity is not null or shop is not null or tourism is not null "
    "or coalesce(name, '') <> '' or phone is not null", "fx_pois"))
def tagged_nodes(spark, sf_dir):
    every = fx.nodes(spark, sf_dir).unionByName(fx.way_nodes(spark, sf_dir))
    return elements.tagged(every).select("id", "lon", "lat")


@query("b3_reject_malformed", fx.sql(
    "select reason, count(*) as n from (select case when id%43=0 then 'bad id' when id%41=0 then 'bad lat' "
    "when id%47=0 then 'bad lon' else 'accepted' end as reason from fx_pois) r group by reason", "fx_pois"))
def reject_malformed(spark, sf_dir):
    parsed = elements.parse_nodes(_raw_nodes(spark, sf_dir))
    bad = elements.rejected(parsed).select(F.col("reject_reason").alias("reason"))
    good = elements.accepted(parsed).select(F.lit("accepted").alias("reason"))
    return bad.unionByName(good).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("b4_way_refs", fx.sql(
    "select id, string_agg(cast(node_id as varchar), ',' order by i) as refs, count(*) as n from fx_vertices group by id",
    "fx_vertices"))
def way_refs(spark, sf_dir):
    raw = fx.frame(spark, sf_dir, "fx_ways").selectExpr(
        "id",
        "concat(array(named_struct('_ref', '')), transform(sequence(0, n - 1), i -> "
        "named_struct('_ref', cast(id*10 + i as string))), array(named_struct('_ref', cast(null as string)))) as nd",
    )
    return raw.select("id", elements.way_refs().alias("nodes")).select(
        "id", F.expr("array_join(transform(nodes, n -> cast(n as string)), ',')").alias("refs"),
        F.size("nodes").cast("bigint").alias("n"),
    )


@query("b5_members", fx.sql(
    "select id, u.seq, u.ref, u.role from (select id, unnest([{'seq': 0, 'ref': id*4, 'role': 'outer'}, "
    "{'seq': 1, 'ref': id*4 + 3, 'role': ''}]) as u from fx_areas) a", "fx_areas"))
def members(spark, sf_dir):
    raw = fx.frame(spark, sf_dir, "fx_areas").selectExpr(
        "id",
        "array(named_struct('_type', 'way', '_ref', cast(id*4 as string), '_role', 'outer'), "
        "named_struct('_type', '', '_ref', '7', '_role', 'x'), "
        "named_struct('_type', 'node', '_ref', cast(null as string), '_role', 'y'), "
        "named_struct('_type', 'way', '_ref', cast(id*4 + 3 as string), '_role', cast(null as string))) as member",
    )
    return raw.select("id", F.posexplode(elements.relation_members()).alias("seq", "m")).select(
        "id", "seq", "m.ref", "m.role"
    )


# --- validation -----------------------------------------------------------------------------


def _shaky_nodes(spark, sf_dir):
    return fx.nodes(spark, sf_dir).withColumn(
        "lat", F.expr("case when id % 50 = 1 then null when id % 50 = 2 then lat + 200 else lat end")
    ).withColumn("lon", F.expr("case when id % 50 = 3 then -400D when id % 50 = 4 then null else lon end"))


_NODE_REASON = (
    "case when id%50=1 then 'missing lat' when id%50=4 then 'missing lon' when id%50=2 then 'lat out of range' "
    "when id%50=3 then 'lon out of range' end"
)


def _shaky_ways(spark, sf_dir):
    return fx.ways(spark, sf_dir).withColumn(
        "nodes", F.expr("case when id % 50 = 1 then slice(nodes, 1, 1) when id % 50 = 2 then null else nodes end")
    )


_WAY_REASON = "case when id%50=2 then 'missing nodes' when id%50=1 then 'fewer than two nodes' end"


@query("c1_validate_dataset", fx.sql(
    f"""select 'validation' as check_type, check_name, status, result_value from (
    select 'invalid_nodes' as check_name, case when count({_NODE_REASON}) = 0 then 'passed' else 'failed' end as status,
      cast(count({_NODE_REASON}) as double) as result_value from fx_pois
    union all select 'invalid_ways', case when count({_WAY_REASON}) = 0 then 'passed' else 'failed' end,
      cast(count({_WAY_REASON}) as double) from fx_ways
    union all select 'invalid_relations', 'passed', 0.0
    union all select 'elements_present', 'passed', cast((select count(*) from fx_pois) + (select count(*) from fx_ways) as double)) c""",
    "fx_pois", "fx_ways"))
def validate_dataset(spark, sf_dir):
    return validate.validate_dataset(
        _shaky_nodes(spark, sf_dir), _shaky_ways(spark, sf_dir), fx.areas(spark, sf_dir)[0]
    )


@query("c2_validate_node", fx.sql(
    f"select id, {_NODE_REASON} as reason, ({_NODE_REASON}) is null as is_valid from fx_pois", "fx_pois"))
def validate_node(spark, sf_dir):
    return validate.validate_nodes(_shaky_nodes(spark, sf_dir)).select("id", "reason", "is_valid")


@query("c3_validate_way", fx.sql(
    f"select id, {_WAY_REASON} as reason, ({_WAY_REASON}) is null as is_valid from fx_ways", "fx_ways"))
def validate_way(spark, sf_dir):
    return validate.validate_ways(_shaky_ways(spark, sf_dir)).select("id", "reason", "is_valid")


def _qa_layer(spark, sf_dir):
    return fx.building_ways(spark, sf_dir).select(
        "id",
        F.expr(
            "case when id % 50 = 1 then null when id % 50 = 2 then '' when id % 50 = 3 then 'BROKEN' else geometry end"
        ).alias("geometry_wkt"),
    )


_QA = """select count(*) as total_records,
  count(*) filter (id%50 not in (1,2,3) and id%20 <> 0) as valid_geometries,
  count(*) filter (id%50 = 1) as null_geometries, count(*) filter (id%50 = 2) as empty_geometries,
  count(*) filter (id%50 not in (1,2) and (id%50 = 3 or id%20 = 0)) as invalid_geometries from fx_buildings"""


@query("c4_quality_check", fx.sql(
    f"select *, round(valid_geometries * 100.0 / total_records, 6) as geometry_completeness_percent, "
    f"round(valid_geometries * 100.0 / total_records, 6) as quality_score from ({_QA}) q", "fx_buildings"))
def quality_check(spark, sf_dir):
    q = validate.quality_check(_qa_layer(spark, sf_dir))
    return q.withColumns({c: F.round(c, 6) for c in ("geometry_completeness_percent", "quality_score")})


@query("c5_record_check", fx.sql(
    f"""select 'run-1' as run_id, 'geometry' as check_type, check_name, round(result_value, 6) as result_value, threshold_value,
    case when threshold_value is null then 'recorded' when result_value >= threshold_value then 'passed' else 'failed' end as status
    from (select 'total_records' as check_name, cast(total_records as double) as result_value, cast(1 as double) as threshold_value from ({_QA}) q
    union all select 'valid_geometries', valid_geometries, null from ({_QA}) q
    union all select 'null_geometries', null_geometries, null from ({_QA}) q
    union all select 'empty_geometries', empty_geometries, null from ({_QA}) q
    union all select 'invalid_geometries', invalid_geometries, null from ({_QA}) q
    union all select 'geometry_completeness_percent', valid_geometries * 100.0 / total_records, null from ({_QA}) q
    union all select 'quality_score', valid_geometries * 100.0 / total_records, 99.0 from ({_QA}) q) c""", "fx_buildings"))
def record_check(spark, sf_dir):
    checks = validate.quality_rows(validate.quality_check(_qa_layer(spark, sf_dir)))
    rows = validate.record_checks(
        checks, {"quality_score": 99.0, "total_records": 1.0}, "run-1", F.current_timestamp()
    )
    path = session.new_path(spark, "checks")
    sinks.append_rows(rows, schemas.QUALITY_CHECK, path)
    stored = spark.read.schema(schemas.QUALITY_CHECK).parquet(path)
    return stored.select(
        "run_id", "check_type", "check_name", F.round("result_value", 6).alias("result_value"),
        "threshold_value", "status",
    )


