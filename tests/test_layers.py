import random
import time

import pytest
from pyspark.sql import functions as F

from geoloom import schemas, session
from geoloom.functions import geometry as geo
from geoloom.operators import changes, ingest, layers, retention, validate
from geoloom.sources import elements, sinks


def nodes(spark, rows):
    return spark.createDataFrame(rows, "id long, lat double, lon double, tags map<string,string>").withColumns(
        {"version": F.lit(1), "timestamp": F.lit(None).cast("timestamp")}
    )


def ways(spark, rows):
    return spark.createDataFrame(rows, "id long, nodes array<long>, tags map<string,string>").withColumns(
        {"geometry": F.lit(None).cast("string"), "version": F.lit(1), "timestamp": F.lit(None).cast("timestamp")}
    )


GRID = [(i, float(i), float(i) / 2, {}) for i in range(1, 9)]


def test_strict_pois(sample_nodes):
    rows = {r["osm_id"]: r for r in layers.poi_nodes(sample_nodes).collect()}
    assert rows[1]["poi_type"] == "amenity:hospital" and rows[1]["name"] == "Hill Clinic"
    assert rows[2]["poi_type"] == "shop:bakery"


def test_node_without_coordinates_is_skipped(spark):
    tags = {"amenity": "bank"}
    df = nodes(spark, [(1, 1.0, 1.0, tags), (2, None, None, tags), (3, 2.0, 2.0, tags)])
    assert layers.poi_nodes(df).count() == 2


def test_strict_and_wide_pois_differ(spark):
    df = nodes(spark, [(1, 0.0, 0.0, {"amenity": "bench", "shop": "bakery", "name": "B"}),
                       (2, 1.0, 0.0, {"tourism": "artwork", "name": "A"})])
    strict = {r["osm_id"]: r["poi_type"] for r in layers.poi_nodes(df).collect()}
    wide = {r["osm_id"]: r for r in layers.pois(df).collect()}
    assert strict == {1: "shop:bakery"}
    assert wide[1]["poi_category"] == "bench" and wide[2]["poi_type"] == "tourism"
    assert wide[1]["geometry_wkt"] == "POINT(0.0 0.0)"


def test_road_lines_full_and_partial(spark, sample_ways):
    full = layers.road_lines(sample_ways, nodes(spark, GRID[:4])).collect()
    assert [r["geometry_wkt"] for r in full] == ["LINESTRING (0.5 1.0, 1.0 2.0, 1.5 3.0, 2.0 4.0)"]
    partial = nodes(spark, [GRID[0], GRID[2]])
    assert [r["geometry_wkt"] for r in layers.road_lines(sample_ways, partial).collect()] == ["LINESTRING (0.5 1.0, 1.5 3.0)"]
    assert layers.road_lines(sample_ways, partial, "drop").count() == 0
    with pytest.raises(ValueError):
        layers.road_lines(sample_ways, partial, "guess")


def test_geometry_edge_cases(spark):
    w = ways(spark, [(1, [1, 1, 2, 3], {"highway": "service"}), (2, [1], {"highway": "service"}),
                     (3, [1, 2, 3, 4], {"highway": "service"}), (4, [], {"highway": "service"})])
    got = {r["osm_id"]: r["geometry_wkt"].count(",") + 1 for r in layers.road_lines(w, nodes(spark, GRID)).collect()}
    assert got == {1: 4, 3: 4}


def test_copies_and_versions_of_a_way(spark):
    """Many copies of one row, and another node list under the same id."""
    copies = ways(spark, [(1, [1, 2, 3], {"highway": "service"})] * 50 + [(1, [4, 5], {"highway": "service"})])
    vertices = layers.way_points(copies, nodes(spark, GRID))
    assert sorted(len(r["points"]) for r in vertices.collect()) == [2, 3]
    lines = layers.road_lines(copies, nodes(spark, GRID)).groupBy("geometry_wkt").count().collect()
    assert sorted(r["count"] for r in lines) == [1, 50]


def test_tag_edge_cases(spark):
    long = "x" * 2000
    df = nodes(spark, [(1, 0.0, 0.0, {}), (2, 0.0, 0.0, {"amenity": "cafe", "name": 'Café "Special" & More'}),
                       (3, 0.0, 0.0, {"amenity": "cafe", "name": long})])
    names = {r["osm_id"]: r["name"] for r in layers.poi_nodes(df).collect()}
    assert names == {2: 'Café "Special" & More', 3: long}


def test_closed_building_way(spark, sample_ways):
    square = nodes(spark, [(5, 0.0, 0.0, {}), (6, 0.0, 2.0, {}), (7, 3.0, 2.0, {}), (8, 3.0, 0.0, {})])
    rows = layers.building_ways(sample_ways, square).select("osm_id", F.expr(geo.area("geom")).alias("a")).collect()
    assert [tuple(r) for r in rows] == [(32, 6.0)]


def test_admin_boundary_with_hole_and_two_shells(spark):
    ring = lambda base, x, y, s: [(base, y, x, {}), (base + 1, y, x + s, {}), (base + 2, y + s, x + s, {}), (base + 3, y + s, x, {})]
    n = nodes(spark, ring(10, 0.0, 0.0, 10.0) + ring(20, 2.0, 2.0, 2.0) + ring(30, 50.0, 0.0, 5.0))
    w = ways(spark, [(1, [10, 11, 12], {}), (2, [10, 13, 12], {}), (3, [20, 21, 22, 23, 20], {}), (4, [30, 31, 32], {}),
                     (5, [32, 33, 30], {}), (6, [10, 30], {})])
    members = [("way", 2, "outer"), ("way", 4, "outer"), ("way", 1, ""), ("way", 3, "inner"), ("way", 5, "outer"), ("node", 10, "label"), ("way", 6, "outer")]
    rel = spark.createDataFrame([(9, members, {"boundary": "administrative", "name": "X", "admin_level": "8"}, 1, None)], schemas.RELATION)
    out = layers.admin_boundaries(rel, w, n).select("osm_id", "name", F.size("geom.parts").alias("parts"), F.expr(geo.area("geom")).alias("a")).collect()
    assert sorted((r["parts"], r["a"]) for r in out) == [(1, 25.0), (2, 96.0)]


def test_rings_that_touch_come_apart_and_spurs_open_none():
    walks = [
        [(0, 0), (1, 1)], [(1, 1), (1, -1)], [(1, -1), (0, 0)],  # one ring at (0, 0)
        [(0, 0), (-1, 1)], [(-1, -1), (-1, 1)], [(-1, -1), (0, 0)],  # another
        [(1, 1), (5, 5)], [(5, 5), (6, 6)],  # a spur
        [(9, 9), (8, 8)], [(8, 8), (9, 9)],  # there and back
        [(20, 20), (21, 20), (21, 21), (20, 20)],  # closed by itself
    ]
    rng = random.Random(4)
    for _ in range(200):
        order = rng.sample(range(len(walks)), len(walks))
        lines = [walks[i] if rng.random() < 0.5 else walks[i][::-1] for i in order]
        found = layers._stitch(lines)
        assert sorted(i for at, _ in found for i in at) == list(range(len(walks)))
        rings = sorted(sorted(order[i] for i in at) for at, ring in found if ring)
        assert rings == [[0, 1, 2], [3, 4, 5], [10]]
        assert all(ring[0] == ring[-1] and len(ring) == 4 for _, ring in found if ring)
    assert layers._stitch([]) == []


def test_rejected_boundary_members(spark):
    ring = lambda base, x, y, s: [(base, y, x, {}), (base + 1, y, x + s, {}), (base + 2, y + s, x + s, {}), (base + 3, y + s, x, {})]
    n = nodes(spark, ring(10, 0.0, 0.0, 10.0) + ring(20, 2.0, 2.0, 2.0) + ring(30, 50.0, 0.0, 5.0))
    w = ways(spark, [(1, [10, 11, 12], {}), (2, [10, 13, 12], {}), (3, [20, 21, 22, 23, 20], {}), (4, [30, 31, 32, 33, 30], {}), (6, [10, 30], {})])
    members = [("way", 1, "outer"), ("way", 6, "outer"), ("way", 2, ""), ("way", 3, "inner"), ("way", 4, "inner"), ("way", 77, "outer"), ("node", 10, "label")]
    tags = {"boundary": "administrative"}
    rel = spark.createDataFrame([(9, members, tags, 1, None), (9, members, tags, 1, None), (8, None, tags, 1, None)], schemas.RELATION)
    got = [tuple(r) for r in layers.rejected_boundaries(rel, w, n).collect()]
    assert sorted(got) == [(9, 1, 6, "outer", "unclosed"), (9, 4, 4, "inner", "hole without shell"), (9, 5, 77, "outer", "missing way")]


def test_validation(spark, sample_nodes, sample_ways, sample_relations):
    assert validate.is_valid_dataset(sample_nodes, sample_ways, sample_relations)
    bad = nodes(spark, [(1, 91.0, 0.0, {}), (2, 1.0, None, {}), (3, 1.0, 1.0, {})])
    reasons = {r["id"]: r["reason"] for r in validate.validate_nodes(bad).collect()}
    assert reasons == {1: "lat out of range", 2: "missing lon", 3: None}
    assert not validate.is_valid_dataset(bad, sample_ways, sample_relations)
    short = ways(spark, [(1, [1], {})])
    assert not validate.is_valid_dataset(sample_nodes, short, sample_relations)
    empty_n, empty_w = sample_nodes.limit(0), sample_ways.limit(0)
    assert not validate.is_valid_dataset(empty_n, empty_w, sample_relations)
    assert not validate.is_valid_dataset(None, sample_ways, sample_relations)


def test_quality_buckets_sum_to_total(spark):
    df = spark.createDataFrame([(None,), ("",), ("BROKEN",), ("POINT (1 1)",), ("POLYGON ((0 0, 1 1, 1 0, 0 1, 0 0))",)], "geometry_wkt string")
    q = validate.quality_check(df).first()
    assert (q["null_geometries"], q["empty_geometries"], q["invalid_geometries"], q["valid_geometries"]) == (1, 1, 2, 1)
    assert q["quality_score"] == 20.0
    assert validate.quality_check(df.limit(0)).first()["quality_score"] == 0.0


def test_planar_measures_are_available(spark, sample_ways):
    w = sample_ways.withColumn("geometry", F.lit("LINESTRING (0 0, 3 4)"))
    assert layers.roads(w, "planar").first()["length_meters"] == 5.0
    assert layers.roads(w).first()["length_meters"] == pytest.approx(555_800, rel=0.01)
    with pytest.raises(ValueError):
        layers.roads(w, "miles")


XML = """<?xml version="1.0"?><osm version="0.6">
<node id="1" lat="48.5" lon="12.25" version="1" timestamp="2021-06-05T04:03:02Z"><tag k="amenity" v="restaurant"/><tag k="name" v="A &amp; B"/><tag k="" v="x"/></node>
<node id="2" lat="-3.5" lon="7.75" version="1" timestamp="2021-06-05T04:03:02Z"/>
<node id="x" lat="1" lon="1"/><node id="4" lat="bad" lon="1"/>
<way id="100" version="1"><nd ref="1"/><nd ref=""/><nd ref="2"/><tag k="highway" v="primary"/><tag k="highway" v="trunk"/></way>
<relation id="200"><member type="way" ref="100" role="outer"/><member type="way" ref="100"/><member ref="1"/></relation>
</osm>"""


@pytest.fixture(scope="module")
def xml_file(tmp_path_factory):
    import gzip

    folder = tmp_path_factory.mktemp("xml")
    (folder / "a.osm").write_text(XML)
    with gzip.open(folder / "b.osm.gz", "wt") as f:
        f.write(XML)
    return folder


@pytest.mark.parametrize("name, kind", [("a.osm", "xml"), ("b.osm.gz", "xml.gz")])
def test_extract_xml(spark, xml_file, name, kind):
    data = elements.extract(spark, str(xml_file / name))
    n = {r["id"]: r for r in data.nodes.collect()}
    assert set(n) == {1, 2} and n[1]["tags"] == {"amenity": "restaurant", "name": "A & B"} and n[2]["tags"] == {}
    way = data.ways.first()
    assert way["nodes"] == [1, 2] and way["tags"] == {"highway": "trunk"}
    rel = data.relations.first()
    assert [tuple(m) for m in rel["members"]] == [("way", 100, "outer"), ("way", 100, "")]
    assert tuple(data.metadata.first()) == (str(xml_file / name), kind, 4)


def test_detect_format():
    assert elements.detect_format("a/b.OSM") == "xml"
    for bad in ("a.csv.gz", "a.txt", "a.pbf"):
        with pytest.raises(ValueError):
            elements.detect_format(bad)


def test_ingest_reports_success_and_failure(spark, xml_file, tmp_path):
    out, runs = str(tmp_path / "out"), str(tmp_path / "runs")
    done = ingest.ingest(spark, str(xml_file / "a.osm"), out, run_table=runs)
    assert done["success"] and done["stats"]["layers"] == {"pois": 1, "roads": 1}
    assert spark.read.parquet(f"{out}/roads").first()["road_type"] == "trunk"
    failed = ingest.ingest(spark, str(tmp_path / "none.osm"), out, run_table=runs)
    assert not failed["success"] and "not found" in failed["error"] and "not found" in failed["message"]
    assert sorted(r["status"] for r in spark.read.parquet(runs).collect()) == ["completed", "failed"]


def test_geojson_sink(spark, tmp_path):
    import json

    df = spark.createDataFrame([(1, "POLYGON ((0 0, 1 0, 1 1, 0 0))", None), (2, "POINT (1 2)", 'a"b')], "id int, w string, name string")
    df = df.withColumn("geom", F.expr(geo.parse_wkt("w"))).drop("w")
    assert sinks.load(df, str(tmp_path / "x.geojson"))
    rows = {f["properties"]["id"]: f for f in map(json.loads, (r[0] for r in spark.read.text(str(tmp_path / "x.geojson")).collect()))}
    assert rows[1]["geometry"] == {"type": "Polygon", "coordinates": [[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]]}
    assert rows[2]["geometry"] == {"type": "Point", "coordinates": [1.0, 2.0]} and rows[2]["properties"]["name"] == 'a"b'


def test_ten_thousand_nodes_and_thousand_ways(spark):
    n = spark.range(10_000).selectExpr("id", "37.0 + id * 0.0001 as lat", "-122.0 + id * 0.0001 as lon").selectExpr(
        "id", "cast(lat as double) lat", "cast(lon as double) lon", "map('amenity', 'test') as tags", "1 as version", "cast(null as timestamp) as timestamp")
    w = spark.range(1_000).selectExpr("id", "transform(sequence(0, 3), i -> id * 4 + i) as nodes", "map('highway', 'residential') as tags",
                                      "cast(null as string) as geometry", "1 as version", "cast(null as timestamp) as timestamp")
    start = time.time()
    assert layers.poi_nodes(n).count() == 0
    assert layers.road_lines(w, n).count() == 1_000
    assert time.time() - start < 30


def test_changes_upserts_and_retention(spark):
    cur = spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (3, 5, "c")], "id int, version int, v string")
    new = spark.createDataFrame([(1, 2, "A", False), (2, 2, "b", True), (3, 4, "old", False), (4, 1, "d", False)], "id int, version int, v string, deleted boolean")
    assert sorted(tuple(r) for r in changes.apply_changes(cur, new).collect()) == [(1, 2, "A"), (3, 5, "c"), (4, 1, "d")]
    runs = spark.createDataFrame([("r1", "completed", "2024-01-01"), ("r2", "running", "2024-01-01"), ("r3", "failed", "2024-03-01")],
                                 "run_id string, status string, t string").selectExpr("run_id", "status", "cast(t as timestamp) as start_time")
    now = F.lit("2024-03-02").cast("timestamp")
    assert sorted(r["run_id"] for r in retention.prune_runs(runs, now).collect()) == ["r2", "r3"]
    assert tuple(retention.prune_runs(runs, now, dry_run=True).first()) == (1, 2)


def test_shared_folder_is_the_configured_one(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_one_xml_file_is_read_in_splits(spark, tmp_path):
    path = tmp_path / "one.osm"
    nodes = "".join(f'<node id="{i}" lat="1.5" lon="{i % 90}" version="1"/>\n' for i in range(2000))
    ways = "".join(
        f'<way id="{i}" note="a > b / c"><nd ref="1"/><nd ref="{i}"/><tag k="name" v="W &amp; {i}"/></way>' if i % 3 else f"<way id='{i}'/>"
        for i in range(900))
    path.write_text(f'<?xml version="1.0"?>\n<osm><!-- made up --><bounds minlat="0"/>{nodes}{ways}<wayside id="1"/></osm>')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
        raw = elements.read_xml_raw(spark, str(path), "way")
        assert raw.rdd.getNumPartitions() > 1
        got = {r["id"]: (r["nodes"], r["tags"]) for r in elements.read_xml(spark, str(path), "way").collect()}
        assert got == {i: ([1, i], {"name": f"W & {i}"}) if i % 3 else ([], {}) for i in range(900)}
        assert elements.accepted(elements.read_xml(spark, str(path), "node")).count() == 2000
        path.write_text('<osm><!-- <way id="5"/> --><way id="6"/></osm>')
        assert [r["id"] for r in elements.read_xml(spark, str(path), "way").collect()] == [6]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_rows_without_geometry_are_spread(spark):
    rows = spark.range(4000).selectExpr("id", "if(id % 4 = 0, concat('LINESTRING (', id % 90, ' 1, 2 2)'), null) as geometry")
    parts = layers.spatial_partition(rows, "geometry", partitions=8).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in parts) < 1200


def test_boundaries_are_never_gathered_in_the_driver(spark):
    """Exploded members and vertices look small to the optimizer, so their joins must not be broadcast."""
    relations = spark.createDataFrame([(1, [("way", 2, "outer")], {"boundary": "administrative"}, 1, None)], schemas.RELATION)
    ways = spark.createDataFrame([(2, [5, 6, 7, 5], {}, None, 1, None)], schemas.WAY)
    nodes = spark.createDataFrame([(5, 0.0, 0.0, {}, 1, None), (6, 0.0, 1.0, {}, 1, None), (7, 1.0, 1.0, {}, 1, None)], schemas.NODE)
    for build, n in ((layers.admin_boundaries, 1), (layers.rejected_boundaries, 0)):
        df = build(relations, ways, nodes)
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
        assert df.count() == n
