"""Layers written for reading a tile or a box."""

import random

import pytest
from pyspark.sql import functions as F

from geoloom.operators import skipping, tiles


@pytest.fixture(scope="module")
def places(spark, tmp_path_factory):
    rnd = random.Random(4)
    rows = [(i, f"POINT ({rnd.uniform(-179, 179)} {rnd.uniform(-80, 80)})", "n" * 40 + str(i)) for i in range(40_000)]
    for i in range(300):
        x, y, w = rnd.uniform(-170, 150), rnd.uniform(-70, 60), rnd.choice([0.01, 0.5, 12.0])
        rows.append((100_000 + i, f"POLYGON (({x} {y}, {x + w} {y}, {x + w} {y + w}, {x} {y + w}, {x} {y}))", "area"))
    rows += [(200_000, "BROKEN", "b"), (200_001, None, "b")]
    df = spark.createDataFrame(rows, "osm_id long, geometry_wkt string, name string").repartition(4)
    path = str(tmp_path_factory.mktemp("layer") / "places")
    skipping.write_indexed(df, path, partitions=4, row_group_bytes=1 << 15)
    return df, spark.read.parquet(path)


def rows_read(df):
    """Rows that the scans of an executed query gave out."""
    df.collect()
    todo, total = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if "Scan parquet" in node.nodeName():
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
    return total


LAYER = tiles.Layer("places", "places", 0, 14, "geometry_wkt", ["name"])


@pytest.mark.parametrize("tile", [(7, 70, 50), (12, 2201, 1400), (0, 0, 0), (5, 0, 0), (5, 31, 31)])
def test_a_tile_of_an_indexed_layer(places, tile):
    plain, indexed = places
    assert skipping.with_box(plain).filter("box_x0 is null").count() == 2
    got, want = (tiles.single_tile_features({"places": d}, [LAYER], *tile).select("feature_id") for d in (indexed, plain))
    assert sorted(r[0] for r in got.collect()) == sorted(r[0] for r in want.collect())
    if tile[0] >= 5:
        assert rows_read(got) < indexed.count() / 4


def test_the_scan_is_told_the_box(spark, places):
    _, indexed = places
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    plan = tiles.single_tile_features({"places": indexed}, [LAYER], 7, 70, 50)._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert all(f"({c}," in pushed for c in skipping.BOX)


def test_a_box_of_an_indexed_layer(places):
    plain, indexed = places
    box = (10.0, 40.0, 20.0, 50.0)
    got, want = (
        tiles.tile_features({"places": d}, [LAYER], [6, 8], box).select("z", "x", "y", "feature_id") for d in (indexed, plain)
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []
    assert rows_read(got.filter(F.col("z") > 0)) < indexed.count() / 4
