"""Change sets, stored tables and pruning."""

import pytest
from pyspark.sql import functions as F

from geoloom import schemas
from geoloom.operators import incremental, layers, retention, tiles
from geoloom.sources import elements, parts

ROADS = tiles.Layer("roads", "roads", 0, 12, "geometry_wkt", ["name"])
POIS = tiles.Layer("pois", "pois", 0, 12, "geom", ["name"])
AREAS = tiles.Layer("admin_boundaries", "admin_boundaries", 0, 12, "geom", ["name"])
ZOOMS = [2, 11]


def _elements(spark):
    nodes = [(i, 10.0 + (i // 10) * 0.4, 20.0 + (i % 10) * 0.4, {}, 1, None) for i in range(100)]
    nodes += [(200 + i, 10.0 + i * 0.5, -30.0, {"amenity": "school", "name": f"s{i}"}, 1, None) for i in range(6)]
    nodes += [(300, -40.0, 150.0, {"amenity": "school", "name": "far"}, 1, None)]
    ways = [(500 + i, [10 * i, 10 * i + 1, 10 * i + 2], {"highway": "primary", "name": f"w{i}"}, None, 1, None) for i in range(10)]
    ring = [(600, [0, 5, 55]), (601, [55, 50, 0]), (602, [66, 69, 99]), (603, [99, 96, 66])]
    ways += [(i, n, {}, None, 1, None) for i, n in ring]
    admin = lambda name: {"boundary": "administrative", "name": name}
    relations = [
        (900, [("way", 600, "outer"), ("way", 601, "outer")], admin("one"), 1, None),
        (901, [("w", 602, "outer"), ("w", 603, "outer")], admin("two"), 1, None),
        (902, [("relation", 901, "")], {}, 1, None),
        (903, [("relation", 902, ""), ("relation", 903, "")], {}, 1, None),
    ]
    frames = [spark.createDataFrame(r, s) for r, s in ((nodes, schemas.NODE), (ways, schemas.WAY), (relations, schemas.RELATION))]
    return elements.Elements(*frames, None)


def _changes(spark, data):
    gone = F.lit(False).alias("deleted")
    moved = data.nodes.filter("id in (31, 99)").select("id", "lat", (F.col("lon") + 5).alias("lon"), "tags", F.lit(2).alias("version"), "timestamp", gone)
    dropped = data.nodes.filter("id = 203").withColumns({"version": F.lit(2), "deleted": F.lit(True)})
    ways = data.ways.filter("id = 507").withColumns({"version": F.lit(2), "deleted": F.lit(True)})
    named = data.ways.filter("id = 501").withColumns({"tags": F.expr("map('highway', 'primary', 'name', 'new')"), "version": F.lit(3), "deleted": F.lit(False)})
    return {"node": moved.unionByName(dropped), "way": ways.unionByName(named)}


def _rows(df):
    return sorted(map(repr, df.select("z", "x", "y", "data", "feature_count").collect()))


def test_dirty_closure(spark):
    data = _elements(spark)
    index = incremental.reference_index(data.ways, data.relations)
    changed = spark.createDataFrame([("node", 99), ("way", 505)], "type string, id bigint")
    got = {tuple(r) for r in incremental.dirty_elements(index, changed).collect()}
    assert got == {
        ("node", 99), ("way", 505), ("way", 602), ("way", 603), ("relation", 901), ("relation", 902), ("relation", 903),
    }


def test_refreshed_tiles_equal_a_rebuild(spark, tmp_path, monkeypatch):
    kind, data, layers_shown = "geojson", _elements(spark), [ROADS, POIS, AREAS]
    kept, fresh = str(tmp_path / "kept"), str(tmp_path / "fresh")
    incremental.build_tiles(spark, kept, layers.ingest_layers(data), layers_shown, ZOOMS, kind)
    before = {(r.z, r.x, r.y): bytes(r.data) for r in parts.read(spark, kept, "tiles").collect()}
    folders = parts.manifest(spark, kept)[1]["tiles"]["folders"]
    change_set = _changes(spark, data)

    swap = parts._swap
    monkeypatch.setattr(parts, "_swap", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        incremental.refresh_tiles(spark, kept, data, change_set, layers_shown, ZOOMS, kind)
    monkeypatch.setattr(parts, "_swap", swap)
    assert {(r.z, r.x, r.y): bytes(r.data) for r in parts.read(spark, kept, "tiles").collect()} == before

    encoded, encode = set(), tiles.ENCODERS[kind]

    def seen(features, *args):
        encoded.update(tuple(r) for r in features.select("z", "x", "y").distinct().collect())
        return encode(features, *args)

    monkeypatch.setitem(tiles.ENCODERS, kind, seen)
    after = incremental.refresh_tiles(spark, kept, data, change_set, layers_shown, ZOOMS, kind)
    monkeypatch.setitem(tiles.ENCODERS, kind, encode)
    incremental.build_tiles(spark, fresh, layers.ingest_layers(after), layers_shown, ZOOMS, kind)
    assert _rows(parts.read(spark, kept, "tiles")) == _rows(parts.read(spark, fresh, "tiles"))
    now = {(r.z, r.x, r.y): bytes(r.data) for r in parts.read(spark, kept, "tiles").collect()}
    changed = {t for t in {*before, *now} if before.get(t) != now.get(t)}
    assert changed <= encoded | (set(before) - set(now))
    assert len(set(now) - encoded) > 50  # most tiles hold nothing that depends on the changes
    held = parts.manifest(spark, kept)[1]["tiles"]["folders"]
    assert any(held.get(p) == f for p, f in folders.items()) and held != folders
    assert parts.sweep(spark, kept) and parts.sweep(spark, kept) == []
    assert _rows(parts.read(spark, kept, "tiles")) == _rows(parts.read(spark, fresh, "tiles"))


def _table(spark, root):
    df = spark.range(40).selectExpr("id", "timestamp_seconds(id * 86400) as timestamp", "cast(id div 10 as string) as part")
    parts.commit(spark, root, parts.stage(df, root, "samples"))


def test_pruning_rewrites_only_partitions_with_stale_rows(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    _table(spark, root)
    old = parts.manifest(spark, root)[1]["samples"]["folders"]
    stale = retention.stale_metrics(F.expr("timestamp_seconds(25 * 86400)"), 10)
    ids = lambda: sorted(r.id for r in parts.read(spark, root, "samples").collect())
    assert sorted(map(tuple, retention.prune_stored(spark, root, "samples", stale, dry_run=True).collect())) == [("0", 10, 0), ("1", 5, 5)]
    assert ids() == list(range(40))
    swap = parts._swap
    monkeypatch.setattr(parts, "_swap", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        retention.prune_stored(spark, root, "samples", stale)
    monkeypatch.setattr(parts, "_swap", swap)
    assert ids() == list(range(40))
    retention.prune_stored(spark, root, "samples", stale)
    new = parts.manifest(spark, root)[1]["samples"]["folders"]
    assert ids() == list(range(15, 40))
    assert "0" not in new and new["1"] != old["1"] and [new[p] for p in "23"] == [old[p] for p in "23"]
    assert retention.prune_stored(spark, root, "samples", stale).count() == 0
    assert parts.manifest(spark, root)[1]["samples"]["folders"] == new
    retention.prune_stored(spark, root, "samples", F.lit(True))
    assert ids() == [] and retention.prune_stored(spark, root, "samples", F.lit(True)).count() == 0


def test_two_runs_do_not_overwrite_each_other(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    _table(spark, root)
    number = parts.manifest(spark, root)[0]
    with pytest.raises(RuntimeError):
        parts._swap(spark, root, number, "{}")
    with pytest.raises(ValueError):
        parts.stage(spark.createDataFrame([(1, "9")], "id bigint, part string"), root, "samples", ["1"])
