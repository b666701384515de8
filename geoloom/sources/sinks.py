"""Writers for layers, tiles, metrics and run tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from geoloom.functions import geometry as geo


CSV_NULL = "\\N"


def write_layer(df: DataFrame, path: str) -> int:
    """Overwrite a Parquet layer; the row count is observed during the one write."""
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    observed.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return seen.get["rows"]


def geojson_geometry(geom: str = "geom") -> Column:
    """GeoJSON geometry text of a geometry struct."""
    r, p = geo._lambda(2)
    xy = f"concat('[', CAST({p}.x AS STRING), ',', CAST({p}.y AS STRING), ']')"
    ring = lambda pts: f"concat('[', array_join(transform({pts}, {p} -> {xy}), ','), ']')"
    rings = f"concat('[', array_join(transform({geom}.parts, {r} -> {ring(r)}), ','), ']')"
    first = f"get(transform(array({geom}.parts[0][0]), {p} -> {xy}), 0)"
    shape = lambda name, text: f"concat('{{\"type\":\"{name}\",\"coordinates\":', {text}, '}}') "
    points = f"concat('[', array_join(transform({geom}.parts, {r} -> get(transform(array({r}[0]), {p} -> {xy}), 0)), ','), ']')"
    grouped = (
        f"concat('[', array_join(transform({geom}.parts, ({r}, i) -> concat(CASE WHEN i = 0 THEN '[' "
        f"WHEN {geo.is_shell(geom, r, 'i')} THEN '],[' ELSE ',' END, {ring(r)})), ''), ']]')"
    )
    return F.expr(
        f"CASE {geom}.kind WHEN 'POINT' THEN concat('{{\"type\":\"Point\",\"coordinates\":', {first}, '}}') "
        f"WHEN 'LINESTRING' THEN concat('{{\"type\":\"LineString\",\"coordinates\":', "
        f"{ring(f'{geom}.parts[0]')}, '}}') "
        f"WHEN 'POLYGON' THEN concat('{{\"type\":\"Polygon\",\"coordinates\":', {rings}, '}}') "
        f"WHEN 'MULTIPOINT' THEN {shape('MultiPoint', points)}"
        f"WHEN 'MULTILINESTRING' THEN {shape('MultiLineString', rings)}"
        f"WHEN 'MULTIPOLYGON' THEN {shape('MultiPolygon', grouped)}END"
    )


def geojson_features(df: DataFrame, geom: str = "geom", id_column: str | None = None) -> DataFrame:
    """One GeoJSON Feature text per row; every other column becomes a property."""
    skip = {geom, "weights", "geometry_wkt"}
    props = [c for c in df.columns if c not in skip and c != id_column]
    head = [F.col(id_column).cast("string").alias("id")] if id_column else []
    feature = F.concat(
        F.lit('{"type":"Feature","geometry":'),
        F.coalesce(geojson_geometry(geom), F.lit("null")),
        F.lit(',"properties":'),
        F.to_json(F.struct(*props), {"ignoreNullFields": "false"}) if props else F.lit("{}"),
        F.lit("}"),
    )
    return df.select(*head, feature.alias("value"))


def load(df: DataFrame, destination: str, jdbc: dict | None = None) -> bool:
    """Write by destination: table for ``postgresql://``, else by file suffix, Parquet by default."""
    target = str(destination)
    if target.startswith("postgresql://"):
        load_jdbc(df, target, **(jdbc or {}))
        return True
    lower = target.lower()
    if lower.startswith(("s3://", "s3a://")):
        df.write.mode("overwrite").parquet(target)
    elif lower.endswith(".csv"):
        # NULL has a mark of its own, or it could not be told from the empty text.
        df.write.mode("overwrite").options(header="true", nullValue=CSV_NULL).csv(target)
    elif lower.endswith((".geojson", ".json")) and "geom" in df.columns:
        geojson_features(df).write.mode("overwrite").text(target)
    elif lower.endswith((".geojson", ".json")):
        df.write.mode("overwrite").json(target)
    elif lower.endswith(".parquet"):
        df.write.mode("overwrite").parquet(target)
    else:
        df.write.mode("overwrite").parquet(target + ".parquet")
    return True


def load_jdbc(df: DataFrame, url: str, table: str, batch_size: int = 10000, **options) -> None:
    """Append to a database table in batches."""
    writer = df.write.format("jdbc").option("url", f"jdbc:{url}").option("dbtable", table)
    writer.option("batchsize", batch_size).options(**options).mode("append").save()


def write_tiles(tiles: DataFrame, path: str) -> int:
    """Tile table laid out by zoom, near tiles together inside each file."""
    ordered = tiles.repartitionByRange("z", "x", "y").sortWithinPartitions("z", "x", "y")
    seen = Observation()
    observed = ordered.observe(seen, F.count(F.lit(1)).alias("rows"))
    observed.write.mode("overwrite").partitionBy("z").parquet(path)
    return seen.get["rows"]


def append_rows(df: DataFrame, schema, path: str) -> None:
    """Append rows to a typed table: columns in schema order, missing ones NULL, types enforced."""
    columns = [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    df.select(*columns).write.mode("append").parquet(path)


def write_xml(elements: DataFrame, path: str, root: str = "osm", compression: str = "none") -> None:
    """Element texts (one string column) as XML documents, one per task."""

    def document(batches):
        yield pd.DataFrame({"value": [f"<{root}>"]})
        for batch in batches:
            yield batch
        yield pd.DataFrame({"value": [f"</{root}>"]})

    elements.toDF("value").mapInPandas(document, "value string").write.option(
        "compression", compression
    ).text(path)
