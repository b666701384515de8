"""Layers laid out so that a tile or a box reads little of them.

A layer is written along a space-filling curve with the box of every geometry in plain columns. Parquet keeps
the least and largest value of each column by row group and page, so a predicate on these columns, which the
scan pushes down, leaves out all groups that lie elsewhere before any geometry is read or parsed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.functions import geometry as geo
from geoloom.functions import tilemath
from geoloom.rules import MAX_MERCATOR_LAT

#: Columns of the box of a row's geometry, in the layer's own coordinates.
BOX = ("box_x0", "box_y0", "box_x1", "box_y1")
ROW_GROUP_BYTES = 8 << 20

Area = tuple[float, float, float, float]


def with_box(df: DataFrame, geometry_column: str = "geometry_wkt") -> DataFrame:
    """The layer with the box columns; NULL where the geometry cannot be read."""
    is_struct = isinstance(df.schema[geometry_column].dataType, T.StructType)
    raw = geometry_column if is_struct else geo.parse_wkt(geometry_column)
    box = geo.let(raw, lambda g: f"CASE WHEN {g} IS NOT NULL THEN {geo.bbox(g)} END")
    boxed = geo.once(df, _box=box)
    return boxed.withColumns({name: F.col(f"_box.{side}") for name, side in zip(BOX, ("x0", "y0", "x1", "y1"))}).drop("_box")


def write_indexed(
    df: DataFrame,
    path: str,
    geometry_column: str = "geometry_wkt",
    zoom: int = 12,
    partitions: int | None = None,
    row_group_bytes: int = ROW_GROUP_BYTES,
) -> None:
    """Write a layer in EPSG:4326 along the Morton curve of its boxes' corners.

    Range sampling keeps files even where the data is dense; a hash of the geometry splits places with very
    many rows. Large shapes are kept apart, so that their boxes do not widen those of their neighbours: the
    curve is followed once by every size of box, in powers of four.
    """
    x0, y0, x1, y1 = BOX
    z = str(zoom)
    size = F.expr(f"CAST(ceil(log2(greatest({x1} - {x0}, {y1} - {y0}, 1e-6)) / 2) AS INT)")
    address = f"named_struct('x', {tilemath.tile_x(x0, z)}, 'y', {tilemath.tile_y(y0, z)})"
    cell = F.expr(geo.let(address, lambda t: tilemath.morton(f"{t}.x", f"{t}.y", zoom)))
    boxed = with_box(df, geometry_column).withColumns({"_size": size, "_cell": cell})
    order = ["_size", "_cell", F.xxhash64(*BOX)]
    ranged = boxed.repartitionByRange(partitions, *order) if partitions else boxed.repartitionByRange(*order)
    placed = ranged.sortWithinPartitions(*order).drop("_size", "_cell")
    placed.write.mode("overwrite").option("parquet.block.size", row_group_bytes).parquet(path)


def in_area(df: DataFrame, area: Area | None) -> DataFrame:
    """Rows whose box meets the area, if the layer has box columns; all rows otherwise."""
    if area is None or not set(BOX) <= set(df.columns):
        return df
    return df.filter(meets(area))


def meets(area: Area) -> Column:
    """The row's box and the area share a point: comparisons of plain columns with numbers."""
    x0, y0, x1, y1 = area
    return (F.col(BOX[0]) <= x1) & (F.col(BOX[2]) >= x0) & (F.col(BOX[1]) <= y1) & (F.col(BOX[3]) >= y0)


def _lat(y: float, n: int) -> float:
    return math.degrees(math.atan(math.sinh(math.pi * (1 - 2 * y / n))))


def area_of_tiles(z: int, x_min: int, x_max: int, y_min: int, y_max: int, buffer: int, tile_size: int) -> Area:
    """What the buffered boxes of a range of tiles can reach, a little more for rounding."""
    n, share = 1 << z, buffer / tile_size + 1e-6
    width = 360 / n * share
    top, bottom = _lat(y_min, n), _lat(y_max + 1, n)
    above, below = (top - _lat(y_min + 1, n)) * share, (_lat(y_max, n) - bottom) * share
    return (x_min / n * 360 - 180 - width, bottom - below, (x_max + 1) / n * 360 - 180 + width, top + above)


def area_of_box(bbox: Area, zooms: list[int], buffer: int, tile_size: int) -> Area:
    """What the tiles of a box can reach at any of the zooms, with one more tile each way."""
    areas = []
    for z in zooms:
        n = 1 << z
        column = lambda lon: math.floor((lon + 180) / 360 * n)  # noqa: E731, B023
        at = lambda lat: math.asinh(math.tan(math.radians(max(-MAX_MERCATOR_LAT, min(MAX_MERCATOR_LAT, lat)))))
        row = lambda lat: math.floor((1 - at(lat) / math.pi) / 2 * n)  # noqa: E731, B023
        clamp = lambda v: max(0, min(n - 1, v))  # noqa: E731, B023
        x0, y0, x1, y1 = bbox
        areas.append(
            area_of_tiles(z, clamp(column(x0) - 1), clamp(column(x1) + 1), clamp(row(y1) - 1), clamp(row(y0) + 1), buffer, tile_size)
        )
    return tuple(pick(a[i] for a in areas) for i, pick in enumerate((min, min, max, max)))
