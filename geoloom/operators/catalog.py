"""Queries over the tile catalog (columns z, x, y, format, size_bytes, feature_count)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ZOOM = 18
# Formats in order of preference.
FORMATS = ["mvt", "pbf", "geojson"]


def _check_zoom(z: int) -> None:
    if not 0 <= z <= MAX_ZOOM:
        raise ValueError(f"Invalid zoom level: {z}")


def catalog_page(catalog: DataFrame, z: int | None = None, limit: int = 100) -> DataFrame:
    """The first tiles by address, with how many there are in total and after the filter."""
    chosen = catalog if z is None else catalog.filter(F.col("z") == z)
    total = catalog.agg(F.count(F.lit(1))).scalar()
    filtered = chosen.agg(F.count(F.lit(1))).scalar()
    page = chosen.orderBy("z", "x", "y", "format").limit(limit)
    return page.withColumns(
        {
            "total_tiles": total,
            "filtered_tiles": filtered,
            "returned_tiles": F.least(filtered, F.lit(limit).cast("bigint")),
        }
    )


def catalog_stats(catalog: DataFrame) -> DataFrame:
    """Tiles and bytes by zoom, by format and overall, from one pass."""
    z, fmt = F.col("z"), F.col("format")
    grouped = catalog.groupingSets([[z], [fmt], []], z, fmt).agg(
        F.count(F.lit(1)).alias("tiles"),
        F.sum("size_bytes").alias("size_bytes"),
        F.grouping_id().alias("_g"),
    )
    # Bits of the grouping id: 2 = zoom rolled up, 1 = format rolled up.
    return grouped.select(
        F.when(F.col("_g") == 1, "zoom").when(F.col("_g") == 2, "format").otherwise("total").alias("level"),
        "z",
        "format",
        "tiles",
        "size_bytes",
        F.round(F.col("size_bytes") / F.lit(1024.0 * 1024.0), 2).alias("size_mb"),
    )


def catalog_zoom(catalog: DataFrame, z: int) -> DataFrame:
    """Tiles of one zoom with their URL."""
    _check_zoom(z)
    return catalog.filter(F.col("z") == z).select(
        "z", "x", "y", "format", F.format_string("/tiles/%d/%d/%d.%s", "z", "x", "y", "format").alias("url")
    )


def catalog_lookup(catalog: DataFrame, requests: DataFrame, wanted: str | None = None) -> DataFrame:
    """Best format per requested tile; not found gives NULLs.

    Without a wanted format the preference is mvt, pbf, geojson.  A request for mvt or pbf also
    accepts the other of the two; geojson accepts only itself.
    """
    if wanted is None:
        order = FORMATS
    elif wanted in ("mvt", "pbf"):
        order = [wanted, "pbf" if wanted == "mvt" else "mvt"]
    elif wanted == "geojson":
        order = ["geojson"]
    else:
        raise ValueError(f"Unsupported format: {wanted}")
    rank = F.array_position(F.array(*map(F.lit, order)), F.col("format"))
    keys = ["z", "x", "y"]
    asked = requests.select(*keys).distinct()
    best = (
        catalog.filter(F.col("format").isin(order))
        .groupBy(*keys)
        .agg(F.min_by(F.struct("format", "size_bytes"), rank).alias("best"))
    )
    return asked.join(best, keys, "left").select(
        *keys,
        F.col("best.format").alias("format"),
        F.col("best.size_bytes").alias("size_bytes"),
        F.col("best").isNotNull().alias("found"),
    )
