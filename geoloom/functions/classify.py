"""Scalar classification rules as columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from geoloom import rules


def _lookup(value: Column, groups: Mapping, default) -> Column:
    out = None
    for label, members in groups.items():
        hit = value.isin(members)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(default))


def road_class(road_type: Column) -> Column:
    return _lookup(road_type, rules.ROAD_CLASSES, "local")


def poi_category(amenity: Column, shop: Column, tourism: Column) -> Column:
    return F.coalesce(amenity, shop, tourism, F.lit("other"))


def poi_type(amenity: Column, shop: Column, tourism: Column) -> Column:
    return (
        F.when(amenity.isNotNull(), "amenity")
        .when(shop.isNotNull(), "shop")
        .when(tourism.isNotNull(), "tourism")
        .otherwise("other")
    )


def strict_poi_type(amenity: Column, shop: Column, tourism: Column) -> Column:
    """``key:value`` of the first key whose value is listed, NULL when none is."""
    listed = lambda key, col, values: F.when(
        col.isin(values), F.concat(F.lit(f"{key}:"), col)
    )
    return F.coalesce(
        listed("amenity", amenity, rules.POI_AMENITIES),
        listed("shop", shop, rules.POI_SHOPS),
        listed("tourism", tourism, rules.POI_TOURISM),
    )


def importance_score(category: Column) -> Column:
    return _lookup(category, rules.IMPORTANCE, rules.DEFAULT_IMPORTANCE)


def named(name: Column) -> Column:
    return name.isNotNull() & (name != "")


def building_class(building_type: Column) -> Column:
    return _lookup(building_type, rules.BUILDING_CLASSES, "other")


def height_meters(height: Column) -> Column:
    return F.when(height.rlike(r"^\d+(\.\d+)?$"), height.try_cast("double"))


def num_levels(levels: Column) -> Column:
    return F.when(levels.rlike(r"^\d+$"), levels.try_cast("int"))


def estimated_height(height: Column, levels: Column) -> Column:
    return F.coalesce(height, levels * F.lit(rules.METERS_PER_LEVEL))


def large_enough(area: Column) -> Column:
    return area.isNull() | (area > rules.MIN_BUILDING_AREA)
