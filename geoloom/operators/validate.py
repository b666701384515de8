"""Element validation and layer quality checks, each in one aggregation pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions import geometry as geo


def node_reason() -> Column:
    """Why a node is unusable, NULL when it is fine."""
    return (
        F.when(F.col("id").isNull(), "missing id")
        .when(F.col("lat").isNull(), "missing lat")
        .when(F.col("lon").isNull(), "missing lon")
        .when(~F.col("lat").between(-90, 90), "lat out of range")
        .when(~F.col("lon").between(-180, 180), "lon out of range")
    )


def way_reason() -> Column:
    return (
        F.when(F.col("id").isNull(), "missing id")
        .when(F.col("nodes").isNull(), "missing nodes")
        .when(F.size("nodes") < 2, "fewer than two nodes")
    )


def validate_nodes(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("reason", node_reason()).withColumn(
        "is_valid", F.col("reason").isNull()
    )


def validate_ways(ways: DataFrame) -> DataFrame:
    return ways.withColumn("reason", way_reason()).withColumn("is_valid", F.col("reason").isNull())


def validate_dataset(nodes: DataFrame, ways: DataFrame, relations: DataFrame) -> DataFrame:
    """Check rows over all elements: check_type, check_name, status, result_value."""

    def section(df: DataFrame, name: str, reason: Column | None) -> DataFrame:
        bad = F.count_if(reason.isNotNull()) if reason is not None else F.lit(0)
        return df.agg(F.count(F.lit(1)).alias("rows"), bad.cast("bigint").alias("invalid")).select(
            F.lit(name).alias("section"), "rows", "invalid"
        )

    sections = reduce(
        DataFrame.unionByName,
        [
            section(nodes, "nodes", node_reason()),
            section(ways, "ways", way_reason()),
            section(relations, "relations", None),
        ],
    )
    per_section = sections.select(
        F.lit("validation").alias("check_type"),
        F.concat(F.lit("invalid_"), "section").alias("check_name"),
        F.when(F.col("invalid") == 0, "passed").otherwise("failed").alias("status"),
        F.col("invalid").cast("double").alias("result_value"),
    )
    elements = sections.filter("section <> 'relations'").agg(F.sum("rows").alias("n"))
    present = elements.select(
        F.lit("validation").alias("check_type"),
        F.lit("elements_present").alias("check_name"),
        F.when(F.col("n") > 0, "passed").otherwise("failed").alias("status"),
        F.col("n").cast("double").alias("result_value"),
    )
    return per_section.unionByName(present)


def is_valid_dataset(nodes: DataFrame | None, ways: DataFrame | None, relations: DataFrame | None) -> bool:
    if nodes is None or ways is None or relations is None:
        return False
    checks = validate_dataset(nodes, ways, relations)
    return checks.filter("status <> 'passed'").isEmpty()


def quality_check(df: DataFrame, geometry_column: str = "geometry_wkt") -> DataFrame:
    """Exclusive buckets null, empty, invalid and valid, and the share of valid rows in percent."""
    wkt = F.col(geometry_column)
    valid = F.expr(geo.wkt_is_valid(f"`{geometry_column}`"))
    bucket = (
        F.when(wkt.isNull(), "null").when(wkt == "", "empty").when(valid, "valid").otherwise("invalid")
    )
    n = lambda name: F.count_if(F.col("_b") == name)
    counted = (
        df.select(bucket.alias("_b"))
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            n("valid").alias("valid_geometries"),
            n("null").alias("null_geometries"),
            n("empty").alias("empty_geometries"),
            n("invalid").alias("invalid_geometries"),
        )
    )
    percent = F.when(
        F.col("total_records") > 0,
        F.col("valid_geometries") * F.lit(100.0) / F.col("total_records"),
    ).otherwise(F.lit(0.0))
    return counted.withColumn("geometry_completeness_percent", percent).withColumn(
        "quality_score", percent
    )


def quality_rows(quality: DataFrame) -> DataFrame:
    """The one-row quality result as check rows."""
    names = [
        "total_records", "valid_geometries", "null_geometries", "empty_geometries",
        "invalid_geometries", "geometry_completeness_percent", "quality_score",
    ]
    pairs = ", ".join(f"'{n}', CAST({n} AS DOUBLE)" for n in names)
    return quality.selectExpr(
        "'geometry' AS check_type", f"stack({len(names)}, {pairs}) AS (check_name, result_value)"
    )


def record_checks(checks: DataFrame, thresholds: dict[str, float], run_id: str, now: Column) -> DataFrame:
    """Check rows with threshold and status, shaped for the quality table."""
    threshold = F.lit(None).cast("double")
    for name, limit in thresholds.items():
        threshold = F.when(F.col("check_name") == name, F.lit(float(limit))).otherwise(threshold)
    return checks.withColumn("threshold_value", threshold).select(
        F.lit(run_id).alias("run_id"),
        "check_type",
        "check_name",
        F.when(F.col("threshold_value").isNull(), "recorded")
        .when(F.col("result_value") >= F.col("threshold_value"), "passed")
        .otherwise("failed")
        .alias("status"),
        "result_value",
        "threshold_value",
        now.alias("timestamp"),
    )
