"""Change sets, conflation of two sources and road junctions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom import session
from geoloom.functions import geometry as geo
from geoloom.operators import joins


def apply_changes(current: DataFrame, changes: DataFrame, key: str = "id") -> DataFrame:
    """Latest version per element; elements whose latest version is a deletion disappear.

    ``changes`` has the columns of ``current`` plus ``deleted``.  A row without a version is older
    than any with one; of equal versions a deletion wins, then the later timestamp, then the larger
    row.  The newest row is found by an aggregate, so rows of one id are reduced before the shuffle.
    """
    columns = current.columns
    rest = [c for c in columns if c != key]
    versions = current.withColumn("deleted", F.lit(False)).unionByName(
        changes.select(*columns, "deleted")
    )
    plain = [f.name for f in current.schema.fields if f.name in rest and not _nested(f.dataType)]
    ties = [c for c in ("timestamp",) if c in plain] + [c for c in plain if c not in ("version", "timestamp")]
    order = F.struct(F.coalesce("version", F.lit(-1)).alias("v"), "deleted", *ties)
    newest = versions.groupBy(key).agg(F.max_by(F.struct("deleted", *rest), order).alias("r"))
    alive = newest.filter(~F.col("r.deleted"))
    return alive.select(key, *[F.col(f"r.{c}").alias(c) for c in rest]).select(*columns)


def _nested(kind: T.DataType) -> bool:
    return isinstance(kind, (T.MapType, T.ArrayType, T.StructType, T.VariantType))


def conflate(
    left: DataFrame,
    right: DataFrame,
    distance: float,
    max_name_distance: int,
    left_geom: str = "geometry_wkt",
    right_geom: str = "geometry_wkt",
    max_name_share: float = 0.5,
) -> DataFrame:
    """One partner in ``right`` (osm_id, name, geometry) for each left feature that gets one: near and alike.

    Names are alike if at most ``max_name_distance`` letters and at most ``max_name_share`` of the
    longer name differ.  Features without a name have nothing to be alike in and find no partner.

    A place is matched once: copies (same name and geometry) are one place and share its match.  The
    matching is the one of taking pairs in the order of letters that differ, distance and ids, and
    leaving out every pair with a place already taken.  It is found in rounds: a pair that is the first
    one of both its places is taken in any case, so all such pairs are taken at once.
    """
    spark = left.sparkSession

    def stored(df: DataFrame, name: str) -> DataFrame:
        path = session.new_path(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def groups(df: DataFrame, geom: str, number: str) -> DataFrame:
        named = df.filter(F.col("name") != "").groupBy("name", F.col(geom).alias("geom"))
        return stored(named.agg(F.min("osm_id").alias("id")).withColumn(number, F.monotonically_increasing_id()), f"places-{number}")

    lefts, rights = groups(left, left_geom, "l"), groups(right, right_geom, "r")
    pairs = joins.distance_join(lefts, rights.withColumnRenamed("id", "match_id"), distance, "geom", "geom")
    alike = pairs.withColumn("name_distance", F.levenshtein("name", "name_right")).filter(
        (F.col("name_distance") <= max_name_distance)
        & (F.col("name_distance") <= max_name_share * F.greatest(F.length("name"), F.length("name_right")))
    )
    # Rounded, so that the last bits do not order places equally far away.
    apart = F.round(F.expr(geo.wkt_distance("geom", "geom_right")), 12).alias("apart")
    rank = F.struct("name_distance", apart, "id", "match_id", "l", "r").alias("rank")
    open_ = stored(alike.select("l", "r", rank), "pairs")
    taken = []
    while not open_.isEmpty():
        first = [open_.groupBy(side).agg(F.min("rank").alias("rank")) for side in ("l", "r")]
        both = stored(first[0].join(first[1], "rank").select("l", "r", "rank.match_id", "rank.name_distance"), "taken")
        taken.append(both)
        open_ = stored(open_.join(both.select("l"), "l", "left_anti").join(both.select("r"), "r", "left_anti"), "pairs")
    features = left.select("osm_id", "name", F.col(left_geom).alias("geom"))
    if not taken:
        return features.limit(0).select("osm_id", F.lit(None).cast(right.schema["osm_id"].dataType).alias("match_id"), F.lit(0).alias("name_distance"))
    best = lefts.select("l", "name", "geom").join(reduce(DataFrame.unionByName, taken), "l")
    return features.join(best, ["name", "geom"]).select("osm_id", "match_id", "name_distance")


def road_junctions(vertices: DataFrame) -> DataFrame:
    """Nodes used by at least two ways (rows way_id, ref): ref and number of ways.

    Distinct (ref, way) pairs are formed first, so a node used everywhere is counted from
    partial sums.
    """
    pairs = vertices.select("ref", "way_id").distinct()
    return (
        pairs.groupBy("ref").agg(F.count(F.lit(1)).alias("ways")).filter(F.col("ways") >= 2)
    )
