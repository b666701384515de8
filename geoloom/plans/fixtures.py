"""Map elements and metric samples derived from the given tables.

Each fixture is a select list over one table, written in SQL that Spark and DuckDB read alike,
so the same text makes the Spark frame and the common table expression of the check.  All rows
come from one input row each: nothing here shuffles or groups.  Coordinates are integers
divided once, which both engines round and print alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom import session
from geoloom.functions import geometry as geo


def _div(a: str, b: int) -> str:
    return f"cast({a} as double) / cast({b} as double)"


def _case(value: str, *choices: str) -> str:
    whens = " ".join(f"when {i} then '{c}'" for i, c in enumerate(choices))
    return f"case {value} {whens} end"


_ROADS = [
    "motorway", "trunk", "primary", "secondary", "tertiary", "unclassified", "residential",
    "service", "motorway_link", "trunk_link", "primary_link", "secondary_link", "tertiary_link",
    "footway",
]
_WAY_X = "((o_orderkey*7919)%350000 - 175000 + (o_orderkey*(i+3)*31)%90)"
_WAY_Y = "((o_orderkey*104729)%160000 - 80000 + (o_orderkey*(i+5)*17)%70)"
_BX, _BY = "((p_partkey*7919)%36000*10000 - 180000000)", "((p_partkey*104729)%17000*10000 - 85000000)"
_ZX, _ZY = "((s_suppkey*7919)%340000 - 170000)", "((s_suppkey*104729)%150000 - 75000)"
_ZW, _ZH = "(1000 + (s_suppkey%9)*1500)", "(1000 + (s_suppkey%5)*1200)"
_AX, _AY = "((p_partkey*7919)%340000 - 170000)", "((p_partkey*104729)%150000 - 75000)"
_AW, _AH = "(10 + p_partkey%50)", "(10 + p_partkey%30)"

# name -> (table, select list, rows per input row, condition)
FIXTURES: dict[str, tuple[str, dict[str, str], int, str | None]] = {
    "fx_pois": (
        "customer",
        {
            "id": "c_custkey",
            "lon": _div("(c_custkey*7919)%360000 - 180000", 1000),
            "lat": _div("(c_custkey*104729)%170000 - 85000", 1000),
            "amenity": _case("c_custkey%10", "restaurant", "hospital", "school", "bank", "bench", "pharmacy"),
            "shop": _case("c_custkey%7", "supermarket", "bakery", "kiosk"),
            "tourism": _case("c_custkey%11", "hotel", "artwork"),
            "name": "case when c_custkey%6=0 then null when c_custkey%6=1 then '' else c_name end",
            "phone": "case when c_custkey%4=0 then concat('+1-', cast(c_custkey as varchar(20))) end",
            "ts": "cast(concat('2024-01-', lpad(cast(c_custkey%28+1 as varchar(2)), 2, '0'), ' 00:00:00') as timestamp)",
        },
        1,
        None,
    ),
    "fx_ways": (
        "orders",
        {
            "id": "o_orderkey",
            "n": "cast(2 + o_orderkey%4 as int)",
            "highway": _case("o_orderkey%15", *_ROADS),
            "name": "case when o_orderkey%3=0 then null else concat('Street ', cast(o_orderkey%500 as varchar(20))) end",
            "maxspeed": _case("o_orderkey%4", "50", "80"),
            "surface": _case("o_orderkey%5", "asphalt", "gravel", "paved"),
            "lanes": "cast(o_orderkey%4+1 as varchar(20))",
            "ts": "o_orderdate",
        },
        1,
        None,
    ),
    "fx_vertices": (
        "orders",
        {
            "id": "o_orderkey",
            "i": "cast(i as int)",
            "node_id": "o_orderkey*10 + i",
            "lon": _div(_WAY_X, 1000),
            "lat": _div(_WAY_Y, 1000),
        },
        5,
        "i < 2 + o_orderkey%4",
    ),
    "fx_buildings": (
        "part",
        {
            "id": "p_partkey",
            "x0": _div(_BX, 1000000),
            "y0": _div(_BY, 1000000),
            "x1": _div(f"{_BX} + p_size*10", 1000000),
            "y1": _div(f"{_BY} + (p_partkey%20)*10", 1000000),
            "building": _case("p_partkey%9", "house", "retail", "warehouse", "school", "yes", "no", "detached", "office"),
            "name": "case when p_partkey%4=0 then null else p_name end",
            "height": _case("p_partkey%5", "12", "7.5", "12 m", ""),
            "levels": _case("p_partkey%4", "3", "3.5", "two"),
        },
        1,
        None,
    ),
    "fx_zones": (
        "supplier",
        {
            "id": "s_suppkey",
            "x0": _div(_ZX, 1000),
            "y0": _div(_ZY, 1000),
            "x1": _div(f"{_ZX} + {_ZW}", 1000),
            "y1": _div(f"{_ZY} + {_ZH}", 1000),
            "name": "s_name",
        },
        1,
        None,
    ),
    # One administrative area per part: four corners, four edges, one relation.
    "fx_corners": (
        "part",
        {
            "area_id": "p_partkey",
            "c": "cast(i as int)",
            "id": "p_partkey*4 + i",
            "lon": _div(f"{_AX} + case when i in (1, 2) then {_AW} else 0 end", 1000),
            "lat": _div(f"{_AY} + case when i in (2, 3) then {_AH} else 0 end", 1000),
        },
        4,
        None,
    ),
    "fx_areas": (
        "part",
        {
            "id": "p_partkey",
            "name": "p_name",
            "boundary": "case when p_partkey%3=0 then 'political' else 'administrative' end",
            "w": _div(_AW, 1000),
            "h": _div(_AH, 1000),
        },
        1,
        None,
    ),
    # Vertices as a reference list: ways are orders, nodes are parts, some nodes are missing.
    "fx_refs": (
        "lineitem",
        {"way_id": "l_orderkey", "pos": "l_linenumber", "ref": "l_partkey"},
        1,
        None,
    ),
    "fx_nodes": (
        "part",
        {
            "id": "p_partkey",
            "lon": _div("(p_partkey*7919)%360000 - 180000", 1000),
            "lat": _div("(p_partkey*104729)%170000 - 85000", 1000),
        },
        1,
        "p_partkey%37 <> 0",
    ),
    # A point and two boxes per line item on a small integer grid, so contacts are common.
    "fx_pairs": (
        "lineitem",
        {
            "l_orderkey": "l_orderkey",
            "l_linenumber": "l_linenumber",
            "px": _div("l_partkey%61", 10),
            "py": _div("l_suppkey%61", 10),
            "ax0": _div("l_partkey%5", 1),
            "ay0": _div("l_suppkey%5", 1),
            "ax1": _div("l_partkey%5 + 1 + l_orderkey%3", 1),
            "ay1": _div("l_suppkey%5 + 1 + l_orderkey%2", 1),
            "bx0": _div("l_orderkey%4", 1),
            "by0": _div("l_linenumber%4", 1),
            "bx1": _div("l_orderkey%4 + 2 + l_partkey%3", 1),
            "by1": _div("l_linenumber%4 + 2 + l_suppkey%3", 1),
        },
        1,
        None,
    ),
    "fx_metrics": (
        "events",
        {
            "sample_id": "event_id",
            "name": "event_type",
            "value": "value",
            "ts": "ts",
            "label_key": "concat('{\"bucket\":\"', cast(user_id%4 as varchar(20)), '\"}')",
        },
        1,
        None,
    ),
    "fx_runs": (
        "orders",
        {
            "run_id": "cast(o_orderkey as varchar(20))",
            "start_time": "o_orderdate",
            "status": "case o_orderstatus when 'F' then 'completed' when 'O' then 'running' else 'failed' end",
            "records_processed": "cast(o_custkey as bigint)",
        },
        1,
        None,
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, columns, copies, condition = FIXTURES[name]
    used = " ".join([*columns.values(), condition or ""])
    df = table(spark, sf_dir, source)
    df = session.spread(df.select(*[c for c in df.columns if c in used]))
    if copies > 1:
        df = df.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    if condition:
        df = df.filter(condition)
    return df.selectExpr(*[f"{e} as {c}" for c, e in columns.items()])


def cte(name: str) -> str:
    source, columns, copies, condition = FIXTURES[name]
    select = ", ".join(f"{e} as {c}" for c, e in columns.items())
    copied = f", range(0, {copies}) as copies(i)" if copies > 1 else ""
    where = f" where {condition}" if condition else ""
    return f"{name} as (select {select} from {source}{copied}{where})"


def sql(body: str, *names: str) -> str:
    """The check's SQL with the named fixtures as common table expressions in front."""
    head = "with recursive " + ", ".join(cte(n) for n in names)
    body = body.strip()
    return f"{head}, {body[4:].strip()}" if body.lower().startswith("with") else f"{head} {body}"


# --- fixtures in element form ---------------------------------------------------------------


def _tags(**keys: str) -> str:
    """Map of the non-null values."""
    entries = ", ".join(f"named_struct('k', '{k}', 'v', {v})" for k, v in keys.items())
    return f"map_from_entries(filter(array({entries}), e -> e.v IS NOT NULL AND e.v <> ''))"


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged nodes (NODE columns)."""
    tags = _tags(amenity="amenity", shop="shop", tourism="tourism", name="name", phone="phone")
    return frame(spark, sf_dir, "fx_pois").selectExpr(
        "id", "lat", "lon", f"{tags} as tags", "cast(1 as int) as version", "ts as timestamp"
    )


def way_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untagged way nodes; every 37th is missing from the data."""
    return (
        frame(spark, sf_dir, "fx_vertices")
        .filter("node_id % 37 <> 0")
        .selectExpr(
            "node_id as id", "lat", "lon", "cast(map() as map<string, string>) as tags",
            "cast(1 as int) as version", "cast(null as timestamp) as timestamp",
        )
    )


def ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ways with node references and their WKT geometry (WAY columns)."""
    vertex = (
        "transform(sequence(0, n - 1), i -> named_struct("
        f"'x', {_div(_WAY_X, 1000)}, 'y', {_div(_WAY_Y, 1000)}))"
    ).replace("o_orderkey", "id")
    tags = _tags(
        highway="highway", name="name", maxspeed="maxspeed", surface="surface", lanes="lanes"
    )
    return frame(spark, sf_dir, "fx_ways").selectExpr(
        "id",
        "transform(sequence(0, n - 1), i -> id*10 + i) as nodes",
        f"{tags} as tags",
        f"{geo.let(geo.line(vertex), geo.to_wkt)} as geometry",
        "cast(1 as int) as version",
        "cast(ts as timestamp) as timestamp",
    )


def box_wkt() -> str:
    return geo.let(geo.box("x0", "y0", "x1", "y1"), geo.to_wkt)


def building_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Building ways that carry their WKT geometry (WAY columns, no references)."""
    tags = _tags(building="building", name="name", height="height", levels="levels")
    return frame(spark, sf_dir, "fx_buildings").selectExpr(
        "id", "cast(null as array<bigint>) as nodes", f"{tags} as tags",
        f"{box_wkt()} as geometry", "cast(1 as int) as version",
        "cast(null as timestamp) as timestamp",
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, "fx_zones").selectExpr(
        "id as zone_id", "name as zone_name", f"{box_wkt()} as geometry_wkt"
    )


def areas(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Relations, their member ways and the ways' nodes.  Every second area has a reversed edge."""
    rel = frame(spark, sf_dir, "fx_areas").selectExpr(
        "id",
        "transform(array(0, 2, 1, 3), e -> named_struct("
        "'type', 'way', 'ref', id*4 + e, 'role', 'outer')) as members",
        f"{_tags(boundary='boundary', name='name')} as tags",
        "cast(1 as int) as version",
        "cast(null as timestamp) as timestamp",
    )
    edge = frame(spark, sf_dir, "fx_corners").selectExpr(
        "id",
        "case when c = 2 and area_id % 2 = 1 "
        "then array(area_id*4 + (c + 1) % 4, id) else array(id, area_id*4 + (c + 1) % 4) end as nodes",
        "cast(map('name', cast(c as string)) as map<string, string>) as tags",
        "cast(null as string) as geometry",
        "cast(1 as int) as version",
        "cast(null as timestamp) as timestamp",
    )
    node = frame(spark, sf_dir, "fx_corners").selectExpr(
        "id", "lat", "lon", "cast(map() as map<string, string>) as tags",
        "cast(1 as int) as version", "cast(null as timestamp) as timestamp",
    )
    return rel, edge, node


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, "fx_metrics").selectExpr(
        "sample_id", "name", "value", "cast(ts as timestamp) as timestamp", "label_key"
    )
