"""Readers for nodes, ways and relations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom import schemas


@dataclass(frozen=True)
class Elements:
    nodes: DataFrame
    ways: DataFrame
    relations: DataFrame
    metadata: DataFrame


def scan(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Parquet elements below ``path``; kind is nodes, ways or relations."""
    schema = {"nodes": schemas.NODE, "ways": schemas.WAY, "relations": schemas.RELATION}[kind]
    return spark.read.schema(schema).parquet(f"{path}/{kind}")


# --- projections of raw XML rows ------------------------------------------------------------


def tags_map(tag: str = "tag") -> Column:
    """Tag list to map: pairs with an empty key or value are dropped, the last duplicate wins."""
    filled = f"filter({tag}, t -> t._k <> '' AND t._v <> '')"
    last = (
        f"filter({filled}, (t, i) -> "
        f"i = size({filled}) - array_position(reverse(transform({filled}, u -> u._k)), t._k))"
    )
    return F.expr(
        f"coalesce(map_from_entries(transform({last}, t -> struct(t._k, t._v))), "
        "CAST(map() AS MAP<STRING, STRING>))"
    )


def way_refs(nd: str = "nd") -> Column:
    """Node references in document order, empty ones skipped."""
    return F.expr(
        f"coalesce(transform(filter({nd}, n -> n._ref <> ''), n -> try_cast(n._ref AS BIGINT)), "
        "CAST(array() AS ARRAY<BIGINT>))"
    )


def relation_members(member: str = "member") -> Column:
    """Members that have a type and a reference; a missing role is the empty string."""
    return F.expr(
        f"coalesce(transform(filter({member}, m -> m._type <> '' AND m._ref <> ''), "
        "m -> named_struct('type', m._type, 'ref', try_cast(m._ref AS BIGINT), "
        "'role', coalesce(m._role, ''))), "
        "CAST(array() AS ARRAY<STRUCT<type: STRING, ref: BIGINT, role: STRING>>))"
    )


def _common() -> list[Column]:
    return [
        F.col("_version").try_cast("int").alias("version"),
        F.col("_timestamp").try_cast("timestamp").alias("timestamp"),
    ]


def parse_nodes(raw: DataFrame) -> DataFrame:
    """Typed node rows plus ``reject_reason``, NULL for usable rows."""
    typed = raw.select(
        F.col("_id").try_cast("bigint").alias("id"),
        F.col("_lat").try_cast("double").alias("lat"),
        F.col("_lon").try_cast("double").alias("lon"),
        tags_map().alias("tags"),
        *_common(),
    )
    return typed.withColumn(
        "reject_reason",
        F.when(F.col("id").isNull(), "bad id")
        .when(F.col("lat").isNull(), "bad lat")
        .when(F.col("lon").isNull(), "bad lon"),
    )


def parse_ways(raw: DataFrame) -> DataFrame:
    typed = raw.select(
        F.col("_id").try_cast("bigint").alias("id"),
        way_refs().alias("nodes"),
        tags_map().alias("tags"),
        F.lit(None).cast("string").alias("geometry"),
        *_common(),
    )
    return typed.withColumn(
        "reject_reason",
        F.when(F.col("id").isNull(), "bad id").when(
            F.expr("exists(nodes, r -> r IS NULL)"), "bad ref"
        ),
    )


def parse_relations(raw: DataFrame) -> DataFrame:
    typed = raw.select(
        F.col("_id").try_cast("bigint").alias("id"),
        relation_members().alias("members"),
        tags_map().alias("tags"),
        *_common(),
    )
    return typed.withColumn(
        "reject_reason",
        F.when(F.col("id").isNull(), "bad id").when(
            F.expr("exists(members, m -> m.ref IS NULL)"), "bad ref"
        ),
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter("reject_reason IS NULL").drop("reject_reason")


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.filter("reject_reason IS NOT NULL")


def tagged(nodes: DataFrame) -> DataFrame:
    """Nodes that carry at least one tag, the candidates for point features."""
    return nodes.filter(F.size("tags") > 0)


# --- XML files ------------------------------------------------------------------------------

_XML = {
    "node": (schemas.XML_NODE, parse_nodes),
    "way": (schemas.XML_WAY, parse_ways),
    "relation": (schemas.XML_RELATION, parse_relations),
}


# Attributes up to the end of an opening tag, and whether the tag closes itself.
_OPENING = r"""^((?:[^<>"'/]++|/(?!>)|"[^"]*+"|'[^']*+')*+)(/?)>"""


def read_xml_raw(spark: SparkSession, path: str, element: str) -> DataFrame:
    """Elements of XML files as rows of text.

    Uncompressed files are read in splits: the opening of the element separates records, and each is cut
    at its own end.  Only a file that has elements inside comments goes through Spark's XML source, which
    reads a file in one task, and so do gzip files, whose rows are spread right behind that task.
    """
    schema, _ = _XML[element]
    whole = spark.read.format("xml").option("rowTag", element).schema(schema)
    if path.lower().endswith(".gz"):
        return whole.load(path).repartition(spark.sparkContext.defaultParallelism)
    pieces = spark.read.option("lineSep", f"<{element}").text(path)
    rest = F.substring_index("value", "<!--", -1)
    hidden = F.col("value").contains("<!--") & ~rest.contains("-->")
    if not pieces.filter(hidden).isEmpty():
        return whole.load(path)
    end = f"</{element}>"
    inner = F.substring_index("value", end, 1)
    record = F.when(
        F.regexp_extract("value", _OPENING, 2) == "/",
        F.concat(F.lit(f"<{element}"), F.regexp_extract("value", _OPENING, 1), F.lit("/>")),
    ).when(F.col("value").contains(end), F.concat(F.lit(f"<{element}"), inner, F.lit(end)))
    # What precedes the first element, and elements whose name only begins alike, do not match.
    named = F.col("value").rlike(r"^[\s/>]") & F.col("value").rlike(_OPENING)
    records = pieces.filter(named).select(record.alias("record")).filter("record IS NOT NULL")
    return records.select(F.from_xml("record", schema).alias("e")).select("e.*")


def read_xml(spark: SparkSession, path: str, element: str) -> DataFrame:
    """All parsed rows of one element type, with their reject reason."""
    return _XML[element][1](read_xml_raw(spark, path, element))


def detect_format(path: str) -> str:
    name = path.lower().rstrip("/")
    if name.endswith((".osm.gz", ".xml.gz")):
        return "xml.gz"
    if name.endswith(".gz"):
        raise ValueError(f"only XML is read from gzip files, not {path}")
    if name.endswith((".osm", ".xml")):
        return "xml"
    if name.endswith(".pbf"):
        raise ValueError(f"PBF is not read, convert it to XML or Parquet: {path}")
    raise ValueError(f"neither XML nor Parquet: {path}")


def _must_exist(spark: SparkSession, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.globStatus(jvm_path):
        raise FileNotFoundError(f"{path} was not found")


def extract(spark: SparkSession, path: str) -> Elements:
    """All elements of one file as lazy frames, with a one-row description."""
    _must_exist(spark, path)
    kind = detect_format(path)
    nodes, ways, relations = (
        accepted(read_xml(spark, path, e)) for e in ("node", "way", "relation")
    )
    counts = [df.agg(F.count(F.lit(1)).alias("n")) for df in (nodes, ways, relations)]
    total = counts[0].unionByName(counts[1]).unionByName(counts[2])
    metadata = total.agg(F.sum("n").alias("total_elements")).select(
        F.lit(path).alias("source_file"), F.lit(kind).alias("format"), "total_elements"
    )
    return Elements(nodes, ways, relations, metadata)


def read_sources(spark: SparkSession, sources: list[dict], element: str) -> DataFrame:
    """Rows of several configured sources ``{name, url, format, priority}``, marked by origin."""
    out = None
    for source in sources:
        if source.get("format", "parquet") == "parquet":
            df = scan(spark, source["url"], f"{element}s")
        else:
            df = accepted(read_xml(spark, source["url"], element))
        df = df.withColumn("source", F.lit(source["name"])).withColumn(
            "priority", F.lit(source.get("priority", 1))
        )
        out = df if out is None else out.unionByName(df)
    return out
