"""Stored tables whose partitions are replaced together: new folders first, one manifest last.

A root folder holds numbered manifests. The newest names, for every table of the root, the folder of each of
its partitions. Replacing partitions writes only theirs into a folder of its own (``stage``) and then swaps in
a manifest that names the new folders (``commit``), so readers see the old or the new tables, and a run lost
in between leaves the old ones and can be repeated. All other partitions keep their files.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Column that names a row's partition while it is staged: letters, digits, dots and hyphens.
PART = "part"


@dataclass(frozen=True)
class Staged:
    """Partitions of a table that are written and not yet part of it (None: it has no rows any more)."""

    table: str
    schema: str
    folders: dict[str, str | None]


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, path: str) -> list[str]:
    files, place = _files(spark, path)
    return [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []


def manifest(spark: SparkSession, root: str) -> tuple[int, dict]:
    """Number and content of the newest manifest: by table its schema and the folders of its partitions."""
    numbers = [int(n.removesuffix(".json")) for n in _names(spark, f"{root}/manifests") if n.endswith(".json") and n[0] != "."]
    if not numbers:
        return 0, {}
    text = spark.read.text(f"{root}/manifests/{max(numbers):010d}.json", wholetext=True).first()[0]
    return max(numbers), json.loads(text)


def _frame(spark: SparkSession, root: str, schema: str, folders: list[str]) -> DataFrame:
    kind = T.StructType.fromJson(json.loads(schema))
    if not folders:
        return spark.createDataFrame([], kind)
    return spark.read.schema(kind).parquet(*[f"{root}/{f}" for f in folders])


def read(spark: SparkSession, root: str, table: str, parts: list[str] | None = None) -> DataFrame:
    """The table's rows, or those of the named partitions."""
    held = manifest(spark, root)[1][table]
    folders = [f for p, f in held["folders"].items() if parts is None or p in set(parts)]
    return _frame(spark, root, held["schema"], folders)


def part_of_file() -> Column:
    """Partition of a row that ``read`` has just read."""
    return F.regexp_extract(F.col("_metadata.file_path"), f"/{PART}=([^/]+)/[^/]+$", 1)


def stage(df: DataFrame, root: str, table: str, parts: list[str] | None = None) -> Staged:
    """Write rows (with a column ``part``) that are to replace the named partitions, or the whole table."""
    spark = df.sparkSession
    folder = f"{table}-{uuid.uuid4().hex}"
    kind = T.StructType([f for f in df.schema.fields if f.name != PART])
    df.repartition(PART).write.partitionBy(PART).parquet(f"{root}/{folder}")
    made = {n.removeprefix(f"{PART}="): f"{folder}/{n}" for n in _names(spark, f"{root}/{folder}") if n.startswith(f"{PART}=")}
    if parts is None:
        held = manifest(spark, root)[1].get(table, {"folders": {}})
        parts = [*held["folders"], *made]
    outside = set(made) - set(parts)
    if outside:
        raise ValueError(f"rows of {table} are in partitions that are not replaced: {sorted(outside)[:5]}")
    return Staged(table, json.dumps(kind.jsonValue()), {p: made.get(p) for p in parts})


def staged_rows(spark: SparkSession, root: str, staged: Staged) -> DataFrame:
    return _frame(spark, root, staged.schema, [f for f in staged.folders.values() if f])


def commit(spark: SparkSession, root: str, *changes: Staged) -> int:
    """Make staged partitions of one or more tables part of them, all at once."""
    number, tables = manifest(spark, root)
    for change in changes:
        held = tables.get(change.table, {"folders": {}})
        folders = {p: f for p, f in {**held["folders"], **change.folders}.items() if f}
        tables[change.table] = {"schema": change.schema, "folders": folders}
    _swap(spark, root, number + 1, json.dumps(tables))
    return number + 1


def _swap(spark: SparkSession, root: str, number: int, text: str) -> None:
    files, draft = _files(spark, f"{root}/manifests/.{uuid.uuid4().hex}")
    out = files.create(draft)
    out.write(bytearray(text.encode()))
    out.close()
    final = _files(spark, f"{root}/manifests/{number:010d}.json")[1]
    if files.exists(final) or not files.rename(draft, final):
        raise RuntimeError(f"{root} was changed by another run in the meantime")


def sweep(spark: SparkSession, root: str) -> list[str]:
    """Delete what no partition of the newest manifest uses: replaced folders, and those of runs that were lost.

    Not while a reader of an older manifest or a run that has staged something is still at work.
    """
    number, tables = manifest(spark, root)
    used = {f for t in tables.values() for f in t["folders"].values()}
    gone = []
    for folder in _names(spark, root):
        if folder == "manifests":
            old = [f"manifests/{n}" for n in _names(spark, f"{root}/manifests") if n != f"{number:010d}.json"]
        else:
            old = [f"{folder}/{n}" for n in _names(spark, f"{root}/{folder}") if n.startswith(PART) and f"{folder}/{n}" not in used]
        gone += old
    for path in gone:
        files, place = _files(spark, f"{root}/{path}")
        files.delete(place, True)
    return gone
