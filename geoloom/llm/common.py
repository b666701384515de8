"""Small helpers shared by the text operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom import session

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and survives lost executors."""
    path = session.new_path(df.sparkSession, f"{name}-{uuid.uuid4().hex[:8]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z alone. ``lower`` does the same, faster, where no other letter has a case."""
    other = r"[^\x00-\x7F&&[\p{Lu}\p{Lt}\p{Nl}\p{So}]]"
    return F.when(text.rlike(other), F.translate(text, UPPER, UPPER.lower())).otherwise(F.lower(text))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of ``column`` in one piece hold about ``limit`` bytes."""
    for batch in batches:
        lengths = batch.column(column).cast(pa.large_string()).cast(pa.large_binary())
        first, held = 0, 0
        for i, value in enumerate(pc.binary_length(lengths).to_pylist()):
            held += value or 0
            if held >= limit:
                yield batch.slice(first, i + 1 - first)
                first, held = i + 1, 0
        if first < batch.num_rows:
            yield batch.slice(first)
