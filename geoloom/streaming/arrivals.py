"""Processing of element files as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def watch(
    spark: SparkSession,
    path: str,
    schema,
    build: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    glob: str | None = None,
    files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Build a layer from every Parquet file that has landed since the last run.

    Each batch overwrites its own folder, so a repeated batch does not duplicate rows.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)

    def process(batch: DataFrame, batch_id: int) -> None:
        build(batch).write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    return (
        reader.parquet(path)
        .writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
