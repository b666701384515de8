"""Metric windows and alerts as streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from geoloom.operators import metrics

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

COUNTS = [*metrics.GROUP, "value"]


def value_counts(stream: DataFrame, duration: str, lateness: str) -> DataFrame:
    """How often each value occurs per window, metric and label set; late rows are dropped.

    State is one counter per distinct value, so for real-valued metrics about one row per sample
    of the open windows: ``write_windows`` keeps it in RocksDB.  A window's counters all leave in the micro-batch
    that closes it, which is what lets the batch operator finish the statistics exactly.
    """
    w = F.window("timestamp", duration)
    return (
        stream.withWatermark("timestamp", lateness)
        .groupBy(w.alias("w"), "name", "label_key", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "name",
            "label_key",
            "value",
            "n",
        )
    )


def finish_windows(counts: DataFrame) -> DataFrame:
    return metrics.exact_percentiles(
        counts, metrics.GROUP, "value", metrics.PERCENTILES, weight="n"
    )


def write_windows(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    duration: str = "1 minute",
    lateness: str = "1 minute",
    rules: list[metrics.AlertRule] | None = None,
    alerts_path: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Closed windows to a table, alerts to another.

    Each batch goes to its own folder and is overwritten when it is retried, so a lost executor
    or a restart leaves no duplicates.  For alerts every batch also leaves the aggregates of
    the last evaluation period to the next one; older history is never read again.
    """

    def finish(batch: DataFrame, batch_id: int) -> None:
        target = f"{path}/batch_id={batch_id}"
        batch.persist()  # several branches read it, and it comes out of the state store
        try:
            finish_windows(batch).write.mode("overwrite").parquet(target)
        finally:
            batch.unpersist()
        if rules:
            fresh = batch.sparkSession.read.parquet(target)
            _raise_alerts(fresh, rules, alerts_path, batch_id)

    stream.sparkSession.conf.set(STATE_STORE, ROCKSDB)
    writer = (
        value_counts(stream, duration, lateness)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(finish)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _raise_alerts(
    fresh: DataFrame, rules: list[metrics.AlertRule], path: str, batch_id: int
) -> None:
    """Alerts at the new window ends, looking back over what the previous batch handed on."""
    spark = fresh.sparkSession
    kept = ["name", "label_key", "window_end", "avg"]
    history = fresh.select(*kept)
    if batch_id > 0:
        handed_on = spark.read.schema(history.schema).parquet(f"{path}-recent/batch_id={batch_id - 1}")
        history = history.unionByName(handed_on)
    period = max(r.evaluation_period for r in rules)
    newest = history.agg(F.max("window_end")).scalar()
    recent = history.filter(F.col("window_end") >= newest - F.expr(f"INTERVAL {period} SECONDS"))
    recent.write.mode("overwrite").parquet(f"{path}-recent/batch_id={batch_id}")
    ends = fresh.select(F.col("name").alias("metric_name"), F.col("window_end").alias("timestamp"))
    found = metrics.alerts(history, rules).join(
        ends.distinct(), ["metric_name", "timestamp"], "left_semi"
    )
    found.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_windows(spark: SparkSession, path: str, schema) -> DataFrame:
    """All finished windows; the batch folder is not part of the result."""
    return spark.read.schema(schema).parquet(f"{path}/batch_id=*")
