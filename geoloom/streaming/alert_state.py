"""Alerts kept as keyed state: each metric remembers just the aggregates its next alert can depend on.

A streaming aggregate gives the average of every closed window; its rows go to the state of their metric, which
holds as many of the newest ones as the longest rule counts and none older than the longest evaluation period.
There is no history table to read back, and a restart goes on from the checkpoint. A metric that falls silent
loses its state by a timer, one evaluation period after its last window.

The alerts are those of ``operators.metrics.alerts`` over the closed windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from geoloom.operators import metrics
from geoloom.streaming.metrics import ROCKSDB, STATE_STORE

MICROS = 1_000_000
FOUND = "metric_name string, threshold_value double, actual_value double, at bigint, label_key string, rule int"
COLUMNS = ["metric_name", "threshold_value", "actual_value", "at", "label_key", "rule"]


def violates(value: float | None, limit: float, operator: str) -> bool:
    if value is None or value != value:
        return False
    if operator == "greater_than":
        return value > limit
    if operator == "less_than":
        return value < limit
    return operator == "equal_to" and abs(value - limit) < 0.001


class AlertProcessor(StatefulProcessor):
    """State of one metric (or of one of its label sets): its newest aggregates, oldest first."""

    def __init__(self, rules: list[metrics.AlertRule]):
        self.rules = [(i, *astuple(r)) for i, r in enumerate(rules)]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "at bigint, label_key string, avg double")
        self.expiry = handle.getValueState("expiry", "at bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        mine = [r for r in self.rules if r[1] == key[0]]
        if not mine:  # no rule asks for this metric
            return
        new = [r for frame in rows for r in zip(frame["at"], frame["label_key"], frame["avg"])]
        new.sort(key=lambda r: (r[0], r[1] is not None, r[1] or ""))
        series = list(self.held.get()) if self.held.exists() else []
        longest, period = max(r[6] for r in mine), max(r[5] for r in mine) * MICROS
        found = []
        for i, row in enumerate(new):
            series.append(row)
            del series[: max(len(series) - longest, 0)]
            if i + 1 < len(new) and new[i + 1][0] == row[0]:
                continue  # a time is judged once all its label sets are in
            for number, name, _, limit, operator, seconds, points in mine:
                last = series[-points:]
                alarm = all(violates(r[2], limit, operator) and r[0] >= row[0] - seconds * MICROS for r in last)
                if alarm and len(last) == points:
                    found.append((name, limit, row[2], row[0], row[1], number))
        if new:
            self.held.put([tuple(r) for r in series if r[0] >= series[-1][0] - period])
            self._expire_at((series[-1][0] + period) // 1000 + 1)
        if found:
            yield pd.DataFrame(found, columns=COLUMNS)

    def _expire_at(self, milliseconds: int) -> None:
        if self.expiry.exists():
            self.handle.deleteTimer(self.expiry.get()[0])
        self.handle.registerTimer(milliseconds)
        self.expiry.update((milliseconds,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.held.clear()
        self.expiry.clear()
        return iter(())

    def close(self) -> None:
        pass


def averages(stream: DataFrame, duration: str, lateness: str) -> DataFrame:
    """Average of every closed window by metric and label set, with the window's end."""
    w = F.window("timestamp", duration).alias("w")
    mean = F.avg("value").alias("avg")
    return stream.withWatermark("timestamp", lateness).groupBy(w, "name", "label_key").agg(mean).select(
        "name", "label_key", "avg", F.col("w.end").alias("window_end"), F.unix_micros("w.end").alias("at")
    )


def write_alerts(
    stream: DataFrame,
    rules: list[metrics.AlertRule],
    path: str,
    checkpoint: str,
    duration: str = "1 minute",
    lateness: str = "1 minute",
    per_labels: bool = False,
    available_now: bool = True,
) -> StreamingQuery:
    """Critical alerts as a table, one per rule and window end at which it alarms.

    A metric without a rule is left out before any state is kept. ``per_labels`` judges every label set for
    itself; otherwise a metric's label sets are one series, which is one key of the state.
    """
    stream.sparkSession.conf.set(STATE_STORE, ROCKSDB)
    wanted = stream.filter(F.col("name").isin(sorted({r.metric_name for r in rules})))
    rows = averages(wanted, duration, lateness)
    keys = ["name"]
    if per_labels:
        rows, keys = rows.withColumn("series", F.col("label_key")), ["name", "series"]
    found = rows.groupBy(*keys).transformWithStateInPandas(AlertProcessor(rules), FOUND, "append", "EventTime")
    shown = found.select(
        "metric_name",
        F.lit("critical").alias("threshold_type"),
        "threshold_value",
        "actual_value",
        F.timestamp_micros("at").alias("timestamp"),
        "label_key",
        "rule",
    )
    writer = shown.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
