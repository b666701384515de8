"""Operational metrics: windows, percentiles, alerts, health and freshness."""

from __future__ import annotations

from dataclasses import astuple, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom import schemas, session

PERCENTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
GROUP = ["window_start", "window_end", "name", "label_key"]

# Value bins per factor of two, see value_bin.
_BINS_PER_OCTAVE = 4096
_BIN_ORIGIN = 5_000_000


def label_key(labels: str = "labels") -> Column:
    """Canonical JSON of a label map: keys sorted."""
    return F.expr(f"to_json(map_from_entries(array_sort(map_entries({labels}))))")


def samples(
    df: DataFrame,
    name: str,
    metric_type: str,
    value: Column,
    timestamp: Column,
    labels: Column,
    sample_id: Column,
    unit: str = "",
    description: str = "",
) -> DataFrame:
    """Rows of any table as metric samples of one counter, histogram, gauge or timing."""
    if metric_type not in ("counter", "histogram", "gauge", "timing"):
        raise ValueError(f"Unknown metric type: {metric_type}")
    return df.select(
        sample_id.cast("bigint").alias("sample_id"),
        F.lit(name).alias("name"),
        F.lit(metric_type).alias("metric_type"),
        value.cast("double").alias("value"),
        timestamp.alias("timestamp"),
        labels.alias("labels"),
        F.lit("seconds" if metric_type == "timing" and not unit else unit).alias("unit"),
        F.lit(description).alias("description"),
    )


# --- windows and exact percentiles ----------------------------------------------------------


def value_bin(value: Column) -> Column:
    """Order-preserving bin of a double that needs no knowledge of the data's range.

    About 4,096 bins per factor of two: a group of n values has at most min(n, some ten
    thousand) bins in practice, and a very large group is spread over that many.
    """
    octave = F.greatest(F.lit(-1100.0), F.least(F.lit(1100.0), F.log2(F.abs(value))))
    scaled = F.floor(octave * _BINS_PER_OCTAVE) + _BIN_ORIGIN
    return F.when(value > 0, scaled).when(value < 0, -scaled).otherwise(F.lit(0).cast("bigint"))


def _bin_anchor(bin_: Column) -> Column:
    """A value inside or next to the bin, around which sums of squares stay precise."""
    size = F.pow(F.lit(2.0), (F.abs(bin_) - _BIN_ORIGIN) / F.lit(float(_BINS_PER_OCTAVE)))
    return F.when(bin_ > 0, size).when(bin_ < 0, -size).otherwise(F.lit(0.0))


def exact_percentiles(
    df: DataFrame, keys: list[str], value: str, percentiles: dict[str, float], weight: str | None = None
) -> DataFrame:
    """Group statistics with exact, linearly interpolated percentiles.

    No task ever holds a whole group: values are counted into bins before the shuffle, the bin
    holding each wanted rank is found from the bin counts, and only the values of those bins
    are looked at, again as counts per distinct value.  Groups of one value have NULL spread
    and percentiles.
    """
    n = F.col(weight) if weight else F.lit(1)
    v = F.col(value)
    rows = df.filter(v.isNotNull())
    counts = (
        rows.withColumn("_bin", value_bin(v))
        .groupBy(*keys, "_bin", v.alias("_v"))
        .agg(F.sum(n).cast("bigint").alias("_n"))
    )
    off = F.col("_v") - _bin_anchor(F.col("_bin"))
    total, off1 = F.sum("_n"), F.sum(off * F.col("_n"))
    bins = (
        counts.groupBy(*keys, "_bin")
        .agg(
            total.alias("_bn"),
            F.sum(F.col("_v") * F.col("_n")).alias("_bsum"),
            off1.alias("_boff"),
            F.sum(off * off * F.col("_n")).alias("_boff2"),
            F.min("_v").alias("_bmin"),
            F.max("_v").alias("_bmax"),
        )
        .withColumn("_bmean", _bin_anchor(F.col("_bin")) + F.col("_boff") / F.col("_bn"))
        .withColumn("_bss", F.col("_boff2") - F.col("_boff") * F.col("_boff") / F.col("_bn"))
    )
    whole = W.partitionBy(*keys)
    running = whole.orderBy("_bin").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = (
        bins.withColumn("count", F.sum("_bn").over(whole))
        .withColumn("_mean", F.sum("_bsum").over(whole) / F.col("count"))
        .withColumn("_upto", F.sum("_bn").over(running))
    )
    deviation = F.greatest(F.col("_bss"), F.lit(0.0)) + F.col("_bn") * F.pow(
        F.col("_bmean") - F.col("_mean"), 2
    )
    stats = placed.groupBy(*keys).agg(
        F.max("count").alias("count"),
        F.sum("_bsum").alias("sum"),
        F.max("_mean").alias("avg"),
        F.min("_bmin").alias("min"),
        F.max("_bmax").alias("max"),
        F.sum(deviation).alias("_ss"),
    )
    # Ranks are 0-based; percentile p needs ranks floor((n-1)p) and the next one.
    lower = lambda p: F.floor((F.col("count") - 1) * F.lit(p))
    holds = lambda r: (r >= F.col("_upto") - F.col("_bn")) & (r < F.col("_upto"))
    needed = F.lit(False)
    for p in percentiles.values():
        needed = needed | holds(lower(p)) | holds(lower(p) + 1)
    wanted = placed.filter((F.col("count") > 1) & needed).select(
        *keys, "_bin", "count", (F.col("_upto") - F.col("_bn")).alias("_before")
    )
    inside = W.partitionBy(*keys, "_bin").orderBy("_v").rowsBetween(
        W.unboundedPreceding, W.currentRow
    )
    on = [F.col(f"w.{k}").eqNullSafe(F.col(f"c.{k}")) for k in [*keys, "_bin"]]
    ranked = (
        wanted.alias("w")
        .join(session.shuffled(counts.alias("c")), on)
        .select("w.*", "c._v", "c._n")
        .withColumn("_upto", F.col("_before") + F.sum("_n").over(inside))
    )
    at = lambda r: F.max(
        F.when((r >= F.col("_upto") - F.col("_n")) & (r < F.col("_upto")), F.col("_v"))
    )
    picks = []
    for name, p in percentiles.items():
        share = (F.max("count") - 1) * F.lit(p) - F.floor((F.max("count") - 1) * F.lit(p))
        lo, hi = at(lower(p)), at(lower(p) + 1)
        picks.append(
            F.when(share == 0, lo).otherwise(lo * (1 - share) + hi * share).alias(name)
        )
    found = ranked.groupBy(*keys).agg(*picks)
    same = [F.col(f"s.{k}").eqNullSafe(F.col(f"f.{k}")) for k in keys]
    return (
        stats.alias("s")
        .join(session.shuffled(found.alias("f")), same, "left")
        .select(
            *[F.col(f"s.{k}") for k in keys],
            "count",
            "sum",
            "avg",
            "min",
            "max",
            F.when(F.col("count") > 1, F.sqrt(F.col("_ss") / (F.col("count") - 1))).alias("stddev"),
            *percentiles,
        )
    )


def with_window(df: DataFrame, duration: str, timestamp: str = "timestamp") -> DataFrame:
    w = F.window(timestamp, duration)
    return df.withColumn("_w", w).withColumns(
        {"window_start": F.col("_w.start"), "window_end": F.col("_w.end")}
    ).drop("_w")


def metric_windows(df: DataFrame, duration: str = "1 minute") -> DataFrame:
    """Aggregates per window, metric and label set; spread and percentiles when n > 1."""
    return exact_percentiles(with_window(df, duration), GROUP, "value", PERCENTILES)


# --- alerts ---------------------------------------------------------------------------------


def violated(value: Column) -> Column:
    limit, op = F.col("critical_threshold"), F.col("comparison_operator")
    return (
        F.when(op == "greater_than", value > limit)
        .when(op == "less_than", value < limit)
        .when(op == "equal_to", F.abs(value - limit) < 0.001)
        .otherwise(F.lit(False))
    )


@dataclass(frozen=True)
class AlertRule:
    metric_name: str
    warning_threshold: float
    critical_threshold: float
    comparison_operator: str = "greater_than"
    evaluation_period: int = 300
    datapoints_to_alarm: int = 2


def rules_frame(spark: SparkSession, rules: list[AlertRule]) -> DataFrame:
    """The rules with their number, which keeps two rules on one metric apart."""
    schema = T.StructType([T.StructField("rule", T.IntegerType(), False), *schemas.ALERT_RULE.fields])
    return spark.createDataFrame([(i, *astuple(r)) for i, r in enumerate(rules)], schema)


def alerts(aggregates: DataFrame, rules: list[AlertRule], per_labels: bool = False) -> DataFrame:
    """Critical alerts, one per rule and evaluation time; ``rule`` is the rule's place in the list.

    At every window end a metric's last k aggregates (label sets mixed unless ``per_labels``)
    must all violate the limit and lie within the evaluation period.  The look-back is bounded
    by that period, so a metric's history is cut into slices that carry over just the period
    before them: a metric that owns a third of all aggregates is spread over its slices.
    """
    slice_seconds = max(3600, max(r.evaluation_period for r in rules))
    series = ["name", "label_key"] if per_labels else ["name"]
    rule = rules_frame(aggregates.sparkSession, rules).withColumnRenamed("metric_name", "name")
    judged = (
        aggregates.select("name", "label_key", "window_end", "avg")
        .join(rule, "name")
        .withColumn("_t", F.unix_timestamp(F.col("window_end").cast("timestamp")))
        .withColumn("_bad", violated(F.col("avg")))
        .withColumn("_own", F.floor(F.col("_t") / slice_seconds))
    )
    last = F.floor((F.col("_t") + F.col("evaluation_period")) / slice_seconds)
    sliced = judged.withColumn("_slice", F.explode(F.sequence("_own", last)))
    parts = [*series, "rule", "_slice"]
    order = W.partitionBy(*parts).orderBy("_t", "label_key")
    longest = max(r.datapoints_to_alarm for r in rules)
    seen = order.rowsBetween(-(longest - 1), W.currentRow)
    history = F.collect_list(F.struct("_t", "_bad")).over(seen)
    k = F.col("datapoints_to_alarm")
    tail = F.expr("slice(_h, -datapoints_to_alarm, datapoints_to_alarm)")
    return (
        sliced.withColumn("_h", history)
        .withColumn("_next", F.lead("_t").over(order))
        .filter(F.col("_slice") == F.col("_own"))
        .filter(F.col("_next").isNull() | (F.col("_next") > F.col("_t")))
        .filter(F.size("_h") >= k)
        .withColumn("_tail", tail)
        .filter(F.expr("forall(_tail, h -> h._bad AND h._t >= _t - evaluation_period)"))
        .select(
            F.col("name").alias("metric_name"),
            F.lit("critical").alias("threshold_type"),
            F.col("critical_threshold").alias("threshold_value"),
            F.col("avg").alias("actual_value"),
            F.col("window_end").alias("timestamp"),
            "label_key",
            "rule",
        )
    )


# --- summaries ------------------------------------------------------------------------------


def as_of(df: DataFrame, timestamp: str) -> Column:
    """The newest time in the data, as a scalar subquery."""
    return df.agg(F.max(timestamp)).scalar()


def recent(df: DataFrame, timestamp: str, period: str, now: Column) -> DataFrame:
    """Rows not older than ``period`` (an interval text) before ``now``."""
    return df.filter(F.col(timestamp) >= now - F.expr(f"INTERVAL {period}"))


def metric_summary(aggregates: DataFrame, hours: int, now: Column) -> DataFrame:
    """Per metric over the last hours: points, latest, min, max, avg and spread of the averages."""
    latest = F.max_by("avg", F.struct("window_end", "label_key"))
    return (
        recent(aggregates, "window_end", f"{int(hours)} HOURS", now)
        .groupBy(F.col("name").alias("metric_name"))
        .agg(
            F.count(F.lit(1)).alias("data_points"),
            latest.alias("latest_value"),
            F.min("avg").alias("min_value"),
            F.max("avg").alias("max_value"),
            F.avg("avg").alias("avg_value"),
            F.stddev_samp("avg").alias("stddev"),
        )
        .withColumn("time_range_hours", F.lit(int(hours)))
    )


def health(df: DataFrame, is_error: Column, now: Column, timestamp: str = "timestamp") -> DataFrame:
    """Error share over 10 % is degraded; nothing new for 300 s is unhealthy and wins."""
    facts = df.agg(
        F.count(F.lit(1)).alias("total_metrics_collected"),
        F.count_if(is_error).alias("metrics_collection_errors"),
        F.max(timestamp).alias("last_metric_timestamp"),
    )
    age = F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp(
        F.col("last_metric_timestamp").cast("timestamp")
    )
    rate = F.col("metrics_collection_errors") / F.greatest(
        F.col("total_metrics_collected"), F.lit(1)
    )
    return facts.withColumn("seconds_since_last", age).withColumn(
        "status",
        F.when(F.col("seconds_since_last") > 300, "unhealthy")
        .when(rate > 0.1, "degraded")
        .otherwise("healthy"),
    )


def retain_aggregates(aggregates: DataFrame, now: Column) -> DataFrame:
    """Aggregates of the last hour."""
    return recent(aggregates, "window_end", "1 HOUR", now)


def recent_samples(df: DataFrame, k: int = 10_000, timestamp: str = "timestamp") -> DataFrame:
    """The newest k samples; each task keeps its own k before they are merged."""
    return df.orderBy(F.col(timestamp).desc(), F.col("sample_id").desc()).limit(k)


def counter_totals(df: DataFrame, timestamp: str = "timestamp") -> DataFrame:
    """Daily increments and the running total per counter and label set.

    Days are summed before the running total, which then sees one row per day.
    """
    daily = df.groupBy("name", "label_key", F.to_date(timestamp).alias("day")).agg(
        F.sum("value").alias("increment")
    )
    run = W.partitionBy("name", "label_key").orderBy("day").rowsBetween(
        W.unboundedPreceding, W.currentRow
    )
    return daily.withColumn("total", F.sum("increment").over(run))


def gauge_latest(df: DataFrame, timestamp: str = "timestamp") -> DataFrame:
    """Last value of each gauge and label set."""
    newest = F.struct(timestamp, "sample_id")
    return df.groupBy("name", "label_key").agg(
        F.max_by("value", newest).alias("value"), F.max(timestamp).alias("timestamp")
    )


def freshness(df: DataFrame, source: str, timestamp: str, now: Column, limit_hours: float) -> DataFrame:
    """Age of the newest row per source against the limit."""
    age = (
        F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp(F.col("latest").cast("timestamp"))
    ) / F.lit(3600.0)
    return (
        df.groupBy(F.col(source).alias("source"))
        .agg(F.max(timestamp).alias("latest"))
        .withColumn("age_hours", age)
        .withColumn(
            "status", F.when(F.col("age_hours") > limit_hours, "stale").otherwise("fresh")
        )
    )


def export_rows(df: DataFrame, now: Column, timestamp: str = "timestamp") -> DataFrame:
    """Samples of the last hour as one JSON text per row, ready for a text sink."""
    body = F.struct(
        "name",
        "value",
        F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        "labels",
        "description",
    )
    return recent(df, timestamp, "1 HOUR", now).select(F.to_json(body).alias("value"))


def export_envelope(df: DataFrame, now: Column, timestamp: str = "timestamp") -> DataFrame:
    """The export's header; the samples themselves stay rows next to it."""
    return (
        recent(df, timestamp, "1 HOUR", now)
        .agg(F.count(F.lit(1)).alias("metrics_count"))
        .select(
            F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("export_timestamp"),
            "metrics_count",
            F.lit("1 hour").alias("time_range"),
        )
    )
