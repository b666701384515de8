"""Metrics in batch and streaming, retention and upserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoloom import schemas, session
from geoloom.functions import tilemath
from geoloom.operators import metrics, retention
from geoloom.plans import fixtures as fx
from geoloom.plans.registry import query
from geoloom.plans.tile_queries import _sx, _sy
from geoloom.sources import parts, sinks
from geoloom.streaming import alert_state
from geoloom.streaming import metrics as stream_metrics

_NOW = "(select max(ts) from fx_metrics)"


def _stamp(c: str, name: str | None = None):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(name or c)


def _rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


_STATS = ["sum", "avg", "min", "max", "stddev", "p50", "p95", "p99"]
_QUANTILES = ", ".join(
    f"case when count(*) > 1 then round(quantile_cont(value, {p}), 6) end as {n}" for n, p in metrics.PERCENTILES.items()
)
_AGG = (
    "count(*) as count, round(sum(value), 6) as sum, round(avg(value), 6) as avg, round(min(value), 6) as min, "
    f"round(max(value), 6) as max, round(stddev_samp(value), 6) as stddev, {_QUANTILES}"
)


def _windows(step: str, source: str = "fx_metrics") -> str:
    """Window aggregates in DuckDB; step is an interval text."""
    return (
        f"select name, label_key, time_bucket(interval '{step}', ts) as window_start, "
        f"time_bucket(interval '{step}', ts) + interval '{step}' as window_end, count(*) as n, avg(value) as avg "
        f"from {source} group by all"
    )


def _stats_sql(step: str, closed: bool = False) -> str:
    open_ = f" where window_end <= {_NOW} - interval '1 minute'" if closed else ""
    return (
        f"select strftime(window_start, '%Y-%m-%d %H:%M:%S') as window_start, strftime(window_end, '%Y-%m-%d %H:%M:%S') as window_end, "
        f"name, label_key, {_AGG} from (select *, time_bucket(interval '{step}', ts) as window_start, "
        f"time_bucket(interval '{step}', ts) + interval '{step}' as window_end from fx_metrics) w{open_} group by all"
    )


def _shown(df):
    return _rounded(df, *_STATS).withColumns({"window_start": _stamp("window_start"), "window_end": _stamp("window_end")})


@query("i1_metric_samples", fx.sql(
    "select name, metric_type, unit, count(*) as n, round(sum(value), 2) as total, count(distinct label_key) as label_sets from ("
    "select event_type as name, 'counter' as metric_type, '' as unit, 1.0::double as value, cast(user_id % 4 as varchar) as label_key from events union all "
    "select 'order_price', 'histogram', 'usd', o_totalprice, o_orderpriority from orders union all "
    "select 'balance', 'gauge', 'usd', s_acctbal, cast(s_nationkey as varchar) from supplier union all "
    "select 'run_time', 'timing', 'seconds', cast(o_custkey as double), o_orderstatus from orders) m group by all", "fx_runs"))
def metric_samples(spark, sf_dir):
    """Counter, histogram, gauge and timing samples from four kinds of rows."""
    label = lambda k, c: F.create_map(F.lit(k), F.col(c).cast("string"))
    events, orders, supplier = (fx.table(spark, sf_dir, t) for t in ("events", "orders", "supplier"))
    bucket = F.create_map(F.lit("bucket"), (F.col("user_id") % 4).cast("string"))
    ts = lambda c: F.col(c).cast("timestamp")
    every = metrics.samples(
        events, "event", "counter", F.lit(1.0), ts("ts"),
        F.map_concat(bucket, label("type", "event_type")), F.col("event_id"),
    )
    every = every.withColumn("name", F.col("labels")["type"]).withColumn(
        "labels", F.map_filter("labels", lambda k, v: k != "type")
    )
    every = every.unionByName(metrics.samples(
        orders, "order_price", "histogram", F.col("o_totalprice"), ts("o_orderdate"), label("priority", "o_orderpriority"), F.col("o_orderkey"), "usd"))
    every = every.unionByName(metrics.samples(
        supplier, "balance", "gauge", F.col("s_acctbal"), F.current_timestamp(), label("nation", "s_nationkey"), F.col("s_suppkey"), "usd"))
    every = every.unionByName(metrics.samples(
        orders, "run_time", "timing", F.col("o_custkey"), ts("o_orderdate"), label("status", "o_orderstatus"), F.col("o_orderkey")))
    return every.withColumn("label_key", metrics.label_key()).groupBy("name", "metric_type", "unit").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"), F.count_distinct("label_key").alias("label_sets")
    )


@query("i2_metric_windows", fx.sql(_stats_sql("1 minute"), "fx_metrics"))
def metric_windows(spark, sf_dir):
    return _shown(metrics.metric_windows(fx.metric_samples(spark, sf_dir)))


@query("i2_metric_windows_daily", fx.sql(_stats_sql("1 day"), "fx_metrics"))
def metric_windows_daily(spark, sf_dir):
    return _shown(metrics.metric_windows(fx.metric_samples(spark, sf_dir), "1 day"))


@query("i3_percentile_linear", fx.sql(f"select name, {_AGG} from fx_metrics group by name", "fx_metrics"))
def percentile_linear(spark, sf_dir):
    """Percentiles of whole metrics, the largest groups there are."""
    df = metrics.exact_percentiles(fx.metric_samples(spark, sf_dir), ["name"], "value", metrics.PERCENTILES)
    return _rounded(df, *_STATS)


# Example rules over the fixture's metrics; thresholds near the usual averages so both outcomes occur.
RULES = [
    metrics.AlertRule("click", 40.0, 45.0, "greater_than", 21600, 2),
    metrics.AlertRule("view", 55.0, 50.0, "less_than", 14400, 3),
    metrics.AlertRule("purchase", 40.0, 30.0, "greater_than", 43200, 4),
    metrics.AlertRule("error", 60.0, 50.0, "greater_than", 90000, 5),
    metrics.AlertRule("signup", 60.0, 50.0, "greater_than", 90000, 2),
]
# Two rules on one metric, alike but for the period and the number of points.
TWO_RULES = [
    metrics.AlertRule("click", 40.0, 45.0, "greater_than", 21600, 2),
    metrics.AlertRule("click", 40.0, 45.0, "greater_than", 90000, 4),
    metrics.AlertRule("view", 55.0, 50.0, "less_than", 14400, 3),
]


def _rule_values(rules) -> str:
    return ", ".join(
        f"({i}::int, '{r.metric_name}', {r.critical_threshold}::double, '{r.comparison_operator}', {r.evaluation_period}, {r.datapoints_to_alarm})"
        for i, r in enumerate(rules)
    )


def _alerts_sql(closed: bool = False, rules=RULES) -> str:
    open_ = f" where window_end <= {_NOW} - interval '1 minute'" if closed else ""
    return (
        f"with agg as (select * from ({_windows('1 hour')}) w{open_}), rules(rule, name, limit_, op, period, k) as (values {_rule_values(rules)}), "
        "judged as (select a.*, rule, limit_, period, k, case op when 'greater_than' then avg > limit_ when 'less_than' then avg < limit_ else abs(avg - limit_) < 0.001 end as bad "
        "from agg a join rules using (name)), "
        "seen as (select *, list({'t': window_end, 'bad': bad}) over (partition by rule order by window_end, label_key rows between unbounded preceding and current row) as h, "
        "lead(window_end) over (partition by rule order by window_end, label_key) as next_end from judged), "
        "cut as (select *, h[len(h) - k + 1 :] as tail from seen where len(h) >= k and (next_end is null or next_end > window_end)) "
        "select name as metric_name, 'critical' as threshold_type, limit_ as threshold_value, round(avg, 6) as actual_value, "
        "strftime(window_end, '%Y-%m-%d %H:%M:%S') as timestamp, label_key, rule from cut "
        "where len(list_filter(tail, lambda e: not e.bad or e.t < window_end - to_seconds(period))) = 0"
    )


def _alert_columns(df):
    return df.withColumns({"timestamp": _stamp("timestamp"), "actual_value": F.round("actual_value", 6)})


@query("i4_alerts", fx.sql(_alerts_sql(), "fx_metrics"))
def alerts(spark, sf_dir):
    hourly = metrics.metric_windows(fx.metric_samples(spark, sf_dir), "1 hour")
    return _alert_columns(metrics.alerts(hourly, RULES))


@query("i4_alerts_two_rules", fx.sql(_alerts_sql(rules=TWO_RULES), "fx_metrics"))
def alerts_two_rules(spark, sf_dir):
    """Rules on one metric are judged apart."""
    hourly = metrics.metric_windows(fx.metric_samples(spark, sf_dir), "1 hour")
    return _alert_columns(metrics.alerts(hourly, TWO_RULES))


@query("i5_metric_summary", fx.sql(
    f"select name as metric_name, count(*) as data_points, round(arg_max(avg, (window_end, label_key)), 6) as latest_value, round(min(avg), 6) as min_value, "
    f"round(max(avg), 6) as max_value, round(avg(avg), 6) as avg_value, round(stddev_samp(avg), 6) as stddev, cast(48 as int) as time_range_hours "
    f"from ({_windows('1 hour')}) w where window_end >= {_NOW} - interval 48 hour group by name", "fx_metrics"))
def metric_summary(spark, sf_dir):
    samples = fx.metric_samples(spark, sf_dir)
    hourly = metrics.metric_windows(samples, "1 hour")
    df = metrics.metric_summary(hourly, 48, metrics.as_of(samples, "timestamp"))
    return _rounded(df, "latest_value", "min_value", "max_value", "avg_value", "stddev")


_HEALTH = (
    "select '{label}' as checked, count(*) as total_metrics_collected, count(*) filter ({error}) as metrics_collection_errors, "
    "cast({late} as bigint) as seconds_since_last, case when {late} > 300 then 'unhealthy' "
    "when count(*) filter ({error}) / count(*)::double > 0.1 then 'degraded' else 'healthy' end as status from fx_metrics"
)


@query("i6_health", fx.sql(
    " union all ".join([
        _HEALTH.format(label="now", error="value < 1", late=0),
        _HEALTH.format(label="errors", error="value < 60", late=0),
        _HEALTH.format(label="late", error="value < 60", late=600),
    ]), "fx_metrics"))
def health(spark, sf_dir):
    """Healthy, degraded by its errors, and unhealthy because nothing new arrived."""
    df = fx.metric_samples(spark, sf_dir)
    now = lambda: metrics.as_of(df, "timestamp")
    rows = [
        metrics.health(df, F.col("value") < 1, now()).withColumn("checked", F.lit("now")),
        metrics.health(df, F.col("value") < 60, now()).withColumn("checked", F.lit("errors")),
        metrics.health(df, F.col("value") < 60, now() + F.expr("INTERVAL 10 MINUTES")).withColumn("checked", F.lit("late")),
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).drop("last_metric_timestamp")


@query("i7_aggregate_retention", fx.sql(
    f"select strftime(window_end, '%Y-%m-%d %H:%M:%S') as window_end, name, label_key, n as count from ({_windows('1 minute')}) w "
    f"where window_end >= {_NOW} - interval 1 hour", "fx_metrics"))
def aggregate_retention(spark, sf_dir):
    samples = fx.metric_samples(spark, sf_dir)
    kept = metrics.retain_aggregates(metrics.metric_windows(samples), metrics.as_of(samples, "timestamp"))
    return kept.select(_stamp("window_end"), "name", "label_key", "count")


@query("i8_recent_samples", fx.sql(
    "select sample_id, name, round(value, 6) as value from fx_metrics order by ts desc, sample_id desc limit 500", "fx_metrics"))
def recent_samples(spark, sf_dir):
    return metrics.recent_samples(fx.metric_samples(spark, sf_dir), 500).select("sample_id", "name", F.round("value", 6).alias("value"))


@query("i9_counter_totals", fx.sql(
    "select name, label_key, day, round(increment, 4) as increment, round(sum(increment) over (partition by name, label_key order by day), 4) as total from ("
    "select name, label_key, strftime(ts, '%Y-%m-%d') as day, sum(value) as increment from fx_metrics group by all) d", "fx_metrics"))
def counter_totals(spark, sf_dir):
    df = metrics.counter_totals(fx.metric_samples(spark, sf_dir))
    return _rounded(df.withColumn("day", F.col("day").cast("string")), "increment", "total", digits=4)


@query("i10_gauge_latest", fx.sql(
    "select name, label_key, round(arg_max(value, (ts, sample_id)), 6) as value, strftime(max(ts), '%Y-%m-%d %H:%M:%S') as timestamp from fx_metrics group by name, label_key", "fx_metrics"))
def gauge_latest(spark, sf_dir):
    df = metrics.gauge_latest(fx.metric_samples(spark, sf_dir))
    return _rounded(df, "value").withColumn("timestamp", _stamp("timestamp"))


@query("i11_freshness", fx.sql(
    f"select *, case when age_hours > 1 then 'stale' else 'fresh' end as status from (select concat(name, label_key) as source, "
    f"round((epoch(date_trunc('second', {_NOW})) - epoch(date_trunc('second', max(ts)))) / 3600.0, 6) as age_hours from fx_metrics group by 1) a", "fx_metrics"))
def freshness(spark, sf_dir):
    df = fx.metric_samples(spark, sf_dir).withColumn("feed", F.concat("name", "label_key"))
    out = metrics.freshness(df, "feed", "timestamp", metrics.as_of(df, "timestamp"), 1.0)
    return _rounded(out, "age_hours").select("source", "age_hours", "status")


# --- streaming ------------------------------------------------------------------------------


def _event_stream(spark, sf_dir):
    schema = fx.table(spark, sf_dir, "events").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    columns = fx.FIXTURES["fx_metrics"][1]
    return raw.selectExpr(*[f"{e} as {c}" for c, e in columns.items()]).selectExpr(
        "sample_id", "name", "value", "cast(ts as timestamp) as timestamp", "label_key"
    )


def _finished(spark, path):
    stats = "count bigint, sum double, avg double, min double, max double, stddev double, p50 double, p95 double, p99 double"
    schema = f"window_start timestamp, window_end timestamp, name string, label_key string, {stats}"
    return stream_metrics.read_windows(spark, path, schema)


@query("l1_stream_windows", fx.sql(_stats_sql("1 hour", closed=True), "fx_metrics"))
def stream_windows(spark, sf_dir):
    """Windows closed by the watermark, from a stream over the event file."""
    path, checkpoint = session.new_path(spark, "windows"), session.new_path(spark, "windows-cp")
    stream_metrics.write_windows(_event_stream(spark, sf_dir), path, checkpoint, "1 hour").awaitTermination()
    return _shown(_finished(spark, path))


@query("l2_stream_alerts", fx.sql(_alerts_sql(closed=True), "fx_metrics"))
def stream_alerts(spark, sf_dir):
    """Alerts raised while the windows close."""
    path, found, checkpoint = (session.new_path(spark, n) for n in ("windows", "alerts", "alerts-cp"))
    stream_metrics.write_windows(
        _event_stream(spark, sf_dir), path, checkpoint, "1 hour", rules=RULES, alerts_path=found
    ).awaitTermination()
    schema = "metric_name string, threshold_type string, threshold_value double, actual_value double, timestamp timestamp, label_key string, rule int"
    return _alert_columns(stream_metrics.read_windows(spark, found, schema))


@query("l2_keyed_alerts", fx.sql(_alerts_sql(closed=True), "fx_metrics"))
def keyed_alerts(spark, sf_dir):
    """The same alerts from the state of each metric, without a history table."""
    path, checkpoint = session.new_path(spark, "keyed-alerts"), session.new_path(spark, "keyed-alerts-cp")
    alert_state.write_alerts(_event_stream(spark, sf_dir), RULES, path, checkpoint, "1 hour").awaitTermination()
    return _alert_columns(spark.read.parquet(path))


# --- retention and upserts ------------------------------------------------------------------


def _dated_tiles(spark, sf_dir):
    df = fx.frame(spark, sf_dir, "fx_pois").select(
        F.expr(tilemath.tile_x("lon", "8")).alias("x"), F.expr(tilemath.tile_y("lat", "8")).alias("y"), "ts"
    )
    return df.groupBy("x", "y").agg(F.max("ts").alias("generated_at")).withColumns(
        {"z": F.lit(8), "format": F.when(F.col("x") % 2 == 0, "mvt").otherwise("geojson")}
    )


_DATED = f"select x, y, max(ts) as generated_at, case when x % 2 = 0 then 'mvt' else 'geojson' end as format from (select *, {_sx('8')} as x, {_sy('8')} as y from fx_pois) t group by x, y"
_TILE_NOW = "timestamp '2024-02-10 00:00:00'"


@query("k1_prune_tiles", fx.sql(
    f"select x, y, format from ({_DATED}) t where not (format = 'mvt' and generated_at < {_TILE_NOW} - interval 30 day)", "fx_pois"))
def prune_tiles(spark, sf_dir):
    now = F.lit("2024-02-10").cast("timestamp")
    return retention.prune_tiles(_dated_tiles(spark, sf_dir), now).select("x", "y", "format")


@query("k1_prune_tiles_dry_run", fx.sql(
    f"select count(*) filter (old) as removed, count(*) filter (not old) as kept from (select format = 'mvt' and generated_at < {_TILE_NOW} - interval 30 day as old from ({_DATED}) t) o", "fx_pois"))
def prune_tiles_dry_run(spark, sf_dir):
    now = F.lit("2024-02-10").cast("timestamp")
    return retention.prune_tiles(_dated_tiles(spark, sf_dir), now, dry_run=True)


@query("k2_prune_metrics", fx.sql(
    f"select sample_id, (select count(*) from fx_metrics where ts < {_NOW} - interval 7 day) as removed from fx_metrics where ts >= {_NOW} - interval 7 day", "fx_metrics"))
def prune_metrics(spark, sf_dir):
    df = fx.metric_samples(spark, sf_dir)
    now = lambda: metrics.as_of(df, "timestamp")
    removed = retention.prune_metrics(df, now(), 7, dry_run=True).select("removed").scalar()
    return retention.prune_metrics(df, now(), 7).select("sample_id", removed.alias("removed"))


_STORED = (
    f"select 'tiles' as kind, format || ':' || x || '/' || y as row_key from ({_DATED}) t where not (format = 'mvt' and generated_at < {_TILE_NOW} - interval 30 day) union all "
    "select 'metrics', sample_id::varchar from fx_metrics where ts >= (select max(ts) from fx_metrics) - interval 7 day union all "
    "select 'runs', run_id::varchar from fx_runs where not (status in ('completed', 'failed') and start_time < timestamp '1996-01-01')"
)


@query("k1_prune_stored", fx.sql(_STORED, "fx_pois", "fx_metrics", "fx_runs"))
def prune_stored(spark, sf_dir):
    """Tiles, samples and runs pruned as stored tables, partition by partition."""
    root = session.new_path(spark, "retention")
    samples = fx.metric_samples(spark, sf_dir)
    runs = fx.frame(spark, sf_dir, "fx_runs").withColumn("start_time", F.col("start_time").cast("timestamp"))
    column = F.expr("cast(x div 16 as string)").alias("part")
    parts.commit(
        spark,
        root,
        parts.stage(_dated_tiles(spark, sf_dir).select("*", column), root, "tiles"),
        parts.stage(samples.withColumn("part", F.date_format("timestamp", "yyyy-MM-dd")), root, "metrics"),
        parts.stage(runs.withColumn("part", F.date_format("start_time", "yyyy-MM")), root, "runs"),
    )
    at = lambda text: F.lit(text).cast("timestamp")
    newest = samples.agg(F.max("timestamp").cast("string")).first()[0]
    retention.prune_stored(spark, root, "tiles", retention.stale_tiles(at("2024-02-10")))
    retention.prune_stored(spark, root, "metrics", retention.stale_metrics(at(newest), 7))
    retention.prune_stored(spark, root, "runs", retention.stale_runs(at("1996-01-31"), 30))
    keys = {"tiles": "concat(format, ':', x, '/', y)", "metrics": "cast(sample_id as string)", "runs": "cast(run_id as string)"}
    rows = [parts.read(spark, root, t).select(F.lit(t).alias("kind"), F.expr(k).alias("row_key")) for t, k in keys.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


_RUN_NOW = "(select max(start_time) from fx_runs)"


@query("k3_prune_runs", fx.sql(
    f"select run_id, status from fx_runs where not (status in ('completed', 'failed') and start_time < {_RUN_NOW} - interval 365 day)", "fx_runs"))
def prune_runs(spark, sf_dir):
    runs = fx.frame(spark, sf_dir, "fx_runs")
    return retention.prune_runs(runs, metrics.as_of(runs, "start_time"), 365).select("run_id", "status")


@query("k4_insert_ignore", fx.sql(
    "select run_id, 'running' as status, cast(0 as bigint) as records_processed from fx_runs where status <> 'completed'", "fx_runs"))
def insert_ignore(spark, sf_dir):
    """Completed runs exist; the batch names every run twice.  Appended rows are read back."""
    runs = fx.frame(spark, sf_dir, "fx_runs")
    existing = runs.filter("status = 'completed'")
    batch = runs.selectExpr("run_id", "start_time", "'running' as status", "explode(array(0L, 5L)) as records_processed")
    path = session.new_path(spark, "new-runs")
    sinks.append_rows(retention.insert_ignore(existing, batch), schemas.RUN, path)
    return spark.read.schema(schemas.RUN).parquet(path).select("run_id", "status", "records_processed")


@query("k5_touch_updated_at", fx.sql(
    "select run_id, case when status = 'running' then 'completed' else status end as status, "
    "case when status = 'running' then '2030-01-01 00:00:00' else strftime(start_time, '%Y-%m-%d %H:%M:%S') end as updated_at from fx_runs", "fx_runs"))
def touch_updated_at(spark, sf_dir):
    """Running runs finish, each told twice; only they get the new time."""
    runs = fx.frame(spark, sf_dir, "fx_runs").selectExpr("run_id", "status", "cast(start_time as timestamp) as updated_at")
    done = runs.filter("status = 'running'").selectExpr("run_id", "explode(array('failed later', 'completed')) as status")
    out = retention.upsert(runs, done, F.lit("2030-01-01").cast("timestamp"))
    return out.select("run_id", "status", _stamp("updated_at"))
