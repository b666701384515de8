import math
import random
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from geoloom.operators import metrics
from geoloom.streaming import alert_state, arrivals
from geoloom.streaming import metrics as stream_metrics

T0 = datetime(2024, 1, 1)


def linear_percentile(values, p):
    values = sorted(values)
    k = (len(values) - 1) * p
    lo = int(k)
    hi = min(lo + 1, len(values) - 1)
    return values[lo] + (values[hi] - values[lo]) * (k - lo)


def check(values, row):
    assert row["count"] == len(values)
    assert row["sum"] == pytest.approx(math.fsum(values), rel=1e-9, abs=1e-9)
    assert (row["min"], row["max"]) == (min(values), max(values))
    if len(values) == 1:
        assert row["stddev"] is None and row["p50"] is None and row["p99"] is None
        return
    assert row["stddev"] == pytest.approx(statistics.stdev(values), rel=1e-7, abs=1e-9)
    for name, p in metrics.PERCENTILES.items():
        assert row[name] == pytest.approx(linear_percentile(values, p), rel=1e-12, abs=1e-12)


@pytest.fixture(scope="module")
def groups():
    rng = random.Random(3)
    return {
        "one": [4.2],
        "three": [1.0, 2.0, 10.0],
        "same": [1234567.1] * 7,
        "signs": [rng.gauss(0, 5) for _ in range(501)] + [0.0] * 20,
        "tiny": [rng.uniform(1e-12, 1e-11) for _ in range(50)],
        "wide": [10 ** rng.uniform(-8, 12) * rng.choice((-1, 1)) for _ in range(300)],
        # One group with most rows, most of them one value.
        "hot": [5.0] * 4000 + [rng.uniform(0, 100) for _ in range(2000)],
        "near": [1e6 + rng.random() for _ in range(200)],
    }


def test_exact_percentiles(spark, groups):
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("one", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    out = {r["k"]: r for r in metrics.exact_percentiles(df, ["k"], "v", metrics.PERCENTILES).collect()}
    assert set(out) == set(groups)
    for k, values in groups.items():
        check(values, out[k])


def test_percentiles_of_weighted_counts(spark, groups):
    rows = [(k, v) for k, vs in groups.items() for v in vs]
    counted = spark.createDataFrame(rows, "k string, v double").groupBy("k", "v").agg(F.count("*").alias("n"))
    out = {r["k"]: r for r in metrics.exact_percentiles(counted, ["k"], "v", metrics.PERCENTILES, "n").collect()}
    for k, values in groups.items():
        check(values, out[k])


def test_null_keys_form_a_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "k string, v double")
    out = {r["k"]: r["p50"] for r in metrics.exact_percentiles(df, ["k"], "v", {"p50": 0.5}).collect()}
    assert out == {None: 2.0, "a": None}


def test_value_bins_keep_order(spark):
    rng = random.Random(5)
    values = sorted([rng.choice((-1, 1)) * 10 ** rng.uniform(-300, 300) for _ in range(2000)] + [0.0, -1e-320, 1e-320])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    bins = [r[0] for r in df.orderBy("i").select(metrics.value_bin(F.col("v"))).collect()]
    assert bins == sorted(bins)


def samples(spark, rows):
    return spark.createDataFrame(
        [(i, n, float(v), T0 + timedelta(seconds=s), {"b": "1", "a": str(l)}) for i, (n, s, v, l) in enumerate(rows)],
        "sample_id long, name string, value double, timestamp timestamp, labels map<string,string>",
    ).withColumn("label_key", metrics.label_key())


def test_label_key_ignores_map_order(spark):
    df = spark.sql("SELECT map('b', '1', 'a', '2') AS labels UNION ALL SELECT map('a', '2', 'b', '1')")
    assert [r[0] for r in df.select(metrics.label_key()).distinct().collect()] == ['{"a":"2","b":"1"}']


def alert_rule(**kw):
    return metrics.AlertRule("m", 1.0, 10.0, **{"comparison_operator": "greater_than", **kw})


def minutes(*values):
    return [("m", 60 * i + 5, v, 0) for i, v in enumerate(values)]


@pytest.mark.parametrize(
    "rows, rule, expected",
    [
        (minutes(11, 12, 5, 13, 14), alert_rule(), [2, 5]),
        (minutes(11, 12, 13), alert_rule(datapoints_to_alarm=3), [3]),
        (minutes(9, 8, 12), alert_rule(comparison_operator="less_than"), [2]),
        (minutes(10.0005, 9.9995, 10.1), alert_rule(comparison_operator="equal_to"), [2]),
        (minutes(11, 12), alert_rule(comparison_operator="about"), []),
        # The two violations are further apart than the evaluation period.
        ([("m", 5, 11.0, 0), ("m", 605, 12.0, 0)], alert_rule(), []),
        # Label sets of one metric share its history.
        ([("m", 5, 11.0, 0), ("m", 6, 12.0, 1)], alert_rule(), [1]),
        ([("m", 5, 11.0, 0), ("m", 6, 2.0, 1)], alert_rule(), []),
    ],
)
def test_alerts(spark, rows, rule, expected):
    agg = metrics.metric_windows(samples(spark, rows))
    found = metrics.alerts(agg, [rule]).collect()
    assert sorted((r["timestamp"] - T0).seconds // 60 for r in found) == expected


def test_alerts_per_labels(spark):
    rows = [("m", 5, 11.0, 0), ("m", 6, 12.0, 1), ("m", 65, 13.0, 0)]
    agg = metrics.metric_windows(samples(spark, rows))
    found = metrics.alerts(agg, [alert_rule()], per_labels=True).collect()
    assert [((r["timestamp"] - T0).seconds // 60, r["label_key"]) for r in found] == [(2, '{"a":"0","b":"1"}')]


def test_alerts_look_back_across_slices(spark):
    """Violations on both sides of a slice border still meet."""
    start = 86400 - 120
    rows = [("m", start + 60 * i, 11.0, 0) for i in range(4)]
    found = metrics.alerts(metrics.metric_windows(samples(spark, rows)), [alert_rule()]).collect()
    assert len(found) == 3


def test_health(spark):
    df = samples(spark, [("m", i, float(i), 0) for i in range(20)])
    status = lambda bad, now: metrics.health(df, F.col("value") < bad, F.lit(T0 + timedelta(seconds=now))).first()["status"]
    assert (status(2, 30), status(3, 30), status(3, 400)) == ("healthy", "degraded", "unhealthy")


def test_samples_and_export(spark, tmp_path):
    import json

    df = spark.createDataFrame([(1, 2.5)], "id int, took double")
    s = metrics.samples(df, "run_time", "timing", F.col("took"), F.lit(T0), F.create_map(F.lit("a"), F.lit("b")), F.col("id"))
    assert s.first()["unit"] == "seconds"
    with pytest.raises(ValueError):
        metrics.samples(df, "x", "summary", F.col("took"), F.lit(T0), F.lit(None), F.col("id"))
    doc = json.loads(metrics.export_rows(s, F.lit(T0)).first()[0])
    assert doc == {"name": "run_time", "value": 2.5, "timestamp": "2024-01-01T00:00:00.000000", "labels": {"a": "b"}, "description": ""}


# --- streaming ------------------------------------------------------------------------------

SCHEMA = "sample_id long, name string, value double, timestamp timestamp, labels map<string,string>, label_key string"


def land(df, path, n):
    df.coalesce(1).write.mode("append").parquet(f"{path}/part{n}")


def test_stream_over_several_runs_equals_batch(spark, tmp_path):
    """Files land one after the other; closed windows and alerts equal the batch results."""
    rng = random.Random(11)
    src, out, found, cp = (str(tmp_path / n) for n in ("src", "out", "alerts", "cp"))
    rule = alert_rule(evaluation_period=600, datapoints_to_alarm=3)
    rows = [("m", 60 * i + rng.randrange(60), rng.uniform(6, 18), i % 2) for i in range(60)]
    for n in range(3):
        land(samples(spark, rows[20 * n : 20 * n + 20]), src, n)
        stream = spark.readStream.schema(SCHEMA).parquet(f"{src}/*")
        stream_metrics.write_windows(stream, out, cp, rules=[rule], alerts_path=found).awaitTermination()
    batch = metrics.metric_windows(samples(spark, rows))
    newest = max(r[1] for r in rows)
    closed = batch.filter(F.col("window_end") <= F.lit(T0 + timedelta(seconds=newest - 60)))
    got = stream_metrics.read_windows(spark, out, batch.schema)
    key = lambda r: (r["window_end"], r["label_key"])
    want = {key(r): r["avg"] for r in closed.collect()}
    assert {key(r): r["avg"] for r in got.collect()} == pytest.approx(want)
    assert len(want) > 50
    alerts = metrics.alerts(closed, [rule])
    got_alerts = stream_metrics.read_windows(spark, found, alerts.schema).collect()
    assert sorted(r["timestamp"] for r in got_alerts) == sorted(r["timestamp"] for r in alerts.collect())
    assert got_alerts


@pytest.mark.parametrize("per_labels", [False, True])
def test_keyed_alerts_over_restarts_equal_batch(spark, tmp_path, per_labels):
    """Every landing is a run of its own, so the state comes out of the checkpoint; one metric falls silent."""
    rng = random.Random(12)
    src, found, cp = (str(tmp_path / n) for n in ("src", "alerts", "cp"))
    rules = [alert_rule(evaluation_period=600, datapoints_to_alarm=3), alert_rule(evaluation_period=120, datapoints_to_alarm=2)]
    rows = [("m", 60 * i + rng.randrange(60), rng.uniform(8, 20), i % 2) for i in range(45) if not 20 < i < 33]
    rows += [("n", 60 * i, 50.0, 0) for i in range(45)]
    rows.sort(key=lambda r: r[1])
    for n in range(3):
        land(samples(spark, rows[26 * n : 26 * n + 26]), src, n)
        stream = spark.readStream.schema(SCHEMA).parquet(f"{src}/*")
        alert_state.write_alerts(stream, rules, found, cp, per_labels=per_labels).awaitTermination()
    newest = max(r[1] for r in rows[:78])
    closed = metrics.metric_windows(samples(spark, rows[:78])).filter(F.col("window_end") <= F.lit(T0 + timedelta(seconds=newest - 60)))
    want = [(r.rule, r.timestamp, r.label_key, round(r.actual_value, 9)) for r in metrics.alerts(closed, rules, per_labels).collect()]
    got = [(r.rule, r.timestamp, r.label_key, round(r.actual_value, 9)) for r in spark.read.parquet(found).collect()]
    assert sorted(got) == sorted(want)
    assert {r[0] for r in got} == {0, 1}


def test_late_samples_are_dropped(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("src", "out", "cp"))
    for n, rows in enumerate([[("m", 5, 1.0, 0), ("m", 600, 1.0, 0)], [("m", 10, 9.0, 0), ("m", 900, 1.0, 0)]]):
        land(samples(spark, rows), src, n)
        stream = spark.readStream.schema(SCHEMA).parquet(f"{src}/*")
        stream_metrics.write_windows(stream, out, cp).awaitTermination()
    first = spark.read.parquet(f"{out}/batch_id=*").filter(F.col("window_start") == F.lit(T0)).collect()
    assert [(r["count"], r["avg"]) for r in first] == [(1, 1.0)]


def test_arrivals_process_each_file_once(spark, tmp_path, sample_nodes):
    from geoloom import schemas
    from geoloom.operators import layers

    src, out, cp = (str(tmp_path / n) for n in ("src", "out", "cp"))
    for n in range(2):
        land(sample_nodes.withColumn("id", F.col("id") + 10 * n), src, n)
        arrivals.watch(spark, f"{src}/*", schemas.NODE, layers.poi_nodes, out, cp).awaitTermination()
    assert sorted(r["osm_id"] for r in spark.read.parquet(f"{out}/batch_id=*").collect()) == [1, 2, 11, 12]


def test_percentiles_are_never_gathered_in_the_driver(spark):
    """Values of all windows meet their bins by shuffles, however small they look."""
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 4.0), (None, 3.0)], "k string, v double").coalesce(1)
    got = metrics.exact_percentiles(df, ["k"], "v", {"p50": 0.5})
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
    assert {r["k"]: r["p50"] for r in got.collect()} == {"a": 2.0, None: None}
