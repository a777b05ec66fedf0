import json
import math
import time

from conftest import rows
from pyspark.sql import functions as F

from tidemark.sources import topics as S
from tidemark.streaming import jobs as J, windows as W

EVENTS = "timestamp long, server_timestamp long"


def put(spark, path, values):
    spark.createDataFrame([(json.dumps(v),) for v in values], "value string").coalesce(1).write.mode("append").text(str(path))


def arrivals(spark, path):
    get = lambda c: F.get_json_object("value", f"$.{c}").cast("long").alias(c)
    return S.stream_lines(spark, str(path), 1).select(get("timestamp"), get("server_timestamp"))


def test_closed_windows_equal_the_batch_and_late_rows_are_told(spark, tmp_path):
    batches = [
        [(100 + i, i % 7) for i in range(60)],
        [(150 + i, i % 5) for i in range(100)],  # some fall into the first windows, which are still open
        [(400, 3)],
        [(105, 9), (106, 9), (450, 1)],  # the first two are too late
        [(2000, 0)],
    ]
    source, out, counted = tmp_path / "in", str(tmp_path / "out"), []
    for part in batches:
        put(spark, source, [{"timestamp": t, "server_timestamp": t * 1000 + ms} for t, ms in part])
        windows = W.latency_windows(arrivals(spark, source), 50, "100 seconds")
        query = J.drain(W.window_stream(windows, out, str(tmp_path / "cp"), J.DRAIN))
        counted += [p.observedMetrics[W.METRICS]["rows"] for p in query.recentProgress if W.METRICS in p.observedMetrics]
    closed = spark.read.schema(windows.schema).parquet(out)
    on_time = [r for part in batches for r in part if r not in [(105, 9), (106, 9), (2000, 0)]]
    whole = spark.createDataFrame([(t, t * 1000 + ms) for t, ms in on_time], EVENTS)
    shown = ["window_start", "n", "min_ms", "max_ms", "upper_ms", "mean_ms"]
    assert rows(closed, *shown) == rows(W.latency_windows(whole, 50, "100 seconds"), *shown)
    # Rows read, less those of closed windows and the one still open, are the late ones.
    assert sum(counted) - sum(r.n for r in closed.collect()) - 1 == 2


def test_wider_windows_are_merged_from_sketches_within_their_error(spark):
    n = 60_000
    events = spark.range(n, numPartitions=7).select(
        (F.col("id") % 600).alias("timestamp"), ((F.col("id") % 600) * 1000 + F.pmod(F.xxhash64("id"), F.lit(100_000))).alias("server_timestamp")
    )
    wide = W.wider_windows(W.latency_windows(events, 30, "1 minute"), 300)
    exact = {r.w: r for r in events.groupBy(F.expr("timestamp div 300 * 300 AS w")).agg(
        F.sort_array(F.collect_list(F.expr("cast(server_timestamp - timestamp * 1000 AS double)"))).alias("ms")
    ).collect()}
    got = wide.collect()
    assert sorted(r.window_start for r in got) == [0, 300]
    for r in got:
        ms = exact[r.window_start].ms
        assert r.n == len(ms) and (r.min_ms, r.max_ms) == (ms[0], ms[-1]) and math.isclose(r.mean_ms, sum(ms) / len(ms), rel_tol=1e-9)
        rank = sum(v <= r.upper_ms for v in ms) / len(ms)
        assert abs(rank - W.UPPER) < 0.003


def test_no_events_and_rows_without_time_give_no_windows(spark):
    empty = spark.createDataFrame([(None, 5), (5, None)], EVENTS)
    assert W.latency_windows(empty, 50, "1 minute").count() == 0
    assert W.wider_windows(W.latency_windows(empty.filter("1 = 0"), 50, "1 minute"), 100).count() == 0


def keyed(spark, path):
    return S.stream_lines(spark, str(path), 1).withColumn("shard", F.get_json_object("value", "$.s"))


def test_groups_end_by_size_and_the_rest_waits_over_a_restart(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")

    def drained():
        groups = W.flush_groups(keyed(spark, source), size=3, wait=None)
        J.drain(W.flush_stream(groups, out, str(tmp_path / "cp"), J.DRAIN))
        found = spark.read.schema(groups.schema).parquet(out)
        return rows(found.groupBy("shard", "flush", "reason").agg(F.count("*").alias("n")), "shard", "flush", "reason", "n")

    put(spark, source, [{"s": "a", "i": i} for i in range(7)] + [{"s": "b", "i": 0}, {"i": 1}])
    assert drained() == [("a", 0, "size", 3), ("a", 1, "size", 3)]
    put(spark, source, [{"s": "a", "i": 7}, {"s": "b", "i": 1}, {"i": 2}])
    assert drained() == [("a", 0, "size", 3), ("a", 1, "size", 3)]
    put(spark, source, [{"s": "a", "i": 8}, {"i": 3}])
    assert drained() == sorted([("a", f, "size", 3) for f in range(3)] + [(None, 0, "size", 3)], key=repr)


def test_groups_end_by_time(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    put(spark, source, [{"s": "a", "i": i} for i in range(7)])
    groups = W.flush_groups(keyed(spark, source), size=3, wait="2 seconds")
    query = W.flush_stream(groups, out, str(tmp_path / "cp"), {"processingTime": "200 milliseconds"})
    try:
        found, until = None, time.monotonic() + 60
        while time.monotonic() < until and query.isActive:
            time.sleep(0.5)
            found = spark.read.schema(groups.schema).parquet(out) if (tmp_path / "out" / "_spark_metadata").exists() else None
            if found is not None and found.count() == 7:
                break
        kinds = found.groupBy("flush", "reason").agg(F.count("*").alias("n"))
        assert rows(kinds, "flush", "reason", "n") == [(0, "size", 3), (1, "size", 3), (2, "time", 1)]
    finally:
        query.stop()


def test_the_fixed_size_and_interval_are_the_defaults(spark, tmp_path):
    put(spark, tmp_path / "in", [{"s": "a", "i": i} for i in range(S.FLUSH_EVENTS + 1)])
    groups = W.flush_groups(keyed(spark, tmp_path / "in"), wait=None)
    J.drain(W.flush_stream(groups, str(tmp_path / "out"), str(tmp_path / "cp"), J.DRAIN))
    assert spark.read.schema(groups.schema).parquet(str(tmp_path / "out")).count() == S.FLUSH_EVENTS == 500
    assert S.FLUSH_INTERVAL == "2 seconds"
