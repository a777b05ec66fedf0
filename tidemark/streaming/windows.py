"""Window metrics of a stream with mergeable sketches, and row groups that end by size or by time."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.plans.events import ingest_latency
from tidemark.sources.topics import FLUSH_EVENTS, FLUSH_INTERVAL
from tidemark.streaming.jobs import EVERY

# Rank error about 0.1 %; a sketch of fewer values holds them all.
SKETCH_K = 4000
UPPER = 0.95
METRICS = "window_rows"


def _summary(q: float) -> list[Column]:
    return [F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias("upper_ms"), F.col("sketch")]


def latency_windows(events: DataFrame, seconds: int, delay: str, q: float = UPPER) -> DataFrame:
    """Count, mean, extremes, upper quantile and quantile sketch of the ingest latency per window of event time.

    Batch and streaming frames alike. In a stream the state keeps one row per
    open window and merges the partial sketches of every micro-batch into it;
    a window closes, and is sent in append mode, once the watermark (``delay``
    behind the newest event) passes its end. Events of closed windows are too
    late and dropped: the rows observed as ``window_rows`` less the ``n`` of all
    windows are those. The quantile is a value of the window whose rank is off by
    the sketch's error at most; without a time or latency an event counts nowhere.
    """
    timed = ingest_latency(events).select(F.timestamp_seconds("timestamp").alias("at"), F.col("latency_ms").cast("double").alias("ms"))
    timed = timed.filter("at IS NOT NULL AND ms IS NOT NULL").observe(METRICS, F.count("*").alias("rows"))
    grouped = timed.withWatermark("at", delay).groupBy(F.window("at", f"{seconds} seconds").alias("w"))
    sketched = grouped.agg(
        F.count("*").alias("n"), F.avg("ms").alias("mean_ms"), F.min("ms").alias("min_ms"), F.max("ms").alias("max_ms"),
        F.kll_sketch_agg_double("ms", F.lit(SKETCH_K)).alias("sketch"),
    )
    return sketched.select(F.unix_seconds("w.start").alias("window_start"), "n", "mean_ms", "min_ms", "max_ms", *_summary(q))


def wider_windows(windows: DataFrame, seconds: int, q: float = UPPER) -> DataFrame:
    """Closed windows merged into wider ones; the events are not read again.

    ``seconds`` must be a multiple of the windows' own width.
    """
    start = (F.floor(F.col("window_start") / seconds) * seconds).cast("bigint").alias("window_start")
    merged = windows.groupBy(start).agg(
        F.sum("n").alias("n"), (F.sum(F.col("mean_ms") * F.col("n")) / F.sum("n")).alias("mean_ms"), F.min("min_ms").alias("min_ms"),
        F.max("max_ms").alias("max_ms"), F.kll_merge_agg_double("sketch").alias("sketch"),
    )
    return merged.select("window_start", "n", "mean_ms", "min_ms", "max_ms", *_summary(q))


def window_stream(windows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Closed windows of :func:`latency_windows`, each written once."""
    writer = windows.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or EVERY)).start()


def _buffer(size: int, wait_ms: int | None):
    def run(key, parts, state: GroupState):
        held, flush, due = json.loads(state.get[0]) if state.exists else ([], 0, 0)
        now = 0 if wait_ms is None else state.getCurrentProcessingTimeMs()

        def sent(rows, reason):
            frame = pd.DataFrame(rows, columns=["key", "value"])
            return frame.assign(shard=key[0], flush=flush, reason=reason)[["shard", "flush", "reason", "key", "value"]]

        if state.hasTimedOut:
            yield sent(held, "time")
            held, flush = [], flush + 1
        else:
            for part in parts:
                for k, v in zip(part["key"], part["value"]):
                    if not held:
                        due = now + (wait_ms or 0)
                    held.append((None if pd.isna(k) else k, None if pd.isna(v) else v))
                    if len(held) >= size:
                        yield sent(held, "size")
                        held, flush = [], flush + 1
        state.update((json.dumps([held, flush, due]),))
        if held and wait_ms is not None:
            state.setTimeoutDuration(max(1, due - now))

    return run


def flush_groups(records: DataFrame, shard: str = "shard", size: int = FLUSH_EVENTS, wait: str | None = FLUSH_INTERVAL) -> DataFrame:
    """A stream of ``key``/``value`` records in groups that end at ``size`` rows or ``wait`` after their first row.

    Each ``shard`` (text) fills one group at a time, so the state holds fewer
    than ``size`` rows a shard however fast it comes; deal a busy stream over
    more shards. Rows come out with their group's number (``shard``, ``flush``),
    and the ``reason`` it ended. Groups end by time at the first micro-batch after their
    wait; Spark then runs batches without data too, so such a query never ends by
    itself. With ``wait`` None groups end by size alone and a drained query ends;
    what it left in a group waits in its state for the next start. NULL keys and values pass; a NULL
    shard is a shard of its own.
    """
    wait_ms, timeout = None, GroupStateTimeout.NoTimeout
    if wait is not None:
        number, unit = wait.split()
        wait_ms, timeout = int(pd.Timedelta(int(number), unit).total_seconds() * 1000), GroupStateTimeout.ProcessingTimeTimeout
    rows = records.select(F.col(shard).cast("string").alias("shard"), "key", "value")
    kinds = "shard string, flush long, reason string, key string, value string"
    return rows.groupBy("shard").applyInPandasWithState(_buffer(size, wait_ms), kinds, "held string", "append", timeout)


def flush_stream(groups: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """The rows of :func:`flush_groups` as files."""
    writer = groups.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or EVERY)).start()
