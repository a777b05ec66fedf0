"""Sinks: topic, files, console, memory, CSV export and the printed summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.plans.events import to_topic_records
from tidemark.plans.volatility import daily_rows, summary_table
from tidemark.sources.topics import BROKER_TIMEOUT_MS, EVENT_TOPIC


def topic_sink_options(servers: str, topic: str = EVENT_TOPIC) -> dict[str, str]:
    """Wait for the broker's acknowledgement of every record, give up after the timeout."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.delivery.timeout.ms": str(BROKER_TIMEOUT_MS),
        "kafka.request.timeout.ms": str(BROKER_TIMEOUT_MS),
        "kafka.linger.ms": "0",
    }


def _topic(events: DataFrame, servers: str, topic: str = EVENT_TOPIC, checkpoint: str | None = None, trigger=None):
    records, options = to_topic_records(events), topic_sink_options(servers, topic)
    if events.isStreaming:
        writer = records.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {})).start() if trigger else writer.start()
    records.write.format("kafka").options(**options).save()


def _files(events: DataFrame, path: str, checkpoint: str | None = None, trigger=None):
    records = to_topic_records(events)
    if events.isStreaming:
        writer = records.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        return writer.trigger(**trigger).start() if trigger else writer.start()
    records.write.mode("append").parquet(path)


def print_rows(rows: DataFrame, *_) -> None:
    """Print every row as a line of JSON, one partition at a time on the driver."""
    for row in rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).toLocalIterator():
        print(row[0])


def _mock(events: DataFrame, name: str | None = None, trigger=None, **_):
    """Print all events, or keep them in a named in-memory table of the driver (tests)."""
    if events.isStreaming:
        writer = events.writeStream
        writer = writer.format("memory").queryName(name) if name else writer.foreachBatch(print_rows)
        return writer.trigger(**trigger).start() if trigger else writer.start()
    print_rows(events)


# Fixed sink names; any broker that speaks the Kafka protocol is the topic sink.
SINKS = {"redpanda": _topic, "kafka": _topic, "files": _files, "mock": _mock}


def write_events(events: DataFrame, sink: str, **options):
    """Publish normalised events to the sink of that name; a streaming frame returns its running query."""
    try:
        write = SINKS[sink]
    except KeyError:
        raise ValueError(f"Unknown publish source: {sink}") from None
    return write(events, **options)


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None, mode: str = "overwrite") -> None:
    """CSV part files with a header each, written in parallel."""
    (df.select(*columns) if columns else df).write.mode(mode).option("header", True).csv(path)


def export_results(results: DataFrame, path: str) -> None:
    write_csv(results, path)


def export_daily(series: DataFrame, path: str) -> None:
    """Daily series with its date, one folder per ticker."""
    daily_rows(series).write.mode("overwrite").option("header", True).partitionBy("ticker").csv(path)


def print_summary(results: DataFrame) -> None:
    """Print the summary line of every ticker, in order."""
    print_rows(summary_table(results).orderBy("Ticker"))
