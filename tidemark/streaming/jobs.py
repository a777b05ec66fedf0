"""Structured Streaming queries: normalise, persist, membership and change capture.

Offsets live in each query's checkpoint and a failed micro-batch runs again;
writes are keyed and named by batch, so a replayed batch changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.keyed import DELETE
from tidemark.plans import cdc as C, events as P
from tidemark.plans.keyed_table import BucketedTable
from tidemark.schemas import MESSAGES_KEY, STOCK_TRADES_KEY
from tidemark.sources.topics import FLUSH_INTERVAL
from tidemark.streaming.metrics import with_counters
from tidemark.streaming.sinks import write_events

EVERY = {"processingTime": FLUSH_INTERVAL}
DRAIN = {"availableNow": True}


def normalize_stream(
    raw: DataFrame, sink: str, server_time: Column | None = None, ids: str = "content", **sink_options
) -> StreamingQuery:
    """Raw JSON bodies to normalised topic records; bad rows are counted and skipped (see :func:`reject_stream`)."""
    events = P.valid_events(with_counters(P.parse_events(raw)))
    return write_events(P.normalize_events(events, server_time, ids), sink, **sink_options)


def reject_stream(raw: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Bad raw events with reason and raw text, kept as files."""
    return _keep_rejects(P.rejected_events(P.parse_events(raw)), path, checkpoint, trigger)


def record_reject_stream(records: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Topic records :func:`persist_stream` skips, kept as files."""
    return _keep_rejects(P.rejected_events(P.parse_normalized(records)), path, checkpoint, trigger)


def change_reject_stream(records: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Change records :func:`change_stream` skips, kept as files."""
    return _keep_rejects(C.rejected_changes(C.parse_changes(records.select("value"))), path, checkpoint, trigger)


def _keep_rejects(bad: DataFrame, path: str, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    return (
        bad.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY))
        .start()
    )


def distinct_events(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Drop repeats of an event id that arrive within ``delay`` of each other (bounded state).

    The watermark follows the time of arrival, not the event's: a first arrival
    is never late, however old the event, so only repeats are dropped.
    """
    timed = events.withColumn("_arrived", F.current_timestamp())
    return timed.withWatermark("_arrived", delay).dropDuplicatesWithinWatermark(["event_id"]).drop("_arrived")


def _keep_latest(rows: DataFrame, table: BucketedTable, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    """Upsert every micro-batch into ``table``, once.

    A batch is named by its checkpoint and number; a replay after a failure
    finds a record of that number and writes nothing. A batch rewrites the
    buckets its keys fall into, an empty one none.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch, source=checkpoint, number=batch_id)

    return rows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**(trigger or EVERY)).start()


# The tables below merge by event order, not arrival order, so rows that arrive late or twice
# leave the same state as a batch run over everything.
STREAM_TABLE = {"mode": "event_time"}


def message_table(spark, path: str, **options) -> BucketedTable:
    """The message store: last server stamp per (room, time, event) wins, files clustered by room and time."""
    return BucketedTable(spark, path, MESSAGES_KEY, "server_timestamp", cluster_by=MESSAGES_KEY, **(STREAM_TABLE | options))


def persist_stream(records: DataFrame, table: BucketedTable, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Normalised records into the message table."""
    good = P.message_rows(P.valid_events(with_counters(P.parse_normalized(records))))
    return _keep_latest(good, table, checkpoint, trigger)


def change_table(spark, path: str, horizon: int | None = None, **options) -> BucketedTable:
    """Last change per key by source position. Deletes are kept as rows: an older change arriving later must lose to them.

    ``horizon`` says how late a change can come, in source positions: a deleted
    key's row leaves, when its bucket is rewritten, once a batch is that far
    ahead of it. Without it the rows stay.
    """

    def expired(batch: DataFrame) -> Column:
        ahead = batch.agg(F.max("lsn")).first()[0]
        return (F.col("op") == DELETE) & (F.col("lsn") < F.lit(ahead - horizon))

    expire = {} if horizon is None else {"expire": expired}
    return BucketedTable(spark, path, STOCK_TRADES_KEY, C.CHANGE_ORDER, **(STREAM_TABLE | expire | options))


def change_stream(records: DataFrame, table: BucketedTable, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Change envelopes into a :func:`change_table`; undecodable ones go to :func:`change_reject_stream`."""
    changes = C.valid_changes(C.parse_changes(records.select("value")))
    return _keep_latest(changes, table, checkpoint, trigger)


def current_trades(table: BucketedTable) -> DataFrame:
    """Live rows of a :func:`change_table`."""
    return table.snapshot().filter(F.col("op") != DELETE).drop("op", "lsn", "ts_ms")


def membership_table(spark, path: str, **options) -> BucketedTable:
    return BucketedTable(spark, path, ["room_id", "user_id"], "move", **(STREAM_TABLE | options))


def membership_stream(events: DataFrame, table: BucketedTable, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Join and leave events kept as the last move per (room, user); at equal times the leave counts."""
    leaves = (F.col("event_type") == "leave").cast("bigint")
    moves = events.filter(F.col("event_type").isin("join", "leave")).select(
        "room_id", "user_id", F.col("timestamp").alias("updated_at"), (F.col("timestamp") * 2 + leaves).alias("move"), "event_type"
    )
    return _keep_latest(moves, table, checkpoint, trigger)


def current_members(table: BucketedTable) -> DataFrame:
    """Live membership rows of a :func:`membership_table`."""
    joined = table.snapshot().filter(F.col("event_type") == "join")
    return joined.select("room_id", "user_id", F.col("updated_at").alias("joined_at"), "updated_at")


def drain(query: StreamingQuery) -> StreamingQuery:
    """Wait for a query that ends by itself (``DRAIN``) and re-raise its failure."""
    query.awaitTermination()
    return query

