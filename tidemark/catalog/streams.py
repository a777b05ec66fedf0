"""Event and change-capture queries, batch and streaming, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import views as V
from tidemark.plans import cdc as C, events as P
from tidemark.session import scratch_path
from tidemark.sources.topics import CHANGE_TOPIC, EVENT_TOPIC, stream_lines, stream_records
from tidemark.streaming import jobs as J, membership as M, windows as W

RECENT = 3
MEMBERS_DELAY = "60 days"
WINDOW_S = 86_400


def _parsed(spark, d):
    return P.parse_events(V.raw_events(spark, d))


def _normalized(spark, d):
    """Valid events in normalised form, stamped with the view's server time."""
    return P.normalize_events(P.valid_events(_parsed(spark, d)), F.col("server_ms"))


def _delivered(spark, d):
    """Normalised events with a late second copy of those whose k is 90 or more (copied after the one parse)."""
    events = P.valid_events(_parsed(spark, d))
    delays = F.when(F.col("k") >= V.LATE_COPY, F.array(F.lit(0), F.lit(1000))).otherwise(F.array(F.lit(0)))
    copies = events.withColumn("_late", F.explode(delays))
    return P.normalize_events(copies, F.col("server_ms") + F.col("_late"))


def ev_parse_valid(spark, d):
    return P.valid_events(_parsed(spark, d)).select("src_id", "event_type", "user_id", "room_id", "timestamp", "message", "emoji", "room_action")


def ev_rejected(spark, d):
    """Reason per rejected body."""
    return _parsed(spark, d).filter(F.col("error").isNotNull()).select("src_id", "error")


def ev_normalize(spark, d):
    return _normalized(spark, d)


def ev_topic_records(spark, d):
    """What goes to the topic, read back by the strict consumer."""
    back = P.parse_normalized(P.to_topic_records(_normalized(spark, d)))
    return back.select("key", "event_id", "journey_id", "payload", "server_timestamp", "error")


def ev_reply(spark, d):
    return P.reply(_normalized(spark, d), EVENT_TOPIC)


def ev_messages_upsert(spark, d):
    return P.latest_messages(_delivered(spark, d))


def ev_message_view(spark, d):
    return P.message_view(_normalized(spark, d))


def ev_message_table(spark, d):
    """Delivered events, some twice, as the modelled table with the first and last time each was stored."""
    return P.message_table_view(_delivered(spark, d))


def ev_room_members(spark, d):
    return P.room_members(_normalized(spark, d))


def ev_user_rooms(spark, d):
    return P.user_rooms(P.room_members(_normalized(spark, d)))


def ev_rooms(spark, d):
    return P.rooms(P.valid_events(_parsed(spark, d)))


def ev_recent_messages(spark, d):
    turns = V.table(spark, d, "conversations")
    return P.recent_messages(turns, RECENT, room="conv_id", time="turn", tie="text").select("conv_id", "turn", "role", "text")


def ev_throughput(spark, d):
    return V.rounded(P.throughput(_parsed(spark, d), F.col("arrival_s").cast("double")))


def ev_throughput_by_interval(spark, d):
    return P.throughput_by_interval(_parsed(spark, d), F.col("arrival_s"))


def ev_latency(spark, d):
    return V.rounded(P.latency_summary(_normalized(spark, d)))


def ev_latency_by_window(spark, d):
    return V.rounded(P.latency_by_window(_normalized(spark, d), WINDOW_S))


def ev_failure_reply(spark, d):
    return P.failure_reply(_parsed(spark, d), EVENT_TOPIC)


# ---- streams: the view is landed as files, drained in micro-batches -------------------------------

# The tables of these queries are small; a bucket should hold some 100 MB.
BUCKETS = 4
FILES, PER_BATCH = 8, 4
FLUSH_ROWS = 20
# Bytes of a row group of a topic file: the least a task parses, so that a few files make work for all cores.
GROUP_BYTES = 4 << 20


def _land(df, name: str) -> str:
    """JSON bodies as text files for a file stream."""
    path = scratch_path(df.sparkSession, name)
    df.select("value").repartition(FILES).write.text(path)
    return path


def _topic(records) -> str:
    """Topic records as files for a stream."""
    path = scratch_path(records.sparkSession, "topic")
    records.repartition(FILES).write.option("parquet.block.size", GROUP_BYTES).parquet(path)
    return path


def _normalized_topic(spark, d) -> str:
    """Raw bodies through the normalising stream into a folder of topic records.

    The server stamp is taken from the event time plus the payload length, which a replay repeats.
    """
    raw, out = _land(V.raw_events(spark, d), "raw"), scratch_path(spark, "topic")
    stamp = F.col("timestamp") * 1000 + F.length(F.coalesce("message", "emoji", F.lit("")))
    J.drain(
        J.normalize_stream(
            stream_lines(spark, raw, PER_BATCH), "files", stamp, path=out, checkpoint=f"{out}-checkpoint", trigger=J.DRAIN
        )
    )
    return out


def ev_stream_normalize(spark, d):
    out = _normalized_topic(spark, d)
    return P.parse_normalized(spark.read.schema("key string, value string").parquet(out)).drop("key", "value", "error")


def ev_stream_rejects(spark, d):
    raw, out = _land(V.raw_events(spark, d), "raw"), scratch_path(spark, "rejects")
    J.drain(J.reject_stream(stream_lines(spark, raw, PER_BATCH), out, f"{out}-checkpoint", J.DRAIN))
    return spark.read.schema("raw string, error string").parquet(out).groupBy("error").agg(F.count("*").alias("n"))


def ev_persist_rejects(spark, d):
    """Topic records the persisting stream cannot store: cut off, or without a payload."""
    out = scratch_path(spark, "record-rejects")
    time, value = F.get_json_object("value", "$.timestamp").cast("bigint") % 7, F.col("value")
    faulty = F.when(time == 0, F.substring(value, F.lit(1), F.length(value) - 1)).when(time == 1, F.regexp_replace(value, '"payload":"[^"]*",', ""))
    topic = _topic(P.to_topic_records(_normalized(spark, d)).withColumn("value", faulty.otherwise(value)))
    J.drain(J.record_reject_stream(stream_records(spark, topic, PER_BATCH), out, f"{out}-checkpoint", J.DRAIN))
    return spark.read.schema("raw string, error string").parquet(out).groupBy("error").agg(F.count("*").alias("n"))


def ev_stream_persist(spark, d):
    """Topic records, some delivered twice, through the persisting stream into the message table."""
    topic, path = _topic(P.to_topic_records(_delivered(spark, d))), scratch_path(spark, "messages")
    table = J.message_table(spark, path, buckets=BUCKETS)
    J.drain(J.persist_stream(stream_records(spark, topic, PER_BATCH), table, f"{path}-checkpoint", J.DRAIN))
    return table.snapshot()


def ev_stream_members(spark, d):
    topic, path = _topic(P.to_topic_records(_normalized(spark, d))), scratch_path(spark, "members")
    events = P.valid_events(P.parse_normalized(stream_records(spark, topic, PER_BATCH)))
    table = J.membership_table(spark, path, buckets=BUCKETS)
    J.drain(J.membership_stream(events, table, f"{path}-checkpoint", J.DRAIN))
    return J.current_members(table)


def ev_stream_intervals(spark, d):
    """Times of membership from streaming state, files arriving in any order."""
    topic, path = _topic(P.to_topic_records(_normalized(spark, d))), scratch_path(spark, "intervals")
    events = P.valid_events(P.parse_normalized(stream_records(spark, topic, PER_BATCH)))
    table = M.interval_table(spark, path, buckets=BUCKETS)
    J.drain(M.interval_stream(events, table, f"{path}-checkpoint", J.DRAIN, MEMBERS_DELAY))
    return table.snapshot().drop("op")


def ev_stream_latency_windows(spark, d):
    """Latency per day from streaming state, merged from closed windows of six hours.

    Files come in any order, so nothing is late within the delay; a last event, long after, closes all windows before it.
    """
    topic, out = _topic(P.to_topic_records(_normalized(spark, d))), scratch_path(spark, "windows")
    events = P.valid_events(P.parse_normalized(stream_records(spark, topic, PER_BATCH)))
    windows = W.latency_windows(events, WINDOW_S // 4, MEMBERS_DELAY)
    J.drain(W.window_stream(windows, out, f"{out}-checkpoint", J.DRAIN))
    last = _normalized(spark, d).orderBy(F.desc("timestamp")).limit(1).withColumn("timestamp", F.col("timestamp") + 400 * WINDOW_S)
    P.to_topic_records(last).write.mode("append").parquet(topic)
    J.drain(W.window_stream(windows, out, f"{out}-checkpoint", J.DRAIN))
    closed = spark.read.schema(windows.schema).parquet(out)
    return V.rounded(W.wider_windows(closed, WINDOW_S).drop("sketch"))


def ev_stream_flush(spark, d):
    """Groups that end by size, per room."""
    topic, out = _topic(P.to_topic_records(_normalized(spark, d))), scratch_path(spark, "flushed")
    records = stream_records(spark, topic, PER_BATCH).withColumn("shard", F.get_json_object("value", "$.room_id"))
    groups = W.flush_groups(records, size=FLUSH_ROWS, wait=None)
    J.drain(W.flush_stream(groups, out, f"{out}-checkpoint", J.DRAIN))
    return spark.read.schema(groups.schema).parquet(out).groupBy("shard", "flush", "reason").agg(F.count("*").alias("n"))


def ev_stream_distinct(spark, d):
    """Event ids that survive de-duplication within a watermark longer than the data."""
    topic, out = _topic(P.to_topic_records(_delivered(spark, d))), scratch_path(spark, "distinct")
    events = P.valid_events(P.parse_normalized(stream_records(spark, topic, PER_BATCH)))
    once = J.distinct_events(events, MEMBERS_DELAY).select("event_id", "event_type")
    query = once.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-checkpoint")
    J.drain(query.trigger(**J.DRAIN).start())
    return spark.read.schema(once.schema).parquet(out)


# ---- change capture -------------------------------------------------------------------------------


def _changes(spark, d):
    envelopes = C.of_table(C.decode_envelopes(C.of_topic(V.envelopes(spark, d), CHANGE_TOPIC)))
    return C.change_rows(envelopes)


def cdc_decode(spark, d):
    return _changes(spark, d)


def cdc_apply(spark, d):
    return C.apply_changes(_changes(spark, d))


def cdc_symbol_totals(spark, d):
    return V.rounded(C.symbol_totals(C.apply_changes(_changes(spark, d))), 4)


def cdc_as_of(spark, d):
    """The table as the change history had it in the middle of the month; the bound on ``ts`` reaches the scan."""
    early = V.envelopes(spark, d).filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp"))
    commits = early.withColumn("_at", F.col("commit_time")).select("_at", "value")
    decoded = C.change_rows(C.of_table(C.decode_envelopes(commits)), "base64", "_at")
    return C.changes_as_of(decoded, "_at", "20240115")


def cdc_intervals(spark, d):
    """Every state of a trade with the time it held."""
    return C.trade_intervals(_changes(spark, d))


def cdc_state_at_event(spark, d):
    """Each event of a user, those that change nothing included, with the state of the user's trade at that time."""
    return C.trades_at(V.trade_events(spark, d), _changes(spark, d), "at").drop("created_at")


def cdc_rejected(spark, d):
    """Reasons of the change records that cannot be applied."""
    return C.rejected_changes(C.parse_changes(V.faulty_envelopes(spark, d))).groupBy("error").agg(F.count("*").alias("n"))


def cdc_stream_rejects(spark, d):
    """The same through the reject stream."""
    topic, out = _land(V.faulty_envelopes(spark, d), "envelopes"), scratch_path(spark, "change-rejects")
    J.drain(J.change_reject_stream(stream_lines(spark, topic, PER_BATCH), out, f"{out}-checkpoint", J.DRAIN))
    return spark.read.schema("raw string, error string").parquet(out).groupBy("error").agg(F.count("*").alias("n"))


def cdc_stream_ties(spark, d):
    """Envelopes whose position says nothing but the day: ties fall to the later source time, in a stream as in a batch."""
    day = F.regexp_replace("value", '"lsn":[0-9]+', F.concat(F.lit('"lsn":'), F.col("commit_time")))
    topic, path = _land(V.envelopes(spark, d).withColumn("value", day), "envelopes"), scratch_path(spark, "trades")
    table = J.change_table(spark, path, buckets=BUCKETS)
    J.drain(J.change_stream(stream_lines(spark, topic, PER_BATCH), table, f"{path}-checkpoint", J.DRAIN))
    return J.current_trades(table)


def cdc_stream_apply(spark, d):
    """Envelopes through the change stream into a bucketed table, in whatever order files arrive."""
    topic, path = _land(V.envelopes(spark, d), "envelopes"), scratch_path(spark, "trades")
    table = J.change_table(spark, path, buckets=BUCKETS)
    J.drain(J.change_stream(stream_lines(spark, topic, PER_BATCH), table, f"{path}-checkpoint", J.DRAIN))
    return J.current_trades(table)


# ---- oracles --------------------------------------------------------------------------------------

_N = f"WITH {V.RAW_SQL}"
_E = f"WITH {V.ENVELOPES_SQL}"
_LIVE = "trade_id, stock_name, stock_price, stock_purchase_choice, trader_id, created_at, updated_at"
_NORM = "event_type, user_id, room_id, journey_id, timestamp, payload, metadata_json, event_id"
_DELIVERED = f"""{_N}, delivered AS (
  SELECT * FROM norm UNION ALL SELECT * REPLACE (server_timestamp + 1000 AS server_timestamp) FROM norm WHERE k >= {V.LATE_COPY}),
stored AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY room_id, timestamp, event_id ORDER BY server_timestamp DESC) AS rn
  FROM delivered) WHERE rn = 1)"""
_MESSAGES = f"{_DELIVERED} SELECT room_id, timestamp, event_id, event_type, user_id, payload, metadata_json, server_timestamp FROM stored"
_MEMBERS = f"""{_N}, moves AS (
  SELECT room_id, user_id, timestamp, event_type, row_number() OVER (PARTITION BY room_id, user_id ORDER BY timestamp DESC, event_type DESC) AS rn
  FROM norm WHERE event_type IN ('join', 'leave'))
SELECT room_id, user_id, timestamp AS joined_at, timestamp AS updated_at FROM moves WHERE rn = 1 AND event_type = 'join'"""

_INTERVALS = f"""{_E}, single AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY trade_id, ts_ms ORDER BY lsn DESC) AS rn FROM envl) WHERE rn = 1),
ranged AS (SELECT *, make_timestamp(ts_ms * 1000) AS valid_from,
  make_timestamp(lead(ts_ms) OVER (PARTITION BY trade_id ORDER BY ts_ms) * 1000) AS valid_to FROM single),
held AS (SELECT * FROM ranged WHERE NOT gone)"""

_CHANGE_REJECTS = (
    f"SELECT error, count(*) AS n FROM (SELECT CASE WHEN k = {V.CUT_SHORT} THEN 'malformed_json' WHEN event_type <> 'purchase' THEN"
    f" CASE WHEN k = {V.TEXT_TIME} THEN 'wrong_instant:created_at' WHEN k = {V.NO_ROOM} THEN 'unknown_operation'"
    f" WHEN k = {V.NUMBER_USER} AND event_type <> 'error' THEN 'wrong_decimal:stock_price' END END AS error"
    " FROM (SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)) WHERE error IS NOT NULL GROUP BY 1"
)

QUERIES = {
    "ev_parse_valid": (
        ev_parse_valid,
        f"{_N} SELECT src_id, event_type, user_id, room_id, timestamp,"
        f" CASE WHEN event_type = 'chat' AND k <> {V.SILENT} THEN payload END AS message,"
        " CASE WHEN event_type = 'reaction' THEN payload END AS emoji, CASE WHEN event_type = 'join' THEN 'join' END AS room_action FROM norm",
    ),
    "ev_rejected": (ev_rejected, f"{_N} SELECT src_id, error FROM checked WHERE error IS NOT NULL"),
    "ev_normalize": (ev_normalize, f"{_N} SELECT {_NORM}, server_timestamp FROM norm"),
    "ev_topic_records": (
        ev_topic_records,
        f"{_N} SELECT event_type AS key, event_id, journey_id, payload, server_timestamp, CAST(NULL AS VARCHAR) AS error FROM norm",
    ),
    "ev_reply": (ev_reply, f"{_N} SELECT true AS ok, 'delivered' AS status, event_id, 'chat_events' AS topic FROM norm"),
    "ev_messages_upsert": (ev_messages_upsert, _MESSAGES),
    "ev_message_view": (
        ev_message_view,
        f"{_N} SELECT room_id, timestamp, event_id, event_type, user_id, CASE WHEN event_type = 'chat' THEN payload END AS message,"
        " CASE WHEN event_type = 'reaction' THEN 'msg_' || src_id END AS message_id,"
        " CASE WHEN event_type = 'reaction' THEN payload END AS emoji FROM norm",
    ),
    "ev_message_table": (
        ev_message_table,
        f"{_DELIVERED} SELECT room_id, timestamp, event_id, event_type, user_id, CASE WHEN event_type = 'chat' THEN payload END AS message,"
        " json_extract_string(metadata_json, '$.message_id') AS message_id, CASE WHEN event_type = 'reaction' THEN payload END AS emoji,"
        " s.created_at, s.updated_at FROM stored JOIN (SELECT room_id, timestamp, event_id, min(server_timestamp) AS created_at,"
        " max(server_timestamp) AS updated_at FROM delivered GROUP BY ALL) s USING (room_id, timestamp, event_id)",
    ),
    "ev_room_members": (ev_room_members, _MEMBERS),
    "ev_user_rooms": (ev_user_rooms, _MEMBERS),
    "ev_rooms": (
        ev_rooms,
        f"{_N}, chats AS (SELECT room_id, json_extract_string(metadata_json, '$.chat_type') AS chat_type, row_number() OVER (PARTITION BY room_id"
        " ORDER BY timestamp DESC, json_extract_string(metadata_json, '$.chat_type') DESC) AS rn FROM norm WHERE event_type = 'chat')"
        " SELECT n.room_id, n.room_id AS name, max(c.chat_type) AS room_type, min(n.timestamp) AS created_at, max(n.timestamp) AS updated_at"
        " FROM norm n LEFT JOIN chats c ON n.room_id = c.room_id AND c.rn = 1 GROUP BY n.room_id",
    ),
    "ev_recent_messages": (
        ev_recent_messages,
        "SELECT conv_id, turn, role, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, text DESC) AS rn"
        f" FROM conversations) WHERE rn <= {RECENT}",
    ),
    "ev_throughput": (
        ev_throughput,
        f"{_N} SELECT count(*) FILTER (WHERE error IS NULL) AS total_events, count(*) FILTER (WHERE error IS NOT NULL) AS errors,"
        " CAST(max(seconds) - min(seconds) AS DOUBLE) AS uptime_seconds,"
        " round(count(*) FILTER (WHERE error IS NULL) / greatest(CAST(max(seconds) - min(seconds) AS DOUBLE), 1.0), 6) AS events_per_second FROM checked",
    ),
    "ev_throughput_by_interval": (
        ev_throughput_by_interval,
        f"{_N} SELECT CAST(floor(seconds / 5) * 5 AS BIGINT) AS interval_start, count(*) FILTER (WHERE error IS NULL) AS n_events,"
        " count(*) FILTER (WHERE error IS NOT NULL) AS n_errors FROM checked GROUP BY 1",
    ),
    "ev_latency": (
        ev_latency,
        f"{_N}, lat AS (SELECT event_type, CAST(server_timestamp - timestamp * 1000 AS DOUBLE) AS ms FROM norm)"
        " SELECT event_type, count(*) AS n, round(avg(ms), 6) AS mean_ms, min(ms) AS min_ms, max(ms) AS max_ms,"
        " round(quantile_cont(ms, 0.95), 6) AS upper_ms FROM lat GROUP BY 1",
    ),
    "ev_stream_normalize": (
        ev_stream_normalize,
        f"{_N} SELECT {_NORM}, timestamp * 1000 + length(payload) AS server_timestamp FROM norm",
    ),
    "ev_stream_rejects": (ev_stream_rejects, f"{_N} SELECT error, count(*) AS n FROM checked WHERE error IS NOT NULL GROUP BY 1"),
    "ev_stream_persist": (ev_stream_persist, _MESSAGES),
    "ev_stream_members": (ev_stream_members, _MEMBERS),
    "ev_stream_intervals": (
        ev_stream_intervals,
        f"""{_N}, moves AS (SELECT DISTINCT room_id, user_id, timestamp, event_type FROM norm WHERE event_type IN ('join', 'leave')),
placed AS (SELECT *, lag(event_type) OVER o AS before, min(CASE WHEN event_type = 'leave' THEN timestamp END)
  OVER (PARTITION BY room_id, user_id ORDER BY timestamp, event_type ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS left_at
  FROM moves WINDOW o AS (PARTITION BY room_id, user_id ORDER BY timestamp, event_type))
SELECT room_id, user_id, timestamp AS joined_at, left_at FROM placed WHERE event_type = 'join' AND coalesce(before, 'leave') = 'leave'""",
    ),
    "ev_stream_latency_windows": (
        ev_stream_latency_windows,
        f"{_N}, lat AS (SELECT CAST(floor(timestamp / {WINDOW_S}) * {WINDOW_S} AS BIGINT) AS window_start,"
        " CAST(server_timestamp - timestamp * 1000 AS DOUBLE) AS ms FROM norm)"
        " SELECT window_start, CAST(count(*) AS BIGINT) AS n, round(avg(ms), 6) AS mean_ms, min(ms) AS min_ms, max(ms) AS max_ms,"
        " quantile_disc(ms, 0.95) AS upper_ms FROM lat GROUP BY 1",
    ),
    "ev_stream_flush": (
        ev_stream_flush,
        f"{_N} SELECT room_id AS shard, CAST(unnest(range(count(*) // {FLUSH_ROWS})) AS BIGINT) AS flush, 'size' AS reason,"
        f" CAST({FLUSH_ROWS} AS BIGINT) AS n FROM norm GROUP BY room_id",
    ),
    "ev_stream_distinct": (ev_stream_distinct, f"{_DELIVERED} SELECT DISTINCT event_id, event_type FROM delivered"),
    "cdc_decode": (
        cdc_decode,
        f"{_E} SELECT trade_id, CASE WHEN NOT gone THEN stock_name END AS stock_name, CASE WHEN NOT gone THEN stock_price END AS stock_price,"
        " CASE WHEN NOT gone THEN stock_purchase_choice END AS stock_purchase_choice, CASE WHEN NOT gone THEN trader_id END AS trader_id,"
        " created_at, CASE WHEN NOT gone THEN updated_at END AS updated_at, op, lsn, ts_ms FROM envl",
    ),
    "cdc_apply": (cdc_apply, f"{_E} SELECT {_LIVE} FROM live"),
    "cdc_symbol_totals": (
        cdc_symbol_totals,
        f"{_E} SELECT stock_name, count(*) AS n_trades, count(*) FILTER (WHERE stock_purchase_choice = 'BUY') AS n_buy,"
        " count(*) FILTER (WHERE stock_purchase_choice = 'SELL') AS n_sell, round(sum(stock_price), 4) AS total_price,"
        " round(avg(stock_price), 4) AS avg_price, round(max(stock_price), 4) AS max_price FROM live GROUP BY 1",
    ),
    "cdc_as_of": (
        cdc_as_of,
        f"{_E} SELECT {_LIVE} FROM (SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY lsn DESC) AS rn FROM envl"
        " WHERE commit_time <= '20240115') WHERE rn = 1 AND NOT gone",
    ),
    "cdc_intervals": (cdc_intervals, f"{_INTERVALS} SELECT {_LIVE}, valid_from, valid_to FROM held"),
    "cdc_state_at_event": (
        cdc_state_at_event,
        f"{_INTERVALS} SELECT e.event_id, 't' || e.user_id AS trade_id, e.ts AS at, h.valid_from, h.stock_name AS stock_name_then,"
        " h.stock_price AS stock_price_then, h.stock_purchase_choice AS stock_purchase_choice_then FROM events e"
        " LEFT JOIN held h ON h.trade_id = 't' || e.user_id AND e.ts >= h.valid_from AND (h.valid_to IS NULL OR e.ts < h.valid_to)",
    ),
    "cdc_stream_apply": (cdc_stream_apply, f"{_E} SELECT {_LIVE} FROM live"),
    "cdc_rejected": (cdc_rejected, _CHANGE_REJECTS),
    "cdc_stream_rejects": (cdc_stream_rejects, _CHANGE_REJECTS),
    "cdc_stream_ties": (
        cdc_stream_ties,
        f"{_E} SELECT {_LIVE} FROM (SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY commit_time DESC, ts_ms DESC, stock_name DESC) AS rn"
        " FROM envl) WHERE rn = 1 AND NOT gone",
    ),
    "ev_latency_by_window": (
        ev_latency_by_window,
        f"{_N}, lat AS (SELECT CAST(floor(timestamp / {WINDOW_S}) * {WINDOW_S} AS BIGINT) AS window_start,"
        " CAST(server_timestamp - timestamp * 1000 AS DOUBLE) AS ms FROM norm)"
        " SELECT window_start, count(*) AS n, round(avg(ms), 6) AS mean_ms, min(ms) AS min_ms, max(ms) AS max_ms,"
        " round(quantile_cont(ms, 0.95), 6) AS upper_ms FROM lat GROUP BY 1",
    ),
    "ev_failure_reply": (
        ev_failure_reply,
        f"{_N} SELECT false AS ok, error AS status, CAST(NULL AS VARCHAR) AS event_id, 'chat_events' AS topic FROM checked WHERE error IS NOT NULL",
    ),
    "ev_persist_rejects": (
        ev_persist_rejects,
        f"{_N} SELECT CASE timestamp % 7 WHEN 0 THEN 'malformed_json' ELSE 'missing_field:payload' END AS error, count(*) AS n"
        " FROM norm WHERE timestamp % 7 IN (0, 1) GROUP BY 1",
    ),
}
