import json
import uuid
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.catalog import streams, views
from tidemark.functions import events as E
from tidemark.plans import events as P
from tidemark.schemas import NORMALIZED_EVENT
from tidemark.sources import topics as S
from tidemark.streaming import jobs as J, sinks
from tidemark.streaming.metrics import ThroughputListener

CHAT = {
    "event_type": "chat", "user_id": "user_123", "room_id": "room_456", "journey_id": "journey_999", "timestamp": 1733490000,
    "message": "Hello world", "message_type": "text", "chat_type": "group",
}
JOIN = {"event_type": "join", "user_id": "user_123", "room_id": "room_456", "timestamp": 1733490000}
LEAVE = JOIN | {"event_type": "leave"}
REACTION = JOIN | {"event_type": "reaction", "message_id": "msg_777", "emoji": "thumbs_up"}
GOOD = [CHAT, JOIN, LEAVE, REACTION]


def bodies(spark, *events):
    return spark.createDataFrame([(e if isinstance(e, str) else json.dumps(e),) for e in events], "value string")


def normalized(spark, *events, **options):
    return P.normalize_events(P.valid_events(P.parse_events(bodies(spark, *events))), F.lit(1), **options)


def without(event, key):
    return {k: v for k, v in event.items() if k != key}


def test_samples_normalise(spark):
    got = {r.event_type: r for r in normalized(spark, *GOOD).collect()}
    assert (got["chat"].payload, got["chat"].journey_id) == ("Hello world", "journey_999")
    assert got["chat"].metadata_json == '{"chat_type":"group","message_id":null,"message_type":"text"}'
    for kind in ("join", "leave"):
        assert (got[kind].payload, got[kind].metadata_json, got[kind].journey_id) == ("", "{}", None)
    assert got["reaction"].payload == "thumbs_up"
    assert got["reaction"].metadata_json == '{"message_id":"msg_777","target_user_id":null}'


@pytest.mark.parametrize(
    "body,error",
    [
        ("not json", "malformed_json"),
        ("", "malformed_json"),
        ('{"event_type": "chat"', "malformed_json"),
        ("[1, 2]", "not_an_object"),
        ('"chat"', "not_an_object"),
        (without(JOIN, "event_type"), "missing_field:event_type"),
        (JOIN | {"event_type": 5}, "wrong_type:event_type"),
        (JOIN | {"event_type": "Chat"}, "unknown_event_type"),
        (without(JOIN, "room_id"), "missing_field:room_id"),
        (JOIN | {"user_id": None}, "missing_field:user_id"),
        (without(without(REACTION, "emoji"), "message_id"), "missing_field:message_id,emoji"),
        (JOIN | {"timestamp": "1733490000"}, "wrong_type:timestamp"),
        (JOIN | {"timestamp": 1.5}, "wrong_type:timestamp"),
        (JOIN | {"timestamp": 2**70}, "wrong_type:timestamp"),
        (JOIN | {"user_id": 7}, "wrong_type:user_id"),
        (CHAT | {"message": {"text": "x"}}, "wrong_type:message"),
        (JOIN | {"created_at": "now"}, "wrong_type:created_at"),
        (without(CHAT, "message"), None),
        (CHAT | {"message": None}, None),
        (JOIN | {"extra": [1, {"room_id": 3}]}, None),
        (JOIN | {"message": 5, "emoji": {"a": 1}}, None),
        (CHAT | {"message": 'say "user_id": 5 {'}, None),
    ],
)
def test_strict_parsing(spark, body, error):
    parsed = P.parse_events(bodies(spark, body))
    assert parsed.first().error == error
    assert P.rejected_events(parsed).count() == (error is not None)
    if error is None:
        row = P.normalize_events(P.valid_events(parsed), F.lit(1)).first()
        assert (row.user_id, row.room_id, row.timestamp) == ("user_123", "room_456", 1733490000)


def test_missing_message_is_an_empty_payload(spark):
    assert normalized(spark, without(CHAT, "message")).first().payload == ""


def test_ids(spark):
    a, b = (sorted(r.event_id for r in normalized(spark, *GOOD).collect()) for _ in range(2))
    assert a == b and len(set(a)) == 4
    for text in a:
        assert len(text) == 36 and str(uuid.UUID(text)) == text
    swapped = normalized(spark, CHAT | {"message": "a", "journey_id": "b"}, CHAT | {"message": "b", "journey_id": "a"})
    assert swapped.select("event_id").distinct().count() == 2
    drawn = normalized(spark, JOIN, JOIN, ids="uuid")
    assert drawn.select("event_id").distinct().count() == 2
    with pytest.raises(ValueError):
        normalized(spark, JOIN, ids="other")
    assert spark.range(1).select(E.server_millis().alias("t")).first().t > 1.7e12


def test_topic_records_round_trip(spark):
    events = normalized(spark, *GOOD)
    records = P.to_topic_records(events)
    assert {r.key for r in records.collect()} == {"chat", "join", "leave", "reaction"}
    assert list(json.loads(records.filter("key = 'join'").first().value)) == NORMALIZED_EVENT.names, "nulls are kept"
    back = P.parse_normalized(records)
    assert back.filter("error IS NOT NULL").count() == 0
    assert rows(P.valid_events(back).select(*NORMALIZED_EVENT.names)) == rows(events)


def test_consumer_rejects_incomplete_records(spark):
    whole = json.loads(P.to_topic_records(normalized(spark, JOIN)).first().value)
    cases = [without(whole, "payload"), whole | {"server_timestamp": "1"}, without(whole, "journey_id"), "{"]
    errors = [r.error for r in P.parse_normalized(bodies(spark, *cases)).collect()]
    assert errors == ["missing_field:payload", "wrong_type:server_timestamp", None, "malformed_json"]


def test_message_view_and_membership(spark):
    events = normalized(
        spark, *GOOD, JOIN | {"user_id": "b"}, LEAVE | {"user_id": "b", "timestamp": 1733490005},
        JOIN | {"user_id": "b", "timestamp": 1733490009}, LEAVE | {"user_id": "c"}, JOIN | {"user_id": "d"},
    )
    view = {r.event_type: r for r in P.message_view(events.filter("user_id = 'user_123'")).collect()}
    assert (view["chat"].message, view["chat"].message_id, view["chat"].emoji) == ("Hello world", None, None)
    assert (view["reaction"].message, view["reaction"].message_id, view["reaction"].emoji) == (None, "msg_777", "thumbs_up")
    # user_123 joined and left in the same second: the leave counts.
    assert rows(P.room_members(events), "user_id", "joined_at") == [("b", 1733490009), ("d", 1733490000)]
    kept = P.rooms(P.valid_events(P.parse_events(bodies(spark, *GOOD)))).first()
    assert (kept.room_type, kept.created_at, kept.updated_at) == ("group", 1733490000, 1733490000)


def test_reply(spark):
    r = P.reply(normalized(spark, JOIN), S.EVENT_TOPIC).first()
    assert r.ok and r.status == "delivered" and r.topic == "chat_events" and len(r.event_id) == 36


def test_sinks(spark, tmp_path, capfd):
    events = normalized(spark, *GOOD)
    with pytest.raises(ValueError, match="Unknown publish source: nowhere"):
        sinks.write_events(events, "nowhere")
    sinks.write_events(events, "files", path=str(tmp_path / "topic"))
    assert spark.read.parquet(str(tmp_path / "topic")).count() == 4
    sinks.write_events(events, "mock")
    assert "thumbs_up" in capfd.readouterr().out
    sinks.write_csv(events, str(tmp_path / "csv"), ["event_type", "timestamp"])
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == ["event_type", "timestamp"]
    assert sinks.SINKS["redpanda"] is sinks.SINKS["kafka"]
    options = sinks.topic_sink_options("broker:9092")
    assert options["topic"] == "chat_events" and options["kafka.delivery.timeout.ms"] == "5000"
    whole = {"kafka.bootstrap.servers": "b:9092", "subscribe": "t", "startingOffsets": "earliest"}
    assert S.topic_options("b:9092", "t") == whole
    assert S.topic_options("b:9092", "t", S.MAX_IN_FLIGHT) == whole | {"maxOffsetsPerTrigger": "10000"}


def test_the_mock_sink_prints_every_event(spark, tmp_path, capfd):
    events = [CHAT | {"message": f"m{i:02d}."} for i in range(21)]
    sinks.write_events(normalized(spark, *events), "mock")
    printed = capfd.readouterr().out
    assert all(f"m{i:02d}." in printed for i in range(21))
    land(bodies(spark, *events), tmp_path / "raw")
    J.drain(J.normalize_stream(S.stream_lines(spark, str(tmp_path / "raw")), "mock", trigger=J.DRAIN))
    printed = capfd.readouterr().out
    assert all(f"m{i:02d}." in printed for i in range(21))


def test_a_late_first_arrival_is_no_repeat(spark, tmp_path):
    """An event a year older than what came before it is kept; its repeat is not."""
    land(normalized(spark, CHAT, JOIN).select(F.to_json(F.struct("*")).alias("value")).coalesce(1), tmp_path / "in")
    late = normalized(spark, CHAT | {"timestamp": CHAT["timestamp"] - 31_536_000})
    schema = late.schema

    def run():
        parsed = S.stream_lines(spark, str(tmp_path / "in")).select(F.from_json("value", schema).alias("e")).select("e.*")
        query = J.distinct_events(parsed).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        J.drain(query.option("checkpointLocation", str(tmp_path / "cp")).trigger(**J.DRAIN).start())

    run()
    both = late.unionByName(normalized(spark, CHAT))
    land(both.select(F.to_json(F.struct("*")).alias("value")), tmp_path / "in")
    run()
    assert spark.read.schema(schema).parquet(str(tmp_path / "out")).count() == 3


def land(df, path):
    df.repartition(4).write.mode("append").text(str(path))


def test_streams_equal_batch_and_survive_replays(spark, tmp_path):
    events = [CHAT | {"user_id": f"u{i % 5}", "timestamp": 1733490000 + i, "message": f"m{i}"} for i in range(40)]
    events += [JOIN | {"user_id": f"u{i}", "timestamp": 1733490000 + i} for i in range(6)]
    raw = bodies(spark, *events, "broken", JOIN | {"timestamp": "x"})
    land(raw, tmp_path / "raw")
    stamp, listener = F.col("timestamp") * 1000, ThroughputListener()
    spark.streams.addListener(listener)

    def normalise():
        source = S.stream_lines(spark, str(tmp_path / "raw"), max_files=1)
        J.drain(
            J.normalize_stream(source, "files", stamp, path=str(tmp_path / "topic"), checkpoint=str(tmp_path / "c1"), trigger=J.DRAIN)
        )

    normalise()
    batch = P.normalize_events(P.valid_events(P.parse_events(raw)), stamp)
    topic = spark.read.schema("key string, value string").parquet(str(tmp_path / "topic"))
    assert rows(topic) == rows(P.to_topic_records(batch))

    table = J.message_table(spark, str(tmp_path / "messages"))

    def persist(checkpoint):
        J.drain(J.persist_stream(S.stream_records(spark, str(tmp_path / "topic"), 2), table, str(tmp_path / checkpoint), J.DRAIN))

    persist("c2")
    want = rows(P.latest_messages(batch))
    assert rows(table.snapshot()) == want
    stored = {p: p.stat().st_mtime_ns for p in (tmp_path / "messages").rglob("*.parquet")}
    persist("c2")
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "messages").rglob("*.parquet")} == stored, "nothing new arrived"
    persist("c3")
    assert rows(table.snapshot()) == want, "reading the topic again from the start changes nothing"

    land(bodies(spark, CHAT | {"message": "late"}), tmp_path / "raw")
    normalise()
    persist("c2")
    assert table.snapshot().count() == len(want) + 1

    J.drain(J.reject_stream(S.stream_lines(spark, str(tmp_path / "raw")), str(tmp_path / "bad"), str(tmp_path / "c4"), J.DRAIN))
    assert rows(spark.read.parquet(str(tmp_path / "bad")), "error") == [("malformed_json",), ("wrong_type:timestamp",)]

    spark.streams.removeListener(listener)
    summary = listener.summary()
    assert summary["errors"] >= 2 and summary["total_events"] >= 47 and summary["events_per_second"] > 0


def test_a_replayed_micro_batch_is_applied_once(spark, tmp_path):
    table = J.message_table(spark, str(tmp_path / "messages"))
    batch = P.message_rows(normalized(spark, *GOOD))
    assert [table.upsert(batch, source="checkpoint", number=0) for _ in range(2)] == [True, False]
    assert table.snapshot().count() == 4


def test_membership_does_not_depend_on_arrival_order(spark, tmp_path):
    moves = [JOIN | {"timestamp": 10}, LEAVE | {"timestamp": 20}, JOIN | {"timestamp": 15}, JOIN | {"user_id": "x", "timestamp": 5}]
    for i, move in enumerate(moves):
        P.to_topic_records(normalized(spark, move)).coalesce(1).write.mode("append").parquet(str(tmp_path / "topic"))
    events = P.valid_events(P.parse_normalized(S.stream_records(spark, str(tmp_path / "topic"), 1)))
    table = J.membership_table(spark, str(tmp_path / "members"))
    J.drain(J.membership_stream(events, table, str(tmp_path / "c"), J.DRAIN))
    assert rows(J.current_members(table), "user_id", "joined_at") == [("x", 5)]


def test_memory_sink_streams(spark, tmp_path):
    land(bodies(spark, *GOOD), tmp_path / "raw")
    query = J.normalize_stream(S.stream_lines(spark, str(tmp_path / "raw")), "mock", F.lit(1), name="seen", trigger=J.DRAIN)
    J.drain(query)
    assert spark.table("seen").count() == 4


def test_throughput_floor_of_one_second(spark):
    parsed = P.parse_events(bodies(spark, *GOOD, "x"))
    got = P.throughput(parsed, F.lit(5.0)).first()
    assert (got.total_events, got.errors, got.events_per_second) == (4, 1, 4.0)


def test_listener_reports(monkeypatch):
    now = [0.0]
    listener = ThroughputListener(report_seconds=5, clock=lambda: now[0])
    listener.total_events = 30
    assert listener.summary()["events_per_second"] == 30.0
    now[0] = 10.0
    assert listener.summary()["events_per_second"] == 3.0


def test_one_file_of_events_is_parsed_by_all_cores(spark, tmp_path, monkeypatch):
    """Bodies are dealt out before they are parsed, and a topic file can be read by several tasks."""
    kinds = F.element_at(F.array(*map(F.lit, ["view", "signup", "error", "click"])), (F.col("id") % 4 + 1).cast("int"))
    events = spark.range(0, 4000, 1, 1).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 50).alias("user_id"),
        kinds.alias("event_type"),
        F.col("id").cast("double").alias("value"),
        F.format_string('{"k": %d}', F.col("id") % 100).alias("props"),
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    raw = views.raw_events(spark, str(tmp_path))
    sizes = [r[0] for r in raw.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(sizes) >= spark.sparkContext.defaultParallelism and max(sizes) < 2000 and sum(sizes) == 4000
    monkeypatch.setattr(streams, "GROUP_BYTES", 1 << 14)
    records = P.to_topic_records(streams._normalized(spark, str(tmp_path)))
    topic = streams._topic(records)
    groups = [pq.ParquetFile(f).num_row_groups for f in Path(topic).glob("*.parquet")]
    assert len(groups) == streams.FILES and min(groups) > 1
    assert rows(spark.read.parquet(topic)) == rows(records)
