import json
import random

from conftest import rows
from pyspark.sql import functions as F

from tidemark.sources import topics as S
from tidemark.streaming import jobs as J, membership as M


def moves(*listed):
    return [(t, M.LEAVE if kind == "leave" else M.JOIN) for t, kind in listed]


def test_intervals():
    ordered = moves((1, "leave"), (2, "join"), (3, "join"), (5, "leave"), (6, "leave"), (7, "join"), (7, "leave"), (9, "join"))
    assert M.intervals(ordered) == {2: 5, 7: 7, 9: None}


def test_settling_keeps_what_later_moves_need():
    r = random.Random(1)
    for _ in range(500):
        ordered = sorted({(r.randint(0, 20), r.randint(0, 1)) for _ in range(r.randint(0, 12))})
        before, later = r.randint(0, 21), sorted({(r.randint(21, 30), r.randint(0, 1)) for _ in range(4)})
        full, kept = M.intervals(ordered + later), M.intervals(M.settled(ordered, before) + later)
        closed = {s: e for s, e in M.intervals([m for m in ordered if m[0] < before]).items() if e is not None}
        assert full == closed | kept


def event(user, kind, time):
    return json.dumps({"room": "r", "user": user, "kind": kind, "time": time})


def stream(spark, path):
    read = S.stream_lines(spark, str(path), 1)
    get = lambda c: F.get_json_object("value", f"$.{c}")
    return read.select(get("room").alias("room_id"), get("user").alias("user_id"), get("kind").alias("event_type"), get("time").cast("long").alias("timestamp"))


def test_out_of_order_moves_restarts_and_late_moves(spark, tmp_path):
    table = M.interval_table(spark, str(tmp_path / "t"), buckets=2)

    def put(*bodies):
        spark.createDataFrame([(b,) for b in bodies], "value string").coalesce(1).write.mode("append").text(str(tmp_path / "in"))
        J.drain(M.interval_stream(stream(spark, tmp_path / "in"), table, str(tmp_path / "cp"), J.DRAIN, "100 seconds"))
        return rows(table.snapshot(), "user_id", "joined_at", "left_at")

    assert put(event("a", "join", 1000), event("b", "join", 1010)) == [("a", 1000, None), ("b", 1010, None)]
    assert put(event("a", "leave", 1020)) == [("a", 1000, 1020), ("b", 1010, None)], "the state outlives the query"
    # Earlier moves arrive: a was in from 990 and left at 1005 already, so 1000 is no start and 1020 ends nothing.
    assert put(event("a", "join", 990), event("a", "leave", 1005)) == [("a", 990, 1005), ("b", 1010, None)]
    put(event("c", "join", 5000))  # the watermark passes
    put(event("c", "chat", 5001), event("c", "leave", 5002))
    final = put(event("a", "leave", 995), event("b", "leave", 5003))
    assert final == [("a", 990, 1005), ("b", 1010, 5003), ("c", 5000, 5002)], "too late for a; b's open interval waited"
    assert rows(M.members_at(table.snapshot(), 1004), "user_id") == [("a",)]


def test_users_share_the_states_of_their_shards(spark, tmp_path):
    r = random.Random(2)
    listed = [(f"u{r.randint(0, 30)}", r.choice(["join", "leave"]), r.randint(1000, 1050)) for _ in range(200)]
    table = M.interval_table(spark, str(tmp_path / "t"), buckets=2)
    for part in (listed[:90], listed[90:]):
        spark.createDataFrame([(event(*m),) for m in part], "value string").coalesce(1).write.mode("append").text(str(tmp_path / "in"))
        J.drain(M.interval_stream(stream(spark, tmp_path / "in"), table, str(tmp_path / "cp"), J.DRAIN, "100 seconds", shards=3))
    want = [
        (user, since, until)
        for user in {m[0] for m in listed}
        for since, until in M.intervals(sorted(set(moves(*[(t, kind) for who, kind, t in listed if who == user])))).items()
    ]
    assert rows(table.snapshot(), "user_id", "joined_at", "left_at") == sorted(want, key=repr)
    states = spark.read.format("statestore").load(str(tmp_path / "cp"))
    assert 1 <= states.count() <= 3, "a state per shard, not per user"
