"""Membership as keyed streaming state: from join and leave events to intervals (``joined_at``, ``left_at``).

Per (room, user) the state keeps the moves that may still meet an older one,
ordered by time (at equal times a leave comes after a join). A first join opens
an interval, further joins inside it change nothing, the first leave closes it,
a leave without an open interval counts for nothing. Each micro-batch sends the
intervals that came, changed or vanished by its moves, so late moves within the
watermark's delay correct what was sent before. What lies behind the watermark is
settled: of it the state keeps an open interval's start, and an event-time timer
removes the state of users with none. Moves later than the delay are dropped
by the watermark and counted in the query's progress.

A state holds the users of one shard, a hash of (room, user): a call per user
would cost milliseconds in the Python worker, whatever the moves. A batch reads
and rewrites the shards its moves fall in, as it does the buckets of the table.
The number of shards is fixed for the life of a checkpoint; some thousand users
a shard is a good size.
"""

from __future__ import annotations

import json
from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.operators.keyed import DELETE
from tidemark.plans.keyed_table import BucketedTable

JOIN, LEAVE = 0, 1
SHARDS = 1024
INTERVAL_KEY = ["room_id", "user_id", "joined_at"]
_SENT = "room_id string, user_id string, joined_at long, left_at long, op string"


def intervals(moves: list[tuple[int, int]]) -> dict[int, int | None]:
    """joined_at -> left_at of ordered (time, kind) moves; an open interval ends at None."""
    out, since = {}, None
    for time, kind in moves:
        if kind == JOIN and since is None:
            since = time
            out[since] = None
        elif kind == LEAVE and since is not None:
            out[since], since = time, None
    return out


def settled(moves: list[tuple[int, int]], before: int) -> list[tuple[int, int]]:
    """The moves with those before a time replaced by the start they leave open, if any."""
    old = [m for m in moves if m[0] < before]
    still = [(since, JOIN) for since, until in intervals(old).items() if until is None]
    return still + [m for m in moves if m[0] >= before]


def _by_member(parts) -> dict[tuple[str, str], set[tuple[int, int]]]:
    fresh = defaultdict(set)
    for part in parts:
        for room, user, time, kind in zip(part["room_id"], part["user_id"], part["timestamp"], part["kind"]):
            fresh[room, user].add((int(time), int(kind)))
    return fresh


def _advance(key, parts, state: GroupState):
    kept = {(room, user): [tuple(m) for m in moves] for room, user, moves in json.loads(state.get[0])} if state.exists else {}
    watermark = state.getCurrentWatermarkMs()
    rows = []
    if not state.hasTimedOut:
        for member, fresh in _by_member(parts).items():
            moves = kept.get(member, [])
            merged = sorted(fresh | set(moves))
            old, new = intervals(moves), intervals(merged)
            rows += [(*member, since, until, "u") for since, until in new.items() if old.get(since, -1) != until]
            rows += [(*member, since, None, DELETE) for since in old if since not in new]
            kept[member] = merged
    kept = {member: left for member, moves in kept.items() if (left := settled(moves, watermark // 1000))}
    if kept:
        state.update((json.dumps([(*member, moves) for member, moves in kept.items()]),))
        last = max(moves[-1][0] for moves in kept.values())
        if last * 1000 >= watermark:
            # Once the watermark has passed the last move, all are settled; open intervals then wait for their leave without a timer.
            state.setTimeoutTimestamp(max((last + 1) * 1000, watermark + 1))
    else:
        state.remove()
    if rows:
        sent = pd.DataFrame(rows, columns=["room_id", "user_id", "joined_at", "left_at", "op"], dtype=object)
        yield sent.astype({"joined_at": "Int64", "left_at": "Int64"})


def membership_changes(events: DataFrame, delay: str, shards: int = SHARDS) -> DataFrame:
    """Intervals to write (``op`` u) and to take back (``op`` d) of a stream of normalised events."""
    moves = events.filter(F.col("event_type").isin("join", "leave")).select(
        "room_id", "user_id", "timestamp", (F.col("event_type") == "leave").cast("int").alias("kind"), F.timestamp_seconds("timestamp").alias("at")
    )
    shard = F.pmod(F.xxhash64("room_id", "user_id"), F.lit(shards)).cast("int")
    grouped = moves.withColumn("shard", shard).withWatermark("at", delay).groupBy("shard")
    return grouped.applyInPandasWithState(_advance, _SENT, "moves string", "update", GroupStateTimeout.EventTimeTimeout)


def interval_table(spark, path: str, **options) -> BucketedTable:
    return BucketedTable(spark, path, INTERVAL_KEY, "left_at", **options)


def interval_stream(
    events: DataFrame, table: BucketedTable, checkpoint: str, trigger: dict, delay: str = "10 minutes", shards: int = SHARDS
) -> StreamingQuery:
    """Keep an :func:`interval_table` up to date; a replayed batch changes nothing."""

    def run(batch: DataFrame, batch_id: int) -> None:
        table.change(batch, "op", ["op"], source=checkpoint, number=batch_id)

    writer = membership_changes(events, delay, shards).writeStream.foreachBatch(run).outputMode("update")
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def members_at(table: DataFrame, seconds: int) -> DataFrame:
    """Who was in which room at a time: joined before or then, not yet left."""
    return table.filter((F.col("joined_at") <= seconds) & (F.col("left_at").isNull() | (F.col("left_at") > seconds))).select("room_id", "user_id", "joined_at")
