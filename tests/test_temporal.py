"""Validity intervals and states at an instant against plain loops."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import temporal as T

LOG = "k string, at timestamp, lsn long, op string, price int, _bucket int"
START = datetime(2024, 1, 1)


def sample(seed, n, span):
    """A log in which one key has two thirds of the rows, several of them at one instant."""
    draw = random.Random(seed)
    return [
        (draw.choice(["hot", "hot", "hot", "hot", "a", "b", None]), START + timedelta(microseconds=draw.randrange(span)), i, draw.choice("cuud"), i, 0)
        for i in range(n)
    ]


def versions(log):
    last = {}
    for k, at, lsn, op, price, _ in log:
        if k is not None and at is not None and ((k, at) not in last or last[k, at][0] < lsn):
            last[k, at] = (lsn, op, price)
    keys = {k for k, _ in last}
    return {k: sorted((at, *v) for (o, at), v in last.items() if o == k) for k in keys}


@pytest.mark.parametrize("max_rows, span", [(256, 10**12), (3, 10**12), (1, 500), (5, 3 * 10**6)])
def test_intervals_equal_a_loop(spark, max_rows, span):
    log = sample(max_rows, 400, span)
    want = []
    for k, own in versions(log).items():
        for i, (at, _, op, price) in enumerate(own):
            if op != "d":
                want.append((k, price, at, own[i + 1][0] if i + 1 < len(own) else None))
    got = T.validity_intervals(spark.createDataFrame(log, LOG.replace("_bucket", "other")), ["k"], "at", ["lsn"], max_rows=max_rows)
    assert got.columns == ["k", "at", "lsn", "op", "price", "other", "valid_from", "valid_to"]
    assert rows(got, "k", "price", "valid_from", "valid_to") == sorted(want, key=repr)


@pytest.mark.parametrize("max_rows, span", [(256, 10**12), (3, 10**12), (1, 500), (5, 3 * 10**6)])
def test_states_equal_a_loop(spark, max_rows, span):
    log = sample(max_rows, 300, span)
    draw = random.Random(7)
    asked = [
        (i, draw.choice(["hot", "a", "b", "none", None]), START + timedelta(microseconds=draw.randrange(-span, 3 * span))) for i in range(300)
    ]
    asked += [(1000, "hot", None), (1001, "hot", START), (1001, "hot", START)] + [(2000 + i, log[0][0], log[0][1]) for i in range(50)]
    known, want = versions(log), []
    for i, k, at in asked:
        held = [v for v in known.get(k, []) if at is not None and v[0] <= at]
        alive = held[-1] if held and held[-1][2] != "d" else (None,) * 4
        want.append((i, k, at, alive[0], alive[3]))
    frame = spark.createDataFrame(asked, "i int, k string, price timestamp")
    got = T.state_at(frame, spark.createDataFrame(log, LOG), ["k"], "price", "at", ["lsn"], {"price": "price_then"}, max_rows=max_rows)
    assert got.columns == ["i", "k", "price", "valid_from", "price_then"]
    assert rows(got) == sorted(want, key=repr)


@pytest.mark.parametrize("forward", [False, True])
def test_carried_values_come_from_the_nearest_bucket_over_all_levels(spark, forward):
    draw = random.Random(3)
    marks = [(k, b, draw.choice([None, None, b * 10])) for k in "ab" for b in sorted(draw.sample(range(-300, 300), 150))]
    got = T.carried(spark.createDataFrame(marks, "k string, _bucket long, _value long"), ["k"], forward, levels=2, fanout=5)
    want = []
    for k, b, v in marks:
        near = [(o, w) for q, o, w in marks if q == k and w is not None and (o > b if forward else o < b)]
        want.append((k, b, v, (min(near) if forward else max(near))[1] if near else None))
    assert rows(got, "k", "_bucket", "_value", "_carry") == sorted(want, key=repr)


def test_empty_log_and_no_rows(spark):
    log, asked = spark.createDataFrame([], LOG), spark.createDataFrame([("a", START)], "k string, t timestamp")
    assert T.validity_intervals(log, ["k"], "at", ["lsn"]).count() == 0
    assert rows(T.state_at(asked, log, ["k"], "t", "at", ["lsn"], {"price": "p"})) == [("a", START, None, None)]
    full = spark.createDataFrame(sample(1, 20, 1000), LOG)
    assert T.state_at(asked.filter("1 = 0"), full, ["k"], "t", "at", ["lsn"], {"price": "p"}).count() == 0


def test_a_crowded_key_is_joined_once_per_row_without_ranges(spark):
    log = spark.createDataFrame([("hot", START + timedelta(seconds=i), i, "u", i, 0) for i in range(2000)], LOG)
    asked = spark.range(5000).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 2500).alias("t"))
    out = T.state_at(asked, log, ["k"], "t", "at", ["lsn"], {"price": "p"}, max_rows=16)
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    assert out.count() == 5000 and out.filter("p <> least(unix_seconds(t) - 1704067200, 1999)").count() == 0
