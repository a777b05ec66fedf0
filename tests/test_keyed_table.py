import random
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import keyed as K
from tidemark.plans.keyed_table import BucketedTable, ChangeLog
from tidemark.schemas import USER_DELETES, USERS, USERS_EVOLVED
from tidemark.sources.tables import records

INITIAL = [("1", "Alice", 1000), ("2", "Bob", 1001), ("3", "Charlie", 1002)]
UPSERT = [("1", "AliceUpdated", 2000), ("4", "Dave", 1003)]
DELETE = [("2", 3000), ("4", 3000)]
EVOLVED = [("3", "Charlie", 1002, "charlie@example.com"), ("1", "AliceUpdated", 2000, "alice.updated@example.com")]


def users(spark, data, schema=USERS):
    return spark.createDataFrame(data, schema)


@pytest.fixture
def table(spark, tmp_path):
    def make(**options):
        return BucketedTable(spark, str(tmp_path / "users"), ["id"], "ts", **({"buckets": 8} | options))

    return make


def files(tmp_path, folder="users"):
    return {str(p) for p in Path(tmp_path / folder).glob("rows-*/*/*.parquet")}


def folders(paths):
    return {str(Path(p).parent) for p in paths}


def test_overwrite_upsert_delete_incremental(spark, table):
    t = table()
    first = t.overwrite(users(spark, INITIAL))
    assert rows(t.snapshot()) == INITIAL
    t.upsert(users(spark, UPSERT))
    assert rows(t.snapshot()) == [("1", "AliceUpdated", 2000), ("2", "Bob", 1001), ("3", "Charlie", 1002), ("4", "Dave", 1003)]
    t.delete(users(spark, DELETE, USER_DELETES))
    live = [("1", "AliceUpdated", 2000), ("3", "Charlie", 1002)]
    assert rows(t.snapshot()) == live
    # A bound before every instant is a full read; the true first commit shows only later changes.
    assert rows(t.incremental("00000000000001"), "id", "name", "ts") == live
    assert rows(t.incremental(first), "id", "name", "ts") == [("1", "AliceUpdated", 2000)]
    assert rows(table().snapshot()) == live, "a table opened anew"


def test_new_columns(spark, table):
    t = table()
    t.bulk_insert(users(spark, INITIAL[:2]))
    t.upsert(users(spark, EVOLVED, USERS_EVOLVED))
    expected = [
        ("1", "AliceUpdated", 2000, "alice.updated@example.com"),
        ("2", "Bob", 1001, None),
        ("3", "Charlie", 1002, "charlie@example.com"),
    ]
    assert rows(t.snapshot()) == expected
    assert rows(table().snapshot(), "id", "name", "ts", "email") == expected


def test_a_batch_rewrites_the_buckets_of_its_keys_and_a_replay_nothing(spark, table, tmp_path):
    t = table(buckets=32)
    t.overwrite(users(spark, [(str(i), "a", i) for i in range(400)]))
    before = files(tmp_path)
    assert len(folders(before)) == 32
    assert t.upsert(users(spark, [(str(i), "b", 1000) for i in (3, 7, 500)]), source="stream", number=4)
    after = files(tmp_path)
    assert 1 <= len(folders(before - after)) <= 3 and folders(before - after) == folders(after - before)
    for number in (4, 2):
        assert not t.upsert(users(spark, [("9", "again", 5000)]), source="stream", number=number)
    assert files(tmp_path) == after
    assert t.upsert(users(spark, [("9", "new", 5000)]), source="stream", number=5) and t.upsert(users(spark, [("9", "x", 5001)]), source="other", number=0)
    assert len(list(Path(tmp_path / "users" / "applied").glob("[!.]*"))) == 2, "a record a source, however many batches"
    assert t.snapshot().count() == 401


def test_a_bucket_that_loses_all_its_keys_is_gone(spark, table, tmp_path):
    t = table(buckets=64)
    t.overwrite(users(spark, INITIAL))
    t.delete(users(spark, [("1", 0), ("2", 0)], USER_DELETES))
    assert rows(t.snapshot()) == INITIAL[2:] and len(folders(files(tmp_path))) == 1
    t.delete(users(spark, [("3", 0)], USER_DELETES))
    assert not files(tmp_path)


def test_a_writer_that_dies_between_staging_and_placing(spark, table, monkeypatch):
    t = table()
    t.overwrite(users(spark, INITIAL))

    def dies(self):
        raise RuntimeError("lost")

    real, calls = BucketedTable._finish, []
    monkeypatch.setattr(BucketedTable, "_finish", lambda self: real(self) if not calls and not calls.append(1) else dies(self))
    with pytest.raises(RuntimeError):
        t.upsert(users(spark, UPSERT), source="s", number=1)
    monkeypatch.setattr(BucketedTable, "_finish", real)
    again = table()
    assert again.upsert(users(spark, UPSERT), source="s", number=1), "no record of it yet"
    assert rows(again.snapshot()) == [("1", "AliceUpdated", 2000), ("2", "Bob", 1001), ("3", "Charlie", 1002), ("4", "Dave", 1003)]


def test_another_number_of_buckets_is_refused(spark, table):
    table().overwrite(users(spark, INITIAL))
    with pytest.raises(ValueError, match="number of buckets"):
        table(buckets=9)


def test_later_commit_or_greater_ordering_wins(spark, table, tmp_path):
    t = table()
    t.overwrite(users(spark, INITIAL))
    t.upsert(users(spark, [("1", "Old", 1)]))
    assert ("1", "Old", 1) in rows(t.snapshot()), "the later commit wins although its ordering value is smaller"
    e = BucketedTable(spark, str(tmp_path / "by-time"), ["id"], "ts", "event_time", 4)
    e.overwrite(users(spark, INITIAL))
    e.upsert(users(spark, [("1", "Late", 5), ("2", "Newer", 9000)]))
    assert rows(e.snapshot()) == [("1", "Alice", 1000), ("2", "Newer", 9000), ("3", "Charlie", 1002)]
    e.delete(users(spark, [("1", 1)], USER_DELETES))
    e.upsert(users(spark, [("1", "Back", 3)]))
    assert ("1", "Back", 3) in rows(e.snapshot()), "what came after the delete is alive, whatever its ordering"


def test_in_batch_duplicates_and_unknown_deletes(spark, table):
    t = table()
    t.overwrite(users(spark, [*INITIAL, ("1", "Stale", 1)]))
    t.upsert(users(spark, [("5", "a", 2), ("5", "b", 3), ("5", "c", 1)]))
    t.delete(users(spark, [("99", 1)], USER_DELETES))
    assert rows(t.snapshot()) == [*INITIAL, ("5", "b", 3)]


def test_null_keys_and_type_changes_are_refused(spark, table):
    t = table()
    t.overwrite(users(spark, INITIAL))
    with pytest.raises(Exception, match="record key column id is NULL"):
        t.upsert(users(spark, [(None, "x", 1)]))
    with pytest.raises(TypeError, match="column ts"):
        t.upsert(users(spark, UPSERT).withColumn("ts", F.col("ts").cast("string")))
    assert rows(t.snapshot()) == INITIAL, "a failed write leaves no trace"


def test_expired_rows_leave_with_their_bucket(spark, table):
    """Rows named x are forgotten ten units after them."""
    t = table(buckets=1, mode="event_time", expire=lambda batch: (F.col("name") == "x") & (F.col("ts") < batch.agg(F.max("ts")).first()[0] - 10))
    t.upsert(users(spark, [("1", "x", 5), ("2", "x", 20), ("3", "a", 1)]))
    assert rows(t.snapshot(), "id") == [("2",), ("3",)]
    t.upsert(users(spark, [("4", "a", 31)]))
    assert rows(t.snapshot(), "id") == [("3",), ("4",)]


def test_a_log_gives_states_and_increments(spark, tmp_path):
    log = ChangeLog(spark, str(tmp_path / "log"), ["id"], "ts")
    make = lambda op, data: users(spark, data).withColumn("op", F.lit(op))
    log.append(make("u", INITIAL), "20240101")
    log.append(make("u", UPSERT), "20240102")
    log.append(make("d", [("2", None, 3000), ("4", None, 3000)]), "20240103")
    log.append(make("d", [("2", None, 3000), ("4", None, 3000)]), "20240103")
    assert rows(log.snapshot(), "id", "name") == [("1", "AliceUpdated"), ("3", "Charlie")]
    assert rows(log.snapshot("20240101")) == INITIAL
    assert rows(log.incremental("20240101"), "id") == [("1",)]
    assert rows(log.incremental("20240101", changes=True), "id", "op") == [("1", "u"), ("2", "d"), ("4", "d")]
    assert rows(log.incremental("20240101", "20240102"), "id") == [("1",), ("4",)]
    plan = log.snapshot("20240101")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_commit" in plan


@pytest.mark.parametrize("mode", ["commit_time", "event_time"])
@pytest.mark.parametrize("seed", range(2))
def test_table_equals_a_dictionary(spark, table, mode, seed):
    r, t, state = random.Random(seed), table(mode=mode), {}
    for step in range(5):
        batch = {str(k): r.randint(0, 30) for k in r.sample(range(9), 4)}
        t.upsert(users(spark, [(k, str(step), ts) for k, ts in batch.items()]))
        for k, ts in batch.items():
            if mode == "commit_time" or k not in state or ts >= state[k][2]:
                state[k] = (k, str(step), ts)
        if r.random() < 0.6:
            gone = [str(k) for k in r.sample(range(9), 2)]
            t.delete(users(spark, [(k, 0) for k in gone], USER_DELETES))
            state = {k: v for k, v in state.items() if k not in gone}
        assert rows(t.snapshot()) == sorted(state.values())


def test_ordering_may_be_several_columns(spark, tmp_path):
    t = BucketedTable(spark, str(tmp_path / "t"), ["id"], ["a", "b"], "event_time", 4)
    make = lambda *data: spark.createDataFrame(data, "id string, a int, b int")
    t.upsert(make(("k", 1, 5)))
    t.upsert(make(("k", 1, 3), ("k", 1, 4)))
    assert rows(t.snapshot()) == [("k", 1, 5)]
    t.upsert(make(("k", 1, 6), ("k", 0, 9)))
    assert rows(t.snapshot()) == [("k", 1, 6)]


def test_upsert_is_idempotent_and_modes_differ(spark):
    base, batch = users(spark, INITIAL), users(spark, [("1", "Late", 5), ("4", "Dave", 1003), ("4", "Older", 1)])
    once = K.upsert(base, batch, ["id"], "ts")
    assert rows(K.upsert(once, batch, ["id"], "ts")) == rows(once)
    assert ("1", "Late", 5) in rows(once) and ("4", "Dave", 1003) in rows(once)
    assert ("1", "Alice", 1000) in rows(K.upsert(base, batch, ["id"], "ts", mode="event_time"))
    with pytest.raises(ValueError):
        K.upsert(base, batch, ["id"], "ts", mode="other")


def test_latest_by_key_with_map_columns(spark):
    df = spark.sql("SELECT 'a' AS id, 1 AS ts, map('k', 1) AS m UNION ALL SELECT 'a', 2, map('k', 2)")
    assert K.latest_by_key(df, ["id"], ["ts"]).first().m == {"k": 2}


def test_records_match_by_name(spark):
    df = records(spark, [{"ts": 3, "id": "1"}, {"id": "2", "name": "b", "ts": 1}], USERS)
    assert rows(df) == [("1", None, 3), ("2", "b", 1)]
    with pytest.raises(ValueError):
        records(spark, [{"nope": 1}], USERS)


def test_update_with_does_not_multiply_rows(spark):
    target = spark.createDataFrame([("a", 1)], "id string, v int")
    source = spark.createDataFrame([("a", 5, 1), ("a", 7, 0)], "id string, v int, o int")
    assert rows(K.update_with(target, source, ["id"], ["v"], ["o"])) == [("a", 5)]
    assert rows(K.update_with(target, source, ["id"], ["v"])) == [("a", 7)]


def test_a_great_bucket_is_written_by_several_tasks(spark, table, tmp_path):
    """Every row but a few has one key; no task takes the whole bucket."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "16KB")
    try:
        t = table(buckets=1)
        key = F.when(F.col("id") % 100 == 0, F.col("id")).otherwise(7).cast("string")
        many = spark.range(0, 40_000, 1, 8).select(key.alias("id"), F.md5(F.col("id").cast("string")).alias("name"), F.col("id").alias("ts"))
        t.bulk_insert(many)
    finally:
        spark.conf.set(name, before)
    assert rows(t.snapshot()) == rows(many)
    written = [[r.id for r in spark.read.parquet(f).collect()] for f in files(tmp_path)]
    assert len(written) > 1 and max(map(len, written)) < 40_000 and all(ids == sorted(ids) for ids in written)
