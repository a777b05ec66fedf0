"""Keyed-table, data-quality and layout queries with their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.catalog import views as V
from tidemark.functions import returns as R
from tidemark.operators import keyed as K, ordering as O, quality as Q
from tidemark.plans.keyed_table import BucketedTable, ChangeLog
from tidemark.session import scratch_path

KEY = ["trade_id"]
PAIR = ["trade_id", "created_at"]
NOW = "2024-06-01 00:00:00"
MID, COMPACTED = "20240115", "20240120"


def _trade_rows(df: DataFrame) -> DataFrame:
    return df.select(*V.TRADE_COLUMNS)


def kt_precombine(spark, d):
    """Each day's commit reduced to one row per user."""
    return K.precombine(V.changes(spark, d), ["commit_time", "user_id"], "ts")


def kt_snapshot_latest(spark, d):
    return K.snapshot(V.changes(spark, d), ["user_id"], ["ts"])


def kt_upsert(spark, d):
    return _trade_rows(K.upsert(V.open_trades(spark, d), V.fills(spark, d), KEY, "updated_at"))


def kt_upsert_event_time(spark, d):
    return _trade_rows(K.upsert(V.open_trades(spark, d), V.fills(spark, d), KEY, "updated_at", mode="event_time"))


def kt_delete(spark, d):
    returned = V.fills(spark, d).filter("stock_name = 'FILL-R'").select("trade_id", "updated_at")
    return K.delete(V.trades(spark, d), returned, KEY)


def _debtor_trades(spark, d):
    """Keys of the trades of customers in debt."""
    debtors = V.table(spark, d, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("trader_id"))
    return V.trades(spark, d).join(debtors, "trader_id", "left_semi").select(*PAIR)


def kt_delete_using(spark, d):
    return K.delete_using(V.trades(spark, d), _debtor_trades(spark, d), PAIR)


def kt_update_from(spark, d):
    tenth = F.lit("1.1").cast("decimal(2,1)")
    return K.update_from(
        V.trades(spark, d),
        _debtor_trades(spark, d),
        PAIR,
        {
            "stock_price": R.to_cents(F.col("stock_price") * tenth),
            "stock_purchase_choice": R.toggled_side(F.col("stock_purchase_choice")),
            "updated_at": F.lit(NOW).cast("timestamp"),
        },
    )


def kt_update_with(spark, d):
    """New prices taken from the last fill of each trade."""
    last = K.precombine(V.fills(spark, d), KEY, "updated_at").select("trade_id", "stock_price", "updated_at")
    return K.update_with(V.trades(spark, d), last, KEY, ["stock_price", "updated_at"])


def kt_returning(spark, d):
    return K.returning(V.trades(spark, d), _debtor_trades(spark, d), PAIR, ["trade_id"])


def kt_insert(spark, d):
    return K.insert(V.trades(spark, d), V.fills(spark, d))


def _since(log: DataFrame, day: str) -> DataFrame:
    """Changes of the commits after ``day``: the bound stands on the stored instant too, so it reaches the scan."""
    return log.filter(F.col("ts") >= F.date_add(F.to_date(F.lit(day), "yyyyMMdd"), 1).cast("timestamp"))


def _until(log: DataFrame, day: str) -> DataFrame:
    return log.filter(F.col("ts") < F.date_add(F.to_date(F.lit(day), "yyyyMMdd"), 1).cast("timestamp"))


def kt_incremental(spark, d):
    return K.incremental(_since(V.changes(spark, d), MID), ["user_id"], ["ts"], "commit_time", MID)


def kt_incremental_changes(spark, d):
    log = _until(_since(V.changes(spark, d), MID), COMPACTED)
    return K.incremental(log, ["user_id"], ["ts"], "commit_time", MID, end=COMPACTED, changes=True)


def kt_as_of(spark, d):
    return K.as_of(_until(V.changes(spark, d), MID), ["user_id"], ["ts"], "commit_time", MID)


def kt_commit_timeline(spark, d):
    return K.commit_timeline(V.changes(spark, d), "commit_time")


def kt_schema_evolution(spark, d):
    c = V.table(spark, d, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("mktsegment"),
    )
    s = V.table(spark, d, "supplier").select(
        F.col("s_acctbal").alias("acctbal"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey")
    )
    return K.concat_by_name(s, c)


def kt_indexed_lookup(spark, d):
    """Trades of a trader and trades of a month from one table laid out for both columns."""
    path = scratch_path(spark, "indexed")
    O.write_indexed(V.trades(spark, d), path, ["trader_id", "created_at"], files=16, point=["trader_id"])
    stored = spark.read.parquet(path)
    of_trader = stored.filter("trader_id = 7").withColumn("asked", F.lit("trader"))
    of_month = stored.filter("created_at >= '1995-03-01' AND created_at < '1995-04-01'").withColumn("asked", F.lit("month"))
    return of_trader.unionByName(of_month)


def kt_time_partition_scan(spark, d):
    """Trades laid out in a folder per year, then one year read newest first."""
    path = scratch_path(spark, "trades-by-year")
    part = O.write_time_partitioned(V.trades(spark, d), path, "created_at", KEY, grain="year")
    return O.newest_first(spark.read.parquet(path).filter(F.col(part) == "1997").drop(part), "created_at")


# ---- the persisted table: commits of ten days each ------------------------------------------------

DECADES = ["20240110", "20240120", "20240131"]


BUCKETS = 4


def _commits(spark, d):
    """The change log as one commit per ten days: (last day, changes)."""
    log, after = V.changes(spark, d).drop("commit_time"), None
    for until in DECADES:
        part = log if after is None else _since(log, after)
        # The last commit takes all that is left.
        yield until, part if until == DECADES[-1] else _until(part, until)
        after = until


def _user_table(spark, mode: str = "commit_time") -> BucketedTable:
    return BucketedTable(spark, scratch_path(spark, "users"), ["user_id"], "ts", mode, BUCKETS)


def _changed_table(spark, d, last: str = DECADES[-1]) -> BucketedTable:
    table = _user_table(spark)
    for commit, changes in _commits(spark, d):
        if commit <= last:
            table.change(changes, "op", ["ts"], commit)
    return table


def _change_log(spark, d) -> ChangeLog:
    log = ChangeLog(spark, scratch_path(spark, "user-log"), ["user_id"], "ts")
    for commit, changes in _commits(spark, d):
        log.append(changes, commit)
    return log


def _user_rows(df: DataFrame) -> DataFrame:
    return df.select("user_id", "ts", "value", "event_id")


def kt_table_cow(spark, d):
    """Every commit rewrites the buckets it touches."""
    return _user_rows(_changed_table(spark, d).snapshot())


def kt_table_mor(spark, d):
    """Commits are appended and reduced by the reader."""
    return _user_rows(_change_log(spark, d).snapshot())


def kt_read_optimized(spark, d):
    """The table after the second commit; the third is only in the log and invisible."""
    return _user_rows(_changed_table(spark, d, DECADES[1]).snapshot())


def kt_table_incremental(spark, d):
    return _user_rows(_changed_table(spark, d).incremental(DECADES[0]))


def kt_table_incremental_event_time(spark, d):
    """The later part of the month arrives first: of the earlier part only rows that win, and are not deleted, are news."""
    table = _user_table(spark, "event_time")
    log, day = V.changes(spark, d).drop("commit_time"), F.date_format("ts", "yyyyMMdd")
    table.change(log.filter(day > COMPACTED), "op", ["ts"], DECADES[0])
    table.change(log.filter(day <= COMPACTED), "op", ["ts"], DECADES[1])
    return _user_rows(table.incremental(DECADES[0]))


def kt_table_as_of(spark, d):
    return _user_rows(_change_log(spark, d).snapshot(as_of=DECADES[1]))


def _trade_table(spark) -> BucketedTable:
    return BucketedTable(spark, scratch_path(spark, "trades"), KEY, "updated_at", buckets=BUCKETS)


def kt_overwrite(spark, d):
    """A table of trades replaced by the fills, of which each key's last counts."""
    table = _trade_table(spark)
    table.upsert(V.trades(spark, d))
    table.overwrite(V.fills(spark, d))
    return _trade_rows(table.snapshot())


def kt_bulk_insert(spark, d):
    """The fills as they are: no key lookup, no reduction."""
    table = _trade_table(spark)
    table.bulk_insert(V.fills(spark, d))
    return _trade_rows(table.snapshot())


# ---- data quality ---------------------------------------------------------------------------------


def _faulty_trades(spark, d):
    """Trades with unknown sides, missing prices and missing update times."""
    orders = V.table(spark, d, "orders")
    status, rank = F.col("o_orderstatus"), F.col("o_orderpriority")
    return orders.select(
        F.col("o_orderkey").alias("trade_id"),
        rank.alias("stock_name"),
        F.when(rank != "4-NOT SPECIFIED", F.col("o_totalprice").cast("decimal(12,2)")).alias("stock_price"),
        F.when(status == "F", "SELL").when(status == "O", "BUY").otherwise("HOLD").alias("stock_purchase_choice"),
        F.col("o_custkey").alias("trader_id"),
        F.col("o_orderdate").alias("created_at"),
        F.when(status != "O", F.col("o_orderdate")).alias("updated_at"),
    )


FAULTY_SQL = """faulty AS (
  SELECT o_orderkey AS trade_id, o_orderpriority AS stock_name,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(o_totalprice AS DECIMAL(12,2)) END AS stock_price,
    CASE o_orderstatus WHEN 'F' THEN 'SELL' WHEN 'O' THEN 'BUY' ELSE 'HOLD' END AS stock_purchase_choice,
    o_custkey AS trader_id, o_orderdate AS created_at, CASE WHEN o_orderstatus <> 'O' THEN o_orderdate END AS updated_at
  FROM orders)"""


def dq_constraints(spark, d):
    return Q.violation_counts(_faulty_trades(spark, d), Q.trade_constraints())


def dq_violations(spark, d):
    _, bad = Q.split_rows(_faulty_trades(spark, d), Q.trade_constraints())
    return bad.select("trade_id", F.array_join("violations", ",").alias("violations"))


def dq_good_rows(spark, d):
    good, _ = Q.split_rows(_faulty_trades(spark, d), Q.trade_constraints())
    return good


def dq_duplicates(spark, d):
    return Q.duplicate_keys(V.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def dq_defaults(spark, d):
    now = F.lit(NOW).cast("timestamp")
    defaults = {"updated_at": now, "stock_price": F.lit(0).cast("decimal(12,2)"), "source": F.lit("import")}
    return Q.with_defaults(_faulty_trades(spark, d), defaults)


# ---- oracles --------------------------------------------------------------------------------------

_LATEST = "row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn"
_CHG = "user_id, ts, op, value, event_id, commit_time"
_USERS = "user_id, ts, value, event_id"
_T = f"WITH {V.TRADES_SQL}"
_TF = f"{_T}, {V.OPEN_TRADES_SQL}, {V.FILLS_SQL}, {V.LAST_FILL_SQL}"
_DEBT = "(SELECT t.trade_id, t.created_at FROM trades t WHERE t.trader_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0))"


def _latest(where: str, keep: str = "WHERE rn = 1 AND op <> 'd'", columns: str = _CHG) -> str:
    return f"WITH {V.CHANGES_SQL} SELECT {columns} FROM (SELECT *, {_LATEST} FROM chg {where}) {keep}"


QUERIES = {
    "kt_precombine": (
        kt_precombine,
        f"WITH {V.CHANGES_SQL} SELECT {_CHG} FROM (SELECT *, row_number() OVER (PARTITION BY commit_time, user_id"
        " ORDER BY ts DESC) AS rn FROM chg) WHERE rn = 1",
    ),
    "kt_snapshot_latest": (kt_snapshot_latest, _latest("")),
    "kt_upsert": (
        kt_upsert,
        f"{_TF} SELECT {V.TRADE_OUT} FROM open_trades t WHERE NOT EXISTS (SELECT 1 FROM last_fill f WHERE f.trade_id = t.trade_id)"
        f" UNION ALL SELECT {V.TRADE_OUT} FROM last_fill",
    ),
    "kt_upsert_event_time": (
        kt_upsert_event_time,
        f"{_TF} SELECT {V.TRADE_OUT} FROM (SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY updated_at DESC, src DESC) AS rn"
        " FROM (SELECT *, 0 AS src FROM open_trades UNION ALL SELECT *, 1 AS src FROM last_fill)) WHERE rn = 1",
    ),
    "kt_delete": (
        kt_delete,
        f"{_T} SELECT {V.TRADE_OUT} FROM trades WHERE trade_id NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')",
    ),
    "kt_delete_using": (
        kt_delete_using,
        f"{_T} SELECT {V.TRADE_OUT} FROM trades WHERE (trade_id, created_at) NOT IN {_DEBT}",
    ),
    "kt_update_from": (
        kt_update_from,
        f"{_T}, hit AS {_DEBT} SELECT t.trade_id, stock_name,"
        " CAST(CASE WHEN h.trade_id IS NULL THEN stock_price ELSE CAST(round(stock_price * CAST(1.1 AS DECIMAL(2,1)), 2) AS DECIMAL(12,2)) END AS DOUBLE) AS stock_price,"
        " CASE WHEN h.trade_id IS NULL THEN stock_purchase_choice WHEN stock_purchase_choice = 'BUY' THEN 'SELL' ELSE 'BUY' END AS stock_purchase_choice,"
        f" trader_id, t.created_at, CASE WHEN h.trade_id IS NULL THEN updated_at ELSE TIMESTAMP '{NOW}' END AS updated_at"
        " FROM trades t LEFT JOIN hit h ON t.trade_id = h.trade_id AND t.created_at = h.created_at",
    ),
    "kt_update_with": (
        kt_update_with,
        f"{_TF} SELECT t.trade_id, t.stock_name, CAST(coalesce(f.stock_price, t.stock_price) AS DOUBLE) AS stock_price,"
        " t.stock_purchase_choice, t.trader_id, t.created_at, coalesce(f.updated_at, t.updated_at) AS updated_at"
        " FROM trades t LEFT JOIN last_fill f ON t.trade_id = f.trade_id",
    ),
    "kt_returning": (
        kt_returning,
        f"{_T} SELECT trade_id FROM trades WHERE trader_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)",
    ),
    "kt_insert": (
        kt_insert,
        f"{_T}, {V.FILLS_SQL} SELECT {V.TRADE_OUT} FROM trades UNION ALL SELECT {V.TRADE_OUT} FROM fills",
    ),
    "kt_incremental": (kt_incremental, _latest(f"WHERE commit_time > '{MID}'")),
    "kt_incremental_changes": (
        kt_incremental_changes,
        _latest(f"WHERE commit_time > '{MID}' AND commit_time <= '{COMPACTED}'", "WHERE rn = 1"),
    ),
    "kt_as_of": (kt_as_of, _latest(f"WHERE commit_time <= '{MID}'")),
    "kt_commit_timeline": (
        kt_commit_timeline,
        f"WITH {V.CHANGES_SQL} SELECT commit_time, count(*) AS n_rows, count(*) FILTER (WHERE op = 'd') AS n_deletes FROM chg GROUP BY 1",
    ),
    "kt_schema_evolution": (
        kt_schema_evolution,
        "SELECT s_acctbal AS acctbal, s_name AS name, s_nationkey AS nationkey, CAST(NULL AS VARCHAR) AS mktsegment FROM supplier"
        " UNION ALL SELECT c_acctbal, c_name, c_nationkey, c_mktsegment FROM customer",
    ),
    "kt_indexed_lookup": (
        kt_indexed_lookup,
        f"WITH {V.TRADES_SQL} SELECT {V.TRADE_OUT}, 'trader' AS asked FROM trades WHERE trader_id = 7 UNION ALL"
        f" SELECT {V.TRADE_OUT}, 'month' FROM trades WHERE created_at >= TIMESTAMP '1995-03-01' AND created_at < TIMESTAMP '1995-04-01'",
    ),
    "kt_time_partition_scan": (
        kt_time_partition_scan,
        f"{_T} SELECT {V.TRADE_OUT} FROM trades WHERE year(created_at) = 1997",
    ),
    "kt_table_cow": (kt_table_cow, _latest("", columns=_USERS)),
    "kt_table_mor": (kt_table_mor, _latest("", columns=_USERS)),
    "kt_read_optimized": (kt_read_optimized, _latest(f"WHERE commit_time <= '{DECADES[1]}'", columns=_USERS)),
    "kt_table_incremental": (kt_table_incremental, _latest(f"WHERE commit_time > '{DECADES[0]}'", columns=_USERS)),
    "kt_table_incremental_event_time": (
        kt_table_incremental_event_time,
        f"WITH {V.CHANGES_SQL}, late AS (SELECT * FROM (SELECT *, {_LATEST} FROM chg WHERE commit_time > '{COMPACTED}') WHERE rn = 1),"
        f" early AS (SELECT * FROM (SELECT *, {_LATEST} FROM chg WHERE commit_time <= '{COMPACTED}') WHERE rn = 1)"
        f" SELECT {_USERS} FROM early WHERE op <> 'd' AND user_id NOT IN (SELECT user_id FROM late WHERE op <> 'd')",
    ),
    "kt_overwrite": (kt_overwrite, f"{_TF} SELECT {V.TRADE_OUT} FROM last_fill"),
    "kt_bulk_insert": (kt_bulk_insert, f"{_TF} SELECT {V.TRADE_OUT} FROM fills"),
    "kt_table_as_of": (kt_table_as_of, _latest(f"WHERE commit_time <= '{DECADES[1]}'", columns=_USERS)),
    "dq_constraints": (
        dq_constraints,
        f"WITH {FAULTY_SQL} SELECT * FROM (SELECT unnest(['trade_id_not_null', 'stock_name_not_null', 'stock_price_not_null',"
        " 'stock_purchase_choice_not_null', 'trader_id_not_null', 'created_at_not_null', 'updated_at_not_null',"
        " 'stock_purchase_choice_in_list']) AS rule, unnest([count(*) FILTER (WHERE trade_id IS NULL), count(*) FILTER (WHERE stock_name IS NULL),"
        " count(*) FILTER (WHERE stock_price IS NULL), count(*) FILTER (WHERE stock_purchase_choice IS NULL), count(*) FILTER (WHERE trader_id IS NULL),"
        " count(*) FILTER (WHERE created_at IS NULL), count(*) FILTER (WHERE updated_at IS NULL),"
        " count(*) FILTER (WHERE stock_purchase_choice NOT IN ('BUY', 'SELL'))]) AS n_bad FROM faulty)",
    ),
    "dq_violations": (
        dq_violations,
        f"WITH {FAULTY_SQL} SELECT trade_id, concat_ws(',', CASE WHEN stock_price IS NULL THEN 'stock_price_not_null' END,"
        " CASE WHEN updated_at IS NULL THEN 'updated_at_not_null' END,"
        " CASE WHEN stock_purchase_choice NOT IN ('BUY', 'SELL') THEN 'stock_purchase_choice_in_list' END) AS violations FROM faulty"
        " WHERE stock_price IS NULL OR updated_at IS NULL OR stock_purchase_choice NOT IN ('BUY', 'SELL')",
    ),
    "dq_good_rows": (
        dq_good_rows,
        f"WITH {FAULTY_SQL} SELECT {V.TRADE_OUT} FROM faulty WHERE stock_price IS NOT NULL AND updated_at IS NOT NULL"
        " AND stock_purchase_choice IN ('BUY', 'SELL')",
    ),
    "dq_duplicates": (
        dq_duplicates,
        "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    ),
    "dq_defaults": (
        dq_defaults,
        f"WITH {FAULTY_SQL} SELECT trade_id, stock_name, CAST(coalesce(stock_price, 0) AS DOUBLE) AS stock_price, stock_purchase_choice,"
        f" trader_id, created_at, coalesce(updated_at, TIMESTAMP '{NOW}') AS updated_at, 'import' AS source FROM faulty",
    ),
}
