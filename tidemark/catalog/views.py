"""The driver's tables seen as trades, change logs, chat events and bars.

Each view has a Spark form and the SQL text (``*_SQL``, a CTE) the oracles use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampType

from tidemark.functions.events import evaluate_once
from tidemark.session import ensure_session
from tidemark.sources.tables import read_table


def portable(df: DataFrame) -> DataFrame:
    """Types every engine prints alike: decimals as doubles, dates as text, instants without zone."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, TimestampType):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(f.name))
    return df.select(*out)


def rounded(df: DataFrame, digits: int = 6, *columns: str) -> DataFrame:
    """Round double columns: sums over different partitions differ in the last bits."""
    names = columns or [n for n, t in df.dtypes if t == "double"]
    return df.withColumns({n: F.round(n, digits) for n in names})


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(ensure_session(spark), folder, name)


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt evenly over all cores, before work that costs far more than moving them: a small file is one task."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)


# ---- orders and lineitem as trades ----------------------------------------------------------------

TRADE_COLUMNS = ["trade_id", "stock_name", "stock_price", "stock_purchase_choice", "trader_id", "created_at", "updated_at"]


def trades(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("trade_id"),
        F.col("o_orderpriority").alias("stock_name"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("stock_price"),
        F.when(F.col("o_orderstatus") == "F", "SELL").otherwise("BUY").alias("stock_purchase_choice"),
        F.col("o_custkey").alias("trader_id"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"),
    )


TRADES_SQL = """trades AS (
  SELECT o_orderkey AS trade_id, o_orderpriority AS stock_name, CAST(o_totalprice AS DECIMAL(12,2)) AS stock_price,
    CASE WHEN o_orderstatus = 'F' THEN 'SELL' ELSE 'BUY' END AS stock_purchase_choice,
    o_custkey AS trader_id, o_orderdate AS created_at, o_orderdate AS updated_at
  FROM orders)"""


def open_trades(spark: SparkSession, folder: str) -> DataFrame:
    """Trades of orders that are open or filled; a batch of fills then also brings new keys."""
    pending = table(spark, folder, "orders").filter(F.col("o_orderstatus") == "P").select(F.col("o_orderkey").alias("trade_id"))
    return trades(spark, folder).join(pending, "trade_id", "left_anti")


OPEN_TRADES_SQL = """open_trades AS (
  SELECT * FROM trades WHERE trade_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'))"""


def fills(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as a batch of trade rows: many per key, later and earlier than the stored ones."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("trade_id"),
        F.concat(F.lit("FILL-"), F.col("l_returnflag")).alias("stock_name"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("stock_price"),
        F.when(F.col("l_linestatus") == "F", "SELL").otherwise("BUY").alias("stock_purchase_choice"),
        F.col("l_suppkey").alias("trader_id"),
        F.col("l_shipdate").alias("created_at"),
        F.col("l_shipdate").alias("updated_at"),
    )


FILLS_SQL = """fills AS (
  SELECT l_orderkey AS trade_id, 'FILL-' || l_returnflag AS stock_name, CAST(l_extendedprice AS DECIMAL(12,2)) AS stock_price,
    CASE WHEN l_linestatus = 'F' THEN 'SELL' ELSE 'BUY' END AS stock_purchase_choice,
    l_suppkey AS trader_id, l_shipdate AS created_at, l_shipdate AS updated_at
  FROM lineitem)"""

LAST_FILL_SQL = """last_fill AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY updated_at DESC, stock_name DESC, stock_price DESC,
      stock_purchase_choice DESC, trader_id DESC, created_at DESC) AS rn FROM fills) WHERE rn = 1)"""

TRADE_OUT = (
    "trade_id, stock_name, CAST(stock_price AS DOUBLE) AS stock_price, stock_purchase_choice, trader_id, created_at, updated_at"
)

# ---- events as a change log -----------------------------------------------------------------------


def changes(spark: SparkSession, folder: str) -> DataFrame:
    """One change per event: key user, ordering time, an instant per day."""
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        "user_id",
        "ts",
        F.when(kind == "signup", "c").when(kind == "error", "d").otherwise("u").alias("op"),
        "value",
        "event_id",
        F.date_format("ts", "yyyyMMdd").alias("commit_time"),
    )


CHANGES_SQL = """chg AS (
  SELECT user_id, ts, CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op, value, event_id,
    strftime(ts, '%Y%m%d') AS commit_time
  FROM events)"""


# ---- events as chat bodies ------------------------------------------------------------------------

# Fixed faults of the raw bodies, chosen by the event's own k value.
NO_ROOM, TEXT_TIME, CUT_SHORT, NUMBER_USER, SILENT, LATE_COPY = 13, 17, 19, 23, 7, 90


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    """JSON bodies of chat, join, leave, reaction and unknown events, some of them faulty."""
    e = evaluate_once(spread(table(spark, folder, "events")), k=F.get_json_object("props", "$.k").cast("bigint"))
    kind = F.col("event_type")
    k = F.col("k")
    tag = (
        F.when(kind == "view", "chat").when(kind == "signup", "join").when(kind == "error", "leave").when(kind == "click", "reaction")
        .otherwise("bogus")
    )
    user = F.concat(F.lit("user_"), F.col("user_id"))
    seconds = F.unix_seconds("ts")
    chat, reaction = kind == "view", kind == "click"

    def body(user_field, time_field):
        return F.to_json(
            F.struct(
                tag.alias("event_type"),
                user_field.alias("user_id"),
                F.when(k != NO_ROOM, F.concat(F.lit("room_"), F.floor(k / 10))).alias("room_id"),
                time_field.alias("timestamp"),
                F.when(chat, F.concat(F.lit("journey_"), k)).alias("journey_id"),
                F.when(chat & (k != SILENT), F.concat(F.lit("hello "), F.col("event_id"))).alias("message"),
                F.when(chat, "standard").alias("message_type"),
                F.when(chat, F.when(k < 33, "single").when(k < 66, "group").otherwise("global")).alias("chat_type"),
                F.when(reaction, F.concat(F.lit("msg_"), F.col("event_id"))).alias("message_id"),
                F.when(reaction, F.when(k < 50, "thumbs_up").otherwise("heart")).alias("emoji"),
                F.when(reaction & (k < 25), F.concat(F.lit("user_"), k)).alias("target_user_id"),
                F.when(kind == "signup", "join").alias("room_action"),
            )
        )

    text = (
        F.when(k == TEXT_TIME, body(user, seconds.cast("string")))
        .when(k == NUMBER_USER, body(F.col("user_id"), seconds))
        .otherwise(body(user, seconds))
    )
    return e.select(
        F.col("event_id").alias("src_id"),
        "k",
        (F.unix_millis("ts") + F.floor(F.col("value") * 10)).alias("server_ms"),
        seconds.alias("arrival_s"),
        F.when(k == CUT_SHORT, F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text).alias("value"),
    )


RAW_SQL = f"""raw AS (
  SELECT event_id AS src_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type AS kind, user_id, event_id,
    epoch_us(ts) // 1000 + CAST(floor(value * 10) AS BIGINT) AS server_ms, CAST(floor(epoch(ts)) AS BIGINT) AS seconds
  FROM events),
checked AS (
  SELECT *, CASE WHEN k = {CUT_SHORT} THEN 'malformed_json' WHEN kind = 'purchase' THEN 'unknown_event_type'
      WHEN k = {NO_ROOM} THEN 'missing_field:room_id' WHEN k = {TEXT_TIME} THEN 'wrong_type:timestamp'
      WHEN k = {NUMBER_USER} THEN 'wrong_type:user_id' END AS error
  FROM raw),
shaped AS (
  SELECT src_id, k, server_ms AS server_timestamp,
    CASE kind WHEN 'view' THEN 'chat' WHEN 'signup' THEN 'join' WHEN 'error' THEN 'leave' ELSE 'reaction' END AS event_type,
    'user_' || user_id AS user_id, 'room_' || CAST(floor(k / 10) AS BIGINT) AS room_id,
    CASE WHEN kind = 'view' THEN 'journey_' || k END AS journey_id, seconds AS timestamp,
    CASE WHEN kind = 'view' THEN CASE WHEN k = {SILENT} THEN '' ELSE 'hello ' || event_id END
      WHEN kind = 'click' THEN CASE WHEN k < 50 THEN 'thumbs_up' ELSE 'heart' END ELSE '' END AS payload,
    CASE WHEN kind = 'view' THEN '{{"chat_type":"' || CASE WHEN k < 33 THEN 'single' WHEN k < 66 THEN 'group' ELSE 'global' END
        || '","message_id":null,"message_type":"standard"}}'
      WHEN kind = 'click' THEN '{{"message_id":"msg_' || event_id || '","target_user_id":' ||
        CASE WHEN k < 25 THEN '"user_' || k || '"' ELSE 'null' END || '}}' ELSE '{{}}' END AS metadata_json
  FROM checked WHERE error IS NULL),
hashed AS (
  SELECT *, sha256(length(event_type) || ':' || event_type || length(user_id) || ':' || user_id || length(room_id) || ':' || room_id
    || coalesce(length(journey_id) || ':' || journey_id, '-') || length(CAST(timestamp AS VARCHAR)) || ':' || timestamp
    || length(payload) || ':' || payload || length(metadata_json) || ':' || metadata_json) AS h FROM shaped),
norm AS (
  SELECT * EXCLUDE (h), substr(h,1,8) || '-' || substr(h,9,4) || '-' || substr(h,13,4) || '-' || substr(h,17,4) || '-' || substr(h,21,12) AS event_id
  FROM hashed)"""

# ---- events as change envelopes -------------------------------------------------------------------

# Fixed symbols of the captured table.
SYMBOLS = ["AAPL", "GOOG", "MSFT", "AMZN", "TSLA"]


def envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """Change envelopes of a trades table keyed by user, wrapped beside a schema when k is below 50."""
    e = evaluate_once(table(spark, folder, "events"), k=F.get_json_object("props", "$.k").cast("bigint"))
    kind = F.col("event_type")
    op = F.when(kind == "signup", "c").when(kind == "error", "d").otherwise("u")
    cents = F.round(F.col("value") * 100).cast("bigint")
    signed = F.when(kind == "click", -cents).otherwise(cents)
    # Eight big-endian bytes of the unscaled integer.
    price = F.base64(F.unhex(F.lpad(F.hex(signed), 16, "0")))
    image = F.struct(
        F.concat(F.lit("t"), F.col("user_id")).alias("trade_id"),
        F.element_at(F.array(*[F.lit(s) for s in SYMBOLS]), (F.floor(F.col("k") / 20) + 1).cast("int")).alias("stock_name"),
        price.alias("stock_price"),
        F.when(F.col("k") < 40, "BUY").otherwise("SELL").alias("stock_purchase_choice"),
        F.concat(F.lit("p"), F.col("k")).alias("trader_id"),
        F.lit("2024-01-01T00:00:00Z").alias("created_at"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("updated_at"),
    )
    key_only = F.struct(F.concat(F.lit("t"), F.col("user_id")).alias("trade_id"), F.lit("2024-01-01T00:00:00Z").alias("created_at"))
    source = F.struct(
        F.lit("public").alias("schema"),
        F.when(kind == "purchase", "other_table").otherwise("stock_trades").alias("table"),
        F.col("event_id").alias("lsn"),
        F.unix_millis("ts").alias("ts_ms"),
    )
    bare = F.struct(
        op.alias("op"),
        F.unix_millis("ts").alias("ts_ms"),
        F.when(kind == "error", key_only).alias("before"),
        F.when(kind != "error", image).alias("after"),
        source.alias("source"),
    )
    wrapped = F.concat(F.lit('{"schema":{"type":"struct"},"payload":'), F.to_json(bare), F.lit("}"))
    return e.select(
        F.lit("cdc.public.stock_trades").alias("topic"),
        "ts",
        "k",
        F.date_format("ts", "yyyyMMdd").alias("commit_time"),
        F.when(F.col("k") < 50, wrapped).otherwise(F.to_json(bare)).alias("value"),
    )


def trade_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events beside the key of their user's trade."""
    return table(spark, folder, "events").select(
        "event_id",
        F.concat(F.lit("t"), F.col("user_id")).alias("trade_id"),
        F.lit("2024-01-01T00:00:00Z").cast("timestamp").alias("created_at"),
        F.col("ts").alias("at"),
    )


def faulty_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """The envelopes, some of them with faults by the event's own k value."""
    k, value = F.col("k"), F.col("value")
    return envelopes(spark, folder).withColumn(
        "value",
        F.when(k == CUT_SHORT, F.substring(value, F.lit(1), F.length(value) - 1))
        .when(k == TEXT_TIME, F.regexp_replace(value, '"created_at":"[^"]*"', '"created_at":"soon"'))
        .when(k == NO_ROOM, F.regexp_replace(value, '"op":"[a-z]"', '"op":"x"'))
        .when(k == NUMBER_USER, F.regexp_replace(value, '"stock_price":"[^"]*"', '"stock_price":"12.5"'))
        .otherwise(value),
    )


ENVELOPES_SQL = """img AS (
  SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE event_type <> 'purchase'),
envl AS (
  SELECT 't' || user_id AS trade_id, event_type = 'error' AS gone,
    CASE CAST(floor(k / 20) AS BIGINT) WHEN 0 THEN 'AAPL' WHEN 1 THEN 'GOOG' WHEN 2 THEN 'MSFT' WHEN 3 THEN 'AMZN' ELSE 'TSLA' END AS stock_name,
    round(CASE WHEN event_type = 'click' THEN -value ELSE value END, 2) AS stock_price,
    CASE WHEN k < 40 THEN 'BUY' ELSE 'SELL' END AS stock_purchase_choice, 'p' || k AS trader_id,
    TIMESTAMP '2024-01-01 00:00:00' AS created_at, ts AS updated_at,
    CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op, event_id AS lsn, epoch_us(ts) // 1000 AS ts_ms,
    strftime(ts, '%Y%m%d') AS commit_time
  FROM img),
live AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY lsn DESC) AS rn FROM envl)
  WHERE rn = 1 AND NOT gone)"""

# ---- orders as bars -------------------------------------------------------------------------------


def bars(spark: SparkSession, folder: str) -> DataFrame:
    """Daily bars per order priority: the first and last order by key open and close a day."""
    price, key = F.col("o_totalprice"), F.col("o_orderkey")
    return (
        table(spark, folder, "orders")
        .groupBy(F.col("o_orderpriority").alias("ticker"), F.to_date("o_orderdate").alias("date"))
        .agg(
            F.min_by(price, key).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, key).alias("close"),
            F.count("*").alias("volume"),
        )
    )


BARS_SQL = """bars AS (
  SELECT o_orderpriority AS ticker, CAST(o_orderdate AS DATE) AS date, arg_min(o_totalprice, o_orderkey) AS open,
    max(o_totalprice) AS high, min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close, count(*) AS volume
  FROM orders GROUP BY 1, 2)"""

RETURNS_SQL = BARS_SQL + """,
ret AS (
  SELECT * FROM (SELECT *, ln(close / lag(close) OVER (PARTITION BY ticker ORDER BY date)) AS log_return FROM bars)
  WHERE log_return IS NOT NULL)"""
