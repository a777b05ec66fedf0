"""Change capture: decode envelopes, apply them to keyed tables, query the result."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.functions.events import evaluate_once
from tidemark.operators.keyed import DELETE, as_of, snapshot
from tidemark.operators.temporal import state_at, validity_intervals
from tidemark.schemas import CHANGE_ENVELOPE, STOCK_TRADES_KEY

# Fixed names of the captured table and its topic.
SOURCE_SCHEMA = "public"
SOURCE_TABLE = "stock_trades"
UPSERT_OPS = ["c", "u", "r"]
CHANGE_ORDER = ["lsn", "ts_ms"]


def decode_decimal(text: Column, precision: int = 12, scale: int = 2, mode: str = "base64") -> Column:
    """Decimal of a change record; NULL where the text is none.

    The connector declares how it writes decimals: ``base64`` of the unscaled
    big-endian two's-complement integer (8 bytes hold up to 18 digits, 16 bytes
    up to 38), or plain ``string``.
    """
    if not 0 < precision <= 38:
        raise ValueError("a decimal has 1 to 38 digits")
    if mode == "string":
        return text.try_cast(f"decimal({precision},{scale})")
    if mode != "base64":
        raise ValueError(f"unknown decimal mode: {mode}")
    digits = F.hex(F.try_to_binary(text, F.lit("base64")))
    if precision > 18:
        return _wide_decimal(digits, precision, scale)
    sign = F.when(digits >= "8", "F").otherwise("0")
    unscaled = F.conv(F.lpad(digits, F.lit(16), sign), 16, -10).cast("decimal(20,0)")
    value = (unscaled * F.lit(Decimal(1).scaleb(-scale))).try_cast(f"decimal({precision},{scale})")
    return F.when(F.length(digits).between(2, 16), value)


def _wide_decimal(digits: Column, precision: int, scale: int) -> Column:
    """Decimal of up to 16 two's-complement bytes in hexadecimal.

    A negative number is one below zero less its inverted bits, so both halves
    of 64 bits are added up unsigned. The point is set in the text: scaling by
    arithmetic would round beyond 38 digits.
    """
    negative = digits >= "8"
    bits = F.when(negative, F.translate(digits, "0123456789ABCDEF", "FEDCBA9876543210")).otherwise(digits)
    bits = F.lpad(bits, 32, "0")
    high, low = (F.conv(F.substring(bits, start, 16), 16, 10).try_cast("decimal(38,0)") for start in (1, 17))
    size = F.try_add(F.try_multiply(high, F.lit(Decimal(1 << 64))).try_cast("decimal(38,0)"), low).try_cast("decimal(38,0)")
    size = F.when(negative, F.try_add(size, F.lit(Decimal(1)))).otherwise(size).try_cast("decimal(38,0)")
    shown = F.lpad(size.cast("string"), F.greatest(F.length(size.cast("string")), F.lit(scale + 1)), F.lit("0"))
    whole = F.substring(shown, F.lit(1), F.length(shown) - scale)
    text = F.concat(F.when(negative, "-").otherwise(""), whole, F.lit("."), F.substring(shown, F.length(shown) - scale + 1, F.lit(scale)))
    return F.when(F.length(digits).between(2, 32), text.try_cast(f"decimal({precision},{scale})"))


def decode_envelopes(records: DataFrame, body: str = "value", keep: bool = False) -> DataFrame:
    """Envelope columns of each change record; the body may be bare or wrapped beside its schema.

    Bodies that are no envelope (no operation) come out with ``op`` NULL. ``keep`` keeps the body too.
    """
    both = StructType([StructField("payload", CHANGE_ENVELOPE), *CHANGE_ENVELOPE])
    # One parse serves both forms: a wrapped body fills ``payload``, a bare one the fields beside it.
    parsed = evaluate_once(records, _e=F.from_json(F.col(body), both))
    wrapped = F.col("_e.payload").isNotNull()
    fields = [F.when(wrapped, F.col(f"_e.payload.{f}")).otherwise(F.col(f"_e.{f}")).alias(f) for f in CHANGE_ENVELOPE.names]
    return parsed.select(*[c for c in records.columns if keep or c != body], *fields)


def of_table(envelopes: DataFrame, schema: str = SOURCE_SCHEMA, table: str = SOURCE_TABLE) -> DataFrame:
    """Keep changes of one table; chunk tables of a time-partitioned source are published under its name."""
    return envelopes.filter((F.col("source.schema") == schema) & (F.col("source.table") == table))


def of_topic(records: DataFrame, topic: str) -> DataFrame:
    return records.filter(F.col("topic") == topic)


CHANGE_COLUMNS = [
    "trade_id", "stock_name", "stock_price", "stock_purchase_choice", "trader_id", "created_at", "updated_at", "op", "lsn", "ts_ms",
]


def _typed(envelopes: DataFrame, decimals: str) -> DataFrame:
    """Envelopes with the typed columns of a change and, in ``_i``, the image they come from."""
    gone = F.col("op") == DELETE
    imaged = envelopes.withColumn("_i", F.when(gone, F.col("before")).otherwise(F.col("after")))

    def live(c: Column) -> Column:
        return F.when(~gone, c)

    return imaged.withColumns(
        {
            "trade_id": F.col("_i.trade_id"),
            "stock_name": live(F.col("_i.stock_name")),
            "stock_price": live(decode_decimal(F.col("_i.stock_price"), mode=decimals)),
            "stock_purchase_choice": live(F.col("_i.stock_purchase_choice")),
            "trader_id": live(F.col("_i.trader_id")),
            "created_at": F.try_to_timestamp(F.col("_i.created_at")),
            "updated_at": live(F.try_to_timestamp(F.col("_i.updated_at"))),
            "lsn": F.coalesce("source.lsn", F.lit(0)),
        }
    )


def change_rows(envelopes: DataFrame, decimals: str = "base64", *also: str) -> DataFrame:
    """Typed rows of a change stream: key from whichever image exists, ``op`` c/u/r/d and source position.

    A delete carries the key alone: the source publishes only the primary key
    in ``before``. Values that cannot be decoded are NULL here;
    :func:`parse_changes` tells them apart. ``also`` names further columns to keep.
    """
    return _typed(envelopes.filter(F.col("op").isin(*UPSERT_OPS, DELETE)), decimals).select(*CHANGE_COLUMNS, *also)


def parse_changes(
    records: DataFrame, body: str = "value", schema: str = SOURCE_SCHEMA, table: str = SOURCE_TABLE, decimals: str = "base64"
) -> DataFrame:
    """Changes of one table with the raw body and ``error``, NULL for those that can be applied.

    Records of other tables are left out; what cannot be read as an envelope at all stays, as it could be of any.
    """
    envelopes = decode_envelopes(records.select(F.col(body).alias("value")), keep=True)
    known = F.col("op").isNull() | ((F.col("source.schema") == schema) & (F.col("source.table") == table))
    typed = _typed(envelopes.filter(known), decimals)
    upsert = F.col("op") != DELETE

    def unread(name: str) -> Column:
        return F.col(f"_i.{name}").isNotNull() & F.col(name).isNull()

    error = (
        F.when(F.try_parse_json("value").isNull(), "malformed_json")
        .when(F.col("op").isNull(), "no_operation")
        .when(~F.col("op").isin(*UPSERT_OPS, DELETE), "unknown_operation")
        .when(F.col("_i").isNull(), "no_image")
        .when(F.col("_i.trade_id").isNull() | F.col("_i.created_at").isNull(), "missing_key")
        .when(unread("created_at"), "wrong_instant:created_at")
        .when(upsert & unread("updated_at"), "wrong_instant:updated_at")
        .when(upsert & unread("stock_price"), "wrong_decimal:stock_price")
    )
    return evaluate_once(typed, error=error).select("value", *CHANGE_COLUMNS, "error")


def valid_changes(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error").isNull()).select(*CHANGE_COLUMNS)


def rejected_changes(parsed: DataFrame) -> DataFrame:
    """Bad-record path: raw text and reason of every change that cannot be applied."""
    return parsed.filter(F.col("error").isNotNull()).select(F.col("value").alias("raw"), "error")


def apply_changes(changes: DataFrame) -> DataFrame:
    """Live rows after all changes: last change per key by source position, deleted keys absent."""
    return snapshot(changes, STOCK_TRADES_KEY, CHANGE_ORDER).drop("op", "lsn", "ts_ms")


def changes_as_of(changes: DataFrame, commit: str, at: str) -> DataFrame:
    """The table as the retained history had it at commit ``at``."""
    return as_of(changes, STOCK_TRADES_KEY, CHANGE_ORDER, commit, at).drop("op", "lsn", "ts_ms", commit)


def _dated(changes: DataFrame) -> DataFrame:
    return changes.withColumn("changed_at", F.timestamp_millis("ts_ms"))


def trade_intervals(changes: DataFrame) -> DataFrame:
    """Every state a trade had, from the source time of its change to that of the next one."""
    intervals = validity_intervals(_dated(changes), STOCK_TRADES_KEY, "changed_at", CHANGE_ORDER)
    return intervals.drop("changed_at", "op", "lsn", "ts_ms")


def trades_at(rows: DataFrame, changes: DataFrame, asked: str) -> DataFrame:
    """``rows`` (with the key columns of a trade) beside name, price and side the trade had at instant ``asked``."""
    columns = {c: f"{c}_then" for c in ("stock_name", "stock_price", "stock_purchase_choice")}
    return state_at(rows, _dated(changes), STOCK_TRADES_KEY, asked, "changed_at", CHANGE_ORDER, columns)


def symbol_totals(trades: DataFrame) -> DataFrame:
    """Query layer: trades, side counts and price statistics per symbol."""
    price = F.col("stock_price").cast("double")
    return trades.groupBy("stock_name").agg(
        F.count("*").alias("n_trades"),
        F.count_if(F.col("stock_purchase_choice") == "BUY").alias("n_buy"),
        F.count_if(F.col("stock_purchase_choice") == "SELL").alias("n_sell"),
        F.sum(price).alias("total_price"),
        F.avg(price).alias("avg_price"),
        F.max(price).alias("max_price"),
    )
