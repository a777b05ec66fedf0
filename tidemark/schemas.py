"""Explicit schemas of every table the library reads or writes."""

from __future__ import annotations

from pyspark.sql.types import (
    DataType, DateType, DecimalType, DoubleType, LongType, StringType, StructField, StructType, TimestampType,
)

TEXT, LONG, DOUBLE, DATE, INSTANT = StringType(), LongType(), DoubleType(), DateType(), TimestampType()


def struct(**fields: DataType) -> StructType:
    """A schema of nullable fields in the given order."""
    return StructType([StructField(name, dtype, True) for name, dtype in fields.items()])


USERS = struct(id=TEXT, name=TEXT, ts=LONG)
USERS_EVOLVED = struct(id=TEXT, name=TEXT, ts=LONG, email=TEXT)
USER_DELETES = struct(id=TEXT, ts=LONG)

STOCK_TRADES = struct(
    trade_id=TEXT, stock_name=TEXT, stock_price=DecimalType(12, 2), stock_purchase_choice=TEXT, trader_id=TEXT,
    created_at=INSTANT, updated_at=INSTANT,
)
STOCK_TRADES_KEY = ["trade_id", "created_at"]

# A row image inside a change envelope: decimals arrive as base64 text, times as ISO text.
TRADE_IMAGE = struct(
    trade_id=TEXT, stock_name=TEXT, stock_price=TEXT, stock_purchase_choice=TEXT, trader_id=TEXT, created_at=TEXT,
    updated_at=TEXT,
)
CHANGE_ENVELOPE = struct(
    op=TEXT, ts_ms=LONG, before=TRADE_IMAGE, after=TRADE_IMAGE,
    source=struct(schema=TEXT, table=TEXT, lsn=LONG, ts_ms=LONG),
)

NORMALIZED_EVENT = struct(
    event_type=TEXT, user_id=TEXT, room_id=TEXT, journey_id=TEXT, timestamp=LONG, payload=TEXT, metadata_json=TEXT,
    event_id=TEXT, server_timestamp=LONG,
)
MESSAGES = struct(
    room_id=TEXT, timestamp=LONG, event_id=TEXT, event_type=TEXT, user_id=TEXT, payload=TEXT, metadata_json=TEXT,
    server_timestamp=LONG,
)
MESSAGES_KEY = ["room_id", "timestamp", "event_id"]
ROOMS = struct(room_id=TEXT, name=TEXT, room_type=TEXT, created_at=LONG, updated_at=LONG)
GROUP_MEMBERS = struct(room_id=TEXT, user_id=TEXT, joined_at=LONG, updated_at=LONG)
USER_ROOMS = struct(user_id=TEXT, room_id=TEXT, joined_at=LONG, updated_at=LONG)

BARS = struct(ticker=TEXT, date=DATE, open=DOUBLE, high=DOUBLE, low=DOUBLE, close=DOUBLE, volume=LONG)
