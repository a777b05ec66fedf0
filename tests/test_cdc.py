import base64
import json
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.functions.returns import to_cents, toggled_side
from tidemark.operators import keyed as K, quality as Q
from tidemark.plans import cdc as C
from tidemark.schemas import STOCK_TRADES
from tidemark.sources import topics as S
from tidemark.streaming import jobs as J

CREATED = "2024-01-01T00:00:00Z"


def price(text):
    n = int(Decimal(text) * 100)
    size = max(1, (n + (n < 0)).bit_length() // 8 + 1)
    return base64.b64encode(n.to_bytes(size, "big", signed=True)).decode()


def envelope(op, key, lsn, cost="1.00", side="BUY", wrapped=False, table="stock_trades", ts_ms=None):
    image = {
        "trade_id": key, "stock_name": "AAPL", "stock_price": price(cost), "stock_purchase_choice": side, "trader_id": "p",
        "created_at": CREATED, "updated_at": "2024-01-02T10:20:30.123456Z",
    }
    gone = op == "d"
    body = {
        "op": op, "ts_ms": lsn if ts_ms is None else ts_ms, "before": {"trade_id": key, "created_at": CREATED} if gone else None,
        "after": None if gone else image, "source": {"schema": "public", "table": table, "lsn": lsn, "ts_ms": lsn},
    }
    return json.dumps({"schema": {"type": "struct"}, "payload": body} if wrapped else body)


def records(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def changes(spark, *values):
    return C.change_rows(C.of_table(C.decode_envelopes(records(spark, *values))))


@pytest.mark.parametrize(
    "text", ["0.00", "0.01", "1.27", "1.28", "1.29", "327.67", "327.68", "-0.01", "-1.28", "-1.29", "-12345678.90", "9999999999.99", "-9999999999.99"]
)
def test_decimals(spark, text):
    got = spark.createDataFrame([(price(text),)], "p string").select(C.decode_decimal(F.col("p")).alias("d")).first().d
    assert got == Decimal(text)


WIDE = 10**38 - 1


@pytest.mark.parametrize("scale", [0, 2, 9, 37, 38])
def test_wide_decimals_round_trip(spark, scale):
    """19 to 38 digits of both signs, the borders of every byte and of the 64-bit halves among them."""
    sizes = [0, 1, 127, 128, 255, 256, WIDE, WIDE - 1, *[10**n + d for n in range(18, 38) for d in (-1, 0, 7)]]
    sizes += [(1 << b) + d for b in (62, 63, 64, 65, 71, 119, 126) for d in (-1, 0, 1)]
    numbers = [s * n for n in sizes for s in (1, -1) if n <= WIDE]
    shown = [(str(n), base64.b64encode(n.to_bytes(((n + (n < 0)).bit_length()) // 8 + 1, "big", signed=True)).decode()) for n in numbers]
    df = spark.createDataFrame(shown, "n string, p string")
    got = df.select("n", C.decode_decimal(F.col("p"), 38, scale).alias("d"))
    assert got.schema["d"].dataType.simpleString() == f"decimal(38,{scale})"
    assert [r.d for r in got.collect()] == [Decimal(f"{n}E-{scale}") for n, _ in shown]


def test_wide_decimals_beyond_their_digits_are_null(spark):
    texts = [base64.b64encode(n.to_bytes(size, "big", signed=True)).decode() for n, size in [(WIDE + 1, 16), (-WIDE - 1, 16), (2**127 - 1, 16), (5, 17), (10**20, 9)]]
    df = spark.createDataFrame([(t,) for t in [*texts, "", "?", None]], "p string")
    assert [r.d for r in df.select(C.decode_decimal(F.col("p"), 38, 2).alias("d")).collect()][:4] == [None] * 4
    assert [r.d for r in df.select(C.decode_decimal(F.col("p"), 20, 2).alias("d")).collect()] == [None] * 8
    with pytest.raises(ValueError):
        C.decode_decimal(F.col("p"), 39, 2)


def test_null_decimal(spark):
    assert spark.createDataFrame([(None,)], "p string").select(C.decode_decimal(F.col("p")).alias("d")).first().d is None


def test_bare_and_wrapped_decode_alike(spark):
    bare, wrapped = (changes(spark, envelope("c", "t1", 5, "12.34", wrapped=w)).first() for w in (False, True))
    assert bare == wrapped
    assert bare.stock_price == Decimal("12.34") and bare.updated_at.microsecond == 123456 and bare.op == "c"
    typed = changes(spark, envelope("c", "t1", 5)).schema
    for field in STOCK_TRADES.fields:
        assert typed[field.name].dataType == field.dataType


def test_other_tables_and_junk_are_dropped(spark):
    assert changes(spark, envelope("c", "t", 1, table="other"), "junk", "{}", json.dumps({"op": "x"})).count() == 0


def test_apply_orders_by_source_position(spark):
    values = [
        envelope("u", "a", 3, "3.00"), envelope("c", "a", 1, "1.00"), envelope("r", "b", 1, "9.00", wrapped=True), envelope("d", "b", 4),
        envelope("c", "c", 2), envelope("d", "c", 3, wrapped=True), envelope("c", "c", 6, "6.00", "SELL"),
    ]
    live = C.apply_changes(changes(spark, *values))
    assert rows(live, "trade_id", "stock_price") == [("a", Decimal("3.00")), ("c", Decimal("6.00"))]
    totals = C.symbol_totals(live).first()
    assert (totals.n_trades, totals.n_buy, totals.n_sell, totals.total_price) == (2, 1, 1, 9.0)
    assert rows(C.changes_as_of(changes(spark, *values), "ts_ms", "2"), "trade_id") == [("a",), ("b",), ("c",)]


def test_stream_equals_batch_in_any_arrival_order(spark, tmp_path):
    values = [
        envelope("d", "b", 4), envelope("u", "a", 3, "3.00"), envelope("c", "b", 2, wrapped=True), envelope("c", "a", 1),
        envelope("u", "a", 7, "7.00"), envelope("c", "z", 5),
    ]
    for v in values:
        records(spark, v).write.mode("append").text(str(tmp_path / "topic"))
    table = J.change_table(spark, str(tmp_path / "trades"))
    J.drain(J.change_stream(S.stream_lines(spark, str(tmp_path / "topic"), 1), table, str(tmp_path / "c"), J.DRAIN))
    assert rows(J.current_trades(table)) == rows(C.apply_changes(changes(spark, *values)))


def test_quality_rules(spark):
    trades = C.apply_changes(changes(spark, envelope("c", "a", 1), envelope("c", "b", 2, side="HOLD")))
    good, bad = Q.split_rows(trades, Q.trade_constraints())
    assert rows(good, "trade_id") == [("a",)] and bad.first().violations == ["stock_purchase_choice_in_list"]
    filled = Q.with_defaults(trades.drop("updated_at", "trader_id"), Q.trade_defaults(F.lit("2024-05-05").cast("timestamp")))
    row = filled.first()
    assert len(row.trader_id) == 36 and row.updated_at.isoformat() == "2024-05-05T00:00:00"
    assert Q.duplicate_keys(trades.unionByName(trades), ["trade_id", "created_at"]).count() == 2


def test_update_and_delete_with_an_empty_source_touch_nothing(spark):
    trades = C.apply_changes(changes(spark, envelope("c", "a", 1, "10.05"), envelope("c", "b", 2, "20.00", "SELL")))
    one = trades.filter("trade_id = 'a'").select("trade_id", "created_at")
    new = {"stock_price": to_cents(F.col("stock_price") * 2), "stock_purchase_choice": toggled_side(F.col("stock_purchase_choice"))}
    updated = K.update_from(trades, one, ["trade_id", "created_at"], new)
    assert rows(updated, "trade_id", "stock_price", "stock_purchase_choice") == [("a", Decimal("20.10"), "SELL"), ("b", Decimal("20.00"), "SELL")]
    none = one.filter("false")
    assert rows(K.update_from(trades, none, ["trade_id"], new)) == rows(trades)
    assert rows(K.delete_using(trades, none, ["trade_id"])) == rows(trades)
    assert K.returning(trades, none, ["trade_id"]).count() == 0
    assert rows(K.returning(trades, one.union(one), ["trade_id"])) == [("a",)]


def test_what_cannot_be_decoded_is_kept_with_its_reason(spark):
    good = envelope("c", "t1", 1)
    plain = good.replace(f'"stock_price": "{price("1.00")}"', '"stock_price": "12.5"')
    bad = {
        good[:-1]: "malformed_json",
        json.dumps({"a": 1}): "no_operation",
        good.replace('"op": "c"', '"op": "x"'): "unknown_operation",
        good.replace(CREATED, "soon"): "wrong_instant:created_at",
        good.replace("2024-01-02T10:20:30.123456Z", "2024-13-02"): "wrong_instant:updated_at",
        plain: "wrong_decimal:stock_price",
        good.replace('"trade_id": "t1"', '"trade_id": null'): "missing_key",
        good.replace('"after"', '"afterwards"'): "no_image",
    }
    parsed = C.parse_changes(records(spark, good, *bad, envelope("c", "t2", 2, table="other")))
    assert {r.raw: r.error for r in C.rejected_changes(parsed).collect()} == bad
    assert rows(C.valid_changes(parsed), "trade_id") == [("t1",)]
    # One bad instant neither ends a batch nor counts as a time.
    assert changes(spark, good.replace(CREATED, "soon")).first().created_at is None


def test_decimal_modes(spark):
    df = spark.createDataFrame([("12.5",), ("x",), (price("3.21"),), ("AAAAAAAAAAAAAAAAAAA=",), (None,)], "p string")
    plain = [r[0] for r in df.select(C.decode_decimal(F.col("p"), mode="string")).collect()]
    coded = [r[0] for r in df.select(C.decode_decimal(F.col("p"))).collect()]
    assert plain == [Decimal("12.50"), None, None, None, None]
    assert coded == [None, None, Decimal("3.21"), None, None]
    with pytest.raises(ValueError):
        C.decode_decimal(F.col("p"), precision=19)


def test_stream_and_batch_agree_on_equal_positions(spark, tmp_path):
    late, early = envelope("u", "t1", 0, "2.00", ts_ms=20), envelope("u", "t1", 0, "9.00", ts_ms=10)
    for i, body in enumerate((late, early)):
        records(spark, body).coalesce(1).write.mode("append").text(str(tmp_path / "in"))
        table = J.change_table(spark, str(tmp_path / "t"))
        J.drain(J.change_stream(S.stream_lines(spark, str(tmp_path / "in")), table, str(tmp_path / "cp"), J.DRAIN))
    batch = C.apply_changes(changes(spark, late, early))
    assert rows(J.current_trades(table), *batch.columns) == rows(batch) and batch.first().stock_price == Decimal("2.00")


def test_deleted_keys_leave_after_the_horizon(spark, tmp_path):
    """A change older than a delete loses to it while the delete is within the horizon, and is applied once it has left."""
    table = J.change_table(spark, str(tmp_path / "t"), horizon=100, buckets=1)
    put = lambda *bodies: table.upsert(C.valid_changes(C.parse_changes(records(spark, *bodies))))
    put(envelope("c", "a", 10), envelope("d", "a", 50), envelope("d", "b", 120))
    put(envelope("u", "a", 20), envelope("u", "z", 149))
    assert rows(J.current_trades(table), "trade_id") == [("z",)] and table.snapshot().count() == 3, "the late change loses"
    put(envelope("u", "z", 160))
    assert rows(table.snapshot(), "trade_id", "op") == [("b", "d"), ("z", "u")], "a's delete is out of the horizon, b's is not"
