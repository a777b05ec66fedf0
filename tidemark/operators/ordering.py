"""Ordering, limits, sampling and ordered layouts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DateType, MapType, StringType, TimestampNTZType, TimestampType, VariantType

from tidemark.operators.blocks import SALTS
from tidemark.session import ensure_session

# Spark's default bound for cutting ranked groups before the shuffle.
EARLY_CUT_ROWS = 1000


def sample_n(df: DataFrame, n: int, key: Sequence[str], seed: int = 0) -> DataFrame:
    """``n`` rows in reproducible random order: a keyed hash replaces RANDOM(), so a retry picks the same rows.

    Plans as a top-n per task followed by a merge; nothing is sorted as a whole.
    """
    token = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))
    return df.orderBy(token, *key).limit(n)


def first_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def newest_first(df: DataFrame, by: str) -> DataFrame:
    return df.orderBy(F.desc(by))


def latest_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The ``n`` first rows of each group by ``order``.

    The rank filter lets Spark cut every group to ``n`` rows per task before
    the shuffle, so a hot group arrives as a handful of rows. Spark does so up
    to ``EARLY_CUT_ROWS``; above, salted parts of each group are cut first
    (the ``n`` first of a group are among the ``n`` first of its parts).
    """
    if n > EARLY_CUT_ROWS:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)))
        part = F.row_number().over(Window.partitionBy(*group, "_salt").orderBy(*order))
        df = salted.withColumn("_rank", part).filter(F.col("_rank") <= n).drop("_rank", "_salt")
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def clustered(df: DataFrame, *order: str) -> DataFrame:
    """Rows range-partitioned and sorted by ``order``: files hold narrow min/max ranges that scans skip.

    Range bounds split a hot leading value by the columns after it, which
    hashing on the leading column could not.
    """
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def write_time_partitioned(df: DataFrame, path: str, time: str, key: Sequence[str], grain: str = "day", mode: str = "overwrite"):
    """Write ``df`` in one folder per day, month or year of ``time``, files clustered by time.

    Time filters then prune folders; ``<time>_<grain>`` is the partition column.
    """
    pattern = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}[grain]
    part = f"{time}_{grain}"
    out = df.withColumn(part, F.date_format(time, pattern))
    clustered(out, part, time, *key).write.mode(mode).partitionBy(part).parquet(path)
    return part


SLOT_BITS = 8


def _numeric(df: DataFrame, name: str) -> Column:
    """A number in the order of the column: instants in seconds, texts by their first seven bytes."""
    kind = df.schema[name].dataType
    if isinstance(kind, StringType):
        return F.conv(F.rpad(F.substring(F.hex(F.col(name)), 1, 14), 14, "0"), 16, 10).cast("double")
    if isinstance(kind, (DateType, TimestampType)):
        return F.unix_seconds(F.col(name).cast("timestamp")).cast("double")
    if isinstance(kind, TimestampNTZType):
        return F.col(name).cast("timestamp").cast("double")
    return F.col(name).cast("double")


def _slot(limits: Column, value: Column, spread: Column) -> Column:
    """Slot of a value among ordered limits; one that stands several times among them is dealt over all its slots."""
    low, high = F.size(F.filter(limits, lambda b: b < value)), F.size(F.filter(limits, lambda b: b <= value))
    return F.coalesce(low + F.pmod(spread, high - low + 1), F.lit(0)).cast("bigint")


def interleaved(df: DataFrame, columns: Sequence[str], files: int) -> DataFrame:
    """Rows dealt into ``files`` partitions by interleaved bits of several columns, sorted inside.

    Every column is cut into 256 slots of equal row counts, whose bounds one
    aggregate over the columns alone gives (255 numbers a column reach the
    driver). The bits of the slot numbers, taken in turn, make a place on the
    curve, and the partition is that place's share of the curve, so a file
    covers a narrow range of each column and a filter on any of them skips most
    files. A value that fills several slots has its rows dealt evenly over them by
    hash, so a hot value does not land in one task. NULLs take slot zero.
    """
    slots = 1 << SLOT_BITS
    shares = [i / slots for i in range(1, slots)]
    bounds = df.agg(*[F.percentile_approx(_numeric(df, c), shares, 10_000).alias(f"b{i}") for i, c in enumerate(columns)]).first()
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if not isinstance(df.schema[c].dataType, (MapType, VariantType))])
    place = F.lit(0).cast("bigint")
    for i, c in enumerate(columns):
        limits, value = F.array(*[F.lit(b) for b in bounds[i] or [0.0]]), _numeric(df, c)
        slot = _slot(limits, value, spread)
        for bit in range(SLOT_BITS):
            target = bit * len(columns) + len(columns) - 1 - i
            place = place.bitwiseOR(F.shiftleft(F.shiftright(slot, bit).bitwiseAND(F.lit(1).cast("bigint")), target))
    number = F.floor(place * files / F.lit(slots ** len(columns))).cast("int")
    dealt = df.withColumn("_place", place).withColumn("_file", number).repartitionById(files, F.col("_file"))
    return dealt.sortWithinPartitions("_place", *columns).drop("_place", "_file")


def write_indexed(df: DataFrame, path: str, columns: Sequence[str], files: int, point: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Write :func:`interleaved` files with a Bloom filter per row group on the columns ``point``.

    Ranges on any of ``columns`` skip row groups by their bounds, equality on a
    ``point`` column also those whose bounds hold the value but whose filter does not.
    """
    ensure_session(df.sparkSession)
    writer = interleaved(df, columns, files).write.mode(mode)
    for c in point:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.enable.dictionary#{c}", "false")
    writer.parquet(path)
