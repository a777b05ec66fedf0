"""Series split into time blocks, so that one long series is many tasks' work.

A window over a whole series puts it into one task. Here a series is cut into
blocks of ``days`` calendar days (a fraction for intraday series); a block
holds at most one row per distinct order value, so its size is bounded by its
length. Frames reaching back across a block's start see a halo: copies of the
last rows before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DateType

from tidemark.session import cut_lineage

BLOCK_DAYS = 1024
# Rows of a block: what one window or one array of a fit may hold. Blocks of denser series are cut shorter.
MAX_BLOCK_ROWS = 16_384
BLOCK = "_block"
HALO = "_halo"

# A row of per-key values is a few numbers: this many stay within some 20 MB.
BROADCAST_ROWS = 100_000
SALTS = 64


def block_of(order: str, days: float = BLOCK_DAYS) -> Column:
    """Number of the block a date or timestamp falls into."""
    return F.floor(F.unix_seconds(F.col(order).cast("timestamp")) / F.lit(float(days * 86_400))).cast("bigint")


def fitted_days(df: DataFrame, series: Sequence[str], order: str, days: float, max_rows: int | None = None) -> float:
    """``days``, or the shorter length at which no block of a series has more than ``max_rows`` rows.

    Series of dates have a row a day at most. Those of timestamps are counted
    per block (partial counts leave a task), again with shorter blocks until
    the fullest one fits; a timestamp occurs once in a series, so one does.
    """
    max_rows = max_rows or MAX_BLOCK_ROWS
    if isinstance(df.schema[order].dataType, DateType):
        return min(days, float(max_rows))
    while True:
        counted = df.groupBy(*series, block_of(order, days).alias(BLOCK)).count()
        fullest = counted.agg(F.max("count")).first()[0] or 0
        if fullest <= max_rows:
            return days
        days /= max(2.0, 1.25 * fullest / max_rows)


def with_halo(df: DataFrame, series: Sequence[str], order: str, rows_back: int, days: float = BLOCK_DAYS) -> DataFrame:
    """Add ``_block`` and, flagged ``_halo``, the ``rows_back`` rows that precede each block of a series.

    Only the last ``rows_back`` rows of any block can be needed by a later one
    (the rank filter reduces blocks to them before the shuffle). A tail row is
    copied to every block that starts within the next ``rows_back`` tail rows:
    counting only tail rows is exact, because the rows left out are followed by
    ``rows_back`` tail rows of their own block.
    """
    df = df.withColumn(BLOCK, block_of(order, fitted_days(df, series, order, days)))
    newest = Window.partitionBy(*series, BLOCK).orderBy(F.desc(order))
    tails = df.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= rows_back).drop("_rank")
    ahead = Window.partitionBy(*series).orderBy(order).rowsBetween(1, rows_back)
    targets = F.array_remove(F.collect_set(BLOCK).over(ahead), F.col(BLOCK))
    halo = tails.withColumn("_to", targets).withColumn(BLOCK, F.explode("_to")).drop("_to")
    return df.withColumn(HALO, F.lit(False)).unionByName(halo.withColumn(HALO, F.lit(True)))


def block_window(series: Sequence[str], order: str) -> Window:
    return Window.partitionBy(*series, BLOCK).orderBy(order)


def without_halo(df: DataFrame) -> DataFrame:
    return df.filter(~F.col(HALO)).drop(HALO, BLOCK)


def attach_stats(
    rows: DataFrame,
    stats: DataFrame,
    on: Sequence[str],
    spread: Sequence[str],
    broadcast_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
    written: bool = False,
    how: str = "inner",
) -> DataFrame:
    """Put per-key values (one narrow row per key) onto ``rows``.

    ``how='left'`` keeps rows whose key has no values, with NULLs.

    The per-key table is written and counted first (pass ``written`` if it
    already is a stored table). Up to ``broadcast_rows`` keys it is broadcast
    and ``rows``, of which one key may hold a third, are not shuffled. Beyond
    that the key is salted by ``spread`` with a stats row per salt; adaptive
    execution splits what is still skewed.
    """
    if not written:
        stats = cut_lineage(stats, "per-key")
    if stats.count() <= broadcast_rows:
        return rows.join(F.broadcast(stats), list(on), how)
    salted = stats.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    keyed = rows.withColumn("_salt", F.pmod(F.hash(*spread), F.lit(salts)))
    return keyed.join(salted, [*on, "_salt"], how).drop("_salt")
