"""Exact quantiles and histograms per key from counts, so that only a bounded rest of a key's values meets in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.blocks import attach_stats
from tidemark.session import cut_lineage

# Values of one key that may be counted one by one in the end.
LAST_ROWS = 100_000


def _numbers(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Keys and values that are numbers: neither NULL nor NaN."""
    v = F.col(value).cast("double")
    return df.filter(v.isNotNull() & ~F.isnan(v)).select(*keys, v.alias("_v"))


def bin_of(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin 0..bins-1 of ``value`` in [low, high]; the last bin is closed on the right.

    Monotone in ``value``. A range with no width is a single bin.
    """
    index = F.floor((value - low) / (high - low) * F.lit(float(bins)))
    return F.when(high > low, F.least(F.greatest(index, F.lit(0)), F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")


def _narrow(rows: DataFrame, bands: DataFrame, keys: Sequence[str], bin_: Column) -> DataFrame:
    """Count each key's rows inside its band per bin and keep the bin holding the wanted rank.

    Rank ``_rank`` (0-based, within the band) and its successor either fall
    into one bin, which becomes the next band, or into two neighbours, whose
    touching ends are then the wanted values ``_v0`` and ``_v1``. A key whose
    values are known is carried along in a single bin.
    """
    within = attach_stats(rows, bands, keys, ["_v"], written=True).filter(F.col("_v").between(F.col("_low"), F.col("_high")))
    bin_ = F.when(F.col("_v0").isNull(), bin_)
    counted = within.groupBy(*keys, "_rank", "_frac", "_v0", "_v1", bin_.alias("_bin")).agg(
        F.count("*").alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max")
    )
    by_bin = Window.partitionBy(*keys).orderBy("_bin")
    placed = counted.withColumns(
        {
            "_cum": F.sum("_n").over(by_bin.rowsBetween(Window.unboundedPreceding, 0)),
            "_next": F.lead("_min").over(by_bin),
        }
    ).filter((F.col("_cum") > F.col("_rank")) & (F.col("_cum") - F.col("_n") <= F.col("_rank")))
    known = F.col("_v0").isNotNull()
    split = F.col("_cum") == F.col("_rank") + 1
    single = F.col("_min") == F.col("_max")
    return placed.select(
        *keys,
        F.when(known, 0).otherwise(F.col("_rank") - (F.col("_cum") - F.col("_n"))).alias("_rank"),
        "_frac",
        F.col("_min").alias("_low"),
        F.col("_max").alias("_high"),
        F.when(known, F.col("_v0")).when(single | split, F.col("_max")).alias("_v0"),
        F.when(known, F.col("_v1"))
        .when(split, F.coalesce("_next", "_max"))
        .when(single, F.col("_max"))
        .alias("_v1"),
        F.when(known | split | single, 0).otherwise(F.col("_n")).alias("_left"),
    )


def exact_quantile(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    q: float,
    into: str = "quantile",
    bins: int = 1 << 16,
    last_rows: int = LAST_ROWS,
) -> DataFrame:
    """One row per key with the linearly interpolated quantile of its values (NULL and NaN do not count).

    Selection by counting: each level counts a key's values in ``bins`` bins
    (partial counts; at most ``bins`` rows per key leave a task) and keeps the
    bin holding the wanted rank. Levels follow until no key has more than
    ``last_rows`` values left, which are then counted one by one. A band's ends
    are values, so every level sheds some; a far outlier costs one more level.
    """
    rows = _numbers(df, keys, value)
    position = (F.col("_count") - 1) * F.lit(float(q))
    unknown = F.lit(None).cast("double")
    bands = (
        rows.groupBy(*keys)
        .agg(F.count("*").alias("_count"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
        .select(
            *keys,
            F.floor(position).alias("_rank"),
            (position - F.floor(position)).alias("_frac"),
            "_low",
            "_high",
            unknown.alias("_v0"),
            unknown.alias("_v1"),
            F.col("_count").alias("_left"),
        )
    )
    bands = cut_lineage(bands, "quantile-bands")
    while (bands.agg(F.max("_left")).first()[0] or 0) > last_rows:
        bands = cut_lineage(_narrow(rows, bands, keys, bin_of(F.col("_v"), F.col("_low"), F.col("_high"), bins)), "quantile-bands")
    bands = _narrow(rows, bands, keys, F.col("_v"))
    return bands.select(*keys, (F.col("_v0") + (F.col("_v1") - F.col("_v0")) * F.col("_frac")).alias(into))


def density_histogram(df: DataFrame, keys: Sequence[str], value: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram per key normalised to density; empty bins are absent.

    Partial counts leave each task, so rows of a hot key never travel.
    """
    rows = _numbers(df, keys, value)
    extent = rows.groupBy(*keys).agg(
        F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.count("*").alias("_total")
    )
    binned = attach_stats(rows, extent, keys, ["_v"])
    width = (F.col("_high") - F.col("_low")) / bins
    return (
        binned.groupBy(*keys, "_low", "_high", "_total", bin_of(F.col("_v"), F.col("_low"), F.col("_high"), bins).alias("bin"))
        .agg(F.count("*").alias("n"))
        .select(
            *keys,
            "bin",
            (F.col("_low") + F.col("bin") * width).alias("bin_start"),
            "n",
            F.when(width > 0, F.col("n") / (F.col("_total") * width)).alias("density"),
        )
    )
