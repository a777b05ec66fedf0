"""Table scans: parquet tables, inline records and OHLCV bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType, TimestampNTZType


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Scan ``folder/name.parquet``; zone-less timestamps become instants (session zone is UTC)."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(
        *[
            F.col(f.name).cast("timestamp").alias(f.name) if isinstance(f.dataType, TimestampNTZType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def records(spark: SparkSession, rows: list[dict], schema: StructType) -> DataFrame:
    """Inline records matched to ``schema`` by name; absent columns read NULL, unknown ones are refused."""
    unknown = {k for r in rows for k in r} - set(schema.names)
    if unknown:
        raise ValueError(f"columns not in schema: {sorted(unknown)}")
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)


def scan_bars(bars: DataFrame, tickers: list[str] | None = None, start=None, end=None) -> DataFrame:
    """Bars of the given tickers with ``start <= date < end``; all filters reach the scan."""
    if tickers is not None:
        bars = bars.filter(F.col("ticker").isin(*tickers))
    if start is not None:
        bars = bars.filter(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        bars = bars.filter(F.col("date") < F.lit(end).cast("date"))
    return bars


def flatten_columns(df: DataFrame) -> DataFrame:
    """Name columns of a two-level frame (``Close.AAPL``) by their first level."""
    return df.toDF(*[c.split(".")[0] for c in df.columns])
