"""Scalar expressions of the volatility study."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values of the study.
TRADING_DAYS = 252.0
ROLLING_ROWS = 20
REGIME_QUANTILE = 0.75
HIGH_VOL = "High Vol"
LOW_VOL = "Low Vol"
BORING = "Buy when boring (sells off in high vol)"
EXCITING = "Buy when exciting (rallies in high vol)"
PATTERN_WIDTH = 28
PERCENT = 100.0
MILLION = 1e6


def log_ratio(a: Column, b: Column) -> Column:
    """ln(a / b); NULL unless both are positive."""
    return F.when((a > 0) & (b > 0), F.log(a / b))


def parkinson_term(high: Column, low: Column) -> Column:
    """High-low range variance of one bar: ln(high/low)^2 / (4 ln 2)."""
    span = log_ratio(high, low)
    return span * span / (4.0 * F.log(F.lit(2.0)))


def regime_label(vol: Column, threshold: Column) -> Column:
    """High only when strictly above the threshold; undefined volatility counts as low."""
    return F.when(~F.isnan(vol) & (vol > threshold), HIGH_VOL).otherwise(LOW_VOL)


def pattern_label(high_vol_return: Column, low_vol_return: Column) -> Column:
    return F.when(high_vol_return < low_vol_return, BORING).otherwise(EXCITING)


def leverage_label(gamma: Column) -> Column:
    """NULL-safe: an unknown asymmetry is not a leverage effect."""
    return F.when(gamma < 0, "Yes").otherwise("No/Unknown")


def annualised(daily: Column) -> Column:
    return daily * F.sqrt(F.lit(TRADING_DAYS))


def toggled_side(side: Column) -> Column:
    return F.when(side == "BUY", "SELL").otherwise("BUY")


def to_cents(value: Column) -> Column:
    return F.round(value, 2).cast("decimal(12,2)")


# ---- aggregates ---------------------------------------------------------------------------------


def sample_skewness(value: Column) -> Column:
    """Bias-corrected skewness G1 (Spark's own is the population moment); NULL below 3 values."""
    n = F.count(value).cast("double")
    return F.when(n >= 3, F.skewness(value) * F.sqrt(n * (n - 1)) / (n - 2))


def sample_kurtosis(value: Column) -> Column:
    """Bias-corrected excess kurtosis G2; NULL below 4 values."""
    n = F.count(value).cast("double")
    return F.when(n >= 4, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(value) + 6))


def dispersion(value: Column) -> Column:
    """Coefficient of variation; 0 for an empty series."""
    return F.coalesce(F.stddev_samp(value) / F.avg(value), F.lit(0.0))


def mean_where(mask: Column, value: Column) -> Column:
    """Mean over the rows of a mask, 0 when there are none."""
    return F.coalesce(F.avg(F.when(mask, value)), F.lit(0.0))


def count_where(mask: Column) -> Column:
    return F.count_if(mask)
