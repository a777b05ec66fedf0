"""Returns, moments, rolling dispersion, regimes and summaries over many tickers at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import returns as R
from tidemark.operators.blocks import BLOCK_DAYS, attach_stats, block_window, with_halo, without_halo
from tidemark.operators.distribution import exact_quantile
from tidemark.session import cut_lineage

SERIES = ["ticker"]


def log_returns(bars: DataFrame, block_days: float = BLOCK_DAYS) -> DataFrame:
    """Bars with ``log_return``; rows with any undefined column (the first of a series) are dropped."""
    blocks = with_halo(bars, SERIES, "date", rows_back=1, days=block_days)
    previous = F.lag("close").over(block_window(SERIES, "date"))
    return without_halo(blocks.withColumn("log_return", R.log_ratio(F.col("close"), previous))).na.drop()


def with_range(bars: DataFrame) -> DataFrame:
    """High-low log range, its Parkinson variance term and that term's square root."""
    term = R.parkinson_term(F.col("high"), F.col("low"))
    return bars.withColumns(
        {"hl_range": R.log_ratio(F.col("high"), F.col("low")), "parkinson": term, "parkinson_vol": F.sqrt(term)}
    )


def extent(bars: DataFrame) -> DataFrame:
    """Row count and first and last date per ticker."""
    return bars.groupBy(*SERIES).agg(
        F.count("*").alias("n_rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )


def moments(returns: DataFrame) -> DataFrame:
    """Mean, spread, corrected skewness and kurtosis, extremes and extent per ticker."""
    r = F.col("log_return")
    return returns.groupBy(*SERIES).agg(
        F.count("*").alias("n_rows"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.avg(r).alias("mean_return"),
        F.stddev_samp(r).alias("std_return"),
        R.annualised(F.stddev_samp(r)).alias("annualised_vol"),
        R.sample_skewness(r).alias("skewness"),
        R.sample_kurtosis(r).alias("kurtosis"),
        F.min(r).alias("min_return"),
        F.max(r).alias("max_return"),
    )


def rolling(
    series: DataFrame, value: str, prefix: str, rows: int = R.ROLLING_ROWS, block_days: float = BLOCK_DAYS, written: bool = False
) -> DataFrame:
    """Rolling mean, deviation, population skewness, dispersion and bands; NULL until ``rows`` values exist.

    Blocks and their halos read the series twice, so it is written once first (pass ``written`` if it already is a stored
    table): what it was derived by, such as the returns' own halo, is not part of this plan.
    """
    if not written:
        series = cut_lineage(series, "series")
    blocks = with_halo(series, SERIES, "date", rows_back=rows - 1, days=block_days)
    frame = block_window(SERIES, "date").rowsBetween(-(rows - 1), 0)
    full = F.count(value).over(frame) == rows

    def gated(aggregate: Column) -> Column:
        return F.when(full, aggregate.over(frame))

    out = blocks.withColumns(
        {
            f"{prefix}_ma": gated(F.avg(value)),
            f"{prefix}_std": gated(F.stddev_samp(value)),
            f"{prefix}_skew": gated(F.skewness(value)),
        }
    ).withColumns(
        {
            f"{prefix}_dispersion": F.col(f"{prefix}_std") / F.col(f"{prefix}_ma"),
            f"{prefix}_upper": F.col(f"{prefix}_ma") + F.col(f"{prefix}_std"),
            f"{prefix}_lower": F.col(f"{prefix}_ma") - F.col(f"{prefix}_std"),
        }
    )
    return without_halo(out)


def vol_profile(series: DataFrame, value: str) -> DataFrame:
    """Mean, extremes, deviation and coefficient of variation of a volatility column per ticker."""
    v = F.col(value)
    return series.groupBy(*SERIES).agg(
        F.avg(v).alias("vol_mean"),
        F.max(v).alias("vol_max"),
        F.min(v).alias("vol_min"),
        F.stddev_samp(v).alias("vol_std"),
        R.dispersion(v).alias("dispersion"),
    )


def with_regime(series: DataFrame, value: str, q: float = R.REGIME_QUANTILE) -> DataFrame:
    """Label each row by whether its volatility is above the ticker's own quantile.

    The quantile passes over its input several times, so the series is written once first.
    """
    series = cut_lineage(series, "series")
    threshold = exact_quantile(series, SERIES, value, q, into="vol_threshold")
    # A ticker without any volatility has no threshold; its rows stay and are labelled like every unmarked row.
    marked = attach_stats(series, threshold, SERIES, ["date"], how="left")
    return marked.withColumn("vol_regime", R.regime_label(F.col(value), F.col("vol_threshold")))


def regime_stats(labelled: DataFrame) -> DataFrame:
    """Mean, deviation and count of returns by ticker and regime."""
    return labelled.groupBy(*SERIES, "vol_regime").agg(
        F.avg("log_return").alias("mean_return"),
        F.stddev_samp("log_return").alias("std_return"),
        F.count("log_return").alias("n_rows"),
    )


def regime_summary(labelled: DataFrame) -> DataFrame:
    """High and low regime returns, day counts and the trading pattern per ticker."""
    high = F.col("vol_regime") == R.HIGH_VOL
    out = labelled.groupBy(*SERIES).agg(
        R.mean_where(high, F.col("log_return")).alias("high_vol_return"),
        R.mean_where(~high, F.col("log_return")).alias("low_vol_return"),
        R.count_where(high).alias("high_vol_days"),
        R.count_where(~high).alias("low_vol_days"),
    )
    return out.withColumn("trading_pattern", R.pattern_label(F.col("high_vol_return"), F.col("low_vol_return")))


def align(series: DataFrame, volatility: DataFrame) -> DataFrame:
    """Rows of ``series`` that have a volatility on the same date."""
    return series.join(volatility, [*SERIES, "date"])


def scatter(series: DataFrame, value: str) -> DataFrame:
    """Volume in millions against volatility in percent, with the return as colour."""
    return series.select(
        *SERIES,
        "date",
        (F.col("volume") / R.MILLION).alias("volume_millions"),
        (F.col(value) * R.PERCENT).alias("vol_percent"),
        "log_return",
    )


# Fixed column names of the exported result row and daily series.
RESULT_COLUMNS = [
    "Ticker", "Start_Date", "End_Date", "Mean_Return", "Daily_Volatility", "Annualized_Vol", "Skewness", "Kurtosis",
    "High_Vol_Return", "Low_Vol_Return", "High_Vol_Days", "Low_Vol_Days", "Trading_Pattern", "GARCH_Dispersion",
    "EGARCH_Dispersion", "GARCH_Alpha", "GARCH_Beta", "GARCH_Persistence", "EGARCH_Gamma", "Leverage_Effect",
]
DAILY_COLUMNS = {
    "date": "Date", "close": "Close", "log_return": "Log_Returns", "garch_vol": "GARCH_Volatility",
    "egarch_vol": "EGARCH_Volatility", "garch_dispersion": "GARCH_Vol_Dispersion", "vol_regime": "Vol_Regime",
}


def result_rows(labelled: DataFrame, params: DataFrame) -> DataFrame:
    """The 20-column result row per ticker.

    ``labelled`` carries date, log_return, garch_vol, egarch_vol and vol_regime;
    ``params`` one row per ticker with garch_alpha, garch_beta and egarch_gamma.
    Everything but the parameters comes from one aggregation.
    """
    r, high = F.col("log_return"), F.col("vol_regime") == R.HIGH_VOL
    rows = labelled.groupBy(*SERIES).agg(
        F.min("date").alias("Start_Date"),
        F.max("date").alias("End_Date"),
        F.avg(r).alias("Mean_Return"),
        F.stddev_samp(r).alias("Daily_Volatility"),
        R.annualised(F.stddev_samp(r)).alias("Annualized_Vol"),
        R.sample_skewness(r).alias("Skewness"),
        R.sample_kurtosis(r).alias("Kurtosis"),
        R.mean_where(high, r).alias("High_Vol_Return"),
        R.mean_where(~high, r).alias("Low_Vol_Return"),
        R.count_where(high).alias("High_Vol_Days"),
        R.count_where(~high).alias("Low_Vol_Days"),
        R.dispersion(F.col("garch_vol")).alias("GARCH_Dispersion"),
        R.dispersion(F.col("egarch_vol")).alias("EGARCH_Dispersion"),
    )
    return (
        rows.join(params, SERIES)
        .withColumns(
            {
                "Ticker": F.col("ticker"),
                "Trading_Pattern": R.pattern_label(F.col("High_Vol_Return"), F.col("Low_Vol_Return")),
                "GARCH_Alpha": F.col("garch_alpha"),
                "GARCH_Beta": F.col("garch_beta"),
                "GARCH_Persistence": F.col("garch_alpha") + F.col("garch_beta"),
                "EGARCH_Gamma": F.col("egarch_gamma"),
                "Leverage_Effect": R.leverage_label(F.col("egarch_gamma")),
            }
        )
        .select(*RESULT_COLUMNS)
    )


def daily_rows(series: DataFrame) -> DataFrame:
    """The exported daily series, one block of rows per ticker."""
    return series.select("ticker", *[F.col(c).alias(name) for c, name in DAILY_COLUMNS.items()])


def pattern_counts(results: DataFrame) -> DataFrame:
    """Tickers that 'buy when boring' and 'buy when exciting'."""
    pattern = F.col("Trading_Pattern")
    return results.agg(
        F.count_if(pattern.contains("Buy when boring")).alias("n_boring"),
        F.count_if(pattern.contains("Buy when exciting")).alias("n_exciting"),
    )


def extremes(results: DataFrame) -> DataFrame:
    """Tickers with the highest and lowest daily volatility."""
    sigma = F.col("Daily_Volatility")
    return results.agg(
        F.max_by("Ticker", sigma).alias("highest_ticker"),
        F.max(sigma).alias("highest_vol"),
        F.min_by("Ticker", sigma).alias("lowest_ticker"),
        F.min(sigma).alias("lowest_vol"),
    )


def summary_table(results: DataFrame) -> DataFrame:
    """The printed summary: formatted text columns, the pattern cut to its display width."""
    return results.select(
        "Ticker",
        F.format_string("%.2f%%", F.col("Daily_Volatility") * R.PERCENT).alias("Volatility"),
        F.format_string("%.3f%%", F.col("High_Vol_Return") * R.PERCENT).alias("High_Vol_Return"),
        F.format_string("%.3f%%", F.col("Low_Vol_Return") * R.PERCENT).alias("Low_Vol_Return"),
        F.substring("Trading_Pattern", 1, R.PATTERN_WIDTH).alias("Pattern"),
        F.format_string("%.3f", F.col("GARCH_Dispersion")).alias("Dispersion"),
    )


def study(returns: DataFrame, series, distributions=("normal",)) -> DataFrame:
    """The whole analysis of every ticker in ``returns``: one result row each, with ``Status``.

    ``series`` is :func:`tidemark.plans.garch.prepare` of the same returns. A
    ticker that cannot be fitted keeps its row: its parameters and dispersions
    are NULL, all its days count as low volatility and ``Status`` says why.
    """
    from tidemark.plans import garch as G

    garch, egarch = G.fit_garch(series), G.fit_egarch(series, distributions)
    daily = returns.join(G.volatilities(series, garch, egarch), [*SERIES, "date"], "left")
    labelled = with_regime(daily, "garch_vol")
    params = garch.select("ticker", F.col("alpha").alias("garch_alpha"), F.col("beta").alias("garch_beta"), "status").join(
        egarch.select("ticker", F.col("gamma").alias("egarch_gamma")), "ticker", "left"
    )
    rows = result_rows(labelled, params.drop("status"))
    return rows.join(params.select(F.col("ticker").alias("Ticker"), F.col("status").alias("Status")), "Ticker").select(*RESULT_COLUMNS, "Status")
