"""Volatility queries over daily bars, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import views as V
from tidemark.functions import returns as R
from tidemark.operators import distribution as D, ordering as O
from tidemark.plans import garch as G, volatility as P
from tidemark.session import cut_lineage, scratch_path
from tidemark.sources.tables import scan_bars
from tidemark.streaming.sinks import export_daily, export_results

START, END = "1996-01-01", "2000-01-01"
HIST_BINS = 50

# Fixed parameters of the filter queries, relative to each ticker's own mean and variance.
ALPHA, BETA, GAMMA = 0.1, 0.8, -0.05
E_ALPHA, E_BETA = 0.15, 0.9


def _returns(spark, d):
    return P.log_returns(V.bars(spark, d))


def _abs_vol(spark, d):
    """Returns with their size as the volatility measure."""
    return _returns(spark, d).withColumn("vol", F.abs("log_return"))


GRID_DIGITS = 4


def ts_scan(spark, d):
    """Two tickers in a date range: start included, end not."""
    return scan_bars(V.bars(spark, d), ["1-URGENT", "2-HIGH"], START, END)


def ts_returns(spark, d):
    out = P.with_range(_returns(spark, d))
    return V.rounded(out, 9, "log_return", "hl_range", "parkinson", "parkinson_vol")


def ts_moments(spark, d):
    return V.rounded(P.moments(_returns(spark, d)))


def ts_extent(spark, d):
    return P.extent(V.bars(spark, d))


def ts_rolling(spark, d):
    out = P.rolling(_abs_vol(spark, d), "vol", "vol")
    return V.rounded(out.select("ticker", "date", "vol_ma", "vol_std", "vol_skew", "vol_dispersion", "vol_upper", "vol_lower"))


def ts_quantile(spark, d):
    sizes = cut_lineage(_abs_vol(spark, d).select(*P.SERIES, "vol"), "sizes")
    return V.rounded(D.exact_quantile(sizes, P.SERIES, "vol", R.REGIME_QUANTILE), 9)


def ts_regimes(spark, d):
    return V.rounded(P.regime_stats(P.with_regime(_abs_vol(spark, d), "vol")))


def ts_regime_labels(spark, d):
    return P.with_regime(_abs_vol(spark, d), "vol").select("ticker", "date", "vol_regime")


def ts_regime_summary(spark, d):
    return V.rounded(P.regime_summary(P.with_regime(_abs_vol(spark, d), "vol")), 9)


def ts_dispersion(spark, d):
    return V.rounded(P.vol_profile(_abs_vol(spark, d), "vol"))


def ts_histogram(spark, d):
    return V.rounded(D.density_histogram(_abs_vol(spark, d), P.SERIES, "vol", HIST_BINS))


def ts_scatter(spark, d):
    return V.rounded(P.scatter(_abs_vol(spark, d), "vol"), 9)


def ts_head(spark, d):
    """First five bars of each ticker."""
    return O.latest_per_group(V.bars(spark, d), P.SERIES, [F.asc("date")], 5)


def ts_first_rows(spark, d):
    return O.first_rows(V.bars(spark, d).select("date", "ticker", "open", "high", "low", "close", "volume"), ["date", "ticker"])


def ts_sample(spark, d):
    """A reproducible random row, as ORDER BY RANDOM() LIMIT 1."""
    return O.sample_n(V.bars(spark, d), 1, ["ticker", "date"], seed=7)


# ---- models ---------------------------------------------------------------------------------------


def _prepared(spark, d):
    returns = cut_lineage(_returns(spark, d).select("ticker", "date", "close", "log_return"), "returns")
    return returns, G.prepare(returns)


def _fixed_garch(series):
    return series.stats.select(
        "ticker", F.col("mean").alias("mu"), (F.col("var") * (1 - ALPHA - BETA)).alias("omega"),
        F.lit(ALPHA).alias("alpha"), F.lit(BETA).alias("beta"),
    )


def _fixed_egarch(series):
    return series.stats.select(
        "ticker", F.col("mean").alias("mu"), (F.log("var") * (1 - E_BETA)).alias("omega"),
        F.lit(E_ALPHA).alias("alpha"), F.lit(GAMMA).alias("gamma"), F.lit(E_BETA).alias("beta"),
    )


def ts_garch_filter(spark, d):
    _, series = _prepared(spark, d)
    return V.rounded(G.conditional_volatility(series, _fixed_garch(series), G.GARCH, "garch_vol"), 8)


def ts_egarch_filter(spark, d):
    _, series = _prepared(spark, d)
    return V.rounded(G.conditional_volatility(series, _fixed_egarch(series), G.EGARCH, "egarch_vol"), 8)


def _fixed_study(spark, d):
    """Labelled daily rows and parameters of the whole analysis with the fixed models."""
    returns, series = _prepared(spark, d)
    garch, egarch = _fixed_garch(series), _fixed_egarch(series)
    labelled = P.with_regime(P.align(returns, G.volatilities(series, garch, egarch)), "garch_vol")
    params = garch.select("ticker", F.col("alpha").alias("garch_alpha"), F.col("beta").alias("garch_beta")).join(
        egarch.select("ticker", F.col("gamma").alias("egarch_gamma")), "ticker", "left"
    )
    return labelled, params


def ts_result_rows(spark, d):
    """The 20-column result row per ticker."""
    return V.rounded(P.result_rows(*_fixed_study(spark, d)), 8)


def ts_pattern_counts(spark, d):
    return P.pattern_counts(P.result_rows(*_fixed_study(spark, d)))


def ts_extremes(spark, d):
    return V.rounded(P.extremes(P.result_rows(*_fixed_study(spark, d))), 8)


def ts_summary_table(spark, d):
    return P.summary_table(P.result_rows(*_fixed_study(spark, d)))


def ts_daily_export(spark, d):
    """The exported daily series with rolling dispersion and regime."""
    labelled, _ = _fixed_study(spark, d)
    return V.rounded(P.daily_rows(P.rolling(labelled, "garch_vol", "garch")), 8)


def ts_egarch_dispersion(spark, d):
    """Rolling mean, deviation and dispersion of the EGARCH volatility."""
    labelled, _ = _fixed_study(spark, d)
    out = P.rolling(labelled, "egarch_vol", "egarch")
    return V.rounded(out.select("ticker", "date", "egarch_ma", "egarch_std", "egarch_dispersion"), 8)


def ts_export_results(spark, d):
    """The result rows written as CSV and read back."""
    results, path = ts_result_rows(spark, d), scratch_path(spark, "results-csv")
    export_results(results, path)
    return spark.read.schema(results.schema).option("header", True).csv(path)


def ts_export_daily(spark, d):
    """The daily series written as CSV, a folder per ticker, and read back."""
    labelled, _ = _fixed_study(spark, d)
    series, path = P.rolling(labelled, "garch_vol", "garch"), scratch_path(spark, "daily-csv")
    export_daily(series, path)
    back = spark.read.schema(P.daily_rows(series).schema).option("header", True).csv(path)
    return V.rounded(back, 8)


def _grid(spark, d, model):
    """Log-likelihood of every point of the model's coarse grid for every ticker."""
    _, series = _prepared(spark, d)
    return V.rounded(G.grid_loglik(series, model), GRID_DIGITS, "loglik")


def ts_garch_grid(spark, d):
    return _grid(spark, d, G.GARCH)


def ts_egarch_grid(spark, d):
    return _grid(spark, d, G.EGARCH)


def _against_grid(fits, series, model):
    """What each fit says, and the best grid point it must not fall behind."""
    grid = G.grid_loglik(series, model).groupBy("ticker").agg(F.max_by("point", "loglik").alias("point"), F.max("loglik").alias("grid_loglik"))
    gain = F.col("loglik") - F.col("grid_loglik")
    out = fits.join(grid, "ticker", "left").select("ticker", "n", "dist", "status", "point", "grid_loglik", (gain >= -1e-9).alias("no_worse"))
    return V.rounded(out, GRID_DIGITS, "grid_loglik")


def ts_garch_fit(spark, d):
    _, series = _prepared(spark, d)
    return _against_grid(G.fit_garch(series), series, G.GARCH)


def ts_egarch_fit(spark, d):
    """EGARCH with the chain of densities; the later ones run only for tickers the first could not fit."""
    _, series = _prepared(spark, d)
    return _against_grid(G.fit_egarch(series, G.DISTRIBUTIONS), series, G.EGARCH)


def ts_garch_report(spark, d):
    """Parameters of every ticker's fit with robust errors and intervals; checked by differences in the tests."""
    return G.fit_report(_prepared(spark, d)[1], G.GARCH)


def ts_egarch_report(spark, d):
    return G.fit_report(_prepared(spark, d)[1], G.EGARCH)


def ts_volatility_study(spark, d):
    """The whole analysis of every ticker; of what the fitted parameters decide, that the columns agree with each other."""
    returns, series = _prepared(spark, d)
    rows = P.study(returns, series)
    persistence, gamma = F.col("GARCH_Persistence"), F.col("EGARCH_Gamma")
    return V.rounded(
        rows.select(
            "Ticker", "Start_Date", "End_Date", "Mean_Return", "Daily_Volatility", "Annualized_Vol", "Skewness", "Kurtosis", "Status",
            (F.col("High_Vol_Days") + F.col("Low_Vol_Days")).alias("Days"),
            F.col("High_Vol_Days"),
            ((persistence > 0) & (persistence < 1)).alias("stationary"),
            (F.col("Trading_Pattern") == R.pattern_label(F.col("High_Vol_Return"), F.col("Low_Vol_Return"))).alias("pattern_agrees"),
            (F.col("Leverage_Effect") == R.leverage_label(gamma)).alias("leverage_agrees"),
        ),
        8,
    )


# ---- oracles --------------------------------------------------------------------------------------

_R = f"WITH {V.RETURNS_SQL}"
_A = f"{_R}, av AS (SELECT *, abs(log_return) AS vol FROM ret)"
_REG = (
    f"{_A}, thr AS (SELECT ticker, quantile_cont(vol, 0.75) AS q FROM av GROUP BY 1), lab AS (SELECT av.*, CASE WHEN vol > q THEN 'High Vol'"
    " ELSE 'Low Vol' END AS vol_regime FROM av JOIN thr USING (ticker))"
)
_WIN = "(PARTITION BY ticker ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"
_PATTERN = (
    "CASE WHEN high_vol_return < low_vol_return THEN 'Buy when boring (sells off in high vol)'"
    " ELSE 'Buy when exciting (rallies in high vol)' END"
)
_DEV_SQL = f"""WITH RECURSIVE {V.RETURNS_SQL},
num AS (SELECT ticker, date, close, log_return, log_return * 100 AS r, row_number() OVER (PARTITION BY ticker ORDER BY date) AS i FROM ret),
st AS (SELECT ticker, avg(r) AS mean, var_samp(r) AS v FROM num GROUP BY 1),
bc AS (SELECT n.ticker, any_value(mean) AS mean, any_value(v) AS v, sum(pow(0.94, i - 1) * pow(r - mean, 2)) / sum(pow(0.94, i - 1)) AS b
  FROM num n JOIN st USING (ticker) WHERE i <= 75 GROUP BY 1),
dev AS MATERIALIZED (SELECT n.ticker, n.date, n.i, n.r - b.mean AS e, b.v, b.b FROM num n JOIN bc b USING (ticker))"""
_MODEL_SQL = f"""{_DEV_SQL},
path AS (
  SELECT ticker, date, i, e, v, v * {1 - ALPHA - BETA} + ({ALPHA} + {BETA}) * b AS s, ln(v) * (1 - {E_BETA}) + {E_BETA} * ln(b) AS l FROM dev WHERE i = 1
  UNION ALL
  SELECT d.ticker, d.date, d.i, d.e, d.v, d.v * {1 - ALPHA - BETA} + {ALPHA} * p.e * p.e + {BETA} * p.s,
    ln(d.v) * (1 - {E_BETA}) + {E_ALPHA} * (abs(p.e / exp(p.l / 2)) - sqrt(2 / pi())) + ({GAMMA}) * p.e / exp(p.l / 2) + {E_BETA} * p.l
  FROM path p JOIN dev d ON d.ticker = p.ticker AND d.i = p.i + 1),
vols AS (SELECT ticker, date, sqrt(s) / 100 AS garch_vol, exp(l / 2) / 100 AS egarch_vol FROM path),
day AS (SELECT n.ticker, n.date, close, log_return, garch_vol, egarch_vol FROM num n JOIN vols w ON n.ticker = w.ticker AND n.date = w.date),
thr AS (SELECT ticker, quantile_cont(garch_vol, 0.75) AS q FROM day GROUP BY 1),
lab AS (SELECT day.*, CASE WHEN garch_vol > q THEN 'High Vol' ELSE 'Low Vol' END AS vol_regime FROM day JOIN thr USING (ticker)),
res AS (
  SELECT ticker, min(date) AS first_date, max(date) AS last_date, avg(log_return) AS mean_return, stddev_samp(log_return) AS sd,
    skewness(log_return) AS sk, kurtosis(log_return) AS ku,
    coalesce(avg(log_return) FILTER (WHERE vol_regime = 'High Vol'), 0) AS high_vol_return,
    coalesce(avg(log_return) FILTER (WHERE vol_regime = 'Low Vol'), 0) AS low_vol_return,
    count(*) FILTER (WHERE vol_regime = 'High Vol') AS hd, count(*) FILTER (WHERE vol_regime = 'Low Vol') AS ld,
    stddev_samp(garch_vol) / avg(garch_vol) AS gd, stddev_samp(egarch_vol) / avg(egarch_vol) AS ed
  FROM lab GROUP BY 1),
pat AS (SELECT *, {_PATTERN} AS pattern FROM res)"""



def _grid_sql(model) -> str:
    """CTEs up to ``grid`` (ticker, point, ll): the recursion of every grid point, one day after the other."""
    points = ", ".join(f"({k}, {', '.join(f'CAST({x!r} AS DOUBLE)' for x in point)})" for k, point in enumerate(G.grid_points(model).tolist()))
    if model is G.GARCH:
        theta = """pts AS (SELECT *, pow(sin(c1), 2) AS p, pow(sin(c2), 2) AS share FROM (VALUES {points}) AS t(point, c0, c1, c2, c3)),
th AS (SELECT ticker, point, v * exp(c3) * (1 - p) AS omega, p * share AS alpha, p * (1 - share) AS beta, b FROM bc, pts),
path AS (
  SELECT d.ticker, d.i, d.e, point, omega, alpha, beta, omega + (alpha + beta) * t.b AS s, CAST(0 AS DOUBLE) AS before
  FROM dev d JOIN th t ON d.ticker = t.ticker WHERE d.i = 1
  UNION ALL
  SELECT d.ticker, d.i, d.e, point, omega, alpha, beta, omega + alpha * p.e * p.e + beta * p.s, before + ln(p.s) + p.e * p.e / p.s
  FROM path p JOIN dev d ON d.ticker = p.ticker AND d.i = p.i + 1),
ends AS (SELECT *, before + ln(s) + e * e / s AS total, row_number() OVER (PARTITION BY ticker, point ORDER BY i DESC) AS rn FROM path),"""
    else:
        theta = """pts AS (SELECT *, sin(c1) AS beta, c2 AS alpha, c3 AS gamma FROM (VALUES {points}) AS t(point, c0, c1, c2, c3, c4)),
th AS (SELECT ticker, point, (1 - beta) * (ln(v) + c4) AS omega, alpha, gamma, beta, b FROM bc, pts),
path AS (
  SELECT d.ticker, d.i, d.e, point, omega, alpha, gamma, beta, omega + beta * ln(t.b) AS l, CAST(0 AS DOUBLE) AS before
  FROM dev d JOIN th t ON d.ticker = t.ticker WHERE d.i = 1
  UNION ALL
  SELECT d.ticker, d.i, d.e, point, omega, alpha, gamma, beta, omega + alpha * (abs(p.e / exp(p.l / 2)) - sqrt(2 / pi()))
    + gamma * p.e / exp(p.l / 2) + beta * p.l, before + p.l + p.e * p.e / exp(p.l)
  FROM path p JOIN dev d ON d.ticker = p.ticker AND d.i = p.i + 1),
ends AS (SELECT *, before + l + e * e / exp(l) AS total, row_number() OVER (PARTITION BY ticker, point ORDER BY i DESC) AS rn FROM path),"""
    return f"{_DEV_SQL},\n{theta.format(points=points)}\ngrid AS (SELECT ticker, point, -0.5 * (i * ln(2 * pi()) + total) AS ll, i AS n FROM ends WHERE rn = 1)"


def _grid_query(model) -> str:
    return f"{_grid_sql(model)} SELECT ticker, CAST(point AS INTEGER) AS point, round(ll, {GRID_DIGITS}) AS loglik FROM grid"


def _fit_query(model) -> str:
    return (
        f"{_grid_sql(model)} SELECT ticker, max(n) AS n, 'normal' AS dist, 'ok' AS status, CAST(arg_max(point, ll) AS INTEGER) AS point,"
        f" round(max(ll), {GRID_DIGITS}) AS grid_loglik, true AS no_worse FROM grid GROUP BY 1"
    )


QUERIES = {
    "ts_scan": (
        ts_scan,
        f"WITH {V.BARS_SQL} SELECT ticker, CAST(date AS VARCHAR) AS date, open, high, low, close, volume FROM bars"
        f" WHERE ticker IN ('1-URGENT', '2-HIGH') AND date >= DATE '{START}' AND date < DATE '{END}'",
    ),
    "ts_returns": (
        ts_returns,
        f"{_R} SELECT ticker, CAST(date AS VARCHAR) AS date, open, high, low, close, volume, round(log_return, 9) AS log_return,"
        " round(ln(high / low), 9) AS hl_range, round(pow(ln(high / low), 2) / (4 * ln(2)), 9) AS parkinson,"
        " round(sqrt(pow(ln(high / low), 2) / (4 * ln(2))), 9) AS parkinson_vol FROM ret",
    ),
    "ts_moments": (
        ts_moments,
        f"{_R} SELECT ticker, count(*) AS n_rows, CAST(min(date) AS VARCHAR) AS first_date, CAST(max(date) AS VARCHAR) AS last_date,"
        " round(avg(log_return), 6) AS mean_return, round(stddev_samp(log_return), 6) AS std_return,"
        " round(stddev_samp(log_return) * sqrt(252), 6) AS annualised_vol, round(skewness(log_return), 6) AS skewness,"
        " round(kurtosis(log_return), 6) AS kurtosis, round(min(log_return), 6) AS min_return, round(max(log_return), 6) AS max_return"
        " FROM ret GROUP BY 1",
    ),
    "ts_extent": (
        ts_extent,
        f"WITH {V.BARS_SQL} SELECT ticker, count(*) AS n_rows, CAST(min(date) AS VARCHAR) AS first_date, CAST(max(date) AS VARCHAR) AS last_date"
        " FROM bars GROUP BY 1",
    ),
    "ts_rolling": (
        ts_rolling,
        f"{_A}, w AS (SELECT ticker, date, count(*) OVER {_WIN} AS n, avg(vol) OVER {_WIN} AS m, stddev_samp(vol) OVER {_WIN} AS s,"
        f" skewness(vol) OVER {_WIN} * 18 / sqrt(20.0 * 19.0) AS k FROM av),"
        " g AS (SELECT ticker, date, CASE WHEN n = 20 THEN m END AS m, CASE WHEN n = 20 THEN s END AS s, CASE WHEN n = 20 THEN k END AS k FROM w)"
        " SELECT ticker, CAST(date AS VARCHAR) AS date, round(m, 6) AS vol_ma, round(s, 6) AS vol_std, round(k, 6) AS vol_skew,"
        " round(s / m, 6) AS vol_dispersion, round(m + s, 6) AS vol_upper, round(m - s, 6) AS vol_lower FROM g",
    ),
    "ts_quantile": (ts_quantile, f"{_A} SELECT ticker, round(quantile_cont(vol, 0.75), 9) AS quantile FROM av GROUP BY 1"),
    "ts_regimes": (
        ts_regimes,
        f"{_REG} SELECT ticker, vol_regime, round(avg(log_return), 6) AS mean_return, round(stddev_samp(log_return), 6) AS std_return,"
        " count(*) AS n_rows FROM lab GROUP BY 1, 2",
    ),
    "ts_regime_labels": (ts_regime_labels, f"{_REG} SELECT ticker, CAST(date AS VARCHAR) AS date, vol_regime FROM lab"),
    "ts_regime_summary": (
        ts_regime_summary,
        f"{_REG}, s AS (SELECT ticker, avg(log_return) FILTER (WHERE vol_regime = 'High Vol') AS high_vol_return,"
        " avg(log_return) FILTER (WHERE vol_regime = 'Low Vol') AS low_vol_return, count(*) FILTER (WHERE vol_regime = 'High Vol') AS high_vol_days,"
        " count(*) FILTER (WHERE vol_regime = 'Low Vol') AS low_vol_days FROM lab GROUP BY 1)"
        " SELECT ticker, round(high_vol_return, 9) AS high_vol_return, round(low_vol_return, 9) AS low_vol_return, high_vol_days, low_vol_days,"
        f" {_PATTERN} AS trading_pattern FROM s",
    ),
    "ts_dispersion": (
        ts_dispersion,
        f"{_A} SELECT ticker, round(avg(vol), 6) AS vol_mean, round(max(vol), 6) AS vol_max, round(min(vol), 6) AS vol_min,"
        " round(stddev_samp(vol), 6) AS vol_std, round(stddev_samp(vol) / avg(vol), 6) AS dispersion FROM av GROUP BY 1",
    ),
    "ts_histogram": (
        ts_histogram,
        f"{_A}, x AS (SELECT ticker, min(vol) AS lo, max(vol) AS hi, count(*) AS total FROM av GROUP BY 1)"
        f" SELECT ticker, CAST(least(greatest(floor((vol - lo) / (hi - lo) * {HIST_BINS}.0), 0), {HIST_BINS - 1}) AS INTEGER) AS bin,"
        f" round(any_value(lo) + least(greatest(floor((vol - lo) / (hi - lo) * {HIST_BINS}.0), 0), {HIST_BINS - 1}) * any_value((hi - lo) / {HIST_BINS}), 6) AS bin_start,"
        f" count(*) AS n, round(count(*) / (any_value(total) * any_value((hi - lo) / {HIST_BINS})), 6) AS density"
        " FROM av JOIN x USING (ticker) GROUP BY ticker, least(greatest(floor((vol - lo) / (hi - lo)"
        f" * {HIST_BINS}.0), 0), {HIST_BINS - 1})",
    ),
    "ts_scatter": (
        ts_scatter,
        f"{_A} SELECT ticker, CAST(date AS VARCHAR) AS date, round(volume / 1e6, 9) AS volume_millions, round(vol * 100, 9) AS vol_percent,"
        " round(log_return, 9) AS log_return FROM av",
    ),
    "ts_head": (
        ts_head,
        f"WITH {V.BARS_SQL} SELECT ticker, CAST(date AS VARCHAR) AS date, open, high, low, close, volume FROM (SELECT *,"
        " row_number() OVER (PARTITION BY ticker ORDER BY date) AS rn FROM bars) WHERE rn <= 5",
    ),
    "ts_first_rows": (
        ts_first_rows,
        f"WITH {V.BARS_SQL} SELECT CAST(date AS VARCHAR) AS date, ticker, open, high, low, close, volume FROM bars ORDER BY bars.date, ticker LIMIT 5",
    ),
    "ts_sample": (
        ts_sample,
        f"WITH {V.BARS_SQL} SELECT ticker, CAST(date AS VARCHAR) AS date, open, high, low, close, volume FROM bars"
        " ORDER BY md5('7|' || ticker || '|' || CAST(bars.date AS VARCHAR)), ticker, bars.date LIMIT 1",
    ),
    "ts_garch_filter": (
        ts_garch_filter, f"{_MODEL_SQL} SELECT ticker, CAST(date AS VARCHAR) AS date, round(garch_vol, 8) AS garch_vol FROM vols",
    ),
    "ts_egarch_filter": (
        ts_egarch_filter, f"{_MODEL_SQL} SELECT ticker, CAST(date AS VARCHAR) AS date, round(egarch_vol, 8) AS egarch_vol FROM vols",
    ),
    "ts_result_rows": (
        ts_result_rows,
        f"{_MODEL_SQL} SELECT ticker AS Ticker, CAST(first_date AS VARCHAR) AS Start_Date, CAST(last_date AS VARCHAR) AS End_Date,"
        " round(mean_return, 8) AS Mean_Return, round(sd, 8) AS Daily_Volatility, round(sd * sqrt(252), 8) AS Annualized_Vol,"
        " round(sk, 8) AS Skewness, round(ku, 8) AS Kurtosis, round(high_vol_return, 8) AS High_Vol_Return,"
        " round(low_vol_return, 8) AS Low_Vol_Return, hd AS High_Vol_Days, ld AS Low_Vol_Days, pattern AS Trading_Pattern,"
        f" round(gd, 8) AS GARCH_Dispersion, round(ed, 8) AS EGARCH_Dispersion, CAST({ALPHA} AS DOUBLE) AS GARCH_Alpha,"
        f" CAST({BETA} AS DOUBLE) AS GARCH_Beta, round(CAST({ALPHA} AS DOUBLE) + CAST({BETA} AS DOUBLE), 8) AS GARCH_Persistence,"
        f" CAST({GAMMA} AS DOUBLE) AS EGARCH_Gamma, 'Yes' AS Leverage_Effect FROM pat",
    ),
    "ts_pattern_counts": (
        ts_pattern_counts,
        f"{_MODEL_SQL} SELECT count(*) FILTER (WHERE pattern LIKE '%Buy when boring%') AS n_boring,"
        " count(*) FILTER (WHERE pattern LIKE '%Buy when exciting%') AS n_exciting FROM pat",
    ),
    "ts_extremes": (
        ts_extremes,
        f"{_MODEL_SQL} SELECT arg_max(ticker, sd) AS highest_ticker, round(max(sd), 8) AS highest_vol, arg_min(ticker, sd) AS lowest_ticker,"
        " round(min(sd), 8) AS lowest_vol FROM pat",
    ),
    "ts_summary_table": (
        ts_summary_table,
        f"{_MODEL_SQL} SELECT ticker AS Ticker, printf('%.2f%%', sd * 100) AS Volatility, printf('%.3f%%', high_vol_return * 100) AS High_Vol_Return,"
        " printf('%.3f%%', low_vol_return * 100) AS Low_Vol_Return, substr(pattern, 1, 28) AS Pattern, printf('%.3f', gd) AS Dispersion FROM pat",
    ),
    "ts_daily_export": (
        ts_daily_export,
        f"{_MODEL_SQL}, w AS (SELECT *, count(*) OVER {_WIN} AS n, stddev_samp(garch_vol) OVER {_WIN} / avg(garch_vol) OVER {_WIN} AS disp FROM lab)"
        " SELECT ticker, CAST(date AS VARCHAR) AS Date, close AS Close, round(log_return, 8) AS Log_Returns, round(garch_vol, 8) AS GARCH_Volatility,"
        " round(egarch_vol, 8) AS EGARCH_Volatility, round(CASE WHEN n = 20 THEN disp END, 8) AS GARCH_Vol_Dispersion, vol_regime AS Vol_Regime FROM w",
    ),
    "ts_egarch_dispersion": (
        ts_egarch_dispersion,
        f"{_MODEL_SQL}, w AS (SELECT ticker, date, count(*) OVER {_WIN} AS n, stddev_samp(egarch_vol) OVER {_WIN} AS s, avg(egarch_vol) OVER {_WIN} AS m FROM day)"
        " SELECT ticker, CAST(date AS VARCHAR) AS date, round(CASE WHEN n = 20 THEN m END, 8) AS egarch_ma,"
        " round(CASE WHEN n = 20 THEN s END, 8) AS egarch_std, round(CASE WHEN n = 20 THEN s / m END, 8) AS egarch_dispersion FROM w",
    ),
    "ts_garch_grid": (ts_garch_grid, _grid_query(G.GARCH)),
    "ts_egarch_grid": (ts_egarch_grid, _grid_query(G.EGARCH)),
    "ts_garch_fit": (ts_garch_fit, _fit_query(G.GARCH)),
    # A maximiser has no SQL form.
    "ts_garch_report": (ts_garch_report, None),
    "ts_egarch_report": (ts_egarch_report, None),
    "ts_egarch_fit": (ts_egarch_fit, _fit_query(G.EGARCH)),
    "ts_volatility_study": (
        ts_volatility_study,
        f"{_R} SELECT ticker AS Ticker, CAST(min(date) AS VARCHAR) AS Start_Date, CAST(max(date) AS VARCHAR) AS End_Date,"
        " round(avg(log_return), 8) AS Mean_Return, round(stddev_samp(log_return), 8) AS Daily_Volatility,"
        " round(stddev_samp(log_return) * sqrt(252), 8) AS Annualized_Vol, round(skewness(log_return), 8) AS Skewness,"
        " round(kurtosis(log_return), 8) AS Kurtosis, 'ok' AS Status, count(*) AS Days,"
        # Days strictly above an interpolated upper quartile, when no two days have the same volatility.
        " (count(*) - 1) // 4 + CASE WHEN (count(*) - 1) % 4 > 0 THEN 1 ELSE 0 END AS High_Vol_Days,"
        " true AS stationary, true AS pattern_agrees, true AS leverage_agrees FROM ret GROUP BY 1",
    ),
}
QUERIES["ts_export_results"] = (ts_export_results, QUERIES["ts_result_rows"][1])
QUERIES["ts_export_daily"] = (ts_export_daily, QUERIES["ts_daily_export"][1])
