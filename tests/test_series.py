import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions import returns as R
from tidemark.operators import distribution as D, ordering as O
from tidemark.plans import volatility as P
from tidemark.sources.tables import flatten_columns, scan_bars


@pytest.fixture(scope="module")
def frame():
    """Two tickers with gaps of many blocks, one of them with hardly any rows."""
    rng = np.random.default_rng(1)
    out = []
    for ticker, n in (("A", 300), ("B", 4)):
        day = dt.date(2020, 1, 1)
        for i in range(n):
            day += dt.timedelta(days=int(rng.choice([1, 1, 1, 3, 40])))
            low, high = sorted(rng.uniform(50, 60, 2))
            out.append((ticker, day, low, high, low, float(rng.uniform(low, high)), i))
    return pd.DataFrame(out, columns=["ticker", "date", "open", "high", "low", "close", "volume"])


@pytest.fixture(scope="module")
def bars(spark, frame):
    return spark.createDataFrame(frame, "ticker string, date date, open double, high double, low double, close double, volume bigint")


def expected_returns(frame):
    out = frame.copy()
    out["log_return"] = np.log(out.close / out.groupby("ticker").close.shift(1))
    return out.dropna().reset_index(drop=True)


def collected(df):
    return df.toPandas().sort_values(["ticker", "date"]).reset_index(drop=True)


@pytest.mark.parametrize("days", [2, 7, 64, 4096])
def test_returns_cross_block_borders(bars, frame, days):
    got, want = collected(P.log_returns(bars, days)), expected_returns(frame)
    assert len(got) == len(want)
    np.testing.assert_allclose(got.log_return, want.log_return, rtol=1e-12)


@pytest.mark.parametrize("days", [3, 30, 4096])
def test_rolling_matches_pandas(bars, frame, days):
    got = collected(P.rolling(P.log_returns(bars, days), "log_return", "r", block_days=days))
    want = expected_returns(frame)
    roll = want.groupby("ticker").log_return.rolling(20)
    np.testing.assert_allclose(got.r_ma.astype(float), roll.mean().values, rtol=1e-9, equal_nan=True)
    np.testing.assert_allclose(got.r_std.astype(float), roll.std().values, rtol=1e-9, equal_nan=True)
    biased = roll.apply(lambda x: ((x - x.mean()) ** 3).mean() / ((x - x.mean()) ** 2).mean() ** 1.5, raw=True)
    np.testing.assert_allclose(got.r_skew.astype(float), biased.values, rtol=1e-6, equal_nan=True)
    np.testing.assert_allclose(got.r_upper - got.r_lower, 2 * got.r_std, rtol=1e-9)
    assert got[got.ticker == "B"].r_ma.isna().all()


@pytest.mark.parametrize("days", [0.25 / 24, 0.5, 30])
def test_intraday_blocks(spark, days):
    rng = np.random.default_rng(4)
    stamps = pd.Timestamp("2024-01-01") + pd.to_timedelta(np.cumsum(rng.integers(1, 4000, 200)), unit="s")
    pdf = pd.DataFrame({"ticker": "A", "date": stamps, "v": rng.normal(size=200)})
    df = spark.createDataFrame(pdf).withColumn("date", F.col("date").cast("timestamp"))
    got = collected(P.rolling(df, "v", "r", rows=5, block_days=days))
    np.testing.assert_allclose(got.r_ma.astype(float), pdf.v.rolling(5).mean().values, rtol=1e-9, equal_nan=True)


def test_null_close_is_dropped_before_rolling(spark, bars):
    holes = bars.withColumn("close", F.when(F.col("volume") != 50, F.col("close")))
    got = P.log_returns(holes, 16)
    assert got.filter("ticker = 'A'").count() == 297 and got.filter("log_return IS NULL").count() == 0


def test_moments_match_pandas(bars, frame):
    got = P.moments(P.log_returns(bars)).toPandas().set_index("ticker").loc["A"]
    r = expected_returns(frame).query("ticker == 'A'").log_return
    for name, value in {"mean_return": r.mean(), "std_return": r.std(), "skewness": r.skew(), "kurtosis": r.kurtosis()}.items():
        assert got[name] == pytest.approx(value, rel=1e-9), name
    assert got.annualised_vol == pytest.approx(r.std() * np.sqrt(252))
    small = P.moments(P.log_returns(bars)).filter("ticker = 'B'").first()
    assert small.n_rows == 3 and small.skewness is not None and small.kurtosis is None


VALUES = {
    "normal": np.random.default_rng(2).normal(size=501),
    "ties": np.repeat([1.0, 2.0, 2.0, 7.0], 25),
    "one": np.array([3.0]),
    "two": np.array([3.0, 8.0]),
    "constant": np.full(40, 2.5),
    "heavy": np.exp(np.random.default_rng(3).normal(size=400) * 20),
    "border": np.arange(101.0),
}


@pytest.mark.parametrize("q", [0.0, 0.25, 0.75, 0.999, 1.0])
@pytest.mark.parametrize("bins,last_rows", [(4, 1000), (4, 50), (4, 1), (1 << 16, 100)])
def test_exact_quantile(spark, q, bins, last_rows):
    data = [(k, float(v)) for k, values in VALUES.items() for v in values] + [("normal", None), ("ties", float("nan"))]
    df = spark.createDataFrame(data, "k string, v double")
    got = {r.k: r.quantile for r in D.exact_quantile(df, ["k"], "v", q, bins=bins, last_rows=last_rows).collect()}
    for name, values in VALUES.items():
        assert got[name] == pytest.approx(np.quantile(values, q), rel=1e-12), name
    assert set(got) == set(VALUES)


def test_histogram_matches_numpy(spark):
    values = VALUES["normal"]
    df = spark.createDataFrame([("a", float(v)) for v in values] + [("c", 1.0)] * 3, "k string, v double")
    got = {(r.k, r.bin): r for r in D.density_histogram(df, ["k"], "v", 50).collect()}
    counts, _ = np.histogram(values, bins=50)
    density, _ = np.histogram(values, bins=50, density=True)
    for i in range(50):
        assert (got[("a", i)].n if ("a", i) in got else 0) == counts[i]
        if counts[i]:
            assert got[("a", i)].density == pytest.approx(density[i])
    assert got[("c", 0)].n == 3 and got[("c", 0)].density is None


def test_regimes_and_labels(spark):
    df = spark.createDataFrame(
        [("A", dt.date(2024, 1, i + 1), float(i), 0.01 * i) for i in range(8)] + [("A", dt.date(2024, 2, 1), float("nan"), 0.0)],
        "ticker string, date date, vol double, log_return double",
    )
    clean = df.filter(~F.isnan("vol"))
    labelled = P.with_regime(clean, "vol")
    assert labelled.filter("vol_regime = 'High Vol'").count() == 2
    assert df.select(R.regime_label(F.col("vol"), F.lit(3.0)).alias("l")).filter("l = 'High Vol'").count() == 4, "NaN is low"
    summary = P.regime_summary(labelled).first()
    assert (summary.high_vol_days, summary.low_vol_days) == (2, 6) and summary.trading_pattern == R.EXCITING
    none_high = labelled.withColumn("vol_regime", F.lit("Low Vol"))
    assert P.regime_summary(none_high).first().high_vol_return == 0.0
    labels = spark.sql("SELECT -0.1D AS g UNION ALL SELECT 0.1D UNION ALL SELECT NULL").select(R.leverage_label(F.col("g")).alias("l"))
    assert sorted(r.l for r in labels.collect()) == ["No/Unknown", "No/Unknown", "Yes"]


def test_empty_series_has_no_dispersion(spark):
    assert spark.createDataFrame([], "v double").agg(R.dispersion(F.col("v")).alias("d")).first().d == 0.0


def test_scan_and_columns(spark, bars):
    days = [r.date for r in bars.filter("ticker = 'A'").orderBy("date").collect()]
    picked = scan_bars(bars, ["A"], days[3], days[6]).orderBy("date").collect()
    assert [r.date for r in picked] == days[3:6]
    assert scan_bars(bars, ["NONE"]).count() == 0
    two_level = spark.createDataFrame([(1.0, 2.0)], ["Close.A", "Open.A"])
    assert flatten_columns(two_level).columns == ["Close", "Open"]


def test_sample_is_reproducible(spark, bars):
    picks = {seed: O.sample_n(bars, 3, ["ticker", "date"], seed).collect() for seed in (1, 2)}
    again = O.sample_n(bars.repartition(3), 3, ["ticker", "date"], 1).collect()
    assert picks[1] == again and picks[1] != picks[2]


def test_time_partitions_prune(spark, bars, tmp_path):
    part = O.write_time_partitioned(bars, str(tmp_path / "bars"), "date", ["ticker"], "year")
    one = spark.read.parquet(str(tmp_path / "bars")).filter(F.col(part) == "2021")
    assert one.count() == bars.filter("year(date) = 2021").count()
    assert "PartitionFilters: [isnotnull(date_year" in one._jdf.queryExecution().toString()


@pytest.mark.parametrize("n", [3, 1500])
def test_latest_per_group_with_a_hot_group(spark, n):
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, F.col("id") % 7).otherwise(99).alias("g"), "id")
    got = O.latest_per_group(df, ["g"], [F.desc("id")], n).toPandas()
    want = df.toPandas().sort_values("id", ascending=False).groupby("g").head(n)
    assert sorted(got.id) == sorted(want.id)


def test_per_key_values_salted_and_broadcast_agree(spark):
    from tidemark.operators.blocks import attach_stats

    rows = spark.range(500).select((F.col("id") % 3).alias("k"), "id")
    stats = rows.groupBy("k").agg(F.max("id").alias("top"))
    sides = [attach_stats(rows, stats, ["k"], ["id"], broadcast_rows=limit) for limit in (0, 10)]
    a, b = (sorted(map(tuple, df.select("k", "id", "top").collect())) for df in sides)
    assert a == b and len(a) == 500
    assert "BroadcastExchange" in sides[1]._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in sides[0]._jdf.queryExecution().executedPlan().toString()


def test_far_outlier_costs_a_level_not_a_gather(spark, monkeypatch):
    """A million distinct values and one at 1e12: the last count is of a bounded band."""
    df = spark.range(1_000_000).select(F.lit("k").alias("k"), (F.col("id") * 0.5).alias("v"))
    df = df.unionByName(spark.createDataFrame([("k", 1e12)], "k string, v double"))
    bands, real = [], D._narrow

    def watched(rows, band, keys, bin_):
        bands.append(band.first()["_left"])
        return real(rows, band, keys, bin_)

    monkeypatch.setattr(D, "_narrow", watched)
    got = D.exact_quantile(df, ["k"], "v", 0.75).first().quantile
    assert got == 375000.0 and bands[-1] <= D.LAST_ROWS and len(bands) <= 4


def test_nan_is_no_value(spark):
    df = spark.createDataFrame([("k", x) for x in (1.0, 2.0, 3.0, 4.0, float("nan"))], "k string, v double")
    assert D.exact_quantile(df, ["k"], "v", 0.75).first().quantile == 3.25
    assert D.density_histogram(df, ["k"], "v", 2).agg(F.sum("n")).first()[0] == 4


def test_a_ticker_without_volatility_keeps_its_rows(spark):
    rows_ = [("A", i, float(i)) for i in range(8)] + [("B", i, None) for i in range(5)]
    df = spark.createDataFrame(rows_, "ticker string, date int, vol double")
    got = P.with_regime(df, "vol").groupBy("ticker", "vol_regime").count().collect()
    assert {(r.ticker, r.vol_regime): r["count"] for r in got} == {("A", "High Vol"): 2, ("A", "Low Vol"): 6, ("B", "Low Vol"): 5}


def test_default_blocks_hold_on_second_bars(spark, monkeypatch):
    """100,000 second bars of one ticker, a burst of them in one place: no block holds more than its rows."""
    from tidemark.operators import blocks as B
    from tidemark.plans import garch as G

    monkeypatch.setattr(B, "MAX_BLOCK_ROWS", 2000)
    df = spark.range(100_000).select(
        F.lit("A").alias("ticker"), F.timestamp_micros(F.when(F.col("id") < 90_000, F.col("id") * 1000).otherwise(F.col("id") * 1_000_000)).alias("date"),
        (100 + F.sin("id")).alias("close"),
    )
    rows_ = B.with_halo(df, ["ticker"], "date", 19)
    sizes = rows_.filter(~F.col(B.HALO)).groupBy(B.BLOCK).count().agg(F.max("count"), F.sum("count")).first()
    assert sizes[0] <= 2000 and sizes[1] == 100_000
    assert P.log_returns(df).count() == 99_999
    series = G.prepare(df.select("ticker", "date", F.sin("close").alias("log_return")))
    assert series.blocks.agg(F.max(F.size("r"))).first()[0] <= 2000 and series.max_blocks > 50


def test_the_summary_prints_every_ticker(spark, capfd):
    from tidemark.streaming.sinks import print_summary

    results = spark.range(130).select(
        F.format_string("T%03d", "id").alias("Ticker"), *[F.lit(0.01).alias(c) for c in ("Daily_Volatility", "High_Vol_Return", "Low_Vol_Return", "GARCH_Dispersion")],
        F.lit("Buy when boring").alias("Trading_Pattern"),
    )
    print_summary(results)
    lines = [x for x in capfd.readouterr().out.splitlines() if '"Ticker"' in x]
    assert len(lines) == 130 and "T000" in lines[0] and "T129" in lines[-1]
