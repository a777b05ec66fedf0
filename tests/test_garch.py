import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import variance as V
from tidemark.plans import garch as G, volatility as P


def simulate(kind, n, theta, seed):
    rng, out = np.random.default_rng(seed), []
    if kind == "garch":
        mu, omega, alpha, beta = theta
        s = omega / (1 - alpha - beta)
        for _ in range(n):
            e = math.sqrt(s) * rng.standard_normal()
            out.append(mu + e)
            s = omega + alpha * e * e + beta * s
    else:
        mu, omega, alpha, gamma, beta = theta
        s = omega / (1 - beta)
        for _ in range(n):
            e = math.exp(s / 2) * rng.standard_normal()
            out.append(mu + e)
            z = e * math.exp(-s / 2)
            s = omega + alpha * (abs(z) - math.sqrt(2 / math.pi)) + gamma * z + beta * s
    return np.array(out)


SERIES = {
    "G": simulate("garch", 1200, (0.05, 0.05, 0.1, 0.85), 1),
    "E": simulate("egarch", 1200, (0.05, 0.02, 0.2, -0.12, 0.95), 2),
    "SHORT": np.array([1.0, -1.0, 0.5]),
    "FLAT": np.zeros(30),
}


@pytest.fixture(scope="module")
def returns(spark):
    start = dt.date(2015, 1, 1)
    data = [(k, start + dt.timedelta(days=i), float(x) / 100) for k, xs in SERIES.items() for i, x in enumerate(xs)]
    return spark.createDataFrame(data, "ticker string, date date, log_return double")


@pytest.fixture(scope="module")
def whole(returns):
    return G.prepare(returns)


@pytest.fixture(scope="module")
def fits(whole):
    return {r.ticker: r for r in G.fit_garch(whole).collect()}, {r.ticker: r for r in G.fit_egarch(whole).collect()}


def backcast(r):
    e2 = (r[:75] - r.mean()) ** 2
    w = 0.94 ** np.arange(len(e2))
    return (w * e2).sum() / w.sum()


def garch_ll(r, mu, omega, alpha, beta):
    s, ll = omega + (alpha + beta) * backcast(r), 0.0
    for x in r:
        e = x - mu
        ll -= 0.5 * (math.log(2 * math.pi * s) + e * e / s)
        s = omega + alpha * e * e + beta * s
    return ll


def test_garch_fit_is_a_maximum_near_the_truth(fits):
    f, r = fits[0]["G"], SERIES["G"]
    theta = np.array([f.mu, f.omega, f.alpha, f.beta])
    assert f.status == "ok" and f.loglik == pytest.approx(garch_ll(r, *theta), rel=1e-9)
    assert abs(f.alpha - 0.1) < 0.05 and abs(f.beta - 0.85) < 0.08 and f.persistence == pytest.approx(f.alpha + f.beta)
    for i in range(4):
        for step in (-0.02, 0.02):
            moved = theta.copy()
            moved[i] *= 1 + step
            assert garch_ll(r, *moved) < f.loglik + 1e-7
    assert f.aic == pytest.approx(8 - 2 * f.loglik) and f.bic == pytest.approx(4 * math.log(1200) - 2 * f.loglik)


def test_egarch_finds_the_leverage_effect(fits):
    e = fits[1]["E"]
    assert e.status == "ok" and -0.2 < e.gamma < -0.05 and abs(e.beta - 0.95) < 0.04
    assert e.loglik > fits[0]["E"].loglik


def test_bad_series_are_reported_not_raised(fits):
    for found in fits:
        assert found["SHORT"].status == "too_short" and found["FLAT"].status == "constant"
        assert found["SHORT"].alpha is None


def test_blocks_do_not_change_the_fit_or_the_path(returns, whole, fits):
    split = G.prepare(returns.filter("ticker = 'G' OR ticker = 'SHORT'"), 400)
    assert split.max_blocks > 2
    fit = {r.ticker: r for r in G.fit_garch(split).collect()}
    for p in ("mu", "omega", "alpha", "beta", "loglik"):
        assert fit["G"][p] == pytest.approx(fits[0]["G"][p], rel=2e-3)
    params = whole.stats.select(
        "ticker", F.lit(0.01).alias("mu"), F.lit(-0.05).alias("omega"), F.lit(0.2).alias("alpha"), F.lit(-0.1).alias("gamma"), F.lit(0.97).alias("beta")
    ).filter("ticker = 'G'")
    path = lambda s: np.array([r.vol for r in G.conditional_volatility(s, params, G.EGARCH).orderBy("date").collect()])
    np.testing.assert_allclose(path(split), path(whole), rtol=1e-9)


def test_path_matches_brute_force(whole):
    params = whole.stats.filter("ticker = 'G'").select(
        "ticker", F.lit(0.0).alias("mu"), F.lit(0.1).alias("omega"), F.lit(0.2).alias("alpha"), F.lit(0.7).alias("beta")
    )
    got = [r.vol for r in G.conditional_volatility(whole, params, G.GARCH).orderBy("date").collect()]
    r, s, want = SERIES["G"], 0.1 + 0.9 * backcast(SERIES["G"]), []
    for x in r:
        want.append(math.sqrt(s) / 100)
        s = 0.1 + 0.2 * x * x + 0.7 * s
    np.testing.assert_allclose(got, want, rtol=1e-12)


@pytest.mark.parametrize("dist,shape", [("normal", None), ("ged", 2.0), ("t", 1e7)])
def test_densities_agree_at_the_normal_limit(dist, shape):
    e2, var = np.array([[0.3], [2.0]]), np.array([[1.5], [0.7]])
    got = V.log_density(e2, var, dist, None if shape is None else np.array([shape]))[0]
    want = sum(-0.5 * (math.log(2 * math.pi * v) + e / v) for e, v in zip(e2[:, 0], var[:, 0]))
    assert got == pytest.approx(want, rel=1e-5)


@pytest.mark.parametrize("dist,shape", [("ged", 1.3), ("t", 5.0)])
def test_densities_have_unit_mass_and_variance(dist, shape):
    x = np.linspace(-60, 60, 400001)
    p = np.exp(V.log_density((x**2)[None, :], np.ones((1, len(x))), dist, np.full(len(x), shape)))
    dx = x[1] - x[0]
    assert p.sum() * dx == pytest.approx(1, abs=1e-4) and (p * x**2).sum() * dx == pytest.approx(1, abs=2e-2)


def test_fallback_chain_reaches_the_next_density(whole, monkeypatch):
    real = G._natural

    def failing_normal(found, model, dist):
        out = real(found, model, dist)
        return out.withColumn("best_ll", F.when((F.col("ticker") == "E") & F.lit(dist == "normal"), F.lit(-1e300)).otherwise(F.col("best_ll")))

    monkeypatch.setattr(G, "_natural", failing_normal)
    fit = {r.ticker: r for r in G.fit_egarch(whole, G.DISTRIBUTIONS).collect()}
    assert fit["G"].dist == "normal" and fit["G"].shape is None
    assert fit["E"].dist == "ged" and fit["E"].shape > 1
    alone = {r.ticker: r for r in G.fit_egarch(whole).collect()}
    assert alone["E"].status == "failed"


def test_missing_egarch_uses_the_garch_series(whole, fits, spark):
    garch = whole.stats.select("ticker", F.lit(0.0).alias("mu"), F.lit(0.1).alias("omega"), F.lit(0.1).alias("alpha"), F.lit(0.8).alias("beta"))
    none = garch.withColumns({"gamma": F.lit(None).cast("double"), "alpha": F.lit(None).cast("double")})
    both = G.volatilities(whole, garch.filter("ticker = 'G'"), none)
    assert both.filter("garch_vol <> egarch_vol").count() == 0 and both.count() == 1200


def test_study_has_one_row_per_ticker(returns, whole):
    out = P.study(returns, whole)
    assert out.columns == [*P.RESULT_COLUMNS, "Status"]
    got = {r.Ticker: r for r in out.collect()}
    assert set(got) == set(SERIES) and got["E"].Leverage_Effect == "Yes"
    assert got["G"].High_Vol_Days == 300 and got["G"].Low_Vol_Days == 900
    assert (got["SHORT"].Status, got["FLAT"].Status, got["G"].Status) == ("too_short", "constant", "ok")
    assert got["SHORT"].GARCH_Alpha is None and (got["SHORT"].High_Vol_Days, got["SHORT"].Low_Vol_Days) == (0, 3)


@pytest.mark.parametrize("model,lengths", [(G.GARCH, (4096, 100, 30, 10)), (G.EGARCH, (4096, 30))])
def test_a_score_does_not_depend_on_the_blocks(returns, model, lengths):
    """One series in 1, 13, 41 and 121 blocks, under slowly forgetting parameters too."""
    own = returns.filter("ticker = 'G'")
    grid, scores = np.vstack([G.grid_points(model)[::37], G.grid_points(model)[-1]]), []
    if model is G.GARCH:
        grid = np.vstack([grid, [0.0, 1.5, 0.12, 0.0]])  # persistence 0.995
    for days in lengths:
        series = G.prepare(own, days)
        origin, one = (F.array(*[F.lit(x)] * grid.shape[1]) for x in (0.0, 1.0))
        state = series.stats.select("ticker", "mean", "var", "backcast", origin.alias("center"), one.alias("radius"))
        state = G.cut_lineage(state, "points")
        scores.append(G._score(series, series.blocks.drop("dates"), state, model, "normal", grid).first().scores)
    for other in scores[1:]:
        np.testing.assert_allclose(other, scores[0], atol=1e-6, rtol=0)


def test_min_rows_is_the_callers(whole):
    assert {r.ticker: r.status for r in G.fit_garch(whole, 3, min_rows=3).collect()}["SHORT"] != "too_short"


def test_paths_step_together():
    rng = np.random.default_rng(0)
    series = [rng.standard_normal(n) for n in (0, 1, 7, 40)]
    theta = [rng.random(4) * x for x in (0.1, 0.1, 0.1, 0.8)]
    got = V.paths(V.garch_states, series, theta, np.ones(4))
    for k, r in enumerate(series):
        s, want = 1.0, [1.0]
        for x in r:
            s = theta[1][k] + theta[2][k] * (x - theta[0][k]) ** 2 + theta[3][k] * s
            want.append(s)
        np.testing.assert_allclose(got[k], want, rtol=1e-12)


def path_loglik(kind, r, theta):
    """Log density of every row, by a plain loop."""
    out, b = [], backcast(r)
    if kind == "garch":
        mu, omega, alpha, beta = theta
        s = omega + (alpha + beta) * b
        for x in r:
            out.append(-0.5 * (math.log(2 * math.pi * s) + (x - mu) ** 2 / s))
            s = omega + alpha * (x - mu) ** 2 + beta * s
    else:
        mu, omega, alpha, gamma, beta = theta
        s = omega + beta * math.log(b)
        for x in r:
            z = (x - mu) * math.exp(-s / 2)
            out.append(-0.5 * (math.log(2 * math.pi) + s + z * z))
            s = omega + alpha * (abs(z) - math.sqrt(2 / math.pi)) + gamma * z + beta * s
    return np.array(out)


def sandwich(kind, r, theta, steps):
    """Standard errors by differences in the parameters themselves, and the gradient in their units."""
    p, f = len(theta), lambda *moves: path_loglik(kind, r, theta + sum(moves, np.zeros(len(theta))))
    e = np.diag(steps)
    slopes = np.array([(f(e[i]) - f(-e[i])) / (2 * steps[i]) for i in range(p)]).T
    hess = np.array([[(f(e[i], e[j]) - f(e[i], -e[j]) - f(-e[i], e[j]) + f(-e[i], -e[j])).sum() / (4 * steps[i] * steps[j]) for j in range(p)] for i in range(p)])
    bread = np.linalg.inv(-hess)
    return np.sqrt(np.diag(bread @ slopes.T @ slopes @ bread)), slopes.sum(0)


@pytest.mark.parametrize(
    "model, ticker, truth, block_days",
    [(G.GARCH, "G", (0.05, 0.05, 0.1, 0.85), 600), (G.EGARCH, "E", (0.05, 0.02, 0.2, -0.12, 0.95), 4096)],
    ids=["garch", "egarch"],
)
def test_the_report_agrees_with_differences_of_a_plain_likelihood(returns, model, ticker, truth, block_days):
    series = G.prepare(returns.filter(F.col("ticker").isin(ticker, "FLAT")), block_days)
    rows = G.fit_report(series, model).collect()
    assert {r.ticker for r in rows} == {ticker}
    report = {r.param: r for r in rows}
    theta = np.array([report[p].estimate for p in model.params])
    got = np.array([report[p].std_err for p in model.params])
    kink = model is G.EGARCH  # no second derivative in the mean: differences over another width differ some
    want, gradient = sandwich(model.name, SERIES[ticker], theta, got * np.where([kink, *[False] * (len(got) - 1)], 0.15, 0.02))
    assert np.allclose(got[kink:], want[kink:], rtol=2e-2 if kink else 5e-3) and np.allclose(got, want, rtol=0.15)
    assert np.abs(gradient * got).max() < (0.2 if kink else 0.02), "at the maximum"
    assert all(r.off_optimum < (0.2 if kink else 0.02) for r in rows)
    for p, true in zip(model.params, truth):
        r = report[p]
        assert abs(r.estimate - true) < 4 * r.std_err and math.isclose(r.t_value, r.estimate / r.std_err)
        assert math.isclose(r.upper - r.lower, 2 * 1.959963984540054 * r.std_err) and 0 <= r.p_value <= 1
