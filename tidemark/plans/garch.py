"""GARCH(1,1) and EGARCH(1,1) per ticker as Spark jobs.

A series is cut into blocks (one row each, an array of returns). Each round of
the fit joins every ticker's current search point to its blocks, scores a small
design of parameter vectors per block inside an Arrow function, sums the scores
over blocks by a grouped aggregation and moves every ticker's point at once.
Between rounds only one row per ticker survives, written to the shared folder.
A ticker whose whole series is one block needs nothing from other tasks: its
rounds run back to back where the block is, one job for all such tickers.

The recursions run over time. A long series still spreads over tasks: all
blocks run at once from guessed start states, then again from the end states
of their predecessors, until the states at the seams stop moving. After ``j``
sweeps the first ``j`` blocks are exact, so the sweeps always end.
"""

from __future__ import annotations

import itertools
import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions import returns as R, variance as V
from tidemark.operators.blocks import attach_stats, block_of, fitted_days
from tidemark.session import cut_lineage

# Task-side helpers travel with the job; executors need no installed copy.
cloudpickle.register_pickle_by_value(V)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_DAYS = 4096
# Shorter series are not fitted; a caller may ask for another number.
MIN_ROWS = 10
# Fixed values of the published estimator's start-up.
BACKCAST_ROWS = 75
BACKCAST_DECAY = 0.94
DISTRIBUTIONS = ("normal", "ged", "t")

# A search that still gains after so many rounds says so in its status.
MAX_ROUNDS = 60
GAIN_TOLERANCE = 1e-6
SEAM_TOLERANCE = 1e-12


@dataclass(frozen=True)
class Model:
    """Names of the natural parameters and the unbounded coordinates they are searched in."""

    name: str
    params: tuple[str, ...]
    grid: tuple[tuple[float, ...], ...]
    radius: tuple[float, ...]


# Persistences and shares are squared sines (EGARCH's beta a sine) of their coordinates: a maximum at the end of their
# range is then a smooth one at a finite point. Coordinates: mean shift in deviations, persistence, alpha's share of it,
# log variance ratio.
GARCH = Model(
    "garch",
    ("mu", "omega", "alpha", "beta"),
    ((0.0,), (0.8, 1.1, 1.35, 1.46), (0.15, 0.3, 0.5, 0.9), (-0.7, 0.0, 0.7)),
    (0.05, 0.2, 0.2, 0.5),
)
# Coordinates: mean shift in deviations, beta, alpha, gamma, log variance offset.
EGARCH = Model(
    "egarch",
    ("mu", "omega", "alpha", "gamma", "beta"),
    ((0.0,), (0.3, 0.85, 1.25, 1.42), (0.02, 0.1, 0.25, 0.45), (-0.2, -0.05, 0.05, 0.2), (-0.5, 0.0, 0.5)),
    (0.05, 0.2, 0.1, 0.1, 0.4),
)
SHAPE_GRID = {"ged": (0.2, 0.7, 1.1), "t": (0.7, 1.8, 3.0)}
SHAPE_RADIUS = 0.4


@dataclass(frozen=True)
class Series:
    """Blocks of percent returns ``ticker, seq, n_blocks, dates, r`` and per-ticker ``n, mean, var, backcast``."""

    blocks: DataFrame
    stats: DataFrame
    max_blocks: int

    def spread(self, rows: DataFrame) -> DataFrame:
        """Even out compute: partitions by count of blocks, not by their (small) bytes."""
        return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism, "ticker", "seq")


def prepare(returns: DataFrame, block_days: float = BLOCK_DAYS) -> Series:
    """Cut the ``log_return`` series into blocks, scaled to percent, and write them once."""
    block_days = fitted_days(returns, ["ticker"], "date", block_days)
    packed = (
        returns.select("ticker", "date", (F.col("log_return") * R.PERCENT).alias("r"), block_of("date", block_days).alias("_block"))
        .groupBy("ticker", "_block")
        .agg(F.sort_array(F.collect_list(F.struct("date", "r"))).alias("rows"))
        .select("ticker", "_block", F.col("rows.date").alias("dates"), F.col("rows.r").alias("r"))
    )
    # The returns are computed once, for the blocks; everything else reads those back.
    packed = cut_lineage(packed, "garch-blocks")
    r = packed.select("ticker", "_block", F.posexplode("r").alias("_pos", "r"))
    moments = r.groupBy("ticker").agg(
        F.count("*").alias("n"), F.avg("r").alias("mean"), F.var_samp("r").alias("var")
    )
    early = Window.partitionBy("ticker").orderBy("_block", "_pos")
    head = r.withColumn("_i", F.row_number().over(early)).filter(F.col("_i") <= BACKCAST_ROWS)
    weight = F.pow(F.lit(BACKCAST_DECAY), F.col("_i") - 1)
    backcast = head.join(moments, "ticker").groupBy("ticker").agg(
        (F.sum(weight * F.pow(F.col("r") - F.col("mean"), 2)) / F.sum(weight)).alias("backcast")
    )
    stats = cut_lineage(moments.join(backcast, "ticker"), "garch-stats")
    per_ticker = Window.partitionBy("ticker")
    numbered = packed.select("ticker", "_block").withColumns(
        {
            "seq": F.row_number().over(per_ticker.orderBy("_block")) - 1,
            "n_blocks": F.count("*").over(per_ticker),
        }
    )
    max_blocks = (numbered.agg(F.max("seq")).first()[0] or 0) + 1
    if max_blocks == 1:
        blocks = packed.withColumns({"seq": F.lit(0), "n_blocks": F.lit(1).cast("bigint")})
    else:
        blocks = packed.join(numbered, ["ticker", "_block"])
    return Series(blocks.select("ticker", "seq", "n_blocks", "dates", "r"), stats, max_blocks)


# ---- task-side ----------------------------------------------------------------------------------


def _theta(model: Model, u: np.ndarray, mean: float, var: float, dist: str):
    """Natural parameters (and density shape) of search points ``u`` (points x coordinates)."""
    shape = None
    if dist != "normal":
        shape = np.exp(u[:, -1]) + (2.0 if dist == "t" else 0.0)
    mu = mean + u[:, 0] * math.sqrt(var)
    if model.name == "garch":
        p, share = np.sin(u[:, 1]) ** 2, np.sin(u[:, 2]) ** 2
        return (mu, np.exp(u[:, 3]) * var * (1 - p), p * share, p * (1 - share)), shape
    beta = np.sin(u[:, 1])
    return (mu, (1 - beta) * (math.log(var) + u[:, 4]), u[:, 2], u[:, 3], beta), shape


def _default_start(model_name: str, theta, backcast: float):
    """State before the first row; also the first guess at a seam."""
    if model_name == "garch":
        return theta[1] + (theta[2] + theta[3]) * backcast
    return theta[1] + theta[-1] * math.log(backcast)


def _design(p: int) -> np.ndarray:
    """Centre, both ends of every axis and the corners of every coordinate pair."""
    points = [np.zeros(p)]
    for i in range(p):
        points += [s * np.eye(p)[i] for s in (1, -1)]
    for i, j in itertools.combinations(range(p), 2):
        points += [a * np.eye(p)[i] + b * np.eye(p)[j] for a in (1, -1) for b in (1, -1)]
    return np.array(points)


def _quadratic_step(values: np.ndarray, design: np.ndarray):
    """Maximiser of the quadratic through the scored design, held inside the unit box, and its predicted value."""
    p = design.shape[1]
    pairs = list(itertools.combinations(range(p), 2))
    terms = np.column_stack([np.ones(len(design)), design, design**2, *[design[:, i] * design[:, j] for i, j in pairs]])
    coef = np.linalg.lstsq(terms, values, rcond=None)[0]
    slope, hess = coef[1 : 1 + p], np.diag(2 * coef[1 + p : 1 + 2 * p])
    for (i, j), c in zip(pairs, coef[1 + 2 * p :]):
        hess[i, j] = hess[j, i] = c
    curve, axes = np.linalg.eigh(hess)
    curve = np.minimum(curve, -1e-3 * np.abs(curve).max() - 1e-12)
    step = axes @ (-(axes.T @ slope) / curve)
    reach = np.abs(step).max()
    step = step / max(1.0, reach)
    return step, reach, values[0] + slope @ step + 0.5 * step @ hess @ step


def _move(values, center, radius, best, best_ll, design, coarse, first_radius):
    """Next (centre, radius, best point, its score, gain, settled) of one ticker's search."""
    values = np.where(np.isfinite(values), values, -1e300)
    i = int(values.argmax())
    points = center + radius * design
    gain = 0.0
    if values[i] > best_ll:
        gain, best, best_ll = values[i] - best_ll, points[i], values[i]
    if coarse:
        return best, first_radius, best, best_ll, gain, False
    if values[0] < best_ll - gain - 1e-9:
        return best, radius * 0.5, best, best_ll, gain, False
    step, reach, predicted = _quadratic_step(values, design)
    settled = bool(gain < GAIN_TOLERANCE and predicted - values[i] < GAIN_TOLERANCE)
    # The box grows while the maximum lies beyond it (a best value may be at no finite point) and shrinks around one inside.
    scale = 2.0 if reach > 1 and gain > 0 else 1.0 if reach > 1 else max(0.3, min(0.8, 2 * reach))
    target = center + radius * step if predicted >= values[i] else points[i]
    return target, np.minimum(radius * scale, 2 * first_radius), best, best_ll, gain, settled


def _search_here(model: Model, dist: str, r, mean, var, backcast, coarse, local, first_radius, max_rounds):
    """All rounds of one ticker whose series is at hand."""
    best, best_ll, settled = np.zeros(len(first_radius)), -1e300, False
    center, radius, design = np.zeros(len(first_radius)), np.ones(len(first_radius)), coarse
    for round_ in range(max_rounds):
        values = _score_block(model, dist, center + radius * design, r, mean, var, backcast, None)[0]
        center, radius, best, best_ll, _, settled = _move(
            values, center, radius, best, best_ll, design, round_ == 0, first_radius
        )
        design = local
        if settled:
            break
    return best, best_ll, settled


def _row_scores(model: Model, dist: str, u, r, mean, var, backcast, start):
    """Log density of every row of one block under search points ``u``, and the states it ends in."""
    states = V.garch_states if model.name == "garch" else V.egarch_states
    with np.errstate(all="ignore"):
        theta, shape = _theta(model, u, mean, var, dist)
        if start is None:
            start = _default_start(model.name, theta, backcast)
        e2, variance, end = states(r, theta, np.array(start, dtype=float))
        if model.name == "egarch":
            variance = np.exp(variance)
        return V.row_log_density(e2, variance, dist, shape), end


def _score_block(model: Model, dist: str, u, r, mean, var, backcast, start):
    """Log-likelihood of one block under search points ``u``, and the states it ends in."""
    scores, end = _row_scores(model, dist, u, r, mean, var, backcast, start)
    with np.errstate(all="ignore"):
        return scores.sum(axis=0), end


# ---- rounds -------------------------------------------------------------------------------------


def _score_pass(rows: DataFrame, model: Model, dist: str, design: np.ndarray) -> DataFrame:
    """Score the design around each row's centre over that row's block."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            scored = [
                _score_block(
                    model, dist, row.center + row.radius * design, row.r, row.mean, row.var, row.backcast, row.start
                )
                for row in pdf.itertuples(index=False)
            ]
            yield pd.DataFrame(
                {"ticker": pdf["ticker"], "seq": pdf["seq"], "ll": [s[0] for s in scored], "ends": [s[1] for s in scored]}
            )

    return rows.mapInPandas(score, "ticker string, seq int, ll array<double>, ends array<double>")


def _moved(ends: DataFrame, before: DataFrame) -> DataFrame:
    """Blocks one of whose end states is not where the sweep before left it (two undefined states are the same)."""
    old = before.select("ticker", "seq", F.col("ends").alias("_old"))
    differ = F.exists(
        F.zip_with("ends", "_old", lambda a, b: (a != b) & (F.abs(a - b) > SEAM_TOLERANCE * (1 + F.abs(a)))), lambda x: x
    )
    return ends.join(old, ["ticker", "seq"]).filter(differ)


def _swept(series: Series, blocks: DataFrame, state: DataFrame, model: Model, dist: str, design: np.ndarray) -> tuple[DataFrame, DataFrame]:
    """(blocks with their ticker's search point, every block's ``ll`` and end states).

    Sweeps go on until no state at a seam moves, so the sum is that of the
    uncut series: after ``j`` sweeps the first ``j`` blocks are exact, and a
    recursion that forgets its start needs few.
    """
    points = state.select("ticker", "center", "radius", "mean", "var", "backcast")
    rows = series.spread(attach_stats(blocks, points, ["ticker"], ["seq"], written=True))
    scored = cut_lineage(_score_pass(rows.withColumn("start", F.lit(None).cast("array<double>")), model, dist, design), "seams")
    for _ in range(series.max_blocks - 1):
        before = scored
        scored = cut_lineage(_score_pass(_from_seams(rows, before), model, dist, design), "seams")
        if _moved(scored, before).isEmpty():
            break
    return rows, scored


def _from_seams(rows: DataFrame, scored: DataFrame) -> DataFrame:
    """Blocks that start in the states the blocks before them end in."""
    seams = scored.select("ticker", (F.col("seq") + 1).alias("seq"), F.col("ends").alias("start"))
    return rows.join(seams, ["ticker", "seq"], "left")


def _summed(scored: DataFrame, column: str) -> DataFrame:
    """(ticker, column): the arrays of a ticker's blocks added up."""
    return (
        scored.select("ticker", F.posexplode(column).alias("pos", "x"))
        .groupBy("ticker", "pos")
        .agg(F.sum("x").alias("x"))
        .groupBy("ticker")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "x"))).alias("all"))
        .select("ticker", F.col("all.x").alias(column))
    )


def _score(series: Series, blocks: DataFrame, state: DataFrame, model: Model, dist: str, design: np.ndarray) -> DataFrame:
    """Log-likelihood per ticker and design point, summed over the blocks."""
    return _summed(_swept(series, blocks, state, model, dist, design)[1], "ll").withColumnRenamed("ll", "scores")


def grid_points(model: Model) -> np.ndarray:
    """The fixed coarse grid, in search coordinates."""
    return np.array(list(itertools.product(*model.grid)))


def grid_loglik(series: Series, model: Model, min_rows: int = MIN_ROWS) -> DataFrame:
    """(ticker, point, loglik): normal log-likelihood of every point of the coarse grid for every usable ticker."""
    grid = grid_points(model)
    origin = F.array(*[F.lit(0.0)] * grid.shape[1])
    one = F.array(*[F.lit(1.0)] * grid.shape[1])
    state = _usable(series.stats, min_rows).filter(F.col("reason").isNull())
    state = cut_lineage(state.select("ticker", "mean", "var", "backcast", origin.alias("center"), one.alias("radius")), "grid")
    scores = _score(series, series.blocks.drop("dates"), state, model, "normal", grid)
    return scores.select("ticker", F.posexplode("scores").alias("point", "loglik"))


def _advance(state: DataFrame, scores: DataFrame, design: np.ndarray, coarse: bool, first_radius: np.ndarray) -> DataFrame:
    """Move every ticker's search point by its scores (one small row per ticker)."""
    columns = state.columns

    def move(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            moved = [
                _move(r.scores, r.center, r.radius, r.best, r.best_ll, design, coarse, first_radius)
                for r in pdf.itertuples(index=False)
            ]
            out = pdf.drop(columns="scores")
            for k, name in enumerate(("center", "radius", "best", "best_ll", "gain", "settled")):
                out[name] = [m[k] for m in moved]
            yield out[columns]

    return state.join(scores, "ticker").mapInPandas(move, state.schema)


def _usable(stats: DataFrame, min_rows: int) -> DataFrame:
    """Statistics with the reason a series cannot be fitted, if any."""
    return stats.withColumn(
        "reason",
        F.when(F.col("n") < min_rows, "too_short").when(~(F.col("var") > 0) | ~(F.col("backcast") > 0), "constant"),
    )


FOUND = "ticker string, mean double, var double, best array<double>, best_ll double, settled boolean"


def _search_short(series: Series, stats: DataFrame, model: Model, dist: str, coarse, local, radius, max_rounds: int) -> DataFrame:
    """Search of the tickers whose series is a single block."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [
                _search_here(model, dist, row.r, row.mean, row.var, row.backcast, coarse, local, radius, max_rounds)
                for row in pdf.itertuples(index=False)
            ]
            out = pdf[["ticker", "mean", "var"]].copy()
            for k, name in enumerate(("best", "best_ll", "settled")):
                out[name] = [f[k] for f in found]
            yield out

    rows = series.blocks.filter("n_blocks = 1").drop("dates").join(stats, "ticker")
    return series.spread(rows).mapInPandas(run, FOUND)


def _search_long(series: Series, stats: DataFrame, model: Model, dist: str, coarse, local, radius, max_rounds: int) -> DataFrame:
    """Search of the tickers spread over several blocks, one job per round."""
    blocks = series.blocks.filter("n_blocks > 1").drop("dates")

    def constant(v: float):
        return F.array(*[F.lit(float(v))] * len(radius))

    first = stats.join(blocks.filter("seq = 0").select("ticker"), "ticker", "left_semi").select(
        "ticker",
        "mean",
        "var",
        "backcast",
        constant(0).alias("center"),
        constant(1).alias("radius"),
        constant(0).alias("best"),
        F.lit(-1e300).alias("best_ll"),
        F.lit(0.0).alias("gain"),
        F.lit(False).alias("settled"),
    )
    state, done = cut_lineage(first, f"{model.name}-start"), []
    for round_ in range(max_rounds):
        design = coarse if round_ == 0 else local
        scores = _score(series, blocks, state, model, dist, design)
        state = cut_lineage(_advance(state, scores, design, round_ == 0, radius), f"{model.name}-round")
        # Settled tickers leave the search, so later rounds only pay for the rest.
        done.append(state.filter("settled"))
        state = state.filter(~F.col("settled"))
        if round_ > 0 and state.isEmpty():
            break
    found = state
    for part in done:
        found = found.unionByName(part)
    return found.select("ticker", "mean", "var", "best", "best_ll", "settled")


def search(series: Series, stats: DataFrame, model: Model, dist: str = "normal", max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """Maximise the likelihood for every ticker in ``stats``: ``best`` point, ``best_ll`` and ``settled`` per ticker."""
    grid, radius = list(model.grid), np.array(model.radius)
    if dist != "normal":
        grid, radius = [*grid, SHAPE_GRID[dist]], np.append(radius, SHAPE_RADIUS)
    stats = stats.select("ticker", "mean", "var", "backcast")
    args = (np.array(list(itertools.product(*grid))), _design(len(radius)), radius, max_rounds)
    found = _search_short(series, stats, model, dist, *args)
    if series.max_blocks > 1:
        found = found.unionByName(_search_long(series, stats, model, dist, *args))
    return found


def _natural(found: DataFrame, model: Model, dist: str) -> DataFrame:
    names = [*model.params, "shape"]
    schema = "ticker string, " + ", ".join(f"{n} double" for n in names) + ", best_ll double, settled boolean"

    def translate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                theta, shape = _theta(model, np.asarray(r.best)[None, :], r.mean, r.var, dist)
                rows.append([r.ticker, *[float(t[0]) for t in theta], None if shape is None else float(shape[0]), r.best_ll, r.settled])
            yield pd.DataFrame(rows, columns=["ticker", *names, "best_ll", "settled"]).astype({"shape": float})

    return found.mapInPandas(translate, schema)


def _fit(series: Series, model: Model, distributions: Sequence[str], max_rounds: int, min_rows: int) -> DataFrame:
    """Try each density in turn for the tickers the ones before it could not fit."""
    checked = _usable(series.stats, min_rows)
    todo = checked.filter(F.col("reason").isNull())
    fits = None
    for dist in distributions:
        found = _natural(search(series, todo, model, dist, max_rounds), model, dist).withColumn("dist", F.lit(dist))
        good = cut_lineage(found.filter(F.col("best_ll") > -1e299), f"{model.name}-fit")
        fits = good if fits is None else fits.unionByName(good)
        if dist == distributions[-1]:
            break
        todo = todo.join(good.select("ticker"), "ticker", "left_anti")
        if todo.isEmpty():
            break
    k = F.lit(len(model.params)) + F.when(F.col("dist") == "normal", 0).otherwise(1)
    status = (
        F.when(F.col("reason").isNotNull(), F.col("reason"))
        .when(F.col("best_ll").isNull(), "failed")
        .when(F.col("settled"), "ok")
        .otherwise("max_rounds")
    )
    return (
        checked.join(fits, "ticker", "left")
        .withColumn("status", status)
        .select(
            "ticker",
            "n",
            "backcast",
            *model.params,
            F.when(~F.isnan("shape"), F.col("shape")).alias("shape"),
            "dist",
            F.col("best_ll").alias("loglik"),
            (-2 * F.col("best_ll") + 2 * k).alias("aic"),
            (-2 * F.col("best_ll") + k * F.log(F.col("n").cast("double"))).alias("bic"),
            "status",
        )
    )


def fit_garch(series: Series, max_rounds: int = MAX_ROUNDS, min_rows: int = MIN_ROWS) -> DataFrame:
    """Constant mean, normal GARCH(1,1) per ticker: parameters, persistence, fit summary and status.

    Every ticker has a row; one that cannot be fitted (fewer than ``min_rows``
    returns, no variance) has NULL parameters and the reason as its status.
    """
    return _fit(series, GARCH, ["normal"], max_rounds, min_rows).withColumn("persistence", F.col("alpha") + F.col("beta"))


def fit_egarch(series: Series, distributions: Sequence[str] = ("normal",), max_rounds: int = MAX_ROUNDS, min_rows: int = MIN_ROWS) -> DataFrame:
    """EGARCH(1,1) with asymmetry per ticker; pass :data:`DISTRIBUTIONS` for the fallback chain."""
    return _fit(series, EGARCH, list(distributions), max_rounds, min_rows)


# ---- fit report ---------------------------------------------------------------------------------

# Half widths of the differences, as a share of the first search box. EGARCH's likelihood has a kink in the mean at
# every return; its curvature there is that over a width with some returns.
REPORT_STEP = 5e-3
KINK_STEP = 0.1
Z95 = 1.959963984540054


def _outer_pass(rows: DataFrame, model: Model, dist: str, design: np.ndarray, p: int) -> DataFrame:
    """Per block the sum over its rows of the products of their score's components (in design units)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            outer = []
            for row in pdf.itertuples(index=False):
                scores, _ = _row_scores(model, dist, row.center + row.radius * design, row.r, row.mean, row.var, row.backcast, row.start)
                slopes = (scores[:, 1 : 2 * p : 2] - scores[:, 2 : 2 * p + 1 : 2]) / 2
                outer.append((slopes.T @ slopes).ravel())
            yield pd.DataFrame({"ticker": pdf["ticker"], "outer": outer})

    return rows.mapInPandas(run, "ticker string, outer array<double>")


def _differences(values: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and second differences of a scored :func:`_design`, in design units."""
    plus, minus = values[1 : 2 * p : 2], values[2 : 2 * p + 1 : 2]
    hess = np.diag(plus - 2 * values[0] + minus)
    for k, (i, j) in enumerate(itertools.combinations(range(p), 2)):
        both, first, second, none = values[1 + 2 * p + 4 * k : 5 + 2 * p + 4 * k]
        hess[i, j] = hess[j, i] = (both - first - second + none) / 4
    return (plus - minus) / 2, hess


def _report_rows(model: Model, dist: str, row, design: np.ndarray, p: int):
    """(param, estimate, std_err, t_value, p_value, lower, upper) and the gradient in standard errors, per natural parameter."""
    points = row.center + row.radius * design
    theta, shape = _theta(model, points, row.mean, row.var, dist)
    natural = np.array([np.broadcast_to(t, len(points)) for t in (*theta, *(() if shape is None else (shape,)))])
    slope, hess = _differences(np.asarray(row.scores), p)
    error, off = np.full(p, np.nan), np.nan
    if np.isfinite(hess).all() and np.linalg.eigvalsh(hess).max() < 0:
        bread = np.linalg.inv(-hess)
        covariance = bread @ np.asarray(row.outer).reshape(p, p) @ bread
        into = (natural[:, 1 : 2 * p : 2] - natural[:, 2 : 2 * p + 1 : 2]) / 2
        error = np.sqrt(np.diag(into @ covariance @ into.T))
        # How far the maximum of the local quadratic lies, in units of its own spread.
        off = float(np.sqrt(max(slope @ bread @ slope, 0.0)))
    names = [*model.params, *(["shape"] if shape is not None else [])]
    for name, value, e in zip(names, natural[:, 0].tolist(), error.tolist()):
        usable = e > 0
        t = value / e if usable else None
        yield (
            row.ticker, name, value, e if usable else None, t, math.erfc(abs(t) / math.sqrt(2)) if usable else None,
            value - Z95 * e if usable else None, value + Z95 * e if usable else None, off,
        )


REPORT = "ticker string, param string, estimate double, std_err double, t_value double, p_value double, lower double, upper double, off_optimum double"


def fit_report(series: Series, model: Model, dist: str = "normal", max_rounds: int = MAX_ROUNDS, min_rows: int = MIN_ROWS) -> DataFrame:
    """A row per ticker and parameter: estimate, robust standard error, t-value, p-value and 95 % interval.

    Errors are those of the sandwich: second differences of the likelihood on
    both sides of the summed outer products of the rows' scores, both summed over
    blocks, then carried from search coordinates to the parameters. Where the
    likelihood is not curved downwards, or a parameter stands at the end of its
    range, errors are NULL. ``off_optimum`` says how far from the point the
    local quadratic's maximum lies, in its own standard deviations. Tickers
    that cannot be fitted have no rows.
    """
    usable = _usable(series.stats, min_rows).filter(F.col("reason").isNull())
    found = search(series, usable, model, dist, max_rounds).filter(F.col("best_ll") > -1e299)
    p = len(model.radius) + (dist != "normal")
    step = [REPORT_STEP * r for r in (*model.radius, *([SHAPE_RADIUS] if dist != "normal" else []))]
    if model is EGARCH:
        step[0] = KINK_STEP * model.radius[0]
    state = found.select("ticker", F.col("best").alias("center"), "mean", "var").join(series.stats.select("ticker", "backcast"), "ticker")
    state = cut_lineage(state.withColumn("radius", F.array(*map(F.lit, step))), f"{model.name}-report")
    design = _design(p)
    rows, scored = _swept(series, series.blocks.drop("dates"), state, model, dist, design)
    outer = _summed(_outer_pass(_from_seams(rows, scored), model, dist, design, p), "outer")
    whole = state.join(_summed(scored, "ll").withColumnRenamed("ll", "scores"), "ticker").join(outer, "ticker")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            listed = [r for row in pdf.itertuples(index=False) for r in _report_rows(model, dist, row, design, p)]
            names = [c.split(" ")[0] for c in REPORT.split(", ")]
            yield pd.DataFrame(listed, columns=names).astype({c: float for c in names[2:]})

    out = whole.mapInPandas(run, REPORT)
    return out.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c not in ("ticker", "param") else F.col(c) for c in out.columns])


# ---- conditional volatility ---------------------------------------------------------------------


def _paths(rows: DataFrame, model: Model) -> DataFrame:
    """States of each block's rows plus the state after it, from the row's ``start``; the blocks of a batch step together."""
    states = V.garch_states if model.name == "garch" else V.egarch_states
    params = model.params

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            theta = [pdf[p].to_numpy(dtype=float) for p in params]
            with np.errstate(all="ignore"):
                if model.name == "garch":
                    guess = _default_start(model.name, theta, pdf["backcast"].to_numpy(dtype=float))
                else:
                    guess = theta[1] + theta[-1] * np.log(pdf["backcast"].to_numpy(dtype=float))
                starts = np.where(np.isnan(pdf["start"]), guess, pdf["start"])
                found = V.paths(states, [np.asarray(r, dtype=float) for r in pdf["r"]], theta, starts)
            yield pd.DataFrame({"ticker": pdf["ticker"], "seq": pdf["seq"], "dates": pdf["dates"], "states": found})

    return rows.mapInPandas(run, "ticker string, seq int, dates array<date>, states array<double>")


def conditional_volatility(series: Series, params: DataFrame, model: Model, into: str = "vol") -> DataFrame:
    """``ticker, date, <into>``: conditional volatility of every return, back in return units.

    ``params`` holds one row per ticker with the model's natural parameters;
    tickers whose parameters are NULL have no rows.
    """
    usable = params.select("ticker", *model.params).na.drop()
    stats = usable.join(series.stats.select("ticker", "backcast"), "ticker")
    rows = series.spread(attach_stats(series.blocks.drop("n_blocks"), stats, ["ticker"], ["seq"]))
    nothing = F.lit(float("nan"))
    paths = _paths(rows.withColumn("start", nothing), model)
    if series.max_blocks > 1:
        ends = None
        for _ in range(series.max_blocks):
            tail = paths.select("ticker", "seq", F.element_at("states", -1).alias("end"))
            new_ends = cut_lineage(tail, f"{model.name}-seams")
            settled = False
            if ends is not None:
                moved = F.abs(new_ends["end"] - ends["end"]) > SEAM_TOLERANCE * (1 + F.abs(new_ends["end"]))
                both = new_ends.join(ends, (new_ends["ticker"] == ends["ticker"]) & (new_ends["seq"] == ends["seq"]))
                settled = both.filter(moved).isEmpty()
            ends = new_ends
            seams = ends.select("ticker", (F.col("seq") + 1).alias("seq"), F.col("end").alias("start"))
            paths = _paths(rows.join(seams, ["ticker", "seq"], "left").na.fill(float("nan"), ["start"]), model)
            if settled:
                break
    cells = F.explode(F.arrays_zip("dates", F.slice("states", 1, F.size("dates")).alias("state")))
    state = F.col("cell.state")
    sigma = F.sqrt(state) if model.name == "garch" else F.exp(state / 2)
    return paths.select("ticker", cells.alias("cell")).select(
        "ticker", F.col("cell.dates").alias("date"), (sigma / R.PERCENT).alias(into)
    )


def volatilities(series: Series, garch: DataFrame, egarch: DataFrame) -> DataFrame:
    """GARCH and EGARCH volatility per date; where no EGARCH exists the GARCH series stands in.

    Written once: what follows reads the series several times.
    """
    g = conditional_volatility(series, garch, GARCH, "garch_vol")
    e = conditional_volatility(series, egarch, EGARCH, "egarch_vol")
    both = g.join(e, ["ticker", "date"], "left").withColumn("egarch_vol", F.coalesce("egarch_vol", "garch_vol"))
    return cut_lineage(both, "volatilities")
