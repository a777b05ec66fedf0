"""Variance recursions and log-likelihoods over one block of a return series.

Small numpy helpers for use inside Arrow functions: Spark decides which block
meets which parameters and carries the state from block to block.
"""

from __future__ import annotations

import math

import numpy as np

MEAN_ABS_NORMAL = math.sqrt(2.0 / math.pi)
LOG_VARIANCE_LIMIT = 700.0


def _columns(returns):
    """Returns as rows of time and columns of parameters; one series serves all columns."""
    return returns[:, None] if returns.ndim == 1 else returns


def garch_states(returns, theta, start):
    """Squared residuals and variance of every row under every column of ``theta`` (mu, omega, alpha, beta), and the end states.

    ``returns`` is one series for all columns or a matrix with a series per column.
    """
    mu, omega, alpha, beta = theta
    e2 = (_columns(returns) - mu) ** 2
    shocks = omega + alpha * e2
    variances = np.empty_like(e2)
    state = start
    for i in range(len(returns)):
        variances[i] = state
        state = shocks[i] + beta * state
    return e2, variances, state


def egarch_states(returns, theta, start):
    """As :func:`garch_states` for (mu, omega, alpha, gamma, beta); the states are log variances."""
    mu, omega, alpha, gamma, beta = theta
    e = _columns(returns) - mu
    level = omega - alpha * MEAN_ABS_NORMAL
    logs = np.empty_like(e)
    state = start
    for i in range(len(returns)):
        logs[i] = state
        z = e[i] * np.exp(-0.5 * state)
        state = level + alpha * np.abs(z) + gamma * z + beta * state
        np.clip(state, -LOG_VARIANCE_LIMIT, LOG_VARIANCE_LIMIT, out=state)
    return e * e, logs, state


def paths(states, series, theta, starts):
    """For each series (a list of arrays) under its own parameters: its rows' states and, last, the state after it.

    All series step together, each in its own column; shorter ones are padded, which their part of the result leaves out.
    """
    longest = max(map(len, series), default=0)
    padded = np.zeros((longest, len(series)))
    for column, r in enumerate(series):
        padded[: len(r), column] = r
    _, inside, end = states(padded, theta, np.array(starts, dtype=float))
    whole = np.vstack([inside, end])
    return [whole[: len(r) + 1, column] for column, r in enumerate(series)]


def log_density(e2, variance, dist, shape=None):
    """Summed log density per parameter column; ``shape`` is the GED or Student-t degree per column."""
    return row_log_density(e2, variance, dist, shape).sum(axis=0)


def row_log_density(e2, variance, dist, shape=None):
    """Log density of every row under every parameter column."""
    z2 = e2 / variance
    base = -0.5 * np.log(variance)
    if dist == "normal":
        return base - 0.5 * (math.log(2.0 * math.pi) + z2)
    lgamma = np.vectorize(math.lgamma)
    if dist == "ged":
        log_scale = 0.5 * (-2.0 / shape * math.log(2.0) + lgamma(1.0 / shape) - lgamma(3.0 / shape))
        const = np.log(shape) - log_scale - lgamma(1.0 / shape) - (1.0 + 1.0 / shape) * math.log(2.0)
        return base + const - 0.5 * (z2 / np.exp(2.0 * log_scale)) ** (shape / 2.0)
    if dist == "t":
        const = lgamma((shape + 1.0) / 2.0) - lgamma(shape / 2.0) - 0.5 * np.log(math.pi * (shape - 2.0))
        return base + const - (shape + 1.0) / 2.0 * np.log1p(z2 / (shape - 2.0))
    raise ValueError(f"unknown distribution: {dist}")
