"""Weights of additive exponential smoothing for a batch of series, with array arithmetic.

This is the one step Spark's own expressions cannot carry out at a useful speed: a recursion over
time, tried with many weights. It runs inside tasks, on the rows Spark hands to each, and hands back the
weights and the start; what these make of a series is computed by ``operators/forecast.smoothed``.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle

# Ship this module's functions by value, so that workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WEIGHTS = ("series string, y array<double>, season_length int, alpha double, beta double, gamma double, "
           "level double, trend double, season array<double>")


def _start(y: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Level before the first value, slope and seasonal pattern by least squares; y is (S, n)."""
    n = y.shape[1]
    t = np.arange(1, n + 1)
    if n < 2:
        return y[:, 0].copy(), np.zeros(len(y)), np.zeros((len(y), max(m, 1)))
    if m < 2:
        slope, at_zero = np.polyfit(t, y.T, 1)
        return at_zero, slope, np.zeros((len(y), 1))
    design = np.zeros((n, m + 1))
    design[np.arange(n), np.arange(n) % m] = 1
    design[:, m] = t
    fitted = np.linalg.lstsq(design, y.T, rcond=None)[0]
    base = fitted[:m].mean(axis=0)
    return base, fitted[m], (fitted[:m] - base).T


def _smooth(y: np.ndarray, m: int, start: tuple, a: np.ndarray, b: np.ndarray, g: np.ndarray):
    """Run all (series, candidate) pairs through the data; a, b, g are (S, C). Returns the sum of
    squared one-step errors, its mean error, and the final state."""
    seasonal = m > 1
    level = np.repeat(start[0][:, None], a.shape[1], axis=1)
    trend = np.repeat(start[1][:, None], a.shape[1], axis=1)
    season = [np.repeat(start[2][:, [j]], a.shape[1], axis=1) for j in range(start[2].shape[1])]
    sse, total = np.zeros(a.shape), np.zeros(a.shape)
    for i in range(y.shape[1]):
        j = i % m if seasonal else 0
        ahead = level + trend
        error = y[:, [i]] - ahead - season[j]
        sse += error * error
        total += error
        risen = ahead + a * error
        trend = trend + b * (risen - level - trend)
        level = risen
        if seasonal:
            season[j] = season[j] + g * error
    return sse, total / y.shape[1], level, trend, season


# Candidate weights of the first search; later rounds look around the best one.
_ALPHA = (0.01, 0.05, 0.15, 0.4, 0.8)
_BETA = (0.0, 0.02, 0.1, 0.4)
_GAMMA = (0.0, 0.03, 0.1, 0.3)


def _pick(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
    return rows[np.arange(len(rows)), at]


def _fit_batch(y: np.ndarray, m: int) -> dict[str, np.ndarray]:
    """Weights with the least squared one-step error, and the state they lead to."""
    starts = [_start(y, m)]
    if m > 1 and y.shape[1] > 4 * m:
        starts.append(_start(y[:, :4 * m], m))
    gammas = _GAMMA if m > 1 else (0.0,)
    grid = np.array([(a, b, g) for a in _ALPHA for b in _BETA for g in gammas])
    best = None
    for start in starts:
        weights = np.repeat(grid[None, :, :], len(y), axis=0)
        step = np.array([0.08, 0.04, 0.05])
        for _ in range(4):
            sse, mean, level, trend, season = _smooth(y, m, start, *np.moveaxis(weights, 2, 0))
            at = np.argmin(np.where(np.isfinite(sse), sse, np.inf), axis=1)
            found = {
                "weights": weights[np.arange(len(y)), at], "sse": _pick(sse, at),
                "mean": _pick(mean, at), "level": _pick(level, at), "trend": _pick(trend, at),
                "season": np.stack([_pick(s, at) for s in season], axis=1),
                "start_level": start[0].copy(), "start_trend": start[1].copy(),
                "start_season": start[2].copy()}
            moves = np.array([(x, z, w) for x in (-1, 0, 1) for z in (-1, 0, 1)
                              for w in ((-1, 0, 1) if m > 1 else (0,))]) * step
            weights = np.clip(found["weights"][:, None, :] + moves[None], 0.0, 0.999)
            step = step / 2.5
        if best is None:
            best = found
        else:
            better = found["sse"] < best["sse"]
            for name, values in found.items():
                best[name][better] = values[better]
    return best


def batch_fitter(season_length: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The function that turns batches of (series, y) into rows of WEIGHTS: the state is the one before
    the first value."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lengths = batch["y"].map(len)
            for n in sorted(lengths.unique()):
                same = batch[lengths == n]
                # With less than two whole seasons only level and trend are fitted.
                m = season_length if n >= 2 * season_length else 0
                for lo in range(0, len(same), 64):
                    part = same.iloc[lo:lo + 64]
                    y = np.stack([np.asarray(v, dtype=float) for v in part["y"]])
                    state = _fit_batch(y, m)
                    yield pd.DataFrame({
                        "series": part["series"].to_numpy(), "y": list(part["y"]), "season_length": m,
                        "alpha": state["weights"][:, 0], "beta": state["weights"][:, 1],
                        "gamma": state["weights"][:, 2], "level": state["start_level"],
                        "trend": state["start_trend"], "season": list(state["start_season"])})
    return run
