"""Logistic regression on samples of bounded size, and its calibration."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def minimise(
    f: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, rounds: int = 100, memory: int = 8
) -> np.ndarray:
    """Limited-memory BFGS with a backtracking search, for smooth convex functions."""
    value, slope = f(x)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        q, used = slope.copy(), []
        for s, y in reversed(steps):
            a = s @ q / (s @ y)
            q -= a * y
            used.append(a)
        if steps:
            s, y = steps[-1]
            q *= s @ y / (y @ y)
        for (s, y), a in zip(steps, reversed(used)):
            q += s * (a - y @ q / (s @ y))
        t, fall = 1.0 if steps else 1.0 / max(1.0, float(np.abs(q).sum())), float(slope @ q)
        while True:
            new = x - t * q
            new_value, new_slope = f(new)
            if new_value <= value - 1e-4 * t * fall or t < 1e-12:
                break
            t *= 0.5
        s, y = new - x, new_slope - slope
        done = value - new_value <= 1e-9 * max(1.0, abs(value))
        x, value, slope = new, new_value, new_slope
        if s @ y > 1e-12:
            steps = [*steps, (s, y)][-memory:]
        if done:
            break
    return x


def fit_logistic(
    times: Callable[[np.ndarray], np.ndarray],
    back: Callable[[np.ndarray], np.ndarray],
    width: int,
    y: np.ndarray,
    weight: np.ndarray,
    penalty: float,
) -> np.ndarray:
    """Coefficients, the constant last. `times` is the product with the rows, `back` that
    with their transpose; the penalty on squares leaves the constant alone."""
    total = weight.sum()

    def f(w):
        z = times(w[:-1]) + w[-1]
        loss = np.maximum(z, 0) - z * y + np.log1p(np.exp(-np.abs(z)))
        error = weight * (sigmoid(z) - y) / total
        slope = np.append(back(error) + penalty * w[:-1], error.sum())
        return float(weight @ loss / total + penalty / 2 * w[:-1] @ w[:-1]), slope

    return minimise(f, np.zeros(width + 1))


def fit_dense(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, penalty: float = 1e-3):
    weight = np.ones(len(y)) if weight is None else weight
    return fit_logistic(lambda w: x @ w, lambda e: x.T @ e, x.shape[1], y, weight, penalty)


def calibrate(z: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> tuple[float, float]:
    """Slope and constant of a logistic curve through raw scores, by Platt's targets.

    Without both classes there is nothing to fit, and the curve is that of the raw score.
    """
    good, bad = float(y.sum()), float(len(y) - y.sum())
    if not good or not bad:
        return 1.0, 0.0
    target = np.where(y > 0.5, (good + 1) / (good + 2), 1 / (bad + 2))
    scale = max(float(np.std(z)), 1e-9)
    w = fit_dense((z / scale)[:, None], target, weight, penalty=1e-6)
    return float(w[0] / scale), float(w[1])
