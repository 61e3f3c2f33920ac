"""A small logistic regression by Newton steps, for driver-side calibration of a few features."""

from __future__ import annotations

import numpy as np


def fit(x: np.ndarray, y: np.ndarray, l2: float = 1.0, steps: int = 40, weights: np.ndarray | None = None) -> np.ndarray:
    """Weights with the intercept first; the intercept is not shrunk. ``weights``: how much each row counts."""
    x = np.column_stack([np.ones(len(x)), x])
    w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], l2)
    ridge[0] = 1e-6
    u = np.ones(len(x)) if weights is None else weights
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve((x * (u * p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-9), x.T @ (u * (y - p)) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def predict(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(w[0] + x @ w[1:], -40, 40)))
