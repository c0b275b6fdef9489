"""Ridge logistic regression on a small matrix."""

from __future__ import annotations

import numpy as np


def ridge_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """Coefficients, intercept first, by damped Newton steps; the intercept has no penalty."""
    x = np.column_stack([np.ones(len(x)), x])
    penalty = np.array([1e-9] + [ridge] * (x.shape[1] - 1))

    def loss(b: np.ndarray) -> float:
        z = x @ b
        return float(weight @ (np.logaddexp(0, z) - y * z) + penalty @ b**2 / 2)

    b = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -500, 500)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (weight * (y - p)) - penalty * b)
        size = 1.0
        while size > 1e-6 and loss(b + size * step) > loss(b):
            size /= 2
        b = b + size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return b
