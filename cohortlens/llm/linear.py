"""Logistic regression on a bounded sample, in numpy on the driver."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p) - np.log1p(-p)


class Standard:
    """Scales columns to mean 0 and deviation 1 as seen in training, and bounds what lies far outside."""

    def __init__(self, x: np.ndarray):
        self.mean = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
        deviation = x.std(axis=0) if len(x) else np.ones(x.shape[1])
        self.scale = np.where(deviation > 1e-9, deviation, 1.0)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -12, 12)


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights of a penalized logistic regression by Newton's method; the last one is the intercept.

    With labels of one kind only, or none, the weights are 0 and the intercept is the smoothed rate.
    """
    weights = np.zeros(x.shape[1] + 1)
    rate = (y.sum() + 0.5) / (len(y) + 1.0)
    weights[-1] = logit(np.array(rate))
    if len(y) == 0 or y.min() == y.max():
        return weights
    design = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.full(design.shape[1], penalty)
    ridge[-1] = 1e-6

    def loss(w):
        z = design @ w
        return np.logaddexp(0, z).sum() - z @ y + 0.5 * (ridge * w * w).sum()

    best = loss(weights)
    for _ in range(steps):
        p = sigmoid(design @ weights)
        slope = design.T @ (p - y) + ridge * weights
        curve = (design * (p * (1 - p))[:, None]).T @ design + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        size = 1.0
        while size > 1e-4 and (now := loss(weights - size * step)) > best:
            size /= 2
        if size <= 1e-4 or best - now < 1e-7 * max(1.0, abs(best)):
            break
        weights, best = weights - size * step, now
    return weights


def fit_sparse(
    indptr: np.ndarray, indices: np.ndarray, dense: np.ndarray, y: np.ndarray, width: int, penalty: float = 0.01, steps: int = 300
) -> np.ndarray:
    """Like ``fit`` with ``width`` binary features given as rows of indices, before the dense ones.

    Accelerated gradient; weights are ordered binary, dense, intercept.
    """
    n, d = dense.shape
    weights = np.zeros(width + d + 1)
    weights[-1] = logit(np.array((y.sum() + 0.5) / (n + 1.0)))
    if n == 0 or y.min() == y.max():
        return weights
    rows = np.repeat(np.arange(n), np.diff(indptr))
    # Frequent features get smaller steps, so that rare telling ones are learned as fast.
    curvature = np.concatenate([np.bincount(indices, minlength=width), (dense**2).sum(axis=0), [n]]) * 0.25
    per_row = np.sqrt(np.diff(indptr).mean() + d + 1)
    scale = 1.0 / (curvature * per_row + penalty)

    def forward(w):
        return np.bincount(rows, w[indices], minlength=n) + dense @ w[width:-1] + w[-1]

    probe, momentum = weights.copy(), 1.0
    for _ in range(steps):
        error = sigmoid(forward(probe)) - y
        slope = np.concatenate([np.bincount(indices, error[rows], minlength=width), dense.T @ error, [error.sum()]])
        slope[:-1] += penalty * probe[:-1]
        new = probe - scale * slope
        following = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        # Restart when the step turns against the movement.
        if ((probe - new) * (new - weights)).sum() > 0:
            following, momentum = 1.0, 1.0
        probe = new + (momentum - 1) / following * (new - weights)
        weights, momentum = new, following
    return weights
