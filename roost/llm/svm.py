"""Small linear models, fitted on bounded samples."""

from __future__ import annotations

import numpy as np


def fit_svm(x: np.ndarray, y: np.ndarray, penalty: float, weight: np.ndarray | None = None) -> np.ndarray:
    """Linear support vector machine with squared hinge loss; the last weight is the bias.

    ``y`` is -1 or 1. Newton steps on the rows inside the margin, in the space of the rows
    if there are fewer of them than columns.
    """
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    weight = np.ones(len(x)) if weight is None else weight
    w = np.zeros(x.shape[1])
    inside = np.ones(len(x), bool)
    for _ in range(30):
        a, b, c = x[inside], y[inside], weight[inside]
        if len(a) < x.shape[1]:
            dual = np.linalg.solve(a @ a.T + np.diag(penalty / c), b)
            w = a.T @ dual
        else:
            w = np.linalg.solve((a.T * c) @ a + penalty * np.eye(x.shape[1]), a.T @ (c * b))
        now = y * (x @ w) < 1
        if not now.any() or (now == inside).all():
            break
        inside = now
    return w


def fit_logistic(
    x: np.ndarray, y: np.ndarray, penalty: float, bias_penalty: float = 1e-4
) -> np.ndarray:
    """Logistic regression on 0 or 1; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float64)
    held = np.full(x.shape[1], penalty)
    held[-1] = bias_penalty
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = sigmoid(x @ w)
        slope = x.T @ (p - y) + held * w
        curve = (p * (1 - p)).clip(1e-6)
        if len(x) < x.shape[1]:  # solve in the space of the rows
            scaled = x / held
            inner = np.diag(1 / curve) + scaled @ x.T
            step = slope / held - scaled.T @ np.linalg.solve(inner, x @ (slope / held))
        else:
            step = np.linalg.solve((x.T * curve) @ x + np.diag(held), slope)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
