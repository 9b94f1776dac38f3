"""Small linear models on bounded samples: squared-hinge support vectors, logistic regression, calibrated scores."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def support_vectors(x: np.ndarray, positive: np.ndarray, c: float = 1.0, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise |w|^2 / 2 + c * mean squared hinge, classes weighted alike.

    Newton steps with conjugate gradients over the rows inside the margin; the intercept is weakly regularised.
    """
    n, d = x.shape
    y = np.where(positive, 1.0, -1.0)
    share = np.where(positive, 0.5 / max(positive.sum(), 1), 0.5 / max((~positive).sum(), 1)) * c * n
    shrink = np.append(np.ones(d), 1e-3)
    # products keep the rows' own number type, so that no wider copy of them is made
    times = lambda rows, w: (rows @ w[:d].astype(x.dtype)).astype(float) + w[d]
    back = lambda rows, v: np.append((v.astype(x.dtype) @ rows).astype(float), v.sum())
    loss = lambda w, gap: 0.5 * (shrink * w * w).sum() + 0.5 * (share * np.maximum(0, gap) ** 2).sum()
    w = np.zeros(d + 1)
    gap = 1 - y * times(x, w)
    now = loss(w, gap)
    for _ in range(rounds):
        inside = gap > 0
        rows, weight = x if inside.all() else x[inside], share[inside]
        slope = shrink * w - back(rows, weight * y[inside] * gap[inside])
        if np.linalg.norm(slope) < 1e-5 * max(1.0, now):
            break
        step, left = np.zeros(d + 1), -slope
        to, size = left.copy(), left @ left
        for _ in range(50):
            curved = shrink * to + back(rows, weight * times(rows, to))
            by = size / (to @ curved)
            step += by * to
            left -= by * curved
            if (after := left @ left) < 1e-8 * (slope @ slope):
                break
            to, size = left + after / size * to, after
        far = 1.0
        while far > 1e-6:
            ahead = 1 - y * times(x, w + far * step)
            if loss(w + far * step, ahead) <= now + 1e-4 * far * (slope @ step):
                break
            far /= 2
        else:
            break
        w, gap = w + far * step, ahead
        now = loss(w, gap)
    return w[:d], float(w[d])


def logistic(x: np.ndarray, target: np.ndarray, ridge: float = 1.0, rounds: int = 100) -> tuple[np.ndarray, float]:
    """Weights and intercept of ridge logistic regression; targets from 0 to 1. Newton steps in the span of the rows."""
    n = len(x)
    gram = x @ x.T  # few rows, many columns: weights are x.T @ a
    a, b = np.zeros(n), 0.0
    for _ in range(rounds):
        p = sigmoid(gram @ a + b)
        h = np.maximum(p * (1 - p), 1e-6)
        # solve for the new a and b: (gram + ridge / h) a + b = z, sum(a) = 0
        z = gram @ a + b + (target - p) / h
        system = np.zeros((n + 1, n + 1))
        system[:n, :n] = gram + np.diag(ridge / h)
        system[:n, n] = system[n, :n] = 1.0
        solved = np.linalg.solve(system, np.append(z, 0.0))
        moved = np.abs(solved[:n] - a).max(initial=0.0)
        a, b = solved[:n], float(solved[n])
        if moved < 1e-9:
            break
    return x.T @ a, b


def calibrated(margin: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """Slope and intercept that turn margins into probabilities, with softened targets and a positive slope."""
    p, q = int(positive.sum()), int((~positive).sum())
    target = np.where(positive, (p + 1) / (p + 2), 1 / (q + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        s = sigmoid(a * margin + b)
        g = np.array([((s - target) * margin).sum() + 1e-6 * a, (s - target).sum()])
        h = np.maximum(s * (1 - s), 1e-9)
        m = np.array([[(h * margin * margin).sum() + 1e-6, (h * margin).sum()], [(h * margin).sum(), h.sum() + 1e-6]])
        step = np.clip(np.linalg.solve(m, g), -2, 2)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return max(float(a), 1e-3), float(b)
