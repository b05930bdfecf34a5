"""Ridge logistic regression toward a prior, on a bounded sample in memory."""

from __future__ import annotations

import numpy as np


def fit(x: np.ndarray, y: np.ndarray, prior: np.ndarray, strength: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights (last: intercept) that fit ``y`` in {0, 1}, drawn to ``prior``; no rows: the prior.

    Newton steps, halved until the penalised likelihood grows.
    """
    w = np.asarray(prior, np.float64).copy()
    if not len(y):
        return w
    a = np.hstack([np.asarray(x, np.float64).reshape(len(y), len(w) - 1), np.ones((len(y), 1))])
    pull = np.full(len(w), strength)
    pull[-1] = 1e-3 * strength

    def loss(v):
        z = a @ v
        return np.sum(np.logaddexp(0, z) - y * z) + 0.5 * np.sum(pull * (v - prior) ** 2)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -500, 500)))
        grad = a.T @ (p - y) + pull * (w - prior)
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(pull), grad)
        size, now = 1.0, loss(w)
        while size > 1e-6 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w


def fit_ordered(
    x: np.ndarray, y: np.ndarray, prior: np.ndarray, below: list[tuple[int, int]], strength: float = 1.0
) -> np.ndarray:
    """As :func:`fit`, but no weight is negative and ``w[a] <= w[b]`` for every (a, b) in ``below``.

    Weights that would break the order are pooled: they get one common weight;
    a negative one becomes 0, with those that must be below it.
    """
    k = len(prior) - 1
    x = np.asarray(x, np.float64).reshape(len(y), k)
    pool, none = list(range(k)), set()
    while True:
        names = [g for g in dict.fromkeys(pool) if g not in none]
        at = [[i for i in range(k) if pool[i] == g] for g in names]
        cols = np.stack([x[:, i].sum(axis=1) for i in at], axis=1) if at else np.zeros((len(y), 0))
        got = fit(cols, y, np.array([*(np.mean(prior[i]) for i in at), prior[-1]]), strength)
        w = np.zeros(k + 1)
        for i, v in zip(at, got):
            w[i] = v
        w[-1] = got[-1]
        negative = [g for g, v in zip(names, got) if v < 0]
        wrong = max(below, key=lambda e: w[e[0]] - w[e[1]], default=None)
        if negative:
            none.update(negative)
        elif wrong is not None and w[wrong[0]] > w[wrong[1]] + 1e-12:
            low, high = pool[wrong[0]], pool[wrong[1]]
            if high in none:
                none.add(low)
            else:
                pool = [high if g == low else g for g in pool]
        else:
            return w
