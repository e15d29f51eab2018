"""Logistic calibration of a few numbers per document, fitted on a bounded number of rows."""

from __future__ import annotations

import numpy as np


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> dict:
    """Weights of a logistic regression by Newton steps on standardised columns.

    Without rows the score is 0.5; with one class only it is that class's smoothed share."""
    if not len(y) or len(set(y.tolist())) < 2:
        share = (float(np.sum(y)) + 0.5) / (len(y) + 1.0)
        return {"mean": np.zeros(x.shape[1]), "scale": np.ones(x.shape[1]),
                "w": np.concatenate([[np.log(share / (1 - share))], np.zeros(x.shape[1])])}
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-12, scale, 1.0)
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w, penalty = np.zeros(z.shape[1]), np.diag([0.0] + [ridge * len(y)] * x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + penalty + 1e-9 * np.eye(len(w)),
                               z.T @ (y - p) - penalty @ w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return {"mean": mean, "scale": scale, "w": w}


def apply_logistic(model: dict, x: np.ndarray) -> np.ndarray:
    """Scores of rows.  Columns are added one by one, in their order: a matrix product may round a row
    differently in another batch."""
    z = np.clip((x - model["mean"]) / model["scale"], -20, 20)
    total = np.full(len(x), model["w"][0])
    for column, weight in zip(z.T, model["w"][1:]):
        total = total + column * weight
    return 1 / (1 + np.exp(-np.clip(total, -30, 30)))
