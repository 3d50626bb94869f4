"""Logistic regression on a bounded sample of labelled rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded(rows: DataFrame, key: str, label: str, most: int) -> DataFrame:
    """At most about ``most`` rows of each label, chosen by a hash of ``key``; all of them where there are fewer.

    Column ``weight`` says how many rows of its label each one stands for, so that a fit keeps the ratio of the labels.
    """
    counts = {r[label]: r["c"] for r in rows.where(F.col(label).isin(0, 1)).groupBy(label).agg(F.count("*").alias("c")).collect()}
    place = F.pmod(F.xxhash64(key), F.lit(1 << 20))
    share = {y: max(1, int((1 << 20) * min(1.0, most / max(1, counts.get(y, 0))))) for y in (0, 1)}
    of_label = lambda values: F.when(F.col(label) == 1, values[1]).when(F.col(label) == 0, values[0])
    return rows.where(place < of_label(share)).withColumn("weight", of_label({y: (1 << 20) / n for y, n in share.items()}))


def matrix(rows: list) -> np.ndarray:
    """Rows of equal length as a matrix; none make one without columns."""
    return np.array(rows, dtype=float) if rows else np.zeros((0, 0))


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights (intercept first) on features shifted and scaled by the other two arrays; one label only gives its own rate.

    ``counts`` are the numbers of rows that each row stands for, one by default.
    """
    if len(y) == 0 or y.min() == y.max():
        rate = 0.5 if len(y) == 0 else (y.sum() + 0.5) / (len(y) + 1)
        width = x.shape[1] if x.ndim == 2 else 0
        return np.r_[np.log(rate / (1 - rate)), np.zeros(width)], np.zeros(width), np.ones(width)
    counts = np.ones(len(y)) if counts is None else counts
    shift = np.average(x, axis=0, weights=counts)
    scale = np.maximum(np.sqrt(np.average((x - shift) ** 2, axis=0, weights=counts)), 1e-3)
    z = np.c_[np.ones(len(x)), (x - shift) / scale]
    w = np.zeros(z.shape[1])
    penalty = np.diag([1e-6, *[ridge] * x.shape[1]])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (counts * p * (1 - p))[:, None]).T @ z + penalty, z.T @ (counts * (y - p)) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w, shift, scale


def logit(x: np.ndarray, model: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    w, shift, scale = model
    return np.clip(w[0] + ((x - shift) / scale) @ w[1:], -30, 30)
