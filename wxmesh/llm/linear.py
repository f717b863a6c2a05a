"""Linear models fitted in numpy on a bounded sample, and the sample itself.

A fit sees at most ``cap`` rows of each class (a documented parameter of every
operator that uses it), chosen by a hash of the id over all labelled rows.
What is broadcast to the scoring tasks is a weight matrix of a fixed size.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bounded_rows(rows: DataFrame, cap: int, key: Column) -> DataFrame:
    """The ``cap`` rows with the smallest hash of ``key``: a top-k, of which each task sends at most ``cap`` rows."""
    return rows.orderBy(F.xxhash64(key), key).limit(cap)


def bounded_sample(labelled: DataFrame, label: str, cap: int, key: Column, values=(0, 1)) -> DataFrame:
    """``bounded_rows`` of each label among ``values``."""
    return reduce(DataFrame.unionByName, [bounded_rows(labelled.filter(F.col(label) == v), cap, key) for v in values])


def bounded_classes(labelled: DataFrame, label: str, cap: int, key: Column) -> DataFrame:
    """At most ``cap`` rows of each label, where the labels are not known beforehand.

    The rows with the smallest hash of ``key``; the size of a label says below
    which hash about three times ``cap`` of its rows lie, and only those are
    ranked, so a label that holds most rows sends few of them on.
    """
    size = labelled.groupBy(F.col(label).alias("_label")).agg(F.count(F.lit(1)).alias("_n"))  # one row per label
    hashed = labelled.withColumn("_hash", F.shiftrightunsigned(F.xxhash64(key), 32))
    near = hashed.join(F.broadcast(size), F.col(label) == F.col("_label")) \
        .filter(F.col("_hash") * F.col("_n") <= F.lit(3 * cap) * F.lit(float(1 << 32)))
    order = Window.partitionBy(label).orderBy("_hash", key)
    return (near.withColumn("_rank", F.row_number().over(order))
            .filter(F.col("_rank") <= cap).drop("_rank", "_hash", "_label", "_n"))


def minimise(gradient, start: np.ndarray, steps: int, rate: float) -> np.ndarray:
    """Full-batch Adam with a linearly falling step; ``gradient(w)`` gives dloss/dw."""
    w, m, v = start.astype(np.float64), np.zeros_like(start, np.float64), np.zeros_like(start, np.float64)
    for t in range(1, steps + 1):
        g = gradient(w)
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        w = w - rate * (1 - t / (steps + 1)) * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-9)
    return w


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_logistic(x: np.ndarray, target: np.ndarray, weight: np.ndarray | None = None, l2: float = 1e-4,
                 steps: int = 250, rate: float = 0.1) -> np.ndarray:
    """Logistic regression; ``target`` may be a probability. The last weight is the bias."""
    weight = np.ones(len(x)) if weight is None else weight
    weight = (weight / weight.sum()).astype(np.float64)

    def gradient(w):
        err = (sigmoid(x @ w[:-1].astype(x.dtype) + w[-1]) - target) * weight
        return np.append(x.T @ err.astype(x.dtype) + l2 * w[:-1], err.sum())

    return minimise(gradient, np.zeros(x.shape[1] + 1), steps, rate)


def fit_svm(x: np.ndarray, sign: np.ndarray, l2: float = 1e-4, steps: int = 250, rate: float = 0.1) -> np.ndarray:
    """Linear support vector machine (squared hinge), classes balanced. The last weight is the bias."""
    weight = np.where(sign > 0, 0.5 / max(1, (sign > 0).sum()), 0.5 / max(1, (sign < 0).sum()))

    def gradient(w):
        slack = np.maximum(0, 1 - sign * (x @ w[:-1].astype(x.dtype) + w[-1]))
        err = -2 * slack * sign * weight
        return np.append(x.T @ err.astype(x.dtype) + l2 * w[:-1], err.sum())

    return minimise(gradient, np.zeros(x.shape[1] + 1), steps, rate)


def fit_platt(margin: np.ndarray, target: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn margins into calibrated probabilities."""
    scale = max(1e-6, float(np.abs(margin).mean()))
    w = fit_logistic((margin / scale)[:, None], target, l2=1e-6, steps=300, rate=0.1)
    return float(w[0] / scale), float(w[1])
