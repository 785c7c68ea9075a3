"""Projection on the simplex and minimisation over it."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.operators.linear import gram, terms_of
from lodestat.operators.ordering import running_total
from lodestat.session import per_group


def project_simplex(df: DataFrame, value: str, by: list[str], total: float = 1.0, name: str = "projected") -> DataFrame:
    """Euclidean projection of each group's vector on the simplex of sum ``total``.

    The threshold comes from distinct values with their counts in descending order, so
    neither a large group nor many equal entries sit in one task.
    """
    counts = df.groupBy(*by, F.col(value).cast("double").alias("_y")).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_ny", F.col("_n") * F.col("_y"))
    order = [F.desc("_y")]
    s = running_total(running_total(counts, "_n", order, by, "_i"), "_ny", order, by, "_s")
    tau = (F.col("_s") - total) / F.col("_i")
    best = s.filter(F.col("_y") > tau).groupBy(*by).agg(F.max_by(tau, "_i").alias("_tau"))
    if by:
        return df.join(per_group(best), by).withColumn(name, F.greatest(F.col(value) - F.col("_tau"), F.lit(0.0))).drop("_tau")
    return df.withColumn(name, F.greatest(F.col(value) - best.select("_tau").scalar(), F.lit(0.0)))


def project_vector(y: np.ndarray, total: float = 1.0) -> np.ndarray:
    """The same for one short vector."""
    u = np.sort(y)[::-1]
    tau = (np.cumsum(u) - total) / np.arange(1, len(u) + 1)
    return np.maximum(y - tau[np.flatnonzero(u > tau)[-1]], 0.0)


Oracle = Callable[[np.ndarray], tuple[float, np.ndarray]]


def squared_loss(df: DataFrame, features: list[str], y: str) -> Oracle:
    """Half mean squared error and its gradient, from the second moments: one pass in all."""
    g = gram(df, terms_of(features), F.col(y))
    second = g.s / g.n + np.outer(g.mean, g.mean)
    a, c, yy = second[:-1, :-1], second[:-1, -1], float(second[-1, -1])

    def call(w):
        return float((w @ a @ w - 2 * w @ c + yy) / 2), a @ w - c
    return call


def logistic_loss(df: DataFrame, features: list[str], y: str) -> Oracle:
    """Mean logistic loss of 0/1 labels and its gradient; one pass per call."""
    def call(w):
        z = F.lit(0.0)
        for f, v in zip(features, w):
            z = z + F.col(f) * float(v)
        d = df.select(z.alias("_z"), F.col(y).cast("double").alias("_y"), *features)
        p = 1 / (1 + F.exp(-F.col("_z")))
        loss = F.greatest(F.col("_z"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("_z"))) - F.col("_y") * F.col("_z")
        r = d.agg(F.avg(loss).alias("loss"), *[F.avg((p - F.col("_y")) * F.col(f)).alias(f"g{i}") for i, f in enumerate(features)]).first()
        return float(r["loss"]), np.array([r[f"g{i}"] for i in range(len(features))])
    return call


def minimise_on_simplex(oracle: Oracle, dims: int, method: str = "frank_wolfe", steps: int = 50, gap_tol: float = 1e-6, total: float = 1.0):
    """Minimises over {w >= 0, sum w = total}; returns (w, history of (step, loss, gap)).

    ``frank_wolfe``, ``away`` and ``pairwise`` use steps 2/(t+2), cut at the longest step that
    stays inside; ``projected`` halves its step until the loss drops enough.  The weights of
    the vertices are the coordinates themselves, so every step keeps them consistent.
    """
    w = np.zeros(dims)
    w[0] = total
    loss, g = oracle(w)
    history = []
    for t in range(steps):
        to = int(np.argmin(g))
        towards = -w.copy()
        towards[to] += total
        gap = float(-g @ towards)
        history.append((t, loss, gap))
        if gap <= gap_tol:
            break
        if method == "projected":
            w, loss, g = _backtracked(oracle, w, loss, g, total)
            continue
        step = 2.0 / (t + 2)
        used = np.flatnonzero(w > 1e-15)
        worst = int(used[np.argmax(g[used])])
        if method == "frank_wolfe":
            d, longest = towards, 1.0
        elif method == "away":
            away = w.copy()
            away[worst] -= total
            share = w[worst] / total
            if gap >= float(-g @ away) or share >= 1 - 1e-15:
                d, longest = towards, 1.0
            else:
                d, longest = away, share / (1 - share)
        elif method == "pairwise":
            d = np.zeros(dims)
            d[to] += total
            d[worst] -= total
            longest = w[worst] / total
        else:
            raise ValueError(f"unknown method {method}")
        w = np.maximum(w + min(step, longest) * d, 0.0)
        w *= total / w.sum()
        loss, g = oracle(w)
    return w, history


def _backtracked(oracle, w, loss, g, total, shrink=0.5, share=0.5):
    step = 1.0
    while True:
        new = project_vector(w - step * g, total)
        l2, g2 = oracle(new)
        if l2 <= loss + share * float(g @ (new - w)) or step < 1e-12:
            return new, l2, g2
        step *= shrink


def simplex_regression(df: DataFrame, features: list[str], y: str, method: str = "frank_wolfe", steps: int = 50, loss: str = "squared", total: float = 1.0):
    """Weights on the simplex that fit ``y`` best: one pass for squared loss, one per step for logistic."""
    make = logistic_loss if loss == "logistic" else squared_loss
    return minimise_on_simplex(make(df, features, y), len(features), method, steps, total=total)


def is_on_simplex(w, total: float = 1.0) -> bool:
    return bool(min(w) >= 0 and math.isclose(sum(w), total, abs_tol=1e-9))
