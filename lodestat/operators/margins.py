"""Linear and landmark-kernel support vector machines, many at once, with a duality gap as the stop.

The model minimises ``strength / 2 * |w|^2 + mean(max(0, 1 - y * w.x))`` with a constant 1 as the
last component of x.  Each round is one aggregation for all models together: the hinge loss
and its subgradient, a sum of p numbers, at the present weights.  The driver keeps these as
cutting planes and minimises their maximum plus the norm over the planes' simplex.  That value
is a lower bound of the optimum, so best loss minus bound is a proven gap; a fit that does not
reach its tolerance raises an error.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.operators.frames import row_hash
from lodestat.session import held


class NotConverged(RuntimeError):
    """A fit that stayed above its tolerance."""


def _on_simplex(q: np.ndarray, c: np.ndarray, start: np.ndarray, rounds: int = 4000) -> np.ndarray:
    """Maximises ``c.a - a.q.a / 2`` over the simplex by moving mass between the best and the worst coordinate."""
    a, g = start.copy(), c - q @ start
    for _ in range(rounds):
        up = int(g.argmax())
        held = np.flatnonzero(a > 0)
        down = held[int(g[held].argmin())]
        lead = g[up] - g[down]
        if lead <= 1e-13 * max(1.0, abs(g).max()):
            break
        curve = q[up, up] - 2 * q[up, down] + q[down, down]
        step = min(a[down], lead / curve if curve > 1e-300 else a[down])
        a[up] += step
        a[down] -= step
        g -= step * (q[:, up] - q[:, down])
    return a


class _Bundle:
    """Cutting planes of one model."""

    def __init__(self, strength: float, p: int):
        self.strength, self.planes, self.offsets, self.a = strength, np.zeros((0, p)), np.zeros(0), np.zeros(0)
        self.w, self.best, self.best_w, self.bound = np.zeros(p), np.inf, np.zeros(p), -np.inf

    def add(self, loss: float, slope: np.ndarray) -> None:
        """Loss and subgradient of the mean hinge at ``w``."""
        value = loss + self.strength / 2 * float(self.w @ self.w)
        if value < self.best:
            self.best, self.best_w = value, self.w.copy()
        self.planes = np.vstack([self.planes, slope])
        self.offsets = np.append(self.offsets, loss - float(slope @ self.w))
        q = self.planes @ self.planes.T / self.strength
        start = np.append(self.a, 0.0) if len(self.a) else np.ones(1)
        self.a = _on_simplex(q, self.offsets, start)
        self.w = -(self.a @ self.planes) / self.strength
        self.bound = max(self.bound, float(self.offsets @ self.a - self.a @ q @ self.a / 2))
        kept = self.a > 0
        kept[-1] = True
        if len(kept) > 200:  # planes without mass add nothing to the present bound
            self.planes, self.offsets, self.a = self.planes[kept], self.offsets[kept], self.a[kept]

    @property
    def gap(self) -> float:
        return self.best - self.bound


def fit(df: DataFrame, vector: str, label: str, strengths: dict[str, float], by: str | None = None, tolerance: float = 1e-3, rounds: int = 500) -> dict[str, dict]:
    """``{model: {w, objective, gap, rounds}}`` of each value of ``by`` (one model "" without it).

    ``vector``: array column of equal lengths; ``label`` is 0 or 1; ``strengths``: the weight of
    the norm by model.  Weights end with the constant's.
    """
    key = F.col(by).cast("string") if by else F.lit("")
    rows = df.select(key.alias("model"), (F.col(label).cast("double") * 2 - 1).alias("y"), F.concat(F.col(vector).cast("array<double>"), F.array(F.lit(1.0))).alias("x"))
    p = rows.select(F.max(F.size("x"))).first()[0] or 1
    bundles = {k: _Bundle(s, p) for k, s in strengths.items()}
    if any(s <= 0 for s in strengths.values()):
        raise ValueError("the norm needs a positive weight")
    live, used = set(bundles), dict.fromkeys(bundles, 0)
    for _ in range(rounds):
        model = held(df.sparkSession, [(k, bundles[k].w.tolist()) for k in sorted(live)], "model string, w array<double>")
        margin = F.aggregate(F.zip_with("x", "w", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
        at = rows.join(model, "model").withColumn("short", 1 - F.col("y") * margin)
        inside = F.col("short") > 0
        sums = at.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(inside, F.col("short")).otherwise(0.0)).alias("loss"),
                                       *[F.sum(F.when(inside, -F.col("y") * F.get("x", F.lit(j))).otherwise(0.0)).alias(f"g{j}") for j in range(p)])
        got = {r["model"]: r for r in sums.collect()}  # a row per model
        for k in list(live):
            if k not in got:  # no rows: the zero model is the optimum
                bundles[k].best = bundles[k].bound = 0.0
                live.discard(k)
                continue
            r = got[k]
            bundles[k].add(r["loss"] / r["n"], np.array([r[f"g{j}"] for j in range(p)]) / r["n"])
            used[k] += 1
            if bundles[k].gap <= tolerance * max(1e-3, abs(bundles[k].best)):
                live.discard(k)
        if not live:
            break
    if live:
        raise NotConverged(f"{len(live)} models above the tolerance after {rounds} rounds, worst gap {max(bundles[k].gap for k in live):.2e}")
    return {k: {"w": b.best_w, "objective": b.best, "gap": max(0.0, b.gap), "rounds": used[k]} for k, b in bundles.items()}


def margins(df: DataFrame, vector: str, models: dict[str, dict], by: str | None = None) -> DataFrame:
    """Adds ``score``, the signed margin under each row's model; rows without a model are left out."""
    key = F.col(by).cast("string") if by else F.lit("")
    table = held(df.sparkSession, [(k, m["w"].tolist()) for k, m in models.items()], "_model string, _w array<double>")
    x = F.concat(F.col(vector).cast("array<double>"), F.array(F.lit(1.0)))
    score = F.aggregate(F.zip_with(x, F.col("_w"), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    return df.withColumn("_model", key).join(table, "_model").withColumn("score", score).drop("_w", "_model")


def landmarks(df: DataFrame, vector: str, key: str, count: int = 64) -> np.ndarray:
    """``count`` distinct vectors, chosen by a hash of the key: the bounded sample a kernel map rests on."""
    rows = df.select(F.col(vector).cast("array<double>").alias("x"), row_hash(F.col(key)).alias("h"), F.col(key).alias("k"))
    got = rows.groupBy("x").agg(F.min(F.struct("h", "k")).alias("h")).orderBy("h").limit(count).collect()
    return np.array([r["x"] for r in got], float)


def kernel_map(vector: Column, marks: np.ndarray, width: float) -> Column:
    """Features whose inner products are those of the Gaussian kernel projected on the landmarks."""
    gram = np.exp(-0.5 * ((marks[:, None, :] - marks[None, :, :]) ** 2).sum(2) / width**2)
    values, vectors = np.linalg.eigh(gram)
    kept = values > 1e-10 * values.max()
    root = vectors[:, kept] / np.sqrt(values[kept])

    @F.pandas_udf("array<double>")
    def mapped(x: pd.Series) -> pd.Series:
        out = []
        for at in range(0, len(x), 4096):
            block = np.stack(x.iloc[at:at + 4096].to_numpy())
            far = (block**2).sum(1)[:, None] + (marks**2).sum(1)[None, :] - 2 * block @ marks.T
            out += list(np.exp(-0.5 * np.maximum(far, 0) / width**2) @ root)
        return pd.Series(out, index=x.index, dtype=object)

    return mapped(vector)
