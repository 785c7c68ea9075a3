"""K-means with group fairness.

Centres are K small rows, so they travel as literals in the assignment
expression: assigning points never shuffles.  Each round is one combinable
aggregation to K x groups rows.
"""

from __future__ import annotations

import math
import time

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.functions.vectors import l1_distance, squared_distance

Centres = list[list[float]]

# Above this many terms the unrolled distance would not compile; fold arrays instead.
UNROLL_LIMIT = 600


def _folded(metric: str, centre: list[float]):
    c = F.array(*[F.lit(float(v)) for v in centre])
    diff = F.zip_with("features", c, lambda a, b: a - b)
    each = (lambda d: F.abs(d)) if metric == "l1" else (lambda d: d * d)
    return F.aggregate(diff, F.lit(0.0), lambda s, d: s + each(d))


def assign(points: DataFrame, centres: Centres, metric: str = "l2") -> DataFrame:
    """Adds ``cluster`` (nearest centre, first index on ties) and ``dist`` (squared L2, or L1)."""
    if len(centres) * len(centres[0]) > UNROLL_LIMIT:
        dists = [_folded(metric, c) for c in centres]
    else:
        fn = l1_distance if metric == "l1" else squared_distance
        dists = [fn(F.col("features"), c) for c in centres]
    options = [F.struct(d.alias("dist"), F.lit(k).alias("cluster")) for k, d in enumerate(dists)]
    best = F.least(*options) if len(options) > 1 else options[0]
    return points.withColumn("_best", best).select("*", "_best.cluster", "_best.dist").drop("_best")


def seed_centres(points: DataFrame, k: int, seed: int = 1) -> Centres:
    """k-means|| seeds: the library fit with zero iterations."""
    return ml_lloyd(points, k, 0, seed)


def ml_lloyd(points: DataFrame, k: int, rounds: int, seed: int = 1) -> Centres:
    """Library k-means with parallel seeding and a fixed number of rounds."""
    data = points.select(array_to_vector("features").alias("features"))
    model = KMeans(k=k, maxIter=rounds, initMode="k-means||", tol=0.0, seed=seed).fit(data)
    return [list(map(float, c)) for c in model.clusterCenters()]


def lloyd(points: DataFrame, centres: Centres, rounds: int, metric: str = "l2") -> Centres:
    """Plain rounds from given centres; an empty cluster keeps its centre."""
    dims = range(len(centres[0]))
    for _ in range(rounds):
        rows = (assign(points, centres, metric).groupBy("cluster")
                .agg(*[F.avg(F.col("features")[i]).alias(f"m{i}") for i in dims]).collect())
        new = {r["cluster"]: [r[f"m{i}"] for i in dims] for r in rows}
        centres = [new.get(k, c) for k, c in enumerate(centres)]
    return centres


def centres_frame(spark, centres: Centres) -> DataFrame:
    return spark.createDataFrame([(k, [float(v) for v in c]) for k, c in enumerate(centres)], "cluster int, centre array<double>")


def objective(points: DataFrame, centres: Centres) -> DataFrame:
    """Mean squared distance to the nearest centre."""
    return assign(points, centres).agg(F.avg("dist").alias("objective"))


def fair_objective(points: DataFrame, centres: Centres) -> DataFrame:
    """The largest of the groups' mean squared distances."""
    return assign(points, centres).groupBy("grp").agg(F.avg("dist").alias("m")).agg(F.max("m").alias("objective"))


def group_sizes(points: DataFrame, centres: Centres, groups: list[str]) -> DataFrame:
    """(cluster, centre, one count column per group), zero where a group is absent."""
    counts = assign(points, centres).groupBy("cluster").agg(*[F.count_if(F.col("grp") == g).alias(f"n_{g}") for g in groups])
    full = centres_frame(points.sparkSession, centres).join(counts, "cluster", "left")
    return full.fillna(0, [f"n_{g}" for g in groups])


def cluster_group_sums(points: DataFrame, centres: Centres, metric: str = "l2") -> DataFrame:
    """(cluster, grp, n, s0.., q): per cluster and group the count, coordinate sums and squared
    norms, all taken relative to the cluster's centre so that they do not cancel."""
    dims = range(len(centres[0]))
    spread = F.create_map(*[x for k, c in enumerate(centres) for x in (F.lit(k), F.array(*[F.lit(float(v)) for v in c]))])
    rel = assign(points, centres, metric).withColumn("_c", spread[F.col("cluster")])
    offs = [(F.col("features")[i] - F.col("_c")[i]) for i in dims]
    square = sum((o * o for o in offs), F.lit(0.0))
    return rel.groupBy("cluster", "grp").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(o).alias(f"s{i}") for i, o in enumerate(offs)], F.sum(square).alias("q"))


def fair_parameters(rows: list, centres: Centres, groups: tuple[str, str] = ("A", "B")) -> dict:
    """Shares, group means, their distance and the in-group residuals, from K x 2 summary rows.

    A group absent from a cluster takes the other group's mean; an empty cluster its old centre.
    Any other group raises.
    """
    k, d = len(centres), len(centres[0])
    n = np.zeros((2, k))
    mu = np.full((2, k, d), np.nan)
    resid = np.zeros(2)
    for r in rows:
        if r["grp"] not in groups:
            raise ValueError(f"group {r['grp']!r} is neither of {groups}")
        g, c = groups.index(r["grp"]), r["cluster"]
        s = np.array([r[f"s{i}"] for i in range(d)])
        n[g, c] = r["n"]
        mu[g, c] = np.array(centres[c]) + s / r["n"]
        resid[g] += max(r["q"] - float(s @ s) / r["n"], 0.0)
    for g in (0, 1):
        gap = np.isnan(mu[g]).any(axis=1)
        mu[g][gap] = mu[1 - g][gap]
        gap = np.isnan(mu[g]).any(axis=1)
        mu[g][gap] = np.array(centres)[gap]
    mu[0][np.isnan(mu[0])] = mu[1][np.isnan(mu[0])]
    total = n.sum(axis=1)
    share = np.divide(n, total[:, None], out=np.zeros_like(n), where=total[:, None] > 0)
    fixed = np.divide(resid, total, out=np.zeros(2), where=total > 0)
    return {"alpha": share[0], "beta": share[1], "mu_a": mu[0], "mu_b": mu[1],
            "ell": np.linalg.norm(mu[0] - mu[1], axis=1), "fixed_a": float(fixed[0]), "fixed_b": float(fixed[1])}


def _offsets(p: dict, gamma: float) -> np.ndarray:
    """Best distances from the first group's means when its objective weighs ``gamma``."""
    mine, other = gamma * p["alpha"], (1 - gamma) * p["beta"]
    both = mine + other
    return np.divide(other * p["ell"], both, out=np.zeros_like(both), where=both > 0)


def _lead(p: dict, gamma: float) -> float:
    """First group's objective less the second's; falls as ``gamma`` grows."""
    x = _offsets(p, gamma)
    return p["fixed_a"] - p["fixed_b"] + float(p["alpha"] @ x ** 2 - p["beta"] @ (p["ell"] - x) ** 2)


def balance(p: dict, tol: float = 1e-12) -> np.ndarray:
    """Distance of each new centre from the first group's mean at which both groups'
    objectives meet, or come nearest when one stays above the other."""
    low, high = 0.0, 1.0
    if _lead(p, low) <= 0:
        return _offsets(p, low)
    if _lead(p, high) >= 0:
        return _offsets(p, high)
    while high - low > tol:
        mid = (low + high) / 2
        low, high = (mid, high) if _lead(p, mid) > 0 else (low, mid)
    return _offsets(p, (low + high) / 2)


def shifted_centres(p: dict, x: np.ndarray) -> Centres:
    """Points on the segment between the two group means at distance ``x`` from the first."""
    ell = p["ell"]
    t = np.where(ell > 0, x / np.where(ell > 0, ell, 1.0), 0.0)[:, None]
    return ((1 - t) * p["mu_a"] + t * p["mu_b"]).tolist()


def fair_lloyd(points: DataFrame, k: int, rounds: int, metric: str = "l2", seeds: Centres | None = None,
               groups: tuple[str, str] = ("A", "B"), seed: int = 1) -> Centres:
    """Fair rounds from k-means|| seeds (or given ones).  Zero rounds return the seeds."""
    centres = seeds or seed_centres(points, k, seed)
    for _ in range(rounds):
        p = fair_parameters(cluster_group_sums(points, centres, metric).collect(), centres, groups)
        centres = shifted_centres(p, balance(p))
    return centres


def timed(label: str, fn):
    """(result, (label, seconds)) of a call that runs its own actions."""
    t0 = time.perf_counter()
    out = fn()
    return out, (label, time.perf_counter() - t0)


def compare_report(points: DataFrame, k: int, rounds: int, seed: int = 1) -> DataFrame:
    """Fair objective of standard and of fair centres with the four wall-clock times."""
    spark = points.sparkSession
    points = points.persist()
    try:
        std, t1 = timed("ms_standard", lambda: ml_lloyd(points, k, rounds, seed))
        fair, t2 = timed("ms_fair", lambda: fair_lloyd(points, k, rounds, seed=seed))
        phi_std, t3 = timed("ms_objective_standard", lambda: fair_objective(points, std).first()[0])
        phi_fair, t4 = timed("ms_objective_fair", lambda: fair_objective(points, fair).first()[0])
    finally:
        points.unpersist()
    times = {name: 1000 * s for name, s in (t1, t2, t3, t4)}
    return spark.createDataFrame([{"phi_standard": phi_std, "phi_fair": phi_fair, **times}])
