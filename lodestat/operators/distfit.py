"""Maximum-likelihood fits of discrete distributions to degree sequences.

A fit sees its data only through five sums, so the data pass is one combinable
aggregation per group and the optimiser runs on one row per group.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestat.functions.special import minimise, power_sums, zeta

MODELS = ("geometric", "poisson", "zeta2", "zeta", "zeta_truncated", "altmann")
# Number of free parameters per model.
FREE = {"geometric": 1, "poisson": 1, "zeta2": 0, "zeta": 1, "zeta_truncated": 2, "altmann": 2}

_EXACT = 16
# Support points generated together.
_SUPPORT = 10_000


def log_factorial(k: Column) -> Column:
    """ln k! from a short table, then Stirling's series; exact to double precision."""
    table = F.array(*[F.lit(math.lgamma(i + 1)) for i in range(_EXACT)])
    x = (k + 1).cast("double")
    series = (x - 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x ** 3) + 1 / (1260 * x ** 5) - 1 / (1680 * x ** 7)
    return F.when(k < _EXACT, F.get(table, k.cast("int"))).otherwise(series)


def sufficient_stats(degrees: DataFrame, by: list[str]) -> DataFrame:
    """N, M, sum ln k, sum ln k! and the largest k per group; raises on k below one."""
    k = F.col("degree")
    good = F.when(k >= 1, k).otherwise(F.raise_error(F.lit("degrees must be at least 1")).cast("bigint"))
    counts = degrees.groupBy(*by, "degree").agg(F.count(F.lit(1)).alias("c"))
    c = F.col("c")
    return counts.withColumn("degree", good).groupBy(*by).agg(
        F.sum("c").alias("n"), F.sum(c * k).alias("m"), F.sum(c * F.log(k)).alias("sum_log"),
        F.sum(c * log_factorial(k)).alias("sum_log_fact"), F.max(k).alias("k_max"))


def fit_geometric(stats: DataFrame, by: list[str]) -> DataFrame:
    """Closed form q = N/M."""
    n, m = F.col("n").cast("double"), F.col("m").cast("double")
    q = n / m
    rest = F.when(m > n, (m - n) * F.log(1 - q)).otherwise(0.0)
    return stats.select(*by, "n", F.lit("geometric").alias("model"), q.alias("p1"), F.lit(None).cast("double").alias("p2"),
                        (rest + n * F.log(q)).alias("log_lik"))


def fit_zeta2(stats: DataFrame, by: list[str]) -> DataFrame:
    """Exponent fixed at two; nothing to fit."""
    return stats.select(*by, "n", F.lit("zeta2").alias("model"), F.lit(2.0).alias("p1"), F.lit(None).cast("double").alias("p2"),
                        (-2.0 * F.col("sum_log") - F.col("n") * math.log(math.pi ** 2 / 6)).alias("log_lik"))


def poisson_fit(s) -> tuple[float, float, float]:
    mean = s.m / s.n
    if mean <= 1:
        lam = 1e-9
    else:
        lam = mean - 1 if mean < 2 else mean
        for _ in range(100):
            e = math.exp(-lam)
            g = lam / (1 - e) - mean
            slope = (1 - e - lam * e) / (1 - e) ** 2
            step = g / slope
            lam = max(lam - step, 1e-9)
            if abs(step) < 1e-13 * lam:
                break
    ll = s.m * math.log(lam) - s.n * (lam + math.log(-math.expm1(-lam))) - s.sum_log_fact
    return lam, math.nan, ll


def zeta_fit(s) -> tuple[float, float, float]:
    def nll(g):
        return g * s.sum_log + s.n * math.log(zeta(g))
    g = minimise(nll, 1 + 1e-9, 60.0)
    return g, math.nan, -nll(g)


def truncated_fit(s) -> tuple[float, float, float]:
    """The best upper end is the largest value seen, so only the exponent is searched."""
    def nll(g):
        return g * s.sum_log + s.n * math.log(power_sums(g, 0.0, s.k_max)[0])
    g = minimise(nll, 1e-9, 60.0)
    return g, float(s.k_max), -nll(g)


def altmann_fit(s) -> tuple[float, float, float]:
    """Newton steps on (gamma, delta) with delta held at zero when it would go below."""
    def nll(g, d):
        return g * s.sum_log + d * s.m + s.n * math.log(power_sums(g, d, s.n)[0])

    g, d = 1.0, 0.01
    best = nll(g, d)
    for _ in range(200):
        z = power_sums(g, d, s.n, 2)
        e = z / z[0]
        grad = np.array([s.sum_log - s.n * e[1], s.m - s.n * e[2]])
        hess = s.n * np.array([[e[3] - e[1] ** 2, e[4] - e[1] * e[2]], [e[4] - e[1] * e[2], e[5] - e[2] ** 2]])
        step = np.linalg.solve(hess + 1e-12 * np.eye(2), grad)
        if d <= 0 and step[1] > 0:
            step = np.array([grad[0] / hess[0, 0], 0.0])
        t, moved = 1.0, False
        while t > 1e-10:
            g2, d2 = max(g - t * step[0], 1e-9), max(d - t * step[1], 0.0)
            new = nll(g2, d2)
            if new < best - 1e-13 * abs(best):
                moved = True
                break
            t /= 2
        if not moved:
            break
        g, d, best = g2, d2, new
    return g, d, -best


_SEARCHED = {"poisson": poisson_fit, "zeta": zeta_fit, "zeta_truncated": truncated_fit, "altmann": altmann_fit}


def fit_searched(stats: DataFrame, by: list[str], models) -> DataFrame:
    """Fits that need a search, on one row per group."""
    names = [m for m in models if m in _SEARCHED]
    fields = {f.name: f.dataType.simpleString() for f in stats.schema}
    schema = ", ".join(f"{b} {fields[b]}" for b in by) + ", n bigint, model string, p1 double, p2 double, log_lik double"

    def run(frames):
        for pdf in frames:
            out = []
            for s in pdf.itertuples(index=False):
                for name in names:
                    p1, p2, ll = _SEARCHED[name](s)
                    out.append((*[getattr(s, b) for b in by], s.n, name, p1, None if math.isnan(p2) else p2, ll))
            yield pd.DataFrame(out, columns=[*by, "n", "model", "p1", "p2", "log_lik"])

    return stats.repartition(*by).mapInPandas(run, schema)


def fit_models(degrees: DataFrame, by: list[str], models=MODELS) -> DataFrame:
    """(by, n, model, p1, p2, log_lik, aicc, delta_aicc) for every group and model."""
    stats = sufficient_stats(degrees, by)
    parts = [fit_searched(stats, by, models)]
    if "geometric" in models:
        parts.append(fit_geometric(stats, by))
    if "zeta2" in models:
        parts.append(fit_zeta2(stats, by))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return compare_models(out, by)


def compare_models(fits: DataFrame, by: list[str]) -> DataFrame:
    """Corrected AIC and its distance to the best model of the group; null when N-K-1 <= 0."""
    k = F.create_map(*[x for m, v in FREE.items() for x in (F.lit(m), F.lit(v))])[F.col("model")]
    n = F.col("n")
    aicc = F.when(k == 0, -2 * F.col("log_lik")).when(
        n - k - 1 > 0, -2 * F.col("log_lik") + 2 * k * F.try_divide(n, n - k - 1))
    # a handful of models per group
    best = Window.partitionBy(*by)
    return fits.withColumn("aicc", aicc).withColumn("delta_aicc", F.col("aicc") - F.min("aicc").over(best))


def parameter_table(fits: DataFrame, by: list[str]) -> DataFrame:
    """One row per group, parameters side by side."""
    return fits.groupBy(*by).pivot("model", list(MODELS)).agg(F.first("p1").alias("p1"), F.first("p2").alias("p2"))


def log_pmf(model: str, k: Column, p1: Column, p2: Column, norm: Column) -> Column:
    """ln P(k) given parameters and, for the power laws, ln of the normaliser."""
    if model == "geometric":
        return (k - 1) * F.log(1 - p1) + F.log(p1)
    if model == "poisson":
        return k * F.log(p1) - p1 - F.log(1 - F.exp(-p1)) - log_factorial(k)
    if model == "altmann":
        return -p1 * F.log(k) - p2 * k - norm
    return -p1 * F.log(k) - norm


def fitted_pmf(degrees: DataFrame, fits: DataFrame, by: list[str], k_max: int | None = None) -> DataFrame:
    """(by, model, degree, observed, fitted) over 1..largest degree; a pmf at or below zero is null.

    ``observed`` is the share of the group's values, null where a degree does not occur.
    """
    from lodestat.operators.graph import degree_histogram

    hist = degree_histogram(degrees, by).select(*by, "degree", F.col("share").alias("observed"))
    top = degrees.groupBy(*by).agg(F.max("degree").alias("_top")) if k_max is None else fits.select(*by).distinct().withColumn("_top", F.lit(k_max).cast("bigint"))

    @F.pandas_udf("double")
    def log_norm(model: pd.Series, p1: pd.Series, p2: pd.Series, n: pd.Series) -> pd.Series:
        # one value per fitted row, not per degree
        def one(m, a, b, nn):
            if m == "zeta2":
                return math.log(math.pi ** 2 / 6)
            if m == "zeta":
                return math.log(zeta(a))
            if m == "zeta_truncated":
                return math.log(power_sums(a, 0.0, b)[0])
            if m == "altmann":
                return math.log(power_sums(a, b, nn)[0])
            return 0.0
        return pd.Series([one(*x) for x in zip(model, p1, p2, n)])

    params = fits.select(*by, "model", "p1", "p2", log_norm("model", "p1", "p2", F.col("n").cast("double")).alias("_norm"))
    # blocks first, so that a long support is neither one array nor one task's work
    block = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_top") - 1) / _SUPPORT))
    grid = params.join(top, by).withColumn("_b", F.explode(block)).repartition(*by, "model", "_b")
    lo = F.col("_b") * _SUPPORT + 1
    grid = grid.withColumn("degree", F.explode(F.sequence(lo, F.least(lo + _SUPPORT - 1, F.col("_top")))))
    lp = None
    for m in MODELS:
        e = log_pmf(m, F.col("degree"), F.col("p1"), F.col("p2"), F.col("_norm"))
        lp = F.when(F.col("model") == m, e) if lp is None else lp.when(F.col("model") == m, e)
    inside = (F.col("model") != "zeta_truncated") | (F.col("degree") <= F.col("p2"))
    pmf = F.when(inside, F.exp(lp))
    return grid.withColumn("fitted", F.when(pmf > 0, pmf)).join(hist, [*by, "degree"], "left").select(
        *by, "model", "degree", "observed", "fitted")
