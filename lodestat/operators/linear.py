"""Linear models from one Gram matrix.

The data pass is a single aggregation of centred products; every model on a
subset of its columns (nested tests, elimination, best subsets, lower polynomial
degrees, folds) is algebra on that small matrix.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.functions.quantile import normal_quantile
from lodestat.functions.special import f_tail, t_ppf, t_tail
from lodestat.operators.ordering import number_rows

Terms = dict[str, Column]


@dataclass
class Gram:
    """n, means and centred cross products; the last name is the response."""

    names: list[str]
    n: float
    mean: np.ndarray
    s: np.ndarray

    def keep(self, terms: list[str]) -> "Gram":
        i = [self.names.index(t) for t in terms] + [len(self.names) - 1]
        return Gram([self.names[j] for j in i], self.n, self.mean[i], self.s[np.ix_(i, i)])

    @property
    def terms(self) -> list[str]:
        return self.names[:-1]


def terms_of(names: list[str]) -> Terms:
    return {n: F.col(n).cast("double") for n in names}


def _products(cols: list[Column]) -> list[Column]:
    p = len(cols)
    return [F.sum(cols[i] * cols[j]).alias(f"s{i}_{j}") for i in range(p) for j in range(i, p)]


def _matrix(row, p: int) -> np.ndarray:
    m = np.zeros((p, p))
    for i in range(p):
        for j in range(i, p):
            m[i, j] = m[j, i] = row[f"s{i}_{j}"] or 0.0
    return m


def _design(df: DataFrame, x: Terms, y: Column) -> DataFrame:
    cols = [c.cast("double").alias(f"x{i}") for i, c in enumerate([*x.values(), y])]
    return df.select("*", *cols)


# Wider designs are multiplied batch by batch in tasks: their sums would not compile well.
WIDE = 5


def gram(df: DataFrame, x: Terms, y: Column, where: Column | None = None) -> Gram:
    """Means first, then centred products: two scans, one row each.  Rows with nulls drop out."""
    whole, _ = _grams(df.filter(where) if where is not None else df, x, y, F.lit(0))
    return whole


def fold_grams(df: DataFrame, x: Terms, y: Column, fold: Column) -> tuple[Gram, dict[int, Gram]]:
    """The whole Gram and one per fold, all centred at the same point, in two scans."""
    return _grams(df, x, y, fold)


def _grams(df: DataFrame, x: Terms, y: Column, fold: Column) -> tuple[Gram, dict[int, Gram]]:
    names = [*x, "(response)"]
    p = len(names)
    cols = [f"x{i}" for i in range(p)]
    d = _design(df, x, y).select(fold.cast("bigint").alias("_f"), *cols).na.drop()
    head = d.agg(*[F.avg(c).alias(c) for c in cols]).first()
    centre = np.array([head[c] for c in cols], float)
    raw = _wide_sums(d, cols, centre) if p > WIDE else _compiled_sums(d, cols, centre)

    def build(n, t, m):
        return Gram(names, n, centre + t / n, m - np.outer(t, t) / n)

    total = tuple(sum(v[i] for v in raw.values()) for i in range(3))
    return build(*total), {f: build(*v) for f, v in raw.items()}


def _compiled_sums(d: DataFrame, cols: list[str], centre: np.ndarray) -> dict:
    moved = [F.col(c) - F.lit(float(m)) for c, m in zip(cols, centre)]
    rows = d.groupBy("_f").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"t{i}") for i, c in enumerate(moved)], *_products(moved)).collect()
    return {r["_f"]: (float(r["n"]), np.array([r[f"t{i}"] for i in range(len(cols))]), _matrix(r, len(cols))) for r in rows}


def _wide_sums(d: DataFrame, cols: list[str], centre: np.ndarray) -> dict:
    """Each task adds up its own matrices; (1 + p + p^2) numbers per task and fold are summed."""
    p = len(cols)

    def run(frames):
        acc: dict = {}
        for pdf in frames:
            m = pdf[cols].to_numpy(float) - centre
            f = pdf["_f"].to_numpy()
            for k in np.unique(f):
                z = m[f == k]
                acc[k] = acc.get(k, 0) + np.concatenate([[len(z)], z.sum(axis=0), (z.T @ z).ravel()])
        if acc:
            yield pd.DataFrame({"_f": list(acc), "v": list(acc.values())})

    parts = d.mapInPandas(run, "_f bigint, v array<double>").select("_f", F.posexplode("v").alias("i", "x"))
    out: dict = {}
    for r in parts.groupBy("_f", "i").agg(F.sum("x").alias("x")).collect():
        out.setdefault(r["_f"], np.zeros(1 + p + p * p))[r["i"]] = r["x"]
    return {f: (float(v[0]), v[1:1 + p], v[1 + p:].reshape(p, p)) for f, v in out.items()}


def minus(whole: Gram, part: Gram) -> Gram:
    """Gram of the rows outside ``part``."""
    n = whole.n - part.n
    mean = (whole.n * whole.mean - part.n * part.mean) / n
    gap = part.mean - mean
    return Gram(whole.names, n, mean, whole.s - part.s - np.outer(gap, gap) * part.n * n / whole.n)


class Fit:
    """Least squares on a Gram matrix."""

    def __init__(self, g: Gram):
        self.g = g
        p = len(g.names) - 1
        sxx, sxy = g.s[:p, :p], g.s[:p, p]
        scale = np.sqrt(np.where(np.diag(sxx) > 0, np.diag(sxx), 1.0))
        self.inv = np.linalg.pinv(sxx / np.outer(scale, scale), hermitian=True) / np.outer(scale, scale) if p else np.zeros((0, 0))
        self.beta = self.inv @ sxy
        self.intercept = float(g.mean[p] - self.beta @ g.mean[:p])
        self.tss = float(g.s[p, p])
        self.rss = float(max(self.tss - self.beta @ sxy, 0.0))
        self.df = g.n - p - 1
        self.p = p

    @property
    def sigma2(self) -> float:
        return self.rss / self.df

    @property
    def r2(self) -> float:
        return 1 - self.rss / self.tss

    @property
    def adj_r2(self) -> float:
        return 1 - (self.rss / self.df) / (self.tss / (self.g.n - 1))

    @property
    def f(self) -> float:
        return ((self.tss - self.rss) / self.p) / self.sigma2

    def table(self) -> list[tuple]:
        """(term, estimate, std_error, t, p) with the intercept first."""
        mx = self.g.mean[: self.p]
        se = [math.sqrt(self.sigma2 * (1 / self.g.n + mx @ self.inv @ mx)), *np.sqrt(self.sigma2 * np.diag(self.inv))]
        est = [self.intercept, *self.beta]
        rows = []
        for name, b, s in zip(["(Intercept)", *self.g.terms], est, se):
            t = float(b / s) if s > 0 else math.inf
            rows.append((name, float(b), float(s), t, float(t_tail(t, self.df))))
        return rows

    def predict(self, x: Terms) -> Column:
        out = F.lit(self.intercept)
        for name, b in zip(self.g.terms, self.beta):
            out = out + x[name] * float(b)
        return out

    def leverage(self, x: Terms) -> Column:
        """1/n + (x - mean)' S^-1 (x - mean)."""
        d = [x[n] - float(m) for n, m in zip(self.g.terms, self.g.mean)]
        h = F.lit(1 / self.g.n)
        for i in range(self.p):
            for j in range(i, self.p):
                h = h + d[i] * d[j] * float(self.inv[i, j] * (1 if i == j else 2))
        return h

    def cross_error(self, other: Gram) -> float:
        """Sum of squared errors of this fit on the rows of another Gram."""
        w = np.append(-self.beta, 1.0)
        bias = float(other.mean @ w) - self.intercept
        return float(w @ other.s @ w + other.n * bias ** 2)


COEFFICIENTS = "term string, estimate double, std_error double, t double, p double"


def coefficient_frame(spark, fit: Fit) -> DataFrame:
    return spark.createDataFrame(fit.table(), COEFFICIENTS)


def summary_frame(spark, fit: Fit) -> DataFrame:
    row = (fit.rss, fit.df, math.sqrt(fit.sigma2), fit.r2, fit.adj_r2, fit.f, f_tail(fit.f, fit.p, fit.df))
    return spark.createDataFrame([row], "rss double, df double, rse double, r2 double, adj_r2 double, f double, p double")


def confidence_frame(spark, fit: Fit, level: float = 0.95) -> DataFrame:
    q = t_ppf(0.5 + level / 2, fit.df)
    return spark.createDataFrame([(t, b - q * s, b + q * s) for t, b, s, _, _ in fit.table()], "term string, lower double, upper double")


def predict_intervals(df: DataFrame, fit: Fit, x: Terms, level: float = 0.95) -> DataFrame:
    """Adds fit, and the confidence and prediction bounds of each row."""
    q, s = t_ppf(0.5 + level / 2, fit.df), math.sqrt(fit.sigma2)
    out = df.withColumn("fit", fit.predict(x)).withColumn("_h", fit.leverage(x))
    mean_half, new_half = q * s * F.sqrt("_h"), q * s * F.sqrt(1 + F.col("_h"))
    return out.select("*", (F.col("fit") - mean_half).alias("conf_lo"), (F.col("fit") + mean_half).alias("conf_hi"),
                      (F.col("fit") - new_half).alias("pred_lo"), (F.col("fit") + new_half).alias("pred_hi")).drop("_h")


def nested_f(reduced: Fit, full: Fit) -> tuple[float, float, float, float]:
    """F, its two degrees of freedom and p."""
    d1 = reduced.df - full.df
    f = ((reduced.rss - full.rss) / d1) / full.sigma2
    return f, d1, full.df, f_tail(f, d1, full.df)


def anova_frame(spark, fits: dict[str, Fit]) -> DataFrame:
    """Sequence of nested models with RSS, df and the F test against the one before."""
    rows, prev, last = [], None, list(fits.values())[-1]
    for name, f in fits.items():
        if prev is None:
            rows.append((name, f.df, f.rss, None, None, None))
        else:
            d1 = prev.df - f.df
            stat = ((prev.rss - f.rss) / d1) / last.sigma2
            rows.append((name, f.df, f.rss, d1, stat, f_tail(stat, d1, last.df)))
        prev = f
    return spark.createDataFrame(rows, "model string, res_df double, rss double, df double, f double, p double")


def backward_elimination(g: Gram, alpha: float = 0.05) -> tuple[Fit, list[tuple[str, float]]]:
    """Drops the term with the largest p above ``alpha`` until none is left."""
    dropped = []
    terms = list(g.terms)
    while terms:
        fit = Fit(g.keep(terms))
        name, *_, p = max(fit.table()[1:], key=lambda r: r[4])
        if p <= alpha:
            return fit, dropped
        terms.remove(name)
        dropped.append((name, p))
    return Fit(g.keep([])), dropped


def vifs(g: Gram) -> dict[str, float]:
    """Variance inflation: the diagonal of the inverse correlation matrix."""
    p = len(g.terms)
    sd = np.sqrt(np.diag(g.s)[:p])
    inv = np.linalg.inv(g.s[:p, :p] / np.outer(sd, sd))
    return dict(zip(g.terms, map(float, np.diag(inv))))


def vif_pruning(g: Gram, limit: float = 10.0) -> tuple[dict[str, float], list[tuple[str, float]]]:
    """Drops the largest inflation above ``limit`` until none is; (what stays, what went)."""
    gone = []
    while len(g.terms) > 1:
        v = vifs(g)
        worst = max(v, key=v.get)
        if v[worst] <= limit:
            return v, gone
        gone.append((worst, v[worst]))
        g = g.keep([t for t in g.terms if t != worst])
    return vifs(g), gone


def residual_table(df: DataFrame, fit: Fit, x: Terms, y: Column, order: list[str]) -> DataFrame:
    """Fitted values, residuals, leverage, standardised residuals and the normal Q-Q pairs.

    ``order`` breaks ties so that the order of residuals is total.
    """
    s = math.sqrt(fit.sigma2)
    d = df.withColumn("fitted", fit.predict(x)).withColumn("resid", y - F.col("fitted")).withColumn("leverage", fit.leverage(x))
    d = d.withColumn("std_resid", F.col("resid") / (s * F.sqrt(1 - F.col("leverage"))))
    d = d.withColumn("root_abs", F.sqrt(F.abs("std_resid")))
    d = number_rows(d, ["std_resid", *order], "_i", 1)
    return d.withColumn("normal_q", normal_quantile((F.col("_i") - 0.5) / fit.g.n)).drop("_i")


# --- design columns -----------------------------------------------------------------------

def treatment(col: str, levels: list[str]) -> Terms:
    """Indicators of all levels but the first."""
    return {f"{col}{v}": (F.col(col) == v).cast("double") for v in levels[1:]}


def interaction(a: Terms, b: Terms) -> Terms:
    return {f"{m}:{n}": x * y for m, x in a.items() for n, y in b.items()}


def powers(x: Column, degree: int, name: str = "x") -> Terms:
    return {f"{name}^{k}": F.pow(x, F.lit(float(k))) for k in range(1, degree + 1)}


def legendre(df: DataFrame, col: str, degree: int) -> Terms:
    """Polynomial basis that stays well conditioned: Legendre terms on the column's range.

    Spans the same space as raw powers, so fits agree while high degrees stay accurate.
    """
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    z = (F.col(col) - (lo + hi) / 2) * (2 / (hi - lo) if hi > lo else 1.0)
    out = {}
    for k in range(1, degree + 1):
        coef = np.polynomial.legendre.leg2poly([0.0] * k + [1.0])
        acc = F.lit(float(coef[-1]))
        for c in coef[-2::-1]:
            acc = acc * z + float(c) if c else acc * z
        out[f"{col}~{k}"] = acc
    return out


def back_transform(fit: Fit, x: Terms) -> Column:
    """Prediction of a log-response model on the response's own scale."""
    return F.exp(fit.predict(x))


# --- model choice ----------------------------------------------------------------------------

def best_subsets(spark, g: Gram) -> DataFrame:
    """(size, terms, rss, cp, bic, adj_r2) of the best model of each size.

    The 2^p subsets are rows spread over the cluster; the small Gram matrix goes along.
    """
    full = Fit(g)
    p, n, s2, names = len(g.terms), g.n, full.sigma2, list(g.terms)

    def run(frames):
        for pdf in frames:
            out = []
            for mask in pdf["id"]:
                chosen = [names[i] for i in range(p) if mask >> i & 1]
                f = Fit(g.keep(chosen))
                k = len(chosen)
                bic = n * math.log(f.rss / n) + (k + 1) * math.log(n)
                out.append((k, ",".join(chosen), f.rss, f.rss / s2 - n + 2 * (k + 1), bic, f.adj_r2))
            yield pd.DataFrame(out, columns=["size", "terms", "rss", "cp", "bic", "adj_r2"])

    rows = spark.range(1, 1 << p).mapInPandas(run, "size int, terms string, rss double, cp double, bic double, adj_r2 double")
    best = rows.groupBy("size").agg(F.min(F.struct("rss", "terms", "cp", "bic", "adj_r2")).alias("b"))
    return best.select("size", "b.terms", "b.rss", "b.cp", "b.bic", "b.adj_r2")


def loocv(df: DataFrame, fits: dict[str, Fit], x: Terms, y: Column) -> DataFrame:
    """Exact leave-one-out error of every model, all in one pass; tasks return sums only."""
    names = list(x)
    d = df.select(y.cast("double").alias("_y"), *[c.alias(f"_x{i}") for i, c in enumerate(x.values())])
    models = [([names.index(t) for t in f.g.terms], f.beta, f.intercept, f.g.mean[: f.p], f.inv, f.g.n) for f in fits.values()]

    def run(frames):
        sums, n = np.zeros(len(models)), 0
        for pdf in frames:
            m = pdf.to_numpy(float)
            n += len(m)
            for k, (idx, beta, b0, mean, inv, size) in enumerate(models):
                z = m[:, [1 + i for i in idx]]
                gap = z - mean
                h = 1 / size + np.einsum("ij,jk,ik->i", gap, inv, gap)
                sums[k] += (((m[:, 0] - b0 - z @ beta) / (1 - h)) ** 2).sum()
        yield pd.DataFrame({"model": list(fits), "s": sums, "n": n})

    return (d.na.drop().mapInPandas(run, "model string, s double, n bigint")
            .groupBy("model").agg((F.sum("s") / F.sum("n")).alias("cv_error")))


def kfold(df: DataFrame, models: dict[str, list[str]], x: Terms, y: Column, fold: Column,
          grams: tuple[Gram, dict[int, Gram]] | None = None) -> list[tuple[str, float]]:
    """k-fold error per model: training Gram = whole minus fold, test error from the fold's Gram.

    ``grams``: those of ``fold_grams``, if at hand.
    """
    whole, parts = grams or fold_grams(df, x, y, fold)
    out = []
    for name, terms in models.items():
        sse = sum(Fit(minus(whole, g).keep(terms)).cross_error(g.keep(terms)) for g in parts.values())
        out.append((name, float(sse / whole.n)))
    return out
