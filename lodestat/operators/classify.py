"""Classifiers whose training is an aggregation and whose scoring is an expression."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.functions.special import chi2_tail
from lodestat.operators.density import kernel_density
from lodestat.operators.linear import _matrix, _products


def _assembled(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="_x").transform(df)


def logistic(df: DataFrame, features: list[str], label: str):
    """Binomial model by iteratively reweighted least squares; returns the fitted model."""
    glm = GeneralizedLinearRegression(family="binomial", link="logit", featuresCol="_x", labelCol="_y", maxIter=50, tol=1e-12,
                                      predictionCol="prob", linkPredictionCol="link")
    return glm.fit(_assembled(df.withColumn("_y", F.col(label).cast("double")), features))


def logistic_table(spark, model, features: list[str]) -> DataFrame:
    """(term, estimate, std_error, z, p); the intercept first."""
    s = model.summary
    est = [model.intercept, *model.coefficients.toArray()]
    order = [len(features), *range(len(features))]  # the summary lists the intercept last
    rows = [(n, float(est[i]), float(s.coefficientStandardErrors[j]), float(s.tValues[j]), float(s.pValues[j]))
            for i, (n, j) in enumerate(zip(["(Intercept)", *features], order))]
    return spark.createDataFrame(rows, "term string, estimate double, std_error double, z double, p double")


def logistic_scores(df: DataFrame, model, features: list[str]) -> DataFrame:
    """Adds ``link`` and ``prob``."""
    return model.transform(_assembled(df, features)).drop("_x")


def deviance_test(reduced_deviance: float, reduced_df: int, full_deviance: float, full_df: int) -> tuple[float, int, float]:
    """Chi-square test of nested models: statistic, df, p."""
    stat, d = reduced_deviance - full_deviance, reduced_df - full_df
    return stat, d, chi2_tail(stat, d)


def ridge_logistic(df: DataFrame, features: str, label: str, c: float, n: int):
    """L2-penalised model with inverse strength ``c`` on a vector column."""
    return LogisticRegression(featuresCol=features, labelCol=label, regParam=1.0 / (c * n), standardization=False, maxIter=100, tol=1e-8).fit(df)


# --- discriminants -----------------------------------------------------------------------------

@dataclass
class ClassMoments:
    labels: list
    n: np.ndarray
    mean: np.ndarray
    scatter: np.ndarray  # one matrix per class
    features: list[str]

    @property
    def priors(self) -> np.ndarray:
        return self.n / self.n.sum()


def class_moments(df: DataFrame, features: list[str], label: str) -> ClassMoments:
    """Counts, means and scatter matrices per class; two scans with a handful of rows out."""
    p = len(features)
    head = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"), *[F.avg(f).alias(f"m{i}") for i, f in enumerate(features)]).orderBy(label).collect()
    labels = [r[label] for r in head]
    mean = np.array([[r[f"m{i}"] for i in range(p)] for r in head])

    def centre(i):
        out = None
        for r, m in zip(head, mean[:, i]):
            out = F.when(F.col(label) == r[label], float(m)) if out is None else out.when(F.col(label) == r[label], float(m))
        return out

    rel = df.select(label, *[(F.col(f) - centre(i)).alias(f"d{i}") for i, f in enumerate(features)])
    rows = {r[label]: _matrix(r, p) for r in rel.groupBy(label).agg(*_products([F.col(f"d{i}") for i in range(p)])).collect()}
    return ClassMoments(labels, np.array([r["n"] for r in head], float), mean, np.array([rows[v] for v in labels]), features)


def _gaussian_score(m: ClassMoments, k: int, cov: np.ndarray) -> Column:
    inv, (_, logdet) = np.linalg.inv(cov), np.linalg.slogdet(cov)
    d = [F.col(f) - float(v) for f, v in zip(m.features, m.mean[k])]
    q = F.lit(0.0)
    for i in range(len(d)):
        for j in range(i, len(d)):
            q = q + d[i] * d[j] * float(inv[i, j] * (1 if i == j else 2))
    return F.lit(math.log(m.priors[k]) - 0.5 * float(logdet)) - q / 2


def posterior(df: DataFrame, scores: list[Column], labels: list) -> DataFrame:
    """Adds ``post_<label>`` from log scores, safe against overflow."""
    d = df.select("*", *[s.alias(f"_s{k}") for k, s in enumerate(scores)])
    top = F.greatest(*[F.col(f"_s{k}") for k in range(len(labels))])
    d = d.withColumn("_top", top)
    total = sum((F.exp(F.col(f"_s{k}") - F.col("_top")) for k in range(len(labels))), F.lit(0.0))
    d = d.withColumn("_z", total)
    out = d.select("*", *[(F.exp(F.col(f"_s{k}") - F.col("_top")) / F.col("_z")).alias(f"post_{v}") for k, v in enumerate(labels)])
    return out.drop("_top", "_z", *[f"_s{k}" for k in range(len(labels))])


def lda(df: DataFrame, m: ClassMoments) -> DataFrame:
    """Posterior with one covariance pooled over n - K degrees of freedom."""
    pooled = m.scatter.sum(axis=0) / (m.n.sum() - len(m.labels))
    return posterior(df, [_gaussian_score(m, k, pooled) for k in range(len(m.labels))], m.labels)


def qda(df: DataFrame, m: ClassMoments) -> DataFrame:
    """Posterior with one covariance per class."""
    return posterior(df, [_gaussian_score(m, k, m.scatter[k] / (m.n[k] - 1)) for k in range(len(m.labels))], m.labels)


def naive_bayes_tables(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """(label, prior, mean_f, sd_f ...) with sample deviations."""
    stats = [x for f in features for x in (F.avg(f).alias(f"mean_{f}"), F.stddev_samp(f).alias(f"sd_{f}"))]
    total = df.agg(F.count(F.lit(1))).scalar()
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"), *stats).withColumn("prior", F.col("_n") / total).drop("_n")


def naive_bayes(df: DataFrame, tables: list, features: list[str], label: str) -> DataFrame:
    """Posterior of Gaussian naive Bayes from collected class rows."""
    scores = []
    for r in tables:
        s = F.lit(math.log(r["prior"]))
        for f in features:
            z = (F.col(f) - r[f"mean_{f}"]) / r[f"sd_{f}"]
            s = s - math.log(r[f"sd_{f}"]) - z * z / 2
        scores.append(s)
    return posterior(df, scores, [r[label] for r in tables])


# --- naive Bayes over mixed columns -----------------------------------------------------------------

DENSITY_FLOOR = 1e-300  # for the logarithm of a density of 0


def mixed_naive_bayes(train: DataFrame, test: DataFrame, label: str, categorical: dict[str, list], binary: list[str],
                      kernel: str, normal: list[str], alpha: float = 1.0, width: float = 1.0) -> DataFrame:
    """Posterior from smoothed categorical shares, Bernoulli shares, one kernel density and one
    multivariate normal.

    Training keeps bounded tables only: levels, two moments, and the density's cells.  The
    bandwidth is ``width`` x deviation x n^(-1/5) in each class (1 where values do not vary).  A
    null in the kernel column says nothing.
    """
    m = class_moments(train, normal, label)
    shares = train.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"), F.stddev_samp(kernel).alias("sd"),
        *[F.count_if(F.col(c) == v).alias(f"c_{c}_{i}") for c, levels in categorical.items() for i, v in enumerate(levels)],
        *[F.sum(F.col(b).cast("bigint")).alias(f"b_{b}") for b in binary]).collect()
    by_label = {r[label]: r for r in shares}
    bandwidth = {v: width * (by_label[v]["sd"] or 0.0) * by_label[v]["n"] ** -0.2 or 1.0 for v in m.labels}
    dens = kernel_density(train.select(F.col(label).alias("_k"), F.col(kernel).cast("double").alias("_x")), test.select(F.col(kernel).cast("double").alias("_x")), "_x", bandwidth, "_k")
    logs = dens.groupBy("_x").agg(*[F.log(F.max(F.when(F.col("_k") == v, F.greatest("density", F.lit(DENSITY_FLOOR))))).alias(f"_f{k}") for k, v in enumerate(m.labels)])
    scores = []
    for k, v in enumerate(m.labels):
        r = by_label[v]
        s = _gaussian_score(m, k, m.scatter[k] / (m.n[k] - 1))
        for c, levels in categorical.items():
            share = None
            for i, lev in enumerate(levels):
                w = math.log((r[f"c_{c}_{i}"] + alpha) / (r["n"] + alpha * len(levels)))
                share = F.when(F.col(c) == lev, w) if share is None else share.when(F.col(c) == lev, w)
            s = s + share.otherwise(math.log(alpha / (r["n"] + alpha * len(levels))))
        for b in binary:
            q = (r[f"b_{b}"] + alpha) / (r["n"] + 2 * alpha)
            s = s + F.when(F.col(b).cast("boolean"), math.log(q)).otherwise(math.log(1 - q))
        scores.append(s + F.coalesce(F.col(f"_f{k}"), F.lit(0.0)))
    joined = test.withColumn("_x", F.col(kernel).cast("double")).join(logs, "_x", "left")
    return posterior(joined, scores, m.labels).drop("_x", *[f"_f{k}" for k in range(len(m.labels))])


def class_probability(df: DataFrame, model, features: str) -> DataFrame:
    """Adds ``score``, the probability of class one, from a fitted ridge model."""
    return model.transform(df).withColumn("score", vector_to_array("probability")[1])
