"""Tests on group means and variances, from one aggregated row per group."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.functions.special import chi2_tail, f_tail, t_tail, tukey_tail


def group_moments(df: DataFrame, group: str, value: str) -> list[tuple]:
    """(group, n, mean, variance) per group; groups are factor levels, so few."""
    rows = df.groupBy(group).agg(F.count(value).alias("n"), F.avg(value).alias("m"), F.var_samp(value).alias("v")).orderBy(group).collect()
    return [(r[group], r["n"], r["m"], r["v"]) for r in rows]


def two_sample_t(m: list[tuple]) -> tuple:
    """Equal-variance t test of two groups: t, df, p."""
    (_, n1, m1, v1), (_, n2, m2, v2) = m
    df = n1 + n2 - 2
    pooled = ((n1 - 1) * v1 + (n2 - 1) * v2) / df
    t = (m1 - m2) / math.sqrt(pooled * (1 / n1 + 1 / n2))
    return "t", t, float(df), t_tail(t, df)


def variance_f(m: list[tuple]) -> tuple:
    """Two-sided F test that two variances are equal: F, numerator df, p."""
    (_, n1, _, v1), (_, n2, _, v2) = m
    f = v1 / v2
    upper = f_tail(f, n1 - 1, n2 - 1)
    return "F", f, float(n1 - 1), min(1.0, 2 * min(upper, 1 - upper))


def bartlett(m: list[tuple]) -> tuple:
    """Bartlett's test that all variances are equal: statistic, df, p."""
    k, n = len(m), sum(r[1] for r in m)
    pooled = sum((r[1] - 1) * r[3] for r in m) / (n - k)
    top = (n - k) * math.log(pooled) - sum((r[1] - 1) * math.log(r[3]) for r in m)
    corr = 1 + (sum(1 / (r[1] - 1) for r in m) - 1 / (n - k)) / (3 * (k - 1))
    return "K2", top / corr, float(k - 1), chi2_tail(top / corr, k - 1)


def one_way(m: list[tuple]) -> dict:
    """Between and within sums of squares, F and p."""
    k, n = len(m), sum(r[1] for r in m)
    grand = sum(r[1] * r[2] for r in m) / n
    between = sum(r[1] * (r[2] - grand) ** 2 for r in m)
    within = sum((r[1] - 1) * r[3] for r in m)
    f = (between / (k - 1)) / (within / (n - k))
    return {"ss_between": between, "df_between": float(k - 1), "ss_within": within, "df_within": float(n - k), "f": f, "p": f_tail(f, k - 1, n - k)}


def tukey_pairs(m: list[tuple]) -> list[tuple]:
    """(a, b, diff, q, p) for all pairs of groups."""
    a = one_way(m)
    s2 = a["ss_within"] / a["df_within"]
    out = []
    for i, (g1, n1, m1, _) in enumerate(m):
        for g2, n2, m2, _ in m[i + 1:]:
            q = abs(m2 - m1) / math.sqrt(s2 / 2 * (1 / n1 + 1 / n2))
            out.append((g1, g2, m2 - m1, q, tukey_tail(q, len(m), a["df_within"])))
    return out
