"""Grouped summaries: spread, quantiles, histograms, covariance, boxplots, friend statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.operators.ordering import exact_quantiles, first_per_key
from lodestat.session import cut, per_group

QUARTILES = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}


def spread(df: DataFrame, col: str, by=()) -> DataFrame:
    """n, min, max, mean and exact median of ``col``."""
    by = [by] if isinstance(by, str) else list(by)
    base = df.groupBy(*by).agg(
        F.count(col).alias("n"), F.min(col).alias("min"), F.max(col).alias("max"), F.avg(col).alias("mean"))
    med = exact_quantiles(df, col, {"median": 0.5}, by).drop("n")
    if by:
        return base.join(med, by, "left")
    return base.withColumn("median", med.select("median").scalar())


def five_numbers(df: DataFrame, col: str, by=()) -> DataFrame:
    """Minimum, quartiles, maximum and mean."""
    by = [by] if isinstance(by, str) else list(by)
    q = exact_quantiles(df, col, QUARTILES, by)
    mean = df.groupBy(*by).agg(F.avg(col).alias("mean"))
    if by:
        return q.join(mean, by)
    return q.withColumn("mean", mean.scalar())


def histogram(df: DataFrame, col: str, bins: int | None = None, breaks: list[float] | None = None) -> DataFrame:
    """(bin, lo, hi, n, density) with left-closed bins, the last one closed; empty bins appear."""
    spark = df.sparkSession
    c = F.col(col)
    if breaks is None:
        edge = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
        width = (edge["hi"] - edge["lo"]) / bins
        breaks = [edge["lo"] + i * width for i in range(bins)] + [edge["hi"]]
    # a binary search among the inner breaks: a handful of comparisons a row however many bins
    inner = F.array(*[F.lit(float(b)) for b in breaks[1:-1]]) if len(breaks) > 2 else F.array().cast("array<double>")
    index, step = F.lit(0), 1 << max(0, len(breaks) - 2).bit_length()
    while step > 1:
        step >>= 1
        index = index + F.when(c >= F.get(inner, index + (step - 1)), step).otherwise(0)
        df, index = df.withColumn("_at", index), F.col("_at")
    inside = (c >= F.lit(float(breaks[0]))) & (c <= F.lit(float(breaks[-1])))
    counts = cut(df.filter(inside).groupBy(index.alias("bin")).agg(F.count(F.lit(1)).alias("n")))  # a row per bin
    grid = spark.createDataFrame(
        [(i, float(breaks[i]), float(breaks[i + 1])) for i in range(len(breaks) - 1)], "bin int, lo double, hi double")
    full = grid.join(counts, "bin", "left").fillna(0, ["n"])
    total = counts.agg(F.sum("n")).scalar()
    return full.withColumn("density", F.col("n") / (total * (F.col("hi") - F.col("lo"))))


def covariances(df: DataFrame, cols: list[str]) -> DataFrame:
    """(a, b, cov, cor) for all column pairs, from one pass; cor is cov scaled by the deviations."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    row = df.agg(*[F.covar_samp(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    idx = {p: i for i, p in enumerate(pairs)}

    def at(a, b):
        return F.col(f"c{idx[(a, b)] if (a, b) in idx else idx[(b, a)]}")

    cells = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), at(a, b).alias("cov"),
                 F.try_divide(at(a, b), F.sqrt(at(a, a) * at(b, b))).alias("cor"))
        for a in cols for b in cols
    ]
    return row.select(F.inline(F.array(*cells)))


def cross_table(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def fences(df: DataFrame, col: str, by=(), k: float = 1.5) -> DataFrame:
    """Quartiles and the fences at ``k`` interquartile ranges."""
    by = [by] if isinstance(by, str) else list(by)
    q = exact_quantiles(df, col, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by)
    iqr = F.col("q3") - F.col("q1")
    return q.withColumn("low_fence", F.col("q1") - k * iqr).withColumn("high_fence", F.col("q3") + k * iqr)


def outliers(df: DataFrame, col: str, by=(), k: float = 1.5) -> DataFrame:
    """Rows outside the fences."""
    by = [by] if isinstance(by, str) else list(by)
    f = per_group(fences(df, col, by, k).select(*by, "low_fence", "high_fence"))
    outside = (F.col(col) < F.col("low_fence")) | (F.col(col) > F.col("high_fence"))
    if by:
        return df.join(f, by).filter(outside).drop("low_fence", "high_fence")
    lo, hi = f.select("low_fence").scalar(), f.select("high_fence").scalar()
    return df.filter((F.col(col) < lo) | (F.col(col) > hi))


def boxplot(df: DataFrame, col: str, by) -> DataFrame:
    """Per group: quartiles, whisker ends (furthest values inside the fences), outlier count."""
    by = [by] if isinstance(by, str) else list(by)
    f = per_group(fences(df, col, by))
    inside = (F.col(col) >= F.col("low_fence")) & (F.col(col) <= F.col("high_fence"))
    ends = df.join(f.select(*by, "low_fence", "high_fence"), by).groupBy(*by).agg(
        F.min(F.when(inside, F.col(col))).alias("whisker_lo"),
        F.max(F.when(inside, F.col(col))).alias("whisker_hi"),
        F.count_if(~inside).alias("n_outliers"))
    return f.join(ends, by).drop("low_fence", "high_fence")


def simulated_interval(df: DataFrame, col: str, by=()) -> DataFrame:
    """mean, population sd and the 2.5/97.5 percentiles."""
    by = [by] if isinstance(by, str) else list(by)
    q = exact_quantiles(df, col, {"p2_5": 0.025, "p97_5": 0.975}, by)
    m = df.groupBy(*by).agg(F.avg(col).alias("mean"), F.stddev_pop(col).alias("std"))
    if by:
        return q.join(m, by)
    return q.withColumn("mean", m.select("mean").scalar()).withColumn("std", m.select("std").scalar())


def friend_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Per node n, min, max, mean and median score; (0, -1, -1, -1, -1) with no friends."""
    s = spread(edges.select(F.col("src").alias("node"), "score"), "score", "node")
    return nodes.join(s, "node", "left").select(
        "node", F.coalesce("n", F.lit(0)).alias("n"),
        *[F.coalesce(c, F.lit(-1.0)).alias(c) for c in ("min", "max", "mean", "median")])


def best_friend(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Friend with the highest score, ties by name; null with no friends."""
    ranked = edges.select(F.col("src").alias("node"), (-F.col("score")).alias("_neg"), F.col("dst").alias("friend"))
    return nodes.join(first_per_key(ranked, ["node"], ["_neg", "friend"]).drop("_neg"), "node", "left")


def out_degree_of(nodes: DataFrame, edges: DataFrame, asked: DataFrame) -> DataFrame:
    """Out-degree per asked node; -1 when the node is unknown."""
    deg = edges.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("d"))
    known = nodes.join(deg, "node", "left").select("node", F.coalesce("d", F.lit(0)).alias("n_friends"))
    return asked.join(known, "node", "left").select("node", F.coalesce("n_friends", F.lit(-1)).alias("n_friends"))


def top_k_degree(edges: DataFrame, k: int, end: str = "src") -> DataFrame:
    """``k`` nodes with the most edges at ``end``: src for out-degree, dst for in-degree."""
    return (
        edges.groupBy(F.col(end).alias("node")).agg(F.count(F.lit(1)).alias("degree"))
        .orderBy(F.desc("degree"), "node").limit(max(k, 0))
    )


def top_k_groups(df: DataFrame, group: str, value: Column, k: int, name: str = "value") -> DataFrame:
    """``k`` groups with the largest aggregate; none when ``k`` is negative."""
    return df.groupBy(group).agg(value.alias(name)).orderBy(F.desc(name), group).limit(max(k, 0))
