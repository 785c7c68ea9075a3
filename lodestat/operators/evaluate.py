"""Confusion tables, ROC curves, splits and transforms fitted on train."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.operators.frames import row_hash
from lodestat.operators.ordering import number_rows, running_total
from lodestat.session import per_group


def confusion(df: DataFrame, truth: Column, score: Column, threshold: float, strict: bool = False) -> DataFrame:
    """Counts and rates at a threshold; ``strict`` predicts positive only above it."""
    pred = score > threshold if strict else score >= threshold
    c = df.agg(
        F.count_if(pred & truth).alias("tp"), F.count_if(pred & ~truth).alias("fp"),
        F.count_if(~pred & truth).alias("fn"), F.count_if(~pred & ~truth).alias("tn"))
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    ppv, tpr = F.try_divide("tp", F.col("tp") + F.col("fp")), F.try_divide("tp", F.col("tp") + F.col("fn"))
    return c.select(
        "*", F.try_divide(F.col("fp") + F.col("fn"), n).alias("error"), ppv.alias("ppv"), tpr.alias("tpr"),
        F.try_divide(2 * ppv * tpr, ppv + tpr).alias("f1"),
        F.try_divide("tn", F.col("tn") + F.col("fp")).alias("tnr"), F.try_divide("fp", F.col("tn") + F.col("fp")).alias("fpr"),
        F.try_divide(F.least(F.col("tp") + F.col("fn"), F.col("tn") + F.col("fp")), n).alias("trivial_error"))


def roc_points(df: DataFrame, truth: Column, score: str) -> DataFrame:
    """(threshold, tpr, fpr) at every distinct score, predicting positive at or above it."""
    counts = df.groupBy(F.col(score).alias("threshold")).agg(F.count_if(truth).alias("_p"), F.count_if(~truth).alias("_n"))
    cum = running_total(running_total(counts, "_p", [F.desc("threshold")], (), "_tp"), "_n", [F.desc("threshold")], (), "_fp")
    tot = counts.agg(F.sum("_p").alias("p"), F.sum("_n").alias("n"))
    p, n = tot.select("p").scalar(), tot.select("n").scalar()
    return cum.select("threshold", (F.col("_tp") / p).alias("tpr"), (F.col("_fp") / n).alias("fpr"))


def auc(df: DataFrame, truth: Column, score: str) -> DataFrame:
    """Area under the curve from ranks; ties count one half."""
    counts = df.groupBy(F.col(score).alias("_s")).agg(F.count_if(truth).alias("_p"), F.count_if(~truth).alias("_n"))
    cum = running_total(counts, "_n", "_s", (), "_below")
    wins = F.sum(F.col("_p") * (F.col("_below") - F.col("_n") / 2.0))
    return cum.agg((wins / (F.sum("_p") * F.sum("_n"))).alias("auc"))


def best_threshold(roc: DataFrame) -> DataFrame:
    """The threshold with the largest tpr + tnr, the highest one on ties."""
    key = F.struct(F.round(F.col("tpr") - F.col("fpr"), 12), F.col("threshold"))
    return roc.agg(F.max_by(F.struct("threshold", "tpr", "fpr"), key).alias("b")).select("b.*")


def macro_scores(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Accuracy and unweighted mean precision, recall and F1 over the classes."""
    cells = df.groupBy(truth, pred).agg(F.count(F.lit(1)).alias("c"))
    sides = cells.select(F.inline(F.array(
        F.struct(F.col(truth).alias("k"), F.col("c").alias("act"), F.lit(0).cast("bigint").alias("prd"), F.when(F.col(truth) == F.col(pred), F.col("c")).otherwise(0).alias("hit")),
        F.struct(F.col(pred).alias("k"), F.lit(0).cast("bigint").alias("act"), F.col("c").alias("prd"), F.lit(0).cast("bigint").alias("hit")))))
    per = sides.groupBy("k").agg(F.sum("act").alias("act"), F.sum("prd").alias("prd"), F.sum("hit").alias("hit"))
    prec, rec = F.coalesce(F.try_divide("hit", "prd"), F.lit(0.0)), F.coalesce(F.try_divide("hit", "act"), F.lit(0.0))
    per = per.select("*", prec.alias("prec"), rec.alias("rec"), F.coalesce(F.try_divide(2 * prec * rec, prec + rec), F.lit(0.0)).alias("f1"))
    return per.agg((F.sum("hit") / F.sum("act")).alias("accuracy"), F.avg("prec").alias("precision"), F.avg("rec").alias("recall"), F.avg("f1").alias("f1"))


def exact_split(df: DataFrame, key: str, shares: dict[str, float], shuffle: bool = True, seed: int = 0) -> DataFrame:
    """Adds ``part`` with exact sizes: rounded cumulative shares along the key or its hash."""
    order = [row_hash(F.col(key) + seed).alias("_h"), F.col(key)] if shuffle else [F.col(key)]
    d = df.withColumn("_h", order[0]) if shuffle else df
    numbered = number_rows(d, ["_h", key] if shuffle else [key], "_i")
    n = df.agg(F.count(F.lit(1))).scalar()
    numbered = numbered.withColumn("_n", n)
    part, acc = None, 0.0
    names = list(shares)
    for name in names[:-1]:
        acc += shares[name]
        inside = F.col("_i") < F.round(F.col("_n") * acc)
        part = F.when(inside, name) if part is None else part.when(inside, name)
    part = part.otherwise(names[-1]) if part is not None else F.lit(names[-1])
    return numbered.withColumn("part", part).drop("_i", "_h", "_n")


def mse(df: DataFrame, y: Column, fitted: Column, by: str | None = None) -> DataFrame:
    err = F.avg(F.pow(y - fitted, F.lit(2.0))).alias("mse")
    return df.groupBy(by).agg(err) if by else df.agg(err)


def standardise(train: DataFrame, test: DataFrame, cols: list[str]) -> DataFrame:
    """``test`` in units of the training mean and population deviation; constants become zero."""
    row = train.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    out = test
    for c in cols:
        sd = row[f"s_{c}"] or 0.0
        out = out.withColumn(c, (F.col(c) - row[f"m_{c}"]) / sd if sd > 0 else F.lit(0.0))
    return out


def power_value(x: Column, lam: float, kind: str) -> Column:
    """Box-Cox (positive x) or Yeo-Johnson (any x) transform."""
    if kind == "box-cox":
        return F.log(x) if lam == 0 else (F.pow(x, F.lit(lam)) - 1) / lam
    up = F.log1p(x) if lam == 0 else (F.pow(1 + x, F.lit(lam)) - 1) / lam
    down = -F.log1p(-x) if lam == 2 else -(F.pow(1 - x, F.lit(2 - lam)) - 1) / (2 - lam)
    # each side sees only its own sign, so neither raises on the other's rows
    return F.when(x >= 0, F.when(x >= 0, up)).otherwise(F.when(x < 0, down))


def power_likelihood(train: DataFrame, col: str, kind: str = "yeo-johnson", grid: list[float] | None = None) -> DataFrame:
    """(lambda, log_lik): the profile likelihood of every grid value in one aggregation."""
    grid = grid or [round(-2 + 0.1 * i, 10) for i in range(41)]
    x = F.col(col).cast("double")
    jac = F.log(x) if kind == "box-cox" else F.signum(x) * F.log1p(F.abs(x))
    parts = [F.var_pop(power_value(x, g, kind)).alias(f"v{i}") for i, g in enumerate(grid)]
    row = train.agg(F.count(col).alias("n"), F.sum(jac).alias("j"), *parts)
    cells = [F.struct(F.lit(float(g)).alias("lambda"), (-F.col("n") / 2 * F.log(f"v{i}") + (g - 1) * F.col("j")).alias("log_lik")) for i, g in enumerate(grid)]
    return row.select(F.inline(F.array(*cells)))


def power_transform(train: DataFrame, test: DataFrame, cols: list[str], kind: str = "yeo-johnson", grid: list[float] | None = None) -> DataFrame:
    """``test`` under the most likely transform of each training column."""
    out = test
    for c in cols:
        lam = power_likelihood(train, c, kind, grid).agg(F.max_by("lambda", "log_lik")).first()[0]
        out = out.withColumn(c, power_value(F.col(c), lam, kind))
    return out


def class_quantiles(df: DataFrame, col: str, by: str) -> DataFrame:
    """Normal Q-Q pairs of a column inside each class."""
    from lodestat.functions.quantile import normal_quantile

    one = running_total(df.withColumn("_one", F.lit(1).cast("bigint")), "_one", [col], [by], "_i")
    size = per_group(df.groupBy(by).agg(F.count(F.lit(1)).alias("_n")))
    return one.join(size, by).select(by, col, normal_quantile((F.col("_i") - 0.5) / F.col("_n")).alias("normal_q"))


