"""Four classifiers over repeated splits, each tuned by cross-validation, many fits at a time.

Rounds and folds are rows of one table: a training row of round r is copied to the folds that
learn from it, so one aggregation serves all fits of a kind (a level of all trees, a round of
all margins, a Newton step of all logistic models).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.operators import margins, trees
from lodestat.operators.classify import DENSITY_FLOOR
from lodestat.operators.density import kernel_density
from lodestat.operators.frames import row_hash
from lodestat.operators.ordering import running_total
from lodestat.session import cut, held, per_group, release

ALPHAS = (0.0, 0.002, 0.005, 0.01, 0.02, 0.05)  # cost of a leaf
STRENGTHS = (0.001, 0.01, 0.1)  # weight of the norm
WIDTHS = (0.5, 1.0, 2.0)  # bandwidth factors


@dataclass
class Columns:
    """Which columns the models read; the mixed model needs the last four as well."""

    features: list[str]
    key: str = "doc_id"
    label: str = "quality"
    categorical: dict[str, list] | None = None
    binary: list[str] | None = None
    kernel: str | None = None
    normal: list[str] | None = None


def auc_by(df: DataFrame, by: list[str], label: str, score: str) -> DataFrame:
    """``by, auc``: area under the curve in each group, ties one half; null where a class is missing."""
    counts = df.groupBy(*by, F.col(score).alias("_s")).agg(F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) != 1).alias("_n"))
    below = running_total(counts, "_n", "_s", by, "_below")
    wins = F.sum(F.col("_p") * (F.col("_below") - F.col("_n") / 2.0))
    return below.groupBy(*by).agg(F.try_divide(wins, F.sum("_p") * F.sum("_n")).alias("auc"))


def splits(df: DataFrame, c: Columns, rounds: int, folds: int, share: float = 0.8) -> DataFrame:
    """Each row once per round with ``part`` and ``fold``: exact shares along a hash of key and round.

    Features are in units of the round's training rows.
    """
    rows = df.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
    rows = rows.withColumn("_h", row_hash(F.col(c.key) + 1000 * F.col("round"))).withColumn("_one", F.lit(1).cast("bigint"))
    placed = running_total(rows, "_one", [F.col("_h"), F.col(c.key)], ["round"], "_at")
    n = per_group(df.agg(F.count(F.lit(1)).alias("_total")))
    learn = F.col("_at") <= F.round(F.col("_total") * share)
    placed = placed.crossJoin(F.broadcast(n)).withColumn("part", F.when(learn, "train").otherwise("test"))  # one row
    placed = cut(placed.withColumn("fold", F.pmod("_at", F.lit(folds)).cast("int")).drop("_h", "_one", "_at", "_total"))
    stats = placed.filter("part = 'train'").groupBy("round").agg(
        *[x for i, f in enumerate(c.features) for x in (F.avg(f).alias(f"_m{i}"), F.stddev_pop(f).alias(f"_s{i}"))])
    scaled = placed.join(per_group(stats), "round")
    for i, f in enumerate(c.features):
        scaled = scaled.withColumn(f"_z{i}", F.coalesce(F.try_divide(F.col(f) - F.col(f"_m{i}"), F.col(f"_s{i}")), F.lit(0.0)))
    return scaled.drop(*[f"_{k}{i}" for i in range(len(c.features)) for k in "ms"])


def _copies(rows: DataFrame, folds: int, settings: tuple = ("",)) -> DataFrame:
    """Training rows for every fit that learns from them: one per other fold and the whole round, times settings."""
    fit = F.explode(F.sequence(F.lit(0), F.lit(folds)))
    out = rows.filter("part = 'train'").withColumn("fit", fit).filter("fit != fold")
    if settings != ("",):
        out = out.withColumn("setting", F.explode(F.array(*[F.lit(float(s)) for s in settings])))
        return out.withColumn("model", F.concat_ws("/", "round", "fit", "setting"))
    return out.withColumn("model", F.concat_ws("/", "round", "fit"))


def _asked(rows: DataFrame, folds: int, settings: tuple) -> DataFrame:
    """Rows to be scored: held-out folds by the fit without them, test rows by the whole fit, for every setting."""
    fit = F.when(F.col("part") == "train", F.col("fold")).otherwise(folds)
    out = rows.withColumn("fit", fit).withColumn("setting", F.explode(F.array(*[F.lit(float(s)) for s in settings])))
    return out.withColumn("model", F.concat_ws("/", "round", "fit", "setting"))


def _best(scored: DataFrame, label: str, prefer_large: bool) -> list:
    """``round, setting, auc``: the setting with the best mean AUC over held-out folds, and its AUC on the test rows."""
    auc = cut(auc_by(scored, ["round", "part", "fit", "setting"], label, "score"))
    mean = auc.filter("part = 'train'").groupBy("round", "setting").agg(F.round(F.avg("auc"), 12).alias("m"))
    tie = F.col("setting") if prefer_large else -F.col("setting")
    chosen = mean.groupBy("round").agg(F.max_by("setting", F.struct("m", tie)).alias("setting"))
    return chosen.join(auc.filter("part = 'test'"), ["round", "setting"]).select("round", "setting", "auc").collect()  # a row per round


def logistic_newton(df: DataFrame, vector: str, label: str, strengths: dict[str, float], by: str, tolerance: float = 1e-8, rounds: int = 50) -> dict[str, np.ndarray]:
    """Weights (constant last, not penalised) of a ridge logistic model for each value of ``by``.

    A round is one aggregation: gradient and curvature sums of all models.  Raises ``NotConverged``.
    """
    rows = df.select(F.col(by).alias("model"), F.col(label).cast("double").alias("y"), F.concat(F.col(vector).cast("array<double>"), F.array(F.lit(1.0))).alias("x"))
    p = rows.select(F.max(F.size("x"))).first()[0] or 1
    w, live = {k: np.zeros(p) for k in strengths}, set(strengths)
    free = np.ones(p)
    free[-1] = 0.0
    for _ in range(rounds):
        model = held(df.sparkSession, [(k, w[k].tolist()) for k in sorted(live)], "model string, w array<double>")
        link = F.aggregate(F.zip_with("x", "w", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
        at = rows.join(model, "model").withColumn("q", 1 / (1 + F.exp(-link)))
        x = [F.get("x", F.lit(j)) for j in range(p)]
        curve = F.col("q") * (1 - F.col("q"))
        got = at.groupBy("model").agg(F.count(F.lit(1)).alias("n"), *[F.sum((F.col("q") - F.col("y")) * x[j]).alias(f"g{j}") for j in range(p)],
                                      *[F.sum(curve * x[i] * x[j]).alias(f"h{i}_{j}") for i in range(p) for j in range(i, p)]).collect()
        live &= {r["model"] for r in got}
        for r in got:
            k, n = r["model"], r["n"]
            h = np.array([[r[f"h{min(i, j)}_{max(i, j)}"] for j in range(p)] for i in range(p)]) / n + strengths[k] * np.diag(free) + 1e-12 * np.eye(p)
            step = np.linalg.solve(h, np.array([r[f"g{j}"] for j in range(p)]) / n + strengths[k] * free * w[k])
            w[k] = w[k] - step * min(1.0, 5.0 / max(1e-300, np.abs(step).max()))
            if np.abs(step).max() <= tolerance * max(1.0, np.abs(w[k]).max()):
                live.discard(k)
        if not live:
            return w
    raise margins.NotConverged(f"{len(live)} logistic models still move after {rounds} rounds")


def naive_scores(learned: DataFrame, asked: DataFrame, c: Columns, alpha: float = 1.0) -> DataFrame:
    """``asked`` with ``score``, the log odds of class 1 under the mixed naive Bayes of its fit and bandwidth factor.

    ``learned``: training rows with their ``model``; ``asked`` has ``model`` and ``setting`` behind a slash.
    The same rules as ``classify.mixed_naive_bayes``, for all fits at once.
    """
    spark, names, levels, flags = learned.sparkSession, c.normal or [], c.categorical or {}, c.binary or []
    p = len(names)
    stats = learned.groupBy("model", F.col(c.label).alias("k")).agg(
        F.count(F.lit(1)).alias("n"), F.stddev_samp(c.kernel).alias("sd"), *[F.avg(f).alias(f"m{i}") for i, f in enumerate(names)],
        *[F.covar_samp(names[i], names[j]).alias(f"c{i}_{j}") for i in range(p) for j in range(i, p)],
        *[F.count_if(F.col(f) == v).alias(f"l{i}_{j}") for i, (f, own) in enumerate(levels.items()) for j, v in enumerate(own)],
        *[F.count_if(F.col(f).cast("boolean")).alias(f"b{i}") for i, f in enumerate(flags)]).collect()  # two rows per fit
    total, tables, widths = {}, {}, {}
    for r in stats:
        total[r["model"]] = total.get(r["model"], 0) + r["n"]
    for r in stats:
        cov = np.array([[r[f"c{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(p)] for i in range(p)]).reshape(p, p)
        cov = cov + 1e-12 * max(1.0, np.trace(cov)) * np.eye(p)
        shares = [[float(np.log((r[f"l{i}_{j}"] + alpha) / (r["n"] + alpha * len(own)))) for j in range(len(own))] + [float(np.log(alpha / (r["n"] + alpha * len(own))))]
                  for i, own in enumerate(levels.values())]
        on = [(r[f"b{i}"] + alpha) / (r["n"] + 2 * alpha) for i in range(len(flags))]
        base = float(np.log(r["n"] / total[r["model"]]) - 0.5 * (np.linalg.slogdet(cov)[1] if p else 0.0))
        tables.setdefault(r["model"], {})[r["k"]] = (base, [float(r[f"m{i}"]) for i in range(p)], np.linalg.inv(cov).ravel().tolist() if p else [],
                                                     shares, [float(np.log(q)) for q in on], [float(np.log(1 - q)) for q in on])
        for h in WIDTHS:
            widths[f"{r['model']}/{float(h)}/{r['k']}"] = h * (r["sd"] or 0.0) * r["n"] ** -0.2 or 1.0
    kind = "struct<base: double, mean: array<double>, inv: array<double>, share: array<array<double>>, on: array<double>, off: array<double>>"
    model = held(spark, [(k, t[0], t[1]) for k, t in tables.items() if len(t) == 2], f"_fit string, t0 {kind}, t1 {kind}")
    widened = learned.withColumn("_h", F.explode(F.array(*[F.lit(float(h)) for h in WIDTHS])))
    points = widened.select(F.concat_ws("/", "model", "_h", F.col(c.label)).alias("_k"), F.col(c.kernel).cast("double").alias("_x"))
    at = asked.withColumn("_fit", F.concat_ws("/", "round", "fit")).withColumn("_x", F.col(c.kernel).cast("double")).join(model, "_fit")
    classes = F.explode(F.array(F.lit("0"), F.lit("1")))
    places = at.select("model", "_x", classes.alias("_c")).select(F.concat_ws("/", "model", "_c").alias("_k"), "_x")
    dens = kernel_density(points, places, "_x", widths, "_k").withColumn("model", F.regexp_replace("_k", "/[01]$", ""))
    logs = dens.groupBy("model", "_x").agg(*[F.log(F.max(F.when(F.col("_k").endswith(f"/{k}"), F.greatest("density", F.lit(DENSITY_FLOOR))))).alias(f"_f{k}") for k in (0, 1)])
    x = F.array(*[F.col(f).cast("double") for f in names]) if names else F.array().cast("array<double>")

    def log_score(t: str):
        d = F.zip_with(x, F.col(f"{t}.mean"), lambda a, b: a - b)
        s = F.col(f"{t}.base")
        if p:
            s = s - 0.5 * F.aggregate(F.sequence(F.lit(0), F.lit(p * p - 1)), F.lit(0.0), lambda q, i: q + F.get(d, F.floor(i / p).cast("int")) * F.get(d, i % p) * F.get(F.col(f"{t}.inv"), i))
        for i, (f, own) in enumerate(levels.items()):
            place = F.array_position(F.array(*[F.lit(v) for v in own]), F.col(f)).cast("int")
            s = s + F.get(F.get(F.col(f"{t}.share"), F.lit(i)), F.when(F.coalesce(place, F.lit(0)) > 0, place - 1).otherwise(len(own)))
        for i, f in enumerate(flags):
            s = s + F.when(F.col(f).cast("boolean"), F.get(F.col(f"{t}.on"), F.lit(i))).otherwise(F.get(F.col(f"{t}.off"), F.lit(i)))
        return s

    scored = at.join(logs, ["model", "_x"], "left")
    odds = log_score("t1") - log_score("t0") + F.coalesce(F.col("_f1") - F.col("_f0"), F.lit(0.0))
    return scored.withColumn("score", odds).drop("t0", "t1", "_fit", "_x", "_f0", "_f1")


def compare_models(df: DataFrame, c: Columns, rounds: int = 100, folds: int = 10, depth: int = 5, least: int = 5, tolerance: float = 0.01) -> DataFrame:
    """``model, round, setting, auc`` of logistic regression, tree, support vector machine and mixed naive
    Bayes (where its columns are named): test AUC under the setting that ``folds``-fold validation chose.

    Trees and bandwidths prefer the simpler of equal settings, as do the norms' weights.
    """
    spark = df.sparkSession
    needed = list(dict.fromkeys([c.key, c.label, *c.features, *(c.categorical or {}), *(c.binary or []), *([c.kernel] if c.kernel else []), *(c.normal or [])]))
    rows = cut(splits(df.select(*needed), c, rounds, folds).withColumn("x", F.array(*[F.col(f"_z{i}") for i in range(len(c.features))])))
    z = [f"_z{i}" for i in range(len(c.features))]
    fits = [f"{r}/{f}" for r in range(rounds) for f in range(folds + 1)]
    out: list[tuple] = []

    grown = trees.grow(_copies(rows, folds), z, c.label, depth, least, by="model")
    small = {f"{k}/{float(a)}": trees.pruned(t, a) for k, t in grown.items() for a in ALPHAS}
    held = trees.scored(_asked(rows, folds, ALPHAS), z, small, by="model")
    out += [("tree", r["round"], r["setting"], r["auc"]) for r in _best(held, c.label, True)]

    copies = cut(_copies(rows, folds, STRENGTHS).select("model", c.label, "x"))
    strengths = {f"{k}/{float(s)}": s for k in fits for s in STRENGTHS}
    for name, fitted in (("logistic", {k: {"w": w} for k, w in logistic_newton(copies, "x", c.label, strengths, "model").items()}),
                         ("svm", margins.fit(copies, "x", c.label, strengths, "model", tolerance))):
        held = margins.margins(_asked(rows, folds, STRENGTHS), "x", fitted, by="model")
        out += [(name, r["round"], r["setting"], r["auc"]) for r in _best(held, c.label, True)]
    release(copies)

    if c.kernel:
        held = naive_scores(_copies(rows, folds), _asked(rows, folds, WIDTHS), c)
        out += [("mixed_naive_bayes", r["round"], r["setting"], r["auc"]) for r in _best(held, c.label, True)]
    return spark.createDataFrame(out, "model string, round int, setting double, auc double")


def summary(results: DataFrame) -> DataFrame:
    """``model, rounds, mean_auc, sd_auc, setting`` (the one chosen most often, the smaller of equals), ``chosen``."""
    picked = results.groupBy("model", "setting").agg(F.count(F.lit(1)).alias("n")).groupBy("model").agg(
        F.max_by("setting", F.struct("n", -F.col("setting"))).alias("setting"), F.max("n").alias("chosen"))
    auc = results.groupBy("model").agg(F.count(F.lit(1)).alias("rounds"), F.avg("auc").alias("mean_auc"), F.stddev_samp("auc").alias("sd_auc"))
    return auc.join(picked, "model")
