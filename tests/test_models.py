import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestat.operators import classify, evaluate, grouptests, linear
from lodestat.functions.special import f_tail


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    n = 160
    x = rng.normal(size=(n, 4)) * [1, 20, 1, 1] + [0, 500, 0, 0]
    x[:, 3] = x[:, 2] + 0.05 * rng.normal(size=n)
    y = 3 + 2 * x[:, 0] - 0.1 * x[:, 1] + rng.normal(size=n)
    c = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 0] + x[:, 2])))).astype(int)
    rows = [(i, *map(float, r), float(v), int(k), "abc"[i % 3]) for i, (r, v, k) in enumerate(zip(x, y, c))]
    return x, y, c, spark.createDataFrame(rows, "id bigint, a double, b double, c double, d double, y double, k int, g string").repartition(4).cache()


def ols(x, y):
    z = np.column_stack([np.ones(len(x)), x])
    beta, *_ = np.linalg.lstsq(z, y, rcond=None)
    e = y - z @ beta
    inv = np.linalg.inv(z.T @ z)
    return z, beta, e, inv, np.einsum("ij,jk,ik->i", z, inv, z)


def test_least_squares(data):
    x, y, _, df = data
    names = ["a", "b", "c"]
    fit = linear.Fit(linear.gram(df, linear.terms_of(names), F.col("y")))
    z, beta, e, inv, h = ols(x[:, :3], y)
    t = fit.table()
    s2 = e @ e / (len(y) - 4)
    assert [r[1] for r in t] == pytest.approx(beta.tolist())
    assert [r[2] for r in t] == pytest.approx(np.sqrt(s2 * np.diag(inv)).tolist())
    assert fit.rss == pytest.approx(e @ e) and fit.df == len(y) - 4
    xs = linear.terms_of(names)
    res = linear.residual_table(df, fit, xs, F.col("y"), ["id"]).orderBy("id").toPandas()
    assert res["leverage"].to_numpy() == pytest.approx(h)
    assert res["std_resid"].to_numpy() == pytest.approx(e / np.sqrt(s2 * (1 - h)))
    assert res["normal_q"].sum() == pytest.approx(0, abs=1e-6)
    band = linear.predict_intervals(df, fit, xs).first()
    assert band["pred_lo"] < band["conf_lo"] < band["fit"] < band["conf_hi"] < band["pred_hi"]


def test_nested_f_is_t_squared(data):
    _, _, _, df = data
    g = linear.gram(df, linear.terms_of(["a", "b", "c"]), F.col("y"))
    full = linear.Fit(g)
    f, d1, d2, p = linear.nested_f(linear.Fit(g.keep(["a", "b"])), full)
    row = full.table()[3]
    assert f == pytest.approx(row[3] ** 2) and p == pytest.approx(row[4]) and d1 == 1
    assert linear.anova_frame(df.sparkSession, {"0": linear.Fit(g.keep(["a", "b"])), "1": full}).collect()[1]["f"] == pytest.approx(f)


def test_published_f_arithmetic():
    # residual sums of squares of a known pair of nested models: 1611057 on 40 df, 1426447 on 33
    f = ((1611057 - 1426447) / 7) / (1426447 / 33)
    assert f == pytest.approx(0.610, abs=5e-4) and 0.7 < f_tail(f, 7, 33) < 0.8


def test_elimination_and_inflation(data):
    _, _, _, df = data
    g = linear.gram(df, linear.terms_of(["a", "b", "c", "d"]), F.col("y"))
    fit, dropped = linear.backward_elimination(g)
    assert set(fit.g.terms) >= {"a", "b"} and all(p > 0.05 for _, p in dropped)
    v, gone = linear.vif_pruning(g)
    assert len(gone) == 1 and gone[0][0] in "cd" and max(v.values()) < 10


def test_best_subsets_against_all_fits(data):
    x, y, _, df = data
    g = linear.gram(df, linear.terms_of(["a", "b", "c"]), F.col("y"))
    for r in linear.best_subsets(df.sparkSession, g).collect():
        import itertools
        want = min((ols(x[:, list(s)], y)[2] ** 2).sum() for s in itertools.combinations(range(3), r["size"]))
        assert r["rss"] == pytest.approx(want)


def test_cross_validation(data):
    x, y, _, df = data
    xs = linear.terms_of(["a", "b"])
    fit = linear.Fit(linear.gram(df, xs, F.col("y")))
    loo = []
    for i in range(len(y)):
        keep = np.arange(len(y)) != i
        beta = ols(x[keep, :2], y[keep])[1]
        loo.append((y[i] - beta[0] - x[i, :2] @ beta[1:]) ** 2)
    assert linear.loocv(df, {"m": fit}, xs, F.col("y")).first()["cv_error"] == pytest.approx(np.mean(loo))
    fold = np.arange(len(y)) % 4
    sse = 0.0
    for k in range(4):
        beta = ols(x[fold != k][:, :2], y[fold != k])[1]
        sse += ((y[fold == k] - beta[0] - x[fold == k][:, :2] @ beta[1:]) ** 2).sum()
    (_, got), = linear.kfold(df, {"m": ["a", "b"]}, xs, F.col("y"), F.pmod("id", F.lit(4)))
    assert got == pytest.approx(sse / len(y))


def test_polynomials_fit_like_raw_powers(data):
    x, y, _, df = data
    basis = linear.legendre(df, "b", 3)
    fit = linear.Fit(linear.gram(df, basis, F.col("y")))
    z = (x[:, 1] - x[:, 1].mean()) / x[:, 1].std()
    _, beta, e, _, _ = ols(np.column_stack([z, z ** 2, z ** 3]), y)
    assert fit.rss == pytest.approx(e @ e)


def test_wide_sums_skip_empty_tasks(data):
    _, _, _, df = data
    thin = df.filter("id < 40").repartition(64, "g")
    names = ["a", "b", "c", "d"]
    x = {**linear.terms_of(names), **linear.interaction(linear.terms_of(["a"]), linear.terms_of(["b", "c"]))}
    assert linear.gram(thin, x, F.col("y")).n == 40


def test_contrasts(data):
    _, y, _, df = data
    fit = linear.Fit(linear.gram(df, linear.treatment("g", ["b", "a", "c"]), F.col("y")))
    got = {r[0]: r[1] for r in fit.table()}
    m = {g: y[[i for i in range(len(y)) if "abc"[i % 3] == g]].mean() for g in "abc"}
    assert got["(Intercept)"] == pytest.approx(m["b"]) and got["ga"] == pytest.approx(m["a"] - m["b"])


def test_group_tests(data):
    _, y, _, df = data
    m = grouptests.group_moments(df, "g", "y")
    fit = linear.Fit(linear.gram(df, linear.treatment("g", ["a", "b", "c"]), F.col("y")))
    a = grouptests.one_way(m)
    assert a["f"] == pytest.approx(fit.f)
    two = [r for r in m if r[0] != "c"]
    _, t, d, p = grouptests.two_sample_t(two)
    assert grouptests.one_way(two)["f"] == pytest.approx(t * t) and grouptests.one_way(two)["p"] == pytest.approx(p)
    # with two groups the range test is the t test
    assert grouptests.tukey_pairs(two)[0][4] == pytest.approx(p, abs=1e-4)


def test_logistic_and_deviance(data):
    x, _, c, df = data
    model = classify.logistic(df, ["a", "c"], "k")
    z = np.column_stack([np.ones(len(c)), x[:, [0, 2]]])
    beta = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-z @ beta))
        beta += np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z, z.T @ (c - p))
    t = classify.logistic_table(df.sparkSession, model, ["a", "c"]).collect()
    assert [r["estimate"] for r in t] == pytest.approx(beta.tolist(), rel=1e-5)
    assert t[0]["z"] == pytest.approx(t[0]["estimate"] / t[0]["std_error"])
    p = 1 / (1 + np.exp(-z @ beta))
    dev = -2 * np.sum(np.where(c == 1, np.log(p), np.log(1 - p)))
    assert model.summary.deviance == pytest.approx(dev)
    got = classify.logistic_scores(df, model, ["a", "c"]).orderBy("id").toPandas()
    assert got["prob"].to_numpy() == pytest.approx(p, rel=1e-5) and got["link"].to_numpy() == pytest.approx(z @ beta, rel=1e-4, abs=1e-5)


def gauss(x, m, s):
    d = x - m
    return np.exp(-0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(s), d)) / math.sqrt(np.linalg.det(s))


def test_discriminants(data):
    x, _, c, df = data
    z = x[:, :2]
    m = classify.class_moments(df, ["a", "b"], "k")
    parts = [z[c == k] for k in (0, 1)]
    pooled = sum((len(p) - 1) * np.cov(p.T) for p in parts) / (len(z) - 2)
    for fn, covs in ((classify.lda, [pooled, pooled]), (classify.qda, [np.cov(p.T) for p in parts])):
        w = [len(p) / len(z) * gauss(z, p.mean(axis=0), s) for p, s in zip(parts, covs)]
        got = fn(df, m).orderBy("id").toPandas()["post_1"].to_numpy()
        assert got == pytest.approx(w[1] / (w[0] + w[1]))


def test_mixed_naive_bayes_prefers_the_right_class(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(300):
        k = i % 2
        rows.append((i, k, "x" if rng.random() < 0.8 - 0.6 * k else "y", bool(rng.random() < 0.2 + 0.5 * k), float(rng.normal(k)), float(rng.normal(2 * k)), float(rng.normal())))
    df = spark.createDataFrame(rows, "id int, k int, c string, b boolean, f double, u double, v double")
    out = classify.mixed_naive_bayes(df, df, "k", {"c": ["x", "y"]}, ["b"], "f", ["u", "v"]).toPandas()
    assert ((out["post_1"] > 0.5).astype(int) == out["k"]).mean() > 0.85
    assert (out["post_0"] + out["post_1"]).to_numpy() == pytest.approx(1)


def test_auc_and_roc_with_ties(spark):
    rng = np.random.default_rng(2)
    s, k = rng.integers(0, 6, 200) / 5, rng.integers(0, 2, 200)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, k)], "s double, k int")
    pos, neg = s[k == 1], s[k == 0]
    want = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    truth = F.col("k") == 1
    assert evaluate.auc(df, truth, "s").first()["auc"] == pytest.approx(want)
    roc = {r["threshold"]: (r["tpr"], r["fpr"]) for r in evaluate.roc_points(df, truth, "s").collect()}
    assert roc[0.0] == (1.0, 1.0) and roc[1.0] == pytest.approx(((pos >= 1).mean(), (neg >= 1).mean()))


def test_confusion_edges(spark):
    df = spark.createDataFrame([(0.5, True), (0.2, False)], "s double, k boolean")
    loose = evaluate.confusion(df, F.col("k"), F.col("s"), 0.5).first()
    strict = evaluate.confusion(df, F.col("k"), F.col("s"), 0.5, strict=True).first()
    assert (loose["tp"], loose["error"]) == (1, 0.0) and strict["tp"] == 0 and strict["ppv"] is None


def test_power_transforms(spark):
    rng = np.random.default_rng(3)
    x = np.exp(rng.normal(size=4000))
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    best = evaluate.power_likelihood(df, "x", "box-cox").orderBy(F.desc("log_lik")).first()["lambda"]
    assert abs(best) <= 0.1
    signed = spark.createDataFrame([(-0.5,), (0.0,), (2.0,)], "x double")
    for lam in (0.0, 0.7, 2.0):
        got = [r[0] for r in signed.select(evaluate.power_value(F.col("x"), lam, "yeo-johnson")).collect()]
        want = [-(1.5 ** (2 - lam) - 1) / (2 - lam) if lam != 2 else -math.log(1.5), 0.0, (3 ** lam - 1) / lam if lam else math.log(3)]
        assert got == pytest.approx(want)


def test_exact_split_sizes(data):
    _, _, _, df = data
    parts = dict(evaluate.exact_split(df, "id", {"a": 0.5, "b": 0.25, "c": 0.25}).groupBy("part").count().collect())
    assert parts == {"a": 80, "b": 40, "c": 40}
    one = {r["id"] for r in evaluate.exact_split(df, "id", {"a": 0.5, "b": 0.5}, seed=1).filter("part = 'a'").collect()}
    two = {r["id"] for r in evaluate.exact_split(df, "id", {"a": 0.5, "b": 0.5}, seed=9).filter("part = 'a'").collect()}
    assert one != two and len(one) == len(two)


def test_user_model_batches(spark):
    from lodestat.operators.inference import classify_batches
    df = spark.createDataFrame([("good thing",), ("bad",)] * 40, "t string")
    sizes = []

    def model(texts):
        sizes.append(len(texts))
        return [1.0 if "good" in x else 0.0 for x in texts]
    out = classify_batches(df, "t", model, {0: "no", 1: "yes"}, batch=16).groupBy("predicted").count().collect()
    assert dict(out) == {"yes": 40, "no": 40}


def test_newton_steps_do_not_read_the_texts_again(spark, monkeypatch):
    from lodestat.plans import classes

    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def read(x):
        seen.add(1)
        return x

    rows = [(i, i % 3 % 2, float(i % 7)) for i in range(60)]
    d = spark.createDataFrame(rows, "doc_id long, quality int, avg_len double").withColumn("avg_len", read("avg_len"))
    monkeypatch.setattr(classes, "scored", lambda t: d)
    got = classes.l07b(None).collect()
    assert len(got) == 60 and all(0 < r["prob"] < 1 for r in got)
    assert seen.value == 60
