"""Trees, support vector machines, kernel densities and the model comparison against plain versions."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestat.operators import comparison, margins, trees
from lodestat.operators.density import kernel_density


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(11)
    x = np.column_stack([rng.integers(0, 12, 300), rng.integers(0, 7, 300), np.round(rng.normal(size=300), 1)]).astype(float)
    y = ((x[:, 0] > 5) ^ (x[:, 2] > 0.4) ^ (rng.random(300) < 0.15)).astype(int)
    rows = [(i, *map(float, r), int(k), "uv"[i % 2]) for i, (r, k) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(rows, "id long, a double, b double, c double, y int, half string").repartition(4)


def _plain_tree(x, y, depth, least):
    """Every cut at every value, by recursion."""
    out = trees.Tree()

    def go(i, rows, left):
        n = np.bincount(y[rows], minlength=2)
        out.counts[i] = n
        if not left or n.min() == 0 or n.sum() < 2 * least:
            return
        best = None
        for f in range(x.shape[1]):
            for v in np.unique(x[:, f])[:-1]:
                lo = np.bincount(y[rows[x[rows, f] <= v]], minlength=2)
                hi = n - lo
                if lo.sum() < least or hi.sum() < least:
                    continue
                gain = 2 * n[0] * n[1] / n.sum() - 2 * lo[0] * lo[1] / lo.sum() - 2 * hi[0] * hi[1] / hi.sum()
                if gain > 1e-12 and (best is None or round(gain, 9) > best[0]):
                    best = (round(gain, 9), f, v)
        if best is None:
            return
        out.cuts[i] = best[1:]
        go(2 * i + 1, rows[x[rows, best[1]] <= best[2]], left - 1)
        go(2 * i + 2, rows[x[rows, best[1]] > best[2]], left - 1)

    go(0, np.arange(len(x)), depth)
    return out


def test_trees_are_those_of_plain_recursion(table):
    x, y, df = table
    want = _plain_tree(x, y, 4, 5)
    got = trees.grow(df, ["a", "b", "c"], "y", depth=4, least=5, bins=100)[""]
    assert got.cuts == want.cuts and {k: v.tolist() for k, v in got.counts.items()} == {k: v.tolist() for k, v in want.counts.items()}
    scored = trees.scored(df, ["a", "b", "c"], {"": got}).orderBy("id").toPandas()
    assert scored["score"].to_numpy() == pytest.approx(want.predict(x))


def test_many_trees_grow_together(table):
    x, y, df = table
    got = trees.grow(df, ["a", "b", "c"], "y", depth=3, least=4, bins=100, by="half")
    assert set(got) == {"u", "v"}
    for k, rows in (("u", np.arange(0, 300, 2)), ("v", np.arange(1, 300, 2))):
        # cut values come from all rows, counts from the tree's own
        alone = trees.grow(df.filter(F.col("half") == k), ["a", "b", "c"], "y", depth=3, least=4, bins=100)[""]
        assert got[k].counts[0].tolist() == np.bincount(y[rows], minlength=2).tolist() == alone.counts[0].tolist()
        assert {i: f for i, (f, _) in got[k].cuts.items()} == {i: f for i, (f, _) in alone.cuts.items()}
    frame = trees.frame(df.sparkSession, got, ["a", "b", "c"]).toPandas()
    assert len(frame) == sum(len(t.counts) for t in got.values())


def _subtrees(t, i=0):
    yield {i}
    if i in t.cuts:
        for l, r in itertools.product(_subtrees(t, 2 * i + 1), _subtrees(t, 2 * i + 2)):
            yield l | r


def test_pruning_minimises_its_cost(table):
    x, y, _ = table
    t = _plain_tree(x, y, 4, 5)
    total = t.counts[0].sum()

    def cost(leaves, a):
        return sum(int(t.counts[i].min()) for i in leaves) / total + a * len(leaves)

    for a in (0.0, 0.003, 0.01, 0.02, 0.05, 0.3):
        best = min(_subtrees(t), key=lambda s: (round(cost(s, a), 12), len(s)))
        got = trees.pruned(t, a).leaves()
        assert cost(got, a) == pytest.approx(cost(best, a)) and len(got) == len(best)
    alphas = [a for a, _ in trees.weakest_links(t)]
    assert alphas == sorted(alphas)


def test_quantile_cuts_and_nulls(spark):
    rows = [(float(i), None if i % 10 == 0 else float(i % 3), int(i >= 500)) for i in range(1000)]
    df = spark.createDataFrame(rows, "x double, z double, y int")
    got = trees.grow(df, ["x", "z"], "y", depth=2, bins=16)[""]
    assert got.cuts[0][0] == 0 and abs(got.cuts[0][1] - 499) <= 1000 / 16
    assert trees.grow(df.limit(0), ["x"], "y") == {}
    alone = trees.grow(df.filter("y = 1"), ["x", "z"], "y")[""]
    assert not alone.cuts and alone.share(0) == 1.0


def _plain_margin(x, y, strength, sweeps=2000):
    """Dual coordinate ascent to high accuracy; returns the objective."""
    x, s = np.column_stack([x, np.ones(len(x))]), 2.0 * y - 1
    a, w, c = np.zeros(len(x)), np.zeros(x.shape[1]), 1 / (strength * len(x))
    q = (x**2).sum(1)
    for _ in range(sweeps):
        for i in range(len(x)):
            new = min(c, max(0.0, a[i] + (1 - s[i] * (x[i] @ w)) / q[i]))
            w += (new - a[i]) * s[i] * x[i]
            a[i] = new
    return strength / 2 * w @ w + np.maximum(0, 1 - s * (x @ w)).mean()


def test_margins_reach_the_optimum(table):
    x, y, df = table
    x = x / [12, 7, 1]
    df = df.withColumn("x", F.array(F.col("a") / 12, F.col("b") / 7, "c")).withColumn("h", F.col("half"))
    got = margins.fit(df, "x", "y", {"u": 0.01, "v": 0.1}, "h", tolerance=1e-3)
    for k, strength, at in (("u", 0.01, 0), ("v", 0.1, 1)):
        want = _plain_margin(x[at::2], y[at::2], strength)
        assert got[k]["gap"] <= 1e-3 and got[k]["objective"] == pytest.approx(want, abs=2e-3)
        assert got[k]["objective"] >= want - 1e-4
    scored = margins.margins(df, "x", got, "h").orderBy("id").toPandas()
    w = [got["uv"[i % 2]]["w"] for i in range(300)]
    assert scored["score"].to_numpy() == pytest.approx([np.append(r, 1) @ v for r, v in zip(x, w)])
    with pytest.raises(margins.NotConverged):
        margins.fit(df, "x", "y", {"u": 1e-4}, "h", tolerance=1e-9, rounds=2)


def test_landmark_kernel_beats_the_line_on_a_ring(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 2))
    y = (np.hypot(*x.T) > 1.1).astype(int)
    df = spark.createDataFrame([(i, r.tolist(), int(k)) for i, (r, k) in enumerate(zip(x, y))], "id long, x array<double>, y int")
    marks = margins.landmarks(df, "x", "id", 40)
    assert len(marks) == 40
    df = df.withColumn("z", margins.kernel_map(F.col("x"), marks, 1.0))
    z = np.array([r["z"] for r in df.orderBy("id").select("z").collect()])
    at = [int(np.flatnonzero((x == m).all(1))[0]) for m in marks]
    exact = np.exp(-0.5 * ((x[at][:, None] - x[at][None]) ** 2).sum(2))
    assert z[at] @ z[at].T == pytest.approx(exact, abs=1e-6)

    def accuracy(column):
        fit = margins.fit(df, column, "y", {"": 0.001}, tolerance=1e-2)
        return margins.margins(df, column, fit).agg(F.avg(((F.col("score") > 0).cast("int") == F.col("y")).cast("double"))).first()[0]

    assert accuracy("z") > 0.93 > 0.8 > accuracy("x")


def test_density_equals_the_plain_sum(spark):
    rng = np.random.default_rng(5)
    v = np.concatenate([np.round(rng.normal(size=300), 2), rng.normal(30, 0.01, 50), [0.5] * 40, [-80.0]])
    df = spark.createDataFrame([(float(x), "ab"[i % 2]) for i, x in enumerate(v)], "v double, g string")
    places = spark.createDataFrame([(float(x),) for x in [*v, 3.3, 100.0, -81.5, 4.9]] + [(None,)], "v double")
    h = {"a": 0.31, "b": 0.07}
    got = {(r["g"], r["v"]): r["density"] for r in kernel_density(df, places, "v", h, "g").collect()}
    assert len(got) == 2 * len(set([*v, 3.3, 100.0, -81.5, 4.9]))
    for (g, x), d in got.items():
        own = v["ab".index(g)::2]
        want = np.exp(-0.5 * ((x - own) / h[g]) ** 2).sum() / (len(own) * h[g] * np.sqrt(2 * np.pi))
        # beyond the reach of 12 bandwidths a density is 0
        assert d == pytest.approx(want, rel=1e-11, abs=1e-30), (g, x)
    with pytest.raises(ValueError):
        kernel_density(df, places, "v", {"a": 0.0, "b": 1.0}, "g")


def test_comparison_names_four_models_and_their_settings(spark, table):
    rng = np.random.default_rng(8)
    y = rng.integers(0, 2, 240)
    rows = [(i, int(k), float(rng.normal(2 * k)), float(rng.normal(k, 2)), "xyz"[int(rng.integers(0, 3))], int(rng.random() < 0.3 + 0.4 * k), float(rng.normal(k)), float(rng.normal()))
            for i, k in enumerate(y)]
    df = spark.createDataFrame(rows, "doc_id long, quality int, u double, v double, cat string, flag int, ker double, w double")
    c = comparison.Columns(["u", "v"], "doc_id", "quality", {"cat": ["x", "y"]}, ["flag"], "ker", ["u", "w"])
    results = comparison.compare_models(df, c, rounds=2, folds=2)
    got = results.toPandas()
    assert sorted(got["model"].unique()) == ["logistic", "mixed_naive_bayes", "svm", "tree"] and len(got) == 8
    assert (got["auc"] > 0.75).all()
    assert set(got[got["model"] == "tree"]["setting"]) <= set(comparison.ALPHAS) and set(got[got["model"] == "svm"]["setting"]) <= set(comparison.STRENGTHS)
    s = comparison.summary(results).toPandas()
    assert (s["rounds"] == 2).all() and s["chosen"].between(1, 2).all()


def test_fits_of_all_folds_equal_fits_alone(spark):
    from lodestat.operators import classify
    from lodestat.operators.comparison import Columns, _asked, _copies, naive_scores, splits

    rng = np.random.default_rng(9)
    rows = [(i, i % 2, float(rng.normal(i % 2)), "xyz"[i % 3], int(rng.random() < 0.4), round(float(rng.normal(i % 2)), 1), float(rng.normal())) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, quality int, u double, cat string, flag int, ker double, w double")
    c = Columns(["u"], "doc_id", "quality", {"cat": ["x", "y"]}, ["flag"], "ker", ["u", "w"])
    placed = splits(df, c, 1, 3)
    sizes = {(r["part"], r["fold"]): r["count"] for r in placed.groupBy("part", "fold").count().collect()}
    assert sum(n for (p, _), n in sizes.items() if p == "train") == 120 and {n for (p, _), n in sizes.items() if p == "train"} == {40}
    got = {r["doc_id"]: r["score"] for r in naive_scores(_copies(placed, 3), _asked(placed, 3, comparison.WIDTHS), c).filter("part = 'test' and setting = 2.0").collect()}
    alone = classify.mixed_naive_bayes(placed.filter("part = 'train'"), placed.filter("part = 'test'"), "quality", {"cat": ["x", "y"]}, ["flag"], "ker", ["u", "w"], width=2.0)
    want = {r["doc_id"]: np.log(r["post_1"] / r["post_0"]) for r in alone.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-6) for k in got)
    w = comparison.logistic_newton(placed.withColumn("x", F.array("_z0")).withColumn("m", F.lit("a")), "x", "quality", {"a": 0.0001}, "m")["a"]
    glm = classify.logistic(placed, ["_z0"], "quality")
    assert w[0] == pytest.approx(glm.coefficients[0], rel=0.02) and w[1] == pytest.approx(glm.intercept, abs=0.02)


def test_quantile_edges_are_exact(spark):
    x = np.random.default_rng(2).normal(size=(20_001, 2))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double")
    at = np.ceil(len(x) * np.arange(1, 33) / 32.0).astype(int) - 1
    assert trees.edges(df, ["a", "b"], 32) == [np.sort(x[:, i])[at][:-1].tolist() for i in range(2)]


def test_density_plans_stay_short(spark, monkeypatch):
    """A column per moment made plans of many nested products, which the driver could not hold."""
    from lodestat.operators import density
    seen = []
    monkeypatch.setattr(density, "cut", lambda df, real=density.cut: seen.append(len(df._jdf.queryExecution().optimizedPlan().toJSON())) or real(df))
    df = spark.createDataFrame([(float(i % 7), "a") for i in range(50)], "x double, g string")
    assert kernel_density(df, df.select("x"), "x", {"a": 0.7}, "g").count() == 7
    assert seen and max(seen) < 60_000, seen
