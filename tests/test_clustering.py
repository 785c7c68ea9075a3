import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestat.operators import clustering as C


@pytest.fixture(scope="module")
def points(spark):
    # two groups in two clusters: B is large and left, A small and right of each cluster's middle
    rng = np.random.default_rng(0)
    rows = []
    for k in range(2):
        rows += [([float(x), float(y)], "A") for x, y in rng.normal([5, 100 * k], 1 / 3, (10, 2))]
        rows += [([float(x), float(y)], "B") for x, y in rng.normal([-5, 100 * k], 1 / 3, (90, 2))]
    return spark.createDataFrame(rows, "features array<double>, grp string").repartition(3).cache()


def test_ties_go_to_the_first_centre(spark):
    p = spark.createDataFrame([([0.0], "A")], "features array<double>, grp string")
    assert C.assign(p, [[1.0], [-1.0]]).first()["cluster"] == 0


def test_folded_distance_agrees(spark, points, monkeypatch):
    centres = [[0.0, 0.0], [1.0, 100.0]]
    flat = [tuple(r) for r in C.assign(points, centres).select("cluster", F.round("dist", 9)).orderBy("features").collect()]
    monkeypatch.setattr(C, "UNROLL_LIMIT", 1)
    assert [tuple(r) for r in C.assign(points, centres).select("cluster", F.round("dist", 9)).orderBy("features").collect()] == flat


def test_fair_rounds_balance_the_groups(points):
    seeds = [[0.0, 1.0], [0.0, 99.0]]
    std = C.lloyd(points, seeds, 5)
    fair = C.fair_lloyd(points, 2, 5, seeds=seeds)
    phi_std, phi_fair = C.fair_objective(points, std).first()[0], C.fair_objective(points, fair).first()[0]
    assert phi_fair < 0.5 * phi_std
    each = {r["grp"]: r["m"] for r in C.assign(points, fair).groupBy("grp").agg(F.avg("dist").alias("m")).collect()}
    assert each["A"] == pytest.approx(each["B"], rel=0.02)
    assert C.fair_lloyd(points, 2, 0, seeds=seeds) == seeds
    assert len(C.fair_lloyd(points, 2, 2, metric="l1")) == 2


def test_absent_groups(spark):
    p = spark.createDataFrame([([0.0], "A"), ([1.0], "A"), ([9.0], "B")], "features array<double>, grp string")
    centres = [[0.5], [9.0], [50.0]]
    q = C.fair_parameters(C.cluster_group_sums(p, centres).collect(), centres)
    assert q["mu_a"].ravel().tolist() == [0.5, 9.0, 50.0] and q["mu_b"].ravel().tolist() == [0.5, 9.0, 50.0]
    assert q["alpha"].tolist() == [1, 0, 0] and q["fixed_a"] == pytest.approx(0.25)
    sizes = {r["cluster"]: (r["n_A"], r["n_B"]) for r in C.group_sizes(p, centres, ["A", "B"]).collect()}
    assert sizes == {0: (2, 0), 1: (0, 1), 2: (0, 0)}


def test_balance_meets_or_takes_the_end():
    p = {"alpha": np.array([0.5, 0.5]), "beta": np.array([0.2, 0.8]), "ell": np.array([3.0, 5.0]), "fixed_a": 1.0, "fixed_b": 0.4}
    x = C.balance(p)
    f_a = p["fixed_a"] + (p["alpha"] * x**2).sum()
    f_b = p["fixed_b"] + (p["beta"] * (p["ell"] - x) ** 2).sum()
    assert f_a == pytest.approx(f_b, rel=1e-9)
    # one group stays above the other wherever the centres lie
    assert C.balance({**p, "fixed_a": 1e6}).tolist() == [0.0, 0.0]
    assert C.balance({**p, "fixed_b": 1e6}).tolist() == pytest.approx(p["ell"].tolist())


def test_unknown_group_raises(spark):
    rows = [{"grp": "Z", "cluster": 0, "n": 1, "s0": 0.0, "q": 0.0}]
    with pytest.raises(ValueError):
        C.fair_parameters(rows, [[0.0]])
