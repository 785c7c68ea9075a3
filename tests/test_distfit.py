import math

import numpy as np
import pytest

from lodestat.functions.special import power_sums, zeta
from lodestat.operators import distfit


def sample(pmf, n=4000):
    """Deterministic sample by inverse distribution function."""
    cdf = np.cumsum(pmf)
    return (np.searchsorted(cdf, (np.arange(n) + 0.5) / n) + 1).clip(max=len(pmf)).tolist()


K = np.arange(1, 3001, dtype=float)
CASES = {
    "geometric": (0.2 * 0.8 ** (K - 1), 0.2),
    "poisson": (np.array([math.exp(k * math.log(4) - 4 - math.lgamma(k + 1)) / (1 - math.exp(-4)) for k in K]), 4.0),
    "zeta": (K ** -2.5 / zeta(2.5), 2.5),
    "zeta_truncated": (np.where(K <= 60, K ** -1.3, 0) / (K[:60] ** -1.3).sum(), 1.3),
    "altmann": (K ** -1.0 * np.exp(-0.05 * K) / power_sums(1.0, 0.05, 3000)[0], 1.0),
}


@pytest.fixture(scope="module")
def fits(spark):
    rows = [(name, int(k)) for name, (pmf, _) in CASES.items() for k in sample(pmf)]
    deg = spark.createDataFrame(rows, "lang string, degree bigint").cache()
    return deg, {(r["lang"], r["model"]): r for r in distfit.fit_models(deg, ["lang"]).collect()}


def test_parameters_are_recovered(fits):
    _, f = fits
    for name, (_, p) in CASES.items():
        assert f[(name, name)]["p1"] == pytest.approx(p, rel=0.05), name
    assert f[("altmann", "altmann")]["p2"] == pytest.approx(0.05, rel=0.1)


def test_best_model_is_the_true_one(fits):
    _, f = fits
    for name in ("geometric", "poisson", "zeta_truncated"):
        best = min((r for (g, _), r in f.items() if g == name), key=lambda r: r["aicc"])
        assert best["model"] == name and best["delta_aicc"] == 0
    r = f[("zeta", "zeta2")]
    assert r["aicc"] == pytest.approx(-2 * r["log_lik"])


def test_likelihood_is_stationary(fits):
    deg, f = fits
    st = {r["lang"]: r for r in distfit.sufficient_stats(deg, ["lang"]).collect()}
    s, r = st["altmann"], f[("altmann", "altmann")]

    def ll(g, d):
        return -g * s["sum_log"] - d * s["m"] - s["n"] * math.log(power_sums(g, d, s["n"])[0])
    for dg, dd in [(1e-3, 0), (-1e-3, 0), (0, 1e-4), (0, -1e-4)]:
        assert ll(r["p1"] + dg, r["p2"] + dd) < r["log_lik"]


def test_bad_degrees_raise(spark):
    d = spark.createDataFrame([("x", 0)], "lang string, degree bigint")
    with pytest.raises(Exception, match="at least 1"):
        distfit.sufficient_stats(d, ["lang"]).collect()


def test_log_factorial(spark):
    ks = [1, 5, 15, 16, 40, 1000, 10 ** 6]
    from pyspark.sql import functions as F
    got = [r[0] for r in spark.createDataFrame([(k,) for k in ks], "k bigint").select(distfit.log_factorial(F.col("k"))).collect()]
    assert got == pytest.approx([math.lgamma(k + 1) for k in ks], rel=1e-13)


def test_fitted_pmf_sums_to_one(fits):
    deg, f = fits
    one = deg.filter("lang = 'zeta_truncated'")
    rows = distfit.fitted_pmf(one, distfit.fit_models(one, ["lang"]), ["lang"]).collect()
    total = sum(r["fitted"] for r in rows if r["model"] == "zeta_truncated")
    assert total == pytest.approx(1) and max(r["degree"] for r in rows) == 60
    assert sum(r["observed"] or 0 for r in rows if r["model"] == "zeta") == pytest.approx(1)
