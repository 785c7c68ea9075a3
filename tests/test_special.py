import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestat.functions import special as sp
from lodestat.functions.quantile import normal_quantile


def test_tails_match_published_tables():
    assert sp.t_tail(2.228139, 10) == pytest.approx(0.05, abs=1e-6)
    assert sp.f_tail(4.964603, 1, 10) == pytest.approx(0.05, abs=1e-6)
    assert sp.chi2_tail(3.841459, 1) == pytest.approx(0.05, abs=1e-6)
    assert sp.chi2_tail(18.307038, 10) == pytest.approx(0.05, abs=1e-6)
    assert sp.t_ppf(0.975, 30) == pytest.approx(2.042272, abs=1e-5)
    assert sp.norm_ppf(0.975) == pytest.approx(1.959963984540054, abs=1e-10)
    assert sp.f_tail(2.5 ** 2, 1, 17) == pytest.approx(sp.t_tail(2.5, 17), rel=1e-10)


@pytest.mark.parametrize("q,k,df", [(3.877, 3, 10), (4.232, 5, 20), (3.578, 3, 20), (3.314, 3, 1e9)])
def test_studentised_range(q, k, df):
    assert sp.tukey_tail(q, k, df) == pytest.approx(0.05, abs=5e-4)


def test_zeta_and_power_sums():
    assert sp.zeta(2) == pytest.approx(math.pi ** 2 / 6, rel=1e-10)
    assert sp.zeta(1.5) == pytest.approx(2.6123753486854883, rel=1e-9)
    k = np.arange(1, 50001, dtype=float)
    for g, d in [(0.3, 0.0), (1.7, 0.0), (1.1, 1e-4)]:
        f = k ** -g * np.exp(-d * k)
        want = [f.sum(), (f * np.log(k)).sum(), (f * k).sum(), (f * np.log(k) ** 2).sum(), (f * k * np.log(k)).sum(), (f * k * k).sum()]
        assert sp.power_sums(g, d, 50000, 2) == pytest.approx(want, rel=1e-7)


def test_normal_quantile_column(spark):
    ps = [1e-12, 1e-4, 0.01, 0.2, 0.5, 0.61, 0.93, 0.999, 1 - 1e-9]
    got = [r[0] for r in spark.createDataFrame([(p,) for p in ps], "p double").select(normal_quantile(F.col("p"))).collect()]
    assert got == pytest.approx([sp.norm_ppf(p) for p in ps], abs=1e-7)
