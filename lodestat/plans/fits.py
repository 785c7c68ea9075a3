"""Distribution fits to the out-degrees of the directed word networks."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestat.operators import distfit
from lodestat.operators.linkdegrees import link_degrees
from lodestat.plans import standins as S
from lodestat.plans.graphs import LANG
from lodestat.plans.registry import query
from lodestat.plans.tabular import r
from lodestat.session import cut


def out_degrees(t):
    """Out-degrees above zero: every node of a link is counted where it is the source."""
    return cut(link_degrees(S.document_words(t), "lang", "words", directed=True).select(*LANG, "degree"))


_STATS_SQL = f"""{S.DEDGES_SQL}, deg AS (SELECT lang, src, count(*) AS k FROM de GROUP BY ALL),
 st AS (SELECT lang, count(*) AS n, CAST(sum(k) AS BIGINT) AS m, sum(ln(k)) AS sl, sum(lgamma(k + 1)) AS slf, max(k) AS k_max FROM deg GROUP BY 1)"""


@query("d01_sufficient_stats", f"WITH {_STATS_SQL} SELECT lang, n, m, round(sl, 4) AS sum_log, round(slf, 2) AS sum_log_fact, k_max FROM st")
def d01(t):
    return distfit.sufficient_stats(out_degrees(t), LANG).select("lang", "n", "m", r("sum_log", 4).alias("sum_log"), r("sum_log_fact", 2).alias("sum_log_fact"), "k_max")


_GEO = "(m - n) * ln(1 - n / m) + n * ln(n / m)"
_Z2 = "-2.0 * sl - n * ln(pi() * pi() / 6)"


@query("d02_geometric", f"WITH {_STATS_SQL} SELECT lang, round(n / m, 9) AS q, round({_GEO}, 3) AS log_lik FROM st")
def d02(t):
    return distfit.fit_geometric(distfit.sufficient_stats(out_degrees(t), LANG), LANG).select("lang", r("p1", 9).alias("q"), r("log_lik", 3).alias("log_lik"))


# the displaced mean M/N = L / (1 - exp(-L)) solved by fixed-point steps L <- (M/N)(1 - exp(-L))
@query("d03_poisson", f"""WITH RECURSIVE {_STATS_SQL}, it(lang, i, l) AS (SELECT lang, 0, m / n FROM st UNION ALL
  SELECT it.lang, i + 1, m / n * (1 - exp(-l)) FROM it JOIN st ON st.lang = it.lang WHERE i < 200)
 SELECT lang, round(l, 6) AS lambda, round(m * ln(l) - n * (l + ln(1 - exp(-l))) - slf, 2) AS log_lik FROM it JOIN st USING (lang) WHERE i = 200""")
def d03(t):
    f = distfit.fit_searched(distfit.sufficient_stats(out_degrees(t), LANG), LANG, ["poisson"])
    return f.select("lang", r("p1").alias("lambda"), r("log_lik", 2).alias("log_lik"))


@query("d04_zeta")
def d04(t):
    return distfit.fit_searched(distfit.sufficient_stats(out_degrees(t), LANG), LANG, ["zeta"])


@query("d05_zeta_two", f"WITH {_STATS_SQL} SELECT lang, round({_Z2}, 3) AS log_lik, round(-2 * ({_Z2}), 3) AS aicc FROM st")
def d05(t):
    f = distfit.compare_models(distfit.fit_zeta2(distfit.sufficient_stats(out_degrees(t), LANG), LANG), LANG)
    return f.select("lang", r("log_lik", 3).alias("log_lik"), r("aicc", 3).alias("aicc"))


# Newton on d/dg [g * sl + n * ln(sum k^-g)]; the sums run over 1..k_max
@query("d06_zeta_truncated", f"""WITH RECURSIVE {_STATS_SQL}, ks AS (SELECT lang, unnest(range(1, k_max + 1)) AS k FROM st),
 it(lang, i, g) AS (SELECT lang, 0, CAST(1.2 AS DOUBLE) FROM st UNION ALL
  SELECT lang, i + 1, g - (sl - n * s1 / s0) / (n * (s2 / s0 - (s1 / s0) ** 2)) FROM (SELECT it.lang, any_value(i) AS i, any_value(g) AS g, any_value(sl) AS sl, any_value(n) AS n,
    sum(k ** -g) AS s0, sum(k ** -g * ln(k)) AS s1, sum(k ** -g * ln(k) ** 2) AS s2 FROM it JOIN ks ON ks.lang = it.lang JOIN st ON st.lang = it.lang WHERE i < 25 GROUP BY it.lang)),
 fin AS (SELECT lang, g FROM it WHERE i = 25), z AS (SELECT lang, any_value(g) AS g, sum(k ** -g) AS s0 FROM fin JOIN ks USING (lang) GROUP BY 1)
 SELECT lang, round(g, 5) AS gamma, CAST(k_max AS DOUBLE) AS k_max, round(-g * sl - n * ln(s0), 2) AS log_lik FROM z JOIN st USING (lang)""")
def d06(t):
    f = distfit.fit_searched(distfit.sufficient_stats(out_degrees(t), LANG), LANG, ["zeta_truncated"])
    return f.select("lang", r("p1", 5).alias("gamma"), F.col("p2").alias("k_max"), r("log_lik", 2).alias("log_lik"))


@query("d07_altmann")
def d07(t):
    return distfit.fit_searched(distfit.sufficient_stats(out_degrees(t), LANG), LANG, ["altmann"])


@query("d08_model_comparison", f"""WITH {_STATS_SQL}, f AS (SELECT lang, n, 'geometric' AS model, {_GEO} AS ll, 1 AS k FROM st UNION ALL SELECT lang, n, 'zeta2', {_Z2}, 0 FROM st),
 a AS (SELECT *, CASE WHEN k = 0 THEN -2 * ll ELSE -2 * ll + 2 * k * n / (n - k - 1) END AS aicc FROM f)
 SELECT lang, model, round(aicc, 3) AS aicc, round(aicc - min(aicc) OVER (PARTITION BY lang), 3) AS delta_aicc FROM a""")
def d08(t):
    st = distfit.sufficient_stats(out_degrees(t), LANG)
    f = distfit.compare_models(distfit.fit_geometric(st, LANG).unionByName(distfit.fit_zeta2(st, LANG)), LANG)
    return f.select("lang", "model", r("aicc", 3).alias("aicc"), r("delta_aicc", 3).alias("delta_aicc"))


@query("d09_all_models")
def d09(t):
    return distfit.fit_models(out_degrees(t), LANG)


@query("d09b_parameter_table")
def d09b(t):
    return distfit.parameter_table(distfit.fit_models(out_degrees(t), LANG), LANG)


@query("d10_fitted_pmf", f"""WITH {_STATS_SQL}, h AS (SELECT lang, k, count(*) AS c FROM deg GROUP BY ALL), ks AS (SELECT lang, n, m, unnest(range(1, k_max + 1)) AS k FROM st),
 f AS (SELECT lang, 'geometric' AS model, k, n, exp((k - 1) * ln(1 - n / m) + ln(n / m)) AS p FROM ks UNION ALL SELECT lang, 'zeta2', k, n, exp(-2.0 * ln(k) - ln(pi() * pi() / 6)) FROM ks)
 SELECT f.lang, model, f.k AS degree, round(c / n, 9) AS observed, CASE WHEN p > 0 THEN round(p, 9) END AS fitted FROM f LEFT JOIN h ON h.lang = f.lang AND h.k = f.k""")
def d10(t):
    deg = out_degrees(t)
    fits = distfit.fit_models(deg, LANG, ("geometric", "zeta2"))
    return distfit.fitted_pmf(deg, fits, LANG).select("lang", "model", "degree", r("observed", 9).alias("observed"), r("fitted", 9).alias("fitted"))
