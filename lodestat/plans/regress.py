"""Regression queries: price of a line item on quantity, discount, tax and line number."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestat.operators import evaluate, grouptests, linear
from lodestat.operators.frames import row_hash
from lodestat.plans import standins as S
from lodestat.plans.registry import query
from lodestat.plans.tabular import r, row_hash_sql

ALL = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
TWO = ["l_quantity", "l_discount"]


def price():
    return F.col("l_extendedprice")


def _gram(t, names, where=None):
    return linear.gram(t.lineitem, linear.terms_of(names), price(), where)


_ONE_SQL = """m AS (SELECT count(*) AS n, avg(l_quantity) AS mx, avg(l_extendedprice) AS my, regr_sxx(l_extendedprice, l_quantity) AS sxx,
  regr_syy(l_extendedprice, l_quantity) AS syy, regr_sxy(l_extendedprice, l_quantity) AS sxy FROM lineitem),
 f AS (SELECT *, sxy / sxx AS b1, my - sxy / sxx * mx AS b0, syy - sxy * sxy / sxx AS rss FROM m)"""

_TWO_SQL = """m AS (SELECT count(*) AS n, avg(l_quantity) AS m1, avg(l_discount) AS m2, avg(l_extendedprice) AS my,
  regr_sxx(l_extendedprice, l_quantity) AS s11, regr_sxx(l_extendedprice, l_discount) AS s22, regr_sxy(l_discount, l_quantity) AS s12,
  regr_sxy(l_extendedprice, l_quantity) AS s1y, regr_sxy(l_extendedprice, l_discount) AS s2y, regr_syy(l_extendedprice, l_quantity) AS syy FROM lineitem),
 i AS (SELECT *, s11 * s22 - s12 * s12 AS det FROM m), b AS (SELECT *, (s22 * s1y - s12 * s2y) / det AS b1, (s11 * s2y - s12 * s1y) / det AS b2 FROM i),
 f AS (SELECT *, my - b1 * m1 - b2 * m2 AS b0, syy - b1 * s1y - b2 * s2y AS rss, n - 3 AS df FROM b),
 v AS (SELECT *, rss / df AS s2, s22 / det AS i11, s11 / det AS i22, -s12 / det AS i12 FROM f),
 se AS (SELECT *, sqrt(s2 * (1.0 / n + m1 * m1 * i11 + 2 * m1 * m2 * i12 + m2 * m2 * i22)) AS e0, sqrt(s2 * i11) AS e1, sqrt(s2 * i22) AS e2 FROM v)"""
# the t quantile at 97.5 % by its expansion around the normal one
_Z = 1.959963984540054
_TQ = f"({_Z} + {(_Z**3 + _Z) / 4} / df + {(5 * _Z**5 + 16 * _Z**3 + 3 * _Z) / 96} / (df * df) + {(3 * _Z**7 + 19 * _Z**5 + 17 * _Z**3 - 15 * _Z) / 384} / (df * df * df))"


@query("l01_simple_regression", f"""WITH {_ONE_SQL} SELECT n, round(b1, 4) AS slope, round(b0, 3) AS intercept, round(sqrt(rss / (n - 2)), 4) AS rse, round(1 - rss / syy, 9) AS r2,
 round((SELECT sum(l_extendedprice - b0 - b1 * l_quantity) FROM lineitem, f) / n, 4) + 0.0 AS mean_resid, round((SELECT corr(l_extendedprice - b0 - b1 * l_quantity, l_quantity) FROM lineitem, f), 6) + 0.0 AS resid_x FROM f""")
def l01(t):
    d = t.lineitem
    m = d.agg(F.count(F.lit(1)).alias("n"), F.regr_slope("l_extendedprice", "l_quantity").alias("b1"), F.regr_intercept("l_extendedprice", "l_quantity").alias("b0"),
              F.regr_r2("l_extendedprice", "l_quantity").alias("r2"), F.regr_syy("l_extendedprice", "l_quantity").alias("syy"))
    b = m.first()
    e = F.col("l_extendedprice") - b["b0"] - b["b1"] * F.col("l_quantity")
    resid = d.select(e.alias("e"), "l_quantity").agg(F.avg("e").alias("me"), F.sum(F.col("e") * F.col("e")).alias("rss"), F.corr("e", "l_quantity").alias("rx"))
    return resid.select(F.lit(b["n"]).cast("bigint").alias("n"), F.lit(round(b["b1"], 4)).alias("slope"), F.lit(round(b["b0"], 3)).alias("intercept"),
                        r(F.sqrt(F.col("rss") / (b["n"] - 2)), 4).alias("rse"), r(1 - F.col("rss") / b["syy"], 9).alias("r2"),
                        (r("me", 4) + 0.0).alias("mean_resid"), (r("rx", 6) + 0.0).alias("resid_x"))


@query("l02_coefficients", f"""WITH {_TWO_SQL} SELECT unnest(['(Intercept)', 'l_quantity', 'l_discount']) AS term, unnest([round(b0, 3), round(b1, 3), round(b2, 3)]) AS estimate,
 unnest([round(e0, 4), round(e1, 4), round(e2, 4)]) AS std_error, unnest([round(b0 / e0, 5), round(b1 / e1, 5), round(b2 / e2, 5)]) AS t FROM se""")
def l02(t):
    c = linear.coefficient_frame(t.spark, linear.Fit(_gram(t, TWO)))
    return c.select("term", r("estimate", 3).alias("estimate"), r("std_error", 4).alias("std_error"), r("t", 5).alias("t"))


@query("l02b_full_table")
def l02b(t):
    return linear.coefficient_frame(t.spark, linear.Fit(_gram(t, ALL, where=F.col("l_returnflag") != "R")))


@query("l02c_summary", f"""WITH {_TWO_SQL} SELECT round(sqrt(s2), 4) AS rse, df::DOUBLE AS df, round(1 - rss / syy, 9) AS r2, round(1 - (rss / df) / (syy / (n - 1)), 9) AS adj_r2, round(((syy - rss) / 2) / s2, 3) AS f FROM v""")
def l02c(t):
    s = linear.summary_frame(t.spark, linear.Fit(_gram(t, TWO)))
    return s.select(r("rse", 4).alias("rse"), "df", r("r2", 9).alias("r2"), r("adj_r2", 9).alias("adj_r2"), r("f", 3).alias("f"))


@query("l03_intervals", f"""WITH {_TWO_SQL} SELECT unnest(['(Intercept)', 'l_quantity', 'l_discount']) AS term, unnest([round(b0 - {_TQ} * e0, 3), round(b1 - {_TQ} * e1, 3), round(b2 - {_TQ} * e2, 3)]) AS lower,
 unnest([round(b0 + {_TQ} * e0, 3), round(b1 + {_TQ} * e1, 3), round(b2 + {_TQ} * e2, 3)]) AS upper FROM se""")
def l03(t):
    c = linear.confidence_frame(t.spark, linear.Fit(_gram(t, TWO)))
    return c.select("term", r("lower", 3).alias("lower"), r("upper", 3).alias("upper"))


@query("l03b_prediction_intervals", f"""WITH {_TWO_SQL}, p AS (SELECT l_orderkey, l_linenumber, b0 + b1 * l_quantity + b2 * l_discount AS fit, {_TQ} * sqrt(s2) AS q,
  1.0 / n + (l_quantity - m1) ** 2 * i11 + 2 * (l_quantity - m1) * (l_discount - m2) * i12 + (l_discount - m2) ** 2 * i22 AS h FROM lineitem, v)
 SELECT l_orderkey, l_linenumber, round(fit, 2) AS fit, round(fit - q * sqrt(h), 2) AS conf_lo, round(fit + q * sqrt(h), 2) AS conf_hi, round(fit - q * sqrt(1 + h), 2) AS pred_lo, round(fit + q * sqrt(1 + h), 2) AS pred_hi FROM p""")
def l03b(t):
    x = linear.terms_of(TWO)
    p = linear.predict_intervals(t.lineitem, linear.Fit(_gram(t, TWO)), x)
    return p.select("l_orderkey", "l_linenumber", *[r(c, 2).alias(c) for c in ("fit", "conf_lo", "conf_hi", "pred_lo", "pred_hi")])


@query("l04_nested_f_test", f"""WITH {_TWO_SQL}, red AS (SELECT syy - s1y * s1y / s11 AS rss0 FROM m) SELECT 1.0::DOUBLE AS df1, df::DOUBLE AS df2, round(((rss0 - rss) / 1) / (rss / df), 6) AS f FROM v, red""")
def l04(t):
    g = _gram(t, TWO)
    f, d1, d2, _ = linear.nested_f(linear.Fit(g.keep(["l_quantity"])), linear.Fit(g))
    return t.spark.createDataFrame([(d1, d2, round(f, 6))], "df1 double, df2 double, f double")


@query("l04b_anova_table")
def l04b(t):
    g = _gram(t, ALL)
    return linear.anova_frame(t.spark, {"+".join(ALL[:k]): linear.Fit(g.keep(ALL[:k])) for k in range(1, 5)})


@query("l05_backward_elimination")
def l05(t):
    fit, dropped = linear.backward_elimination(_gram(t, ALL))
    rows = [(term, "kept", p) for term, _, _, _, p in fit.table()] + [(n, "dropped", p) for n, p in dropped]
    return t.spark.createDataFrame(rows, "term string, state string, p double")


DOC_X = ["n_chars", "n_tokens", "avg_len"]


@query("l06_vif_pruning", f"""WITH {S.SCORED_SQL} SELECT f AS term, round(1 / (1 - c * c), 4) AS vif FROM (SELECT corr(n_chars, n_tokens) AS c FROM sd), (VALUES ('n_chars'), ('n_tokens')) v(f)""")
def l06(t):
    g = linear.gram(S.scored_documents(t), linear.terms_of(["n_chars", "n_tokens"]), F.col("quality"))
    return t.spark.createDataFrame([(k, round(v, 4)) for k, v in linear.vifs(g).items()], "term string, vif double")


@query("l06b_vif_rounds")
def l06b(t):
    g = linear.gram(S.scored_documents(t), linear.terms_of(DOC_X), F.col("quality"))
    kept, gone = linear.vif_pruning(g)
    return t.spark.createDataFrame([(k, "kept", v) for k, v in kept.items()] + [(k, "dropped", v) for k, v in gone], "term string, state string, vif double")


# each document's residual of n_tokens on n_chars
_DOCFIT = """m AS (SELECT count(*) AS n, avg(n_chars) AS mx, avg(n_tokens) AS my, regr_sxx(n_tokens, n_chars) AS sxx, regr_sxy(n_tokens, n_chars) AS sxy, regr_syy(n_tokens, n_chars) AS syy FROM sd),
 f AS (SELECT *, sxy / sxx AS b1, my - sxy / sxx * mx AS b0, sqrt((syy - sxy * sxy / sxx) / (n - 2)) AS s FROM m),
 rs AS (SELECT doc_id, b0 + b1 * n_chars AS fitted, n_tokens - b0 - b1 * n_chars AS resid, 1.0 / n + (n_chars - mx) ** 2 / sxx AS h, s, n FROM sd, f),
 st AS (SELECT *, resid / (s * sqrt(1 - h)) AS z FROM rs)"""


@query("l09_residual_diagnostics", f"""WITH {S.SCORED_SQL}, {_DOCFIT} SELECT doc_id, round(fitted, 4) AS fitted, round(resid, 4) AS resid, round(h, 8) AS leverage, round(z, 6) AS std_resid, round(sqrt(abs(z)), 6) AS root_abs,
 round((row_number() OVER (ORDER BY z, doc_id) - 0.5) / n, 9) AS p FROM st""")
def l09(t):
    d, x = S.scored_documents(t), linear.terms_of(["n_chars"])
    fit = linear.Fit(linear.gram(d, x, F.col("n_tokens")))
    out = linear.residual_table(d, fit, x, F.col("n_tokens"), ["doc_id"])
    # the quantile column is undone with the normal distribution's own rank order
    ranked = linear.number_rows(out, ["normal_q"], "i", 1)
    return ranked.select("doc_id", r("fitted", 4).alias("fitted"), r("resid", 4).alias("resid"), r("leverage", 8).alias("leverage"), r("std_resid").alias("std_resid"),
                         r("root_abs").alias("root_abs"), r((F.col("i") - 0.5) / fit.g.n, 9).alias("p"))


@query("l10_polynomial_fit")
def l10(t):
    basis = linear.legendre(t.lineitem, "l_quantity", 12)
    g = linear.gram(t.lineitem, basis, price())
    names = list(basis)
    rows = []
    for d in range(1, 13):
        f = linear.Fit(g.keep(names[:d]))
        rows.append((d, f.rss, f.r2, f.adj_r2))
    return t.spark.createDataFrame(rows, "degree int, rss double, r2 double, adj_r2 double")


_SQ = """q AS (SELECT l_quantity AS x, l_quantity * l_quantity AS w, l_extendedprice AS y FROM lineitem),
 m AS (SELECT avg(x) AS m1, avg(w) AS m2, avg(y) AS my, regr_sxx(y, x) AS s11, regr_sxx(y, w) AS s22, regr_sxy(w, x) AS s12, regr_sxy(y, x) AS s1y, regr_sxy(y, w) AS s2y FROM q),
 b AS (SELECT *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1, (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM m)"""


@query("l10b_quadratic_fitted_values", f"WITH {_SQ} SELECT DISTINCT l_quantity AS x, round(my + b1 * (l_quantity - m1) + b2 * (l_quantity * l_quantity - m2), 3) AS fitted FROM lineitem, b")
def l10b(t):
    basis = linear.legendre(t.lineitem, "l_quantity", 2)
    fit = linear.Fit(linear.gram(t.lineitem, basis, price()))
    return t.lineitem.select("l_quantity").distinct().select(F.col("l_quantity").alias("x"), r(fit.predict(basis), 3).alias("fitted"))


@query("l11_treatment_contrasts", """WITH m AS (SELECT l_returnflag AS g, avg(l_extendedprice) AS v FROM lineitem GROUP BY 1), b AS (SELECT v AS b0 FROM m WHERE g = 'A')
 SELECT CASE WHEN g = 'A' THEN '(Intercept)' ELSE 'l_returnflag' || g END AS term, round(CASE WHEN g = 'A' THEN v ELSE v - b0 END, 3) AS estimate FROM m, b""")
def l11(t):
    x = linear.treatment("l_returnflag", ["A", "N", "R"])
    return linear.coefficient_frame(t.spark, linear.Fit(linear.gram(t.lineitem, x, price()))).select("term", r("estimate", 3).alias("estimate"))


@query("l11b_interaction", """WITH s AS (SELECT l_linestatus AS g, regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem GROUP BY 1),
 f AS (SELECT * FROM s WHERE g = 'F'), o AS (SELECT * FROM s WHERE g = 'O')
 SELECT unnest(['(Intercept)', 'l_quantity', 'l_linestatusO', 'l_quantity:l_linestatusO']) AS term, unnest([round(f.a, 3), round(f.b, 3), round(o.a - f.a, 3), round(o.b - f.b, 3)]) AS estimate FROM f, o""")
def l11b(t):
    q, g = linear.terms_of(["l_quantity"]), linear.treatment("l_linestatus", ["F", "O"])
    x = {**q, **g, **linear.interaction(q, g)}
    return linear.coefficient_frame(t.spark, linear.Fit(linear.gram(t.lineitem, x, price()))).select("term", r("estimate", 3).alias("estimate"))


@query("l12_log_response", """WITH f AS (SELECT regr_slope(ln(l_extendedprice), l_quantity) AS b, regr_intercept(ln(l_extendedprice), l_quantity) AS a FROM lineitem)
 SELECT DISTINCT l_quantity AS x, round(exp(a + b * l_quantity), 3) AS fitted FROM lineitem, f""")
def l12(t):
    x = linear.terms_of(["l_quantity"])
    fit = linear.Fit(linear.gram(t.lineitem, x, F.log(price())))
    return t.lineitem.select("l_quantity").distinct().select(F.col("l_quantity").alias("x"), r(linear.back_transform(fit, x), 3).alias("fitted"))


_GM = "g AS (SELECT {c} AS g, count(*)::DOUBLE AS n, avg({v}) AS m, var_samp({v}) AS v FROM {t} GROUP BY 1)"


@query("l13_two_sample_tests", f"""WITH {_GM.format(c='l_linestatus', v='l_discount', t='lineitem')}, a AS (SELECT * FROM g WHERE g = 'F'), b AS (SELECT * FROM g WHERE g = 'O'),
 k AS (SELECT l_returnflag AS g, count(*)::DOUBLE AS n, var_samp(l_discount) AS v FROM lineitem GROUP BY 1),
 kk AS (SELECT count(*) AS k, sum(n) AS n, sum((n - 1) * v) / (sum(n) - count(*)) AS sp, sum((n - 1) * ln(v)) AS sl, sum(1 / (n - 1)) AS si FROM k)
 SELECT 't' AS test, round((a.m - b.m) / sqrt(((a.n - 1) * a.v + (b.n - 1) * b.v) / (a.n + b.n - 2) * (1 / a.n + 1 / b.n)), 6) AS stat, a.n + b.n - 2 AS df FROM a, b
 UNION ALL SELECT 'F', round(a.v / b.v, 6), a.n - 1 FROM a, b
 UNION ALL SELECT 'K2', round(((n - k) * ln(sp) - sl) / (1 + (si - 1 / (n - k)) / (3 * (k - 1))), 6), (k - 1)::DOUBLE FROM kk""")
def l13(t):
    two = grouptests.group_moments(t.lineitem, "l_linestatus", "l_discount")
    three = grouptests.group_moments(t.lineitem, "l_returnflag", "l_discount")
    rows = [grouptests.two_sample_t(two), grouptests.variance_f(two), grouptests.bartlett(three)]
    return t.spark.createDataFrame([(n, round(s, 6), d) for n, s, d, _ in rows], "test string, stat double, df double")


@query("l13b_test_p_values")
def l13b(t):
    two = grouptests.group_moments(t.lineitem, "l_linestatus", "l_discount")
    three = grouptests.group_moments(t.lineitem, "l_returnflag", "l_discount")
    return t.spark.createDataFrame([grouptests.two_sample_t(two), grouptests.variance_f(two), grouptests.bartlett(three)], "test string, stat double, df double, p double")


@query("l14_one_way_anova", f"""WITH {_GM.format(c='event_type', v='value', t='events')}, w AS (SELECT count(*) AS k, sum(n) AS n, sum(n * m) / sum(n) AS gm, sum((n - 1) * v) AS ssw FROM g),
 b AS (SELECT sum(g.n * (g.m - gm) ** 2) AS ssb FROM g, w) SELECT round(ssb, 3) AS ss_between, (k - 1)::DOUBLE AS df_between, round(ssw, 3) AS ss_within, n - k AS df_within, round((ssb / (k - 1)) / (ssw / (n - k)), 6) AS f FROM w, b""")
def l14(t):
    a = grouptests.one_way(grouptests.group_moments(t.events, "event_type", "value"))
    row = (round(a["ss_between"], 3), a["df_between"], round(a["ss_within"], 3), a["df_within"], round(a["f"], 6))
    return t.spark.createDataFrame([row], "ss_between double, df_between double, ss_within double, df_within double, f double")


@query("l14b_tukey_pairs", f"""WITH {_GM.format(c='event_type', v='value', t='events')}, w AS (SELECT sum((n - 1) * v) / (sum(n) - count(*)) AS s2 FROM g)
 SELECT a.g AS a, b.g AS b, round(b.m - a.m, 6) AS diff, round(abs(b.m - a.m) / sqrt(s2 / 2 * (1 / a.n + 1 / b.n)), 6) AS q FROM g a JOIN g b ON a.g < b.g, w""")
def l14b(t):
    pairs = grouptests.tukey_pairs(grouptests.group_moments(t.events, "event_type", "value"))
    return t.spark.createDataFrame([(a, b, round(d, 6), round(q, 6)) for a, b, d, q, _ in pairs], "a string, b string, diff double, q double")


@query("l14c_tukey_p_values")
def l14c(t):
    pairs = grouptests.tukey_pairs(grouptests.group_moments(t.events, "event_type", "value"))
    return t.spark.createDataFrame(pairs, "a string, b string, diff double, q double, p double")


@query("l15_best_subsets")
def l15(t):
    x = {**linear.terms_of(ALL), **linear.interaction(linear.terms_of(["l_quantity"]), linear.terms_of(["l_discount", "l_tax"])),
         **linear.treatment("l_returnflag", ["A", "N", "R"])}
    return linear.best_subsets(t.spark, linear.gram(t.lineitem, x, price()))


@query("l16_exact_split", f"""WITH k AS (SELECT doc_id, row_number() OVER (ORDER BY {row_hash_sql('doc_id')}, doc_id) - 1 AS i, count(*) OVER () AS n FROM documents)
 SELECT doc_id, CASE WHEN i < round(n * 0.7) THEN 'train' WHEN i < round(n * 0.85) THEN 'valid' ELSE 'test' END AS part FROM k""")
def l16(t):
    return evaluate.exact_split(t.documents.select("doc_id"), "doc_id", {"train": 0.7, "valid": 0.15, "test": 0.15}).select("doc_id", "part")


@query("l16b_ordered_split", """WITH k AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents)
 SELECT doc_id, CASE WHEN i < round(n * 0.8) THEN 'train' ELSE 'test' END AS part FROM k""")
def l16b(t):
    return evaluate.exact_split(t.documents.select("doc_id"), "doc_id", {"train": 0.8, "test": 0.2}, shuffle=False).select("doc_id", "part")


@query("l18_loocv", f"""WITH {_ONE_SQL} SELECT 'linear' AS model, round(avg(((l_extendedprice - b0 - b1 * l_quantity) / (1 - 1.0 / n - (l_quantity - mx) ** 2 / sxx)) ** 2), 1) AS cv_error FROM lineitem, f""")
def l18(t):
    x = linear.terms_of(["l_quantity"])
    fits = {"linear": linear.Fit(linear.gram(t.lineitem, x, price()))}
    return linear.loocv(t.lineitem, fits, x, price()).select("model", r("cv_error", 1).alias("cv_error"))


_FOLD = f"{row_hash_sql('l_orderkey * 8 + l_linenumber')} % 5"


@query("l18b_kfold", f"""WITH d AS (SELECT l_quantity AS x, l_extendedprice AS y, {_FOLD} AS fold FROM lineitem), f AS (SELECT DISTINCT fold AS k FROM d),
 b AS (SELECT k, regr_slope(y, x) AS b1, regr_intercept(y, x) AS b0 FROM d JOIN f ON fold <> k GROUP BY 1)
 SELECT 'linear' AS model, round(avg((y - b0 - b1 * x) ** 2), 1) AS cv_error FROM d JOIN b ON fold = k""")
def l18b(t):
    x = linear.terms_of(["l_quantity"])
    fold = F.pmod(row_hash(F.col("l_orderkey") * 8 + F.col("l_linenumber")), F.lit(5))
    rows = linear.kfold(t.lineitem, {"linear": ["l_quantity"]}, x, price(), fold)
    return t.spark.createDataFrame([(m, round(e, 1)) for m, e in rows], "model string, cv_error double")


@query("l18c_cv_by_degree")
def l18c(t):
    basis = linear.legendre(t.lineitem, "l_quantity", 10)
    names = list(basis)
    fold = F.pmod(row_hash(F.col("l_orderkey") * 8 + F.col("l_linenumber")), F.lit(10))
    grams = linear.fold_grams(t.lineitem, basis, price(), fold)
    fits = {str(d): linear.Fit(grams[0].keep(names[:d])) for d in range(1, 11)}
    k10 = t.spark.createDataFrame(linear.kfold(t.lineitem, {str(d): names[:d] for d in range(1, 11)}, basis, price(), fold, grams), "model string, kfold double")
    return linear.loocv(t.lineitem, fits, basis, price()).join(k10, "model")


@query("l19_train_and_validation_mse", f"""WITH d AS (SELECT l_quantity AS x, l_extendedprice AS y, CASE WHEN {_FOLD} = 0 THEN 'valid' ELSE 'train' END AS part FROM lineitem),
 b AS (SELECT regr_slope(y, x) AS b1, regr_intercept(y, x) AS b0 FROM d WHERE part = 'train') SELECT part, round(avg((y - b0 - b1 * x) ** 2), 1) AS mse FROM d, b GROUP BY 1""")
def l19(t):
    fold = F.pmod(row_hash(F.col("l_orderkey") * 8 + F.col("l_linenumber")), F.lit(5))
    d = t.lineitem.withColumn("part", F.when(fold == 0, "valid").otherwise("train"))
    x = linear.terms_of(["l_quantity"])
    fit = linear.Fit(linear.gram(d, x, price(), F.col("part") == "train"))
    return evaluate.mse(d, price(), fit.predict(x), "part").select("part", r("mse", 1).alias("mse"))


