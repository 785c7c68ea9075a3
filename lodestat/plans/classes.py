"""Classification queries: the quality label of documents on three text features."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import HashingTF, RegexTokenizer, VectorAssembler
from pyspark.sql import functions as F

from lodestat.operators import classify, comparison, evaluate, linear, margins, summaries, trees
from lodestat.operators.density import kernel_density
from lodestat.operators.frames import row_hash
from lodestat.plans import standins as S
from lodestat.plans.registry import query
from lodestat.plans.tabular import r, row_hash_sql
from lodestat.session import cut

X = ["n_chars", "n_tokens", "avg_len"]
ONE = ["avg_len"]


def scored(t):
    return S.scored_documents(t)


def read_once(t):
    """The one feature and the label: a Newton step reads numbers, and the texts are read once."""
    return cut(scored(t).select("doc_id", "quality", *ONE))


def truth():
    return F.col("quality") == 1


# Newton steps of a one-feature logistic model; the feature is centred inside for stability
_IRLS = f"""{S.SCORED_SQL}, mu AS (SELECT avg(avg_len) AS c FROM sd), d AS (SELECT doc_id, quality AS y, avg_len - c AS x FROM sd, mu),
 it(i, b0, b1) AS (SELECT 0, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) UNION ALL
  SELECT i + 1, b0 + (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01), b1 + (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01)
  FROM (SELECT any_value(i) AS i, any_value(b0) AS b0, any_value(b1) AS b1, sum(y - p) AS g0, sum((y - p) * x) AS g1, sum(p * (1 - p)) AS h00, sum(p * (1 - p) * x) AS h01, sum(p * (1 - p) * x * x) AS h11
   FROM (SELECT i, b0, b1, x, y, 1 / (1 + exp(-(b0 + b1 * x))) AS p FROM it, d WHERE i < 30)) WHERE i IS NOT NULL),
 co AS (SELECT b0 - b1 * c AS b0, b1 FROM it, mu WHERE i = 30),
 pr AS (SELECT doc_id, quality AS y, b0 + b1 * avg_len AS link, 1 / (1 + exp(-(b0 + b1 * avg_len))) AS p FROM sd, co),
 dev AS (SELECT -2 * sum(CASE WHEN y = 1 THEN ln(p) ELSE ln(1 - p) END) AS resid, count(*) AS n, avg(y) AS m FROM pr),
 dv AS (SELECT resid, n, -2 * n * (m * ln(m) + (1 - m) * ln(1 - m)) AS nul FROM dev)"""


@query("l07_logistic", f"""WITH RECURSIVE {_IRLS} SELECT round(b0, 4) AS intercept, round(b1, 4) AS slope, round(nul, 4) AS null_deviance, round(resid, 4) AS deviance FROM co, dv""")
def l07(t):
    m = classify.logistic(read_once(t), ONE, "quality")
    row = (round(m.intercept, 4), round(float(m.coefficients[0]), 4), round(m.summary.nullDeviance, 4), round(m.summary.deviance, 4))
    return t.spark.createDataFrame([row], "intercept double, slope double, null_deviance double, deviance double")


@query("l07b_logistic_predictions", f"WITH RECURSIVE {_IRLS} SELECT doc_id, round(link, 4) AS link, round(p, 5) AS prob FROM pr")
def l07b(t):
    d = read_once(t)
    return classify.logistic_scores(d, classify.logistic(d, ONE, "quality"), ONE).select("doc_id", r("link", 4).alias("link"), r("prob", 5).alias("prob"))


@query("l07c_logistic_table")
def l07c(t):
    d = cut(evaluate.standardise(scored(t), scored(t), X))
    return classify.logistic_table(t.spark, classify.logistic(d, X, "quality"), X)


def text_features(t, dims=4096):
    docs = t.documents.select("doc_id", "text").join(t.labels, "doc_id")
    pipe = Pipeline(stages=[RegexTokenizer(inputCol="text", outputCol="w", pattern=r"\w\w+", gaps=False), HashingTF(inputCol="w", outputCol="features", numFeatures=dims)])
    return pipe.fit(docs).transform(docs).select("doc_id", "quality", "toxic", "features")


@query("l07d_ridge_logistic")
def l07d(t):
    f = text_features(t).persist()
    m = classify.ridge_logistic(f, "features", "quality", 1.0, f.count())
    return classify.class_probability(f, m, "features").select("doc_id", "quality", "score")


@query("l08_deviance_test", f"WITH RECURSIVE {_IRLS} SELECT round(nul - resid, 4) AS stat, 1::INTEGER AS df FROM dv")
def l08(t):
    s = classify.logistic(read_once(t), ONE, "quality").summary
    stat, d, _ = classify.deviance_test(s.nullDeviance, s.residualDegreeOfFreedomNull, s.deviance, s.residualDegreeOfFreedom)
    return t.spark.createDataFrame([(round(stat, 4), d)], "stat double, df int")


@query("l08b_deviance_p_values")
def l08b(t):
    d = cut(evaluate.standardise(scored(t), scored(t), X))
    rows, prev = [], None
    for k in range(1, 4):
        s = classify.logistic(d, X[:k], "quality").summary
        if prev is not None:
            stat, df, p = classify.deviance_test(prev.deviance, prev.residualDegreeOfFreedom, s.deviance, s.residualDegreeOfFreedom)
            rows.append(("+".join(X[:k]), stat, df, float(p)))
        prev = s
    return t.spark.createDataFrame(rows, "model string, stat double, df int, p double")


@query("l17_penalty_sweep")
def l17(t):
    f = evaluate.exact_split(text_features(t), "doc_id", {"train": 0.7, "valid": 0.3}).persist()
    train, valid = f.filter("part = 'train'"), f.filter("part = 'valid'")
    n, rows = train.count(), []
    for c in (0.001, 0.01, 0.1, 1.0, 10.0):
        m = classify.ridge_logistic(train, "features", "quality", c, n)
        acc = [m.transform(p).agg(F.avg((F.col("prediction") == F.col("quality")).cast("double"))).first()[0] for p in (train, valid)]
        rows.append((c, *acc))
    return t.spark.createDataFrame(rows, "c double, train_accuracy double, valid_accuracy double")


# a rule-based score shared by the threshold queries
_RULE = "avg_len / 10"


def ruled(t):
    return cut(scored(t).withColumn("score", r(F.col("avg_len") / 10, 9)))


_RULED_SQL = f"{S.SCORED_SQL}, ru AS (SELECT doc_id, quality, toxic, round({_RULE}, 9) AS score FROM sd)"


@query("l20_confusion", f"""WITH {_RULED_SQL}, c AS (SELECT count(*) FILTER (score >= 0.5 AND quality = 1) AS tp, count(*) FILTER (score >= 0.5 AND quality = 0) AS fp,
  count(*) FILTER (score < 0.5 AND quality = 1) AS fn, count(*) FILTER (score < 0.5 AND quality = 0) AS tn FROM ru)
 SELECT tp, fp, fn, tn, round((fp + fn) / (tp + fp + fn + tn), 9) AS error, round(tp / (tp + fp), 9) AS ppv, round(tp / (tp + fn), 9) AS tpr, round(2 * tp / (2 * tp + fp + fn), 9) AS f1,
 round(tn / (tn + fp), 9) AS tnr, round(fp / (tn + fp), 9) AS fpr, round(least(tp + fn, tn + fp) / (tp + fp + fn + tn), 9) AS trivial_error FROM c""")
def l20(t):
    c = evaluate.confusion(ruled(t), truth(), F.col("score"), 0.5)
    return c.select("tp", "fp", "fn", "tn", *[r(x, 9).alias(x) for x in ("error", "ppv", "tpr", "f1", "tnr", "fpr", "trivial_error")])


_ROC_SQL = f"""{_RULED_SQL}, k AS (SELECT score, count(*) FILTER (quality = 1) AS p, count(*) FILTER (quality = 0) AS n FROM ru GROUP BY 1),
 rc AS (SELECT score AS threshold, sum(p) OVER (ORDER BY score DESC) / (SELECT sum(p) FROM k) AS tpr, sum(n) OVER (ORDER BY score DESC) / (SELECT sum(n) FROM k) AS fpr FROM k)"""


@query("l21_roc_points", f"WITH {_ROC_SQL} SELECT threshold, round(tpr, 9) AS tpr, round(fpr, 9) AS fpr FROM rc")
def l21(t):
    return evaluate.roc_points(ruled(t), truth(), "score").select("threshold", r("tpr", 9).alias("tpr"), r("fpr", 9).alias("fpr"))


@query("l21b_auc", f"""WITH {_ROC_SQL}, a AS (SELECT sum(p * (SELECT coalesce(sum(n), 0) FROM k b WHERE b.score < k.score)) + sum(p * n) / 2.0 AS wins, sum(p) * sum(n) AS total FROM k)
 SELECT round(wins / total, 9) AS auc, (SELECT threshold FROM rc ORDER BY round(tpr - fpr, 12) DESC, threshold DESC LIMIT 1) AS best_threshold FROM a""")
def l21b(t):
    d = ruled(t)
    best = evaluate.best_threshold(evaluate.roc_points(d, truth(), "score")).select("threshold").scalar()
    return evaluate.auc(d, truth(), "score").select(r("auc", 9).alias("auc"), best.alias("best_threshold"))


TWO = ["n_chars", "avg_len"]
_CLS = f"""{S.SCORED_SQL}, cm AS (SELECT quality AS k, count(*)::DOUBLE AS n, avg(n_chars) AS m1, avg(avg_len) AS m2, regr_sxx(avg_len, n_chars) AS a, regr_sxx(n_chars, avg_len) AS d, regr_sxy(avg_len, n_chars) AS b FROM sd GROUP BY 1),
 tot AS (SELECT sum(n) AS n, sum(a) AS a, sum(b) AS b, sum(d) AS d FROM cm),
 lc AS (SELECT k, cm.n / tot.n AS pi, m1, m2, tot.a / (tot.n - 2) AS a, tot.b / (tot.n - 2) AS b, tot.d / (tot.n - 2) AS d FROM cm, tot),
 qc AS (SELECT k, cm.n / tot.n AS pi, m1, m2, cm.a / (cm.n - 1) AS a, cm.b / (cm.n - 1) AS b, cm.d / (cm.n - 1) AS d FROM cm, tot)"""


def _post_sql(c):
    return f"""WITH {_CLS}, s AS (SELECT doc_id, k, ln(pi) - 0.5 * ln(a * d - b * b) - 0.5 * (d * (n_chars - m1) ** 2 - 2 * b * (n_chars - m1) * (avg_len - m2) + a * (avg_len - m2) ** 2) / (a * d - b * b) AS s FROM sd, {c})
     SELECT doc_id, round(1 / (1 + exp(max(s) FILTER (k = 0) - max(s) FILTER (k = 1))), 6) AS post_1 FROM s GROUP BY 1"""


@query("l22_lda", _post_sql("lc"))
def l22(t):
    d = scored(t)
    return classify.lda(d, classify.class_moments(d, TWO, "quality")).select("doc_id", r("post_1").alias("post_1"))


@query("l23_qda", _post_sql("qc"))
def l23(t):
    d = scored(t)
    return classify.qda(d, classify.class_moments(d, TWO, "quality")).select("doc_id", r("post_1").alias("post_1"))


_NB = f"""{S.SCORED_SQL}, nb AS (SELECT quality AS k, count(*) / (SELECT count(*)::DOUBLE FROM sd) AS pi, avg(n_chars) AS m1, stddev_samp(n_chars) AS s1, avg(avg_len) AS m2, stddev_samp(avg_len) AS s2 FROM sd GROUP BY 1)"""


@query("l24_naive_bayes_tables", f"WITH {_NB} SELECT k AS quality, round(pi, 9) AS prior, round(m1, 4) AS mean_n_chars, round(s1, 4) AS sd_n_chars, round(m2, 6) AS mean_avg_len, round(s2, 6) AS sd_avg_len FROM nb")
def l24(t):
    n = classify.naive_bayes_tables(scored(t), TWO, "quality")
    return n.select("quality", r("prior", 9).alias("prior"), r("mean_n_chars", 4).alias("mean_n_chars"), r("sd_n_chars", 4).alias("sd_n_chars"), r("mean_avg_len").alias("mean_avg_len"), r("sd_avg_len").alias("sd_avg_len"))


@query("l24b_naive_bayes", f"""WITH {_NB}, s AS (SELECT doc_id, k, ln(pi) - ln(s1) - ln(s2) - ((n_chars - m1) / s1) ** 2 / 2 - ((avg_len - m2) / s2) ** 2 / 2 AS s FROM sd, nb)
 SELECT doc_id, round(1 / (1 + exp(max(s) FILTER (k = 0) - max(s) FILTER (k = 1))), 6) AS post_1 FROM s GROUP BY 1""")
def l24b(t):
    d = scored(t)
    tables = classify.naive_bayes_tables(d, TWO, "quality").orderBy("quality").collect()
    return classify.naive_bayes(d, tables, TWO, "quality").select("doc_id", r("post_1").alias("post_1"))


@query("l25_macro_scores", f"""WITH {_RULED_SQL}, q AS (SELECT quality AS y, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS p FROM ru),
 c AS (SELECT k, count(*) FILTER (y = k AND p = k) AS h, count(*) FILTER (p = k) AS pr, count(*) FILTER (y = k) AS ac FROM q, (VALUES (0), (1)) v(k) GROUP BY 1),
 m AS (SELECT h, coalesce(h / nullif(pr, 0), 0) AS a, coalesce(h / nullif(ac, 0), 0) AS b, ac FROM c)
 SELECT round(sum(h) / sum(ac), 9) AS accuracy, round(avg(a), 9) AS "precision", round(avg(b), 9) AS recall, round(avg(coalesce(2 * a * b / nullif(a + b, 0), 0)), 9) AS f1 FROM m""")
def l25(t):
    d = ruled(t).withColumn("pred", (F.col("score") >= 0.5).cast("int"))
    return evaluate.macro_scores(d, "quality", "pred").select(*[r(c, 9).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


def four_models(d, test, features, label="quality"):
    """(name, scored frame) of four classifiers fitted on ``d``."""
    moments = classify.class_moments(d, features, label)
    tables = classify.naive_bayes_tables(d, features, label).orderBy(label).collect()
    logit = classify.logistic(d, features, label)
    yield "logistic", classify.logistic_scores(test, logit, features).withColumn("post_1", F.col("prob"))
    yield "lda", classify.lda(test, moments)
    yield "qda", classify.qda(test, moments)
    yield "naive_bayes", classify.naive_bayes(test, tables, features, label)


@query("l26_compare_classifiers")
def l26(t):
    d = scored(t).persist()
    out = None
    for name, s in four_models(d, d, TWO):
        row = evaluate.confusion(s, truth(), F.col("post_1"), 0.5, strict=name == "logistic").select(F.lit(name).alias("model"), "tpr", "ppv", "f1", "error")
        out = row if out is None else out.unionByName(row)
    return out


_PART = f"CASE WHEN {row_hash_sql('doc_id')} % 10 < 7 THEN 'train' ELSE 'test' END"


@query("l27_standardise", f"""WITH {S.SCORED_SQL}, z AS (SELECT *, {_PART} AS part FROM sd), m AS (SELECT avg(n_chars) AS m1, stddev_pop(n_chars) AS s1, avg(avg_len) AS m2, stddev_pop(avg_len) AS s2 FROM z WHERE part = 'train')
 SELECT doc_id, round((n_chars - m1) / s1, 6) AS n_chars, round((avg_len - m2) / s2, 6) AS avg_len FROM z, m WHERE part = 'test'""")
def l27(t):
    d = scored(t).withColumn("part", F.when(F.pmod(row_hash(F.col("doc_id")), F.lit(10)) < 7, "train").otherwise("test"))
    out = evaluate.standardise(d.filter("part = 'train'"), d.filter("part = 'test'"), TWO)
    return out.select("doc_id", r("n_chars").alias("n_chars"), r("avg_len").alias("avg_len"))


@query("l28_power_likelihood", """WITH g AS (SELECT round(-2 + 0.1 * i, 10)::DOUBLE AS g FROM range(41) t(i)),
 v AS (SELECT g, count(*) AS n, var_pop(CASE WHEN g = 0 THEN ln(o_totalprice) ELSE (o_totalprice ** g - 1) / g END) AS v, sum(ln(o_totalprice)) AS j FROM orders, g GROUP BY 1)
 SELECT g AS lambda, round(-n / 2 * ln(v) + (g - 1) * j, 2) AS log_lik FROM v""")
def l28(t):
    return evaluate.power_likelihood(t.orders, "o_totalprice", "box-cox").select("lambda", r("log_lik", 2).alias("log_lik"))


@query("l28b_yeo_johnson", """WITH g AS (SELECT round(-2 + 0.1 * i, 10)::DOUBLE AS g FROM range(41) t(i)), c AS (SELECT c_custkey, c_acctbal / 1000 AS x FROM customer),
 yj AS (SELECT c_custkey, g, x, CASE WHEN x >= 0 THEN CASE WHEN g = 0 THEN ln(1 + x) ELSE ((1 + abs(x)) ** g - 1) / g END ELSE CASE WHEN g = 2 THEN -ln(1 - x) ELSE -((1 + abs(x)) ** (2 - g) - 1) / (2 - g) END END AS y FROM c, g),
 l AS (SELECT g, -count(*) / 2 * ln(var_pop(y)) + (g - 1) * sum(sign(x) * ln(1 + abs(x))) AS ll FROM yj GROUP BY 1)
 SELECT c_custkey, round(y, 6) AS x FROM yj WHERE g = (SELECT g FROM l ORDER BY ll DESC LIMIT 1)""")
def l28b(t):
    d = t.customer.select("c_custkey", (F.col("c_acctbal") / 1000).alias("x"))
    return evaluate.power_transform(d, d, ["x"]).select("c_custkey", r("x").alias("x"))


LANGS = ["de", "en", "es", "fr"]
# every place against every training value: the plain form of the density that the query sums by cells
_L29 = f"""{S.SCORED_SQL}, x AS (SELECT sd.*, d.lang FROM sd JOIN documents d USING (doc_id)),
 st AS (SELECT quality AS k, count(*)::DOUBLE AS n, stddev_samp(avg_len) * count(*) ** -0.2 AS h, avg(n_chars) AS m1, avg(n_tokens) AS m2, var_samp(n_chars) AS a, var_samp(n_tokens) AS d,
  covar_samp(n_chars, n_tokens) AS b, (sum(toxic) + 1) / (count(*) + 2) AS q FROM x GROUP BY 1),
 cs AS (SELECT quality AS k, lang, count(*) AS c FROM x GROUP BY ALL),
 av AS (SELECT DISTINCT avg_len AS v FROM x), tv AS (SELECT quality AS k, avg_len AS v, count(*) AS c FROM x GROUP BY ALL),
 kd AS (SELECT av.v, st.k, sum(tv.c * exp(-0.5 * ((av.v - tv.v) / h) ** 2)) / (any_value(n) * any_value(h) * sqrt(2 * pi())) AS f FROM av, tv JOIN st ON st.k = tv.k GROUP BY ALL),
 s AS (SELECT x.doc_id, x.quality, st.k, ln(n / (SELECT count(*) FROM x)) - 0.5 * ln(a * d - b * b) - 0.5 * (d * (n_chars - m1) ** 2 - 2 * b * (n_chars - m1) * (n_tokens - m2) + a * (n_tokens - m2) ** 2) / (a * d - b * b)
   + ln((coalesce(cs.c, 0) + 1) / (n + 4)) + CASE WHEN toxic = 1 THEN ln(q) ELSE ln(1 - q) END + ln(greatest(f, 1e-300)) AS s
  FROM x CROSS JOIN st LEFT JOIN cs ON cs.k = st.k AND cs.lang = x.lang JOIN kd ON kd.v = avg_len AND kd.k = st.k)"""


def mixed(t):
    return scored(t).join(t.documents.select("doc_id", "lang"), "doc_id")


@query("l29_mixed_naive_bayes", f"WITH {_L29} SELECT doc_id, any_value(quality) AS quality, round(1 / (1 + exp(max(s) FILTER (k = 0) - max(s) FILTER (k = 1))), 6) AS post_1 FROM s GROUP BY 1")
def l29(t):
    d = mixed(t)
    out = classify.mixed_naive_bayes(d, d, "quality", {"lang": LANGS}, ["toxic"], "avg_len", ["n_chars", "n_tokens"])
    return out.select("doc_id", "quality", r("post_1").alias("post_1"))


@query("l29b_kernel_density", f"WITH {_L29} SELECT k AS quality, round(v, 9) AS avg_len, round(f, 9) AS density FROM kd")
def l29b(t):
    d = scored(t).select("quality", "avg_len")
    h = {r_["quality"]: r_["sd"] * r_["n"] ** -0.2 for r_ in d.groupBy("quality").agg(F.stddev_samp("avg_len").alias("sd"), F.count(F.lit(1)).alias("n")).collect()}
    out = kernel_density(d, d.select("avg_len"), "avg_len", h, "quality")
    return out.select("quality", r("avg_len", 9).alias("avg_len"), r("density", 9).alias("density"))


COLUMNS = comparison.Columns(TWO, "doc_id", "quality", {"lang": LANGS}, ["toxic"], "avg_len", ["n_chars", "n_tokens"])


@query("l30_repeated_comparison")
def l30(t):
    return comparison.summary(comparison.compare_models(mixed(t), COLUMNS, rounds=3, folds=10))


# the best cut of all rows, then of both sides, over the quantiles of each feature
_CUTS = f"""{S.SCORED_SQL}, v AS (SELECT doc_id, quality, 0 AS f, n_chars AS x FROM sd UNION ALL SELECT doc_id, quality, 1, avg_len FROM sd),
 fe AS (SELECT f, count(DISTINCT x) AS d, count(*) AS n FROM v GROUP BY 1),
 o AS (SELECT f, x, row_number() OVER (PARTITION BY f ORDER BY x) AS i FROM v),
 e0 AS (SELECT DISTINCT o.f, x FROM o JOIN fe USING (f) JOIN range(1, 33) t(q) ON d > 32 AND i = ceil(n * q / 32.0) UNION SELECT DISTINCT v.f, x FROM v JOIN fe USING (f) WHERE d <= 32),
 e AS (SELECT f, x FROM e0 QUALIFY row_number() OVER (PARTITION BY f ORDER BY x DESC) > 1)"""


def _cut_sql(node, rows):
    return f"""(SELECT {node} AS node, f, edge FROM (SELECT e.f, e.x AS edge, count(*) AS t, sum(quality) AS t1, count(*) FILTER (v.x <= e.x) AS l, coalesce(sum(quality) FILTER (v.x <= e.x), 0) AS l1
     FROM e JOIN v ON v.f = e.f {rows} GROUP BY 1, 2) WHERE l >= 5 AND t - l >= 5 AND 2.0 * t1 * (t - t1) / t - 2.0 * l1 * (l - l1) / l - 2.0 * (t1 - l1) * (t - l - t1 + l1) / (t - l) > 1e-12
     ORDER BY round(2.0 * t1 * (t - t1) / t - 2.0 * l1 * (l - l1) / l - 2.0 * (t1 - l1) * (t - l - t1 + l1) / (t - l), 9) DESC, f, edge LIMIT 1)"""


@query("l30b_tree_cuts", f"""WITH {_CUTS}, n0 AS {_cut_sql(0, '')}, side AS (SELECT v.doc_id, CASE WHEN v.x > n0.edge THEN 2 ELSE 1 END AS node FROM v JOIN n0 USING (f)),
 n1 AS {_cut_sql(1, 'JOIN side ON side.doc_id = v.doc_id AND side.node = 1')}, n2 AS {_cut_sql(2, 'JOIN side ON side.doc_id = v.doc_id AND side.node = 2')}
 SELECT CAST(node AS INTEGER) AS node, CASE f WHEN 0 THEN 'n_chars' ELSE 'avg_len' END AS feature, round(edge, 9) AS edge FROM (SELECT * FROM n0 UNION ALL SELECT * FROM n1 UNION ALL SELECT * FROM n2)""")
def l30b(t):
    grown = trees.grow(scored(t), TWO, "quality", depth=2, least=5, bins=32)
    return trees.frame(t.spark, grown, TWO).filter("feature is not null").select("node", "feature", r("edge", 9).alias("edge"))


@query("l30c_support_vectors")
def l30c(t):
    """Margins of every labelled document under a linear and a landmark-kernel machine, with their proven gaps."""
    d = cut(evaluate.standardise(scored(t), scored(t), TWO).withColumn("x", F.array(*TWO)))
    marks = margins.landmarks(d, "x", "doc_id", 32)
    d = cut(d.withColumn("z", margins.kernel_map(F.col("x"), marks, 1.0)))
    out = None
    for name, x in (("linear", "x"), ("kernel", "z")):
        fit = margins.fit(d, x, "quality", {"": 0.01})
        one = margins.margins(d, x, fit).select("doc_id", "quality", F.lit(name).alias("machine"), "score", F.lit(fit[""]["gap"]).alias("gap"))
        out = one if out is None else out.unionByName(one)
    return out


@query("l31_clean_and_binarise", """SELECT d.doc_id, n_chars, CASE WHEN quality + 2 * toxic > 0 THEN 1 ELSE 0 END AS target FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS NOT NULL AND toxic IS NOT NULL""")
def l31(t):
    d = t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id", "left").na.drop(subset=["n_chars", "quality", "toxic"])
    return d.select("doc_id", "n_chars", F.when(F.col("quality") + 2 * F.col("toxic") > 0, 1).otherwise(0).alias("target"))


@query("l32_correlation_cells", " UNION ALL ".join(
    f"(WITH {S.SCORED_SQL} SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS cor FROM sd)" for a in X for b in X))
def l32(t):
    return summaries.covariances(scored(t), X).select("a", "b", r("cor").alias("cor"))


@query("l32b_class_quantiles", f"""WITH {S.SCORED_SQL}, k AS (SELECT quality, avg_len, doc_id, row_number() OVER (PARTITION BY quality ORDER BY avg_len) AS i, count(*) OVER (PARTITION BY quality) AS n FROM sd)
 SELECT quality, round(avg_len, 9) AS avg_len, count(*) AS n FROM k GROUP BY ALL""")
def l32b(t):
    q = evaluate.class_quantiles(scored(t), "avg_len", "quality")
    return q.groupBy("quality", r("avg_len", 9).alias("avg_len")).agg(F.count("normal_q").alias("n"))


@query("n16_batch_classification")
def n16(t):
    from lodestat.operators.inference import classify_batches
    f = text_features(t).persist()
    m = classify.ridge_logistic(f, "features", "quality", 1.0, f.count())
    w, b = m.coefficients.toArray(), m.intercept

    def model(x):
        return 1 / (1 + pow(2.718281828459045, -(x @ w + b)))
    out = classify_batches(f, "features", model, {0: "poor", 1: "good"})
    d = out.withColumn("truth", F.when(F.col("quality") == 1, "good").otherwise("poor"))
    return evaluate.macro_scores(d, "truth", "predicted")
