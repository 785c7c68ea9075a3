"""Vector queries over the embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestat.functions.vectors import cosine
from lodestat.operators import similarity as V
from lodestat.plans.registry import query
from lodestat.plans.tabular import r
from lodestat.sources.sinks import load_vectors, save_vectors
from lodestat.session import scratch_path


def vectors(t, lo=None, n=None):
    vec = F.transform("embedding", lambda x: x.cast("double"))
    if lo is not None:
        vec = F.slice(vec, lo, n)
    return t.embeddings.select(F.col("vec_id").alias("id"), vec.alias("vec"))


_E = "e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, label FROM embeddings)"
_PAIR = "pr AS (SELECT vec_id AS a, vec_id + 1 AS b, vec_id AS k FROM embeddings)"


def _sims(e="e", q="e"):
    return f"SELECT q.id AS qid, d.id, round(list_cosine_similarity(q.v, d.v), 9) AS sim FROM {q} q, {e} d WHERE q.id <> d.id"


def _top(n, sims, name="tp"):
    return f"""{name} AS (SELECT qid, id, sim, rk FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY sim DESC, id) AS rk FROM ({sims})) WHERE rk <= {n})"""


@query("s15_vector_lookup", f"WITH {_E} SELECT c_custkey AS id, round(list_sum(v), 5) AS total, len(v) AS dims, v IS NOT NULL AS known FROM customer LEFT JOIN e ON id = c_custkey")
def s15(t):
    keys = t.customer.select(F.col("c_custkey").alias("id"))
    total = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x)
    return keys.join(vectors(t), "id", "left").select(
        "id", r(total, 5).alias("total"), F.when(F.col("vec").isNotNull(), F.size("vec")).cast("bigint").alias("dims"), F.col("vec").isNotNull().alias("known"))


@query("s20_unit_vectors", f"WITH {_E} SELECT id, round(list_transform(v, lambda x: x / sqrt(list_dot_product(v, v)))[1], 6) AS first, round(1.0, 6)::DOUBLE AS length FROM e")
def s20(t):
    path = scratch_path(t.spark, "vectors")
    save_vectors(vectors(t).withColumn("text", F.col("id").cast("string")), path, ["id"], "text", "vec")
    v = load_vectors(t.spark, path)
    return v.select("id", r(F.col("vector")[0]).alias("first"), r(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))).alias("length"))


@query("j07_pair_scores", f"""WITH {_E}, {_PAIR} SELECT pr.a, pr.b, round(list_cosine_similarity(x.v, y.v), 6) AS sim, CASE WHEN x.label = y.label THEN 1.0 ELSE 0.0 END::DOUBLE AS human
 FROM pr JOIN e x ON x.id = a JOIN e y ON y.id = b""")
def j07(t):
    return _pairs(t).select("a", "b", r("sim").alias("sim"), "human")


def _pairs(t):
    lab = t.embeddings.select(F.col("vec_id").alias("b"), F.col("label").alias("lb"))
    pairs = t.embeddings.select(F.col("vec_id").alias("a"), (F.col("vec_id") + 1).alias("b"), "label").join(lab, "b", "left")
    pairs = pairs.select("a", "b", F.when(F.col("label") == F.col("lb"), 1.0).otherwise(0.0).alias("human"))
    return V.pair_similarity(vectors(t), pairs)


@query("j08_all_pairs_top", f"WITH {_E}, {_top(5, _sims())} SELECT qid, id, round(sim, 6) AS sim, rk::INTEGER AS \"rank\" FROM tp")
def j08(t):
    v = vectors(t)
    return V.top_similar(v, v.select(F.col("id").alias("qid"), F.col("vec").alias("qvec")), 5, skip_self=True).select("qid", "id", r("sim").alias("sim"), "rank")


@query("j08b_all_pairs_top_blocked", f"WITH {_E}, {_top(5, _sims())} SELECT qid, id, round(sim, 6) AS sim, rk::INTEGER AS \"rank\" FROM tp")
def j08b(t):
    v = vectors(t)
    out = V.top_similar(v, v.select(F.col("id").alias("qid"), F.col("vec").alias("qvec")), 5, skip_self=True, query_limit=200, vector_block=150)
    return out.select("qid", "id", r("sim").alias("sim"), "rank")


_SEEDS = "sd AS (SELECT min(vec_id) AS seed FROM embeddings GROUP BY label)"


@query("j10_two_hops", f"""WITH {_E}, {_SEEDS}, h1 AS (SELECT qid AS seed, id AS dst, sim FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY sim DESC, id) AS rk FROM ({_sims()}) WHERE qid IN (SELECT seed FROM sd)) WHERE rk <= 10 AND sim >= 0.2),
 fr AS (SELECT qid AS src, id AS dst, sim FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY sim DESC, id) AS rk FROM ({_sims()}) WHERE qid IN (SELECT dst FROM h1)) WHERE rk <= 100 AND sim >= 0.2),
 vis AS (SELECT seed, dst FROM h1 UNION SELECT seed, seed FROM sd)
 SELECT seed, seed AS src, dst, round(sim, 6) AS sim, 1 AS hop FROM h1 UNION ALL
 SELECT h1.seed, fr.src, fr.dst, round(fr.sim, 6), 2 FROM h1 JOIN fr ON fr.src = h1.dst WHERE NOT EXISTS (SELECT 1 FROM vis WHERE vis.seed = h1.seed AND vis.dst = fr.dst)""")
def j10(t):
    seeds = t.embeddings.groupBy("label").agg(F.min("vec_id").alias("seed")).select("seed")
    return V.two_hops(vectors(t), seeds, 0.2).select("seed", "src", "dst", r("sim").alias("sim"), "hop")


@query("n04_cosine", f"""WITH {_E} SELECT x.id AS a, y.id AS b, round(list_cosine_similarity(x.v, y.v), 6) AS sim, round(1 - list_cosine_similarity(x.v, y.v), 6) AS dist
 FROM e x JOIN e y ON y.id = x.id + 7""")
def n04(t):
    v = vectors(t)
    other = v.select((F.col("id") - 7).alias("id"), F.col("id").alias("b"), F.col("vec").alias("w"))
    s = cosine(F.col("vec"), F.col("w"))
    return v.join(other, "id").select(F.col("id").alias("a"), "b", r(s).alias("sim"), r(1 - s).alias("dist"))


_U = "u AS (SELECT id, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS v FROM e)"


@query("n05_most_similar", f"""WITH {_E}, {_U}, q AS (SELECT list_transform(range(1, 65), lambda i: (a.v[i] + b.v[i] - c.v[i]) / 3) AS v FROM u a, u b, u c WHERE a.id = 3 AND b.id = 8 AND c.id = 5)
 SELECT 0::BIGINT AS qid, id, round(sim, 6) AS sim, row_number() OVER (ORDER BY sim DESC, id)::INTEGER AS "rank" FROM (SELECT id, round(list_cosine_similarity(q.v, u.v), 9) AS sim FROM u, q WHERE id NOT IN (3, 8, 5)) QUALIFY "rank" <= 10""")
def n05(t):
    asked = t.spark.createDataFrame([(0, 3, 1.0), (0, 8, 1.0), (0, 5, -1.0)], "qid bigint, id bigint, sign double")
    return V.most_similar(vectors(t), asked, 10).select("qid", "id", r("sim").alias("sim"), "rank")


@query("n06_similarity_benchmark", f"""WITH {_E}, {_PAIR}, s AS (SELECT round(list_cosine_similarity(x.v, y.v), 9) AS sim, CASE WHEN x.label = y.label THEN 1.0 ELSE 0.0 END::DOUBLE AS human
 FROM pr JOIN e x ON x.id = a JOIN e y ON y.id = b),
 k AS (SELECT *, rank() OVER (ORDER BY sim) + (count(*) OVER (PARTITION BY sim) - 1) / 2.0 AS rs, rank() OVER (ORDER BY human) + (count(*) OVER (PARTITION BY human) - 1) / 2.0 AS rh FROM s)
 SELECT count(*) AS n, round(corr(sim, human), 6) AS pearson, round(corr(rs::DOUBLE, rh::DOUBLE), 6) AS spearman FROM k""")
def n06(t):
    p = _pairs(t).select(r("sim", 9).alias("sim"), "human")
    return V.correlation_report(p, "sim", "human").select("n", r("pearson").alias("pearson"), r("spearman").alias("spearman"))


@query("n07_analogies", f"""WITH {_E}, {_U}, qd AS (SELECT a.id AS qid, a.id AS a, b.id AS b, c.id AS c, a.id + 3 AS d,
  list_transform(range(1, 65), lambda i: (b.v[i] - a.v[i] + c.v[i]) / 3) AS v FROM u a JOIN u b ON b.id = a.id + 1 JOIN u c ON c.id = a.id + 2 WHERE EXISTS (SELECT 1 FROM u WHERE u.id = a.id + 3)),
 s AS (SELECT qid, d, u.id, round(list_cosine_similarity(qd.v, u.v), 9) AS sim FROM qd, u WHERE u.id NOT IN (a, b, c)),
 p AS (SELECT qid, any_value(d) AS d, arg_min(id, (-sim, id)) AS predicted FROM s GROUP BY 1)
 SELECT count(*) AS n, round(avg(CASE WHEN predicted = d THEN 1.0 ELSE 0.0 END), 9) AS share, CAST(sum(predicted * (qid + 1)) AS BIGINT) AS checksum FROM p""")
def n07(t):
    ids = t.embeddings.select(F.col("vec_id").alias("d"))
    quads = ids.select((F.col("d") - 3).alias("qid"), (F.col("d") - 3).alias("a"), (F.col("d") - 2).alias("b"), (F.col("d") - 1).alias("c"), "d").filter("a >= 0")
    out = V.analogies(vectors(t), quads)
    return out.agg(F.count(F.lit(1)).alias("n"), r(F.avg(F.col("correct").cast("double")), 9).alias("share"),
                   F.sum(F.col("predicted") * (F.col("qid") + 1)).alias("checksum"))


@query("n08_principal_components")
def n08(t):
    comp, share = V.principal_components(vectors(t), 3)
    return comp.select("id", *[F.col("components")[i].alias(f"pc{i + 1}") for i in range(3)]).withColumn("explained", F.lit(sum(share)))


@query("n09_neighbour_drift", f"""WITH f AS (SELECT vec_id AS id, embedding[1:32]::DOUBLE[] AS v FROM embeddings), g AS (SELECT vec_id AS id, embedding[33:64]::DOUBLE[] AS v FROM embeddings),
 {_top(50, _sims('f', 'f'), 'tf')}, {_top(50, _sims('g', 'g'), 'tg')}
 SELECT f.id, count(tg.id) AS common FROM f LEFT JOIN tf ON tf.qid = f.id LEFT JOIN tg ON tg.qid = tf.qid AND tg.id = tf.id GROUP BY 1 ORDER BY 2, 1 LIMIT 10""")
def n09(t):
    return V.neighbour_drift(vectors(t, 1, 32), vectors(t, 33, 32))


@query("n10_bias_probe", f"WITH {_E} SELECT id, round(list_cosine_similarity(v, (SELECT v FROM e WHERE id = 0)), 6) AS sim FROM e WHERE id <> 0")
def n10(t):
    return V.similarity_to(vectors(t), 0).select("id", r("sim").alias("sim"))
