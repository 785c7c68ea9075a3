"""K-means and fair k-means on the lineitem points."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestat.operators import clustering as C
from lodestat.plans import standins as S
from lodestat.plans.registry import query
from lodestat.plans.tabular import r

CENTRES = [[10.0, 20.0], [20.0, 60.0], [35.0, 40.0], [45.0, 85.0]]
_VALUES = ", ".join(f"({k}, {c[0]}, {c[1]})" for k, c in enumerate(CENTRES))

ASSIGN_SQL = f"""{S.POINTS_SQL}, rows_ AS (SELECT *, row_number() OVER () AS rid FROM pts),
 c0 AS (SELECT * FROM (VALUES {_VALUES}) v(k, cx, cy)),
 dist AS (SELECT rid, x, y, grp, k, (x - cx) * (x - cx) + (y - cy) * (y - cy) AS d FROM rows_, c0),
 asg AS (SELECT rid, any_value(x) AS x, any_value(y) AS y, any_value(grp) AS grp, arg_min(k, (d, k)) AS cluster, min(d) AS dist FROM dist GROUP BY rid)"""


def _round_sql(i: int, metric: str = "l2") -> str:
    d = "abs(x - cx) + abs(y - cy)" if metric == "l1" else "(x - cx) * (x - cx) + (y - cy) * (y - cy)"
    return f"""a{i} AS (SELECT rid, any_value(x) AS x, any_value(y) AS y, any_value(grp) AS grp, arg_min(k, (d, k)) AS k FROM (SELECT rid, x, y, grp, k, {d} AS d FROM rows_, c{i - 1}) GROUP BY rid),
 c{i} AS (SELECT c.k, coalesce(avg(x), any_value(cx)) AS cx, coalesce(avg(y), any_value(cy)) AS cy FROM c{i - 1} c LEFT JOIN a{i} a ON a.k = c.k GROUP BY c.k)"""


BASE_SQL = f"""{S.POINTS_SQL}, rows_ AS (SELECT *, row_number() OVER () AS rid FROM pts),
 c0 AS (SELECT * FROM (VALUES {_VALUES}) v(k, cx, cy))"""


def _centres(t, centres):
    return C.centres_frame(t.spark, centres).select(
        "cluster", r(F.col("centre")[0], 5).alias("x"), r(F.col("centre")[1], 5).alias("y"))


@query("j04_nearest_centre", f"WITH {ASSIGN_SQL} SELECT round(x, 6) AS x, round(y, 6) AS y, cluster, round(dist, 6) AS dist FROM asg")
def j04(t):
    return C.assign(S.points(t), CENTRES).select(
        r(F.col("features")[0]).alias("x"), r(F.col("features")[1]).alias("y"), "cluster", r("dist").alias("dist"))


@query("c01_lloyd_rounds", f"WITH {BASE_SQL}, {_round_sql(1)}, {_round_sql(2)}, {_round_sql(3)} SELECT k AS cluster, round(cx, 5) AS x, round(cy, 5) AS y FROM c3")
def c01(t):
    return _centres(t, C.lloyd(S.points(t), CENTRES, 3))


@query("c01b_kmeans_parallel_seeds")
def c01b(t):
    return _centres(t, C.ml_lloyd(S.points(t), 4, 5))


@query("c02_timed_kmeans", "SELECT 'kmeans' AS step, 4 AS centres, true AS timed")
def c02(t):
    found, (label, seconds) = C.timed("kmeans", lambda: C.ml_lloyd(S.points(t), 4, 5))
    return t.spark.createDataFrame([(label, len(found), seconds > 0)], "step string, centres int, timed boolean")


@query("c03_objective", f"WITH {ASSIGN_SQL} SELECT round(avg(dist), 5) AS objective FROM asg")
def c03(t):
    return C.objective(S.points(t), CENTRES).select(r("objective", 5).alias("objective"))


@query("c04_fair_objective", f"WITH {ASSIGN_SQL} SELECT round(max(m), 5) AS objective FROM (SELECT grp, avg(dist) AS m FROM asg GROUP BY 1)")
def c04(t):
    return C.fair_objective(S.points(t), CENTRES).select(r("objective", 5).alias("objective"))


@query("c05_group_sizes", f"""WITH {ASSIGN_SQL} SELECT k AS cluster, cx AS x, cy AS y, count(*) FILTER (grp = 'A') AS n_A, count(*) FILTER (grp = 'B') AS n_B
 FROM (SELECT k, CAST(cx AS DOUBLE) AS cx, CAST(cy AS DOUBLE) AS cy FROM c0) LEFT JOIN asg ON k = cluster GROUP BY ALL""")
def c05(t):
    return C.group_sizes(S.points(t), CENTRES, ["A", "B"]).select(
        "cluster", F.col("centre")[0].alias("x"), F.col("centre")[1].alias("y"), "n_A", "n_B")


@query("c06_cluster_group_sums", f"""WITH {ASSIGN_SQL} SELECT cluster, grp, count(*) AS n, round(sum(x), 2) AS sum_x, round(sum(y), 2) AS sum_y FROM asg GROUP BY ALL""")
def c06(t):
    return C.assign(S.points(t), CENTRES).groupBy("cluster", "grp").agg(
        F.count(F.lit(1)).alias("n"), r(F.sum(F.col("features")[0]), 2).alias("sum_x"), r(F.sum(F.col("features")[1]), 2).alias("sum_y"))


_PARAMS_SQL = f"""{ASSIGN_SQL}, p AS (SELECT cluster, count(*) FILTER (grp = 'A') / (SELECT count(*)::DOUBLE FROM pts WHERE grp = 'A') AS alpha,
  count(*) FILTER (grp = 'B') / (SELECT count(*)::DOUBLE FROM pts WHERE grp = 'B') AS beta, avg(x) FILTER (grp = 'A') AS ax, avg(y) FILTER (grp = 'A') AS ay,
  avg(x) FILTER (grp = 'B') AS bx, avg(y) FILTER (grp = 'B') AS by_ FROM asg GROUP BY 1),
 e AS (SELECT *, sqrt((ax - bx) ** 2 + (ay - by_) ** 2) AS ell FROM p),
 fx AS (SELECT avg((x - ax) ** 2 + (y - ay) ** 2) FILTER (grp = 'A') AS fa, avg((x - bx) ** 2 + (y - by_) ** 2) FILTER (grp = 'B') AS fb FROM asg JOIN p USING (cluster))"""


def _params(t):
    return C.fair_parameters(C.cluster_group_sums(S.points(t), CENTRES).collect(), CENTRES)


@query("c07_fair_parameters", f"""WITH {_PARAMS_SQL} SELECT CAST(cluster AS INTEGER) AS cluster, round(alpha, 6) AS alpha, round(beta, 6) AS beta,
 round(ax, 5) AS ax, round(ay, 5) AS ay, round(bx, 5) AS bx, round(by_, 5) AS by_, round(ell, 5) AS ell FROM e""")
def c07(t):
    p = _params(t)
    rows = [(k, float(p["alpha"][k]), float(p["beta"][k]), *map(float, p["mu_a"][k]), *map(float, p["mu_b"][k]), float(p["ell"][k])) for k in range(4)]
    df = t.spark.createDataFrame(rows, "cluster int, alpha double, beta double, ax double, ay double, bx double, by_ double, ell double")
    return df.select("cluster", r("alpha").alias("alpha"), r("beta").alias("beta"), *[r(c, 5).alias(c) for c in ("ax", "ay", "bx", "by_", "ell")])


@query("c08_group_residuals", f"WITH {_PARAMS_SQL} SELECT round(fa, 5) AS fixed_a, round(fb, 5) AS fixed_b FROM fx")
def c08(t):
    p = _params(t)
    return t.spark.createDataFrame([(p["fixed_a"], p["fixed_b"])], "fixed_a double, fixed_b double").select(
        r("fixed_a", 5).alias("fixed_a"), r("fixed_b", 5).alias("fixed_b"))


# the bracketed root as a recursive query over the K parameter rows
_OFFSETS = "list_transform(v, lambda q: CASE WHEN {g} * q[1] + (1 - {g}) * q[2] > 0 THEN (1 - {g}) * q[2] * q[3] / ({g} * q[1] + (1 - {g}) * q[2]) ELSE 0 END)"
_LEAD = """(SELECT fa - fb FROM fx) + list_sum(list_transform(v, lambda q, j: q[1] * {x}[j] ** 2 - q[2] * (q[3] - {x}[j]) ** 2))"""
_FAIR_SQL = _PARAMS_SQL + f""", par AS (SELECT array_agg((alpha, beta, ell, cluster, ax, ay, bx, by_) ORDER BY cluster) AS v FROM e),
 ends AS (SELECT v, {_OFFSETS.format(g="0.0")} AS x0, {_OFFSETS.format(g="1.0")} AS x1 FROM par),
 br(i, lo, hi, v) AS (
  SELECT 0, CAST(CASE WHEN {_LEAD.format(x="x1")} >= 0 THEN 1 ELSE 0 END AS DOUBLE), CAST(CASE WHEN {_LEAD.format(x="x0")} <= 0 THEN 0 ELSE 1 END AS DOUBLE), v FROM ends
  UNION ALL
  SELECT i + 1, CASE WHEN ld > 0 THEN m ELSE lo END, CASE WHEN ld > 0 THEN hi ELSE m END, v
  FROM (SELECT *, {_LEAD.format(x="xm")} AS ld FROM (SELECT *, {_OFFSETS.format(g="m")} AS xm FROM (SELECT *, (lo + hi) / 2 AS m FROM br WHERE i < 45)))),
 last AS (SELECT v, {_OFFSETS.format(g="m")} AS x FROM (SELECT v, (lo + hi) / 2 AS m FROM br ORDER BY i DESC LIMIT 1)),
 px AS (SELECT unnest(v) AS q, unnest(x) AS x FROM last)"""


@query("c09_balance_search", f"WITH RECURSIVE {_FAIR_SQL} SELECT CAST(q[4] AS INTEGER) AS cluster, round(x, 5) AS x FROM px")
def c09(t):
    x = C.balance(_params(t))
    return t.spark.createDataFrame([(k, float(v)) for k, v in enumerate(x)], "cluster int, x double").select("cluster", r("x", 5).alias("x"))


@query("c10_new_centres", f"""WITH RECURSIVE {_FAIR_SQL} SELECT CAST(q[4] AS INTEGER) AS cluster,
 round(((q[3] - x) * q[5] + x * q[7]) / q[3], 5) AS x, round(((q[3] - x) * q[6] + x * q[8]) / q[3], 5) AS y FROM px""")
def c10(t):
    p = _params(t)
    return _centres(t, C.shifted_centres(p, C.balance(p)))


@query("c11_fair_lloyd")
def c11(t):
    pts = S.points(t).persist()
    centres = C.fair_lloyd(pts, 4, 5, seeds=CENTRES)
    out = _centres(t, centres).withColumn("phi", F.lit(round(C.fair_objective(pts, centres).first()[0], 5)))
    pts.unpersist()
    return out


@query("c11b_fair_lloyd_l1")
def c11b(t):
    return _centres(t, C.fair_lloyd(S.points(t), 4, 3, metric="l1", seeds=CENTRES))


@query("c12_compare_report")
def c12(t):
    return C.compare_report(S.points(t), 4, 5)
