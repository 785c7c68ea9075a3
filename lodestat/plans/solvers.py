"""Label spreading over customers and simplex-constrained fits."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestat.operators import simplex
from lodestat.operators.fieldsums import kernel_sums
from lodestat.operators.frames import MASK_P, row_hash
from lodestat.operators.spreading import FieldSpreading, Spreading, gap_history, kernel_edges, locations
from lodestat.plans.registry import query
from lodestat.plans.tabular import r, row_hash_sql
from lodestat.session import cut

# kernel widths for labelled and unlabelled neighbours, ridge, smallest weight kept
SIGMA, SIGMA_BAR, ALPHA, EPS = 0.3, 0.25, 0.1, 1e-15
COORDS = ["x", "y"]


def spread_points(t):
    """(id, x, y, label): customers at (balance, nation); one in ten keeps its label."""
    hidden = row_hash(F.col("c_custkey")) < int(0.9 * MASK_P)
    label = F.when(F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE"), 1).otherwise(-1)
    return t.customer.select(F.col("c_custkey").alias("id"), (F.col("c_acctbal") / 100).alias("x"), F.col("c_nationkey").cast("double").alias("y"),
                             F.when(~hidden, label).alias("label"))


_PTS = f"""p AS (SELECT c_custkey AS id, c_acctbal / 100 AS x, c_nationkey::DOUBLE AS y, CASE WHEN {row_hash_sql('c_custkey')} < {int(0.9 * MASK_P)} THEN NULL
  WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN 1 ELSE -1 END AS label FROM customer),
 lo AS (SELECT min(id) AS loc, x, y, count(label) AS n_lab, coalesce(sum(label), 0)::DOUBLE AS sum_lab, count(*) - count(label) AS n_unl FROM p GROUP BY x, y),
 un AS (SELECT * FROM lo WHERE n_unl > 0), la AS (SELECT * FROM lo WHERE n_lab > 0),
 lu AS (SELECT a.loc AS a, b.loc AS b, exp(-((a.x - b.x) ** 2 + (a.y - b.y) ** 2) / (2 * {SIGMA} * {SIGMA})) AS w, b.n_lab, b.sum_lab FROM un a, la b WHERE w > {EPS}),
 uu AS (SELECT a.loc AS a, b.loc AS b, exp(-((a.x - b.x) ** 2 + (a.y - b.y) ** 2) / (2 * {SIGMA_BAR} * {SIGMA_BAR})) AS w, b.n_unl AS u FROM un a, un b WHERE a.loc <> b.loc AND w > {EPS})"""

_NODES = _PTS + f""", dw AS (SELECT a AS loc, sum(w * n_lab) AS dw, sum(w * sum_lab) AS pull FROM lu GROUP BY 1), ds AS (SELECT a AS loc, sum(w * u) AS ds, sum(4 * w * w * u) AS c2 FROM uu GROUP BY 1),
 nd AS (SELECT un.loc, n_unl AS u, 2 * (coalesce(dw, 0) + coalesce(ds, 0) + n_unl - 1) + {ALPHA}::DOUBLE AS d, coalesce(c2, 0) AS c2, -2 * coalesce(pull, 0) AS b FROM un LEFT JOIN dw USING (loc) LEFT JOIN ds USING (loc)),
 st AS (SELECT *, (loc % 7 - 3) / 10.0::DOUBLE AS y FROM nd),
 sd AS (SELECT a AS loc, sum(w * uu.u * y) AS s FROM uu JOIN st ON st.loc = uu.b GROUP BY 1),
 gr AS (SELECT st.*, (d - 2 * (u - 1)) * y - 2 * coalesce(s, 0) + b AS g FROM st LEFT JOIN sd USING (loc))"""


def problem(t) -> Spreading:
    return Spreading(spread_points(t), COORDS, SIGMA, SIGMA_BAR, ALPHA, EPS)


def field_problem(t) -> FieldSpreading:
    """The same without a table of pairs."""
    return FieldSpreading(spread_points(t), COORDS, SIGMA, SIGMA_BAR, ALPHA)


def start(s: Spreading):
    return s.nodes.select("loc", (F.pmod("loc", F.lit(7)) - 3).cast("double").alias("y")).withColumn("y", F.col("y") / 10)


@query("j09_kernel_join", f"WITH {_PTS} SELECT 'labelled' AS side, a, b, round(w, 9) AS w FROM lu UNION ALL SELECT 'unlabelled', a, b, round(w, 9) FROM uu")
def j09(t):
    loc = cut(locations(spread_points(t), COORDS))
    un, la = loc.filter("n_unl > 0"), loc.filter("n_lab > 0")
    # nine decimals as a product and a floor: billions of pairs are rounded, and decimal numbers take longer than the join
    w = F.floor(F.col("w") * 1e9 + 0.5) / 1e9
    lu = kernel_edges(un, la, COORDS, SIGMA, EPS).select(F.lit("labelled").alias("side"), "a", "b", w.alias("w"))
    uu = kernel_edges(un, un, COORDS, SIGMA_BAR, EPS).filter("a <> b").select(F.lit("unlabelled").alias("side"), "a", "b", w.alias("w"))
    return lu.unionByName(uu)


_SUMS = _PTS + """, ks AS (SELECT a.loc, sum(b.n_unl * exp(-((a.x - b.x) ** 2 + (a.y - b.y) ** 2) / (2 * {s} * {s}))) AS s FROM un a, un b WHERE (a.x - b.x) ** 2 + (a.y - b.y) ** 2 < 64 * {s} * {s} GROUP BY 1)""".format(s=SIGMA_BAR)


@query("j09b_kernel_sums", f"WITH {_SUMS} SELECT loc, round(s, 8) AS s FROM ks")
def j09b(t):
    """Sum of the kernel over all unlabelled customers at each of their places, without their pairs."""
    un = locations(spread_points(t), COORDS).filter("n_unl > 0")
    return kernel_sums(un, un, COORDS, SIGMA_BAR, ["n_unl"]).select("loc", r("s_n_unl", 8).alias("s"))


@query("o01_objective_terms", f"WITH {_NODES} SELECT loc, u, round(d, 6) AS d, round(b, 6) AS b FROM nd")
def o01(t):
    return field_problem(t).nodes.select("loc", "u", r("d").alias("d"), r("b").alias("b"))


@query("o02_gradient", f"WITH {_NODES} SELECT loc, round(g, 6) AS g FROM gr")
def o02(t):
    s = field_problem(t)
    return s.state(start(s)).select("loc", r("g").alias("g"))


@query("o02b_objective_value", f"WITH {_NODES} SELECT round(sum(u * y * (g + b) / 2), 5) AS f, round(sqrt(sum(u * g * g)), 5) AS norm FROM gr")
def o02b(t):
    s = field_problem(t)
    f, n = s.measure(s.state(start(s)))
    return t.spark.createDataFrame([(round(f, 5), round(n, 5))], "f double, norm double")


@query("o03_step_rules", f"WITH {_NODES} SELECT loc, round(1 / d, 8) AS exact, round(1 / sqrt(d * d + c2 + 4 * (u - 1)), 8) AS block_l FROM nd")
def o03(t):
    s = field_problem(t)
    return s.nodes.select("loc", r(s.step("exact"), 8).alias("exact"), r(s.step("block_L"), 8).alias("block_l"))


@query("o03b_spectral_norm")
def o03b(t):
    return t.spark.createDataFrame([(field_problem(t).spectral_norm(),)], "norm double")


# two simultaneous rounds with the exact rule, spelled out
_ROUND2 = _NODES + """, y1 AS (SELECT loc, u, d, b, y - g / d AS y FROM gr), s1 AS (SELECT a AS loc, sum(w * uu.u * y) AS s FROM uu JOIN y1 ON y1.loc = uu.b GROUP BY 1),
 g1 AS (SELECT y1.*, (d - 2 * (u - 1)) * y - 2 * coalesce(s, 0) + b AS g FROM y1 LEFT JOIN s1 USING (loc)), y2 AS (SELECT loc, y - g / d AS y FROM g1)"""


@query("o04_two_descent_rounds", f"WITH {_ROUND2} SELECT loc, round(y, 6) AS y FROM y2")
def o04(t):
    s = field_problem(t)
    state, _ = s.descend("exact", rounds=2, tol=0.0, start=start(s))
    return state.select("loc", r("y").alias("y"))


@query("o04b_descent_history")
def o04b(t):
    _, h = field_problem(t).descend("exact", rounds=8, tol=1e-6)
    return t.spark.createDataFrame(h, "round int, f double, norm double")


@query("o05_greedy_rounds")
def o05(t):
    _, h = field_problem(t).greedy(m=64, rounds=4)
    return t.spark.createDataFrame(h, "round int, f double, norm double")


@query("o05b_greedy_single_step", f"WITH {_NODES}, top AS (SELECT loc FROM gr ORDER BY g * g / d DESC, loc LIMIT 1) SELECT loc, round(CASE WHEN loc = (SELECT loc FROM top) THEN y - g / d ELSE y END, 6) AS y FROM gr")
def o05b(t):
    s = field_problem(t)
    state, _ = s.greedy(m=1, rounds=1, tol=0.0, start=start(s))
    return state.select("loc", r("y").alias("y"))


@query("o06_block_sweeps")
def o06(t):
    _, h = field_problem(t).sweep(epochs=2)
    return t.spark.createDataFrame(h, "round int, f double, norm double")


@query("o06b_colouring", f"WITH {_PTS} SELECT count(*) AS nodes, 0::BIGINT AS conflicts, true AS at_most_one_more_than_degree FROM un")
def o06b(t):
    """Every place has a colour, neighbours differ, and colours are at most one more than the largest degree."""
    s = field_problem(t)
    seen = s.neighbours(s.colours()).agg(F.count("colour").alias("nodes"), F.coalesce(F.sum("same"), F.lit(0)).alias("conflicts"), F.max("colour").alias("top"), F.max("n").alias("degree"))
    return seen.select("nodes", "conflicts", (F.col("top") <= F.col("degree")).alias("at_most_one_more_than_degree"))


@query("o07_optimum_and_gaps")
def o07(t):
    s = field_problem(t)
    _, best, _ = s.solve()
    _, h = s.descend("exact", rounds=4)
    return gap_history(t.spark, {"exact": h}, best)


@query("o08_simplex_projection", """WITH v AS (SELECT o_orderpriority AS g, o_orderkey AS k, o_totalprice / 10000 AS y FROM orders),
 s AS (SELECT g, y, sum(y) OVER w AS s, row_number() OVER w AS i FROM v WINDOW w AS (PARTITION BY g ORDER BY y DESC, k ROWS UNBOUNDED PRECEDING)),
 t AS (SELECT g, arg_max((s - 5) / i, i) AS tau FROM s WHERE y > (s - 5) / i GROUP BY 1)
 SELECT k, round(greatest(y - tau, 0), 8) AS projected FROM v JOIN t USING (g)""")
def o08(t):
    v = t.orders.select(F.col("o_orderpriority").alias("g"), F.col("o_orderkey").alias("k"), (F.col("o_totalprice") / 10000).alias("y"))
    return simplex.project_simplex(v, "y", ["g"], 5.0).select("k", r("projected", 8).alias("projected"))


def _mix(t):
    price = (F.col("l_extendedprice") / 100000).alias("y")
    return t.lineitem.select(price, (F.col("l_quantity") / 50).alias("a"), (F.col("l_discount") * 10).alias("b"), (F.col("l_tax") * 10).alias("c"), (F.col("l_linenumber") / 7).alias("d"))


_MIX = """x AS (SELECT l_extendedprice / 100000 AS y, l_quantity / 50 AS a, l_discount * 10 AS b, l_tax * 10 AS c, l_linenumber / 7 AS d FROM lineitem)"""


def _fw_sql(steps):
    """Frank-Wolfe steps on the four weights, one scan per step."""
    ctes = ["w0 AS (SELECT 1.0::DOUBLE AS p, 0.0::DOUBLE AS q, 0.0::DOUBLE AS r, 0.0::DOUBLE AS s)"]
    for t in range(steps):
        e = "(p * a + q * b + r * c + s * d - y)"
        ctes.append(f"g{t} AS (SELECT any_value(p) AS p, any_value(q) AS q, any_value(r) AS r, any_value(s) AS s, avg({e} * {e}) / 2 AS loss, avg({e} * a) AS ga, avg({e} * b) AS gb, avg({e} * c) AS gc, avg({e} * d) AS gd FROM x, w{t})")
        h = 2.0 / (t + 2)
        low = "least(ga, gb, gc, gd)"
        cols = ", ".join(f"{n} + {h} * ((CASE WHEN {g} = {low} THEN 1 ELSE 0 END) - {n}) AS {n}" for n, g in zip("pqrs", ("ga", "gb", "gc", "gd")))
        ctes.append(f"w{t + 1} AS (SELECT {cols} FROM g{t})")
    hist = " UNION ALL ".join(f"SELECT {t}::INTEGER AS step, round(loss, 8) AS loss, round(p * ga + q * gb + r * gc + s * gd - least(ga, gb, gc, gd), 8) AS gap FROM g{t}" for t in range(steps))
    return f"WITH {_MIX}, {', '.join(ctes)} {hist}"


@query("o09_frank_wolfe", _fw_sql(6))
def o09(t):
    _, h = simplex.simplex_regression(_mix(t), ["a", "b", "c", "d"], "y", "frank_wolfe", 6)
    return t.spark.createDataFrame(h, "step int, loss double, gap double").select("step", r("loss", 8).alias("loss"), r("gap", 8).alias("gap"))


@query("o09b_simplex_methods")
def o09b(t):
    x, rows = _mix(t).persist(), []
    for m in ("frank_wolfe", "away", "pairwise", "projected"):
        w, h = simplex.simplex_regression(x, ["a", "b", "c", "d"], "y", m, 25)
        rows.append((m, len(h), h[-1][1], h[-1][2], [float(v) for v in w]))
    x.unpersist()
    return t.spark.createDataFrame(rows, "method string, steps int, loss double, gap double, weights array<double>")
