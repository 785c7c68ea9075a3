import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestat.operators import simplex, spreading
from lodestat.operators.spreading import FieldSpreading, Spreading, gap_history


@pytest.fixture(scope="module")
def problem(spark):
    """Points with copies: the dense problem over all points next to ours over locations."""
    rng = np.random.default_rng(6)
    xy = rng.uniform(0, 6, (60, 2))
    xy[40:50] = xy[0]  # a heap of copies
    xy[55] = xy[56]
    label = [None] * 60
    for i in (0, 3, 9, 20, 45, 55):
        label[i] = 1 if i % 2 else -1
    rows = [(i, float(a), float(b), label[i]) for i, (a, b) in enumerate(xy)]
    df = spark.createDataFrame(rows, "id bigint, x double, y double, label int")
    s = Spreading(df, ["x", "y"], 0.7, 0.5, alpha=0.2)
    lab = [i for i in range(60) if label[i] is not None]
    unl = [i for i in range(60) if label[i] is None]
    d2 = ((xy[:, None] - xy[None]) ** 2).sum(-1)
    w_lu = np.exp(-d2[np.ix_(lab, unl)] / (2 * 0.49))
    w_uu = np.exp(-d2[np.ix_(unl, unl)] / (2 * 0.25))
    np.fill_diagonal(w_uu, 0)
    q = 2 * (np.diag(w_lu.sum(0)) + np.diag(w_uu.sum(1)) - w_uu) + 0.2 * np.eye(len(unl))
    b = -2 * w_lu.T @ np.array([label[i] for i in lab], float)
    # location of each unlabelled point
    first = {}
    for i, p in enumerate(map(tuple, xy)):
        first.setdefault(p, i)
    loc = [first[tuple(xy[i])] for i in unl]
    return s, q, b, loc


def test_gradient_and_value(problem):
    s, q, b, loc = problem
    y = np.array([(v % 5 - 2) / 4 for v in loc])
    start = s.nodes.select("loc", ((F.pmod("loc", F.lit(5)) - 2) / 4.0).alias("y"))
    st = s.state(start)
    g = q @ y + b
    got = {r["loc"]: r["g"] for r in st.collect()}
    assert [got[v] for v in loc] == pytest.approx(g.tolist())
    f, n = s.measure(st)
    assert f == pytest.approx(0.5 * y @ q @ y + b @ y) and n == pytest.approx(np.linalg.norm(g))


def test_step_rules(problem):
    s, q, _, loc = problem
    rows = {r["loc"]: r for r in s.nodes.collect()}
    assert [rows[v]["d"] for v in loc] == pytest.approx(np.diag(q).tolist())
    assert [rows[v]["col_norm"] for v in loc] == pytest.approx(np.linalg.norm(q, axis=0).tolist())
    norm = s.spectral_norm()
    assert norm == pytest.approx(np.linalg.norm(q, 2), rel=2e-6) and norm >= np.linalg.norm(q, 2) * (1 - 1e-12)


def test_solvers_reach_the_direct_solution(problem, spark):
    s, q, b, loc = problem
    y = np.linalg.solve(q, -b)
    best = 0.5 * y @ q @ y + b @ y
    sol, f, _ = s.solve(rounds=60, tol=1e-9)
    got = {r["loc"]: r["y"] for r in sol.collect()}
    assert f == pytest.approx(best) and [got[v] for v in loc] == pytest.approx(y.tolist(), abs=1e-7)
    runs = {"exact": s.descend("exact", rounds=6)[1], "greedy": s.greedy(m=1, rounds=3)[1], "blocks": s.greedy(m=8, rounds=4)[1],
            "sweep": s.sweep(epochs=2)[1]}
    for name, h in runs.items():
        fs = [r[1] for r in h]
        assert fs[-1] < fs[0] and fs[-1] >= best - 1e-9, name
    for name in ("greedy", "blocks", "sweep"):  # single coordinates never raise F
        fs = [r[1] for r in runs[name]]
        assert all(x >= z - 1e-12 for x, z in zip(fs, fs[1:])), name
    gaps = gap_history(spark, runs, best).collect()
    assert all(0 <= r["percent"] <= 100 for r in gaps)


def test_a_coloured_sweep_is_one_coordinate_after_the_other(problem):
    s, q, b, loc = problem
    colour = {r["loc"]: r["colour"] for r in s.colours(3).collect()}
    assert set(colour) == set(loc)
    assert all(colour[r["a"]] != colour[r["b"]] for r in s.edges.collect())
    names = sorted(set(colour.values()))
    y, at = np.zeros(len(loc)), {v: [i for i, x in enumerate(loc) if x == v] for v in set(loc)}
    for epoch in range(2):
        for c in np.random.default_rng([3, epoch]).permutation(len(names)):
            for v in sorted(v for v in at if colour[v] == names[c]):  # copies of a place move together
                i = at[v][0]
                y[at[v]] -= (q[i] @ y + b[i]) / q[i, i]
    state, history = s.sweep(epochs=2, tol=0.0, seed=3)
    got = {r["loc"]: (r["y"], r["g"]) for r in state.collect()}
    assert [got[v][0] for v in loc] == pytest.approx(y.tolist(), abs=1e-9)
    # gradients that were only changed by moves are still the true ones
    assert [got[v][1] for v in loc] == pytest.approx((q @ y + b).tolist(), abs=1e-9)
    assert len(history) == 3


def test_projection(spark):
    rng = np.random.default_rng(8)
    rows = [("g", i, float(v)) for i, v in enumerate(rng.normal(size=200))] + [("h", 1000 + i, 0.3) for i in range(50)]
    df = spark.createDataFrame(rows, "g string, id int, y double")
    out = simplex.project_simplex(df, "y", ["g"], 2.0).toPandas().sort_values("id")
    for g, part in out.groupby("g"):
        w = part["projected"].to_numpy()
        assert w.sum() == pytest.approx(2.0) and w.min() >= 0
        assert w == pytest.approx(simplex.project_vector(part["y"].to_numpy(), 2.0))


@pytest.mark.parametrize("method,steps", [("frank_wolfe", 60), ("away", 60), ("pairwise", 60), ("projected", 25)])
def test_simplex_methods(method, steps):
    rng = np.random.default_rng(9)
    a, y = rng.normal(size=(50, 5)), None
    y = a @ np.array([0.5, 0.3, 0.2, 0, 0]) + 0.01 * rng.normal(size=50)

    def oracle(w):
        e = a @ w - y
        return float(e @ e) / 100, a.T @ e / 50
    w, h = simplex.minimise_on_simplex(oracle, 5, method, steps)
    assert simplex.is_on_simplex(w) and h[-1][1] < 0.02 * h[0][1]
    assert w == pytest.approx([0.5, 0.3, 0.2, 0, 0], abs=0.1)


def test_losses_match_their_gradients(spark):
    rng = np.random.default_rng(10)
    x = rng.normal(size=(40, 2))
    df = spark.createDataFrame([(float(a), float(b), int(a > 0)) for a, b in x], "a double, b double, k int").cache()
    for make in (simplex.squared_loss, simplex.logistic_loss):
        f = make(df, ["a", "b"], "k")
        w, h = np.array([0.3, 0.7]), 1e-5
        _, g = f(w)
        num = [(f(w + h * e)[0] - f(w - h * e)[0]) / (2 * h) for e in np.eye(2)]
        assert g == pytest.approx(np.array(num), abs=1e-6)


def test_conjugate_gradient_settles_or_raises(problem):
    s, q, b, loc = problem
    best = np.linalg.solve(q, -b)
    y, f, used = s.solve(tol=1e-10)
    got = {r["loc"]: r["y"] for r in y.collect()}
    assert [got[v] for v in loc] == pytest.approx(best.tolist(), abs=1e-9)
    assert f == pytest.approx(0.5 * best @ q @ best + b @ best, rel=1e-10) and 0 < used < 60
    with pytest.raises(RuntimeError):
        s.solve(rounds=2, tol=1e-10)
    with pytest.raises(RuntimeError):
        s.spectral_norm(tol=1e-12, rounds=2)


def test_moves_without_a_table_of_pairs(spark):
    rng = np.random.default_rng(9)
    xy = rng.uniform(0, 12, (90, 2))
    xy[40:46] = xy[0]
    rows = [(i, float(a), float(b), (1 if i % 2 else -1) if i % 9 == 0 else None) for i, (a, b) in enumerate(xy)]
    df = spark.createDataFrame(rows, "id bigint, x double, y double, label int")
    pairs, field = Spreading(df, ["x", "y"], 0.7, 0.4, alpha=0.2), FieldSpreading(df, ["x", "y"], 0.7, 0.4, alpha=0.2)
    assert not hasattr(field, "edges")
    # the greedy moves are those of the table of pairs
    for m in (9,):
        a, b = pairs.greedy(m=m, rounds=2)[1], field.greedy(m=m, rounds=2)[1]
        assert [x for r in b for x in r] == pytest.approx([x for r in a for x in r], abs=1e-9)
    colour = {r["loc"]: r["colour"] for r in field.colours(3).collect()}
    edges = pairs.edges.select("a", "b").collect()
    degree = {v: 0 for v in colour}
    for r in edges:
        degree[r["a"]] += 1
        assert colour[r["a"]] != colour[r["b"]]
    assert set(colour) == {r["loc"] for r in pairs.nodes.collect()} and all(0 <= c <= degree[v] for v, c in colour.items())
    one = field.nodes.select("loc", F.lit(0).alias("colour"))
    assert {r["loc"]: (r["n"], r["same"]) for r in field.neighbours(one).collect()} == {v: (d, d) for v, d in degree.items()}
    # a sweep lowers F with every epoch, and its gradients are the true ones
    state, history = field.sweep(epochs=2, tol=0.0, seed=3)
    f = [h[1] for h in history]
    assert f[0] > f[1] > f[2] and f[1] - f[2] < 0.2 * (f[0] - f[1])
    got = {r["loc"]: r["g"] for r in state.collect()}
    true = {r["loc"]: r["g"] for r in pairs.state(state.select("loc", "y")).collect()}
    assert [got[v] for v in sorted(got)] == pytest.approx([true[v] for v in sorted(got)], abs=1e-9)


def test_kernel_pairs_are_found_by_many_tasks(spark):
    """Few bytes make many pairs: the join is dealt by rows, and finds what brute force finds."""
    rng = np.random.default_rng(3)
    at = np.round(np.column_stack([rng.uniform(-4, 9, 700), rng.integers(-2, 3, 700)]), 3)
    loc = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(at)], "loc long, x double, y double")
    w = np.exp(-((at[:, None] - at[None]) ** 2).sum(2) / (2 * 0.3 * 0.3))
    want = {(int(a), int(b)) for a, b in zip(*np.nonzero(w > spreading.EPSILON))}
    for rows in (spreading._ROWS, 50):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(spreading, "_ROWS", rows)
            edges = spreading.kernel_edges(loc, loc, ["x", "y"], 0.3)
            got = edges.withColumn("task", F.spark_partition_id()).collect()
        assert len(got) == len(want) and {(r["a"], r["b"]) for r in got} == want
        assert rows > 50 or len({r["task"] for r in got}) > 4


def test_rounds_of_a_field_reach_what_a_table_of_pairs_does(spark):
    """One job a round, blocks as rows: norm and optimum are the dense ones, with copies, crowded cells and missing coordinates."""
    from lodestat.operators import fieldrounds

    rng = np.random.default_rng(11)
    xy = np.concatenate([rng.uniform(0, 12, (110, 2)), rng.uniform(3, 3.15, (60, 2)), rng.uniform(-9, -8, (20, 2))])
    xy[100:106] = xy[0]
    rows = [(i, float(a), float(b), (1 if i % 2 else -1) if i % 7 == 0 else None) for i, (a, b) in enumerate(xy)]
    rows += [(900, None, 2.0, None), (901, 3.0, None, None), (902, None, None, None)]
    df = spark.createDataFrame(rows, "id bigint, x double, y double, label int")
    s = FieldSpreading(df, ["x", "y"], 0.7, 0.4, alpha=0.2)
    nodes = s.nodes.orderBy("loc").toPandas()
    x, y, u, e, b = (nodes[c].to_numpy(float) for c in ("_at0", "_at1", "u", "e", "b"))
    q = -2 * np.nan_to_num(np.exp(-((x[:, None] - x) ** 2 + (y[:, None] - y) ** 2) / (2 * 0.16))) * u + np.diag(e + 2 * u)
    assert np.isnan(x).sum() == 2 and u.max() > 1
    best = np.linalg.solve(q, -b)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(fieldrounds, "CHUNK", 30)
        m.setattr(fieldrounds, "BLOCK", 25)
        jobs = spark.sparkContext.statusTracker()
        spark.sparkContext.setJobGroup("rounds", "rounds")
        got, f, used = s.solve(tol=1e-7)
        done = len(jobs.getJobIdsForGroup("rounds"))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        norm = s.spectral_norm(tol=1e-4)
    # a round is a product, its sums and no more; adaptive execution runs each shuffle as a job
    assert 0 < used < 60 and done < 6 * used + 40
    assert [r["y"] for r in got.orderBy("loc").collect()] == pytest.approx(best.tolist(), abs=1e-5)
    assert f == pytest.approx((u * best * (q @ best)).sum() / 2 + (u * b * best).sum(), rel=1e-9)
    top = max(np.linalg.eigvalsh(np.sqrt(u)[:, None] * q / np.sqrt(u)).max(), (nodes["d"][nodes["u"] > 1] + 2).max())
    assert top * (1 - 1e-12) <= norm <= top * (1 + 2e-4)
    # where a tile is too dense for a row, the rounds go over kernel sums as before
    with pytest.MonkeyPatch.context() as m:
        m.setattr(fieldrounds, "PLACES", 10)
        assert fieldrounds.FieldRounds.of(s.nodes, s.AT, 0.4, ["b"]) is None
