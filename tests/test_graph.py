import collections
import itertools
import random

import pytest
from pyspark.sql import functions as F

from lodestat.operators import graph, nullmodels, trianglecells
from lodestat.operators.frames import endpoints

E = "g string, src string, dst string"
SMALL = {
    "triangle": [("a", "b"), ("b", "c"), ("a", "c")],
    "path": [("a", "b"), ("b", "c"), ("c", "d")],
    "star": [("a", "b"), ("a", "c"), ("a", "d")],
    "two": [("a", "b"), ("c", "d"), ("c", "e"), ("d", "e")],
}


def frame(spark, graphs):
    return spark.createDataFrame([(g, *sorted(e)) for g, es in graphs.items() for e in es], E)


def brute(edges):
    near = collections.defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    cl = []
    for v, nb in near.items():
        d = len(nb)
        t = sum(1 for x, y in itertools.combinations(nb, 2) if y in near[x])
        cl.append(2 * t / (d * (d - 1)) if d > 1 else 0.0)
    total = pairs = 0
    comp = set()
    for s in near:
        dist, todo = {s: 0}, [s]
        for x in todo:
            for y in near[x]:
                if y not in dist:
                    dist[y] = dist[x] + 1
                    todo.append(y)
        comp.add(min(dist))
        total += sum(dist.values())
        pairs += len(dist) - 1
    return sum(cl) / len(cl), len(comp), total / pairs, pairs


@pytest.fixture(scope="module")
def graphs():
    rnd = random.Random(4)
    names = [f"n{i:03d}" for i in range(150)]
    big = {tuple(sorted(rnd.sample(names, 2))) for _ in range(260)}
    hub = {("h", n) for n in names[:80]} | {tuple(sorted(rnd.sample(names[:40], 2))) for _ in range(120)}
    return {**SMALL, "big": sorted(big), "hub": sorted(tuple(sorted(e)) for e in hub)}


def test_metrics_against_brute_force(spark, graphs):
    edges = frame(spark, graphs).cache()
    nodes = endpoints(edges, ["g"]).cache()
    cl = {r["g"]: r["clustering"] for r in graph.average_clustering(nodes, edges, ["g"]).collect()}
    con = {r["g"]: r["n_components"] for r in graph.connectivity(nodes, edges, ["g"]).collect()}
    path = {r["g"]: r for r in graph.path_lengths(nodes, edges, ["g"]).collect()}
    for g, es in graphs.items():
        c, n, m, pairs = brute(es)
        assert cl[g] == pytest.approx(c), g
        assert con[g] == n, g
        assert path[g]["mean_path"] == pytest.approx(m) and path[g]["n_pairs"] == pairs, g
    st = {r["g"]: r for r in graph.network_stats(nodes, edges, ["g"]).collect()}
    assert (st["path"]["n_nodes"], st["path"]["n_edges"], st["path"]["mean_degree"], st["path"]["density"]) == (4, 3, 1.5, 0.5)


def test_sampled_sources(spark, graphs):
    edges = frame(spark, {"big": graphs["big"]})
    nodes = endpoints(edges, ["g"])
    assert graph.path_lengths(nodes, edges, ["g"], n_sources=5).first()["n_sources"] == 5


def test_random_graphs_have_the_asked_size(spark, graphs):
    names = [f"k{i}" for i in range(9)]
    dense = [e for e in itertools.combinations(names, 2)][:-3]
    edges = frame(spark, {"big": graphs["big"], "dense": dense})
    nodes = endpoints(edges, ["g"])
    er = nullmodels.random_graphs(nodes, edges, ["g"], 3).collect()
    for g, want, n in (("big", len(graphs["big"]), len({x for e in graphs["big"] for x in e})), ("dense", len(dense), 9)):
        per = [[(r["src"], r["dst"]) for r in er if r["g"] == g and r["rep"] == k] for k in range(3)]
        for es in per:
            assert len(es) == len(set(es)) == want
            assert all(0 <= a < b < n for a, b in es)
        assert set(per[0]) != set(per[1])


def test_swaps_keep_every_degree(spark, graphs):
    edges = frame(spark, {"big": graphs["big"], "hub": graphs["hub"]})
    sw, share = nullmodels.swapped_graphs(edges, ["g"], 2, rounds=4)
    rows = sw.collect()
    for g, rep in itertools.product(("big", "hub"), range(2)):
        es = [(r["src"], r["dst"]) for r in rows if r["g"] == g and r["rep"] == rep]
        deg = lambda x: collections.Counter(n for e in x for n in e)
        assert deg(es) == deg(graphs[g]) and len(set(es)) == len(es) and all(a < b for a, b in es)
        assert set(es) != set(graphs[g])
    for r in share.collect():
        assert 0 < r["accepted_share"] <= 1 and r["swapped"] <= r["proposed"]


def test_significance(spark):
    # cliques cluster far more than any null model
    edges = [e for k in range(6) for e in itertools.combinations([f"c{k}{i}" for i in range(5)], 2)]
    edges += [(f"c{k}0", f"c{k + 1}1") for k in range(5)]
    df = frame(spark, {"cliques": edges})
    r = nullmodels.clustering_significance(endpoints(df, ["g"]), df, ["g"], reps=4, rounds=3).first()
    assert r["p_er"] == 0 and r["p_sw"] == 0 and r["c_real"] > 0.7 and r["reps"] == 4


def test_degree_tables(spark):
    e = spark.createDataFrame([("g", "a", "b"), ("g", "a", "c")], E)
    n = endpoints(e, ["g"])
    out = {r["node"]: r["degree"] for r in graph.degrees(n, e, ["g"], directed=True).collect()}
    assert out == {"a": 2, "b": 0, "c": 0}
    h = graph.degree_histogram(graph.degrees(n, e, ["g"], directed=True), ["g"]).collect()
    assert [(r["degree"], r["n"], r["share"]) for r in h] == [(2, 1, 1.0)]
    assert graph.sampling_bound(graph.degrees(n, e, ["g"]), ["g"]).select(F.round("ratio", 6)).first()[0] == pytest.approx(0.333333)


def test_long_paths_are_followed_to_the_end(spark):
    edges = spark.createDataFrame([("p", f"{i:02d}", f"{i + 1:02d}") for i in range(8)], "g string, src string, dst string")
    nodes = endpoints(edges, ["g"])
    r = graph.path_lengths(nodes, edges, ["g"]).first()
    assert r["n_pairs"] == 72 and r["mean_path"] == pytest.approx(10 / 3)


def test_merged_counters_estimate_the_mean_path(spark):
    rng = random.Random(2)
    ring = [("r", f"{i:03d}", f"{(i + 1) % 200:03d}") for i in range(200)]
    more = [("r", f"{rng.randrange(200):03d}", f"{rng.randrange(200):03d}") for _ in range(60)]
    rows = ring + [e for e in more if e[1] != e[2]] + [("s", "a", "b"), ("s", "b", "c"), ("two", "a", "b"), ("two", "c", "d")]
    edges = spark.createDataFrame(rows, "g string, src string, dst string")
    nodes = endpoints(edges, ["g"])
    exact = {r["g"]: r for r in graph.path_lengths(nodes, edges, ["g"]).collect()}
    got = {r["g"]: r for r in graph.estimated_path_lengths(nodes, edges, ["g"], lg_k=10).collect()}
    for g, want in exact.items():
        bound = 3 * got[g]["error"]
        assert got[g]["n_nodes"] == want["n_sources"]
        assert got[g]["n_pairs"] == pytest.approx(want["n_pairs"], rel=bound) and got[g]["mean_path"] == pytest.approx(want["mean_path"], rel=bound)
    assert got["s"]["mean_path"] == pytest.approx(4 / 3, rel=1e-3) and got["two"]["n_pairs"] == pytest.approx(4, rel=1e-3)
    with pytest.raises(RuntimeError):
        graph.estimated_path_lengths(nodes, edges, ["g"], rounds=2)


def test_triangles_in_cells_are_found_once(spark):
    """Cells of every kind of colours together find each triangle once, in pieces of a few paths too."""
    rnd = random.Random(5)
    pairs = sorted({tuple(sorted(rnd.sample(range(60), 2))) for _ in range(500)})
    near = collections.defaultdict(set)
    for x, y in pairs:
        near[x].add(y)
        near[y].add(x)
    want = {v: sum(1 for x, y in itertools.combinations(sorted(nb), 2) if y in near[x]) for v, nb in near.items()}
    up = spark.createDataFrame(pairs, "low long, high long")
    for b in (1, 2, 3, 5):
        got = {r["id"]: r["triangles"] for r in trianglecells.triangle_counts(up, len(pairs), b).collect()}
        assert got == {v: n for v, n in want.items() if n}, b
    assert trianglecells.colours(70_000_000) == 11 and trianglecells.colours(10) == 4


def test_paths_of_two_edges_are_no_rows(spark, graphs):
    """No join of edges with edges: the plan of the triangles has none after the numbering."""
    up = spark.createDataFrame([(0, 1), (1, 2), (0, 2)], "low long, high long")
    plan = trianglecells.triangle_counts(up, 3)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_swaps_in_many_small_cells_keep_every_degree(spark, graphs, monkeypatch):
    """Colours that change from round to round let edges of all cells meet."""
    monkeypatch.setattr(nullmodels, "_CELL", 30)
    edges = frame(spark, {"big": graphs["big"]})
    sw, share = nullmodels.swapped_graphs(edges, ["g"], 1, rounds=9)
    es = [(r["src"], r["dst"]) for r in sw.collect()]
    deg = lambda x: collections.Counter(n for e in x for n in e)
    assert deg(es) == deg(graphs["big"]) and len(set(es)) == len(es) and all(a < b for a, b in es)
    assert len(set(es) & set(graphs["big"])) < len(es) / 2 and share.first()["accepted_share"] > 0.5


def test_random_graphs_draw_few_more_pairs_than_they_keep(spark, monkeypatch):
    rnd = random.Random(6)
    pairs = sorted({tuple(sorted(rnd.sample([f"{i:04d}" for i in range(2000)], 2))) for _ in range(10_000)})
    edges = frame(spark, {"wide": pairs})
    ranked, plain = [], nullmodels.rank_within
    monkeypatch.setattr(nullmodels, "rank_within", lambda df, by, order, name: ranked.append(df.count()) or plain(df, by, order, name))
    out = nullmodels.random_graphs(endpoints(edges, ["g"]), edges, ["g"], 1).collect()
    assert len(out) == len({(r["src"], r["dst"]) for r in out}) == len(pairs)
    assert max(ranked) < 1.2 * len(pairs)


def test_both_word_networks_come_from_one_pass_over_the_texts(spark, monkeypatch):
    from lodestat.plans import graphs as plans
    links = spark.createDataFrame([("g", "b", "a"), ("g", "a", "b"), ("g", "b", "a"), ("g", "a", "a")], "lang string, src string, dst string")
    asked = []
    monkeypatch.setattr(plans.S, "word_links", lambda t: asked.append(t) or links)
    got = {tuple(r) for r in plans.g01(None).collect()}
    assert got == {("undirected", "g", "a", 1, "b", "b"), ("directed", "g", "a", 2, "a", "b"), ("directed", "g", "b", 1, "a", "a")}
    assert len(asked) == 1


def test_counters_are_never_broadcast(spark):
    """Counters that are alike make tiny files and large tables."""
    held = graph.cut(spark.createDataFrame([("g", "a"), ("g", "b")], "g string, node string").withColumn("s", F.lit(b"")).withColumn("size", F.lit(1.0)))
    arcs = graph.cut(spark.createDataFrame([("g", "a", "b"), ("g", "b", "a")], "g string, node string, to string"))
    plan = graph._merged_counters(held, arcs, ["g"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and "Broadcast" not in plan


def test_arcs_stay_in_their_buckets(spark):
    """A level of the search shuffles masks only: no exchange and no sort of the arcs."""
    arcs = graph._bucketed(spark.createDataFrame([(i, (i * 7) % 50) for i in range(50)], "u long, v long"))
    fresh = graph.cut(spark.createDataFrame([(1, 0, 1), (2, 0, 2)], "id long, part long, mask long"))
    plan = graph._reached(fresh, arcs)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Sort" not in plan
    # one for the masks sent and one for those that arrive
    assert plan.count("Exchange hashpartitioning") == 2
    assert {(r["id"], r["_in"]) for r in graph._reached(fresh, arcs).collect()} == {(7, 1), (14, 2)}


def test_nodes_are_told_apart_whatever_the_hash(spark, monkeypatch):
    edges = frame(spark, {"two": SMALL["two"]})
    plain = F.xxhash64
    # under the first seed all nodes have one number
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.lit(1).cast("bigint") if c and not isinstance(c[0], str) and "seed0" in str(c[0]) else plain(*c))
    monkeypatch.setattr(graph, "_seed", lambda seed: F.lit(f"seed{seed}"))
    named, pairs = graph._coded(endpoints(edges, ["g"]), edges, ["g"])
    assert named.select("id").distinct().count() == 5 and pairs.distinct().count() == 4
    assert graph.connectivity(endpoints(edges, ["g"]), edges, ["g"]).first()["n_components"] == 2
