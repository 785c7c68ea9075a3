"""Random reference graphs and the clustering significance test.

All replicates of all graphs are rows of one table, told apart by ``by`` and
``rep``; every step is an ordinary distributed aggregation or join.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.operators.frames import endpoints, rank_within
from lodestat.operators.graph import average_clustering, network_stats
from lodestat.operators.ordering import number_rows
from lodestat.session import cut, release, ship

# Edges of a cell, about, and how often they are paired off before the colours change.
_CELL = 1 << 20
_PAIRINGS = 4


def _replicated(df: DataFrame, reps: int) -> DataFrame:
    return df.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(reps - 1))))


def random_graphs(nodes: DataFrame, edges: DataFrame, by: list[str], reps: int, seed: int = 0) -> DataFrame:
    """Per graph and replicate: E distinct random pairs over nodes 0..N-1, no loops.

    Sparse graphs draw hashed candidates beside the real edges, few more than give E distinct
    ones, and keep the E with the lowest hash; graphs denser than one half rank all pairs.
    Columns: ``by``, rep, src, dst.
    """
    size = network_stats(nodes, edges, by).select(*by, "n_nodes", "n_edges").withColumn(
        "_pairs", F.col("n_nodes") * (F.col("n_nodes") - 1) / 2)
    size = size.withColumn("_dense", F.col("n_edges") > 0.5 * F.col("_pairs"))
    key = [*by, "rep"]
    dense = _replicated(
        rank_within(nodes.join(size.filter("_dense"), by), by, [F.col("node")], "_i"), reps
    ).filter("_i < n_nodes").select(
        *key, "n_edges", (F.col("_i") - 1).alias("src"),
        F.explode(F.sequence(F.col("_i"), F.col("n_nodes") - 1)).alias("dst"),
    ).withColumn("_prio", F.xxhash64(F.lit(seed), "rep", "src", "dst"))
    copies = 1
    while True:
        # draws for each edge that give E distinct pairs without loops on average, and eight standard deviations more
        need = -F.log(1 - F.col("n_edges") / F.col("_pairs")) * F.col("_pairs") / F.col("n_edges") / (1 - 1 / F.col("n_nodes"))
        each = need * (1 + 8 / F.sqrt("n_edges")) * copies
        share = F.pmod(F.xxhash64(F.lit(seed), F.lit(4), "src", "dst"), F.lit(1 << 20)) / (1 << 20)
        draws = F.floor(each + share).cast("int")
        drawn = _replicated(edges.join(size.filter("NOT _dense"), by).withColumn("_d", draws).filter("_d > 0"), reps).select(
            *key, "n_edges", "n_nodes", "src", "dst", F.explode(F.expr("sequence(1, _d)")).alias("_c"))
        pick = lambda tag: F.pmod(F.xxhash64(F.lit(seed), F.lit(tag), "rep", "src", "dst", "_c"), F.col("n_nodes"))
        sparse = drawn.select(*key, "n_edges", pick(1).alias("_a"), pick(2).alias("_b"),
                              F.xxhash64(F.lit(seed), F.lit(3), "rep", "src", "dst", "_c").alias("_prio")).filter("_a <> _b")
        sparse = sparse.groupBy(*key, F.least("_a", "_b").alias("src"), F.greatest("_a", "_b").alias("dst")).agg(
            F.first("n_edges").alias("n_edges"), F.min("_prio").alias("_prio"))
        pool = sparse.unionByName(dense.select(*sparse.columns))
        ranked = rank_within(pool, key, [F.col("_prio"), F.col("src"), F.col("dst")], "_r").filter(F.col("_r") <= F.col("n_edges"))
        out = ranked.select(*key, "src", "dst", "n_edges")
        short = out.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.first("n_edges").alias("_e")).filter("_n < _e")
        if short.isEmpty():
            return out.drop("n_edges")
        copies *= 2


def swap_rounds(n_edges: int) -> int:
    """Rounds in which about half of the edges propose, to reach round(ln E) * E proposals."""
    return max(1, 2 * round(math.log(max(n_edges, 2))))


def _round(state: DataFrame, key: list[str], n: int, pairings: int, seed: int) -> DataFrame:
    """A few pairings of parallel swaps; edges carry running tallies ``proposed`` and ``swapped``.

    Nodes get one of c colours, anew in each round, and a cell has all edges of two colours.  A swap of two
    edges of a cell makes edges of the same cell, so whether they exist is known inside the task.
    """
    c = F.ceil(F.sqrt(2 * F.col("n_edges") / _CELL))
    colour = [F.pmod(F.xxhash64(F.lit(seed + 1), F.lit(n), end), c) for end in ("src", "dst")]
    ends = state.withColumn("_s", colour[0]).withColumn("_d", colour[1])
    cells = ends.withColumn("_cell", F.least("_s", "_d") * c + F.greatest("_s", "_d")).withColumn("_turned", F.col("_s") > F.col("_d")).withColumn(
        "_one", F.col("_s") == F.col("_d")).withColumn("_number", F.xxhash64(F.lit(seed), F.lit(n), *key, "_cell"))
    names = [f.name for f in state.schema.fields]

    def run(table):
        column = lambda name: table.column(name).to_numpy()
        src, dst, done, ok = swap_cell(column("src"), column("dst"), column("_turned"), column("_one")[0], pairings, int(column("_number")[0]) & (2**63 - 1))
        tally = {name: np.zeros(len(src), "int64") for name in ("proposed", "swapped")}
        for name, more in (("proposed", done), ("swapped", ok)):
            tally[name][0] = column(name).sum() + more  # the first edge carries the cell's tally on
        new = {"src": src, "dst": dst, **tally}
        return pa.table({name: pa.array(new[name]) if name in new else table.column(name) for name in names})

    return cells.groupBy(*key, "_cell").applyInArrow(run, state.schema)


def swap_cell(src: np.ndarray, dst: np.ndarray, turned: np.ndarray, one: bool, pairings: int, number: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """The edges of a cell after ``pairings`` rounds of swaps, the swaps proposed and those made.

    ``turned``: the edge's first colour is at ``dst``; with ``one`` colour an edge may be taken either way.
    A proposal fails if an edge that it makes is a loop, exists, or is made by another one too.
    """
    random = np.random.default_rng(number)
    names = np.unique(np.concatenate([src, dst]))
    src, dst = np.searchsorted(names, src), np.searchsorted(names, dst)
    a, b = np.where(turned, dst, src), np.where(turned, src, dst)
    number_of = lambda x, y: np.minimum(x, y) * len(names) + np.maximum(x, y)
    done = made = 0
    for _ in range(pairings):
        order = random.permutation(len(a))[:len(a) // 2 * 2].reshape(-1, 2)
        if one:
            flip = random.random(len(a)) < 0.5
            a, b = np.where(flip, b, a), np.where(flip, a, b)
        p, q = order[:, 0], order[:, 1]
        done += len(p)
        fine = (a[p] != a[q]) & (b[p] != b[q]) & (a[p] != b[q]) & (a[q] != b[p])
        p, q = p[fine], q[fine]
        fresh = np.concatenate([number_of(a[p], b[q]), number_of(a[q], b[p])])
        _, at, times = np.unique(np.concatenate([number_of(a, b), fresh]), return_inverse=True, return_counts=True)
        alone = (times[at] == 1)[len(a):].reshape(2, -1).all(0)
        p, q = p[alone], q[alone]
        b[p], b[q] = b[q], b[p]
        made += len(p)
    return names[np.minimum(a, b)], names[np.maximum(a, b)], done, made


def swapped_graphs(edges: DataFrame, by: list[str], reps: int, rounds: int | None = None, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Degree-preserving rewiring of every graph, ``reps`` times.

    Returns the rewired edges (``by``, rep, src, dst) and per graph and replicate the
    accepted share of the proposals.
    """
    by = list(by)
    key = [*by, "rep"]
    spark = edges.sparkSession
    ship(spark)
    size = edges.groupBy(*by).agg(F.count(F.lit(1)).alias("n_edges"))
    largest = size.agg(F.max("n_edges")).first()[0] or 0
    zero = F.lit(0).cast("bigint")
    # numbers in the order of the names, which return at the end
    ids = cut(number_rows(endpoints(edges, by), [*by, "node"], "id"))
    ends = [ids.select(*by, F.col("node").alias(end), F.col("id").alias(f"_{end}")) for end in ("src", "dst")]
    numbered = edges.select(*by, "src", "dst").join(ends[0], [*by, "src"]).join(ends[1], [*by, "dst"]).select(
        *by, F.col("_src").alias("src"), F.col("_dst").alias("dst"))
    state = cut(_replicated(numbered.join(size, by), reps).withColumn("proposed", zero).withColumn("swapped", zero))
    # a graph stops at its own number of rounds
    own = F.greatest(F.lit(1), 2 * F.bround(F.log(F.greatest("n_edges", F.lit(2))), 0))
    total, n = swap_rounds(largest) if rounds is None else rounds, 0
    stops = {total} if rounds is not None else {total} | {swap_rounds(r[0]) for r in size.select("n_edges").groupBy(own.alias("_r")).agg(
        F.max("n_edges").alias("n_edges")).select("n_edges").collect()}  # one row per number of rounds
    while n < total:
        step = min(_PAIRINGS, min(x for x in stops if x > n) - n)
        due = F.lit(n) < own if rounds is None else F.lit(True)
        state, old = cut(_round(state.filter(due), key, n, step, seed).unionByName(state.filter(~due))), state
        release(old)
        n += step
    share = state.groupBy(*key).agg(F.sum("proposed").alias("proposed"), F.sum("swapped").alias("swapped")).withColumn(
        "accepted_share", F.coalesce(F.try_divide("swapped", "proposed"), F.lit(0.0)))
    back = [ids.select(F.col("id").alias(end), F.col("node").alias(f"_{end}")) for end in ("src", "dst")]
    named = state.join(back[0], "src").join(back[1], "dst")
    return named.select(*key, F.col("_src").alias("src"), F.col("_dst").alias("dst")), share


def clustering_significance(nodes: DataFrame, edges: DataFrame, by: list[str], reps: int = 100,
                            rounds: int | None = None, seed: int = 0) -> DataFrame:
    """Per graph: real clustering, share of null replicates above it under both models, and the
    mean and standard error of the accepted swap share."""
    by = list(by)
    key = [*by, "rep"]
    real = average_clustering(nodes, edges, by).withColumnRenamed("clustering", "c_real")
    er = random_graphs(nodes, edges, by, reps, seed)
    size = nodes.groupBy(*by).agg(F.count(F.lit(1)).alias("n_nodes"))
    er_c = _mean_clustering(er, key, size, by).withColumnRenamed("clustering", "c_er")
    sw, share = swapped_graphs(edges, by, reps, rounds, seed)
    sw_c = _mean_clustering(sw, key, size, by).withColumnRenamed("clustering", "c_sw")
    return (
        er_c.join(sw_c, key).join(share, key).join(real, by).groupBy(*by)
        .agg(F.first("c_real").alias("c_real"), F.avg((F.col("c_er") > F.col("c_real")).cast("double")).alias("p_er"),
             F.avg((F.col("c_sw") > F.col("c_real")).cast("double")).alias("p_sw"),
             F.avg("accepted_share").alias("mean_accepted"),
             (F.stddev_pop("accepted_share") / F.sqrt(F.count(F.lit(1)))).alias("se_accepted"),
             F.avg("c_er").alias("mean_c_er"), F.avg("c_sw").alias("mean_c_sw"), F.count(F.lit(1)).alias("reps"))
    )


def _mean_clustering(edges: DataFrame, key: list[str], size: DataFrame, by: list[str]) -> DataFrame:
    """Average clustering over N nodes where nodes without an edge count as zero."""
    from lodestat.operators.graph import local_clustering

    c = local_clustering(endpoints(edges, key), edges, key).groupBy(*key).agg(F.sum("c").alias("_s"))
    return c.join(size, by).select(*key, (F.col("_s") / F.col("n_nodes")).alias("clustering"))
