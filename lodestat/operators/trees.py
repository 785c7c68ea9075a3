"""Classification trees grown level by level, many at once, and cost-complexity pruning.

Features are cut into bins once: at every distinct value where these are few, at quantiles
otherwise.  A level is one aggregation over (tree, node, feature, bin, class) for all trees
together; the best cut of each node is chosen in Spark, so the driver sees one row per node.
Rows find their node by walking their tree's arrays inside one expression.

A tree is a ``Tree`` of arrays in heap order: node ``i`` has children ``2i + 1`` and ``2i + 2``.
Defined cases: null features take no part in a cut's counts and go left; of equal gains the
first feature and the lowest cut win; a table without rows gives a single leaf.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestat.operators.ordering import lower_quantiles
from lodestat.session import cut, held, release

BINS = 64


@dataclass
class Tree:
    """Cuts and class counts by node number; a node without a cut is a leaf."""

    cuts: dict[int, tuple[int, float]] = field(default_factory=dict)  # node -> (feature, largest value that goes left)
    counts: dict[int, np.ndarray] = field(default_factory=dict)

    def leaves(self) -> list[int]:
        return sorted(i for i in self.counts if i not in self.cuts)

    def share(self, node: int) -> float:
        """Share of the second class in a node."""
        c = self.counts[node]
        return float(c[1] / c.sum()) if c.sum() else 0.0

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Share of the second class for each row."""
        out = np.empty(len(x))
        for k, row in enumerate(x):
            i = 0
            while i in self.cuts:
                f, edge = self.cuts[i]
                i = 2 * i + (2 if row[f] > edge else 1)
            out[k] = self.share(i)
        return out


def edges(df: DataFrame, features: list[str], bins: int = BINS) -> list[list[float]]:
    """Cut values of each feature, ascending; the largest value is none, as nothing lies above it.

    All distinct values if there are at most ``bins``, else ``bins`` exact quantiles: a bounded table.
    """
    seen = df.agg(*[F.approx_count_distinct(f, 0.01).alias(f"d{i}") for i, f in enumerate(features)]).first()
    few = [f for i, f in enumerate(features) if seen[f"d{i}"] <= 1.2 * bins + 8]
    told: dict[str, list[float]] = {}
    if few:
        # a sketch with an error of 1 % found few values, so these sets are small
        row = df.agg(*[F.sort_array(F.collect_set(F.col(f).cast("double"))).alias(f"s{i}") for i, f in enumerate(few)]).first()
        told = {f: list(row[f"s{i}"]) for i, f in enumerate(few) if len(row[f"s{i}"]) <= bins}
    many = [f for f in features if f not in told]
    told |= lower_quantiles(df, many, bins)
    return [told[f][:-1] for f in features]


def binned(df: DataFrame, features: list[str], cuts: list[list[float]]) -> Column:
    """Array of bin numbers: how many cut values of its feature a value exceeds; null stays null."""
    # a literal array of at most BINS values for each feature
    def bin_of(f: str, own: list[float]) -> Column:
        if not own:
            return F.lit(0)
        above = F.filter(F.array(*[F.lit(float(v)) for v in own]), lambda e: e < F.col(f).cast("double"))
        return F.when(F.col(f).isNotNull(), F.size(above))

    return F.array(*[bin_of(f, own).cast("int") for f, own in zip(features, cuts)])


def walked(tree_arrays: str, values: str, depth: int) -> Column:
    """Node of a row: walks ``(feature, edge)`` arrays of its tree, heap order, feature -1 at leaves."""

    def step(node, _):
        f = F.get(F.col(f"{tree_arrays}.feature"), node)
        higher = F.coalesce(F.get(F.col(values), f) > F.get(F.col(f"{tree_arrays}.edge"), node), F.lit(False))
        return F.when(F.coalesce(f, F.lit(-1)) < 0, node).otherwise(node * 2 + F.when(higher, 2).otherwise(1))

    return F.aggregate(F.sequence(F.lit(1), F.lit(max(1, depth))), F.lit(0), step) if depth else F.lit(0)


def arrays(spark, trees: dict, places: dict | None = None) -> DataFrame:
    """``tree, m`` with the arrays of each tree; ``places`` maps cut values to bin numbers, by (feature, value)."""
    rows = []
    for key, t in trees.items():
        size = max(t.cuts, default=-1) + 1
        feature, edge = [-1] * size, [0.0] * size
        for i, (f, v) in t.cuts.items():
            feature[i], edge[i] = f, float(v if places is None else places[f, v])
        rows.append((key, (feature, edge)))
    return held(spark, rows, "tree string, m struct<feature: array<int>, edge: array<double>>")


def grow(df: DataFrame, features: list[str], label: str, depth: int = 5, least: int = 5, bins: int = BINS, by: str | None = None,
         least_gain: float = 1e-12) -> dict[str, Tree]:
    """A tree for each value of ``by`` (one tree named "" without it); ``label`` is 0 or 1.

    Cuts minimise the Gini impurity.  A node is cut if both sides keep ``least`` rows and the
    impurity falls.  One Spark job per level serves all trees.
    """
    spark = df.sparkSession
    cuts = edges(df, features, bins)
    place = {(f, v): b for f, own in enumerate(cuts) for b, v in enumerate(own)}
    key = F.col(by).cast("string") if by else F.lit("")
    rows = cut(df.select(key.alias("tree"), F.col(label).cast("int").alias("y"), binned(df, features, cuts).alias("x")))
    trees = {r["tree"]: Tree() for r in rows.select("tree").distinct().collect()}
    for r in rows.groupBy("tree").agg(F.count_if(F.col("y") == 0).alias("a"), F.count_if(F.col("y") == 1).alias("b")).collect():
        trees[r["tree"]].counts[0] = np.array([r["a"], r["b"]], "int64")
    open_nodes = {k: {0} for k in trees}
    for level in range(depth):
        # rows in nodes that may still be cut
        model = arrays(spark, {k: t for k, t in trees.items() if open_nodes[k]}, place)
        active = held(spark, [(k, i) for k, nodes in open_nodes.items() for i in nodes], "tree string, node int")
        at = rows.join(model, "tree").withColumn("node", walked("m", "x", level)).join(active, ["tree", "node"])
        cells = (at.select("tree", "node", "y", F.posexplode("x").alias("f", "b")).filter("b is not null")
                 .groupBy("tree", "node", "f", "b").agg(F.count_if(F.col("y") == 0).alias("n0"), F.count_if(F.col("y") == 1).alias("n1")))
        own = Window.partitionBy("tree", "node", "f")  # at most ``bins`` + 1 cells
        upto = own.orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
        sums = cells.select("tree", "node", "f", "b", *[F.sum(c).over(w).alias(a) for c, w, a in (
            ("n0", upto, "l0"), ("n1", upto, "l1"), ("n0", own, "t0"), ("n1", own, "t1"))])
        r0, r1 = F.col("t0") - F.col("l0"), F.col("t1") - F.col("l1")

        def gini(a, b):
            return F.try_divide(2.0 * a * b, a + b)

        gain = gini(F.col("t0"), F.col("t1")) - gini(F.col("l0"), F.col("l1")) - gini(r0, r1)
        good = sums.withColumn("gain", gain).filter((F.col("l0") + F.col("l1") >= least) & (r0 + r1 >= least) & (F.col("gain") > least_gain))
        # 12 digits, so that equal gains stay equal whatever the order of sums
        best = good.groupBy("tree", "node").agg(F.max_by(F.struct("f", "b", "l0", "l1", "t0", "t1"), F.struct(F.round("gain", 9), -F.col("f"), -F.col("b"))).alias("s"))
        found = best.select("tree", "node", "s.*").collect()  # a row per open node
        open_nodes = {k: set() for k in trees}
        for r in found:
            t, i, b = trees[r["tree"]], r["node"], r["b"]
            t.cuts[i] = (r["f"], cuts[r["f"]][b])
            left, whole = np.array([r["l0"], r["l1"]], "int64"), t.counts[i]
            t.counts[2 * i + 1], t.counts[2 * i + 2] = whole - np.array([r["t0"] - r["l0"], r["t1"] - r["l1"]]), np.array([r["t0"] - r["l0"], r["t1"] - r["l1"]])
            open_nodes[r["tree"]] |= {j for j in (2 * i + 1, 2 * i + 2) if t.counts[j].min() > 0 and t.counts[j].sum() >= 2 * least}
        if not any(open_nodes.values()):
            break
    release(rows)
    return trees


def pruned(tree: Tree, alpha: float) -> Tree:
    """The smallest subtree that minimises misclassified share + ``alpha`` x leaves (weakest links first)."""
    out = Tree(dict(tree.cuts), dict(tree.counts))
    for a, node in weakest_links(tree):
        if a > alpha + 1e-15:
            break
        _collapse(out, node)
    return out


def _collapse(t: Tree, node: int) -> None:
    stack = [2 * node + 1, 2 * node + 2]
    t.cuts.pop(node, None)
    while stack:
        i = stack.pop()
        if i in t.counts:
            stack += [2 * i + 1, 2 * i + 2]
            t.cuts.pop(i, None)
            del t.counts[i]


def weakest_links(tree: Tree) -> list[tuple[float, int]]:
    """(alpha, node) in the order in which nodes become leaves as alpha grows."""
    t = Tree(dict(tree.cuts), dict(tree.counts))
    total = max(1, int(t.counts[0].sum())) if t.counts else 1
    out, last = [], 0.0
    while t.cuts:
        errors, leaves = {}, {}
        for i in sorted(t.counts, reverse=True):  # children before parents
            if i in t.cuts:
                errors[i], leaves[i] = errors[2 * i + 1] + errors[2 * i + 2], leaves[2 * i + 1] + leaves[2 * i + 2]
            else:
                errors[i], leaves[i] = int(t.counts[i].min()) / total, 1
        a, node = min(((int(t.counts[i].min()) / total - errors[i]) / (leaves[i] - 1), i) for i in t.cuts)
        last = max(last, a)
        out.append((last, node))
        _collapse(t, node)
    return out


def scored(df: DataFrame, features: list[str], trees: dict[str, Tree], by: str | None = None) -> DataFrame:
    """Adds ``node`` and ``score`` (the share of class 1 in the row's leaf); rows without a tree are left out."""
    spark = df.sparkSession
    model = arrays(spark, trees)
    leaves = held(spark, [(k, i, t.share(i)) for k, t in trees.items() for i in t.leaves()], "tree string, node int, score double")
    depth = max((i.bit_length() for t in trees.values() for i in (n + 1 for n in t.cuts)), default=0)
    key = F.col(by).cast("string") if by else F.lit("")
    at = df.withColumn("tree", key).withColumn("_x", F.array(*[F.col(f).cast("double") for f in features])).join(model, "tree")
    out = at.withColumn("node", walked("m", "_x", depth)).join(leaves, ["tree", "node"])
    return out.drop("m", "_x", *([] if by == "tree" else ["tree"]))


def frame(spark, trees: dict[str, Tree], features: list[str]) -> DataFrame:
    """Trees as rows: ``tree, node, feature, edge, n0, n1``; leaves have no feature."""
    rows = [(k, i, features[t.cuts[i][0]] if i in t.cuts else None, float(t.cuts[i][1]) if i in t.cuts else None, int(t.counts[i][0]), int(t.counts[i][1]))
            for k, t in sorted(trees.items()) for i in sorted(t.counts)]
    return spark.createDataFrame(rows, "tree string, node int, feature string, edge double, n0 long, n1 long")
