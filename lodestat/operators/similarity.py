"""Cosine search and its benchmarks.

The search multiplies blocks of vectors inside tasks and keeps only a running
top-n per query, so pairs are scored but never emitted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.functions.vectors import cosine, unit
from lodestat.operators.ordering import average_ranks, top_per_key
from lodestat.session import cut

# Up to this many query vectors travel to the tasks as one matrix; more are blocked on both sides.
QUERY_LIMIT = 4096
VECTOR_BLOCK = 65_536
# Blocks grow with the tables so that a row is copied to at most this many, as long as a block fits a task.
COPIES = 32
_QUERY_ROOM, _VECTOR_ROOM = 16_384, 65_536
# Similarities are rounded before ranking so that ties are decided by id on every machine.
SIM_DIGITS = 9
# Similarities held at a time.
_CELLS = 1 << 21


def _unit_rows(col: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    m = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(col), -1) if len(col) else np.zeros((0, 0))
    n = np.sqrt(np.einsum("ij,ij->i", m, m))
    return m / np.where(n > 0, n, np.inf)[:, None]


def _ids(col: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return col.to_numpy(zero_copy_only=False) if isinstance(col, pa.Array) else col.to_numpy()


class _Best:
    """Running best ``n`` of each query: flat arrays of query number, id and similarity, by query and rank."""

    def __init__(self, qids: np.ndarray, q: np.ndarray, n: int, skip_self: bool):
        self.qids, self.q, self.n, self.skip_self = qids, q, n, skip_self
        self.floor = np.full(len(qids), -np.inf)  # nothing below can be among the best
        self.at, self.ids, self.sims = np.zeros(0, "int64"), None, np.zeros(0)

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Vectors meet the queries in pieces, so that never more than about ``_CELLS`` similarities are held."""
        whole = np.isfinite(vectors).all(1)
        if not whole.all():
            ids, vectors = ids[whole], vectors[whole]
        wide = max(1, min(len(ids), 4096))
        tall = max(1, _CELLS // wide)
        for v in range(0, len(ids), wide):
            found = [self._near(slice(q, q + tall), ids[v:v + wide], vectors[v:v + wide]) for q in range(0, len(self.qids), tall)]
            self._keep(*(np.concatenate(x) for x in zip(*found)))

    def _near(self, rows: slice, ids: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sims = self.q[rows] @ vectors.T
        floor = self.floor[rows]
        # one more than asked, as the query itself may be among them
        reach = self.n + self.skip_self
        if np.isneginf(floor).any() and sims.shape[1] > reach:
            floor = np.maximum(floor, np.partition(sims, -reach, axis=1)[:, -reach])
        # what rounding could lift stays
        at, place = np.nonzero(sims >= (floor - 2 * 10.0**-SIM_DIGITS)[:, None])
        if self.skip_self:
            other = ids[place] != self.qids[rows][at]
            at, place = at[other], place[other]
        return self._first(at + rows.start, ids[place], np.round(sims[at, place], SIM_DIGITS) + 0.0)[:3]

    def _first(self, at: np.ndarray, ids: np.ndarray, sims: np.ndarray) -> tuple[np.ndarray, ...]:
        """The best ``n`` of each query, by query and rank, and which of them are the ``n``-th."""
        order = np.lexsort((ids, -sims, at))
        at, ids, sims = at[order], ids[order], sims[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        best = place < self.n
        return at[best], ids[best], sims[best], place[best] == self.n - 1

    def _keep(self, at: np.ndarray, ids: np.ndarray, sims: np.ndarray) -> None:
        if not len(at):
            return
        if self.ids is not None:
            at, ids, sims = np.concatenate([self.at, at]), np.concatenate([self.ids, ids]), np.concatenate([self.sims, sims])
        self.at, self.ids, self.sims, last = self._first(at, ids, sims)
        self.floor[self.at[last]] = self.sims[last]

    def table(self, kind: pa.DataType) -> pa.RecordBatch:
        ids = self.ids if self.ids is not None else []
        return pa.RecordBatch.from_arrays([pa.array(self.qids[self.at], kind), pa.array(ids, kind), pa.array(self.sims)], names=["qid", "id", "sim"])


def top_similar(vectors: DataFrame, queries: DataFrame, n: int, skip_self: bool = False,
                query_limit: int = QUERY_LIMIT, vector_block: int = VECTOR_BLOCK) -> DataFrame:
    """(qid, id, sim, rank): the ``n`` vectors closest in cosine to each query.

    ``vectors`` holds (id, vec), ``queries`` (qid, qvec); ids of one type.  Exact for any
    number of queries: few travel as one matrix and the vectors are not shuffled, many
    meet the vectors in hashed blocks of bounded size.  The work is queries times vectors; memory is that
    of two blocks.  ``query_limit`` and ``vector_block`` are the sizes of a block as long as no row is
    copied to more than ``COPIES`` blocks.  Null vectors take no part.
    """
    id_type = vectors.schema["id"].dataType.simpleString()
    schema = f"qid {id_type}, id {id_type}, sim double"
    vectors = vectors.select("id", F.col("vec").cast("array<double>").alias("vec")).filter("vec is not null")
    queries = queries.select("qid", F.col("qvec").cast("array<double>").alias("qvec")).filter("qvec is not null")
    few = queries.limit(query_limit + 1).toArrow()
    if few.num_rows <= query_limit:
        if not few.num_rows:
            return vectors.sparkSession.createDataFrame([], schema + ", rank int")
        qids, q = _ids(few.column("qid")), _unit_rows(few.column("qvec"))

        def scan(batches):
            best, kind = _Best(qids, q, n, skip_self), None
            for b in batches:
                kind = b.schema.field(0).type
                best.add(_ids(b.column(0)), _unit_rows(b.column(1)))
            if kind is not None:
                yield best.table(kind)

        partial = vectors.mapInArrow(scan, schema)
    else:
        del few

        def blocks(df: DataFrame, own: int, room: int) -> int:
            rows = df.count()
            size = max(1, own, min(room, -(-rows // COPIES)))
            return max(1, -(-rows // size))

        qb, vb = blocks(queries, query_limit, _QUERY_ROOM), blocks(vectors, vector_block, _VECTOR_ROOM)
        left = queries.select("qid", "qvec", F.pmod(F.xxhash64("qid"), F.lit(qb)).alias("_q"),
                              F.explode(F.sequence(F.lit(0), F.lit(vb - 1))).alias("_v"))
        right = vectors.select("id", "vec", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(qb - 1).cast("bigint"))).alias("_q"),
                               F.pmod(F.xxhash64("id"), F.lit(vb)).cast("int").alias("_v"))

        def block(lhs: pa.Table, rhs: pa.Table) -> pa.Table:
            best = _Best(_ids(lhs.column("qid")), _unit_rows(lhs.column("qvec")), n, skip_self)
            if lhs.num_rows and rhs.num_rows:
                best.add(_ids(rhs.column("id")), _unit_rows(rhs.column("vec")))
            return pa.Table.from_batches([best.table(rhs.schema.field("id").type)])

        partial = left.groupBy("_q", "_v").cogroup(right.groupBy("_q", "_v")).applyInArrow(block, schema)
    return top_per_key(partial, ["qid"], [F.desc("sim"), F.col("id")], n)


def pair_similarity(vectors: DataFrame, pairs: DataFrame) -> DataFrame:
    """Cosine of (a, b) pairs; a pair with an unknown member drops out with its other columns."""
    va = vectors.select(F.col("id").alias("a"), F.col("vec").alias("_va"))
    vb = vectors.select(F.col("id").alias("b"), F.col("vec").alias("_vb"))
    return pairs.join(va, "a").join(vb, "b").withColumn("sim", cosine(F.col("_va"), F.col("_vb"))).drop("_va", "_vb")


def combine_queries(vectors: DataFrame, asked: DataFrame) -> DataFrame:
    """Query vectors from (qid, id, sign) rows: the signed mean of unit vectors.

    Each query has a handful of members.  Columns: qid, qvec, members.
    """
    parts = asked.join(vectors, "id").select("qid", "id", F.posexplode(unit(F.col("vec"))).alias("i", "x"), "sign")
    coords = parts.groupBy("qid", "i").agg(F.avg(F.col("x") * F.col("sign")).alias("x"))
    # one entry per dimension
    vec = coords.groupBy("qid").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("qvec"))
    members = asked.groupBy("qid").agg(F.collect_set("id").alias("members"))
    return vec.join(members, "qid")


def most_similar(vectors: DataFrame, asked: DataFrame, n: int) -> DataFrame:
    """Top ``n`` per query of (qid, id, sign) rows, the query's own members left out."""
    q = cut(combine_queries(vectors, asked))
    # a query's own members can take up as many places as the largest query has members
    most = q.agg(F.max(F.size("members"))).first()[0] or 0
    wide = top_similar(vectors, q, n + most).drop("rank")
    kept = wide.join(q.select("qid", "members"), "qid").filter(~F.array_contains("members", F.col("id"))).drop("members")
    return top_per_key(kept, ["qid"], [F.desc("sim"), F.col("id")], n)


def analogies(vectors: DataFrame, quads: DataFrame) -> DataFrame:
    """(qid, a, b, c, d, predicted, correct) for a : b = c : d questions."""
    asked = quads.select("qid", F.inline(F.array(
        F.struct(F.col("a").alias("id"), F.lit(-1.0).alias("sign")),
        F.struct(F.col("b").alias("id"), F.lit(1.0).alias("sign")),
        F.struct(F.col("c").alias("id"), F.lit(1.0).alias("sign")))))
    best = most_similar(vectors, asked, 1).select("qid", F.col("id").alias("predicted"))
    return quads.join(best, "qid", "left").withColumn("correct", F.coalesce(F.col("predicted") == F.col("d"), F.lit(False)))


def correlation_report(pairs: DataFrame, x: str, y: str) -> DataFrame:
    """n, Pearson and Spearman (average ranks) of two columns."""
    rx, ry = average_ranks(pairs, x, "_rx").drop("n"), average_ranks(pairs, y, "_ry").drop("n")
    ranked = pairs.join(rx, x).join(ry, y)
    return ranked.agg(F.count(F.lit(1)).alias("n"), F.corr(x, y).alias("pearson"), F.corr("_rx", "_ry").alias("spearman"))


def principal_components(vectors: DataFrame, k: int = 3) -> tuple[DataFrame, list[float]]:
    """(id, components) of centred vectors and the explained variance shares."""
    v = vectors.select("id", array_to_vector(F.transform("vec", lambda x: x.cast("double"))).alias("v"))
    mean = v.select(vector_to_array(Summarizer.mean(F.col("v"))).alias("m")).first()["m"]
    centre = F.array(*[F.lit(float(m)) for m in mean])
    centred = vectors.select("id", array_to_vector(F.zip_with("vec", centre, lambda a, b: a.cast("double") - b)).alias("v"))
    model = PCA(k=k, inputCol="v", outputCol="p").fit(centred)
    return model.transform(centred).select("id", vector_to_array("p").alias("components")), [float(x) for x in model.explainedVariance]


def two_hops(vectors: DataFrame, seeds: DataFrame, threshold: float, first: int = 10, second: int = 100,
             keep_back_edges: bool = False) -> DataFrame:
    """(seed, src, dst, sim, hop): neighbours of each seed, then theirs, at or above ``threshold``.

    Second-hop edges that lead back to words already visited for the seed are left out
    unless asked for.
    """
    q1 = seeds.select(F.col("seed").alias("id")).join(vectors, "id").select(F.col("id").alias("qid"), F.col("vec").alias("qvec"))
    hop1 = top_similar(vectors, q1, first, skip_self=True).filter(F.col("sim") >= threshold).select(
        F.col("qid").alias("seed"), F.col("qid").alias("src"), F.col("id").alias("dst"), "sim", F.lit(1).alias("hop"))
    via = hop1.select(F.col("dst").alias("id")).distinct()
    q2 = via.join(vectors, "id").select(F.col("id").alias("qid"), F.col("vec").alias("qvec"))
    far = top_similar(vectors, q2, second, skip_self=True).filter(F.col("sim") >= threshold)
    hop2 = hop1.select("seed", F.col("dst").alias("src")).distinct().join(far.withColumnRenamed("qid", "src"), "src").select(
        "seed", "src", F.col("id").alias("dst"), "sim", F.lit(2).alias("hop"))
    if not keep_back_edges:
        visited = hop1.select("seed", "dst").unionByName(seeds.select("seed", F.col("seed").alias("dst"))).distinct()
        hop2 = hop2.join(visited, ["seed", "dst"], "left_anti")
    return hop1.unionByName(hop2)


def neighbour_drift(first: DataFrame, second: DataFrame, n: int = 50, lowest: int = 10) -> DataFrame:
    """Terms whose top-``n`` neighbours agree least between two models, as (id, common)."""
    def near(v):
        q = v.select(F.col("id").alias("qid"), F.col("vec").alias("qvec"))
        return top_similar(v, q, n, skip_self=True).select("qid", "id")
    both = first.select("id").join(second.select("id"), "id", "left_semi").select(F.col("id").alias("qid"))
    common = near(first).join(near(second), ["qid", "id"]).groupBy("qid").agg(F.count(F.lit(1)).alias("common"))
    return both.join(common, "qid", "left").select(F.col("qid").alias("id"), F.coalesce("common", F.lit(0)).alias("common")).orderBy("common", "id").limit(lowest)


def similarity_to(vectors: DataFrame, word) -> DataFrame:
    """(id, sim) of every other vector to one word's vector; no rows for an unknown word."""
    probe = vectors.filter(F.col("id") == word).select("vec").first()
    if probe is None:
        return vectors.select("id", F.lit(0.0).alias("sim")).limit(0)
    lit = F.array(*[F.lit(float(x)) for x in probe["vec"]])
    return vectors.filter(F.col("id") != word).select("id", cosine(F.col("vec"), lit).alias("sim"))
