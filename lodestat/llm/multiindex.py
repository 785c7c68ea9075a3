"""Nearest neighbours by cosine with an inverted multi-index.

Unit vectors are cut into two halves, each quantised by its own ``CENTRES`` centroids, so a
pair of centroids is a cell.  A query walks over cells by summed distance with a heap and
stops once the cells hold a share ``reach`` of all vectors; their entries are scored exactly.
``reach`` is learned: the least share at which the queries of a bounded sample find
``RECALL`` of their exact neighbours in the sample.  Neighbours in the full table are nearer
than in a sample, so the share is on the safe side.

Entries are dealt by first centroid and cut into blocks of about ``BLOCK`` rows; a query goes
once to each block it visits and each block returns its best ``k``.  A cell that holds a
third of all vectors is many blocks.

Defined cases: null vectors, zero vectors, vectors with null or non-finite components or of
another length than the first sampled one take no part; a query's own id is no neighbour of
it; a query id that occurs in several rows asks with its smallest vector; equal scores rank
by id, and equal ids count as rows; fewer candidates give fewer rows; an empty table gives
none; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestat.llm.common import narrow
from lodestat.session import cut

CENTRES = 32  # centroids of each half
SAMPLE = 8192  # vectors the index is fitted on
PROBES = 256  # sample queries that set the reach
RECALL = 0.97
BLOCK = 8192
_ROUNDS = 12


def usable(rows: DataFrame) -> DataFrame:
    """``vec_id`` and the vector as 64-bit floats in bytes; unusable vectors are left out."""

    def pack(batches):
        for b in batches:
            ids, out = [], []
            for key, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if v is None or key is None or any(x is None for x in v):
                    continue
                x = np.array(v, "float64")
                if len(x) and np.isfinite(x).all() and x.any():
                    ids.append(key)
                    out.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], names=["vec_id", "v"])

    return rows.mapInArrow(pack, "vec_id long, v binary")


def _matrix(col) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(x) for x in col), "float64").reshape(len(col), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    # scaling first keeps squares of huge and tiny components finite
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, summed in the same order whatever the batch."""
    return (a * b).sum(1)


def _gaps(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1), 0)


def _centres(x: np.ndarray, k: int) -> np.ndarray:
    c = x[np.random.default_rng(0).choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(_ROUNDS):
        near = _gaps(x, c).argmin(1)
        n = np.bincount(near, minlength=len(c))
        sums = np.stack([np.bincount(near, x[:, j], len(c)) for j in range(x.shape[1])], 1)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


def walk(d1: np.ndarray, d2: np.ndarray, counts: np.ndarray, enough: float) -> list[tuple[int, int]]:
    """Cells in order of ``d1[i] + d2[j]`` until they hold ``enough`` entries."""
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    heap, out, held = [(d1[o1[0]] + d2[o2[0]], 0, 0)], [], 0
    while heap and held < enough:
        _, a, b = heapq.heappop(heap)
        i, j = int(o1[a]), int(o2[b])
        if counts[i, j]:
            out.append((i, j))
            held += counts[i, j]
        # (a, b) opens (a, b + 1); only the first column opens the next row, so each cell enters once
        if b + 1 < len(o2):
            heapq.heappush(heap, (d1[o1[a]] + d2[o2[b + 1]], a, b + 1))
        if b == 0 and a + 1 < len(o1):
            heapq.heappush(heap, (d1[o1[a + 1]] + d2[o2[0]], a + 1, 0))
    return out


class Index:
    """Centroids of both halves and the learned reach."""

    def __init__(self, sample: np.ndarray, k: int):
        x = _unit(sample)
        self.width, self.half = x.shape[1], max(1, x.shape[1] // 2)
        self.first, self.second = _centres(x[:, :self.half], CENTRES), _centres(x[:, self.half:], CENTRES)
        d1, d2 = _gaps(x[:, :self.half], self.first), _gaps(x[:, self.half:], self.second)
        counts = np.zeros((len(self.first), len(self.second)), "int64")
        np.add.at(counts, (d1.argmin(1), d2.argmin(1)), 1)
        need = []
        for q in range(0, len(x), max(1, len(x) // PROBES)):
            s = x @ x[q]
            s[q] = -2
            best = np.argsort(-s)[:k]
            order = walk(d1[q], d2[q], counts, np.inf)
            before = dict(zip(order, np.cumsum([counts[c] for c in order])))
            need += [before[int(d1[b].argmin()), int(d2[b].argmin())] / len(x) for b in best if b != q]
        self.reach = float(np.quantile(need, RECALL)) if need else 1.0

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _gaps(x[:, :self.half], self.first), _gaps(x[:, self.half:], self.second)


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for each row of ``queries``."""
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    rows = cut(usable(narrow(vectors, vec_id=id_col, v=vec_col)))
    asked = cut(usable(narrow(queries, vec_id=id_col, v=vec_col)).groupBy("vec_id").agg(F.min("v").alias("v")))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(SAMPLE).collect()  # bounded rows
    if not sample:
        return spark.createDataFrame([], schema)
    size = len(sample[0]["v"])
    index = Index(_matrix([r["v"] for r in sample if len(r["v"]) == size]), k)
    shared = spark.sparkContext.broadcast(index)  # 2 x CENTRES centroids

    def place(batches):
        ix = shared.value
        for b in batches:
            keep = [i for i, v in enumerate(b.column(1)) if len(v.as_py()) == size]
            b = b.take(pa.array(keep, pa.int64()))
            if b.num_rows:
                d1, d2 = ix.cells(_unit(_matrix(b.column(1).to_pylist())))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(d1.argmin(1), pa.int32()), pa.array(d2.argmin(1), pa.int32())],
                                                 names=["vec_id", "v", "i", "j"])

    placed = cut(rows.mapInArrow(place, "vec_id long, v binary, i int, j int"))
    cells = placed.groupBy("i", "j").count().collect()  # at most CENTRES x CENTRES rows
    counts = np.zeros((len(index.first), len(index.second)), "int64")
    for r in cells:
        counts[r["i"], r["j"]] = r["count"]
    blocks = np.maximum(1, -(-counts.sum(1) // BLOCK))
    total, n_asked = int(counts.sum()), asked.count()
    query_blocks = max(1, -(-n_asked // BLOCK))
    plan = spark.sparkContext.broadcast((counts, blocks))

    def visit(batches):
        ix, (counts, blocks) = shared.value, plan.value
        for b in batches:
            b = b.take(pa.array([i for i, v in enumerate(b.column(1)) if len(v.as_py()) == size], pa.int64()))
            if not b.num_rows:
                continue
            d1, d2 = ix.cells(_unit(_matrix(b.column(1).to_pylist())))
            out = []
            for q, (key, v) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                seen: dict[int, list[int]] = {}
                # one more than asked, so that the query's own row does not use up the share
                for i, j in walk(d1[q], d2[q], counts, ix.reach * total + 1):
                    seen.setdefault(i, []).append(j)
                out += [(key, v, i, s, js) for i, js in seen.items() for s in range(blocks[i])]
            yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], t) for c, t in enumerate(
                (pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.list_(pa.int32())))], names=["query_id", "q", "i", "s", "js"])

    split = F.create_map(*[F.lit(int(x)) for i, n in enumerate(blocks) for x in (i, n)])
    entries = (placed.withColumn("s", F.pmod(F.xxhash64("vec_id", "v"), split[F.col("i")]).cast("int"))
               .withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))))
    visits = (asked.repartition(F.col("vec_id")).mapInArrow(visit, "query_id long, q binary, i int, s int, js array<int>")
              .withColumn("g", F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)).cast("int")))

    def rank(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        got = []
        if len(left) and len(right):
            ids, x, cell = left["vec_id"].to_numpy(), _unit(_matrix(left["v"])), left["j"].to_numpy()
            q = _unit(_matrix(right["q"]))
            rough = q @ x.T
            for n, (key, js) in enumerate(zip(right["query_id"], right["js"])):
                at = np.flatnonzero(np.isin(cell, js) & (ids != key))
                if len(at) > k:
                    edge = np.partition(rough[n, at], len(at) - k)[len(at) - k]
                    at = at[rough[n, at] >= edge - 1e-9]
                exact = cosines(x[at], q[n][None, :])
                best = np.lexsort((ids[at], -exact))[:k]
                got.append(pd.DataFrame({"query_id": key, "vec_id": ids[at[best]], "score": exact[best]}))
        return pd.concat(got) if got else pd.DataFrame({"query_id": pd.Series([], dtype="int64"), "vec_id": pd.Series([], dtype="int64"), "score": pd.Series([], dtype="float64")})

    keys = ["i", "s", "g"]
    found = (entries.groupBy(*keys).cogroup(visits.groupBy(*keys))
             .applyInPandas(rank, "query_id long, vec_id long, score double"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int"), "vec_id", "score"))
