"""Hard negatives: rows of another label that score just below an anchor's positives.

Scores are integer inner products of vectors whose components are ``floor(scale * x)``.  An
anchor's positives are its best rows of the same label; a negative of a positive with score
``p`` is a row of another label with a score between ``low * p`` and ``high * p``.

1. Vectors are packed into cells of at most ``CELL`` rows, anchors into cells of ``ANCHORS``.
   Cells of both kinds meet in groups of bounded size, so every pair is scored in a block.
2. First pass: each block keeps an anchor's best rows of the same label; the best of all
   blocks are its positives.  Second pass: with these known, each block keeps the first rows
   inside each positive's window.  No row outside can be among the first of all blocks, so
   what is shuffled does not grow with the square of the table.
3. Secondary sort: pairs are shuffled by anchor and sorted within partitions by
   (anchor, descending score, positives first, id).  A streaming iterator opens a window at
   each positive and emits the negatives that follow; an anchor's rows are never held.

Defined cases: rows with a null id, label or vector, or a null or non-finite component, take
no part; vectors meet vectors of their own length only; a row never pairs with rows of its own
id; repeated rows are rows of their own (a repeated anchor gives its result twice); equal
scores go by smaller id; a negative or missing positive score has no window; an empty table
gives no rows; other columns are ignored.  Scores that do not fit 64 bits raise an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestat.llm.common import narrow
from lodestat.session import cut, release

CELL = 8192  # candidate rows scored at a time
ANCHORS = 2048  # anchors of one cell
TOGETHER = 8  # mean number of candidate cells a task group sees at once
_ROWS = 256  # anchors of one matrix product

_CELLS = "dim long, n long, no binary, id binary, label binary, width int, rows binary, windows binary"
_PAIRS = "no long, anchor_id long, vec_id long, score long"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def usable(vectors: DataFrame, scale: int, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, label, rows`` of the rows that take part, components as whole numbers."""
    v = narrow(vectors, vec_id=id_col, label=label_col, rows=vector_col).withColumn("rows", F.col("rows").cast("array<double>"))
    finite = F.forall("rows", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    v = v.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    return v.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.transform("rows", lambda x: F.floor(x * scale).cast("long")).alias("rows"))


def cells(rows: DataFrame, size: int) -> DataFrame:
    """Rows ``no, vec_id, label, rows, windows`` packed into cells of at most ``size`` of one vector length."""

    def pack(dim, held):
        table = pa.Table.from_batches(held).combine_chunks()
        for at in range(0, table.num_rows, size):
            part = table.slice(at, size)
            part = part.take(pc.sort_indices(part.column("vec_id")))
            n = part.num_rows
            x = part.column("rows").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, dim)
            most = max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0
            width = next(w for w, top in ((2, 2**15), (4, 2**31), (8, 2**64)) if most < top)
            windows = part.column("windows").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            numbers = [part.column(c).to_numpy().astype("<i8").tobytes() for c in ("no", "vec_id", "label")]
            yield pa.RecordBatch.from_pydict({
                "dim": [dim], "n": [n], "no": [numbers[0]], "id": [numbers[1]], "label": [numbers[2]],
                "width": pa.array([width], pa.int32()), "rows": [x.astype(f"<i{width}").tobytes()], "windows": [windows.astype("<i8").tobytes()]})

    def run(batches):
        held: dict[int, list] = {}
        for b in batches:
            length = pc.list_value_length(b.column("rows"))
            for dim in pc.unique(length).to_pylist():
                held.setdefault(dim, []).append(b.filter(pc.equal(length, dim)))
                if sum(x.num_rows for x in held[dim]) >= size:
                    yield from pack(dim, held.pop(dim))
        for dim, parts in held.items():
            yield from pack(dim, parts)

    return rows.select("no", "vec_id", "label", "rows", "windows").mapInArrow(run, _CELLS)


class Cell:
    """A packed cell as arrays."""

    def __init__(self, row: dict):
        self.no, self.id, self.label = (np.frombuffer(row[c], "<i8") for c in ("no", "id", "label"))
        self.rows = np.frombuffer(row["rows"], f"<i{row['width']}").reshape(row["n"], row["dim"])
        self.windows = np.frombuffer(row["windows"], "<i8").reshape(row["n"], -1)
        self.dim = row["dim"]
        self.most = max(abs(int(self.rows.max())), abs(int(self.rows.min()))) if self.rows.size else 0


def products(a: np.ndarray, b: np.ndarray, bound: int) -> np.ndarray:
    """Exact inner products of the rows of both; ``bound`` is the largest they can be."""
    if bound < 2**53:
        return (a.astype("float64") @ b.astype("float64").T).astype("int64")
    if bound < 2**63:
        return a.astype("int64") @ b.astype("int64").T
    raise ValueError("components are too large for 64-bit scores")


def first(score: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Of the places ``at`` (ascending) the ``k`` with the largest score, ties to the first place."""
    if len(at) <= k:
        return at
    own = score[at]
    least = np.partition(own, len(own) - k)[len(own) - k]
    above = at[own > least]
    return np.concatenate([above, at[own == least][:k - len(above)]])


def _scored(pairs: DataFrame, anchors: DataFrame, choose) -> DataFrame:
    """Pairs that ``choose(scores, same label, windows)`` keeps, block by block: ``no, anchor_id, vec_id, score``."""
    many, few = pairs.count(), anchors.count()
    salts, sides = -(-many // TOGETHER), max(1, few)
    left = (pairs.withColumn("salt", F.pmod(F.xxhash64("id", "rows"), F.lit(max(1, salts))))
            .withColumn("side", F.explode(F.sequence(F.lit(0), F.lit(sides - 1)))))
    right = (anchors.withColumn("side", F.pmod(F.xxhash64("no"), F.lit(sides)).cast("int"))
             .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(1, salts) - 1).cast("long")))))

    def score(candidates: pa.Table, asking: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = []
        cells_of = [Cell(r) for r in candidates.to_pylist()]
        for a in map(Cell, asking.to_pylist()):
            for c in cells_of:
                if a.dim != c.dim:
                    continue
                bound = a.dim * a.most * c.most
                for at in range(0, len(a.id), _ROWS):
                    scores = products(a.rows[at:at + _ROWS], c.rows, bound)
                    for i, s in enumerate(scores, at):
                        keep = choose(s, a.label[i] == c.label, a.id[i] != c.id, a.windows[i])
                        if len(keep):
                            out.append([np.full(len(keep), a.no[i]), np.full(len(keep), a.id[i]), c.id[keep], s[keep]])
        columns = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, "int64")] * 4
        return pa.table(dict(zip(("no", "anchor_id", "vec_id", "score"), columns)))

    return left.groupBy("side", "salt").cogroup(right.groupBy("side", "salt")).applyInArrow(score, _PAIRS)


def mine(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, low: tuple[int, int] = (30, 100),
         high: tuple[int, int] = (90, 100), scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding",
         label_col: str = "label") -> DataFrame:
    """Columns ``RESULT``: for each anchor and positive its first ``negatives``, ranked from 1.

    ``anchor``: condition on ``vec_id`` that makes a row an anchor.  ``low`` and ``high`` are
    fractions (numerator, denominator) of the positive's score; ``high`` is at most 1.
    """
    if high[0] > high[1] or low[1] <= 0 or high[1] <= 0:
        raise ValueError("a window ends at the positive's score at most")
    points = usable(vectors, scale, id_col, vector_col, label_col)
    no_windows = F.array().cast("array<long>")
    table = cut(cells(points.withColumn("no", F.lit(0).cast("long")).withColumn("windows", no_windows), CELL))
    asking = cut(points.filter(anchor).withColumn("no", F.monotonically_increasing_id()))
    parts = max(1, -(-asking.count() // ANCHORS))

    def nearest(s, same, other, _):
        return first(s, np.flatnonzero(same & other), positives)

    first_cells = cut(cells(asking.withColumn("windows", no_windows).repartition(parts), ANCHORS))
    ranked = Window.partitionBy("no").orderBy(F.desc("score"), "vec_id")
    best = _scored(table, first_cells, nearest).withColumn("r", F.row_number().over(ranked)).filter(F.col("r") <= positives).drop("r")
    best = cut(best)

    def inside(s, same, other, scores):
        found = [first(s, np.flatnonzero(~same & other & (s >= lo) & (s <= hi)), negatives) for lo, hi in scores.reshape(-1, 2) if lo <= hi]
        return np.unique(np.concatenate(found)) if found else np.zeros(0, "int64")

    # whole-number limits of each window, so that blocks compare without fractions
    times = "cast(score as decimal(20, 0)) * "
    lo, hi = F.expr(f"({times}{low[0]} + {low[1] - 1}) div {low[1]}"), F.expr(f"{times}{high[0]} div {high[1]}")
    shut = F.array(F.lit(1).cast("long"), F.lit(0).cast("long"))
    limits = (best.select("no", F.when(F.col("score") < 0, shut).otherwise(F.array(lo, hi)).alias("w"))
              .groupBy("no").agg(F.collect_list("w").alias("w")))  # at most ``positives`` each
    wide = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(positives - 1)), lambda i: F.coalesce(F.get("w", i), shut)))
    windows = asking.join(limits, "no").withColumn("windows", wide)
    second_cells = cut(cells(windows.repartition(parts), ANCHORS))
    below = _scored(table, second_cells, inside)

    pairs = best.withColumn("kind", F.lit(0)).unionByName(below.withColumn("kind", F.lit(1)))
    ordered = (pairs.select("no", (-F.col("score")).alias("down"), "kind", "vec_id", "anchor_id")
               .repartition("no").sortWithinPartitions("no", "down", "kind", "vec_id"))

    def emit(batches):
        now, opened = None, []
        for b in batches:
            out: list[tuple] = []
            for no, down, kind, vec_id, anchor_id in zip(*(c.to_pylist() for c in b.columns)):
                if no != now:
                    now, opened = no, []
                score = -down
                if not kind:
                    opened.append([vec_id, score, 0])
                    continue
                for w in opened:
                    if w[2] < negatives and low[0] * w[1] <= low[1] * score and high[1] * score <= high[0] * w[1]:
                        w[2] += 1
                        out.append((anchor_id, w[0], w[2], vec_id, w[1], score))
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=[c.split()[0] for c in RESULT.split(", ")])

    result = cut(ordered.mapInArrow(emit, RESULT))
    release(table, asking, first_cells, best, second_cells)
    return result
