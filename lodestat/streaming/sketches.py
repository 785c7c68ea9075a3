"""Count-Min and Count-Sketch as tables of cells (j, bucket, c).

``sketch`` reads raw items once: each task keeps one array of depth x width numbers, and the
arrays add up.  Partial sketches merge by sums, and the table is bounded by depth x width
however long the stream is.  ``count_min`` and ``count_sketch`` take (item, n) tables instead.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.operators.frames import with_ties_top
from lodestat.session import held

# The prime modulus and the seed of the hash coefficients.
PRIME = 8191
SEED = 0


def hash_family(depth: int, seed: int = SEED) -> list[tuple[int, int]]:
    """Coefficients (a, b) of ``depth`` linear hashes, a in [1, 8189] and b in [0, 8189]."""
    rng = np.random.RandomState(seed)
    a = rng.randint(1, PRIME - 1, size=depth)
    b = rng.randint(0, PRIME - 1, size=depth)
    return [(int(x), int(y)) for x, y in zip(a, b)]


def hashed(item: Column, ab: tuple[int, int], buckets: int) -> Column:
    # the item is reduced first, so large ids cannot overflow
    reduced = F.pmod(item.cast("bigint"), F.lit(PRIME))
    return F.pmod(F.pmod(reduced * ab[0] + ab[1], F.lit(PRIME)), F.lit(buckets))


def _rows(item: Column, depth: int, width: int, signs: list[tuple[int, int]] | None, seed: int) -> Column:
    cells = []
    for j, ab in enumerate(hash_family(depth, seed)):
        sign = F.lit(1).cast("bigint") if signs is None else hashed(item, signs[j], 2) * 2 - 1
        cells.append(F.struct(F.lit(j).alias("j"), hashed(item, ab, width).alias("bucket"), sign.alias("sign")))
    return F.array(*cells)


def sign_family(depth: int, shared_hash: bool) -> list[tuple[int, int]]:
    """Sign coefficients: independent ones, or the bucket hash's own on request."""
    return hash_family(depth) if shared_hash else hash_family(depth, SEED + 1)


def count_min(counts: DataFrame, depth: int, width: int) -> DataFrame:
    """Count-Min cells of an (item, n) table."""
    return _cells(counts, depth, width, None)


def count_sketch(counts: DataFrame, depth: int, width: int, shared_hash: bool = False) -> DataFrame:
    """Count-Sketch cells of an (item, n) table."""
    return _cells(counts, depth, width, sign_family(depth, shared_hash))


def _cells(counts, depth, width, signs):
    return (
        counts.select("n", F.explode(_rows(F.col("item"), depth, width, signs, SEED)).alias("c"))
        .groupBy("c.j", "c.bucket").agg(F.sum(F.col("n") * F.col("c.sign")).alias("c"))
    )


def _hashes(x: np.ndarray, ab: tuple[int, int], buckets: int) -> np.ndarray:
    return ((x % PRIME) * ab[0] + ab[1]) % PRIME % buckets


def sketch(items: DataFrame, depth: int, width: int, signed: bool = False, shared_hash: bool = False) -> DataFrame:
    """Cells of a table of raw ``item`` rows, in one pass without counts per item; null items take no part."""
    buckets = hash_family(depth)
    signs = sign_family(depth, shared_hash) if signed else None

    def add(batches):
        cells, met = np.zeros((depth, width), "int64"), np.zeros((depth, width), bool)
        for b in batches:
            x = b.column(0).to_numpy(zero_copy_only=False)
            for j, ab in enumerate(buckets):
                at = _hashes(x, ab, width)
                met[j, at] = True
                if signs is None:
                    cells[j] += np.bincount(at, minlength=width)
                else:
                    up = _hashes(x, signs[j], 2) == 1
                    cells[j] += np.bincount(at[up], minlength=width) - np.bincount(at[~up], minlength=width)
        j, bucket = np.nonzero(met)
        yield pa.RecordBatch.from_arrays([pa.array(j, pa.int32()), pa.array(bucket), pa.array(cells[j, bucket])], names=["j", "bucket", "c"])

    raw = items.select(F.col("item").cast("bigint").alias("item")).filter("item is not null")
    return raw.mapInArrow(add, "j int, bucket bigint, c bigint").groupBy("j", "bucket").agg(F.sum("c").alias("c"))


def merge(*sketches: DataFrame) -> DataFrame:
    out = sketches[0]
    for s in sketches[1:]:
        out = out.unionByName(s)
    return out.groupBy("j", "bucket").agg(F.sum("c").alias("c"))


def _looked_up(items, cells, depth, width, signs):
    asked = items.select("item", F.explode(_rows(F.col("item"), depth, width, signs, SEED)).alias("a")).select(
        "item", F.col("a.j").alias("j"), F.col("a.bucket").alias("bucket"), F.col("a.sign").alias("sign"))
    # depth x width cells at most
    small = F.broadcast(cells) if depth * width <= 1_000_000 else cells
    return asked.join(small, ["j", "bucket"], "left").select("item", (F.coalesce("c", F.lit(0)) * F.col("sign")).alias("v"))


def estimate_min(items: DataFrame, cells: DataFrame, depth: int, width: int) -> DataFrame:
    """(item, est): the smallest cell per item."""
    return _looked_up(items, cells, depth, width, None).groupBy("item").agg(F.min("v").cast("double").alias("est"))


def estimate_median(items: DataFrame, cells: DataFrame, depth: int, width: int, shared_hash: bool = False) -> DataFrame:
    """(item, est): the median of the signed cells per item (``depth`` values each)."""
    v = _looked_up(items, cells, depth, width, sign_family(depth, shared_hash))
    s = F.sort_array(F.collect_list("v"))
    lo, hi = s[(depth - 1) // 2], s[depth // 2]
    return v.groupBy("item").agg(((lo + hi) / 2).alias("est"))


def candidates(items: DataFrame, capacity: int = 1024) -> DataFrame:
    """``item, least``: at most ``capacity`` items per task with a lower bound of their count.

    Each task runs a frequency summary over its raw items: beyond ``capacity`` items all counts
    fall by the (capacity + 1)-th largest.  An item with more than rows / (capacity + 1) of a
    task's rows is always kept there.
    """

    def summarise(batches):
        names, counts = np.zeros(0, "int64"), np.zeros(0, "int64")
        for b in batches:
            new, n = np.unique(b.column(0).to_numpy(zero_copy_only=False), return_counts=True)
            both, at = np.unique(np.concatenate([names, new]), return_inverse=True)
            total = np.bincount(at, np.concatenate([counts, n]), len(both)).astype("int64")
            if len(both) > capacity:
                total -= np.partition(total, len(total) - capacity - 1)[len(total) - capacity - 1]
            names, counts = both[total > 0], total[total > 0]
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(counts)], names=["item", "least"])

    raw = items.select(F.col("item").cast("bigint").alias("item")).filter("item is not null")
    return raw.mapInArrow(summarise, "item bigint, least bigint").groupBy("item").agg(F.sum("least").alias("least"))


def frequent(items: DataFrame, k: int, depth: int = 5, width: int = 2048, capacity: int = 1024) -> DataFrame:
    """``item, n``: the ``k`` most frequent items with ties and their exact counts, without a count per item.

    1. One pass gives a Count-Min sketch and a summary of frequent items; the ``k``-th largest
       lower bound of the summary is a floor that the ``k``-th count reaches.
    2. Rows whose sketch estimate lies below the floor are left out, which loses none of the
       top items as an estimate is never below the count; the rest are counted.
    """
    spark = items.sparkSession
    floor = candidates(items, capacity).orderBy(F.desc("least"), "item").limit(k).collect()  # k rows
    least = floor[-1]["least"] if len(floor) == k else 1
    rows = np.zeros((depth, width), "int64")
    for r in sketch(items, depth, width).collect():  # depth x width cells
        rows[r["j"], r["bucket"]] = r["c"]
    cells = held(spark, [(rows.tolist(),)], "cells array<array<bigint>>")
    estimates = [F.get(F.get("cells", F.lit(j)), hashed(F.col("item"), ab, width).cast("int")) for j, ab in enumerate(hash_family(depth))]
    estimate = F.least(*estimates) if depth > 1 else estimates[0]
    likely = items.filter("item is not null").select(F.col("item").cast("bigint").alias("item")).crossJoin(cells).filter(estimate >= least)  # one row
    return with_ties_top(likely.groupBy("item").agg(F.count(F.lit(1)).alias("n")), "n", k)


def heavy_hitters(counts: DataFrame, cells: DataFrame, k: int, depth: int, width: int,
                  kind: str = "min", shared_hash: bool = False) -> DataFrame:
    """(item, n, est) for the top ``k`` items with ties, true next to estimated count.

    ``counts``: an (item, n) table, or raw ``item`` rows, of which only likely ones are counted.
    """
    top = with_ties_top(counts.select("item", "n"), "n", k) if "n" in counts.columns else frequent(counts, k)
    if kind == "min":
        est = estimate_min(top, cells, depth, width)
    else:
        est = estimate_median(top, cells, depth, width, shared_hash)
    return top.join(est, "item")


def relative_error(hitters: DataFrame) -> DataFrame:
    """Average relative error where an estimate at or below zero adds nothing, and the plain one."""
    err = F.abs(F.col("n") - F.col("est")) / F.col("n")
    return hitters.agg(F.avg(F.when(F.col("est") > 0, err).otherwise(0.0)).alias("guarded_error"), F.avg(err).alias("plain_error"))
