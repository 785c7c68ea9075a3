"""Global order without a one-task window.

A window with no partition key pulls every row into one task.  These helpers
range-partition instead: each task sees a slice of the order, and only one
number per slice travels between slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestat.session import cut, per_group

# monotonically_increasing_id keeps the row position in the low 33 bits.
_SLICE_BITS = 33


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols or [])


def _sliced(df: DataFrame, order: list) -> DataFrame:
    ordered = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id())
    return cut(ordered).withColumn("_slice", F.shiftright("_mid", _SLICE_BITS))


def number_rows(df: DataFrame, order: list, name: str = "rn", start: int = 0) -> DataFrame:
    """Number all rows along a total order, from ``start``."""
    sliced = _sliced(df, order)
    sizes = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    pos = F.col("_mid").bitwiseAND((1 << _SLICE_BITS) - 1)
    # one row per slice, so the broadcast side is bounded by the partition count
    return (
        sliced.join(F.broadcast(offsets), "_slice")
        .withColumn(name, pos + F.col("_off") + F.lit(start))
        .drop("_mid", "_slice", "_off")
    )


def running_total(df: DataFrame, value: str, order, by=(), name: str = "cum") -> DataFrame:
    """Inclusive running sum of ``value`` along ``order`` inside each ``by`` group.

    A hot group is spread over many slices, so no group has to fit one task.
    """
    by = _names(by)
    sliced = _sliced(df, [*by, *([order] if isinstance(order, (str, Column)) else order)])
    keys = [*by, "_slice"]
    part = sliced.groupBy(*keys).agg(F.sum(value).alias("_tot"))
    ahead = (
        Window.partitionBy(*(by or [F.lit(0)])).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = part.select(*keys, F.coalesce(F.sum("_tot").over(ahead), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(*keys).orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0)
    return (
        sliced.withColumn("_in", F.sum(value).over(inside))
        .join(offsets.withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)}),
              on=_null_safe(keys), how="inner")
        .withColumn(name, F.col("_in") + F.col("_off"))
        .drop("_mid", "_slice", "_off", "_in", *[f"_k{i}" for i in range(len(keys))])
    )


def _null_safe(keys: list[str]) -> Column:
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return cond


def exact_quantiles(df: DataFrame, col: str, probs: dict[str, float], by=()) -> DataFrame:
    """Exact quantiles with linear interpolation (type 7), one row per group.

    Equal values are counted before the shuffle, then located by running count:
    no group's values are ever held together.  ``probs`` maps output name to
    probability.  Result: ``by`` columns, ``n`` and one column per name.
    """
    by = _names(by)
    counts = (
        df.filter(F.col(col).isNotNull())
        .groupBy(*by, F.col(col).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    counts = cut(counts)
    cum = running_total(counts, "_n", "_v", by, "_cum")
    totals = per_group(counts.groupBy(*by).agg(F.sum("_n").alias("n")))
    if by:
        cum = cum.join(totals.withColumnsRenamed({b: f"_g_{b}" for b in by}),
                       on=_all_equal(by), how="inner").drop(*[f"_g_{b}" for b in by])
    else:
        cum = cum.withColumn("n", totals.select("n").scalar())
    picks = []
    for name, p in probs.items():
        pos = F.lit(float(p)) * (F.col("n") - 1)
        picks.append(F.min(F.when(F.col("_cum") > F.floor(pos), F.col("_v"))).alias(f"_lo_{name}"))
        picks.append(F.min(F.when(F.col("_cum") > F.ceil(pos), F.col("_v"))).alias(f"_hi_{name}"))
    picked = cum.groupBy(*by).agg(F.max("n").alias("n"), *picks)
    out = []
    for name, p in probs.items():
        pos = F.lit(float(p)) * (F.col("n") - 1)
        frac = pos - F.floor(pos)
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        out.append((lo + (hi - lo) * frac).alias(name))
    return picked.select(*by, "n", *out)


def lower_quantiles(df: DataFrame, cols: list[str], parts: int) -> dict[str, list[float]]:
    """For each column the distinct values at rows ceil(n * i / parts), i = 1 ... parts, of its ascending order.

    All columns share one sort of their distinct values with counts.  Nulls take no part.
    """
    if not cols:
        return {}
    values = F.inline(F.array(*[F.struct(F.lit(i).alias("_c"), F.col(c).cast("double").alias("_v")) for i, c in enumerate(cols)]))
    counts = df.select(values).filter(F.col("_v").isNotNull()).groupBy("_c", "_v").agg(F.count(F.lit(1)).alias("_n"))
    cum = running_total(counts, "_n", "_v", ["_c"], "_cum")
    totals = per_group(cum.groupBy("_c").agg(F.sum("_n").alias("_total")))
    # rows _cum - _n + 1 to _cum hold the value: it is asked for if a multiple of n / parts ends there
    asked = F.floor(F.col("_cum") * parts / F.col("_total")) > F.floor((F.col("_cum") - F.col("_n")) * parts / F.col("_total"))
    found: dict[str, list[float]] = {c: [] for c in cols}
    for r in cum.join(totals, "_c").filter(asked).select("_c", "_v").collect():  # at most ``parts`` a column
        found[cols[r["_c"]]].append(r["_v"])
    return {c: sorted(v) for c, v in found.items()}


def _all_equal(by: list[str]) -> Column:
    cond = F.lit(True)
    for b in by:
        cond = cond & F.col(b).eqNullSafe(F.col(f"_g_{b}"))
    return cond


def average_ranks(df: DataFrame, col: str, name: str) -> DataFrame:
    """Distinct values of ``col`` with their count ``n`` and average rank ``name`` (from 1)."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    cum = running_total(counts, "n", col, (), "_cum")
    return cum.select(col, "n", (F.col("_cum") - F.col("n") + (F.col("n") + 1) / 2).alias(name))


def top_per_key(df: DataFrame, key: list[str], order: list, k: int, name: str = "rank") -> DataFrame:
    """First ``k`` rows per key; Spark trims each map task to ``k`` rows before the shuffle."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)


def first_per_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """First row per key by ``order``, as a combinable minimum instead of a window."""
    rest = [c for c in df.columns if c not in key]
    packed = F.struct(*order, *[c for c in rest if c not in order])
    best = df.groupBy(*key).agg(F.min(packed).alias("_b"))
    return best.select(*[F.col(c) if c in key else F.col(f"_b.{c}").alias(c) for c in df.columns])
