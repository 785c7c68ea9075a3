"""Gaussian kernel densities whose cost grows with points plus places, not with their product.

Values are grouped into cells half a bandwidth wide.  One aggregation keeps, for each cell,
``TERMS`` moments of its values about its middle; a place sums the series of the cells within
``REACH`` bandwidths.  Both errors are relative: below 1e-13 for the series (distances up to
``REACH``, cells of a quarter bandwidth to each side), and what lies beyond the reach is below
exp(-REACH^2 / 2), about 1e-31, of a value at the place itself.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.session import cut, per_group

TERMS = 28
REACH = 12.0
_CELLS = int(REACH * 2)  # cells of half a bandwidth to each side


def kernel_density(points: DataFrame, places: DataFrame, value: str, bandwidths: dict, by: str | None = None, name: str = "density") -> DataFrame:
    """``by, value, density`` at every distinct value of ``places`` for every group of ``bandwidths``.

    ``points``: one row per value, with its group in ``by``.  Places that carry ``by`` are asked in their own group only.  The density is 0 where no point of
    the group lies within the reach.  Null values take no part.
    """
    spark = points.sparkSession
    key = F.col(by) if by else F.lit(0)
    kind = dict(points.dtypes)[by] if by else "int"
    if any(not h > 0 for h in bandwidths.values()):
        raise ValueError("a bandwidth is above 0")
    groups = per_group(spark.createDataFrame([(k, float(h)) for k, h in bandwidths.items()], f"_g {kind}, _h double"))
    # equal values are counted before any exponential
    counted = points.filter(F.col(value).isNotNull()).groupBy(key.alias("_g"), F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    cell = F.floor(F.col("_v") * 2 / F.col("_h"))
    off = F.col("_v") / F.col("_h") - (cell + 0.5) / 2  # from the middle, in bandwidths
    d = counted.join(groups, "_g").withColumn("_cell", cell).withColumn("_d", off)
    # one row per value and power, summed before any shuffle: a column per power would be an
    # expression of hundreds of products, which costs the driver more than the data costs the tasks
    weight = F.col("_n") * F.exp(-F.col("_d") * F.col("_d") / 2)
    powers = F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(TERMS - 1)), lambda j: F.col("_w") * F.pow(F.col("_d"), j.cast("double"))))
    terms = d.select("_g", "_cell", "_d", weight.alias("_w")).select("_g", "_cell", powers.alias("_j", "_x")).groupBy("_g", "_cell", "_j").agg(F.sum("_x").alias("_x"))
    shares = F.array(*[F.lit(1.0 / math.factorial(j)) for j in range(TERMS)])
    # coefficients of the place's offset, highest power first
    series = F.transform(F.sort_array(F.collect_list(F.struct("_j", (F.col("_x") * F.get(shares, F.col("_j"))).alias("_x"))), asc=False), lambda t: t["_x"])
    cells = cut(terms.groupBy("_g", "_cell").agg(series.alias("_m")))
    total = counted.groupBy("_g").agg(F.sum("_n").alias("_total"))
    own = by is not None and by in places.columns
    asked = places.filter(F.col(value).isNotNull()).select(*([F.col(by).alias("_g")] if own else []), F.col(value).cast("double").alias("_v")).distinct()
    sized = per_group(groups.join(total, "_g"))
    pairs = asked.join(sized, "_g") if own else asked.crossJoin(sized)  # one row per group
    near = pairs.withColumn("_cell", F.explode(F.sequence(cell - _CELLS, cell + _CELLS)))
    t = F.col("_v") / F.col("_h") - (F.col("_cell") + 0.5) / 2
    met = near.join(per_group(cells), ["_g", "_cell"]).withColumn("_t", t)
    part = F.exp(-F.col("_t") * F.col("_t") / 2) * F.aggregate("_m", F.lit(0.0), lambda s, m: s * F.col("_t") + m)
    found = met.groupBy("_g", "_v").agg(F.sum(part).alias("_s"))
    out = pairs.join(found, ["_g", "_v"], "left").select(
        "_g", "_v", (F.coalesce("_s", F.lit(0.0)) / (F.col("_total") * F.col("_h") * math.sqrt(2 * math.pi))).alias(name))
    return out.select(*([F.col("_g").alias(by)] if by else []), F.col("_v").alias(value), name)
