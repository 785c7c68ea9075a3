"""Edge-list and adjacency files, and their writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Neighbour lists are cut into parts of about this many entries.
PART_SIZE = 1000


def read_edge_list(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Distinct undirected edges of ``('a', 'b')`` lines, and the count of rejected lines.

    The ``N E`` header line does not count as rejected.
    """
    pattern = r"^\(\s*['\"](.*?)['\"]\s*,\s*['\"](.*?)['\"]\s*\)\s*$"
    lines = spark.read.text(path).filter(~F.col("value").rlike(r"^\d+\s+\d+\s*$"))
    good = F.col("value").rlike(pattern)
    a, b = F.regexp_extract("value", pattern, 1), F.regexp_extract("value", pattern, 2)
    edges = lines.filter(good).select(F.least(a, b).alias("src"), F.greatest(a, b).alias("dst")).distinct()
    rejected = lines.agg(F.count_if(~good).alias("rejected"))
    return edges, rejected


def edge_lines(edges: DataFrame) -> DataFrame:
    return edges.select(F.format_string("('%s', '%s')", F.col("src"), F.col("dst")).alias("value"))


def adjacency(edges: DataFrame, part_size: int = PART_SIZE) -> DataFrame:
    """(node, part, n_parts, neighbours) of an undirected edge table.

    A hub's list is spread over ``ceil(degree / part_size)`` hashed parts, so no
    task gathers the whole list.  Parts of one node have no neighbour in common.
    """
    both = edges.select(F.col("src").alias("node"), F.col("dst").alias("nbr")).unionByName(
        edges.select(F.col("dst").alias("node"), F.col("src").alias("nbr"))).distinct()
    parts = both.groupBy("node").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(part_size)).cast("int").alias("n_parts"))
    return (
        both.join(parts, "node")
        .groupBy("node", "n_parts", F.pmod(F.xxhash64("nbr"), F.col("n_parts")).cast("int").alias("part"))
        .agg(F.sort_array(F.collect_list("nbr")).alias("neighbours"))
        .select("node", "part", "n_parts", "neighbours")
    )


def adjacency_edges(adj: DataFrame) -> DataFrame:
    """Edges back from adjacency rows, each undirected edge once."""
    pair = adj.select("node", F.explode("neighbours").alias("nbr"))
    return pair.select(F.least("node", "nbr").alias("src"), F.greatest("node", "nbr").alias("dst")).distinct()
