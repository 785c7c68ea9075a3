"""Writers; nested columns go to JSON or parquet, flat ones to CSV or text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.functions.vectors import unit


def write_csv(df: DataFrame, path: str) -> None:
    nested = [f.name for f in df.schema if f.dataType.typeName() in ("array", "map", "struct")]
    if nested:
        raise ValueError(f"columns {nested} are nested; write JSON or parquet")
    df.write.mode("overwrite").csv(path, header=True)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_lines(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Text sink for a ``value`` column, optionally one folder per partition value."""
    w = df.write.mode("overwrite")
    (w.partitionBy(partition_by) if partition_by else w).text(path)


def save_vectors(df: DataFrame, path: str, key: list[str], text: str, vector: str) -> None:
    """Vector collection for cosine search: vectors are scaled to length one at write."""
    df.select(*key, text, unit(F.col(vector)).alias("vector")).write.mode("overwrite").parquet(path)


def load_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
