"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.session import shared_dir

# Words as the contracts have them: runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names: ``narrow(df, doc_id="id", text="body")``.

    Other columns, whatever their names, take no part.
    """
    return df.select(*[F.col(f"`{have}`").alias(want) for want, have in columns.items()])


def slices(spark: SparkSession) -> int:
    """Partition count the session asks for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete scratch folders below the shared folder."""
    root = shared_dir(spark).rstrip("/")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        if not path.startswith(root + "/"):
            raise ValueError(f"{path} is not below {root}")
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def whole(col: str | Column) -> Column:
    """A text column with null as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def small(df: DataFrame, rows: int = 20_000) -> DataFrame:
    """Broadcast hint for a table counted and found to have at most ``rows`` rows; any other stays as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
