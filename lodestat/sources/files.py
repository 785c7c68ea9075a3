"""Readers for delimited, whitespace and line-based files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestat.operators.ordering import number_rows


def read_points(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Headerless CSV: all fields but the last are coordinates, the last is a group label."""
    parts = F.split("value", ",")
    df = spark.read.text(path).select(
        F.slice(parts, F.lit(1), F.size(parts) - 1).cast("array<double>").alias("features"),
        F.element_at(parts, -1).alias("grp"),
    )
    return df.repartition(partitions) if partitions else df


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
                   null_tokens: tuple[str, ...] = ("",), header: bool = True) -> DataFrame:
    """Delimited file with several null tokens; the header line gives way to ``schema``."""
    raw_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    raw = spark.read.schema(raw_schema).option("enforceSchema", True).csv(path, sep=sep, header=header)
    return raw.select(*[
        F.when(F.col(f.name).isin(*null_tokens), None).otherwise(F.col(f.name)).cast(f.dataType).alias(f.name)
        for f in schema
    ])


def read_whitespace_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Whitespace-separated table with one header line per file.

    The header is the first line of each file; names come from ``schema``, which also keeps
    dots out of column names.  Blank lines are skipped and a row with another number of
    fields than ``schema`` raises.
    """
    # one column per line: the separator cannot occur in text, and the reader drops headers by position
    lines = spark.read.schema("value string").csv(path, sep="\x01", quote="", header=True, enforceSchema=True)
    rows = lines.filter(F.trim("value") != "").select("value", F.split(F.trim("value"), r"\s+").alias("f"))
    wrong = F.raise_error(F.concat(F.lit(f"expected {len(schema)} fields: "), F.col("value")))
    f = F.when(F.size("f") == len(schema), F.col("f")).otherwise(wrong.cast("array<string>"))
    return rows.select(f.alias("f")).select(*[F.col("f")[i].cast(c.dataType).alias(c.name) for i, c in enumerate(schema)])


def as_factor(col: str, levels: list[str]) -> Column:
    """1-based code of a string by explicit level order; unknown strings give null."""
    return F.nullif(F.array_position(F.array(*[F.lit(v) for v in levels]), F.col(col)), F.lit(0)).cast("int")


def read_numbered_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with header whose first column is a row number to drop; ``schema`` names the rest."""
    full = T.StructType([T.StructField("_row", T.LongType()), *schema.fields])
    return spark.read.schema(full).csv(path, header=True).drop("_row")


def read_table(spark: SparkSession, name: str, names: list[str] | None = None) -> DataFrame:
    """Catalog table or view, optionally renamed by position."""
    df = spark.table(name)
    return df.toDF(*names) if names else df


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int,
              partitions: int, names: list[str] | None = None) -> DataFrame:
    """Database table read in parallel ranges of a numeric key, optionally renamed."""
    df = spark.read.jdbc(url, table, column=key, lowerBound=lower, upperBound=upper, numPartitions=partitions)
    return df.toDF(*names) if names else df


def clean_document(col: str) -> Column:
    """Strip, lowercase, delete ASCII punctuation."""
    return F.regexp_replace(F.lower(F.regexp_replace(col, r"^\s+|\s+$", "")), r"\p{Punct}", "")


def read_line_documents(spark: SparkSession, path: str) -> DataFrame:
    """One document per line, cleaned; the id is the line position over the sorted files."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
        clean_document("value").alias("text"),
    )
    return number_rows(lines, ["_file", "_block", "_line"], "doc_id").select("doc_id", "text")


def read_class_dirs(spark: SparkSession, path: str, whole: bool = True) -> DataFrame:
    """Directory-per-class corpus to (text, category); the folder name is the category."""
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return (
        spark.read.option("recursiveFileLookup", True).text(path, wholetext=whole)
        .select(F.col("value").alias("text"), F.regexp_replace(folder, "^[^=]*=", "").alias("category"))
    )


def read_degrees(spark: SparkSession, path: str) -> DataFrame:
    """Degree per line; keeps whole numbers above zero."""
    return (
        spark.read.text(path).filter(F.col("value").rlike("^[0-9]+$"))
        .select(F.col("value").cast("bigint").alias("degree")).filter("degree > 0")
    )


def value_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name))
