"""Item streams: per-batch counts, exact histogram, stop after T items.

State lives in a table of per-batch counts, one folder per batch id that a
replay overwrites, so at-least-once delivery changes nothing.  Everything else
(histogram, sketches, reports) is a sum over that table.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestat.session import scratch_path

COUNTS = "batch int, item bigint, n bigint"


def file_items(spark: SparkSession, path: str, schema: T.StructType, item: str, fmt: str = "parquet",
               glob: str | None = None, files_per_batch: int = 1) -> DataFrame:
    """Stream of ``item`` values from files arriving in a folder."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.format(fmt).load(path).select(F.col(item).cast("bigint").alias("item"))


def integers(lines: DataFrame, strict: bool = True) -> DataFrame:
    """``item`` of lines with one integer each; a line that is none stops the stream, or is left out unless ``strict``.

    Empty lines hold no item.
    """
    text = F.trim("value")
    number = text.try_cast("bigint")
    if strict:
        number = F.coalesce(number, F.raise_error(F.concat(F.lit("not an integer: "), text)).cast("bigint"))
    return lines.filter(text != "").select(number.alias("item")).filter("item IS NOT NULL")


def socket_items(spark: SparkSession, host: str, port: int, strict: bool = True) -> DataFrame:
    """Stream of one integer per text line from a socket."""
    lines = spark.readStream.format("socket").option("host", host).option("port", port).load()
    return integers(lines, strict)


class ItemCounter:
    """Runs a stream of items into a table of per-batch counts, optionally until ``stop_after`` items.

    A batch is dropped when the batches before it already reach ``stop_after``;
    otherwise it counts whole, so the final total may exceed it.
    """

    def __init__(self, spark: SparkSession, out: str | None = None, stop_after: int | None = None):
        self.spark = spark
        self.out = out or scratch_path(spark, "item-counts")
        self.stop_after = stop_after
        self.totals: dict[int, int] = self._known_totals()
        self.reached = threading.Event()

    def _known_totals(self) -> dict[int, int]:
        rows = self.table().groupBy("batch").agg(F.sum("n").alias("n")).collect()
        return {r["batch"]: r["n"] for r in rows}

    def table(self) -> DataFrame:
        """The per-batch counts (batch, item, n)."""
        try:
            return self.spark.read.schema(COUNTS).parquet(self.out)
        except Exception as exc:
            if "PATH_NOT_FOUND" in str(exc):
                return self.spark.createDataFrame([], COUNTS)
            raise

    def handle(self, batch: DataFrame, batch_id: int) -> None:
        before = sum(n for b, n in self.totals.items() if b < batch_id)
        if self.stop_after is not None and before >= self.stop_after:
            self.reached.set()
            return
        folder = f"{self.out}/batch={batch_id}"
        batch.groupBy("item").agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(folder)
        n = self.spark.read.parquet(folder).agg(F.sum("n")).first()[0] or 0
        self.totals[batch_id] = n
        if self.stop_after is not None and before + n >= self.stop_after:
            self.reached.set()

    def run(self, stream: DataFrame, checkpoint: str | None = None, available_now: bool = True) -> "ItemCounter":
        writer = stream.writeStream.foreachBatch(self.handle).option(
            "checkpointLocation", checkpoint or scratch_path(self.spark, "stream-state"))
        query = (writer.trigger(availableNow=True) if available_now else writer).start()
        while not query.awaitTermination(0.2):
            if self.reached.is_set():
                query.stop()
                break
        return self

    def histogram(self) -> DataFrame:
        """Exact counts per item over all batches."""
        return self.table().groupBy("item").agg(F.sum("n").alias("n"))

    def summary(self) -> DataFrame:
        """Stream length and number of distinct items."""
        return self.histogram().agg(F.coalesce(F.sum("n"), F.lit(0)).alias("length"), F.count("item").alias("distinct_items"))
