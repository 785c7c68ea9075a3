"""Item streams with state in Spark's state store: counts per time window, running histogram, stop after T items.

A batch is a window of event time, so it is the same whatever files, triggers or restarts
bring its rows.  Windows that the watermark has passed leave the state and go to a Parquet
sink exactly once; open ones are read from the checkpoint's state store, and so is the running
histogram.  A query that is killed goes on from its checkpoint.

Rows with a null time or item take no part.  Rows older than the watermark come too late:
Spark leaves them out, and ``late`` says how many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestat.session import scratch_path


def timed_items(spark: SparkSession, path: str, schema: T.StructType, ts: str, item: str, files_per_batch: int = 1) -> DataFrame:
    """Stream ``ts, item`` of Parquet files arriving in a folder, oldest first."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return rows.select(F.col(ts).cast("timestamp").alias("ts"), F.col(item).cast("bigint").alias("item")).filter("ts is not null and item is not null")


def arriving(df: DataFrame, ts: str, pieces: int, path: str | None = None) -> tuple[str, str]:
    """Folder in which the rows of ``df`` lie as ``pieces`` writes that arrive in the order of ``ts``, and the
    delay that takes in the disorder of the files of one write."""
    path = path or scratch_path(df.sparkSession, "arriving")
    first, last = df.agg(F.min(ts), F.max(ts)).first()
    if first is None:
        df.write.mode("append").parquet(path)
        return path, "0 seconds"
    step = (last - first) / pieces
    for i in range(pieces):
        # one write after the other, so that files carry their order; each is as parallel as its rows
        rows = (F.col(ts) >= F.lit(first + step * i)) & ((F.col(ts) < F.lit(first + step * (i + 1))) if i + 1 < pieces else F.lit(True))
        df.filter(rows).write.mode("append").parquet(path)
    return path, f"{int(step.total_seconds()) + 1} seconds"


class _Stateful:
    """A streaming query with its folder: checkpoint, state and progress."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark, self.folder, self.late = spark, folder or scratch_path(spark, "stream"), 0

    @property
    def checkpoint(self) -> str:
        return f"{self.folder}/checkpoint"

    def _state(self) -> DataFrame | None:
        """Rows of the state store as of the last finished micro-batch; none before the first."""
        try:
            return self.spark.read.format("statestore").load(self.checkpoint)
        except Exception as exc:
            if any(s in str(exc) for s in ("STDS_", "does not exist", "doesn't exist", "no committed batch")):
                return None
            raise

    def _follow(self, query, done, available_now: bool, most: int | None) -> None:
        """Waits for the query's end; stops it once ``done()`` holds after a micro-batch, or after ``most`` of them."""
        seen = -1
        while not query.awaitTermination(0.2):
            last = query.lastProgress
            if last is not None and last["batchId"] != seen:
                seen = last["batchId"]
                if done() or (most is not None and seen + 1 >= most):
                    query.stop()
                    break
        for p in query.recentProgress:
            self.late += sum(s.get("numRowsDroppedByWatermark", 0) for s in p["stateOperators"])


class RunningHistogram(_Stateful):
    """Exact count of every item; the state store holds one row per item."""

    def run(self, stream: DataFrame, available_now: bool = True, most_batches: int | None = None) -> "RunningHistogram":
        counts = stream.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
        writer = counts.writeStream.outputMode("update").format("noop").option("checkpointLocation", self.checkpoint)
        self._follow((writer.trigger(availableNow=True) if available_now else writer).start(), lambda: False, available_now, most_batches)
        return self

    def histogram(self) -> DataFrame:
        """``item, n`` over all rows of finished micro-batches."""
        state = self._state()
        if state is None:
            return self.spark.createDataFrame([], "item bigint, n bigint")
        return state.select(F.col("key.item").alias("item"), F.col("value.count").alias("n"))

    def summary(self) -> DataFrame:
        return _summary(self.histogram())


class WindowedCounts(_Stateful):
    """Counts per (window, item); optionally the stream ends once closed windows hold ``stop_after`` items.

    A window is dropped when the windows before it already reach ``stop_after``; otherwise it
    counts whole, so the total may exceed it.
    """

    SCHEMA = "start timestamp, item bigint, n bigint"

    def __init__(self, spark: SparkSession, every: str = "1 day", delay: str = "0 seconds", stop_after: int | None = None, folder: str | None = None):
        super().__init__(spark, folder)
        self.every, self.delay, self.stop_after = every, delay, stop_after

    def run(self, stream: DataFrame, available_now: bool = True, most_batches: int | None = None) -> "WindowedCounts":
        counts = (stream.withWatermark("ts", self.delay).groupBy(F.window("ts", self.every).alias("window"), "item")
                  .agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), "item", "n"))
        writer = (counts.writeStream.outputMode("append").format("parquet").option("path", f"{self.folder}/closed")
                  .option("checkpointLocation", self.checkpoint))
        query = (writer.trigger(availableNow=True) if available_now else writer).start()
        self._follow(query, self._reached, available_now, most_batches)
        return self

    def closed(self) -> DataFrame:
        """Counts of windows that are complete."""
        try:
            return self.spark.read.schema(self.SCHEMA).parquet(f"{self.folder}/closed")
        except Exception as exc:
            if "PATH_NOT_FOUND" in str(exc):
                return self.spark.createDataFrame([], self.SCHEMA)
            raise

    def _reached(self) -> bool:
        return self.stop_after is not None and (self.closed().agg(F.sum("n")).first()[0] or 0) >= self.stop_after

    def table(self) -> DataFrame:
        """``start, item, n`` of all windows, complete or open."""
        state, closed = self._state(), self.closed()
        if state is None:
            return closed
        # a query killed between sink and commit has windows in both; the sink's are complete
        still = state.select(F.col("key.window.start").alias("start"), F.col("key.item").alias("item"), F.col("value.count").alias("n"))
        return closed.unionByName(still.join(F.broadcast(closed.select("start").distinct()), "start", "left_anti"))  # a row per window

    def kept(self) -> DataFrame:
        """``start, item, n`` of the windows that are not dropped."""
        if self.stop_after is None:
            return self.table()
        before = Window.partitionBy(F.lit(0)).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)  # one row per window
        totals = self.table().groupBy("start").agg(F.sum("n").alias("n"))
        good = totals.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).filter(F.col("before") < self.stop_after)
        return self.table().join(good.select("start"), "start", "left_semi")

    def histogram(self) -> DataFrame:
        return self.kept().groupBy("item").agg(F.sum("n").alias("n"))

    def summary(self) -> DataFrame:
        return _summary(self.histogram())


def _summary(histogram: DataFrame) -> DataFrame:
    return histogram.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("length"), F.count("item").alias("distinct_items"))
