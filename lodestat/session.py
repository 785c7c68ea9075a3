"""Session helpers: lineage cuts, shared scratch space and bounded broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Applications whose workers already have the package.
_SHIPPED: set[str] = set()


def local_session(app: str = "lodestat", cpus: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench; a cluster job brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named is None:
        current = sc.getCheckpointDir()
        if current is not None:
            return current
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="lodestat-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` below the shared folder and go on from the written table.

    The table survives lost executors, carries exact sizes for the join planner, and
    unlike a checkpointed plan brings no inherited constraints, which in a loop would
    double with every round.
    """
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.__dict__["_scratch"] = path
    return out


def per_group(df: DataFrame, rows: int = 20_000) -> DataFrame:
    """A table of one row per group, written once; broadcast when it has at most ``rows`` rows.

    A broadcast keeps the large side of a join where it is, so a group that holds a third of
    its rows stays spread over all tasks.  A longer table is joined by shuffle, where adaptive
    execution splits such groups.
    """
    kept = cut(df)
    return F.broadcast(kept) if kept.limit(rows + 1).count() <= rows else kept


def held(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A table of rows that the driver holds, and so no larger than these, to be broadcast."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def release(*tables: DataFrame | None) -> None:
    """Delete the tables that ``cut`` wrote for these frames; nothing may read them any more.

    Loops call it for a round once the next one is written.
    """
    for df in tables:
        path = None if df is None else df.__dict__.pop("_scratch", None)
        if path:
            sc = df.sparkSession.sparkContext
            p = sc._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application.

    Functions that run there refer to it by name, and a worker does not share the
    driver's working folder or path.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    name = os.path.basename(root)
    target = os.path.join(tempfile.mkdtemp(prefix=f"{name}-"), f"{name}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join(name, os.path.relpath(full, root)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)
