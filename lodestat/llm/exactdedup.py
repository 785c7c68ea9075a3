"""Exact duplicates by an exchange of Golomb-coded fingerprints.

1. Every Arrow batch of a scan task is a sender.  It sorts its distinct fingerprints and
   sends each owner (a range of the fingerprint space) its share, Rice-coded.
2. An owner decodes what it got and answers every sender with a bitmap: seen elsewhere too?
3. The bitmaps go back to the senders' rows, which stay where they were written: the row
   table is bucketed by sender.  Only suspects, rows with a set bit or a twin in their own
   batch, travel with their text, and are grouped by the bytes themselves.

A text held by a third of all rows is one fingerprint per sender and is counted before the
suspects' shuffle, so no task sees it more than once per input task.

Defined cases: null text is empty; equal rows count one by one, and of rows with the same
key and text exactly one stays; a null key sorts below all keys; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.llm.common import narrow, slices, whole
from lodestat.session import cut

BITS = 48  # kept of each 64-bit hash; a chance clash costs one comparison, never a wrong result


def rice_encode(values: np.ndarray) -> tuple[int, bytes]:
    """Rice parameter and code of sorted distinct ``values``: unary quotients, then remainders."""
    gaps = np.diff(values, prepend=np.uint64(0))
    mean = float(values[-1]) / len(values) if len(values) else 1.0
    k = max(0, int(np.log2(max(1.0, mean * np.log(2)))))
    ends = np.cumsum((gaps >> np.uint64(k)).astype("int64") + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1 if len(ends) else 0, bool)
    unary[ends] = True
    low = (gaps[:, None] >> np.arange(k, dtype="uint64")[::-1]) & np.uint64(1)
    return k, np.packbits(np.concatenate([unary, low.astype(bool).ravel()])).tobytes()


def rice_decode(n: int, k: int, code: bytes) -> np.ndarray:
    """The ``n`` values coded by ``rice_encode``."""
    bits = np.unpackbits(np.frombuffer(code, "uint8"))
    # the n-th set bit ends the unary part; padding and remainders lie behind it
    ends = np.flatnonzero(bits)[:n]
    high = np.diff(ends, prepend=-1) - 1
    start = int(ends[-1]) + 1 if n else 0
    low = bits[start:start + n * k].reshape(n, k).astype("uint64") @ (np.uint64(1) << np.arange(k, dtype="uint64")[::-1])
    return np.cumsum((high.astype("uint64") << np.uint64(k)) + low, dtype="uint64")


def _bit(bitmap: Column, at: Column) -> Column:
    """Whether bit ``at`` of a binary column is set."""
    byte = F.conv(F.hex(F.substring(bitmap, (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.pmod(F.floor(byte / F.pow(F.lit(2), 7 - F.pmod(at, F.lit(8)))), F.lit(2)) == 1


def find_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    spark = docs.sparkSession
    owners = 1 << max(0, (slices(spark) - 1).bit_length())
    shift = BITS - (owners.bit_length() - 1)
    text = whole("text")
    rows = narrow(docs, doc_id=id_col, text=text_col).select(
        "doc_id", text.alias("text"), F.shiftrightunsigned(F.xxhash64(text), 64 - BITS).alias("fp"),
        F.sha2(text, 256).alias("text_sha256"))
    fields = [("sender", pa.int64()), ("place", pa.int64()), ("slot", pa.int64()), ("twin", pa.bool_()), ("doc_id", pa.int64()),
              ("text", pa.string()), ("fp", pa.int64()), ("text_sha256", pa.string()),
              ("owner", pa.int64()), ("n", pa.int64()), ("k", pa.int64()), ("code", pa.binary())]
    schema = pa.schema(fields)

    def send(batches):
        sender = TaskContext.get().partitionId() << 32
        for b in batches:
            if not b.num_rows:
                continue
            b = b.rename_columns(["doc_id", "text", "fp", "text_sha256"])
            own, slot, times = np.unique(b.column(2).to_numpy().astype("uint64"), return_inverse=True, return_counts=True)
            yield _batch(schema, b.num_rows, {
                "sender": np.full(b.num_rows, sender), "place": np.arange(b.num_rows), "slot": slot, "twin": times[slot] > 1,
                "doc_id": b.column(0), "text": b.column(1), "fp": b.column(2), "text_sha256": b.column(3)})
            owner = (own >> np.uint64(shift)).astype("int64")
            names, starts = np.unique(owner, return_index=True)
            parts = np.split(own & np.uint64((1 << shift) - 1), starts[1:])
            codes = [rice_encode(p) for p in parts]
            yield _batch(schema, len(names), {
                "sender": np.full(len(names), sender), "owner": names, "n": [len(p) for p in parts],
                "k": [c[0] for c in codes], "code": [c[1] for c in codes]})
            sender += 1

    table = f"rows_{uuid.uuid4().hex}"
    (rows.mapInArrow(send, "sender long, place long, slot long, twin boolean, doc_id long, text string, fp long, "
                           "text_sha256 string, owner long, n long, k long, code binary")
     .write.format("parquet").option("compression", "zstd").bucketBy(slices(spark), "sender").saveAsTable(table))
    sent = spark.table(table)

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        lists = [rice_decode(int(n), int(k), c) for n, k, c in zip(pdf["n"], pdf["k"], pdf["code"])]
        _, at, times = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
        shared = np.split(times[at] > 1, np.cumsum([len(x) for x in lists])[:-1])
        return pd.DataFrame({"sender": pdf["sender"], "owner": pdf["owner"], "n": pdf["n"],
                             "bits": [np.packbits(s).tobytes() for s in shared]})

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        # owners are ranges, so their answers in order line up with the sender's sorted list
        pdf = pdf.sort_values("owner")
        bits = [np.unpackbits(np.frombuffer(b, "uint8"))[:n] for b, n in zip(pdf["bits"], pdf["n"])]
        return pd.DataFrame({"sender": pdf["sender"].iloc[:1], "bitmap": [np.packbits(np.concatenate(bits)).tobytes()]})

    answers = (sent.filter("owner is not null").select("sender", "owner", "n", "k", "code")
               .groupBy("owner").applyInPandas(answer, "sender long, owner long, n long, bits binary")
               .groupBy("sender").applyInPandas(gather, "sender long, bitmap binary"))
    own = sent.filter("owner is null")
    suspects = (own.join(answers, "sender").filter(F.col("twin") | _bit(F.col("bitmap"), F.col("slot")))
                .select("fp", "text", "text_sha256", "doc_id", "sender", "place"))
    # equal bytes, whatever the hashes say
    groups = suspects.groupBy("fp", "text").agg(
        F.max(F.struct("doc_id", "sender", "place")).alias("best"), F.count(F.lit(1)).alias("group_size"),
        F.first("text_sha256").alias("sha")).filter("group_size > 1").select("sha", "best", "group_size")
    groups = cut(groups)
    out = own.select("doc_id", "sender", "place", "text_sha256").join(groups, F.col("text_sha256") == F.col("sha"), "left")
    alone = F.col("best").isNull()
    out = cut(out.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("best.sender") == F.col("sender")) & (F.col("best.place") == F.col("place"))).alias("kept"),
        "text_sha256"))
    spark.sql(f"drop table {table}")
    return out


def _batch(schema: pa.Schema, n: int, columns: dict) -> pa.RecordBatch:
    """A batch of ``schema``; columns not given are null."""
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns and not isinstance(columns[f.name], pa.Array)
         else columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)
