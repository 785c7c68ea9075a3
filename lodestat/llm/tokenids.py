"""Token ids as raw binary shards, with a minimal perfect hash index over document keys.

Layout below one folder, all written by Spark's committers (a lost task leaves nothing):

``shards``  one row per shard of about ``SHARD_IDS`` ids: ``part``, ``seq`` (its place),
            ``n_docs``, ``n_ids``, ``lengths`` (uint32 ids per document, in order) and
            ``payload`` (the ids themselves, little-endian, ``width`` bytes each).
``index``   one row per bucket of keys: ``bucket``, ``n``, ``seeds`` (int32 per group of
            keys), and per slot ``prints`` (uint32 fingerprint), ``part``, ``seq``,
            ``offset`` (ids before the document in its shard), ``length``, ``copies``.

A key costs one bucket row, one seed and one slot, whatever the size of the corpus.

Defined cases: null text is empty and holds the end id alone; rows with a null key are
stored first, not indexed, and come back with a null key; rows with the same key lie next
to each other and the index keeps the first place and their number; an empty table gives
empty folders; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestat.llm.common import narrow, slices
from lodestat.llm.tokens import batch_encoder, parts, with_end

SHARD_IDS = 1 << 20  # a shard is closed once it holds this many ids; one long document may exceed it
BUCKET_KEYS = 256  # mean number of keys of an index bucket
GROUP_KEYS = 4  # mean number of keys that share one seed

_INDEX = ("bucket long, n long, seeds binary, prints binary, part binary, seq binary, offset binary, "
          "length binary, copies binary")


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, drops_space: bool = False, width: int = 2,
          id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode all texts, append ``end_id`` to each and write shards and index below ``path``.

    Documents are range-partitioned and sorted by key, so shards read in (part, seq) order
    hold them in ascending key order.  ``width`` 2 suits vocabularies of up to 65 536 ids.
    """
    spark = docs.sparkSession
    if end_id >= 1 << (8 * width):
        raise ValueError("end_id does not fit the width")
    ordered = (narrow(docs, doc_id=id_col, text=text_col)
               .repartitionByRange(slices(spark), "doc_id").sortWithinPartitions("doc_id"))
    def shards(batches):
        part, seq = TaskContext.get().partitionId(), 0
        enc = batch_encoder(tokenizer, drops_space, width)
        keys, lengths, payload, size = [], [], [], 0

        def close():
            return pa.RecordBatch.from_pydict({
                "part": [part], "seq": [seq], "keys": [keys], "n_docs": [len(lengths)], "n_ids": [size],
                "lengths": [np.array(lengths, "<u4").tobytes()], "payload": [b"".join(payload)],
            }, schema=schema)

        for batch in (b.slice(i, j - i) for b in batches for i, j in parts(b.column(1))):
            ids, before = with_end(*enc.encode(batch.column(1)), end_id)
            for key, a, b in zip(batch.column(0).to_pylist(), before.tolist(), before[1:].tolist()):
                keys.append(key)
                lengths.append(b - a)
                payload.append(ids[a:b].tobytes())
                size += lengths[-1]
                if size >= SHARD_IDS:
                    yield close()
                    seq, keys, lengths, payload, size = seq + 1, [], [], [], 0
        if lengths:
            yield close()

    schema = pa.schema([("part", pa.int64()), ("seq", pa.int64()), ("keys", pa.list_(pa.int64())), ("n_docs", pa.int64()),
                        ("n_ids", pa.int64()), ("lengths", pa.binary()), ("payload", pa.binary())])
    (ordered.mapInArrow(shards, "part long, seq long, keys array<long>, n_docs long, n_ids long, lengths binary, payload binary")
     .write.option("compression", "zstd").parquet(f"{path}/shards"))
    _write_index(spark, path)


def _places(spark: SparkSession, path: str) -> DataFrame:
    """Key and place of every document, from the shards' own headers."""

    def spread(batches):
        for b in batches:
            for part, seq, keys, lengths in zip(*[b.column(i) for i in range(4)]):
                n = np.frombuffer(lengths.as_py(), "<u4").astype("int64")
                yield pa.RecordBatch.from_arrays([
                    keys.values, pa.array(np.full(len(n), part.as_py())), pa.array(np.full(len(n), seq.as_py())),
                    pa.array(np.cumsum(n) - n), pa.array(n)], names=["doc_id", "part", "seq", "offset", "length"])

    return (spark.read.parquet(f"{path}/shards").select("part", "seq", "keys", "lengths")
            .mapInArrow(spread, "doc_id long, part long, seq long, offset long, length long"))


def _write_index(spark: SparkSession, path: str) -> None:
    n = spark.read.parquet(f"{path}/shards").agg(F.sum("n_docs")).first()[0] or 0
    buckets = max(1, -(-n // BUCKET_KEYS))
    first = F.min(F.struct("part", "seq", "offset", "length")).alias("p")
    keyed = (_places(spark, path).filter("doc_id is not null").groupBy("doc_id").agg(first, F.count(F.lit(1)).alias("copies"))
             .select("doc_id", "p.*", "copies").withColumn("bucket", _bucket(F.col("doc_id"), buckets)))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = pdf["doc_id"].to_numpy("int64")
        seeds, slot = perfect_hash(keys)
        order = np.empty(len(keys), "int64")
        order[slot] = np.arange(len(keys))
        cols = {c: pdf[c].to_numpy("int64")[order].astype("<i8").tobytes() for c in ("part", "seq", "offset", "length", "copies")}
        return pd.DataFrame([{"bucket": pdf["bucket"].iloc[0], "n": len(keys), "seeds": seeds.astype("<i4").tobytes(),
                              "prints": fingerprint(keys[order]).tobytes(), **cols}])

    (keyed.groupBy("bucket").applyInPandas(build, _INDEX)
     .write.option("compression", "zstd").parquet(f"{path}/index"))


def _bucket(key, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("long")


def _mix(keys: np.ndarray, seed) -> np.ndarray:
    """64-bit finaliser over key and seed; numpy wraps around."""
    with np.errstate(over="ignore"):
        x = keys.astype("uint64") + (np.asarray(seed).astype("uint64") + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, 2**32) >> np.uint64(32)).astype("<u4")


def perfect_hash(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seeds and slots: distinct ``keys`` of n go to slots 0..n-1 without a clash.

    Keys are hashed into groups; groups, largest first, try seeds until all their keys
    fall on free slots.  A group keeps only its seed.
    """
    n = len(keys)
    groups = max(1, -(-n // GROUP_KEYS))
    group = (_mix(keys, 0) % np.uint64(groups)).astype("int64")
    order = np.argsort(group, kind="stable")
    starts = np.searchsorted(group[order], np.arange(groups + 1))
    seeds, slots, taken = np.zeros(groups, "int32"), np.empty(n, "int64"), np.zeros(n, bool)
    for g in np.argsort(-(starts[1:] - starts[:-1]), kind="stable"):
        own = order[starts[g]:starts[g + 1]]
        if not len(own):
            break
        seed = 1
        while True:
            tries = np.arange(seed, seed + 64)
            at = (_mix(keys[own][None, :], tries[:, None]) % np.uint64(n)).astype("int64")
            good = ~taken[at].any(1)
            if len(own) > 1:
                s = np.sort(at, 1)
                good &= (s[:, 1:] != s[:, :-1]).all(1)
            if good.any():
                k = int(good.argmax())
                seeds[g], slots[own] = tries[k], at[k]
                taken[at[k]] = True
                break
            seed += 64
    return seeds, slots


def slot_of(keys: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    """Slots of ``keys`` in constant time each; a key that is not in the index gets some slot."""
    group = (_mix(keys, 0) % np.uint64(len(seeds))).astype("int64")
    return (_mix(keys, seeds[group].astype("int64")) % np.uint64(n)).astype("int64")


def lookup(spark: SparkSession, path: str, keys: DataFrame, key_col: str = "doc_id") -> DataFrame:
    """Place of each key found: ``doc_id, part, seq, offset, length, copies``.

    The keys travel to their bucket (8 bytes each) and ask its perfect hash; a slot whose
    fingerprint differs is a key that is not there.  A stranger passes with chance 2^-32.
    """
    index = spark.read.parquet(f"{path}/index")
    buckets = index.agg(F.max("bucket")).first()[0]
    schema = "doc_id long, part long, seq long, offset long, length long, copies long"
    n = spark.read.parquet(f"{path}/shards").agg(F.sum("n_docs")).first()[0] or 0
    if buckets is None:
        return spark.createDataFrame([], schema)
    asked = (narrow(keys, doc_id=key_col).filter("doc_id is not null").distinct()
             .withColumn("bucket", _bucket(F.col("doc_id"), max(1, -(-n // BUCKET_KEYS)))))
    names = [f.split()[0] for f in schema.split(", ")]

    def probe(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({c: pd.Series([], dtype="int64") for c in names})
        keys, row = left["doc_id"].to_numpy("int64"), right.iloc[0]
        slot = slot_of(keys, np.frombuffer(row["seeds"], "<i4"), int(row["n"]))
        found = np.frombuffer(row["prints"], "<u4")[slot] == fingerprint(keys)
        out = {c: np.frombuffer(row[c], "<i8")[slot[found]] for c in names[1:]}
        return pd.DataFrame({"doc_id": keys[found], **out})

    return asked.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInPandas(probe, schema)


def digests(spark: SparkSession, path: str, width: int = 2) -> DataFrame:
    """One row per stored document, read from the payloads: place, ``start`` (ids before it in
    all shards), ``n_tokens`` and the crc32 of its ids as little-endian 32-bit integers."""
    shards = spark.read.parquet(f"{path}/shards")
    # a slice's total first, so the running sum over all shards sees one row per slice and per shard of it
    sizes = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per slice
    base = sizes.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    begins = shards.select("part", "seq", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("before"))
    begins = begins.join(base, "part").select("part", "seq", (F.col("base") + F.col("before")).alias("begin"))

    def sums(batches):
        for b in batches:
            for part, seq, lengths, payload in zip(*[b.column(i) for i in range(4)]):
                n = np.frombuffer(lengths.as_py(), "<u4").astype("int64")
                ids = np.frombuffer(payload.as_py(), f"<u{width}").astype("<u4")
                at = np.cumsum(n) - n
                crc = [zlib.crc32(ids[a:a + k].tobytes()) for a, k in zip(at, n)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(n), part.as_py())), pa.array(np.full(len(n), seq.as_py())),
                    pa.array(at), pa.array(n), pa.array(crc, pa.int64())], names=["part", "seq", "offset", "n_tokens", "ids_crc32"])

    rows = shards.select("part", "seq", "lengths", "payload").mapInArrow(
        sums, "part long, seq long, offset long, n_tokens long, ids_crc32 long")
    return rows.join(begins, ["part", "seq"]).select(
        "part", "seq", "offset", (F.col("begin") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def documents_of(spark: SparkSession, path: str, keys: DataFrame, key_col: str = "doc_id", width: int = 2) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every row of ``keys``, found through the index.

    Repeated keys are the rows that follow the first place; null keys are the stored rows
    that no key of the index reaches.
    """
    rows = digests(spark, path, width)
    found = lookup(spark, path, keys, key_col)
    copies = Window.partitionBy("part").orderBy("seq", "offset").rowsBetween(Window.unboundedPreceding, 0)
    joined = rows.join(found.select("doc_id", "part", "seq", "offset", "copies"), ["part", "seq", "offset"], "left")
    # a repeated key names its first row only; the rows behind it take over its name
    named = joined.withColumn("doc_id", F.last("doc_id", ignorenulls=True).over(copies))
    return named.select("doc_id", "start", "n_tokens", "ids_crc32")
