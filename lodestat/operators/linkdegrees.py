"""Degrees of the network of neighbouring words, without a row for each link.

Words are numbers, hashes that are counted to be distinct (another hash is taken if not).  A task folds
the links of about ``CHUNK`` words and hands on distinct ones only, packed by bucket of links; a bucket
folds what all tasks sent and counts at each word.  Links are dealt by both ends, so a frequent word
is spread over all buckets, and the partial degrees of a word are added up at the end.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.session import cut, release

CHUNK = 2_000_000
# Longer texts are cut; a piece starts with the last word of the one before, so no link is lost.
PIECE = 2_000
# Texts of a bucket, on average.
TEXTS = 1_000


def _unique(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs in order."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


def _folded(batches, buckets: int, directed: bool, room: int):
    """Rows (bucket, graph, pairs, words): packed distinct links, and rows that only list the distinct words."""
    graphs, words, codes, lengths, held = [], [], [], [], 0

    def chunk():
        word, code = (pa.concat_arrays(x) for x in (words, codes))
        code, length = code.to_numpy(zero_copy_only=False), np.concatenate(lengths)
        ids, first, at = np.unique(code, return_index=True, return_inverse=True)
        graph = pa.chunked_array(graphs).combine_chunks().dictionary_encode(null_encoding="encode")
        own = np.repeat(graph.indices.to_numpy(zero_copy_only=False), length)
        inside = np.ones(len(code), bool)
        inside[np.cumsum(length) - 1] = False  # the last word of a piece
        here = np.flatnonzero(inside)
        a, b, own = at[here], at[here + 1], own[here]
        out = {"bucket": [None], "graph": [None], "pairs": [None], "words": [word.take(pa.array(first))]}
        for k, name in enumerate(graph.dictionary.to_pylist()):
            x, y = a[own == k], b[own == k]
            if not directed:
                x, y = np.minimum(x, y)[x != y], np.maximum(x, y)[x != y]  # numbers follow the order of the hashes
            both = np.unique(x * len(ids) + y)
            x, y = ids[both // len(ids)], ids[both % len(ids)]
            with np.errstate(over="ignore"):
                mixed = (x.view("uint64") * np.uint64(0x9E3779B97F4A7C15)) ^ (y.view("uint64") * np.uint64(0xC2B2AE3D27D4EB4F))
                place = ((mixed ^ (mixed >> np.uint64(29))) % np.uint64(buckets)).astype("int64")
            order = np.argsort(place, kind="stable")
            sent, start = np.unique(place[order], return_index=True)
            for n, rows in zip(sent.tolist(), np.split(order, start[1:])):
                out["bucket"].append(n)
                out["graph"].append(name)
                out["pairs"].append(np.stack([x[rows], y[rows]]).tobytes())
                out["words"].append(None)
        return pa.RecordBatch.from_arrays([pa.array(out["bucket"], pa.int32()), pa.array(out["graph"], graphs[0].type), pa.array(out["pairs"], pa.binary()),
                                           pa.array(out["words"], pa.list_(pa.string()))], names=list(out))

    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            graphs.append(part.column(0))
            words.append(part.column(1).flatten())
            codes.append(part.column(2).flatten())
            lengths.append(part.column(2).value_lengths().to_numpy(zero_copy_only=False))
            held += len(codes[-1])
            if held >= room:
                yield chunk()
                graphs, words, codes, lengths, held = [], [], [], [], 0
    if held:
        yield chunk()


def link_degrees(texts: DataFrame, by: str, words: str, directed: bool, room: int = CHUNK, code=F.xxhash64) -> DataFrame:
    """(by, id, degree): at each word of a graph the number of distinct words that follow it somewhere, or, if
    not ``directed``, of distinct other words beside it; words without any are left out.

    Null texts and texts of one word have no links.  ``id`` stands for the word.
    """
    kind = dict(texts.dtypes)[by]
    n = F.size(words)
    cuts = F.transform(F.sequence(F.lit(0), n - 2, F.lit(PIECE)), lambda at: F.slice(words, at + 1, F.lit(PIECE + 1)))
    pieces = texts.select(F.col(by).alias("graph"), F.explode(F.when(n > PIECE + 1, cuts).when(n > 1, F.array(words))).alias("piece"))
    buckets = max(32, texts.count() // TEXTS)
    for seed in range(8):
        hashed = functools.partial(code, F.lit(seed))
        coded = pieces.select("graph", "piece", F.transform("piece", lambda w: hashed(w)).alias("codes"))  # noqa: B023
        folded = cut(coded.mapInArrow(lambda b: _folded(b, buckets, directed, room), f"bucket int, graph {kind}, pairs binary, words array<string>"))
        seen = folded.filter("words is not null").select(F.explode("words").alias("w")).distinct()
        if seen.groupBy(hashed("w").alias("id")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
            break
        release(folded)
    else:
        raise RuntimeError("words share their numbers under every hash")

    def count(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        sent = [np.frombuffer(p.as_py(), "int64").reshape(2, -1) for p in part.column("pairs")]
        a, b = _unique(*np.concatenate(sent, axis=1))
        ids, times = np.unique(a if directed else np.concatenate([a, b]), return_counts=True)
        return pa.table({"graph": pa.array([key[1].as_py()] * len(ids), part.schema.field("graph").type), "id": ids, "n": times})

    partial = folded.filter("bucket is not null").select("bucket", "graph", "pairs").groupBy("bucket", "graph").applyInArrow(count, f"graph {kind}, id long, n long")
    return partial.groupBy(F.col("graph").alias(by), "id").agg(F.sum("n").alias("degree"))
