"""Lexical retrieval packing: neighbours by BM25 fill the window of each seed document.

1. Texts are encoded once.  A document's terms are its token ids, so the vocabulary is the
   tokenizer's and document frequencies are one bounded table, counted over all documents.
2. Documents are ordered by the id of their rarest frequent terms and range-partitioned in
   that order, so documents about the same things meet.  A partition is cut into index
   shards of at most ``SHARD_DOCS`` documents; a crowd of like documents is many shards.
3. In a shard, the unused document with the smallest key seeds a window; the shard's
   inverted index returns unused neighbours by BM25 score, which fill the window in turn.
   The last one is cut at the window's end and its rest seeds the next window.

A partition carries its last open window from shard to shard; what is left at its end is cut
into sequences whose lengths are powers of two, which need no padding.

Defined cases: null text is empty and holds the end id alone; rows with equal or null keys
are documents of their own; equal scores go by order in the shard; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.llm.common import narrow, slices
from lodestat.llm.tokens import batch_encoder, parts, with_end
from lodestat.session import scratch_path

WINDOW = 4096
SHARD_DOCS = 256
K1, B = 1.2, 0.75
ROUTE_DF = 16  # terms of fewer documents bring no neighbours together
_TYPE = "<u2"  # ids of vocabularies up to 65 536
_TIMES = "<u4"

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def encode(docs: DataFrame, path: str, tokenizer: str, end_id: int, drops_space: bool) -> None:
    """Write ``doc_id, ids, terms, times`` per document, and ``term, df`` per task, below ``path``."""

    def run(batches):
        enc, df = batch_encoder(tokenizer, drops_space, 2), np.zeros(1 << 16, "int64")
        for b in (b.slice(i, j - i) for b in batches for i, j in parts(b.column(1))):
            ids, before = with_end(*enc.encode(b.column(1)), end_id)
            first, terms, times = count_terms(ids, before)
            df += np.bincount(terms, minlength=1 << 16)
            cells = {"ids": (ids, before), "terms": (terms, first), "times": (times, first)}
            yield _rows(schema, b.num_rows, {"kind": ["doc"] * b.num_rows, "doc_id": b.column(0).cast(pa.int64()),
                                             **{c: _binary(v, at) for c, (v, at) in cells.items()}})
        used = np.flatnonzero(df)
        yield _rows(schema, len(used), {"kind": ["term"] * len(used), "term": used, "df": df[used]})

    schema = pa.schema([("kind", pa.string()), ("doc_id", pa.int64()), ("ids", pa.binary()), ("terms", pa.binary()),
                        ("times", pa.binary()), ("term", pa.int64()), ("df", pa.int64())])
    (docs.mapInArrow(run, "kind string, doc_id long, ids binary, terms binary, times binary, term long, df long")
     .write.option("compression", "zstd").partitionBy("kind").parquet(path))


def count_terms(ids: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each text's terms begin, its distinct ids in order, and how often it holds each; one sort for all texts."""
    n = len(before) - 1
    kind = "uint32" if n <= 1 << 16 else "uint64"  # the shorter one sorts twice as fast
    pairs = np.repeat(np.arange(n, dtype=kind) << np.array(16, kind), np.diff(before)) | ids.astype(kind)
    pairs.sort()
    at = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.zeros(0, "int64")
    pairs, times = pairs[at], np.diff(at, append=len(ids))
    first = np.searchsorted(pairs >> np.array(16, kind), np.arange(n + 1))
    return first, (pairs & np.array(0xFFFF, kind)).astype(_TYPE), times.astype(_TIMES)


def _binary(values: np.ndarray, before: np.ndarray) -> pa.Array:
    """Binary column of the runs ``before[i] .. before[i + 1]`` of ``values``."""
    raw = pa.py_buffer(np.ascontiguousarray(values))
    return pa.BinaryArray.from_buffers(pa.binary(), len(before) - 1, [None, pa.py_buffer((before * values.itemsize).astype("<i4")), raw])


def _rows(schema: pa.Schema, n: int, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns and not isinstance(columns[f.name], pa.Array)
                                       else columns.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)


class Shard:
    """Inverted index of a bounded number of documents, with corpus-wide weights."""

    def __init__(self, terms: list[np.ndarray], times: list[np.ndarray], lengths: np.ndarray, idf: np.ndarray, mean: float):
        doc = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
        term, tf = np.concatenate(terms).astype("int64"), np.concatenate(times).astype("float64")
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[doc] / mean))
        order = np.argsort(term, kind="stable")
        self.doc, self.weight, term = doc[order], weight[order], term[order]
        names, self.first = np.unique(term, return_index=True)
        self.size = np.diff(self.first, append=len(term))
        self.place = np.full(len(idf), -1)
        self.place[names] = np.arange(len(names))
        self.n = len(terms)

    def scores(self, terms: np.ndarray) -> np.ndarray:
        """BM25 score of every document of the shard for a set of terms."""
        at = self.place[terms]
        at = at[at >= 0]
        size = self.size[at]
        # positions of all postings of the terms, list after list
        ends = np.cumsum(size)
        pos = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.first[at] - (ends - size), size)
        return np.bincount(self.doc[pos], self.weight[pos], self.n)


def pack(docs: DataFrame, tokenizer: str, end_id: int, drops_space: bool = True, window: int = WINDOW,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``sequences`` puts the ids themselves together.
    """
    return _packed(docs, tokenizer, end_id, drops_space, window, id_col, text_col, False).drop("ids")


def sequences(docs: DataFrame, tokenizer: str, end_id: int, drops_space: bool = True, window: int = WINDOW,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``sequence_id, ids``: each sequence's ids, pieces in order."""
    pieces = _packed(docs, tokenizer, end_id, drops_space, window, id_col, text_col, True)
    # a sequence has at most ``window`` ids
    return pieces.groupBy("sequence_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids"))


def _packed(docs: DataFrame, tokenizer: str, end_id: int, drops_space: bool, window: int, id_col: str, text_col: str,
            with_ids: bool) -> DataFrame:
    spark = docs.sparkSession
    path = scratch_path(spark, "packing")
    encode(narrow(docs, doc_id=id_col, text=text_col), path, tokenizer, end_id, drops_space)
    table = spark.read.schema("doc_id long, ids binary, terms binary, times binary, term long, df long, kind string").parquet(path)
    df = np.zeros(1 << 16)
    for r in table.filter("kind = 'term'").groupBy("term").agg(F.sum("df").alias("df")).collect():  # at most 65 536 rows
        df[r["term"]] = r["df"]
    rows = table.filter("kind = 'doc'")
    n, ids = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("ids"))).first()
    if not n:
        return spark.createDataFrame([], _PIECES + ", ids array<int>")
    idf = np.log(1 + (n - df + 0.5) / (df + 0.5))  # above 0 for every df, so every term counts
    shared = spark.sparkContext.broadcast((idf, df, ids / 2 / n))  # two tables of 65 536 numbers

    def route(batches):
        idf, df, _ = shared.value
        for b in batches:
            keys = []
            for t in b.column(2):
                t = np.frombuffer(t.as_py(), _TYPE)
                t = t[df[t] >= ROUTE_DF]
                best = t[np.argsort(-idf[t], kind="stable")[:3]] if len(t) else np.empty(0, "int64")
                keys.append(sum(int(x) << s for x, s in zip(np.sort(best)[::-1], (32, 16, 0))))
            yield b.append_column("route", pa.array(keys, pa.int64()))

    routed = rows.select("doc_id", "ids", "terms", "times").mapInArrow(route, "doc_id long, ids binary, terms binary, times binary, route long")
    # equal routes are told apart by the id, so that a crowd spreads over partitions
    ordered = routed.repartitionByRange(slices(spark), "route", "doc_id").sortWithinPartitions("route", "doc_id")

    def fill(batches):
        writer = _Writer(TaskContext.get().partitionId() << 40, window, with_ids)
        idf, _, mean = shared.value
        held: list[tuple] = []
        for b in batches:
            for row in zip(*[b.column(i).to_pylist() for i in range(4)]):
                held.append(row)
                if len(held) == SHARD_DOCS:
                    _fill(held, writer, idf, mean, window)
                    held = []
                    yield from writer.take()
        if held:
            _fill(held, writer, idf, mean, window)
        writer.close()
        yield from writer.take()

    return ordered.select("doc_id", "ids", "terms", "times").mapInArrow(fill, _PIECES + ", ids array<int>")


class _Writer:
    """Puts documents one after the other into sequences and gathers their pieces."""

    def __init__(self, first: int, window: int, with_ids: bool):
        self.next, self.window, self.with_ids, self.open, self.used, self.out = first, window, with_ids, [], 0, []

    def room(self) -> int:
        return self.window - self.used

    def add(self, key, ids: np.ndarray) -> None:
        start = 0
        while start < len(ids):
            n = min(self.room(), len(ids) - start)
            self.open.append((key, start, ids[start:start + n], len(ids)))
            self.used += n
            start += n
            if not self.room():
                self._emit(self.open)
                self.open, self.used = [], 0

    def _emit(self, pieces: list) -> None:
        offset = 0
        for key, start, ids, total in pieces:
            self.out.append((key, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, self.next, offset, ids if self.with_ids else None))
            offset += len(ids)
        self.next += 1

    def close(self) -> None:
        """Cut the open window into lengths that are powers of two, longest first."""
        while self.used:
            size, now, rest, left = 1 << (self.used.bit_length() - 1), [], [], 1 << (self.used.bit_length() - 1)
            for key, start, ids, total in self.open:
                if left:
                    now.append((key, start, ids[:left], total))
                if len(ids) > left:
                    rest.append((key, start + left, ids[left:], total))
                left -= min(left, len(ids))
            self._emit(now)
            self.open, self.used = rest, self.used - size

    def take(self):
        if self.out:
            types = [pa.int64()] * 7 + [pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in self.out], t) for i, t in enumerate(types)],
                                             names=[*(c.split()[0] for c in _PIECES.split(", ")), "ids"])
            self.out = []


def _fill(held: list[tuple], writer: _Writer, idf: np.ndarray, mean: float, window: int) -> None:
    """Pack one shard's documents."""
    order = sorted(range(len(held)), key=lambda i: (held[i][0] is None, held[i][0] or 0))
    ids = [np.frombuffer(held[i][1], _TYPE) for i in order]
    terms = [np.frombuffer(held[i][2], _TYPE).astype("int64") for i in order]
    times = [np.frombuffer(held[i][3], _TIMES) for i in order]
    lengths = np.array([len(x) for x in ids], "float64")
    index, unused, seed = Shard(terms, times, lengths, idf, mean), np.ones(len(held), bool), -1
    while unused.any():
        if seed < 0:
            seed = int(unused.argmax())
            unused[seed] = False
            writer.add(held[order[seed]][0], ids[seed])
        score = index.scores(terms[seed])
        score[~unused] = -1
        # only as many neighbours as can be needed: all that start in this window
        for near in np.argsort(-score, kind="stable")[:int(unused.sum())]:
            before = writer.next
            unused[near] = False
            writer.add(held[order[near]][0], ids[near])
            if writer.next != before:
                # the window closed in this document; what is left of it leads on
                seed = int(near) if writer.used else -1
                break
        else:
            break
