"""BPE encoding and decoding by a table of distinct words.

1. Spark splits texts at blanks, tabs and line ends and before marks that follow a letter, where the
   tokenizers meant here join nothing.  Texts are packed into chunks of at most ``CHUNK_WORDS`` words;
   a chunk lists its distinct words once and keeps a text as word numbers, most frequent words first.
   For a tokenizer without regard to case, words that differ in ASCII case are one.
2. The word lists of all chunks are shuffled by word and sorted, so each distinct word of the
   corpus is encoded once, however often it occurs.
3. Ids go back to the chunks by (chunk, word number) and are put in place of the numbers.  The chunks
   lie in a table bucketed by chunk, so only the ids travel.
4. Decoding: the distinct ids of each chunk are joined with the id-to-piece table, and pieces go
   back by (chunk, id) in the same way.

A word occurs once in a chunk's list whatever its frequency, so no word is a hot key.

Defined cases: null text is empty, has no ids and decodes to an empty text; texts of white space
alone too; rows with equal or null keys are documents of their own; strings of special tokens
become these tokens, as in the library's default, unless ``literal``; ids without a piece are left
out of the decoded text; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.llm.common import narrow, slices
from lodestat.llm.packed import by_weight, squeeze, unsqueeze
from lodestat.llm.tokens import batch_encoder, spread
from lodestat.session import cut, scratch_path

CHUNK_WORDS = 1 << 23
SLICE_WORDS = 1 << 20  # words whose ids and texts are put together at a time
# white space, or the place between a letter (ASCII or Latin-1) and a mark
GAPS = r"[ \t\r\n]+|(?<=[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF])(?=[.,;:!?])"

_CHUNKS = "chunk long, keys array<long>, sizes binary, numbers binary, words array<string>"
_OUT = "doc_id long, ids binary, decoded string"


def _folded(words: pa.Array) -> pa.Array:
    """ASCII letters lowered, but for words that may hold a special token's string."""
    return pc.if_else(pc.match_substring(words, "<|"), words, pc.ascii_lower(words))


def chunks(docs: DataFrame, fold: bool, most: int = CHUNK_WORDS) -> DataFrame:
    """``doc_id, text`` as chunks: keys, words per text, word numbers and the distinct words by number."""
    split = docs.select(F.col("doc_id").cast("long"), F.array_remove(F.split(F.col("text"), GAPS), "").alias("words"))

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for b in batches:
            sizes = pc.fill_null(pc.list_value_length(b.column(1)), 0).to_numpy().astype("int64")
            for start, end in by_weight(sizes, most):
                part = b.slice(start, end - start)
                coded = part.column(1).flatten().dictionary_encode()
                names, code = coded.dictionary, coded.indices.to_numpy()
                if fold:
                    again = _folded(names).dictionary_encode()
                    names, code = again.dictionary, again.indices.to_numpy()[code]
                n = len(names)
                order = np.argsort(-np.bincount(code, minlength=n), kind="stable")
                place = np.empty(n, "int64")
                place[order] = np.arange(n)
                yield pa.RecordBatch.from_arrays([
                    pa.array([number]), pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
                    pa.array([squeeze(sizes[start:end])]), pa.array([squeeze(place[code])]),
                    pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), names.take(pa.array(order)).cast(pa.string())),
                ], names=["chunk", "keys", "sizes", "numbers", "words"])
                number += 1

    return split.mapInArrow(run, _CHUNKS)


def encode_words(words: DataFrame, tokenizer: str, literal: bool = False) -> DataFrame:
    """``chunk, no, ids`` of rows ``chunk, no, word``; equal words meet and are encoded once."""
    met = words.repartition("word").sortWithinPartitions("word")

    def run(batches):
        enc = batch_encoder(tokenizer, True, 4, literal)
        last, last_ids = None, b""
        for b in batches:
            if not b.num_rows:
                continue
            word = b.column("word")
            fresh = np.ones(b.num_rows, bool)
            fresh[1:] = pc.not_equal(word.slice(1), word.slice(0, b.num_rows - 1)).to_numpy(zero_copy_only=False)
            names = word.filter(pa.array(fresh)).to_pylist()
            known = [last_ids] if names[0] == last else []
            ids = known + enc.encode_words(names[len(known):])
            last, last_ids = names[-1], ids[-1]
            size = np.fromiter(map(len, ids), "int64", len(ids)) // 4
            flat, run_of = np.frombuffer(b"".join(ids), "<u4").astype("int32"), np.cumsum(fresh) - 1
            own = size[run_of]
            cells = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(own)]), pa.int32()),
                                             pa.array(flat[spread((np.cumsum(size) - size)[run_of], own)]))
            yield pa.RecordBatch.from_arrays([b.column("chunk"), b.column("no"), cells], names=["chunk", "no", "ids"])

    return met.select("chunk", "no", "word").mapInArrow(run, "chunk long, no int, ids array<int>")


def pieces(spark: SparkSession, tokenizer: str) -> DataFrame:
    """The tokenizer's id-to-piece table, ``id, piece``: as long as its vocabulary, special tokens included."""
    held = batch_encoder(tokenizer, True, 4, True).tokenizer
    return spark.createDataFrame([(i, p) for p, i in held.get_vocab(with_added_tokens=True).items()], "id int, piece string")


def _lists(values: pa.Array, sizes: np.ndarray) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int64()), values)


def _bucketed(df: DataFrame, key: str) -> DataFrame:
    """``df`` written below the shared folder in buckets of ``key``, so that groups by it need no shuffle.

    The catalogue knows the table only until it is read here; its files stay, as those of ``cut`` do.
    """
    spark, name = df.sparkSession, f"chunks_{uuid.uuid4().hex}"
    df.write.format("parquet").option("path", scratch_path(spark, "chunks")).bucketBy(slices(spark), key).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"drop table {name}")
    return table


def round_trip(docs: DataFrame, tokenizer: str, literal: bool = False, id_col: str = "doc_id", text_col: str = "text",
               most: int = CHUNK_WORDS) -> DataFrame:
    """``doc_id, ids, decoded`` of every row: ids as little-endian unsigned 32-bit integers, and the text they decode to.

    For tokenizers that drop white space and name no decoder, whose decoded text is the pieces
    with blanks between them.
    """
    enc = batch_encoder(tokenizer, True, 4, literal)
    normalizer = enc.tokenizer.normalizer
    fold = normalizer is not None and normalizer.normalize_str("AZ") == "az"
    packed = _bucketed(chunks(narrow(docs, doc_id=id_col, text=text_col), fold, most), "chunk")
    words = packed.select("chunk", F.posexplode("words").alias("no", "word"))
    ids = cut(encode_words(words, tokenizer, literal))
    used = ids.select("chunk", F.explode("ids").alias("id")).distinct()
    named = used.join(F.broadcast(pieces(docs.sparkSession, tokenizer)), "id")  # a tokenizer's vocabulary
    back = (ids.withColumn("piece", F.lit(None).cast("string"))
            .unionByName(named.select("chunk", F.col("id").alias("no"), F.lit(None).cast("array<int>").alias("ids"), "piece")))

    def put(key, chunk: pa.Table, rows: pa.Table) -> pa.Table:
        if not chunk.num_rows:
            return _EMPTY
        row = chunk.slice(0, 1).to_pylist()[0]
        keys = row["keys"]
        sizes = unsqueeze(row["sizes"], len(keys)).astype("int64")
        code = unsqueeze(row["numbers"], int(sizes.sum()))
        is_word = pc.is_valid(rows.column("ids"))
        cells = rows.filter(is_word).select(["no", "ids"]).sort_by("no").column("ids").combine_chunks()
        if not len(cells):
            cells = pa.array([], pa.list_(pa.int32()))
        named = rows.filter(pc.invert(is_word)).select(["no", "piece"]).sort_by("no").combine_chunks()
        size, flat = pc.list_value_length(cells).to_numpy(zero_copy_only=False).astype("int64"), cells.flatten().to_numpy(zero_copy_only=False)
        edges, start = np.concatenate([[0], np.cumsum(sizes)]), np.cumsum(size) - size
        # text of each word: its pieces with blanks between
        known, piece = named.column("no").to_numpy(), named.column("piece").combine_chunks()
        held = np.isin(flat, known)
        shown = np.diff(np.concatenate([[0], np.cumsum(held)])[np.concatenate([[0], np.cumsum(size)])])
        text = pc.binary_join(_lists(piece.take(pa.array(np.searchsorted(known, flat[held]))), shown), " ").cast(pa.large_string())
        out = []
        for i, j in by_weight(sizes, SLICE_WORDS):
            own, at = code[edges[i]:edges[j]], edges[i:j + 1] - edges[i]
            before = np.concatenate([[0], np.cumsum(size[own])])[at]
            ids = np.ascontiguousarray(flat[spread(start[own], size[own])].astype("<u4"))
            ids_of = pa.LargeBinaryArray.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(before * 4), pa.py_buffer(ids)])
            some = shown[own] > 0
            said = _lists(text.take(pa.array(own[some])), np.diff(np.concatenate([[0], np.cumsum(some)])[at]))
            decoded = pc.binary_join(said, pa.scalar(" ", pa.large_string()))
            out.append(pa.table({"doc_id": pa.array(keys[i:j], pa.int64()), "ids": ids_of.cast(pa.binary()), "decoded": decoded.cast(pa.string())}))
        return pa.concat_tables(out) if out else _EMPTY

    return packed.drop("words").groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(put, _OUT)


_EMPTY = pa.table({"doc_id": pa.array([], pa.int64()), "ids": pa.array([], pa.binary()), "decoded": pa.array([], pa.string())})
