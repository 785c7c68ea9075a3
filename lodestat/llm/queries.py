"""Queries of the operators in this folder, over the test tables.

Each applies one operator with production parameters to its whole table and derives the
digest columns from the operator's real output.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.llm import align, exactdedup, hardneg, langid, linededup, mixing, multiindex, neardedup, packing, pii, quality, tokenids, wordtable
from lodestat.session import scratch_path, ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

END_ID = 2


def query(key: str, sql: str | None = None):
    """Register under ``key``; ``sql`` is the DuckDB twin where SQL can say it."""

    def register(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_token_ids")
def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode, write shards and index, then find every document again through the index."""
    docs, path = _table(spark, sf_dir, "documents"), scratch_path(spark, "token-ids")
    tokenids.write(docs, path, _tokenizer("byte_bpe_50k.json"), END_ID)
    return tokenids.documents_of(spark, path, docs)


@query("op7_exact_dedup", sql="""
    with t as (select doc_id, coalesce(text, '') as text from documents),
         g as (select text, max(doc_id) as keep_id, count(*) as group_size from t group by text)
    select t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id as kept, sha256(t.text) as text_sha256
    from t join g on t.text = g.text
""")
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exactdedup.find_copies(_table(spark, sf_dir, "documents"))


@query("op8_mixing")
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of each document so that sources meet targets of weight 1, 2, 3 in turn."""
    mix = mixing.mix(_table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query("op2_quality")
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posterior of good and of toxic for every document; the source is the host, the language the path."""
    return quality.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query("op5_language")
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of the ids."""
    return langid.predict(_table(spark, sf_dir, "documents"))


@query("op9_nearest")
def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest vectors of every vector whose id is divisible by 50."""
    vectors = _table(spark, sf_dir, "embeddings")
    return multiindex.search(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


@query("op3_near_dedup")
def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose shingle sets are at least 85 % alike."""
    return neardedup.groups(_table(spark, sf_dir, "documents"))


@query("op10_packing")
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 ids, neighbours by BM25 side by side."""
    return packing.pack(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), END_ID)


@query("op6_pii")
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base spans and those the span classifier adds."""
    return pii.digest(pii.find(_table(spark, sf_dir, "documents")))


@query("op4_line_dedup")
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, lines cut as repeats, and the hash of what stays."""
    return linededup.report(_table(spark, sf_dir, "documents"))


@query("op11_hard_negatives", sql="""
    with v as (
      select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
             list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as c
      from embeddings
      where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    p as (
      select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same,
             cast(list_sum(list_transform(list_zip(a.c, b.c), lambda z: z[1] * z[2])) as bigint) as s
      from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
    pos as (
      select anchor_id, vec_id, s from p where same
      qualify row_number() over (partition by anchor_id order by s desc, vec_id) <= 5)
    select * from (
      select pos.anchor_id, pos.vec_id as positive_id,
             cast(row_number() over (partition by pos.anchor_id, pos.vec_id order by n.s desc, n.vec_id) as integer) as rank,
             n.vec_id as negative_id, pos.s as positive_score, n.s as negative_score
      from pos join p n on n.anchor_id = pos.anchor_id and not n.same and 30 * pos.s <= 100 * n.s and 100 * n.s <= 90 * pos.s)
    where rank <= 10
""")
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives just below the five best positives of every row whose id is divisible by 100."""
    vectors = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


@query("op13_bpe")
def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the text they decode to, as digests."""
    held = wordtable.round_trip(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))
    return held.select("doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op12_alignment")
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between two tokenizers for every document."""
    docs = _table(spark, sf_dir, "documents")
    return align.align(docs, _tokenizer("byte_bpe_50k.json"), _tokenizer("piece_bpe_32k.model"), with_groups=False).drop("groups")
