"""Word-level text operators: bags, lemmas, n-gram models, chunks, prompts."""

from __future__ import annotations

import pandas as pd
from pyspark.ml.feature import StopWordsRemover, Word2Vec
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestat.session import cut

# A word of two or more letters, digits or underscores.
TERM = r"([\p{L}\p{N}_]{2,})"


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(1))


def tokens(text: Column) -> Column:
    """Whitespace tokens without empty ones."""
    return F.filter(F.split(text, r"\s+"), lambda x: x != "")


def ngrams(words: Column, n: int) -> Column:
    """Word n-grams in order, stride one; empty when there are fewer than ``n`` words.

    Shifted copies are zipped, so ``words`` is evaluated ``n`` times and not once per gram.
    """
    count = F.greatest(F.size(words) - F.lit(n - 1), F.lit(0))
    shifted = [F.slice(words, F.lit(i + 1), count).alias(f"w{i}") for i in range(n)]
    return F.transform(F.arrays_zip(*shifted), lambda z: F.concat_ws(" ", *[z[f"w{i}"] for i in range(n)]))


# --- bags of words ------------------------------------------------------------------------

def bag_of_words(docs: DataFrame, key: str, text: str, tokenizer=terms) -> DataFrame:
    """(key, term, n) with any column-to-array tokenizer."""
    return docs.select(key, F.explode(tokenizer(F.col(text))).alias("term")).groupBy(key, "term").agg(F.count(F.lit(1)).alias("n"))


def vocabulary(bag: DataFrame) -> DataFrame:
    """Terms with document and total frequency."""
    return bag.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("n").alias("tf"))


def with_vocabulary(bag: DataFrame, vocab: DataFrame) -> DataFrame:
    """The bag of unseen documents over a fitted vocabulary: unknown terms fall away."""
    return bag.join(vocab.select("term"), "term", "left_semi")


def pandas_tokenizer(fn):
    """Wraps a text-to-list function as a tokenizer for :func:`bag_of_words`."""
    @F.pandas_udf("array<string>")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: list(fn(x)) if x is not None else [])
    return run


def default_stop_words(language: str = "english") -> list[str]:
    return StopWordsRemover.loadDefaultStopWords(language)


def without_stop_words(words: Column, stop: list[str]) -> Column:
    return F.array_except(words, F.array()) if not stop else F.filter(words, lambda w: ~w.isin(*stop))


def lemmatise(word_rows: DataFrame, lemmas: DataFrame, word: str) -> DataFrame:
    """Replaces ``word`` by its lemma from a (form, lemma) table, itself when unknown."""
    known = lemmas.select(F.col("form").alias(word), F.col("lemma").alias("_l"))
    return word_rows.join(known, word, "left").withColumn(word, F.coalesce("_l", word)).drop("_l")


def train_vectors(docs: DataFrame, words: str, size: int = 300, window: int = 5, min_count: int = 5,
                  max_iter: int = 1, seed: int = 1, partitions: int = 1):
    """Skip-gram word vectors of an array column; returns the fitted model."""
    return Word2Vec(vectorSize=size, windowSize=window, minCount=min_count, maxIter=max_iter, seed=seed,
                    numPartitions=partitions, inputCol=words, outputCol="_v").fit(docs)


# --- bigram model and the typo rule -----------------------------------------------------------

def bigram_model(docs: DataFrame, words: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Counts of bigrams (w1, w2, c2), words (w, c1) and one row (total, vocab).

    The texts are read once: each word comes with the next one, the last of a text with null, so the
    words are counted from the pairs, and the size from the words.
    """
    nexts = F.arrays_zip(F.col(words).alias("w1"), F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))).alias("w2"))
    counts = cut(docs.select(F.explode(nexts).alias("e")).groupBy("e.w1", "e.w2").agg(F.count(F.lit(1)).alias("c2")))
    c2 = counts.filter("w2 is not null")
    c1 = cut(counts.groupBy(F.col("w1").alias("w")).agg(F.sum("c2").alias("c1")))
    size = c1.agg(F.sum("c1").alias("total"), F.count(F.lit(1)).alias("vocab"))
    return c2, c1, size


def token_log_probs(sentences: DataFrame, key: list[str], words: str, model, k: float = 1.0) -> DataFrame:
    """(key, pos, token, logp): add-k bigram log probability of each token given the one before;
    the first token has its own add-k share."""
    c2, c1, size = model
    total, vocab = size.select("total").scalar(), size.select("vocab").scalar()
    seq = sentences.select(*key, F.posexplode(F.arrays_zip(
        F.col(words).alias("token"), F.concat(F.array(F.lit(None).cast("string")), F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0)))).alias("before"))).alias("pos", "e")
    ).select(*key, "pos", "e.token", "e.before").filter("token IS NOT NULL")
    # each pair of words is scored once, so a frequent word is joined per pair and not per occurrence
    pairs = (
        seq.select("before", "token").distinct().hint("shuffle_hash")  # the model is long, and need not be sorted
        .join(c2.withColumnsRenamed({"w1": "before", "w2": "token"}), ["before", "token"], "left")
        .join(c1.withColumnsRenamed({"w": "before", "c1": "_cb"}), "before", "left")
        .join(c1.withColumnsRenamed({"w": "token", "c1": "_ct"}), "token", "left")
        .withColumnsRenamed({"before": "_before", "token": "_token"})
    )
    # a small file of texts makes many rows, so neither side is broadcast for its size
    seq = seq.join(pairs.hint("merge"), F.col("before").eqNullSafe(F.col("_before")) & (F.col("token") == F.col("_token")))
    zero = F.lit(0)
    first = F.log((F.coalesce("_ct", zero) + k) / (total + k * vocab))
    later = F.log((F.coalesce("c2", zero) + k) / (F.coalesce("_cb", zero) + k * vocab))
    return seq.select(*key, "pos", "token", F.when(F.col("pos") == 0, first).otherwise(later).alias("logp"))


def cumulative_log_probs(scored: DataFrame, key: list[str]) -> DataFrame:
    """Running sum of ``logp`` inside each sentence."""
    w = Window.partitionBy(*key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return scored.withColumn("cum", F.sum("logp").over(w))


def largest_drops(scored: DataFrame, key: list[str]) -> DataFrame:
    """Largest drop of the running sum per sentence; the first token does not count."""
    return scored.groupBy(*key).agg(F.coalesce(F.max(F.when(F.col("pos") > 0, -F.col("logp"))), F.lit(0.0)).alias("drop"))


def typo_flags(drops: DataFrame, threshold: float) -> DataFrame:
    """Adds ``pred``: 0 for a suspect sentence, 1 for a fine one."""
    return drops.withColumn("pred", F.when(F.col("drop") > threshold, 0).otherwise(1))


def threshold_accuracy(drops: DataFrame, label: str, grid: list[float]) -> DataFrame:
    """(threshold, accuracy) over a grid, in one pass."""
    hits = drops.agg(*[F.avg((F.when(F.col("drop") > g, 0).otherwise(1) == F.col(label)).cast("double")).alias(f"a{i}") for i, g in enumerate(grid)])
    return hits.select(F.inline(F.array(*[F.struct(F.lit(float(g)).alias("threshold"), F.col(f"a{i}").alias("accuracy")) for i, g in enumerate(grid)])))


# --- chunks and retrieval ---------------------------------------------------------------------------

def token_chunks(docs: DataFrame, key: str, text: str, size: int, overlap: int) -> DataFrame:
    """(key, chunk, start, words): windows of ``size`` tokens that share ``overlap`` with the next."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below size")
    d = docs.select(key, tokens(F.col(text)).alias("_t")).filter(F.size("_t") > 0)
    last = F.greatest(F.size("_t") - overlap - 1, F.lit(0))
    # windows are cut before the rows multiply, so no row carries the whole text
    cuts = F.transform(F.sequence(F.lit(0), last, F.lit(size - overlap)), lambda at, i: F.struct(
        i.alias("chunk"), at.alias("start"), F.slice("_t", at + 1, F.lit(size)).alias("words")))
    return d.select(key, F.explode(cuts).alias("c")).select(key, "c.chunk", "c.start", "c.words")


SEPARATORS = ("\n\n", "\n", " ", "")


def _pieces(text: str, size: int, count, seps) -> list[str]:
    """Cuts at the largest separator that helps, going down only inside pieces still too long."""
    if count(text) <= size or not text:
        return [text] if text else []
    for i, sep in enumerate(seps):
        if sep == "":
            return list(text)
        if sep in text:
            parts = text.split(sep)
            out = []
            for j, p in enumerate(parts):
                p = p + sep if j < len(parts) - 1 else p
                out += [p] if count(p) <= size else _pieces(p, size, count, seps[i + 1:])
            return out
    return [text]


def separator_chunks_of(text: str, size: int, overlap: int, count=lambda s: len(s.split()), seps=SEPARATORS) -> list[str]:
    """Packs separator-bounded pieces into chunks of at most ``size`` with up to ``overlap`` carried over."""
    out, cur, total = [], [], 0
    for p in _pieces(text, size, count, seps):
        n = count(p)
        if cur and total + n > size:
            out.append("".join(cur).strip())
            while cur and (total > overlap or total + n > size):
                total -= count(cur.pop(0))
        cur.append(p)
        total += n
    if cur and "".join(cur).strip():
        out.append("".join(cur).strip())
    return [c for c in out if c]


def separator_chunks(docs: DataFrame, key: str, text: str, size: int, overlap: int, tokenizer=None) -> DataFrame:
    """(key, chunk, text): chunks that end at paragraph, line or word boundaries where they can.

    ``tokenizer`` counts the tokens of a string; whitespace words by default.
    """
    counter = tokenizer or (lambda s: len(s.split()))

    @F.pandas_udf("array<string>")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: separator_chunks_of(x, size, overlap, counter) if x else [])

    return docs.select(key, F.posexplode(run(text)).alias("chunk", "text"))


def hash_buckets(words: Column, dims: int) -> Column:
    """Portable hashing-trick bucket of each word."""
    return F.transform(words, lambda w: F.pmod(F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("bigint"), F.lit(dims)).cast("int"))


def bucket_idf(rows: DataFrame, buckets: str, dims: int) -> list[float]:
    """ln((1 + N) / (1 + df)) per bucket: ``dims`` numbers."""
    n = rows.count()
    df = {r[0]: r[1] for r in rows.select(F.explode(F.array_distinct(buckets)).alias("b")).groupBy("b").count().collect()}
    import math
    return [math.log((1 + n) / (1 + df.get(i, 0))) for i in range(dims)]


def tfidf_vector(buckets: Column, idf: list[float]) -> Column:
    """Dense tf-idf array of a bucket list."""
    import numpy as np
    weights = np.array(idf)

    @F.pandas_udf("array<double>")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda b: np.bincount(np.asarray(b, dtype=np.int64), minlength=len(weights)) * weights)

    return run(buckets)


PROMPT = "Answer the question from the context alone.\n\nContext:\n%s\nQuestion: %s\nAnswer:"


def assemble_prompts(hits: DataFrame, qid: str, rank: str, text: str, questions: DataFrame, question: str, template: str = PROMPT) -> DataFrame:
    """(qid, prompt): the few ranked chunks of each question, numbered and set into a template."""
    context = hits.groupBy(qid).agg(F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), F.col(text).alias("t")))).alias("_c"))
    joined = F.concat_ws("", F.transform("_c", lambda s: F.concat(F.lit("["), s["r"].cast("string"), F.lit("] "), s["t"], F.lit("\n"))))
    return context.join(questions, qid).select(qid, F.format_string(template, joined, F.col(question)).alias("prompt"))
