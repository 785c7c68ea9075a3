"""Language by string kernel: blended-spectrum presence kernels, Nystroem landmarks and
one-versus-rest kernel ridge regression.

A text is the set of its n-grams of one to three characters, hashed to ``BINS`` bins; the
kernel of two texts is the number of bins they share over the geometric mean of their own
numbers.  ``LANDMARKS`` training texts span the solution, so a model is one matrix and a
batch of texts is scored by two matrix products.

The fit reads a bounded sample (``TRAIN`` rows, spread evenly over all languages, chosen by hash
of the id, or ``LEAST`` rows of each where that is more); counts per language and predictions cover every row and whole texts.

Defined cases: null text or text without a letter is ``und`` with score 0; rows with a null
language or null id are not learned from but are predicted; with nothing to learn every row
is ``und``; of equal margins the language first in code point order wins; repeated rows are
predicted alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestat.llm.common import narrow

BINS = 1 << 14
ORDERS = (1, 2, 3)
TRAIN = 4096  # sampled rows the model is fitted on
LANDMARKS = 512
LEAST = 8  # sampled rows of a language at least, if it has them; with many languages the sample grows
RIDGE = 1e-4
UNKNOWN = "und"
_BLOCK = 1 << 20  # characters hashed at a time
_BATCH = 64  # texts per matrix product
_ROWS = 128  # sampled rows unpacked at a time
_LETTER = re.compile(r"[^\W\d_]")


def presence(texts: list[str]) -> np.ndarray:
    """0/1 matrix (texts x bins) of the n-grams each whole text holds, without regard to case."""
    out = np.zeros((len(texts), BINS), "float32")
    for row, text in zip(out, texts):
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
        for at in range(0, len(points), _BLOCK):
            part = points[at:at + _BLOCK + max(ORDERS) - 1].astype("uint32")
            mixed = np.zeros(len(part), "uint32")
            for n in range(1, max(ORDERS) + 1):
                if len(part) < n:
                    break
                mixed = (mixed[:len(part) - n + 1] * np.uint32(0x01000193)) ^ (part[n - 1:] + np.uint32(n << 24))
                if n in ORDERS:
                    row[(mixed * np.uint32(0x9E3779B1)) >> np.uint32(32 - BINS.bit_length() + 1)] = 1
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))


def _unpacked(bits: list[bytes]) -> np.ndarray:
    rows = np.unpackbits(np.frombuffer(b"".join(bits), "uint8")).reshape(len(bits), BINS)
    return _unit(rows.astype("float32"))


def _known_share(k: np.ndarray, sizes: np.ndarray, mark_sizes: np.ndarray) -> np.ndarray:
    """Largest share of a text's n-grams that one landmark holds too, beyond what hashing gives by chance.

    ``k``: kernel of texts and landmarks; ``sizes``: their numbers of n-grams.
    """
    chance = mark_sizes[None, :] / BINS
    share = k * np.sqrt(mark_sizes[None, :] / np.maximum(sizes[:, None], 1))
    return ((share - chance) / np.maximum(1 - chance, 1e-9)).max(1)


def fit(bits: list[bytes], langs: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, float]:
    """Languages, landmark matrix, dual coefficients, the landmarks' numbers of n-grams and the evidence a
    known language has at least: half of the least known share of the sampled rows that are no landmarks.
    """
    names = sorted(set(langs))
    y = np.where(np.array(langs)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    # presence rows are unpacked a few at a time: what stays is the landmarks and their kernel values
    marks = _unpacked(bits[:LANDMARKS])
    k_nm = np.concatenate([(_unpacked(bits[at:at + _ROWS]) @ marks.T).astype("float64") for at in range(0, len(bits), _ROWS)])
    k_mm = k_nm[:len(marks)]
    system = k_nm.T @ k_nm + RIDGE * len(bits) * k_mm
    alpha = np.linalg.solve(system + 1e-6 * np.trace(system) / len(system) * np.eye(len(system)), k_nm.T @ y)
    sizes = np.array([np.unpackbits(np.frombuffer(b, "uint8")).sum() for b in bits], "float64")
    others, own = k_nm[len(marks):], sizes[:len(marks)]
    floor = 0.5 * float(_known_share(others, sizes[len(marks):], own).min()) if len(others) else 0.0
    return names, marks, alpha, own, max(0.0, floor)


def learnable(key: Column) -> Column:
    """Rows a model may learn from: three quarters of the ids."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string")), F.lit(4)) != 2, F.lit(False))


def sample(docs: DataFrame) -> list:
    """Packed presence rows of the training sample: ``lang, bits``, shuffled by hash.

    Rates per language come from counts over all rows.
    """
    rows = docs.filter(F.col("lang").isNotNull() & learnable(F.col("doc_id")))
    counts = rows.groupBy("lang").count().collect()  # a row per language
    if not counts:
        return []
    each = max(LEAST, TRAIN // len(counts))
    rates = F.create_map(*[F.lit(v) for r in counts for v in (r["lang"], min(1.0, 1.5 * each / r["count"]))])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    picked = rows.withColumn("draw", draw).filter(F.col("draw") < rates[F.col("lang")])

    def pack(batches):
        for b in batches:
            keep = [i for i, t in enumerate(b.column(1).to_pylist()) if t and _LETTER.search(t)]
            b = b.take(pa.array(keep, pa.int64()))
            for at in range(0, b.num_rows, _BATCH):
                part = b.slice(at, _BATCH)
                bits = np.packbits(presence(part.column(1).to_pylist()).astype(bool), axis=1)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([r.tobytes() for r in bits]), part.column(2)],
                                                 names=["lang", "bits", "draw"])

    packed = picked.select("lang", "text", "draw").mapInArrow(pack, "lang string, bits binary, draw double")
    # rates aim at 1.5 x each language's share, of which the first rows by hash are taken
    share = Window.partitionBy("lang").orderBy("draw", "bits")
    chosen = packed.withColumn("place", F.row_number().over(share)).filter(F.col("place") <= each)
    got = chosen.orderBy(F.col("draw") / rates[F.col("lang")], "lang", "bits").collect()  # at most each x languages
    return [(r["lang"], bytes(r["bits"])) for r in got]


def annotate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``input`` (the whole row), ``doc_id, held_out, lang_pred, score, familiar`` of every row of ``docs``.

    The score is half the lead over the second best language.  A text is familiar if it shares as much with
    a landmark as texts of the learned languages do, however short or mixed it is.
    """
    spark = docs.sparkSession
    rows = narrow(docs, doc_id=id_col, text=text_col, lang=lang_col)
    learned = sample(rows)
    fitted = fit([b for _, b in learned], [n for n, _ in learned]) if learned else ([], None, None, None, 0.0)
    model = spark.sparkContext.broadcast(fitted)  # at most LANDMARKS x BINS numbers

    def score(batches):
        names, marks, alpha, mark_sizes, floor = model.value
        label = np.array([*names, UNKNOWN], dtype=object)
        for b in batches:
            texts = b.column(2).to_pylist()
            best, lead, familiar = np.full(len(texts), len(names)), np.zeros(len(texts)), np.zeros(len(texts), bool)
            told = [i for i, t in enumerate(texts) if names and t and _LETTER.search(t)]
            for at in range(0, len(told), _BATCH):
                part = told[at:at + _BATCH]
                grams = presence([texts[i] for i in part])
                k = (_unit(grams) @ marks.T).astype("float64")
                f = k @ alpha
                best[part] = f.argmax(1)
                familiar[part] = _known_share(k, grams.sum(1, dtype="float64"), mark_sizes) >= floor
                second = np.sort(f, 1)[:, -2] if len(names) > 1 else np.full(len(part), -1.0)
                lead[part] = np.clip((f.max(1) - second) / 2, 0, 1)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), pa.array(label[best], pa.string()), pa.array(lead), pa.array(familiar)],
                                             names=["input", "doc_id", "held_out", "lang_pred", "score", "familiar"])

    asked = docs.select(F.struct("*").alias("input")).select(
        "input", F.col(f"input.`{id_col}`").cast("long").alias("doc_id"), F.col(f"input.`{text_col}`").alias("text"))
    asked = asked.withColumn("held_out", F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False)))
    out = T.StructType([asked.schema["input"], T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()),
                        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("familiar", T.BooleanType())])
    return asked.mapInArrow(score, out)


def predict(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row."""
    needed = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys((id_col, text_col, lang_col))])
    return annotate(needed, id_col, text_col, lang_col).drop("input", "familiar")


def known(docs: DataFrame, least: float = 0.0, **columns: str) -> DataFrame:
    """The rows of ``docs`` in a learned language, with a score of ``least`` or more.

    Texts without a language go, and texts unlike all that was learned.  A small lead is common in
    texts of two languages, so by default it costs no text its place.
    """
    told = annotate(docs, **columns).filter((F.col("lang_pred") != UNKNOWN) & F.col("familiar") & (F.col("score") >= least))
    return told.select("input.*")
