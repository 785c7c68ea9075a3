"""Quality by hierarchical empirical Bayes over sites.

A document's own evidence comes from two logistic models (good? toxic?) on the words it
holds and on its shape.  Labelled rows also tell how good a host is, and a path of it: a
path's posterior mean shrinks to its host's, the host's to the global rate, with strengths
estimated from the spread between groups (method of moments).  The site's log-odds against
the global rate are added to the evidence; a site without labels adds nothing.

The models are fitted on a bounded sample of labelled rows (``TRAIN``, chosen by hash of the
id); all counts of sites cover every labelled row.

Defined cases: null text is empty; rows without a host or path belong to the null site, a
site like any other; repeated labels of one id count one by one; without labels the scores
are 0.5 and nothing is rejected; repeated rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.llm.common import narrow, small
from lodestat.session import cut

BINS = 1 << 17  # words are hashed here
_SHAPES = 6 * 16  # shape features follow the words
TRAIN = 4096  # sampled labelled rows the models are fitted on
CHI = 25.0
STEPS, RATE, DECAY = 400, 0.3, 1.0
_WORD = re.compile(r"\w+")
_MARK = np.zeros(128, bool)
_MARK[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def features(text: str, bin_of: dict[str, int]) -> np.ndarray:
    """Numbers of the features one whole text has."""
    words = _WORD.findall(text.lower())
    for w in set(words).difference(bin_of):
        if len(bin_of) > 400_000:
            bin_of.clear()
        bin_of[w] = zlib.crc32(w.encode("utf-8", "surrogatepass")) % BINS
    held = {bin_of[w] if w in bin_of else zlib.crc32(w.encode("utf-8", "surrogatepass")) % BINS for w in set(words)}
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    n, k = max(1, len(points)), max(1, len(words))
    ascii_ = points[points < 128]
    again = sum(map(str.__eq__, words, words[1:]))
    capital = ((ascii_ >= 65) & (ascii_ <= 90)).sum()
    shape = (min(15, k.bit_length()), 15 * len(held) / k, 15 * again / k, min(15, 60 * _MARK[ascii_].sum() / n),
             min(15, 30 * capital / n), min(15, sum(map(len, words)) / k))
    return np.array([*sorted(held), *(BINS + 16 * i + int(min(15, v)) for i, v in enumerate(shape))], "int64")


def fit(rows: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic model over sparse 0/1 rows, by adaptive gradient steps.

    Only features whose chi-square against ``y`` reaches ``CHI`` take part: words seen in a few
    rows tell the rows apart, not their labels.
    """
    at = np.concatenate(rows)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    n, size, share = len(rows), BINS + _SHAPES, float(y.mean())
    df, hits = np.bincount(at, minlength=size), np.bincount(at, y[row], size)
    chi = (hits - df * share) ** 2 / np.maximum(df * share * (1 - share) * (1 - df / n), 1e-9)
    used = np.flatnonzero((chi >= CHI) & (df >= 5) & (df < n))
    place = np.full(size, -1)
    place[used] = np.arange(len(used))
    at, row = place[at][place[at] >= 0], row[place[at] >= 0]
    w, b, seen, seen_b = np.zeros(len(used)), float(np.log((share + 1e-6) / (1 - share + 1e-6))), np.full(len(used), 1e-8), 1e-8
    for _ in range(STEPS):
        err = 1 / (1 + np.exp(-(np.bincount(row, w[at], n) + b))) - y
        g = (np.bincount(at, err[row], len(used)) + DECAY * w) / n
        seen += g * g
        seen_b += err.mean() ** 2
        w -= RATE * g / np.sqrt(seen)
        b -= RATE * err.mean() / np.sqrt(seen_b)
    out = np.zeros(size)
    out[used] = w
    return out, b


def shrunk_sites(labelled: DataFrame, host_cols: list[str], path_cols: list[str]) -> DataFrame:
    """Per path: ``site_good``, ``site_toxic``, log-odds of the posterior mean less the global ones.

    ``labelled`` has the site columns and ``good``, ``toxic`` (0/1).
    """
    sums = [F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")]
    paths = cut(labelled.groupBy(*path_cols).agg(*sums))
    hosts = paths.groupBy(*host_cols).agg(*[F.sum(c).alias(f"h_{c}") for c in ("n", "good", "toxic")])
    joined = cut(_equal_join(paths, hosts, host_cols))
    total = joined.agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")]).first()
    if not total["n"]:
        return joined.select(*path_cols, F.lit(0.0).alias("site_good"), F.lit(0.0).alias("site_toxic"))
    out = []
    for c in ("good", "toxic"):
        mu = (total[c] + 0.5) / (total["n"] + 1)
        host_k = _strength(hosts, F.col(f"h_{c}"), F.col("h_n"), F.lit(mu))
        host = (F.col(f"h_{c}") + host_k * mu) / (F.col("h_n") + host_k)
        path_k = _strength(joined, F.col(c), F.col("n"), host)
        path = (F.col(c) + path_k * host) / (F.col("n") + path_k)
        out.append((F.log(path / (1 - path)) - float(np.log(mu / (1 - mu)))).alias(f"site_{c}"))
    return cut(joined.select(*path_cols, *out))


def _strength(groups: DataFrame, hits: Column, n: Column, mean: Column) -> float:
    """Prior weight, in rows, that fits the spread of group rates around ``mean``."""
    off = F.pow(hits / n - mean, 2) * n
    r = groups.agg(F.sum(off).alias("between"), F.sum(mean * (1 - mean)).alias("chance"), F.sum(n).alias("n"),
                   F.sum(n * mean * (1 - mean)).alias("spread")).first()
    # between = chance + variance x rows, where chance is what equal groups would show
    variance = max((r["between"] - r["chance"]) / r["n"], 1e-9)
    return float(min(max(r["spread"] / r["n"] / variance - 1, 1.0), 1e6))


def _equal_join(left: DataFrame, right: DataFrame, cols: list[str], how: str = "inner") -> DataFrame:
    """Join where null equals null; the right side's keys are dropped."""
    right = small(right.withColumnsRenamed({c: f"r_{c}" for c in cols}))
    on = [F.col(c).eqNullSafe(F.col(f"r_{c}")) for c in cols]
    return left.join(right, on, how).drop(*[f"r_{c}" for c in cols])


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          host_col: str = "source", path_col: str = "lang") -> DataFrame:
    """``doc_id, p_good, p_toxic, kept`` of every row; ``labels`` has ``doc_id, quality, toxic``."""
    spark = docs.sparkSession
    rows = narrow(docs, doc_id=id_col, text=text_col, host=host_col, path=path_col)
    marks = narrow(labels, doc_id="doc_id", quality="quality", toxic="toxic").filter(
        "doc_id is not null and quality is not null and toxic is not null").select(
        "doc_id", (F.col("quality") > 0).cast("int").alias("good"), (F.col("toxic") > 0).cast("int").alias("toxic"))
    sites = shrunk_sites(rows.select("doc_id", "host", "path").join(marks, "doc_id").drop("doc_id"), ["host"], ["host", "path"])

    picked = F.broadcast(marks.orderBy(F.xxhash64("doc_id"), "doc_id", "good", "toxic").limit(TRAIN))  # bounded rows

    def pack(batches):
        bin_of: dict[str, int] = {}
        for b in batches:
            bits = []
            for text in b.column(0).to_pylist():
                one = np.zeros(BINS + _SHAPES, bool)
                one[features(text or "", bin_of)] = True
                bits.append(zlib.compress(np.packbits(one).tobytes(), 1))
            yield pa.RecordBatch.from_arrays([pa.array(bits, pa.binary()), b.column(1), b.column(2)], names=["bits", "good", "toxic"])

    packed = rows.select("doc_id", "text").join(picked, "doc_id").select("text", "good", "toxic")
    # at most TRAIN rows of at most BINS bits, unless ids repeat: then the limit holds
    got = packed.mapInArrow(pack, "bits binary, good int, toxic int").orderBy(F.xxhash64("bits"), "bits", "good", "toxic").limit(TRAIN).collect()
    if got:
        held = [np.flatnonzero(np.unpackbits(np.frombuffer(zlib.decompress(bytes(r["bits"])), "uint8"))) for r in got]
        models = [fit(held, np.array([r[c] for r in got], "float64")) for c in ("good", "toxic")]
    else:
        models = None
    shared = spark.sparkContext.broadcast(models)  # two vectors of BINS numbers

    def evidence(batches):
        bin_of: dict[str, int] = {}
        for b in batches:
            z = np.zeros((b.num_rows, 2))
            for i, text in enumerate(b.column(1).to_pylist() if shared.value else []):
                f = features(text or "", bin_of)
                z[i] = [w[f].sum() + c for w, c in shared.value]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), b.column(3), pa.array(z[:, 0]), pa.array(z[:, 1])],
                                             names=["doc_id", "host", "path", "good", "toxic"])

    seen = rows.mapInArrow(evidence, "doc_id long, host string, path string, good double, toxic double")
    both = _equal_join(seen, sites, ["host", "path"], "left")
    p_good, p_toxic = (1 / (1 + F.exp(-(F.col(c) + F.coalesce(f"site_{c}", F.lit(0.0))))) for c in ("good", "toxic"))
    out = both.select("doc_id", p_good.alias("p_good"), p_toxic.alias("p_toxic"))
    if models is None:
        return out.withColumn("kept", F.lit(True))
    return out.withColumn("kept", (F.col("p_good") >= 0.5) & (F.col("p_toxic") < 0.5))
