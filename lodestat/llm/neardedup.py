"""Near duplicates by HyperMinHash.

A document is the set of its five-word shingles.  Each shingle hash falls in one of
``REGISTERS`` buckets; a bucket keeps its smallest hash as a leading-zero count and
``MANTISSA`` bits.  Bands of the compressed registers propose pairs, the registers estimate
the similarity of a pair with chance collisions taken off, and what may reach the limit is
confirmed on the full sets.

No pairs are made of a whole group.  Equal sets are one class from the start.  One member of
every bucket, the hub, meets the others; links found join classes to components, and a bucket
whose other members are all in one component is done.  Those of the other buckets meet in tasks,
in blocks of bounded size: first by registers, then, where one may have a partner in another
component, by full sets.  A task returns at most one link for each two components it joins.
No link is lost that the bands can see (a pair at the limit is missed with chance below ``MISS``).

Defined cases: null, empty and wordless texts have no shingles and no links; a text of one
to four words is one shingle; rows that share an id are one document, linked with whatever
any of them links to; rows without an id are linked with nothing, kept, and have no
component; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.llm.common import narrow, small
from lodestat.operators.graph import components
from lodestat.session import cut

WORDS = 5
REGISTERS = 128
MANTISSA = 10
MISS = 1e-6  # chance at most with which the bands miss a pair at the limit
LIMIT = (85, 100)  # linked when 100 x intersection >= 85 x union, unless a caller sets another limit
MARGIN = 5.0  # standard deviations by which an estimate may lie below the limit
BLOCK_ROWS = 2048  # members of one bucket that meet in one task
BLOCK_SHINGLES = 4_000_000  # and their shingles

_EMPTY = 0xFFFF
_VALUE_BITS = 64 - (REGISTERS.bit_length() - 1)
_ASCII_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_TURNS = np.random.default_rng(11).integers(1, 2**63, WORDS, dtype="uint64") * np.uint64(2) + np.uint64(1)
_PROBE = np.random.default_rng(12).integers(0, REGISTERS, (64, REGISTERS))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    """Word hashes seen before, up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = _Hashes()


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_ASCII_LOWER).split()
    n = len(words)
    if not n:
        return np.empty(0, "uint64")
    h = np.fromiter(map(_HASHES.__getitem__, words), "uint64", n)
    k = min(WORDS, n)
    total = np.full(n - k + 1, np.uint64(k))
    for i in range(k):
        total += h[i:n - k + 1 + i] * _TURNS[i]
    return np.unique(_mix(total))


def registers(hashes: np.ndarray) -> np.ndarray:
    """Compressed bucket minima: leading zeros above ``MANTISSA`` bits, or empty."""
    low = np.full(REGISTERS, np.uint64(2**64 - 1))
    bucket = (hashes >> np.uint64(_VALUE_BITS)).astype("int64")
    # sorted hashes: the first of each bucket is its smallest
    held, first = np.unique(bucket, return_index=True)
    low[held] = hashes[first] & np.uint64((1 << _VALUE_BITS) - 1)
    out = np.full(REGISTERS, _EMPTY, "uint16")
    v = low[held]
    length = np.frexp(v.astype("float64"))[1].astype("int64")
    length -= (v >> np.maximum(length - 1, 0).astype("uint64")) == 0
    length = np.maximum(length, 0)
    lead = _VALUE_BITS - length
    aligned = v << lead.astype("uint64")
    mantissa = (aligned >> np.uint64(_VALUE_BITS - 1 - MANTISSA)) & np.uint64((1 << MANTISSA) - 1)
    out[held] = (lead.astype("uint64") << np.uint64(MANTISSA)) | mantissa
    return out


def band_rows(limit: tuple[int, int]) -> int:
    """Registers of a band: as many as leave a pair at the limit unseen with a chance below ``MISS``."""
    j = limit[0] / limit[1]
    return next((r for r in range(REGISTERS, 1, -1) if (1 - j**r) ** (REGISTERS // r) < MISS), 1)


def bands(regs: np.ndarray, limit: tuple[int, int] = LIMIT) -> list[int]:
    """Signed 64-bit bucket keys; empty registers borrow from filled ones, by a fixed rule."""
    full = regs.copy()
    empty = np.flatnonzero(full == _EMPTY)
    for probe in _PROBE:
        if not len(empty):
            break
        full[empty] = regs[probe[empty]]
        empty = empty[full[empty] == _EMPTY]
    if len(empty):
        full[empty] = regs[regs != _EMPTY].min()
    rows = band_rows(limit)
    return [xxhash.xxh3_64_intdigest(full[a:a + rows].tobytes(), seed=a) - 2**63 for a in range(0, REGISTERS - rows + 1, rows)]


def estimate(a: np.ndarray, b: np.ndarray, na: int, nb: int) -> tuple[float, int]:
    """Jaccard estimate without accidental matches, and the number of registers it rests on."""
    used = (a != _EMPTY) | (b != _EMPTY)
    n = int(used.sum())
    ratio = na / nb
    # expected matches of different minima: a fixed share of 2^-MANTISSA, less for unequal sizes
    chance = 0.169919487159739 * n / (1 << MANTISSA) * 4 * ratio / (1 + ratio) ** 2
    return max(0.0, (int((a == b)[used].sum()) - chance) / n), n


def may_link(a: bytes, b: bytes, na: int, nb: int, limit: tuple[int, int] = LIMIT) -> bool:
    if limit[1] * min(na, nb) < limit[0] * max(na, nb):
        return False
    j, n = estimate(np.frombuffer(a, "uint16"), np.frombuffer(b, "uint16"), na, nb)
    least = limit[0] / limit[1]
    return j >= least - MARGIN * np.sqrt(least * (1 - least) / n)


def linked(a: np.ndarray, b: np.ndarray, limit: tuple[int, int] = LIMIT) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return limit[1] * both >= limit[0] * (len(a) + len(b) - both)


def _digest(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def sketches(rows: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, set_id, regs`` of each row."""

    def sketch(batches):
        for b in batches:
            n, ids, regs = [], [], []
            for text in b.column(1):
                s = shingles(text.as_py())
                n.append(len(s))
                ids.append(_digest(s) if len(s) else None)
                regs.append(registers(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(regs, pa.binary())],
                                             names=["doc_id", "n_shingles", "set_id", "regs"])

    return rows.mapInArrow(sketch, "doc_id long, n_shingles long, set_id binary, regs binary")


def _banded(classes: DataFrame, limit: tuple[int, int]) -> DataFrame:
    """``band, id, set_id``, one row per class and band."""

    def spread(batches):
        for b in batches:
            keys = [bands(np.frombuffer(r.as_py(), "uint16"), limit) for r in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(keys, pa.list_(pa.int64()))], names=["id", "set_id", "keys"])

    wide = classes.select("id", "set_id", "regs").mapInArrow(spread, "id long, set_id binary, keys array<long>")
    return wide.select(F.explode("keys").alias("band"), "id", "set_id")


def _sides(pairs: DataFrame, table: DataFrame, value: list[str]) -> DataFrame:
    """Both sides' ``value`` columns for ``a, b`` (set ids), with suffixes."""
    left = table.select(F.col("set_id").alias("a"), *[F.col(v).alias(f"{v}_a") for v in value])
    right = table.select(F.col("set_id").alias("b"), *[F.col(v).alias(f"{v}_b") for v in value])
    return pairs.join(left, "a").join(right, "b")


def _sets_of(ids: DataFrame, set_ids: DataFrame, rows: DataFrame) -> DataFrame:
    """``set_id, s``: the full shingle sets of the asked classes, from the texts of the asked ids."""

    def full(batches):
        for b in batches:
            s = [shingles(t.as_py()) for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([_digest(x) for x in s], pa.binary()), pa.array([x.tobytes() for x in s], pa.binary())], names=["set_id", "s"])

    # one long per id: at most 16 MB when broadcast, shuffled beyond that
    texts = rows.join(small(cut(ids.distinct()), 1_000_000), "doc_id").select("text").mapInArrow(full, "set_id binary, s binary")
    return cut(texts.join(set_ids.distinct(), "set_id", "left_semi").groupBy("set_id").agg(F.first("s").alias("s")))


def _confirm(pairs: DataFrame, classes: DataFrame, rows: DataFrame, limit: tuple[int, int]) -> DataFrame:
    """Those of ``pairs`` (``a, b`` set ids) whose full sets are linked, as ``src, dst`` ids."""

    def likely(batches):
        for b in batches:
            p = {n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)}
            keep = [i for i in range(b.num_rows) if may_link(p["regs_a"][i], p["regs_b"][i], p["n_shingles_a"][i], p["n_shingles_b"][i], limit)]
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(n)) for n in ("a", "b", "id_a", "id_b")], names=["a", "b", "src", "dst"]).take(pa.array(keep, pa.int64()))

    close = cut(_sides(pairs, classes, ["regs", "n_shingles", "id"]).mapInArrow(likely, "a binary, b binary, src long, dst long"))

    sets = _sets_of(close.select(F.explode(F.array("src", "dst")).alias("doc_id")), close.select(F.explode(F.array("a", "b")).alias("set_id")), rows)

    def check(batches):
        for b in batches:
            keep = [i for i, (x, y) in enumerate(zip(b.column(2), b.column(3)))
                    if linked(np.frombuffer(x.as_py(), "uint64"), np.frombuffer(y.as_py(), "uint64"), limit)]
            yield b.select([0, 1]).take(pa.array(keep, pa.int64()))

    return _sides(close, sets, ["s"]).select("src", "dst", "s_a", "s_b").mapInArrow(check, "src long, dst long")


def _labels(nodes: DataFrame, links: DataFrame) -> DataFrame:
    return cut(components(nodes, links).select(F.col("node").alias("id"), F.col("component").alias("label")))


def _blocks(members: DataFrame) -> DataFrame:
    """Members of buckets that hold several components, dealt to pairs of blocks ``lo, hi``."""
    mixed = members.groupBy("band").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("w"))
    many = F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("w") / BLOCK_SHINGLES)).cast("int")
    mixed = cut(mixed.filter("x < y").select("band", many.alias("many")))
    dealt = members.join(mixed, "band").withColumn("mine", F.pmod(F.xxhash64("set_id"), F.col("many")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("many") - 1)).alias("other")
    return dealt.select("*", other).select("band", "set_id", "id", "label", "n_shingles", "mine", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"))


def _meets(pdf: pd.DataFrame, i: int) -> np.ndarray:
    """Rows behind row ``i`` of another component that this pair of blocks has to compare it with."""
    rest = np.arange(i + 1, len(pdf))
    mine, label = pdf["mine"].to_numpy(), pdf["label"].to_numpy()
    ok = label[rest] != label[i]
    if pdf["lo"].iloc[0] != pdf["hi"].iloc[0]:
        ok &= mine[rest] != mine[i]
    return rest[ok]


def _joining(members: DataFrame, classes: DataFrame, rows: DataFrame, limit: tuple[int, int]) -> DataFrame:
    """``src, dst`` links between components, from all buckets that hold several."""

    def hopeful(pdf: pd.DataFrame) -> pd.DataFrame:
        regs = np.frombuffer(b"".join(pdf["regs"]), "uint16").reshape(len(pdf), REGISTERS)
        n, least = pdf["n_shingles"].to_numpy("float64"), limit[0] / limit[1]
        full, hope = regs != _EMPTY, np.zeros(len(pdf), bool)
        for i in range(len(pdf)):
            at = _meets(pdf, i)
            at = at[np.minimum(n[at], n[i]) >= least * np.maximum(n[at], n[i])]
            if len(at):
                used = (full[at] | full[i]).sum(1)
                # accidental matches only raise the estimate, so leaving them in loses nothing
                alike = ((regs[at] == regs[i]) & full[i]).sum(1) / used
                at = at[alike >= least - MARGIN * np.sqrt(least * (1 - least) / used)]
                hope[at] = True
                hope[i] |= len(at) > 0
        return pdf.loc[hope, ["band", "set_id", "id", "label", "n_shingles"]]

    kind = "band long, set_id binary, id long, label long, n_shingles long"
    key = ["band", "lo", "hi"]
    near = cut(_blocks(members).join(classes.select("set_id", "regs"), "set_id").groupBy(*key).applyInPandas(hopeful, kind).distinct())

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(x, "uint64") for x in pdf["s"]]
        n, ids, label = pdf["n_shingles"].to_numpy(), pdf["id"].to_numpy(), pdf["label"].to_numpy()
        shingle, doc = np.concatenate(sets), np.repeat(np.arange(len(sets)), n)
        order = np.argsort(shingle, kind="stable")
        doc = doc[order]
        names, first = np.unique(shingle[order], return_index=True)
        size = np.diff(first, append=len(doc))
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        out = []
        for i in range(len(pdf)):
            at = _meets(pdf, i)
            if not len(at):
                continue
            own = np.searchsorted(names, sets[i])
            # all postings of the set's shingles, list after list
            ends = np.cumsum(size[own])
            pos = np.arange(ends[-1]) + np.repeat(first[own] - (ends - size[own]), size[own])
            both = np.bincount(doc[pos], minlength=len(pdf))[at]
            for j in at[limit[1] * both >= limit[0] * (n[at] + n[i] - both)]:
                a, b = find(int(label[i])), find(int(label[j]))
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    out.append((ids[i], ids[j]))
        return pd.DataFrame(out, columns=["src", "dst"], dtype="int64")

    sets = _sets_of(near.select(F.col("id").alias("doc_id")), near.select("set_id"), rows)
    met = _blocks(near).join(sets, "set_id")
    return cut(met.groupBy(*key).applyInPandas(join, "src long, dst long").distinct())


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: tuple[int, int] = LIMIT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Linked are sets with ``limit[1]`` x intersection >= ``limit[0]`` x union.
    """
    rows = narrow(docs, doc_id=id_col, text=text_col)
    sketched = cut(sketches(rows))
    classes = cut(sketched.filter("set_id is not null and doc_id is not null").groupBy("set_id").agg(
        F.min("doc_id").alias("id"), F.first("regs").alias("regs"), F.first("n_shingles").alias("n_shingles")))
    # buckets of one class propose nothing
    banded = _banded(classes, limit)
    banded = cut(banded)
    busy = cut(banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("band"))
    banded = cut(banded.join(busy, "band"))
    nodes = classes.select(F.col("id").alias("node")).distinct()
    # rows of one id are one document
    same = cut(sketched.filter("set_id is not null and doc_id is not null").select("doc_id", "set_id").join(
        classes.select("set_id", "id"), "set_id").filter("doc_id <> id").select(F.col("doc_id").alias("src"), F.col("id").alias("dst"))
        .join(nodes.withColumnRenamed("node", "src"), "src", "left_semi"))
    hubs = cut(banded.groupBy("band").agg(F.min_by("set_id", F.xxhash64("id")).alias("hub")))
    pairs = banded.join(hubs, "band").filter("hub <> set_id").select(F.least("hub", "set_id").alias("a"), F.greatest("hub", "set_id").alias("b"))
    links = cut(same.unionByName(_confirm(cut(pairs.distinct()), classes, rows, limit)).distinct())
    label = _labels(nodes, links)
    # the hub has met every member of its bucket already
    others = banded.join(hubs, "band").filter("hub <> set_id").drop("hub")
    members = cut(others.join(label, "id").join(classes.select("set_id", "n_shingles"), "set_id"))
    more = _joining(members, classes, rows, limit)
    if not more.isEmpty():
        label = _labels(nodes, cut(links.unionByName(more)))
    of_set = cut(classes.select("set_id", "id").join(label, "id").select("set_id", "label"))
    out = sketched.select("doc_id", "n_shingles", "set_id").join(of_set, "set_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: tuple[int, int] = LIMIT) -> DataFrame:
    """The rows of ``docs`` without those that another document of their component stands for."""
    gone = cut(groups(docs, id_col, text_col, limit).filter(~F.col("kept")).select(F.col("doc_id").alias("gone_id")).distinct())
    # one long per id: at most 16 MB when broadcast, shuffled beyond that
    return docs.join(small(gone, 1_000_000), F.col(f"`{id_col}`") == F.col("gone_id"), "left_anti")
