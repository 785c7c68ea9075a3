"""Cross-tokenizer alignment: token groups and links between two tokenizations of the same bytes.

1. A text with a blank in front is cut at blanks and line feeds that follow other characters,
   where neither tokenizer joins anything; the distinct pieces of a batch are aligned once.
2. A piece's tokens get their cumulative byte ends.  Dictionaries lead from end to token index;
   the intersection of their key sets, sorted, slices both id lists into groups.  Inside a
   group, tokens whose byte ranges overlap are linked.
3. Texts are packed into chunks that list their distinct id pairs once, with the number of texts
   that hold each; sums over chunks give the corpus-wide counts, and each A id's highest count.
4. Counts go back to the chunks by (chunk, pair number) and are summed over each text's links.

A pair occurs once in a chunk's list whatever its frequency, so no pair is a hot key.

Defined cases: texts that are null, empty, or whose joined token bytes differ from blank + text
have no tokens, no groups and no links; rows with equal or null keys are documents of their own;
a text without tokens has null groups; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.llm.common import narrow
from lodestat.llm.packed import by_weight, lists, squeeze, unsqueeze
from lodestat.llm.tokens import batch_encoder, cut_before_space, pieces, spread, whole_texts
from lodestat.session import cut

CHUNK_BYTES = 1 << 23  # text in a chunk
B_IDS = 1 << 16  # ids of B are below; a pair is a * B_IDS + b

MEMO = 300_000  # aligned pieces a worker remembers
_DIFFERS = (0, 0, 0, "", [], True)  # a piece whose joined bytes are not its own

_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")
_CHUNKS = ("chunk long, keys array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
           "groups array<string>, sha array<string>, sizes binary, numbers binary, times binary, pairs array<long>, docs array<long>")
_OUT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string")


class Aligner:
    """Aligns pieces of text between a byte-level tokenizer A and a sentencepiece tokenizer B."""

    def __init__(self, a: str, b: str):
        import sentencepiece

        self.a = batch_encoder(a, False, 4)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if len(names) > B_IDS:
            raise ValueError("B has too many ids")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        # A writes one character for each byte
        size = self.a.tokenizer.get_vocab_size(True)
        self.a_size = [len(self.a.tokenizer.id_to_token(i) or "") for i in range(size)]
        self.b_size = [len(x) for x in self.b_bytes]
        self.a_text, self.b_text = [str(i) for i in range(size)], [str(i) for i in range(len(names))]
        self.memo: dict[str, tuple] = {}
        self.lead = self.b.piece_to_id("▁")
        self.at_blank = not any("▁" in p.lstrip("▁") for p in names)
        self.at_feed = self.at_blank and not any("\n" in p for p in names)

    def cuts(self, raw: np.ndarray) -> np.ndarray:
        """Places where both tokenizers start anew."""
        if not self.at_blank:
            return np.zeros(0, "int64")
        return cut_before_space(raw, (raw == 0x20) | (raw == 0x0A) if self.at_feed else raw == 0x20)

    def ids(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of pieces under A and B; a piece starts with the blank that B adds, or with a line feed."""
        a = [np.frombuffer(x, "<u4").tolist() for x in self.a.encode_words(texts)]
        b = self.b.encode([t[1:] if t[0] == " " else t for t in texts], num_threads=1)
        # nothing gets no blank from B
        return a, [[self.lead] if t == " " else x if t[0] == " " else x[1:] if x[:1] == [self.lead] else [] for t, x in zip(texts, b)]

    def same_bytes(self, text: str, b: list[int]) -> bool:
        return b"".join([self.b_bytes[i] for i in b]) == text.encode()

    def align(self, a: list[int], b: list[int]) -> tuple[int, str, list[int]]:
        """Number of groups, groups as text, and links (a * B_IDS + b) of one piece."""
        a_ends = list(accumulate(map(self.a_size.__getitem__, a)))
        b_ends = list(accumulate(map(self.b_size.__getitem__, b)))
        a_index, b_index = dict(zip(a_ends, range(1, len(a) + 1))), dict(zip(b_ends, range(1, len(b) + 1)))
        told, links, i, j, a_text, b_text = [], [], 0, 0, self.a_text, self.b_text
        for end in sorted(a_index.keys() & b_index.keys()):
            to_i, to_j = a_index[end], b_index[end]
            if to_i - i == 1:
                p = a[i]
                if to_j - j == 1:
                    told.append(f"{a_text[p]}|{b_text[b[j]]}")
                    links.append(p * B_IDS + b[j])
                else:
                    told.append(f"{a_text[p]}|{','.join([b_text[q] for q in b[j:to_j]])}")
                    links += [p * B_IDS + q for q in b[j:to_j]]
            else:
                told.append(f"{','.join([a_text[p] for p in a[i:to_i]])}|{','.join([b_text[q] for q in b[j:to_j]])}")
                if to_j - j == 1:
                    links += [p * B_IDS + b[j] for p in a[i:to_i]]
                else:
                    k = j
                    for x in range(i, to_i):
                        start, stop = (a_ends[x - 1] if x else 0), a_ends[x]
                        while b_ends[k] <= start:
                            k += 1
                        y = k
                        while y < to_j and (b_ends[y - 1] if y else 0) < stop:
                            links.append(a[x] * B_IDS + b[y])
                            y += 1
            i, j = to_i, to_j
        return len(told), ";".join(told), links

    def pieces(self, names: list[str]) -> list[tuple]:
        """``(n_a, n_b, n_groups, groups, links, differs)`` of each piece; a bounded number is remembered."""
        if len(self.memo) > MEMO:
            self.memo.clear()
        memo = self.memo
        out = list(map(memo.get, names))
        new = [i for i, x in enumerate(out) if x is None]
        if new:
            for i, a, b in zip(new, *self.ids([names[i] for i in new])):
                good = self.same_bytes(names[i], b)
                out[i] = (len(a), len(b), *self.align(a, b), False) if good else _DIFFERS
                if len(names[i]) <= 32:
                    memo[names[i]] = out[i]
        return out


_ALIGNERS: dict[tuple, Aligner] = {}


def _aligner(a: str, b: str) -> Aligner:
    if (a, b) not in _ALIGNERS:
        _ALIGNERS[a, b] = Aligner(a, b)
    return _ALIGNERS[a, b]


def _sums(values: np.ndarray, before: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[before[1:]] - total[before[:-1]]


def chunks(docs: DataFrame, a: str, b: str, with_groups: bool, most: int = CHUNK_BYTES) -> DataFrame:
    """``doc_id, text`` as chunks: per text its numbers and groups, its distinct pairs as (number, times), and the chunk's pairs."""

    def one(aligner: Aligner, part: pa.RecordBatch, number: int) -> pa.RecordBatch:
        text = pc.fill_null(part.column(1).cast(pa.large_string()), "")
        text = pc.if_else(pc.equal(text, ""), text, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), text, pa.scalar("", pa.large_string())))
        raw, ends = whole_texts(text)
        place = np.zeros(len(raw) + 1, bool)
        place[0] = place[ends] = place[aligner.cuts(raw)] = True
        at = np.flatnonzero(place)
        names, code = pieces(raw, at) if len(raw) else ([], np.zeros(0, "int64"))
        names = [n.decode() for n in names]
        n_a, n_b, n_groups, told, links, differs = zip(*aligner.pieces(names)) if names else ((),) * 6
        sizes = np.fromiter(map(len, links), "int64", len(names))
        pairs = np.fromiter(chain.from_iterable(links), "int64", int(sizes.sum()))
        counts = [np.array(x, "int64") for x in (n_a, n_b, n_groups, sizes, differs)]
        # pieces of each text
        edges = np.searchsorted(at, np.concatenate([[0], ends]))
        good = _sums(counts[4][code], edges) == 0
        numbers = [np.where(good, _sums(x[code], edges), 0) for x in counts[:4]]
        word, edge = code.tolist(), edges.tolist()
        groups = [";".join(map(told.__getitem__, word[s:e])) if ok and e > s else None for ok, s, e in zip(good.tolist(), edge, edge[1:])]
        sha = ["" if g is None else hashlib.sha256(g.encode()).hexdigest() for g in groups]
        # distinct pairs of the chunk, by number; then of each text
        distinct = np.sort(pairs)
        distinct = distinct[np.flatnonzero(np.diff(distinct, prepend=-1))]
        pair_no = np.searchsorted(distinct, pairs)
        own = np.where(np.repeat(good, np.diff(edges)), sizes[code], 0)
        flat = pair_no[spread((np.cumsum(sizes) - sizes)[code], own)]
        doc = np.repeat(np.repeat(np.arange(len(good)), np.diff(edges)), own)
        held = np.sort(doc << 32 | flat)
        first = np.flatnonzero(np.diff(held, prepend=-1))
        times, held = np.diff(first, append=len(held)), held[first]
        docs_of = np.bincount(held & 0xFFFFFFFF, minlength=len(distinct))
        per_doc = np.bincount(held >> 32, minlength=len(good))
        used = np.flatnonzero(docs_of)  # pairs of texts without tokens do not count
        renumber = np.cumsum(docs_of > 0) - 1
        step = np.diff(renumber[held & 0xFFFFFFFF], prepend=0) if len(held) else held
        row = lambda v, kind=pa.int64(): lists(np.asarray(v), np.array([0, len(v)]), kind)
        return pa.RecordBatch.from_arrays([
            pa.array([number]), pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())), *[row(v) for v in numbers],
            pa.array([groups if with_groups else None], pa.list_(pa.string())), pa.array([sha], pa.list_(pa.string())),
            pa.array([squeeze(per_doc)]), pa.array([squeeze(np.where(step < 0, step + (1 << 32), step))]), pa.array([squeeze(times)]),
            row(distinct[used]), row(docs_of[used])], names=[c.split()[0] for c in _CHUNKS.split(", ")])

    def run(batches):
        aligner, number = _aligner(a, b), TaskContext.get().partitionId() << 32
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype("int64")
            for start, end in by_weight(size, most):
                yield one(aligner, batch.slice(start, end - start), number)
                number += 1

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _CHUNKS)


def pair_counts(packed: DataFrame) -> DataFrame:
    """``pair, n, best`` of every id pair: texts that hold it linked, and whether this is its A id's highest count."""
    counts = cut(packed.select(F.explode(F.arrays_zip("pairs", "docs")).alias("p")).groupBy("p.pairs").agg(F.sum("p.docs").alias("n"))
                 .select(F.col("pairs").alias("pair"), "n"))
    a_id = F.floor(F.col("pair") / B_IDS).alias("a_id")
    top = counts.groupBy(a_id).agg(F.max("n").alias("top"))  # a row for each id of A at most
    return counts.withColumn("a_id", a_id).join(F.broadcast(top), "a_id").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def align(docs: DataFrame, a: str, b: str, with_groups: bool = True, id_col: str = "doc_id", text_col: str = "text",
          most: int = CHUNK_BYTES) -> DataFrame:
    """Columns ``_OUT`` of every row; ``groups`` reads ``a1,a2|b1;a3|b2,b3`` (null unless ``with_groups``)."""
    packed = cut(chunks(narrow(docs, doc_id=id_col, text=text_col), a, b, with_groups, most))
    uses = packed.select("chunk", F.posexplode("pairs").alias("no", "pair"))
    back = uses.join(pair_counts(packed), "pair").select("chunk", "no", "n", "best")

    def put(key, chunk: pa.Table, rows: pa.Table) -> pa.Table:
        names = [c.split()[0] for c in _OUT.split(", ")]
        if not chunk.num_rows:
            return pa.table({n: pa.array([], pa.string() if n.startswith("groups") else pa.int64()) for n in names})
        row = chunk.slice(0, 1).to_pylist()[0]
        n = len(row["keys"])
        per_doc = unsqueeze(row["sizes"], n).astype("int64")
        total = int(per_doc.sum())
        no = np.cumsum(unsqueeze(row["numbers"], total)).astype("uint32").astype("int64") if total else np.zeros(0, "int64")
        times = unsqueeze(row["times"], total).astype("int64")
        count, best = np.zeros(rows.num_rows, "int64"), np.zeros(rows.num_rows, "int64")
        at = rows.column("no").to_numpy()
        count[at], best[at] = rows.column("n").to_numpy(), rows.column("best").to_numpy().astype("int64")
        before = np.concatenate([[0], np.cumsum(per_doc)])
        return pa.table({
            "doc_id": pa.array(row["keys"], pa.int64()), **{c: pa.array(row[c], pa.int64()) for c in _NUMBERS},
            "n_best": _sums(times * best[no], before), "count_sum": _sums(times * count[no], before),
            "groups_sha256": pa.array(row["sha"], pa.string()),
            "groups": pa.array(row["groups"] if row["groups"] is not None else [None] * n, pa.string())})

    held = packed.drop("pairs", "docs").withColumn("chunk", F.col("chunk") + 0)  # a column of its own beside that of the pairs
    return held.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(put, _OUT)
