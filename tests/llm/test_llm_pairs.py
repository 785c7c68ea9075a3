"""Hard negatives, alignment of two tokenizers and the word table, against brute force."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodestat.llm import align, hardneg, packed, queries, wordtable
from lodestat.session import ship

BYTE, WORDS, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
ODD = "ab'tsZ09 .,;!\n\t\r\x0b\x1c\x1f\x85\xa0 　▁“é̈ΣßIİ<|>-_\x00ﬁ﻿\U0001f600"


def _texts():
    rng = random.Random(3)
    odd = ["".join(rng.choice(ODD) for _ in range(rng.randrange(0, 25))) for _ in range(400)]
    words = ["the", "river", "boats", "unbelievably", "lay", "still;", "'twas", "naïve", "x1y2", "<|endoftext|>", "a<|startoftext|>b", "<s>", "<0x41>", "▁"]
    prose = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))) for _ in range(60)]
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    return [None, "", " ", "  \n\t ", "a b c", "a b c", "x" * 3000, long, long + "\nend", *odd, *prose, "  lead", "trail  ", "two\n\n  lines \n x"]


@pytest.fixture(scope="module")
def texts(spark):
    """Documents with repeated and null keys, and columns that clash with inner names."""
    ship(spark)
    rows = [(None if i % 97 == 5 else i // 2 if i % 31 == 7 else i, t, 0, "c") for i, t in enumerate(_texts())]
    return spark.createDataFrame(rows, "doc_id long, text string, chunk long, word string").repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def _rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]



# --- word table ------------------------------------------------------------------------------


def _digests(rows, literal=False):
    tokenizer, out = Tokenizer.from_file(WORDS), collections.Counter()
    tokenizer.encode_special_tokens = literal
    for key, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        out[key, np.array(ids, "<u4").tobytes(), tokenizer.decode(ids, skip_special_tokens=False)] += 1
    return out


@pytest.mark.parametrize("literal", [False, True])
def test_word_table_is_the_librarys_encoding(texts, literal):
    got = collections.Counter((r["doc_id"], bytes(r["ids"]), r["decoded"]) for r in wordtable.round_trip(texts, WORDS, literal).collect())
    assert got == _digests(_rows(texts), literal)


def test_words_are_encoded_once(spark, texts):
    chunks = wordtable.chunks(texts.select("doc_id", "text"), True, 200).cache()  # many chunks that share words
    assert chunks.count() > 10
    words = chunks.select("chunk", F.posexplode("words").alias("no", "word"))
    got = wordtable.encode_words(words, WORDS).join(words, ["chunk", "no"]).groupBy("word").agg(F.countDistinct("ids").alias("n")).collect()
    assert {r["n"] for r in got} == {1}
    again = collections.Counter((r["doc_id"], bytes(r["ids"]), r["decoded"]) for r in wordtable.round_trip(texts, WORDS, most=200).collect())
    assert again == _digests(_rows(texts))
    chunks.unpersist()


def test_word_table_of_nothing_and_the_query(spark, none, tmp_path):
    assert wordtable.round_trip(none, WORDS).count() == 0
    spark.createDataFrame([(1, "A cat sat."), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.QUERIES["op13_bpe"](spark, str(tmp_path)).collect()}
    tokenizer = Tokenizer.from_file(WORDS)
    ids = tokenizer.encode("A cat sat.").ids
    assert got[1]["n_tokens"] == len(ids) and got[1]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert got[1]["decoded_sha256"] == hashlib.sha256(tokenizer.decode(ids).encode()).hexdigest()
    assert got[2]["n_tokens"] == 0 and got[2]["decoded_sha256"] == hashlib.sha256(b"").hexdigest()


def test_numbers_survive_squeezing():
    for x in (np.zeros(0, "<u4"), np.array([0, 1, 2**32 - 1, 65536], "<u4"), np.arange(100_000, dtype="<u4")):
        assert (packed.unsqueeze(packed.squeeze(x), len(x)) == x).all()
    assert packed.by_weight(np.array([3, 9, 1, 1, 1]), 4) == [(0, 1), (1, 2), (2, 5)]
    assert packed.by_weight(np.zeros(0), 4) == []


# --- alignment -------------------------------------------------------------------------------


def _byte_letters():
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def _aligned(rows):
    tokenizer, model, letters = Tokenizer.from_file(BYTE), sentencepiece.SentencePieceProcessor(model_file=PIECES), _byte_letters()
    tokenizer.encode_special_tokens = True
    per_row, count = [], collections.Counter()
    for key, text in rows:
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        at = [bytes(letters[c] for c in tokenizer.id_to_token(i)) for i in a]
        bt = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if b"".join(at) != b"".join(bt) or b"".join(at) != (" " + (text or "")).encode():
            a, b, at, bt = [], [], [], []
        ends = [np.cumsum([len(x) for x in t]).astype(int).tolist() for t in (at, bt)]
        groups, i, j = [], 0, 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            to_i, to_j = ends[0].index(e) + 1, ends[1].index(e) + 1
            groups.append(f"{','.join(map(str, a[i:to_i]))}|{','.join(map(str, b[j:to_j]))}")
            i, j = to_i, to_j
        links = [(a[x], b[y]) for x in range(len(a)) for y in range(len(b))
                 if ends[0][x] - len(at[x]) < ends[1][y] and ends[1][y] - len(bt[y]) < ends[0][x]]
        per_row.append((key, len(a), len(b), groups, links))
        count.update(set(links))
    return per_row, count


def test_alignment_against_brute_force(spark, texts):
    short = texts.filter("text is null or length(text) < 2000")
    rows, count = _aligned(_rows(short))
    top = collections.Counter()
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    want = collections.Counter(
        (k, na, nb, len(g), len(x), sum(count[p] == top[p[0]] for p in x), sum(count[p] for p in x),
         hashlib.sha256(";".join(g).encode()).hexdigest() if na else "", ";".join(g) if na else None) for k, na, nb, g, x in rows)
    assert sum(n for k, n in want.items() if not k[1]) > 20 < sum(n for k, n in want.items() if k[1])
    names = [c.split()[0] for c in align._OUT.split(", ")]
    for size in (align.CHUNK_BYTES, 300):
        got = collections.Counter(tuple(r[c] for c in names) for r in align.align(short, BYTE, PIECES, most=size).collect())
        assert got == want


def test_alignment_of_long_texts_and_of_nothing(spark, texts, none):
    got = [r for r in align.align(texts, BYTE, PIECES, with_groups=False).collect() if r["n_a"] > 10_000]
    assert len(got) == 2 and all(r["groups"] is None and r["n_links"] >= r["n_groups"] >= 30_000 for r in got)
    assert align.align(none, BYTE, PIECES).count() == 0


# --- hard negatives --------------------------------------------------------------------------


def _mined(rows, anchors, positives=5, negatives=10):
    out = collections.Counter()
    rows = [(i, lab, [int(np.floor(256.0 * x)) for x in v]) for i, v, lab in rows
            if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    for i, lab, v in rows:
        if not anchors(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in rows if j != i and len(w) == len(v))
        for p, j, _ in [s for s in scored if s[2] == lab][:positives]:
            inside = [(n, k) for n, k, m in scored if m != lab and 30 * -p <= 100 * -n <= 90 * -p][:negatives]
            for rank, (n, k) in enumerate(inside, 1):
                out[i, j, rank, k, -p, -n] += 1
    return out


def _vectors(spark, rows):
    return spark.createDataFrame([(*r, 0, 1) for r in rows], "vec_id long, embedding array<double>, label int, no long, score int").repartition(3)


def test_hard_negatives_against_brute_force(spark, monkeypatch):
    ship(spark)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 6)) + rng.normal(size=(5, 6))[rng.integers(0, 5, 600)]
    x[200:300] = x[7]  # a common vector, so scores tie
    rows = [(i, [float(v) for v in r], int(rng.integers(0, 4))) for i, r in enumerate(x)]
    rows += [(700, None, 1), (701, [float("nan")] * 6, 1), (702, [1.0, None] * 3, 1), (703, [float("inf")] * 6, 1), (710, [1.0] * 6, None), (None, [1.0] * 6, 1)]
    rows += [(i, [float(i % 5), 1.0], i % 2) for i in range(800, 830)] + [(840, [], 1), (850, [], 2)] + rows[20:23]
    rows += [(900, [0.0] * 6, 1)]  # every score is 0, and so is every window
    wanted = _mined(rows, lambda i: i % 10 == 0)
    frame, names = _vectors(spark, rows), [c.split()[0] for c in hardneg.RESULT.split(", ")]
    for cell, anchors, together in ((hardneg.CELL, hardneg.ANCHORS, 8), (64, 7, 2)):
        for name, value in (("CELL", cell), ("ANCHORS", anchors), ("TOGETHER", together)):
            monkeypatch.setattr(hardneg, name, value)
        got = collections.Counter(tuple(r[c] for c in names) for r in hardneg.mine(frame, F.col("vec_id") % 10 == 0).collect())
        assert got == wanted and sum(got.values()) > 1000
    assert hardneg.mine(frame.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert hardneg.mine(frame, F.col("vec_id") < 0).count() == 0


def test_large_components_stay_exact(spark):
    ship(spark)
    rows = [(i, [float(2**21 + i), float(-(2**20) * (i % 3)), 2.0**19], i % 2) for i in range(40)]
    frame, names = _vectors(spark, rows), [c.split()[0] for c in hardneg.RESULT.split(", ")]
    got = collections.Counter(tuple(r[c] for c in names) for r in hardneg.mine(frame, F.col("vec_id") % 5 == 0).collect())
    assert got == _mined(rows, lambda i: i % 5 == 0) and got
    with pytest.raises(Exception, match="too large"):
        hardneg.mine(_vectors(spark, [(0, [2.0**30], 1), (1, [2.0**30], 1)]), F.col("vec_id") == 0).collect()
    with pytest.raises(ValueError):
        hardneg.mine(frame, F.col("vec_id") == 0, high=(11, 10))


def test_first_keeps_order_of_ties():
    score = np.array([5, 7, 5, 7, 5, 9])
    assert sorted(hardneg.first(score, np.arange(6), 4)) == [0, 1, 3, 5]
    assert sorted(hardneg.first(score, np.array([0, 2, 4]), 2)) == [0, 2]
