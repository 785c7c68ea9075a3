"""Operators of lodestat.llm on small fixtures: brute force, round trips and edge cases."""

from __future__ import annotations

import collections
import hashlib
import itertools
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodestat.llm import exactdedup, langid, linededup, mixing, multiindex, neardedup, packing, pii, quality, tokenids
from lodestat.llm.tokens import BatchEncoder
from lodestat.session import scratch_path, ship

SCHEMA = "doc_id long, text string, lang string, source string, fp long, input string, row string"
BYTE, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PROSE = ["the cat sat on the warm mat and looked at the rain for a while", "le chat est assis sur le tapis et regarde la pluie dehors",
         "el gato se sienta en la alfombra y mira la lluvia de la tarde", "die katze sitzt auf der matte und schaut in den regen hinaus"]


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty and long texts, repeats, ties and columns that clash with inner names."""
    ship(spark)
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    rows = [(1, "a b c", "en", "x"), (2, None, None, None), (3, "", "en", "x"), (4, "a b c", "en", None), (4, "a b c", "en", None),
            (5, long, "en", "y"), (6, long + " tail", "en", "y"), (7, "  \n\t ", "fr", "z"), (None, "a b c", "en", "x"),
            (None, None, None, "x"), (8, "12345 !!", "en", "z"), (9, "\U0001f600 mail me: a.b@c.org +1 (234) 555-0199 \n x", "en", "z")]
    rows += [(20 + i, f"{PROSE[i % 4]} {i} " + " ".join(f"w{i}x{j}" for j in range(i)), ["en", "fr", "es", "de"][i % 4], f"s{i % 3}") for i in range(40)]
    return spark.createDataFrame([(*r, 0, "i", "r") for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def _texts(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


# --- token ids -------------------------------------------------------------------------------


def _tokenizer(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def _same_ids(enc, texts):
    want = [e.ids for e in _tokenizer(enc.path).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for _ in range(2):  # learned, then remembered
        ids, before = enc.encode(pa.array(texts, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(before, before[1:])] == want


@pytest.mark.parametrize("path,drops", [(BYTE, False), (WORDS, True)])
@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.none() | st.text(alphabet=st.sampled_from("ab'tsZ09 .,!\n\t\r\x0b\x1c\x1f\x85\xa0\u2003\u3000“é̈ΣßIİ<|>-_\x00ÇÎ×÷"), max_size=40), max_size=5))
def test_batches_match_the_library(path, drops, texts):
    _same_ids(BatchEncoder(path, drops, 4), texts)


@pytest.mark.parametrize("path,drops", [(BYTE, False), (WORDS, True)])
def test_special_strings_and_long_pieces_are_text(path, drops):
    _same_ids(BatchEncoder(path, drops, 2), ["a <|endoftext|> b", "<|startoftext|>", "x" * 500 + " y" * 900, None, "", " ", "<| a"])


def test_encoder_forgets_beyond_its_bound():
    enc = BatchEncoder(BYTE, False, 4, memo=3)
    _same_ids(enc, ["one two three four five, six."] * 2)
    _same_ids(enc, ["seven eight"])
    assert len(enc.memo) <= 3


def test_token_ids_round_trip(spark, docs):
    path = scratch_path(spark, "test-ids")
    tokenids.write(docs, path, BYTE, 2)
    got = tokenids.documents_of(spark, path, docs).collect()
    tokenizer, start, want = _tokenizer(BYTE), 0, []
    for key, text in sorted(_texts(docs), key=lambda r: (r[0] is not None, r[0], r[1] or "")):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        want.append((key, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == collections.Counter(want)
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    named = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert named == sorted(named, key=lambda k: (k is not None, k))


def test_token_ids_of_nothing_and_of_strangers(spark, none, docs):
    path = scratch_path(spark, "test-ids")
    tokenids.write(none, path, BYTE, 2)
    assert tokenids.documents_of(spark, path, none).count() == 0
    path = scratch_path(spark, "test-ids")
    tokenids.write(docs, path, BYTE, 2)
    strangers = spark.range(10_000, 12_000).withColumnRenamed("id", "doc_id")
    assert tokenids.lookup(spark, path, strangers).count() == 0


@settings(max_examples=20, deadline=None)
@given(st.sets(st.integers(-(2**63), 2**63 - 1), min_size=1, max_size=300))
def test_perfect_hash_is_perfect(keys):
    keys = np.array(sorted(keys), "int64")
    seeds, slots = tokenids.perfect_hash(keys)
    assert sorted(slots) == list(range(len(keys)))
    assert (tokenids.slot_of(keys, seeds, len(keys)) == slots).all()


# --- exact duplicates ------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 2**48 - 1), min_size=1, max_size=200))
def test_rice_code_round_trip(values):
    x = np.array(sorted(values), "uint64")
    k, code = exactdedup.rice_encode(x)
    assert (exactdedup.rice_decode(len(x), k, code) == x).all()


def test_exact_copies_against_brute_force(spark, docs, none):
    got = exactdedup.find_copies(docs).collect()
    groups = collections.defaultdict(list)
    for key, text in _texts(docs):
        groups[text or ""].append(key)
    assert len(got) == sum(map(len, groups.values()))
    by_hash = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in groups.items()}
    kept = collections.Counter()
    for r in got:
        own = by_hash[r["text_sha256"]]
        assert r["group_size"] == len(own)
        assert r["keep_id"] == max((k for k in own if k is not None), default=None)
        kept[r["text_sha256"]] += r["kept"]
    assert set(kept.values()) == {1}
    assert exactdedup.find_copies(none).count() == 0


# --- near duplicates -------------------------------------------------------------------------


def _sets(rows):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for key, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        yield key, frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def test_near_copies_against_brute_force(spark, docs, none):
    rng = np.random.default_rng(5)
    rows = _texts(docs.select("doc_id", "text"))
    for base in range(12):
        words = [f"b{base}v{i}" for i in range(int(rng.integers(8, 200)))]
        for copy in range(8):
            w = list(words)
            for _ in range(int(rng.integers(0, 4))):
                w[int(rng.integers(len(w)))] = f"n{int(rng.integers(99))}"
            rows.append((1000 + 10 * base + copy, " ".join(w)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("label", F.lit(1)).repartition(4)
    got = neardedup.groups(frame).collect()
    assert len(got) == len(rows)
    parent = {k: k for k, _ in rows if k is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(k, s) for k, s in _sets(rows) if k is not None and s]
    for (a, x), (b, y) in itertools.combinations(sets, 2):
        both = len(x & y)
        if 100 * both >= 85 * (len(x) + len(y) - both):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == find(r["doc_id"])
            assert r["kept"] == (r["doc_id"] == r["component_id"])
    assert collections.Counter(r["n_shingles"] for r in got) == collections.Counter(len(s) for _, s in _sets(rows))
    assert neardedup.groups(none).count() == 0


def test_registers_estimate_similarity():
    rng = np.random.default_rng(1)
    both = rng.integers(0, 2**64, 900, dtype="uint64")
    a, b = (np.unique(np.concatenate([both, rng.integers(0, 2**64, 50, dtype="uint64")])) for _ in range(2))
    j, n = neardedup.estimate(neardedup.registers(a), neardedup.registers(b), len(a), len(b))
    assert abs(j - 0.9) < 0.12 and n == neardedup.REGISTERS
    far = np.unique(rng.integers(0, 2**64, 900, dtype="uint64"))
    assert neardedup.estimate(neardedup.registers(a), neardedup.registers(far), len(a), len(far))[0] < 0.1


# --- repeated passages -----------------------------------------------------------------------


def test_shifted_passages_are_cut_once(spark):
    ship(spark)
    passage = [f"shared line number {i} of the passage with some more words" for i in range(12)]
    rows = [(i, "\n".join([f"own opening {i} a b c d e f g"] * (i + 1) + passage + [f"own ending {i} q r s t u v w x"])) for i in range(6)]
    long = " ".join(f"t{i}" for i in range(60))
    rows += [(10, "start here\n" + long + "\nend"), (11, long), (12, "other\n" + long), (13, None), (14, ""), (None, long), (15, long), (15, long)]
    frame = spark.createDataFrame([(a, b, "k") for a, b in rows], "doc_id long, text string, input string").repartition(3)
    out = linededup.clean(frame)
    assert out.columns == frame.columns and out.count() == len(rows)
    got = collections.defaultdict(list)
    for r in out.collect():
        got[r["doc_id"]].append(r["text"])
    assert got[0] == [rows[0][1]]
    for i in range(1, 6):
        left = set(got[i][0].split("\n"))
        assert f"own ending {i} q r s t u v w x" in left and len(left & set(passage)) <= 6
    assert got[10] == ["start here\n" + long + "\nend"]
    assert got[11] == [""] and got[12] == ["other"] and got[13] == [None] and got[14] == [""] and got[None] == [""] and got[15] == ["", ""]


def test_every_repeat_of_fifty_words_in_whole_lines_is_cut(spark):
    ship(spark)
    rng, rows, want = np.random.default_rng(5), [], {}
    for k in range(40):
        # 50 words or more in two to twelve lines, uneven, some blank, between foreign lines
        sizes = [int(x) for x in rng.integers(0, 30, int(rng.integers(2, 13)))]
        sizes[0], sizes[-1] = 8, max(1, 50 - sum(sizes[1:-1]) - 8, sizes[-1])
        passage = [" ".join(f"p{k}x{i}y{j}" for j in range(n)) for i, n in enumerate(sizes)]
        for copy in range(2):
            before, after = ([f"own {k} {copy} {side} {i}" for i in range(int(rng.integers(0, 4)))] for side in "ab")
            rows.append((2 * k + copy, "\n".join(before + passage + after)))
            want[2 * k + copy] = "\n".join(before + ([] if copy else passage) + after)
    rows.append((900, "\n".join(["one line of ten words that comes again and again"] * 12)))
    want[900] = "\n".join(["one line of ten words that comes again and again"] * 5)
    got = {r["doc_id"]: r["text"] for r in linededup.clean(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert {k for k in want if got[k] != want[k] and k != 900} == set()
    assert 1 <= got[900].count("one line") <= 5


def test_line_report_of_edge_cases(spark, docs, none):
    got = linededup.report(docs)
    assert got.count() == docs.count() and linededup.report(none).count() == 0
    assert all(0 <= r["n_removed"] <= r["n_lines"] for r in got.collect())


# --- language --------------------------------------------------------------------------------


def test_language_on_held_out_rows(spark, docs, none):
    rows = [(i, " ".join(np.random.default_rng(i).permutation(PROSE[i % 4].split())), "enfresde"[2 * (i % 4):2 * (i % 4) + 2]) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = {r["doc_id"]: r for r in langid.predict(frame).collect()}
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, _ in rows)
    held = [(i, n) for i, _, n in rows if got[i]["held_out"]]
    assert np.mean([got[i]["lang_pred"] == n for i, n in held]) > 0.97
    odd = langid.predict(docs).collect()
    assert len(odd) == docs.count()
    for r in odd:
        assert 0 <= r["score"] <= 1
        if r["doc_id"] in (2, 3, 7, 8):
            assert r["lang_pred"] == "und" and r["score"] == 0
    assert langid.predict(none).count() == 0
    assert langid.known(docs).columns == docs.columns
    assert {r["lang_pred"] for r in langid.predict(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_texts_unlike_all_languages_learned_are_not_known(spark):
    rows = [(i, " ".join(np.random.default_rng(i).permutation(PROSE[i % 4].split())), "enfresde"[2 * (i % 4):2 * (i % 4) + 2]) for i in range(1200)]
    mixed = [(2000, PROSE[0] + " " + PROSE[2], "en"), (2001, PROSE[1].split()[0], "fr")]
    strange = [(3000, "Съешь же ещё этих мягких булок, да выпей чаю", None), (3001, "これは日本語の文章です", None), (3002, "你好世界", None)]
    frame = spark.createDataFrame(rows + mixed + strange, "doc_id long, text string, lang string").repartition(4)
    assert {r["doc_id"] for r in langid.known(frame).collect()} == {r[0] for r in rows + mixed}


# --- quality ---------------------------------------------------------------------------------


def test_quality_finds_toxic_and_junk(spark, docs, none):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, marks = [], []
    for i in range(1500):
        words = list(rng.choice(vocabulary, 60))
        toxic, junk = i % 7 == 0, i % 5 == 0
        if toxic:
            words[::20] = rng.choice(["vile", "rotten", "nasty"], 3)
        if junk:
            words = [w + "!!" for w in words]
        rows.append((i, " ".join(words), f"s{i % 9}", "en"))
        if i % 2:
            marks.append((i, int(not junk), int(toxic)))
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").repartition(3)
    got = {r["doc_id"]: r["kept"] for r in quality.score(frame, labels).collect()}
    wrong = [i for i in range(0, 1500, 2) if got[i] != (i % 7 != 0 and i % 5 != 0)]
    assert len(got) == 1500 and len(wrong) < 15
    assert quality.score(docs, labels.limit(0)).filter("kept").count() == docs.count()
    assert quality.score(docs, labels).count() == docs.count()
    assert quality.score(none, labels).count() == 0


def test_sites_shrink_to_the_global_rate(spark):
    rows = [("a", "p", 1, 0)] * 400 + [("b", "p", 0, 0)] * 400 + [("b", "q", 0, 1)] + [("c", None, 1, 0)] + [(None, "p", 0, 0)]
    sites = {(r["host"], r["path"]): r["site_good"] for r in quality.shrunk_sites(
        spark.createDataFrame(rows, "host string, path string, good int, toxic int"), ["host"], ["host", "path"]).collect()}
    assert len(sites) == 5
    assert sites["a", "p"] > sites["c", None] > 0 > sites[None, "p"] > sites["b", "p"]


# --- personal data ---------------------------------------------------------------------------


def _luhn(d):
    return sum((int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4)) for i, c in enumerate(reversed(d))) % 10 == 0


def _base_spans(text):
    kinds = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(re.sub("[^0-9]", "", m)) <= 19 and _luhn(re.sub("[^0-9]", "", m))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15)]
    out = [(m.start(), k, m.end()) for k, (_, p, ok) in enumerate(kinds) for m in re.finditer(p, text) if ok(m.group())]
    return ",".join(f"{kinds[k][0]}:{a}:{b}" for a, k, b in sorted(out))


def test_base_spans_against_python(spark, docs, none):
    rng = np.random.default_rng(2)
    pieces = ["a.b@c.de", "a@b", "x@y.z_w@v.u", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "0", " ", "-",
              "+1 (234) 555-0199", "+49 30", "+12", "\U0001f600", "é", "\n", ".", "tel", "378282246310005", "@", "+", "(", "00000000000000000000000", "9" * 30]
    rows = [(i, "".join(rng.choice(pieces, int(rng.integers(0, 25))))) for i in range(400)]
    rows += [(1000, "1 " * 20_000), (1001, "7" * 50_000), (1002, "a@b.cc " * 700), (1003, "1.2.3.4 " * 700), (1004, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("base", F.lit("clash")).repartition(4)
    got = {r["doc_id"]: r for r in pii.digest(pii.find(frame)).collect()}
    for key, text in rows:
        want = _base_spans(text or "")
        assert got[key]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), (key, text)
        assert set(filter(None, want.split(","))) <= set(got[key]["spans"].split(","))
        assert got[key]["n_ip"] == want.count("ip:") and got[key]["n_phone"] == want.count("phone:")
    assert pii.digest(pii.find(docs)).count() == docs.count()
    assert pii.digest(pii.find(none)).count() == 0


def test_votes_set_reliabilities():
    def row(rank, votes, count):
        return {"rank": rank, "votes": votes, "size": 4, "parts": 1, "count": count}

    rows = [row(3, [1, 1, 1, 0], 900), row(3, [-1, -1, -1, 0], 900), row(3, [-1, 1, 1, 1], 40), row(2, [-1, -1, 1, 0], 10)]
    right, _, post = pii.reliabilities(rows)
    assert post[0] > 0.95 and post[1] < 0.05 and post[2] > post[3] and all(0.5 < x < 1 for x in right)
    weights = pii.classifier(rows, post)
    assert len(weights) == len(pii.KINDS) + pii.LABELERS + 2


# --- many languages --------------------------------------------------------------------------


def test_every_label_is_learned(spark):
    ship(spark)
    rows = [(i, f"{chr(0x4E00 + i % 300)}{chr(0x5E00 + i % 300)} x", f"l{i % 300:03d}") for i in range(3000)]
    rows += [(3000 + i, "rare words", "once") for i in range(4)]
    learned = langid.sample(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3))
    assert len({lang for lang, _ in learned}) == 301


# --- mixing ----------------------------------------------------------------------------------


def _targets(size):
    names = sorted((n for n in size if n is not None)) + ([None] if None in size else [])
    weight, cap = {n: 1 + i % 3 for i, n in enumerate(names)}, {n: 3 * s for n, s in size.items()}
    rest, free, out = sum(size.values()), set(names), {}
    while free:
        share = {n: rest * weight[n] / sum(weight[m] for m in free) for n in free}
        over = [n for n in free if share[n] > cap[n]]
        if not over:
            return {**out, **share}
        for n in over:
            out[n] = cap[n]
            rest -= cap[n]
            free.remove(n)
    return out


def test_mix_meets_targets(spark, docs, none):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 60))), ["a", "b", "c", None, "tiny"][min(4, int(rng.integers(0, 4)) if i > 3 else 4)]) for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash")).repartition(5)
    got = mixing.mix(frame).collect()
    size, taken = collections.Counter(), collections.Counter()
    for i, text, source in rows:
        size[source] += len(text.split())
    want = _targets(size)
    for r in got:
        source = None if r["no_source"] else r["source"]
        assert r["source_size"] == size[source] and r["target"] == pytest.approx(want[source])
        assert 0 <= r["copies"] <= 3
        taken[source] += r["copies"] * r["size"]
    assert len(got) == len(rows) and all(abs(taken[n] - want[n]) <= 60 for n in size)
    again = {r["doc_id"]: r["copies"] for r in mixing.mix(frame.repartition(2)).collect()}
    assert again == {r["doc_id"]: r["copies"] for r in got}
    out = mixing.mixed(frame)
    assert out.columns == frame.columns and out.count() == sum(r["copies"] for r in got)
    assert mixing.mix(none).count() == 0 and mixing.mix(docs).count() == docs.count()


def test_repeated_rows_share_out_their_target(spark):
    """60 equal rows of a source are taken as often as its target says, not all alike; texts behind a key may differ."""
    rows = [(7, "w " * 10, "a")] * 60 + [(7, "v " * 10, "a")] * 3 + [(i, "w " * int(5 + i % 9), "b") for i in range(100, 150)] + [(9, "w w", None)] * 5
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = mixing.mix(frame).collect()
    size, taken = collections.Counter(), collections.Counter()
    for _, text, source in rows:
        size[source] += len(text.split())
    want = _targets(size)
    for r in got:
        taken[None if r["no_source"] else r["source"]] += r["copies"] * r["size"]
    assert len(got) == len(rows) and all(abs(taken[n] - want[n]) <= 10 for n in size)
    out = collections.Counter(r["source"] for r in mixing.mixed(frame).collect())
    per_row = collections.Counter()
    for r in got:
        per_row[None if r["no_source"] else r["source"]] += r["copies"]
    assert out == per_row


def test_rounding_keeps_expectations(spark):
    items = spark.range(200).select(F.lit(False).alias("no_source"), F.lit("s").alias("source"), F.col("id").alias("doc_id"), F.lit(7).cast("long").alias("size"), F.lit(1).cast("long").alias("copy"), F.lit(0.3).alias("part"))
    counts = np.zeros(200)
    for seed in range(6):
        got = mixing.rounded(items, seed).collect()
        assert len(got) == 200 and sum(r["extra"] for r in got) == 60
        for r in got:
            counts[r["doc_id"]] += r["extra"]
    assert counts.max() < 6 and (counts > 0).sum() > 120


# --- nearest neighbours ----------------------------------------------------------------------


def test_nearest_against_brute_force(spark):
    ship(spark)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 16)).astype("float32")
    x[100:160] = x[0]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(5000, None), (5001, [0.0] * 16), (5002, [float("nan")] * 16), (5003, [1.0, None] * 8), (5004, [1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit(1)).repartition(4)
    got = collections.defaultdict(list)
    for r in multiindex.search(frame, frame.filter("vec_id % 50 = 0"), k=5).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    unit = x.astype("float64") / np.linalg.norm(x.astype("float64"), axis=1, keepdims=True)
    hits = 0
    for q in range(0, 3000, 50):
        s = unit @ unit[q]
        s[q] = -2
        best = np.lexsort((np.arange(3000), -np.round(s, 12)))[:5]
        hits += len({v for v, _ in got[q]} & set(best.tolist()))
        assert all(abs(sc - s[v]) < 1e-12 for v, sc in got[q]) and len(got[q]) == 5
    assert hits >= 0.93 * 5 * 60 and set(got) == set(range(0, 3000, 50))
    assert [v for v, _ in got[0]] == [100, 101, 102, 103, 104]
    assert multiindex.search(frame.limit(0), frame.limit(0)).count() == 0
    few = frame.filter("vec_id < 3")
    assert multiindex.search(few, few.filter("vec_id = 0")).count() == 2


@settings(max_examples=40, deadline=None)
@given(st.lists(st.floats(0, 9), min_size=1, max_size=6), st.lists(st.floats(0, 9), min_size=1, max_size=6))
def test_walk_visits_cells_in_order(a, b):
    counts = np.ones((len(a), len(b)), "int64")
    out = multiindex.walk(np.array(a), np.array(b), counts, np.inf)
    sums = [a[i] + b[j] for i, j in out]
    assert len(set(out)) == len(a) * len(b) and sums == sorted(sums)


# --- packing ---------------------------------------------------------------------------------


def test_packing_covers_every_id_once(spark, docs, none):
    pieces = packing.pack(docs, WORDS, 2).collect()
    tokenizer = _tokenizer(WORDS)
    left = collections.Counter()
    for key, text in _texts(docs):
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids) + 1
        left[key, n] += n
    for r in pieces:
        left[r["doc_id"], r["doc_tokens"]] -= r["length"]
    assert not any(left.values())
    by = collections.defaultdict(list)
    for r in pieces:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at == 4096 or at & (at - 1) == 0
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(docs, WORDS, 2).collect()}
    crc = {(r["sequence_id"], r["offset"]): (r["length"], r["ids_crc32"]) for r in pieces}
    assert set(whole) == set(by)
    for (seq, offset), (length, want) in crc.items():
        assert zlib.crc32(np.array(whole[seq][offset:offset + length], "<u4").tobytes()) == want
    assert packing.pack(none, WORDS, 2).count() == 0


def test_shard_scores_are_bm25():
    rng = np.random.default_rng(8)
    terms = [np.unique(rng.integers(0, 40, 12)) for _ in range(20)]
    times = [rng.integers(1, 5, len(t)) for t in terms]
    lengths, idf = np.array([t.sum() for t in times], "float64"), rng.random(40)
    shard = packing.Shard(terms, times, lengths, idf, 25.0)
    got = shard.scores(terms[3])
    for d in range(20):
        want = sum(idf[t] * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * lengths[d] / 25.0)) for t, n in zip(terms[d], times[d]) if t in terms[3])
        assert got[d] == pytest.approx(want)


def test_terms_of_a_third_of_all_documents_bring_them_together(spark):
    ship(spark)
    topics = ["river boat water fish shore", "engine wheel motor brake road", "flour bread oven sugar butter"]
    frame = spark.createDataFrame([(i, " ".join([topics[i % 3]] * 3)) for i in range(120)], "doc_id long, text string").repartition(3)
    held = collections.defaultdict(set)
    for r in packing.pack(frame, WORDS, 2, window=64).collect():
        held[r["sequence_id"]].add(r["doc_id"] % 3)
    # at most the places where one topic ends and the next begins, in each of four partitions
    assert sum(len(x) > 1 for x in held.values()) <= 12 < len(held) / 2
