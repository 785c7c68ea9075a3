import gzip
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestat.operators import similarity as V
from lodestat.operators import text as X
from lodestat.sources import treebank
from lodestat.session import scratch_path


def test_ngrams(spark):
    d = spark.createDataFrame([(["a", "b", "c", "d"],), (["x"],), ([],)], "w array<string>")
    got = [r[0] for r in d.select(X.ngrams(F.col("w"), 3)).collect()]
    assert got == [["a b c", "b c d"], [], []]


def test_bag_of_words_drops_single_letters_and_case(spark):
    docs = spark.createDataFrame([(1, "The cat, the CAT a"), (2, "")], "id int, text string")
    got = {(r["id"], r["term"]): r["n"] for r in X.bag_of_words(docs, "id", "text").collect()}
    assert got == {(1, "the"): 2, (1, "cat"): 2}
    own = {r["term"] for r in X.bag_of_words(docs, "id", "text", X.pandas_tokenizer(lambda s: s.split(","))).collect()}
    assert "The cat" in own
    assert "the" in X.default_stop_words()


def test_chunks_overlap_and_cover(spark):
    words = [f"w{i}" for i in range(23)]
    d = spark.createDataFrame([(1, " ".join(words)), (2, "one"), (3, " ")], "id int, text string")
    rows = X.token_chunks(d, "id", "text", 10, 3).orderBy("id", "chunk").collect()
    first = [r for r in rows if r["id"] == 1]
    assert [r["start"] for r in first] == [0, 7, 14]
    assert all(a["words"][-3:] == b["words"][:3] for a, b in zip(first, first[1:]))
    assert first[-1]["words"][-1] == "w22" and [r["id"] for r in rows].count(3) == 0
    with pytest.raises(ValueError):
        X.token_chunks(d, "id", "text", 5, 5)


def test_separator_chunks_respect_size_and_boundaries(spark):
    text = "\n\n".join(" ".join(f"p{p}w{i}" for i in range(n)) for p, n in enumerate([4, 5, 30, 2]))
    chunks = X.separator_chunks_of(text, 10, 2)
    assert all(len(c.split()) <= 10 for c in chunks)
    assert set(" ".join(chunks).split()) == set(text.split())
    assert chunks[0].startswith("p0w0 p0w1 p0w2 p0w3\n\np1w0 p1w1 p1w2 p1w3 p1w4")
    d = spark.createDataFrame([(1, text)], "id int, text string")
    assert [r["text"] for r in X.separator_chunks(d, "id", "text", 10, 2).orderBy("chunk").collect()] == chunks


def test_bigram_scores_and_typo_rule(spark):
    docs = spark.createDataFrame([(["a", "b", "a", "b", "a", "c"],)], "words array<string>")
    s = spark.createDataFrame([(1, ["a", "b"]), (2, ["a", "z", "b"])], "id int, words array<string>")
    sc = X.token_log_probs(s, ["id"], "words", X.bigram_model(docs, "words"))
    got = {(r["id"], r["pos"]): r["logp"] for r in sc.collect()}
    assert got[(1, 0)] == pytest.approx(math.log(4 / 9)) and got[(1, 1)] == pytest.approx(math.log(3 / 6))
    assert got[(2, 1)] == pytest.approx(math.log(1 / 6)) and got[(2, 2)] == pytest.approx(math.log(1 / 3))
    flags = {r["id"]: r["pred"] for r in X.typo_flags(X.largest_drops(sc, ["id"]), 1.0).collect()}
    assert flags == {1: 1, 2: 0}
    cum = {(r["id"], r["pos"]): r["cum"] for r in X.cumulative_log_probs(sc, ["id"]).collect()}
    assert cum[(2, 2)] == pytest.approx(got[(2, 0)] + got[(2, 1)] + got[(2, 2)])


def test_prompt(spark):
    hits = spark.createDataFrame([(1, 2, "late"), (1, 1, "early")], "q int, rank int, t string")
    q = spark.createDataFrame([(1, "why?")], "q int, question string")
    p = X.assemble_prompts(hits, "q", "rank", "t", q, "question", "%s|%s").first()["prompt"]
    assert p == "[1] early\n[2] late\n|why?"


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(0)
    m = rng.normal(size=(120, 8))
    m[7] = m[3]  # exact copy
    return m, spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id bigint, vec array<double>").repartition(5).cache()


@pytest.mark.parametrize("limit", [4096, 50])
def test_top_similar_is_exact_on_both_paths(vectors, limit):
    m, df = vectors
    u = m / np.linalg.norm(m, axis=1)[:, None]
    sims = np.round(u @ u.T, 9)
    q = df.select(F.col("id").alias("qid"), F.col("vec").alias("qvec"))
    got = V.top_similar(df, q, 5, skip_self=True, query_limit=limit, vector_block=40).orderBy("qid", "rank").collect()
    want = [(i, j) for i in range(120) for j in sorted((k for k in range(120) if k != i), key=lambda k: (-sims[i, k], k))[:5]]
    assert [(r["qid"], r["id"]) for r in got] == want


def test_components_match_a_decomposition(vectors):
    m, df = vectors
    comp, share = V.principal_components(df, 3)
    got = np.array([r["components"] for r in comp.orderBy("id").collect()])
    c = m - m.mean(axis=0)
    u, s, _ = np.linalg.svd(c, full_matrices=False)
    assert np.abs(got) == pytest.approx(np.abs(u[:, :3] * s[:3]), abs=1e-8)
    assert share == pytest.approx((s[:3] ** 2 / (s ** 2).sum()).tolist())


def test_pairs_with_unknown_words_drop(vectors, spark):
    _, df = vectors
    pairs = spark.createDataFrame([(3, 7, 1.0), (3, 999, 0.5)], "a bigint, b bigint, human double")
    rows = V.pair_similarity(df, pairs).collect()
    assert len(rows) == 1 and rows[0]["sim"] == pytest.approx(1.0)


def test_most_similar_and_analogies(vectors, spark):
    m, df = vectors
    u = m / np.linalg.norm(m, axis=1)[:, None]
    quads = spark.createDataFrame([(0, 1, 2, 4, 5)], "qid bigint, a bigint, b bigint, c bigint, d bigint")
    s = u @ (u[2] - u[1] + u[4])
    s[[1, 2, 4]] = -9
    assert V.analogies(df, quads).first()["predicted"] == int(s.argmax())


def test_second_hop_leaves_visited_words_out(vectors, spark):
    _, df = vectors
    seeds = spark.createDataFrame([(3,)], "seed bigint")
    rows = V.two_hops(df, seeds, 0.3).collect()
    seen = {3} | {r["dst"] for r in rows if r["hop"] == 1}
    assert all(r["dst"] not in seen for r in rows if r["hop"] == 2)
    assert V.two_hops(df, seeds, 0.3, keep_back_edges=True).count() > len(rows)


TREE = """# sent_id = 1
1-2\tdu\t_\t_\t_\t_\t_\t_\t_\t_
1\tLe\tle\tDET\t_\t_\t2\tdet\t_\t_
2\tchat\tchat\tNOUN\t_\t_\t3\tnsubj\t_\t_
3\tdort\t_\tVERB\t_\t_\t0\troot\t_\t_
3.1\tx\t_\t_\t_\t_\t_\t_\t_\t_

# sent_id = 2
1\tchat\tchat\tNOUN\t_\t_\t2\tnsubj\t_\t_
2\tdort\tdormir\tVERB\t_\t_\t0\troot\t_\t_
\t_
1\tici\tici\tADV\t_\t_\t0\troot\t_\t_
"""


def test_treebank_rules(spark, tmp_path):
    (tmp_path / "fr_pud-ud-test.conllu").write_text(TREE)
    s = treebank.read_sentences(spark, str(tmp_path))
    assert s.count() == 3 and s.first()["lang"] == "fr"
    pairs = {(r["head_word"], r["child_word"]) for r in treebank.head_pairs(s).collect()}
    assert pairs == {("chat", "Le"), ("dort", "chat")}
    n = {r["head_word"]: r["n_dependents"] for r in treebank.head_counts(treebank.head_pairs(s)).collect()}
    assert n == {"chat": 1, "dort": 2}
    lem = {(r["head_word"], r["child_word"]) for r in treebank.head_pairs(treebank.read_sentences(spark, str(tmp_path), lemma=True)).collect()}
    assert lem == {("chat", "le"), ("dort", "chat"), ("dormir", "chat")}


def test_line_documents_keep_file_order(spark):
    from lodestat.sources.files import read_line_documents
    path = scratch_path(spark, "lines")
    spark.createDataFrame([(f"  Line {i}!  ",) for i in range(30)], "value string").coalesce(1).write.text(path)
    assert [r["text"] for r in read_line_documents(spark, path).orderBy("doc_id").collect()] == [f"line {i}" for i in range(30)]


def test_most_similar_leaves_out_all_members(spark):
    import numpy as np

    from lodestat.operators import similarity
    from lodestat.session import ship

    ship(spark)
    rng = np.random.default_rng(1)
    vectors = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=8)]) for i in range(60)], "id int, vec array<double>")
    asked = spark.createDataFrame([(1, i, 1.0) for i in range(12)] + [(2, 50, 1.0)], "qid int, id int, sign double")
    got = similarity.most_similar(vectors, asked, 5).collect()
    assert sorted(r["qid"] for r in got) == [1] * 5 + [2] * 5
    assert all(r["id"] >= 12 for r in got if r["qid"] == 1) and all(r["id"] != 50 for r in got if r["qid"] == 2)
    assert similarity.similarity_to(vectors, 999).count() == 0


def test_whitespace_table_keeps_every_row(spark, tmp_path):
    from pyspark.errors import PySparkException
    from pyspark.sql import types as T

    from lodestat.sources import files

    schema = T.StructType([T.StructField("K", T.StringType()), T.StructField("V", T.StringType())])
    (tmp_path / "a.txt").write_text("K  V\nx 1\nK z\n\n  y\t\"2\n")
    got = files.read_whitespace_table(spark, str(tmp_path / "a.txt"), schema).collect()
    assert [tuple(r) for r in got] == [("x", "1"), ("K", "z"), ("y", '"2')]
    (tmp_path / "b.txt").write_text("K V\nx 1\n2\n")
    with pytest.raises(PySparkException, match="expected 2 fields"):
        files.read_whitespace_table(spark, str(tmp_path / "b.txt"), schema).collect()


def test_blocks_of_a_search_stay_small_and_keep_ties(spark, monkeypatch):
    rng = np.random.default_rng(12)
    m = rng.normal(size=(400, 8))
    m[100:250] = m[100]  # equal vectors: ties by id
    m /= np.sqrt((m * m).sum(1))[:, None]
    sims = np.round(m @ m.T, V.SIM_DIGITS) + 0.0
    want = [[j for j in np.lexsort((np.arange(400), -sims[i])) if j != i][:7] for i in range(400)]
    monkeypatch.setattr(V, "_CELLS", 1000)
    held = []
    near = V._Best._near
    monkeypatch.setattr(V._Best, "_near", lambda self, rows, ids, v: held.append(len(self.qids[rows]) * len(ids)) or near(self, rows, ids, v))
    best = V._Best(np.arange(400), m, 7, True)
    for at in range(0, 400, 130):
        best.add(np.arange(400)[at:at + 130], m[at:at + 130])
    assert best.ids.reshape(400, 7).tolist() == want and max(held) <= 1000
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)] + [(999, None)], "id long, vec array<double>").repartition(5)
    monkeypatch.setattr(V, "COPIES", 3)
    got = V.top_similar(df, df.toDF("qid", "qvec"), 7, True, query_limit=5, vector_block=4).orderBy("qid", "rank").toPandas()
    assert got["id"].to_numpy().reshape(400, 7).tolist() == want


def test_heads_in_long_and_odd_sentences(spark):
    kind = "lang string, tokens array<struct<id: string, head: string, word: string>>"
    odd = [("2", "5", "a"), ("5", "0", "b"), ("5", "2", "c"), ("7", "x", "d"), ("8", "5", "e"), ("9", "99", "f")]  # gaps, a number twice, heads that are none
    long = [(str(i), str(i // 2), f"w{i}") for i in range(1, 20_001)]
    got = treebank.head_pairs(spark.createDataFrame([("x", odd), ("y", long)], kind)).collect()
    assert sorted((r["head_word"], r["child_word"]) for r in got if r["lang"] == "x") == [("a", "c"), ("b", "a"), ("b", "e")]
    assert {(r["head_word"], r["child_word"]) for r in got if r["lang"] == "y"} == {(f"w{i // 2}", f"w{i}") for i in range(2, 20_001)}


def test_bigram_model_reads_the_texts_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def words(text):
        read.add(1)
        return text.split() if text is not None else None

    docs = spark.createDataFrame([("a b a b",), ("c",), ("",), (None,)], "text string").select(words.asNondeterministic()("text").alias("w"))
    c2, c1, size = X.bigram_model(docs, "w")
    assert {tuple(r) for r in c2.collect()} == {("a", "b", 2), ("b", "a", 1)}
    assert {tuple(r) for r in c1.collect()} == {("a", 2), ("b", 2), ("c", 1)}
    assert tuple(size.first()) == (5, 3) and read.value == 4


def test_token_heads_shuffle_tokens_once_and_count_every_head(spark):
    rows = [(1, 1, 0, "r"), (1, 2, 1, "a"), (1, 3, 1, "b"), (1, 4, 9, "no head"), (2, 5, 0, "s"), (2, 7, 5, "c"), (2, 7, 5, "d"), (2, 8, 7, "e")]
    t = spark.createDataFrame(rows, "s int, i int, h int, w string").repartition(3)
    got = treebank.token_heads(t, ["s"], "i", "h", "w")
    assert sorted(tuple(r) for r in got.collect()) == [
        (1, "r", "a"), (1, "r", "b"), (2, "c", "e"), (2, "d", "e"), (2, "s", "c"), (2, "s", "d")]
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()


def test_treebank_is_written_small_and_documents_that_share_a_key_are_one_sentence(spark, tmp_path):
    from lodestat.plans import inputs
    from lodestat.plans.registry import QUERIES, Tables

    texts = {(1, "en"): ["a b c d"], (2, "en"): ["b a", "c d b"], (2, "de"): ["b b a"], (None, "en"): ["a a", "d"], (3, "en"): [""], (4, "en"): [None]}
    rows = [(k, lang, x, "s", 1) for (k, lang), some in texts.items() for x in some]
    rows += [(10 + i, "fr", "un deux trois quatre " * 100, "s", 1) for i in range(20)]
    spark.createDataFrame(rows, "doc_id long, lang string, text string, source string, n_chars int").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    path = inputs.write_treebank(Tables(spark, str(tmp_path))).removeprefix("file:")
    files = [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.startswith("part-")]
    assert len({os.path.dirname(f) for f in files}) == 3 and sum(map(os.path.getsize, files)) < 20 * 400 * 10
    blocks = [b for f in files for b in gzip.open(f, "rt").read().split("\n\n") if b and "lang=en" in f]
    # every sentence of a key once, in order of place and word; a null number writes no sentence
    want = {"1": "a b c d", "2": "b c a d b"}
    got = {b.split("\n")[0].removeprefix("# doc "): " ".join(x.split("\t")[1] for x in b.split("\n")[2:]) for b in blocks}
    assert got == want and len(blocks) == 2
    counts = {(r["lang"], r["head_word"]): r["n_dependents"] for r in QUERIES["s09_head_counts"](spark, str(tmp_path)).collect()}
    assert sum(v for (lang, _), v in counts.items() if lang == "fr") == 20 * 399
    assert counts["en", "a"] == 2 and sum(v for (lang, _), v in counts.items() if lang == "en") == 3 + 3
