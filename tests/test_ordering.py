import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodestat.operators import frames, summaries
from lodestat.operators.ordering import average_ranks, exact_quantiles, first_per_key, number_rows, running_total


@pytest.fixture(scope="module")
def skewed(spark):
    # one value and one group hold more than a third of the rows
    rng = np.random.default_rng(3)
    n = 3000
    pdf = pd.DataFrame({"id": range(n), "g": np.where(rng.random(n) < 0.5, "hot", rng.integers(0, 20, n).astype(str)),
                        "v": np.where(rng.random(n) < 0.4, 7.0, rng.normal(size=n).round(2))})
    return pdf, spark.createDataFrame(pdf).repartition(6)


def test_number_rows_is_a_total_order(skewed):
    pdf, df = skewed
    got = number_rows(df, ["v", "id"], "rn", 1).select("id", "rn").toPandas().sort_values("rn")
    assert got["rn"].tolist() == list(range(1, len(pdf) + 1))
    assert got["id"].tolist() == pdf.sort_values(["v", "id"])["id"].tolist()


def test_running_total_by_group(skewed):
    pdf, df = skewed
    got = running_total(df, "v", ["id"], ["g"]).toPandas().sort_values("id")
    want = pdf.sort_values("id").groupby("g")["v"].cumsum()
    assert got["cum"].to_numpy() == pytest.approx(want.sort_index().to_numpy())


def test_exact_quantiles(skewed):
    pdf, df = skewed
    probs = {"a": 0.025, "b": 0.25, "c": 0.5, "d": 0.9}
    one = exact_quantiles(df, "v", probs).first()
    assert [one[k] for k in probs] == pytest.approx(np.quantile(pdf["v"], list(probs.values())).tolist())
    for r in exact_quantiles(df, "v", probs, "g").collect():
        assert [r[k] for k in probs] == pytest.approx(np.quantile(pdf[pdf.g == r["g"]]["v"], list(probs.values())).tolist())


def test_average_ranks_and_first_per_key(skewed):
    pdf, df = skewed
    got = {r["v"]: r["k"] for r in average_ranks(df, "v", "k").collect()}
    want = dict(zip(pdf["v"], pdf["v"].rank()))
    assert got == pytest.approx(want)
    first = {r["g"]: r["id"] for r in first_per_key(df, ["g"], ["id"]).collect()}
    assert first == pdf.groupby("g")["id"].min().to_dict()


def test_ties_at_the_cut(spark):
    c = spark.createDataFrame([("a", 5), ("b", 3), ("c", 3), ("d", 1)], "item string, n bigint")
    assert {r["item"] for r in frames.with_ties_top(c, "n", 2).collect()} == {"a", "b", "c"}
    assert frames.with_ties_top(c, "n", 9).count() == 4


def test_histogram_closes_its_last_bin(spark):
    d = spark.createDataFrame([(float(x),) for x in [0, 0.5, 1, 2, 2]], "x double")
    assert [r["n"] for r in summaries.histogram(d, "x", breaks=[0, 1, 2]).orderBy("bin").collect()] == [2, 3]
    h = summaries.histogram(d, "x", bins=4).orderBy("bin").collect()
    assert [r["n"] for r in h] == [1, 1, 1, 2] and sum(r["density"] * 0.5 for r in h) == pytest.approx(1)


def test_friend_defaults(spark):
    nodes = spark.createDataFrame([("x",), ("y",), ("z",)], "node string")
    edges = spark.createDataFrame([("x", "y", 0.5), ("x", "z", 0.5), ("y", "x", 0.1)], "src string, dst string, score double")
    s = {r["node"]: r for r in summaries.friend_stats(nodes, edges).collect()}
    assert tuple(s["z"])[1:] == (0, -1.0, -1.0, -1.0, -1.0) and s["x"]["n"] == 2
    best = {r["node"]: r["friend"] for r in summaries.best_friend(nodes, edges).collect()}
    assert best == {"x": "y", "y": "x", "z": None}
    asked = spark.createDataFrame([("x",), ("nobody",), ("z",)], "node string")
    assert {r["node"]: r["n_friends"] for r in summaries.out_degree_of(nodes, edges, asked).collect()} == {"x": 2, "nobody": -1, "z": 0}
    assert summaries.top_k_degree(edges, -1).count() == 0


def test_lookups(spark):
    ranked = spark.createDataFrame([(2000, 1, "Ann"), (2000, 2, "Bob")], "year int, rank bigint, name string")
    asked = spark.createDataFrame([(2000, 0), (2000, 2), (2000, 9)], "year int, position bigint")
    got = {r["position"]: r["name"] for r in frames.name_at(ranked, asked).collect()}
    assert got == {0: frames.BAD_POSITION, 2: "Bob", 9: frames.NOT_FOUND}
    assert frames.find_names(ranked, "^A", 2000).first()["name"] == "Ann"
    assert frames.find_names(ranked, "A", 1999).first()["status"] == frames.NO_YEAR
    assert frames.find_names(ranked, "zzz", 2000).count() == 0
    p = spark.createDataFrame([(0.0,), (1.0,), (0.5,)], "p double").select(frames.format_pvalue(F.col("p")))
    assert [r[0] for r in p.collect()] == ["<10^-4", ">1-10^-4", "0.5000 ± 0.0050"]


def test_token_and_substring_membership(spark):
    d = spark.createDataFrame([("The cat sat",)], "t string")
    f = d.select(frames.word_in_document(F.col("t"), "CAT"), frames.word_in_document(F.col("t"), "ca"), frames.word_in_document(F.col("t"), "ca", "substring")).first()
    assert tuple(f) == (True, False, True)


def test_four_decimals_are_rounded_by_the_binary_value(spark):
    rng = np.random.default_rng(8)
    # halves that binary fractions hit, decimals just above or below a half, and random shares
    values = [k / 32 for k in range(33)] + [k / 10000 + 0.00005 for k in range(0, 10000, 7)] + rng.random(3000).tolist() + [1e-9, 4.9999e-5, 5e-5, 0.99995, 0.99999]
    got = spark.createDataFrame([(v,) for v in values], "x double").select("x", frames.fixed_four(F.col("x")).alias("t")).collect()
    assert [(r["x"], r["t"]) for r in got if r["t"] != f"{r['x']:.4f}"] == []
    p = spark.createDataFrame([(1 / 32,)], "p double").select(frames.format_pvalue(F.col("p"))).first()[0]
    assert p == "0.0312 ± 0.0017"
