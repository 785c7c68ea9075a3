import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestat.operators import linkdegrees as L


def _texts():
    rng = np.random.default_rng(5)
    rows = [("ab"[k % 2], [f"w{int(i)}" for i in rng.integers(0, 40, int(rng.integers(0, 60)))]) for k in range(200)]
    return [*rows, ("a", ["x", "x", "x"]), ("c", ["alone"]), ("a", None), (None, ["p", "q", "p"])]


def _expected(rows, directed):
    links = {(g, *((x, y) if directed else sorted((x, y)))) for g, w in rows for x, y in zip(w or [], (w or [])[1:]) if directed or x != y}
    out = {}
    for g, x, y in links:
        for word in ((x,) if directed else (x, y)):
            out[g, word] = out.get((g, word), 0) + 1
    return sorted((g or "", n) for (g, _), n in out.items())


@pytest.mark.parametrize("directed", [True, False])
def test_degrees_are_those_of_distinct_links(spark, directed, monkeypatch):
    monkeypatch.setattr(L, "PIECE", 7)  # long texts are cut, and no link is lost or made
    rows = _texts()
    d = spark.createDataFrame(rows, "lang string, words array<string>").repartition(3)
    got = L.link_degrees(d, "lang", "words", directed, room=500).collect()
    assert sorted((r["lang"] or "", r["degree"]) for r in got) == _expected(rows, directed)


def test_another_hash_is_taken_if_words_share_a_number(spark):
    rows = _texts()
    d = spark.createDataFrame(rows, "lang string, words array<string>")

    def code(seed, w):
        w = F.col(w) if isinstance(w, str) else w
        return F.when(seed == 0, F.xxhash64(F.substring(w, 1, 2))).otherwise(F.xxhash64(seed, w))

    got = L.link_degrees(d, "lang", "words", True, code=code).collect()
    assert sorted((r["lang"] or "", r["degree"]) for r in got) == _expected(rows, True)


def test_the_queries_make_no_row_for_each_link(spark, monkeypatch):
    from lodestat.plans import fits, graphs
    from lodestat.plans.registry import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(graphs.S, "word_links", lambda t: pytest.fail("links as rows"))
    assert fits.d05(t).count() == graphs.g02(t).count() == graphs.g03(t).select("lang").distinct().count() > 0
