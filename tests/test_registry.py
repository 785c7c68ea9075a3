import re

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
COUNTS = {"s": 20, "p": 19, "j": 10, "a": 18, "w": 15, "e": 4, "c": 12, "t": 8, "g": 11, "d": 10, "n": 16, "l": 32, "o": 9, "u": 5}


def test_every_operator_has_a_query():
    keys = {m.group(1) for k in entry.queries() if (m := re.match(r"([a-z]\d\d)", k))}
    want = {f"{f}{i:02d}" for f, n in COUNTS.items() for i in range(1, n + 1)}
    assert want - keys == set() and len(want) == 189


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["objective"] and df.count() == 1


@pytest.mark.parametrize("key", ["p03_above_mean", "a17_boxplot", "c09_balance_search", "g02_network_stats", "l02c_summary", "t08_relative_error"])
def test_small_tables_agree_with_sql(spark, key):
    con = duckdb.connect()
    for t in ("part", "events", "lineitem", "documents"):
        con.sql(f"create view {t} as from '{SF}/{t}.parquet'")
    rel = con.sql(entry.oracle_sql()[key])
    cols = sorted(rel.columns)
    got = sorted(tuple(r[c] for c in cols) for r in entry.queries()[key](spark, SF).collect())
    order = [rel.columns.index(c) for c in cols]
    want = sorted(tuple(r[i] for i in order) for r in rel.fetchall())
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a == pytest.approx(b)
