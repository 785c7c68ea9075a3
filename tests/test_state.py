"""Streams with a state store, and sketches from raw items."""

import collections
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestat.operators.frames import with_ties_top
from lodestat.streaming import sketches as K
from lodestat.streaming import windows as W

DAY = dt.datetime(2024, 3, 1)


@pytest.fixture(scope="module")
def events(spark):
    rng = np.random.default_rng(2)
    rows = [(DAY + dt.timedelta(minutes=int(m)), int(i)) for m, i in zip(np.sort(rng.integers(0, 5 * 1440, 600)), rng.zipf(1.6, 600) % 40)]
    df = spark.createDataFrame(rows, "ts timestamp, item long")
    extra = spark.createDataFrame([(None, 3), (DAY, None)], "ts timestamp, item long")
    path, delay = W.arriving(df.repartition(5), "ts", 2)
    assert delay.endswith("seconds")
    extra.coalesce(1).write.mode("append").parquet(path)
    return rows, df.schema, (path, delay)


def _per_day(rows):
    return collections.Counter(((t - DAY).days, i) for t, i in rows)


def _table(df):
    return {((r["start"] - DAY).days, r["item"]): r["n"] for r in df.collect()}


def test_windows_survive_a_kill(spark, events, monkeypatch):
    rows, schema, (path, delay) = events
    first = W.WindowedCounts(spark, delay=delay).run(W.timed_items(spark, path, schema, "ts", "item"), most_batches=1)
    part = sum(r["n"] for r in first.table().collect())
    assert 0 < part < len(rows)
    again = W.WindowedCounts(spark, delay=delay, folder=first.folder).run(W.timed_items(spark, path, schema, "ts", "item"))
    assert _table(again.table()) == _per_day(rows) and again.late == 0
    closed = {(r["start"] - DAY).days for r in again.closed().select("start").distinct().collect()}
    assert closed and closed < {0, 1, 2, 3, 4}  # the last days are still open, in the state store
    late = W.WindowedCounts(spark).run(W.timed_items(spark, path, schema, "ts", "item"))  # no delay: later files of a write come too late
    assert late.late > 0 and late.summary().first()["length"] < len(rows)
    assert tuple(again.summary().first()) == (len(rows), len({i for _, i in rows}))


def test_batches_beyond_the_total_are_dropped(spark, events):
    rows, schema, (path, delay) = events
    got = W.WindowedCounts(spark, delay=delay, stop_after=200).run(W.timed_items(spark, path, schema, "ts", "item"))
    per_day = collections.Counter((t - DAY).days for t, _ in rows)
    kept, total = [], 0
    for d in sorted(per_day):
        if total < 200:
            kept.append(d)
            total += per_day[d]
    assert {k for k, _ in _table(got.kept())} == set(kept) and len(kept) < 5
    assert got.summary().first()["length"] == total >= 200


def test_running_histogram_goes_on_after_a_restart(spark, events):
    rows, schema, (path, delay) = events
    h = W.RunningHistogram(spark).run(W.timed_items(spark, path, schema, "ts", "item"), most_batches=1)
    before = h.summary().first()["length"]
    again = W.RunningHistogram(spark, h.folder).run(W.timed_items(spark, path, schema, "ts", "item"))
    assert 0 < before < len(rows)
    assert {r["item"]: r["n"] for r in again.histogram().collect()} == collections.Counter(i for _, i in rows)
    assert W.RunningHistogram(spark).histogram().count() == 0 and W.WindowedCounts(spark).table().count() == 0


@pytest.mark.parametrize("flat", [False, True])
def test_sketches_of_raw_items_equal_those_of_counts(spark, flat):
    rng = np.random.default_rng(7)
    items = rng.permutation(np.repeat(np.arange(400), 5)) if flat else rng.zipf(1.4, 2000) % 5000
    items = [int(x) * (-1) ** int(x % 7 == 0) for x in items]
    raw = spark.createDataFrame([(x,) for x in items] + [(None,)], "item long").repartition(5)
    counts = raw.filter("item is not null").groupBy("item").agg(F.count(F.lit(1)).alias("n")).cache()
    rows = lambda df: sorted(map(tuple, df.select("j", "bucket", "c").collect()))
    assert rows(K.sketch(raw, 4, 32)) == rows(K.count_min(counts, 4, 32))
    for shared in (False, True):
        assert rows(K.sketch(raw, 4, 32, True, shared)) == rows(K.count_sketch(counts, 4, 32, shared))
    want = sorted(map(tuple, with_ties_top(counts, "n", 10).select("item", "n").collect()))
    for capacity, width in ((1024, 2048), (20, 64), (3, 8)):  # small ones leave more rows to count, never fewer items
        assert sorted(map(tuple, K.frequent(raw, 10, 4, width, capacity).select("item", "n").collect())) == want
    least = {r["item"]: r["least"] for r in K.candidates(raw, 20).collect()}
    true = collections.Counter(items)
    assert all(n <= true[i] for i, n in least.items()) and len(least) <= 5 * 20
    plan = K.frequent(raw, 10)._jdf.queryExecution().optimizedPlan().toString()
    assert "cells" in plan  # the sketch filters before anything is counted
    assert K.frequent(raw.limit(0), 3).count() == 0 and K.sketch(raw.limit(0), 2, 8).count() == 0
    counts.unpersist()
