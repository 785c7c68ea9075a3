import collections

import numpy as np
import pytest
from pyspark.sql import types as T

from lodestat.session import scratch_path
from lodestat.streaming import sketches as K
from lodestat.streaming.itemstream import ItemCounter, file_items, integers

SCHEMA = T.StructType([T.StructField("item", T.LongType())])


@pytest.fixture(scope="module")
def folder(spark):
    rng = np.random.default_rng(1)
    path, items = scratch_path(spark, "stream"), []
    for i in range(5):
        part = [int(x) for x in rng.zipf(1.5, 200) % 500]
        items += part
        spark.createDataFrame([(x,) for x in part], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return path, items


def test_stream_equals_batch_and_replay_changes_nothing(spark, folder):
    path, items = folder
    c = ItemCounter(spark).run(file_items(spark, path, SCHEMA, "item"))
    want = collections.Counter(items)
    assert {r["item"]: r["n"] for r in c.histogram().collect()} == want
    assert tuple(c.summary().first()) == (1000, len(want)) and len(c.totals) == 5
    # a batch delivered again under its id replaces itself, also after a restart
    again = ItemCounter(spark, out=c.out)
    assert again.totals == c.totals
    again.handle(_items(spark, c, 3), 3)
    assert {r["item"]: r["n"] for r in again.histogram().collect()} == want


def _items(spark, counter, batch):
    rows = counter.table().filter(f"batch = {batch}").collect()
    return spark.createDataFrame([(r["item"],) for r in rows for _ in range(r["n"])], SCHEMA)


def test_stops_after_the_batch_that_reaches_the_total(spark, folder):
    path, _ = folder
    c = ItemCounter(spark, stop_after=350).run(file_items(spark, path, SCHEMA, "item"))
    assert c.summary().first()["length"] == 400


def test_sketches(spark, folder):
    _, items = folder
    want = collections.Counter(items)
    counts = spark.createDataFrame(list(want.items()), "item bigint, n bigint").cache()
    d, w = 5, 32
    cm = {r["item"]: r["est"] for r in K.estimate_min(counts, K.count_min(counts, d, w), d, w).collect()}
    assert all(cm[i] >= n for i, n in want.items())
    free = {r["item"]: r["est"] for r in K.estimate_median(counts, K.count_sketch(counts, d, w), d, w).collect()}
    tied = {r["item"]: r["est"] for r in K.estimate_median(counts, K.count_sketch(counts, d, w, True), d, w, True).collect()}
    bias = lambda est: np.mean([est[i] - n for i, n in want.items()])
    # independent signs cancel on average, shared ones cannot
    assert abs(bias(free)) < 0.25 * bias(tied)
    halves = [counts.filter("item % 2 = 0"), counts.filter("item % 2 = 1")]
    merged = K.merge(*[K.count_sketch(h, d, w) for h in halves])
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, K.count_sketch(counts, d, w).collect()))


def test_hash_range_and_large_items(spark):
    assert all(1 <= a <= 8189 and 0 <= b <= 8189 for a, b in K.hash_family(50))
    big = spark.createDataFrame([(2 ** 62, 1)], "item bigint, n bigint")
    (a, b), = K.hash_family(1)
    assert K.count_min(big, 1, 100).first()["bucket"] == (a * 2 ** 62 + b) % 8191 % 100


def test_guarded_error(spark):
    h = spark.createDataFrame([(1, 10, 12.0), (2, 10, -5.0)], "item bigint, n bigint, est double")
    assert tuple(K.relative_error(h).first()) == pytest.approx((0.1, 0.85))


def test_lines_that_are_no_integers_are_not_lost_silently(spark):
    lines = spark.createDataFrame([("12",), (" -7 ",), ("",), ("9223372036854775807",)], "value string")
    assert [r["item"] for r in integers(lines).collect()] == [12, -7, 9223372036854775807]
    bad = lines.union(spark.createDataFrame([("x1",), ("3.5",)], "value string"))
    assert [r["item"] for r in integers(bad, strict=False).collect()] == [12, -7, 9223372036854775807]
    with pytest.raises(Exception, match="not an integer: x1"):
        integers(bad).collect()
