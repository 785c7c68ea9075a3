"""Stream queries over the event table and sketches over item counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestat.plans.registry import query
from lodestat.plans.tabular import r
from lodestat.session import cut, scratch_path
from lodestat.streaming import sketches as K
from lodestat.streaming import windows as W

DEPTH, WIDTH = 5, 64


# files that arrive one after the other; a batch of counts is a day of event time
FILES, STOP_AFTER = 4, 2500


def _windows(t, stop_after=None) -> W.WindowedCounts:
    """Counts per day of event time, from files that arrive in the order of time."""
    rows = t.events.select("ts", "user_id")
    path, delay = W.arriving(rows, "ts", FILES)
    return W.WindowedCounts(t.spark, delay=delay, stop_after=stop_after).run(W.timed_items(t.spark, path, rows.schema, "ts", "user_id"))


def _running(t) -> W.RunningHistogram:
    """Counts of all items in the state store; here the order of files is of no matter."""
    path = scratch_path(t.spark, "arriving")
    t.events.select("ts", "user_id").repartition(FILES).write.parquet(path)
    return W.RunningHistogram(t.spark).run(W.timed_items(t.spark, path, t.events.select("ts", "user_id").schema, "ts", "user_id"))


@query("s14_item_stream", "SELECT count(*) AS length, count(DISTINCT user_id) AS distinct_items FROM events")
def s14(t):
    return _running(t).summary()


@query("t01_batch_counts", """WITH d AS (SELECT date_trunc('day', ts) AS d, user_id AS item FROM events)
 SELECT CAST(date_diff('day', (SELECT min(d) FROM d), d) AS INTEGER) AS batch, item, count(*) AS n FROM d GROUP BY ALL""")
def t01(t):
    rows = cut(_windows(t).table())
    return rows.select(F.date_diff("start", rows.agg(F.min("start")).scalar()).alias("batch"), "item", "n")


_KEPT = f"""WITH d AS (SELECT date_trunc('day', ts) AS d, user_id AS item FROM events), w AS (SELECT d, count(*) AS n FROM d GROUP BY 1),
 k AS (SELECT d FROM (SELECT d, sum(n) OVER (ORDER BY d) - n AS ahead FROM w) WHERE ahead < {STOP_AFTER})"""


@query("t02_stop_after_items", f"{_KEPT} SELECT count(*) AS length, count(DISTINCT item) AS distinct_items, count(DISTINCT d) AS batches, (SELECT count(*) FROM events) > count(*) AS dropped FROM d JOIN k USING (d)")
def t02(t):
    counted = _windows(t, STOP_AFTER)
    kept = cut(counted.kept())
    total = t.events.agg(F.count(F.lit(1))).scalar()
    return kept.agg(F.sum("n").alias("length"), F.count_distinct("item").alias("distinct_items"), F.count_distinct("start").alias("batches"),
                    (total > F.sum("n")).alias("dropped"))


@query("t03_running_histogram", "SELECT user_id AS item, count(*) AS n FROM events GROUP BY 1")
def t03(t):
    return _running(t).histogram()


def _h(ab, buckets, x="item"):
    return f"((({x} % 8191) * {ab[0]} + {ab[1]}) % 8191) % {buckets}"


def _items(t):
    return t.lineitem.select(F.col("l_partkey").alias("item"))


_COUNTS_SQL = "cnt AS (SELECT l_partkey AS item, count(*) AS n FROM lineitem GROUP BY 1)"


def _cells_sql(signs):
    rows = " UNION ALL ".join(
        f"SELECT item, n, {j} AS j, {_h(ab, WIDTH)} AS bucket, {'1' if signs is None else _h(signs[j], 2) + ' * 2 - 1'} AS sign FROM cnt"
        for j, ab in enumerate(K.hash_family(DEPTH)))
    return f"{_COUNTS_SQL}, hr AS ({rows}), cells AS (SELECT j, bucket, CAST(sum(n * sign) AS BIGINT) AS c FROM hr GROUP BY 1, 2)"


_CM, _CS, _CSH = _cells_sql(None), _cells_sql(K.sign_family(DEPTH, False)), _cells_sql(K.sign_family(DEPTH, True))
_EST_CM = _CM + ", est AS (SELECT item, any_value(n) AS n, CAST(min(c) AS DOUBLE) AS est FROM hr JOIN cells USING (j, bucket) GROUP BY 1)"
_EST_CS = _CS + ", est AS (SELECT item, any_value(n) AS n, median(c * sign) AS est FROM hr JOIN cells USING (j, bucket) GROUP BY 1)"
_EST_CSH = _CSH + ", est AS (SELECT item, any_value(n) AS n, median(c * sign) AS est FROM hr JOIN cells USING (j, bucket) GROUP BY 1)"
_TOP = "top AS (SELECT item, n, est FROM (SELECT *, rank() OVER (ORDER BY n DESC) AS k FROM est) WHERE k <= 10)"


@query("t04_hash_family", "WITH i AS (SELECT DISTINCT user_id AS item FROM events) " + " UNION ALL ".join(
    f"SELECT item, CAST({j} AS INTEGER) AS j, {_h(ab, WIDTH)} AS bucket FROM i" for j, ab in enumerate(K.hash_family(DEPTH))))
def t04(t):
    i = t.events.select(F.col("user_id").alias("item")).distinct()
    return i.select("item", F.inline(F.array(*[
        F.struct(F.lit(j).alias("j"), K.hashed(F.col("item"), ab, WIDTH).alias("bucket")) for j, ab in enumerate(K.hash_family(DEPTH))])))


@query("t05_count_min", f"WITH {_CM} SELECT CAST(j AS INTEGER) AS j, bucket, c FROM cells")
def t05(t):
    return K.sketch(_items(t), DEPTH, WIDTH)


@query("t05b_count_min_estimates", f"WITH {_EST_CM} SELECT item, est FROM est")
def t05b(t):
    return K.estimate_min(_items(t).distinct(), K.sketch(_items(t), DEPTH, WIDTH), DEPTH, WIDTH)


@query("t06_count_sketch", f"WITH {_EST_CS} SELECT item, est FROM est")
def t06(t):
    return K.estimate_median(_items(t).distinct(), K.sketch(_items(t), DEPTH, WIDTH, signed=True), DEPTH, WIDTH)


@query("t06b_count_sketch_shared_hash", f"WITH {_EST_CSH} SELECT item, est FROM est")
def t06b(t):
    return K.estimate_median(_items(t).distinct(), K.sketch(_items(t), DEPTH, WIDTH, signed=True, shared_hash=True), DEPTH, WIDTH, True)


@query("t07_heavy_hitters", f"WITH {_EST_CM}, {_TOP} SELECT item, n, est FROM top")
def t07(t):
    return K.heavy_hitters(_items(t), K.sketch(_items(t), DEPTH, WIDTH), 10, DEPTH, WIDTH)


@query("t08_relative_error", " UNION ALL ".join(
    f"""SELECT '{kind}' AS kind, round(guarded, 6) AS guarded_error, round(plain, 6) AS plain_error FROM (WITH {sql}, {_TOP}
     SELECT avg(CASE WHEN est > 0 THEN abs(n - est) / n ELSE 0 END) AS guarded, avg(abs(n - est) / n) AS plain FROM top)"""
    for kind, sql in (("min", _EST_CM), ("median", _EST_CS))))
def t08(t):
    out, top = None, cut(K.frequent(_items(t), 10))  # with their exact counts
    for kind, cells in (("min", K.sketch(_items(t), DEPTH, WIDTH)), ("median", K.sketch(_items(t), DEPTH, WIDTH, signed=True))):
        e = K.relative_error(K.heavy_hitters(top, cells, 10, DEPTH, WIDTH, kind)).select(
            F.lit(kind).alias("kind"), r("guarded_error").alias("guarded_error"), r("plain_error").alias("plain_error"))
        out = e if out is None else out.unionByName(e)
    return out
