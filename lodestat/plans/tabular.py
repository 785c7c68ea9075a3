"""Projections, filters, joins, aggregations, order-based and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestat.operators import frames, summaries
from lodestat.operators.ordering import exact_quantiles, number_rows, running_total, top_per_key
from lodestat.plans import standins as S
from lodestat.plans.registry import query
from lodestat.session import per_group


def r(col, digits=6):
    return F.round(col, digits)


# --- projections and filters -----------------------------------------------------

@query("p01_project_names", f"WITH {S.RECORDS_SQL} SELECT name FROM rec")
def p01(t):
    return S.records(t).select("name")


@query("p02_range_filter", """SELECT CASE WHEN l_quantity BETWEEN 10 AND 25 THEN 'inclusive' ELSE 'half_open' END AS slice,
 l_returnflag, count(*) AS n, round(sum(l_extendedprice), 2) AS total FROM lineitem
 WHERE (l_quantity >= 10 AND l_quantity <= 25 AND l_returnflag = 'A') OR (l_quantity >= 30 AND l_quantity < 40) GROUP BY ALL""")
def p02(t):
    q = F.col("l_quantity")
    inclusive = q.between(10, 25) & (F.col("l_returnflag") == "A")
    half_open = (q >= 30) & (q < 40)
    return (t.lineitem.filter(inclusive | half_open)
            .groupBy(F.when(q.between(10, 25), "inclusive").otherwise("half_open").alias("slice"), "l_returnflag")
            .agg(F.count(F.lit(1)).alias("n"), r(F.sum("l_extendedprice"), 2).alias("total")))


@query("p03_above_mean", """SELECT p_partkey, p_brand, p_size FROM part
 WHERE p_size > (SELECT avg(p_size) FROM part) AND p_brand = 'Brand#2'""")
def p03(t):
    return frames.above_mean(t.part, "p_size", F.col("p_brand") == "Brand#2").select("p_partkey", "p_brand", "p_size")


@query("p04_split_by_other_mean", """SELECT s_suppkey, s_acctbal,
 CASE WHEN s_acctbal < (SELECT avg(c_acctbal) FROM customer) THEN 'lower' ELSE 'ge' END AS side FROM supplier""")
def p04(t):
    return frames.split_by_mean_of(t.supplier, "s_acctbal", t.customer, "c_acctbal").select("s_suppkey", "s_acctbal", "side")


@query("p05_at_minimum", "SELECT p_partkey, p_name, p_size FROM part WHERE p_size = (SELECT min(p_size) FROM part)")
def p05(t):
    return frames.at_minimum(t.part, "p_size").select("p_partkey", "p_name", "p_size")


@query("p06_equality_count", "SELECT count(*) AS n FROM events WHERE event_type = 'purchase'")
def p06(t):
    return t.events.filter(F.col("event_type") == "purchase").agg(F.count(F.lit(1)).alias("n"))


@query("p07_drop_nulls", """SELECT d.doc_id, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
 WHERE quality IS NOT NULL AND toxic IS NOT NULL""")
def p07(t):
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left").na.drop(subset=["quality", "toxic"])


@query("p08_drop_duplicates", """SELECT c_nationkey, c_mktsegment, c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS "row"
 FROM (SELECT c_nationkey, c_mktsegment, min(c_custkey) AS c_custkey FROM customer GROUP BY ALL)""")
def p08(t):
    d = t.customer.select("c_nationkey", "c_mktsegment", "c_custkey")
    return frames.drop_duplicates_keep_first(d, ["c_nationkey", "c_mktsegment"], ["c_custkey"])


@query("p09_recode", """SELECT doc_id, CASE WHEN lower(text) LIKE '%licen%' THEN 1 ELSE 0 END AS licensed,
 CASE lang WHEN 'en' THEN 1 WHEN 'de' THEN -1 ELSE 0 END AS lang_code FROM documents""")
def p09(t):
    return t.documents.select("doc_id", frames.contains_word_flag(F.col("text"), "licen").alias("licensed"),
                              frames.recode(F.col("lang"), {"en": 1, "de": -1}, 0).alias("lang_code"))




def row_hash_sql(key: str) -> str:
    return f"(((({key}) * 48271 + 11) % 2147483647) * 48271 + 11) % 2147483647"


@query("p10_hide_labels", f"""SELECT doc_id, quality, {row_hash_sql('doc_id')} < {int(0.9 * 2147483647)} AS hidden FROM labels""")
def p10(t):
    return frames.hide_labels(t.labels.select("doc_id", "quality"), "doc_id", 0.9)


@query("p11_sample_rows", f"SELECT doc_id, lang FROM documents ORDER BY {row_hash_sql('doc_id')}, doc_id LIMIT 10")
def p11(t):
    return frames.sample_rows(t.documents.select("doc_id", "lang"), "doc_id", 10)


@query("p12_derived_columns", """SELECT p_partkey, round((p_size - 32) * 5.0 / 9, 6) AS celsius, round(ln(p_retailprice), 6) AS log_price,
 p_size * p_size AS size2, round(p_size * p_retailprice, 4) AS size_price FROM part""")
def p12(t):
    s, p = F.col("p_size"), F.col("p_retailprice")
    return t.part.select("p_partkey", r((s - 32) * 5.0 / 9).alias("celsius"), r(F.log(p)).alias("log_price"),
                         (s * s).alias("size2"), r(s * p, 4).alias("size_price"))


@query("p13_regex_clean", r"""SELECT doc_id, md5(replace(regexp_replace(lower(text), '[!"#%&()*,./:;?@\[\]{}]', '', 'g'), chr(10), ' ')) AS cleaned FROM documents""")
def p13(t):
    return t.documents.select("doc_id", F.md5(F.translate(
        F.regexp_replace(F.lower("text"), r'[!"#%&()*,./:;?@\[\]{}]', ""), "\n", " ")).alias("cleaned"))


@query("p14_date_split", """SELECT CASE WHEN CAST(o_orderdate AS DATE) <= DATE '1997-06-30' THEN 'early' ELSE 'late' END AS period,
 count(*) AS n, CAST(min(o_orderdate) AS DATE)::VARCHAR AS first_day, CAST(max(o_orderdate) AS DATE)::VARCHAR AS last_day FROM orders GROUP BY 1""")
def p14(t):
    text = t.orders.select(F.date_format("o_orderdate", "M/d/yyyy").alias("day"))
    return (frames.split_at_date(text, "day", "M/d/yyyy", "1997-06-30").groupBy("period")
            .agg(F.count(F.lit(1)).alias("n"), F.min("date").cast("string").alias("first_day"), F.max("date").cast("string").alias("last_day")))


@query("p15_word_in_document", r"""SELECT ids.vec_id AS doc_id, coalesce(list_contains(regexp_split_to_array(lower(text), '\s+'), 'que'), false) AS found
 FROM embeddings ids LEFT JOIN documents d ON d.doc_id = ids.vec_id""")
def p15(t):
    return frames.word_in_documents(t.documents, t.embeddings.select(F.col("vec_id").alias("doc_id")), "doc_id", "text", "que")


@query("p16_format_pvalue", """SELECT l_suppkey, CASE WHEN p = 0 THEN '<10^-4' WHEN p = 1 THEN '>1-10^-4'
 ELSE printf('%.4f ± %.4f', p, sqrt(p * (1 - p) / 10000.0)) END AS p_text
 FROM (SELECT l_suppkey, CAST(count(*) FILTER (l_returnflag = 'R' AND l_quantity > 45) AS DOUBLE) / count(*) AS p FROM lineitem GROUP BY 1)""")
def p16(t):
    p = t.lineitem.groupBy("l_suppkey").agg(
        (F.count_if((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45)) / F.count(F.lit(1))).alias("p"))
    return p.select("l_suppkey", frames.format_pvalue(F.col("p")).alias("p_text"))


@query("p17_find_names", f"""WITH {S.RANKED_SQL} SELECT "rank", name, 'ok' AS status FROM ranked WHERE "year" = 1997 AND regexp_matches(name, '7[05]$')""")
def p17(t):
    return frames.find_names(S.ranked_names(t), "7[05]$", 1997)


@query("p17b_find_names_empty_year", "SELECT CAST(NULL AS BIGINT) AS \"rank\", CAST(NULL AS VARCHAR) AS name, 'Year not found' AS status")
def p17b(t):
    return frames.find_names(S.ranked_names(t), "7", 1901)


@query("p18_name_at_position", f"""WITH {S.RANKED_SQL}, asked AS (SELECT DISTINCT "year", p AS "position" FROM rec, (VALUES (0), (1), (10), (100000000)) v(p))
 SELECT a."year", a."position", CASE WHEN a."position" < 1 THEN 'Position must be greater than zero' ELSE coalesce(name, 'Not Found') END AS name
 FROM asked a LEFT JOIN ranked q ON a."year" = q."year" AND a."position" = q."rank" """)
def p18(t):
    ranked = S.ranked_names(t)
    asked = ranked.select("year").distinct().select("year", F.explode(F.array(*[F.lit(p) for p in (0, 1, 10, 100000000)])).alias("position"))
    return frames.name_at(ranked, asked)


@query("p19_replace_year", f"""WITH {S.RANKED_SQL} SELECT "year", "rank", name FROM ranked WHERE "year" <> 1996
 UNION ALL SELECT 1996, "rank", upper(name) FROM ranked WHERE "year" = 1997""")
def p19(t):
    ranked = S.ranked_names(t)
    new = ranked.filter("year = 1997").select("rank", F.upper("name").alias("name"))
    return frames.replace_year(ranked, new, 1996)


# --- joins -------------------------------------------------------------------------

@query("j01_equi_join", """SELECT n_name, count(*) AS n, round(avg(c_acctbal), 6) AS mean_bal FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def j01(t):
    return (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name")
            .agg(F.count(F.lit(1)).alias("n"), r(F.avg("c_acctbal")).alias("mean_bal")))


@query("j02_names_not_in_set", f"""WITH {S.RECORDS_SQL} SELECT DISTINCT name FROM rec WHERE "year" = 1997
 AND name NOT IN (SELECT name FROM rec WHERE "year" = 1996)""")
def j02(t):
    rec = S.records(t)
    return frames.anti(rec.filter("year = 1997"), rec.filter("year = 1996"), ["name"])


@query("j05_pair_by_position", f"""WITH {S.RECORDS_SQL},
 f AS (SELECT name, row_number() OVER (ORDER BY id) AS pos FROM rec WHERE sex = 'FEMALE'),
 m AS (SELECT name, row_number() OVER (ORDER BY id) AS pos FROM rec WHERE sex = 'MALE')
 SELECT f.pos, f.name AS female, m.name AS male FROM f JOIN m USING (pos) WHERE pos <= 5""")
def j05(t):
    rec = S.records(t)
    f = rec.filter("sex = 'FEMALE'").select("id", F.col("name").alias("female"))
    m = rec.filter("sex = 'MALE'").select("id", F.col("name").alias("male"))
    return frames.pair_by_position(f, ["id"], m, ["id"], 5).select("pos", "female", "male")


@query("j06_attach_metric", """SELECT d.doc_id, d.lang, round(m.mean_chars, 6) AS mean_chars FROM documents d
 JOIN (SELECT lang, avg(n_chars) AS mean_chars FROM documents GROUP BY 1) m ON d.lang = m.lang""")
def j06(t):
    metric = per_group(t.documents.groupBy("lang").agg(r(F.avg("n_chars")).alias("mean_chars")))
    return t.documents.select("doc_id", "lang").join(metric, "lang")


# --- aggregations --------------------------------------------------------------------

@query("a01_group_counts", f"WITH {S.POINTS_SQL} SELECT g AS grp, count(grp) AS n FROM (VALUES ('A'), ('B'), ('C')) v(g) LEFT JOIN pts ON g = grp GROUP BY 1")
def a01(t):
    groups = ["A", "B", "C"]
    row = S.points(t).agg(*[F.count_if(F.col("grp") == g).alias(g) for g in groups])
    return row.select(F.inline(F.array(*[F.struct(F.lit(g).alias("grp"), F.col(g).alias("n")) for g in groups])))


@query("a02_slice_stats", """SELECT count(*) AS n, min(p_size) AS min, max(p_size) AS max, round(avg(p_size), 6) AS mean, median(p_size) AS median
 FROM part WHERE p_type = 'ECONOMY' AND p_retailprice > (SELECT avg(p_retailprice) FROM part)""")
def a02(t):
    s = frames.above_mean(t.part, "p_retailprice", F.col("p_type") == "ECONOMY")
    return summaries.spread(s, "p_size").withColumn("mean", r("mean"))


@query("a03_slice_mean_median", """SELECT round(avg(o_totalprice), 4) AS mean, round(median(o_totalprice), 4) AS median FROM orders JOIN customer ON o_custkey = c_custkey
 WHERE c_mktsegment = 'BUILDING' AND o_orderstatus = 'F' AND c_nationkey BETWEEN 3 AND 18 AND c_acctbal > (SELECT avg(c_acctbal) FROM customer)""")
def a03(t):
    rich = frames.above_mean(t.customer, "c_acctbal", (F.col("c_mktsegment") == "BUILDING") & F.col("c_nationkey").between(3, 18))
    rows = t.orders.filter("o_orderstatus = 'F'").join(rich, F.col("o_custkey") == F.col("c_custkey"))
    return summaries.spread(rows, "o_totalprice").select(r("mean", 4).alias("mean"), r("median", 4).alias("median"))


@query("a04_mean_for_key", """SELECT k AS nation, round(avg(c_acctbal), 6) AS mean FROM (VALUES (7), (99)) v(k) LEFT JOIN customer ON c_nationkey = k GROUP BY 1""")
def a04(t):
    def one(k):
        return t.customer.filter(F.col("c_nationkey") == k).agg(r(F.avg("c_acctbal")).alias("mean")).select(F.lit(k).alias("nation"), "mean")
    return one(7).unionByName(one(99))


@query("a05_maximum", "SELECT max(length(url)) AS longest FROM pages")
def a05(t):
    return t.pages.agg(F.max(F.length("url")).cast("bigint").alias("longest"))


@query("a06_friend_stats", f"""WITH {S.FRIENDS_SQL} SELECT node, count(score) AS n, round(coalesce(min(score), -1), 6) AS min, round(coalesce(max(score), -1), 6) AS max,
 round(coalesce(avg(score), -1), 6) AS mean, round(coalesce(median(score), -1), 6) AS median FROM nodes LEFT JOIN friends ON node = src GROUP BY 1""")
def a06(t):
    nodes, edges = S.friends(t)
    return summaries.friend_stats(nodes, edges).select("node", "n", *[r(c).alias(c) for c in ("min", "max", "mean", "median")])


@query("a07_mean_with_having", f"WITH {S.FRIENDS_SQL} SELECT src AS node, round(avg(score), 6) AS mean FROM friends GROUP BY 1 HAVING count(*) >= 2")
def a07(t):
    _, edges = S.friends(t)
    return (edges.groupBy(F.col("src").alias("node")).agg(r(F.avg("score")).alias("mean"), F.count(F.lit(1)).alias("n"))
            .filter("n >= 2").select("node", "mean"))


@query("a08_out_degree", f"""WITH {S.FRIENDS_SQL}, asked AS (SELECT node FROM nodes UNION ALL SELECT 'NOWHERE'),
 d AS (SELECT node, count(src) AS n FROM nodes LEFT JOIN friends ON node = src GROUP BY 1)
 SELECT a.node, coalesce(n, -1) AS n_friends, coalesce(n, -1) > 2 AS more_than_2,
  EXISTS (SELECT 1 FROM friends f WHERE f.src = a.node AND f.dst = 'NATION_3') AS friend_of_3 FROM asked a LEFT JOIN d ON a.node = d.node""")
def a08(t):
    nodes, edges = S.friends(t)
    asked = nodes.unionByName(t.nation.limit(1).select(F.lit("NOWHERE").alias("node")))
    deg = summaries.out_degree_of(nodes, edges, asked)
    to3 = edges.filter("dst = 'NATION_3'").select(F.col("src").alias("node"), F.lit(True).alias("hit"))
    return deg.join(to3, "node", "left").select(
        "node", "n_friends", (F.col("n_friends") > 2).alias("more_than_2"), F.coalesce("hit", F.lit(False)).alias("friend_of_3"))


@query("a09_mean_doc_length", r"""SELECT round(coalesce(avg(len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> ''))), 0), 6) AS mean_len FROM documents""")
def a09(t):
    return t.documents.agg(r(F.coalesce(F.avg(F.size(F.filter(F.split("text", r"\s+"), lambda x: x != ""))), F.lit(0.0))).alias("mean_len"))


@query("a10_word_length_stats", r"""SELECT doc_id, min(length(w)) AS min, max(length(w)) AS max, round(avg(length(w)), 6) AS mean, round(stddev_pop(length(w)), 6) AS std
 FROM (SELECT doc_id, unnest(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS w FROM documents) GROUP BY 1""")
def a10(t):
    # a document is one row, so its statistics are array folds: nothing is shuffled
    lens = F.transform(F.filter(F.split("text", r"\s+"), lambda x: x != ""), lambda x: F.length(x).cast("bigint"))
    d = t.documents.select("doc_id", lens.alias("v")).filter(F.size("v") > 0)
    total = F.aggregate("v", F.lit(0).cast("bigint"), lambda s, x: s + x)
    d = d.withColumn("mean", total / F.size("v"))
    var = F.aggregate("v", F.lit(0.0), lambda s, x: s + (x - F.col("mean")) * (x - F.col("mean"))) / F.size("v")
    return d.select("doc_id", F.array_min("v").alias("min"), F.array_max("v").alias("max"), r("mean").alias("mean"), r(F.sqrt(var)).alias("std"))


@query("a12_five_numbers", """SELECT l_returnflag, count(*) AS n, min(l_extendedprice) AS min, round(quantile_cont(l_extendedprice, 0.25), 4) AS q1, round(median(l_extendedprice), 4) AS median,
 round(quantile_cont(l_extendedprice, 0.75), 4) AS q3, max(l_extendedprice) AS max, round(avg(l_extendedprice), 4) AS mean FROM lineitem GROUP BY 1""")
def a12(t):
    out = summaries.five_numbers(t.lineitem, "l_extendedprice", "l_returnflag")
    return out.select("l_returnflag", "n", "min", r("q1", 4).alias("q1"), r("median", 4).alias("median"), r("q3", 4).alias("q3"), "max", r("mean", 4).alias("mean"))


@query("a13_histogram", """WITH e AS (SELECT min(o_totalprice) AS lo, (max(o_totalprice) - min(o_totalprice)) / 40 AS w, max(o_totalprice) AS hi FROM orders),
 b AS (SELECT i AS bin, lo + i * w AS a, CASE WHEN i = 39 THEN hi ELSE lo + (i + 1) * w END AS z FROM e, range(40) t(i))
 SELECT CAST(bin AS INTEGER) AS bin, round(a, 4) AS lo, round(z, 4) AS hi, count(o_orderkey) AS n, round(count(o_orderkey) / ((SELECT count(*) FROM orders) * (z - a)), 12) AS density
 FROM b LEFT JOIN orders ON o_totalprice >= a AND (o_totalprice < z OR (bin = 39 AND o_totalprice <= z)) GROUP BY bin, a, z""")
def a13(t):
    return summaries.histogram(t.orders, "o_totalprice", bins=40).select("bin", r("lo", 4).alias("lo"), r("hi", 4).alias("hi"), "n", r("density", 12).alias("density"))


@query("a14_covariance", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(covar_samp({a}, {b}), 4) AS cov, round(corr({a}, {b}), 6) AS cor FROM lineitem"
    for a in ("l_quantity", "l_extendedprice", "l_discount") for b in ("l_quantity", "l_extendedprice", "l_discount")))
def a14(t):
    return summaries.covariances(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"]).select("a", "b", r("cov", 4).alias("cov"), r("cor").alias("cor"))


@query("a15_cross_table", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL")
def a15(t):
    return summaries.cross_table(t.lineitem, "l_returnflag", "l_linestatus")


@query("a16_simulated_interval", """SELECT event_type, count(*) AS n, round(quantile_cont(value, 0.025), 6) AS p2_5, round(quantile_cont(value, 0.975), 6) AS p97_5,
 round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std FROM events GROUP BY 1""")
def a16(t):
    return summaries.simulated_interval(t.events, "value", "event_type").select("event_type", "n", *[r(c).alias(c) for c in ("p2_5", "p97_5", "mean", "std")])


_FENCES = """f AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, median(value) AS median, quantile_cont(value, 0.75) AS q3, count(*) AS n FROM events GROUP BY 1)"""


@query("a17_boxplot", f"""WITH {_FENCES} SELECT event_type, n, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
 min(value) FILTER (value >= q1 - 1.5 * (q3 - q1)) AS whisker_lo, max(value) FILTER (value <= q3 + 1.5 * (q3 - q1)) AS whisker_hi,
 count(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS n_outliers FROM f JOIN events USING (event_type) GROUP BY event_type, n""")
def a17(t):
    return summaries.boxplot(t.events, "value", "event_type").select(
        "event_type", "n", r("q1").alias("q1"), r("median").alias("median"), r("q3").alias("q3"), "whisker_lo", "whisker_hi", "n_outliers")


@query("a18_outliers", """WITH f AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
 SELECT event_id, value FROM events, f WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""")
def a18(t):
    return summaries.outliers(t.events.select("event_id", "value"), "value")


# --- order ------------------------------------------------------------------------------

@query("w01_last_n_sorted", "SELECT c_name FROM customer ORDER BY c_name DESC LIMIT 12")
def w01(t):
    return frames.last_n_sorted(t.customer, "c_name", 12)


@query("w02_positions_by_category", f"""WITH {S.RECORDS_SQL}, p AS (SELECT sex, row_number() OVER (ORDER BY id) - 1 AS "position" FROM rec)
 SELECT sex, row_number() OVER (PARTITION BY sex ORDER BY "position") AS nth, "position" FROM p""")
def w02(t):
    return frames.positions_by_category(S.records(t), "sex", ["id"])


@query("w03_reverse_ranks", """WITH s AS (SELECT o_custkey, round(sum(o_totalprice), 2) AS spend FROM orders GROUP BY 1)
 SELECT o_custkey, row_number() OVER (ORDER BY spend, o_custkey DESC) - 1 AS "rank" FROM s""")
def w03(t):
    s = t.orders.groupBy("o_custkey").agg(r(F.sum("o_totalprice"), 2).alias("spend"))
    return frames.reverse_ranks(s, [F.asc("spend"), "o_custkey"]).select("o_custkey", "rank")


@query("w04_best_friend", f"""WITH {S.FRIENDS_SQL} SELECT node, (SELECT dst FROM friends f WHERE f.src = node ORDER BY score DESC, dst LIMIT 1) AS friend FROM nodes""")
def w04(t):
    return summaries.best_friend(*S.friends(t))


@query("w05_top_out_degree", f"WITH {S.FRIENDS_SQL} SELECT src AS node, count(*) AS degree FROM friends GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def w05(t):
    return summaries.top_k_degree(S.friends(t)[1], 5)


@query("w06_top_in_degree", f"WITH {S.FRIENDS_SQL} SELECT dst AS node, count(*) AS degree FROM friends GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def w06(t):
    return summaries.top_k_degree(S.friends(t)[1], 5, "dst")


@query("w07_top_groups_by_mean", "SELECT p_brand, round(avg(p_retailprice), 6) AS value FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 7")
def w07(t):
    return summaries.top_k_groups(t.part, "p_brand", r(F.avg("p_retailprice")), 7)


@query("w08_top_groups_by_max", """SELECT user_id, max(value) AS value FROM events WHERE event_type = 'error' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""")
def w08(t):
    return summaries.top_k_groups(t.events.filter("event_type = 'error'"), "user_id", F.max("value"), 5)


@query("w09_top_with_ties", """SELECT l_partkey AS item, n FROM (SELECT l_partkey, count(*) AS n, rank() OVER (ORDER BY count(*) DESC) AS k FROM lineitem GROUP BY 1) WHERE k <= 20""")
def w09(t):
    counts = t.lineitem.groupBy(F.col("l_partkey").alias("item")).agg(F.count(F.lit(1)).alias("n"))
    return frames.with_ties_top(counts, "n", 20).orderBy("item")


@query("w12_word_ngrams", f"""WITH d AS (SELECT doc_id, {S.WORDS_SQL} AS w FROM documents)
 SELECT doc_id, len(w) - 2 AS n, md5(array_to_string(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2]), '|')) AS grams
 FROM d WHERE len(w) >= 3""")
def w12(t):
    from lodestat.operators.text import ngrams
    d = S.document_words(t).select("doc_id", ngrams(F.col("words"), 3).alias("g")).filter(F.size("g") > 0)
    return d.select("doc_id", F.size("g").cast("bigint").alias("n"), F.md5(F.array_join("g", "|")).alias("grams"))


@query("w14_best_setting", """WITH s AS (SELECT l_linenumber, round(avg(l_discount), 9) AS score FROM lineitem GROUP BY 1)
 SELECT arg_min(l_linenumber, score) AS best_low, arg_max(l_linenumber, score) AS best_high FROM s""")
def w14(t):
    s = t.lineitem.groupBy("l_linenumber").agg(r(F.avg("l_discount"), 9).alias("score"))
    return s.agg(F.min_by("l_linenumber", "score").alias("best_low"), F.max_by("l_linenumber", "score").alias("best_high"))


@query("w15_normalised_curve", """WITH c AS (SELECT l_linenumber AS p, avg(l_extendedprice) AS x FROM lineitem GROUP BY 1)
 SELECT p, round(x / (SELECT arg_min(x, p) FROM c), 6) AS ratio FROM c""")
def w15(t):
    c = t.lineitem.groupBy(F.col("l_linenumber").alias("p")).agg(F.avg("l_extendedprice").alias("x"))
    first = c.agg(F.min_by("x", "p")).scalar()
    return c.select("p", r(F.col("x") / first).alias("ratio"))


# --- sets --------------------------------------------------------------------------------

@query("e01_set_difference", """SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) = 1996 EXCEPT SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1997""")
def e01(t):
    o = t.orders.select("o_custkey", F.year("o_orderdate").alias("y"))
    return o.filter("y = 1996").select("o_custkey").subtract(o.filter("y = 1997").select("o_custkey"))


@query("e02_intersection_size", f"""WITH {S.FRIENDS_SQL} SELECT f.src AS node, f.dst AS other, count(b.dst) AS common
 FROM friends f JOIN friends a ON a.src = f.src LEFT JOIN friends b ON b.src = f.dst AND b.dst = a.dst GROUP BY 1, 2""")
def e02(t):
    _, e = S.friends(t)
    return frames.common_neighbours(e, e.select(F.col("src").alias("node"), F.col("dst").alias("other")))


@query("e03_concatenate", """SELECT s_suppkey AS key, s_acctbal AS bal FROM supplier UNION ALL SELECT c_custkey, c_acctbal FROM customer""")
def e03(t):
    return t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("bal")).unionByName(
        t.customer.select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("bal")))


@query("e04_endpoints_and_edges", f"""WITH {S.FRIENDS_SQL}, u AS (SELECT DISTINCT least(src, dst) AS src, greatest(src, dst) AS dst FROM friends)
 SELECT (SELECT count(*) FROM u) AS n_edges, (SELECT count(*) FROM (SELECT src FROM u UNION SELECT dst FROM u)) AS n_nodes""")
def e04(t):
    _, e = S.friends(t)
    u = frames.undirected(e)
    return u.agg(F.count(F.lit(1)).alias("n_edges")).withColumn("n_nodes", frames.endpoints(u).agg(F.count(F.lit(1))).scalar())
