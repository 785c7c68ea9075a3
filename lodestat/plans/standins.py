"""Which test table plays which input: points, names, friends, words, labelled vectors.

Every function takes the ``Tables`` of one directory; every ``*_SQL`` text is the
same relation for DuckDB, to be put in a WITH clause.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.operators.frames import rank_within
from lodestat.session import cut

# --- points with a group label -------------------------------------------------


def points(t) -> DataFrame:
    """(features, grp): quantity and price in thousands, grouped by line status."""
    return t.lineitem.select(
        F.array(F.col("l_quantity"), F.col("l_extendedprice") / 1000).alias("features"),
        F.when(F.col("l_linestatus") == "F", "A").otherwise("B").alias("grp"))


POINTS_SQL = """pts AS (SELECT l_quantity AS x, l_extendedprice / 1000 AS y,
  CASE WHEN l_linestatus = 'F' THEN 'A' ELSE 'B' END AS grp FROM lineitem)"""

# --- names ---------------------------------------------------------------------


def records(t) -> DataFrame:
    """(id, year, sex, name): orders with their customer's name; status F or other as the sex."""
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("id"), F.year("o_orderdate").alias("year"),
        F.when(F.col("o_orderstatus") == "F", "FEMALE").otherwise("MALE").alias("sex"),
        F.col("c_name").alias("name"), F.col("o_totalprice").alias("price"))


RECORDS_SQL = """rec AS (SELECT o_orderkey AS id, CAST(year(o_orderdate) AS INTEGER) AS "year",
  CASE WHEN o_orderstatus = 'F' THEN 'FEMALE' ELSE 'MALE' END AS sex, c_name AS name, o_totalprice AS price
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def ranked_names(t) -> DataFrame:
    """(year, rank, name): customers ranked by yearly spend."""
    spend = records(t).groupBy("year", "name").agg(F.round(F.sum("price"), 2).alias("spend"))
    return rank_within(spend, ["year"], [F.desc("spend"), F.col("name")]).select("year", "rank", "name")


RANKED_SQL = RECORDS_SQL + """, spend AS (SELECT "year", name, round(sum(price), 2) AS spend FROM rec GROUP BY ALL),
 ranked AS (SELECT "year", row_number() OVER (PARTITION BY "year" ORDER BY spend DESC, name) AS "rank", name FROM spend)"""

# --- friends -------------------------------------------------------------------


def friends(t) -> tuple[DataFrame, DataFrame]:
    """Nodes = nations; directed scored edges = customer nation to supplier nation where the
    mean discount stands out from the other pairs."""
    n = t.nation.select("n_nationkey", "n_name")
    pairs = (
        t.lineitem.select("l_orderkey", "l_suppkey", "l_discount")
        .join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer.select("c_custkey", F.col("c_nationkey").alias("a")), F.col("o_custkey") == F.col("c_custkey"))
        .join(t.supplier.select("s_suppkey", F.col("s_nationkey").alias("b")), F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("a", "b").agg(F.round(F.avg("l_discount"), 9).alias("s"))
        .join(n.toDF("a", "src"), "a").join(n.toDF("b", "dst"), "b").select("src", "dst", "s"))
    floor = pairs.agg(F.avg("s") + 1.5 * F.stddev_pop("s")).scalar()
    edges = pairs.filter((F.col("s") > floor) & (F.col("src") != F.col("dst"))).select("src", "dst", F.col("s").alias("score"))
    return n.select(F.col("n_name").alias("node")), cut(edges)


FRIENDS_SQL = """pairs AS (SELECT cn.n_name AS src, sn.n_name AS dst, round(avg(l_discount), 9) AS s
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation cn ON cn.n_nationkey = c_nationkey
  JOIN nation sn ON sn.n_nationkey = s_nationkey GROUP BY 1, 2),
 friends AS (SELECT src, dst, s AS score FROM pairs
  WHERE s > (SELECT avg(s) + 1.5 * stddev_pop(s) FROM pairs) AND src <> dst),
 nodes AS (SELECT n_name AS node FROM nation)"""

# --- words ---------------------------------------------------------------------


def words_of(col: str):
    """Lowercase letter runs of a text."""
    return F.regexp_extract_all(F.lower(col), F.lit(r"(\p{L}+)"), F.lit(1))


WORDS_SQL = r"regexp_extract_all(lower(text), '\p{L}+')"


def document_words(t) -> DataFrame:
    return t.documents.select("doc_id", "lang", "source", words_of("text").alias("words"))


def word_links(t) -> DataFrame:
    """(lang, src, dst): each word and the next one, per document, repeats kept."""
    w = document_words(t)
    n = F.size("words")
    nexts = F.when(n > 1, F.arrays_zip(
        F.slice("words", F.lit(1), F.greatest(n - 1, F.lit(0))).alias("src"),
        F.slice("words", F.lit(2), F.greatest(n - 1, F.lit(0))).alias("dst")))
    return w.select("lang", F.explode(nexts).alias("e")).select("lang", "e.src", "e.dst")


LINKS_SQL = f"""dw AS (SELECT doc_id, lang, source, {WORDS_SQL} AS words FROM documents),
 links AS (SELECT lang, unnest(words[1:len(words)-1]) AS src, unnest(words[2:len(words)]) AS dst FROM dw WHERE len(words) > 1)"""

UEDGES_SQL = LINKS_SQL + """,
 ue AS (SELECT DISTINCT lang, least(src, dst) AS src, greatest(src, dst) AS dst FROM links WHERE src <> dst),
 un AS (SELECT lang, src AS node FROM ue UNION SELECT lang, dst FROM ue)"""

DEDGES_SQL = LINKS_SQL + """,
 de AS (SELECT DISTINCT lang, src, dst FROM links),
 dn AS (SELECT lang, src AS node FROM de UNION SELECT lang, dst FROM de)"""

# --- labelled documents ----------------------------------------------------------


def scored_documents(t) -> DataFrame:
    """(doc_id, quality, toxic, n_chars, n_tokens, avg_len): labelled documents with three features."""
    toks = F.filter(F.split("text", r"\s+"), lambda x: x != "")
    d = t.documents.select("doc_id", F.col("n_chars").cast("double").alias("n_chars"),
                           F.size(toks).cast("double").alias("n_tokens"),
                           F.length(F.array_join(toks, "")).cast("double").alias("tok_chars"))
    return t.labels.join(d, "doc_id").select(
        "doc_id", "quality", "toxic", "n_chars", "n_tokens",
        F.coalesce(F.try_divide("tok_chars", "n_tokens"), F.lit(0.0)).alias("avg_len"))


SCORED_SQL = r"""tk AS (SELECT doc_id, CAST(n_chars AS DOUBLE) AS n_chars,
  list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS tk FROM documents),
 sd AS (SELECT doc_id, quality, toxic, n_chars, CAST(len(tk) AS DOUBLE) AS n_tokens,
  coalesce(CAST(length(array_to_string(tk, '')) AS DOUBLE) / nullif(len(tk), 0), 0.0) AS avg_len
  FROM labels JOIN tk USING (doc_id))"""
