"""Source and sink queries: the test tables are written in a file layout and read back."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestat.operators import graph, text
from lodestat.operators.frames import endpoints, undirected
from lodestat.plans import standins as S
from lodestat.plans.registry import query
from lodestat.plans.tabular import r
from lodestat.session import cut, scratch_path
from lodestat.sources import files, graphfiles, sinks, treebank


@query("s01_points_csv", f"WITH {S.POINTS_SQL} SELECT grp, count(*) AS n, round(sum(x), 2) AS sum_x, round(sum(y), 2) AS sum_y, 2::INTEGER AS dims FROM pts GROUP BY 1")
def s01(t):
    path = scratch_path(t.spark, "points")
    p = S.points(t)
    sinks.write_lines(p.select(F.concat_ws(",", F.col("features")[0], F.col("features")[1], "grp").alias("value")), path)
    back = files.read_points(t.spark, path, partitions=8)
    return back.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), r(F.sum(F.col("features")[0]), 2).alias("sum_x"),
                                   r(F.sum(F.col("features")[1]), 2).alias("sum_y"), F.max(F.size("features")).alias("dims"))


@query("s02_null_tokens", "SELECT c_custkey AS id, CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'MACHINERY') THEN NULL ELSE c_mktsegment END AS segment, c_acctbal AS balance FROM customer")
def s02(t):
    path = scratch_path(t.spark, "delimited")
    seg = F.when(F.col("c_mktsegment") == "HOUSEHOLD", "?").when(F.col("c_mktsegment") == "MACHINERY", "NA").otherwise(F.col("c_mktsegment"))
    t.customer.select(F.col("c_custkey").alias("Key"), seg.alias("Seg."), F.col("c_acctbal").alias("Bal")).write.csv(path, sep=";", header=True)
    schema = T.StructType().add("id", "long").add("segment", "string").add("balance", "double")
    return files.read_delimited(t.spark, path, schema, ";", ("?", "NA"))


@query("s03_whitespace_table", """SELECT n_nationkey AS k, replace(n_name, 'N', 'n') AS m_f, n_regionkey AS region, CASE WHEN n_regionkey IN (0, 2) THEN CASE n_regionkey WHEN 2 THEN 1 ELSE 2 END END::INTEGER AS factor FROM nation""")
def s03(t):
    path = scratch_path(t.spark, "whitespace")
    n = t.nation.select(F.concat(F.lit("  "), F.col("n_nationkey"), F.lit("\t  "), F.translate("n_name", "N", "n"), F.lit("   "), F.col("n_regionkey")).alias("value"))
    head = t.nation.limit(1).select(F.lit("K M.F  Region").alias("value"))
    head.unionByName(n).coalesce(1).write.text(path)
    schema = T.StructType().add("k", "integer").add("m_f", "string").add("region", "integer")
    back = files.read_whitespace_table(t.spark, path, schema).withColumn("r", F.col("region").cast("string"))
    return back.select("k", "m_f", "region", files.as_factor("r", ["2", "0"]).alias("factor"))


@query("s04_numbered_csv", "SELECT s_suppkey, s_acctbal FROM supplier")
def s04(t):
    path = scratch_path(t.spark, "numbered")
    t.supplier.select((F.col("s_suppkey") + 1).alias("row"), "s_suppkey", "s_acctbal").write.csv(path, header=True)
    return files.read_numbered_csv(t.spark, path, T.StructType().add("s_suppkey", "long").add("s_acctbal", "double"))


@query("s05_table_scan", "SELECT r_regionkey AS key, r_name AS name FROM region")
def s05(t):
    t.region.createOrReplaceTempView("region_view")
    return files.read_table(t.spark, "region_view", ["key", "name"])


@query("s06_clean_documents", r"""SELECT doc_id, md5(regexp_replace(lower(regexp_replace(text, '^\s+|\s+$', '', 'g')), '[[:punct:]]', '', 'g')) AS cleaned FROM documents""")
def s06(t):
    return t.documents.select("doc_id", F.md5(files.clean_document("text")).alias("cleaned"))


@query("s06b_line_documents", r"""SELECT count(*) AS n, min(k) AS first, max(k) AS last FROM (SELECT row_number() OVER () - 1 AS k FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents))""")
def s06b(t):
    path = scratch_path(t.spark, "lines")
    t.documents.select("text").write.text(path)
    d = files.read_line_documents(t.spark, path)
    return d.agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))


@query("s07_class_folders", r"""SELECT quality::VARCHAR AS category, count(*) AS n, CAST(sum(length(replace(replace(text, chr(10), ' '), chr(13), ' '))) AS BIGINT) AS chars FROM documents JOIN labels USING (doc_id) GROUP BY 1""")
def s07(t):
    path = scratch_path(t.spark, "classes")
    d = t.documents.join(t.labels, "doc_id").select(F.translate("text", "\n\r", "  ").alias("value"), F.col("quality").alias("category"))
    sinks.write_lines(d, path, "category")
    return files.read_class_dirs(t.spark, path, whole=False).groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))


def write_treebank(t) -> str:
    """Documents as sentences in ten columns; the head of token i is i div 2, so 1 hangs on the root."""
    path = scratch_path(t.spark, "treebank")
    key, texts = ["lang", "doc_id"], t.documents.select("lang", "doc_id", "text")
    if texts.rdd.getNumPartitions() < t.spark.sparkContext.defaultParallelism:  # a small file is one part, and much work
        texts = texts.repartition(int(t.spark.conf.get("spark.sql.shuffle.partitions")))
    w = texts.select(*key, S.words_of("text").alias("words")).filter(F.size("words") > 0)

    def line(p, word):
        return F.concat_ws("\t", p + 1, word, F.lit("_"), F.lit("X"), F.lit("_"), F.lit("_"), F.floor((p + 1) / 2), F.lit("dep"), F.lit("_"), F.lit("_"))

    # a document is a sentence where it stands; only those that share their key are gathered
    shared = cut(t.documents.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*[F.col(c).alias(f"_{c}") for c in key]))
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("doc_id").eqNullSafe(F.col("_doc_id"))
    some = not shared.isEmpty()
    lone = w.join(shared, same, "left_anti") if some else w
    block = lone.select(*key, F.transform("words", lambda x, i: line(i, x)).alias("s"))
    if some:
        each = w.join(shared, same, "left_semi").select(*key, F.posexplode("words").alias("p", "w"))
        # a sentence is bounded by its documents
        whole = each.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("p", line(F.col("p"), F.col("w")).alias("l")))).alias("s"))
        block = block.unionByName(whole.select(*key, F.col("s.l").alias("s")))
    value = F.concat(F.lit("# doc "), F.col("doc_id"), F.lit("\n1-2\t_\t_\t_\t_\t_\t_\t_\t_\t_\n"), F.array_join("s", "\n"))
    # ten columns are some five times the words, and most of them alike
    block.select("lang", value.alias("value")).write.option("lineSep", "\n\n").option("compression", "gzip").partitionBy("lang").text(path)
    return path


_TREE = f"""dw AS (SELECT doc_id, lang, {S.WORDS_SQL} AS w FROM documents), tok AS (SELECT doc_id, lang, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM dw),
 pr AS (SELECT c.lang, h.word AS head_word, c.word AS child_word FROM tok c JOIN tok h ON h.doc_id = c.doc_id AND h.i = c.i // 2)"""


@query("s08_treebank_pairs", f"WITH {_TREE}, d AS (SELECT DISTINCT lang, head_word, child_word FROM pr) SELECT lang, head_word, count(*) AS n, min(child_word) AS first, max(child_word) AS last FROM d GROUP BY ALL")
def s08(t):
    pairs = treebank.head_pairs(treebank.read_sentences(t.spark, write_treebank(t))).distinct()
    return pairs.groupBy("lang", "head_word").agg(F.count(F.lit(1)).alias("n"), F.min("child_word").alias("first"), F.max("child_word").alias("last"))


@query("s09_head_counts", f"WITH {_TREE} SELECT lang, head_word, count(*) AS n_dependents FROM pr GROUP BY ALL")
def s09(t):
    return treebank.head_counts(treebank.head_pairs(treebank.read_sentences(t.spark, write_treebank(t))))


@query("j03_token_head_join", f"WITH {_TREE} SELECT lang, count(*) AS n_pairs, min(head_word || '>' || child_word) AS first FROM (SELECT DISTINCT lang, head_word, child_word FROM pr WHERE head_word <> child_word) GROUP BY 1")
def j03(t):
    tok = S.document_words(t).select("lang", "doc_id", F.posexplode("words").alias("p", "word")).select(
        "lang", "doc_id", (F.col("p") + 1).alias("i"), F.floor((F.col("p") + 1) / 2).cast("int").alias("head"), "word")
    pairs = treebank.token_heads(tok, ["lang", "doc_id"], "i", "head", "word").select("lang", "head_word", "child_word").filter("head_word <> child_word").distinct()
    return pairs.groupBy("lang").agg(F.count(F.lit(1)).alias("n_pairs"), F.min(F.concat("head_word", F.lit(">"), "child_word")).alias("first"))


def _friend_edges(t):
    return undirected(S.friends(t)[1])


_FU = f"{S.FRIENDS_SQL}, fu AS (SELECT DISTINCT least(src, dst) AS src, greatest(src, dst) AS dst FROM friends)"


@query("s10_edge_list_file", f"WITH {_FU} SELECT src, dst, 2::BIGINT AS rejected FROM fu")
def s10(t):
    path = scratch_path(t.spark, "edges")
    e = S.friends(t)[1]
    extra = t.region.limit(1).select(F.explode(F.array(F.lit("25 99"), F.lit("broken line"), F.lit("('a' 'b')"))).alias("value"))
    sinks.write_lines(graphfiles.edge_lines(e).unionByName(extra), path)
    edges, rejected = graphfiles.read_edge_list(t.spark, path)
    return edges.withColumn("rejected", rejected.scalar())


@query("s11_adjacency", f"WITH {_FU} SELECT src, dst FROM fu")
def s11(t):
    path = scratch_path(t.spark, "adjacency")
    sinks.write_json(graphfiles.adjacency(_friend_edges(t), part_size=3), path)
    back = t.spark.read.schema("node string, part int, n_parts int, neighbours array<string>").json(path)
    return graphfiles.adjacency_edges(back)


@query("s12_graph_sizes", f"WITH {_FU} SELECT 'friends' AS \"graph\", (SELECT count(*) FROM (SELECT src FROM fu UNION SELECT dst FROM fu)) AS n_nodes, (SELECT count(*) FROM fu) AS n_edges")
def s12(t):
    e = _friend_edges(t).withColumn("graph", F.lit("friends"))
    return graph.network_stats(endpoints(e, ["graph"]), e, ["graph"]).select("graph", "n_nodes", "n_edges")


@query("s13_degree_file", "SELECT d AS degree, count(*) AS n FROM (SELECT l_partkey, count(*) AS d FROM lineitem GROUP BY 1) GROUP BY 1")
def s13(t):
    path = scratch_path(t.spark, "degrees")
    deg = t.lineitem.groupBy("l_partkey").agg(F.count(F.lit(1)).cast("string").alias("value")).select("value")
    sinks.write_lines(deg.unionByName(t.region.select(F.lit("0").alias("value"))).unionByName(t.region.select(F.lit("n/a").alias("value"))), path)
    return files.value_counts(files.read_degrees(t.spark, path), "degree")


@query("s16_csv_sink", "SELECT o_orderpriority AS priority, count(*) AS n FROM orders GROUP BY 1")
def s16(t):
    path = scratch_path(t.spark, "table")
    sinks.write_csv(files.value_counts(t.orders.select(F.col("o_orderpriority").alias("priority")), "priority"), path)
    return t.spark.read.schema("priority string, n bigint").csv(path, header=True)


@query("s17_text_sink", "SELECT lang, count(*) AS n FROM documents GROUP BY 1")
def s17(t):
    path = scratch_path(t.spark, "text")
    sinks.write_lines(t.documents.select("lang", F.col("n_chars").cast("string").alias("value")), path, "lang")
    return t.spark.read.schema("value string, lang string").text(path).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@query("s18_json_sink", "SELECT event_type, round(avg(value), 6) AS mean, [min(value), max(value)] AS span FROM events GROUP BY 1")
def s18(t):
    path = scratch_path(t.spark, "report")
    sinks.write_json(t.events.groupBy("event_type").agg(r(F.avg("value")).alias("mean"), F.array(F.min("value"), F.max("value")).alias("span")), path)
    return t.spark.read.schema("event_type string, mean double, span array<double>").json(path)


# --- user functions ----------------------------------------------------------------------------

@query("u01_row_function", "SELECT c_custkey, round(c_acctbal * 2 + 1, 6) AS v FROM customer")
def u01(t):
    @F.pandas_udf("double")
    def f(s: pd.Series) -> pd.Series:
        return s * 2 + 1
    return t.customer.select("c_custkey", r(f("c_acctbal")).alias("v"))


@query("u02_vector_combiner", """WITH e AS (SELECT label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings),
 s AS (SELECT label, i, round(sum(x), 6) AS s FROM e GROUP BY 1, 2), c AS (SELECT label, count(*) AS n FROM embeddings GROUP BY 1)
 SELECT label, list(s ORDER BY i) AS total, any_value(n) AS n FROM s JOIN c USING (label) GROUP BY 1""")
def u02(t):
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    v = t.embeddings.select("label", array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("v"))
    s = v.groupBy("label").agg(vector_to_array(Summarizer.sum(F.col("v"))).alias("s"), F.count(F.lit(1)).alias("n"))
    return s.select("label", F.transform("s", lambda x: F.round(x, 6)).alias("total"), "n")


@query("u03_one_to_many", r"""SELECT item_id, unnest(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS token FROM benchmark""")
def u03(t):
    return t.benchmark.select("item_id", F.explode(text.tokens(F.col("text"))).alias("token"))


@query("u04_pluggable_tokenizer", r"""WITH b AS (SELECT doc_id, unnest(string_split(text, ',')) AS term FROM documents) SELECT doc_id, count(DISTINCT term) AS n_terms FROM b GROUP BY 1""")
def u04(t):
    bag = text.bag_of_words(t.documents, "doc_id", "text", text.pandas_tokenizer(lambda s: s.split(",")))
    return bag.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_terms"))


@query("u05_per_group_function", "SELECT l_shipdate::DATE::VARCHAR AS day, round(max(l_quantity) - min(l_quantity), 6) AS span FROM lineitem GROUP BY 1")
def u05(t):
    def span(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"day": [pdf["day"].iloc[0]], "span": [pdf["hi"].max() - pdf["lo"].min()]})
    # the groups are folded to a few partial rows each before Python sees them
    d = t.lineitem.groupBy(F.col("l_shipdate").cast("date").cast("string").alias("day"), F.pmod("l_orderkey", F.lit(8)).alias("salt")).agg(
        F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi"))
    return d.groupBy("day").applyInPandas(span, "day string, span double")
