"""Word networks of the documents and the friend graph of the nations."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestat.operators import frames, graph, nullmodels
from lodestat.operators.linkdegrees import link_degrees
from lodestat.plans import standins as S
from lodestat.plans.registry import query
from lodestat.plans.tabular import r
from lodestat.session import cut

LANG = ["lang"]


def word_network(t):
    """Undirected word network per language: (nodes, edges), built once and then measured."""
    edges = cut(frames.undirected(S.word_links(t), LANG))
    return frames.endpoints(edges, LANG), edges


def directed_network(t):
    edges = cut(S.word_links(t).distinct())
    return frames.endpoints(edges, LANG), edges


def talk_network(t):
    """Undirected network of neighbouring words per speaker role of the conversations."""
    talk = t.conversations.select("role", S.words_of("text").alias("w"))
    n = F.greatest(F.size("w") - 1, F.lit(0))
    links = talk.select(F.col("role").alias("lang"), F.explode(F.arrays_zip(
        F.slice("w", F.lit(1), n).alias("src"), F.slice("w", F.lit(2), n).alias("dst"))).alias("e")).select("lang", "e.src", "e.dst")
    edges = cut(frames.undirected(links, LANG))
    return frames.endpoints(edges, LANG), edges


@query("g01_word_network", f"""WITH {S.UEDGES_SQL}, de AS (SELECT DISTINCT lang, src, dst FROM links), k AS (
 SELECT 'directed' AS kind, lang, src, dst FROM de UNION ALL SELECT 'undirected', lang, src, dst FROM ue)
 SELECT kind, lang, src, count(*) AS n, min(dst) AS first, max(dst) AS last FROM k GROUP BY ALL""")
def g01(t):
    _, d = directed_network(t)
    u = cut(frames.undirected(d, LANG))  # from distinct links, so that the texts are read once
    both = u.withColumn("kind", F.lit("undirected")).unionByName(d.withColumn("kind", F.lit("directed")))
    return both.groupBy("kind", "lang", "src").agg(F.count(F.lit(1)).alias("n"), F.min("dst").alias("first"), F.max("dst").alias("last"))


@query("g02_network_stats", f"""WITH {S.UEDGES_SQL}, n AS (SELECT lang, count(*) AS n_nodes FROM un GROUP BY 1), e AS (SELECT lang, count(*) AS n_edges FROM ue GROUP BY 1)
 SELECT lang, n_nodes, n_edges, round(2 * n_edges / n_nodes, 6) AS mean_degree, round(2.0 * n_edges / (n_nodes * (n_nodes - 1)), 9) AS density FROM n JOIN e USING (lang)""")
def g02(t):
    # each edge is counted at both of its ends
    deg = cut(link_degrees(S.document_words(t), "lang", "words", directed=False))
    stats = deg.groupBy(*LANG).agg(F.count(F.lit(1)).alias("n_nodes"), (F.sum("degree") / 2).cast("bigint").alias("n_edges"))
    return graph.with_density(stats).select("lang", "n_nodes", "n_edges", r("mean_degree").alias("mean_degree"), r("density", 9).alias("density"))


@query("g03_degree_histogram", f"""WITH {S.DEDGES_SQL}, deg AS (SELECT lang, src, count(*) AS degree FROM de GROUP BY ALL)
 SELECT lang, degree, n, round(n / sum(n) OVER (PARTITION BY lang), 9) AS share FROM (SELECT lang, degree, count(*) AS n FROM deg GROUP BY ALL)""")
def g03(t):
    deg = cut(link_degrees(S.document_words(t), "lang", "words", directed=True))
    return graph.degree_histogram(deg, LANG).select("lang", "degree", "n", r("share", 9).alias("share"))


@query("a11_degree_stats", f"""WITH {S.DEDGES_SQL}, deg AS (SELECT lang, src, count(*) AS degree FROM de GROUP BY ALL)
 SELECT lang, count(*) AS n, max(degree) AS max_degree, round(sum(degree) / count(*), 6) AS m_per_n, round(count(*) / sum(degree), 6) AS n_per_m FROM deg GROUP BY 1""")
def a11(t):
    nodes, edges = directed_network(t)
    return graph.degree_sequence_stats(graph.degrees(nodes, edges, LANG, True), LANG).select(
        "lang", "n", "max_degree", r("m_per_n").alias("m_per_n"), r("n_per_m").alias("n_per_m"))


_TRI_SQL = f"""{S.UEDGES_SQL}, ends AS (SELECT lang, src AS node FROM ue UNION ALL SELECT lang, dst FROM ue),
 deg AS (SELECT lang, node, count(*) AS d FROM ends GROUP BY ALL),
 ori AS (SELECT ue.lang, CASE WHEN (a.d, src) < (b.d, dst) THEN src ELSE dst END AS lo, CASE WHEN (a.d, src) < (b.d, dst) THEN dst ELSE src END AS hi
  FROM ue JOIN deg a ON a.lang = ue.lang AND a.node = src JOIN deg b ON b.lang = ue.lang AND b.node = dst),
 tri AS (SELECT p.lang, p.lo AS u, p.hi AS v, q.hi AS w FROM ori p JOIN ori q ON p.lang = q.lang AND p.lo = q.lo AND p.hi < q.hi
  JOIN ue ON ue.lang = p.lang AND ue.src = p.hi AND ue.dst = q.hi),
 tn AS (SELECT lang, node, count(*) AS t FROM (SELECT lang, u AS node FROM tri UNION ALL SELECT lang, v FROM tri UNION ALL SELECT lang, w FROM tri) GROUP BY ALL)"""


@query("g04_average_clustering", f"""WITH {_TRI_SQL} SELECT lang, round(avg(CASE WHEN d < 2 THEN 0 ELSE coalesce(2.0 * t / (d * (d - 1)), 0) END), 8) AS clustering
 FROM deg LEFT JOIN tn USING (lang, node) GROUP BY 1""")
def g04(t):
    return graph.average_clustering(*word_network(t), LANG).select("lang", r("clustering", 8).alias("clustering"))


@query("g05_sampling_bound", f"""WITH {S.UEDGES_SQL}, deg AS (SELECT lang, node, count(*) AS d FROM (SELECT lang, src AS node FROM ue UNION ALL SELECT lang, dst FROM ue) GROUP BY ALL),
 b AS (SELECT lang, sqrt(ln(0.05 / 2) / (-2.0 * count(*) * 0.2)) AS epsilon, count(*) FILTER (d >= 2) / count(*) AS ratio FROM deg GROUP BY 1)
 SELECT lang, round(epsilon, 9) AS epsilon, round(ratio, 9) AS ratio, round(epsilon * ratio, 9) AS product FROM b""")
def g05(t):
    deg = graph.degrees(*word_network(t), LANG)
    return graph.sampling_bound(deg, LANG).select("lang", *[r(c, 9).alias(c) for c in ("epsilon", "ratio", "product")])


# the big component by a plain walk from its best linked word, then labels for what is left
@query("g06_connectivity", f"""WITH RECURSIVE {S.UEDGES_SQL}, arcs AS (SELECT lang, src, dst FROM ue UNION ALL SELECT lang, dst, src FROM ue),
 hub AS (SELECT lang, mode(src) AS node FROM arcs GROUP BY 1),
 main(lang, node) AS (SELECT lang, node FROM hub UNION SELECT a.lang, a.dst FROM main m JOIN arcs a ON a.lang = m.lang AND a.src = m.node),
 rest AS (SELECT lang, node FROM un EXCEPT SELECT lang, node FROM main),
 ra AS (SELECT a.lang, a.src, a.dst FROM arcs a JOIN rest ON rest.lang = a.lang AND rest.node = a.src),
 walk(lang, node, comp) AS (SELECT lang, node, node FROM rest UNION SELECT w.lang, a.dst, w.comp FROM walk w JOIN ra a ON a.lang = w.lang AND a.src = w.node),
 lab AS (SELECT lang, node, min(comp) AS comp FROM walk GROUP BY ALL)
 SELECT hub.lang, 1 + count(DISTINCT comp) AS n_components, count(DISTINCT comp) = 0 AS connected FROM hub LEFT JOIN lab ON hub.lang = lab.lang GROUP BY 1""")
def g06(t):
    return graph.connectivity(*word_network(t), LANG)


_FRIEND_U = f"""{S.FRIENDS_SQL}, fu AS (SELECT DISTINCT least(src, dst) AS src, greatest(src, dst) AS dst FROM friends),
 arcs AS (SELECT src, dst FROM fu UNION ALL SELECT dst, src FROM fu)"""


@query("g07_mean_path", f"""WITH RECURSIVE {_FRIEND_U}, bfs(s, node, d) AS (SELECT DISTINCT src, src, 0 FROM arcs UNION
  SELECT s, dst, d + 1 FROM bfs JOIN arcs ON src = node WHERE d < 24),
 best AS (SELECT s, node, min(d) AS d FROM bfs GROUP BY 1, 2)
 SELECT 'friends' AS "graph", count(DISTINCT s) AS n_sources, count(*) FILTER (d > 0) AS n_pairs, round(avg(d) FILTER (d > 0), 6) AS mean_path FROM best""")
def g07(t):
    _, e = S.friends(t)
    edges = frames.undirected(e).withColumn("graph", F.lit("friends"))
    nodes = frames.endpoints(edges, ["graph"])
    return graph.path_lengths(nodes, edges, ["graph"]).select("graph", "n_sources", "n_pairs", r("mean_path").alias("mean_path"))


@query("g07b_mean_path_sampled_sources")
def g07b(t):
    return graph.path_lengths(*word_network(t), LANG, n_sources=63)


@query("g07c_mean_path_all_words")
def g07c(t):
    """All sources of the networks of spoken words, which grow with the table, by merged counters."""
    return graph.estimated_path_lengths(*talk_network(t), LANG)


# what every null model of these networks keeps: their sizes, no loops, no repeated edges
_NULL_SQL = f"""WITH t AS (SELECT role AS lang, {S.WORDS_SQL} AS words FROM conversations),
 links AS (SELECT lang, unnest(words[1:len(words)-1]) AS src, unnest(words[2:len(words)]) AS dst FROM t WHERE len(words) > 1),
 ue AS (SELECT DISTINCT lang, least(src, dst) AS src, greatest(src, dst) AS dst FROM links WHERE src <> dst),
 un AS (SELECT lang, src AS node FROM ue UNION ALL SELECT lang, dst FROM ue), dg AS (SELECT lang, node, count(*) AS d FROM un GROUP BY ALL),
 sz AS (SELECT lang, count(*) AS n_edges FROM ue GROUP BY 1), reps AS (SELECT unnest(range({{reps}})) AS rep)"""


def _kept(graphs):
    """Per graph and replicate: edges, loops, repeated edges."""
    return graphs.groupBy("lang", "rep").agg(
        F.count(F.lit(1)).alias("n_edges"), F.count_if(F.col("src") == F.col("dst")).alias("loops"),
        (F.count(F.lit(1)) - F.count_distinct(F.least("src", "dst"), F.greatest("src", "dst"))).alias("repeated"))


@query("g08_random_graphs", _NULL_SQL.replace("{reps}", "2") + " SELECT lang, CAST(rep AS INTEGER) AS rep, n_edges, 0::BIGINT AS loops, 0::BIGINT AS repeated FROM sz, reps")
def g08(t):
    nodes, edges = talk_network(t)
    return _kept(nullmodels.random_graphs(nodes, edges, LANG, 2)).withColumn("rep", F.col("rep").cast("int"))


@query("g09_degree_preserving_swaps", _NULL_SQL.replace("{reps}", "1") + """, sq AS (SELECT lang, CAST(sum(d * d) AS BIGINT) AS squared_degrees, max(d) AS max_degree FROM dg GROUP BY 1)
 SELECT lang, CAST(rep AS INTEGER) AS rep, n_edges, 0::BIGINT AS loops, 0::BIGINT AS repeated, squared_degrees, max_degree, true AS mostly_accepted FROM sz JOIN sq USING (lang), reps""")
def g09(t):
    _, edges = talk_network(t)
    sw, share = nullmodels.swapped_graphs(edges, LANG, 1)
    ends = sw.select("lang", "rep", F.explode(F.array("src", "dst")).alias("node")).groupBy("lang", "rep", "node").agg(F.count(F.lit(1)).alias("d"))
    degrees = ends.groupBy("lang", "rep").agg(F.sum(F.col("d") * F.col("d")).alias("squared_degrees"), F.max("d").alias("max_degree"))
    accepted = share.select("lang", "rep", (F.col("accepted_share") > 0.5).alias("mostly_accepted"))
    return _kept(sw).join(degrees, ["lang", "rep"]).join(accepted, ["lang", "rep"]).withColumn("rep", F.col("rep").cast("int"))


@query("g10_clustering_significance")
def g10(t):
    _, e = S.friends(t)
    edges = frames.undirected(e).withColumn("lang", F.lit("friends"))
    return nullmodels.clustering_significance(frames.endpoints(edges, LANG), edges, LANG, reps=20)


@query("g11_strength_bands", f"""WITH {S.FRIENDS_SQL} SELECT src, dst, CASE WHEN score / (SELECT max(score) FROM friends) >= 0.8 THEN 'strong' ELSE 'weak' END AS band FROM friends""")
def g11(t):
    _, e = S.friends(t)
    top = e.agg(F.max("score")).scalar()
    return e.select("src", "dst", graph.strength_band(F.col("score") / top).alias("band"))
