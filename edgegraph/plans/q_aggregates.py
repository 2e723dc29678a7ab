"""Degrees, counts, vertex/global aggregates, neighbourhoods, windowed last value."""

from __future__ import annotations

from pyspark.sql import functions as F

from edgegraph.operators import degrees as D
from edgegraph.operators.monoid import clamped_walk
from edgegraph.plans.catalog import register
from edgegraph.plans.oracle_views import with_views
from edgegraph.sources import cust_edges, signed_edges, txn_edges, user_edges

ENDS = "SELECT src AS v, pos, 0 AS side FROM user_edges UNION ALL SELECT trg, pos, 1 FROM user_edges"


@register("deg_all", with_views(["txn_edges"], """
SELECT v, count(*) AS degree FROM (SELECT src AS v FROM txn_edges UNION ALL SELECT trg FROM txn_edges) GROUP BY v"""))
def deg_all(spark, sf_dir):
    return D.degrees(txn_edges(spark, sf_dir), "all")


@register("deg_in", with_views(["txn_edges"], "SELECT trg AS v, count(*) AS degree FROM txn_edges GROUP BY trg"))
def deg_in(spark, sf_dir):
    return D.degrees(txn_edges(spark, sf_dir), "in")


@register("deg_out", with_views(["txn_edges"], "SELECT src AS v, count(*) AS degree FROM txn_edges GROUP BY src"))
def deg_out(spark, sf_dir):
    return D.degrees(txn_edges(spark, sf_dir), "out")


@register("deg_changelog", with_views(["user_edges"], f"""
SELECT v, side, pos, row_number() OVER (PARTITION BY v ORDER BY pos, side) AS degree FROM ({ENDS})"""))
def deg_changelog(spark, sf_dir):
    return D.degree_changelog(user_edges(spark, sf_dir).select("src", "trg", "pos"))


@register("n_edges", with_views(["txn_edges"], "SELECT count(*) AS n_edges FROM txn_edges"))
def n_edges(spark, sf_dir):
    return D.edge_count(txn_edges(spark, sf_dir))


@register("n_vertices", with_views(["txn_edges"], """
SELECT count(DISTINCT v) AS n_vertices FROM (SELECT src AS v FROM txn_edges UNION ALL SELECT trg FROM txn_edges)"""))
def n_vertices(spark, sf_dir):
    return D.vertex_count(txn_edges(spark, sf_dir))


@register("n_vertices_approx", with_views(["txn_edges"], """
SELECT count(DISTINCT v) AS n_vertices, true AS within_error FROM (SELECT src AS v FROM txn_edges UNION ALL SELECT trg FROM txn_edges)"""))
def n_vertices_approx(spark, sf_dir):
    return D.vertex_count_checked(txn_edges(spark, sf_dir))


@register("n_vertices_changelog", with_views(["cust_edges"], """
SELECT v, pos, side, row_number() OVER (ORDER BY pos, side) AS n_vertices FROM (
  SELECT v, arg_min(pos, pos * 2 + side) AS pos, arg_min(side, pos * 2 + side) AS side FROM (
    SELECT src AS v, src AS pos, 0 AS side FROM cust_edges UNION ALL SELECT trg, src, 1 FROM cust_edges) GROUP BY v)"""))
def n_vertices_changelog(spark, sf_dir):
    # customers' path edges in the order of their source id
    e = cust_edges(spark, sf_dir).withColumn("pos", F.col("src"))
    return D.vertex_count_changelog(e, "pos")


@register("agg_vertex_custom", with_views(["txn_edges"], """
SELECT v, CAST(sum(x) AS BIGINT) AS net_amount FROM (
  SELECT src AS v, -amount AS x FROM txn_edges UNION ALL SELECT trg, amount FROM txn_edges) GROUP BY v"""))
def agg_vertex_custom(spark, sf_dir):
    e = txn_edges(spark, sf_dir)
    return D.vertex_aggregate(e, [("src", -F.col("amount")), ("trg", F.col("amount"))],
                              F.sum("x").cast("bigint"), "net_amount")


@register("agg_global_custom", with_views(["user_edges"], """
SELECT pos, value FROM (
  SELECT pos, value, lag(value) OVER (ORDER BY pos) AS prev FROM (
    SELECT pos, max(amount) OVER (ORDER BY pos ROWS UNBOUNDED PRECEDING) AS value FROM user_edges))
WHERE prev IS NULL OR prev <> value"""))
def agg_global_custom(spark, sf_dir):
    return D.global_aggregate(user_edges(spark, sf_dir), F.col("amount"), "max", "pos")


@register("nbr_final", with_views(["user_edges"], """
SELECT src AS v, trg AS nbr, row_number() OVER (PARTITION BY src ORDER BY trg) AS idx
FROM (SELECT DISTINCT src, trg FROM user_edges)"""))
def nbr_final(spark, sf_dir):
    return D.neighborhood_rows(user_edges(spark, sf_dir, pos=False))


@register("nbr_running", with_views(["user_edges"], """
SELECT pos, src, trg, CAST(sum(CASE WHEN first THEN 1 ELSE 0 END) OVER (PARTITION BY src ORDER BY pos) AS BIGINT) AS n_nbrs FROM (
  SELECT pos, src, trg, pos = min(pos) OVER (PARTITION BY src, trg) AS first FROM user_edges)"""))
def nbr_running(spark, sf_dir):
    return D.running_neighborhood_size(user_edges(spark, sf_dir))


@register("nbr_running_undirected", with_views(["user_edges"], """
SELECT v, nbr, pos, side, k = 1 AS is_new, CAST(sum(CASE WHEN k = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY v ORDER BY pos, side) AS BIGINT) AS n_nbrs
FROM (SELECT *, row_number() OVER (PARTITION BY v, nbr ORDER BY pos, side) AS k FROM (
  SELECT src AS v, trg AS nbr, pos, 0 AS side FROM user_edges UNION ALL SELECT trg, src, pos, 1 FROM user_edges))"""))
def nbr_running_undirected(spark, sf_dir):
    return D.running_neighborhood(user_edges(spark, sf_dir), directed=False)


H1 = 3600000


@register("win_graph_size", with_views(["user_edges"], f"""
SELECT ts - ts % {H1} AS w_start, ts - ts % {H1} + {H1} AS w_end, count(DISTINCT src) AS graph_size
FROM user_edges GROUP BY 1, 2"""))
def win_graph_size(spark, sf_dir):
    return D.window_graph_size(user_edges(spark, sf_dir, pos=False), "1 hour")


D1 = 86400000


@register("win_last_value", with_views(["user_edges"], f"""
SELECT ts - ts % {D1} AS w_start, ts - ts % {D1} + {D1} AS w_end, src, arg_max(trg, pos) AS trg
FROM user_edges GROUP BY 1, 2, src"""))
def win_last_value(spark, sf_dir):
    return D.window_last_value(user_edges(spark, sf_dir), "1 day", "src", "trg", "pos")


@register("agg_global_struct", with_views(["signed_edges"], """
SELECT pos, CAST(s - least(0, min(s) OVER (ORDER BY pos ROWS UNBOUNDED PRECEDING)) AS BIGINT) AS value
FROM (SELECT pos, sum(chg) OVER (ORDER BY pos ROWS UNBOUNDED PRECEDING) AS s FROM signed_edges)"""))
def agg_global_struct(spark, sf_dir):
    """A running level over the whole stream that never falls below 0: a struct state, merged in arrival order."""
    return D.global_aggregate(signed_edges(spark, sf_dir), clamped_walk(F.col("chg")), collect_updates=False)
