"""A*, B*, F12, F13: decoders, transforms, union and arrival positions."""

from __future__ import annotations

from pyspark.sql import functions as F

from edgegraph.operators import transforms as T
from edgegraph.operators.positions import with_position
from edgegraph.plans.catalog import register
from edgegraph.plans.oracle_views import with_views
from edgegraph.sources import cust_edges, edge_lines, load_table, txn_edges, user_edges
from edgegraph.sources.text import decode


def ms(df, *cols):
    """Render timestamp columns as epoch ms for comparison."""
    for c in cols or ("ts",):
        if c in df.columns:
            df = df.withColumn(c, F.unix_millis(F.col(c)))
    return df


# ---- sources ------------------------------------------------------------------------------

@register("src_parse_pair", with_views(["user_edges"], """
SELECT CAST(f[1] AS BIGINT) AS src, CAST(f[2] AS BIGINT) AS trg
FROM (SELECT regexp_split_to_array(src || ' ' || trg, '\\s') AS f FROM user_edges)"""))
def src_parse_pair(spark, sf_dir):
    return decode(edge_lines(spark, sf_dir, "pair"), "pair")


@register("src_parse_tab", with_views(["user_edges"], """
SELECT CAST(f[1] AS BIGINT) AS src, CAST(f[2] AS BIGINT) AS trg
FROM (SELECT string_split(src || chr(9) || trg, chr(9)) AS f FROM user_edges)"""))
def src_parse_tab(spark, sf_dir):
    return decode(edge_lines(spark, sf_dir, "pair_tab"), "pair_tab")


@register("src_parse_txn", with_views(["txn_edges"], """
SELECT CAST(f[1] AS BIGINT) AS src, CAST(f[2] AS BIGINT) AS trg, CAST(f[3] AS BIGINT) AS amount,
       CAST(f[4] AS BIGINT) AS ts
FROM (SELECT string_split(src || ' ' || trg || ' ' || amount || ' ' || ts, ' ') AS f FROM txn_edges)"""))
def src_parse_txn(spark, sf_dir):
    return ms(decode(edge_lines(spark, sf_dir, "txn"), "txn"))


@register("src_comment_skip", """
SELECT CAST(f[1] AS BIGINT) AS src, CAST(f[2] AS BIGINT) AS trg FROM (
  SELECT string_split(CASE WHEN event_type = 'error' THEN '% ' || user_id || ' ' || event_id
                           ELSE user_id || ' ' || (1000 + event_id % 40) END, ' ') AS f FROM events)
WHERE f[1] <> '%'""")
def src_comment_skip(spark, sf_dir):
    return decode(edge_lines(spark, sf_dir, "commented"), "commented")


@register("src_parse_signed", with_views(["signed_edges"], """
SELECT CAST(f[1] AS BIGINT) AS src, CAST(f[2] AS BIGINT) AS trg, CASE WHEN f[3] = '+' THEN 1 ELSE -1 END AS chg
FROM (SELECT string_split(src || ' ' || trg || ' ' || CASE WHEN chg > 0 THEN '+' ELSE '-' END, ' ') AS f
      FROM signed_edges)"""))
def src_parse_signed(spark, sf_dir):
    return decode(edge_lines(spark, sf_dir, "signed"), "signed")


@register("src_parse_timed", with_views(["user_edges"], """
SELECT src, trg, ts FROM user_edges"""))
def src_parse_timed(spark, sf_dir):
    e = user_edges(spark, sf_dir, pos=False)
    lines = e.select(F.concat_ws(" ", "src", "trg", F.unix_millis("ts").cast("string")).alias("value"))
    return ms(decode(lines, "timed"))


@register("src_bipartite_offset", """
SELECT l_suppkey AS src, l_partkey + 1000000 AS trg, CAST(l_quantity AS BIGINT) * 10 AS amount FROM lineitem""")
def src_bipartite_offset(spark, sf_dir):
    return decode(edge_lines(spark, sf_dir, "rating"), "rating")


# ---- transforms ---------------------------------------------------------------------------

@register("g_edges", with_views(["user_edges"], "SELECT src, trg, amount, ts, pos FROM user_edges"))
def g_edges(spark, sf_dir):
    return ms(user_edges(spark, sf_dir))


@register("g_vertices", with_views(["txn_edges"], """
SELECT DISTINCT v FROM (SELECT src AS v FROM txn_edges UNION ALL SELECT trg FROM txn_edges)"""))
def g_vertices(spark, sf_dir):
    return T.vertices(txn_edges(spark, sf_dir))


@register("g_map_edges", with_views(["user_edges"], "SELECT src, trg, amount // 100 AS value, pos FROM user_edges"))
def g_map_edges(spark, sf_dir):
    e = user_edges(spark, sf_dir)
    return T.map_edges(e, F.expr("amount div 100"), "value").select("src", "trg", "value", "pos")


@register("g_filter_vertices", with_views(["user_edges"], """
SELECT src, trg, pos FROM user_edges WHERE src >= 5 AND trg >= 5"""))
def g_filter_vertices(spark, sf_dir):
    return T.filter_vertices(user_edges(spark, sf_dir), lambda v: v >= 5).select("src", "trg", "pos")


@register("g_filter_edges", with_views(["user_edges"], """
SELECT src, trg, amount, pos FROM user_edges WHERE amount > 5000"""))
def g_filter_edges(spark, sf_dir):
    return T.filter_edges(user_edges(spark, sf_dir), F.col("amount") > 5000).select("src", "trg", "amount", "pos")


@register("g_distinct", with_views(["txn_edges"], "SELECT DISTINCT src, trg FROM txn_edges"))
def g_distinct(spark, sf_dir):
    return T.distinct(txn_edges(spark, sf_dir))


@register("g_distinct_first", with_views(["user_edges"], """
SELECT src, trg, amount, ts, pos FROM (
  SELECT *, row_number() OVER (PARTITION BY src, trg ORDER BY pos) AS rn FROM user_edges) WHERE rn = 1"""))
def g_distinct_first(spark, sf_dir):
    return ms(T.distinct_first(user_edges(spark, sf_dir), "pos"))


@register("g_reverse", with_views(["user_edges"], "SELECT trg AS src, src AS trg, amount, pos FROM user_edges"))
def g_reverse(spark, sf_dir):
    return T.reverse(user_edges(spark, sf_dir).select("src", "trg", "amount", "pos"))


@register("g_undirected", with_views(["user_edges"], """
SELECT src, trg, pos FROM user_edges UNION ALL SELECT trg, src, pos FROM user_edges"""))
def g_undirected(spark, sf_dir):
    return T.undirected(user_edges(spark, sf_dir).select("src", "trg", "pos"))


@register("g_canonical", with_views(["user_edges"], """
SELECT least(src, trg) AS src, greatest(src, trg) AS trg, pos FROM user_edges"""))
def g_canonical(spark, sf_dir):
    return T.canonical(user_edges(spark, sf_dir).select("src", "trg", "pos"))


@register("g_union", with_views(["user_edges", "cust_edges"], """
SELECT src, trg FROM user_edges UNION ALL SELECT src, trg FROM cust_edges"""))
def g_union(spark, sf_dir):
    return T.union(user_edges(spark, sf_dir, pos=False).select("src", "trg"), cust_edges(spark, sf_dir))


@register("with_position", """
SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS pos FROM events""")
def with_position_q(spark, sf_dir):
    ev = load_table(spark, sf_dir, "events").select("event_id", "ts")
    return with_position(ev, ["ts", "event_id"], "pos").select("event_id", "pos")
