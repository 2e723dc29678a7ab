"""H4*, H5: connected components (three algorithms, one answer) and bipartiteness."""

from __future__ import annotations

from pyspark.sql import functions as F

from edgegraph.operators import bipartite as B
from edgegraph.operators import components as C
from edgegraph.plans.catalog import register
from edgegraph.plans.oracle_views import components_cte, with_views
from edgegraph.sources import cust_edges, user_edges

CC_SQL = with_views(["cust_edges"], "SELECT v, component FROM cc", ctes=components_cte("cust_edges"), recursive=True)


@register("cc_labels", CC_SQL)
def cc_labels(spark, sf_dir):
    return C.connected_components(cust_edges(spark, sf_dir))


@register("cc_tree", CC_SQL)
def cc_tree(spark, sf_dir):
    return C.connected_components_tree(cust_edges(spark, sf_dir))


@register("cc_iterative", CC_SQL)
def cc_iterative(spark, sf_dir):
    return C.connected_components_iterative(cust_edges(spark, sf_dir))


@register("cc_sizes", with_views(["cust_edges"], "SELECT component, count(*) AS size FROM cc GROUP BY component",
                                 ctes=components_cte("cust_edges"), recursive=True))
def cc_sizes(spark, sf_dir):
    return C.component_sizes(C.connected_components(cust_edges(spark, sf_dir)))


@register("cc_members", with_views(["cust_edges"], """
SELECT component, v, row_number() OVER (PARTITION BY component ORDER BY v) AS idx FROM cc""",
    ctes=components_cte("cust_edges"), recursive=True))
def cc_members(spark, sf_dir):
    return C.component_members(C.connected_components(cust_edges(spark, sf_dir)))


def _cover(view: str) -> str:
    return f"""dc AS (SELECT 2 * src AS src, 2 * trg + 1 AS trg FROM {view} UNION ALL SELECT 2 * src + 1, 2 * trg FROM {view}),
{components_cte("dc")},
half AS (SELECT (v - (v % 2 + 2) % 2) // 2 AS v, (v % 2 + 2) % 2 AS side, component FROM cc),
pv AS (SELECT v, min(CASE WHEN side = 0 THEN component END) AS ce,
              min(CASE WHEN side = 1 THEN component END) AS co FROM half GROUP BY v),
sv AS (SELECT v, (least(ce, co) - (least(ce, co) % 2 + 2) % 2) // 2 AS component,
              ce = least(ce, co) - (least(ce, co) % 2 + 2) % 2 AS sign, ce = co AS conflict FROM pv)"""


@register("bip_flag", with_views(["user_edges"], """
SELECT NOT coalesce(bool_or(conflict), false) AS bipartite, count(*) AS n_vertices FROM sv""",
    ctes=_cover("user_edges"), recursive=True))
def bip_flag(spark, sf_dir):
    return B.is_bipartite(user_edges(spark, sf_dir, pos=False))


@register("bip_components", with_views(["cust_edges"], """
SELECT component, NOT bool_or(conflict) AS bipartite, count(*) AS size FROM sv GROUP BY component""",
    ctes=_cover("cust_edges"), recursive=True))
def bip_components(spark, sf_dir):
    return B.component_bipartite(cust_edges(spark, sf_dir))


@register("bip_signs", with_views(["cust_edges"], """
SELECT component, v, sign FROM sv WHERE component NOT IN (SELECT component FROM sv WHERE conflict)""",
    ctes=_cover("cust_edges"), recursive=True))
def bip_signs(spark, sf_dir):
    return B.signed_vertices(cust_edges(spark, sf_dir))


# Every third customer's id becomes negative, all lie beyond 2**53, where doubles skip integers.
SHIFT = 9007199254740993


def _shift(v: str) -> str:
    return f"CASE WHEN {v} % 3 = 0 THEN -{SHIFT} - {v} ELSE {SHIFT} + {v} END"


@register("bip_shifted", with_views(["cust_edges"], """
SELECT v, component, sign, conflict FROM sv""", ctes=f"""shifted AS (
    SELECT CAST({_shift("src")} AS BIGINT) AS src, CAST({_shift("trg")} AS BIGINT) AS trg FROM cust_edges
    UNION ALL SELECT CAST({_shift("src")} AS BIGINT), CAST({_shift("src")} AS BIGINT) FROM cust_edges WHERE src % 50 = 0),
{_cover("shifted")}""", recursive=True))
def bip_shifted(spark, sf_dir):
    e = cust_edges(spark, sf_dir)
    src, trg = F.expr(_shift("src")).cast("bigint").alias("src"), F.expr(_shift("trg")).cast("bigint").alias("trg")
    loops = e.where("src % 50 = 0").select(src, F.expr(_shift("src")).cast("bigint").alias("trg"))
    return B.vertex_signs(e.select(src, trg).unionByName(loops))
