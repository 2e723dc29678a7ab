"""H8, H9, C11: exact triangles (global, local with the -1 global row, changelog) and windowed triangles."""

from __future__ import annotations

from edgegraph.operators import triangles as Tr
from edgegraph.plans.catalog import register
from edgegraph.plans.oracle_views import with_views
from edgegraph.sources import user_edges

E = "e AS (SELECT DISTINCT least(src, trg) AS a, greatest(src, trg) AS b FROM user_edges WHERE src <> trg)"
T = "t AS (SELECT x.a AS x1, x.b AS x2, y.b AS x3 FROM e x JOIN e y ON x.b = y.a JOIN e z ON z.a = x.a AND z.b = y.b)"


@register("tri_exact_global", with_views(["user_edges"], "SELECT CAST(count(*) AS BIGINT) AS triangles FROM t",
                                         ctes=E + ",\n" + T))
def tri_exact_global(spark, sf_dir):
    return Tr.triangle_count(user_edges(spark, sf_dir, pos=False))


@register("tri_exact_local", with_views(["user_edges"], """
SELECT v, CAST(count(*) AS BIGINT) AS triangles FROM (SELECT x1 AS v FROM t UNION ALL SELECT x2 FROM t UNION ALL SELECT x3 FROM t)
GROUP BY v UNION ALL SELECT -1, CAST(count(*) AS BIGINT) FROM t""", ctes=E + ",\n" + T))
def tri_exact_local(spark, sf_dir):
    return Tr.local_triangles(user_edges(spark, sf_dir, pos=False))


@register("tri_exact_changelog", with_views(["user_edges"], """
SELECT pos, CAST(count(*) AS BIGINT) AS new_triangles,
       CAST(sum(count(*)) OVER (ORDER BY pos) AS BIGINT) AS total_triangles FROM tp GROUP BY pos""", ctes="""
f AS (SELECT least(src, trg) AS a, greatest(src, trg) AS b, min(pos) AS p FROM user_edges WHERE src <> trg GROUP BY 1, 2),
tp AS (SELECT greatest(x.p, y.p, z.p) AS pos FROM f x JOIN f y ON x.b = y.a JOIN f z ON z.a = x.a AND z.b = y.b)"""))
def tri_exact_changelog(spark, sf_dir):
    return Tr.triangle_changelog(user_edges(spark, sf_dir))


W6 = 6 * 3600000


@register("tri_window", with_views(["user_edges"], f"""
SELECT ws.w + {W6} - 1 AS w_max_ts, CAST(coalesce(tc.n, 0) AS BIGINT) AS triangles
FROM (SELECT DISTINCT ts - ts % {W6} AS w FROM user_edges) ws LEFT JOIN tc USING (w)""", ctes=f"""
we AS (SELECT DISTINCT ts - ts % {W6} AS w, least(src, trg) AS a, greatest(src, trg) AS b FROM user_edges WHERE src <> trg),
tc AS (SELECT x.w, count(*) AS n FROM we x JOIN we y ON x.w = y.w AND x.b = y.a
       JOIN we z ON z.w = x.w AND z.a = x.a AND z.b = y.b GROUP BY x.w)"""))
def tri_window(spark, sf_dir):
    return Tr.window_triangles(user_edges(spark, sf_dir, pos=False), "6 hours")
