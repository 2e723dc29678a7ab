"""Degree distribution with deletions (signed events view)."""

from __future__ import annotations

from edgegraph.operators import degree_dist as DD
from edgegraph.plans.catalog import register
from edgegraph.plans.oracle_views import with_views
from edgegraph.sources import signed_edges

WALK = """
ends AS (SELECT src AS v, pos, 0 AS side, chg FROM signed_edges UNION ALL SELECT trg, pos, 1, chg FROM signed_edges),
run AS (SELECT *, sum(chg) OVER w AS s, sum(chg) OVER w - chg AS t FROM ends
        WINDOW w AS (PARTITION BY v ORDER BY pos, side ROWS UNBOUNDED PRECEDING)),
walk AS (SELECT *, CAST(t - least(0, min(t) OVER w) AS BIGINT) AS d_prev,
                 CAST(s - least(0, least(min(t) OVER w, s)) AS BIGINT) AS d_new FROM run
         WINDOW w AS (PARTITION BY v ORDER BY pos, side ROWS UNBOUNDED PRECEDING))"""


@register("deg_dist_final", with_views(["signed_edges"], """
SELECT degree, count(*) AS n_vertices FROM (
  SELECT v, arg_max(d_new, pos * 2 + side) AS degree FROM walk GROUP BY v) WHERE degree > 0 GROUP BY degree""",
    ctes=WALK))
def deg_dist_final(spark, sf_dir):
    return DD.degree_distribution(signed_edges(spark, sf_dir))


@register("deg_dist_changelog", with_views(["signed_edges"], """
SELECT pos, side, sub, degree, delta,
       CAST(sum(delta) OVER (PARTITION BY degree ORDER BY pos, side, sub ROWS UNBOUNDED PRECEDING) AS BIGINT) AS count
FROM (SELECT pos, side, 0 AS sub, d_new AS degree, 1 AS delta FROM walk WHERE d_new > 0
      UNION ALL SELECT pos, side, 1, d_prev, -1 FROM walk WHERE d_prev > 0)""", ctes=WALK))
def deg_dist_changelog(spark, sf_dir):
    return DD.degree_distribution_changelog(signed_edges(spark, sf_dir))
