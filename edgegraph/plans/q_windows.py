"""sliding keyed sums and count windows."""

from __future__ import annotations

from edgegraph.operators import windows as Wn
from edgegraph.plans.catalog import register
from edgegraph.plans.oracle_views import with_views
from edgegraph.sources import user_edges

H2, H1 = 2 * 3600000, 3600000


@register("win_sliding_sum", with_views(["user_edges"], f"""
SELECT w_start, w_start + {H2} AS w_end, src, CAST(sum(amount) AS BIGINT) AS sum_amount FROM (
  SELECT *, ts - ts % {H1} - {H1} * unnest(range(0, {H2 // H1 + 1})) AS w_start FROM user_edges)
WHERE w_start <= ts AND ts < w_start + {H2} GROUP BY w_start, src"""))
def win_sliding_sum(spark, sf_dir):
    return Wn.sliding_sum(user_edges(spark, sf_dir, pos=False), "2 hours", "1 hour")


@register("win_count_tumbling", with_views(["user_edges"], """
SELECT (rn - 1) // 5 AS bucket, count(*) AS n_edges, CAST(sum(amount) AS BIGINT) AS sum_amount,
       min(rn) AS first_pos, max(rn) AS last_pos
FROM (SELECT amount, row_number() OVER (ORDER BY ts, pos) AS rn FROM user_edges) GROUP BY bucket"""))
def win_count_tumbling(spark, sf_dir):
    return Wn.count_windows(user_edges(spark, sf_dir), 5, ["ts", "pos"])
