"""Sampled triangle estimators (broadcast and incidence forms, estimates at prefixes)."""

from __future__ import annotations

from pyspark.sql import functions as F

from edgegraph.operators import estimators as Es
from edgegraph.plans.catalog import register
from edgegraph.plans.oracle_views import with_views
from edgegraph.sources import user_edges

# Fixed parameters: sample count and seed.
S = 2000
SEED = Es.DEFAULT_SEED
HEX = "1152921504606846976.0"


def _h(tag: str) -> str:
    return f"CAST('0x' || substr(md5('{SEED}:{tag}:' || i || ':' || p), 1, 15) AS BIGINT)"


def _sql(prefix_expr: str) -> str:
    return with_views(["user_edges"], f"""
SELECT l.lim AS n_edges, CAST(coalesce(b.beta_sum, 0) AS BIGINT) AS beta_sum,
       CAST(floor((1.0 / {S}) * coalesce(b.beta_sum, 0) * l.lim * ((SELECT n FROM st) - 2)) AS BIGINT) AS estimate
FROM lims l LEFT JOIN (SELECT lim, sum(beta) AS beta_sum FROM beta GROUP BY lim) b USING (lim)""", ctes=f"""
st AS (SELECT count(*) AS m, (SELECT count(DISTINCT v) FROM (SELECT src AS v FROM user_edges UNION ALL SELECT trg FROM user_edges)) AS n
       FROM user_edges),
rk AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS r FROM (SELECT src AS v FROM user_edges UNION SELECT trg FROM user_edges)),
lims AS ({prefix_expr}),
c(i, p) AS (SELECT range AS i, CAST(1 AS BIGINT) FROM range(0, {S})
    UNION ALL SELECT i, CAST(floor(p / (({_h('e')} + 1) / {HEX})) + 1 AS BIGINT) FROM c
    WHERE p <= (SELECT m FROM st)),
last AS (SELECT i, lim, max(p) AS p FROM c JOIN lims ON c.p <= lims.lim GROUP BY i, lim),
smp AS (SELECT i, lim, p, src AS a, trg AS b, least(x.r, y.r) AS lo, greatest(x.r, y.r) AS hi,
               {_h('t')} % ((SELECT n FROM st) - 2) AS h2, {_h('t')} % ((SELECT n FROM st) - 1) AS h1
        FROM last JOIN user_edges ON user_edges.pos = last.p JOIN rk x ON x.v = src JOIN rk y ON y.v = trg),
smp2 AS (SELECT *, CASE WHEN lo = hi THEN (CASE WHEN h1 < lo THEN h1 ELSE h1 + 1 END)
                        WHEN h2 < lo THEN h2 WHEN h2 + 1 < hi THEN h2 + 1 ELSE h2 + 2 END AS tr FROM smp),
smp3 AS (SELECT smp2.*, rk.v AS t FROM smp2 JOIN rk ON rk.r = tr),
need AS (SELECT DISTINCT i, lim, p, x, y FROM (
    SELECT i, lim, p, least(a, t) AS x, greatest(a, t) AS y FROM smp3
    UNION ALL SELECT i, lim, p, least(b, t), greatest(b, t) FROM smp3)),
nneed AS (SELECT i, lim, count(*) AS k FROM need GROUP BY i, lim),
hit AS (SELECT DISTINCT need.i, need.lim, need.x, need.y FROM need JOIN user_edges e
        ON least(e.src, e.trg) = need.x AND greatest(e.src, e.trg) = need.y AND e.pos > need.p AND e.pos <= need.lim),
beta AS (SELECT h.i, h.lim, CASE WHEN count(*) = max(n.k) THEN 1 ELSE 0 END AS beta
         FROM hit h JOIN nneed n USING (i, lim) GROUP BY h.i, h.lim)""", recursive=True)


FULL = "SELECT m AS lim FROM st"
PREFIXES = "SELECT CAST(ceil(m * q / 4.0) AS BIGINT) AS lim FROM st, (VALUES (1), (2), (3), (4)) v(q)"


@register("tri_est_broadcast", _sql(FULL))
def tri_est_broadcast(spark, sf_dir):
    return Es.estimate(user_edges(spark, sf_dir), S, SEED, "broadcast")


@register("tri_est_incidence", _sql(FULL))
def tri_est_incidence(spark, sf_dir):
    return Es.estimate(user_edges(spark, sf_dir), S, SEED, "incidence")


@register("tri_est_prefixes", _sql(PREFIXES))
def tri_est_prefixes(spark, sf_dir):
    e = user_edges(spark, sf_dir)
    m = e.count()
    prefixes = [-(-m * q // 4) for q in (1, 2, 3, 4)]
    return Es.estimate(e, S, SEED, "broadcast", prefixes=prefixes)


@register("tri_est_sparse_ids", _sql(FULL))
def tri_est_sparse_ids(spark, sf_dir):
    """The same graph under sparse and partly negative ids gives the same estimate."""
    e = user_edges(spark, sf_dir)
    for c in ("src", "trg"):
        e = e.withColumn(c, F.col(c) * 1000003 - 7_000_000)
    return Es.estimate(e, S, SEED, "incidence")
