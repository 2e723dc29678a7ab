"""Weighted matching over the rating-style bipartite view.

The oracle runs the same locally dominant rounds as a recursive CTE: each iteration keeps the edges
picked by both endpoints (heaviest, then smaller ids) and drops edges touching them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from edgegraph.operators import matching as Ma
from edgegraph.plans.catalog import register
from edgegraph.sources import edge_lines
from edgegraph.sources.text import decode

def _rounds(order: str, weight: str = "CAST(l_quantity AS BIGINT) * 10") -> str:
    return f"""
e AS (SELECT least(l_suppkey, l_partkey + 1000000) AS a, greatest(l_suppkey, l_partkey + 1000000) AS b,
             max({weight}) AS w
      FROM lineitem WHERE l_suppkey <> l_partkey + 1000000 GROUP BY 1, 2),
r(a, b, w, st) AS (
  SELECT a, b, w, 'L' FROM e
  UNION ALL
  (WITH live AS (SELECT a, b, w FROM r WHERE st = 'L'),
        ends AS (SELECT a AS v, a, b, w FROM live UNION ALL SELECT b AS v, a, b, w FROM live),
        best AS (SELECT v, a, b FROM (
                   SELECT *, row_number() OVER (PARTITION BY v ORDER BY {order}) AS rn FROM ends) WHERE rn = 1),
        picked AS (SELECT a, b FROM best GROUP BY a, b HAVING count(*) = 2),
        used AS (SELECT a AS v FROM picked UNION SELECT b FROM picked)
   SELECT l.a, l.b, l.w, 'N' FROM live l JOIN picked p ON l.a = p.a AND l.b = p.b
   UNION ALL
   SELECT l.a, l.b, l.w, 'L' FROM live l WHERE l.a NOT IN (SELECT v FROM used) AND l.b NOT IN (SELECT v FROM used)))"""


ROUNDS = _rounds("w DESC, a, b")
CLASSES = _rounds("CASE WHEN w > 0 THEN length(bin(w)) ELSE 0 END DESC, "
                  "CAST('0x' || substr(md5('match:' || a || ':' || b), 1, 15) AS BIGINT) DESC, a, b")


def _ratings(spark, sf_dir):
    return decode(edge_lines(spark, sf_dir, "rating"), "rating")


@register("match_locally_dominant", "WITH RECURSIVE " + ROUNDS.strip() + """
SELECT a AS src, b AS trg, w AS weight FROM r WHERE st = 'N'""")
def match_locally_dominant(spark, sf_dir):
    return Ma.locally_dominant_matching(_ratings(spark, sf_dir), "amount")


@register("match_final_weight", "WITH RECURSIVE " + ROUNDS.strip() + """
SELECT CAST(count(*) AS BIGINT) AS n_matched, CAST(coalesce(sum(w), 0) AS BIGINT) AS total_weight FROM r WHERE st = 'N'""")
def match_final_weight(spark, sf_dir):
    return Ma.matching_weight(Ma.locally_dominant_matching(_ratings(spark, sf_dir), "amount"))


@register("match_weight_classes", "WITH RECURSIVE " + CLASSES.strip() + """
SELECT a AS src, b AS trg, w AS weight FROM r WHERE st = 'N'""")
def match_weight_classes(spark, sf_dir):
    return Ma.weight_class_matching(_ratings(spark, sf_dir), "amount")


def _fractional(spark, sf_dir):
    return _ratings(spark, sf_dir).withColumn("amount", F.col("amount") * F.lit(0.025))


QUARTERS = "CAST(l_quantity AS BIGINT) * 10 * 0.025::DOUBLE"


@register("match_fractional", "WITH RECURSIVE " + _rounds("w DESC, a, b", QUARTERS).strip() + """
SELECT a AS src, b AS trg, w AS weight FROM r WHERE st = 'N'""")
def match_fractional(spark, sf_dir):
    """Weights in fractions: 0.25 times the quantity."""
    return Ma.locally_dominant_matching(_fractional(spark, sf_dir), "amount")


@register("match_fractional_classes", "WITH RECURSIVE " + _rounds(
    "floor(log2(w * 1024.0::DOUBLE + 0.001)) DESC, CAST('0x' || substr(md5('match:' || a || ':' || b), 1, 15) AS BIGINT) DESC, a, b",
    QUARTERS).strip() + """
SELECT a AS src, b AS trg, w AS weight FROM r WHERE st = 'N'""")
def match_fractional_classes(spark, sf_dir):
    return Ma.weight_class_matching(_fractional(spark, sf_dir), "amount")


@register("match_events", """
SELECT count(*) AS n_edges, true AS disjoint, true AS rebuilt, true AS within_factor
FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem WHERE l_suppkey <> l_partkey + 1000000)""")
def match_events(spark, sf_dir):
    """The preemptive matching over all ratings in two batches: vertex-disjoint, rebuilt by its events, and within its factor of
    the greedy one (which is at most the optimum)."""
    e = _ratings(spark, sf_dir)
    half = F.pmod(F.xxhash64("src", "trg"), F.lit(2)) == 0
    nothing = e.select("src", "trg", F.col("amount").alias("weight")).where(F.lit(False))
    first, log1 = Ma.preempt(nothing, e.where(half))
    final, log2 = Ma.preempt(first, e.where(~half))
    log = log1.unionByName(log2).groupBy("src", "trg", "weight").agg(F.sum(F.when(F.col("op") == "ADD", 1).otherwise(-1)).alias("n"))
    differ = (log.where("n <> 0").withColumn("x", F.col("n")).select("src", "trg", "weight", "x")
              .unionByName(final.withColumn("x", F.lit(-1).cast("bigint"))).groupBy("src", "trg", "weight").agg(F.sum("x").alias("x")).where("x <> 0"))
    ends = final.select(F.explode(F.array("src", "trg")).alias("v")).groupBy("v").count().where("count > 1")
    ours, greedy = Ma.matching_weight(final).first(), Ma.matching_weight(Ma.locally_dominant_matching(e)).first()
    ok = [not ends.limit(1).count(), not differ.limit(1).count(), ours["total_weight"] * 6 >= greedy["total_weight"]]
    pairs = e.where("src <> trg").select(F.least("src", "trg").alias("a"), F.greatest("src", "trg").alias("b")).distinct()
    return pairs.agg(F.count(F.lit(1)).alias("n_edges")).select(
        "n_edges", *[F.lit(x).alias(n) for x, n in zip(ok, ("disjoint", "rebuilt", "within_factor"))])
