"""Declarative mergeable summaries per window (bulk, tree, transient)."""

from __future__ import annotations

from pyspark.sql import functions as F

from edgegraph.operators import summary as Su
from edgegraph.operators.monoid import Monoid
from edgegraph.plans.catalog import register
from edgegraph.plans.oracle_views import with_views
from edgegraph.sources import user_edges

W = 6 * 3600000
SIZE = "6 hours"
PER_WINDOW = f"""pw AS (SELECT ts - ts % {W} AS w_start, count(*) AS n_edges, min(amount) AS min_amount,
                      max(amount) AS max_amount, sum(amount) AS sum_amount FROM user_edges GROUP BY 1)"""
CUMULATIVE = f"""
SELECT w_start, w_start + {W} AS w_end,
       CAST(sum(n_edges) OVER w AS BIGINT) AS n_edges, CAST(min(min_amount) OVER w AS BIGINT) AS min_amount,
       CAST(max(max_amount) OVER w AS BIGINT) AS max_amount, CAST(sum(sum_amount) OVER w AS BIGINT) AS sum_amount
FROM pw WINDOW w AS (ORDER BY w_start ROWS UNBOUNDED PRECEDING)"""


@register("summary_bulk", with_views(["user_edges"], CUMULATIVE, ctes=PER_WINDOW))
def summary_bulk(spark, sf_dir):
    return Su.summarize_bulk(user_edges(spark, sf_dir, pos=False), SIZE, Su.edge_stats_spec("amount"))


@register("summary_tree", with_views(["user_edges"], CUMULATIVE, ctes=PER_WINDOW))
def summary_tree(spark, sf_dir):
    return Su.summarize_tree(user_edges(spark, sf_dir, pos=False), SIZE, Su.edge_stats_spec("amount"))


@register("summary_transient", with_views(["user_edges"], f"""
SELECT w_start, w_start + {W} AS w_end, CAST(n_edges AS BIGINT) AS n_edges, min_amount, max_amount,
       CAST(sum_amount AS BIGINT) AS sum_amount FROM pw""", ctes=PER_WINDOW))
def summary_transient(spark, sf_dir):
    return Su.summarize_bulk(user_edges(spark, sf_dir, pos=False), SIZE, Su.edge_stats_spec("amount"), cumulative=False)


# Quarters of a cent are exact in a double, so sums in any order agree to the last bit.
HALVES = f"""pw AS (SELECT ts - ts % {W} AS w_start, count(*) AS n_edges, min(amount * 0.25::DOUBLE) AS min_v,
                    max(amount * 0.25::DOUBLE) AS max_v, sum(amount * 0.25::DOUBLE) AS sum_v FROM user_edges GROUP BY 1)"""


def _double_spec():
    v = F.col("amount") * F.lit(0.25)
    return [Su.Field("n_edges", F.count(F.lit(1)), "sum", "sum"), Su.Field("min_v", F.min(v), "min", "min"),
            Su.Field("max_v", F.max(v), "max", "max"), Su.Field("sum_v", F.sum(v), "sum", "sum")]


@register("summary_double", with_views(["user_edges"], f"""
SELECT w_start, w_start + {W} AS w_end, CAST(sum(n_edges) OVER w AS BIGINT) AS n_edges, min(min_v) OVER w AS min_v,
       max(max_v) OVER w AS max_v, sum(sum_v) OVER w AS sum_v
FROM pw WINDOW w AS (ORDER BY w_start ROWS UNBOUNDED PRECEDING)""", ctes=HALVES))
def summary_double(spark, sf_dir):
    """Fractional values keep their type."""
    return Su.summarize_tree(user_edges(spark, sf_dir, pos=False), SIZE, _double_spec())


def trail(order: str = "pos") -> Monoid:
    """First and last edge of a stretch, its length, and how often an edge starts where the one before it ended: a struct state
    whose merge looks at the seam, so it doesn't commute."""
    one = F.lit(1).cast("bigint")
    return Monoid(
        F.struct(F.col("src").alias("first_src"), F.col("trg").alias("last_trg"), one.alias("n"), F.lit(0).cast("bigint").alias("joined")),
        lambda a, b: F.struct(a["first_src"].alias("first_src"), b["last_trg"].alias("last_trg"), (a["n"] + b["n"]).alias("n"),
                              (a["joined"] + b["joined"] + (a["last_trg"] == b["first_src"]).cast("bigint")).alias("joined")))


TRAIL = f"""e AS (SELECT *, ts - ts % {W} AS w_start, lag(trg) OVER (PARTITION BY ts - ts % {W} ORDER BY pos) AS before FROM user_edges),
pw AS (SELECT w_start, arg_min(src, pos) AS first_src, arg_max(trg, pos) AS last_trg, count(*) AS n,
              count(*) FILTER (before = src) AS joined FROM e GROUP BY w_start)"""
TRAIL_CUMULATIVE = f"""
SELECT w_start, w_start + {W} AS w_end, first_value(first_src) OVER w AS first_src, last_trg, CAST(sum(n) OVER w AS BIGINT) AS n,
       CAST(sum(joined + CASE WHEN seam THEN 1 ELSE 0 END) OVER w AS BIGINT) AS joined
FROM (SELECT *, coalesce(lag(last_trg) OVER (ORDER BY w_start) = first_src, false) AS seam FROM pw)
WINDOW w AS (ORDER BY w_start ROWS UNBOUNDED PRECEDING)"""


def _trail(spark, sf_dir, summarize, **options):
    out = summarize(user_edges(spark, sf_dir), SIZE, [Su.StateField("t", trail())], **options)
    return out.select("w_start", "w_end", "t.*")


@register("summary_state_bulk", with_views(["user_edges"], TRAIL_CUMULATIVE, ctes=TRAIL))
def summary_state_bulk(spark, sf_dir):
    return _trail(spark, sf_dir, Su.summarize_bulk)


@register("summary_state_tree", with_views(["user_edges"], TRAIL_CUMULATIVE, ctes=TRAIL))
def summary_state_tree(spark, sf_dir):
    return _trail(spark, sf_dir, Su.summarize_tree)


@register("summary_state_transient", with_views(["user_edges"], f"""
SELECT w_start, w_start + {W} AS w_end, first_src, last_trg, n, joined FROM pw""", ctes=TRAIL))
def summary_state_transient(spark, sf_dir):
    return _trail(spark, sf_dir, Su.summarize_bulk, cumulative=False)


@register("summary_distinct", with_views(["user_edges"], f"""
SELECT w_start, w_start + {W} AS w_end, CAST(sum(n) OVER (ORDER BY w_start) AS BIGINT) AS n_vertices, true AS within_error
FROM (SELECT w.w_start, count(v) AS n FROM (SELECT DISTINCT ts - ts % {W} AS w_start FROM user_edges) w LEFT JOIN (
        SELECT v, min(ts - ts % {W}) AS w_start FROM (SELECT src AS v, ts FROM user_edges UNION ALL SELECT trg, ts FROM user_edges)
        GROUP BY v) f USING (w_start) GROUP BY w.w_start)"""))
def summary_distinct(spark, sf_dir):
    """Distinct vertices so far, window by window: a merged sketch beside the exact count of first sights."""
    e = user_edges(spark, sf_dir, pos=False)
    ends = e.select(F.explode(F.array("src", "trg")).alias("src"), "ts").withColumn("trg", F.col("src"))
    sketched = Su.summarize_bulk(ends, SIZE, [Su.distinct_field("sketch", F.col("src"))])
    first = ends.groupBy("src").agg(F.min("ts").alias("ts")).withColumn("trg", F.col("src"))
    exact = Su.summarize_bulk(first.withColumn("k", F.lit(1).cast("bigint")).unionByName(ends.withColumn("k", F.lit(0).cast("bigint"))), SIZE,
                              [Su.Field("n_vertices", F.sum("k"), "sum", "sum")])
    guess = F.hll_sketch_estimate("sketch")
    return sketched.join(exact, ["w_start", "w_end"]).select(
        "w_start", "w_end", "n_vertices", (F.abs(guess - F.col("n_vertices")) <= 4 * 1.04 / 64 * F.col("n_vertices") + 1).alias("within_error"))
