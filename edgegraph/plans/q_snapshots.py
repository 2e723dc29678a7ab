"""Per-window, per-vertex neighbourhood snapshots over the user transition graph (6 h windows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from edgegraph.operators import snapshot as S
from edgegraph.operators.monoid import Monoid
from edgegraph.plans.catalog import register
from edgegraph.plans.oracle_views import with_views
from edgegraph.sources import user_edges

W = 6 * 3600000
SIZE = "6 hours"
OUT = f"SELECT ts - ts % {W} AS w_start, src AS v, trg AS nbr, amount, pos FROM user_edges"
IN = f"SELECT ts - ts % {W} AS w_start, trg AS v, src AS nbr, amount, pos FROM user_edges"
ALL = f"{OUT} UNION ALL {IN}"


def _sql(view: str, select: str) -> str:
    return with_views(["user_edges"], f"""
SELECT w_start, w_start + {W} AS w_end, v, {select} FROM s GROUP BY w_start, v""", ctes=f"s AS ({view})")


SUMMARY = "count(*) AS n_edges, count(DISTINCT nbr) AS n_nbrs"


@register("slice_out", _sql(OUT, SUMMARY))
def slice_out(spark, sf_dir):
    return S.neighborhood_summary(S.slice_edges(user_edges(spark, sf_dir, pos=False), SIZE, "out"))


@register("slice_in", _sql(IN, SUMMARY))
def slice_in(spark, sf_dir):
    return S.neighborhood_summary(S.slice_edges(user_edges(spark, sf_dir, pos=False), SIZE, "in"))


@register("slice_all", _sql(ALL, SUMMARY))
def slice_all(spark, sf_dir):
    return S.neighborhood_summary(S.slice_edges(user_edges(spark, sf_dir, pos=False), SIZE, "all"))


def _reduce(op):
    @register(f"slice_reduce_{op}", _sql(ALL, f"CAST({op}(amount) AS BIGINT) AS {op}_amount"))
    def q(spark, sf_dir):
        return S.reduce_on_edges(S.slice_edges(user_edges(spark, sf_dir, pos=False), SIZE, "all"), "amount", op) \
            .withColumn(f"{op}_amount", F.col(f"{op}_amount").cast("bigint"))
    return q


for _op in ("sum", "min", "max"):
    _reduce(_op)


@register("slice_aggregate_neighbors", _sql(ALL, """count(*) AS n_edges, CAST(sum(amount) AS BIGINT) AS total_amount,
       max(nbr) AS max_nbr"""))
def slice_aggregate_neighbors(spark, sf_dir):
    sl = S.slice_edges(user_edges(spark, sf_dir, pos=False), SIZE, "all")
    return S.aggregate_neighbors(sl, [F.count(F.lit(1)).cast("bigint").alias("n_edges"),
                                      F.sum("amount").cast("bigint").alias("total_amount"),
                                      F.max("nbr").alias("max_nbr")])


@register("slice_fold_neighbors", _sql(OUT, """arg_min(nbr, pos) AS first_nbr, arg_max(nbr, pos) AS last_nbr,
       count(*) AS n_edges"""))
def slice_fold_neighbors(spark, sf_dir):
    return S.fold_neighbors(S.slice_edges(user_edges(spark, sf_dir), SIZE, "out"), "pos")


@register("slice_apply_neighbors", with_views(["user_edges"], f"""
SELECT s.w_start, s.w_start + {W} AS w_end, s.v, s.nbr, s.amount FROM s
JOIN (SELECT w_start, v, sum(amount) AS t, count(*) AS n FROM s GROUP BY ALL) g USING (w_start, v)
WHERE s.amount * g.n >= g.t""", ctes=f"s AS ({ALL})"))
def slice_apply_neighbors(spark, sf_dir):
    return S.apply_on_neighbors(S.slice_edges(user_edges(spark, sf_dir, pos=False), SIZE, "all"), "amount")


PRIME = 1000003


@register("slice_fold_product", _sql(ALL, f"""
       list_reduce(list_concat([1::BIGINT], list((amount % {PRIME})::BIGINT)), lambda a, x: a * x % {PRIME}) AS product"""))
def slice_fold_product(spark, sf_dir):
    """Product of the amounts modulo a prime: a fold that no built-in aggregate gives."""
    sl = S.slice_edges(user_edges(spark, sf_dir, pos=False), SIZE, "all")
    mod = F.lit(PRIME).cast("bigint")
    times = Monoid((F.col("amount") % mod).cast("bigint"), lambda a, x: a * x % mod, zero=F.lit(1))
    return S.fold_edges(sl, times, name="product", block=16)


@register("slice_fold_ordered", _sql(ALL, """string_agg(nbr, '>' ORDER BY pos, nbr) AS path,
       'v' || v || string_agg('>' || nbr, '' ORDER BY pos, nbr) AS named"""))
def slice_fold_ordered(spark, sf_dir):
    """Neighbours in arrival order as one string: a fold that doesn't commute, with and without a start value."""
    sl = S.slice_edges(user_edges(spark, sf_dir), SIZE, "all")
    path = Monoid(F.col("nbr").cast("string"), lambda a, b: F.concat(a, F.lit(">"), b))
    return S.fold_edges(sl, path, "pos", "path", block=8).withColumn("named", F.concat(F.lit("v"), "v", F.lit(">"), "path"))


@register("slice_apply_top", with_views(["user_edges"], f"""
SELECT s.w_start, s.w_start + {W} AS w_end, s.v, s.nbr, s.amount * 100 // g.t AS share FROM s
JOIN (SELECT w_start, v, CAST(sum(amount) AS BIGINT) AS t, max(amount) AS m FROM s GROUP BY ALL) g USING (w_start, v)
WHERE s.amount = g.m AND g.t > 0""", ctes=f"s AS ({ALL})"))
def slice_apply_top(spark, sf_dir):
    """Neighbours with the largest amount and their share of the total: user aggregates, row rule and output."""
    sl = S.slice_edges(user_edges(spark, sf_dir, pos=False), SIZE, "all")
    return S.apply_on_neighbors(sl, aggs=[F.sum("amount").alias("t"), F.max("amount").alias("m")],
                                keep=(F.col("amount") == F.col("m")) & (F.col("t") > 0),
                                output=[F.col("nbr"), F.expr("amount * 100 div t").alias("share")])
