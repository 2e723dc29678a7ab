"""Degree distribution under edge additions and deletions.

Per vertex the degree is a walk clamped at zero: ``d_i = max(0, d_{i-1} + chg_i)`` (a deletion at
degree 0 is ignored). The clamped walk has the closed form ``d_i = s_i - min(0, min_{j<=i} s_j)`` with
``s`` the running sum of ``chg``, so it needs only ordered running sums and minima, which
:class:`~edgegraph.operators.positions.OrderedFrame` computes without one task per vertex.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgegraph.operators.positions import OrderedFrame
from edgegraph.operators.transforms import endpoints


def clamped_walk(ends: DataFrame, order: Sequence[str]) -> DataFrame:
    """Endpoint events (v, ``order``, chg) with the degree before (``d_prev``) and after (``d_new``) each."""
    of = OrderedFrame(ends, ["v"], order).running("_s", F.col("chg").cast("long"), "sum")
    # t = running sum before this event; min over t covers s_0 = 0 .. s_{i-1}
    of = of.with_column("_t", F.col("_s") - F.col("chg"))
    of = of.running("_mt", F.col("_t"), "min")
    d_prev = F.col("_t") - F.least(F.lit(0), F.col("_mt"))
    d_new = F.col("_s") - F.least(F.lit(0), F.least(F.col("_mt"), F.col("_s")))
    return of.result().select("v", *order, "chg", d_prev.cast("bigint").alias("d_prev"), d_new.cast("bigint").alias("d_new"))


def _walk(signed: DataFrame, order: str) -> DataFrame:
    """:func:`clamped_walk` of all edges' ends; edges without a ``chg`` column are all additions."""
    if "chg" not in signed.columns:
        signed = signed.withColumn("chg", F.lit(1))
    return clamped_walk(endpoints(signed, "chg", order, side=True), [order, "side"])


def final_degrees(signed: DataFrame, order: str = "pos") -> DataFrame:
    """(v, degree) after all events, vertices with degree > 0."""
    w = _walk(signed, order)
    last = w.groupBy("v").agg(F.max_by("d_new", F.struct(order, "side")).alias("degree"))
    return last.where(F.col("degree") > 0)


def degree_distribution(signed: DataFrame, order: str = "pos") -> DataFrame:
    """Final (degree, n_vertices) histogram."""
    return (final_degrees(signed, order).groupBy("degree")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_vertices")))


def changes_of_walk(walk: DataFrame, order: Sequence[str]) -> DataFrame:
    """The events of :func:`clamped_walk` as changes (``order``, sub, degree, delta): (new degree, +1) when the new degree is
    positive, then (old degree, -1) when the old degree was positive; ``sub`` orders the two."""
    changes = F.array(
        F.struct(F.col("d_new").alias("degree"), F.lit(1).alias("delta"), F.lit(0).alias("sub"),
                 (F.col("d_new") > 0).alias("keep")),
        F.struct(F.col("d_prev").alias("degree"), F.lit(-1).alias("delta"), F.lit(1).alias("sub"),
                 (F.col("d_prev") > 0).alias("keep")))
    return (walk.select(*order, F.explode(changes).alias("c")).where(F.col("c.keep"))
            .select(*order, "c.sub", "c.degree", "c.delta"))


def degree_distribution_changelog(signed: DataFrame, order: str = "pos") -> DataFrame:
    """One row per (degree, +-1) change in event order with the running vertex count of that degree."""
    ev = changes_of_walk(_walk(signed, order), [order, "side"])
    run = OrderedFrame(ev, ["degree"], [order, "side", "sub"]).running("count", F.col("delta").cast("long"), "sum")
    return run.result().select(order, "side", "sub", "degree", "delta", F.col("count").cast("bigint").alias("count"))
