"""Per-window, per-vertex neighbourhood snapshots (``slice`` and its reduce/aggregate/fold/apply).

A snapshot is ``groupBy(window(ts, size), v)``; the user's function is given as Spark aggregate
expressions (partial + final aggregation, so a hub's neighbourhood is combined map-side and never
gathered into one task) instead of opaque per-neighbourhood code.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgegraph.functions import win_end_ms, win_start_ms
from edgegraph.operators.monoid import Monoid, fold
from edgegraph.operators.transforms import reverse, undirected


def slice_edges(edges: DataFrame, size: str, direction: str = "out") -> DataFrame:
    """Edges keyed by a vertex (``v``) and its neighbour (``nbr``) with the tumbling window column.

    ``out``: keyed by source; ``in``: by target (edges reversed); ``all``: both (undirected).
    """
    if direction == "out":
        e = edges
    elif direction == "in":
        e = reverse(edges)
    elif direction == "all":
        e = undirected(edges)
    else:
        raise ValueError("direction must be out, in or all")
    rest = [c for c in e.columns if c not in ("src", "trg")]
    return e.select(F.window("ts", size).alias("window"), F.col("src").alias("v"), F.col("trg").alias("nbr"), *rest)


def _finish(df: DataFrame) -> DataFrame:
    cols = [c for c in df.columns if c != "window"]
    return df.select(win_start_ms().alias("w_start"), win_end_ms().alias("w_end"), *cols)


def aggregate_neighbors(sliced: DataFrame, aggs: Sequence[Column]) -> DataFrame:
    """``aggregateNeighbors`` / ``reduceOnEdges`` / ``foldNeighbors``: aggregates per (window, vertex)."""
    return _finish(sliced.groupBy("window", "v").agg(*aggs))


def reduce_on_edges(sliced: DataFrame, value: str, op: str) -> DataFrame:
    fn = {"sum": F.sum, "min": F.min, "max": F.max}[op]
    return aggregate_neighbors(sliced, [fn(value).alias(f"{op}_{value}")])


def neighborhood_summary(sliced: DataFrame) -> DataFrame:
    """Edges and distinct neighbours, as two levels of plain aggregates: per neighbour, then per vertex."""
    per_nbr = sliced.groupBy("window", "v", "nbr").agg(F.count(F.lit(1)).alias("_n"))
    return _finish(per_nbr.groupBy("window", "v").agg(F.sum("_n").cast("bigint").alias("n_edges"),
                                                      F.count(F.lit(1)).cast("bigint").alias("n_nbrs")))


def fold_neighbors(sliced: DataFrame, order: str = "pos") -> DataFrame:
    """An order-dependent fold expressed by order-keyed aggregates: first and last neighbour, count."""
    return aggregate_neighbors(sliced, [F.min_by("nbr", order).alias("first_nbr"),
                                        F.max_by("nbr", order).alias("last_nbr"),
                                        F.count(F.lit(1)).cast("bigint").alias("n_edges")])


def fold_edges(sliced: DataFrame, monoid: Monoid, order: str | None = None, name: str = "result", block: int = 256) -> DataFrame:
    """User fold of every neighbourhood (:class:`~edgegraph.operators.monoid.Monoid` over the edges' columns). With ``order`` the
    edges are folded in arrival order and the merge need not commute; the result doesn't depend on ``block``, and a hub's
    edges are spread over tasks either way."""
    return _finish(fold(sliced, ["window", "v"], monoid, None if order is None else [order], name, block))


def apply_on_neighbors(sliced: DataFrame, value: str = "amount", aggs: Sequence[Column] | None = None,
                       keep: Column | None = None, output: Sequence[Column] | None = None) -> DataFrame:
    """``applyOnNeighbors`` emitting 0..n rows per neighbourhood: the user's aggregates of the neighbourhood (``aggs``, aliased) are
    joined back to its edges, the rows where ``keep`` holds stay and ``output`` columns are emitted.

    By default the neighbours whose edge value is at least the neighbourhood mean. No group is collected."""
    if aggs is None:
        aggs = [F.sum(value).alias("_s"), F.count(F.lit(1)).alias("_n")]
        keep = F.col(value) * F.col("_n") >= F.col("_s")
    stats = sliced.groupBy("window", "v").agg(*aggs)
    out = [F.col("nbr"), F.col(value)] if output is None else list(output)
    rows = sliced.join(stats, ["window", "v"])
    return _finish((rows if keep is None else rows.where(keep)).select("window", "v", *out))
