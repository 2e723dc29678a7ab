"""Edge-stream transforms (projections, filters, orientation, union). All narrow except distinct."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EDGE_COLS = ("src", "trg")


def _others(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in EDGE_COLS]


def vertices(edges: DataFrame) -> DataFrame:
    """Distinct endpoints (``v``). One explode, then a map-side-combined distinct."""
    return edges.select(F.explode(F.array("src", "trg")).alias("v")).distinct()


def map_edges(edges: DataFrame, value: Column, name: str = "value", drop: tuple[str, ...] = ()) -> DataFrame:
    """Replace the edge value by an expression over the edge's columns."""
    return edges.withColumn(name, value).drop(*drop)


def remove_value(edges: DataFrame) -> DataFrame:
    return edges.select("src", "trg")


def filter_vertices(edges: DataFrame, pred: Callable[[Column], Column]) -> DataFrame:
    """Keep an edge iff both endpoints satisfy ``pred`` (a Column function over a vertex id)."""
    return edges.where(pred(F.col("src")) & pred(F.col("trg")))


def filter_edges(edges: DataFrame, cond: Column) -> DataFrame:
    return edges.where(cond)


def distinct(edges: DataFrame) -> DataFrame:
    """Distinct (src, trg) pairs."""
    return edges.select("src", "trg").distinct()


def distinct_first(edges: DataFrame, order: str = "pos") -> DataFrame:
    """The first edge (by ``order``) of every (src, trg) pair, with its other columns.

    ``min_by`` is a declarative aggregate, so repeated pairs combine map-side before the shuffle.
    """
    rest = _others(edges)
    first = F.min_by(F.struct(*[F.col(c) for c in rest]), F.col(order)).alias("_first")
    return edges.groupBy("src", "trg").agg(first).select("src", "trg", *[F.col(f"_first.{c}").alias(c) for c in rest])


def reverse(edges: DataFrame) -> DataFrame:
    rest = _others(edges)
    return edges.select(F.col("trg").alias("src"), F.col("src").alias("trg"), *rest)


def undirected(edges: DataFrame) -> DataFrame:
    """Each edge and its reverse (two rows per edge, one scan)."""
    rest = _others(edges)
    both = F.explode(F.array(F.struct(F.col("src").alias("a"), F.col("trg").alias("b")),
                             F.struct(F.col("trg").alias("a"), F.col("src").alias("b")))).alias("_e")
    return edges.select(both, *rest).select(F.col("_e.a").alias("src"), F.col("_e.b").alias("trg"), *rest)


def canonical(edges: DataFrame) -> DataFrame:
    """Orientation (min id, max id)."""
    rest = _others(edges)
    return edges.select(F.least("src", "trg").alias("src"), F.greatest("src", "trg").alias("trg"), *rest)


def union(edges: DataFrame, other: DataFrame) -> DataFrame:
    """Multiset union by column name (missing columns become null)."""
    return edges.unionByName(other, allowMissingColumns=True)


def endpoints(edges: DataFrame, *extra: str, side: bool = False) -> DataFrame:
    """Edge -> its two endpoint rows ``v`` (with ``side`` 0 = source, 1 = target)."""
    pair = F.array(F.struct(F.col("src").alias("v"), F.lit(0).alias("side")),
                   F.struct(F.col("trg").alias("v"), F.lit(1).alias("side")))
    out = edges.select(F.explode(pair).alias("_x"), *extra).select("_x.v", "_x.side", *extra)
    return out if side else out.drop("side")
