"""Degrees, counts, vertex/global aggregates, neighbourhoods and their changelogs.

Final values are plain grouped aggregates (partial + final). The reference's per-update outputs
("changelogs") are reproduced in batch with ordered running aggregates from
:mod:`edgegraph.operators.positions`, which split hot keys over many tasks.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgegraph.functions import win_end_ms, win_start_ms
from edgegraph.operators.monoid import Monoid, scan
from edgegraph.operators.positions import OrderedFrame, keyed_position, with_position
from edgegraph.operators.transforms import endpoints


def degrees(edges: DataFrame, direction: str = "all") -> DataFrame:
    """(v, degree). ``all`` counts both endpoints (a self-loop counts 2), ``in`` targets, ``out`` sources."""
    if direction == "all":
        ends = endpoints(edges)
    elif direction == "in":
        ends = edges.select(F.col("trg").alias("v"))
    elif direction == "out":
        ends = edges.select(F.col("src").alias("v"))
    else:
        raise ValueError(direction)
    return ends.groupBy("v").agg(F.count(F.lit(1)).cast("bigint").alias("degree"))


def degree_changelog(edges: DataFrame, order: str = "pos") -> DataFrame:
    """One row per endpoint update in arrival order: the endpoint's degree after the update."""
    ends = endpoints(edges, order, side=True)
    return keyed_position(ends, ["v"], [order, "side"], name="degree")


def edge_count(edges: DataFrame) -> DataFrame:
    return edges.agg(F.count(F.lit(1)).cast("bigint").alias("n_edges"))


def vertex_count(edges: DataFrame, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    ends = endpoints(edges)
    if approx:
        return ends.agg(F.approx_count_distinct("v", rsd).cast("bigint").alias("n_vertices"))
    return ends.agg(F.count_distinct("v").cast("bigint").alias("n_vertices"))


def vertex_count_checked(edges: DataFrame, rsd: float = 0.01) -> DataFrame:
    """Exact distinct vertices, and whether the HyperLogLog estimate lies within four standard errors of them. The vertices are made
    distinct first: beside a distinct count the sketch would be kept once per vertex."""
    both = endpoints(edges).distinct().agg(F.count("v").cast("bigint").alias("n_vertices"),
                                           F.approx_count_distinct("v", rsd).alias("_n"))
    return both.select("n_vertices", (F.abs(F.col("_n") - F.col("n_vertices")) <= F.col("n_vertices") * (4 * rsd))
                       .alias("within_error"))


def vertex_count_changelog(edges: DataFrame, order: str = "pos") -> DataFrame:
    """Running distinct-vertex count, one row per new vertex (emitted only when the count changes).

    A vertex's first appearance is a map-side-combined ``min`` per vertex; the running count is then
    the position of that first appearance among all first appearances.
    """
    ends = endpoints(edges, order, side=True)
    firsts = (ends.groupBy("v").agg(F.min(F.struct(F.col(order), F.col("side"))).alias("_f"))
              .select("v", F.col(f"_f.{order}").alias(order), F.col("_f.side").alias("side")))
    return with_position(firsts, [order, "side"], name="n_vertices")


def vertex_aggregate(edges: DataFrame, edge_values: list[tuple[str, Column]], agg: Column,
                     name: str = "value") -> DataFrame:
    """``aggregate(edgeMapper, vertexMapper)``: each edge maps to (vertex, value) rows, folded per vertex.

    ``edge_values`` is a list of (endpoint column, value expression); ``agg`` an aggregate over ``x``.
    """
    rows = F.explode(F.array(*[F.struct(F.col(v).alias("v"), val.alias("x")) for v, val in edge_values]))
    return edges.select(rows.alias("_r")).select("_r.v", "_r.x").groupBy("v").agg(agg.alias(name))


def global_aggregate(edges: DataFrame, value: Column | Monoid, op: str = "max", order: str = "pos",
                     collect_updates: bool = True) -> DataFrame:
    """``globalAggregate``: one running value over the whole stream in arrival order. ``value`` is a column with ``op`` (sum, min
    or max), or a user's mergeable state over the edges' columns.

    With ``collect_updates`` only rows where the running value changes are kept (emit-on-change). The
    previous row is found by an equi-join on the dense position (no global ``lag`` window).
    """
    if isinstance(value, Monoid):
        base = with_position(edges.select(F.col(order).alias("_o"), value.lift.alias("_x")), ["_o"], name="_i")
        run = scan(base, [], ["_i"], replace(value, lift=F.col("_x")), "value")
    else:
        base = with_position(edges.select(F.col(order).alias("_o"), value.alias("_x")), ["_o"], name="_i")
        run = OrderedFrame(base, [], ["_i"]).running("value", F.col("_x"), op).result()
    if not collect_updates:
        return run.select(F.col("_o").alias(order), "value")
    prev = run.select((F.col("_i") + 1).alias("_i"), F.col("value").alias("_prev"))
    return (run.join(prev, "_i", "left")
            .where(~F.col("value").eqNullSafe(F.col("_prev")))
            .select(F.col("_o").alias(order), "value"))


def neighborhood_rows(edges: DataFrame, directed: bool = True) -> DataFrame:
    """Final neighbour sets as rows: (v, nbr, idx) with ``idx`` the 1-based rank of ``nbr`` in v's sorted
    set. A keyed ordered scan, so a hub's neighbour set is spread over many tasks, never one row."""
    e = edges.select("src", "trg")
    if not directed:
        e = e.unionByName(e.select(F.col("trg").alias("src"), F.col("src").alias("trg")))
    pairs = e.distinct().select(F.col("src").alias("v"), F.col("trg").alias("nbr"))
    return keyed_position(pairs, ["v"], ["nbr"], name="idx")


def neighborhoods(edges: DataFrame, directed: bool = True) -> DataFrame:
    """Final sorted neighbour set per vertex as one array: (v, nbrs ARRAY<BIGINT>, n_nbrs).

    Convenience form for bounded degrees; a hub's set is one row here, so use :func:`neighborhood_rows`
    when degrees are unbounded.
    """
    e = edges.select("src", "trg")
    if not directed:
        e = e.unionByName(e.select(F.col("trg").alias("src"), F.col("src").alias("trg")))
    return (e.distinct().groupBy("src")
            .agg(F.array_sort(F.collect_list("trg")).alias("nbrs"))
            .select(F.col("src").alias("v"), "nbrs", F.size("nbrs").cast("bigint").alias("n_nbrs")))


def running_neighborhood_size(edges: DataFrame, order: str = "pos") -> DataFrame:
    """Per edge in arrival order: size of the source's neighbour set after the edge.

    ``buildNeighborhood`` emits the whole set after every edge (quadratic output for a hub); the set's
    size is the linear form. First sightings of a pair are a map-side-combined ``min``; the running
    count per source is an ordered scan that splits a hub over many tasks.
    """
    firsts = edges.groupBy("src", "trg").agg(F.min(order).alias("_first"))
    flagged = (edges.select("src", "trg", order)
               .join(firsts, ["src", "trg"])
               .withColumn("_new", (F.col(order) == F.col("_first")).cast("long")))
    run = OrderedFrame(flagged, ["src"], [order]).running("n_nbrs", F.col("_new"), "sum").result()
    return run.select(order, "src", "trg", F.col("n_nbrs").cast("bigint").alias("n_nbrs"))


def running_neighborhood(edges: DataFrame, directed: bool = True, order: str = "pos") -> DataFrame:
    """Per arriving edge and vertex ``v`` that it reaches: (v, nbr, order, side, is_new, n_nbrs).

    ``is_new`` marks the first sight of the neighbour, so the set after any edge is the rows with ``is_new`` up to it, in
    output linear in the edges; ``n_nbrs`` is its size. Undirected: both ends of an edge get a row (side 0 and 1)."""
    ends = edges.select(F.col("src").alias("v"), F.col("trg").alias("nbr"), order, F.lit(0).alias("side"))
    if not directed:
        ends = ends.unionByName(edges.select(F.col("trg").alias("v"), F.col("src").alias("nbr"), order, F.lit(1).alias("side")))
    firsts = ends.groupBy("v", "nbr").agg(F.min(F.struct(order, "side")).alias("_first"))
    flagged = ends.join(firsts, ["v", "nbr"]).withColumn("is_new", F.struct(order, "side") == F.col("_first")).drop("_first")
    run = OrderedFrame(flagged, ["v"], [order, "side"]).running("n_nbrs", F.col("is_new").cast("long"), "sum").result()
    return run.select("v", "nbr", order, "side", "is_new", F.col("n_nbrs").cast("bigint").alias("n_nbrs"))


def window_graph_size(edges: DataFrame, size: str) -> DataFrame:
    """Per tumbling window: number of vertices with outgoing edges (adjacency-map size)."""
    per_v = edges.groupBy(F.window("ts", size).alias("window"), "src").agg(F.count(F.lit(1)).alias("_n"))
    return (per_v.groupBy("window").agg(F.count(F.lit(1)).cast("bigint").alias("graph_size"))
            .select(win_start_ms().alias("w_start"), win_end_ms().alias("w_end"), "graph_size"))


def window_last_value(labels: DataFrame, size: str, key: str, value: str, order: str) -> DataFrame:
    """Per window and key, the value of the latest row (``max_by``, combined map-side)."""
    return (labels.groupBy(F.window("ts", size).alias("window"), key)
            .agg(F.max_by(value, order).alias(value))
            .select(win_start_ms().alias("w_start"), win_end_ms().alias("w_end"), key, value))
