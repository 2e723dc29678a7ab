"""``EdgeStream``: the graph-stream API over one DataFrame of edges (batch or streaming).

Columns: ``src``, ``trg`` and optionally ``amount`` (edge value), ``ts`` (event time), ``chg``
(+1 addition / -1 deletion) and ``pos`` (arrival position, for order-sensitive operators).
Every method returns a new ``EdgeStream`` or a DataFrame; edges are never collected. Iterative and ordered operators
(components, matching, spanner, triangles, positions, running values) run jobs while their frame is built.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgegraph.operators import bipartite as _bip
from edgegraph.operators import components as _cc
from edgegraph.operators import degree_dist as _dd
from edgegraph.operators import degrees as _deg
from edgegraph.operators import estimators as _est
from edgegraph.operators import matching as _match
from edgegraph.operators import paths as _paths
from edgegraph.operators import patterns as _pat
from edgegraph.operators import snapshot as _snap
from edgegraph.operators import spanner as _span
from edgegraph.operators import summary as _sum
from edgegraph.operators import transforms as _t
from edgegraph.operators import triangles as _tri
from edgegraph.operators import windows as _win
from edgegraph.operators.monoid import Monoid
from edgegraph.operators.positions import with_position


class SnapshotStream:
    """Edges keyed by a vertex and cut in tumbling windows (``EdgeStream.slice``)."""

    def __init__(self, sliced: DataFrame):
        self.df = sliced

    def reduce_on_edges(self, value: str = "amount", op: str = "sum") -> DataFrame:
        return _snap.reduce_on_edges(self.df, value, op)

    def aggregate_neighbors(self, *aggs: Column) -> DataFrame:
        return _snap.aggregate_neighbors(self.df, list(aggs))

    def fold_neighbors(self, order: str = "pos") -> DataFrame:
        return _snap.fold_neighbors(self.df, order)

    def apply_on_neighbors(self, value: str = "amount", **rule) -> DataFrame:
        return _snap.apply_on_neighbors(self.df, value, **rule)

    def fold_edges(self, monoid: Monoid, order: str | None = None, **options) -> DataFrame:
        return _snap.fold_edges(self.df, monoid, order, **options)

    def summary(self) -> DataFrame:
        return _snap.neighborhood_summary(self.df)


class EdgeStream:
    def __init__(self, edges: DataFrame):
        missing = {"src", "trg"} - set(edges.columns)
        if missing:
            raise ValueError(f"edge frame lacks {sorted(missing)}")
        self.df = edges

    # ---- transforms ------------------------------------------------------------------------
    def get_edges(self) -> DataFrame:
        return self.df

    def get_vertices(self) -> DataFrame:
        return _t.vertices(self.df)

    def map_edges(self, value: Column, name: str = "amount") -> "EdgeStream":
        return EdgeStream(_t.map_edges(self.df, value, name))

    def remove_value(self) -> "EdgeStream":
        """Edges without values: (src, trg)."""
        return EdgeStream(_t.remove_value(self.df))

    def filter_vertices(self, pred: Callable[[Column], Column]) -> "EdgeStream":
        return EdgeStream(_t.filter_vertices(self.df, pred))

    def filter_edges(self, cond: Column) -> "EdgeStream":
        return EdgeStream(_t.filter_edges(self.df, cond))

    def distinct(self, keep_first_by: str | None = None) -> "EdgeStream":
        if keep_first_by:
            return EdgeStream(_t.distinct_first(self.df, keep_first_by))
        return EdgeStream(_t.distinct(self.df))

    def reverse(self) -> "EdgeStream":
        return EdgeStream(_t.reverse(self.df))

    def undirected(self) -> "EdgeStream":
        return EdgeStream(_t.undirected(self.df))

    def canonical(self) -> "EdgeStream":
        return EdgeStream(_t.canonical(self.df))

    def union(self, other: "EdgeStream") -> "EdgeStream":
        return EdgeStream(_t.union(self.df, other.df))

    def with_position(self, order: Sequence[str], name: str = "pos") -> "EdgeStream":
        return EdgeStream(with_position(self.df, order, name))

    # ---- degrees, counts, aggregates -------------------------------------------------------
    def get_degrees(self) -> DataFrame:
        return _deg.degrees(self.df, "all")

    def get_in_degrees(self) -> DataFrame:
        return _deg.degrees(self.df, "in")

    def get_out_degrees(self) -> DataFrame:
        return _deg.degrees(self.df, "out")

    def degree_changelog(self, order: str = "pos") -> DataFrame:
        return _deg.degree_changelog(self.df, order)

    def number_of_edges(self) -> DataFrame:
        return _deg.edge_count(self.df)

    def number_of_vertices(self, approx: bool = False) -> DataFrame:
        return _deg.vertex_count(self.df, approx)

    def vertex_count_changelog(self, order: str = "pos") -> DataFrame:
        return _deg.vertex_count_changelog(self.df, order)

    def aggregate(self, edge_values: list[tuple[str, Column]], agg: Column, name: str = "value") -> DataFrame:
        return _deg.vertex_aggregate(self.df, edge_values, agg, name)

    def global_aggregate(self, value: Column | Monoid, op: str = "max", order: str = "pos",
                         collect_updates: bool = True) -> DataFrame:
        return _deg.global_aggregate(self.df, value, op, order, collect_updates)

    def build_neighborhood(self, directed: bool = True) -> DataFrame:
        """Final neighbour sets as rows (v, nbr, idx)."""
        return _deg.neighborhood_rows(self.df, directed)

    def running_neighborhood(self, directed: bool = True, order: str = "pos") -> DataFrame:
        return _deg.running_neighborhood(self.df, directed, order)

    def running_neighborhood_size(self, order: str = "pos") -> DataFrame:
        return _deg.running_neighborhood_size(self.df, order)

    # ---- windows -----------------------------------------------------------------------------
    def slice(self, size: str, direction: str = "out") -> SnapshotStream:
        return SnapshotStream(_snap.slice_edges(self.df, size, direction))

    def sliding_sum(self, size: str, slide: str, key: str = "src", value: str = "amount") -> DataFrame:
        return _win.sliding_sum(self.df, size, slide, key, value)

    def count_windows(self, n: int, order: Sequence[str], value: str = "amount") -> DataFrame:
        return _win.count_windows(self.df, n, list(order), value)

    def window_graph_size(self, size: str) -> DataFrame:
        return _deg.window_graph_size(self.df, size)

    # ---- summaries and algorithms -----------------------------------------------------------
    def summarize(self, size: str, spec: Sequence[_sum.Field | _sum.StateField], tree: bool = False, buckets: int | None = None,
                  cumulative: bool = True) -> DataFrame:
        fn = _sum.summarize_tree if tree else _sum.summarize_bulk
        return fn(self.df, size, spec, buckets, cumulative)

    def connected_components(self, method: str = "star") -> DataFrame:
        if method == "star":
            return _cc.connected_components(self.df)
        if method == "tree":
            return _cc.connected_components_tree(self.df)
        if method == "propagation":
            return _cc.connected_components_iterative(self.df)
        raise ValueError(method)

    def bipartiteness(self) -> DataFrame:
        return _bip.is_bipartite(self.df)

    def bipartite_components(self) -> DataFrame:
        return _bip.component_bipartite(self.df)

    def signed_components(self) -> DataFrame:
        return _bip.signed_vertices(self.df)

    def spanner(self, k: int = 3) -> DataFrame:
        return _span.spanner(self.df, k)

    def within_k(self, pairs: DataFrame, k: int, directed: bool = False) -> DataFrame:
        return _paths.within_k(self.df, pairs, k, directed)

    def triangle_count(self) -> DataFrame:
        return _tri.triangle_count(self.df)

    def local_triangles(self) -> DataFrame:
        return _tri.local_triangles(self.df)

    def triangle_changelog(self, order: str = "pos") -> DataFrame:
        return _tri.triangle_changelog(self.df, order)

    def window_triangles(self, size: str) -> DataFrame:
        return _tri.window_triangles(self.df, size)

    def estimate_triangles(self, samples: int, method: str = "broadcast", seed: str = _est.DEFAULT_SEED,
                           prefixes: list[int] | None = None, vertices: int | None = None) -> DataFrame:
        return _est.estimate(self.df, samples, seed, method, prefixes, vertices)

    def degree_distribution(self, order: str = "pos") -> DataFrame:
        return _dd.degree_distribution(self.df, order)

    def degree_distribution_changelog(self, order: str = "pos") -> DataFrame:
        return _dd.degree_distribution_changelog(self.df, order)

    def weighted_matching(self, weight: str = "amount") -> DataFrame:
        return _match.locally_dominant_matching(self.df, weight)

    def weighted_matching_by_class(self, weight: str = "amount") -> DataFrame:
        return _match.weight_class_matching(self.df, weight)

    # ---- transaction patterns ----------------------------------------------------------------
    def money_movement_alerts(self, rule: _pat.MoneyMovement = _pat.MoneyMovement()) -> DataFrame:
        return _pat.money_movement_alerts(self.df, rule)

    def fraud_window_report(self, rule: _pat.MoneyMovement = _pat.MoneyMovement()) -> DataFrame:
        return _pat.fraud_window_report(self.df, rule)

    def adjacency(self, size: str, slide: str | None = None) -> DataFrame:
        return _pat.adjacency(self.df, size, slide)

    def edge_probe(self, patterns: Sequence[tuple[int, int]], size: str, slide: str | None = None) -> DataFrame:
        return _pat.edge_probe(self.df, patterns, size, slide)

    def with_event_time(self, delay: str = "0 seconds") -> "EdgeStream":
        return EdgeStream(self.df.withWatermark("ts", delay))

    def with_timestamp(self) -> "EdgeStream":
        """Timestamp tap: ``ts_ms`` next to each edge (the reference's element/timestamp print)."""
        return EdgeStream(self.df.withColumn("ts_ms", F.unix_millis("ts")))
