"""Mergeable per-window graph summaries, bulk and tree forms.

A summary is given declaratively as named (partial aggregate, merge aggregate, cumulative op) triples
over Spark columns, e.g. an edge count is (count, sum, sum). Then

* bulk: fold per (window, edge bucket), combine per window, merge the windows cumulatively in time order;
* tree: fold per (window, bucket), then combine bucket pairs (b // 2) round by round until at most two
  remain, then per window: the DataFrame counterpart of a fan-in-2 reduce tree;
* transient: the per-window value without the cumulative merge.

The bucket is a hash of the edge (repeatable, unlike a task index). The cumulative merge is an ordered
running aggregate over windows computed by :class:`~edgegraph.operators.positions.OrderedFrame`, so even a
long window history is never gathered into one task. Values keep the type that the user's expression gives them.

A :class:`StateField` holds any mergeable state (:class:`~edgegraph.operators.monoid.Monoid`), folded in arrival order: bulk folds a
window's edges in blocks, tree with a fan-in of 2, and windows are merged cumulatively in time order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgegraph.functions import win_end_ms, win_start_ms
from edgegraph.operators.monoid import Monoid, fold, scan
from edgegraph.operators.positions import OrderedFrame

_MERGE = {"sum": F.sum, "min": F.min, "max": F.max, "hll": F.hll_union_agg}


@dataclass(frozen=True)
class Field:
    name: str
    partial: Column      # aggregate over edge rows
    merge: str           # sum | min | max | hll: combines partials
    cumulative: str      # sum | min | max | hll: merges window results across time


@dataclass(frozen=True)
class StateField:
    name: str
    state: Monoid        # lift and merge over edge rows in arrival order
    order: str = "pos"


def edge_stats_spec(value: str = "amount") -> list[Field]:
    return [Field("n_edges", F.count(F.lit(1)), "sum", "sum"),
            Field(f"min_{value}", F.min(value), "min", "min"),
            Field(f"max_{value}", F.max(value), "max", "max"),
            Field(f"sum_{value}", F.sum(value), "sum", "sum")]


def distinct_field(name: str, value: Column, lg_k: int = 12) -> Field:
    """Distinct values as a mergeable HyperLogLog sketch of at most 2**lg_k registers; read it by ``hll_sketch_estimate``. The
    relative standard error is about 1.04 / sqrt(2**lg_k)."""
    return Field(name, F.hll_sketch_agg(value, lg_k), "hll", "hll")


def _width(edges: DataFrame, buckets: int | None) -> int:
    """Hash buckets per window: as many as shuffle partitions unless given."""
    return buckets or int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _partials(edges: DataFrame, size: str, spec: Sequence[Field], buckets: int) -> DataFrame:
    b = F.pmod(F.xxhash64("src", "trg"), F.lit(buckets)).alias("_b")
    return (edges.select(F.window("ts", size).alias("window"), b, *[c for c in edges.columns])
            .groupBy("window", "_b").agg(*[f.partial.alias(f.name) for f in spec]))


def _combine(df: DataFrame, keys: list[str], spec: Sequence[Field]) -> DataFrame:
    return df.groupBy(*keys).agg(*[_MERGE[f.merge](f.name).alias(f.name) for f in spec])


def window_partials(edges: DataFrame, size: str, spec: Sequence[Field], buckets: int | None = None) -> DataFrame:
    """Per-window values of some edges, mergeable with those of other edges by :func:`merge_fields`."""
    return _finish(_combine(_partials(edges, size, spec, _width(edges, buckets)), ["window"], spec), spec, cumulative=False)


def merge_fields(parts: DataFrame, keys: list[str], spec: Sequence[Field]) -> DataFrame:
    """Combine partial summaries that share ``keys``."""
    return _combine(parts, keys, spec)


def running_fields(per_window: DataFrame, spec: Sequence[Field]) -> DataFrame:
    """Merge per-window values (w_start, w_end, fields) cumulatively in time order."""
    plain = [f for f in spec if f.cumulative != "hll"]
    out = per_window
    if plain:
        of = OrderedFrame(per_window, [], ["w_start"])
        for f in plain:
            of = of.running(f"_c_{f.name}", F.col(f.name), f.cumulative)
        out = of.result().drop(*[f.name for f in plain]).withColumnsRenamed({f"_c_{f.name}": f.name for f in plain})
    for f in spec:
        if f.cumulative == "hll":
            out = scan(out, [], ["w_start"], Monoid(F.col(f.name), lambda a, b: F.hll_union(a, b)), f.name)
    return out.select("w_start", "w_end", *[f.name for f in spec])


def _finish(per_window: DataFrame, spec: Sequence[Field], cumulative: bool) -> DataFrame:
    out = per_window.select(win_start_ms().alias("w_start"), win_end_ms().alias("w_end"), *[f.name for f in spec])
    return running_fields(out, spec) if cumulative else out


def window_states(edges: DataFrame, size: str, field: StateField, fan_in: int | None = None) -> DataFrame:
    """(w_start, w_end, state) of every window, unfinished: mergeable with those of later edges."""
    bare = Monoid(field.state.lift, field.state.merge)
    rows = edges.select(F.window("ts", size).alias("window"), *edges.columns)
    return fold(rows.select(win_start_ms().alias("w_start"), win_end_ms().alias("w_end"), *edges.columns),
                ["w_start", "w_end"], bare, [field.order], field.name, fan_in=fan_in)


def running_states(per_window: DataFrame, field: StateField, cumulative: bool = True) -> DataFrame:
    """(w_start, w_end, finished value) of unfinished window states, merged in time order if ``cumulative``."""
    m = Monoid(F.col(field.name), field.state.merge, field.state.finish, field.state.zero)
    if cumulative:
        return scan(per_window, [], ["w_start"], m, field.name).select("w_start", "w_end", field.name)
    kind = per_window.schema[field.name].dataType
    return per_window.select("w_start", "w_end", m.output(F.col(field.name), kind).alias(field.name))


def _with_states(out: DataFrame | None, edges: DataFrame, size: str, states: Sequence[StateField], fan_in: int | None,
                 cumulative: bool) -> DataFrame:
    for f in states:
        one = running_states(window_states(edges, size, f, fan_in), f, cumulative)
        out = one if out is None else out.join(one, ["w_start", "w_end"])
    return out


def _split(spec: Sequence[Field | StateField]) -> tuple[list[Field], list[StateField]]:
    return [f for f in spec if isinstance(f, Field)], [f for f in spec if isinstance(f, StateField)]


def summarize_bulk(edges: DataFrame, size: str, spec: Sequence[Field | StateField], buckets: int | None = None,
                   cumulative: bool = True) -> DataFrame:
    fields, states = _split(spec)
    out = None
    if fields:
        parts = _partials(edges, size, fields, _width(edges, buckets))
        out = _finish(_combine(parts, ["window"], fields), fields, cumulative)
    return _with_states(out, edges, size, states, None, cumulative)


def summarize_tree(edges: DataFrame, size: str, spec: Sequence[Field | StateField], buckets: int | None = None,
                   cumulative: bool = True) -> DataFrame:
    fields, states = _split(spec)
    out = None
    if fields:
        width = _width(edges, buckets)
        parts = _partials(edges, size, fields, width)
        while width > 2:
            parts = _combine(parts.withColumn("_b", F.expr("_b div 2")), ["window", "_b"], fields)
            width = (width + 1) // 2
        out = _finish(_combine(parts, ["window"], fields), fields, cumulative)
    return _with_states(out, edges, size, states, 2, cumulative)
