"""Weakly connected components as iterated DataFrame jobs (H4, H4b, H4c, H4d).

``connected_components`` runs the alternating large-star / small-star rounds (Kiveris et al., SoCC 2014)
on an edge table: every round is one aggregate (minimum neighbour, combined map-side) and one equi-join,
it converges in O(log^2 n) rounds, and the converged edge set is a forest of stars centred on each
component's smallest id, so the label is canonical (min vertex id). A hub's edges sit on the large side
of a join against one row per vertex; AQE's skew-join splitting handles that side. The edge table is
checkpointed (reliable, shared ``spark.checkpoint.dir``) every round, so lineage stays short and a lost
executor recomputes at most one round.

All functions accept ``group`` columns (e.g. a window or a bucket) and then solve each group's graph
independently in the same jobs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgegraph.session import ensure_checkpoint_dir


def _ckpt(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _large_star_step(e: DataFrame, g: list[str]) -> tuple[DataFrame | None, DataFrame]:
    """Per-vertex aggregate of the large-star step, also deciding convergence.

    ``e`` is a star forest centred on component minima iff every vertex is a root (no smaller neighbour)
    or a leaf (exactly one smaller neighbour, no larger one). The counts come from the same map-side
    combined aggregate that finds each vertex's minimum neighbour; the table has one row per vertex and is
    checkpointed, so the test scans vertices, not edges. Returns (large-star edges or None, aggregate).
    """
    d = e.select(*g, F.col("hi").alias("x"), F.col("lo").alias("y")).unionByName(
        e.select(*g, F.col("lo").alias("x"), F.col("hi").alias("y")))
    agg = _ckpt(d.groupBy(*g, "x").agg(
        F.min("y").alias("_mn"),
        F.sum(F.when(F.col("y") < F.col("x"), 1).otherwise(0)).alias("nlo"),
        F.sum(F.when(F.col("y") > F.col("x"), 1).otherwise(0)).alias("nhi")))
    bad = agg.where(~((F.col("nlo") == 0) | ((F.col("nlo") == 1) & (F.col("nhi") == 0))))
    if bad.limit(1).count() == 0:
        return None, agg
    m = agg.select(*g, "x", F.least("x", "_mn").alias("m"))
    out = d.where(F.col("y") > F.col("x")).join(m, g + ["x"]).select(*g, F.col("y").alias("hi"), F.col("m").alias("lo"))
    # duplicates are harmless to small-star (min aggregate, distinct output), so no shuffle to drop them here
    return out.where(F.col("hi") != F.col("lo")), agg


def _small_star(e: DataFrame, g: list[str]) -> DataFrame:
    m = e.groupBy(*g, "hi").agg(F.min("lo").alias("m"))
    j = e.join(m, g + ["hi"])
    out = (j.select(*g, F.col("lo").alias("a"), F.col("m").alias("b"))
           .unionByName(j.select(*g, F.col("hi").alias("a"), F.col("m").alias("b"))))
    return (out.select(*g, F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
            .where(F.col("hi") != F.col("lo")).distinct())


def star_edges(edges: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Converged star forest ``(group..., hi, lo)``: ``lo`` is the component minimum of ``hi``."""
    g = list(group)
    e = (edges.select(*g, F.greatest("src", "trg").alias("hi"), F.least("src", "trg").alias("lo"))
         .where(F.col("hi") != F.col("lo")).distinct())
    return _converge(_ckpt(e), g)


def _converge(e: DataFrame, g: list[str]) -> DataFrame:
    while True:
        large, _agg = _large_star_step(e, g)
        if large is None:
            return e
        e = _ckpt(_small_star(large, g))


def connected_components(edges: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """``(group..., v, component)`` for every endpoint; component = smallest vertex id it reaches.

    The input is read once: its canonical edges and its vertex list are materialised together, so an
    expensive edge view is not recomputed by the loop or by the final labelling.
    """
    g = list(group)
    base = _ckpt(edges.select(*g, F.greatest("src", "trg").alias("hi"), F.least("src", "trg").alias("lo")).distinct())
    stars = _converge(_ckpt(base.where(F.col("hi") != F.col("lo"))), g)
    verts = base.select(*g, F.explode(F.array("hi", "lo")).alias("v")).distinct()
    labels = stars.select(*g, F.col("hi").alias("v"), F.col("lo").alias("component"))
    return _ckpt(verts.join(labels, g + ["v"], "left")
                 .select(*g, "v", F.coalesce("component", "v").alias("component")))


def _spanning_forests(batches: Iterator) -> Iterator:
    """Per Arrow batch of edges (bounded by Spark's batch size): the edges of a spanning forest, and loops."""
    import pyarrow as pa
    for b in batches:
        parent: dict[int, int] = {}
        keep = []
        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            for v in (x, y):
                parent.setdefault(v, v)
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            while parent[y] != y:
                parent[y] = y = parent[parent[y]]
            keep.append(x != y)
            parent[x] = y
        # a vertex whose every edge is a loop keeps one through its own pair
        keep = [k or x == y for k, x, y in zip(keep, b.column(0).to_pylist(), b.column(1).to_pylist())]
        yield b.filter(pa.array(keep, pa.bool_()))


def connected_components_tree(edges: DataFrame) -> DataFrame:
    """Tree form: every piece of the input is contracted to a spanning forest where it is read (one narrow pass, no
    shuffle), then the forests' union, at most one edge per vertex and piece, is solved. Equals :func:`connected_components`."""
    e = edges.select(F.col("src").cast("bigint").alias("src"), F.col("trg").cast("bigint").alias("trg")).where(
        F.col("src").isNotNull() & F.col("trg").isNotNull())
    return connected_components(e.mapInArrow(_spanning_forests, "src bigint, trg bigint"))


def connected_components_iterative(edges: DataFrame) -> DataFrame:
    """Min-label propagation with pointer jumping, a driver loop until no label changes.

    Round: ``L(v) <- min(L(v), L(w) for neighbours w)``, then ``L(v) <- L(L(v))``.
    Same result as :func:`connected_components` (labels are component minima).
    """
    base = _ckpt(edges.select("src", "trg").distinct())
    und = (base.select(F.col("src").alias("a"), F.col("trg").alias("b"))
           .unionByName(base.select(F.col("trg").alias("a"), F.col("src").alias("b")))
           .where(F.col("a") != F.col("b")).distinct())
    und = _ckpt(und)
    labels = _ckpt(base.select(F.explode(F.array("src", "trg")).alias("v")).distinct()
                   .select("v", F.col("v").alias("label")))
    while True:
        nbr_min = (und.join(labels.select(F.col("v").alias("b"), F.col("label").alias("nl")), "b")
                   .groupBy("a").agg(F.min("nl").alias("nl")))
        hooked = (labels.join(nbr_min, labels.v == nbr_min.a, "left")
                  .select("v", F.least("label", F.coalesce("nl", "label")).alias("label")))
        jumped = (hooked.alias("x").join(hooked.alias("y"), F.col("x.label") == F.col("y.v"))
                  .select(F.col("x.v").alias("v"), F.least(F.col("x.label"), F.col("y.label")).alias("label")))
        jumped = _ckpt(jumped)
        changed = (jumped.join(labels.withColumnRenamed("label", "old"), "v")
                   .where(F.col("label") != F.col("old")).limit(1).count())
        labels = jumped
        if changed == 0:
            return labels.select("v", F.col("label").alias("component"))


def component_sizes(labels: DataFrame) -> DataFrame:
    return labels.groupBy("component").agg(F.count(F.lit(1)).cast("bigint").alias("size"))


def component_members(labels: DataFrame) -> DataFrame:
    """Flattened listing: (component, v, idx) with ``idx`` the 1-based rank of ``v`` in its component
    (a keyed ordered scan, so a giant component is not gathered into one task)."""
    from edgegraph.operators.positions import keyed_position
    return keyed_position(labels.select("component", "v"), ["component"], ["v"], name="idx")
