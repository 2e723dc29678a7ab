"""Bipartiteness through the bipartite double cover (H5).

Vertex ``v`` gets two copies ``2v`` (even side) and ``2v+1`` (odd side), made and read back by bit operations, which
are exact for negative and large ids; an edge (u, w) becomes
(2u, 2w+1) and (2u+1, 2w). A component is bipartite iff no vertex has both copies in one double-cover
component, i.e. it has no odd cycle (a self-loop is an odd cycle). Signs: the component's smallest vertex
``r`` has sign true; ``v`` has sign true iff ``2v`` shares the double-cover component of ``2r``, whose label
is ``2r`` itself because ``2r`` is the smallest id there. Everything is connected components plus
aggregates; nothing is gathered per component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgegraph.operators.components import connected_components


# Ids in this range keep their double-cover copies within a bigint.
_FITS = 1 << 61


def _copies(edges: DataFrame, wide: bool) -> DataFrame:
    """Double-cover edges; a copy is the bigint 2v + side, or (v, side) where ids do not fit."""
    def copy(v: str, side: int):
        if wide:
            return F.struct(F.col(v).alias("v"), F.lit(side).alias("side"))
        return F.shiftleft(v, 1).bitwiseOR(F.lit(side).cast("bigint"))

    pairs = F.array(F.struct(copy("src", 0).alias("a"), copy("trg", 1).alias("b")),
                    F.struct(copy("src", 1).alias("a"), copy("trg", 0).alias("b")))
    return edges.select(F.explode(pairs).alias("_e")).select(F.col("_e.a").alias("src"), F.col("_e.b").alias("trg"))


def double_cover(edges: DataFrame) -> DataFrame:
    """Edges between bigint copies 2v + side, for ids from -2**61 to 2**61 - 1; others raise when the edge is read."""
    def checked(v: str):
        fits = F.col(v).between(-_FITS, _FITS - 1)
        return F.when(fits, F.col(v)).when(F.col(v).isNotNull(), F.raise_error(F.lit("vertex id beyond +-2**61")).cast("bigint")).alias(v)

    return _copies(edges.select(checked("src"), checked("trg")), wide=False)


def vertex_signs(edges: DataFrame) -> DataFrame:
    """(v, component, sign, conflict) for every endpoint; any bigint ids."""
    edges = edges.select(F.col("src").cast("bigint").alias("src"), F.col("trg").cast("bigint").alias("trg"))
    low, high = edges.agg(F.min(F.least("src", "trg")), F.max(F.greatest("src", "trg"))).first()
    wide = low is not None and (low < -_FITS or high >= _FITS)
    return _signs(connected_components(_copies(edges, wide)), wide)


def _signs(cc: DataFrame, wide: bool) -> DataFrame:
    """(v, component, sign, conflict) from the labels (v, component) of the double cover."""
    if wide:
        cc = cc.select(F.col("v.v").alias("v"), F.col("v.side").alias("side"), F.col("component.v").alias("c"),
                       F.col("component.side").alias("c_side"))
    else:
        one = F.lit(1).cast("bigint")
        cc = cc.select(F.shiftright("v", 1).alias("v"), F.col("v").bitwiseAND(one).cast("int").alias("side"),
                       F.shiftright("component", 1).alias("c"), F.col("component").bitwiseAND(one).cast("int").alias("c_side"))
    label = F.struct("c", "c_side")
    per_v = (cc.groupBy("v").agg(F.min(F.when(F.col("side") == 0, label)).alias("even"),
                                 F.min(F.when(F.col("side") == 1, label)).alias("odd")))
    component = F.least("even", "odd")["c"]
    return per_v.select("v", component.alias("component"),
                        ((F.col("even.c") == component) & (F.col("even.c_side") == 0)).alias("sign"),
                        (F.col("even") == F.col("odd")).alias("conflict"))


def component_bipartite(edges: DataFrame) -> DataFrame:
    """(component, bipartite, size): false as soon as one vertex of the component conflicts."""
    return _per_component(vertex_signs(edges))


def components_of_cover(labels: DataFrame) -> DataFrame:
    """The same from the labels (v, component) of :func:`double_cover`'s components."""
    return _per_component(_signs(labels, wide=False))


def _per_component(s: DataFrame) -> DataFrame:
    return s.groupBy("component").agg((~F.bool_or("conflict")).alias("bipartite"),
                                      F.count(F.lit(1)).cast("bigint").alias("size"))


def is_bipartite(edges: DataFrame) -> DataFrame:
    """One row: the whole graph is bipartite (false is absorbing)."""
    s = vertex_signs(edges)
    return s.agg((~F.coalesce(F.bool_or("conflict"), F.lit(False))).alias("bipartite"),
                 F.count(F.lit(1)).cast("bigint").alias("n_vertices"))


def signed_vertices(edges: DataFrame) -> DataFrame:
    """Signed components of a bipartite graph: (component, v, sign) for components without conflict."""
    s = vertex_signs(edges)
    bad = s.where(F.col("conflict")).select("component").distinct()
    return s.join(bad, "component", "left_anti").select("component", "v", "sign")
