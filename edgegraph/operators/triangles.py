"""Exact and windowed triangle counting (H8, H9, C11).

Edges are deduplicated to canonical pairs and oriented from lower to higher (degree, id). Under that
orientation every vertex has at most sqrt(2m) out-neighbours; its out-list is cut into chunks of bounded length. A
triangle u < w < x (in that order) is found exactly once, at its edge (u, w), as ``x`` in both out(u) and out(w).
Two forms find the same triangles; what each would shuffle is computed from the degrees, and the cheaper one runs:

* lists: out-lists meet at the edges, chunk by chunk (``array_intersect``). The shuffle holds the sum of the squared out-degrees.
* colours: every vertex gets one of rho colours by hash, and a cell is an ordered triple of colours, so a triangle lies in
  exactly one cell and an edge goes to 3 rho - 2 of them. A task holds one cell and probes the shorter list of each edge.
  rho follows from the edges and the largest in-degree, so that a cell holds about ``CELL`` edges whatever the graph.

``group`` columns (a window, for instance) solve each group's graph independently in the same jobs.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgegraph.functions import win_max_ts
from edgegraph.operators.positions import OrderedFrame
from edgegraph.session import ensure_checkpoint_dir


def canonical_edges(edges: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    g = list(group)
    return (edges.select(*g, F.least("src", "trg").alias("a"), F.greatest("src", "trg").alias("b"))
            .where(F.col("a") != F.col("b")).distinct())


def oriented(canon: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """(group..., u, w): each canonical edge directed from lower to higher (degree, id)."""
    g = list(group)
    deg = (canon.select(*g, F.explode(F.array("a", "b")).alias("v"))
           .groupBy(*g, "v").agg(F.count(F.lit(1)).alias("d")))
    j = (canon.join(deg.select(*g, F.col("v").alias("a"), F.col("d").alias("da")), g + ["a"])
         .join(deg.select(*g, F.col("v").alias("b"), F.col("d").alias("db")), g + ["b"]))
    a_first = (F.col("da") < F.col("db")) | ((F.col("da") == F.col("db")) & (F.col("a") < F.col("b")))
    return j.select(*g, F.when(a_first, F.col("a")).otherwise(F.col("b")).alias("u"),
                    F.when(a_first, F.col("b")).otherwise(F.col("a")).alias("w"))


# Out-lists are cut by a hash of the neighbour into chunks of about this many ids.
CHUNK = 512
# Edges that one cell of colours holds, about; look-ups that a task makes at a time.
CELL = 1 << 20
PROBES = 1 << 21
# What an edge in a cell costs, in ids of a packed list: 4 to 18 times the shuffled bytes were measured (repeated lists compress well).
ROW_COST = 16


def _by_lists(o: DataFrame, g: list[str], longest: int) -> DataFrame:
    """Out-lists are aligned in chunks keyed (vertex, hash(neighbour) mod B), with B from the longest list, so a row
    holds about ``CHUNK`` ids whatever the degrees, and a hub's list is intersected by many tasks."""
    buckets = max(1, -(-longest // CHUNK))
    chunk = F.pmod(F.xxhash64("w"), F.lit(buckets)).alias("c")
    out = o.groupBy(*g, "u", chunk).agg(F.collect_list("w").alias("nu"))
    t = (o.join(out, g + ["u"])
         .join(out.select(*g, F.col("u").alias("w"), "c", F.col("nu").alias("nw")), g + ["w", "c"]))
    return (t.select(*g, "u", "w", F.array_intersect("nu", "nw").alias("xs"))
            .where(F.size("xs") > 0))


def colours_for(edges: int, hub: int) -> int:
    """The smallest rho with 3 edges / rho^2 + 2 hub / rho <= CELL; ``hub`` is the largest in-degree."""
    return max(1, math.ceil((hub + math.sqrt(hub * hub + 3 * edges * CELL)) / CELL))


def _closings(u: np.ndarray, w: np.ndarray, role: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of one cell's edges: (row, x) of every edge (u, w) in role 1 whose u has x in role 2 and whose w has x in role 4.

    The shorter list of each edge is looked up in the other one, ``PROBES`` entries at a time."""
    ids, code = np.unique(np.concatenate([u, w]), return_inverse=True)
    n, a, b = len(ids), code[:len(u)], code[len(u):]
    edge = np.flatnonzero(role & 1)
    lists = []
    for bit, end in ((2, a[edge]), (4, b[edge])):
        key = np.sort((a * n + b)[(role & bit) > 0])
        owner = key // max(n, 1)
        lists.append((key, np.searchsorted(owner, end), np.searchsorted(owner, end, "right"), end))
    sizes = [hi - lo for _, lo, hi, _ in lists]
    rows, third = [], []
    for mine, other, chosen in ((0, 1, sizes[0] <= sizes[1]), (1, 0, sizes[0] > sizes[1])):
        key, lo, _, _ = lists[mine]
        into, _, _, end = lists[other]
        at = np.flatnonzero(chosen & (sizes[0] > 0) & (sizes[1] > 0))
        done = np.cumsum(sizes[mine][at])
        cuts = np.unique(np.searchsorted(done, np.arange(0, (done[-1] if len(done) else 0) + PROBES, PROBES)))
        for x, y in zip(cuts, np.append(cuts[1:], len(at))):
            part = at[x:y]
            size = sizes[mine][part]
            place = np.repeat(lo[part] - np.cumsum(size) + size, size) + np.arange(size.sum())
            wanted = np.repeat(end[part], size) * n + key[place] % n
            hit = np.flatnonzero(into[np.minimum(np.searchsorted(into, wanted), len(into) - 1)] == wanted)
            rows.append(np.repeat(edge[part], size)[hit])
            third.append(ids[wanted[hit] % n])
    return (np.concatenate(rows), np.concatenate(third)) if rows else (edge[:0], u[:0])


def _by_colours(o: DataFrame, g: list[str], rho: int) -> DataFrame:
    """Every cell (colour of u, of w, of x) is one task's group: its edges in the roles (u, w), (u, x) and (w, x)."""
    import pyarrow as pa

    def colour(c: str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(rho))

    def cells(i: Column | None, j: Column | None, k: Column | None) -> Column:
        def one(free: Column) -> Column:
            return sum(x * F.lit(rho ** e) for x, e in ((free if c is None else c, e) for c, e in ((i, 2), (j, 1), (k, 0))))
        return F.transform(F.sequence(F.lit(0).cast("bigint"), F.lit(rho - 1).cast("bigint")), one)

    a, b = F.col("_a"), F.col("_b")
    copies = (o.withColumns({"_a": colour("u"), "_b": colour("w")})
              .select("*", F.explode(F.array_distinct(F.concat(cells(a, b, None), cells(a, None, b), cells(None, a, b)))).alias("cell")))
    i, j, k = F.floor(F.col("cell") / rho ** 2), F.floor(F.col("cell") / rho) % rho, F.col("cell") % rho
    role = sum(F.when((x == a) & (y == b), bit).otherwise(0) for x, y, bit in ((i, j, 1), (i, k, 2), (j, k, 4)))
    copies = copies.select(*g, "cell", "u", "w", role.cast("tinyint").alias("role"))

    def solve(table: pa.Table) -> pa.Table:
        u, w = table["u"].to_numpy(), table["w"].to_numpy()
        row, x = _closings(u, w, table["role"].to_numpy())
        order = np.argsort(row, kind="stable")
        row, x = row[order], x[order]
        first = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else row
        at = row[first]
        xs = pa.ListArray.from_arrays(pa.array(np.append(first, len(row)), pa.int32()), pa.array(x, table.schema.field("u").type))
        same = pa.array(np.zeros(len(at), np.int64))
        return pa.table([*[table[c].take(same) for c in g], pa.array(u[at]), pa.array(w[at]), xs], names=[*g, "u", "w", "xs"])

    kind = o.schema["u"].dataType
    found = T.StructType([*[o.schema[c] for c in g], T.StructField("u", kind), T.StructField("w", kind),
                          T.StructField("xs", T.ArrayType(kind))])
    return copies.groupBy(*g, "cell").applyInArrow(solve, found)


def closing_vertices(canon: DataFrame, group: Sequence[str] = (), method: str | None = None) -> DataFrame:
    """(group..., u, w, xs): per oriented edge and part of its lists, the third vertices of the triangles found at it.

    ``method`` is "lists", "colours" or None: what costs less."""
    g = list(group)
    ensure_checkpoint_dir(canon.sparkSession)
    o = oriented(canon, g).checkpoint(eager=True)
    sides = F.explode(F.array(F.struct(F.col("u").alias("v"), F.lit(True).alias("out")),
                              F.struct(F.col("w").alias("v"), F.lit(False).alias("out")))).alias("s")
    d = F.col("d")
    cost = (o.select(*g, sides).groupBy(*g, "s").agg(F.count(F.lit(1)).alias("d"))
            .groupBy(*g).agg(F.sum(F.when(F.col("s.out"), d)).alias("edges"),
                             F.sum(F.when(F.col("s.out"), d.cast("double") * d)).alias("wedges"),
                             F.max(F.when(F.col("s.out"), d)).alias("longest"), F.max(F.when(~F.col("s.out"), d)).alias("hub"))
            .agg(F.max("edges"), F.sum("edges"), F.sum("wedges"), F.max("longest"), F.max("hub")).first())
    largest, edges, wedges, longest, hub = (x or 0 for x in cost)
    rho = colours_for(largest, hub)
    if method is None:
        method = "colours" if ROW_COST * (3 * rho - 2) * edges < wedges else "lists"
    return _by_lists(o, g, longest) if method == "lists" else _by_colours(o, g, rho)


def triangles(edges: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Triangle list (group..., x1 < x2 < x3)."""
    g = list(group)
    cv = closing_vertices(canonical_edges(edges, g), g)
    t = cv.select(*g, "u", "w", F.explode("xs").alias("x"))
    s = F.sort_array(F.array("u", "w", "x"))
    return t.select(*g, s[0].alias("x1"), s[1].alias("x2"), s[2].alias("x3"))


def triangle_count(edges: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    g = list(group)
    cv = closing_vertices(canonical_edges(edges, g), g)
    if g:
        return cv.groupBy(*g).agg(F.sum(F.size("xs")).cast("bigint").alias("triangles"))
    return cv.agg(F.coalesce(F.sum(F.size("xs")), F.lit(0)).cast("bigint").alias("triangles"))


def local_triangles(edges: DataFrame, with_global: bool = True) -> DataFrame:
    """(v, triangles) per vertex in at least one triangle, plus the global row ``v = -1``."""
    cv = closing_vertices(canonical_edges(edges))
    t = F.size("xs").cast("bigint")
    one = F.transform("xs", lambda x: F.struct(x.alias("v"), F.lit(1).cast("bigint").alias("c")))
    # the triangles are read once: the total is a third of what all vertices get
    credits = cv.select(F.explode(F.concat(F.array(F.struct(F.col("u").alias("v"), t.alias("c")),
                                                   F.struct(F.col("w").alias("v"), t.alias("c"))), one)).alias("r")).select("r.v", "r.c")
    per_v = credits.groupBy("v").agg(F.sum("c").cast("bigint").alias("triangles"))
    if not with_global:
        return per_v
    per_v = per_v.checkpoint(eager=True)
    total = per_v.agg(F.lit(-1).cast("bigint").alias("v"), F.expr("sum(triangles) div 3").alias("triangles"))
    return per_v.unionByName(total)


def triangle_changelog(edges: DataFrame, order: str = "pos") -> DataFrame:
    """Triangles counted when their last edge first arrives: (pos, new_triangles, total_triangles)."""
    first = (edges.select(F.least("src", "trg").alias("a"), F.greatest("src", "trg").alias("b"), order)
             .where(F.col("a") != F.col("b"))
             .groupBy("a", "b").agg(F.min(order).alias("p")))
    tri = triangles(edges)

    def pos_of(x, y, name):
        return first.select(F.col("a").alias(x), F.col("b").alias(y), F.col("p").alias(name))

    closed = (tri.join(pos_of("x1", "x2", "p12"), ["x1", "x2"])
              .join(pos_of("x1", "x3", "p13"), ["x1", "x3"])
              .join(pos_of("x2", "x3", "p23"), ["x2", "x3"])
              .select(F.greatest("p12", "p13", "p23").alias(order)))
    per_pos = closed.groupBy(order).agg(F.count(F.lit(1)).cast("bigint").alias("new_triangles"))
    run = OrderedFrame(per_pos, [], [order]).running("total_triangles", F.col("new_triangles"), "sum").result()
    return run.select(order, "new_triangles", F.col("total_triangles").cast("bigint").alias("total_triangles"))


def window_triangles(edges: DataFrame, size: str) -> DataFrame:
    """Per tumbling window with at least one edge: (window max ts in ms, triangles), zero included.

    A window holding only self-loops still has edges, hence a row with 0.
    """
    w = edges.select(F.window("ts", size).alias("window"), "src", "trg")
    counts = triangle_count(w, ["window"])
    windows = w.select("window").distinct()
    return (windows.join(counts, "window", "left")
            .select(win_max_ts().alias("w_max_ts"), F.coalesce("triangles", F.lit(0)).cast("bigint").alias("triangles")))
