"""Ordered changelogs, components and exact triangles of an unbounded stream, over tables that only grow (``foreachBatch``).

What a stream has seen (vertices, neighbour pairs, edges) is never changed, only added to. So its state is a Parquet table with one
partition per micro-batch: a batch reads the partitions before its own, and writes (or, replayed, overwrites) its own partition. The
bytes written follow the batch, not the state, and a replayed batch adds nothing twice.

Running values go on where the batch before stopped: the total so far of each key that the batch touches enters the ordered scan as
the key's first row, so a key holding a third of a batch is split over tasks like any other and is never joined row by row.

Arrival order is the order of the micro-batches and, within one, ``order``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edgegraph.operators.components import connected_components
from edgegraph.operators.degree_dist import changes_of_walk, clamped_walk
from edgegraph.operators.positions import OrderedFrame, with_position
from edgegraph.operators.transforms import endpoints
from edgegraph.session import ensure_checkpoint_dir
from edgegraph.streaming.components import _HadoopFS

_AGAIN = "_eg_again"


def with_carry(rows: DataFrame, carry: DataFrame) -> DataFrame:
    """``rows`` and the earlier totals of their keys; ``_eg_again`` (0 for a total, 1 for a row) leads the order of the scan."""
    return (rows.withColumn(_AGAIN, F.lit(1))
            .unionByName(carry.withColumn(_AGAIN, F.lit(0)), allowMissingColumns=True))


def resumed_sum(rows: DataFrame, carry: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """``rows`` with the running sum ``name`` of ``value`` per key, behind ``carry`` (keys and ``value``: the sums so far)."""
    run = OrderedFrame(with_carry(rows, carry), keys, [_AGAIN, *order]).running(name, F.col(value).cast("long"), "sum").result()
    return run.where(F.col(_AGAIN) == 1).drop(_AGAIN)


class AppendStream:
    """Tables with one partition per micro-batch; subclasses give ``tables`` (name to schema) and ``step``."""

    tables: dict[str, str]

    def __init__(self, spark: SparkSession, state_dir: str, order: str = "pos"):
        self.spark = spark
        self.root = state_dir.rstrip("/")
        self.order = order
        ensure_checkpoint_dir(spark)

    def table(self, name: str, before: int | None = None) -> DataFrame:
        """Rows of a table, of the micro-batches below ``before`` if it is given."""
        schema, fs = self.tables[name], _HadoopFS(self.spark, f"{self.root}/{name}")
        if not fs.names("batch="):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(f"{schema}, batch bigint").parquet(f"{self.root}/{name}")
        return (rows if before is None else rows.where(F.col("batch") < before)).drop("batch")

    def put(self, name: str, rows: DataFrame, batch_id: int) -> DataFrame:
        """Write a micro-batch's partition; returns it as written."""
        schema = self.spark.createDataFrame([], self.tables[name]).schema
        path = f"{self.root}/{name}/batch={batch_id}"
        rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]).write.mode("overwrite").parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def ends(self, batch: DataFrame, *extra: str) -> DataFrame:
        """(v, side, pos and ``extra``) of the edges' ends; a null end counts as none."""
        e = batch.select("src", "trg", F.col(self.order).cast("long").alias("pos"), *extra)
        return endpoints(e, "pos", *extra, side=True).where(F.col("v").isNotNull())

    def step(self, batch: DataFrame, batch_id: int) -> None:
        raise NotImplementedError

    def update(self, batch: DataFrame, batch_id: int) -> None:
        self.step(batch, batch_id)

    def start(self, edges: DataFrame, checkpoint: str, available_now: bool = True):
        w = edges.writeStream.foreachBatch(self.update).option("checkpointLocation", checkpoint)
        return (w.trigger(availableNow=True) if available_now else w).start()


class VertexCountStream(AppendStream):
    """Running distinct-vertex count (C6): one row per new vertex, (v, pos, side, n_vertices), as the batch changelog gives it."""

    tables = {"log": "v bigint, pos bigint, side int, n_vertices bigint"}

    def step(self, batch: DataFrame, batch_id: int) -> None:
        seen = self.table("log", batch_id)
        firsts = (self.ends(batch).groupBy("v").agg(F.min(F.struct("pos", "side")).alias("_f"))
                  .join(seen.select("v"), "v", "left_anti").select("v", "_f.pos", "_f.side"))
        before = seen.agg(F.max("n_vertices")).first()[0] or 0
        new = with_position(firsts, ["pos", "side", "v"], name="_n")
        self.put("log", new.withColumn("n_vertices", F.col("_n") + before), batch_id)

    def results(self) -> DataFrame:
        return self.table("log")


class NeighborhoodStream(AppendStream):
    """Running neighbourhoods (C10): per arriving edge and vertex (v, nbr, pos, side, is_new, n_nbrs). What is kept to go on with
    is the table of new pairs."""

    tables = {"log": "v bigint, nbr bigint, pos bigint, side int, is_new boolean, n_nbrs bigint", "seen": "v bigint, nbr bigint"}

    def __init__(self, spark: SparkSession, state_dir: str, directed: bool = True, order: str = "pos"):
        super().__init__(spark, state_dir, order)
        self.directed = directed

    def step(self, batch: DataFrame, batch_id: int) -> None:
        seen = self.table("seen", batch_id)
        e = batch.where(F.col("src").isNotNull() & F.col("trg").isNotNull())
        ends = e.select(F.col("src").alias("v"), F.col("trg").alias("nbr"), F.col(self.order).alias("pos"), F.lit(0).alias("side"))
        if not self.directed:
            ends = ends.unionByName(e.select(F.col("trg").alias("v"), F.col("src").alias("nbr"), F.col(self.order).alias("pos"),
                                             F.lit(1).alias("side")))
        firsts = (ends.groupBy("v", "nbr").agg(F.min(F.struct("pos", "side")).alias("_first"))
                  .join(seen.withColumn("_old", F.lit(True)), ["v", "nbr"], "left"))
        flagged = (ends.join(firsts, ["v", "nbr"])
                   .withColumn("is_new", F.col("_old").isNull() & (F.struct("pos", "side") == F.col("_first")))
                   .withColumn("_n", F.col("is_new").cast("long")).drop("_first", "_old"))
        sizes = (seen.join(ends.select("v").distinct(), "v", "left_semi")
                 .groupBy("v").agg(F.count(F.lit(1)).cast("long").alias("_n")))
        log = self.put("log", resumed_sum(flagged, sizes, ["v"], ["pos", "side"], "_n", "n_nbrs"), batch_id)
        self.put("seen", log.where("is_new"), batch_id)

    def results(self) -> DataFrame:
        return self.table("log")


class DegreeChangelogStream(AppendStream):
    """Degree changelog under additions (C4) with the vertex's degree after each endpoint event: (v, pos, side, degree). ``last``
    holds the degree that a vertex leaves each of its batches with."""

    tables = {"log": "v bigint, pos bigint, side int, degree bigint", "last": "v bigint, degree bigint"}

    def step(self, batch: DataFrame, batch_id: int) -> None:
        ends = self.ends(batch).withColumn("_n", F.lit(1).cast("long"))
        so_far = (self.table("last", batch_id).join(ends.select("v").distinct(), "v", "left_semi")
                  .groupBy("v").agg(F.max("degree").alias("_n")))  # degrees only rise
        log = self.put("log", resumed_sum(ends, so_far, ["v"], ["pos", "side"], "_n", "degree"), batch_id)
        self.put("last", log.groupBy("v").agg(F.max("degree").alias("degree")), batch_id)

    def results(self) -> DataFrame:
        return self.table("log")


class DegreeDistributionChangelogStream(AppendStream):
    """Changelog of the degree distribution under additions and deletions (C14): (pos, side, sub, degree, delta, count).

    A vertex's degree so far enters its clamped walk as a first event that adds it, and a degree's number of vertices so far enters
    the running count of its changes in the same way. ``moved`` holds the net change of each degree's count per batch."""

    tables = {"log": "pos bigint, side int, sub int, degree bigint, delta int, count bigint",
              "last": "v bigint, degree bigint, at bigint", "moved": "degree bigint, n bigint"}

    def step(self, batch: DataFrame, batch_id: int) -> None:
        if "chg" not in batch.columns:
            batch = batch.withColumn("chg", F.lit(1))
        ends = self.ends(batch, "chg").withColumn("chg", F.col("chg").cast("long"))
        so_far = (self.table("last", batch_id).join(ends.select("v").distinct(), "v", "left_semi")
                  .groupBy("v").agg(F.max_by("degree", "at").alias("chg")))
        walk = (clamped_walk(with_carry(ends, so_far), [_AGAIN, "pos", "side"])
                .where(F.col(_AGAIN) == 1).drop(_AGAIN)).checkpoint(eager=True)
        events = changes_of_walk(walk, ["pos", "side"])
        counts = self.table("moved", batch_id).groupBy("degree").agg(F.sum("n").alias("delta"))
        log = self.put("log", resumed_sum(events, counts, ["degree"], ["pos", "side", "sub"], "delta", "count"), batch_id)
        self.put("moved", log.groupBy("degree").agg(F.sum("delta").alias("n")).where("n <> 0"), batch_id)
        last = walk.groupBy("v").agg(F.max_by("d_new", F.struct("pos", "side")).alias("degree"))
        self.put("last", last.withColumn("at", F.lit(batch_id)), batch_id)

    def results(self) -> DataFrame:
        return self.table("log")


class ExactTriangleStream(AppendStream):
    """Exact triangle counts (H8, C11) of a growing graph, global and per vertex, each triangle counted at its last edge.

    A batch's new edges (not seen before, either way round) are looked at once each: the neighbours of the end of smaller degree are
    listed, and those that the other end is linked to as well, by edges that came before, close a triangle there. So new edges meet
    old and new ones in one form, the rows listed are the sum of the smaller degrees of the new edges, and no hub is expanded unless
    both ends are hubs. Self-loops, repeated and reversed edges and edges with a null end count nothing."""

    tables = {"edges": "a bigint, b bigint, p bigint", "log": "pos bigint, new_triangles bigint, total_triangles bigint",
              "local": "v bigint, triangles bigint"}

    def step(self, batch: DataFrame, batch_id: int) -> None:
        old = self.table("edges", batch_id)
        first = (batch.select(F.least("src", "trg").alias("a"), F.greatest("src", "trg").alias("b"), F.col(self.order).alias("p"))
                 .where(F.col("a") != F.col("b")).groupBy("a", "b").agg(F.min("p").alias("p"))
                 .join(old.select("a", "b"), ["a", "b"], "left_anti"))
        new = self.put("edges", first, batch_id)
        # an edge's place: old ones before all new ones, these by arrival (ends break ties)
        place = F.struct(F.col("p"), F.col("a"), F.col("b"))
        kind = "struct<p:bigint,a:bigint,b:bigint>"
        known = old.select("a", "b", F.lit(None).cast(kind).alias("at")).unionByName(new.select("a", "b", place.alias("at")))
        both = (known.select(F.col("a").alias("u"), F.col("b").alias("x"), "at")
                .unionByName(known.select(F.col("b").alias("u"), F.col("a").alias("x"), "at")))
        touched = new.select(F.explode(F.array("a", "b")).alias("u")).distinct()
        near = both.join(touched, "u", "left_semi").checkpoint(eager=True)  # neighbours of the new edges' ends
        deg = near.groupBy("u").agg(F.count(F.lit(1)).alias("d"))
        e = (new.withColumn("last", place).join(deg.select(F.col("u").alias("a"), F.col("d").alias("da")), "a")
             .join(deg.select(F.col("u").alias("b"), F.col("d").alias("db")), "b"))
        small = F.col("da") <= F.col("db")
        e = e.select("p", "last", F.when(small, F.col("a")).otherwise(F.col("b")).alias("u"),
                     F.when(small, F.col("b")).otherwise(F.col("a")).alias("w"))

        def before(at: Column) -> Column:
            return at.isNull() | (at < F.col("last"))

        listed = e.join(near, "u").where(before(F.col("at"))).select("p", "last", "u", "w", "x")
        other = near.select(F.col("u").alias("w"), "x", F.col("at").alias("at2"))
        closed = listed.join(other, ["w", "x"]).where(before(F.col("at2"))).select("p", "u", "w", "x").checkpoint(eager=True)
        per_pos = closed.groupBy(F.col("p").alias("pos")).agg(F.count(F.lit(1)).alias("new_triangles"))
        so_far = self.table("log", batch_id).agg(F.coalesce(F.sum("new_triangles"), F.lit(0)).alias("new_triangles"))
        self.put("log", resumed_sum(per_pos, so_far, [], ["pos"], "new_triangles", "total_triangles"), batch_id)
        self.put("local", closed.select(F.explode(F.array("u", "w", "x")).alias("v"))
                 .groupBy("v").agg(F.count(F.lit(1)).alias("triangles")), batch_id)

    def changelog(self) -> DataFrame:
        """(pos, new_triangles, total_triangles), as :func:`~edgegraph.operators.triangles.triangle_changelog`."""
        return self.table("log")

    def results(self) -> DataFrame:
        """(v, triangles) of the edges so far, with the global row ``v = -1``, as
        :func:`~edgegraph.operators.triangles.local_triangles`."""
        per_v = self.table("local").groupBy("v").agg(F.sum("triangles").cast("bigint").alias("triangles"))
        total = self.table("log").agg(F.lit(-1).cast("bigint").alias("v"), F.sum("new_triangles").cast("bigint").alias("triangles"))
        return per_v.unionByName(total)


class ComponentsStream(AppendStream):
    """Connected components (H4e) with two levels of labels. A vertex is written once, with the label that its component has then
    (its root). When components merge, only roots are written again: (root, label) in ``forest``, where the newest batch counts.
    So a batch writes its new vertices and the roots of the components that it merges, whatever the number of vertices so far. A
    label is the smallest vertex of its component."""

    tables = {"roots": "v bigint, root bigint", "forest": "root bigint, label bigint, at bigint"}

    def _forest(self, before: int | None = None) -> DataFrame:
        return self.table("forest", before).groupBy("root").agg(F.max_by("label", "at").alias("label"))

    def step(self, batch: DataFrame, batch_id: int) -> None:
        edges = batch.select("src", "trg").where(F.col("src").isNotNull() & F.col("trg").isNotNull())
        touched = edges.select(F.explode(F.array("src", "trg")).alias("v")).distinct()
        forest = self._forest(batch_id)
        known = (self.table("roots", batch_id).join(touched, "v", "left_semi").join(forest, "root", "left")
                 .select("v", F.coalesce("label", "root").alias("label"))).checkpoint(eager=True)
        for end in ("src", "trg"):
            edges = (edges.join(known.select(F.col("v").alias(end), "label"), end, "left")
                     .withColumn(end, F.coalesce("label", end)).drop("label"))
        merged = connected_components(edges).checkpoint(eager=True)  # (label or new vertex, its component's smallest one)
        new = touched.join(known, "v", "left_anti").join(merged, "v", "left")
        self.put("roots", new.select("v", F.coalesce("component", "v").alias("root")), batch_id)
        moved = (merged.where(F.col("v") != F.col("component")).select(F.col("v").alias("label"), "component")
                 .join(known.select("label").distinct(), "label", "left_semi"))
        roots = (moved.select(F.col("label").alias("root"), "component")
                 .unionByName(forest.join(moved, "label").select("root", "component")))
        self.put("forest", roots.select("root", F.col("component").alias("label"), F.lit(batch_id).alias("at")), batch_id)

    def labels(self) -> DataFrame:
        """(v, component) of the edges so far."""
        return (self.table("roots").join(self._forest(), "root", "left")
                .select("v", F.coalesce("label", "root").alias("component")))

    results = labels
