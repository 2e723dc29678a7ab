"""Keyed state merged per micro-batch (``foreachBatch``): cumulative summaries, user states, count windows, degree
distribution, bipartiteness, matching, spanner.

Operators that chain an unbounded history (a running total over all windows, a clamped walk per vertex, a growing
graph) have no append-mode plan. Each micro-batch is reduced to one mergeable row per key, joined to the state table and
written as the next version. The version of a batch is named after its batch id, and the newest complete version *below*
that id is its input, so a replayed batch starts from the same state and overwrites its own result: additions are counted
once whatever fails. One state folder belongs to one stream checkpoint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from edgegraph.operators import bipartite as B
from edgegraph.operators.matching import preempt
from edgegraph.operators.monoid import Monoid, fold
from edgegraph.operators.positions import OrderedFrame
from edgegraph.operators.spanner import extend_spanner
from edgegraph.operators.summary import (Field, StateField, merge_fields, running_fields, running_states, window_partials,
                                         window_states)
from edgegraph.operators.transforms import endpoints
from edgegraph.operators.windows import count_windows
from edgegraph.streaming.components import IncrementalComponents, _HadoopFS


class KeyedState:
    """A table per batch id; subclasses give ``schema`` and ``merge(state, batch)``."""

    schema: str

    def __init__(self, spark: SparkSession, state_dir: str):
        self.spark = spark
        self.state_dir = state_dir.rstrip("/")
        self._fs = _HadoopFS(spark, self.state_dir)

    def merge(self, state: DataFrame, batch: DataFrame) -> DataFrame:
        raise NotImplementedError

    def _versions(self) -> list[int]:
        return [int(n[1:]) for n in self._fs.names("b") if self._fs.exists(f"{n}/_SUCCESS")]

    def _path(self, version: int) -> str:
        return f"{self.state_dir}/b{version:012d}"

    def state(self, before: int | None = None) -> DataFrame:
        done = [v for v in self._versions() if before is None or v < before]
        if not done:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.parquet(self._path(done[-1]))

    def update(self, batch: DataFrame, batch_id: int) -> None:
        state = self.state(batch_id)
        self.merge(state, batch).write.mode("overwrite").parquet(self._path(batch_id))
        for name in self._fs.names("b"):
            if int(name[1:]) < batch_id - 1:  # the previous one is the input of a replay
                self._fs.delete(name)

    def start(self, edges: DataFrame, checkpoint: str, available_now: bool = True):
        w = edges.writeStream.foreachBatch(self.update).option("checkpointLocation", checkpoint)
        return (w.trigger(availableNow=True) if available_now else w).start()


class SummaryStream(KeyedState):
    """Cumulative window summary (H2) on a stream: state is one merged row per window, in the types of the spec's fields."""

    schema: StructType | str | None = None

    def __init__(self, spark: SparkSession, state_dir: str, size: str, spec: Sequence[Field]):
        super().__init__(spark, state_dir)
        self.size, self.spec = size, list(spec)

    def merge(self, state: DataFrame, batch: DataFrame) -> DataFrame:
        new = window_partials(batch, self.size, self.spec)
        merged = merge_fields(state.unionByName(new), ["w_start", "w_end"], self.spec)
        return merged.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in state.schema])

    def update(self, batch: DataFrame, batch_id: int) -> None:
        if self.schema is None:
            self.schema = window_partials(batch, self.size, self.spec).schema
        super().update(batch, batch_id)

    def results(self) -> DataFrame:
        return running_fields(self.state(), self.spec)


class StateStream(KeyedState):
    """Any mergeable state (:class:`~edgegraph.operators.monoid.Monoid`) on a stream: per key, or per window of ``size``. A batch's
    edges are folded in the order of ``field.order`` and merged behind the state so far; so arrival order is the order of
    the micro-batches and, within one, ``field.order``."""

    schema: StructType | str | None = None

    def __init__(self, spark: SparkSession, state_dir: str, field: StateField, keys: Sequence[str] = (), size: str | None = None):
        super().__init__(spark, state_dir)
        self.field, self.size = field, size
        self.keys = ["w_start", "w_end"] if size else list(keys)

    def _folded(self, batch: DataFrame) -> DataFrame:
        if self.size:
            return window_states(batch, self.size, self.field)
        return fold(batch, self.keys, Monoid(self.field.state.lift, self.field.state.merge), [self.field.order], self.field.name)

    def merge(self, state: DataFrame, batch: DataFrame) -> DataFrame:
        kind = state.schema[self.field.name].dataType
        both = state.withColumn("_new", F.lit(0)).unionByName(self._folded(batch).withColumn("_new", F.lit(1)))
        side = [F.first(F.when(F.col("_new") == i, F.col(self.field.name)), ignorenulls=True).alias(f"_s{i}") for i in (0, 1)]
        joined = self.field.state.joined(kind)(F.col("_s0"), F.col("_s1"))
        return both.groupBy(*self.keys).agg(*side).select(*self.keys, joined.alias(self.field.name))

    def update(self, batch: DataFrame, batch_id: int) -> None:
        if self.schema is None:
            self.schema = self._folded(batch.limit(0)).schema
        super().update(batch, batch_id)

    def results(self, cumulative: bool = True) -> DataFrame:
        """Finished values per key; of windows, merged in time order if ``cumulative``."""
        if self.size:
            return running_states(self.state(), self.field, cumulative)
        state, m = self.state(), self.field.state
        return state.select(*self.keys, m.output(F.col(self.field.name), state.schema[self.field.name].dataType).alias(self.field.name))


class CountWindowStream(KeyedState):
    """Count windows (F6) on a stream: state is one row per window of ``n`` edges, the last one still filling.

    Arrival order is the order of the micro-batches and, within one, ``order``; positions go on from the edges so far."""

    schema = "bucket bigint, n_edges bigint, sum_amount bigint, first_pos bigint, last_pos bigint"

    def __init__(self, spark: SparkSession, state_dir: str, n: int, order: Sequence[str]):
        super().__init__(spark, state_dir)
        self.n, self.order = n, list(order)

    def merge(self, state: DataFrame, batch: DataFrame) -> DataFrame:
        seen = state.agg(F.max("last_pos")).first()[0] or 0
        new = count_windows(batch, self.n, self.order, offset=seen)
        return state.unionByName(new).groupBy("bucket").agg(
            F.sum("n_edges").alias("n_edges"), F.sum("sum_amount").alias("sum_amount"),
            F.min("first_pos").alias("first_pos"), F.max("last_pos").alias("last_pos"))

    def results(self, complete_only: bool = False) -> DataFrame:
        return self.state().where(F.col("n_edges") == self.n) if complete_only else self.state()


class DegreeDistributionStream(KeyedState):
    """Degree distribution under additions and deletions (C13) on a stream: state is one degree per vertex.

    A batch of a vertex acts on its degree d as a clamped walk: with the batch's changes in order, their running sums s_i and
    smallest one m = min(0, s_1, ..., s_n), the degree becomes max(d + s_n, s_n - m). So a batch is one (s_n, m) pair per
    vertex, computed by ordered scans that split a hot vertex. Files must arrive in the order of ``order``."""

    schema = "v bigint, degree bigint"

    def __init__(self, spark: SparkSession, state_dir: str, order: str = "pos"):
        super().__init__(spark, state_dir)
        self.order = order

    def merge(self, state: DataFrame, batch: DataFrame) -> DataFrame:
        if "chg" not in batch.columns:
            batch = batch.withColumn("chg", F.lit(1))
        ends = endpoints(batch, "chg", self.order, side=True)
        run = OrderedFrame(ends, ["v"], [self.order, "side"]).running("s", F.col("chg").cast("long"), "sum").result()
        step = run.groupBy("v").agg(F.max_by("s", F.struct(self.order, "side")).alias("last"),
                                    F.least(F.min("s"), F.lit(0)).alias("low"))
        d = F.coalesce("degree", F.lit(0))
        moved = F.when(F.col("last").isNull(), d).otherwise(F.greatest(d + F.col("last"), F.col("last") - F.col("low")))
        return state.join(step, "v", "full").select("v", moved.cast("bigint").alias("degree"))

    def results(self) -> DataFrame:
        return (self.state().where("degree > 0").groupBy("degree").agg(F.count(F.lit(1)).cast("bigint").alias("n_vertices")))


class BipartiteStream:
    """Bipartiteness (H5) on a stream: incremental components of the double cover."""

    def __init__(self, spark: SparkSession, state_dir: str):
        self.cover = IncrementalComponents(spark, state_dir)

    def update(self, batch: DataFrame, batch_id: int | None = None) -> None:
        self.cover.update(B.double_cover(batch), batch_id)

    def start(self, edges: DataFrame, checkpoint: str, available_now: bool = True):
        w = edges.writeStream.foreachBatch(self.update).option("checkpointLocation", checkpoint)
        return (w.trigger(availableNow=True) if available_now else w).start()

    def results(self) -> DataFrame:
        """(component, bipartite, size) of the edges so far."""
        return B.components_of_cover(self.cover.labels())


class MatchingStream(KeyedState):
    """Weighted matching (H13) on a stream: state is the matching, and every micro-batch logs its ADD and REMOVE events."""

    schema: StructType | str | None = None

    def __init__(self, spark: SparkSession, state_dir: str, weight: str = "amount"):
        super().__init__(spark, state_dir)
        self.weight = weight

    def update(self, batch: DataFrame, batch_id: int) -> None:
        if self.schema is None:
            kind = batch.schema[self.weight].dataType.simpleString()
            self.schema = f"src bigint, trg bigint, weight {kind}"
        self._batch_id = batch_id
        super().update(batch, batch_id)

    def merge(self, state: DataFrame, batch: DataFrame) -> DataFrame:
        matching, events = preempt(state, batch, self.weight)
        # before the state: a version without its events cannot exist, and a replay overwrites both
        events.write.mode("overwrite").parquet(f"{self.state_dir}/events/batch={self._batch_id}")
        return matching

    def events(self) -> DataFrame:
        """(batch, round, op, src, trg, weight) of all batches so far."""
        return self.spark.read.parquet(f"{self.state_dir}/events")

    def results(self) -> DataFrame:
        return self.state()


class SpannerStream(KeyedState):
    """k-spanner (H6) on a stream: state is the spanner; see :func:`~edgegraph.operators.spanner.extend_spanner`."""

    schema = "src bigint, trg bigint"

    def __init__(self, spark: SparkSession, state_dir: str, k: int = 3):
        super().__init__(spark, state_dir)
        self.k = k

    def merge(self, state: DataFrame, batch: DataFrame) -> DataFrame:
        return extend_spanner(state, batch.where(F.col("src").isNotNull() & F.col("trg").isNotNull()), self.k)

    def results(self) -> DataFrame:
        return self.state()
