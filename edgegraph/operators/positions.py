"""Arrival order without a single-partition window.

The reference depends on arrival order; Spark rows have none, so order-sensitive operators take an
explicit order key. ``ORDER BY`` windows without ``PARTITION BY`` move every row into one task, and
``PARTITION BY key`` windows put a hot key (a third of all rows, say) into one task. Both are avoided
here the same way:

1. range-partition on ``keys + order`` (Spark samples the bounds, so a hot key is spread over many
   partitions) and sort within partitions;
2. compute the running value inside each partition (narrow, or one more hash shuffle on
   ``(partition id, key)`` whose groups are bounded by the partition size);
3. carry the totals of earlier partitions forward through a table with one row per partition.
   Its size is bounded by the number of partitions, never by the data, so it is broadcast.

The ranged frame is read twice (partition summaries, rows). Range bounds come from sampling, and the
sample depends on the input's row order, which a join under AQE does not fix; so the partition ids are
frozen by a reliable ``checkpoint()`` into the shared ``spark.checkpoint.dir`` before both reads. This holds
even for a plain file scan: the range sampler seeds itself with the RDD id, so two reads of the same scan
sample different bounds.

Order columns must form a total order (unique), as an arrival position would.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgegraph.session import ensure_checkpoint_dir

_PID = "_eg_pid"
_LOCAL = "_eg_local"


def _num_partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in names]


def with_position(df: DataFrame, order: Sequence[str | Column], name: str = "pos",
                  num_partitions: int | None = None) -> DataFrame:
    """Add a 1-based position in the total order ``order`` (a distributed ``zipWithIndex``).

    One range shuffle; the per-partition index comes from ``monotonically_increasing_id`` over the
    sorted partition, and the offsets of earlier partitions from a broadcast table of partition counts.
    """
    n = _num_partitions(df, num_partitions)
    order_cols = _cols(order)
    ranged = (df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
              .withColumn(_PID, F.spark_partition_id())
              .withColumn(_LOCAL, F.monotonically_increasing_id()
                          - F.shiftleft(F.col(_PID).cast("long"), 33)))
    ensure_checkpoint_dir(df.sparkSession)
    ranged = ranged.checkpoint(eager=True)
    counts = ranged.groupBy(_PID).agg(F.count(F.lit(1)).alias("_eg_cnt"))
    # One row per partition: the window below runs over a table bounded by the partition count.
    offsets = counts.select(
        _PID,
        F.coalesce(F.sum("_eg_cnt").over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_eg_off"))
    return (ranged.join(F.broadcast(offsets), _PID)
            .withColumn(name, (F.col("_eg_off") + F.col(_LOCAL) + F.lit(1)).cast("long"))
            .drop(_PID, _LOCAL, "_eg_off"))


_OPS = {"sum": F.sum, "min": F.min, "max": F.max}


class OrderedFrame:
    """A frame range-partitioned on ``keys + order`` supporting keyed running aggregates.

    ``running(name, value, op)`` adds ``op(value) OVER (PARTITION BY keys ORDER BY order ROWS UNBOUNDED
    PRECEDING)`` with ``op`` in sum/min/max, without ever placing one key in one task.
    Several ``running`` calls share the same partitioning (no further shuffle).
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 num_partitions: int | None = None):
        self.keys = list(keys)
        self.order = list(order)
        n = _num_partitions(df, num_partitions)
        cols = _cols(self.keys + self.order)
        self._key_struct = F.struct(*[F.col(k) for k in self.keys]) if self.keys else F.struct(F.lit(0).alias("k"))
        ensure_checkpoint_dir(df.sparkSession)
        self.df = (df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
                   .withColumn(_PID, F.spark_partition_id())).checkpoint(eager=True)

    def _window(self):
        return (Window.partitionBy(F.col(_PID), *[F.col(k) for k in self.keys])
                .orderBy(*[F.col(o) for o in self.order])
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))

    def running(self, name: str, value: str | Column, op: str = "sum") -> "OrderedFrame":
        agg = _OPS[op]
        value_col = F.col(value) if isinstance(value, str) else value
        local = self.df.withColumn(_LOCAL, agg(value_col).over(self._window()))
        keyed = local.withColumn("_eg_key", self._key_struct)
        order_struct = F.struct(*[F.col(o) for o in self.order])
        # Per partition: its first key, its last key and the running value at its last row.
        summary = keyed.groupBy(_PID).agg(
            F.min("_eg_key").alias("_eg_first"),
            F.max_by(F.struct(F.col("_eg_key").alias("k"), F.col(_LOCAL).alias("v")),
                     F.struct(F.col("_eg_key"), order_struct)).alias("_eg_last"))
        # A key that is first in partition p and occurs earlier is the last key of every earlier partition it
        # touches, and those partitions are contiguous (rows follow the range order). So the carry into p is the
        # running total over partitions ending in that key, read at the previous partition: two windows over
        # the one-row-per-partition summary (linear in the partition count, never a pairwise join).
        s_rows = summary.select(F.col(_PID).alias("_eg_p"), F.col("_eg_first").alias("_eg_ck"),
                                F.col("_eg_last.k").alias("_eg_lk"), F.col("_eg_last.v").alias("_eg_lv"))
        s_rows = s_rows.withColumn("_eg_cum", agg("_eg_lv").over(
            Window.partitionBy("_eg_lk").orderBy("_eg_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        by_pid = Window.orderBy("_eg_p")
        carry = (s_rows.select("_eg_p", "_eg_ck",
                               F.lag("_eg_lk").over(by_pid).alias("_eg_plk"),
                               F.lag("_eg_cum").over(by_pid).alias("_eg_pcum"))
                 .where(F.col("_eg_plk") == F.col("_eg_ck"))
                 .select("_eg_p", "_eg_ck", F.col("_eg_pcum").alias("_eg_carry")))
        joined = keyed.join(F.broadcast(carry),
                            (F.col(_PID) == F.col("_eg_p")) & (F.col("_eg_key") == F.col("_eg_ck")), "left")
        if op == "sum":
            out = F.coalesce(F.col(_LOCAL) + F.coalesce(F.col("_eg_carry"), F.lit(0)), F.col(_LOCAL), F.col("_eg_carry"))
        elif op == "min":
            out = F.least(F.col(_LOCAL), F.coalesce(F.col("_eg_carry"), F.col(_LOCAL)))
        else:
            out = F.greatest(F.col(_LOCAL), F.coalesce(F.col("_eg_carry"), F.col(_LOCAL)))
        new = OrderedFrame.__new__(OrderedFrame)
        new.keys, new.order, new._key_struct = self.keys, self.order, self._key_struct
        new.df = (joined.withColumn(name, out)
                  .drop(_LOCAL, "_eg_key", "_eg_p", "_eg_ck", "_eg_carry"))
        return new

    def with_column(self, name: str, expr: Column) -> "OrderedFrame":
        new = OrderedFrame.__new__(OrderedFrame)
        new.keys, new.order, new._key_struct = self.keys, self.order, self._key_struct
        new.df = self.df.withColumn(name, expr)
        return new

    def result(self) -> DataFrame:
        return self.df.drop(_PID)


def keyed_position(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rank",
                   num_partitions: int | None = None) -> DataFrame:
    """1-based position of each row inside its key, in ``order`` (a hot key spans many tasks)."""
    return OrderedFrame(df, keys, order, num_partitions).running(name, F.lit(1).cast("long"), "sum").result()


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, value: str | Column,
            op: str = "sum", num_partitions: int | None = None) -> DataFrame:
    return OrderedFrame(df, keys, order, num_partitions).running(name, value, op).result()
