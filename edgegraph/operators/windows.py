"""Window operators beyond plain tumbling groups: sliding sums and count windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgegraph.functions import win_end_ms, win_start_ms
from edgegraph.operators.positions import with_position


def sliding_sum(edges: DataFrame, size: str, slide: str, key: str = "src", value: str = "amount") -> DataFrame:
    """Keyed sum over sliding event-time windows (an edge falls in ceil(size/slide) windows)."""
    return (edges.groupBy(F.window("ts", size, slide).alias("window"), key)
            .agg(F.sum(value).cast("bigint").alias(f"sum_{value}"))
            .select(win_start_ms().alias("w_start"), win_end_ms().alias("w_end"), key, f"sum_{value}"))


def count_windows(edges: DataFrame, n: int, order: list[str], value: str = "amount",
                  dense_position: str | None = None, offset: int = 0) -> DataFrame:
    """Count windows: consecutive groups of ``n`` edges in arrival order (purge every n elements).

    The bucket is ``(position - 1) // n``; positions come from a distributed ``with_position`` unless a
    dense 1..N position column is given. ``offset`` edges came before (earlier batches of a stream).
    """
    if dense_position is None:
        edges = with_position(edges, order, name="_cw_pos").withColumn("_cw_pos", F.col("_cw_pos") + offset)
        dense_position = "_cw_pos"
    return (edges.groupBy(F.expr(f"({dense_position} - 1) div {n}").cast("bigint").alias("bucket"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_edges"),
                 F.sum(value).cast("bigint").alias(f"sum_{value}"),
                 F.min(dense_position).cast("bigint").alias("first_pos"),
                 F.max(dense_position).cast("bigint").alias("last_pos")))
