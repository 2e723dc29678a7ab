"""Per-update degree changelog on a stream (C4) with ``transformWithStateInPandas``.

State per vertex: its running degree (a single long in the state store, checkpointed). For each
micro-batch, the rows of a vertex are applied in arrival order (``pos``, ``side``) and one output row is
emitted per endpoint occurrence: the literal output of the reference's running degree. Only the rows of one
vertex within one micro-batch meet in a task, so a hot vertex costs one batch's worth of its rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from edgegraph.operators.transforms import endpoints

OUT_SCHEMA = StructType([StructField("v", LongType()), StructField("pos", LongType()),
                         StructField("side", LongType()), StructField("degree", LongType())])


class DegreeChangelog(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.degree = handle.getValueState("degree", StructType([StructField("d", LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        d = self.degree.get()[0] if self.degree.exists() else 0
        batch = pd.concat(list(rows), ignore_index=True).sort_values(["pos", "side"], kind="stable")
        degrees = d + pd.Series(range(1, len(batch) + 1), dtype="int64")
        self.degree.update((int(degrees.iloc[-1]),))
        yield pd.DataFrame({"v": batch["v"].astype("int64").to_numpy(), "pos": batch["pos"].astype("int64").to_numpy(),
                            "side": batch["side"].astype("int64").to_numpy(), "degree": degrees.to_numpy()})

    def close(self) -> None:
        pass


def degree_changelog_stream(edges: DataFrame) -> DataFrame:
    """Streaming frame of (v, pos, side, degree), run with output mode ``append``."""
    ends = endpoints(edges.select("src", "trg", "pos"), "pos", side=True)
    ends = ends.select("v", "pos", ends["side"].cast("long").alias("side"))
    return ends.groupBy("v").transformWithStateInPandas(
        statefulProcessor=DegreeChangelog(), outputStructType=OUT_SCHEMA, outputMode="Append", timeMode="None")
