"""Sampled triangle estimates (H10-H12) on a stream: reservoirs that resume.

State is one row per sampler: its sample and third vertex, which closing edges have come, and the position at which it takes its
next sample. A micro-batch draws on only in the samplers whose next position falls into it, and is matched once against the pairs
that the samplers watch. So after any split of a stream into batches the samples and the estimate are those of
:func:`~edgegraph.operators.estimators.estimate` over the edges so far with the same ``vertices``.

The state has ``samples`` rows, a parameter; it does not grow with the stream. Ids are 0..vertices-1: the third vertex must be known
when a sample is taken, before the vertices of later batches are. An empty batch changes nothing; edges with a null end take a
position and close nothing, as in the batch form. A replayed batch starts from the version before it.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edgegraph.operators import estimators as E
from edgegraph.operators.positions import with_position
from edgegraph.streaming.keyed import KeyedState


class EstimatorStream(KeyedState):
    """Triangle estimate of the edges so far. Arrival order is the order of the micro-batches and, within one, ``order``."""

    schema = "i bigint, p bigint, next bigint, a bigint, b bigint, t bigint, hit_a boolean, hit_b boolean, n_edges bigint"

    def __init__(self, spark: SparkSession, state_dir: str, samples: int, vertices: int, order: Sequence[str] = ("pos",),
                 seed: str = E.DEFAULT_SEED):
        super().__init__(spark, state_dir)
        if vertices < 3:
            raise ValueError("a triangle needs three vertices")
        self.samples, self.vertices, self.order, self.seed = samples, vertices, list(order), seed

    def state(self, before: int | None = None) -> DataFrame:
        found = super().state(before)
        if not found.isEmpty():
            return found
        parts = max(1, min(self.samples, int(self.spark.conf.get("spark.sql.shuffle.partitions"))))
        i = self.spark.range(0, self.samples, 1, parts)
        fresh = {"i": F.col("id"), "next": F.lit(1), "hit_a": F.lit(False), "hit_b": F.lit(False), "n_edges": F.lit(0)}
        return i.select(*[fresh.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in found.schema])

    def merge(self, state: DataFrame, batch: DataFrame) -> DataFrame:
        seen = state.agg(F.max("n_edges")).first()[0]
        edges = (with_position(batch.select("src", "trg", *[F.col(c).alias(f"_o{k}") for k, c in enumerate(self.order)]),
                               [f"_o{k}" for k in range(len(self.order))], "at")
                 .select("src", "trg", (F.col("at") + seen).alias("at")))
        total = seen + edges.count()
        seed = self.seed

        def draw_on(batches):
            for pdf in batches:
                ends = [E.resume_chain(i, p, total, seed) for i, p in zip(pdf["i"].tolist(), pdf["next"].tolist())]
                yield pd.DataFrame({"i": pdf["i"], "p": pd.Series([e[0] for e in ends], dtype="int64"),
                                    "next": pd.Series([e[1] for e in ends], dtype="int64")})

        due = state.where(F.col("next") <= total).select("i", "next").mapInPandas(draw_on, "i long, p long, next long")
        fresh = due.join(edges.select(F.col("at").alias("p"), F.col("src").alias("a"), F.col("trg").alias("b")), "p")
        fresh = (E.with_third(fresh, self.vertices, self.seed)
                 .select("i", "p", "next", "a", "b", "t", F.lit(False).alias("hit_a"), F.lit(False).alias("hit_b")))
        held = state.where(F.col("next") > total).drop("n_edges").unionByName(fresh).checkpoint(eager=True)
        rows = F.array(*[F.struct(F.least(c, "t").alias("x"), F.greatest(c, "t").alias("y"), F.lit(c).alias("end"))
                         for c in ("a", "b")])
        watch = held.select("i", "p", F.explode(rows).alias("w")).select("i", "p", "w.*")
        if 2 * self.samples <= E.BROADCAST_ROWS:
            watch = F.broadcast(watch)
        hits = (edges.select(F.least("src", "trg").alias("x"), F.greatest("src", "trg").alias("y"), "at").join(watch, ["x", "y"])
                .where(F.col("at") > F.col("p")).groupBy("i")
                .agg(F.max(F.col("end") == "a").alias("new_a"), F.max(F.col("end") == "b").alias("new_b")))

        def hit(c: str) -> Column:
            return (F.col(f"hit_{c}") | F.coalesce(f"new_{c}", F.lit(False))).alias(f"hit_{c}")

        return held.join(hits, "i", "left").select("i", "p", "next", "a", "b", "t", hit("a"), hit("b"),
                                                   F.lit(total).cast("bigint").alias("n_edges"))

    def samples_held(self) -> DataFrame:
        """(i, p, a, b, t): every sampler's present sample."""
        return self.state().where(F.col("p").isNotNull()).select("i", "p", "a", "b", "t")

    def results(self) -> DataFrame:
        """(n_edges, beta_sum, estimate) of the edges so far."""
        per = self.state().agg(F.max("n_edges").alias("n_edges"),
                               F.sum((F.col("hit_a") & F.col("hit_b")).cast("bigint")).alias("beta_sum"))
        return per.select("n_edges", "beta_sum", E.scaled(F.col("beta_sum"), F.col("n_edges"), self.samples, self.vertices))
