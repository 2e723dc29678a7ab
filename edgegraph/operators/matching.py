"""Weighted matching (H13) as iterated joins: locally dominant edges.

The reference accepts each arriving edge iff its weight exceeds twice the weight of the matched edges it
collides with, in strict arrival order with parallelism 1. That sequential rule is not run here (it would
put the whole graph, or its giant component, in one task). Instead, every round each vertex points to its
first live edge in a fixed priority; edges chosen from both ends are matched, edges touching a matched
vertex die; this repeats until no live edge remains, however many rounds that takes. The result is the
greedy matching in priority order and vertex-disjoint by construction.

Two priorities:

* :func:`locally_dominant_matching`: heavier first, then smaller endpoints. A 1/2-approximation of the maximum
  weight matching. Weights that rise along a path need a number of rounds linear in its length.
* :func:`weight_class_matching`: power-of-two weight classes, a hash within a class. A 1/4-approximation (a rejected edge is
  blocked by one of at least half its weight); random priorities need O(log n) rounds per class with high probability.

:func:`preempt` is the form for a stream: new edges are merged into a matching, and an edge whose weight exceeds twice the matched
weight that it collides with evicts it. Edges that qualify compete in rounds (weight class, then hash); winners share no vertex, so
a round gives what the sequential rule gives when the edges that don't qualify arrive first and the winners in any order after
them. Every accepted edge passes the sequential rule against what is matched at its time, so its factor of 1/6 holds.

Weights keep their type (integers, decimals, doubles). Every round is one aggregate (combined map-side) and semi/anti joins. The live edges are checkpointed, and the
matched edges of all rounds are appended to one table, so the plan does not grow with the rounds.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgegraph.functions import md5_bigint
from edgegraph.session import ensure_checkpoint_dir


def _rounds(edges: DataFrame, weight: str, priority: Column) -> tuple[DataFrame, int]:
    """(matched edges, number of rounds); ``priority`` orders edges (a, b, w), largest first, without ties."""
    spark = edges.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/matching-{uuid.uuid4().hex}"
    live = (edges.select(F.least("src", "trg").alias("a"), F.greatest("src", "trg").alias("b"),
                         F.col(weight).alias("w"))
            .where(F.col("a") != F.col("b"))
            .groupBy("a", "b").agg(F.max("w").alias("w"))).checkpoint(eager=True)
    live.limit(0).write.parquet(f"{folder}/round=0")
    n = 0
    while live.limit(1).count():
        n += 1
        picked = _mutual(live, priority)
        live.join(picked.select("a", "b"), ["a", "b"], "left_semi").write.mode("overwrite").parquet(f"{folder}/round={n}")
        used = spark.read.parquet(f"{folder}/round={n}").select(F.explode(F.array("a", "b")).alias("v"))
        live = (live.join(used.withColumnRenamed("v", "a"), "a", "left_anti")
                .join(used.withColumnRenamed("v", "b"), "b", "left_anti")
                .select("a", "b", "w")).checkpoint(eager=True)
    matched = spark.read.parquet(folder)
    return matched.select(F.col("a").alias("src"), F.col("b").alias("trg"), F.col("w").alias("weight")), n


def _mutual(live: DataFrame, priority: Column) -> DataFrame:
    """The edges (a, b) that are first at both ends. ``priority`` ends in (na, nb), the ends' negatives, so the sorted and
    shuffled rows hold a vertex and one priority, and the edge is read from that."""
    ends = live.select("a", "b", priority.alias("p")).select(F.explode(F.array("a", "b")).alias("v"), "p")
    best = ends.groupBy("v").agg(F.max("p").alias("p")).select((-F.col("p.na")).alias("a"), (-F.col("p.nb")).alias("b"))
    return best.groupBy("a", "b").agg(F.count(F.lit(1)).alias("k")).where("k = 2")


def _heaviest() -> Column:
    return F.struct(F.col("w"), (-F.col("a")).alias("na"), (-F.col("b")).alias("nb"))


def power_class(w: Column, whole: bool) -> Column:
    """Number of the power-of-two class of a weight, smallest for weights of 0 and less; exact for fractions as well (the
    logarithm's last digit is corrected by comparing with the powers themselves)."""
    if whole:
        return F.when(w > 0, F.length(F.bin(w))).otherwise(0)
    x = w.cast("double")
    c = F.floor(F.log2(x))
    c = c + F.when(x >= F.pow(F.lit(2.0), c + 1), 1).otherwise(0) - F.when(x < F.pow(F.lit(2.0), c), 1).otherwise(0)
    return F.when(x > 0, c).otherwise(F.lit(-2000))


def _classes(whole: bool = True) -> Column:
    return F.struct(power_class(F.col("w"), whole).alias("c"), md5_bigint(F.lit("match"), F.col("a"), F.col("b")).alias("h"),
                    (-F.col("a")).alias("na"), (-F.col("b")).alias("nb"))


def locally_dominant_matching(edges: DataFrame, weight: str = "amount") -> DataFrame:
    """(src, trg, weight) of the greedy matching by weight; parallel edges keep their largest weight, self-loops drop."""
    return _rounds(edges, weight, _heaviest())[0]


def weight_class_matching(edges: DataFrame, weight: str = "amount") -> DataFrame:
    """(src, trg, weight) of the greedy matching by power-of-two weight class and hash."""
    whole = edges.schema[weight].dataType.typeName() in ("byte", "short", "integer", "long")
    return _rounds(edges.withColumn(weight, F.col(weight).cast("bigint")) if whole else edges, weight, _classes(whole))[0]


def matching_weight(matching: DataFrame) -> DataFrame:
    return matching.agg(F.count(F.lit(1)).cast("bigint").alias("n_matched"),
                        F.coalesce(F.sum("weight"), F.lit(0)).alias("total_weight"))


def preempt(matched: DataFrame, edges: DataFrame, weight: str = "amount") -> tuple[DataFrame, DataFrame]:
    """``(matching, events)`` after the edges (src, trg, ``weight``) were offered to the matching (src, trg, weight): events (round,
    op, src, trg, weight) with op ADD or REMOVE rebuild the new matching from the old one, round by round. Parallel edges
    count by their largest weight, self-loops and null ends drop; an offered edge that is matched already changes nothing."""
    spark = edges.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/preempt-{uuid.uuid4().hex}"
    kind = edges.schema[weight].dataType
    whole = kind.typeName() in ("byte", "short", "integer", "long")
    now = matched.select(F.col("src").alias("a"), F.col("trg").alias("b"), F.col("weight").cast(kind).alias("w")).checkpoint(eager=True)
    live = (edges.select(F.least("src", "trg").alias("a"), F.greatest("src", "trg").alias("b"), F.col(weight).alias("w"))
            .where(F.col("src").isNotNull() & F.col("trg").isNotNull() & F.col(weight).isNotNull() & (F.col("a") != F.col("b")))
            .groupBy("a", "b").agg(F.max("w").alias("w")).join(now.select("a", "b"), ["a", "b"], "left_anti")).checkpoint(eager=True)
    rounds = []
    while True:
        ends = now.select(F.explode(F.array("a", "b")).alias("v"), F.struct("a", "b", "w").alias("m"))
        at = [ends.select(F.col("v").alias(x), F.col("m").alias(f"m{x}")) for x in "ab"]
        near = live.join(at[0], "a", "left").join(at[1], "b", "left")
        zero = F.lit(0).cast(kind)
        collided = F.coalesce("ma.w", zero) + F.when(F.col("ma").eqNullSafe(F.col("mb")), zero).otherwise(F.coalesce("mb.w", zero))
        fit = near.where(F.col("w") > collided * 2).checkpoint(eager=True)
        if not fit.limit(1).count():
            break
        priority = F.struct(power_class(F.col("w"), whole).alias("c"), md5_bigint(F.lit("preempt"), F.col("a"), F.col("b")).alias("h"),
                            (-F.col("a")).alias("na"), (-F.col("b")).alias("nb"))
        picked = _mutual(fit, priority)
        won = fit.join(picked.select("a", "b"), ["a", "b"], "left_semi")
        out = won.select(F.explode(F.array("ma", "mb")).alias("m")).where("m IS NOT NULL").select("m.*").distinct()
        n = len(rounds) + 1
        log = out.withColumn("op", F.lit("REMOVE")).unionByName(won.select("a", "b", "w").withColumn("op", F.lit("ADD")))
        log.withColumn("round", F.lit(n)).select("round", "op", "a", "b", "w").write.mode("overwrite").parquet(f"{folder}/{n}")
        log = spark.read.parquet(f"{folder}/{n}")
        rounds.append(f"{folder}/{n}")
        gone, new = log.where("op = 'REMOVE'").select("a", "b"), log.where("op = 'ADD'").select("a", "b", "w")
        now = now.join(gone, ["a", "b"], "left_anti").unionByName(new).checkpoint(eager=True)
        live = fit.select("a", "b", "w").join(new.select("a", "b"), ["a", "b"], "left_anti").checkpoint(eager=True)
    named = [F.col("a").alias("src"), F.col("b").alias("trg"), F.col("w").alias("weight")]
    if rounds:
        events = spark.read.parquet(*rounds).select("round", "op", *named)
    else:
        events = now.where(F.lit(False)).select(F.lit(0).alias("round"), F.lit("").alias("op"), *named)
    return now.select(*named), events
