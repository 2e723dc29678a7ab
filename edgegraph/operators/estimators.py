"""Sampled triangle-count estimators.

Each of ``s`` instances keeps a size-1 reservoir over the edge stream (the i-th edge replaces the sample
with probability 1/i) plus a uniformly drawn third vertex; beta = 1 when both closing edges of the
sampled wedge arrive after the sample. Estimate = floor((1/s) * sum(beta) * m * (n - 2)).

The reservoir's replacement positions form a chain: p1 = 1 and P(next > j | p) = p / j, i.e.
``p' = floor(p / u) + 1`` for ``u`` uniform in (0, 1]. Only ~ln(m) positions per instance exist. The
recurrence is sequential per instance and data dependent in length, which no column expression states,
so each instance's chain is generated inside ``mapInPandas`` over the ``s``-row instance table (Spark
partitions the instances; the work per instance is ~ln m md5 steps). Randomness comes from md5 of
(seed, instance, position), identical to Spark's ``md5`` and DuckDB's: runs repeat and the broadcast and
incidence forms see the same samples.

* broadcast form: the small sample table is broadcast to the edge scan (the reference broadcasts every
  edge to every sampler instead);
* incidence form: edges are routed by endpoint to the samples whose third vertex they touch (shuffle join).
"""

from __future__ import annotations

import hashlib
import math

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edgegraph.functions import HEX15_RANGE, md5_bigint
from edgegraph.operators.positions import with_position

# Fixed value: default seed text of the estimators.
DEFAULT_SEED = "tri"


def _next_position(i: int, p: int, seed: str) -> int:
    """Where instance ``i`` takes the sample after that of ``p``: floor(p / u) + 1, u from md5 of seed:e:i:p."""
    h = int(hashlib.md5(f"{seed}:e:{i}:{p}".encode()).hexdigest()[:15], 16)
    return math.floor(p / (float(h + 1) / float(HEX15_RANGE))) + 1


def _chain_rows(i: int, m: int, seed: str) -> list[int]:
    """Positions of instance ``i`` up to ``m``, from 1 on."""
    out, p = [], 1
    while p <= m:
        out.append(p)
        p = _next_position(i, p, seed)
    return out


def resume_chain(i: int, p: int, m: int, seed: str) -> tuple[int, int]:
    """From position ``p`` <= ``m`` on: the last position up to ``m`` and the one after it, which fits a bigint."""
    while True:
        later = _next_position(i, p, seed)
        if later > m:
            return p, min(later, 2 ** 63 - 1)
        p = later


def scaled(beta_sum: Column, m: Column, s: int, n: int) -> Column:
    """The estimate from the number of closed wedges of ``s`` samples, ``m`` edges and ``n`` vertices."""
    return F.floor(F.lit(1.0 / s) * beta_sum * m * F.lit(n - 2)).cast("long").alias("estimate")


def sample_chain(spark: SparkSession, m: int, s: int, seed: str = DEFAULT_SEED) -> DataFrame:
    """(i, p): every position p <= m at which instance i takes a new sample."""
    def gen(batches):
        for pdf in batches:
            ii, pp = [], []
            for i in pdf["id"].tolist():
                ps = _chain_rows(int(i), m, seed)
                ii.extend([int(i)] * len(ps))
                pp.extend(ps)
            yield pd.DataFrame({"i": pd.Series(ii, dtype="int64"), "p": pd.Series(pp, dtype="int64")})
    parts = max(1, min(s, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return spark.range(0, s, 1, parts).mapInPandas(gen, "i long, p long")


def _third(i, p, lo, hi, n, seed):
    """Uniform vertex of [0, n) other than lo and hi (rank skip; lo == hi skips one value)."""
    h_two = md5_bigint(F.lit(seed), F.lit("t"), i, p) % (n - 2)
    h_one = md5_bigint(F.lit(seed), F.lit("t"), i, p) % (n - 1)
    two = (F.when(h_two < lo, h_two).when(h_two + 1 < hi, h_two + 1).otherwise(h_two + 2))
    one = F.when(h_one < lo, h_one).otherwise(h_one + 1)
    return F.when(lo == hi, one).otherwise(two)


def vertex_ranks(edges: DataFrame) -> DataFrame:
    """(v, r): every endpoint with its rank 0..n-1 in id order, so sparse and negative ids sample like dense ones."""
    v = edges.select(F.explode(F.array("src", "trg")).alias("v")).distinct()
    return with_position(v, ["v"], "_p").select("v", (F.col("_p") - 1).alias("r"))


def with_third(samples: DataFrame, n: int, seed: str) -> DataFrame:
    """Samples (i, p, a, b, ...) with their third vertex ``t`` of 0..n-1, ``a`` and ``b`` left out."""
    third = _third(F.col("i"), F.col("p"), F.least("a", "b"), F.greatest("a", "b"), F.lit(n), seed)
    return samples.withColumn("t", third)


def samples_at(edges: DataFrame, chain: DataFrame, ranks: DataFrame | None, n: int, limits: list[int], seed: str) -> DataFrame:
    """Per (instance, limit): the sample held after ``limit`` edges: (i, lim, p, a, b, t). Without ``ranks`` the ids are the ranks.

    The tables of samples have ``s`` times the number of limits as rows; Spark picks the joins by their size."""
    lims = F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits])).alias("lim")
    last = (chain.select("i", "p", lims).where(F.col("p") <= F.col("lim"))
            .groupBy("i", "lim").agg(F.max("p").alias("p")))
    pick = edges.select(F.col("pos").alias("p"), F.col("src").alias("a"), F.col("trg").alias("b"))
    s = last.join(pick, "p")
    if ranks is None:
        return with_third(s, n, seed)
    s = (s.join(ranks.select(F.col("v").alias("a"), F.col("r").alias("ra")), "a")
         .join(ranks.select(F.col("v").alias("b"), F.col("r").alias("rb")), "b"))
    third = _third(F.col("i"), F.col("p"), F.least("ra", "rb"), F.greatest("ra", "rb"), F.lit(n), seed)
    return (s.select("i", "lim", "p", "a", "b", third.alias("r"))
            .join(ranks.select("r", F.col("v").alias("t")), "r").drop("r"))


def _closing_pairs(samples: DataFrame) -> DataFrame:
    rows = F.array(F.struct(F.least("a", "t").alias("x"), F.greatest("a", "t").alias("y")),
                   F.struct(F.least("b", "t").alias("x"), F.greatest("b", "t").alias("y")))
    return samples.select("i", "lim", "p", F.array_distinct(rows).alias("need")).select(
        "i", "lim", "p", F.size("need").alias("n_need"), F.explode("need").alias("c")).select(
        "i", "lim", "p", "n_need", "c.x", "c.y")


# Rows of the sample table up to which it is broadcast; beyond it Spark joins it by its size.
BROADCAST_ROWS = 200_000


def _beta_broadcast(edges: DataFrame, samples: DataFrame, samples_are_many: bool = False) -> DataFrame:
    need = _closing_pairs(samples)
    e = edges.select(F.least("src", "trg").alias("x"), F.greatest("src", "trg").alias("y"), "pos")
    hits = (e.join(need if samples_are_many else F.broadcast(need), ["x", "y"])
            .where((F.col("pos") > F.col("p")) & (F.col("pos") <= F.col("lim")))
            .select("i", "lim", "x", "y", "n_need").distinct())
    return (hits.groupBy("i", "lim").agg(F.count(F.lit(1)).alias("k"), F.first("n_need").alias("n_need"))
            .select("i", "lim", (F.col("k") == F.col("n_need")).cast("long").alias("beta")))


def _beta_incidence(edges: DataFrame, samples: DataFrame) -> DataFrame:
    """Each sample watches the pairs (third, endpoint); edges are joined on the whole pair, so a hub is no hot key."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("src").alias("v"), F.col("trg").alias("o")),
                                          F.struct(F.col("trg").alias("v"), F.col("src").alias("o")))).alias("x"),
                        "pos").select("x.v", "x.o", "pos")
    watched = F.array_distinct(F.array("a", "b"))
    smp = samples.select("i", "lim", "p", F.col("t").alias("v"), F.size(watched).alias("n_need"), F.explode(watched).alias("o"))
    hits = (ends.join(smp, ["v", "o"]).where((F.col("pos") > F.col("p")) & (F.col("pos") <= F.col("lim")))
            .select("i", "lim", "o", "n_need").distinct())
    return (hits.groupBy("i", "lim").agg(F.count(F.lit(1)).alias("k"), F.first("n_need").alias("n_need"))
            .select("i", "lim", (F.col("k") == F.col("n_need")).cast("long").alias("beta")))


def estimate(edges: DataFrame, s: int, seed: str = DEFAULT_SEED, method: str = "broadcast",
             prefixes: list[int] | None = None, vertices: int | None = None) -> DataFrame:
    """Triangle estimate after the whole stream, or after each prefix size in ``prefixes``.

    ``edges`` needs a dense arrival position ``pos`` (1..m). Output per limit: (n_edges, beta_sum, estimate).
    The third vertex is drawn among the ``n`` vertices by rank, so ids may be sparse or negative. With ``vertices`` the ids are
    0..vertices-1, known before the first edge, and the third vertex is one of them whether or not it has an edge.
    """
    spark = edges.sparkSession
    m = edges.count()
    ranks = vertex_ranks(edges) if vertices is None else None
    n = ranks.count() if vertices is None else vertices
    if m == 0 or n < 3:  # nothing to sample, or no third vertex
        return spark.createDataFrame([(int(x), 0, 0) for x in prefixes or [m]], "n_edges long, beta_sum long, estimate long")
    lims = prefixes or [m]
    limits = spark.createDataFrame([(int(x),) for x in lims], "lim long")
    chain = sample_chain(spark, m, s, seed)
    smp = samples_at(edges, chain, ranks, n, lims, seed)
    beta = (_beta_broadcast(edges, smp, 2 * s * len(lims) > BROADCAST_ROWS) if method == "broadcast"
            else _beta_incidence(edges, smp))
    per = limits.join(beta.groupBy("lim").agg(F.sum("beta").alias("beta_sum")), "lim", "left")
    bsum = F.coalesce(F.col("beta_sum"), F.lit(0)).cast("long")
    return per.select(F.col("lim").alias("n_edges"), bsum.alias("beta_sum"), scaled(bsum, F.col("lim"), s, n))
