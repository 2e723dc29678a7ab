"""Edge views derived from the given tables (canonical columns ``src trg amount ts chg pos``).

``ts`` stays a Spark TIMESTAMP (UTC) so that windows, watermarks and streaming work on it;
outputs that are compared with SQL render it as epoch milliseconds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgegraph.functions import ntz_to_instant
from edgegraph.operators.positions import with_position
from edgegraph.sources.tables import load_table

# Fixed value: payee ids are offset so that payers and payees never share an id.
TXN_TARGET_OFFSET = 1000000
# Fixed values of the signed view: targets 1000 + event_id % 40, 'error' events delete.
SIGNED_TARGET_BASE = 1000
SIGNED_TARGET_MOD = 40


def txn_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments: customer pays supplier, amount in cents, ts = ship date. Bipartite by construction."""
    li = load_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    od = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (li.join(od, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("o_custkey").alias("src"),
                    (F.lit(TXN_TARGET_OFFSET) + F.col("l_suppkey")).alias("trg"),
                    F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("amount"),
                    ntz_to_instant("l_shipdate").alias("ts")))


def user_edges(spark: SparkSession, sf_dir: str, pos: bool = True) -> DataFrame:
    """Transitions between consecutive events (by ts, event_id) of different users, with positions unless
    ``pos`` is false (operators that do not need the arrival order then save a range shuffle and a table).

    The "next event" is found by a distributed position and an equi-join on ``pos + 1`` instead of a
    global ``lead`` window (which would run in one task).
    """
    ev = load_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    ev = with_position(ev, ["ts", "event_id"], name="_p")
    nxt = ev.select((F.col("_p") - 1).alias("_p"), F.col("user_id").alias("trg"))
    pairs = (ev.join(nxt, "_p")
             .where(F.col("trg") != F.col("user_id"))
             .select(F.col("user_id").alias("src"), "trg",
                     F.round(F.col("value") * 100).cast("bigint").alias("amount"),
                     ntz_to_instant("ts").alias("ts"),
                     F.col("event_id").alias("seq")))
    return with_position(pairs, ["seq"], name="pos").drop("seq") if pos else pairs.drop("seq")


def signed_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edge additions (+1) and deletions (-1) in event order."""
    ev = load_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return ev.select(
        F.col("user_id").alias("src"),
        (F.lit(SIGNED_TARGET_BASE) + F.col("event_id") % SIGNED_TARGET_MOD).alias("trg"),
        F.when(F.col("event_type") == "error", F.lit(-1)).otherwise(F.lit(1)).alias("chg"),
        F.col("event_id").alias("pos"))


def cust_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path-shaped components: each customer linked to the next one of its (nation, segment).

    ``lead`` per group is a global position in (nation, segment, key) order plus an equi-join on
    ``pos + 1`` within the same group: each group holds 1/125 of all customers, too many for one task
    at scale, and the position is computed without a single-partition window.
    """
    c = load_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    keys = ["c_nationkey", "c_mktsegment"]
    ranked = with_position(c, keys + ["c_custkey"], name="_r")
    nxt = ranked.select(*keys, (F.col("_r") - 1).alias("_r"), F.col("c_custkey").alias("trg"))
    return ranked.join(nxt, keys + ["_r"]).select(F.col("c_custkey").alias("src"), "trg")


def edge_lines(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    """Text lines (column ``value``) in one of the reference's input formats, built from the views."""
    if fmt == "pair":
        e = user_edges(spark, sf_dir, pos=False)
        return e.select(F.concat_ws(" ", "src", "trg").alias("value"))
    if fmt == "pair_tab":
        e = user_edges(spark, sf_dir, pos=False)
        return e.select(F.concat_ws("\t", "src", "trg").alias("value"))
    if fmt == "txn":
        e = txn_edges(spark, sf_dir)
        return e.select(F.concat_ws(" ", "src", "trg", "amount",
                                    F.unix_millis("ts").cast("string")).alias("value"))
    if fmt == "signed":
        e = signed_edges(spark, sf_dir)
        return e.select(F.concat_ws(" ", "src", "trg",
                                    F.when(F.col("chg") > 0, F.lit("+")).otherwise(F.lit("-"))).alias("value"))
    if fmt == "commented":
        # error events become comment lines whose first field is '%'
        ev = load_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
        return ev.select(F.when(F.col("event_type") == "error",
                                F.concat_ws(" ", F.lit("%"), F.col("user_id"), F.col("event_id")))
                         .otherwise(F.concat_ws(" ", F.col("user_id"), F.lit(SIGNED_TARGET_BASE)
                                                + F.col("event_id") % SIGNED_TARGET_MOD)).alias("value"))
    if fmt == "rating":
        li = load_table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity")
        return li.select(F.concat_ws("\t", "l_suppkey", "l_partkey",
                                     F.col("l_quantity").cast("bigint").cast("string")).alias("value"))
    raise ValueError(f"unknown line format {fmt!r}")
