"""Streaming sources, event time, and the windowed / running operators as streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from edgegraph.operators import degrees as D
from edgegraph.operators import patterns as P
from edgegraph.operators.transforms import endpoints
from edgegraph.sources.text import decode

EDGE_SCHEMA = "src bigint, trg bigint, amount bigint, ts timestamp, pos bigint"


def edge_stream_from_text(spark: SparkSession, path: str, fmt: str, max_files_per_trigger: int | None = None,
                          mode: str = "FAILFAST") -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return decode(reader.load(path), fmt, mode)


def edge_stream_from_kafka(spark: SparkSession, servers: str, topic: str, fmt: str = "txn",
                           mode: str = "FAILFAST", **options: str) -> DataFrame:
    """Message-bus edge stream: each record value is one text line of ``fmt`` (``src trg amount ts`` for
    transactions). Needs the Spark Kafka connector on the cluster's classpath."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic))
    for k, v in options.items():
        reader = reader.option(k, v)
    try:
        raw = reader.load()
    except Exception as exc:  # noqa: BLE001
        if "kafka" in str(exc).lower():
            raise RuntimeError("the Kafka source is not on the classpath (spark-sql-kafka package)") from exc
        raise
    return decode(raw.selectExpr("CAST(value AS STRING) AS value"), fmt, mode)


def edge_stream_from_parquet(spark: SparkSession, path: str, schema: str = EDGE_SCHEMA,
                             max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def with_event_time(edges: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """Event time on ``ts`` with bounded lateness ``delay`` (rows older than the watermark are dropped)."""
    return edges.withWatermark("ts", delay)


def fraud_alert_stream(edges: DataFrame, rule: P.MoneyMovement = P.MoneyMovement(),
                       delay: str = "0 seconds") -> DataFrame:
    """Money-movement alerts as an append-mode streaming frame (same plan as batch)."""
    return P.money_movement_alerts(with_event_time(edges, delay), rule)


def degree_stream(edges: DataFrame, direction: str = "all") -> DataFrame:
    """Running degrees: run with output mode ``update`` (one row per changed vertex per micro-batch)."""
    return D.degrees(edges, direction)


def vertex_count_stream(edges: DataFrame) -> DataFrame:
    """Running distinct-vertex count (``complete``/``update`` mode). Streaming ``count_distinct`` is not
    supported by Spark, so vertices are deduplicated by state first."""
    return endpoints(edges).dropDuplicates(["v"]).groupBy().agg(F.count(F.lit(1)).cast("bigint").alias("n_vertices"))


def run_periodic(df: DataFrame, interval: str, mode: str, checkpoint: str, sink: str = "console",
                 queryName: str | None = None, **options: str) -> StreamingQuery:  # noqa: N803
    """Buffer-and-flush: rows arriving during ``interval`` are processed together as one micro-batch
    (the reference's 5 s flush timer is a processing-time trigger)."""
    w = (df.writeStream.outputMode(mode).format(sink).option("checkpointLocation", checkpoint)
         .trigger(processingTime=interval))
    if queryName:
        w = w.queryName(queryName)
    for k, v in options.items():
        w = w.option(k, v)
    return w.start()


def run_available(df: DataFrame, name: str, mode: str, checkpoint: str) -> StreamingQuery:
    """Run a streaming frame over everything available now into an in-memory table ``name``."""
    q = (df.writeStream.outputMode(mode).format("memory").queryName(name)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q
