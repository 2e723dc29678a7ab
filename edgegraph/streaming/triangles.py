"""Windowed triangle counts on a stream (H9) with ``foreachBatch``.

Per micro-batch: edges are appended to a staging table partitioned by window start; the event-time
watermark (largest ``ts`` seen minus the allowed delay) decides which windows are closed; each closed
window not yet emitted is counted with the batch operator
(:func:`~edgegraph.operators.triangles.window_triangles`, degree-oriented ``array_intersect``, no neighbour
pairs) over its staged edges only (partition pruning), and appended to the output table. Rows for an
already emitted window are late: they are dropped and counted, as Spark's watermark would. Staged edges
are deduplicated by the operator and results are overwritten per window, so a batch that broke off is repeated without harm.
Progress (watermark, last emitted window, late rows, batch id) is a small text file written after the outputs; a batch that it
covers is not run again, so its rows don't count as late. Staged windows are deleted once progress says they are emitted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgegraph.operators.triangles import window_triangles
from edgegraph.streaming.components import _HadoopFS


def _interval_ms(spark: SparkSession, size: str) -> int:
    return int(spark.sql(f"SELECT CAST(unix_millis(TIMESTAMP'1970-01-01 00:00:00' + INTERVAL {size}) AS BIGINT)").first()[0])


class WindowTriangles:
    def __init__(self, spark: SparkSession, state_dir: str, size: str, delay: str = "0 seconds"):
        self.spark = spark
        self.root = state_dir.rstrip("/")
        self.size = size
        self.size_ms = _interval_ms(spark, size)
        self.delay_ms = _interval_ms(spark, delay)
        self._fs = _HadoopFS(spark, self.root)
        saved = self._fs.read_text("_PROGRESS")
        self.watermark, self.emitted_until, self.late_rows, self.batch_id = (
            tuple(int(x) for x in saved.split(",")) if saved else (-2 ** 62, -2 ** 62, 0, -1))

    @property
    def staging(self) -> str:
        return f"{self.root}/staging"

    @property
    def output(self) -> str:
        return f"{self.root}/output"

    def update(self, batch: DataFrame, batch_id: int | None = None) -> None:
        if batch_id is not None and batch_id <= self.batch_id:
            return  # done before, up to the stream's own commit
        e = batch.select("src", "trg", "ts").withColumn(
            "w_start", F.unix_millis("ts") - F.pmod(F.unix_millis("ts"), F.lit(self.size_ms)))
        stats = e.agg(F.max(F.unix_millis("ts")).alias("mx"),
                      F.sum(F.when(F.col("w_start") < self.emitted_until, 1).otherwise(0)).alias("late")).first()
        if stats["mx"] is None:
            return
        on_time = e.where(F.col("w_start") >= self.emitted_until)
        on_time.write.mode("append").partitionBy("w_start").parquet(self.staging)
        watermark = max(self.watermark, int(stats["mx"]) - self.delay_ms)
        # windows [w, w + size) with w + size <= watermark are closed: all starts below closed_until
        closed_until = (watermark // self.size_ms) * self.size_ms
        if closed_until > self.emitted_until:
            staged = (self.spark.read.parquet(self.staging)
                      .where((F.col("w_start") >= self.emitted_until) & (F.col("w_start") < closed_until)))
            result = window_triangles(staged.select("src", "trg", "ts"), self.size)
            # one partition per window, overwritten dynamically: a replayed batch rewrites, never duplicates
            (result.withColumn("w", F.col("w_max_ts")).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("w").parquet(self.output))
            self.emitted_until = closed_until
        self.watermark = watermark
        self.late_rows += int(stats["late"] or 0)
        self.batch_id = self.batch_id if batch_id is None else batch_id
        self._fs.write_text("_PROGRESS", f"{self.watermark},{self.emitted_until},{self.late_rows},{self.batch_id}")
        staged_fs = _HadoopFS(self.spark, self.staging)
        for name in staged_fs.names("w_start="):
            if int(name.split("=", 1)[1]) < self.emitted_until:
                staged_fs.delete(name)

    def results(self) -> DataFrame:
        return self.spark.read.parquet(self.output).drop("w")

    def start(self, edges: DataFrame, checkpoint: str, available_now: bool = True):
        w = edges.writeStream.foreachBatch(lambda df, bid: self.update(df, bid)).option("checkpointLocation", checkpoint)
        w = w.trigger(availableNow=True) if available_now else w
        return w.start()
