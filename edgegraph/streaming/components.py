"""Connected components of an unbounded edge stream (H4e) with ``foreachBatch``.

State is a label table ``(v, component)`` kept as versioned parquet under a shared folder. Per micro-batch:

1. replace each batch endpoint by its current label (left join with the state; unseen vertices are their
   own label); an edge inside one component becomes a loop, which the solver drops;
2. solve the small label graph with :func:`~edgegraph.operators.components.connected_components`
   (label -> new label, the new label being the minimum, hence the component's minimum vertex);
3. relabel: old vertices whose label moved get the new label, new vertices get theirs; write the next version.

A version counts once its ``_SUCCESS`` file is there and the newest such version is the state: there is no pointer that
could be lost, and nothing is deleted before its successor is complete. A batch that is replayed after a crash merges the
same edges again, which changes nothing.

The merge is a join plus an aggregate per batch: no object holds the summary, no task holds a component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgegraph.operators.components import connected_components


class _HadoopFS:
    """Tiny file helpers through the cluster's Hadoop FileSystem (HDFS, S3, local ...)."""

    def __init__(self, spark: SparkSession, root: str):
        jvm = spark.sparkContext._jvm
        self._jvm = jvm
        self._root = jvm.org.apache.hadoop.fs.Path(root)
        self._fs = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _p(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._root, name)

    def names(self, prefix: str) -> list[str]:
        """Names below the root that start with ``prefix``, ascending."""
        if not self._fs.exists(self._root):
            return []
        found = [str(f.getPath().getName()) for f in self._fs.listStatus(self._root)]
        return sorted(n for n in found if n.startswith(prefix))

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._p(name))

    def delete(self, name: str) -> None:
        self._fs.delete(self._p(name), True)

    def _read(self, name: str) -> str:
        stream = self._fs.open(self._p(name))
        try:
            return self._jvm.java.io.BufferedReader(self._jvm.java.io.InputStreamReader(stream)).readLine()
        finally:
            stream.close()

    def read_text(self, name: str) -> str | None:
        """The newest text saved under ``name``."""
        versions = [n for n in self.names(f"{name}-") if not n.endswith(".tmp")]
        return self._read(versions[-1]) if versions else None

    def write_text(self, name: str, text: str) -> None:
        """Save a new version: renamed into place under a name that is not in use, older ones deleted only then."""
        old = [n for n in self.names(f"{name}-") if not n.endswith(".tmp")]
        new = f"{name}-{int(old[-1].rsplit('-', 1)[1]) + 1 if old else 0:012d}"
        out = self._fs.create(self._p(f"{new}.tmp"), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if not self._fs.rename(self._p(f"{new}.tmp"), self._p(new)):
            raise OSError(f"cannot rename {new}.tmp")
        for n in old:
            self.delete(n)


class IncrementalComponents:
    def __init__(self, spark: SparkSession, state_dir: str):
        self.spark = spark
        self.state_dir = state_dir.rstrip("/")
        self._fs = _HadoopFS(spark, self.state_dir)

    @property
    def version(self) -> int:
        """The newest version that was written to its end (Spark commits ``_SUCCESS`` last); -1 if there is none."""
        done = [n for n in self._fs.names("v") if self._fs.exists(f"{n}/_SUCCESS")]
        return int(done[-1][1:]) if done else -1

    def _path(self, version: int) -> str:
        return f"{self.state_dir}/v{version:08d}"

    def labels(self) -> DataFrame:
        version = self.version
        if version < 0:
            return self.spark.createDataFrame([], "v bigint, component bigint")
        return self.spark.read.parquet(self._path(version))

    def update(self, batch: DataFrame, batch_id: int | None = None) -> None:
        state = self.labels()
        edges = batch.select("src", "trg").where(F.col("src").isNotNull() & F.col("trg").isNotNull())
        ls = state.select(F.col("v").alias("src"), F.col("component").alias("ls"))
        lt = state.select(F.col("v").alias("trg"), F.col("component").alias("lt"))
        lab = (edges.join(ls, "src", "left").join(lt, "trg", "left")
               .select(F.coalesce("ls", "src").alias("src"), F.coalesce("lt", "trg").alias("trg")))
        new_vertices = (edges.select(F.explode(F.array("src", "trg")).alias("v")).distinct()
                        .join(state.select("v"), "v", "left_anti"))
        merged = connected_components(lab)  # (v = old label or new vertex, component)
        moved = merged.where(F.col("v") != F.col("component")).select(F.col("v").alias("old"), F.col("component").alias("c"))
        relabeled = (state.join(moved, state.component == moved.old, "left")
                     .select("v", F.coalesce("c", "component").alias("component")))
        fresh = (new_vertices.join(merged, "v", "left")
                 .select("v", F.coalesce("component", "v").alias("component")))
        nxt = relabeled.unionByName(fresh)
        version = self.version + 1
        nxt.write.mode("overwrite").parquet(self._path(version))  # over the rest of an attempt that failed, if any
        for old in self._fs.names("v"):
            if int(old[1:]) < version - 1:  # readers of the previous version may still be at work
                self._fs.delete(old)

    def start(self, edges: DataFrame, checkpoint: str, available_now: bool = True):
        w = edges.writeStream.foreachBatch(lambda df, bid: self.update(df, bid)).option("checkpointLocation", checkpoint)
        w = w.trigger(availableNow=True) if available_now else w
        return w.start()
