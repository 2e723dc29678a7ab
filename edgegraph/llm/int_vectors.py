"""Vectors as exact integers: floor(scale * x), distances without rounding, tables of packed rows between rounds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgegraph.llm.tables import shared_folder


def limit(dims: int) -> int:
    """Components saturate at plus or minus this power of two, so that a squared distance of ``dims`` of them fits into 64 bits;
    2**27 for up to 128 components."""
    return 1 << min(27, (62 - max(dims - 1, 1).bit_length()) // 2 - 1)


def usable(vectors: DataFrame, dims: int | None = None) -> DataFrame:
    """The rows whose vector is not null, holds neither null nor non-finite components and, where given, has ``dims`` of them."""
    x = F.col("embedding")
    fine = x.isNotNull() & F.forall(x, lambda v: F.coalesce(F.abs(v.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return vectors.where(fine if dims is None else (F.size(x) == dims) & fine)


def as_ints(column, scale: int, dims: int) -> np.ndarray:
    """floor(scale * component) of an Arrow list column without nulls, saturated at :func:`limit`."""
    top = limit(dims)
    x = np.asarray(column.flatten()).astype(np.float64).reshape(-1, dims)
    return np.clip(np.floor(np.clip(x, -2.0 * top, 2.0 * top) * scale), -top, top).astype(np.int64)


def pack(x: np.ndarray) -> list[bytes]:
    """One binary per row, of 16-bit components where they fit, else of 32-bit ones."""
    small = (np.abs(x) < 1 << 15).all(1)
    narrow, wide = x.astype(np.int16), None if small.all() else x.astype(np.int32)
    return [(narrow[i] if s else wide[i]).tobytes() for i, s in enumerate(small.tolist())]


def unpack(column, dims: int) -> np.ndarray:
    rows = column.to_pylist()
    if all(len(r) == 2 * dims for r in rows):
        return np.frombuffer(b"".join(rows), np.int16).reshape(-1, dims).astype(np.int64)
    return np.stack([np.frombuffer(r, np.int16 if len(r) == 2 * dims else np.int32) for r in rows]).astype(np.int64)


def square_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row of ``x`` to every row of ``c``."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    if 4 * x.shape[1] * top * top < 1 << 52:  # all sums are integers that a double holds exactly
        xf, cf = x.astype(np.float64), c.astype(np.float64)
        return ((xf * xf).sum(1)[:, None] - 2 * (xf @ cf.T) + (cf * cf).sum(1)).astype(np.int64)
    return np.stack([((x - row) ** 2).sum(1) for row in c], 1)


def pair_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of aligned rows."""
    return ((x - c) ** 2).sum(-1)


def up(x: np.ndarray) -> np.ndarray:
    """A safe upper bound of a computed real."""
    return x * (1 + 1e-9) + 1e-9


def down(x: np.ndarray) -> np.ndarray:
    """A safe lower bound of a computed real."""
    return x * (1 - 1e-9) - 1e-9


def half_down(x: np.ndarray) -> np.ndarray:
    """Lower bounds as half-precision floats, never rounded up; large ones saturate, as a smaller bound stays valid."""
    x = np.where(np.isinf(x), x, np.clip(x, -65000.0, 65000.0))
    h = x.astype(np.float16)
    return np.where(h.astype(np.float64) > x, np.nextafter(h, np.float16(-np.inf)), h)


class Sums:
    """Exact sums and counts of rows by group over a whole partition."""

    def __init__(self, groups: int, dims: int):
        self.sum, self.count = np.zeros((groups, dims), np.int64), np.zeros(groups, np.int64)

    def add(self, group: np.ndarray, x: np.ndarray) -> None:
        n = len(self.count)
        self.count += np.bincount(group, minlength=n)
        if len(x) * int(np.abs(x).max(initial=0)) < 1 << 52:
            for j in range(x.shape[1]):
                self.sum[:, j] += np.bincount(group, x[:, j], n).astype(np.int64)
        else:
            np.add.at(self.sum, group, x)


def sum_schema(key: str, dims: int) -> str:
    return f"{key} int, n bigint, " + ", ".join(f"s{j} bigint" for j in range(dims))


def sum_batch(key: str, sums: Sums):
    """A record batch of the groups that occur."""
    import pyarrow as pa
    used = np.flatnonzero(sums.count)
    return pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), pa.array(sums.count[used]), *(pa.array(c) for c in sums.sum[used].T.copy())],
        names=[key, "n", *(f"s{j}" for j in range(sums.sum.shape[1]))])


def means(partial: DataFrame, key: str, old: np.ndarray) -> np.ndarray:
    """``old`` with every row that has members replaced by their componentwise floor(sum / count). The sums are added
    on the cluster; the driver gets one row per entry, a number fixed by the parameters."""
    dims = old.shape[1]
    total = partial.groupBy(key).agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"),
                                     *[F.sum(F.col(f"s{j}").cast("decimal(38,0)")).alias(f"s{j}") for j in range(dims)])
    new = old.copy()
    for r in total.collect():
        new[r[key]] = [int(r[f"s{j}"]) // int(r["n"]) for j in range(dims)]
    return new


def rewrite(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written as a table of the shared folder and reread, with its place."""
    spark = df.sparkSession
    uri = shared_folder(spark, name)
    df.write.parquet(uri)
    return spark.read.schema(df.schema).parquet(uri), uri


def remove(spark: SparkSession, uri: str) -> None:
    """Delete a table of the shared folder that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def exact_sum(c) -> "F.Column":
    """Sum of bigints as bigint; null where it doesn't fit."""
    return F.expr(f"try_cast(sum(cast({c} as decimal(38,0))) as bigint)")


def kept_columns(df: DataFrame, keep: list[str]) -> tuple[list, str]:
    """The carried columns under names that clash with nothing, and their schema text."""
    return ([F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)],
            "".join(f"_k{i} {df.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep)))
