"""Small shared helpers: checkpoints, size-checked joins, named-value arrays and shared-folder files."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edgegraph.session import ensure_checkpoint_dir

# Words: maximal runs of characters other than space and U+0009..U+000D.
WORD = r"[^\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ckpt(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (``spark.checkpoint.dir``)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder URI under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, UPPER.lower())


def sized_join(left: DataFrame, small: DataFrame, keys: list[str], how: str = "left",
               max_broadcast_rows: int = 200_000, salts: int = 32) -> DataFrame:
    """Equi-join of a large frame with a per-key table, null-safe on the keys.

    Up to ``max_broadcast_rows`` rows (checked by counting them) the table is broadcast, so the large side
    is not shuffled. Beyond it both sides are shuffled on (keys, salt): the large side's salt spreads a hot
    key over ``salts`` tasks, the table is repeated once per salt.
    """
    renamed = small.select(*[F.col(k).alias(f"_sj_{k}") for k in keys], *[c for c in small.columns if c not in keys])
    cond = [left[k].eqNullSafe(F.col(f"_sj_{k}")) for k in keys]
    if small.limit(max_broadcast_rows + 1).count() <= max_broadcast_rows:
        out = left.join(F.broadcast(renamed), cond, how)
    else:
        salted = left.withColumn("_sj_salt", F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(salts)))
        copies = renamed.withColumn("_sj_salt2", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
        out = salted.join(copies, [salted[k].eqNullSafe(copies[f"_sj_{k}"]) for k in keys]
                          + [F.col("_sj_salt") == F.col("_sj_salt2")], how).drop("_sj_salt", "_sj_salt2")
    return out.drop(*[f"_sj_{k}" for k in keys])


# ---- files in the shared folder, written and memory-mapped by tasks -------------------------------------

def _fs(uri: str):
    import pyarrow.fs as pafs
    if uri.startswith("/"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def make_folder(uri: str) -> None:
    fs, path = _fs(uri)
    fs.create_dir(path, recursive=True)


def write_arrays(uri: str, **arrays) -> None:
    """Write numpy arrays as one file, atomically: a retried or speculative task replaces it by the same bytes."""
    import numpy as np
    fs, path = _fs(uri)
    head, at = {}, 0
    for k, a in arrays.items():
        head[k] = (str(a.dtype), int(a.size), at)
        at += (a.nbytes + 7) // 8 * 8
    text = json.dumps(head).encode()
    text += b" " * (-(len(text) + 8) % 8)
    tmp = f"{path}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(tmp) as f:
        f.write(len(text).to_bytes(8, "little") + text)
        for a in arrays.values():
            f.write(np.ascontiguousarray(a).tobytes())
            f.write(b"\0" * (-a.nbytes % 8))
    fs.move(tmp, path)


def map_arrays(uri: str) -> dict:
    """Memory-map the arrays of :func:`write_arrays`. A folder that is mounted is mapped in place; from any other
    store the file is copied into an unlinked scratch file first, which is gone when the mapping closes."""
    import mmap
    import tempfile

    import numpy as np
    import pyarrow.fs as pafs
    fs, path = _fs(uri)
    if isinstance(fs, pafs.LocalFileSystem):
        with open(path, "rb") as f:
            m = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
    else:
        with tempfile.TemporaryFile() as f, fs.open_input_stream(path) as src:
            while block := src.read(1 << 22):
                f.write(block)
            f.flush()
            m = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
    n = int.from_bytes(m[:8], "little")
    head = json.loads(m[8:8 + n])
    return {k: np.frombuffer(m, dtype=t, count=size, offset=8 + n + at) for k, (t, size, at) in head.items()}
