"""Centroid clustering of integer vectors with Ns-bounds.

Method: every vector keeps an upper bound of the distance to its own centroid and a lower bound for each centroid, each with the
round in which it was last evaluated. All earlier centroids are kept (rounds x clusters rows, fixed by the parameters).
In a round a bound is loosened by the norm of the centroid's total displacement since that evaluation, which is never more than
the sum of its drifts round by round. Where every lower bound lies beyond the upper one nothing is measured. Otherwise the own
distance is measured in integers, and then exactly the centroids whose bound still fails. A bound only ever proves that a
centroid is farther, so assignments equal those of a full search, ties to the smaller number included.

Rows between rounds are tables in the shared folder (packed integers and bounds); a table is removed when the next one is complete.

Defined results: rows whose vector is null, has another number of components than ``dims``, or holds null or non-finite ones are
left out; components saturate at 2**27 in size (less beyond 128 components); the first centroids are the rows first by (hash of vec_id
with null ids last, vector), repeated rows included; with fewer rows than clusters there are as many clusters as rows; a
sum of distances that doesn't fit a bigint is null; an empty table gives an empty one. Other columns are carried where ``keep`` names them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgegraph.llm import int_vectors as iv

DIMS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 16, 3, 64, 1


def displacements(history: np.ndarray) -> np.ndarray:
    """[t, j]: upper bound of the way of centroid j from round t to the last round."""
    return iv.up(np.sqrt(((history - history[-1]) ** 2).sum(2).astype(np.float64)))


def evaluate_all(x: np.ndarray, centroids: np.ndarray, t: int) -> tuple[np.ndarray, ...]:
    """``(own, upper, its round, lower, their rounds)`` by measuring every centroid."""
    d = iv.square_distances(x, centroids)
    own = d.argmin(1)
    root = np.sqrt(d.astype(np.float64))
    return (own, iv.up(root[np.arange(len(x)), own]), np.full(len(x), t), iv.down(root), np.full(d.shape, t))


def evaluate_failures(x: np.ndarray, history: np.ndarray, own, upper, upper_at, lower, lower_at) -> tuple[np.ndarray, ...]:
    """As :func:`evaluate_all` at the last round of ``history``, from earlier bounds; and the number of distances measured."""
    t = len(history) - 1
    centroids, way = history[-1], displacements(history)
    ids = np.arange(len(centroids))
    own, upper, upper_at, lower, lower_at = (a.copy() for a in (own, upper, upper_at, lower, lower_at))
    high = upper + way[upper_at, own]
    low = lower - way[lower_at, ids]
    low[np.arange(len(x)), own] = np.inf
    rows = np.flatnonzero(low.min(1, initial=np.inf) <= high)
    if not len(rows):
        return own, upper, upper_at, lower, lower_at, 0
    d = iv.pair_distances(x[rows], centroids[own[rows]])
    root = np.sqrt(d.astype(np.float64))
    upper[rows], upper_at[rows] = iv.up(root), t
    lower[rows, own[rows]], lower_at[rows, own[rows]] = iv.down(root), t
    i, j = np.nonzero(low[rows] <= iv.up(root)[:, None])
    exact = iv.pair_distances(x[rows[i]], centroids[j])
    lower[rows[i], j], lower_at[rows[i], j] = iv.down(np.sqrt(exact.astype(np.float64))), t
    seen = np.full((len(rows), len(ids)), np.iinfo(np.int64).max)
    seen[np.arange(len(rows)), own[rows]] = d
    seen[i, j] = exact
    own[rows] = seen.argmin(1)
    upper[rows] = iv.up(np.sqrt(seen.min(1).astype(np.float64)))
    return own, upper, upper_at, lower, lower_at, len(rows) + len(i)


def _pack_state(own, upper, upper_at, lower, lower_at) -> list[bytes]:
    high = upper.astype(np.float32)
    high = np.where(high.astype(np.float64) < upper, np.nextafter(high, np.float32(np.inf)), high)
    cells = [own.astype(np.uint8)[:, None], upper_at.astype(np.uint8)[:, None], high[:, None].view(np.uint8),
             lower_at.astype(np.uint8), iv.half_down(lower).view(np.uint8)]
    return [r.tobytes() for r in np.concatenate(cells, 1)]


def _unpack_state(rows: list[bytes], k: int) -> tuple[np.ndarray, ...]:
    cell = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)
    high = np.ascontiguousarray(cell[:, 2:6]).view(np.float32)[:, 0].astype(np.float64)
    low = np.ascontiguousarray(cell[:, 6 + k:]).view(np.float16).astype(np.float64)
    return cell[:, 0].astype(np.int64), high, cell[:, 1].astype(np.int64), low, cell[:, 6:6 + k].astype(np.int64)


def _start(batches: Iterator, centroids: np.ndarray, scale: int) -> Iterator:
    """embedding, carried columns -> carried columns, x, state."""
    import pyarrow as pa
    for batch in batches:
        if batch.num_rows:
            x = iv.as_ints(batch.column(0), scale, centroids.shape[1])
            state = _pack_state(*evaluate_all(x, centroids, 0))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(iv.pack(x), pa.binary()), pa.array(state, pa.binary())],
                                             names=[*batch.schema.names[1:], "x", "state"])


def _next(batches: Iterator, history: np.ndarray, last: bool) -> Iterator:
    """Carried columns, x, state -> the same after another assignment; or, ``last``, carried columns, cluster, distance."""
    import pyarrow as pa
    k, dims = history.shape[1:]
    for batch in batches:
        if not batch.num_rows:
            continue
        x = iv.unpack(batch.column("x"), dims)
        state = evaluate_failures(x, history, *_unpack_state(batch.column("state").to_pylist(), k))[:5]
        if last:
            out = [pa.array(state[0].astype(np.int32)), pa.array(iv.pair_distances(x, history[-1][state[0]]))]
        else:
            out = [batch.column("x"), pa.array(_pack_state(*state), pa.binary())]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *out],
                                         names=[*batch.schema.names[:-2], *(("cluster", "distance") if last else ("x", "state"))])


def _sum_clusters(batches: Iterator, k: int, dims: int) -> Iterator:
    sums = iv.Sums(k, dims)
    for batch in batches:
        if batch.num_rows:
            own = np.array([s[0] for s in batch.column(1).to_pylist()], np.int64)
            sums.add(own, iv.unpack(batch.column(0), dims))
    yield iv.sum_batch("cluster", sums)


def cluster(vectors: DataFrame, keep: list[str], dims: int = DIMS, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE,
            seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """``(rows, centroids)``: the ``keep`` columns, cluster and distance (squared) of every usable row of ``vectors`` (vec_id,
    embedding), and the final centroids. At most 256 clusters and 255 rounds."""
    if not (1 <= clusters <= 256 and 1 <= rounds <= 255):
        raise ValueError("clusters and rounds are kept in one byte each")
    spark = vectors.sparkSession
    carried, schema = iv.kept_columns(vectors, keep)
    fine = iv.usable(vectors, dims)
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = fine.select(order.alias("h"), "embedding").orderBy(F.asc_nulls_last("h"), "embedding").limit(clusters).collect()
    if not first:
        empty = vectors.where(F.lit(False)).select(*[F.col(c) for c in keep], F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"))
        return empty, np.zeros((0, dims), np.int64)
    top = iv.limit(dims)
    x = np.array([r["embedding"] for r in first], np.float64)
    history = np.clip(np.floor(np.clip(x, -2.0 * top, 2.0 * top) * scale), -top, top).astype(np.int64)[None]
    k = history.shape[1]
    row = f"{schema}x binary, state binary"
    table, place = iv.rewrite(fine.select(F.col("embedding").alias("_embedding"), *carried).mapInArrow(
        lambda it, c=history[0]: _start(it, c, scale), row), "clusters")
    for i in range(rounds):
        sums = table.select("x", "state").mapInArrow(lambda it: _sum_clusters(it, k, dims), iv.sum_schema("cluster", dims))
        history = np.concatenate([history, iv.means(sums, "cluster", history[-1])[None]])
        last = i + 1 == rounds
        shape = f"{schema}cluster int, distance bigint" if last else row
        after, next_place = iv.rewrite(table.mapInArrow(lambda it, h=history, z=last: _next(it, h, z), shape), "clusters")
        iv.remove(spark, place)
        table, place = after, next_place
    return table.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "cluster", "distance"), history[-1]


def with_inertia(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``rows`` with cluster_inertia, inertia (distance summed over the cluster and over all) and centroid_sha256. The joined
    table has one row per cluster."""
    by = {r["cluster"]: r["d"] for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    total = sum(by.values())

    def fits(d) -> int | None:
        return int(d) if d < 1 << 63 else None

    small = [(i, fits(by[i]), fits(total), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
             for i, c in enumerate(centroids.tolist()) if i in by]
    table = rows.sparkSession.createDataFrame(small, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return rows.join(F.broadcast(table), "cluster")
