"""Vector code compression: product codes of integer vectors, learnt with Drake-Hamerly adaptive bounds.

Method: a vector is cut into ``PARTS`` equal parts; each part position has a codebook of ``ENTRIES`` entries. A first round
measures every entry. From it each part keeps its nearest entry, the ``b`` next ones with lower bounds of their distances in
ascending order, and one outer bound for all others. When the entries have moved, each bound drops by its entry's drift
(the outer one by the largest drift) and is lowered to the bounds behind it, so the order holds. The distance to the kept entry is
then exact; listed entries up to the first bound beyond it are uncertain and measured in integers; a part whose outer bound
isn't beyond it is measured against all entries. ``b`` starts at an eighth of the entries and adapts: what 99 % of a batch's
searches didn't look at is cut off into the outer bound. Bounds only ever prove that an entry is farther, so codes equal
those of a full search, ties to the lower index included.

Rows between rounds are tables in the shared folder: the packed integers, the kept entry and bounds. A table is removed when
the next one is complete. The driver sees the codebooks only (parts x entries x components, fixed by the parameters).

Defined results: rows whose vector is null or holds null or non-finite components are left out, and so are rows whose number
of components isn't a positive multiple of ``PARTS`` or differs from the commonest such number; components saturate
at 2**27 in size (less beyond 128 components); the codebooks start from the rows first by (vec_id with nulls last, vector), repeated
rows included; with fewer rows than entries the codebooks have as many entries as rows; null labels form one group; a label's
error that doesn't fit a bigint is null; an empty table gives an empty one. Other columns are carried where ``keep`` names them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgegraph.llm import int_vectors as iv
from edgegraph.llm.tables import sized_join

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
COVERED = 0.99


# ---- one part position ----------------------------------------------------------------------------------

def search_all(x: np.ndarray, book: np.ndarray, b: int) -> tuple[np.ndarray, ...]:
    """``(nearest, next b entries, their lower bounds, outer bound, squared distance)`` by measuring every entry."""
    d = iv.square_distances(x, book)
    order = np.argsort(d, axis=1, kind="stable")
    near = order[:, 1:b + 1]
    low = iv.down(np.sqrt(np.take_along_axis(d, near, 1).astype(np.float64)))
    if b + 1 < len(book):
        outer = iv.down(np.sqrt(np.take_along_axis(d, order[:, b + 1:b + 2], 1)[:, 0].astype(np.float64)))
    else:
        outer = np.full(len(x), np.inf)
    return order[:, 0], near, low, outer, np.take_along_axis(d, order[:, :1], 1)[:, 0]


def search_bounded(x: np.ndarray, book: np.ndarray, drift: np.ndarray, own: np.ndarray, near: np.ndarray, low: np.ndarray,
                   outer: np.ndarray) -> tuple[np.ndarray, ...]:
    """As :func:`search_all` from an earlier round's bounds, and how many listed entries each search measured (-1: all)."""
    b = near.shape[1]
    outer = iv.down(outer - drift.max(initial=0.0))
    low = iv.down(low - drift[near])
    low = np.minimum.accumulate(np.concatenate([low, outer[:, None]], 1)[:, ::-1], 1)[:, ::-1][:, :b]
    d = iv.pair_distances(x, book[own])
    reach = iv.up(np.sqrt(d.astype(np.float64)))
    looked = (low <= reach[:, None]).sum(1)
    own, near = own.copy(), near.copy()
    rows = np.flatnonzero((looked > 0) & (outer > reach))
    if len(rows):
        some, seen = near[rows], np.arange(b) < looked[rows][:, None]
        dist = np.concatenate([d[rows][:, None], ((x[rows][:, None, :] - book[some]) ** 2).sum(2)], 1)
        entry = np.concatenate([own[rows][:, None], some], 1)
        tried = np.concatenate([np.ones((len(rows), 1), bool), seen], 1)
        least = np.where(tried, dist, np.iinfo(np.int64).max).min(1)
        win = np.where(tried & (dist == least[:, None]), entry, len(book)).min(1)
        bound = np.where(tried, iv.down(np.sqrt(dist.astype(np.float64))), np.concatenate([np.zeros((len(rows), 1)), low[rows]], 1))
        bound[entry == win[:, None]] = -np.inf  # the winner goes to the front, the former one takes a place in the list
        order = np.argsort(bound, axis=1, kind="stable")
        entry, bound = np.take_along_axis(entry, order, 1), np.take_along_axis(bound, order, 1)
        own[rows], near[rows], low[rows], d[rows] = win, entry[:, 1:], bound[:, 1:], least
    rows = np.flatnonzero(outer <= reach)
    if len(rows):
        own[rows], near[rows], low[rows], outer[rows], d[rows] = search_all(x[rows], book, b)
        looked[rows] = -1
    return own, near, low, outer, d, looked


def shrink(near: np.ndarray, low: np.ndarray, outer: np.ndarray, b: int) -> tuple[np.ndarray, ...]:
    """Lists of the first ``b`` entries; the outer bound covers the others."""
    if b >= near.shape[1]:
        return near, low, outer
    return near[:, :b], low[:, :b], np.minimum(outer, low[:, b])


# ---- rows -----------------------------------------------------------------------------------------------

def _pack_state(own: np.ndarray, near: np.ndarray, low: np.ndarray, outer: np.ndarray) -> list[bytes]:
    n = len(own)
    cells = [own.astype(np.uint8), near.astype(np.uint8).reshape(n, -1),
             iv.half_down(low).reshape(n, -1).view(np.uint8), iv.half_down(outer).view(np.uint8)]
    return [r.tobytes() for r in np.concatenate(cells, 1)]


def _unpack_state(rows: list[bytes], parts: int) -> tuple[np.ndarray, ...]:
    n, b = len(rows), len(rows[0]) // (3 * parts) - 1
    cell = np.frombuffer(b"".join(rows), np.uint8).reshape(n, -1)
    cuts = np.cumsum([parts, parts * b, 2 * parts * b])
    own, near, low, outer = np.split(cell, cuts, axis=1)

    def half(a: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(a).view(np.float16).astype(np.float64)

    return own.astype(np.int64), near.reshape(n, parts, b).astype(np.int64), half(low).reshape(n, parts, b), half(outer)


def _start(batches: Iterator, books: np.ndarray, scale: int, b: int) -> Iterator:
    """embedding, carried columns -> carried columns, x, state."""
    import pyarrow as pa
    parts, _, width = books.shape
    for batch in batches:
        if not batch.num_rows:
            continue
        x = iv.as_ints(batch.column(0), scale, parts * width)
        found = [search_all(x[:, p * width:(p + 1) * width], books[p], b) for p in range(parts)]
        state = _pack_state(*(np.stack([f[i] for f in found], 1) for i in range(4)))
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(iv.pack(x), pa.binary()), pa.array(state, pa.binary())],
                                         names=[*batch.schema.names[1:], "x", "state"])


def _next(batches: Iterator, books: np.ndarray, drift: np.ndarray, last: bool) -> Iterator:
    """Carried columns, x, state -> the same after another assignment; or, ``last``, carried columns, code, error."""
    import pyarrow as pa
    parts, _, width = books.shape
    for whole in batches:
        size = np.asarray(pa.compute.binary_length(whole.column("state")))
        for one in np.unique(size):  # b may differ between batches of the earlier round
            batch = whole.filter(pa.array(size == one))
            x = iv.unpack(batch.column("x"), parts * width)
            own, near, low, outer = _unpack_state(batch.column("state").to_pylist(), parts)
            found = [search_bounded(x[:, p * width:(p + 1) * width], books[p], drift[p], own[:, p], near[:, p], low[:, p], outer[:, p])
                     for p in range(parts)]
            carried = batch.columns[:-2]
            if last:
                code = np.stack([f[0] for f in found], 1).astype(np.uint8)
                out = [pa.array([r.tobytes().hex() for r in code], pa.string()), pa.array(sum(f[4] for f in found))]
            else:
                looked = np.concatenate([f[5] for f in found])
                looked = looked[looked >= 0]
                b = near.shape[2]
                if len(looked):
                    b = min(b, max(1, int(np.quantile(looked, COVERED, method="higher"))))
                cut = [shrink(*f[1:4], b) for f in found]
                state = _pack_state(np.stack([f[0] for f in found], 1), *(np.stack([c[i] for c in cut], 1) for i in range(3)))
                out = [batch.column("x"), pa.array(state, pa.binary())]
            yield pa.RecordBatch.from_arrays([*carried, *out], names=[*whole.schema.names[:-2], *(("code", "error") if last else ("x", "state"))])


def _sum_parts(batches: Iterator, parts: int, entries: int, width: int) -> Iterator:
    sums = iv.Sums(parts * entries, width)
    for batch in batches:
        if batch.num_rows:
            x = iv.unpack(batch.column(0), parts * width)
            own = np.stack([np.frombuffer(s[:parts], np.uint8) for s in batch.column(1).to_pylist()]).astype(np.int64)
            sums.add((own + np.arange(parts) * entries).reshape(-1), x.reshape(-1, width))
    yield iv.sum_batch("slot", sums)


# ---- operator -------------------------------------------------------------------------------------------

def common_dims(vectors: DataFrame, parts: int = PARTS) -> int | None:
    """The commonest positive multiple of ``parts`` among the numbers of components (ties: the smallest); None without one."""
    size = F.size("embedding").alias("size")
    r = (vectors.select(size).where((F.col("size") > 0) & (F.col("size") % parts == 0)).groupBy("size").count()
         .orderBy(F.desc("count"), "size").first())
    return None if r is None else r["size"]


def compress(vectors: DataFrame, keep: list[str], parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """``(rows, codebooks)``: the ``keep`` columns, code (hex entry index of each part) and error (squared distance) of every
    usable row of ``vectors`` (vec_id, embedding), and the entries as parts x entries x components. At most 256 entries."""
    if not 1 <= entries <= 256:
        raise ValueError("a code holds at most 256 entries")
    spark = vectors.sparkSession
    carried, schema = iv.kept_columns(vectors, keep)
    fine = iv.usable(vectors)
    dims = common_dims(fine, parts)
    if dims is None:
        empty = vectors.where(F.lit(False)).select(*[F.col(c) for c in keep], F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"))
        return empty, np.zeros((parts, 0, 0), np.int64)
    fine = fine.where(F.size("embedding") == dims)
    width = dims // parts
    first = fine.select("vec_id", "embedding").orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(entries).collect()
    top = iv.limit(dims)
    x = np.array([r["embedding"] for r in first], np.float64)
    x = np.clip(np.floor(np.clip(x, -2.0 * top, 2.0 * top) * scale), -top, top).astype(np.int64)
    books = x.reshape(len(x), parts, width).transpose(1, 0, 2).copy()
    k = len(x)
    b = min(max(1, entries // 8), k - 1)
    row = f"{schema}x binary, state binary"
    table, place = iv.rewrite(fine.select(F.col("embedding").alias("_embedding"), *carried).mapInArrow(lambda it, c=books: _start(it, c, scale, b), row),
                              "codes")
    for i in range(rounds):
        sums = table.select("x", "state").mapInArrow(lambda it: _sum_parts(it, parts, k, width), iv.sum_schema("slot", width))
        new = iv.means(sums, "slot", books.reshape(parts * k, width)).reshape(parts, k, width)
        drift = iv.up(np.sqrt(((new - books) ** 2).sum(2).astype(np.float64)))
        books, last = new, i + 1 == rounds
        shape = f"{schema}code string, error bigint" if last else row
        after, next_place = iv.rewrite(table.mapInArrow(lambda it, c=books, m=drift, z=last: _next(it, c, m, z), shape), "codes")
        iv.remove(spark, place)
        table, place = after, next_place
    return table.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "code", "error"), books


def _expand(batches: Iterator, books: np.ndarray) -> Iterator:
    """code, carried columns -> carried columns, decoded."""
    import pyarrow as pa
    parts, _, width = books.shape
    for b in batches:
        code = b.column(0)
        known = np.flatnonzero(np.asarray(pa.compute.is_valid(code)))
        index = np.frombuffer(bytes.fromhex("".join(code.take(pa.array(known)).to_pylist())), np.uint8).reshape(-1, parts)
        x = books[np.arange(parts), index].reshape(len(known), parts * width)
        lists: list = [None] * b.num_rows
        for i, row in zip(known.tolist(), x.tolist()):
            lists[i] = row
        yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(lists, pa.list_(pa.int64()))], names=[*b.schema.names[1:], "decoded"])


def decompress(codes: DataFrame, books: np.ndarray) -> DataFrame:
    """``codes`` with ``decoded``: the integer components that the code stands for (null for a null code)."""
    carried, schema = iv.kept_columns(codes, codes.columns)
    out = codes.select(F.col("code").alias("_code"), *carried).mapInArrow(lambda it: _expand(it, books), f"{schema}decoded array<bigint>")
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(codes.columns)], "decoded")


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def label_errors(rows: DataFrame) -> DataFrame:
    """``rows`` with label_error: error summed over equal labels."""
    total = rows.groupBy("label").agg(iv.exact_sum("error").alias("label_error"))
    return sized_join(rows, total, ["label"])
