"""Byte-level BPE encoding and decoding with a public vocabulary of ranks.

Method: texts are cut into the pattern's matches by vectorised character classes; every distinct match of a chunk is encoded once.
A match that is itself in the vocabulary is one token. The others go, bucketed by length, into padded numpy matrices
of token ids: in each round every row merges its leftmost pair of minimum rank, pair ranks come from an open-addressing hash
table, merged columns and finished rows are compacted away. A match of more than ``LONGEST`` bytes follows the same rule
with a heap, since a matrix of its own would cost the square of its length.

The vocabulary (tens of thousands of entries, its bound) is read on the driver from a path and broadcast.

Defined results: null and empty texts have no ids and decode to no bytes; repeated rows are encoded alike; a row whose ids are
null, or hold a null or an id outside the vocabulary, decodes to null; an empty table gives an empty one; only the columns
named in ``keep`` are carried, an ``ids`` or ``bytes`` column among them is replaced.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from edgegraph.llm import textwords as tw

CHUNK_BYTES = 1 << 20
LONGEST = 512
NO_RANK = np.int32(np.iinfo(np.int32).max)
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
# The code points of Unicode's White_Space property.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


# ---- vocabulary -----------------------------------------------------------------------------------------

class Vocabulary:
    """Ranks of byte strings: the id of a token is its rank."""

    def __init__(self, ranks: dict[bytes, int]):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the vocabulary lacks a single byte")
        self.ranks = ranks
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        size = max(ranks.values()) + 1
        self.length = np.full(size, -1, np.int64)
        for token, i in ranks.items():
            self.length[i] = len(token)
        self.start = np.concatenate([[0], np.cumsum(np.maximum(self.length, 0))])
        data = bytearray(int(self.start[-1]))
        for token, i in ranks.items():
            data[self.start[i]:self.start[i] + len(token)] = token
        self.data = np.frombuffer(bytes(data), np.uint8)
        pairs = {(ranks[t[:k]] << 32) | ranks[t[k:]]: i for t, i in ranks.items() for k in range(1, len(t))
                 if t[:k] in ranks and t[k:] in ranks}
        self._fill(np.fromiter(pairs.keys(), np.uint64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs)))

    def _fill(self, keys: np.ndarray, values: np.ndarray) -> None:
        slots = 1 << max(4, (4 * len(keys)).bit_length())
        self.mask = np.uint64(slots - 1)
        self.keys = np.full(slots, ~np.uint64(0), np.uint64)
        self.values = np.full(slots, NO_RANK, np.int32)
        at = tw.mix64(keys) & self.mask
        while len(keys):
            free = self.keys[at] == ~np.uint64(0)
            self.keys[at[free]] = keys[free]  # of several claims to a slot the last one stays
            won = self.keys[at] == keys
            self.values[at[won]] = values[won]
            keys, values, at = keys[~won], values[~won], (at[~won] + np.uint64(1)) & self.mask

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each concatenation, ``NO_RANK`` where there is none or an id is negative."""
        key = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint32).astype(np.uint64)
        out = np.full(key.shape, NO_RANK, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        key, flat = key.reshape(-1)[todo], out.reshape(-1)
        at = tw.mix64(key) & self.mask
        while len(todo):
            seen = self.keys[at]
            hit = seen == key
            flat[todo[hit]] = self.values[at[hit]]
            on = ~hit & (seen != ~np.uint64(0))
            todo, key, at = todo[on], key[on], (at[on] + np.uint64(1)) & self.mask
        return out


def load_vocabulary(path: str) -> Vocabulary:
    """From a file with one ``base64 rank`` line per token."""
    with open(path, "rb") as f:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})


# ---- cutting texts into matches -------------------------------------------------------------------------

@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    import unicodedata
    kind = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kind.get(unicodedata.category(chr(i))[0], OTHER) for i in range(0x110000)), np.uint8, 0x110000)
    out[WHITE_SPACE] = SPACE
    return out


def _code_points(data: np.ndarray, pos: np.ndarray) -> np.ndarray:
    first = data[pos]
    cp = first.astype(np.uint32)
    wide = np.flatnonzero(first >= 0xC0)
    if len(wide):
        padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.uint32)
        p, f = pos[wide], first[wide]
        b1, b2, b3 = (padded[p + k] & 0x3F for k in (1, 2, 3))
        lead = f.astype(np.uint32)
        cp[wide] = np.where(f < 0xE0, (lead & 0x1F) << 6 | b1, np.where(
            f < 0xF0, (lead & 0x0F) << 12 | b1 << 6 | b2, (lead & 0x07) << 18 | b1 << 12 | b2 << 6 | b3))
    return np.minimum(cp, 0x10FFFF)


def split(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the matches of
    ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`` in every text; matches never cross
    texts and cover them. A character opens a match where the class changes; of a run of white space before other
    text the last character stands apart, and a single blank there joins what follows; a contraction counts only where its
    apostrophe opens a match, and what follows it opens one again."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lead = (data & 0xC0) != 0x80
    lead[offs[:-1][offs[:-1] < n]] = True
    pos = np.flatnonzero(lead)
    m = len(pos)
    cp = _code_points(data, pos)
    kind = char_classes()[cp]
    first = np.zeros(m + 1, bool)  # a text begins
    first[np.searchsorted(pos, offs)] = True
    first[m] = True
    before = np.full(m, 9, np.uint8)
    before[1:] = kind[:-1]
    before[first[:m]] = 9
    after = np.full(m, 9, np.uint8)
    after[:-1] = kind[1:]
    after[first[1:]] = 9
    blank = np.zeros(m, bool)
    blank[1:] = cp[:-1] == 0x20
    begin = before != kind
    begin |= (kind == SPACE) & (after < SPACE)
    begin &= ~((kind != SPACE) & (before == SPACE) & blank)
    quote = np.flatnonzero((cp == 0x27) & begin & (after == LETTER))
    if len(quote):
        far = np.concatenate([cp, np.zeros(2, cp.dtype)])
        one, two = far[quote + 1], far[quote + 2]
        two[first[np.minimum(quote + 2, m)]] = 0
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(quote), bool)
        for a, b in ("re", "ve", "ll"):
            long |= (one == ord(a)) & (two == ord(b))
        begin[quote[short | long] + 1] = False
        end = np.concatenate([quote[short] + 2, quote[long] + 3])
        begin[end[end < m]] = True
    starts = pos[begin]
    return starts, np.append(starts[1:], n)


def _distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(number of the distinct match, a place of each distinct match)``; equal bytes, not only equal hashes."""
    import pandas as pd
    length = ends - starts
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    window = np.ndarray((len(data) + 8,), "<u8", padded, strides=(1,))

    def word(at: np.ndarray, left: np.ndarray) -> np.ndarray:
        keep = np.clip(left, 0, 8).astype(np.uint64) * np.uint64(8)
        return window[np.minimum(at, len(data))] & np.where(keep < 64, (np.uint64(1) << (keep & np.uint64(63))) - np.uint64(1), ~np.uint64(0))

    short = np.flatnonzero(length <= 16)
    lo, hi = word(starts[short], length[short]), word(starts[short] + 8, length[short] - 8)
    size = length[short].astype(np.uint64)
    code, keys = pd.factorize(tw.mix64(lo ^ tw.mix64(hi + size * np.uint64(0x9E3779B97F4A7C15))))
    place = np.zeros(len(keys), np.int64)
    place[code[::-1]] = np.arange(len(short))[::-1]
    if not ((lo == lo[place][code]) & (hi == hi[place][code]) & (size == size[place][code])).all():
        _, place, code = np.unique(np.stack([lo, hi, size], 1), axis=0, return_index=True, return_inverse=True)
        code = code.reshape(-1)
    number = np.empty(len(starts), np.int64)
    number[short] = code
    places = short[place].tolist()
    known: dict[bytes, int] = {}
    for i in np.flatnonzero(length > 16).tolist():
        text = data[starts[i]:ends[i]].tobytes()
        if text not in known:
            known[text] = len(places)
            places.append(i)
        number[i] = known[text]
    return number, np.array(places, np.int64)


# ---- merging --------------------------------------------------------------------------------------------

def _merge_rows(vocab: Vocabulary, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(row numbers, their final ids)`` of a matrix of ids padded with -1, as rows finish."""
    row = np.arange(len(ids))
    rank = vocab.pair_ranks(ids[:, :-1], ids[:, 1:])
    while len(row):
        if not rank.shape[1]:
            yield row, ids
            return
        at = rank.argmin(1)
        best = rank[np.arange(len(row)), at]
        live = best != NO_RANK
        if not live.all():
            yield row[~live], ids[~live]
            row, ids, rank, at, best = row[live], ids[live], rank[live], at[live], best[live]
            if not len(row):
                return
        i = np.arange(len(row))
        ids[i, at] = best
        cols = np.arange(ids.shape[1] - 1)
        ids = np.take_along_axis(ids, cols + (cols > at[:, None]), 1)
        cols = cols[:-1]
        rank = np.take_along_axis(rank, cols + (cols >= at[:, None]), 1)
        left, right = np.flatnonzero(at > 0), np.flatnonzero(at < ids.shape[1] - 1)
        rank[left, at[left] - 1] = vocab.pair_ranks(ids[left, at[left] - 1], ids[left, at[left]])
        rank[right, at[right]] = vocab.pair_ranks(ids[right, at[right]], ids[right, at[right] + 1])


def _merge_long(vocab: Vocabulary, piece: np.ndarray) -> np.ndarray:
    """The same rule for one long match: smallest (rank, place) first, places linked on both sides."""
    ids = vocab.byte[piece].tolist()
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    ranks = vocab.pair_ranks(np.array(ids[:-1], np.int32), np.array(ids[1:], np.int32)).tolist()
    none = int(NO_RANK)
    heap = [(r, i) for i, r in enumerate(ranks) if r != none]
    heapq.heapify(heap)
    ranks.append(none)

    def rank(i: int) -> int:
        j = after[i]
        return none if j >= n else int(vocab.pair_ranks(np.array([ids[i]], np.int32), np.array([ids[j]], np.int32))[0])

    while heap:
        r, i = heapq.heappop(heap)
        if ids[i] < 0 or ranks[i] != r:
            continue
        j = after[i]
        ids[i], ids[j] = r, -1
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        for k in (before[i], i):
            if k >= 0:
                ranks[k] = rank(k)
                if ranks[k] != none:
                    heapq.heappush(heap, (ranks[k], k))
    return np.array([x for x in ids if x >= 0], np.int32)


def encode_matches(vocab: Vocabulary, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(ids, bounds)``: match i's ids are ``ids[bounds[i]:bounds[i + 1]]``."""
    owner: list[np.ndarray] = []
    parts: list[np.ndarray] = []
    whole = np.fromiter((vocab.ranks.get(data[a:b].tobytes(), -1) for a, b in zip(starts.tolist(), ends.tolist())), np.int32, len(starts))
    found = np.flatnonzero(whole >= 0)
    owner.append(found)
    parts.append(whole[found])
    rest = np.flatnonzero(whole < 0)
    length = ends - starts
    low, width = 1, 8
    while low < LONGEST:
        rows = rest[(length[rest] > low) & (length[rest] <= width)]
        for at in range(0, len(rows), max(1, (1 << 20) // width)):
            some = rows[at:at + max(1, (1 << 20) // width)]
            w = int(length[some].max())
            cell = starts[some][:, None] + np.arange(w)
            pad = np.arange(w) >= length[some][:, None]
            ids = np.where(pad, np.int32(-1), vocab.byte[data[np.minimum(cell, len(data) - 1)]])
            for done, out in _merge_rows(vocab, ids):
                used = out >= 0
                owner.append(np.repeat(some[done], used.sum(1)))
                parts.append(out[used])
        low, width = width, width * 2
    for i in rest[length[rest] > LONGEST].tolist():
        parts.append(_merge_long(vocab, data[starts[i]:ends[i]]))
        owner.append(np.full(len(parts[-1]), i))
    own, ids = np.concatenate(owner), np.concatenate(parts)
    ids = ids[np.argsort(own, kind="stable")]
    return ids, np.concatenate([[0], np.cumsum(np.bincount(own, minlength=len(starts)))])


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indexes of consecutive ranges: start[0], start[0] + 1, ..., start[1], ..."""
    ends = np.cumsum(length)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - length), length)


def encode_texts(vocab: Vocabulary, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(ids, bounds)`` of whole texts."""
    starts, ends = split(data, offs)
    if not len(starts):
        return np.zeros(0, np.int32), np.zeros(len(offs), np.int64)
    number, place = _distinct(data, starts, ends)
    ids, bounds = encode_matches(vocab, data, starts[place], ends[place])
    count = np.diff(bounds)[number]
    total = np.concatenate([[0], np.cumsum(count)])
    return ids[_ranges(bounds[number], count)], total[np.searchsorted(starts, offs)]


def decode_ids(vocab: Vocabulary, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of lists of known ids."""
    length = vocab.length[ids]
    total = np.concatenate([[0], np.cumsum(length)])
    return vocab.data[_ranges(vocab.start[ids], length)], total[bounds]


# ---- Spark ----------------------------------------------------------------------------------------------

def _encode(batches: Iterator, vocab) -> Iterator:
    import pyarrow as pa
    for b in batches:
        kept = b.schema.names[1:]
        for at, end, data, offs in tw.pieces(b.column(0), CHUNK_BYTES):
            ids, bounds = encode_texts(vocab.value, data, offs)
            out = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*(b.column(i + 1).slice(at, end - at) for i in range(len(kept))), out], names=[*kept, "ids"])


def _decode(batches: Iterator, vocab) -> Iterator:
    import pyarrow as pa
    v = vocab.value
    for b in batches:
        kept = b.schema.names[1:]
        lists = b.column(0)
        size = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(lists), 0)).astype(np.int64)
        ends = np.cumsum(size)
        at = 0
        while at < len(lists):
            done = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, done + CHUNK_BYTES // 4, "right")))
            some = lists.slice(at, end - at)
            ids = np.asarray(pa.compute.fill_null(some.flatten(), -1)).astype(np.int64)
            known = (ids >= 0) & (ids < len(v.length))
            known &= v.length[np.where(known, ids, 0)] >= 0
            bounds = np.concatenate([[0], np.cumsum(size[at:end])])
            bad = np.asarray(pa.compute.is_null(some)).copy()
            if not known.all():
                bad |= np.diff(np.concatenate([[0], np.cumsum(~known)])[bounds]) > 0
                good = np.repeat(~bad, size[at:end])
                ids, bounds = ids[good], np.concatenate([[0], np.cumsum(np.where(bad, 0, size[at:end]))])
            data, offs = decode_ids(v, ids, bounds)
            valid = np.packbits(~bad, bitorder="little").tobytes()
            out = pa.Array.from_buffers(pa.large_binary(), end - at, [pa.py_buffer(valid), pa.py_buffer(offs.astype(np.int64).tobytes()),
                                                                       pa.py_buffer(data.tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([*(b.column(i + 1).slice(at, end - at) for i in range(len(kept))), out], names=[*kept, "bytes"])
            at = end


def _schema(df: DataFrame, columns: list[str], added: str) -> str:
    return ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns), added])


def broadcast_vocabulary(spark: SparkSession, path: str):
    return spark.sparkContext.broadcast(load_vocabulary(path))


def encode(docs: DataFrame, path: str, keep: list[str]) -> DataFrame:
    """The ``keep`` columns and ``ids``: every whole text's token ids by the vocabulary at ``path``, without special tokens."""
    vocab = broadcast_vocabulary(docs.sparkSession, path)
    keep = [c for c in keep if c != "ids"]
    return docs.select("text", *keep).mapInArrow(lambda it: _encode(it, vocab), _schema(docs, keep, "ids array<int>"))


def decode(tokens: DataFrame, path: str, keep: list[str]) -> DataFrame:
    """The ``keep`` columns and ``bytes``: the concatenated bytes of the row's ``ids``."""
    vocab = broadcast_vocabulary(tokens.sparkSession, path)
    keep = [c for c in keep if c != "bytes"]
    renamed = tokens.select(tokens["ids"].alias("_ids"), *keep)
    return renamed.mapInArrow(lambda it: _decode(it, vocab), _schema(tokens, keep, "bytes binary"))
