"""Interpolated modified Kneser-Ney language model (words, order 2).

Method: tasks count words, and then word pairs, piece by piece with numpy; partial counts are sorted arrays, cut by hash range into
shards and shuffled; one task per shard merges them and writes a sorted array file into the shared folder. A word's id
is its place in the sorted hash array, so a pair is one exact 64-bit key. Pair shards also yield, per word, how many
different words precede it (the lower order's counts) and how many of its followers occur once, twice or more (the
back-off weights), summed by a second shuffle. Scoring tasks memory-map the arrays and look all words and pairs of a
piece up by binary search; texts are not shuffled.

Every training token counts; the model grows with the corpus, in files that no task or driver holds whole. The driver sees one
row per shard. A very frequent word or pair is one entry per task before the shuffle, and a frequent context's pairs are spread over
all shards. The number of shards is the session's shuffle partitions, rounded up to a power of two. Ids are 32 bits wide: up to
four billion different words. Files are written under a temporary name and renamed, so a repeated task replaces its own
file by an equal one, and a lost executor loses nothing that is finished.

Defined results: null or blank text is one end token; a null doc_id trains; a word or context never seen in training falls back to the
lower order, whose last level is uniform over the words and one unknown word; without training texts every probability
is that uniform one; repeated rows count each; an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgegraph.llm import textwords as tw
from edgegraph.llm.tables import make_folder, map_arrays, shared_folder, write_arrays

PIECE_BYTES = 1 << 22
# Partial counts are flushed when so many distinct keys are held.
HELD = 3_000_000
END = tw.mix64(np.array([0x656E64], np.uint64))[0]


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and summed counts."""
    if len(parts) == 1:
        return parts[0]
    keys = np.concatenate([p[0] for p in parts])
    counts = np.concatenate([p[1] for p in parts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    if not len(keys):
        return keys, counts
    head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[head], np.add.reduceat(counts, head)


def _pack(values: np.ndarray) -> bytes:
    """Differences of an ascending array, or small numbers as they are, with equal bytes side by side: shuffle
    compression then removes the high bytes, which are mostly zero."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def _pack_sorted(values: np.ndarray) -> bytes:
    return _pack(np.diff(values, prepend=values.dtype.type(0)))


def _unpack(blob, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    raw = np.frombuffer(blob.as_buffer(), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, len(raw) // size).T).reshape(-1).view(dtype)


def _shard_of_pair(key: np.ndarray, bits: int) -> np.ndarray:
    return (tw.mix64(key) >> np.uint64(64 - bits)).astype(np.int64)


def _tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with one END after each text, and the text of each."""
    starts, ends, text = tw.words(data, offs)
    n = len(offs) - 1
    per = np.bincount(text, minlength=n) + 1
    last = np.cumsum(per) - 1
    out = np.full(int(per.sum()), END, np.uint64)
    inside = np.ones(len(out), bool)
    inside[last] = False
    out[inside] = tw.hashes(data, starts, ends)
    return out, np.repeat(np.arange(n), per)


def _counting(batches: Iterator, keys_of, shard_of, shards: int) -> Iterator:
    """text -> (shard, keys, counts) blobs of partial counts."""
    import pyarrow as pa
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def flush():
        keys, counts = _merge(held)
        owner = shard_of(keys)
        order = np.argsort(owner, kind="stable")
        keys, counts, owner = keys[order], counts[order], owner[order]
        cut = np.searchsorted(owner, np.arange(shards + 1))
        some = np.flatnonzero(np.diff(cut))
        return pa.RecordBatch.from_arrays([
            pa.array(some), pa.array([_pack_sorted(keys[cut[s]:cut[s + 1]]) for s in some], pa.binary()),
            pa.array([_pack(counts[cut[s]:cut[s + 1]].astype(np.uint32)) for s in some], pa.binary())],
            names=["shard", "keys", "counts"])

    for b in batches:
        for _, _, data, offs in tw.pieces(b.column(0), PIECE_BYTES):
            part = np.unique(keys_of(data, offs), return_counts=True)
            held.append(part)
            size += len(part[0])
            if size > HELD:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def _narrow(counts: np.ndarray) -> np.ndarray:
    return counts.astype(np.uint32 if not len(counts) or counts.max() < 1 << 32 else np.uint64)


def _by_shard(batches: Iterator) -> dict[int, list[tuple[np.ndarray, np.ndarray]]]:
    found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for b in batches:
        for s, k, c in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
            found.setdefault(s, []).append((np.cumsum(_unpack(k, np.uint64)), _unpack(c, np.uint32).astype(np.int64)))
    return found


class Words:
    """The mapped word shards: ids and counts of word hashes."""

    def __init__(self, folder: str, bits: int, offsets: list[int]):
        self.folder, self.bits, self.offsets = folder, bits, np.array(offsets, np.int64)
        self.shards: dict[int, dict] = {}

    def _shard(self, s: int) -> dict:
        if s not in self.shards:
            self.shards[s] = map_arrays(f"{self.folder}/words-{s}")
        return self.shards[s]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id or -1, count or 0) of ascending hashes."""
        ids, counts = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        cut = np.searchsorted((keys >> np.uint64(64 - self.bits)).astype(np.int64), np.arange((1 << self.bits) + 1))
        for s in np.flatnonzero(np.diff(cut)):
            if self.offsets[s] == self.offsets[s + 1]:
                continue
            m, part = self._shard(int(s)), keys[cut[s]:cut[s + 1]]
            at = np.minimum(np.searchsorted(m["keys"], part), len(m["keys"]) - 1)
            hit = m["keys"][at] == part
            ids[cut[s]:cut[s + 1]] = np.where(hit, at + self.offsets[s], -1)
            counts[cut[s]:cut[s + 1]] = np.where(hit, m["counts"][at], 0)
        return ids, counts


def _pairs(ids: np.ndarray, text: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray]:
    """(context, word) of every token; a text's first context is ``begin``."""
    context = np.empty_like(ids)
    context[1:] = ids[:-1]
    if len(ids):
        context[0] = begin
        context[1:][text[1:] != text[:-1]] = begin
    return context, ids


def discounts(n: list[int]) -> list[float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more from the numbers of entries with counts 1 to 4."""
    if min(n[:4]) == 0:
        return [0.5, 1.0, 1.5]
    y = n[0] / (n[0] + 2 * n[1])
    return [min(max(i + 1 - (i + 2) * y * n[i + 1] / n[i], 0.0), i + 1.0) for i in range(3)]


def _histogram(counts: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(counts, 5).astype(np.int64), minlength=6)[1:5].tolist()


class Model:
    """Where the arrays lie and the global numbers; small, sent to every task."""

    def __init__(self, folder, bits, offsets, tokens, pairs, d_pair, d_word, backoff, filled):
        self.filled = filled
        self.folder, self.bits, self.offsets, self.tokens, self.pairs = folder, bits, offsets, tokens, pairs
        self.d_pair, self.d_word, self.backoff = d_pair, d_word, backoff

    @property
    def words(self) -> int:
        return int(self.offsets[-1])


def train(texts: DataFrame) -> Model:
    """Count all rows of ``texts`` (one column) and write the arrays into the shared folder."""
    spark = texts.sparkSession
    folder = shared_folder(spark, "lm")
    make_folder(folder)
    bits = max(1, (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    shards = 1 << bits
    blob = "shard bigint, keys binary, counts binary"

    def count_words(batches: Iterator) -> Iterator:
        return _counting(batches, lambda d, o: _tokens(d, o)[0], lambda k: (k >> np.uint64(64 - bits)).astype(np.int64), shards)

    def write_words(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for s, parts in _by_shard(batches).items():
            keys, counts = _merge(parts)
            write_arrays(f"{folder}/words-{s}", keys=keys, counts=_narrow(counts))
            yield pa.RecordBatch.from_arrays([pa.array([s]), pa.array([len(keys)]), pa.array([int(counts.sum())])],
                                             names=["shard", "n", "total"])

    rows = (texts.mapInArrow(count_words, blob).repartition(shards, "shard")
            .mapInArrow(write_words, "shard bigint, n bigint, total bigint").collect())  # one row per shard
    per = np.zeros(shards, np.int64)
    for r in rows:
        per[r["shard"]] = r["n"]
    offsets = [0, *np.cumsum(per).tolist()]
    begin = offsets[-1]
    tokens = sum(r["total"] for r in rows)

    def count_pairs(batches: Iterator) -> Iterator:
        words = Words(folder, bits, offsets)

        def keys_of(data, offs):
            token, text = _tokens(data, offs)
            distinct, back = np.unique(token, return_inverse=True)
            context, word = _pairs(words.find(distinct)[0][back], text, begin)
            return (context.astype(np.uint64) << np.uint64(32)) | word.astype(np.uint64)

        return _counting(batches, keys_of, lambda k: _shard_of_pair(k, bits), shards)

    def write_pairs(batches: Iterator) -> Iterator:
        """Write the pair shards; pass on partial statistics per word id, cut by the word shards."""
        import pyarrow as pa
        for s, parts in _by_shard(batches).items():
            keys, counts = _merge(parts)
            # one byte a count; the few larger ones apart, by their place
            many = np.flatnonzero(counts > 254)
            write_arrays(f"{folder}/pairs-{s}", keys=keys, counts=np.minimum(counts, 255).astype(np.uint8), many=many,
                         more=counts[many])
            context, word = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
            # one row per word shard: the words that follow, and the contexts whose pairs occur once, twice or more often
            cuts = []
            for ids in (word, *(context[np.minimum(counts, 3) == k] for k in (1, 2, 3))):
                ids, n = np.unique(ids, return_counts=True)
                owner = np.searchsorted(offsets, ids, "right") - 1
                cuts.append((ids, n.astype(np.uint32), np.searchsorted(owner, np.arange(shards + 2))))
            some = np.flatnonzero(np.any([np.diff(c) > 0 for _, _, c in cuts], axis=0))
            ids = [[_pack_sorted((i[c[x]:c[x + 1]] - offsets[x]).astype(np.uint32)) for i, _, c in cuts] for x in some]
            n = [[_pack(m[c[x]:c[x + 1]]) for _, m, c in cuts] for x in some]
            yield pa.RecordBatch.from_arrays([
                pa.array([*some.tolist(), -1 - s]), pa.array([*ids, []], pa.list_(pa.binary())), pa.array([*n, []], pa.list_(pa.binary())),
                pa.array([*([[]] * len(some)), [len(keys), *_histogram(counts)]], pa.list_(pa.int64()))],
                names=["shard", "ids", "n", "stats"])

    def write_statistics(batches: Iterator) -> Iterator:
        """Per word shard: dense arrays of the four statistics, in the order of the ids."""
        import pyarrow as pa
        arrays: dict[int, list[np.ndarray]] = {}
        out = []
        for b in batches:
            for s, ids, n, stats in zip(*(b.column(i) for i in range(4))):
                s = s.as_py()
                if s < 0:
                    out.append((s, stats.as_py()))
                    continue
                if s not in arrays:
                    size = 1 if s == shards else offsets[s + 1] - offsets[s]
                    arrays[s] = [np.zeros(size, np.int64) for _ in range(4)]
                for array, i, m in zip(arrays[s], ids.values, n.values):
                    array[np.cumsum(_unpack(i, np.uint32))] += _unpack(m, np.uint32)
        for s, (before, n1, n2, n3) in arrays.items():
            write_arrays(f"{folder}/statistics-{s}", before=_narrow(before), n1=_narrow(n1), n2=_narrow(n2), n3=_narrow(n3))
            some = before[before > 0]
            out.append((s, [len(some), *_histogram(some)]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()),
                                              pa.array([o[1] for o in out], pa.list_(pa.int64()))], names=["shard", "stats"])

    rows = (texts.mapInArrow(count_pairs, blob).repartition(shards, "shard")
            .mapInArrow(write_pairs, "shard bigint, ids array<binary>, n array<binary>, stats array<bigint>")
            .repartition(shards, "shard").mapInArrow(write_statistics, "shard bigint, stats array<bigint>")
            .collect())  # two rows per shard
    filled = np.zeros(shards, bool)
    filled[[-1 - r["shard"] for r in rows if r["shard"] < 0]] = True
    pair = np.sum([r["stats"] for r in rows if r["shard"] < 0] or [[0] * 5], axis=0)
    word = np.sum([r["stats"] for r in rows if r["shard"] >= 0] or [[0] * 5], axis=0)
    d_pair, d_word = discounts(pair[1:].tolist()), discounts(word[1:].tolist())
    m1, m2 = int(word[1]), int(word[2])
    spare = d_word[0] * m1 + d_word[1] * m2 + d_word[2] * (int(word[0]) - m1 - m2)
    backoff = spare / int(pair[0]) if pair[0] else 1.0
    return Model(folder, bits, offsets, tokens, int(pair[0]), d_pair, d_word, backoff, filled)


class Scorer:
    """Look-ups in the mapped arrays, opened when first needed."""

    def __init__(self, model: Model):
        self.m = model
        self.words = Words(model.folder, model.bits, model.offsets)
        self.files: dict[str, dict] = {}

    def _file(self, name: str) -> dict:
        if name not in self.files:
            self.files[name] = map_arrays(f"{self.m.folder}/{name}")
        return self.files[name]

    def _statistics(self, ids: np.ndarray) -> np.ndarray:
        """Columns before, n1, n2, n3 of ascending word ids (the begin mark has the id after the last word)."""
        out = np.zeros((len(ids), 4), np.int64)
        owner = np.searchsorted(self.words.offsets, ids, "right") - 1
        for s in np.unique(owner):
            f, mine = self._file(f"statistics-{s}"), owner == s
            at = ids[mine] - self.words.offsets[s]
            for i, k in enumerate(("before", "n1", "n2", "n3")):
                out[mine, i] = f[k][at]
        return out

    def _pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of the pairs, in any order. A shard without pairs has no file."""
        out = np.zeros(len(keys), np.int64)
        shard = _shard_of_pair(keys, self.m.bits)
        order = np.lexsort((keys, shard))
        cut = np.searchsorted(shard[order], np.arange((1 << self.m.bits) + 1))
        for s in np.flatnonzero((np.diff(cut) > 0) & self.m.filled):
            f, at = self._file(f"pairs-{s}"), order[cut[s]:cut[s + 1]]
            k = np.minimum(np.searchsorted(f["keys"], keys[at]), len(f["keys"]) - 1)
            c = f["counts"][k].astype(np.int64)
            big = np.flatnonzero(c == 255)
            c[big] = f["more"][np.searchsorted(f["many"], k[big])]
            out[at] = np.where(f["keys"][k] == keys[at], c, 0)
        return out

    def texts(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """n_tokens, n_known, base score (add-one unigrams) and score (the model), log10, of every text."""
        m, n = self.m, len(offs) - 1
        token, text = _tokens(data, offs)
        distinct, back = np.unique(token, return_inverse=True)
        ids, counts = self.words.find(distinct)
        base = np.log10((counts + 1) / (m.tokens + m.words + 1))
        uniform = 1 / (m.words + 1)
        known = ids >= 0
        stats = np.zeros((len(ids), 4), np.int64)
        stats[known] = self._statistics(ids[known])
        seen = stats[:, 0]
        low = np.full(len(ids), m.backoff * uniform)
        if m.pairs:
            cut = np.choose(np.minimum(seen, 3), [0.0, *m.d_word])
            low += np.maximum(seen - cut, 0) / m.pairs
        # what a context gives to the lower order, and how often it occurs
        begin = len(ids)
        give = np.append((stats[:, 1:] * np.array(m.d_pair)).sum(1), 0.0)
        total = np.append(np.where(distinct == END, 0, counts), 0).astype(float)
        if m.words:
            first = self._statistics(np.array([m.words]))[0]
            give[begin] = (first[1:] * np.array(m.d_pair)).sum()
            total[begin] = self.words.find(np.array([END]))[1][0]
        context, word = _pairs(back.astype(np.int64), text, begin)
        all_ids = np.append(ids, m.words)
        pair, where = np.unique(context * (begin + 1) + word, return_inverse=True)
        c, w = pair // (begin + 1), pair % (begin + 1)
        both = (all_ids[c] >= 0) & (ids[w] >= 0) & (m.words > 0)
        found = np.zeros(len(pair), np.int64)
        found[both] = self._pair_counts((all_ids[c[both]].astype(np.uint64) << np.uint64(32)) | ids[w[both]].astype(np.uint64))
        cut = np.choose(np.minimum(found, 3), [0.0, *m.d_pair])
        some = total[c] > 0
        p = np.where(some, (np.maximum(found - cut, 0) + give[c] * low[w]) / np.maximum(total[c], 1), low[w])
        score = np.log10(p)[where]
        return (np.bincount(text, minlength=n), np.bincount(text, counts[back] > 0, n).astype(np.int64),
                np.bincount(text, base[back], n), np.bincount(text, score, n))


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns (plain names), n_tokens, n_known, train_tokens, base_score, score and perplexity of every whole text."""
    from pyspark.sql import types as T

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa
        s = Scorer(model)
        for b in batches:
            for at, end, data, offs in tw.pieces(b.column(len(keep)), PIECE_BYTES):
                tokens, known, base, value = s.texts(data, offs)
                cols = [b.column(i).slice(at, end - at) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    [*cols, pa.array(tokens), pa.array(known), pa.array(np.full(end - at, model.tokens, np.int64)),
                     pa.array(base), pa.array(value), pa.array(10 ** (-value / tokens))],
                    names=[*keep, "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    numbers = [("n_tokens", T.LongType()), ("n_known", T.LongType()), ("train_tokens", T.LongType()),
               ("base_score", T.DoubleType()), ("score", T.DoubleType()), ("perplexity", T.DoubleType())]
    out = T.StructType([*[docs.schema[c] for c in keep], *[T.StructField(n, t) for n, t in numbers]])
    return docs.select(*keep, "text").mapInArrow(scan, out)


def train_and_score(docs: DataFrame, keep: list[str], trains: Column) -> DataFrame:
    """Learn from the rows where ``trains`` holds and score all rows."""
    return score(docs, train(docs.where(trains).select("text")), keep)
