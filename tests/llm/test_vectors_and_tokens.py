"""Operators 11 to 13: token ids against the public library, codes and clusters against plain full searches."""

import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from edgegraph.llm import byte_bpe, ns_clusters, vector_codes
from edgegraph.llm import int_vectors as iv
from edgegraph.llm import textwords as tw
from edgegraph.llm.queries import queries
from tests.conftest import SF_SMALL

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def vocab():
    return byte_bpe.load_vocabulary(PATH)


@pytest.fixture(scope="module")
def library(vocab):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocab.ranks, special_tokens={})


def encoded(vocab, texts, limit=byte_bpe.CHUNK_BYTES):
    out = []
    for _, _, data, offs in tw.pieces(pa.array(texts, pa.string()), limit):
        ids, bounds = byte_bpe.encode_texts(vocab, data, offs)
        back, at = byte_bpe.decode_ids(vocab, ids, bounds)
        assert back.tobytes() == data.tobytes() and (at == offs).all()
        out += [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
    return out


# ---- 11 byte-level BPE ----------------------------------------------------------------------------------

def test_ids_match_library_on_hostile_texts(vocab, library):
    rng = random.Random(1)
    bits = ["'s", "'re", "'ll", "'", '"', "a", "S", "é", "漢", "٣", "1", " ", "  ", "\n", "\t", "!", "-", "s", "re", "　", "\x1c", "😀",
            "ß", "ve", "\x85", "<|endoftext|>"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(0, 30))) for _ in range(3000)] + [
        "", None, "a" * 3000, "ab" * 900 + "漢" * 500, " " * 2000, "x" * 512, "x" * 513, "".join(rng.choice("abcdefgh") for _ in range(4000))]
    want = [library.encode_ordinary(t or "") for t in texts]
    assert encoded(vocab, texts) == want and encoded(vocab, texts, 64) == want


def test_every_code_point_falls_into_its_class(vocab, library):
    chars = [chr(i) for i in range(0, 0x110000, 7) if not 0xD800 <= i < 0xE000]
    texts = [f"a{c}1 {c}x'{c}s" for c in chars]
    assert encoded(vocab, texts) == [library.encode_ordinary(t) for t in texts]


def test_matrix_rounds_equal_plain_merging(vocab):
    rng = random.Random(2)
    words = ["".join(rng.choice("aeinrst漢é") for _ in range(rng.randrange(1, 40))).encode() for _ in range(300)]
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    ids, bounds = byte_bpe.encode_matches(vocab, data, ends - [len(w) for w in words], ends)
    for i, w in enumerate(words):
        parts = [w] if w in vocab.ranks else [bytes([b]) for b in w]
        while True:
            ranks = [vocab.ranks.get(a + b, math.inf) for a, b in zip(parts, parts[1:])]
            if min(ranks, default=math.inf) == math.inf:
                break
            k = ranks.index(min(ranks))
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        got = ids[bounds[i]:bounds[i + 1]].tolist()
        assert got == [vocab.ranks[p] for p in parts]
        assert byte_bpe._merge_long(vocab, np.frombuffer(w, np.uint8)).tolist() == got or w in vocab.ranks


def test_token_query_matches_library(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = queries()["op11_byte_bpe"](spark, SF_SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_tokens_defined_results(spark):
    rows = [(1, None), (2, ""), (None, "some words"), (4, "some words"), (4, "some words"), (5, "long " * 50_000)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("ids", F.lit("extra")).withColumn("bytes", F.lit("extra"))
    e = byte_bpe.encode(d, PATH, ["doc_id", "ids", "bytes"])
    back = byte_bpe.decode(e, PATH, ["doc_id", "ids", "bytes"])
    got = [(r["doc_id"], bytes(r["bytes"]).decode()) for r in back.collect()]
    assert sorted(got, key=str) == sorted([(i, t or "") for i, t in rows], key=str)
    assert byte_bpe.decode(byte_bpe.encode(d.limit(0), PATH, ["doc_id"]), PATH, ["doc_id"]).count() == 0
    odd = spark.createDataFrame([(1, None), (2, [0, None]), (3, [10**6]), (4, []), (5, [-1]), (6, [64])], "k int, ids array<int>")
    assert {r["k"]: r["bytes"] and bytes(r["bytes"]) for r in byte_bpe.decode(odd, PATH, ["k"]).collect()} == {
        1: None, 2: None, 3: None, 4: bytearray(), 5: None, 6: next(t for t, i in byte_bpe.load_vocabulary(PATH).ranks.items() if i == 64)}


# ---- 12 and 13: plain full searches ---------------------------------------------------------------------

def plain_rounds(x, centers, rounds):
    """(assignment, squared distances, centres) of rounds of full search in Python integers."""
    x, centers = [list(map(int, r)) for r in x], [list(map(int, r)) for r in centers]
    for i in range(rounds + 1):
        d = [[sum((a - b) ** 2 for a, b in zip(r, c)) for c in centers] for r in x]
        own = [row.index(min(row)) for row in d]
        if i == rounds:
            return own, [min(row) for row in d], centers
        for k in range(len(centers)):
            mine = [r for r, o in zip(x, own) if o == k]
            if mine:
                centers[k] = [sum(c) // len(mine) for c in zip(*mine)]


def vectors(spark, arrays, ids=None, labels=None):
    n = len(arrays)
    rows = list(zip(ids or range(n), [None if a is None else [None if v is None else float(v) for v in a] for a in arrays],
                    labels or [i % 3 for i in range(n)]))
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")


def clumps(n, dims, seed, scale=1.0):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(6, dims))[rng.integers(0, 6, n)] * scale + rng.normal(size=(n, dims)) * scale / 4).round(2)


@pytest.mark.parametrize("entries,rounds,scale", [(8, 5, 1.0), (64, 3, 1.0), (40, 4, 3e4), (3, 2, 1.0)])
def test_codes_equal_full_search(spark, entries, rounds, scale):
    a = clumps(150, 8, entries, scale)
    a[100:] = a[:50]  # ties and repeated rows
    df = vectors(spark, a.tolist()).repartition(3)
    rows, books = vector_codes.compress(df, ["vec_id"], parts=4, entries=entries, rounds=rounds)
    got = {r["vec_id"]: (r["code"], r["error"]) for r in rows.collect()}
    x = np.floor(a * vector_codes.SCALE).astype(np.int64)
    code, error = [""] * len(x), [0] * len(x)
    for p in range(4):
        own, dist, centers = plain_rounds(x[:, 2 * p:2 * p + 2], x[:entries, 2 * p:2 * p + 2], rounds)
        assert books[p].tolist() == centers
        for i in range(len(x)):
            code[i] += f"{own[i]:02x}"
            error[i] += dist[i]
    assert got == {i: (code[i], error[i]) for i in range(len(x))}
    decoded = {r["vec_id"]: r["decoded"] for r in vector_codes.decompress(rows, books).collect()}
    assert all(sum((u - v) ** 2 for u, v in zip(x[i].tolist(), decoded[i])) == error[i] for i in range(len(x)))


def test_code_bounds_save_measurements_and_stay_below_distances():
    x = (clumps(2000, 4, 5) * 256).astype(np.int64)
    book = x[:64]
    rng = np.random.default_rng(1)
    state = vector_codes.search_all(x, book, 8)[:4]
    for _ in range(4):
        new = book + rng.integers(-4, 5, book.shape)
        drift = iv.up(np.sqrt(((new - book) ** 2).sum(1)))
        own, near, low, outer, d, looked = vector_codes.search_bounded(x, new, drift, *state)
        full = iv.square_distances(x, new)
        assert (own == full.argmin(1)).all() and (d == full.min(1)).all()
        true = np.sqrt(full)
        assert (low <= np.take_along_axis(true, near, 1)).all() and (np.diff(low, axis=1) >= 0).all()
        rest = true.copy()
        np.put_along_axis(rest, near, np.inf, 1)
        rest[np.arange(len(x)), own] = np.inf
        assert (outer <= rest.min(1)).all()
        assert (looked >= 0).mean() > 0.5
        b = max(1, int(np.quantile(looked[looked >= 0], 0.99, method="higher")))
        state, book = (own, *vector_codes.shrink(near, low, outer, b)), new


@pytest.mark.parametrize("k,rounds,scale", [(16, 3, 1.0), (5, 8, 1.0), (1, 2, 1.0), (16, 4, 3e4)])
def test_clusters_equal_full_search(spark, k, rounds, scale):
    a = clumps(160, 6, k, scale)
    a[120:] = a[:40]
    df = vectors(spark, a.tolist(), ids=[i * 7 - 300 for i in range(160)]).repartition(3)
    rows, centroids = ns_clusters.cluster(df, ["vec_id"], dims=6, clusters=k, rounds=rounds)
    x = np.floor(a * ns_clusters.SCALE).astype(np.int64)
    first = sorted(range(160), key=lambda i: hashlib.sha256(f"1:{i * 7 - 300}".encode()).hexdigest())[:k]
    own, dist, centers = plain_rounds(x, x[first], rounds)
    assert centroids.tolist() == centers
    assert {r["vec_id"]: (r["cluster"], r["distance"]) for r in rows.collect()} == {i * 7 - 300: (own[i], dist[i]) for i in range(160)}


def test_ns_bounds_save_measurements_and_stay_valid():
    x = (clumps(2000, 16, 3) * 64).astype(np.int64)
    history = x[:16][None]
    state, sn = ns_clusters.evaluate_all(x, history[0], 0), np.zeros(16)
    for _ in range(6):
        sums = iv.Sums(16, 16)
        sums.add(state[0], x)
        new = np.where(sums.count[:, None] > 0, sums.sum // np.maximum(sums.count, 1)[:, None], history[-1])
        sn += np.sqrt(((new - history[-1]) ** 2).sum(1))
        history = np.concatenate([history, new[None]])
        assert (ns_clusters.displacements(history)[0] <= sn + 1e-6).all()
        *state, measured = ns_clusters.evaluate_failures(x, history, *state)
        d = iv.square_distances(x, new)
        assert (state[0] == d.argmin(1)).all()
        way = ns_clusters.displacements(history)
        assert (state[3] - way[state[4], np.arange(16)] <= np.sqrt(d)).all()
        assert (state[1] + way[state[2], state[0]] >= np.sqrt(d.min(1))).all()
    assert measured < 0.5 * d.size


@pytest.mark.parametrize("run", ["codes", "clusters"])
def test_vectors_defined_results(spark, run):
    def go(df):
        if run == "codes":
            rows, _ = vector_codes.compress(df, ["vec_id", "label", "x", "state"], parts=2, entries=4)
            return vector_codes.label_errors(rows)
        rows, centroids = ns_clusters.cluster(df, ["vec_id", "label", "x", "state"], dims=4, clusters=3)
        return ns_clusters.with_inertia(rows, centroids)

    def extra(df):
        for c in ("x", "state", "code", "cluster", "error", "distance", "_k0", "n", "s0"):
            df = df.withColumn(c, F.lit(f"extra {c}"))
        return df

    good = [1, 2, 3, 4]
    arrays = [good, good, None, [1, None, 3, 4], [1, math.nan, 3, 4], [math.inf, 1, 2, 3], [], [1, 2, 3], [1e300, -1e300, 1e30, 0], [0] * 4, [5] * 4, [7] * 4]
    ids = [1, 1, 2, 3, 4, 5, 6, 7, 8, None, None, 10]
    df = extra(vectors(spark, arrays, ids, [None, 1, 1, 1, 1, 1, 1, 1, None, 1, 2, 2]))
    out = go(df).collect()
    assert sorted((r["vec_id"] for r in out), key=str) == sorted([1, 1, 8, None, None, 10], key=str)
    assert all(r["x"] == "extra x" and r["state"] == "extra state" for r in out)
    same = [r for r in out if r["vec_id"] == 1]
    assert len({(r["code"], r["error"]) if run == "codes" else (r["cluster"], r["distance"]) for r in same}) == 1
    if run == "codes":
        for label in (None, 1, 2):
            mine = [r for r in out if r["label"] == label]
            assert {r["label_error"] for r in mine} == {sum(r["error"] for r in mine)}
    else:
        assert {r["inertia"] for r in out} == {sum(r["distance"] for r in out)}
    assert go(df.limit(0)).count() == 0
    assert go(df.where("vec_id in (2, 3)")).count() == 0
    assert go(df.where("vec_id = 10")).count() == 1


def test_no_round_table_stays_behind(spark):
    import glob
    from edgegraph.session import ensure_checkpoint_dir
    root = ensure_checkpoint_dir(spark).replace("file:", "").replace("//", "/")
    before = set(glob.glob(f"{root}/codes-*") + glob.glob(f"{root}/clusters-*"))
    df = vectors(spark, clumps(40, 4, 1).tolist())
    vector_codes.compress(df, [], parts=2, entries=4)[0].count()
    ns_clusters.cluster(df, [], dims=4, clusters=3)[0].count()
    after = set(glob.glob(f"{root}/codes-*") + glob.glob(f"{root}/clusters-*"))
    assert len(after - before) == 2
