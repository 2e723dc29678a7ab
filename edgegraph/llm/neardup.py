"""Near-duplicate documents by MinHash.

Method: a document is the set of its distinct 5-word shingles. Equal sets form one class, and only class representatives go
on. A representative posts its ``COORDS`` MinHash values as (coordinate, value) tokens. Prefix merging: two signatures
that agree in at least as many coordinates as :func:`match_threshold` asks share a token among the rarest of each, so only
those are posted; tokens that nobody else has fill the prefix for free, and frequent ones are skipped. Collisions are
then counted over the whole signatures, pairs above the match threshold are kept, and every link is confirmed on the
full shingle sets.

A posting list isn't expanded to pairs of rows. The member of a list whose values are the commonest is its hub (the text that
others are copies of), and lists with one hub are merged, so a group of copies becomes one list and not one per coordinate. A
list is cut into blocks of bounded bytes, each with the hub beside it. Documents that no estimate pairs with another are dropped; the others
meet in their block with their sets: a task compares signatures in numpy, confirms promising pairs of different components on the
sets, the likeliest first, and returns the links that joined two components, fewer than it has documents. Lists of several
blocks that still hold different components then compare blocks at growing distance, ``STEPS`` distances a round; after each
round the labels are renewed and settled lists leave. Pairs that are ruled out never become rows, and none is skipped but those inside
one component.

Defined results: null or blank text has an empty set, no links and is its own component; fewer than five words count as
one shingle; a null doc_id can link others and has the smallest non-null id of its component, or null; rows with
the same doc_id and text get the same answer; an empty table gives an empty result; extra columns are carried through by
:func:`drop_copies`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edgegraph.llm import textwords as tw
from edgegraph.llm.tables import ckpt
from edgegraph.operators.components import connected_components
from edgegraph.operators.positions import OrderedFrame

SHINGLE = 5
COORDS = 64
MISS = 1e-6
BINS = 256
# Four standard deviations of a 256-bin estimate at a similarity of 0.5, five at 0.8 and more.
SLACK = 0.125
BLOCK_BYTES = 1 << 24
STEPS = 4
_A = tw.mix64(np.arange(1, COORDS + 1, dtype=np.uint64)) | np.uint64(1)
_B = tw.mix64(np.arange(1001, COORDS + 1001, dtype=np.uint64))


def match_threshold(percent: int) -> int:
    """Coordinates that must agree: at this similarity fewer do with a probability of at most ``MISS``."""
    p, below, m = percent / 100, 0.0, 0
    while m < COORDS:
        below += math.comb(COORDS, m) * p ** m * (1 - p) ** (COORDS - m)
        if below > MISS:
            break
        m += 1
    return max(1, m)


def shingle_sets(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, bounds)``: text i's distinct shingles, ascending, are ``hashes[bounds[i]:bounds[i + 1]]``."""
    n = len(offs) - 1
    starts, ends, text = tw.words(data, offs)
    word = tw.hashes(data, starts, ends)
    h, at = tw.windows(word, text, SHINGLE)
    owner = text[at]
    count = np.bincount(text, minlength=n)
    first = np.concatenate([[0], np.cumsum(count)])
    for i in np.flatnonzero((count > 0) & (count < SHINGLE)):  # one shingle of fewer words
        one, _ = tw.windows(word[first[i]:first[i + 1]], np.zeros(count[i], np.int64), int(count[i]))
        h, owner = np.append(h, one), np.append(owner, i)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[new], owner[new]
    return h, np.searchsorted(owner, np.arange(n + 1))


def _sketch(batches: Iterator) -> Iterator:
    import pyarrow as pa
    for b in batches:
        ids, texts, t = b.column(0), b.column(1), b.column(2)
        for at, end, data, offs in tw.pieces(texts):
            h, bounds = shingle_sets(data, offs)
            n = np.diff(bounds)
            full = np.flatnonzero(n > 0)
            sig = np.zeros((end - at, COORDS), np.uint32)
            oph = np.zeros((end - at, BINS), np.uint8)
            s1, s2 = _digests(h, bounds)
            if len(full):
                seg = bounds[full]
                for k in range(COORDS):
                    sig[full, k] = np.minimum.reduceat(h * _A[k] + _B[k], seg) >> np.uint64(32)
                owner = np.repeat(np.arange(end - at), n)
                cell = owner * BINS + (h >> np.uint64(56)).astype(np.int64)
                head = np.ones(len(h), bool)  # hashes ascend within a text: the first of a bin is its minimum
                head[1:] = cell[1:] != cell[:-1]
                oph.reshape(-1)[cell[head]] = (h[head] >> np.uint64(48)).astype(np.uint8) | np.uint8(1)
            yield pa.RecordBatch.from_arrays([
                ids.slice(at, end - at), t.slice(at, end - at), pa.array(n.astype(np.int64)), pa.array(s1), pa.array(s2),
                pa.array([r.tobytes() for r in sig], pa.binary()),
                pa.array([r.tobytes() for r in oph], pa.binary())], names=["doc_id", "t", "n", "s1", "s2", "sig", "oph"])


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, t (hash of the text), n (set size), s1, s2 (order-free digest of the set), sig (MinHash values), oph (binned
    minima)."""
    return docs.select(F.col("doc_id").cast("bigint"), "text", F.xxhash64("text")).mapInArrow(
        _sketch, "doc_id bigint, t bigint, n bigint, s1 bigint, s2 bigint, sig binary, oph binary")


def _tokens(batches: Iterator) -> Iterator:
    """rep, c (coordinate), v (value) of every signature."""
    import pyarrow as pa
    for b in batches:
        for at in range(0, b.num_rows, 4096):
            part = b.slice(at, 4096)
            sig = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint32).reshape(-1, COORDS)
            rep = np.repeat(part.column(0).to_numpy(), COORDS)
            c = np.tile(np.arange(COORDS, dtype=np.int64), len(sig))
            yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array((c << 32) | sig.reshape(-1).astype(np.int64))],
                                             names=["rep", "token"])


def postings(reps: DataFrame, match: int) -> DataFrame:
    """token, rep, weight: the prefix tokens that another representative has as well; weight adds up how many have each of the
    representative's values."""
    tokens = reps.select("rep", "sig").mapInArrow(_tokens, "rep bigint, token bigint")
    df = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = tokens.join(df, "token")
    per_rep = Window.partitionBy("rep")
    prefix = COORDS - match + 1
    return (shared.withColumn("alone", COORDS - F.count(F.lit(1)).over(per_rep)).withColumn("weight", F.sum("df").over(per_rep))
            .withColumn("rank", F.row_number().over(per_rep.orderBy("df", "token")))
            .where(F.col("alone") + F.col("rank") <= prefix).select("token", "rep", "weight"))


def _estimate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Similarity from two rows, or broadcast stacks, of binned minima."""
    used = ((x > 0) | (y > 0)).sum(-1)
    return ((x == y) & (x > 0)).sum(-1) / np.maximum(used, 1)


def _digests(h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two order-free 64-bit digests of each set; 0 for an empty one."""
    full = np.flatnonzero(np.diff(bounds) > 0)
    s1, s2 = np.zeros(len(bounds) - 1, np.uint64), np.zeros(len(bounds) - 1, np.uint64)
    if len(full):
        s1[full] = np.add.reduceat(tw.mix64(h ^ np.uint64(0x5851F42D4C957F2D)), bounds[full])
        s2[full] = np.add.reduceat(tw.mix64(h * _A[0]), bounds[full])
    return s1.view(np.int64), s2.view(np.int64)


def _sets(batches: Iterator) -> Iterator:
    import pyarrow as pa
    for b in batches:
        for _, _, data, offs in tw.pieces(b.column(0)):
            h, bounds = shingle_sets(data, offs)
            s1, s2 = _digests(h, bounds)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.diff(bounds).astype(np.int64)), pa.array(s1), pa.array(s2),
                pa.array([h[x:y].tobytes() for x, y in zip(bounds[:-1], bounds[1:])], pa.binary())],
                names=["n", "s1", "s2", "set"])


def _groups(batches: Iterator, keys: int) -> Iterator:
    """Consecutive rows with equal first ``keys`` columns, as tables, across batch borders."""
    import pyarrow as pa
    held: list = []
    held_key = None
    for b in batches:
        if not b.num_rows:
            continue
        k = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(keys)], 1)
        cuts = np.concatenate([[0], np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1, [len(k)]])
        for x, y in zip(cuts[:-1], cuts[1:]):
            key = tuple(k[x])
            if held and key != held_key:
                yield pa.Table.from_batches(held)
                held = []
            held_key = key
            held.append(b.slice(x, y - x))
    if held:
        yield pa.Table.from_batches(held)


def _stack(column, dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


def _promising(x, y, n, sig, oph, similarity: float, match: int) -> np.ndarray:
    """Which aligned pairs (x may be one row) may be links: by set size, agreeing coordinates and the binned estimate."""
    ok = np.minimum(n[x], n[y]) >= np.maximum(n[x], n[y]) * (similarity - 1e-9)
    ok[ok] = (sig[y[ok]] == sig[x[ok] if np.ndim(x) else x]).sum(-1) >= match
    ok[ok] = _estimate(oph[y[ok]], oph[x[ok] if np.ndim(x) else x]) >= similarity - SLACK
    return ok


def _live(batches: Iterator, similarity: float, match: int) -> Iterator:
    """Lists of (hub, rep, n, sig, oph) -> hub, rep of the members that may be linked with another member."""
    import pyarrow as pa
    for t in _whole_lists(batches):
        hub, rep, n = (t.column(i).to_numpy() for i in range(3))
        sig, oph = _stack(t.column(3), np.uint32, COORDS), _stack(t.column(4), np.uint8, BINS)
        cuts = np.concatenate([[0], np.flatnonzero(hub[1:] != hub[:-1]) + 1, [len(hub)]])
        live = np.zeros(len(hub), bool)
        end = np.repeat(cuts[1:], np.diff(cuts))
        for step in range(1, int(np.diff(cuts).max())):  # members at this distance in their lists
            x = np.arange(len(hub) - step)
            x = x[x + step < end[x]]
            for at in range(0, len(x), 1 << 14):
                a = x[at:at + (1 << 14)]
                a = a[~(live[a] & live[a + step])]
                ok = _promising(a, a + step, n, sig, oph, similarity, match)
                live[a[ok]] = live[a[ok] + step] = True
        yield pa.RecordBatch.from_arrays([pa.array(hub[live]), pa.array(rep[live])], names=["hub", "rep"])


def _whole_lists(batches: Iterator) -> Iterator:
    """The rows in tables that end where a list (first column) ends."""
    import pyarrow as pa
    held: list = []
    held_key = None
    for b in batches:
        if not b.num_rows:
            continue
        key = b.column(0).to_numpy()
        if held and held_key != key[0]:
            yield pa.Table.from_batches(held)
            held = []
        change = np.flatnonzero(key[1:] != key[:-1])
        if len(change):
            held.append(b.slice(0, int(change[-1]) + 1))
            yield pa.Table.from_batches(held)
            held, b = [], b.slice(int(change[-1]) + 1)
        held.append(b)
        held_key = key[-1]
    if held:
        yield pa.Table.from_batches(held)


def _joining_links(side, n, comp, sig, oph, shingles, bounds, percent: int, match: int) -> list[tuple[int, int]]:
    """Confirmed links (row numbers) that connect exactly what all links between the two sides connect, given components. Rows
    with the commonest values come first, so that the links of a hub settle its copies before they are compared."""
    similarity = percent / 100
    _, word = np.unique(shingles, return_inverse=True)
    mark = np.zeros(len(word) + 1, bool)
    _, label = np.unique(comp, return_inverse=True)
    common = np.zeros(len(n), np.int64)
    for c in range(COORDS):
        _, at, times = np.unique(sig[:, c], return_inverse=True, return_counts=True)
        common += times[at]
    order = np.argsort(-common, kind="stable")
    left = order[side[order] == 0]
    right = order[side[order] == 1]
    within = not len(right)
    out: list[tuple[int, int]] = []
    for k, x in enumerate(left.tolist()):
        y = left[k + 1:] if within else right
        y = y[label[y] != label[x]]
        if not len(y):
            continue
        y = y[_promising(x, y, n, sig, oph, similarity, match)]
        if not len(y):
            continue
        y = y[np.argsort(-_estimate(oph[y], oph[x]), kind="stable")]
        mine = word[bounds[x]:bounds[x + 1]]
        mark[mine] = True
        take = 1
        while len(y):
            some, y = y[:take], y[take:]
            length = bounds[some + 1] - bounds[some]
            ends = np.cumsum(length)
            cells = np.arange(ends[-1]) + np.repeat(bounds[some] - (ends - length), length)
            both = np.add.reduceat(mark[word[cells]].astype(np.int64), ends - length)
            for z in some[100 * both >= percent * (n[x] + n[some] - both)].tolist():
                if label[z] != label[x]:
                    out.append((x, z))
                    label[label == label[z]] = label[x]
            y = y[label[y] != label[x]]
            take = min(take * 4, 256)
        mark[mine] = False
        if label.max() == label.min():
            break
    return out


def _block_links(batches: Iterator, percent: int, match: int) -> Iterator:
    """Rows (hub, bi, bj, side, rep, n, comp, sig, oph, set) of one pair of blocks (or one block) at a time -> src, trg."""
    import pyarrow as pa
    for t in _groups(batches, 3):
        if t.num_rows < 2:
            continue
        side, rep, n, comp = (t.column(x).to_numpy() for x in ("side", "rep", "n", "comp"))
        sig, oph = _stack(t.column("sig"), np.uint32, COORDS), _stack(t.column("oph"), np.uint8, BINS)
        shingles = np.frombuffer(b"".join(t.column("set").to_pylist()), np.uint64)
        found = _joining_links(side, n, comp, sig, oph, shingles, np.concatenate([[0], np.cumsum(n)]), percent, match)
        if found:
            a, b = np.array(found).T
            yield pa.RecordBatch.from_arrays([pa.array(rep[a]), pa.array(rep[b])], names=["src", "trg"])


def _meet(rows: DataFrame, features: DataFrame, labels: DataFrame | None, percent: int) -> DataFrame:
    """Links (src, trg) found between the blocks that ``rows`` (hub, bi, bj, side, rep) bring together."""
    rows = rows.join(features, "rep")
    if labels is None:
        rows = rows.withColumn("comp", F.col("rep"))
    else:
        rows = rows.join(labels.withColumnRenamed("v", "rep"), "rep", "left").withColumn("comp", F.coalesce("component", "rep"))
    rows = (rows.select("hub", "bi", "bj", "side", "rep", "n", "comp", "sig", "oph", "set")
            .repartition("hub", "bi", "bj").sortWithinPartitions("hub", "bi", "bj", "side", "rep"))
    match = match_threshold(percent)
    return ckpt(rows.mapInArrow(lambda it: _block_links(it, percent, match), "src bigint, trg bigint"))


def _forest(labels: DataFrame) -> DataFrame:
    return labels.where("v <> component").select(F.col("v").alias("src"), F.col("component").alias("trg"))


def link_labels(docs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """v, component: the components of all confirmed links between representatives (rep, doc, n, s1, s2, sig, oph)."""
    similarity, match = percent / 100, match_threshold(percent)
    posts = ckpt(postings(reps, match))
    hubs = (posts.groupBy("token").agg(F.max_by("rep", F.struct("weight", "rep")).alias("hub"), F.count(F.lit(1)).alias("k"))
            .where("k > 1").drop("k"))
    member = posts.join(hubs, "token").groupBy("hub", "rep").agg((-F.max("weight")).alias("light"))
    cost = (F.col("n") * 8 + 4096).cast("bigint")
    member = OrderedFrame(member.join(reps.select("rep", "n"), "rep").withColumn("cost", cost), ["hub"], ["light", "rep"])
    member = ckpt(member.running("bytes", "cost", "sum").result()
                  .select("hub", "rep", F.expr(f"(bytes - cost) div {BLOCK_BYTES}").alias("block")))
    long = ckpt(member.where("block > 0").groupBy("hub").agg(F.max("block").alias("last")))
    short = (member.join(long, "hub", "left_anti").join(reps.select("rep", "n", "sig", "oph"), "rep").select("hub", "rep", "n", "sig", "oph")
             .repartition("hub").sortWithinPartitions("hub", "rep"))
    live = ckpt(short.mapInArrow(lambda it: _live(it, similarity, match), "hub bigint, rep bigint").withColumn("block", F.lit(0).cast("bigint"))
                .unionByName(member.join(long, "hub", "left_semi")))
    chosen = reps.join(live.select("rep").distinct(), "rep", "left_semi")
    sets = (docs.select(_doc().alias("doc"), "text").join(chosen.select("doc"), "doc", "left_semi").select("text")
            .mapInArrow(_sets, "n bigint, s1 bigint, s2 bigint, set binary"))
    features = ckpt(sets.join(chosen.select("rep", "n", "s1", "s2", "sig", "oph"), ["n", "s1", "s2"])
                    .groupBy("rep").agg(*[F.first(c).alias(c) for c in ("n", "sig", "oph", "set")]))
    # every block by itself, with its list's hub
    beside = long.select("hub", F.explode(F.sequence(F.lit(1).cast("bigint"), "last")).alias("block")).withColumn("rep", F.col("hub"))
    rows = live.unionByName(beside).distinct().select("hub", F.col("block").alias("bi"), F.col("block").alias("bj"), F.lit(0).alias("side"), "rep")
    labels = connected_components(_meet(rows, features, None, percent))
    # blocks of one list at growing distance
    step, most = 1, long.agg(F.max("last")).first()[0] or 0
    while step <= most:
        comp = member.join(long.where(F.col("last") >= step), "hub").join(labels.withColumnRenamed("v", "rep"), "rep", "left").select(
            "hub", "block", "rep", F.coalesce("component", "rep").alias("comp"))
        blocks = ckpt(comp.groupBy("hub", "block").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")))
        other = blocks.select("hub", F.col("block").alias("bj"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
        pairs = (blocks.select("hub", F.col("block").alias("bi"), "lo", "hi",
                               F.explode(F.expr(f"transform(sequence({step}, {step + STEPS - 1}), d -> block + d)")).alias("bj"))
                 .join(other, ["hub", "bj"]).where(~((F.col("lo") == F.col("hi2")) & (F.col("hi") == F.col("lo2")))).select("hub", "bi", "bj"))
        sides = [pairs.select("*", F.col(c).alias("block"), F.lit(i).alias("side")) for i, c in enumerate(("bi", "bj"))]
        rows = sides[0].unionByName(sides[1]).join(member, ["hub", "block"]).select("hub", "bi", "bj", "side", "rep")
        labels = connected_components(_forest(labels).unionByName(_meet(rows, features, labels, percent)))
        step += STEPS
    return labels


def _doc():
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)).cast("bigint"))


def components(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, t (hash of the text), n_shingles, component_id, kept for every row: linked are documents with 100 * intersection >= ``percent`` *
    union; component_id is the smallest doc_id reachable."""
    return _survivors(docs, percent).drop("stays")


def _survivors(docs: DataFrame, percent: int) -> DataFrame:
    """:func:`components` with ``stays``: the rows of the component's first (doc_id, t), null ids last."""
    sk = ckpt(sketches(docs))
    key = ["n", "s1", "s2"]
    # rep: the class; doc: a document that holds its text
    classes = ckpt(sk.where("n > 0").groupBy(*key).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "t")).alias("least"), F.min(_doc()).alias("doc"), F.first("sig").alias("sig"),
        F.first("oph").alias("oph"), F.count(F.lit(1)).alias("size")).withColumn("rep", F.monotonically_increasing_id()))
    labels = ckpt(link_labels(docs, classes.select("rep", "doc", *key, "sig", "oph"), percent))
    labels = classes.select("rep", "least").join(labels.withColumnRenamed("v", "rep"), "rep")
    ids = labels.groupBy("component").agg(F.min("least").alias("id"))
    named = (classes.join(labels.join(ids, "component").select("rep", "id"), "rep", "left")
             .where("size > 1 OR id IS NOT NULL").select(*key, F.coalesce("id", "least").alias("id")))
    return (sk.select("doc_id", "t", *key).join(named, key, "left")
            .select("doc_id", "t", F.col("n").alias("n_shingles"), F.coalesce("id.doc_id", "doc_id").alias("component_id"),
                    (F.col("id").isNull() | (F.col("doc_id").eqNullSafe(F.col("id.doc_id")) & (F.col("t") == F.col("id.t"))))
                    .alias("stays"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def drop_copies(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, the first by doc_id (null ids last) and hash of the text, all
    columns unchanged. Of rows that agree in doc_id and text one is kept."""
    c = ckpt(_survivors(docs, percent))
    key = ["_doc", "_t"]
    gone = c.where(~F.col("stays")).select(_doc().alias("_doc"), F.col("t").alias("_t")).distinct()
    stay = docs.select(F.struct(*docs.columns).alias("_row"), _doc().alias("_doc"), F.xxhash64("text").alias("_t")).join(
        gone, key, "left_anti")
    if c.where("stays").groupBy("doc_id").count().where("count > 1").limit(1).count():
        stay = stay.dropDuplicates(key)
    return stay.select("_row.*")
