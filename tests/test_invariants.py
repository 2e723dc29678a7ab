"""Invariants and brute-force comparisons on small fixtures."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from edgegraph.operators import components as C
from edgegraph.operators import matching as Ma
from edgegraph.operators import spanner as Sp
from edgegraph.operators import summary as Su
from edgegraph.operators.positions import OrderedFrame, keyed_position, with_position
from edgegraph.sources import cust_edges, user_edges
from tests.conftest import SF_SMALL


def test_with_position_dense_and_ordered(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 50), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k bigint, id bigint")
    got = with_position(df, ["k", "id"], "pos", num_partitions=7).toPandas().sort_values("pos")
    exp = pd.DataFrame(rows, columns=["k", "id"]).sort_values(["k", "id"]).reset_index(drop=True)
    assert got["pos"].tolist() == list(range(1, 3001))
    assert got[["k", "id"]].reset_index(drop=True).equals(exp)


@pytest.mark.parametrize("op", ["sum", "min", "max"])
def test_ordered_frame_hot_key(spark, op):
    # one key holds a third of all rows; partitions split it, carries must join the pieces
    rnd = random.Random(7)
    rows = [(0 if i % 3 == 0 else rnd.randint(1, 40), i, rnd.randint(-5, 9)) for i in range(6000)]
    df = spark.createDataFrame(rows, "k bigint, pos bigint, x bigint")
    got = OrderedFrame(df, ["k"], ["pos"], num_partitions=9).running("r", F.col("x"), op).result().toPandas()
    pdf = pd.DataFrame(rows, columns=["k", "pos", "x"]).sort_values(["k", "pos"])
    pdf["r"] = getattr(pdf.groupby("k")["x"], {"sum": "cumsum", "min": "cummin", "max": "cummax"}[op])()
    m = got.merge(pdf, on=["k", "pos"], suffixes=("", "_e"))
    assert len(m) == 6000 and (m["r"] == m["r_e"]).all()


def test_keyed_position(spark):
    df = spark.createDataFrame([(k % 3, k) for k in range(100)], "g bigint, o bigint")
    got = keyed_position(df, ["g"], ["o"], "rank", num_partitions=5).toPandas()
    for g, part in got.groupby("g"):
        assert sorted(part["rank"]) == list(range(1, len(part) + 1))


def test_components_three_ways_agree(spark):
    e = cust_edges(spark, SF_SMALL)
    a = {tuple(r) for r in C.connected_components(e).collect()}
    b = {tuple(r) for r in C.connected_components_tree(e).collect()}
    c = {tuple(r) for r in C.connected_components_iterative(e).collect()}
    assert a == b == c
    # labels are constant across every edge
    lab = dict(a)
    assert all(lab[r["src"]] == lab[r["trg"]] for r in e.collect())


def test_spanner_invariants(spark):
    e = user_edges(spark, SF_SMALL)
    sp = Sp.spanner(e, 3)
    canon = {(min(r["src"], r["trg"]), max(r["src"], r["trg"])) for r in e.collect() if r["src"] != r["trg"]}
    kept = {(r["src"], r["trg"]) for r in sp.collect()}
    assert kept <= canon
    assert Sp.stretch_check(e, sp, 3).first()["n_violations"] == 0


def _greedy(edges):
    best = {}
    for a, b, w in edges:
        if a == b:
            continue
        key = (min(a, b), max(a, b))
        best[key] = max(best.get(key, w), w)
    used, out = set(), set()
    for (a, b), w in sorted(best.items(), key=lambda kv: (-kv[1], kv[0][0], kv[0][1])):
        if a not in used and b not in used:
            used |= {a, b}
            out.add((a, b, w))
    return out


def test_matching_equals_greedy(spark):
    rnd = random.Random(11)
    rows = [(rnd.randint(0, 40), rnd.randint(0, 40), rnd.randint(1, 30)) for _ in range(300)]
    df = spark.createDataFrame(rows, "src bigint, trg bigint, amount bigint")
    got = {tuple(r) for r in Ma.locally_dominant_matching(df, "amount").collect()}
    assert got == _greedy(rows)
    verts = [v for a, b, _ in got for v in (a, b)]
    assert len(verts) == len(set(verts))


def test_summary_tree_equals_bulk(spark):
    e = user_edges(spark, SF_SMALL)
    spec = Su.edge_stats_spec("amount")
    a = {tuple(r) for r in Su.summarize_bulk(e, "6 hours", spec, buckets=5).collect()}
    b = {tuple(r) for r in Su.summarize_tree(e, "6 hours", spec, buckets=5).collect()}
    assert a == b


def test_matching_of_a_rising_path_is_complete(spark):
    from edgegraph.operators import matching as Ma
    n = 24
    e = spark.createDataFrame([(i, i + 1, 100 + i) for i in range(n)], "src bigint, trg bigint, amount bigint")
    heavy, rounds = Ma._rounds(e, "amount", Ma._heaviest())
    assert sorted(r["src"] for r in heavy.collect()) == list(range(1, n, 2)) and rounds == n // 2
    light, rounds = Ma._rounds(e, "amount", Ma._classes())
    used = [v for r in light.collect() for v in (r["src"], r["trg"])]
    assert len(used) == len(set(used)) and rounds <= 8
    assert all(i in used or i + 1 in used for i in range(n))  # maximal
    best = sum(100 + i for i in range(1, n, 2))
    assert sum(r["weight"] for r in light.collect()) * 4 >= best


def test_bipartiteness_on_negative_and_large_ids(spark):
    from edgegraph.operators import bipartite as B
    mk = lambda *e: spark.createDataFrame(list(e), "src bigint, trg bigint")
    assert B.is_bipartite(mk((-1, -2), (-2, -3), (-3, -1))).first()["bipartite"] is False
    assert B.is_bipartite(mk((-1, -2), (-2, -3), (-3, -4), (-4, -1))).first()["bipartite"] is True
    for a in (2 ** 53 + 1, 2 ** 62 + 1, -(2 ** 62) - 7):
        got = sorted(tuple(r) for r in B.vertex_signs(mk((a, a + 2))).collect())
        assert got == [(a, a, True, False), (a + 2, a, False, False)]
        odd = B.component_bipartite(mk((a, a + 1), (a + 1, a + 2), (a + 2, a), (5, 6))).collect()
        assert {tuple(r) for r in odd} == {(a, False, 3), (5, True, 2)}


def test_spanner_contract_for_every_k(spark):
    from edgegraph.operators import spanner as Sp
    import random
    rng = random.Random(8)
    rows = {(a, b) for a in range(60) for b in range(a) if rng.random() < 0.5}
    e = spark.createDataFrame(list(rows), "src bigint, trg bigint")
    sizes = {}
    for k in (1, 3, 5, 7):
        sp = Sp.spanner(e, k)
        r = Sp.stretch_check(e, sp, k).first()
        assert r["n_violations"] == 0 and r["n_edges"] == len(rows)
        sizes[k] = r["n_spanner_edges"]
    assert sizes[1] == len(rows) and sizes[3] < sizes[1] and sizes[5] < sizes[1]


def test_user_fold_of_a_hub(spark):
    from edgegraph.operators import snapshot as S
    from edgegraph.operators.monoid import Monoid
    from pyspark.sql import functions as F
    rows = [(1, i, (i * 37) % 101 + 1, 0) for i in range(3000)] + [(2, 5, 7, 0)]
    e = spark.createDataFrame(rows, "src bigint, trg bigint, amount bigint, t bigint").withColumn("ts", F.timestamp_millis("t")).drop("t")
    sl = S.slice_edges(e, "1 hour", "out")
    mod = F.lit(1000003).cast("bigint")
    times = Monoid(F.col("amount"), lambda a, b: a * b % mod, zero=F.lit(1))
    got = {r["v"]: r["p"] for r in S.fold_edges(sl, times, name="p", block=8).collect()}
    exp = 1
    for r in rows[:3000]:
        exp = exp * r[2] % 1000003
    assert got == {1: exp, 2: 7}
