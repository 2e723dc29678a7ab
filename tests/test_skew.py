"""Hot keys (one key holding a third of all rows) against brute force on small fixtures."""

import itertools
import random

import pandas as pd
from pyspark.sql import functions as F

from edgegraph.operators import components as C
from edgegraph.operators import degrees as D
from edgegraph.operators import patterns as P
from edgegraph.operators import triangles as Tr


def _skewed_edges(n=3000, hot=0, seed=5, vertices=60):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        src = hot if i % 3 == 0 else rnd.randint(1, vertices)
        trg = rnd.randint(1, vertices)
        if trg == src:
            trg = (trg % vertices) + 1
        rows.append((src, trg, rnd.randint(1, 5) * 100000, 1_700_000_000_000 + rnd.randint(0, 3) * 86_400_000 + rnd.randint(0, 60000), i + 1))
    return rows


def test_fraud_with_hot_payer(spark):
    rows = _skewed_edges()
    df = spark.createDataFrame(rows, "src bigint, trg bigint, amount bigint, t bigint, pos bigint") \
        .select("src", "trg", "amount", F.timestamp_millis("t").alias("ts"), "pos")
    rule = P.MoneyMovement(window="1 day", min_amount=500000, min_payees=5, max_payees=200, min_span_ms=1000)
    got = {(r["w_start"], r["payer"], r["payees"], r["total_amount"]) for r in P.money_movement_alerts(df, rule).collect()}
    pdf = pd.DataFrame(rows, columns=["src", "trg", "amount", "t", "pos"]).drop(columns="pos").drop_duplicates()
    pdf["w"] = pdf["t"] - pdf["t"] % 86_400_000
    exp = set()
    for (w, s), g in pdf.groupby(["w", "src"]):
        payees, total, span = g["trg"].nunique(), g["amount"].sum(), g["t"].max() - g["t"].min()
        if total >= 500000 and 5 <= payees <= 200 and span >= 1000:
            exp.add((w, s, payees, total))
    assert got == exp and any(p == 0 for _, p, _, _ in got)


def test_triangles_with_hub(spark):
    rows = _skewed_edges(n=1500, vertices=40)
    df = spark.createDataFrame([(a, b) for a, b, *_ in rows], "src bigint, trg bigint")
    edges = {(min(a, b), max(a, b)) for a, b, *_ in rows if a != b}
    adj = {}
    for a, b in edges:
        adj.setdefault(a, set()).add(b)
        adj.setdefault(b, set()).add(a)
    exp = sum(1 for a, b in edges for c in adj[a] & adj[b] if c > b)
    assert Tr.triangle_count(df).first()["triangles"] == exp
    local = {r["v"]: r["triangles"] for r in Tr.local_triangles(df).collect()}
    tri = [(a, b, c) for a, b in edges for c in adj[a] & adj[b] if c > b]
    hub = sum(1 for t in tri if 0 in t)
    assert local.get(0, 0) == hub and local[-1] == exp


def test_degree_changelog_hot_vertex(spark):
    rows = _skewed_edges()
    df = spark.createDataFrame([(a, b, p) for a, b, _, _, p in rows], "src bigint, trg bigint, pos bigint")
    got = D.degree_changelog(df).where("v = 0").agg(F.max("degree"), F.count(F.lit(1))).first()
    assert got[0] == got[1] == 1000


def test_components_star_hub(spark):
    # one hub joined to everything plus a separate path
    rows = [(0, v) for v in range(1, 2000)] + list(itertools.pairwise(range(5000, 5100)))
    df = spark.createDataFrame(rows, "src bigint, trg bigint")
    sizes = {r["component"]: r["size"] for r in C.component_sizes(C.connected_components(df)).collect()}
    assert sizes == {0: 2000, 5000: 100}
