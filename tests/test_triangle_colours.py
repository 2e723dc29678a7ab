"""Triangles by colours of vertices: the same triangles as by out-lists, cells of bounded size, on skewed graphs."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from edgegraph.operators import triangles as Tr


def _power_law(n=400, m=3, seed=1):
    """Preferential attachment with a hub that every third vertex joins."""
    rnd = random.Random(seed)
    ends, edges = [0, 1], {(0, 1)}
    for v in range(2, n):
        for t in {rnd.choice(ends) for _ in range(m)} | ({0} if v % 3 == 0 else set()):
            if t != v:
                edges.add((min(t, v), max(t, v)))
                ends += [t, v]
    return sorted(edges)


def _brute(edges):
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    return {tuple(sorted((a, b, x))) for a, b in edges for x in near[a] & near[b]}


def _found(cv):
    rows = [tuple(sorted((r["u"], r["w"], x))) for r in cv.collect() for x in r["xs"]]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("cell", [1 << 20, 2000, 600])
def test_colours_equal_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(Tr, "CELL", cell)
    monkeypatch.setattr(Tr, "PROBES", 50)
    edges = _power_law()
    df = spark.createDataFrame([(b, a) for a, b in edges] + edges[:50] + [(5, 5)], "src bigint, trg bigint")
    canon = Tr.canonical_edges(df)
    got = _found(Tr.closing_vertices(canon, method="colours"))
    assert got == _brute(edges) and len(got) > 100


def test_groups_are_apart(spark, monkeypatch):
    monkeypatch.setattr(Tr, "CELL", 60)
    rnd = random.Random(4)
    rows = [(f"g{g}", *sorted(rnd.sample(range(-20, 20), 2))) for g in range(3) for _ in range(60 * (g + 1))]
    df = spark.createDataFrame(rows, "g string, src bigint, trg bigint").withColumn("g", F.struct("g", F.lit(1).alias("n")))
    canon = Tr.canonical_edges(df, ["g"])
    got = {}
    for r in Tr.closing_vertices(canon, ["g"], method="colours").collect():
        got.setdefault(r["g"]["g"], set()).update(tuple(sorted((r["u"], r["w"], x))) for x in r["xs"])
    assert got == {g: _brute({e[1:] for e in rows if e[0] == g}) for g in ("g0", "g1", "g2")}


def test_no_edges_and_no_triangles(spark):
    for rows in ([], [(1, 2), (2, 3)], [(1, 1)]):
        df = spark.createDataFrame(rows, "src bigint, trg bigint")
        assert Tr.closing_vertices(Tr.canonical_edges(df), method="colours").count() == 0


def test_a_clique_chooses_colours_and_a_path_lists(spark):
    clique = spark.createDataFrame(list(itertools.combinations(range(40), 2)), "src bigint, trg bigint")
    path = spark.createDataFrame([(i, i + 1) for i in range(40)], "src bigint, trg bigint")

    def plan(df):
        return Tr.closing_vertices(Tr.canonical_edges(df))._jdf.queryExecution().optimizedPlan().toString()

    assert "FlatMapGroupsInArrow" in plan(clique) and "FlatMapGroupsInArrow" not in plan(path)
    assert Tr.triangle_count(clique).first()["triangles"] == 40 * 39 * 38 // 6


def test_cell_bound():
    for edges, hub in ((10, 3), (10 ** 7, 10 ** 4), (10 ** 9, 10 ** 6), (10 ** 9, 3 * 10 ** 8)):
        rho = Tr.colours_for(edges, hub)
        assert 3 * edges / rho ** 2 + 2 * hub / rho <= Tr.CELL * 1.001
