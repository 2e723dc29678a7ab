"""Plans and operators whose cost has to follow the input."""

import random
import re

import pytest

from edgegraph.operators import degrees as D
from edgegraph.operators import matching as Ma
from edgegraph.operators import paths as Pa
from edgegraph.operators import spanner as Sp
from edgegraph.operators import triangles as Tr


def edges(spark, rows):
    return spark.createDataFrame(rows, "src bigint, trg bigint")


def test_one_sketch_for_all_vertices(spark):
    e = edges(spark, [(1, 2), (2, 3), (1, 2), (None, 4)])
    got = D.vertex_count_checked(e)
    assert [tuple(r) for r in got.collect()] == [(4, True)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    keyed = re.findall(r"Aggregate\(keys=\[[^\]]+\], functions=\[[^\]]*approx_count_distinct", plan)
    assert "approx_count_distinct" in plan and not keyed


def _random_graph(spark, n, m, seed):
    rng = random.Random(seed)
    return edges(spark, [(rng.randrange(n), rng.randrange(n)) for _ in range(m)])


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5])
def test_beyond_k_is_what_within_k_misses(spark, k, monkeypatch):
    monkeypatch.setattr(Pa, "HUBS", 3)
    e = _random_graph(spark, 150, 210, k)
    asked = _random_graph(spark, 170, 600, 10 + k).toDF("a", "b")
    asked = asked.unionByName(asked.limit(5))
    want = {tuple(r) for r in Pa.within_k(e, asked, k).where("NOT reachable").select("a", "b").collect()}
    got = [tuple(r) for r in Pa.beyond_k(e, asked, k).collect()]
    assert len(got) == len(set(got)) and set(got) == want and want


def test_stretch_check_counts_long_edges(spark):
    ring = edges(spark, [(i, (i + 1) % 9) for i in range(9)])
    r = Sp.stretch_check(ring, ring.where("src < 8"), 3).first()
    assert (r["n_edges"], r["n_spanner_edges"], r["n_violations"]) == (9, 8, 1)


def test_stretch_check_does_not_spread_the_last_level(spark, monkeypatch):
    """The pairs of a clustered spanner are settled by its hubs: no ball of every vertex is grown."""
    grown = []
    ball = Pa._ball
    monkeypatch.setattr(Pa, "_ball", lambda adj, numbered, k: grown.append((numbered.count(), k)) or ball(adj, numbered, k))
    e = _random_graph(spark, 200, 6000, 5)
    r = Sp.stretch_check(e, Sp.spanner(e, 3), 3).first()
    assert r["n_violations"] == 0 and r["n_spanner_edges"] < r["n_edges"]
    assert grown and all(k == 2 for _, k in grown)
    assert sum(n for n, _ in grown) < 200


def test_look_ups_away_from_hubs_grow_no_balls(spark, monkeypatch):
    """Without a cluster's hub, lists of neighbours travel instead of a row for every vertex of every source's ball."""
    grown = []
    ball = Pa._ball
    monkeypatch.setattr(Pa, "_ball", lambda adj, numbered, k: grown.append(numbered.count()) or ball(adj, numbered, k))
    monkeypatch.setattr(Pa, "HUBS", 3)
    e, asked = _random_graph(spark, 150, 210, 3), _random_graph(spark, 170, 600, 13).toDF("a", "b")
    assert Pa.beyond_k(e, asked, 3).count() > 0
    assert sum(grown) <= 3


@pytest.mark.parametrize("k", [2, 3])
@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_beyond_k_with_cut_lists_small_batches_and_wide_vertices(spark, k, kind, monkeypatch):
    for name, value in (("HUBS", 1), ("LIST_ROW", 2), ("LIST_DEGREE", 4), ("TASK_IDS", 500)):
        monkeypatch.setattr(Pa, name, value)
    rng = random.Random(k)
    rows = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)]
    rows += [(1000 + h, rng.randrange(300)) for h in range(3) for _ in range(90 - 10 * h)] + [(None, 5), (7, 7), (8, None)]
    pairs = [(rng.randrange(320), rng.randrange(320)) for _ in range(400)] + [(1001, 1002), (1002, 3), (4, 1001)]
    cast = [f"cast({c} as {kind}) {c}" for c in ("src", "trg")]
    e, p = edges(spark, rows).selectExpr(*cast), edges(spark, pairs).selectExpr(*cast).toDF("a", "b")
    want = {tuple(r) for r in Pa.within_k(e, p, k).where("NOT reachable").select("a", "b").collect()}
    wide = []
    seen = Pa._seen
    monkeypatch.setattr(Pa, "_seen", lambda *a: wide.append(1) or seen(*a))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        nulls = spark.createDataFrame([(None, "5"), ("6", None)], "a string, b string").selectExpr(f"cast(a as {kind}) a", f"cast(b as {kind}) b")
        got = [tuple(r) for r in Pa.beyond_k(e, p.unionByName(nulls), k).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    typed = {"bigint": int, "string": str}[kind]
    assert len(got) == len(set(got)) and set(got) == want | {(None, typed(5)), (typed(6), None)}
    assert 0 < len(want) < len(set(pairs)) and len(wide) == (k == 3)


def test_triangles_are_found_once(spark, monkeypatch):
    """Vertices' counts and the total come from one pass: the second reading of the triangles would be a second search."""
    marks = spark.sparkContext.accumulator(0)
    closing = Tr.closing_vertices

    def counted(canon):
        cv = closing(canon, method="lists")

        def tell(batches):
            for b in batches:
                marks.add(b.num_rows)
                yield b
        return cv.mapInArrow(tell, cv.schema)

    monkeypatch.setattr(Tr, "closing_vertices", counted)
    got = dict(tuple(r) for r in Tr.local_triangles(edges(spark, [(1, 2), (2, 3), (3, 1), (3, 4), (4, 1), (5, 6)])).collect())
    assert got == {1: 2, 2: 1, 3: 2, 4: 1, -1: 2}
    assert marks.value == 2


def test_a_vertex_carries_one_priority(spark):
    """Rows that are sorted per vertex hold the edge once, as the priority's last two parts."""
    live = spark.createDataFrame([(1, 2, 5), (2, 3, 5), (3, 4, 1)], "a bigint, b bigint, w bigint")
    for priority in (Ma._heaviest(), Ma._classes()):
        got = Ma._mutual(live, priority)
        assert len(got.collect()) >= 1
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "max_by" not in plan
    assert [tuple(r)[:2] for r in Ma._mutual(live, Ma._heaviest()).collect()] == [(1, 2)]
