"""Matching and spanner on a stream, and many-source search, against brute force."""

import itertools
import os
import random

import pytest
from pyspark.sql import functions as F

from edgegraph.operators import matching as Ma
from edgegraph.operators import paths as Pa
from edgegraph.operators import spanner as Sp
from edgegraph.streaming import MatchingStream, SpannerStream

EDGES = "src bigint, trg bigint, amount double"


def _best(edges):
    if not edges:
        return 0.0
    (a, b, w), rest = edges[0], edges[1:]
    return max(_best(rest), w + _best([e for e in rest if not {a, b} & set(e[:2])]))


def test_matching_stream_events_disjointness_factor_and_replay(spark, tmpdir_path):
    rng = random.Random(7)
    for trial in range(2):
        edges = [(a, b, rng.choice([0.3, 1, 2.5, 7, 20]) * rng.random()) for a, b in itertools.combinations(range(8), 2) if rng.random() < 0.5]
        rng.shuffle(edges)
        s = MatchingStream(spark, os.path.join(tmpdir_path, f"m{trial}"))
        for i in range(3):
            part = spark.createDataFrame(edges[i::3] + [(1, 1, 99.0), (None, 2, 50.0)], EDGES)
            s.update(part, i)
            before = {tuple(r) for r in s.results().collect()}, s.events().count()
            s.update(part, i)
            assert ({tuple(r) for r in s.results().collect()}, s.events().count()) == before
            used = [v for a, b, _ in before[0] for v in (a, b)]
            assert len(used) == len(set(used))
        held = set()
        for r in s.events().orderBy("batch", "round", F.desc("op")).collect():  # REMOVE before ADD
            edge = (r["src"], r["trg"], r["weight"])
            assert (edge in held) == (r["op"] == "REMOVE")
            held ^= {edge}
        assert held == {tuple(r) for r in s.results().collect()}
        assert sum(w for _, _, w in held) * 6 >= _best(edges)


def test_a_heavier_edge_evicts_and_a_lighter_one_does_not(spark):
    first = spark.createDataFrame([(1, 2, 1.0), (3, 4, 1.0)], "src bigint, trg bigint, weight double")
    got, events = Ma.preempt(first, spark.createDataFrame([(2, 3, 4.0)], EDGES))
    assert {r["src"] for r in got.collect()} == {1, 3} and events.count() == 0  # 4 isn't more than twice 1 + 1
    got, events = Ma.preempt(first, spark.createDataFrame([(2, 3, 4.5)], EDGES))
    assert [tuple(r) for r in got.collect()] == [(2, 3, 4.5)]
    assert sorted((r["op"], r["src"]) for r in events.collect()) == [("ADD", 2), ("REMOVE", 1), ("REMOVE", 3)]
    got, _ = Ma.preempt(first, spark.createDataFrame([(2, 1, 1.5)], EDGES))  # parallel to a matched edge
    assert {r["weight"] for r in got.collect()} == {1.0}


def _distances(edges, source, k):
    near, seen = {}, {source: 0}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    front = {source}
    for d in range(1, k + 1):
        front = {y for x in front for y in near.get(x, ()) if y not in seen}
        seen |= {y: d for y in front}
    return seen


def test_spanner_stream_keeps_every_edge_within_k(spark, tmpdir_path):
    rng = random.Random(3)
    edges = list({(a, b) for a, b in ((rng.randrange(40), rng.randrange(40)) for _ in range(500)) if a < b})
    s = SpannerStream(spark, os.path.join(tmpdir_path, "s"), 3)
    for i in range(3):
        part = spark.createDataFrame(edges[i::3], "src bigint, trg bigint")
        s.update(part, i)
        s.update(part, i)
        kept = [tuple(r) for r in s.results().collect()]
        assert len(kept) == len(set(kept)) and set(kept) <= set(edges)
        for a, b in [e for j in range(i + 1) for e in edges[j::3]]:
            assert _distances(kept, a, 3).get(b) is not None
    assert len(kept) < len(edges)
    halves = [spark.createDataFrame(edges[i::2], "src bigint, trg bigint") for i in (0, 1)]
    merged = [tuple(r) for r in Sp.merge_spanners(*[Sp.spanner(h, 3) for h in halves]).collect()]
    assert all(_distances(merged, a, 3).get(b) is not None for a, b in edges)


@pytest.mark.parametrize("directed", [False, True])
def test_search_from_more_sources_than_a_word_through_a_hub(spark, directed):
    rng = random.Random(5)
    edges = {(0, v) for v in range(1, 150)} | {(rng.randrange(150), rng.randrange(150, 300)) for _ in range(120)} | {(-7, 0), (299, 299)}
    df = spark.createDataFrame(sorted(edges), "src bigint, trg bigint")
    vertices = sorted({v for e in edges for v in e})
    got = {}
    for r in Pa.bounded_distances(df, spark.createDataFrame([(v,) for v in vertices], "s bigint"), 2, directed).collect():
        assert (r["s"], r["v"]) not in got
        got[r["s"], r["v"]] = r["dist"]
    out = {}
    for a, b in edges:
        out.setdefault(a, set()).add(b)
        if not directed:
            out.setdefault(b, set()).add(a)
    exp = {}
    for v in vertices:
        seen, front = {v: 0}, {v}
        for d in (1, 2):
            front = {y for x in front for y in out.get(x, ()) if y not in seen}
            seen |= {y: d for y in front}
        exp |= {(v, y): d for y, d in seen.items()}
    assert got == exp
    asked = [(a, b) for a in vertices[::3] for b in vertices[::5]] + [(10 ** 6, 0)]
    pairs = Pa.within_k(df, spark.createDataFrame(asked, "a bigint, b bigint"), 2, directed)
    assert {(r["a"], r["b"]): (r["dist"], r["reachable"]) for r in pairs.collect()} == {p: (exp.get(p), p in exp) for p in asked}
