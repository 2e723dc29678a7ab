"""Sliding adjacency from slices of time against brute force, and the rows that it groups."""

import random

import pytest
from pyspark.sql import functions as F

from edgegraph.operators import patterns as P


def _edges(spark, rows):
    return spark.createDataFrame(rows, "src bigint, trg bigint, amount bigint, t bigint").select(
        "src", "trg", "amount", F.timestamp_millis("t").alias("ts"))


def _rows(n=900, seed=11):
    """Repeated rows, nulls in every column, times before 1970, and one payer and one pair with a third of all rows."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        src, trg = (0, 50) if i % 3 == 0 else (rnd.choice([None, 0, 1, 2, 3]), rnd.choice([None, 50, 51, 52]))
        t = None if rnd.random() < 0.03 else rnd.randint(-60, 90) * 500 + rnd.randint(0, 1)
        rows.append((src, trg, rnd.choice([None, 5, -7, 9]), t))
    return rows + rows[:40]


def _brute(rows, size, slide):
    groups = {}
    for src, trg, amount, t in set(rows):
        if t is None:
            continue
        w = t - t % slide
        while w + size > t:
            groups.setdefault((w, src), []).append((trg, amount))
            w -= slide
    out = set()
    for (w, src), g in groups.items():
        amounts = [a for _, a in g if a is not None]
        out.add((w, w + size, src, len(g), len({trg for trg, _ in g}), sum(amounts) if amounts else None))
    return out


@pytest.mark.parametrize("size, slide", [(5000, 2000), (4000, 2000), (2500, 700), (8000, 1000), (9000, 1000), (2000, 2000)])
@pytest.mark.parametrize("block", [2, 256])
def test_sliding_adjacency_matches_brute_force(spark, monkeypatch, size, slide, block):
    monkeypatch.setattr(P, "SLICES_PER_BLOCK", block, raising=False)
    rows = _rows()
    got = [tuple(r) for r in P.adjacency(_edges(spark, rows), f"{size} milliseconds", f"{slide} milliseconds").collect()]
    assert len(got) == len(set(got)) and set(got) == _brute(rows, size, slide)


def test_rows_are_not_copied_per_window_before_grouping(spark):
    """every group table held a row per window of each edge."""
    edges = _edges(spark, [(i % 97, i % 89, i, i * 500) for i in range(4000)])
    out = P.adjacency(edges, "5 days", "2 days")
    assert out.count() > 0
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()


def test_long_history_of_one_pair_is_dealt_by_blocks(spark):
    rows = [(1, 2, i, i * 2000) for i in range(1500)]
    got = {tuple(r) for r in P.adjacency(_edges(spark, rows), "5 seconds", "2 seconds").collect()}
    assert got == _brute(rows, 5000, 2000)
