"""User-defined mergeable state: ordered folds and scans, summaries of any type, batch = stream; fractional weights."""

import itertools
import os
import random

import pytest
from pyspark.sql import functions as F

from edgegraph.operators import bipartite as B
from edgegraph.operators import matching as Ma
from edgegraph.operators import snapshot as S
from edgegraph.operators import summary as Su
from edgegraph.operators.monoid import Monoid, clamped_walk, fold, scan
from edgegraph.plans.q_summaries import trail
from edgegraph.sources import user_edges
from edgegraph.streaming import BipartiteStream, StateStream, SummaryStream
from tests.conftest import SF_SMALL


def _rows(n=600, seed=1):
    """Key 0 holds a third of the rows; key None is a key like others."""
    rng = random.Random(seed)
    keys = [0 if i % 3 == 0 else rng.choice([1, 2, 3, None]) for i in range(n)]
    order = list(range(n))
    rng.shuffle(order)
    return [(keys[i], order[i], chr(97 + rng.randrange(26)), rng.choice([-1, 1])) for i in range(n)]


@pytest.mark.parametrize("block", [2, 7, 1000])
def test_ordered_fold_and_scan_equal_a_loop(spark, block):
    rows = _rows()
    df = spark.createDataFrame(rows, "k bigint, pos bigint, c string, step int").repartition(5)
    text = Monoid(F.col("c"), lambda a, b: F.concat(a, b), lambda s: F.concat(s, F.lit("!")), zero=F.lit("start:"))
    exp, walk, running, level = {}, {}, {}, {}
    for k, pos, c, step in sorted(rows, key=lambda r: r[1]):
        exp[k] = exp.get(k, "start:") + c
        walk[k] = max(walk.get(k, 0) + step, 0)
        running[pos], level[pos] = exp[k] + "!", walk[k]
    assert {r["k"]: r["t"] for r in fold(df, ["k"], text, ["pos"], "t", block).collect()} == {k: v + "!" for k, v in exp.items()}
    assert {r["k"]: r["t"] for r in fold(df, ["k"], text, ["pos"], "t", block, fan_in=2).collect()} == {k: v + "!" for k, v in exp.items()}
    out = scan(df, ["k"], ["pos"], text, "t", block)
    assert out.columns == ["k", "pos", "c", "step", "t"] and {r["pos"]: r["t"] for r in out.collect()} == running
    assert {r["pos"]: r["l"] for r in scan(df, ["k"], ["pos"], clamped_walk(F.col("step")), "l", block).collect()} == level
    for one in (fold(df.limit(0), ["k"], text, ["pos"]), scan(df.limit(0), [], ["pos"], text)):
        assert one.count() == 0


def test_null_states_are_the_identity(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, None), (4, "b")], "pos bigint, c string")
    text = Monoid(F.col("c"), lambda a, b: F.concat(a, b))
    assert [r["t"] for r in scan(df, [], ["pos"], text, "t", block=2).orderBy("pos").collect()] == [None, "a", "a", "ab"]


@pytest.mark.parametrize("block", [2, 1024])
def test_a_start_value_counts_once_whatever_the_block(spark, block):
    e = spark.createDataFrame([(1, i, x, i) for i, x in enumerate(range(2, 8))], "src bigint, trg bigint, amount bigint, pos bigint")
    sl = S.slice_edges(e.withColumn("ts", F.timestamp_millis(F.lit(0))), "1 hour")
    plus = Monoid(F.col("amount"), lambda a, b: a + b, zero=F.lit(100))
    assert [r["result"] for r in S.fold_edges(sl, plus, block=block).collect()] == [127]
    assert [r["result"] for r in S.fold_edges(sl, plus, "pos", block=block).collect()] == [127]


def test_fractional_weights(spark):
    e = spark.createDataFrame([(1, 2, 0.6), (2, 3, 0.9), (3, 4, 0.5)], "src bigint, trg bigint, amount double")
    assert [tuple(r) for r in Ma.locally_dominant_matching(e).collect()] == [(2, 3, 0.9)]
    assert Ma.matching_weight(Ma.locally_dominant_matching(e)).first()["total_weight"] == 0.9
    d = e.withColumn("amount", F.col("amount").cast("decimal(5,2)"))
    assert [float(r["weight"]) for r in Ma.locally_dominant_matching(d).collect()] == [0.9]
    x = [2.0 ** k * f for k in range(-60, 60) for f in (1 - 2 ** -52, 1.0, 1 + 2 ** -52, 1.5)]
    got = spark.createDataFrame([(v,) for v in x], "w double").select("w", Ma.power_class(F.col("w"), False).alias("c")).collect()
    assert all(2.0 ** r["c"] <= r["w"] < 2.0 ** (r["c"] + 1) for r in got)


def test_matching_by_class_of_fractions_is_within_its_factor(spark):
    rng = random.Random(4)
    for _ in range(2):
        edges = [(a, b, rng.random()) for a, b in itertools.combinations(range(7), 2) if rng.random() < 0.6]
        got = Ma.weight_class_matching(spark.createDataFrame(edges, "src bigint, trg bigint, amount double")).collect()
        used = [v for r in got for v in (r["src"], r["trg"])]

        def best(rest):
            if not rest:
                return 0
            (a, b, w), more = rest[0], rest[1:]
            return max(best(more), w + best([e for e in more if not {a, b} & set(e[:2])]))
        assert len(used) == len(set(used)) and sum(r["weight"] for r in got) >= best(edges) / 4


def _halves():
    v = F.col("amount") * F.lit(0.25)
    return [Su.Field("n", F.count(F.lit(1)), "sum", "sum"), Su.Field("low", F.min(v), "min", "min"), Su.Field("s", F.sum(v), "sum", "sum")]


def _parts(e, n=3):
    last = e.agg(F.max("pos")).first()[0]
    return [e.where((F.col("pos") > last * i // n) & (F.col("pos") <= last * (i + 1) // n)) for i in range(n)]


def test_fractional_summary_forms_and_stream_agree(spark, tmpdir_path):
    e = user_edges(spark, SF_SMALL).checkpoint()
    bulk = {tuple(r) for r in Su.summarize_bulk(e, "6 hours", _halves()).collect()}
    assert bulk == {tuple(r) for r in Su.summarize_tree(e, "6 hours", _halves()).collect()}
    assert any(r[4] % 1 for r in bulk)
    s = SummaryStream(spark, os.path.join(tmpdir_path, "half"), "6 hours", _halves())
    for i, part in enumerate(_parts(e)):
        s.update(part, i)
        s.update(part, i)
    assert {tuple(r) for r in s.results().collect()} == bulk
    tenth = spark.createDataFrame([(1, 2, 7, 0)], "src bigint, trg bigint, amount bigint, t bigint").withColumn("ts", F.timestamp_millis("t"))
    assert Su.summarize_bulk(tenth, "1 hour", [Su.Field("s", F.sum(F.col("amount") * 0.1), "sum", "sum")]).first()["s"] == pytest.approx(0.7)


def test_state_stream_equals_batch_and_replay_adds_nothing(spark, tmpdir_path):
    e = user_edges(spark, SF_SMALL).checkpoint()
    field = Su.StateField("t", trail())
    s = StateStream(spark, os.path.join(tmpdir_path, "windows"), field, size="6 hours")
    whole = StateStream(spark, os.path.join(tmpdir_path, "whole"), Su.StateField("l", clamped_walk(F.col("amount") - F.lit(2500))))
    for i, part in enumerate(_parts(e)):
        for _ in range(2):
            s.update(part, i)
            whole.update(part, i)
    for cumulative in (True, False):
        exp = {tuple(r) for r in Su.summarize_bulk(e, "6 hours", [field], cumulative=cumulative).collect()}
        assert {tuple(r) for r in s.results(cumulative).collect()} == exp and len(exp) > 10
    level = 0
    for r in e.orderBy("pos").collect():
        level = max(0, level + r["amount"] - 2500)
    assert [r["l"] for r in whole.results().collect()] == [level]
    again = StateStream(spark, os.path.join(tmpdir_path, "windows"), field, size="6 hours")  # a restart reads the stored type
    assert {tuple(r) for r in again.results().collect()} == {tuple(r) for r in s.results().collect()}


def test_distinct_sketch_stream_within_error(spark, tmpdir_path):
    n = 20_000
    e = spark.range(n).select(F.col("id").alias("src"), F.col("id").alias("trg"), F.timestamp_millis(F.col("id") * 1000).alias("ts"))
    s = SummaryStream(spark, os.path.join(tmpdir_path, "hll"), "1 hour", [Su.distinct_field("d", F.col("src"))])
    s.update(e.where("src < 9000"), 0)
    s.update(e.where("src >= 5000"), 1)  # overlaps: distinct, not added
    got = s.results().orderBy("w_start").select("d", F.hll_sketch_estimate("d").alias("n")).collect()
    exact = [min(n, 3600 * (i + 1)) for i in range(len(got))]
    assert len(got) == 6 and all(abs(r["n"] - x) <= 4 * 1.04 / 64 * x for r, x in zip(got, exact))
    assert max(len(r["d"]) for r in got) < 8192
    tree = Su.summarize_tree(e, "1 hour", [Su.distinct_field("d", F.col("src"))]).orderBy("w_start").select(F.hll_sketch_estimate("d")).collect()
    assert [r[0] for r in tree] == [r["n"] for r in got]


def test_wide_ids_raise_on_a_bipartite_stream(spark, tmpdir_path):
    wide = spark.createDataFrame([(1 << 62, 3)], "src bigint, trg bigint")
    with pytest.raises(Exception, match="2\\*\\*61"):
        BipartiteStream(spark, os.path.join(tmpdir_path, "b")).update(wide, 0)
    assert {r["component"] for r in B.component_bipartite(wide).collect()} == {3}
