"""Batch = stream: replay fixtures as files through availableNow streams; late rows; restart."""

import os

import pytest
from pyspark.sql import functions as F

from edgegraph.operators import components as C
from edgegraph.operators import degrees as D
from edgegraph.operators import patterns as P
from edgegraph.sources import cust_edges, txn_edges, user_edges

from edgegraph.streaming import (IncrementalComponents, WindowTriangles, degree_changelog_stream,
                                 degree_stream, edge_stream_from_kafka, fraud_alert_stream, run_available,
                                 vertex_count_stream)
from tests.conftest import SF_SMALL

SCHEMA = "src bigint, trg bigint, amount bigint, ts timestamp, pos bigint"


def _write_slices(df, root, n, order="ts"):
    """Write ``df`` as ``n`` parquet files in time order (file k holds the k-th slice)."""
    from edgegraph.operators.positions import with_position
    pos = with_position(df, [order, "src", "trg", "amount"], "_r")
    total = pos.count()
    for k in range(n):
        lo, hi = k * total // n, (k + 1) * total // n
        (pos.where((F.col("_r") > lo) & (F.col("_r") <= hi)).drop("_r")
         .coalesce(1).write.mode("overwrite").parquet(os.path.join(root, f"part{k:03d}")))
    return total


def _stream_dir(spark, root):
    return (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(root))


def test_fraud_stream_equals_batch(spark, tmpdir_path):
    rule = P.MoneyMovement(window="90 days", min_amount=4000000, min_payees=2, max_payees=10, min_span_ms=15000)
    e = txn_edges(spark, SF_SMALL).withColumn("pos", F.lit(0).cast("bigint"))
    src = os.path.join(tmpdir_path, "in")
    _write_slices(e, src, 4)
    # a far-future sentinel edge moves the watermark past the last window (append mode flush)
    spark.createDataFrame([(-1, -1, 0, 4102444800000, 0)], "src bigint, trg bigint, amount bigint, t bigint, pos bigint") \
        .select("src", "trg", "amount", F.timestamp_millis("t").alias("ts"), "pos") \
        .coalesce(1).write.parquet(os.path.join(src, "part999"))
    q = run_available(fraud_alert_stream(_stream_dir(spark, src), rule), "fraud_out", "append",
                      os.path.join(tmpdir_path, "ck"))
    got = {tuple(r) for r in spark.table("fraud_out").collect()}
    exp = {tuple(r) for r in P.money_movement_alerts(e, rule).collect()}
    assert q.lastProgress is not None
    assert got == exp and len(exp) > 0


def test_degree_stream_update_mode(spark, tmpdir_path):
    e = user_edges(spark, SF_SMALL)
    src = os.path.join(tmpdir_path, "in")
    _write_slices(e, src, 3)
    run_available(degree_stream(_stream_dir(spark, src)), "deg_out", "update", os.path.join(tmpdir_path, "ck"))
    got = spark.table("deg_out").groupBy("v").agg(F.max("degree").alias("degree"))
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in D.degrees(e).collect()}


def test_degree_changelog_transform_with_state(spark, tmpdir_path):
    e = user_edges(spark, SF_SMALL)
    src = os.path.join(tmpdir_path, "in")
    _write_slices(e, src, 3, order="pos")
    run_available(degree_changelog_stream(_stream_dir(spark, src)), "chg_out", "append", os.path.join(tmpdir_path, "ck"))
    got = {(r["v"], r["pos"], r["side"], r["degree"]) for r in spark.table("chg_out").collect()}
    exp = {(r["v"], r["pos"], r["side"], r["degree"]) for r in D.degree_changelog(e.select("src", "trg", "pos")).collect()}
    assert got == exp


def test_incremental_components_equals_batch_and_restarts(spark, tmpdir_path):
    e = cust_edges(spark, SF_SMALL).select("src", "trg", F.lit(0).cast("bigint").alias("amount"),
                                           F.timestamp_millis(F.col("src")).alias("ts"), F.col("src").alias("pos"))
    src = os.path.join(tmpdir_path, "in")
    _write_slices(e, src, 4)
    state = os.path.join(tmpdir_path, "state")
    ck = os.path.join(tmpdir_path, "ck")
    # the first run sees two files; the second one resumes from the same checkpoint and the label table
    later = os.path.join(tmpdir_path, "later")
    os.mkdir(later)
    for p in ("part002", "part003"):
        os.rename(os.path.join(src, p), os.path.join(later, p))
    IncrementalComponents(spark, state).start(_stream_dir(spark, src), ck).awaitTermination()
    first = IncrementalComponents(spark, state)
    assert 0 < first.labels().count() < e.select(F.explode(F.array("src", "trg"))).distinct().count()
    for p in ("part002", "part003"):
        os.rename(os.path.join(later, p), os.path.join(src, p))
    inc = IncrementalComponents(spark, state)
    q = inc.start(_stream_dir(spark, src), ck)
    q.awaitTermination()
    assert [p["batchId"] for p in q.recentProgress if p["numInputRows"]] == [2, 3]  # not the first two files again
    got = {tuple(r) for r in inc.labels().collect()}
    exp = {tuple(r) for r in C.connected_components(e).collect()}
    assert got == exp
    assert len([n for n in os.listdir(state) if n.startswith("v")]) <= 2


def test_incremental_components_survive_a_crash_between_write_and_commit(spark, tmpdir_path):
    state = os.path.join(tmpdir_path, "state")
    edges = lambda *e: spark.createDataFrame(list(e), "src bigint, trg bigint")
    inc = IncrementalComponents(spark, state)
    inc.update(edges((1, 2), (5, 6)), 0)
    inc.update(edges((2, 3)), 1)
    before = {tuple(r) for r in inc.labels().collect()}
    # a crashed attempt leaves the next version without its commit mark; the batch is replayed
    edges((9, 9)).write.parquet(os.path.join(state, "v00000002"))
    os.remove(os.path.join(state, "v00000002", "_SUCCESS"))
    again = IncrementalComponents(spark, state)
    assert {tuple(r) for r in again.labels().collect()} == before
    again.update(edges((3, 5)), 2)
    exp = {(1, 1), (2, 1), (3, 1), (5, 1), (6, 1)}
    assert {tuple(r) for r in again.labels().collect()} == exp
    again.update(edges((3, 5)), 2)  # crashed after the write, before the stream's commit: replayed without harm
    assert {tuple(r) for r in IncrementalComponents(spark, state).labels().collect()} == exp


def test_window_triangle_stream_g4_and_late_rows(spark, tmpdir_path):
    rows = [(k, k + 1, 100 * k) for k in range(1, 11)] + [(k, k + 2, 100 * k + 50) for k in range(1, 11)]
    src = os.path.join(tmpdir_path, "in")
    base = spark.createDataFrame(rows, "src bigint, trg bigint, t bigint")
    mk = lambda df: df.select("src", "trg", F.lit(0).cast("bigint").alias("amount"),
                              F.timestamp_millis("t").alias("ts"), F.lit(0).cast("bigint").alias("pos"))
    mk(base.where("t < 600")).coalesce(1).write.parquet(os.path.join(src, "part000"))
    mk(base.where("t >= 600")).coalesce(1).write.parquet(os.path.join(src, "part001"))
    # a late edge (its window [0, 300) is already emitted) and the far-future sentinel
    mk(spark.createDataFrame([(50, 51, 120), (1000, 1001, 100000)], "src bigint, trg bigint, t bigint")) \
        .coalesce(1).write.parquet(os.path.join(src, "part002"))
    wt = WindowTriangles(spark, os.path.join(tmpdir_path, "state"), "300 milliseconds")
    wt.start(_stream_dir(spark, src), os.path.join(tmpdir_path, "ck")).awaitTermination()
    got = sorted((r["w_max_ts"], r["triangles"]) for r in wt.results().collect())
    assert got == [(299, 1), (599, 2), (899, 2), (1199, 1)]
    assert wt.late_rows == 1


def test_vertex_count_stream(spark, tmpdir_path):
    e = user_edges(spark, SF_SMALL)
    src = os.path.join(tmpdir_path, "in")
    _write_slices(e, src, 3)
    run_available(vertex_count_stream(_stream_dir(spark, src)), "nv_out", "complete", os.path.join(tmpdir_path, "ck"))
    assert spark.table("nv_out").first()["n_vertices"] == D.vertex_count(e).first()["n_vertices"]


def test_kafka_source_gated(spark):
    with pytest.raises(RuntimeError, match="Kafka source"):  # the connector is not installed here
        edge_stream_from_kafka(spark, "localhost:9092", "edges")


def test_snapshot_and_sliding_windows_stream_equal_batch(spark, tmpdir_path):
    from edgegraph.operators import snapshot as S
    from edgegraph.operators import windows as Wn
    from edgegraph.streaming import with_event_time
    e = user_edges(spark, SF_SMALL)
    src = os.path.join(tmpdir_path, "in")
    _write_slices(e, src, 3)
    spark.createDataFrame([(-1, -2, 0, 4102444800000, 0)], "src bigint, trg bigint, amount bigint, t bigint, pos bigint") \
        .select("src", "trg", "amount", F.timestamp_millis("t").alias("ts"), "pos") \
        .coalesce(1).write.parquet(os.path.join(src, "part999"))
    stream = with_event_time(_stream_dir(spark, src))
    run_available(S.reduce_on_edges(S.slice_edges(stream, "6 hours", "all"), "amount", "sum"), "slice_out",
                  "append", os.path.join(tmpdir_path, "ck1"))
    run_available(Wn.sliding_sum(with_event_time(_stream_dir(spark, src)), "2 hours", "1 hour"), "slide_out",
                  "append", os.path.join(tmpdir_path, "ck2"))
    exp1 = {tuple(r) for r in S.reduce_on_edges(S.slice_edges(e, "6 hours", "all"), "amount", "sum").collect()}
    exp2 = {tuple(r) for r in Wn.sliding_sum(e, "2 hours", "1 hour").collect()}
    assert {tuple(r) for r in spark.table("slice_out").collect()} == exp1
    assert {tuple(r) for r in spark.table("slide_out").collect()} == exp2


def test_periodic_trigger_buffers_and_flushes(spark, tmpdir_path):
    from edgegraph.streaming import run_periodic
    e = user_edges(spark, SF_SMALL)
    src = os.path.join(tmpdir_path, "in")
    _write_slices(e, src, 2)
    q = run_periodic(degree_stream(_stream_dir(spark, src)), "1 second", "update", os.path.join(tmpdir_path, "ck"),
                     sink="memory", queryName="periodic_out")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = spark.table("periodic_out").groupBy("v").agg(F.max("degree").alias("degree"))
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in D.degrees(e).collect()}


def _sentinel(spark, src):
    spark.createDataFrame([(-1, -2, 0, 4102444800000, 0)], "src bigint, trg bigint, amount bigint, t bigint, pos bigint") \
        .select("src", "trg", "amount", F.timestamp_millis("t").alias("ts"), "pos") \
        .coalesce(1).write.parquet(os.path.join(src, "part999"))


def test_two_level_windows_stream_equal_batch_and_count_late_rows(spark, tmpdir_path):
    from edgegraph.operators import snapshot as S
    from edgegraph.streaming import with_event_time
    e = user_edges(spark, SF_SMALL)
    src = os.path.join(tmpdir_path, "in")
    _write_slices(e, src, 3)
    _sentinel(spark, src)
    rule = P.MoneyMovement(window="6 hours", min_amount=10000, min_payees=2, max_payees=50, min_span_ms=1)
    forms = {"summary": lambda d: S.neighborhood_summary(S.slice_edges(d, "6 hours", "all")),
             "report": lambda d: P.fraud_window_report(d, rule),
             "size": lambda d: D.window_graph_size(d, "1 hour")}
    for name, form in forms.items():
        if name == "size":
            # a row behind the watermark, after the sentinel: Spark drops it and counts it
            late = e.orderBy("ts").limit(1).withColumn("src", F.lit(777777).cast("bigint"))
            late.coalesce(1).write.parquet(os.path.join(src, "part9991"))
        q = run_available(form(with_event_time(_stream_dir(spark, src))), f"two_{name}", "append", os.path.join(tmpdir_path, f"ck_{name}"))
        exp = {tuple(r) for r in form(e).collect()}
        assert {tuple(r) for r in spark.table(f"two_{name}").collect()} == exp and exp
        dropped = sum(o["numRowsDroppedByWatermark"] for p in q.recentProgress for o in p["stateOperators"])
        assert (dropped >= 1) == (name == "size")


def test_keyed_streams_equal_batch_replay_and_restart(spark, tmpdir_path):
    from edgegraph.operators import bipartite as B
    from edgegraph.operators import degree_dist as DD
    from edgegraph.operators import summary as Su
    from edgegraph.sources import signed_edges
    from edgegraph.streaming import BipartiteStream, DegreeDistributionStream, SummaryStream
    e = user_edges(spark, SF_SMALL)
    src = os.path.join(tmpdir_path, "in")
    _write_slices(e, src, 3)
    spec = Su.edge_stats_spec()
    st = os.path.join(tmpdir_path, "sum")
    s = SummaryStream(spark, st, "6 hours", spec)
    s.start(_stream_dir(spark, src), os.path.join(tmpdir_path, "ck1")).awaitTermination()
    exp = {tuple(r) for r in Su.summarize_bulk(e, "6 hours", spec).collect()}
    assert {tuple(r) for r in s.results().collect()} == exp
    # the last batch again, as after a crash before the stream's commit: nothing is counted twice
    s.update(spark.read.schema(SCHEMA).parquet(os.path.join(src, "part002")), 2)
    assert {tuple(r) for r in s.results().collect()} == exp
    # the same checkpoint goes on where it stopped
    _sentinel(spark, src)
    q = s.start(_stream_dir(spark, src), os.path.join(tmpdir_path, "ck1"))
    q.awaitTermination()
    more = e.select("src", "trg", "amount", "ts").unionByName(
        spark.read.parquet(os.path.join(src, "part999")).select("src", "trg", "amount", "ts"))
    assert {tuple(r) for r in s.results().collect()} == {tuple(r) for r in Su.summarize_bulk(more, "6 hours", spec).collect()}

    from edgegraph.operators import windows as Wn
    from edgegraph.streaming import CountWindowStream
    cw = CountWindowStream(spark, os.path.join(tmpdir_path, "cw"), 7, ["ts", "pos"])
    ordered = e.orderBy("ts", "src", "trg", "amount")
    for i in range(3):
        part = spark.read.schema(SCHEMA).parquet(os.path.join(src, f"part00{i}"))
        cw.update(part, i)
        cw.update(part, i)
    total, k = e.count(), -(-e.count() // 7)
    got = cw.results().orderBy("bucket").collect()
    assert [r["bucket"] for r in got] == list(range(k)) and [r["n_edges"] for r in got[:-1]] == [7] * (k - 1)
    assert sum(r["sum_amount"] for r in got) == ordered.agg(F.sum("amount")).first()[0] and got[-1]["last_pos"] == total
    one = CountWindowStream(spark, os.path.join(tmpdir_path, "cw1"), 7, ["ts", "pos"])
    one.update(e, 0)
    assert {tuple(r) for r in one.results().collect()} == {tuple(r) for r in Wn.count_windows(e, 7, ["ts", "pos"]).collect()}
    assert one.results(complete_only=True).count() == total // 7

    signed = signed_edges(spark, SF_SMALL)
    n = signed.agg(F.max("pos")).first()[0]
    d = DegreeDistributionStream(spark, os.path.join(tmpdir_path, "deg"))
    for i in range(4):
        part = signed.where((F.col("pos") > n * i // 4 - (i == 0)) & (F.col("pos") <= n * (i + 1) // 4))
        d.update(part, i)
        d.update(part, i)
    assert {tuple(r) for r in d.results().collect()} == {tuple(r) for r in DD.degree_distribution(signed).collect()}

    b = BipartiteStream(spark, os.path.join(tmpdir_path, "bip"))
    c = cust_edges(spark, SF_SMALL)
    odd = spark.createDataFrame([(1, -5), (-5, -9), (-9, 1)], "src bigint, trg bigint")
    for i, part in enumerate((c.where("src % 2 = 0"), c.where("src % 2 = 1"), odd)):
        b.update(part, i)
    assert {tuple(r) for r in b.results().collect()} == {tuple(r) for r in B.component_bipartite(c.unionByName(odd)).collect()}
    assert b.results().where("NOT bipartite").count() == 1
