"""EdgeStream API smoke test: every method runs on a small fixture and agrees with the operator it wraps."""

from pyspark.sql import functions as F

from edgegraph import EdgeStream
from edgegraph.operators import patterns as P
from edgegraph.operators import summary as Su
from edgegraph.sources import txn_edges, user_edges
from tests.conftest import SF_SMALL


def test_edge_stream_methods(spark):
    g = EdgeStream(user_edges(spark, SF_SMALL))
    n = g.get_edges().count()
    assert g.number_of_edges().first()["n_edges"] == n
    assert g.get_vertices().count() == g.number_of_vertices().first()["n_vertices"]
    assert g.reverse().reverse().get_edges().select("src", "trg").exceptAll(g.get_edges().select("src", "trg")).count() == 0
    assert g.undirected().get_edges().count() == 2 * n
    assert g.union(g).get_edges().count() == 2 * n
    assert g.distinct().get_edges().count() == g.distinct(keep_first_by="pos").get_edges().count()
    assert g.canonical().get_edges().where("src > trg").count() == 0
    assert g.filter_vertices(lambda v: v >= 3).filter_edges(F.col("amount") > 0).get_edges().count() <= n
    assert g.map_edges(F.col("amount") * 2).get_edges().count() == n
    assert g.with_position(["ts", "pos"], "p2").get_edges().agg(F.max("p2")).first()[0] == n
    degs = {r["v"]: r["degree"] for r in g.get_degrees().collect()}
    ins = {r["v"]: r["degree"] for r in g.get_in_degrees().collect()}
    outs = {r["v"]: r["degree"] for r in g.get_out_degrees().collect()}
    assert all(degs[v] == ins.get(v, 0) + outs.get(v, 0) for v in degs)
    assert g.degree_changelog().count() == 2 * n
    assert g.vertex_count_changelog().count() == len(degs)
    assert g.aggregate([("src", F.col("amount"))], F.sum("x")).count() == len(outs)
    assert g.global_aggregate(F.col("amount")).count() >= 1
    assert g.remove_value().get_edges().columns == ["src", "trg"] and g.remove_value().get_edges().count() == n
    assert g.build_neighborhood().count() == g.get_edges().select("src", "trg").distinct().count()
    assert g.running_neighborhood(directed=False).count() == 2 * n
    assert g.running_neighborhood_size().count() == n
    sl = g.slice("6 hours", "all")
    assert sl.reduce_on_edges("amount", "max").count() == sl.summary().count()
    assert sl.aggregate_neighbors(F.count(F.lit(1)).alias("k")).count() == sl.fold_neighbors().count() == sl.summary().count()
    assert sl.apply_on_neighbors().count() > 0
    assert g.sliding_sum("2 hours", "1 hour").count() > 0
    assert g.count_windows(5, ["pos"]).count() == (n + 4) // 5
    assert g.window_graph_size("1 hour").count() > 0
    assert g.summarize("6 hours", Su.edge_stats_spec(), tree=True).count() == g.summarize("6 hours", Su.edge_stats_spec()).count()
    cc = {tuple(r) for r in g.connected_components().collect()}
    assert cc == {tuple(r) for r in g.connected_components("propagation").collect()}
    assert g.bipartiteness().first()["bipartite"] is (not g.bipartite_components().where("NOT bipartite").count())
    assert g.bipartite_components().count() >= 1
    whole = {r["component"]: r["size"] for r in g.bipartite_components().where("bipartite").collect()}
    assert {r["component"]: r["count"] for r in g.signed_components().groupBy("component").count().collect()} == whole
    assert g.spanner(3).count() <= g.distinct().get_edges().count()
    pairs = g.get_edges().select(F.col("src").alias("a"), F.col("trg").alias("b"))
    assert g.within_k(pairs, 1).where("NOT reachable").count() == 0
    t = g.triangle_count().first()["triangles"]
    assert {r["v"]: r["triangles"] for r in g.local_triangles().collect()}.get(-1, 0) == t
    assert g.triangle_changelog().agg(F.max("total_triangles")).first()[0] in (t, None)
    assert g.window_triangles("6 hours").count() > 0
    assert g.estimate_triangles(200).count() == 1
    assert g.degree_distribution().count() >= 1
    assert g.weighted_matching().count() >= 1
    assert g.with_timestamp().get_edges().where("ts_ms IS NULL").count() == 0


def test_edge_stream_patterns(spark):
    g = EdgeStream(txn_edges(spark, SF_SMALL))
    rule = P.MoneyMovement(window="90 days", min_amount=1000000, min_payees=2, max_payees=10, min_span_ms=0)
    alerts = g.money_movement_alerts(rule)
    report = g.fraud_window_report(rule)
    assert report.where("payer IS NOT NULL").count() == alerts.count()
    assert g.adjacency("30 days").count() > 0
    assert g.edge_probe([(1, 1000002)], "30 days").count() > 0
    assert g.signed_components is not None
