"""Tables that only grow: every split of a stream into micro-batches gives the batch operator's rows, replayed or not."""

import os
import random

import pytest
from pyspark.sql import functions as F

from edgegraph.operators import components as C
from edgegraph.operators import degree_dist as DD
from edgegraph.operators import degrees as D
from edgegraph.operators import triangles as T
from edgegraph.sources import signed_edges, user_edges
from edgegraph.streaming import (ComponentsStream, DegreeChangelogStream, DegreeDistributionChangelogStream, ExactTriangleStream, NeighborhoodStream,
                                 VertexCountStream, WindowTriangles)
from tests.conftest import SF_SMALL


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def cut(edges, bounds):
    """Micro-batches of the arrival positions up to each bound."""
    low = -1
    for high in [*bounds, 1 << 62]:
        yield edges.where((F.col("pos") > low) & (F.col("pos") <= high))
        low = high


def random_graph(spark, seed, n=400, vertices=25, hub=True):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b = rng.randrange(vertices), rng.randrange(vertices)
        out.append((0 if hub and rng.random() < 0.35 else a, b, rng.choice((1, 1, -1)), i))
    return spark.createDataFrame(out, "src bigint, trg bigint, chg int, pos bigint")


def run(stream, edges, bounds, replay=True):
    for i, part in enumerate(cut(edges, bounds)):
        stream.update(part, i)
        if replay and i == 1:
            stream.update(part, i)
    return stream


FORMS = {
    "vertices": (lambda s, d: VertexCountStream(s, d), lambda e: D.vertex_count_changelog(e), ("v", "pos", "side", "n_vertices")),
    "neighbours": (lambda s, d: NeighborhoodStream(s, d), lambda e: D.running_neighborhood(e),
                   ("v", "nbr", "pos", "side", "is_new", "n_nbrs")),
    "neighbours_both": (lambda s, d: NeighborhoodStream(s, d, directed=False), lambda e: D.running_neighborhood(e, directed=False),
                        ("v", "nbr", "pos", "side", "is_new", "n_nbrs")),
    "degrees": (lambda s, d: DegreeChangelogStream(s, d), lambda e: D.degree_changelog(e.select("src", "trg", "pos")),
                ("v", "pos", "side", "degree")),
    "distribution": (lambda s, d: DegreeDistributionChangelogStream(s, d), lambda e: DD.degree_distribution_changelog(e),
                     ("pos", "side", "sub", "degree", "delta", "count")),
}


@pytest.mark.parametrize("name", FORMS)
def test_changelogs_equal_batch_for_any_split(spark, tmpdir_path, name):
    make, batch, cols = FORMS[name]
    for i, (edges, bounds) in enumerate([(random_graph(spark, 1), [40, 250])]):
        got = run(make(spark, os.path.join(tmpdir_path, str(i))), edges, bounds).results()
        assert rows(got, *cols) == rows(batch(edges), *cols)


def test_changelogs_of_given_tables(spark, tmpdir_path):
    e, signed = user_edges(spark, SF_SMALL).select("src", "trg", "pos"), signed_edges(spark, SF_SMALL)
    for name, edges in (("degrees", e), ("distribution", signed)):
        make, batch, cols = FORMS[name]
        n = edges.agg(F.max("pos")).first()[0]
        got = run(make(spark, os.path.join(tmpdir_path, name)), edges, [n // 3, n // 2], replay=False).results()
        assert rows(got, *cols) == rows(batch(edges), *cols)


def test_exact_triangles_after_every_batch(spark, tmpdir_path):
    edges = random_graph(spark, 5, 300, 22).unionByName(
        spark.createDataFrame([(None, 3, 1, 301), (4, None, 1, 302), (7, 7, 1, 303)], "src bigint, trg bigint, chg int, pos bigint"))
    bounds = [30, 31, 200]
    t = ExactTriangleStream(spark, os.path.join(tmpdir_path, "tri"))
    for i, part in enumerate(cut(edges, bounds)):
        t.update(part, i)
        if i > 1:
            t.update(part, i)  # replayed
        so_far = edges.where(F.col("pos") <= ([*bounds, 1 << 62])[i])
        assert rows(t.changelog(), "pos", "new_triangles", "total_triangles") == rows(T.triangle_changelog(so_far))
        assert rows(t.results().where("triangles > 0")) == rows(T.local_triangles(so_far).where("triangles > 0"))
    # edges of one position close each triangle once as well
    tied = ExactTriangleStream(spark, os.path.join(tmpdir_path, "tied"))
    tied.update(spark.createDataFrame([(1, 2, 5), (2, 3, 5), (3, 1, 5), (3, 4, 5), (4, 1, 5)], "src bigint, trg bigint, pos bigint"), 0)
    assert rows(tied.changelog()) == [(5, 2, 2)]


def test_a_batch_writes_its_own_rows_only(spark, tmpdir_path):
    edges = random_graph(spark, 6, 400, 400, hub=False)
    t = run(ExactTriangleStream(spark, tmpdir_path), edges, [380], replay=False)
    for name in t.tables:
        parts = sorted(os.listdir(os.path.join(tmpdir_path, name)))
        assert parts == ["batch=0", "batch=1"]
    assert spark.read.parquet(os.path.join(tmpdir_path, "edges", "batch=1")).count() <= 20


def test_streams_from_files_resume_at_their_checkpoint(spark, tmpdir_path):
    edges = random_graph(spark, 8, 200, 15).select("src", "trg", "pos")
    src, ck, st = (os.path.join(tmpdir_path, n) for n in ("in", "ck", "state"))
    parts = list(cut(edges, [60, 130]))
    read = lambda: (spark.readStream.schema("src bigint, trg bigint, pos bigint").option("maxFilesPerTrigger", 1)
                    .option("recursiveFileLookup", "true").parquet(src))
    for i, part in enumerate(parts):
        part.coalesce(1).write.parquet(os.path.join(src, f"p{i}"))
        ExactTriangleStream(spark, st).start(read(), ck).awaitTermination()
    assert rows(ExactTriangleStream(spark, st).changelog()) == rows(T.triangle_changelog(edges))


def test_window_triangles_replayed_after_their_progress(spark, tmpdir_path):
    e = spark.createDataFrame([(1, 2, 10), (2, 3, 20), (1, 3, 30), (8, 9, 900)], "src bigint, trg bigint, t bigint")
    e = e.select("src", "trg", F.timestamp_millis("t").alias("ts"))
    w = WindowTriangles(spark, tmpdir_path, "300 milliseconds")
    w.update(e, 0)
    again = WindowTriangles(spark, tmpdir_path, "300 milliseconds")  # progress saved, the stream's commit lost
    again.update(e, 0)
    assert again.late_rows == 0 and rows(again.results()) == [(299, 1)]
    assert sorted(n for n in os.listdir(again.staging) if n.startswith("w_start")) == ["w_start=900"]
    again.update(e.where("src = 1"), 1)
    assert again.late_rows == 2


def test_components_write_new_vertices_and_merged_roots_only(spark, tmpdir_path):
    edges = random_graph(spark, 11, 90, 120, hub=False)
    bridges = spark.createDataFrame([(5, 300, 1, 500), (300, 301, 1, 501), (None, 4, 1, 502), (9, 9, 1, 503), (400, 400, 1, 504)],
                                    edges.schema)
    everything, bounds = edges.unionByName(bridges), [25, 50, 400]
    c = ComponentsStream(spark, tmpdir_path)
    for i, part in enumerate(cut(everything, bounds)):
        c.update(part, i)
        if i == 2:
            again = ComponentsStream(spark, tmpdir_path)  # a new instance after a crash replays the batch
            again.update(part, i)
        so_far = everything.where((F.col("pos") <= ([*bounds, 1 << 62])[i]) & F.col("src").isNotNull() & F.col("trg").isNotNull())
        want = {r["v"]: r["component"] for r in C.connected_components(so_far).collect()}
        got = {r["v"]: r["component"] for r in c.labels().collect()}
        assert {v: k for v, k in got.items() if v in want} == want
        assert set(got) - set(want) <= {v for v, k in got.items() if v == k}  # vertices with loops only
    assert c.table("roots").count() == c.table("roots").select("v").distinct().count()
    last = spark.read.parquet(os.path.join(tmpdir_path, "roots", "batch=3"))
    assert {r["v"] for r in last.collect()} <= {300, 301, 400, 9, 5}
