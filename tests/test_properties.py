"""Property-based checks (hypothesis) against step-by-step replays of the reference's semantics."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from edgegraph.operators import degree_dist as DD
from edgegraph.operators.positions import with_position

events = st.lists(st.tuples(st.integers(0, 6), st.integers(7, 12), st.sampled_from([1, 1, -1])), min_size=1, max_size=80)


def _replay(evs):
    degs = {}
    for a, b, c in evs:
        for v in (a, b):
            d = degs.get(v, 0)
            degs[v] = max(0, d + c) if d > 0 or c > 0 else 0
    hist = {}
    for d in degs.values():
        if d > 0:
            hist[d] = hist.get(d, 0) + 1
    return hist


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(evs=events, parts=st.integers(1, 7))
def test_degree_distribution_matches_replay(spark, evs, parts):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        df = spark.createDataFrame([(a, b, c, i + 1) for i, (a, b, c) in enumerate(evs)],
                                   "src bigint, trg bigint, chg int, pos bigint")
        got = {r["degree"]: r["n_vertices"] for r in DD.degree_distribution(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == _replay(evs)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(keys=st.lists(st.integers(0, 5), min_size=1, max_size=200), parts=st.integers(1, 9))
def test_with_position_is_a_dense_rank(spark, keys, parts):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k bigint, id bigint")
    got = [(r["k"], r["id"]) for r in with_position(df, ["k", "id"], "p", num_partitions=parts).orderBy("p").collect()]
    assert got == sorted((k, i) for i, k in enumerate(keys))
    assert with_position(df, ["k", "id"], "p", num_partitions=parts).agg(F.max("p")).first()[0] == len(keys)
