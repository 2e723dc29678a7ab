"""Triangle estimators on a stream: any split into batches gives the batch form's samples and estimate."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from edgegraph.operators import estimators as E
from edgegraph.streaming import EstimatorStream

SAMPLES, VERTICES = 400, 12


def _edges(spark, n=150, seed=3):
    """A dense random graph with a hub, self-loops and repeated edges."""
    rnd = random.Random(seed)
    rows = [(0 if k % 3 == 0 else rnd.randrange(VERTICES), rnd.randrange(VERTICES), k + 1) for k in range(n)]
    return spark.createDataFrame(rows, "src bigint, trg bigint, pos bigint")


@pytest.mark.parametrize("cuts", [[150], [1, 2, 60, 150], [50, 50, 100, 150]])
def test_estimator_stream_equals_batch(spark, cuts):
    e = _edges(spark)
    s = EstimatorStream(spark, tempfile.mkdtemp(prefix="edgegraph-test-"), SAMPLES, VERTICES)
    assert [tuple(r) for r in s.results().collect()] == [(0, 0, 0)]
    last = 0
    for k, cut in enumerate(cuts):
        part = e.where((F.col("pos") > last) & (F.col("pos") <= cut))  # the repeated cut makes an empty batch
        s.update(part, k)
        s.update(part, k)  # replayed: nothing changes
        last = cut
        got = [tuple(r) for r in s.results().collect()]
        assert got == [tuple(r) for r in E.estimate(e.where(F.col("pos") <= cut), SAMPLES, vertices=VERTICES).collect()]
    assert E.estimate(e, SAMPLES, method="incidence", vertices=VERTICES).collect() == s.results().collect()
    chain = E.sample_chain(spark, 150, SAMPLES)
    exp = E.samples_at(e, chain, None, VERTICES, [150], E.DEFAULT_SEED).select("i", "p", "a", "b", "t")
    assert sorted(map(tuple, s.samples_held().collect())) == sorted(map(tuple, exp.collect()))
    assert s.results().first()["beta_sum"] > 0 and s.state().count() == SAMPLES


def test_known_vertices_equal_ranks_when_all_occur(spark):
    e = _edges(spark)
    assert E.vertex_ranks(e).count() == VERTICES
    assert E.estimate(e, SAMPLES, vertices=VERTICES).collect() == E.estimate(e, SAMPLES).collect()


def test_too_few_vertices(spark):
    with pytest.raises(ValueError):
        EstimatorStream(spark, tempfile.mkdtemp(prefix="edgegraph-test-"), 5, 2)
