"""Physical-plan properties that matter at scale (all queries' plans are also checked in test_oracle)."""

import re

from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_prunes_and_stays_parallel(spark):
    from edgegraph.plans.q_patterns import fraud_money_movement
    df = fraud_money_movement(spark, SF_SMALL)
    formatted = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", formatted)
    assert "struct<l_orderkey:bigint,l_suppkey:bigint,l_extendedprice:double,l_shipdate:timestamp_ntz>" in schemas
    assert "struct<o_orderkey:bigint,o_custkey:bigint>" in schemas
    assert "SinglePartition" not in formatted
    assert formatted.count("partial_") >= 2  # payer-payee and payer levels combine map-side


def test_degree_aggregate_is_partial(spark):
    from edgegraph.plans.q_aggregates import deg_all
    plan = _plan(deg_all(spark, SF_SMALL))
    assert "partial_count" in plan and "SinglePartition" not in plan
