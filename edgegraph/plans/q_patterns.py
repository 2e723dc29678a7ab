"""Windowed adjacency, money-movement alerts (flagship), window report, edge probe."""

from __future__ import annotations

from edgegraph.operators import patterns as P
from edgegraph.plans.catalog import register
from edgegraph.plans.oracle_views import with_views
from edgegraph.sources import txn_edges, user_edges

RULE = P.TXN_FIXTURE_RULE
W90 = 90 * 86400000


@register("fraud_money_movement", with_views(["txn_edges"], f"""
SELECT w_start, w_start + {W90} AS w_end, src AS payer, CAST(payees AS BIGINT) AS payees,
       CAST(total_amount AS BIGINT) AS total_amount, first_ts, last_ts, last_ts - first_ts AS span_ms
FROM p WHERE total_amount >= {RULE.min_amount} AND payees BETWEEN {RULE.min_payees} AND {RULE.max_payees}
  AND last_ts - first_ts >= {RULE.min_span_ms}""", ctes=f"""
t AS (SELECT DISTINCT ts - ts % {W90} AS w_start, src, trg, amount, ts FROM txn_edges),
p AS (SELECT w_start, src, count(DISTINCT trg) AS payees, sum(amount) AS total_amount,
             min(ts) AS first_ts, max(ts) AS last_ts FROM t GROUP BY w_start, src)"""))
def fraud_money_movement(spark, sf_dir):
    return P.money_movement_alerts(txn_edges(spark, sf_dir), RULE)


@register("fraud_window_report", with_views(["txn_edges"], f"""
SELECT w_start, w_start + {W90} AS w_end, src AS payer, 'Huge Money Movement by payer id ' || src AS line FROM a
UNION ALL
SELECT w.w_start, w.w_start + {W90}, CAST(NULL AS BIGINT), 'No fraudulent activity in this window'
FROM (SELECT DISTINCT ts - ts % {W90} AS w_start FROM txn_edges) w WHERE w.w_start NOT IN (SELECT w_start FROM a)""",
    ctes=f"""
t AS (SELECT DISTINCT ts - ts % {W90} AS w_start, src, trg, amount, ts FROM txn_edges),
p AS (SELECT w_start, src, count(DISTINCT trg) AS payees, sum(amount) AS total_amount,
             max(ts) - min(ts) AS span FROM t GROUP BY w_start, src),
a AS (SELECT w_start, src FROM p WHERE total_amount >= {RULE.min_amount}
        AND payees BETWEEN {RULE.min_payees} AND {RULE.max_payees} AND span >= {RULE.min_span_ms})"""))
def fraud_window_report(spark, sf_dir):
    return P.fraud_window_report(txn_edges(spark, sf_dir), RULE)


W30 = 30 * 86400000


@register("txn_adjacency_tumbling", with_views(["txn_edges"], f"""
SELECT w_start, w_start + {W30} AS w_end, src, CAST(sum(k) AS BIGINT) AS n_triples,
       CAST(count(*) AS BIGINT) AS n_targets, CAST(sum(amt) AS BIGINT) AS amount
FROM (SELECT w_start, src, trg, count(*) AS k, sum(amount) AS amt FROM t GROUP BY ALL) GROUP BY w_start, src""",
    ctes=f"t AS (SELECT DISTINCT ts - ts % {W30} AS w_start, src, trg, amount, ts FROM txn_edges)"))
def txn_adjacency_tumbling(spark, sf_dir):
    return P.adjacency(txn_edges(spark, sf_dir), "30 days")


# Sliding windows of 5 days every 2 days over the daily payments (the reference: 5 s / 2 s on live ms).
W5, S2 = 5 * 86400000, 2 * 86400000


@register("txn_adjacency_sliding", with_views(["txn_edges"], f"""
SELECT w_start, w_start + {W5} AS w_end, src, CAST(sum(k) AS BIGINT) AS n_triples,
       CAST(count(*) AS BIGINT) AS n_targets, CAST(sum(amt) AS BIGINT) AS amount
FROM (SELECT w_start, src, trg, count(*) AS k, sum(amount) AS amt FROM t GROUP BY ALL) GROUP BY w_start, src""",
    ctes=f"""t AS (SELECT DISTINCT ws AS w_start, src, trg, amount, ts FROM (
      SELECT *, ts - ts % {S2} - {S2} * unnest(range(0, {W5 // S2 + 1})) AS ws FROM txn_edges)
      WHERE ws <= ts AND ts < ws + {W5})"""))
def txn_adjacency_sliding(spark, sf_dir):
    return P.adjacency(txn_edges(spark, sf_dir), "5 days", "2 days")


# Probed edges: fixed parameters (ids present and absent in the user transition graph).
PROBES = [(1, 2), (2, 1), (3, 7), (10, 11), (0, 149)]
W6, S3 = 6 * 3600000, 3 * 3600000


@register("pattern_edge_probe", with_views(["user_edges"], f"""
SELECT w.w_start, w.w_start + {W6} AS w_end, p.a, p.b, coalesce(h.hit, false) AS found,
       CASE WHEN coalesce(h.hit, false) THEN 'Found edge ' ELSE 'Did not find edge ' END
         || p.a || ' -> ' || p.b || ' in this window' AS message
FROM (SELECT DISTINCT w_start FROM uw) w
CROSS JOIN (VALUES {", ".join(f"({a}::BIGINT, {b}::BIGINT)" for a, b in PROBES)}) p(a, b)
LEFT JOIN (SELECT DISTINCT w_start, src AS a, trg AS b, true AS hit FROM uw) h
  ON h.w_start = w.w_start AND h.a = p.a AND h.b = p.b""", ctes=f"""
uw AS (SELECT * FROM (SELECT *, ts - ts % {S3} - {S3} * unnest(range(0, {W6 // S3 + 1})) AS w_start
       FROM user_edges) WHERE w_start <= ts AND ts < w_start + {W6})"""))
def pattern_edge_probe(spark, sf_dir):
    return P.edge_probe(user_edges(spark, sf_dir, pos=False), PROBES, "6 hours", "3 hours")
