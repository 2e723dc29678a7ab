"""DuckDB definitions of the edge views (same meaning as ``edgegraph.sources.views``).

Timestamps are epoch milliseconds (BIGINT) on the SQL side; Spark renders its TIMESTAMP
columns with ``unix_millis`` before comparison.
"""

VIEW_SQL = {
    "txn_edges": """SELECT o_custkey AS src, 1000000 + l_suppkey AS trg,
        CAST(round(l_extendedprice * 100) AS BIGINT) AS amount, epoch_us(l_shipdate) // 1000 AS ts
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "user_edges": """SELECT src, trg, amount, ts, row_number() OVER (ORDER BY seq) AS pos FROM (
        SELECT user_id AS src, lead(user_id) OVER (ORDER BY ts, event_id) AS trg,
               CAST(round(value * 100) AS BIGINT) AS amount, epoch_us(ts) // 1000 AS ts, event_id AS seq
        FROM events) WHERE trg IS NOT NULL AND trg <> src""",
    "signed_edges": """SELECT user_id AS src, 1000 + event_id % 40 AS trg,
        CASE WHEN event_type = 'error' THEN -1 ELSE 1 END AS chg, event_id AS pos FROM events""",
    "cust_edges": """SELECT src, trg FROM (
        SELECT c_custkey AS src,
               lead(c_custkey) OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey) AS trg
        FROM customer) WHERE trg IS NOT NULL""",
}


def with_views(views: list[str], body: str, ctes: str = "", recursive: bool = False) -> str:
    """``WITH [RECURSIVE] <views>, <ctes> <body>``."""
    parts = [f"{v} AS ({VIEW_SQL[v]})" for v in views]
    if ctes.strip():
        parts.append(ctes.strip().rstrip(","))
    head = "WITH RECURSIVE " if recursive else "WITH "
    return (head + ",\n".join(parts) + "\n" + body) if parts else body


def components_cte(edge_view: str, name: str = "cc") -> str:
    """Recursive reachability carrying only smaller labels; ``name(v, component)`` = min reachable id."""
    return f"""
{name}_und AS (SELECT src AS a, trg AS b FROM {edge_view} UNION SELECT trg, src FROM {edge_view}),
{name}_r(v, l) AS (SELECT a, a FROM {name}_und
    UNION SELECT {name}_und.b, {name}_r.l FROM {name}_r JOIN {name}_und ON {name}_und.a = {name}_r.v
    WHERE {name}_r.l < {name}_und.b),
{name} AS (SELECT v, min(l) AS component FROM {name}_r GROUP BY v)"""
