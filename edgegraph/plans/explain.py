"""Print the reviewed physical plans: operator tree, scan schemas and pushed filters per query.

    python -m edgegraph.plans.explain [--sf DIR] name ...
"""

from __future__ import annotations

import argparse
import re

from edgegraph.plans.catalog import queries


def summary(df) -> str:
    """The plan that ran: the query is executed in full first, so adaptive joins and reused exchanges show."""
    spark = df.sparkSession
    for _ in df.toLocalIterator():  # the same plan, one partition in the driver at a time
        pass
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    tree = text.split("\n\n\n")[0].replace("== Physical Plan ==\n", "")
    final = tree.split("+- == Initial Plan ==")[0].rstrip()
    scans = sorted(set(re.findall(r"(ReadSchema: struct<[^\n]*>)", text)))
    pushed = sorted(set(re.findall(r"(PushedFilters: \[[^\n]*\])", text)))
    counts = {"shuffles": len(re.findall(r"[-+ ]Exchange", final)), "reused": len(re.findall("ReusedExchange", final)),
              "broadcasts": len(re.findall("BroadcastExchange", final))}
    return "\n".join([final, *scans, *pushed, f"executed: {counts}"])


def main(argv=None) -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="+")
    args = ap.parse_args(argv)
    from edgegraph.session import get_spark
    spark = get_spark()
    for n in args.names:
        print(f"### {n}\n\n```\n{summary(queries()[n](spark, args.sf))}\n```\n")


if __name__ == "__main__":
    main()
