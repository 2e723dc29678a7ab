"""Decoders (all line formats, FAILFAST / PERMISSIVE), text and csv sinks round trip, console sink."""

import os

import pytest
from pyspark.sql import functions as F

from edgegraph.sources import edge_lines, read_edge_text, txn_edges, user_edges
from edgegraph.sources.text import decode
from tests.conftest import SF_SMALL


def test_text_round_trip_all_formats(spark, tmpdir_path):
    for fmt in ("pair", "pair_tab", "txn", "signed", "commented", "rating"):
        lines = edge_lines(spark, SF_SMALL, fmt)
        path = os.path.join(tmpdir_path, fmt)
        lines.write.text(path)                      # text sink (writeAsText)
        back = read_edge_text(spark, path, fmt)     # text source + decoder
        assert back.count() == decode(lines, fmt).count() > 0


def test_txn_decoder_values(spark):
    e = txn_edges(spark, SF_SMALL)
    got = decode(edge_lines(spark, SF_SMALL, "txn"), "txn")
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in e.collect()}


def test_permissive_and_failfast(spark):
    df = spark.createDataFrame([("1 2",), ("x 3",), ("4 5",)], "value string")
    ok = decode(df, "pair", mode="PERMISSIVE").collect()
    assert [(r["src"], r["trg"]) for r in ok if r["_corrupt"] is None] == [(1, 2), (4, 5)]
    assert [r["_corrupt"] for r in ok if r["_corrupt"] is not None] == ["x 3"]
    with pytest.raises(Exception):
        decode(df, "pair").collect()


def test_comment_lines_skipped(spark):
    df = spark.createDataFrame([("% header",), ("1 2",), ("%x 3",)], "value string")
    got = [(r["src"], r["trg"]) for r in decode(df, "commented", mode="PERMISSIVE").collect()]
    assert (1, 2) in got and len(got) == 2  # only an exact '%' field marks a comment


def test_csv_sink_round_trip(spark, tmpdir_path):
    e = user_edges(spark, SF_SMALL).select("src", "trg", "amount", "pos")
    path = os.path.join(tmpdir_path, "csv")
    e.write.csv(path)                                # writeAsCsv
    back = spark.read.schema("src bigint, trg bigint, amount bigint, pos bigint").csv(path)
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in e.collect()}


def test_file_stream_and_console_sink(spark, tmpdir_path):
    lines = edge_lines(spark, SF_SMALL, "signed")
    src = os.path.join(tmpdir_path, "in")
    lines.write.text(src)
    stream = read_edge_text(spark, src, "signed", streaming=True)
    q = (stream.groupBy("chg").agg(F.count(F.lit(1)).alias("n")).writeStream.outputMode("complete")
         .format("console").option("checkpointLocation", os.path.join(tmpdir_path, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert sum(p["numInputRows"] for p in q.recentProgress) == lines.count()
