"""Decoders for the reference's text line formats, over any frame with a ``value STRING`` column.

The same functions serve ``spark.read.text`` (batch), ``spark.readStream.text`` (file stream) and a
message-bus stream whose payload is cast to string, so the parsing stays JVM-side (``split``/``cast``).
``mode="FAILFAST"`` raises on a malformed number (ANSI cast, like the reference's parseLong);
``mode="PERMISSIVE"`` yields nulls and keeps the raw line in ``_corrupt``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Field separators of the reference's formats.
WHITESPACE = r"\s"
TAB = "\t"
# Fixed value: item ids of a rating file are offset by one million, weights are rating x 10.
RATING_ITEM_OFFSET = 1000000
RATING_WEIGHT_FACTOR = 10

FORMATS = ("pair", "pair_tab", "commented", "timed", "signed", "txn", "rating")


def _num(field: Column, mode: str) -> Column:
    return field.cast("bigint") if mode == "FAILFAST" else field.try_cast("bigint")


def _fields(df: DataFrame, sep: str) -> Column:
    return F.split(F.col("value"), sep)


def _finish(out: DataFrame, mode: str, needed: list[str]) -> DataFrame:
    if mode == "PERMISSIVE":
        bad = F.lit(False)
        for c in needed:
            bad = bad | F.col(c).isNull()
        return out.withColumn("_corrupt", F.when(bad, F.col("_line")).otherwise(F.lit(None))).drop("_line")
    return out.drop("_line")


def parse_pairs(df: DataFrame, sep: str = WHITESPACE, skip_comments: bool = False,
                mode: str = "FAILFAST") -> DataFrame:
    """``src trg`` lines. With ``skip_comments`` a line whose first field is exactly ``%`` is dropped."""
    f = _fields(df, sep)
    base = df.select(F.col("value").alias("_line"), f.alias("_f"))
    if skip_comments:
        base = base.where(F.col("_f")[0] != F.lit("%"))
    out = base.select("_line", _num(F.col("_f")[0], mode).alias("src"), _num(F.col("_f")[1], mode).alias("trg"))
    return _finish(out, mode, ["src", "trg"])


def parse_timed(df: DataFrame, sep: str = WHITESPACE, mode: str = "FAILFAST") -> DataFrame:
    """``src trg ts_ms`` lines; ``ts`` becomes an event-time TIMESTAMP."""
    f = _fields(df, sep)
    out = df.select(F.col("value").alias("_line"), f.alias("_f")).select(
        "_line", _num(F.col("_f")[0], mode).alias("src"), _num(F.col("_f")[1], mode).alias("trg"),
        F.timestamp_millis(_num(F.col("_f")[2], mode)).alias("ts"))
    return _finish(out, mode, ["src", "trg", "ts"])


def parse_signed(df: DataFrame, sep: str = WHITESPACE, mode: str = "FAILFAST") -> DataFrame:
    """``src trg sign`` lines: ``+`` is an addition (chg = 1), anything else a deletion (chg = -1)."""
    f = _fields(df, sep)
    out = df.select(F.col("value").alias("_line"), f.alias("_f")).select(
        "_line", _num(F.col("_f")[0], mode).alias("src"), _num(F.col("_f")[1], mode).alias("trg"),
        F.when(F.col("_f")[2] == F.lit("+"), F.lit(1)).otherwise(F.lit(-1)).alias("chg"))
    return _finish(out, mode, ["src", "trg"])


def parse_txn(df: DataFrame, sep: str = WHITESPACE, mode: str = "FAILFAST") -> DataFrame:
    """``src trg amount ts_ms`` transaction lines."""
    f = _fields(df, sep)
    out = df.select(F.col("value").alias("_line"), f.alias("_f")).select(
        "_line", _num(F.col("_f")[0], mode).alias("src"), _num(F.col("_f")[1], mode).alias("trg"),
        _num(F.col("_f")[2], mode).alias("amount"),
        F.timestamp_millis(_num(F.col("_f")[3], mode)).alias("ts"))
    return _finish(out, mode, ["src", "trg", "amount", "ts"])


def parse_ratings(df: DataFrame, sep: str = TAB, item_offset: int = RATING_ITEM_OFFSET,
                  factor: int = RATING_WEIGHT_FACTOR, mode: str = "FAILFAST") -> DataFrame:
    """``user item rating`` lines to weighted bipartite edges (item ids offset, weight = rating x factor)."""
    f = _fields(df, sep)
    out = df.select(F.col("value").alias("_line"), f.alias("_f")).select(
        "_line", _num(F.col("_f")[0], mode).alias("src"),
        (_num(F.col("_f")[1], mode) + F.lit(item_offset)).alias("trg"),
        (_num(F.col("_f")[2], mode) * F.lit(factor)).alias("amount"))
    return _finish(out, mode, ["src", "trg", "amount"])


_DECODERS = {
    "pair": lambda df, mode: parse_pairs(df, WHITESPACE, mode=mode),
    "pair_tab": lambda df, mode: parse_pairs(df, TAB, mode=mode),
    "commented": lambda df, mode: parse_pairs(df, WHITESPACE, skip_comments=True, mode=mode),
    "timed": lambda df, mode: parse_timed(df, mode=mode),
    "signed": lambda df, mode: parse_signed(df, mode=mode),
    "txn": lambda df, mode: parse_txn(df, mode=mode),
    "rating": lambda df, mode: parse_ratings(df, mode=mode),
}


def decode(df: DataFrame, fmt: str, mode: str = "FAILFAST") -> DataFrame:
    return _DECODERS[fmt](df, mode)


def read_edge_text(spark: SparkSession, path: str, fmt: str, streaming: bool = False,
                   mode: str = "FAILFAST") -> DataFrame:
    """Read text files of a given line format as an edge frame (batch or file stream)."""
    reader = spark.readStream if streaming else spark.read
    return decode(reader.text(path), fmt, mode)
