"""Scalar column helpers shared by all operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: 2**60, the range of 15 hex digits of an md5 digest.
HEX15_RANGE = 1152921504606846976


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_to_instant(c: str | Column) -> Column:
    """TIMESTAMP_NTZ wall-clock value -> TIMESTAMP instant, reading the wall clock as UTC whatever the
    session time zone is (NTZ arithmetic from the epoch has no zone)."""
    name = c if isinstance(c, str) else None
    ntz = F.col(name) if name else c
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ntz)
    return F.timestamp_micros(micros)


def epoch_ms(c: str | Column) -> Column:
    """Epoch milliseconds of a TIMESTAMP column."""
    return F.unix_millis(col(c))


def win_start_ms(window_col: str = "window") -> Column:
    return F.unix_millis(F.col(f"{window_col}.start"))


def win_end_ms(window_col: str = "window") -> Column:
    return F.unix_millis(F.col(f"{window_col}.end"))


def win_max_ts(window_col: str = "window") -> Column:
    """Largest timestamp (ms) inside a window: end minus one millisecond."""
    return F.unix_millis(F.col(f"{window_col}.end")) - F.lit(1)


def md5_bigint(*parts: Column) -> Column:
    """Repeatable pseudo-random 60-bit integer from the md5 of ``part1:part2:...``.

    Pass literals as ``F.lit(...)``. Equals DuckDB's
    ``CAST('0x' || substr(md5(x), 1, 15) AS BIGINT)`` for the same text.
    """
    text = F.concat_ws(":", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def md5_uniform(*parts: Column) -> Column:
    """Uniform double in (0, 1] from :func:`md5_bigint`."""
    return (md5_bigint(*parts) + F.lit(1)).cast("double") / F.lit(float(HEX15_RANGE))
