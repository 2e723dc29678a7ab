"""Folds and running values of a user's mergeable state, in order, over any type.

A :class:`Monoid` is given as column functions: ``lift`` makes the state of one row, ``merge(earlier, later)`` joins the states of
two adjacent stretches (associative, not necessarily commutative), ``zero`` is merged once before the first row and
``finish`` makes the output. The state may be of any type, structs and arrays included; a null state is the identity.

Nothing needs a key's rows in one task: rows get positions within their key by an ordered scan that spreads a hot key over many
range partitions, and every ``block`` consecutive rows are merged by an array fold. Blocks are merged ``fan_in`` at a time, level
by level, until one state per key is left (:func:`fold`); a running value (:func:`scan`) carries the states of earlier blocks down the
same levels. So lists are never longer than a block, and the number of levels is logarithmic in the longest key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType

from edgegraph.operators.positions import keyed_position

_I, _B, _S, _ROW, _PRE, _CARRY = "_mo_i", "_mo_b", "_mo_s", "_mo_row", "_mo_pre", "_mo_carry"


@dataclass(frozen=True)
class Monoid:
    lift: Column
    merge: Callable[[Column, Column], Column]
    finish: Callable[[Column], Column] = lambda state: state
    zero: Column | None = None

    def joined(self, kind) -> Callable[[Column, Column], Column]:
        """``merge`` with null as identity and results of the state's type."""
        return lambda a, b: F.when(a.isNull(), b).when(b.isNull(), a).otherwise(self.merge(a, b).cast(kind))

    def output(self, state: Column, kind) -> Column:
        return self.finish(state if self.zero is None else self.joined(kind)(self.zero.cast(kind), state))


def nullable(kind: DataType) -> DataType:
    """The type with nulls allowed at every depth, as a merge's results may have them where its inputs don't."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, nullable(f.dataType), True) for f in kind.fields])
    if isinstance(kind, ArrayType):
        return ArrayType(nullable(kind.elementType), True)
    if isinstance(kind, MapType):
        return MapType(kind.keyType, nullable(kind.valueType), True)
    return kind


def _lifted(df: DataFrame, monoid: Monoid) -> tuple[Column, DataType]:
    kind = nullable(df.select(monoid.lift.alias(_S)).schema[_S].dataType)
    return monoid.lift.cast(kind).alias(_S), kind


def _in_order(items: Column) -> Column:
    """A list of structs by their position; no other field needs an order."""
    return F.array_sort(items, lambda a, b: F.when(a[_I] < b[_I], -1).when(a[_I] > b[_I], 1).otherwise(0))


def _merged(items: Column, merge) -> Column:
    """One state of an ordered, non-empty list of (position, state)."""
    return F.aggregate(F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(0))), F.get(items, F.lit(0))[_S],
                       lambda acc, x: merge(acc, x[_S]))


def _prefixes(items: Column, merge) -> Column:
    """The running states of an ordered, non-empty list of (position, state)."""
    return F.aggregate(F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(0))), F.array(F.get(items, F.lit(0))[_S]),
                       lambda acc, x: F.concat(acc, F.array(merge(F.element_at(acc, -1), x[_S]))))


def _join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on equal or both null ``keys``."""
    other = right.select(*[F.col(k).alias(f"_mo_{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys])
    on = [left[k].eqNullSafe(other[f"_mo_{i}"]) for i, k in enumerate(keys)]
    return left.join(other, on, "left").drop(*[f"_mo_{i}" for i in range(len(keys))])


def _longest(rows: DataFrame) -> int:
    return rows.agg(F.max(_I)).first()[0] or 0


def fold(df: DataFrame, keys: Sequence[str], monoid: Monoid, order: Sequence[str] | None = None, name: str = "result",
         block: int = 256, fan_in: int | None = None) -> DataFrame:
    """``keys`` and ``name``: the finished state of each key's rows in ``order`` (unique within a key). Without ``order`` the merge
    must be commutative, and rows go to hash buckets. ``fan_in=2`` gives the shape of a binary merge tree."""
    keys, fan_in = list(keys), fan_in or block
    state, kind = _lifted(df, monoid)
    if order is None:
        rows = df.select(*keys, F.xxhash64(*df.columns).alias(_I), state)
        width = -(-(rows.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0) // block)
        part = rows.withColumn(_B, F.pmod(_I, F.lit(max(width, 1))))
    else:
        order = list(order)
        extra = [c for c in order if c not in keys]
        rows = keyed_position(df.select(*keys, *extra, state), keys, order, _I)
        width = -(-_longest(rows) // block)
        part = rows.select(*keys, _I, _S, F.expr(f"({_I} - 1) div {block}").alias(_B))
    merge = monoid.joined(kind)
    while True:
        lists = part.groupBy(*keys, _B).agg(F.collect_list(F.struct(_I, _S)).alias("_mo_list"))
        part = lists.select(*keys, F.col(_B).alias(_I), _merged(_in_order(F.col("_mo_list")), merge).alias(_S))
        if width <= 1:
            return part.select(*keys, monoid.output(F.col(_S), kind).alias(name))
        width = -(-width // fan_in)
        part = part.withColumn(_B, F.expr(f"{_I} div {fan_in}") if order is not None else F.pmod(_I, F.lit(width)))


def _carries(totals: DataFrame, keys: list[str], merge, width: int, block: int) -> DataFrame:
    """keys, block number, state of all earlier blocks (null for the first); ``totals`` has keys, number, state."""
    group = totals.withColumn(_B, F.expr(f"{_I} div {block}")).groupBy(*keys, _B).agg(F.collect_list(F.struct(_I, _S)).alias("_mo_list"))
    group = group.select(*keys, _B, _in_order(F.col("_mo_list")).alias("_mo_list")).select(
        "*", _prefixes(F.col("_mo_list"), merge).alias(_PRE))
    if width > block:
        above = group.select(*keys, F.col(_B).alias(_I), F.element_at(_PRE, -1).alias(_S))
        above = _carries(above, keys, merge, -(-width // block), block).withColumnRenamed(_I, _B)
        group = _join(group, above, [*keys, _B])
    else:
        group = group.withColumn(_CARRY, F.lit(None).cast(totals.schema[_S].dataType))
    item = group.select(*keys, F.posexplode("_mo_list").alias("_mo_at", "_mo_item"), _PRE, _CARRY)
    inside = F.when(F.col("_mo_at") > 0, F.get(F.col(_PRE), F.col("_mo_at") - 1))
    return item.select(*keys, F.col("_mo_item")[_I].alias(_I), merge(F.col(_CARRY), inside).alias(_CARRY))


def scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], monoid: Monoid, name: str = "result", block: int = 256) -> DataFrame:
    """``df`` with ``name``: the finished state of the key's rows up to and including this one, in ``order`` (unique within a key)."""
    keys, order = list(keys), list(order)
    columns = [c for c in df.columns if c != name]
    state, kind = _lifted(df, monoid)
    rows = keyed_position(df.select(*columns, state), keys, order, _I)
    merge = monoid.joined(kind)
    packed = rows.select(*[F.col(k) for k in keys], F.expr(f"({_I} - 1) div {block}").alias(_B),
                         F.struct(_I, _S, F.struct(*columns).alias(_ROW)).alias("_mo_item"))
    blocks = packed.groupBy(*keys, _B).agg(F.collect_list("_mo_item").alias("_mo_list"))
    blocks = blocks.select(*keys, _B, _in_order(F.col("_mo_list")).alias("_mo_list")).select(
        "*", _prefixes(F.col("_mo_list"), merge).alias(_PRE)).checkpoint(eager=True)
    totals = blocks.select(*keys, F.col(_B).alias(_I), F.element_at(_PRE, -1).alias(_S))
    width = (blocks.agg(F.max(_B)).first()[0] or 0) + 1
    carried = _join(blocks, _carries(totals, keys, merge, width, block).withColumnRenamed(_I, _B), [*keys, _B])
    out = carried.select(F.posexplode("_mo_list").alias("_mo_at", "_mo_item"), _PRE, _CARRY)
    running = merge(F.col(_CARRY), F.get(F.col(_PRE), F.col("_mo_at")))
    return out.select(F.col("_mo_item")[_ROW].alias(_ROW), monoid.output(running, kind).alias(name)).select(f"{_ROW}.*", name)


def clamped_walk(step: Column) -> Monoid:
    """A level that starts at 0, moves by ``step`` and never goes below 0, as composable pairs: a stretch with sum ``s`` and lowest
    running sum ``low`` (at most 0) maps a level d to max(d + s, s - low)."""
    s = step.cast("bigint")
    zero = F.lit(0).cast("bigint")
    return Monoid(F.struct(s.alias("s"), F.least(s, zero).alias("low")),
                  lambda a, b: F.struct((a["s"] + b["s"]).alias("s"), F.least(a["low"], a["s"] + b["low"]).alias("low")),
                  lambda x: x["s"] - x["low"])
