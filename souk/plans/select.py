"""Values at given positions of a sorted order, found by counting instead of sorting.

A round groups all values that share the digits found so far by their next digit, of 20
bits, and the counts say which digit holds each position. Values are counted from the
smallest, so that a round is spent only on digits that differ, and four find any long. A
round's aggregate is bounded by the digits, whatever the number of rows; the driver learns
nothing but the positions' digits.

``cuts`` splits rows into equal parts by several measures, as ``ntile`` does. Only rows
whose value is that of a cut are ordered by key, to find the key at which the cut falls.
A row's parts then follow from the row alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from souk.plans.tables import materialize

_DIGIT = 20


@dataclass(frozen=True)
class Found:
    """The value at a position: ``left`` rows with the same value come before it."""

    measure: int
    position: int
    value: int
    left: int


def at_positions(
    df: DataFrame, values: Sequence[Column], wanted: Callable[[int], Iterable[int]]
) -> list[Found]:
    """The value at each position ``wanted`` of a measure, given its number of rows.

    ``values`` are longs, a measure each, and positions count from 0 in ascending order.
    NULLs don't count; positions beyond the rows are left out. Pass a written frame: each
    round reads it.
    """
    longs = [v.cast("bigint") for v in values]
    spans = df.agg(*(
        F.struct(F.count(v), F.min(v), F.max(v)).alias(f"span_{n}") for n, v in enumerate(longs)
    )).first()
    found, low, shift = [], {}, {}
    for measure, (rows, least, most) in enumerate(spans):
        if not rows:
            continue
        # A span beyond a long would overflow: its digits are those of the values themselves.
        wide = most - least >= 1 << 63
        low[measure] = 0 if wide else least
        shift[measure] = 64 if wide else (most - least).bit_length()
        found += [Found(measure, p, 0, p) for p in sorted(set(wanted(rows))) if 0 <= p < rows]
    while any(shift[f.measure] for f in found):
        open_ = {m for m in low if shift[m] and any(f.measure == m for f in found)}
        found = [f for f in found if f.measure not in open_] + _round(
            df, {m: longs[m] - low[m] for m in open_}, shift,
            [f for f in found if f.measure in open_])
        shift |= {m: max(0, shift[m] - _DIGIT) for m in open_}
    return [replace(f, value=f.value + low[f.measure]) for f in found]


def _round(
    df: DataFrame, values: dict[int, Column], shift: dict[int, int], found: list[Found]
) -> list[Found]:
    """``found``, whose values hold the digits so far, with one more digit."""
    listed = []
    for measure, value in values.items():
        after = max(0, shift[measure] - _DIGIT)
        # A shift by 64 would be one by 0: there are no digits yet.
        prefix = F.shiftright(value, shift[measure]) if shift[measure] < 64 else F.lit(0)
        prefixes = {f.value for f in found if f.measure == measure}
        listed.append(F.when(prefix.isin(prefixes), F.struct(
            F.lit(measure).alias("measure"), prefix.cast("bigint").alias("prefix"),
            F.shiftright(value, after).alias("next"))))
    digits = Window.partitionBy("measure", "prefix").orderBy("next")
    counts = (
        _listed(df, listed).filter("next IS NOT NULL").groupBy("measure", "prefix", "next")
        .agg(F.count("*").alias("held"))
        .withColumn("before", F.sum("held").over(digits) - F.col("held"))
    )
    at = counts.select(
        "measure", "prefix", "next", "before",
        _places(found, "prefix", "before", "held"),
    )
    return [
        Found(*row) for row in _fetched(at.select(
            "measure", "place.position", "next", F.col("place.left") - F.col("before")))
    ]


def _places(found: list[Found], value: str, before: str, held: str) -> Column:
    """A row's positions as ``place``, a row each: those with its measure and value, of which
    ``left`` falls into the ``held`` rows after ``before``.
    """
    known = ", ".join(
        f"struct({f.measure} AS of, CAST('{f.value}' AS BIGINT) AS at, {f.position}L AS position,"
        f" {f.left}L AS left)" for f in found)
    return F.expr(
        f"explode(filter(array({known}), p -> p.of = measure AND p.at = {value}"
        f" AND p.left >= {before} AND p.left < {before} + {held}))"
    ).alias("place")


def _listed(df: DataFrame, structs: Sequence[Column]) -> DataFrame:
    return df.select(F.inline(F.array(*structs)))


def _fetched(few: DataFrame) -> list[Row]:
    """Rows of a frame that its own aggregate bounds."""
    return few.agg(F.collect_list(F.struct("*"))).first()[0]


@dataclass(frozen=True)
class Cut:
    """The first row of a part: rows of a greater value, or of that and no smaller key."""

    measure: int
    value: int
    key: Any = None  # None: all rows of that value are of this part

    def reached(self, value: Column, key: Column) -> Column:
        if self.key is None:
            return value >= self.value
        return (value > self.value) | ((value == self.value) & (key >= F.lit(self.key)))


def cuts(df: DataFrame, key: str, values: Sequence[Column], parts: int) -> list[Cut]:
    """The first row of each of ``parts`` equal parts but the first, by each measure.

    Rows are ordered by value, equal ones by key, and the first parts take the remainder, one
    row each. ``key`` differs from row to row, values are not NULL. Pass a written frame.
    """
    def starts(rows: int) -> Iterable[int]:
        each, more = divmod(rows, parts)
        return (n * each + min(n, more) for n in range(1, parts))

    found = at_positions(df, values, starts)
    keys = _keys(df, key, values, [f for f in found if f.left])
    return [Cut(f.measure, f.value, keys.get((f.measure, f.position))) for f in found]


def _keys(
    df: DataFrame, key: str, values: Sequence[Column], found: list[Found]
) -> dict[tuple[int, int], Any]:
    """The key of the row at each position of ``found``, by (measure, position).

    Rows equal to a cut's value are dealt over ranges of keys, so that a crowd is spread, and
    only the ranges that hold a position are sorted.
    """
    if not found:
        return {}
    tied = {(f.measure, f.value) for f in found}
    ties = df.select(F.col(key).alias("key"), F.explode(F.array(*(
        F.when(values[m].cast("bigint") == value, F.struct(
            F.lit(m).alias("measure"), F.lit(value).cast("bigint").alias("value")))
        for m, value in sorted(tied)
    ))).alias("tie")).filter("tie IS NOT NULL").select("tie.*", "key")
    dealt = materialize(
        ties.repartitionByRange("measure", "value", "key")
        .withColumn("slice", F.spark_partition_id()))
    # A row per slice and value.
    slices = Window.partitionBy("measure", "value").orderBy("slice")
    starts = dealt.groupBy("measure", "value", "slice").agg(F.count("*").alias("size")).withColumn(
        "start", F.sum("size").over(slices) - F.col("size"))
    holds = starts.select(
        "measure", "value", "slice", _places(found, "value", "start", "size"), "start"
    ).select(
        "measure", "value", "slice", "place.position",
        (F.col("place.left") - F.col("start")).alias("number"))
    # Slices that hold a position, each once however many it holds.
    held = holds.groupBy("measure", "value", "slice").agg(
        F.collect_list(F.struct("number", "position")).alias("wanted"))
    within = Window.partitionBy("measure", "value", "slice").orderBy("key")
    numbered = dealt.join(F.broadcast(held), ["measure", "value", "slice"]).withColumn(
        "number", F.row_number().over(within) - 1)
    at = numbered.select("measure", "key", F.explode(F.filter(
        "wanted", lambda w: w.number == F.col("number"))).alias("place"))
    return {
        (row.measure, row.position): row.key
        for row in _fetched(at.select("measure", "place.position", "key"))
    }


def part(found: list[Cut], measure: int, value: Column, key: str) -> Column:
    """The part, from 1, of a row by a measure, given its cuts."""
    whole = value.cast("bigint")
    reached = [cut.reached(whole, F.col(key)) for cut in found if cut.measure == measure]
    return sum((F.when(r, 1).otherwise(0) for r in reached), F.lit(1)).cast("int")
