"""Exact quantiles that never gather a column in one task.

A column is counted into equal-width bins between its smallest and largest finite
value; the bin that holds a wanted rank is then binned again, between its own smallest
and largest value, until so few values are left that they are sorted as they are.
Infinities are counted apart.  Every round is one
pruned scan for all columns together, with map-side aggregation into at most ``BINS``
rows per range, and a value that fills a bin alone is found at once, however often it
occurs.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilth.schema import number

GATHER_ROWS = 20_000
BINS = 1024


@dataclass(frozen=True)
class _Range:
    """Values of a column between ``low`` and ``high``: how many, and how many lie below."""

    column: str
    low: float
    high: float
    below: int
    inside: int


def _between(x: Column, r: _Range) -> Column:
    return (x >= F.lit(r.low)) & (x <= F.lit(r.high))


def _split(df: DataFrame, ranges: Sequence[_Range], bins: int) -> dict[_Range, list[_Range]]:
    """Count every range into bins, all in one scan: at most ``bins`` rows per range leave a task."""
    cells = []
    for i, r in enumerate(ranges):
        x = number(df, r.column)
        # Halves keep the width of any two doubles finite.
        share = (x / 2 - r.low / 2) / F.lit(r.high / 2 - r.low / 2)
        place = F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int")
        cells.append(F.when(_between(x, r), F.struct(F.lit(i).alias("r"), place.alias("b"), x.alias("x"))))
    placed = df.select(F.inline(F.array_compact(F.array(*cells))))
    counted = placed.groupBy("r", "b").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).collect()
    out: dict[_Range, list[_Range]] = {r: [] for r in ranges}
    for row in sorted(counted, key=lambda c: (c["r"], c["b"])):
        whole = ranges[row["r"]]
        parts = out[whole]
        below = parts[-1].below + parts[-1].inside if parts else whole.below
        parts.append(_Range(whole.column, row["low"], row["high"], below, row["n"]))
    return out


def _order_statistics(
    df: DataFrame, start: Mapping[str, _Range], ranks: Sequence[tuple[str, int]], gather_rows: int, bins: int
) -> dict[tuple[str, int], float]:
    """The values at 0-based ranks of columns."""
    where = {(c, k): start[c] for c, k in ranks}
    while wide := sorted(
        {r for r in where.values() if r.low < r.high and r.inside > gather_rows},
        key=lambda r: (r.column, r.low),
    ):
        parts = _split(df, wide, bins)
        for (c, k), r in where.items():
            if r in parts:
                where[c, k] = next(p for p in parts[r] if p.below <= k < p.below + p.inside)
    found = {key: r.low for key, r in where.items() if r.low == r.high}
    rest = sorted({r for r in where.values() if r.low < r.high}, key=lambda r: (r.column, r.low))
    if rest:
        held = [
            F.array_sort(F.collect_list(F.when(_between(number(df, r.column), r), number(df, r.column))))
            for r in rest
        ]
        picks = [
            held[rest.index(r)][k - r.below].alias(f"v{i}")
            for i, ((_, k), r) in enumerate(where.items())
            if r.low < r.high
        ]
        row = df.agg(*picks).first()
        for i, key in enumerate(where):
            if where[key].low < where[key].high:
                found[key] = row[f"v{i}"]
    return found


def _lerp(a: float, b: float, part: float) -> float:
    return a if a == b or part == 0 else a + (b - a) * part


def quantiles(
    df: DataFrame,
    wanted: Mapping[str, Sequence[float]],
    *,
    gather_rows: int | None = None,
    bins: int = BINS,
) -> dict[str, list[float | None]]:
    """Linear-interpolated exact quantiles of non-null values, per column."""
    gather_rows = GATHER_ROWS if gather_rows is None else gather_rows
    if not wanted:
        return {}
    names = list(wanted)
    df = df.select(*names)
    finite = {c: F.when(F.abs(number(df, c)) < F.lit(math.inf), number(df, c)) for c in names}
    row = df.agg(
        *[
            F.struct(
                F.count(number(df, c)).alias("n"),
                F.count(finite[c]).alias("inside"),
                F.count_if(number(df, c) == F.lit(-math.inf)).alias("below"),
                F.min(finite[c]).alias("low"),
                F.max(finite[c]).alias("high"),
            ).alias(f"s{i}")
            for i, c in enumerate(names)
        ]
    ).first()
    spans = {c: row[f"s{i}"] for i, c in enumerate(names)}
    ends = {}
    for c in names:
        for p in wanted[c] if spans[c]["n"] else []:
            position = p * (spans[c]["n"] - 1)
            ends[c, p] = (math.floor(position), math.ceil(position), position % 1)
    start = {c: _Range(c, s["low"], s["high"], s["below"], s["inside"]) for c, s in spans.items() if s["inside"]}
    ranks = sorted({(c, k) for (c, _), (a, b, _) in ends.items() for k in (a, b)})
    values, inner = {}, []
    for c, k in ranks:
        if k < spans[c]["below"]:
            values[c, k] = -math.inf
        elif k >= spans[c]["below"] + spans[c]["inside"]:
            values[c, k] = math.inf
        else:
            inner.append((c, k))
    if inner:
        values.update(_order_statistics(df, start, inner, gather_rows, bins))
    return {c: [_lerp(values[c, ends[c, p][0]], values[c, ends[c, p][1]], ends[c, p][2]) if spans[c]["n"] else None for p in wanted[c]] for c in names}
