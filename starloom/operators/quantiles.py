"""Exact quantiles (linear interpolation, as numpy) by radix selection.

A quantile is one or two order statistics. The values of all columns are one list of
(column, value); each round divides every range that holds a wanted rank into ``BUCKETS``
equal parts, counts the values of each part and takes its ends, in one aggregate over
(range, part). The part that holds a rank is the next round's range, until its values are all
equal, the rank is an end of it, or it holds at most ``keep`` values; those are counted by
value and read off.

A part is a monotone function of the value, so counts and ends are exact whatever the rounding.
Every round is one scan with a small hash table (ranges x parts): no table of a column's values
is ever shuffled. The driver sees the parts of the open ranges. NaN counts as missing.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import accumulate
from math import floor
from sys import float_info

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 512
#: Values of a range that are ranked one by one.
KEEP = 100_000


def number(c: str | Column) -> Column:
    """The column as a double with NaN as missing."""
    x = (F.col(f"`{c}`") if isinstance(c, str) else c).cast("double")
    return F.when(~F.isnan(x), x)


def long_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(i, x): the values of all columns, one row each, by the column's place in ``cols``."""
    if not cols:
        return df.sparkSession.createDataFrame([], "i int, x double")
    return (df.select(F.posexplode(F.array(*[number(c) for c in cols])).alias("i", "x"))
            .where(F.col("x").isNotNull()))


@dataclass
class _Range:
    """Values of a column from ``lo`` to ``hi``; ``below`` values are smaller."""
    i: int
    lo: float
    hi: float
    below: int
    n: int
    ranks: list[int] = field(default_factory=list)


def _ranks(n: int, p: float) -> tuple[int, int, float]:
    h = (n - 1) * p
    low = floor(h)
    return low, min(low + 1, n - 1), h - low


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    keep: int = KEEP, buckets: int = BUCKETS) -> DataFrame:
    """(column_name, prob, quantile) for every column that has values."""
    spark = df.sparkSession
    data = long_values(df, cols)
    found: dict[tuple[int, int], float] = {}
    first = [_Range(r["i"], r["lo"], r["hi"], 0, r["n"]) for r in data.groupBy("i").agg(
        F.count("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect()]
    sizes = {r.i: r.n for r in first}
    for r in first:
        r.ranks = sorted({k for p in probs for k in _ranks(r.n, p)[:2]})
    few: list[_Range] = []
    open_ = _settle(first, found, few, keep)
    while open_:
        open_ = _settle(_divide(data, open_, buckets), found, few, keep)
    _read_off(data, few, found)
    rows = []
    for i, n in sorted(sizes.items()):
        for p in probs:
            low, high, t = _ranks(n, p)
            a, b = found[i, low], found[i, high]
            # numpy's interpolation: from the nearer end.
            rows.append((cols[i], float(p), float(b - (b - a) * (1 - t) if t >= 0.5 else a + (b - a) * t)))
    return spark.createDataFrame(rows, "column_name string, prob double, quantile double")


def _settle(ranges: list[_Range], found: dict, few: list[_Range], keep: int) -> list[_Range]:
    """Ranks at a range's ends are known; small ranges are read off later; the rest stay open."""
    open_ = []
    for r in ranges:
        for k in r.ranks:
            if r.lo == r.hi or k == r.below:
                found[r.i, k] = r.lo
            elif k == r.below + r.n - 1:
                found[r.i, k] = r.hi
        r.ranks = [k for k in r.ranks if (r.i, k) not in found]
        if r.ranks:
            (few if r.n <= keep else open_).append(r)
    return open_


def _within(data: DataFrame, ranges: list[_Range]) -> DataFrame:
    """(k, lo, hi, x): the values that lie in each range."""
    side = data.sparkSession.createDataFrame([(k, r.i, r.lo, r.hi) for k, r in enumerate(ranges)],
                                             "k int, i int, lo double, hi double")
    # A few rows for each (column, quantile).
    return data.join(F.broadcast(side), "i").where(F.col("x").between(F.col("lo"), F.col("hi")))


def _divide(data: DataFrame, ranges: list[_Range], buckets: int) -> list[_Range]:
    """The parts of each range that hold its ranks."""
    x = F.col("x")
    # Halves cannot overflow; infinite ends are cut to the largest number.
    lo, hi = (F.greatest(F.least(F.col(c), F.lit(float_info.max)), F.lit(-float_info.max)) / 2 for c in ("lo", "hi"))
    part = F.least(F.floor(F.coalesce(F.try_divide(x / 2 - lo, hi - lo), F.lit(0.0)) * buckets), F.lit(buckets - 1))
    part = F.when(x <= F.col("lo"), 0).when(x >= F.col("hi"), buckets - 1).otherwise(part).cast("int")
    rows = (_within(data, ranges).select("k", part.alias("part"), "x").groupBy("k", "part")
            .agg(F.count("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect())
    by_range: dict[int, list] = {}
    for row in sorted(rows, key=lambda r: (r["k"], r["part"])):
        by_range.setdefault(row["k"], []).append(row)
    out = []
    for k, parts in by_range.items():
        r = ranges[k]
        ends = list(accumulate((p["n"] for p in parts), initial=r.below))
        inside: dict[int, _Range] = {}
        for rank in r.ranks:
            at = bisect_right(ends, rank) - 1
            p = parts[at]
            inside.setdefault(at, _Range(r.i, p["lo"], p["hi"], ends[at], p["n"])).ranks.append(rank)
        out += inside.values()
    return out


def _read_off(data: DataFrame, ranges: list[_Range], found: dict[tuple[int, int], float]) -> None:
    """Counts the values of small ranges one by one and takes the wanted ranks."""
    if not ranges:
        return
    counts = _within(data, ranges).groupBy("k", "x").agg(F.count(F.lit(1)).alias("n"))
    # At most ``keep`` rows in a window.
    last = F.sum("n").over(Window.partitionBy("k").orderBy("x").rowsBetween(Window.unboundedPreceding, 0))
    wanted = data.sparkSession.createDataFrame(
        [(k, rank, rank - r.below) for k, r in enumerate(ranges) for rank in r.ranks], "k int, rank long, at long")
    rows = (counts.withColumn("last", last).join(F.broadcast(wanted), "k")
            .where((F.col("at") < F.col("last")) & (F.col("at") >= F.col("last") - F.col("n")))
            .select("k", "rank", "x").collect())
    for row in rows:
        found[ranges[row["k"]].i, row["rank"]] = row["x"]
