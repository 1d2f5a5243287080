"""Ranks, running sums and exact quantiles over all rows, without a task that sees them all.

Rows are dealt to ranges of the order and counted range by range; a running sum over one number per range, a small table,
then gives each range its start. Ranges are drawn from a sample, so the dealt rows are settled once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gneiss.session import settle

#: Rows of a segment of a series.
SEGMENT_ROWS = 20_000
_LOCAL_BITS = 33  # of monotonically_increasing_id: the row's number in its partition


def _starts(sums: DataFrame) -> DataFrame:
    """(_range, _start) of one (_range, _sum) row per range."""
    before = F.sum("_sum").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    return sums.select("_range", F.coalesce(before, F.lit(0)).alias("_start"))


def ranked(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Adds the row's place in the order, from 1 (ties as they come: give an order without)."""
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id())
    held = settle(dealt).withColumn("_range", F.shiftright("_m", _LOCAL_BITS))
    starts = _starts(held.groupBy("_range").agg(F.count(F.lit(1)).alias("_sum")))
    place = F.col("_start") + F.col("_m").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)) + 1
    return held.join(F.broadcast(starts), "_range").withColumn(name, place).drop("_range", "_m", "_start")


def ranked_in(df: DataFrame, group: str, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Adds the row's place in its group's order; a group may hold any share of the rows."""
    placed = ranked(df, [F.col(group), *order], "_place")
    first = placed.groupBy(F.col(group).alias("_group")).agg(F.min("_place").alias("_first"))
    return placed.join(first, F.col(group).eqNullSafe(F.col("_group"))).withColumn(name, F.col("_place") - F.col("_first") + 1).drop("_place", "_group", "_first")


def segmented(df: DataFrame, group: str, order: Sequence[Column], rows: int = SEGMENT_ROWS) -> DataFrame:
    """Adds _segment and _place (from 0): each group's order cut into segments of so many rows, so that a window over a
    group and a segment is bounded whatever share of all rows the group has."""
    placed = ranked_in(df, group, order, "_in_group").withColumn("_place", F.col("_in_group") - 1).drop("_in_group")
    return placed.withColumn("_segment", F.floor(F.col("_place") / rows).cast("long"))


def running_sum(df: DataFrame, order: Sequence[Column], value: Column, name: str) -> DataFrame:
    """Adds the sum of value over the rows before this one in the order, 0 for the first."""
    held = settle(df.withColumn("_v", value).repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    starts = _starts(held.groupBy("_range").agg(F.sum("_v").alias("_sum")))
    inside = F.sum("_v").over(Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    found = held.withColumn("_inside", F.coalesce(inside, F.lit(0))).join(F.broadcast(starts), "_range")
    return found.withColumn(name, F.col("_start") + F.col("_inside")).drop("_v", "_range", "_inside", "_start")


def at_ranks(df: DataFrame, value: str, wanted: Sequence[int], descending: bool = False) -> dict[int, float]:
    """The non-null values at the wanted places (from 1): as many numbers as are asked for come to the driver.

    Equal values are counted before they are dealt, so one that half the rows have is one row.
    """
    column = F.col(value).desc() if descending else F.col(value).asc()
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    placed = running_sum(counts, [column], F.col("_n"), "_before")
    places = F.filter(F.array(*(F.lit(k).cast("long") for k in sorted(set(wanted)))), lambda k: (k > F.col("_before")) & (k <= F.col("_before") + F.col("_n")))
    return {r["_place"]: float(r[value]) for r in placed.select(value, F.explode(places).alias("_place")).collect()}


def quantiles(df: DataFrame, value: str, shares: Sequence[float]) -> list[float | None]:
    """Exact quantiles, interpolated between neighbouring values; None without a value."""
    n = df.where(F.col(value).isNotNull()).count()
    if not n:
        return [None] * len(shares)
    at = [(n - 1) * q for q in shares]
    found = at_ranks(df, value, [k for x in at for k in (int(x) + 1, min(n, int(x) + 2))])
    return [found[int(x) + 1] + (found[min(n, int(x) + 2)] - found[int(x) + 1]) * (x - int(x)) for x in at]
