"""Window operators: latest rows, change history, rolling deviations, ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gneiss.operators import ranks


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column], nth: int = 1) -> DataFrame:
    """The nth row of each key in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == nth).drop("_rn")


def latest_and_previous(df: DataFrame, keys: Sequence[str], order: Sequence[Column], values: Sequence[str]) -> DataFrame:
    """One row per key: each value of the latest row and, as previous_<value>, of the one before."""
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= 2)
    picks = [F.max(F.when(F.col("_rn") == n, F.col(v))).alias(prefix + v) for n, prefix in ((1, ""), (2, "previous_")) for v in values]
    return ranked.groupBy(*keys).agg(*picks)


def scd2(daily: DataFrame, key: str, tracked: Sequence[str], as_of: str = "as_of_date") -> DataFrame:
    """Versions of a daily register: [valid_from, valid_to), version, is_current and a surrogate key.

    A row starts a version if any tracked column differs from the day before; null differs from every value.
    """
    signature = F.sha2(F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in tracked)), 256)
    w = Window.partitionBy(key).orderBy(as_of)
    changed = daily.withColumn("_sig", signature).withColumn("_before", F.lag("_sig").over(w)).where(F.col("_before").isNull() | (F.col("_before") != F.col("_sig")))
    out = changed.withColumns({"valid_from": F.col(as_of), "valid_to": F.lead(as_of).over(w), "version": F.row_number().over(w)})
    return out.withColumns({"is_current": F.col("valid_to").isNull(), "asset_sk": F.concat_ws("#", F.col(key).cast("string"), F.col("version").cast("string"))}).drop("_sig", "_before", as_of)


def rolling_zscore(
    df: DataFrame, key: str, order: Sequence[str], value: str, rows: int = 24, threshold: float = 3.0, min_change: float = 0.1, judged: Column | None = None,
    counted: Column | None = None, segment_rows: int = ranks.SEGMENT_ROWS,
) -> DataFrame:
    """Rows whose value deviates from the ``rows`` rows before them (the row itself left out).

    ``counted`` rows make the reference, at least half as many as ``rows`` are needed; only ``judged`` rows are reported.
    A reference that hardly varies (below 1e-6, or 1e-3 of its mean) judges nothing. ``order`` tells all rows of a key
    apart. A key's series is cut into segments, each with the ``rows`` last rows of the one before it, so that no window
    holds a whole series.
    """
    keep = df.columns
    placed = ranks.segmented(df, key, [F.col(c) for c in order], segment_rows)
    after = (F.floor((F.col("_place") + rows) / segment_rows)).cast("long")  # the segments that have the row in reach
    own = placed.withColumn("_in", F.explode(F.sequence("_segment", after)))
    w = Window.partitionBy(key, "_in").orderBy("_place").rowsBetween(-rows, -1)
    use = F.when(counted if counted is not None else F.lit(True), F.col(value))
    stats = own.withColumns({"_n": F.count(use).over(w), "baseline": F.avg(use).over(w), "_sd": F.stddev_pop(use).over(w), "_seen": F.count(F.lit(1)).over(w)})
    steady = (F.col("_sd") < 1e-6) | ((F.col("baseline") != 0) & (F.col("_sd") / F.abs("baseline") < 1e-3))
    change = F.abs(F.col(value) - F.col("baseline"))
    hit = (F.col("_in") == F.col("_segment")) & (F.col("_seen") == rows) & (F.col("_n") >= rows // 2) & ~steady
    hit = hit & (change >= threshold * F.col("_sd")) & (change >= min_change * F.greatest(F.abs("baseline"), F.lit(1e-9)))
    if judged is not None:
        hit = hit & judged
    return stats.where(hit).withColumn("zscore", (F.col(value) - F.col("baseline")) / F.col("_sd")).select(*keep, "baseline", "zscore")


def largest(df: DataFrame, keys: Sequence[str], by: Column, ties: Sequence[str]) -> DataFrame:
    """The row of each key with the largest value of an expression."""
    return latest(df, keys, [by.desc(), *(F.col(t) for t in ties)])


def revision_diff(df: DataFrame, group: str, order: str, items: str) -> DataFrame:
    """What each revision's set of items adds and removes against the one before in its group."""
    sets = df.groupBy(group, order).agg(F.sort_array(F.collect_set(items)).alias("items"))
    w = Window.partitionBy(group).orderBy(order)
    before = F.coalesce(F.lag("items").over(w), F.expr("cast(array() as array<string>)"))
    return sets.withColumn("_before", before).select(group, order, "items", F.array_except("items", "_before").alias("added"), F.array_except("_before", "items").alias("removed"))


def first_seen(df: DataFrame, digest: str, order: Sequence[Column], key: str) -> DataFrame:
    """Adds first_<key>, the key of the first row with the same digest, and is_duplicate.

    Rows come in ascending order, ties by key, which is unique. The first ones are partial minima joined back, so a digest
    that a third of all rows have is split like any skewed key.
    """
    place = F.struct(*(c.alias(f"_{i}") for i, c in enumerate(order)), F.col(key).alias("_key"))
    firsts = df.groupBy(F.col(digest).alias("_digest")).agg(F.min(place).alias("_first"))
    both = df.withColumn("_place", place).join(firsts, F.col(digest).eqNullSafe(F.col("_digest")))
    return both.select(*df.columns, F.col("_first._key").alias(f"first_{key}"), (F.col("_place") != F.col("_first")).alias("is_duplicate"))
