"""Joins beyond a plain equi-join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A side may be broadcast on purpose only up to so many rows.
BROADCAST_ROWS = 200_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast after counting up to the limit; a larger side keeps the planner's choice."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def match_by_key(candidates: DataFrame, register: DataFrame, key: str, value: str) -> DataFrame:
    """Adds n_hits and, where exactly one register row has the key, its value: MATCHED, AMBIGUOUS or NOT_IN_REGISTER."""
    groups = register.groupBy(key).agg(F.count(F.lit(1)).alias("n_hits"), F.min(value).alias(value))
    joined = candidates.join(groups, key, "left").withColumn("n_hits", F.coalesce("n_hits", F.lit(0)))
    status = F.when(F.col("n_hits") == 1, "MATCHED").when(F.col("n_hits") > 1, "AMBIGUOUS").otherwise("NOT_IN_REGISTER")
    return joined.withColumn("match_status", status).withColumn(value, F.when(F.col("n_hits") == 1, F.col(value)))


def bridge(left: DataFrame, bridge_df: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Inner join over the distinct pairs of a bridge table."""
    return left.join(bridge_df.select(left_key, right_key).distinct(), left_key).join(right, right_key)


def left_latest(left: DataFrame, right: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Left join to the newest row of each key on the right."""
    from gneiss.operators.windows import latest

    return left.join(latest(right, [key], order), key, "left")


def both_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows in one frame only, with ``side``."""
    return a.subtract(b).withColumn("side", F.lit("left")).unionByName(b.subtract(a).withColumn("side", F.lit("right")))


def on_file_name(left: DataFrame, right: DataFrame, left_path: str, right_path: str, how: str = "inner") -> DataFrame:
    """Join on the base name of two path columns."""
    base = lambda c: F.regexp_extract(c, r"([^/\\]+)$", 1)
    return left.withColumn("_base", base(left_path)).join(right.withColumn("_base", base(right_path)), "_base", how).drop("_base")


def on_bare_path(content: DataFrame, meta: DataFrame, path: str = "path") -> DataFrame:
    """Join on paths without their scheme and authority (file:/x, file:///x, hdfs://host/x and /x agree)."""
    bare = F.regexp_replace(F.col(path), "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    return content.withColumn("_bare", bare).drop(path).join(meta.withColumn("_bare", bare), "_bare").drop("_bare")
