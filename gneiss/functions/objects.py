"""What a landed object's name, side file and source say about it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def asset_hint(source: Column, name: Column, patterns: Mapping[str, str], constants: Mapping[str, str] | None = None, sidecar: Column | None = None) -> Column:
    """(hint, basis): a side file's own word first, then a source's constant, then the first group of its name pattern.

    Both are null where nothing is said.
    """
    none = F.lit(None).cast("string")
    pair = lambda hint, basis: F.struct(hint.alias("hint"), F.lit(basis).alias("basis"))
    out = F.when(sidecar.isNotNull(), pair(sidecar, "SIDECAR")) if sidecar is not None else F.when(F.lit(False), pair(none, ""))
    for key, value in (constants or {}).items():
        out = out.when(source == key, pair(F.lit(value), "CONSTANT"))
    for key, pattern in patterns.items():
        found = F.regexp_extract(name, pattern, 1)
        out = out.when((source == key) & (found != ""), pair(found, "FILE_NAME"))
    return out.otherwise(F.struct(none.alias("hint"), none.alias("basis")))


def with_capture_time(objects: DataFrame, name: str = "file_name", sidecar_time: str = "sidecar_time", date: str = "business_date") -> DataFrame:
    """Adds captured_at: an object's own side file time, else that of the side file with the same stem, else midnight.

    The side files of a date are few next to the objects and are reduced to a row per stem before they are joined.
    """
    stem = F.regexp_replace(F.col(name), r"\.[^.]*$", "")
    rows = objects.withColumn("_stem", stem)
    times = rows.where(F.col(sidecar_time).isNotNull()).groupBy("_stem", date).agg(F.min(sidecar_time).alias("_at"))
    joined = rows.join(times, ["_stem", date], "left")
    return joined.withColumn("captured_at", F.coalesce(sidecar_time, "_at", F.col(date).cast("timestamp"))).drop("_stem", "_at")
