"""Sensor telemetry: time parts, tumbling windows in batch and stream, exactly-once sinks, alarm states, control counts."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from gneiss.functions.columns import to_psi
from gneiss.operators import ranks
from gneiss.operators.aggregates import window_stats
from gneiss.plans.contracts import Contract, parse_stream
from gneiss.session import settle
from gneiss.sources import batches

WATERMARK = "10 minutes"
SIZES = ("1 minute", "15 minutes")
#: A window is flat if it hardly varies over enough readings.
FLAT_STD, FLAT_READINGS = 1e-9, 5


def with_time_parts(df: DataFrame, event: str = "event_ts", sent: str | None = None) -> DataFrame:
    """event_date, event_hour and, if a send time in milliseconds is named, lateness_s."""
    out = df.withColumns({"event_date": F.to_date(event), "event_hour": F.hour(event)})
    return out.withColumn("lateness_s", (F.col(sent) - F.unix_millis(event)) / 1000.0) if sent else out


def normalised(df: DataFrame, value: str = "value", unit: str = "unit") -> DataFrame:
    """Pressures in psi; is_bar remembers the conversion."""
    return df.withColumns({"is_bar": F.col(unit) == "bar", value: to_psi(F.col(value), F.col(unit))})


def seconds_of_day(event: Column) -> Column:
    """Small numbers keep the slope's sums exact."""
    return (F.hour(event) * 3600 + F.minute(event) * 60 + F.second(event)).cast("double")


def windows(df: DataFrame, key: str, size: str, event: str = "event_ts", value: str = "value", counts: Mapping[str, Column] | None = None) -> DataFrame:
    """Statistics per key and tumbling window of one size; on a stream, set a watermark on the event time first.

    Each size is an aggregation of its own: one watermark over mixed window ends would close the small windows early.
    """
    df = df.withColumn("_w", F.window(event, size))
    out = window_stats(df, [key, "_w"], value, seconds_of_day(F.col(event)), event, counts)
    return out.select(key, F.lit(size).alias("window_size"), F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *(c for c in out.columns if c not in (key, "_w")))


def flags(df: DataFrame, threshold: Column, long_size: str = SIZES[-1], least: int = FLAT_READINGS) -> DataFrame:
    """is_flat; is_stuck, a flat window of the long size; is_breach, the maximum above the threshold."""
    flat = (F.col("std_value") < FLAT_STD) & (F.col("n") >= least)
    return df.withColumns({"is_flat": flat, "is_stuck": flat & (F.col("window_size") == long_size), "is_breach": F.col("max_value") > threshold})


def daily(window_rows: DataFrame, key: str) -> DataFrame:
    """Windows rolled up per key and day: readings, mean of means, maximum, mean slope, flagged windows."""
    n = lambda c: F.sum(F.when(F.col(c), 1).otherwise(0)).cast("long")
    return window_rows.groupBy(key, F.to_date("window_start").alias("day")).agg(
        F.sum("n").alias("n_readings"), F.avg("mean_value").alias("mean_value"), F.max("max_value").alias("max_value"), F.avg("slope_per_h").alias("slope_per_h"), n("is_stuck").alias("stuck_windows"), n("is_breach").alias("breach_windows"), F.count(F.lit(1)).alias("n_windows")
    )


def stream_windows(stream: DataFrame, key: str, size: str, path: str, checkpoint: str, event: str = "event_ts", watermark: str = WATERMARK, **options) -> StreamingQuery:
    """Update-mode windows kept as one row each in a table of days: every batch is folded into the days it touches.

    A window's newest row wins and a replayed batch changes nothing (see ``batches.fold``), so a day has as many files
    after any number of batches. Read the result with ``read_windows``.
    """
    found = windows(stream.withWatermark(event, watermark), key, size, event, **options)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumns({"_batch": F.lit(batch_id).cast("long"), "day": F.date_format("window_start", "yyyy-MM-dd")})
        batches.fold(rows, path, [key, "window_size", "window_start", "day"], "_batch", "day", f"b{batch_id:012d}")

    return found.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_windows(spark, path: str) -> DataFrame:
    """The windows that ``stream_windows`` keeps."""
    return spark.read.parquet(path).drop("_batch", "day")


def batch_folders(sinks: Mapping[str, tuple[Callable[[DataFrame], DataFrame], str]]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: each sink's rows go to a folder per batch under its path, exactly once.

    A finished folder is left alone when a batch comes again, an unfinished one is overwritten, sink by sink; so a
    restart neither loses nor doubles rows, and the path can be read as a table or as a stream of its own.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            for select, path in sinks.values():
                folder = f"{path}/_b={batch_id:012d}"
                if not batches.finished(batch.sparkSession, folder):
                    select(held).write.mode("overwrite").parquet(folder)
        finally:
            with contextlib.suppress(Exception):
                held.unpersist()

    return run


def stream_bronze(stream: DataFrame, contract: Contract, good: str, quarantine: str, checkpoint: str) -> StreamingQuery:
    """Messages parsed by their contract: accepted ones and, with their reasons, rejected ones in two exactly-once sinks."""
    sinks = {
        "good": (lambda b: b.where(F.size("reject_reasons") == 0).drop("reject_reasons", "payload"), good),
        "quarantine": (lambda b: b.where(F.size("reject_reasons") > 0).select("payload", "reject_reasons", "timestamp"), quarantine),
    }
    writer = parse_stream(stream, contract).writeStream.foreachBatch(batch_folders(sinks))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def table_stream(spark, path: str, schema) -> DataFrame:
    """A table of batch folders as a stream of the rows appended to it."""
    return spark.readStream.schema(schema).parquet(path)


def route_alarms(batch: DataFrame, priorities: tuple[str, ...] = ("1", "2")) -> dict[str, DataFrame]:
    """Parsed alarms by destination: urgent ones, all valid ones, and those with reject reasons."""
    valid = batch.where(F.size("reject_reasons") == 0)
    return {"priority": valid.where(F.col("priority").isin(*priorities)), "all": valid, "quarantine": batch.where(F.size("reject_reasons") > 0)}


def stream_router(stream: DataFrame, contract: Contract, path: str, checkpoint: str, interval: str = "10 seconds", priorities: tuple[str, ...] = ("1", "2"), sent: str = "timestamp") -> StreamingQuery:
    """A running stream of alarm messages to three destinations under a path, by a processing-time trigger.

    Each destination has a folder for each batch and in it one for each five minutes of sending; a batch that comes again
    after a restart leaves what is finished and writes the rest anew.
    """
    bucket = F.date_format(F.timestamp_millis(F.floor(F.col(sent) / 300_000) * 300_000), "yyyyMMddHHmm")

    def run(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            for name, rows in route_alarms(held, priorities).items():
                folder = f"{path}/{name}/_b={batch_id:012d}"
                if not batches.finished(batch.sparkSession, folder):
                    rows.withColumn("bucket", bucket).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").json(folder)
        finally:
            with contextlib.suppress(Exception):
                held.unpersist()

    parsed = parse_stream(stream, contract).writeStream.foreachBatch(run)
    return parsed.option("checkpointLocation", checkpoint).trigger(processingTime=interval).start()


def await_and_stop(query: StreamingQuery) -> None:
    """Wait until all that has arrived is processed, then stop the stream; its failure is raised here."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def routed(spark, path: str, name: str, schema: str) -> DataFrame:
    """What one destination holds, with the five-minute bucket; schema as DDL."""
    return spark.read.schema(f"{schema}, bucket string").option("basePath", f"{path}/{name}").json(f"{path}/{name}/_b=*")


def control_counts(stream: DataFrame, event: str, keys: tuple[str, ...], delay: str = WATERMARK) -> DataFrame:
    """Messages per minute and key; on a stream each minute is released once it is older than the delay."""
    counted = stream.withWatermark(event, delay) if stream.isStreaming else stream
    return counted.groupBy(F.window(event, "1 minute").alias("_w"), *keys).agg(F.count(F.lit(1)).alias("total")).select(F.col("_w.start").alias("minute"), *keys, "total")


def stream_control_counts(stream: DataFrame, event: str, keys: tuple[str, ...], path: str, checkpoint: str, delay: str = WATERMARK) -> StreamingQuery:
    """Control counts as a stream in append mode: a minute is written once, when the watermark has passed its end."""
    sink = batch_folders({"counts": (lambda b: b, path)})
    counted = control_counts(stream, event, keys, delay).writeStream.outputMode("append").foreachBatch(sink)
    return counted.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


# -- alarms: raise at HI and HIHI, clear below 85 % of HI
CLEAR_SHARE = 0.85


def alarm_step(active: str | None, value: float, hi: float, hihi: float) -> tuple[str | None, tuple[str, str] | None]:
    """(state after the reading, (level, ACTIVE or CLEARED) if an event is due)."""
    level = "HIHI" if value >= hihi else "HI" if value >= hi else None
    if level and level != active and (active is None or level == "HIHI"):
        return level, (level, "ACTIVE")
    if active and value < hi * CLEAR_SHARE:
        return None, (active, "CLEARED")
    return active, None


_ALARM = "{key} {kind}, event_ts {time}, seq long, alarm_type string, state string, value double"


def alarms(readings: DataFrame, key: str, event: str, value: str, seq: str, hi: float, hihi: float, segment_rows: int = ranks.SEGMENT_ROWS) -> DataFrame:
    """Alarm events of each key's readings in event order, by a segmented scan.

    A clearing reading begins a new stretch of its key. The level of a reading is the highest one reached in its stretch,
    so an alarm is raised where the level rises, and cleared where a stretch begins after one with a level. What a
    segment of the series does to the level is two values (the highest since its last clearing, and whether it has one),
    so a scan over a row for each segment gives the level at which each begins, and no window holds a whole series.
    """
    rows = readings.select(key, F.col(event).alias("event_ts"), F.col(seq).cast("long").alias("seq"), F.col(value).cast("double").alias("value"))
    clears = F.col("value") < hi * CLEAR_SHARE
    level = F.when(F.col("value") >= hihi, 2).when(F.col("value") >= hi, 1).otherwise(0)
    rows = settle(ranks.segmented(rows, key, [F.col("event_ts"), F.col("seq")], segment_rows))
    at = F.max(F.when(clears, F.col("_place")))
    last = rows.groupBy(key, "_segment").agg(at.alias("_cleared"))
    # The highest level of a segment after its last clearing, by a second look at its rows.
    tails = rows.join(last.select(F.col(key).alias("_k"), F.col("_segment").alias("_s"), "_cleared"), F.col(key).eqNullSafe(F.col("_k")) & (F.col("_segment") == F.col("_s")))
    sums = tails.groupBy(key, "_segment").agg(F.max(F.when(F.col("_place") >= F.coalesce("_cleared", F.lit(-1)), level)).alias("_high"), F.any_value("_cleared").isNotNull().alias("_clears"))
    order = Window.partitionBy(key).orderBy("_segment")
    runs = sums.withColumn("_run", F.count(F.when(F.col("_clears"), 1)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    reached = F.max("_high").over(Window.partitionBy(key, "_run").orderBy("_segment").rowsBetween(Window.unboundedPreceding, 0))
    starts = runs.withColumn("_reached", reached).withColumn("_start", F.coalesce(F.lag("_reached").over(order), F.lit(0)))
    starts = starts.select(F.col(key).alias("_k"), F.col("_segment").alias("_s"), "_start")
    rows = rows.join(starts, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_segment") == F.col("_s"))).drop("_k", "_s")
    w = Window.partitionBy(key, "_segment").orderBy("_place")
    rows = rows.withColumn("_stretch", F.count(F.when(clears, 1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    inside = F.max(level).over(Window.partitionBy(key, "_segment", "_stretch").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("_level", F.greatest(inside, F.when(F.col("_stretch") == 0, F.col("_start")).otherwise(0)))
    rows = rows.withColumn("_before", F.coalesce(F.lag("_level").over(w), F.col("_start")))
    name = lambda c: F.when(c == 2, "HIHI").otherwise("HI")
    found = rows.where(F.when(clears, F.col("_before") > 0).otherwise(F.col("_level") > F.col("_before")))
    kind, state = F.when(clears, name(F.col("_before"))).otherwise(name(F.col("_level"))), F.when(clears, "CLEARED").otherwise("ACTIVE")
    return found.select(key, "event_ts", "seq", kind.alias("alarm_type"), state.alias("state"), "value")


def stream_alarms(stream: DataFrame, key: str, event: str, value: str, seq: str, hi: float, hihi: float) -> DataFrame:
    """The same on a stream: the level of each key is kept as state; a batch's readings are taken in event order."""
    kinds = dict(stream.dtypes)

    def run(k: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        active = (state.get[0] or None) if state.exists else None
        rows = pd.concat(list(parts)).sort_values(["event_ts", "seq"])
        out = []
        for t, s, v in rows[["event_ts", "seq", "value"]].itertuples(index=False):
            active, event_ = alarm_step(active, v, hi, hihi)
            if event_:
                out.append((k[0], t, s, *event_, v))
        state.update((active or "",))
        yield pd.DataFrame(out, columns=[key, "event_ts", "seq", "alarm_type", "state", "value"])

    rows = stream.select(key, F.col(event).alias("event_ts"), F.col(seq).cast("long").alias("seq"), F.col(value).cast("double").alias("value"))
    return rows.groupBy(key).applyInPandasWithState(run, _ALARM.format(key=key, kind=kinds[key], time=kinds[event]), "active string", "append", GroupStateTimeout.NoTimeout)
