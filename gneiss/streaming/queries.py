"""Telemetry operators over the events table, with SQL twins."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from gneiss.operators import checks
from gneiss.plans import contracts
from gneiss.session import workspace
from gneiss.sources import readers
from gneiss.streaming import telemetry

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}

_STATS = """SELECT event_type, '{size}' AS window_size, time_bucket(INTERVAL '{size}', ts) AS window_start, count(*) AS n, min(value) AS min_value, max(value) AS max_value, round(avg(value), 6) AS mean_value,
    round(stddev_pop(value), 6) AS std_value, min(ts) AS first_event, max(ts) AS last_event, count(*) FILTER (value > 200) AS n_high FROM events GROUP BY ALL"""
_SLOPE = """round(CASE WHEN count(*) * sum(t * t) - sum(t) * sum(t) > 0 THEN (count(*) * sum(t * value) - sum(t) * sum(value)) / (count(*) * sum(t * t) - sum(t) * sum(t)) * 3600 END, 3) AS slope_per_h"""


def _windows(spark, d, sizes):
    events = spark.read.parquet(f"{d}/events.parquet").select("event_type", "ts", "value")
    return checks.union([telemetry.windows(events, "event_type", s, "ts", counts={"n_high": F.col("value") > 200}) for s in sizes])


def sensor_windows(spark, d):
    out = telemetry.flags(_windows(spark, d, ["15 minutes", "1 hour"]), F.lit(400.0), "1 hour")
    return out.select(
        "event_type", "window_size", "window_start", "n", "min_value", "max_value", F.round("mean_value", 6).alias("mean_value"),
        F.round("std_value", 6).alias("std_value"), F.round("slope_per_h", 3).alias("slope_per_h"), "n_high", "is_breach", "is_stuck",
    )


ORACLE_SQL["sensor_windows"] = " UNION ALL ".join(
    f"""SELECT event_type, '{size}' AS window_size, time_bucket(INTERVAL '{size}', ts) AS window_start, count(*) AS n, min(value) AS min_value, max(value) AS max_value, round(avg(value), 6) AS mean_value, round(stddev_pop(value), 6) AS std_value,
    {_SLOPE}, count(*) FILTER (value > 200) AS n_high, max(value) > 400 AS is_breach, stddev_pop(value) < 1e-9 AND count(*) >= 5 AND '{size}' = '1 hour' AS is_stuck
    FROM (SELECT *, (hour(ts) * 3600 + minute(ts) * 60 + second(ts))::DOUBLE AS t FROM events) GROUP BY event_type, time_bucket(INTERVAL '{size}', ts)"""
    for size in ("15 minutes", "1 hour")
)


def sensor_daily(spark, d):
    out = telemetry.daily(telemetry.flags(_windows(spark, d, ["1 hour"]), F.lit(400.0), "1 hour"), "event_type")
    return out.select(
        "event_type", "day", "n_readings", F.round("mean_value", 10).alias("mean_value"), "max_value", F.round("slope_per_h", 3).alias("slope_per_h"),
        "stuck_windows", "breach_windows", "n_windows",
    )


ORACLE_SQL["sensor_daily"] = f"""SELECT event_type, CAST(window_start AS DATE) AS day, CAST(sum(n) AS BIGINT) AS n_readings, round(avg(mean), 10) AS mean_value, max(max_value) AS max_value, round(avg(slope), 3) AS slope_per_h, count(*) FILTER (std < 1e-9 AND n >= 5) AS stuck_windows, count(*) FILTER (max_value > 400) AS breach_windows, count(*) AS n_windows
    FROM ({_STATS.format(size="1 hour").replace("round(avg(value), 6) AS mean_value", "avg(value) AS mean").replace("round(stddev_pop(value), 6) AS std_value", "stddev_pop(value) AS std, " + _SLOPE.replace("round(", "").replace(", 3) AS slope_per_h", " AS slope")).replace("FROM events", "FROM (SELECT *, (hour(ts) * 3600 + minute(ts) * 60 + second(ts))::DOUBLE AS t FROM events)")}) GROUP BY event_type, CAST(window_start AS DATE)"""


def stream_windows(spark, d):
    """The same windows from a stream over the events files, read to the end."""
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    stream = spark.readStream.schema(schema).parquet(f"{d}/events.parque[t]").select("event_type", F.col("ts").cast("timestamp").alias("ts"), "value")
    folder = workspace(spark, "windows")
    telemetry.stream_windows(stream, "event_type", "15 minutes", f"{folder}/out", f"{folder}/state", "ts", counts={"n_high": F.col("value") > 200}).awaitTermination()
    out = telemetry.read_windows(spark, f"{folder}/out")
    plain = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "first_event", "last_event")]
    return out.select("event_type", "window_size", *plain, "n", "min_value", "max_value", F.round("mean_value", 6).alias("mean_value"), F.round("std_value", 6).alias("std_value"), "n_high")


ORACLE_SQL["stream_windows"] = _STATS.format(size="15 minutes")


def stream_exactly_once(spark, d):
    """A stream of three batches whose second one dies after its write and comes again: no row is missing or double."""
    folder = workspace(spark, "once")
    events = spark.read.parquet(f"{d}/events.parquet").select("event_id", "event_type", "value")
    sink = telemetry.batch_folders({"all": (lambda b: b, f"{folder}/out")})
    died = []

    def dies_once(batch, batch_id):
        sink(batch, batch_id)
        if batch_id == 1 and not died:
            died.append(batch_id)
            raise RuntimeError("the driver is lost here")

    for part in range(3):
        events.where(F.col("event_id") % 3 == part).write.mode("append").parquet(f"{folder}/in")
        for _ in range(2):  # the second time is the restart
            stream = spark.readStream.schema(events.schema).parquet(f"{folder}/in")
            query = stream.writeStream.foreachBatch(dies_once).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
            try:
                query.awaitTermination()
            except StreamingQueryException:
                if died != [1]:
                    raise
    found = spark.read.parquet(f"{folder}/out/_b=*")
    return found.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"))


ORACLE_SQL["stream_exactly_once"] = "SELECT event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY event_type"


def stream_control_recon(spark, d):
    """Control counts per minute against landed and quarantined rows: purchases above 300 never landed, other big ones were held."""
    events = spark.read.parquet(f"{d}/events.parquet").withColumns({"minute": F.date_trunc("minute", "ts"), "producer_run": F.col("event_type")})
    control = events.groupBy("minute", "producer_run").agg(F.count(F.lit(1)).alias("total"))
    lost = (F.col("event_type") == "purchase") & (F.col("value") > 300)
    held = ~lost & (F.col("value") > 300)
    found = checks.minute_counts(control, events.where(~lost & ~held), events.where(held))
    return found.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum("expected").alias("expected"), F.sum("actual").alias("actual"))


ORACLE_SQL["stream_control_recon"] = """
    WITH e AS (SELECT date_trunc('minute', ts) AS m, event_type, event_type = 'purchase' AND value > 300 AS lost FROM events),
    c AS (SELECT m, event_type, count(*)::DOUBLE AS expected, count(*) FILTER (NOT lost)::DOUBLE AS actual FROM e GROUP BY ALL),
    s AS (SELECT *, CASE WHEN expected = actual THEN 'MATCHED' WHEN m > (SELECT max(m) FROM c) - INTERVAL 10 MINUTE THEN 'LATE' ELSE 'MISMATCH' END AS status FROM c)
    SELECT status, count(*) AS n, sum(expected) AS expected, sum(actual) AS actual FROM s GROUP BY status"""


READINGS = contracts.Contract("reading", ("event_id",), (
    contracts.Field("event_id", "bigint", required=True),
    contracts.Field("event_type", required=True, allowed=("click", "purchase", "signup", "view")),
    contracts.Field("event_ts", "timestamp", required=True),
    contracts.Field("value", "double", required=True),
))


def _messages(spark, d):
    """Events as messages of three sendings by day of the month; each 97th is broken, each 50th of the first comes last."""
    e = spark.read.parquet(f"{d}/events.parquet")
    sending = F.when(F.dayofmonth("ts") > 20, 3).when(F.dayofmonth("ts") > 10, 2).when(F.col("event_id") % 50 == 0, 3).otherwise(1)
    body = F.to_json(F.struct("event_id", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_ts"), "value"))
    value = F.when(F.col("event_id") % 97 == 0, F.substring(body, 1, 20)).otherwise(body)
    return e.select(sending.alias("sending"), F.col("event_type").alias("key"), F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"), value.alias("value"), F.lit("readings").alias("topic"))


def stream_pipeline(spark, d):
    """Messages through contract, two sinks and windows, each sending a restart of both streams from their checkpoints.

    The windows read the accepted readings as a stream. Per type: messages accepted, in windows, and late ones, which the
    watermark has dropped; rejected ones stand under their reason.
    """
    folder = workspace(spark, "stream")
    inbox, good, bad = f"{folder}/inbox", f"{folder}/good", f"{folder}/bad"
    messages = _messages(spark, d)
    schema = "key string, timestamp long, topic string, event_id long, event_type string, event_ts timestamp, value double, producer_run string"
    for sending in (1, 2, 3):
        messages.where(F.col("sending") == sending).drop("sending").write.mode("append").json(inbox)
        telemetry.stream_bronze(readers.stream_files(spark, inbox), READINGS, good, bad, f"{folder}/state-bronze").awaitTermination()
        readings = telemetry.table_stream(spark, good, schema)
        telemetry.stream_windows(readings, "event_type", "15 minutes", f"{folder}/windows", f"{folder}/state-windows").awaitTermination()
    landed = spark.read.schema(schema).parquet(good).groupBy(F.col("event_type").alias("name")).agg(F.count(F.lit(1)).alias("n_accepted"), F.count_distinct("event_id").alias("n_ids"))
    seen = telemetry.read_windows(spark, f"{folder}/windows").groupBy(F.col("event_type").alias("name")).agg(F.sum("n").alias("n_in_windows"))
    found = landed.join(seen, "name", "left").withColumn("n_late", F.col("n_accepted") - F.col("n_in_windows"))
    none = F.lit(None).cast("long")
    held = spark.read.parquet(bad).select(F.explode("reject_reasons").alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("n_accepted"))
    return found.unionByName(held.select("name", "n_accepted", none.alias("n_ids"), none.alias("n_in_windows"), none.alias("n_late")))


ORACLE_SQL["stream_pipeline"] = """
    WITH m AS (SELECT *, event_id % 97 = 0 AS broken, day(ts) <= 10 AND event_id % 50 = 0 AS late FROM events),
    g AS (SELECT * FROM m WHERE NOT broken AND event_type IN ('click', 'purchase', 'signup', 'view'))
    SELECT event_type AS name, count(*) AS n_accepted, count(*) AS n_ids, CAST(count(*) FILTER (NOT late) AS BIGINT) AS n_in_windows, count(*) FILTER (late) AS n_late FROM g GROUP BY event_type
    UNION ALL SELECT 'value:MALFORMED_JSON', count(*), NULL, NULL, NULL FROM m WHERE broken HAVING count(*) > 0
    UNION ALL SELECT 'event_type:NOT_ALLOWED', count(*), NULL, NULL, NULL FROM m WHERE NOT broken AND event_type NOT IN ('click', 'purchase', 'signup', 'view') HAVING count(*) > 0"""


def _sending():
    """Three sendings by day of the month; each 50th event of the first comes with the last."""
    return F.when(F.dayofmonth("ts") > 20, 3).when(F.dayofmonth("ts") > 10, 2).when(F.col("event_id") % 50 == 0, 3).otherwise(1)


def stream_control_counts(spark, d):
    """Counts per minute and type of three sendings in append mode, the stream restarted for each: what the watermark has
    closed, written once; late rows are dropped."""
    folder = workspace(spark, "control")
    events = spark.read.parquet(f"{d}/events.parquet").withColumn("sending", _sending()).select("sending", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    for sending in (1, 2, 3):
        events.where(F.col("sending") == sending).drop("sending").write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema("event_type string, ts timestamp").parquet(f"{folder}/in")
        telemetry.stream_control_counts(stream, "ts", ("event_type",), f"{folder}/out", f"{folder}/state").awaitTermination()
    return spark.read.parquet(f"{folder}/out/_b=*").select(F.col("minute").cast("timestamp_ntz").alias("minute"), "event_type", "total")


ORACLE_SQL["stream_control_counts"] = """
    WITH e AS (
        SELECT event_type, ts, date_trunc('minute', ts) AS minute,
               CASE WHEN day(ts) > 20 THEN 3 WHEN day(ts) > 10 THEN 2 WHEN event_id % 50 = 0 THEN 3 ELSE 1 END AS sending FROM events),
    w AS (SELECT sending, date_trunc('millisecond', max(max(ts)) OVER (ORDER BY sending)) - INTERVAL 10 MINUTE AS mark FROM e GROUP BY sending),
    b AS (SELECT e.*, (SELECT max(mark) FROM w WHERE w.sending < e.sending) AS passed FROM e)
    SELECT minute, event_type, count(*) AS total FROM b
    WHERE (passed IS NULL OR minute + INTERVAL 1 MINUTE > passed) AND minute + INTERVAL 1 MINUTE <= (SELECT max(mark) FROM w)
    GROUP BY minute, event_type"""


ALARMS = contracts.Contract("alarm", ("alarm_id",), (
    contracts.Field("alarm_id", "bigint", required=True),
    contracts.Field("event_ts", "timestamp", required=True),
    contracts.Field("priority", required=True, allowed=("1", "2", "3", "4")),
    contracts.Field("value", "double", required=True),
))


def alarm_router(spark, d):
    """Alarm messages routed by a running stream, stopped and started again between two sendings: counts per destination,
    and per five minutes of sending within it."""
    folder = workspace(spark, "router")
    e = spark.read.parquet(f"{d}/events.parquet")
    body = F.to_json(F.struct(F.col("event_id").alias("alarm_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("event_ts"), (F.col("event_id") % 5 + 1).cast("string").alias("priority"), "value"))
    value = F.when(F.col("event_id") % 97 == 0, F.substring(body, 1, 20)).otherwise(body)
    sent = F.unix_millis(F.date_trunc("day", "ts").cast("timestamp")) + F.col("event_id") % 7 * 60_000
    messages = e.select((F.col("event_id") % 2).alias("sending"), F.lit("a").alias("key"), sent.alias("timestamp"), value.alias("value"), F.lit("alarms").alias("topic"))
    for sending in (0, 1):
        messages.where(F.col("sending") == sending).drop("sending").write.mode("append").json(f"{folder}/in")
        arriving = readers.stream_files(spark, f"{folder}/in")
        telemetry.await_and_stop(telemetry.stream_router(arriving, ALARMS, f"{folder}/out", f"{folder}/state", "1 second"))
    counts = [telemetry.routed(spark, f"{folder}/out", name, "timestamp long").groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).withColumn("destination", F.lit(name)) for name in ("priority", "all", "quarantine")]
    return checks.union(counts).select("destination", "bucket", "n")


ORACLE_SQL["alarm_router"] = """
    WITH m AS (SELECT event_id, date_trunc('day', ts) + to_minutes(CAST(event_id % 7 AS INTEGER)) AS sent, event_id % 97 = 0 AS broken, event_id % 5 + 1 AS priority FROM events),
    b AS (SELECT *, strftime(time_bucket(INTERVAL 5 MINUTE, sent), '%Y%m%d%H%M') AS bucket, NOT broken AND priority <= 4 AS valid FROM m)
    SELECT 'priority' AS destination, bucket, count(*) AS n FROM b WHERE valid AND priority <= 2 GROUP BY bucket
    UNION ALL SELECT 'all', bucket, count(*) FROM b WHERE valid GROUP BY bucket
    UNION ALL SELECT 'quarantine', bucket, count(*) FROM b WHERE NOT valid GROUP BY bucket"""


def alarm_hysteresis(spark, d):
    """Alarm events per user: raised at two levels, cleared below 85 % of the lower; also tested against a plain loop."""
    events = spark.read.parquet(f"{d}/events.parquet")
    return telemetry.alarms(events, "user_id", "ts", "value", "event_id", 100.0, 250.0)


ORACLE_SQL["alarm_hysteresis"] = """
    WITH s AS (SELECT user_id, ts AS event_ts, event_id AS seq, value, value < 85 AS clears, count(*) FILTER (value < 85) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS stretch FROM events),
    l AS (SELECT *, max(CASE WHEN value >= 250 THEN 2 WHEN value >= 100 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, stretch ORDER BY event_ts, seq) AS level FROM s),
    b AS (SELECT *, coalesce(lag(level) OVER (PARTITION BY user_id ORDER BY event_ts, seq), 0) AS before FROM l)
    SELECT user_id, event_ts, seq, CASE WHEN (CASE WHEN clears THEN before ELSE level END) = 2 THEN 'HIHI' ELSE 'HI' END AS alarm_type, CASE WHEN clears THEN 'CLEARED' ELSE 'ACTIVE' END AS state, value
    FROM b WHERE CASE WHEN clears THEN before > 0 ELSE level > before END"""

QUERIES |= {
    f.__name__: f
    for f in (sensor_windows, sensor_daily, stream_windows, stream_exactly_once, stream_control_recon, stream_pipeline, stream_control_counts, alarm_router, alarm_hysteresis)
}
