"""Sources and sinks over the shared tables: each writes a table out in a landed form and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from gneiss.operators import checks, windows
from gneiss.session import workspace
from gneiss.sources import dumps, files, formats, planted, readers

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return add


@query("""
    SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_custkey % 7 > 0
           THEN c_name || '''s; -- \\ ("' || c_mktsegment || '"),' || chr(10) || '(1,''x''); /* INSERT INTO `customer` VALUES (2);' END AS note
    FROM customer
""")
def dump_scan(spark, d):
    """Customers written as SQL dumps, with notes full of quotes and statements, and read back in byte ranges."""
    note = F.concat("c_name", F.lit("'s; -- \\ (\""), "c_mktsegment", F.lit("\"),\n(1,'x'); /* INSERT INTO `customer` VALUES (2);"))
    rows = spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", "c_name", "c_acctbal", F.when(F.col("c_custkey") % 7 > 0, note).alias("note"))
    folder = workspace(spark, "dump")
    dumps.write_dump(rows, folder, "customer")
    found = dumps.read_dump(spark, folder, "customer", rows.columns, range_bytes=1 << 16)
    return found.select(*(F.col(c).cast(k).alias(c) for c, k in rows.dtypes))


@query("""
    WITH o AS (
        SELECT 'a/' || page_id AS path, coalesce(html, '') AS c FROM pages
        UNION ALL SELECT 'b/' || page_id, coalesce(html, '') FROM pages WHERE page_id % 3 = 0)
    SELECT sha256(c) AS sha256, CAST(strlen(c) AS BIGINT) AS size, count(*) AS n_paths, min(path) AS first_path FROM o GROUP BY c
""")
def content_store(spark, d):
    """Pages as objects, a third of them sent again under another name: each content is one file, and paths join back."""
    pages = spark.read.parquet(f"{d}/pages.parquet").select("page_id", F.coalesce("html", F.lit("")).cast("binary").alias("content"))
    named = lambda folder, rows: rows.select(F.concat(F.lit(folder), F.col("page_id").cast("string")).alias("path"), "content")
    folder = workspace(spark, "objects")
    index = files.store_objects(named("a/", pages).unionByName(named("b/", pages.where("page_id % 3 = 0"))), folder)
    held = readers.binary_objects(spark, folder).where("sha256 = file_name").select(F.col("file_name").alias("sha256"), "size")
    return index.select("path", "sha256").join(held, "sha256").groupBy("sha256", "size").agg(F.count(F.lit(1)).alias("n_paths"), F.min("path").alias("first_path"))


_FAULT = """CASE c_custkey % 20 WHEN 0 THEN 'CONTENT' WHEN 1 THEN 'PART' WHEN 2 THEN 'SIZE' WHEN 3 THEN 'SHA' WHEN 4 THEN 'MISSING'
            WHEN 5 THEN 'FORMAT' WHEN 6 THEN 'SMALL' WHEN 7 THEN 'RESENT' ELSE 'OK' END"""
_PLANTED = f"""
    WITH k AS (SELECT c_custkey, {_FAULT} AS fault, CASE c_custkey // 20 % 3 WHEN 0 THEN 'pdf' WHEN 1 THEN 'json' ELSE 'las' END AS source FROM customer),
    v AS (
        SELECT c_custkey, source, fault, CASE fault
               WHEN 'CONTENT' THEN CASE source WHEN 'pdf' THEN 'PDF_TRUNCATED' WHEN 'json' THEN 'JSON_MALFORMED' ELSE 'LAS_BAD_DATA' END
               WHEN 'PART' THEN CASE source WHEN 'pdf' THEN 'PDF_NO_PAGES' WHEN 'json' THEN 'JSON_MISSING_KEYS' ELSE 'LAS_MISSING_SECTION' END
               WHEN 'SIZE' THEN 'SIZE_MISMATCH' WHEN 'SHA' THEN 'SHA_MISMATCH' WHEN 'MISSING' THEN 'MISSING_FILE' WHEN 'FORMAT' THEN 'UNKNOWN_FORMAT'
               WHEN 'SMALL' THEN 'TOO_SMALL' ELSE 'OK' END AS verdict
        FROM k)"""


@query(f"{_PLANTED} SELECT source, verdict, count(*) AS n FROM v GROUP BY source, verdict")
def planted_objects(spark, d):
    """Files made from customers with every kind of fault planted: what the checks against manifest and format say."""
    listed, objects = planted.landed(spark.read.parquet(f"{d}/customer.parquet"), "c_custkey")
    found = readers.manifest_checks(listed, objects, formats.verdicts(objects, min_bytes=2))
    return found.groupBy("source", "verdict").agg(F.count(F.lit(1)).alias("n"))


@query(f"""{_PLANTED},
    o AS (
        SELECT source, CASE WHEN verdict IN ('SIZE_MISMATCH', 'SHA_MISMATCH') THEN 'OK' ELSE verdict END AS verdict,
               fault = 'RESENT' AND c_custkey < (SELECT max(c_custkey) FROM customer) OR verdict = 'TOO_SMALL' AND c_custkey > (SELECT min(c_custkey) FROM v WHERE fault = 'SMALL') AS again
        FROM v WHERE fault <> 'MISSING'),
    b AS (
        SELECT source, count(*) FILTER (NOT again AND verdict <> 'OK') AS bad, count(*) FILTER (again) AS again,
               array_to_string(list_slice(list_sort(list(DISTINCT verdict) FILTER (NOT again AND verdict <> 'OK')), 1, 5), ', ') AS codes FROM o GROUP BY source)
    SELECT 'bronze' AS layer, source AS entity, 'object_quarantine' AS check_name, 0::DOUBLE AS expected, bad::DOUBLE AS actual, NULL::DOUBLE AS explained_by,
           CASE WHEN bad = 0 THEN 'MATCHED' ELSE 'MISMATCH' END AS status, CASE WHEN bad > 0 THEN codes ELSE 'every object passed its format contract' END AS detail FROM b
    UNION ALL SELECT 'bronze', source, 'object_duplicates', 0, again, -again, 'EXPLAINED', 'resent bytes are stored once' FROM b WHERE again > 0
""")
def object_checks(spark, d):
    """The same files by what bronze keeps of them: resends by digest, rejections by format, as reconciliation rows."""
    customers = spark.read.parquet(f"{d}/customer.parquet")
    listed, objects = planted.landed(customers, "c_custkey")
    number = F.regexp_extract("file_name", r"\d+", 0).cast("long")
    seen = windows.first_seen(
        objects.select("file_name", "sha256", number.alias("number"), (number % planted.FAULT_KEYS == 7).alias("resent")), "sha256",
        [F.col("resent"), F.col("number")], "file_name",
    )
    found = seen.join(formats.verdicts(objects, min_bytes=2), "file_name").join(listed.select(F.col("name").alias("file_name"), "source"), "file_name")
    verdict = F.when(F.col("is_duplicate"), "DUPLICATE").when(F.col("format_verdict") == "OK", "VALID").otherwise(F.col("format_verdict"))
    return checks.object_findings(found.withColumn("verdict", verdict))


@query("""
    WITH a AS (SELECT n_name AS entity, n_nationkey % 4 AS k, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey AND c_custkey % 2 = 0) AS n FROM nation)
    SELECT 'bronze' AS layer, '*' AS entity, 'batch_status' AS check_name, 1::DOUBLE AS expected, 0::DOUBLE AS actual, NULL::DOUBLE AS explained_by, 'MISMATCH' AS status,
           'last bronze run FAILED: no space' AS detail
    UNION ALL SELECT 'bronze', entity, 'load_status', 1, CASE WHEN k < 2 THEN 1 ELSE 0 END, NULL, CASE WHEN k < 2 THEN 'MATCHED' ELSE 'MISMATCH' END,
           CASE WHEN k = 0 THEN 'committed by the last run' WHEN k = 1 THEN 'committed by an earlier attempt' WHEN n > 0 THEN 'the table holds ' || n || ' rows of an earlier run' ELSE 'no rows for the date' END
    FROM a
""")
def run_checks(spark, d):
    """Two runs of a batch over the nations, the second one failed: its state and what it loaded of each."""
    n = spark.read.parquet(f"{d}/nation.parquet")
    row = lambda rows, entity, status, at, message: rows.select(
        F.lit("bronze").alias("stage"), F.lit("B1").alias("batch_id"), entity.alias("entity"), status.alias("status"), F.lit(message).alias("message"),
        at.cast("double").alias("at"),
    )
    one, k = n.where("n_nationkey = 0"), F.col("n_nationkey")
    every = F.lit("*")
    audit = checks.union([
        row(one, every, F.lit("STARTED"), F.lit(1), ""), row(n, F.col("n_name"), F.lit("COMMITTED"), 2 + k, ""), row(one, every, F.lit("COMPLETED"), F.lit(90), ""),
        row(one, every, F.lit("STARTED"), F.lit(100), ""), row(n.where(k % 4 < 2), F.col("n_name"), F.when(k % 4 == 0, "COMMITTED").otherwise("SKIPPED"), 101 + k, ""),
        row(one, every, F.lit("FAILED"), F.lit(190), "no space"),
    ])
    held = spark.read.parquet(f"{d}/customer.parquet").where("c_custkey % 2 = 0").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("n"))
    accepted = n.join(held, "n_nationkey", "left").select(F.col("n_name").alias("entity"), F.coalesce("n", F.lit(0)).alias("n"))
    return checks.union([checks.batch_status(audit, "bronze", "B1"), checks.load_status(audit, accepted, "bronze", "B1")])


@query("""
    WITH o AS (SELECT o_orderkey, 'hdfs://host:8020/land/' || o_orderkey || '.pdf' AS path FROM orders), c AS (SELECT c_custkey, '/land/' || c_custkey || '.pdf' AS path FROM customer)
    SELECT o_orderkey, c_custkey, TRUE AS by_path, TRUE AS by_name FROM o JOIN c ON o_orderkey = c_custkey
""")
def path_joins(spark, d):
    """Objects met by their bare path, whatever scheme and host, and by their file name alone."""
    from gneiss.operators import joins

    o = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", F.concat(F.lit("hdfs://host:8020/land/"), F.col("o_orderkey").cast("string"), F.lit(".pdf")).alias("path"))
    c = spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", F.concat(F.lit("file:/land/"), F.col("c_custkey").cast("string"), F.lit(".pdf")).alias("path"))
    by_path = joins.on_bare_path(o, c).select("o_orderkey", "c_custkey", F.lit(True).alias("by_path"))
    by_name = joins.on_file_name(
        o.withColumnRenamed("path", "left_path"), c.withColumnRenamed("path", "right_path"), "left_path", "right_path",
    ).select("o_orderkey", "c_custkey", F.lit(True).alias("by_name"))
    return by_path.join(by_name, ["o_orderkey", "c_custkey"], "full").fillna(False, ["by_path", "by_name"])


@query("""
    SELECT event_type AS topic, strftime(ts, '%Y%m%d%H') AS hour, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY ALL
""")
def stream_file_sink(spark, d):
    """Messages written as JSON lines in a folder per topic and hour of sending, and read back."""
    e = spark.read.parquet(f"{d}/events.parquet")
    messages = e.where(F.col("ts").isNotNull()).select(
        F.col("event_id").cast("string").alias("key"), F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.to_json(F.struct("event_id")).alias("value"), F.col("event_type").alias("topic"),
    )
    folder = workspace(spark, "messages")
    readers.write_stream_files(messages.repartition("topic"), folder)
    found = spark.read.schema("key string, timestamp long, value string, topic string, hour string").json(folder)
    return found.groupBy("topic", "hour").agg(F.count(F.lit(1)).alias("n"), F.sum(F.get_json_object("value", "$.event_id").cast("long")).alias("ids"))


@query("""
    WITH m AS (
        SELECT event_id, ts, (event_id * 48271 + 12345) % 2147483647 / 2147483647.0::DOUBLE AS u, (event_id * 69621 + 12345) % 2147483647 / 2147483647.0::DOUBLE AS v FROM events),
    s AS (
        SELECT *, CASE WHEN u < 0.001 THEN 'very late' WHEN u < 0.001 + 0.01 THEN 'late' WHEN u < 0.001 + 0.01 + 0.02 THEN 'slow' ELSE 'at once' END AS class,
               CASE WHEN u < 0.001 THEN floor(1000 * (900 + v * 900)) WHEN u < 0.001 + 0.01 THEN floor(1000 * (120 + v * 360)) WHEN u < 0.001 + 0.01 + 0.02 THEN floor(1000 * (1 + v * 3)) ELSE 0 END AS delay FROM m)
    SELECT class, count(*) AS n, CAST(sum(delay) AS BIGINT) AS delay_ms, count(*) FILTER (delay > 600000) AS past_watermark FROM s GROUP BY class
""")
def late_producer(spark, d):
    """Events with send times of the late producer: how many are sent at once, slowly, late and past the watermark."""
    e = spark.read.parquet(f"{d}/events.parquet").select("event_id", "ts")
    sent = planted.sent_messages(e, "event_id", "ts").withColumn("delay", F.col("sent_ms") - F.unix_millis(F.col("ts").cast("timestamp")))
    kind = F.when(F.col("delay") >= 900_000, "very late").when(F.col("delay") >= 120_000, "late").when(F.col("delay") > 0, "slow").otherwise("at once")
    return sent.groupBy(kind.alias("class")).agg(F.count(F.lit(1)).alias("n"), F.sum("delay").alias("delay_ms"), F.count_if(F.col("delay") > 600_000).alias("past_watermark"))


@query("""
    WITH e AS (
        SELECT event_id, date_trunc('minute', ts) AS minute, event_type AS run, event_type = 'purchase' AND value > 300 AS lost, value > 300 AS big, event_id % 40 = 0 AS twice, event_id % 100 = 0 AS late FROM events),
    c AS (SELECT minute, run, count(*) AS total, count(*) FILTER (NOT lost) AS got FROM e GROUP BY ALL),
    s AS (SELECT sum(total) AS n, sum(got) AS got, count(*) FILTER (got < total) AS short, count(*) FILTER (got < total AND minute >= (SELECT max(minute) FROM c) - INTERVAL 10 MINUTE) AS recent FROM c),
    w AS (SELECT count(*) AS n, count(*) FILTER (late) AS late FROM e)
    SELECT 'stream' AS layer, 'reading' AS entity, 'stream_records' AS check_name, n::DOUBLE AS expected, got::DOUBLE AS actual, NULL::DOUBLE AS explained_by,
           CASE WHEN n = got THEN 'MATCHED' WHEN short = recent THEN 'LATE' ELSE 'MISMATCH' END AS status, short || ' minute(s) short' AS detail FROM s
    UNION ALL SELECT 'stream', 'reading', 'stream_duplicates', 0, count(*), NULL, CASE WHEN count(*) = 0 THEN 'MATCHED' ELSE 'MISMATCH' END, '' FROM e WHERE twice AND NOT big
    UNION ALL SELECT 'stream', 'sensor_window', 'window_records', n, n - late, NULL, CASE WHEN late = 0 THEN 'MATCHED' ELSE 'LATE' END, late || ' sent too late' FROM w
""")
def stream_checks(spark, d):
    """Landed messages, a fortieth of them twice, against control counts; and readings against the windows that hold
    those sent in time."""
    from gneiss.streaming import telemetry

    e = spark.read.parquet(f"{d}/events.parquet").select("event_id", "value", "ts", "event_type", F.date_trunc("minute", "ts").alias("minute"), F.col("event_type").alias("producer_run"))
    big = F.col("value") > 300
    control = e.groupBy("minute", "producer_run").agg(F.count(F.lit(1)).alias("total"))
    landed = e.where(~big)
    found = checks.stream_records(
        control.unionByName(control.where("minute is not null")), landed.unionByName(landed.where("event_id % 40 = 0")),
        e.where(big & (F.col("event_type") != "purchase")), "reading", "event_id",
    )
    sent = e.withColumn("lateness_s", F.when(F.col("event_id") % 100 == 0, 900.0).otherwise(1.0))
    windows_ = telemetry.windows(sent.where("lateness_s <= 600"), "event_type", "1 minute", "ts")
    return checks.union([found, checks.window_records(sent, windows_)])
