"""The operators over the shared tables, each with the same query in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gneiss.functions import columns as C
from gneiss.functions import objects
from gneiss.operators import aggregates, checks, history, joins, ranks, search, spatial, text, windows
from gneiss.plans import contracts, facts, kpi

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None):
    """Register a query under its function's name, with its SQL twin if it has one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


WEIGHTS = [("criticality_weight.A", 3.0), ("criticality_weight.B", 2.0), ("criticality_weight.C", 1.0)]


@query("""
    WITH newest AS (SELECT max(CAST(o_orderdate AS DATE)) AS d FROM orders),
    o AS (SELECT *, CAST(o_orderdate AS DATE) AS od, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders),
    insp AS (SELECT o_custkey, max(CASE WHEN rn = 1 THEN floor(o_totalprice / 12500) END) AS wl, max(CASE WHEN rn = 2 THEN floor(o_totalprice / 12500) END) AS pwl,
             max(od) AS last_order_date, max(CASE WHEN rn = 1 THEN o_orderpriority END) AS pr, max(CASE WHEN rn = 1 THEN o_orderstatus END) AS st FROM o WHERE rn <= 2 GROUP BY o_custkey),
    wo AS (SELECT o_custkey, count(*) AS corrective FROM o, newest WHERE od > d - 365 AND o_orderstatus = 'F' GROUP BY o_custkey),
    br AS (SELECT o_custkey, count(*) AS breaches FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' GROUP BY o_custkey),
    s AS (SELECT c_custkey, last_order_date, c_acctbal < -900 AS is_abstained,
            CASE WHEN c_mktsegment IN ('MACHINERY', 'AUTOMOBILE') THEN 'A' WHEN c_mktsegment = 'BUILDING' THEN 'B' ELSE 'C' END AS criticality,
            least(100.0::DOUBLE, (least(35.0::DOUBLE, coalesce(wl, 0.0::DOUBLE) * 1.2::DOUBLE) + least(10.0::DOUBLE, 2 * greatest(0.0::DOUBLE, coalesce(wl, 0.0::DOUBLE) - coalesce(pwl, coalesce(wl, 0.0::DOUBLE))))
              + least(20.0::DOUBLE, coalesce(breaches, 0) * 0.5::DOUBLE) + least(10.0::DOUBLE, coalesce(corrective, 0) * 3.0::DOUBLE)
              + least(10.0::DOUBLE, greatest(0.0::DOUBLE, date_diff('day', last_order_date, d) - 30) / 30.0::DOUBLE)
              + least(5.0::DOUBLE, CASE WHEN st = 'F' THEN 5.0::DOUBLE ELSE 0.0::DOUBLE END) + least(5.0::DOUBLE, CASE WHEN pr = '1-URGENT' THEN 5.0::DOUBLE ELSE 0.0::DOUBLE END))
              * (0.6::DOUBLE + 0.4::DOUBLE * CASE WHEN c_mktsegment IN ('MACHINERY', 'AUTOMOBILE') THEN 1.0::DOUBLE WHEN c_mktsegment = 'BUILDING' THEN 0.6::DOUBLE ELSE 0.3::DOUBLE END)) AS score
          FROM customer CROSS JOIN newest LEFT JOIN insp ON c_custkey = insp.o_custkey LEFT JOIN wo ON c_custkey = wo.o_custkey LEFT JOIN br ON c_custkey = br.o_custkey),
    e AS (SELECT *, CASE WHEN is_abstained THEN 0.0::DOUBLE ELSE score / 100 * CASE criticality WHEN 'A' THEN 3.0::DOUBLE WHEN 'B' THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END END AS exposure FROM s)
    SELECT c_custkey, criticality, round(score, 6) AS rule_score, CASE WHEN score >= 40 THEN 'HIGH' WHEN score >= 20 THEN 'MEDIUM' ELSE 'LOW' END AS risk_band, is_abstained,
           round(exposure, 6) AS exposure, row_number() OVER (ORDER BY exposure DESC, score DESC, c_custkey) AS risk_rank, last_order_date = (SELECT max(last_order_date) FROM e) AS is_latest
    FROM e
""")
def risk_worklist(spark, d):
    """Latest and previous orders, trailing counts and breaches scored, weighed by dated parameters, ranked."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority", "o_orderstatus")
    orders = orders.withColumns({"od": F.to_date("o_orderdate"), "wl": F.floor(F.col("o_totalprice") / 12500).cast("double")})
    newest = orders.agg(F.max("od").alias("newest"))
    insp = windows.latest_and_previous(orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], ["wl", "o_orderpriority", "o_orderstatus", "od"])
    recent = orders.crossJoin(F.broadcast(newest)).where((F.col("od") > F.date_sub("newest", 365)) & (F.col("o_orderstatus") == "F")).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("corrective"))
    lines = table(spark, d, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"))
    breaches = orders.select("o_orderkey", "o_custkey").join(lines, "o_orderkey").groupBy("o_custkey").agg(F.sum("n").alias("breaches"))
    c = table(spark, d, "customer").withColumnRenamed("c_custkey", "o_custkey").crossJoin(F.broadcast(newest))
    c = c.join(insp, "o_custkey", "left").join(recent, "o_custkey", "left").join(breaches, "o_custkey", "left")
    seg = F.col("c_mktsegment")
    c = c.withColumn("criticality", F.when(seg.isin("MACHINERY", "AUTOMOBILE"), "A").when(seg == "BUILDING", "B").otherwise("C"))
    overdue = (F.datediff("newest", "od") - 30).cast("double")
    cui, coating = F.when(F.col("o_orderstatus") == "F", "YES"), F.when(F.col("o_orderpriority") == "1-URGENT", "POOR")
    c = c.withColumn(
        "score", C.rule_score(F.col("wl"), F.col("previous_wl"), F.col("breaches"), F.col("corrective"), overdue, cui, coating, F.col("criticality")),
    ).withColumn("is_abstained", F.col("c_acctbal") < -900)
    e = kpi.with_is_latest(kpi.exposure(c, spark.createDataFrame(WEIGHTS, "parameter string, value double"), score="score"), "od")
    e = ranks.ranked(e, [F.desc("exposure"), F.desc("score"), F.col("o_custkey")], "risk_rank")
    return e.select(
        F.col("o_custkey").alias("c_custkey"), "criticality", F.round("score", 6).alias("rule_score"), C.risk_band(F.col("score")).alias("risk_band"),
        "is_abstained", F.round("exposure", 6).alias("exposure"), F.col("risk_rank").cast("long"), "is_latest",
    )


EVENTS = contracts.Contract("events", ("event_id",), (
    contracts.Field("event_id", "bigint", required=True),
    contracts.Field("event_type", required=True, allowed=("click", "purchase", "signup", "view"), severity="reject"),
    contracts.Field("value", "double", minimum=5.0),
    contracts.Field("props", pattern=r'^\{"k": \d{1,2}\}$', severity="reject"),
))

_REASONS = """list_filter([CASE WHEN event_type NOT IN ('click', 'purchase', 'signup', 'view') THEN 'event_type:NOT_ALLOWED' END,
    CASE WHEN value < 5 THEN 'value:BELOW_MIN' END, CASE WHEN NOT regexp_full_match(props, '\\{"k": \\d{1,2}\\}') THEN 'props:PATTERN' END], lambda x: x IS NOT NULL)"""


def _validated_events(spark, d):
    e = table(spark, d, "events")
    return contracts.validate(e.select(*(F.col(c).cast("string").alias(c) for c in EVENTS.names)), EVENTS)


@query(f"SELECT event_id, array_to_string({_REASONS}, '|') AS reasons, len({_REASONS}) = 0 AS accepted FROM events")
def contract_validate(spark, d):
    return _validated_events(spark, d).select(F.col("event_id").cast("long"), F.concat_ws("|", "_reject_reasons").alias("reasons"), (F.size("_reject_reasons") == 0).alias("accepted"))


@query(f"SELECT reason, count(*) AS n FROM (SELECT unnest({_REASONS}) AS reason FROM events) GROUP BY reason ORDER BY n DESC, reason LIMIT 5")
def reject_histogram(spark, d):
    return contracts.reject_histogram(contracts.split(_validated_events(spark, d), EVENTS)[1])


@query(f"SELECT count(*) AS n_rejected, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS control_total FROM events WHERE len({_REASONS}) > 0")
def quarantine_total(spark, d):
    bad = contracts.split(_validated_events(spark, d), EVENTS)[1]
    return bad.agg(F.count(F.lit(1)).alias("n_rejected"), F.sum(F.get_json_object("_record", "$.value").cast("decimal(18,2)")).cast("double").alias("control_total"))


@query("""
    SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_date, CAST(count(*) OVER (PARTITION BY o_custkey, o_orderdate) AS BIGINT) AS n_same
    FROM orders QUALIFY n_same > 1
""")
def duplicate_in_batch(spark, d):
    w = Window.partitionBy("o_custkey", "o_orderdate")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_date"), F.count(F.lit(1)).over(w).alias("n_same"))
    return o.where("n_same > 1")


@query(f"""
    SELECT n_nationkey, sha256(concat_ws(chr({ord(C.SEPARATOR)}), n_nationkey::VARCHAR, coalesce(CASE WHEN n_nationkey % 3 > 0 THEN n_name END, {"||".join(f"chr({ord(x)})" for x in C.NULL_TEXT)}), n_regionkey::VARCHAR)) AS record_hash
    FROM nation
""")
def record_hash(spark, d):
    rows = table(spark, d, "nation").withColumn("n_name", F.when(F.col("n_nationkey") % 3 > 0, F.col("n_name")))
    return rows.select("n_nationkey", C.record_hash(["n_nationkey", "n_name", "n_regionkey"]).alias("record_hash"))


_NAMES = """SELECT p_partkey, CASE WHEN p_size < 10 THEN 'PI-REF-U' || p_size || '-P-' || lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') || 'A.PV'
    WHEN p_size < 20 THEN ' pl' || p_size || '_seg ' || lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') || '.sp'
    WHEN p_size < 30 THEN 'FLD-' || p_size || '-W-' || p_size WHEN p_size < 40 THEN 'PL-' || p_size || '-SEG-' || lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') ELSE upper(p_brand) || '//' || p_name END AS name FROM part"""


def _part_names(spark, d):
    number, size = F.lpad((F.col("p_partkey") % 1000).cast("string"), 3, "0"), F.col("p_size").cast("string")
    name = (
        F.when(F.col("p_size") < 10, F.concat(F.lit("PI-REF-U"), size, F.lit("-P-"), number, F.lit("A.PV"))).when(F.col("p_size") < 20, F.concat(F.lit(" pl"), size, F.lit("_seg "), number, F.lit(".sp")))
        .when(F.col("p_size") < 30, F.concat(F.lit("FLD-"), size, F.lit("-W-"), size)).when(F.col("p_size") < 40, F.concat(F.lit("PL-"), size, F.lit("-SEG-"), number)).otherwise(F.concat(F.upper("p_brand"), F.lit("//"), "p_name"))
    )
    return table(spark, d, "part").select("p_partkey", name.alias("name"))


@query(rf"SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(upper(trim(name)), '\.(PV|SP|OP|MV)$', ''), '[\s_/]+', '-', 'g'), '-+', '-', 'g') AS tag FROM ({_NAMES})")
def tag_normalise(spark, d):
    return _part_names(spark, d).select("p_partkey", C.norm_tag(F.col("name")).alias("tag"))


@query(rf"""
    WITH n AS ({_NAMES}), b AS (SELECT p_partkey, regexp_replace(regexp_replace(upper(trim(name)), '^(?:PI|TI|VI|CP)-(.+?)(?:\.(?:PV|SP|OP|MV))?$', '\1'), '^(?:REF-U\d+|FLD-\d+)-', '') AS k FROM n)
    SELECT p_partkey, CASE WHEN regexp_full_match(k, 'PL-?\d{{2}}-?SEG-?\d{{3}}') THEN regexp_replace(k, '^PL-?(\d{{2}})-?SEG-?(\d{{3}})$', 'PL\1-\2') WHEN regexp_full_match(k, 'PL\d{{2}}-\d{{3}}') THEN k
      WHEN regexp_full_match(k, 'W-?\d{{2}}') THEN replace(k, '-', '') WHEN regexp_full_match(k, '(?:[A-Z]{{1,3}}-?)?(\d{{3}}[AB]?)') THEN regexp_extract(k, '^(?:[A-Z]{{1,3}}-?)?(\d{{3}}[AB]?)$', 1) ELSE nullif(k, '') END AS match_key FROM b
""")
def match_key(spark, d):
    return _part_names(spark, d).select("p_partkey", C.match_key(F.col("name")).alias("match_key"))


@query("""
    SELECT event_id, CASE event_type WHEN 'click' THEN 'pressure_psi' WHEN 'view' THEN 'temperature_c' WHEN 'purchase' THEN 'vibration_mm_s' END AS measurement,
           round(CASE WHEN event_type = 'click' THEN value * 14.5038::DOUBLE ELSE value END, 8) AS value, event_type = 'click' AS is_bar,
           CAST(ts AS DATE) AS event_date, CAST(hour(ts) AS INTEGER) AS event_hour FROM events
""")
def unit_normalise(spark, d):
    from gneiss.streaming import telemetry

    e = table(spark, d, "events").withColumn("unit", F.when(F.col("event_type") == "click", "bar").otherwise("psi"))
    e = telemetry.with_time_parts(telemetry.normalised(e), "ts")
    kind = C.lookup(F.col("event_type"), {"click": "pressure_psi", "view": "temperature_c", "purchase": "vibration_mm_s"})
    return e.select("event_id", kind.alias("measurement"), F.round("value", 8).alias("value"), "is_bar", "event_date", "event_hour")


@query("""
    WITH t AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%d.%m.%Y') WHEN o_orderstatus = 'O' THEN ' ' || strftime(o_orderdate, '%Y-%m-%d') WHEN o_orderpriority = '5-LOW' THEN '' ELSE 'n/a' END AS txt FROM orders)
    SELECT o_orderkey, CAST(coalesce(try_strptime(trim(txt), '%Y-%m-%d'), try_strptime(trim(txt), '%d.%m.%Y')) AS DATE) AS parsed FROM t
""")
def typed_multi_format_date(spark, d):
    o = table(spark, d, "orders")
    txt = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "dd.MM.yyyy")).when(
        F.col("o_orderstatus") == "O", F.concat(F.lit(" "), F.date_format("o_orderdate", "yyyy-MM-dd")),
    ).when(F.col("o_orderpriority") == "5-LOW", "").otherwise("n/a")
    return o.select("o_orderkey", C.typed(txt, "date").alias("parsed"))


@query("""
    SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice, l_suppkey FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_linenumber DESC, l_extendedprice DESC, l_suppkey DESC) = 1
""")
def latest_wins(spark, d):
    return windows.latest(
        table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_suppkey"), ["l_orderkey", "l_partkey"],
        [F.desc("l_linenumber"), F.desc("l_extendedprice"), F.desc("l_suppkey")],
    )


@query("""
    WITH e AS (SELECT user_id, CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op, CASE WHEN event_type IN ('click', 'view', 'signup') THEN event_type END AS seg,
               CASE WHEN event_type = 'purchase' THEN CAST(value AS VARCHAR) END AS bal, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq FROM events),
    i AS (SELECT user_id, max(seq) AS since FROM e WHERE op = 'I' GROUP BY user_id),
    l AS (SELECT e.*, since FROM e LEFT JOIN i USING (user_id) WHERE since IS NULL OR seq >= since),
    g AS (SELECT user_id, arg_max(seg, seq) FILTER (op <> 'D' AND seg IS NOT NULL) AS seg, arg_max(bal, seq) FILTER (op <> 'D' AND bal IS NOT NULL) AS bal, bool_or(op = 'D') AS gone, bool_or(op = 'I') AS new, max(ts) AS last_changed_at, count(*) AS n_events
    FROM l GROUP BY user_id)
    SELECT coalesce(c_custkey, user_id) AS id, coalesce(g.seg, CASE WHEN NOT coalesce(g.new, false) THEN c_mktsegment END) AS segment, coalesce(g.bal, CASE WHEN NOT coalesce(g.new, false) THEN CAST(c_acctbal AS VARCHAR) END) AS balance,
           coalesce(gone, false) AS is_deleted, last_changed_at, coalesce(n_events, 0) AS n_events FROM customer FULL JOIN g ON c_custkey = user_id
""")
def cdc_replay(spark, d):
    e = table(spark, d, "events")
    op = C.lookup(F.col("event_type"), {"signup": "I", "error": "D"}, "U")
    e = e.select(
        F.col("user_id").alias("id"), op.alias("op"), F.when(F.col("event_type").isin("click", "view", "signup"), F.col("event_type")).alias("segment"),
        F.when(F.col("event_type") == "purchase", F.col("value").cast("string")).alias("balance"), F.col("ts").alias("changed_at"),
        F.col("event_id").alias("seq"),
    )
    base = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").cast("string").alias("balance"))
    return history.replay(base, e, "id", ["segment", "balance"])


@query("""
    SELECT user_id, event_type, lag(CAST(floor(value / 100) AS BIGINT)::VARCHAR) OVER w AS old_value, CAST(floor(value / 100) AS BIGINT)::VARCHAR AS new_value, ts, event_id
    FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id) QUALIFY old_value IS DISTINCT FROM new_value
""")
def cdc_change_log(spark, d):
    e = table(spark, d, "events").withColumn("v", F.floor(F.col("value") / 100))
    return history.change_log(e, "user_id", "event_type", "v", ["ts", "event_id"])


@query("""
    WITH t AS (SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_acctbal >= 0),
    s AS (SELECT c_custkey, c_mktsegment, CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer WHERE c_acctbal < 5000),
    j AS (SELECT CASE WHEN t.c_custkey IS NULL THEN 'inserted' WHEN s.c_custkey IS NOT NULL AND (t.c_mktsegment IS DISTINCT FROM s.c_mktsegment OR t.c_acctbal IS DISTINCT FROM s.c_acctbal) THEN 'updated' ELSE 'untouched' END AS change,
          CASE WHEN t.c_custkey IS NULL OR (s.c_custkey IS NOT NULL) THEN s.c_acctbal ELSE t.c_acctbal END AS bal FROM t FULL JOIN s ON t.c_custkey = s.c_custkey)
    SELECT change, count(*) AS n, CAST(sum(CAST(bal AS DECIMAL(18,2))) AS DOUBLE) AS balance FROM j GROUP BY change
""")
def upsert_guarded(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    s = c.where("c_acctbal < 5000").withColumn("c_acctbal", F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
    m = history.upsert(c.where("c_acctbal >= 0"), s, ["c_custkey"], ["c_mktsegment", "c_acctbal"])
    return m.groupBy(F.col("_change").alias("change")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("balance"))


@query("""
    WITH daily AS (SELECT user_id, CAST(ts AS DATE) AS d, arg_max(event_type, row(ts, event_id)) AS status FROM events GROUP BY ALL),
    c AS (SELECT *, lag(status) OVER (PARTITION BY user_id ORDER BY d) AS before FROM daily QUALIFY before IS DISTINCT FROM status)
    SELECT user_id, status, d AS valid_from, lead(d) OVER w AS valid_to, row_number() OVER w AS version, valid_to IS NULL AS is_current, user_id || '#' || version AS asset_sk
    FROM c WINDOW w AS (PARTITION BY user_id ORDER BY d)
""")
def scd2_dim(spark, d):
    daily = table(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("as_of_date")).agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("status"))
    return windows.scd2(daily, "user_id", ["status"]).withColumn("version", F.col("version").cast("long"))


@query("""
    SELECT CAST(day AS DATE) AS day, CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date_key, CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month, CAST(week(day) AS INTEGER) AS iso_week, CAST(dayofweek(day) + 1 AS INTEGER) AS day_of_week
    FROM (SELECT unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS day FROM orders)
""")
def date_dim(spark, d):
    return kpi.date_dim(table(spark, d, "orders"), "o_orderdate")


@query("""
    WITH p AS (SELECT c_custkey, radians((c_custkey * 7919 % 17000) / 100.0::DOUBLE - 85) AS lat, radians((c_custkey * 104729 % 36000) / 100.0::DOUBLE - 180) AS lon FROM customer),
    s AS (SELECT n_nationkey, radians((n_nationkey * 3571 % 17000) / 100.0::DOUBLE - 85) AS lat, radians((n_nationkey * 15485 % 36000) / 100.0::DOUBLE - 180) AS lon FROM nation),
    d AS (SELECT c_custkey, n_nationkey, 12742000.0::DOUBLE * asin(sqrt(pow(sin((s.lat - p.lat) / 2), 2) + cos(p.lat) * cos(s.lat) * pow(sin((s.lon - p.lon) / 2), 2))) AS m FROM p, s)
    SELECT c_custkey, n_nationkey, round(m, 2) AS distance_m, m <= 500000 AS in_band FROM d QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY m, n_nationkey) = 1
""")
def nearest_site(spark, d):
    place = lambda k, a, b: {"lat": (F.col(k).cast("long") * a % 17000) / 100.0 - 85, "lon": (F.col(k).cast("long") * b % 36000) / 100.0 - 180}
    points = table(spark, d, "customer").select("c_custkey").withColumns(place("c_custkey", 7919, 104729))
    sites = table(spark, d, "nation").select("n_nationkey").withColumns(place("n_nationkey", 3571, 15485))
    return spatial.nearest(points, sites, "c_custkey", "n_nationkey", band_m=500_000.0).withColumn("distance_m", F.round("distance_m", 2))


@query("""
    WITH p AS (
        SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 80 + o_orderkey % 1000 / 100.0::DOUBLE WHEN 1 THEN -89.5 ELSE o_orderkey * 7919 % 17000 / 100.0::DOUBLE - 85 END AS lat,
               CASE WHEN o_orderkey % 4 = 2 THEN 180 - o_orderkey % 7 / 1000.0::DOUBLE ELSE o_orderkey * 104729 % 36000 / 100.0::DOUBLE - 180 END AS lon
        FROM orders WHERE o_orderkey % 8 > 3),
    s AS (
        SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 79 + c_custkey % 100 / 10.0::DOUBLE ELSE c_custkey * 3571 % 17000 / 100.0::DOUBLE - 85 END AS lat,
               CASE WHEN c_custkey % 3 = 1 THEN -180 + c_custkey % 11 / 1000.0::DOUBLE ELSE c_custkey * 15485 % 36000 / 100.0::DOUBLE - 180 END AS lon
        FROM customer WHERE c_custkey % 20 = 1),
    d AS (
        SELECT o_orderkey, c_custkey, 12742000.0::DOUBLE * asin(sqrt(least(1, pow(sin(radians(s.lat - p.lat) / 2), 2)
               + cos(radians(p.lat)) * cos(radians(s.lat)) * pow(sin(radians(s.lon - p.lon) / 2), 2)))) AS m
        FROM p, s)
    SELECT o_orderkey, round(min(m), 1) AS distance_m, min(m) <= 50000 AS in_band FROM d GROUP BY o_orderkey
""")
def nearest_rings(spark, d):
    """Orders at places near the poles, on both sides of 180 degrees and everywhere, against sites as odd, in rings of cells."""
    o, c = F.col("o_orderkey"), F.col("c_custkey")
    lat = F.when(o % 4 == 0, 80 + o % 1000 / 100.0).when(o % 4 == 1, -89.5).otherwise(o * 7919 % 17000 / 100.0 - 85)
    lon = F.when(o % 4 == 2, 180 - o % 7 / 1000.0).otherwise(o * 104729 % 36000 / 100.0 - 180)
    points = table(spark, d, "orders").where(o % 8 > 3).select("o_orderkey", lat.alias("lat"), lon.alias("lon"))
    lat = F.when(c % 3 == 0, 79 + c % 100 / 10.0).otherwise(c * 3571 % 17000 / 100.0 - 85)
    lon = F.when(c % 3 == 1, -180 + c % 11 / 1000.0).otherwise(c * 15485 % 36000 / 100.0 - 180)
    sites = table(spark, d, "customer").where(c % 20 == 1).select("c_custkey", lat.alias("lat"), lon.alias("lon"))
    found = spatial.nearest(points, sites, "o_orderkey", "c_custkey", 50_000.0, crossed_sites=0)
    return found.select("o_orderkey", F.round("distance_m", 1).alias("distance_m"), "in_band")


_ENTITY = """WITH r AS (SELECT n_nationkey, n_name AS loc, 'K' || CASE WHEN n_regionkey < 2 THEN n_nationkey ELSE 100 + n_regionkey END AS key FROM nation),
    c AS (SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN 'NATION_' || s_nationkey ELSE s_name END AS loc, 'K' || CASE WHEN s_acctbal > 8000 THEN 999 WHEN s_nationkey < 12 THEN s_nationkey ELSE 100 + s_nationkey % 5 END AS key FROM supplier),
    x AS (SELECT loc AS xloc, min(n_nationkey) AS a FROM r GROUP BY loc), k AS (SELECT key, count(*) AS n, min(n_nationkey) AS a FROM r GROUP BY key),
    m AS (SELECT s_suppkey, CASE WHEN x.a IS NOT NULL THEN x.a WHEN n = 1 THEN k.a END AS n_nationkey, CASE WHEN x.a IS NOT NULL THEN 'EXACT_FUNC_LOC' WHEN n = 1 THEN 'NORMALISED_TAG' WHEN n > 1 THEN 'AMBIGUOUS' ELSE 'NOT_IN_REGISTER' END AS rule,
          CASE WHEN x.a IS NOT NULL THEN 1.0::DOUBLE WHEN n = 1 THEN 0.95::DOUBLE WHEN n > 1 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS score, CASE WHEN x.a IS NOT NULL OR n = 1 THEN 'MATCHED' ELSE 'REVIEW' END AS match_status FROM c LEFT JOIN x ON loc = xloc LEFT JOIN k USING (key))"""


def _resolved(spark, d):
    n, s = table(spark, d, "nation"), table(spark, d, "supplier")
    register = n.select(
        "n_nationkey", F.col("n_name").alias("loc"),
        F.concat(F.lit("K"), F.when(F.col("n_regionkey") < 2, F.col("n_nationkey")).otherwise(100 + F.col("n_regionkey")).cast("string")).alias("key"),
    )
    key = F.when(F.col("s_acctbal") > 8000, F.lit(999)).when(F.col("s_nationkey") < 12, F.col("s_nationkey")).otherwise(100 + F.col("s_nationkey") % 5)
    found = s.select(
        "s_suppkey", F.when(F.col("s_acctbal") < 0, F.concat(F.lit("NATION_"), F.col("s_nationkey").cast("string"))).otherwise(F.col("s_name")).alias("loc"),
        F.concat(F.lit("K"), key.cast("string")).alias("key"),
    )
    return history.resolve(found, register, "loc", "key", "n_nationkey")


@query(f"{_ENTITY} SELECT * FROM m")
def entity_resolution(spark, d):
    return _resolved(spark, d).select("s_suppkey", "n_nationkey", "rule", "score", "match_status")


@query(f"{_ENTITY} SELECT n_nationkey, count(*) AS n_names, count(DISTINCT rule) AS n_systems, string_agg(s, '|' ORDER BY s) AS names FROM (SELECT DISTINCT n_nationkey, rule, CAST(s_suppkey AS VARCHAR) AS s FROM m WHERE match_status = 'MATCHED') GROUP BY n_nationkey")
def xref_survive(spark, d):
    return history.xref(_resolved(spark, d).withColumn("name", F.col("s_suppkey").cast("string")), "n_nationkey", "rule", "name")


@query("""
    WITH o AS (SELECT o_custkey, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent FROM orders GROUP BY o_custkey),
    l AS (SELECT o_custkey, count(*) AS n_lines, max(l_quantity) AS max_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey)
    SELECT c_custkey, n_name, r_name, coalesce(n_orders, 0) AS n_orders, spent, coalesce(n_lines, 0) AS n_lines, max_quantity
    FROM customer LEFT JOIN o ON c_custkey = o.o_custkey LEFT JOIN l ON c_custkey = l.o_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
""")
def star_left_joins(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    per_order = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"), F.max("l_quantity").alias("q"))  # reduced before it meets orders
    o = orders.groupBy("c_custkey").agg(F.count(F.lit(1)).alias("n_orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("spent"))
    lines = per_order.join(orders.select("o_orderkey", "c_custkey"), "o_orderkey").groupBy("c_custkey").agg(F.sum("n").alias("n_lines"), F.max("q").alias("max_quantity"))
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    c = table(spark, d, "customer").join(o, "c_custkey", "left").join(lines, "c_custkey", "left").join(joins.small(n), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return c.select("c_custkey", "n_name", "r_name", F.coalesce("n_orders", F.lit(0)).alias("n_orders"), "spent", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), "max_quantity")


@query("SELECT max(CASE WHEN r_name = 'AFRICA' THEN r_regionkey END) AS \"AFRICA\", max(CASE WHEN r_name = 'ASIA' THEN r_regionkey END) AS \"ASIA\", max(CASE WHEN r_name = 'EUROPE' THEN r_regionkey END) AS \"EUROPE\" FROM region")
def param_pivot(spark, d):
    return aggregates.pivot_parameters(table(spark, d, "region"), [], "r_name", "r_regionkey", ["AFRICA", "ASIA", "EUROPE"])


@query("""
    SELECT n_name, count(*) AS n_assets, count(*) FILTER (c_acctbal < 0) AS n_negative, count(*) FILTER (c_mktsegment = 'BUILDING') AS n_building, min(c_acctbal) AS min_balance, max(c_acctbal) AS max_balance,
           CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name
""")
def rollup_facility(spark, d):
    c = table(spark, d, "customer")
    by = c.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("n_assets"), F.count_if(F.col("c_acctbal") < 0).alias("n_negative"),
        F.count_if(F.col("c_mktsegment") == "BUILDING").alias("n_building"), F.min("c_acctbal").alias("min_balance"), F.max("c_acctbal").alias("max_balance"),
        F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("balance"),
    )
    return by.join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "n_assets", "n_negative", "n_building", "min_balance", "max_balance", "balance")


@query("""
    WITH l AS (SELECT doc_id, min(quality) AS quality FROM labels GROUP BY doc_id)
    SELECT lang, source, count(*) AS received, count(quality) AS covered, count(quality)::DOUBLE / count(*) AS coverage FROM documents LEFT JOIN l USING (doc_id) GROUP BY lang, source
""")
def coverage_ratio(spark, d):
    labels = table(spark, d, "labels").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    joined = table(spark, d, "documents").select("doc_id", "lang", "source").join(labels, "doc_id", "left")
    return kpi.coverage(joined, ["lang", "source"], "true", "quality is not null")


@query("""
    WITH b AS (SELECT o_orderkey, o_orderpriority, o_totalprice, 'risk' AS ordering, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderdate, o_orderkey) AS position FROM orders
      UNION ALL SELECT o_orderkey, o_orderpriority, o_totalprice, 'calendar', row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) FROM orders)
    SELECT o_orderkey, o_orderpriority, ordering, CAST(position AS BIGINT) AS position, position * 0.5::DOUBLE AS review_h FROM b WHERE o_totalprice >= 400000
""")
def time_to_review(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice", "o_orderdate")
    return kpi.time_to_review(
        o, "o_orderpriority", "o_totalprice", "o_orderdate", "o_orderkey", 0.5, "o_totalprice >= 400000",
    ).select("o_orderkey", "o_orderpriority", "ordering", F.col("position").cast("long"), "review_h")


@query("""
    SELECT o_custkey, count(*) AS orders_30d, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent_30d FROM orders
    WHERE CAST(o_orderdate AS DATE) > (SELECT max(CAST(o_orderdate AS DATE)) - 30 FROM orders) GROUP BY o_custkey
""")
def trailing_counts(spark, d):
    o = table(spark, d, "orders")
    newest = o.agg(F.date_sub(F.max(F.to_date("o_orderdate")), 30).alias("since"))
    recent = o.crossJoin(F.broadcast(newest)).where(F.to_date("o_orderdate") > F.col("since"))
    return recent.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders_30d"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("spent_30d"))


@query("""
    WITH w AS (SELECT *, avg(value) OVER w AS baseline, stddev_pop(value) OVER w AS sd, count(*) OVER w AS n
    FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))
    SELECT event_id, event_type, round(value, 8) AS value, round(baseline, 8) AS baseline, round((value - baseline) / sd, 8) AS zscore FROM w
    WHERE n = 24 AND NOT (sd < 1e-6 OR (baseline <> 0 AND sd / abs(baseline) < 1e-3)) AND abs(value - baseline) >= 3.0 * sd AND abs(value - baseline) >= 0.1 * greatest(abs(baseline), 1e-9)
""")
def rolling_zscore(spark, d):
    z = windows.rolling_zscore(table(spark, d, "events").select("event_id", "event_type", "ts", "value"), "event_type", ["ts", "event_id"], "value")
    return z.select("event_id", "event_type", *(F.round(c, 8).alias(c) for c in ("value", "baseline", "zscore")))


@query("""
    WITH l AS (SELECT l_orderkey, count(*) AS n, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS s FROM lineitem GROUP BY l_orderkey),
    o AS (SELECT o_orderpriority, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS expected, CAST(sum(s) AS DOUBLE) AS actual, CAST(sum(CASE WHEN s IS NULL THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS explained
    FROM orders LEFT JOIN l ON o_orderkey = l_orderkey GROUP BY o_orderpriority)
    SELECT 'gold' AS layer, o_orderpriority AS entity, 'control_total' AS check_name, expected, actual, explained AS explained_by, CASE WHEN abs(expected - actual) <= 0.005 THEN 'MATCHED' WHEN abs(expected - actual - coalesce(explained, 0)) <= 0.005 THEN 'EXPLAINED' ELSE 'MISMATCH' END AS status, '' AS detail FROM o
   
    UNION ALL SELECT 'gold', o_orderpriority, 'order_count', count(*)::DOUBLE, count(n)::DOUBLE, count(*) FILTER (n IS NULL)::DOUBLE, CASE WHEN count(*) = count(n) THEN 'MATCHED' ELSE 'EXPLAINED' END, ''
    FROM orders LEFT JOIN l ON o_orderkey = l_orderkey GROUP BY o_orderpriority
""")
def recon_status(spark, d):
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("s"))
    both = table(spark, d, "orders").withColumn("price", F.col("o_totalprice").cast("decimal(18,2)")).join(lines, "o_orderkey", "left")
    by = both.groupBy("o_orderpriority").agg(
        F.sum("price").cast("double").alias("expected"), F.sum("s").cast("double").alias("actual"),
        F.sum(F.when(F.col("s").isNull(), F.col("price"))).cast("double").alias("explained"), F.count(F.lit(1)).alias("all"), F.count("n").alias("some"),
    )
    total = checks.check(by, "gold", F.col("o_orderpriority"), "control_total", F.col("expected"), F.col("actual"), F.col("explained"))
    count = checks.check(by, "gold", F.col("o_orderpriority"), "order_count", F.col("all").cast("double"), F.col("some").cast("double"), (F.col("all") - F.col("some")).cast("double"))
    return checks.union([total, count])


@query("""
    WITH v AS (SELECT c_nationkey, sum(CAST(c_acctbal AS DECIMAL(18,2))) AS s FROM customer GROUP BY c_nationkey),
    a AS (SELECT CAST(sum(s) AS DOUBLE) AS certified FROM v),
    b AS (SELECT CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS consumer FROM customer)
    SELECT 'balance' AS comparison, certified, consumer, CASE WHEN abs(certified - consumer) <= 0.005 * greatest(1.0, abs(certified)) THEN 'MATCHED' ELSE 'MISMATCH' END AS status FROM a, b
""")
def kpi_consistency(spark, d):
    c = table(spark, d, "customer").withColumn("b", F.col("c_acctbal").cast("decimal(18,2)"))
    view = c.groupBy("c_nationkey").agg(F.sum("b").alias("s")).agg(F.sum("s").cast("double").alias("v"))
    return checks.kpi_consistency(view.crossJoin(c.agg(F.sum("b").cast("double").alias("c"))), "balance", F.col("v"), F.col("c"))


@query("""
    SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS sum_qty, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price, max(l_discount) AS max_discount
    FROM lineitem WHERE l_shipdate <= TIMESTAMP '2001-01-01' AND l_quantity > 1 GROUP BY l_returnflag, l_linestatus ORDER BY l_returnflag, l_linestatus LIMIT 1000
""")
def metric_query(spark, d):
    measures = {"n": "count(*)", "sum_qty": "sum(l_quantity)", "sum_price": "cast(sum(cast(l_extendedprice as decimal(18,2))) as double)", "max_discount": "max(l_discount)"}
    return aggregates.metric(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], measures, ["l_shipdate <= timestamp_ntz '2001-01-01'", "l_quantity > 1"], 1000)


@query("""
    SELECT k, 'left' AS side FROM (SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
   
    UNION ALL SELECT k, 'right'
    FROM (SELECT o_custkey AS k
    FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT c_custkey
    FROM customer WHERE c_acctbal > 0) WHERE k NOT IN (SELECT c_custkey FROM customer)
""")
def set_difference(spark, d):
    return joins.both_differences(table(spark, d, "customer").select(F.col("c_custkey").alias("k")), table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k")))


@query("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)")
def semi_join(spark, d):
    big = table(spark, d, "orders").where("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").select("c_custkey", "c_name").join(big, "c_custkey", "left_semi")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)")
def anti_join(spark, d):
    big = table(spark, d, "orders").where("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").select("c_custkey", "c_name").join(big, "c_custkey", "left_anti")


@query("""
    SELECT doc_id, digest, min(doc_id) OVER (PARTITION BY digest) AS first_doc_id, doc_id <> first_doc_id AS is_duplicate FROM (SELECT doc_id, sha256(text) AS digest FROM documents)
""")
def sha_dedup(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))  # the text stays in the scan's task
    first = docs.groupBy("digest").agg(F.min("doc_id").alias("first_doc_id"))  # partial minimum, then a join the planner can split
    return docs.join(first, "digest").select("doc_id", "digest", "first_doc_id", (F.col("doc_id") != F.col("first_doc_id")).alias("is_duplicate"))


@query("""
    SELECT p_brand, s_nationkey, count(*) AS n_pairs
    FROM part JOIN (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY p_brand, s_nationkey
""")
def bridge_join(spark, d):
    pairs = table(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey"))
    joined = joins.bridge(table(spark, d, "part").select("p_partkey", "p_brand"), pairs, table(spark, d, "supplier").select("s_suppkey", "s_nationkey"), "p_partkey", "s_suppkey")
    return joined.groupBy("p_brand", "s_nationkey").agg(F.count(F.lit(1)).alias("n_pairs"))


@query("""
    WITH c AS (SELECT DISTINCT conv_id FROM conversations),
    l AS (SELECT conv_id, turn, length(text) AS n_chars FROM conversations WHERE role = 'assistant' QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, length(text) DESC) = 1)
    SELECT conv_id, turn, CAST(n_chars AS INTEGER) AS n_chars FROM c LEFT JOIN l USING (conv_id)
""")
def latest_review(spark, d):
    c = table(spark, d, "conversations")
    reviews = c.where("role = 'assistant'").select("conv_id", "turn", F.length("text").alias("n_chars"))
    return joins.left_latest(c.select("conv_id").distinct(), reviews, "conv_id", [F.desc("turn"), F.desc("n_chars")])


@query("""
    WITH r AS (SELECT l_extendedprice AS v FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'), c AS (SELECT l_extendedprice AS v FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01'),
    e AS (SELECT quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM r), b AS (SELECT unnest(range(10)) AS bin),
    rr AS (SELECT len(list_filter(q, lambda x: x < v)) AS bin, count(*) AS n FROM r, e GROUP BY 1), cc AS (SELECT len(list_filter(q, lambda x: x < v)) AS bin, count(*) AS n FROM c, e GROUP BY 1),
    s AS (SELECT greatest(coalesce(rr.n, 0)::DOUBLE / (SELECT count(*) FROM r), 1e-4) AS p, greatest(coalesce(cc.n, 0)::DOUBLE / (SELECT count(*) FROM c), 1e-4) AS q
    FROM b LEFT JOIN rr USING (bin) LEFT JOIN cc USING (bin)),
    t AS (SELECT sum((q - p) * ln(q / p)) AS psi FROM s)
    SELECT round(psi, 8) AS psi, CASE WHEN psi >= 0.25 THEN 'ALERT' WHEN psi >= 0.1 THEN 'WARN' ELSE 'OK' END AS status FROM t
""")
def psi_drift(spark, d):
    lines = table(spark, d, "lineitem").select("l_extendedprice", "l_shipdate")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    p = aggregates.psi(lines.where(F.col("l_shipdate") < cut), lines.where(F.col("l_shipdate") >= cut), "l_extendedprice")
    return p.select(F.round("psi", 8).alias("psi"), aggregates.drift_status(F.col("psi")).alias("status"))


@query("""
    WITH p AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
    s AS (SELECT i, avg(x) AS m, greatest(stddev_pop(x), 1e-6) AS s FROM p GROUP BY i),
    z AS (SELECT vec_id, avg(pow((x - m) / s, 2)) AS distance FROM p JOIN s USING (i) GROUP BY vec_id)
    SELECT vec_id, round(distance, 6) AS distance, distance > (SELECT quantile_cont(distance, 0.995) FROM z) AS is_ood FROM z
""")
def ood_distance(spark, d):
    return aggregates.ood_distance(table(spark, d, "embeddings"), "vec_id", "embedding").withColumn("distance", F.round("distance", 6))


_SCORED = "SELECT quality AS y, least(1.0::DOUBLE, n_chars / 5000.0::DOUBLE) AS p FROM documents JOIN labels USING (doc_id)"


def _scored(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.least(F.lit(1.0), F.col("n_chars") / 5000.0).alias("p"))
    return docs.join(table(spark, d, "labels").select("doc_id", F.col("quality").alias("y")), "doc_id").select("y", "p")


@query(f"""
    WITH d AS ({_SCORED}),
    g AS (SELECT p, count(*) AS n, sum(y) AS pos FROM d GROUP BY p),
    w AS (SELECT n, pos, pos * (coalesce(sum(n - pos) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (n - pos) / 2) AS won FROM g),
    a AS (SELECT sum(won)::DOUBLE / (sum(pos) * sum(n - pos))::DOUBLE AS auroc FROM w),
    t AS (SELECT min(p) AS threshold FROM (SELECT p, row_number() OVER (ORDER BY p DESC) AS r, count(*) OVER () AS c FROM d WHERE y = 1) WHERE r <= ceil(0.9::DOUBLE * c))
    SELECT round(auroc, 8) AS auroc, round(threshold, 8) AS threshold, count(*) FILTER (y = 1 AND p >= threshold) AS tp, count(*) FILTER (y = 1 AND p < threshold) AS fn, count(*) FILTER (y <> 1 AND p >= threshold) AS fp, count(*) FILTER (y <> 1 AND p < threshold) AS tn, round(avg(pow(p - y, 2)), 8) AS brier FROM d, a, t GROUP BY ALL
""")
def auroc_threshold(spark, d):
    scored = _scored(spark, d)
    t = aggregates.threshold_for(scored, "y", "p", 0.9)
    hits = scored.crossJoin(F.broadcast(t)).select("y", F.when(F.col("p") >= F.col("threshold"), 1.0).otherwise(0.0).alias("hit"))
    counts = aggregates.classification_metrics(hits, "y", "hit", 0.5).select("tp", "fn", "fp", "tn")
    brier = scored.agg(F.round(F.avg(F.pow(F.col("p") - F.col("y"), 2)), 8).alias("brier"))
    return aggregates.auroc(scored, "y", "p").select(F.round("auroc", 8).alias("auroc")).crossJoin(t.select(F.round("threshold", 8).alias("threshold"))).crossJoin(counts).crossJoin(brier)


@query("""
    WITH d AS (SELECT doc_id, least(1.0::DOUBLE, n_chars / 5000.0::DOUBLE) AS p, CASE WHEN lang = 'en' THEN 'A' ELSE 'B' END AS crit, n_chars >= 100 AS ok FROM documents),
    b AS (SELECT *, CASE WHEN p >= 0.8 THEN 'P1' WHEN abs(p - 0.4::DOUBLE) < 0.05 THEN 'UNCERTAIN' WHEN p >= 0.4 THEN 'P2' ELSE 'P3' END AS raw FROM d)
    SELECT doc_id, CASE WHEN NOT ok THEN 'NA' WHEN crit = 'A' AND raw IN ('P3', 'UNCERTAIN') THEN 'P2' ELSE raw END AS band FROM b
""")
def policy_bands(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "n_chars", F.least(F.lit(1.0), F.col("n_chars") / 5000.0).alias("p"), F.when(F.col("lang") == "en", "A").otherwise("B").alias("crit"))
    return docs.select("doc_id", C.policy_band(F.col("p"), 0.4, 0.8, 0.05, F.col("n_chars") >= 100, F.col("crit")).alias("band"))


@query("""
    WITH m AS (SELECT avg(l_discount) AS discount, count(*) FILTER (l_returnflag = 'R')::DOUBLE / count(*) AS returned, max(l_quantity) AS quantity FROM lineitem)
    SELECT 'discount' AS metric, round(discount, 8) AS value, '<=' AS comparison, 0.06::DOUBLE AS limit_value, discount <= 0.06 AS passed FROM m
    UNION ALL SELECT 'returned', round(returned, 8), '>=', 0.5::DOUBLE, returned >= 0.5 FROM m
    UNION ALL SELECT 'quantity', quantity, '<=', 50.0::DOUBLE, quantity <= 50 FROM m
""")
def gate_checks(spark, d):
    m = table(spark, d, "lineitem").agg(F.avg("l_discount").alias("discount"), (F.count_if(F.col("l_returnflag") == "R") / F.count(F.lit(1))).alias("returned"), F.max("l_quantity").alias("quantity"))
    return checks.gate(m, {"discount": ("<=", 0.06), "returned": (">=", 0.5), "quantity": ("<=", 50.0)}).withColumn("value", F.round("value", 8))


@query("""
    WITH s AS (SELECT source, count(quality) AS n, count(*) AS docs FROM documents LEFT JOIN (SELECT doc_id, min(quality) AS quality FROM labels GROUP BY doc_id) USING (doc_id) GROUP BY source),
    r AS (SELECT source, n, list_filter([CASE WHEN source = 'src3' THEN 'forced' END, CASE WHEN n * 2 < docs AND docs % 40 >= 3 THEN 'drift' END, CASE WHEN n >= 20 THEN 'feedback' END, CASE WHEN docs % 40 > 30 THEN 'age' END], lambda x: x IS NOT NULL) AS a FROM s)
    SELECT source, n AS new_labels, array_to_string(a, '|') AS reasons, len(a) > 0 AS retrain FROM r
""")
def retrain_decision(spark, d):
    labels = table(spark, d, "labels").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    by = table(spark, d, "documents").select("doc_id", "source").join(labels, "doc_id", "left").groupBy("source").agg(F.count("quality").alias("n"), F.count(F.lit(1)).alias("docs"))
    why = checks.retrain_reasons(F.col("docs") % 40, F.col("n"), F.when(F.col("n") * 2 < F.col("docs"), "ALERT").otherwise("OK"), F.col("source") == "src3")
    return by.select("source", F.col("n").alias("new_labels"), F.concat_ws("|", why).alias("reasons"), (F.size(why) > 0).alias("retrain"))


@query(r"""
    WITH w AS (SELECT doc_id, string_split_regex(trim(text, E' \t\n\x0B\x0C\r'), '[ \t\n\x0B\f\r]+') AS w FROM documents WHERE trim(text, E' \t\n\x0B\x0C\r') <> ''),
    c AS (SELECT doc_id, w, unnest(range(CAST(greatest(ceil((len(w) - 60) / 45.0), 0) AS BIGINT) + 1)) AS chunk_no FROM w)
    SELECT doc_id, CAST(chunk_no AS INTEGER) AS chunk_no, sha256(array_to_string(w[chunk_no * 45 + 1 : chunk_no * 45 + 60], ' ')) AS chunk_sha FROM c
""")
def text_chunks(spark, d):
    return text.chunks(table(spark, d, "documents"), "doc_id", "text").select("doc_id", "chunk_no", F.sha2("chunk", 256).alias("chunk_sha"))


@query(r"""
    SELECT page_id, nullif(trim(regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '\s+', ' ', 'g')), '') AS title, nullif(regexp_extract(html, '<html lang="([a-z]+)"', 1), '') AS lang, nullif(trim(regexp_replace(regexp_extract(html, '<h1>([^<]*)</h1>', 1), '\s+', ' ', 'g')), '') AS heading FROM pages
""")
def field_extract(spark, d):
    return table(spark, d, "pages").select("page_id", *text.fields(F.col("html"), {"title": "<title>([^<]*)</title>", "lang": '<html lang="([a-z]+)"', "heading": "<h1>([^<]*)</h1>"}))


@query(r"""
    WITH m AS (SELECT doc_id, regexp_extract_all(text, '[A-Z][a-z]+tion') AS a FROM documents),
    u AS (SELECT doc_id, unnest(a) AS t, generate_subscripts(a, 1) AS i FROM m),
    f AS (SELECT doc_id, t, min(i) AS i FROM u GROUP BY doc_id, t)
    SELECT doc_id, CAST(count(*) AS INTEGER) AS n_tags, string_agg(t, '|' ORDER BY i) AS tags FROM f GROUP BY doc_id
""")
def tag_extract(spark, d):
    t = table(spark, d, "documents").select("doc_id", text.tags(F.col("text"), "[A-Z][a-z]+tion").alias("t")).where(F.size("t") > 0)
    return t.select("doc_id", F.size("t").alias("n_tags"), F.array_join("t", "|").alias("tags"))


@query(r"""
    WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9][a-z0-9\-]+') AS t FROM documents), q AS (SELECT ['there', 'and', 'there and', 'the', 'and the'] AS terms),
    x AS (SELECT doc_id, unnest(list_concat(t, list_transform(range(1, greatest(len(t), 1)), lambda i: t[i] || ' ' || t[i + 1]))) AS term FROM t),
    tf AS (SELECT doc_id, term, ln(count(*)) + 1 AS tf FROM x GROUP BY ALL),
    df AS (SELECT term, ln((1 + (SELECT count(*) FROM documents))::DOUBLE / (1 + count(*))) + 1 AS idf FROM tf GROUP BY term), w AS (SELECT doc_id, term, tf * idf AS w FROM tf JOIN df USING (term)),
    qq AS (SELECT term, idf AS qw FROM df WHERE list_contains((SELECT terms FROM q), term)), n AS (SELECT sqrt(sum(qw * qw)) AS qn FROM qq),
    s AS (SELECT doc_id, sum(w * coalesce(qw, 0)) AS dot, sqrt(sum(w * w)) AS norm FROM w LEFT JOIN qq USING (term) GROUP BY doc_id)
    SELECT doc_id, round(dot / (norm * qn), 8) AS similarity FROM s, n WHERE dot > 0 ORDER BY round(dot / (norm * qn), 10) DESC, doc_id LIMIT 10
""")
def tfidf_search(spark, d):
    return search.tfidf_search(table(spark, d, "documents"), "doc_id", "text", "there and the", 10).withColumn("similarity", F.round("similarity", 8))


@query(r"""
    WITH c AS (SELECT conv_id, string_agg(text, ' ' ORDER BY turn) FILTER (role = 'user') AS ctx, string_agg(text, ' ' ORDER BY turn) FILTER (role = 'assistant') AS out
    FROM conversations GROUP BY conv_id),
    b AS (SELECT conv_id, list_transform(regexp_extract_all(regexp_replace(regexp_replace(coalesce(ctx, ''), '\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2})?Z?)?', ' ', 'g'), '\b[A-Za-z]{1,6}[-_][\w\-.]*\d[\w\-.]*', ' ', 'g'), '-?\d+(?:\.\d+)?'), lambda x: x::DOUBLE) AS base,
          list_transform(regexp_extract_all(regexp_replace(regexp_replace(coalesce(out, ''), '\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2})?Z?)?', ' ', 'g'), '\b[A-Za-z]{1,6}[-_][\w\-.]*\d[\w\-.]*', ' ', 'g'), '-?\d+(?:\.\d+)?'), lambda x: x::DOUBLE) AS o FROM c),
    p AS (SELECT conv_id, list_filter(o, lambda x: x <> floor(x) OR abs(x) >= 10) AS checked, list_concat(base, list_transform(base, lambda x: round(x, 1)), list_transform(list_filter(base, lambda x: abs(x) < 1), lambda x: round(x * 100, 1))) AS pool FROM b)
    SELECT conv_id, CAST(len(checked) AS INTEGER) AS n_checked, CAST(len(list_filter(checked, lambda x: len(list_filter(pool, lambda c: abs(x - c) <= greatest(0.06, 0.011 * abs(c)))) = 0)) AS INTEGER) AS n_ungrounded FROM p
""")
def grounding_numbers(spark, d):
    c = table(spark, d, "conversations")
    side = lambda role: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("role") == role, F.struct("turn", "text")))), lambda x: x["text"]), " ")
    by = c.groupBy("conv_id").agg(side("user").alias("ctx"), side("assistant").alias("out"))
    checked = F.filter(text.numbers(F.col("out")), lambda x: (x != F.floor(x)) | (F.abs(x) >= 10))
    return by.select("conv_id", F.size(checked).alias("n_checked"), F.size(text.ungrounded(F.col("out"), F.col("ctx"))).alias("n_ungrounded"))


@query("""
    WITH s AS (SELECT lang, source, list_sort(list_distinct(list(CAST(n_chars // 1000 AS VARCHAR)))) AS items FROM documents GROUP BY ALL),
    l AS (SELECT *, lag(items) OVER (PARTITION BY lang ORDER BY source) AS b FROM s)
    SELECT lang, source, array_to_string(items, ',') AS items, array_to_string(list_sort(list_filter(items, lambda x: NOT list_contains(coalesce(b, []), x))), ',') AS added, array_to_string(list_sort(list_filter(coalesce(b, []), lambda x: NOT list_contains(items, x))), ',') AS removed FROM l
""")
def revision_diff(spark, d):
    docs = table(spark, d, "documents").select("lang", "source", F.floor(F.col("n_chars") / 1000).cast("string").alias("item"))
    r = windows.revision_diff(docs, "lang", "source", "item")
    return r.select("lang", "source", *(F.array_join(F.sort_array(c), ",").alias(c) for c in ("items", "added", "removed")))


@query("SELECT c_custkey, sha256(c_name) AS c_name, regexp_replace(regexp_replace(c_mktsegment, '[A-Za-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS c_mktsegment, CAST(NULL AS VARCHAR) AS c_acctbal FROM customer")
def masked_view(spark, d):
    return table(spark, d, "customer").select("c_custkey", C.masked("c_name", "HASH"), C.masked("c_mktsegment", "MASK"), C.masked("c_acctbal", "NULL"))


@query("""
    SELECT event_type, event_id, value, CAST(row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS BIGINT) AS rank FROM events QUALIFY rank <= 10
""")
def top_by_rank(spark, d):
    w = Window.partitionBy("event_type").orderBy(F.desc("value"), "event_id")
    return table(spark, d, "events").select("event_type", "event_id", "value", F.row_number().over(w).cast("long").alias("rank")).where("rank <= 10")


@query("""
    WITH b AS (SELECT p_brand || '-' || (p_size % 3) AS brand, p_partkey FROM part), g AS (SELECT brand, count(*) AS n, min(p_partkey) AS p_partkey FROM b GROUP BY brand)
    SELECT s_suppkey, 'Brand#' || s_suppkey || '-0' AS brand, coalesce(n, 0) AS n_hits, CASE WHEN n = 1 THEN 'MATCHED' WHEN n > 1 THEN 'AMBIGUOUS' ELSE 'NOT_IN_REGISTER' END AS match_status, CASE WHEN n = 1 THEN p_partkey END AS p_partkey
    FROM supplier LEFT JOIN g ON brand = 'Brand#' || s_suppkey || '-0'
""")
def key_cardinality(spark, d):
    register = table(spark, d, "part").select(F.concat("p_brand", F.lit("-"), (F.col("p_size") % 3).cast("string")).alias("brand"), "p_partkey")
    found = table(spark, d, "supplier").select("s_suppkey", F.concat(F.lit("Brand#"), F.col("s_suppkey").cast("string"), F.lit("-0")).alias("brand"))
    return joins.match_by_key(found, register, "brand", "p_partkey").select("s_suppkey", "brand", "n_hits", "match_status", "p_partkey")


@query("""
    WITH e AS (SELECT event_type, CAST(value AS DECIMAL(18,2)) AS v, len({reasons}) = 0 AS good FROM events),
    g AS (SELECT event_type, count(*)::DOUBLE AS n, CAST(sum(v) AS DOUBLE) AS s, coalesce(CAST(sum(v) FILTER (good) AS DOUBLE), 0) AS got, coalesce(CAST(sum(v) FILTER (NOT good) AS DOUBLE), 0) AS held
    FROM e GROUP BY event_type)
    SELECT 'bronze' AS layer, event_type AS entity, 'landed_records' AS check_name, n AS expected, n AS actual, NULL::DOUBLE AS explained_by, 'MATCHED' AS status, '' AS detail FROM g
    UNION ALL SELECT 'bronze', event_type, 'control_total', s, got, held, CASE WHEN abs(s - got) <= 0.005 THEN 'MATCHED' ELSE 'EXPLAINED' END, '' FROM g
""".replace("{reasons}", _REASONS))
def bronze_checks(spark, d):
    """Counts and control totals of the batch against what was accepted and quarantined."""
    amount = F.col("value").cast("decimal(18,2)")
    e = table(spark, d, "events").select("event_type", amount.alias("amount"))
    manifest = e.groupBy(F.col("event_type").alias("entity")).agg(F.count(F.lit(1)).alias("records"), F.sum("amount").alias("control_total"))
    v = _validated_events(spark, d).select(F.col("event_type").alias("entity"), amount.alias("amount"), (F.size("_reject_reasons") == 0).alias("good"))
    return checks.landed_records(manifest, v.where("good"), v.where("not good"))


@query("""
    WITH b AS (SELECT o_custkey, CAST(o_totalprice AS DECIMAL(18,2)) AS v FROM orders),
    u AS (SELECT count(*)::DOUBLE AS n, count(DISTINCT o_custkey)::DOUBLE AS k FROM b),
    t AS (SELECT CAST(sum(m) AS DOUBLE) AS s FROM (SELECT max(v) AS m FROM b GROUP BY o_custkey)),
    d AS (SELECT lang, count(*)::DOUBLE AS n, count(*) FILTER (n_chars >= 200)::DOUBLE AS got, count(*) FILTER (n_chars < 200 AND n_chars % 3 > 0)::DOUBLE AS failed FROM documents GROUP BY lang)
    SELECT 'silver' AS layer, 'orders' AS entity, 'record_count' AS check_name, n AS expected, k AS actual, n - k AS explained_by, CASE WHEN n = k THEN 'MATCHED' ELSE 'EXPLAINED' END AS status, '' AS detail FROM u
    UNION ALL SELECT 'silver', 'orders', 'total', s, s, NULL, 'MATCHED', '' FROM t
    UNION ALL SELECT 'silver', lang, 'objects_extracted', n, got, failed, CASE WHEN n = got THEN 'MATCHED' WHEN n - got = failed THEN 'EXPLAINED' ELSE 'MISMATCH' END, '' FROM d
""")
def silver_checks(spark, d):
    """Parity with the layer before, explained by repeated keys; every object extracted or in error."""
    o = table(spark, d, "orders").select("o_custkey", F.col("o_totalprice").cast("decimal(18,2)").alias("v"))
    docs = table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    kept = o.groupBy("o_custkey").agg(F.max("v").alias("v"))
    found = checks.extraction(docs, docs.where("n_chars >= 200"), docs.where("n_chars < 200 and n_chars % 3 > 0"), "doc_id", "lang")
    return checks.union([checks.record_parity(o, kept, "o_custkey", "orders", "v"), found])


@query("""
    WITH p AS (SELECT max(CASE WHEN n_name = 'NATION_1' THEN n_regionkey END) AS "NATION_1", max(CASE WHEN n_name = 'NATION_2' THEN n_regionkey END) AS "NATION_2", n_regionkey AS grp
    FROM nation GROUP BY n_regionkey),
    r AS (SELECT c_nationkey % 5 AS grp, max(c_acctbal) AS top FROM customer WHERE c_nationkey % 5 < 4 GROUP BY 1)
    SELECT s_suppkey, p."NATION_1", p."NATION_2", top FROM supplier JOIN p ON s_nationkey % 5 = p.grp LEFT JOIN r ON s_nationkey % 5 = r.grp
""")
def parameter_join(spark, d):
    """Findings meet the pivoted parameters of their date (inner) and the risk fact (left)."""
    p = aggregates.pivot_parameters(table(spark, d, "nation").withColumn("grp", F.col("n_regionkey")), ["grp"], "n_name", "n_regionkey", ["NATION_1", "NATION_2"])
    grp = (F.col("c_nationkey") % 5).alias("grp")
    risk = table(spark, d, "customer").where("c_nationkey % 5 < 4").groupBy(grp).agg(F.max("c_acctbal").alias("top"))
    s = table(spark, d, "supplier").select("s_suppkey", (F.col("s_nationkey") % 5).alias("grp"))
    return s.join(p, "grp").join(risk, "grp", "left").drop("grp")


@query("""
    WITH daily AS (SELECT user_id, CAST(ts AS DATE) AS d, arg_max(event_type, row(ts, event_id)) AS status FROM events GROUP BY ALL),
    now AS (SELECT user_id, arg_max(status, d) AS status FROM daily GROUP BY user_id)
    SELECT c_custkey, c_mktsegment, status FROM customer LEFT JOIN now ON c_custkey = user_id
""")
def current_dimension(spark, d):
    """Left join to the version of the dimension that is current."""
    return table(spark, d, "customer").select("c_custkey", "c_mktsegment").join(scd2_dim(spark, d).where("is_current").select(F.col("user_id").alias("c_custkey"), "status"), "c_custkey", "left")


@query("SELECT event_type AS layer, CAST(user_id % 7 AS BIGINT) AS guardrail, count(*) AS n, max(ts) AS last_seen FROM events GROUP BY ALL")
def event_counts(spark, d):
    e = table(spark, d, "events")
    return e.groupBy(F.col("event_type").alias("layer"), (F.col("user_id") % 7).alias("guardrail")).agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_seen"))


@query("SELECT c_nationkey AS video, round(avg((c_custkey * 7919 % 17000) / 100.0::DOUBLE - 85), 8) AS lat, round(avg((c_custkey * 104729 % 36000) / 100.0::DOUBLE - 180), 8) AS lon FROM customer GROUP BY c_nationkey")
def mean_position(spark, d):
    place = lambda a, b, c: F.round(F.avg((F.col("c_custkey") * a % b) / 100.0 - c), 8)
    return table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("video")).agg(place(7919, 17000, 85).alias("lat"), place(104729, 36000, 180).alias("lon"))


@query("""
    WITH o AS (SELECT o_orderkey, o_orderkey % 4 AS k, CASE o_orderkey % 4 WHEN 0 THEN 'doc' WHEN 1 THEN 'clip' WHEN 2 THEN 'line' ELSE 'other' END AS source, CAST(o_orderdate AS DATE) AS day, 'F_' || (o_orderkey % 50) AS stem FROM orders),
    n AS (SELECT *, stem || CASE WHEN k = 1 THEN '.json' ELSE '.bin' END AS file_name, CASE WHEN k = 1 AND o_orderkey % 3 = 0 THEN 'SIDE-' || (o_orderkey % 9) END AS side, CASE WHEN k = 1 THEN day + INTERVAL 1 HOUR * (1 + o_orderkey % 5) END AS seen FROM o),
    t AS (SELECT stem, day, min(seen) AS seen FROM n WHERE seen IS NOT NULL GROUP BY stem, day)
    SELECT o_orderkey, CASE WHEN side IS NOT NULL THEN side WHEN source = 'line' THEN 'FIELD' WHEN source = 'doc' THEN substr(stem, 3) END AS hint, CASE WHEN side IS NOT NULL THEN 'SIDECAR' WHEN source = 'line' THEN 'CONSTANT' WHEN source = 'doc' THEN 'FILE_NAME' END AS basis,
           CAST(coalesce(n.seen, t.seen, day::TIMESTAMP) AS TIMESTAMP) AS captured_at FROM n LEFT JOIN t USING (stem, day)
""")
def object_hints(spark, d):
    """Asset hints by side file, constant or name pattern; capture times by side file, stem or date."""
    k = F.col("o_orderkey") % 4
    o = table(spark, d, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("business_date"),
        F.when(k == 0, "doc").when(k == 1, "clip").when(k == 2, "line").otherwise("other").alias("source"),
    )
    o = o.withColumns({
        "file_name": F.concat(F.lit("F_"), (F.col("o_orderkey") % 50).cast("string"), F.when(k == 1, ".json").otherwise(".bin")),
        "side": F.when((k == 1) & (F.col("o_orderkey") % 3 == 0), F.concat(F.lit("SIDE-"), (F.col("o_orderkey") % 9).cast("string"))),
        "sidecar_time": F.when(k == 1, F.timestamp_add("HOUR", (1 + F.col("o_orderkey") % 5).cast("int"), F.col("business_date").cast("timestamp"))),
    })
    hint = objects.asset_hint(F.col("source"), F.col("file_name"), {"doc": r"^F_(\d+)\.bin$"}, {"line": "FIELD"}, F.col("side"))
    out = objects.with_capture_time(o).withColumn("h", hint)
    return out.select("o_orderkey", "h.hint", "h.basis", F.col("captured_at").cast("timestamp_ntz").alias("captured_at"))


_CONVERSED = """
    WITH c AS (
        SELECT conv_id, string_agg(text, ' ' ORDER BY turn) FILTER (role = 'user') AS ctx, string_agg(text, ' ' ORDER BY turn) FILTER (role = 'assistant')
               || CASE WHEN conv_id % 6 = 0 THEN ' [a.pdf p.1] [b.pdf p. 2]' ELSE '' END || ' with 10.5 and 20 and 33.25 and 999' AS out
        FROM conversations GROUP BY conv_id),
    g AS (SELECT conv_id, coalesce(ctx, '') || CASE WHEN conv_id % 2 = 0 THEN ' 10.5 and 20 and 33.25' ELSE '' END AS ctx, coalesce(out, '') AS out FROM c)"""


@query(_CONVERSED + r"""
    , known AS (SELECT DISTINCT unnest(regexp_extract_all(ctx, '[A-Z][a-z]{2,6}')) AS tag FROM g WHERE conv_id % 3 = 0),
    t AS (SELECT DISTINCT conv_id, unnest(regexp_extract_all(out, '[A-Z][a-z]{2,6}')) AS tag FROM g), x AS (SELECT DISTINCT conv_id, unnest(regexp_extract_all(ctx, '[A-Z][a-z]{2,6}')) AS tag FROM g),
    u AS (SELECT conv_id, tag FROM t ANTI JOIN x USING (conv_id, tag) ANTI JOIN known USING (tag))
    SELECT conv_id, 'UNKNOWN_TAG' AS rule, count(*)::DOUBLE AS value, string_agg(tag, ', ' ORDER BY tag) AS detail FROM u GROUP BY conv_id
    UNION ALL SELECT conv_id, 'UNGROUNDED_NUMBER', 1.0, '4 of 4' FROM g WHERE conv_id % 2 = 1 AND out <> ''
    UNION ALL SELECT conv_id, 'NO_CITATION', 0.0, '' FROM g WHERE conv_id % 3 = 0 AND (conv_id % 6 <> 0 OR out = '')
    UNION ALL SELECT conv_id, 'FOREIGN_CITATION', 1.0, 'b.pdf' FROM g WHERE conv_id % 6 = 0 AND out <> ''
""")
def grounding_findings(spark, d):
    """Answers held against what was asked, a dimension of known names, the numbers given and the files at hand."""
    c = table(spark, d, "conversations")
    side = lambda role: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("role") == role, F.struct("turn", "text")))), lambda x: x["text"]), " ")
    rows = c.groupBy("conv_id").agg(side("user").alias("ctx"), side("assistant").alias("out"))
    k = F.col("conv_id")
    cites = F.when(k % 6 == 0, " [a.pdf p.1] [b.pdf p. 2]").otherwise("")
    told = F.when(F.col("out") != "", F.concat("out", cites, F.lit(" with 10.5 and 20 and 33.25 and 999"))).otherwise("")
    rows = rows.select(
        "conv_id", F.concat("ctx", F.when(k % 2 == 0, " 10.5 and 20 and 33.25").otherwise("")).alias("ctx"), told.alias("out"),
        F.when(k % 3 == 0, F.array(F.lit("a.pdf"))).alias("files"),
    )
    pattern = r"[A-Z][a-z]{2,6}"
    known = rows.where(k % 3 == 0).select(F.explode(text.tags(F.col("ctx"), pattern)).alias("tag"))
    return text.grounding(rows, "conv_id", "out", "ctx", known, "tag", pattern, "files", max_share=0.26)


@query("""
    WITH s AS (
        SELECT 'order' AS system, o_custkey AS k, o_orderpriority AS name, CAST(o_orderdate AS DATE) AS day, NULL::DOUBLE AS lat, NULL::DOUBLE AS lon FROM orders
        UNION ALL SELECT 'status', o_custkey, 'pi-' || o_orderstatus || '01.PV', CAST(o_orderdate AS DATE), NULL, NULL FROM orders
        UNION ALL SELECT 'shipment', l_suppkey, l_returnflag, CAST(l_shipdate AS DATE), l_quantity, l_tax * 100 FROM lineitem
        UNION ALL SELECT 'line', l_suppkey, nullif(l_linestatus, 'F'), CAST(l_shipdate AS DATE), NULL, NULL FROM lineitem
        UNION ALL SELECT 'event', user_id, event_type, CAST(ts AS DATE), NULL, NULL FROM events
        UNION ALL SELECT 'visit', user_id, CASE WHEN value > 50 THEN 'PL-02-SEG-001' END, CAST(ts AS DATE), NULL, NULL FROM events
        UNION ALL SELECT 'part', l_partkey, '', CAST(l_shipdate AS DATE), NULL, NULL FROM lineitem)
    SELECT system, CAST(k AS VARCHAR) AS src_key, name AS src_name, min(day) AS first_seen, round(avg(lat), 6) AS lat, round(avg(lon), 6) AS lon
    FROM s WHERE name <> '' AND (system NOT IN ('order', 'status', 'shipment', 'line') OR day <= DATE '1998-01-01') GROUP BY ALL
""")
def first_seen_names(spark, d):
    """The names that seven systems use, each with its first date: one union, reduced where it is read."""
    o, l, e = (table(spark, d, t) for t in ("orders", "lineitem", "events"))
    old = F.to_date(F.lit("1998-01-01"))
    o, l = o.where(F.to_date("o_orderdate") <= old), l.where(F.to_date("l_shipdate") <= old)
    sources = {
        "order": (o, "o_custkey", "o_orderpriority", "o_orderdate"),
        "status": (o.withColumn("name", F.concat(F.lit("pi-"), "o_orderstatus", F.lit("01.PV"))), "o_custkey", "name", "o_orderdate"),
        "shipment": (l.withColumns({"lat": F.col("l_quantity"), "lon": F.col("l_tax") * 100}), "l_suppkey", "l_returnflag", "l_shipdate"),
        "line": (l.withColumn("name", F.nullif("l_linestatus", F.lit("F"))), "l_suppkey", "name", "l_shipdate"),
        "event": (e, "user_id", "event_type", "ts"),
        "visit": (e.withColumn("name", F.when(F.col("value") > 50, "PL-02-SEG-001")), "user_id", "name", "ts"),
        "part": (l.withColumn("name", F.lit("")), "l_partkey", "name", "l_shipdate"),
    }
    found = history.first_seen_candidates(sources)
    return found.select("system", "src_key", "src_name", "first_seen", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1")
def largest_order(spark, d):
    """The row of the largest value of each key."""
    return windows.largest(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], F.col("o_totalprice"), ["o_orderkey"])


@query("""
    SELECT user_id, event_id, value FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) = 1) ORDER BY value DESC, event_id LIMIT 8
""")
def action_plan(spark, d):
    """The most urgent finding of each object, the eight most urgent objects."""
    return text.plan(table(spark, d, "events").select("user_id", "event_id", "value"), "user_id", [F.desc("value"), F.col("event_id")])


@query("""
    SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN 'none' WHEN p_retailprice / 50000 >= 0.02 OR p_size % 7 >= 3 THEN 'severe' ELSE 'surface' END AS severity FROM part
""")
def frame_severities(spark, d):
    """Severity of a frame by its area and its boxes."""
    p = table(spark, d, "part")
    return p.select("p_partkey", C.frame_severity(F.col("p_retailprice") / 50000, F.col("p_size") % 7).alias("severity"))


@query("""
    WITH c AS (
        SELECT o_custkey AS k, CASE WHEN o_orderkey % 17 = 0 THEN 'D' WHEN row_number() OVER w = 1 OR o_orderkey % 13 = 0 THEN 'I' ELSE 'U' END AS op,
               CASE WHEN o_orderkey % 3 > 0 THEN o_orderstatus END AS status, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS priority, o_orderdate AS changed_at, o_orderkey AS seq
        FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
    l AS (SELECT *, count(*) FILTER (op = 'I') OVER (PARTITION BY k ORDER BY changed_at, seq ROWS UNBOUNDED PRECEDING) AS life FROM c),
    s AS (
        SELECT k, life, op, CAST(changed_at AS DATE) AS d, changed_at, seq, last_value(status IGNORE NULLS) OVER w AS status, last_value(priority IGNORE NULLS) OVER w AS priority
        FROM l WINDOW w AS (PARTITION BY k, life ORDER BY changed_at, seq ROWS UNBOUNDED PRECEDING)),
    days AS (SELECT CAST(unnest(generate_series(DATE '1996-03-01', DATE '1996-03-20', INTERVAL 1 DAY)) AS DATE) AS day),
    n AS (SELECT day, s.* FROM days JOIN s ON s.d <= day QUALIFY row_number() OVER (PARTITION BY day, k ORDER BY changed_at DESC, seq DESC) = 1)
    SELECT day, k, status, priority FROM n WHERE op <> 'D' AND life > 0
""")
def register_snapshots(spark, d):
    """Orders as changes of customers: the register at the end of each of twenty days."""
    o = table(spark, d, "orders")
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    op = F.when(F.col("o_orderkey") % 17 == 0, "D").when((F.row_number().over(w) == 1) | (F.col("o_orderkey") % 13 == 0), "I").otherwise("U")
    changes = o.select(
        F.col("o_custkey").alias("k"), op.alias("op"), F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).alias("priority"), F.col("o_orderdate").alias("at"), F.col("o_orderkey").alias("seq"),
    )
    return history.daily_snapshots(changes, "k", ["status", "priority"], "at", "seq", "1996-03-01", "1996-03-20")


@query("""
    WITH scope AS (SELECT c_custkey AS tag, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer WHERE c_nationkey < 5),
    f AS (SELECT tag FROM scope WHERE rank <= 15 OR tag % 40 = 0),
    o AS (SELECT o_custkey AS tag, o_orderkey AS doc, o_orderdate AS day, o_orderkey AS id FROM orders),
    i AS (SELECT * FROM o SEMI JOIN f USING (tag) WHERE day < DATE '1998-01-02' QUALIFY row_number() OVER (PARTITION BY tag ORDER BY day DESC, doc DESC) = 1),
    w AS (SELECT * FROM o SEMI JOIN f USING (tag) WHERE CAST(day AS DATE) BETWEEN DATE '1997-12-02' AND DATE '1998-01-01' ORDER BY day DESC, id LIMIT 40),
    c AS (SELECT l_orderkey AS doc, l_linenumber - 1 AS chunk_no, l_returnflag FROM lineitem WHERE l_linenumber <= 2)
    SELECT 'inspection' AS kind, tag AS key, doc AS id, NULL::VARCHAR AS detail FROM i
    UNION ALL SELECT 'order', tag, id, NULL FROM w
    UNION ALL SELECT 'chunk', doc, chunk_no, l_returnflag FROM c SEMI JOIN i USING (doc)
""")
def facts_summary(spark, d):
    """The focus of a scope and its evidence: newest inspection of each asset, recent work orders, first chunks."""
    customers, o = table(spark, d, "customer").where("c_nationkey < 5"), table(spark, d, "orders")
    scope = customers.select(F.col("c_custkey").alias("tag"), "c_acctbal")
    worklist = ranks.ranked(scope, [F.desc("c_acctbal"), F.col("tag")], "rank")
    flagged = table(spark, d, "customer").where("c_custkey % 40 = 0").select(F.col("c_custkey").alias("tag"))
    rows = o.select(F.col("o_custkey").alias("tag"), F.col("o_orderkey").alias("doc"), F.col("o_orderdate").alias("at"), F.col("o_orderkey").alias("id"))
    chunks = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc"), (F.col("l_linenumber") - 1).alias("chunk_no"), "l_returnflag")
    found = facts.evidence(facts.focus(worklist, flagged, scope, "tag", "rank"), rows, rows, chunks, "tag", "doc", "at", "at", "1998-01-01", "id")
    row = lambda df, kind, key, id_, detail: df.select(F.lit(kind).alias("kind"), F.col(key).cast("long").alias("key"), F.col(id_).cast("long").alias("id"), detail.cast("string").alias("detail"))
    none = F.lit(None)
    return checks.union([row(found["inspections"], "inspection", "tag", "doc", none), row(found["orders"], "order", "tag", "id", none), row(found["chunks"], "chunk", "doc", "chunk_no", F.col("l_returnflag"))])


@query("""
    WITH m AS (SELECT DISTINCT l_partkey AS sheet, s_nationkey AS asset FROM lineitem JOIN supplier ON l_suppkey = s_suppkey AND l_linenumber = 1),
    p AS (SELECT p_partkey AS sheet, 'pid/' || p_partkey || '.pdf' AS pdf FROM part)
    SELECT asset, pdf, p_partkey AS image FROM m JOIN p USING (sheet) JOIN part ON regexp_extract(pdf, '([^/]+)\\.pdf$', 1) = CAST(p_partkey AS VARCHAR)
""".replace("\\\\", "\\"))
def drawing_tags(spark, d):
    """Tags of sheets, the assets they map to, the sheets' drawings, and the images with the drawings' file stems."""
    lines = table(spark, d, "lineitem").where("l_linenumber = 1").select(F.col("l_partkey").alias("sheet"), F.col("l_suppkey").alias("tag"))
    tag_map = table(spark, d, "supplier").select(F.col("s_suppkey").alias("tag"), F.col("s_nationkey").alias("asset"))
    drawings = table(spark, d, "part").select(F.col("p_partkey").alias("sheet"), F.concat(F.lit("pid/"), F.col("p_partkey").cast("string"), F.lit(".pdf")).alias("pdf"))
    images = table(spark, d, "part").select(F.col("p_partkey").alias("image"), F.concat(F.lit("scan/"), F.col("p_partkey").cast("string"), F.lit(".png")).alias("png"))
    mapped = lines.join(tag_map, "tag").select("sheet", "asset").distinct().join(drawings, "sheet")
    stem = lambda c: F.regexp_extract(c, r"([^/]+)\.[^./]+$", 1)
    return mapped.withColumn("_stem", stem("pdf")).join(images.withColumn("_stem", stem("png")), "_stem").select("asset", "pdf", "image")


@query("""
    WITH w AS (SELECT user_id AS sensor, time_bucket(INTERVAL '1 day', ts) AS day, count(*) AS n FROM events GROUP BY ALL),
    b AS (SELECT DISTINCT o_custkey AS sensor, o_orderpriority AS asset FROM orders),
    daily AS (SELECT user_id, CAST(ts AS DATE) AS d, arg_max(event_type, row(ts, event_id)) AS status FROM events GROUP BY ALL),
    now AS (SELECT user_id AS sensor, arg_max(status, d) AS status FROM daily GROUP BY user_id)
    SELECT asset, status, count(*) AS windows, CAST(sum(n) AS BIGINT) AS readings FROM w JOIN b USING (sensor) JOIN now USING (sensor) GROUP BY asset, status
""")
def scoped_windows(spark, d):
    """Windows of sensors over the distinct pairs of a bridge, with the version of the dimension that is current."""
    e = table(spark, d, "events")
    w = e.groupBy(F.col("user_id").alias("sensor"), F.window("ts", "1 day").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    pairs = table(spark, d, "orders").select(F.col("o_custkey").alias("sensor"), F.col("o_orderpriority").alias("asset"))
    current = scd2_dim(spark, d).where("is_current").select(F.col("user_id").alias("sensor"), "status")
    found = w.join(pairs.distinct(), "sensor").join(current, "sensor")
    return found.groupBy("asset", "status").agg(F.count(F.lit(1)).alias("windows"), F.sum("n").alias("readings"))


@query("""
    SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS created, TRY_CAST(left(o_orderpriority, 1) AS INTEGER) AS priority, o_orderstatus = 'F' AS is_corrective
    FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey DESC) = 1
""")
def typed_orders(spark, d):
    """Work orders typed from text, of each id's rows the one that came last in its file."""
    raw = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "dd.MM.yyyy").alias("created"), F.substring("o_orderpriority", 1, 1).alias("priority"))
    newest = windows.latest(raw, ["o_custkey", "o_orderstatus"], [F.desc("o_orderkey")])
    typed = [C.typed(F.col("created"), "date", ("yyyy-MM-dd", "dd.MM.yyyy")).alias("created"), C.typed(F.col("priority"), "int").alias("priority")]
    return newest.select("o_custkey", "o_orderkey", *typed, (F.col("o_orderstatus") == "F").alias("is_corrective"))


@query(r"""
    WITH p AS (
        SELECT coalesce(nullif(regexp_extract(html, '<html lang="([a-z]+)"', 1), ''), 'none') AS lang, nullif(trim(regexp_extract(html, '<title>([^<]*)</title>', 1)), '') AS title,
               nullif(trim(regexp_extract(html, '<h1>([^<]*)</h1>', 1)), '') AS heading, CASE WHEN page_id % 9 > 0 THEN url END AS address FROM pages),
    b AS (SELECT lang, count(*) AS n, count(title) AS t, count(heading) AS h, count(address) AS a FROM p GROUP BY lang)
    SELECT 'silver' AS layer, lang AS entity, 'fields_extracted' AS check_name, (3 * n)::DOUBLE AS expected, (t + h + a)::DOUBLE AS actual, NULL::DOUBLE AS explained_by,
           CASE WHEN 3 * n = t + h + a THEN 'MATCHED' ELSE 'MISMATCH' END AS status,
           concat_ws(', ', CASE WHEN t < n THEN 'title ' || (n - t) END, CASE WHEN h < n THEN 'heading ' || (n - h) END, CASE WHEN a < n THEN 'address ' || (n - a) END) AS detail FROM b
""")
def field_checks(spark, d):
    """Fields found in pages of each language against those that every page should have."""
    own = text.fields(F.col("html"), {"lang": "<html lang=\"([a-z]+)\"", "title": "<title>([^<]*)</title>", "heading": "<h1>([^<]*)</h1>"})
    rows = table(spark, d, "pages").select(*own, F.when(F.col("page_id") % 9 > 0, F.col("url")).alias("address"))
    return checks.fields_extracted(rows.fillna("none", ["lang"]), "lang", ["title", "heading", "address"])


@query("SELECT event_type AS entity, CAST(ts AS DATE) AS day FROM events GROUP BY ALL")
def loaded_dates(spark, d):
    """The dates that each entity has rows for."""
    return table(spark, d, "events").select(F.col("event_type").alias("entity"), F.to_date("ts").alias("day")).distinct()


_KPIS = {
    "orders": "count(*)", "customers": "count(distinct o_custkey)", "turnover": "sum(o_totalprice)", "largest": "max(o_totalprice)", "smallest": "min(o_totalprice)", "mean": "avg(o_totalprice)",
    "final": "count_if(o_orderstatus = 'F')", "urgent": "count_if(o_orderpriority like '1%')", "share_final": "avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END)",
}


@query(" UNION ALL ".join(
    f"SELECT '{name}' AS comparison, round(CAST({sql} AS DOUBLE), 4) AS certified, round(CAST({sql} AS DOUBLE) * {1.1 if name == 'largest' else 1}, 4) AS consumer, '{'MISMATCH' if name == 'largest' else 'MATCHED'}' AS status FROM orders"
    for name, sql in _KPIS.items()
))
def kpi_comparisons(spark, d):
    """Nine certified values against those a consumer makes of a daily roll-up; one of them a tenth too large."""
    o = table(spark, d, "orders")
    view = o.agg(*(F.expr(sql).cast("double").alias(name) for name, sql in _KPIS.items()))
    daily = o.groupBy("o_orderdate", "o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("s"), F.max("o_totalprice").alias("hi"), F.min("o_totalprice").alias("lo"),
        F.count_if(F.col("o_orderstatus") == "F").alias("f"), F.count_if(F.col("o_orderpriority").startswith("1")).alias("u"),
    )
    made = {
        "orders": F.sum("n"), "customers": F.count_distinct("o_custkey"), "turnover": F.sum("s"), "largest": F.max("hi") * 1.1, "smallest": F.min("lo"), "mean": F.sum("s") / F.sum("n"),
        "final": F.sum("f"), "urgent": F.sum("u"), "share_final": F.sum("f") / F.sum("n"),
    }
    consumer = daily.agg(*(c.cast("double").alias(f"c_{name}") for name, c in made.items()))
    both = view.crossJoin(consumer)  # one row each
    found = checks.union([checks.kpi_consistency(both, name, F.col(name), F.col(f"c_{name}")) for name in _KPIS])
    return found.select("comparison", F.round("certified", 4).alias("certified"), F.round("consumer", 4).alias("consumer"), "status")
