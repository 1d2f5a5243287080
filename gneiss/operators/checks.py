"""Reconciliation, gates and policies: every check is a row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gneiss.functions.columns import recon_status

CHECK_COLUMNS = ["layer", "entity", "check_name", "expected", "actual", "explained_by", "status", "detail"]


def check(
    df: DataFrame, layer: str, entity: Column | str, name: str, expected: Column, actual: Column, explained: Column | None = None, late: Column | None = None,
    detail: Column | None = None,
) -> DataFrame:
    """Check rows of a frame that has expected and actual values; ``late`` sets the status LATE over a mismatch."""
    status = recon_status(expected, actual, explained)
    if late is not None:
        status = F.when(late & (status == "MISMATCH"), "LATE").otherwise(status)
    entity = F.lit(entity) if isinstance(entity, str) else entity
    d = lambda c: (c if c is not None else F.lit(None)).cast("double")
    return df.select(
        F.lit(layer).alias("layer"), entity.alias("entity"), F.lit(name).alias("check_name"), d(expected).alias("expected"), d(actual).alias("actual"),
        d(explained).alias("explained_by"), status.alias("status"), (detail if detail is not None else F.lit("")).alias("detail"),
    )


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def landed_records(manifest: DataFrame, accepted: DataFrame, quarantined: DataFrame, entity: str = "entity") -> DataFrame:
    """Records that the manifest (entity, records, control_total) lists against those accepted or quarantined, as rows
    (entity, amount): the counts must agree, and a gap of the control total may be explained by what was quarantined."""
    by = lambda df, n, s: df.groupBy(entity).agg(F.count(F.lit(1)).alias(n), F.sum("amount").alias(s))
    both = manifest.join(by(accepted, "_good", "_sum"), entity, "left").join(by(quarantined, "_bad", "_held"), entity, "left")
    both = both.fillna(0, ["_good", "_bad", "_sum", "_held"])
    count = check(both, "bronze", F.col(entity), "landed_records", F.col("records"), F.col("_good") + F.col("_bad"))
    total = check(both, "bronze", F.col(entity), "control_total", F.col("control_total"), F.col("_sum"), F.col("_held"))
    return union([count, total])


def file_trailers(stats: DataFrame) -> DataFrame:
    """Each pipe-separated file's data lines against its trailer's count (see ``readers.psv_stats``)."""
    return check(stats, "bronze", F.col("_source_file"), "file_trailer", F.col("trailer_count"), F.col("n_lines"))


def landed_objects(listed: DataFrame, source: str = "source", verdict: str = "verdict") -> DataFrame:
    """Objects a source's manifest lists against those that landed and are sound, explained by what was quarantined."""
    by = listed.groupBy(source).agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col(verdict) == "OK").alias("_ok"), F.count_if(~F.col(verdict).isin("OK", "MISSING_FILE")).alias("_held"))
    return check(by, "bronze", F.col(source), "landed_objects", F.col("_n"), F.col("_ok"), F.col("_held"))


def latest_run(audit: DataFrame, stage: str, batch_id: str) -> DataFrame:
    """One row (run_status, message, started): the state of a batch's newest run of a stage, NOT RUN without one.

    audit: (stage, batch_id, entity, status, message, at); a run begins with the STARTED of entity ``*``.
    """
    own = audit.where((F.col("stage") == stage) & (F.col("batch_id") == batch_id))
    begun = own.agg(F.max(F.when((F.col("entity") == "*") & (F.col("status") == "STARTED"), F.col("at"))).alias("started"))
    ends = (F.col("entity") == "*") & F.col("status").isin("COMPLETED", "FAILED") & (F.col("at") >= F.col("started"))
    end = own.crossJoin(F.broadcast(begun)).where(ends).agg(F.max_by(F.struct("status", "message"), "at").alias("e"))
    both = begun.crossJoin(F.broadcast(end))  # one row each
    state = F.when(F.col("started").isNull(), "NOT RUN").otherwise(F.coalesce("e.status", F.lit("RUNNING")))
    return both.select(state.alias("run_status"), F.when(F.col("e.status") == "FAILED", F.col("e.message")).otherwise("").alias("message"), "started")


def batch_status(audit: DataFrame, stage: str, batch_id: str) -> DataFrame:
    """Whether the newest run of the stage has completed."""
    run = latest_run(audit, stage, batch_id)
    detail = F.concat(F.lit(f"last {stage} run "), "run_status", F.when(F.col("message") != "", F.concat(F.lit(": "), "message")).otherwise(""))
    return check(run, stage, "*", "batch_status", F.lit(1), (F.col("run_status") == "COMPLETED").cast("int"), detail=detail)


def load_status(audit: DataFrame, accepted: DataFrame, stage: str, batch_id: str, entity: str = "entity") -> DataFrame:
    """Whether each entity of ``accepted`` (entity, n: rows held for the date) was loaded or skipped by the newest run."""
    run = F.broadcast(latest_run(audit, stage, batch_id))
    own = audit.where((F.col("stage") == stage) & (F.col("batch_id") == batch_id) & F.col("status").isin("COMMITTED", "SKIPPED"))
    state = own.crossJoin(run).where(F.col("at") >= F.col("started")).groupBy(entity).agg(F.max_by("status", "at").alias("_state"))
    both = accepted.join(state, entity, "left").crossJoin(run)
    held = F.when(F.col("n") > 0, F.concat(F.lit("the table holds "), F.col("n").cast("string"), F.lit(" rows of an earlier run"))).otherwise("no rows for the date")
    detail = F.when(F.col("_state") == "COMMITTED", "committed by the last run").when(F.col("_state") == "SKIPPED", "committed by an earlier attempt").otherwise(held)
    return check(both, stage, F.col(entity), "load_status", F.lit(1), F.col("_state").isNotNull().cast("int"), detail=detail)


def object_findings(objects: DataFrame, source: str = "source", verdict: str = "verdict", name: str = "file_name", most: int = 5) -> DataFrame:
    """Per source the objects quarantined (none are expected) and, where there are any, the resends of bytes already here,
    which explain themselves. ``verdict`` is VALID, DUPLICATE or the code of a rejection."""
    bad = ~F.col(verdict).isin("VALID", "DUPLICATE")
    reasons = F.array_sort(F.collect_set(F.when(bad, F.col(verdict))))  # as many as there are codes
    by = objects.groupBy(source).agg(F.count_if(bad).alias("_bad"), F.count_if(F.col(verdict) == "DUPLICATE").alias("_again"), reasons.alias("_codes"))
    none = F.lit("every object passed its format contract")
    held = check(by, "bronze", F.col(source), "object_quarantine", F.lit(0), F.col("_bad"), detail=F.when(F.col("_bad") > 0, F.array_join(F.slice("_codes", 1, most), ", ")).otherwise(none))
    again = by.where("_again > 0")
    return union([held, check(again, "bronze", F.col(source), "object_duplicates", F.lit(0), F.col("_again"), -F.col("_again"), detail=F.lit("resent bytes are stored once"))])


def record_parity(upstream: DataFrame, downstream: DataFrame, key: str, entity: str, amount: str | None = None) -> DataFrame:
    """Records, and a total, of a layer against the one before, where repeated keys of the one before explain a gap.

    Of rows with one key the layer keeps one; the total is compared over the rows it kept, so a gap there is no duplicate.
    """
    up = upstream.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), *([F.max(amount).alias("_a")] if amount else []))
    a = up.agg(F.sum("_n").alias("_rows"), (F.sum("_n") - F.count(F.lit(1))).alias("_copies"), *([F.sum("_a").alias("_expected")] if amount else []))
    b = downstream.agg(F.count(F.lit(1)).alias("_kept"), *([F.sum(amount).alias("_actual")] if amount else []))
    one = a.crossJoin(b)  # one row each
    out = [check(one, "silver", entity, "record_count", F.col("_rows"), F.col("_kept"), F.col("_copies"))]
    if amount:
        out.append(check(one, "silver", entity, "total", F.col("_expected"), F.col("_actual")))
    return union(out)


def extraction(valid: DataFrame, extracted: DataFrame, errors: DataFrame, key: str, kind: str) -> DataFrame:
    """Every valid object of a kind is extracted or has an extraction error, which explains the gap."""
    marked = valid.select(key, kind).join(extracted.select(key).distinct().withColumn("_x", F.lit(1)), key, "left")
    marked = marked.join(errors.select(key).distinct().withColumn("_e", F.lit(1)), key, "left")
    by = marked.groupBy(kind).agg(F.count(F.lit(1)).alias("_n"), F.count("_x").alias("_got"), F.count_if(F.col("_x").isNull() & F.col("_e").isNotNull()).alias("_failed"))
    return check(by, "silver", F.col(kind), "objects_extracted", F.col("_n"), F.col("_got"), F.col("_failed"))


def fields_extracted(extracted: DataFrame, kind: str, fields: Sequence[str]) -> DataFrame:
    """Per kind of object the values found of the fields it should have; the detail counts what is missing by field."""
    by = extracted.groupBy(kind).agg(F.count(F.lit(1)).alias("_n"), *(F.count(f).alias(f"_f{i}") for i, f in enumerate(fields)))
    got = reduce(lambda a, b: a + b, (F.col(f"_f{i}") for i in range(len(fields))))
    missing = [F.when(F.col(f"_f{i}") < F.col("_n"), F.concat(F.lit(f"{f} "), (F.col("_n") - F.col(f"_f{i}")).cast("string"))) for i, f in enumerate(fields)]
    return check(by, "silver", F.col(kind), "fields_extracted", F.col("_n") * len(fields), got, detail=F.concat_ws(", ", *missing))


def report(results: DataFrame, path: str) -> None:
    """The rows that do not match as one CSV file."""
    results.where("status <> 'MATCHED'").coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def minute_counts(control: DataFrame, landed: DataFrame, quarantined: DataFrame, keys: tuple[str, ...] = ("minute", "producer_run"), grace: str = "INTERVAL 10 MINUTES") -> DataFrame:
    """Control counts per minute against what landed or was quarantined; short minutes within the grace are LATE."""
    counted = lambda df, name: df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    both = control.join(counted(landed, "landed"), list(keys), "left").join(counted(quarantined, "held"), list(keys), "left").fillna(0, ["landed", "held"])
    newest = control.agg(F.max("minute").alias("_newest"))
    both = both.crossJoin(F.broadcast(newest))
    return check(both, "stream", F.date_format("minute", "yyyy-MM-dd HH:mm"), "minute_counts", F.col("total"), F.col("landed") + F.col("held"), late=F.col("minute") > F.col("_newest") - F.expr(grace))


def stream_records(
    control: DataFrame, landed: DataFrame, quarantined: DataFrame, table: str, key: str, keys: tuple[str, ...] = ("minute", "producer_run"),
    grace: str = "INTERVAL 10 MINUTES",
) -> DataFrame:
    """A stream's landed and quarantined messages against its control counts, and its repeated ids (none are expected).

    control: (keys, total). Missing messages are LATE if every minute that lacks any lies within the grace of the newest
    one. An id counts once in its minute.
    """
    keys = list(keys)
    expected = control.groupBy(*keys).agg(F.max("total").alias("total"))  # a control message may be repeated
    ids = landed.groupBy(*keys, key).agg(F.count(F.lit(1)).alias("_c"))
    got = ids.groupBy(*keys).agg(F.count(F.lit(1)).alias("_landed"), F.sum("_c").alias("_rows"))
    held = quarantined.groupBy(*keys).agg(F.count(F.lit(1)).alias("_held"))
    both = expected.join(got, keys, "left").join(held, keys, "left").fillna(0, ["_landed", "_rows", "_held"])
    newest = F.broadcast(expected.agg(F.max(keys[0]).alias("_newest")))
    both = both.crossJoin(newest)
    short = F.col("_landed") + F.col("_held") < F.col("total")
    recent = F.col(keys[0]) >= F.col("_newest") - F.expr(grace)
    sums = both.agg(
        F.sum("total").alias("_n"), F.sum(F.col("_landed") + F.col("_held")).alias("_got"), F.sum("_rows").alias("_rows"), F.sum("_landed").alias("_ids"),
        F.count_if(short).alias("_short"), F.count_if(short & recent).alias("_recent"),
    )
    late = (F.col("_short") > 0) & (F.col("_short") == F.col("_recent"))
    records = check(sums, "stream", table, "stream_records", F.col("_n"), F.col("_got"), late=late, detail=F.concat(F.col("_short").cast("string"), F.lit(" minute(s) short")))
    return union([records, check(sums, "stream", table, "stream_duplicates", F.lit(0), F.col("_rows") - F.col("_ids"))])


def window_records(readings: DataFrame, windows: DataFrame, lateness: str = "lateness_s", allowed_s: float = 600.0) -> DataFrame:
    """Readings against what the one-minute windows hold (n); LATE if no more are missing than were sent too late."""
    a = readings.agg(F.count(F.lit(1)).alias("_all"), F.count_if(F.col(lateness) > allowed_s).alias("_late"))
    b = windows.where("window_size = '1 minute'").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("_in"))
    one = a.crossJoin(F.broadcast(b))  # one row each
    gap = F.col("_all") - F.col("_in")
    detail = F.concat(F.col("_late").cast("string"), F.lit(" sent too late"))
    return check(one, "stream", "sensor_window", "window_records", F.col("_all"), F.col("_in"), late=(gap > 0) & (gap <= F.col("_late")), detail=detail)


def kpi_consistency(df: DataFrame, name: str, view: Column, consumer: Column, tolerance: float = 0.005) -> DataFrame:
    """A certified value against a consumer's, relative tolerance."""
    ok = F.abs(view - consumer) <= tolerance * F.greatest(F.lit(1.0), F.abs(view))
    return df.select(F.lit(name).alias("comparison"), view.alias("certified"), consumer.alias("consumer"), F.when(ok, "MATCHED").otherwise("MISMATCH").alias("status"))


def gate(metrics: DataFrame, limits: Mapping[str, tuple[str, float]], champion: float | None = None, regression: float = 0.01) -> DataFrame:
    """(metric, value, comparison, limit_value, passed) for a one-row frame of metrics; a champion sets one more floor."""
    wanted = [(m, op, float(v)) for m, (op, v) in limits.items()]
    rows = [(m, m, op, v) for m, op, v in wanted] + ([("auroc_vs_champion", "auroc", ">=", champion - regression)] if champion is not None else [])
    table = F.array(*(F.struct(F.lit(n).alias("metric"), F.col(c).cast("double").alias("value"), F.lit(op).alias("comparison"), F.lit(v).alias("limit_value")) for n, c, op, v in rows))
    out = metrics.select(F.explode(table).alias("g")).select("g.*")
    passed = F.when(
        F.col("comparison") == ">=", F.col("value") >= F.col("limit_value"),
    ).when(F.col("comparison") == "<=", F.col("value") <= F.col("limit_value")).otherwise(F.col("value") == F.col("limit_value"))
    return out.withColumn("passed", passed)


def retrain_reasons(age_days: Column, new_labels: Column, drift: Column, forced: Column, min_labels: int = 20, max_age: int = 30, cooldown: int = 3) -> Column:
    """Array of the reasons to train again; empty if none."""
    codes = [F.when(forced, "forced"), F.when((drift == "ALERT") & (age_days >= cooldown), "drift"), F.when(new_labels >= min_labels, "feedback"), F.when(age_days > max_age, "age")]
    return F.array_compact(F.array(*codes))


def asset_checks(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Adds failed_checks: the columns that are null or outside their range."""
    codes = [F.when(F.col(c).isNull(), F.lit(f"{c}:MISSING")).when((F.col(c) < lo) | (F.col(c) > hi), F.lit(f"{c}:OUT_OF_RANGE")) for c, (lo, hi) in ranges.items()]
    return df.withColumn("failed_checks", F.array_compact(F.array(*codes)))
