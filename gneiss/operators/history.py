"""Change data capture, upserts and entity resolution as joins and aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gneiss.functions.columns import match_key


def replay(base: DataFrame, events: DataFrame, key: str, fields: Sequence[str], op: str = "op", order: Sequence[str] = ("changed_at", "seq")) -> DataFrame:
    """State after insert (I), update (U) and delete (D) events: each field's last value, is_deleted, last change.

    An insert clears what came before it; an update sets its non-null fields and does not bring a deleted row back; an
    update of an unknown key makes a row. One aggregation per key over base and events, no row loop.
    """
    at = F.struct(*order)
    inserts = events.where(F.col(op) == "I").groupBy(key).agg(F.max(at).alias("_since"))
    later = events.join(inserts, key, "left").where(F.col("_since").isNull() | (at >= F.col("_since")))
    changed = later.groupBy(key).agg(
        *(F.max_by(F.when(F.col(op) != "D", F.col(f)), F.when((F.col(op) != "D") & F.col(f).isNotNull(), at)).alias(f"_{f}") for f in fields),
        F.max(F.when(F.col(op) == "D", 1).otherwise(0)).alias("_gone"), F.max(F.when(F.col(op) == "I", 1).otherwise(0)).alias("_new"), F.max(order[0]).alias("last_changed_at"), F.count(F.lit(1)).alias("n_events"),
    )
    joined = base.select(key, *fields).withColumn("_old", F.lit(1)).join(changed, key, "full")
    keep = F.coalesce("_new", F.lit(0)) == 0
    values = [F.coalesce(F.col(f"_{f}"), F.when(keep, F.col(f))).alias(f) for f in fields]
    return joined.select(key, *values, (F.coalesce("_gone", F.lit(0)) == 1).alias("is_deleted"), "last_changed_at", F.coalesce("n_events", F.lit(0)).alias("n_events"))


def change_log(events: DataFrame, key: str, field: str, value: str, order: Sequence[str]) -> DataFrame:
    """(key, field, old_value, new_value, order...) where a field's value differs as text from the one before it."""
    w = Window.partitionBy(key, field).orderBy(*order)
    old = F.lag(F.col(value).cast("string")).over(w)
    rows = events.withColumn("old_value", old).withColumn("new_value", F.col(value).cast("string"))
    return rows.where(~F.col("old_value").eqNullSafe(F.col("new_value"))).select(key, field, "old_value", "new_value", *order)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str], guard: Sequence[str] | None = None) -> DataFrame:
    """The merged table with ``_change``: inserted, updated (a guarded column differs, null-safe) or untouched."""
    guard = list(guard or columns)
    t = target.select(*keys, *columns, F.lit(True).alias("_t"))
    s = source.select(*keys, *(F.col(c).alias(f"_s_{c}") for c in columns), F.lit(True).alias("_s"))
    joined = t.join(s, list(keys), "full")
    differs = F.lit(False)
    for c in guard:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    take = F.col("_t").isNull() | (F.col("_s").isNotNull() & differs)
    change = F.when(F.col("_t").isNull(), "inserted").when(F.col("_s").isNotNull() & differs, "updated").otherwise("untouched")
    return joined.select(*keys, *(F.when(take, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) for c in columns), change.alias("_change"))


def daily_snapshots(changes: DataFrame, key: str, fields: Sequence[str], at: str, seq: str, first: str, last: str, op: str = "op") -> DataFrame:
    """(day, key, fields): the register as it stood at the end of each day from first to last (dates as text).

    changes hold op (I, U, D), the fields (null where a change leaves one as it was), a time and a number that orders
    changes of one time. A field's value is the newest one given since the object was last inserted. A key is in a day's
    snapshot from its insert on, unless deleted. Changes are reduced to one state for each key and day of change before
    days are filled, so only the snapshots themselves are as many rows as keys times days.
    """
    order = Window.partitionBy(key).orderBy(at, seq)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    lives = F.count(F.when(F.col(op) == "I", 1)).over(upto)
    rows = changes.withColumn("_life", lives)
    inside = Window.partitionBy(key, "_life").orderBy(at, seq).rowsBetween(Window.unboundedPreceding, 0)
    states = rows.select(key, "_life", F.to_date(at).alias("_from"), F.struct(at, seq).alias("_at"), (F.col(op) == "D").alias("_gone"), *(F.last(f, True).over(inside).alias(f) for f in fields))
    by_day = states.groupBy(key, "_from").agg(F.max_by(F.struct("_life", "_gone", *fields), "_at").alias("s"))
    until = F.lead("_from").over(Window.partitionBy(key).orderBy("_from"))
    spans = by_day.withColumn("_to", F.coalesce(F.date_sub(until, 1), F.to_date(F.lit(last)))).where("not s._gone and s._life > 0")
    a, b = F.greatest("_from", F.to_date(F.lit(first))), F.least("_to", F.to_date(F.lit(last)))
    return spans.where(a <= b).select(F.explode(F.sequence(a, b)).alias("day"), key, *(F.col(f"s.{f}").alias(f) for f in fields))


def first_seen_candidates(sources: Mapping[str, tuple[DataFrame, str, str, str]], until: str | None = None) -> DataFrame:
    """(system, src_key, src_name, norm_key, lat, lon, first_seen): each name that a system uses for one of its objects,
    with the first date it was seen and its mean place.

    sources: per system (frame, key, name, date); a frame with lat and lon gives places. Rows without a name, or after the
    date ``until``, are left out. All systems' rows are one union, reduced by partial minima and sums where they are read,
    so every source is read once and a system's busiest name is a row per task.
    """
    parts = []
    for system, (df, key, name, date) in sources.items():
        place = [F.col(c).cast("double").alias(c) if c in df.columns else F.lit(None).cast("double").alias(c) for c in ("lat", "lon")]
        parts.append(df.select(F.lit(system).alias("system"), F.col(key).cast("string").alias("src_key"), F.col(name).cast("string").alias("src_name"), F.to_date(date).alias("_date"), *place))
    rows = reduce(DataFrame.unionByName, parts).where("src_name <> ''")
    if until is not None:
        rows = rows.where(F.col("_date") <= F.to_date(F.lit(until)))
    out = rows.groupBy("system", "src_key", "src_name").agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"), F.min("_date").alias("first_seen"))
    return out.withColumn("norm_key", match_key(F.col("src_name")))


def resolve(candidates: DataFrame, register: DataFrame, exact: str, key: str, asset: str) -> DataFrame:
    """Rules in order: exact location 1.0, one register row with the key 0.95, several 0.5 for review, none 0.0."""
    exact_hits = register.groupBy(F.col(exact).alias("_exact")).agg(F.min(asset).alias("_asset_exact"))
    by_key = register.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.min(asset).alias("_asset_key"))
    joined = candidates.join(exact_hits, F.col(exact) == F.col("_exact"), "left").join(by_key, key, "left")
    is_exact, one, many = F.col("_asset_exact").isNotNull(), F.col("_n") == 1, F.col("_n") > 1
    pick = lambda a, b, c, d: F.when(is_exact, a).when(one, b).when(many, c).otherwise(d)
    return joined.withColumns({
        asset: pick(F.col("_asset_exact"), F.col("_asset_key"), F.lit(None), F.lit(None)),
        "rule": pick(F.lit("EXACT_FUNC_LOC"), F.lit("NORMALISED_TAG"), F.lit("AMBIGUOUS"), F.lit("NOT_IN_REGISTER")),
        "score": pick(F.lit(1.0), F.lit(0.95), F.lit(0.5), F.lit(0.0)),
        "match_status": pick(F.lit("MATCHED"), F.lit("MATCHED"), F.lit("REVIEW"), F.lit("REVIEW")),
    }).drop("_exact", "_asset_exact", "_n", "_asset_key")


def gps_override(resolved: DataFrame, nearest: DataFrame, key: str, asset: str, may_override: Column) -> DataFrame:
    """A site within the band wins over no match, or over one that ``may_override``; a replaced match is also given as REJECTED."""
    joined = resolved.join(nearest.where("in_band").select(key, F.col(asset).alias("_gps")), key, "left")
    wins = F.col("_gps").isNotNull() & (F.col(asset).isNull() | (may_override & (F.col(asset) != F.col("_gps"))))
    won = joined.withColumns({asset: F.when(wins, F.col("_gps")).otherwise(F.col(asset)), "rule": F.when(wins, F.lit("GPS_SEGMENT")).otherwise(F.col("rule")), "score": F.when(wins, 0.9).otherwise(F.col("score")), "match_status": F.when(wins, "MATCHED").otherwise(F.col("match_status"))})
    lost = joined.where(wins & F.col(asset).isNotNull()).withColumn("match_status", F.lit("REJECTED"))
    return won.unionByName(lost).drop("_gps")


def xref(matched: DataFrame, asset: str, system: str, name: str) -> DataFrame:
    """Distinct matched names per asset with their counts."""
    pairs = matched.where("match_status = 'MATCHED'").select(asset, system, name).distinct()
    return pairs.groupBy(asset).agg(F.count(F.lit(1)).alias("n_names"), F.count_distinct(system).alias("n_systems"), F.array_join(F.sort_array(F.collect_set(name)), "|").alias("names"))
