"""Certified views: risk worklist with exposure, time to review, coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.operators import ranks


def exposure(risk: DataFrame, weights: DataFrame, score: str = "rule_score", criticality: str = "criticality") -> DataFrame:
    """score / 100 x the criticality's weight (1.0 if none); an abstained asset counts 0. Parameters are named criticality_weight.<class>."""
    w = weights.select(F.col("parameter").alias("_p"), F.col("value").alias("weight"))
    out = risk.join(w, F.concat(F.lit("criticality_weight."), F.col(criticality)) == F.col("_p"), "left").drop("_p")
    out = out.withColumn("weight", F.coalesce("weight", F.lit(1.0)))
    return out.withColumn("exposure", F.when(F.coalesce("is_abstained", F.lit(False)), 0.0).otherwise(F.col(score) / 100 * F.col("weight")))


def time_to_review(findings: DataFrame, partition: str, score: str, at: str, key: str, hours_each: float, keep: str) -> DataFrame:
    """Hours until each finding is reviewed in risk order and in calendar order; the rows of interest are kept after ranking."""
    orders = {"risk": [F.desc(score), F.col(at), F.col(key)], "calendar": [F.col(at), F.col(key)]}
    both = [ranks.ranked_in(findings, partition, order, "position").withColumn("ordering", F.lit(name)) for name, order in orders.items()]
    return both[0].unionByName(both[1]).withColumn("review_h", F.col("position") * hours_each).where(keep)


def coverage(df: DataFrame, dims: list[str], received: str, covered: str) -> DataFrame:
    """Share of received objects that are covered, by dimension."""
    n = lambda e: F.sum(F.when(F.expr(e), 1).otherwise(0))
    out = df.groupBy(*dims).agg(n(received).cast("long").alias("received"), n(f"({received}) and ({covered})").cast("long").alias("covered"))
    return out.withColumn("coverage", F.when(F.col("received") > 0, F.col("covered").cast("double") / F.col("received")))


def with_is_latest(df: DataFrame, date: str) -> DataFrame:
    """Adds is_latest against the one-row maximum of the date."""
    newest = df.agg(F.max(date).alias("_max"))
    return df.crossJoin(F.broadcast(newest)).withColumn("is_latest", F.col(date) == F.col("_max")).drop("_max")


def date_dim(dates: DataFrame, column: str) -> DataFrame:
    """The calendar from the first to the last date: keys, ISO week, day of week (1 Sunday)."""
    span = dates.agg(F.min(column).cast("date").alias("a"), F.max(column).cast("date").alias("b"))
    d = span.where("a is not null").select(F.explode(F.sequence("a", "b")).alias("day"))
    return d.select(
        "day", F.date_format("day", "yyyyMMdd").cast("int").alias("date_key"), F.year("day").alias("year"), F.month("day").alias("month"),
        F.weekofyear("day").alias("iso_week"), F.dayofweek("day").alias("day_of_week"),
    )


def dated_parameters(spark, date: str, definitions: dict) -> DataFrame:
    """(date, parameter, value as text): nested names joined by dots, lists as JSON."""
    import json

    def flat(prefix: str, value) -> list[tuple[str, str]]:
        if isinstance(value, dict):
            return [p for k, v in value.items() for p in flat(f"{prefix}.{k}" if prefix else k, v)]
        return [(prefix, json.dumps(value) if isinstance(value, list) else str(value))]

    return spark.createDataFrame([(date, k, v) for k, v in flat("", definitions)], "date string, parameter string, value string")
