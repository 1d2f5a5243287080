"""Aggregates: window statistics, roll-ups, metrics, drift and out-of-distribution measures."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gneiss.operators import ranks
from gneiss.session import settle


def slope_per_hour(seconds: Column, value: Column) -> Column:
    """Least-squares slope of value over seconds, per hour; null if all seconds are equal."""
    n, st, sv = F.count(value), F.sum(seconds), F.sum(value)
    denominator = n * F.sum(seconds * seconds) - st * st
    return F.when(denominator > 0, (n * F.sum(seconds * value) - st * sv) / denominator * 3600)


def window_stats(df: DataFrame, keys: Sequence[str], value: str, seconds: Column, event: str, counts: Mapping[str, Column] | None = None) -> DataFrame:
    """n, min, max, mean, population deviation, slope, first and last event, and conditional counts, per key."""
    v = F.col(value)
    extra = [F.sum(F.when(c, 1).otherwise(0)).cast("long").alias(name) for name, c in (counts or {}).items()]
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min(v).alias("min_value"), F.max(v).alias("max_value"), F.avg(v).alias("mean_value"), F.stddev_pop(v).alias("std_value"), slope_per_hour(seconds, v).alias("slope_per_h"), F.min(event).alias("first_event"), F.max(event).alias("last_event"), *extra
    )


def metric(df: DataFrame, dims: Sequence[str] = (), measures: Mapping[str, str] = {}, filters: Sequence[str] = (), limit: int | None = None) -> DataFrame:  # noqa: B006
    """Dimensions, named measure expressions, filters and a limit (with an order over the dimensions) as one query."""
    for f in filters:
        df = df.where(f)
    out = df.groupBy(*(F.expr(d) for d in dims)).agg(*(F.expr(e).alias(name) for name, e in measures.items()))
    return out.orderBy(*out.columns[: len(dims)]).limit(limit) if limit else out


def pivot_parameters(df: DataFrame, keys: Sequence[str], name: str, value: str, names: Sequence[str]) -> DataFrame:
    """One column per parameter name."""
    return df.groupBy(*keys).agg(*(F.max(F.when(F.col(name) == n, F.col(value))).alias(n) for n in names))


def psi(reference: DataFrame, current: DataFrame, value: str, bins: int = 10, floor: float = 1e-4) -> DataFrame:
    """One row: the population stability index over the reference's quantile bins, shares clipped from below, and status.

    The edges are ``bins - 1`` numbers, found by ranks and used as constants on both sides.
    """
    edges = F.lit([x for x in ranks.quantiles(reference, value, [i / bins for i in range(1, bins)]) if x is not None] or [0.0])
    numbered = lambda df: df.where(F.col(value).isNotNull()).select(F.size(F.filter(edges, lambda e: e < F.col(value))).alias("bin"))
    share = lambda df, name: df.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).select("bin", (F.col("n") / F.sum("n").over(Window.partitionBy())).alias(name))
    every = reference.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    both = every.join(share(numbered(reference), "r"), "bin", "left").join(share(numbered(current), "c"), "bin", "left")
    r, c = (F.greatest(F.coalesce(x, F.lit(0.0)), F.lit(floor)) for x in ("r", "c"))
    return both.agg(F.sum((c - r) * F.log(c / r)).alias("psi"))


def drift_status(value: Column, warn: float = 0.1, alert: float = 0.25) -> Column:
    return F.when(value >= alert, "ALERT").when(value >= warn, "WARN").otherwise("OK")


def ood_distance(df: DataFrame, key: str, vector: str, quantile: float = 0.995) -> DataFrame:
    """Mean squared z-score of each vector against per-component means and deviations, and whether it exceeds the quantile.

    The components' statistics are one row with an array as long as a vector; each vector meets it in place, unshuffled.
    """
    parts = df.select(F.posexplode(vector).alias("i", "x")).withColumn("x", F.col("x").cast("double"))
    by = parts.groupBy("i").agg(F.avg("x").alias("m"), F.greatest(F.stddev_pop("x"), F.lit(1e-6)).alias("s"))
    stats = by.agg(F.sort_array(F.collect_list(F.struct("i", "m", "s"))).alias("_stats"))  # a place for each component
    square = F.zip_with(vector, "_stats", lambda x, s: F.pow((x.cast("double") - s["m"]) / s["s"], 2))
    z = df.crossJoin(F.broadcast(stats)).select(key, (F.aggregate(square, F.lit(0.0), lambda a, x: a + x) / F.size(vector)).alias("distance"))
    z = settle(z)  # read twice, and two numbers a row
    limit = ranks.quantiles(z, "distance", [quantile])[0]
    return z.select(key, "distance", (F.col("distance") > F.lit(limit)).alias("is_ood"))


def auroc(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row: area under the curve from mid-ranks, by running sums over the counts of distinct scores."""
    by = df.groupBy(F.col(score).alias("_s")).agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col(label).cast("long")).alias("_pos"))
    placed = ranks.running_sum(by, [F.col("_s")], F.col("_n") - F.col("_pos"), "_below")
    won = placed.select("_n", "_pos", (F.col("_pos") * (F.col("_below") + (F.col("_n") - F.col("_pos")) / 2)).alias("_won"))
    return won.agg((F.sum("_won") / (F.sum("_pos") * F.sum(F.col("_n") - F.col("_pos")))).alias("auroc"))


def classification_metrics(df: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    """One row: confusion counts, sensitivity, specificity and Brier score at a threshold."""
    y, hit = F.col(label) == 1, F.col(score) >= threshold
    c = lambda cond, name: F.sum(F.when(cond, 1).otherwise(0)).cast("long").alias(name)
    counts = df.agg(c(y & hit, "tp"), c(y & ~hit, "fn"), c(~y & hit, "fp"), c(~y & ~hit, "tn"), F.avg(F.pow(F.col(score) - F.col(label), 2)).alias("brier"))
    return counts.withColumns({"sensitivity": F.col("tp") / (F.col("tp") + F.col("fn")), "specificity": F.col("tn") / (F.col("tn") + F.col("fp"))})


def threshold_for(df: DataFrame, label: str, score: str, sensitivity: float) -> DataFrame:
    """One row: the largest score that still finds the given share of the positives; null without any."""
    positives = df.where((F.col(label) == 1) & F.col(score).isNotNull()).select(score)
    n = positives.count()
    place = max(1, math.ceil(round(sensitivity * n, 9)))
    found = ranks.at_ranks(positives, score, [place], descending=True) if n else {}
    return df.sparkSession.createDataFrame([(found.get(place),)], "threshold double")
