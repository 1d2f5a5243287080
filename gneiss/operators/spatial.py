"""Nearest places on the sphere."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gneiss.functions.columns import EARTH_RADIUS_M, haversine_m
from gneiss.operators.joins import small
from gneiss.session import settle

#: So few sites are simply compared with every point.
CROSSED_SITES = 64
#: Sites in a cell of the ring on the average, and at most; a point near a fuller cell goes down the pyramid instead.
SITES_IN_CELL, FULL_CELL = 2, 64
#: Levels of the pyramid: cells of side 2, cut in four each way again and again, the last under a metre.
DEEPEST = 12
_CELL, _SIDE = ("_x", "_y", "_z"), 2.0


def _unit(lat: Column, lon: Column) -> list[Column]:
    """The place's point of the unit sphere."""
    a, o = F.radians(lat), F.radians(lon)
    return [F.cos(a) * F.cos(o), F.cos(a) * F.sin(o), F.sin(a)]


def _cells(df: DataFrame, lat: str, lon: str, side: float) -> DataFrame:
    """Adds the cube of the given side that holds a place."""
    return df.withColumns({c: F.floor(x / side).cast("long") for c, x in zip(_CELL, _unit(F.col(lat), F.col(lon)), strict=True)})


def _placed(df: DataFrame, key: str, names: tuple[str, str]) -> DataFrame:
    rows = df.select(key, F.col("lat").cast("double").alias(names[0]), F.col("lon").cast("double").alias(names[1]))
    return rows.where(F.col(names[0]).isNotNull() & F.col(names[1]).isNotNull())


def nearest(
    points: DataFrame, sites: DataFrame, point_key: str, site_key: str, band_m: float = 500.0, crossed_sites: int = CROSSED_SITES, first_side: float | None = None, full_cell: int = FULL_CELL,
) -> DataFrame:
    """(point_key, site_key, distance_m, in_band): each point's nearest site by great circle, ties to the smaller site_key.

    Both sides have lat and lon in degrees. The sphere lies in a grid of cubes, so nothing is special about the poles or
    180 degrees: whatever is nearer than a cube's side along the chord is in the point's cube or one of the 26 around it.
    A point whose nearest site there is within that side is done. The others, and those beside a cube full of sites, go
    down a pyramid of cubes (``_descend``), so no site is lost however far it is, and no point meets all sites of a
    cluster. Points at one place are searched once; sites at one place count once, as the smallest key. A few sites are
    broadcast to all points instead. Sites meet a point as an array in its row, of which only the least leaves it. Points
    and sites without a place take no part; without sites there are no rows.
    """
    s = _placed(sites, site_key, ("_slat", "_slon")).groupBy("_slat", "_slon").agg(F.min(site_key).alias(site_key))
    p = _placed(points, point_key, ("_lat", "_lon"))
    if s.limit(crossed_sites + 1).count() <= crossed_sites:
        all_sites = s.agg(F.collect_list(F.struct(site_key, "_slat", "_slon")).alias("_sites"))
        dealt = p.repartition(point_key)  # by key: a small file is one split, and the least of a key needs no other shuffle
        return _named(dealt.crossJoin(F.broadcast(all_sites)).withColumn("b", _best(F.col("_sites"), site_key)), point_key, site_key, band_m)
    s = settle(s)
    places = settle(p.select("_lat", "_lon").distinct().withColumn("_place", F.monotonically_increasing_id()))
    found = settle(places.join(_searched(places, s, site_key, first_side, full_cell), "_place").select("_lat", "_lon", "b"))
    return _named(p.join(small(found), ["_lat", "_lon"]), point_key, site_key, band_m)


def _best(sites: Column, site_key: str) -> Column:
    """The least (distance_m, site_key) of an array of sites from the row's place; nothing is made of the pairs but their least."""
    away = lambda x: F.struct(haversine_m(F.col("_lat"), F.col("_lon"), x["_slat"], x["_slon"]).alias("distance_m"), x[site_key].alias(site_key))
    return F.array_min(F.transform(sites, away))


def _searched(p: DataFrame, s: DataFrame, site_key: str, first_side: float | None, full_cell: int) -> DataFrame:
    """(_place, b (distance_m, site_key)) of settled places (_place, _lat, _lon)."""
    point_key = "_place"
    side = first_side or min(2.0, math.sqrt(4 * math.pi * SITES_IN_CELL / s.count()))
    steps = [F.lit(k).cast("long") for k in (-1, 0, 1)]
    cells = _cells(s, "_slat", "_slon", side)
    sizes = cells.groupBy(*_CELL).agg((F.count(F.lit(1)) > full_cell).alias("_full"))
    cells = cells.join(sizes, list(_CELL))
    around = F.array(*(F.struct(*((F.col(c) + k).alias(c) for c, k in zip(_CELL, (i, j, k), strict=True))) for i in steps for j in steps for k in steps))
    site = F.struct(site_key, "_slat", "_slon")
    few = cells.where(~F.col("_full")).select(F.explode(around).alias("_c"), site.alias("_site"), "_full")
    full = sizes.where("_full").select(F.explode(around).alias("_c"), F.lit(None).cast(few.schema["_site"].dataType).alias("_site"), "_full")
    met = few.unionByName(full).select("_c.*", "_site", "_full")
    rings = met.groupBy(*_CELL).agg(F.collect_list("_site").alias("_sites"), F.max("_full").alias("_full"))
    joined = _cells(p, "_lat", "_lon", side).join(rings, list(_CELL), "left")
    ring = settle(joined.select(point_key, "_lat", "_lon", F.coalesce("_full", F.lit(False)).alias("_full"), F.when(~F.col("_full"), _best(F.col("_sites"), site_key)).alias("b")))
    chord = 2 * F.sin(F.col("b.distance_m") / (2 * EARTH_RADIUS_M))
    certain = ~F.col("_full") & F.coalesce(chord <= side * (1 - 1e-9), F.lit(False))
    rest = ring.where(~certain).select(point_key, "_lat", "_lon")
    found = [ring.where(certain).select(point_key, "b")]
    if not rest.isEmpty():
        found.append(_descend(rest, s, point_key, site_key))
    return reduce(DataFrame.unionByName, found)


def _descend(points: DataFrame, sites: DataFrame, point_key: str, site_key: str) -> DataFrame:
    """(point_key, b (distance_m, site_key)) by a pyramid of cubes, from the largest down.

    A cube holds a count and one of its sites, whose distance bounds the nearest one's from above; a cube that is further
    away than the least such bound is left out. A point follows a bounded number of cubes at each level, however many
    sites they hold; a cube of one site is followed no further.
    """
    own = dict(zip(("_px", "_py", "_pz"), _unit(F.col("_lat"), F.col("_lon")), strict=True))
    frontier = points.withColumns(own).withColumns({**{c: F.lit(None).cast("long") for c in _CELL}, "_bound": F.lit(4.0)})
    ends: list[DataFrame] = []
    side = _SIDE
    for level in range(1, DEEPEST + 1):
        side /= 4
        placed = _cells(sites, "_slat", "_slon", side)
        place = F.struct(site_key, "_slat", "_slon")
        cubes = placed.groupBy(*_CELL).agg(F.count(F.lit(1)).alias("_n"), F.min(place).alias("_rep"))
        if level == 1:  # some two hundred cubes
            pairs = frontier.drop(*_CELL).crossJoin(F.broadcast(cubes))
        else:
            above = {f"{c}0": F.floor(F.col(c) / 4).cast("long") for c in _CELL}
            held = small(cubes.withColumns(above))
            pairs = frontier.withColumnsRenamed({c: f"{c}0" for c in _CELL}).join(held, [f"{c}0" for c in _CELL]).drop(*(f"{c}0" for c in _CELL))
        rep = _unit(F.col("_rep._slat"), F.col("_rep._slon"))
        upper = F.sqrt(sum((F.pow(F.col(a) - b, 2) for a, b in zip(own, rep, strict=True)), F.lit(0.0)))
        gaps = [F.greatest(F.col(c) * side - F.col(a), F.col(a) - (F.col(c) + 1) * side, F.lit(0.0)) for a, c in zip(own, _CELL, strict=True)]
        lower = F.sqrt(sum((g * g for g in gaps), F.lit(0.0)))
        least = F.least("_bound", F.min("_upper").over(Window.partitionBy(point_key)))
        pairs = pairs.withColumns({"_upper": upper, "_lower": lower}).withColumn("_bound", least)
        kept = settle(pairs.where(F.col("_lower") <= F.col("_bound") * (1 + 1e-9) + 1e-12).drop("_upper", "_lower"))
        last = F.lit(level == DEEPEST)
        ends.append(kept.where((F.col("_n") == 1) & ~last).select(point_key, "_lat", "_lon", "_rep.*"))
        if level == DEEPEST:
            ends.append(kept.select(point_key, "_lat", "_lon", *_CELL).join(placed, list(_CELL)).select(point_key, "_lat", "_lon", site_key, "_slat", "_slon"))
        frontier = kept.where("_n > 1").drop("_n", "_rep")
        if frontier.isEmpty():
            break
    pairs = reduce(DataFrame.unionByName, ends).withColumn("distance_m", haversine_m(F.col("_lat"), F.col("_lon"), F.col("_slat"), F.col("_slon")))
    return pairs.groupBy(point_key).agg(F.min(F.struct("distance_m", site_key)).alias("b"))


def _named(found: DataFrame, point_key: str, site_key: str, band_m: float) -> DataFrame:
    best = found.where("b IS NOT NULL").groupBy(point_key).agg(F.min("b").alias("b"))
    return best.select(point_key, F.col(f"b.{site_key}").alias(site_key), F.col("b.distance_m").alias("distance_m"), (F.col("b.distance_m") <= band_m).alias("in_band"))
