"""Nearest target and radius sums between two point sets, exact at any density.

Both point sets are reduced to distinct coordinates and arranged in nested grid cells (8 degrees,
each level a quarter of the side before). Pairs of (source cell, target cell) are refined level by
level; the distance of two cells lies within centre distance -/+ both radii, so most pairs are
settled without looking at points. Only pairs whose target cell holds few points, or which cannot
be refined further, are compared point by point. A city with a third of all points is just a place
where the refinement goes deeper.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siteplan.functions.geo import haversine_miles
from siteplan.session import stage

TOP_DEG = 8.0  # a power of two, so that cells of all levels nest exactly
FAN_BITS = 2
DEPTH = 12
LEAF_POINTS = 64
SLACK_MI = 1e-6

ROWS, COLS = int(180 / TOP_DEG) + 1, int(360 / TOP_DEG)


# (level, kept pairs, point pairs per state)
Level = tuple[int, DataFrame, dict[str, int]]

# Few cell pairs can stand for many point pairs: one task gets about this many of the latter.
POINT_PAIRS_PER_TASK = 1_000_000


def _side(level: int) -> float:
    return TOP_DEG / (1 << (FAN_BITS * level))


# A cell number holds the row in its upper and the column in its lower 32 bits. The expressions
# are SQL text: one call each instead of one per operator.


def _cell(level: int) -> Column:
    """Cell of (lat, lon)."""
    c = _side(level)
    return F.expr(f"shiftleft(floor((lat + 90d) / {c}d), 32) + floor(pmod(lon + 180d, 360d) / {c}d)")


def _parent(cell: str) -> Column:
    return F.expr(f"shiftleft(shiftright(shiftright({cell}, 32), {FAN_BITS}), 32) + shiftright({cell} & 4294967295, {FAN_BITS})")


def _centre(cell: str, level: int) -> tuple[str, str]:
    c = _side(level)
    return f"((shiftright({cell}, 32) + 0.5d) * {c}d - 90d)", f"((({cell}) & 4294967295) + 0.5d) * {c}d - 180d"


def _nodes(points: DataFrame, level: int, p: str, *extra: Column) -> DataFrame:
    """One row per occupied cell: (p, p_rad, p_pts, p_up, extras)."""
    lat0, lon0 = _centre(p, level)
    return (points.withColumn(p, _cell(level)).groupBy(p)
            .agg(F.max(haversine_miles(lat0, f"({lon0})", "lat", "lon")).alias(f"{p}_rad"),
                 F.count("*").alias(f"{p}_pts"), *extra)
            .withColumn(f"{p}_up", _parent(p)))


def _top_cells() -> Column:
    """Every cell of the coarsest grid (1,035 of them, fixed by the size of the globe)."""
    return F.expr(f"flatten(transform(sequence(0, {ROWS - 1}), r -> transform(sequence(0, {COLS - 1}), "
                  "c -> shiftleft(cast(r as bigint), 32) + c)))")


def _refine(src: DataFrame, tgt: DataFrame, judge: Callable[[DataFrame], DataFrame],
            *target_aggs: Column) -> list[Level]:
    """Refine cell pairs until none is open.

    ``judge`` receives pairs with ``near`` and ``far`` (bounds on every point distance) and a
    ``cap`` inherited from the parent pair; it returns the pairs to keep with ``state`` =
    'inside' (settled as a whole), 'points' (compare points) or 'open' (refine).
    Returns per level the kept pairs and the number of point pairs behind each state.
    """
    out: list[Level] = []
    still_open = None
    for level in range(DEPTH + 1):
        s_nodes, t_nodes = _nodes(src, level, "s"), _nodes(tgt, level, "t", *target_aggs)
        if still_open is None:
            pairs = (s_nodes.withColumns({"cap": F.lit(float("inf")), "t": F.explode(_top_cells())})
                     .join(t_nodes, "t"))
        else:
            pairs = (still_open.select(F.col("s").alias("s_up"), F.col("t").alias("t_up"), "cap")
                     .join(s_nodes, "s_up").join(t_nodes, "t_up"))
        (s_lat, s_lon), (t_lat, t_lon) = _centre("s", level), _centre("t", level)
        judged = judge(pairs.withColumn("apart", haversine_miles(s_lat, f"({s_lon})", t_lat, f"({t_lon})")).withColumns({
            "near": F.expr(f"apart - s_rad - t_rad - {SLACK_MI}d"), "far": F.expr(f"apart + s_rad + t_rad + {SLACK_MI}d"),
            "small": F.lit(True) if level == DEPTH else F.expr(f"t_pts <= {LEAF_POINTS}")}))
        kept = stage(judged.withColumn("work", F.col("s_pts") * F.col("t_pts")).select("s", "t", "cap", "state", "work"),
                     "cellpairs")
        work = {r["state"]: r["work"] for r in kept.groupBy("state").agg(F.sum("work").alias("work")).collect()}
        out.append((level, kept, work))
        if "open" not in work:
            return out
        still_open = kept.filter(F.col("state") == "open")
    return out


def _point_pairs(src: DataFrame, tgt: DataFrame,
                 levels: list[Level], *target_cols: str) -> DataFrame:
    """(lat, lon, target columns, miles) for the pairs that need a look at points."""
    parts = []
    wanted = [lv for lv in levels if "points" in lv[2]] or levels[:1]
    for level, kept, work in wanted:
        tasks = math.ceil(work.get("points", 1) / POINT_PAIRS_PER_TASK)
        s = src.withColumn("s", _cell(level))
        t = tgt.select(F.col("lat").alias("t_lat"), F.col("lon").alias("t_lon"), *target_cols, _cell(level).alias("t"))
        parts.append(kept.filter("state = 'points'").select("s", "t").join(t, "t").repartition(tasks).join(s, "s")
                     .select("lat", "lon", *target_cols, haversine_miles("lat", "lon", "t_lat", "t_lon").alias("miles")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def distinct_points(df: DataFrame) -> DataFrame:
    """Written table of distinct coordinates; such a table passes through unchanged."""
    if getattr(df, "_distinct_points", False):
        return df
    out = stage(df.select("lat", "lon").dropna().distinct(), "src")
    out._distinct_points = True
    return out


def nearest_since(sources: DataFrame, targets: DataFrame) -> DataFrame:
    """Nearest targets over time: (lat, lon, since, miles), one row per useful start year.

    ``sources`` has lat, lon; ``targets`` has lat, lon, since (the year a target starts to count).
    The nearest target as of year t is the least ``miles`` among rows with since <= t.
    """
    src = distinct_points(sources)
    tgt = stage(targets.dropna(subset=["lat", "lon"]).groupBy("lat", "lon")
                .agg(F.min("since").alias("since")), "tgt")
    # A pair can win only in years its target cell has a target; the best upper bound among cells
    # that started no later already holds in all those years.
    earlier = (Window.partitionBy("s").orderBy("t_since")
               .rangeBetween(Window.unboundedPreceding, Window.currentRow))

    def judge(pairs: DataFrame) -> DataFrame:
        return (pairs.withColumn("cap", F.least("cap", F.min("far").over(earlier)))
                .filter(F.col("near") <= F.col("cap"))
                .withColumn("state", F.when(F.col("small"), "points").otherwise("open")))

    levels = _refine(src, tgt, judge, F.min("since").alias("t_since"))
    return (_point_pairs(src, tgt, levels, "since").groupBy("lat", "lon", "since")
            .agg(F.min("miles").alias("miles")))


def weight_within_since(sources: DataFrame, targets: DataFrame, radius_mi: float) -> DataFrame:
    """Target weight within a radius, by start year: (lat, lon, since, weight).

    ``targets`` has lat, lon, since, weight. The distance limit is inclusive. The total as of
    year t is the sum over rows with since <= t.
    """
    src = distinct_points(sources)
    per_year = stage(targets.dropna(subset=["lat", "lon"]).groupBy("lat", "lon", "since")
                     .agg(F.sum("weight").alias("weight")), "tgt")

    def judge(pairs: DataFrame) -> DataFrame:
        return (pairs.filter(F.col("near") <= radius_mi)
                .withColumn("state", F.when(F.col("far") <= radius_mi, "inside")
                            .when(F.col("small"), "points").otherwise("open")))

    levels = _refine(src, per_year, judge)
    parts = [_point_pairs(src, per_year, levels, "since", "weight")
             .filter(F.col("miles") <= radius_mi).select("lat", "lon", "since", "weight")]
    for level, kept, work in levels:
        if "inside" not in work:
            continue
        t = (per_year.groupBy(_cell(level).alias("t"), "since")
             .agg(F.sum("weight").alias("weight")))
        whole = (kept.filter(F.col("state") == "inside").select("s", "t").join(t, "t")
                 .groupBy("s", "since").agg(F.sum("weight").alias("weight")))
        parts.append(src.withColumn("s", _cell(level)).join(whole, "s")
                     .select("lat", "lon", "since", "weight"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("lat", "lon", "since").agg(F.sum("weight").alias("weight"))


def nearest_miles(sources: DataFrame, key: str, targets: DataFrame) -> DataFrame:
    """(key, miles) to the nearest target, null when there is none. Both sides have lat, lon."""
    near = (nearest_since(sources, targets.select("lat", "lon", F.lit(0).alias("since")))
            .select("lat", "lon", "miles"))
    return sources.join(near, ["lat", "lon"], "left").select(key, "miles")


def weight_within(sources: DataFrame, key: str, targets: DataFrame, radius_mi: float) -> DataFrame:
    """(key, weight): total target weight within the radius, 0 when there is none."""
    near = (weight_within_since(sources, targets.select("lat", "lon", "weight", F.lit(0).alias("since")),
                                radius_mi).select("lat", "lon", "weight"))
    return (sources.join(near, ["lat", "lon"], "left")
            .select(key, F.coalesce(F.col("weight").cast("double"), F.lit(0.0)).alias("weight")))
