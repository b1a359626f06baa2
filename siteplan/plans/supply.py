"""Charging supply per area as of the end of each year, in one pass over the stations."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siteplan.operators.cells import distinct_points, nearest_since, weight_within_since

MEASURES = ["dcfc_ports", "dcfc_sites", "large_sites", "rival_ports", "own_ports", "own_sites", "new_large_sites_t"]
RADIUS_MI = 50.0


def _as_of(t: int) -> list[Column]:
    open_by = F.col("open_year_filled") <= t

    def total(cond: Column, what: Column | str = "dc_ports") -> Column:
        what = F.col(what) if isinstance(what, str) else what
        return F.coalesce(F.sum(F.when(cond, what)), F.lit(0)).cast("bigint")

    one = F.lit(1)
    return [F.lit(t).alias("year"), total(open_by).alias("dcfc_ports"), total(open_by, one).alias("dcfc_sites"),
            total(open_by & F.col("is_large"), one).alias("large_sites"),
            total(open_by & F.col("is_rival")).alias("rival_ports"),
            total(open_by & F.col("is_own")).alias("own_ports"),
            total(open_by & F.col("is_own"), one).alias("own_sites"),
            total((F.col("open_year_filled") == t) & F.col("is_large"), one).alias("new_large_sites_t")]


def supply_arrays(st: DataFrame, years: Sequence[int]) -> DataFrame:
    """(fips, supply): an array with one struct of measures per year.

    A single aggregation with map-side combine; the years are columns of it, so no running window
    and no spine join are needed.
    """
    return st.groupBy("fips").agg(F.array(*[F.struct(*_as_of(t)) for t in years]).alias("supply"))


def empty_supply(years: Sequence[int]) -> Column:
    return F.array(*[F.struct(F.lit(t).alias("year"), *[F.lit(0).cast("bigint").alias(m) for m in MEASURES])
                     for t in years])


def supply_by_year(areas: DataFrame, st: DataFrame, years: Sequence[int]) -> DataFrame:
    """(fips, year, measures) for every area and year, zeros where there is nothing."""
    return (areas.select("fips").join(supply_arrays(st, years), "fips", "left")
            .select("fips", F.inline(F.coalesce("supply", empty_supply(years)))))


def _fold(year: Column, first: int) -> Column:
    """Years before the panel count from its first year on."""
    return F.greatest(year, F.lit(first))


def spatial_arrays(areas: DataFrame, st: DataFrame, years: Sequence[int], radius_mi: float = RADIUS_MI) -> DataFrame:
    """(cent_lat, cent_lon, near): per year the miles to the nearest large site and ports in reach."""
    here = distinct_points(areas.select(F.col("cent_lat").alias("lat"), F.col("cent_lon").alias("lon")))
    first, last = min(years), max(years)
    st = st.filter(F.col("open_year_filled") <= last).withColumn("since", _fold(F.col("open_year_filled"), first))
    large = st.filter("is_large").select("lat", "lon", "since")
    weights = st.select("lat", "lon", "since", F.col("dc_ports").alias("weight"))
    with ThreadPool(2) as side_by_side:  # two independent chains of jobs
        first_job = side_by_side.apply_async(nearest_since, (here, large))
        second_job = side_by_side.apply_async(weight_within_since, (here, weights, radius_mi))
        miles, ports = first_job.get(), second_job.get()
    both = (miles.withColumn("weight", F.lit(None).cast("bigint"))
            .unionByName(ports.withColumn("miles", F.lit(None).cast("double"))))
    per_year = [F.struct(
        F.min(F.when(F.col("since") <= t, F.col("miles"))).alias("dist_large_dcfc_mi"),
        F.coalesce(F.sum(F.when(F.col("since") <= t, F.col("weight"))), F.lit(0)).cast("double").alias("ports_within_50mi"))
        for t in years]
    return (both.groupBy(F.col("lat").alias("cent_lat"), F.col("lon").alias("cent_lon"))
            .agg(F.array(*per_year).alias("near")))


def empty_near(years: Sequence[int]) -> Column:
    return F.array(*[F.struct(F.lit(None).cast("double").alias("dist_large_dcfc_mi"),
                              F.lit(0.0).alias("ports_within_50mi")) for _ in years])


def spatial_supply_by_year(areas: DataFrame, st: DataFrame, years: Sequence[int],
                           radius_mi: float = RADIUS_MI) -> DataFrame:
    """(fips, year, dist_large_dcfc_mi, ports_within_50mi)."""
    near = areas.join(spatial_arrays(areas, st, years, radius_mi), ["cent_lat", "cent_lon"], "left")
    return (near.select("fips", F.posexplode(F.coalesce("near", empty_near(years))).alias("i", "n"))
            .select("fips", F.element_at(F.array(*[F.lit(t) for t in years]), F.col("i") + 1).alias("year"), "n.*"))


def dense_years(df: DataFrame, years: Sequence[int]) -> DataFrame:
    """Every row once per year."""
    return df.withColumn("year", F.explode(F.array(*[F.lit(t) for t in years])))


def running_total(df: DataFrame, key: str, order: str, value: str, out: str) -> DataFrame:
    """Running sum within a key (few rows per key, such as years)."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.sum(value).over(w))


def running_min(df: DataFrame, key: str, order: str, value: str, out: str) -> DataFrame:
    """Running minimum within a key."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.min(value).over(w))


def in_force_arrays(incentives: DataFrame, years: Sequence[int]) -> DataFrame:
    """(state, in_force): per year the records enacted by then; undated records always count."""
    return incentives.groupBy("state").agg(F.array(*[
        F.count_if(F.col("enacted_year").isNull() | (F.col("enacted_year") <= t)) for t in years]).alias("in_force"))


def in_force_by_year(states: DataFrame, incentives: DataFrame, years: Sequence[int]) -> DataFrame:
    """(state, year, ev_incentives) for every state and year."""
    none = F.array(*[F.lit(0).cast("bigint") for _ in years])
    return (states.select("state").distinct().join(in_force_arrays(incentives, years), "state", "left")
            .select("state", F.posexplode(F.coalesce("in_force", none)).alias("i", "ev_incentives"))
            .select("state", F.element_at(F.array(*[F.lit(t) for t in years]), F.col("i") + 1).alias("year"),
                    "ev_incentives"))
