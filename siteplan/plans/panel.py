"""Entity x year panel: features known at the end of year t, labels observed in t + 1."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siteplan.functions.arith import floor_at, guarded_ratio
from siteplan.plans import supply as sup
from siteplan.session import bucketed

# Columns of the panel.
PANEL_COLUMNS = [
    "fips", "county_key", "county_name", "state", "cent_lat", "cent_lon", "area_sqmi", "year", "dcfc_ports",
    "dcfc_sites", "large_sites", "rival_ports", "own_ports", "own_sites", "new_large_sites_t", "dist_large_dcfc_mi",
    "ports_within_50mi", "pop", "pop_growth", "fwy_vmt", "fwy_miles", "interstate_miles", "traffic_imputed",
    "has_freeway", "bev_per_1k", "elec_price_c_kwh", "ev_incentives", "bev_est", "pop_density", "ports_per_1k_bev",
    "rival_share", "state_new_large_per_1m", "new_large_next", "y_new_site", "y_first_site",
]


@dataclass(frozen=True)
class Inputs:
    """Tidy tables: areas (fips, county_key, county_name, state, cent_lat, cent_lon, area_sqmi),
    stations (working set with fips), population (fips, year, pop), traffic, registrations,
    electricity, incentives."""

    areas: DataFrame
    stations: DataFrame
    population: DataFrame
    traffic: DataFrame
    registrations: DataFrame
    electricity: DataFrame
    incentives: DataFrame


def co_located(src: Inputs, buckets: int) -> Inputs:
    """The same tables, those with an entity written in ``buckets`` buckets of it.

    Worth it where several panels, windows or labels are built from them: the joins, aggregations and windows by entity
    then plan no shuffle. Tables by state stay as they are.
    """
    return replace(src, **{name: bucketed(getattr(src, name), ["fips"], buckets, name)
                           for name in ("areas", "stations", "population", "traffic")})


def state_rates(population: DataFrame, areas: DataFrame, registrations: DataFrame, rate_year: int) -> DataFrame:
    """(state, state_pop, bev_per_1k): registrations per 1,000 residents of one fixed year."""
    pop = (population.filter(F.col("year") == rate_year).join(areas.select("fips", "state"), "fips")
           .groupBy("state").agg(F.sum("pop").alias("state_pop")))
    return registrations.join(pop, "state", "left").select(
        "state", "state_pop", (F.col("bev_regs") / F.col("state_pop") * 1000).alias("bev_per_1k"))


def growth(population: DataFrame) -> DataFrame:
    """One-year growth within an entity, null in its first year."""
    w = Window.partitionBy("fips").orderBy("year")
    return population.withColumn("pop_growth", F.col("pop") / F.lag("pop").over(w) - 1)


def pop_arrays(population: DataFrame, years: Sequence[int]) -> DataFrame:
    """(fips, pops): population per panel year as an array; the snapshot year repeats the last."""
    values = [F.max(F.when(F.col("year") == t, F.col("pop"))) for t in years]
    return population.groupBy("fips").agg(F.array(*values, values[-1]).alias("pops"))


def demand_columns() -> dict[str, Column]:
    """Estimated demand from a state rate, density, supply per 1,000 demand, one network's share."""
    bev = F.col("bev_per_1k") * F.col("pop") / 1000
    return {"bev_est": bev, "pop_density": F.col("pop") / F.col("area_sqmi"),
            "ports_per_1k_bev": F.col("dcfc_ports") / floor_at(bev, 1.0) * 1000,
            "rival_share": guarded_ratio(F.col("rival_ports").cast("double"), F.col("dcfc_ports"))}


def state_year_rate(panel: DataFrame) -> DataFrame:
    """Add new large sites per million residents of the state and year.

    An aggregate joined back: a window by state would put a hot state into one task.
    """
    rate = panel.groupBy("state", "year").agg(
        (F.sum("new_large_sites_t") / F.sum("pop") * 1e6).alias("state_new_large_per_1m"))
    return panel.join(rate, ["state", "year"], "left")


def label_columns(after: Column, last_label_year: int) -> dict[str, Column]:
    """Labels from the count of the next year; null where that year is not fully observed."""
    seen = F.when(F.col("year") <= last_label_year, after)
    y = F.when(seen.isNotNull(), F.when(seen > 0, 1.0).otherwise(0.0))
    return {"new_large_next": seen, "y_new_site": y, "y_first_site": F.when(F.col("large_sites") == 0, y)}


def next_year_labels(panel: DataFrame, last_label_year: int) -> DataFrame:
    """Add labels to any (fips, year) panel; a gap in the years gives null, not the next row."""
    w = Window.partitionBy("fips").orderBy("year")
    after = F.when(F.lead("year").over(w) == F.col("year") + 1, F.lead("new_large_sites_t").over(w))
    marked = panel.withColumn("_after", after)
    return marked.withColumns(label_columns(F.col("_after"), last_label_year)).drop("_after")


def build_panel(src: Inputs, years: Sequence[int], snapshot: int) -> DataFrame:
    """The whole panel, snapshot year included.

    Sources meet once per entity with their years as arrays, so the large joins move one row per
    entity, and rows are multiplied by year only at the end. Labels and growth read the
    neighbouring array element.
    """
    spine = [*years, snapshot]
    rates = state_rates(src.population, src.areas, src.registrations, years[-1]).select("state", "bev_per_1k")
    none = F.array(*[F.lit(0).cast("bigint") for _ in spine])
    wide = (src.areas.join(sup.supply_arrays(src.stations, spine), "fips", "left")
            .join(pop_arrays(src.population, years), "fips", "left")
            .join(src.traffic, "fips", "left")
            .join(sup.spatial_arrays(src.areas, src.stations, spine), ["cent_lat", "cent_lon"], "left")
            .join(rates, "state", "left").join(src.electricity, "state", "left")
            .join(sup.in_force_arrays(src.incentives, spine), "state", "left")
            .withColumns({"supply": F.coalesce("supply", sup.empty_supply(spine)),
                          "near": F.coalesce("near", sup.empty_near(spine)),
                          "in_force": F.coalesce("in_force", none)}))
    i = F.col("i")
    # The snapshot year carries the growth of the last full year.
    g = F.least(i, F.lit(len(years) - 1))
    rows = (wide.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(len(spine) - 1))))
            .select(*src.areas.columns, F.col("supply")[i].alias("s"), F.col("near")[i].alias("n"),
                    F.get("supply", i + 1)["new_large_sites_t"].alias("_after"),
                    F.col("pops")[i].alias("pop"),
                    F.when(g > 0, F.get("pops", g) / F.get("pops", g - 1) - 1).alias("pop_growth"),
                    *[c for c in src.traffic.columns if c != "fips"], "bev_per_1k", "elec_price_c_kwh",
                    F.col("in_force")[i].alias("ev_incentives"))
            .select("*", "s.*", "n.*").drop("s", "n"))
    rows = state_year_rate(rows.withColumns(demand_columns()))
    return rows.withColumns(label_columns(F.col("_after"), years[-1] - 1)).select(*PANEL_COLUMNS)


def split_snapshot(panel: DataFrame, snapshot: int) -> tuple[DataFrame, DataFrame]:
    """(panel before the snapshot year, snapshot rows)."""
    return panel.filter(F.col("year") < snapshot), panel.filter(F.col("year") == snapshot)
