"""Posted prices: state medians with a national fallback for thin states."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteplan.functions.text import price_per_kwh
from siteplan.operators.ordering import medians
from siteplan.session import stage

MIN_OBSERVATIONS = 10  # fixed value


def priced(stations: DataFrame, text: str = "pricing") -> DataFrame:
    """Add price_kwh parsed from free text."""
    return stations.withColumn("price_kwh", price_per_kwh(F.col(text)))


def price_counts(stations: DataFrame) -> DataFrame:
    """(state, price_kwh, n), written once: the texts are parsed a single time for all medians."""
    return stage(stations.groupBy("state", "price_kwh").agg(F.count("*").alias("n")), "prices")


def state_prices(counts: DataFrame) -> DataFrame:
    """(state, dcfc_price_kwh, price_obs): exact median and count of parsed prices."""
    m = medians(counts, {"dcfc_price_kwh": F.col("price_kwh")}, ["state"], "n")
    return m.select("state", "dcfc_price_kwh", F.col("dcfc_price_kwh_n").alias("price_obs"))


def national_price(counts: DataFrame) -> DataFrame:
    """One row (national, obs)."""
    m = medians(counts, {"national": F.col("price_kwh")}, (), "n")
    return m.select("national", F.col("national_n").alias("obs"))


def with_prices(areas: DataFrame, stations: DataFrame, least: int = MIN_OBSERVATIONS) -> DataFrame:
    """Add dcfc_price_kwh, price_obs, price_imputed to areas by state."""
    counts = price_counts(stations)
    joined = areas.join(state_prices(counts), "state", "left")
    thin = F.coalesce("price_obs", F.lit(0)) < least
    national = national_price(counts).select("national").scalar()
    return joined.withColumns({"dcfc_price_kwh": F.when(thin, national).otherwise(F.col("dcfc_price_kwh")),
                               "price_imputed": thin})
