"""One function per source: raw rows to a tidy table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteplan.functions.text import contains_ci, in_list, lenient_date, not_in_list, padded_code
from siteplan.operators.quality import require_columns
from siteplan.sources.tables import apply_crosswalk

LARGE_SITE_PORTS = 4  # fixed value

# State names and postal codes.
STATE_CODES = {
    "Alabama": "AL", "Alaska": "AK", "Arizona": "AZ", "Arkansas": "AR", "California": "CA", "Colorado": "CO",
    "Connecticut": "CT", "Delaware": "DE", "District of Columbia": "DC", "Florida": "FL", "Georgia": "GA",
    "Hawaii": "HI", "Idaho": "ID", "Illinois": "IL", "Indiana": "IN", "Iowa": "IA", "Kansas": "KS",
    "Kentucky": "KY", "Louisiana": "LA", "Maine": "ME", "Maryland": "MD", "Massachusetts": "MA",
    "Michigan": "MI", "Minnesota": "MN", "Mississippi": "MS", "Missouri": "MO", "Montana": "MT",
    "Nebraska": "NE", "Nevada": "NV", "New Hampshire": "NH", "New Jersey": "NJ", "New Mexico": "NM",
    "New York": "NY", "North Carolina": "NC", "North Dakota": "ND", "Ohio": "OH", "Oklahoma": "OK",
    "Oregon": "OR", "Pennsylvania": "PA", "Rhode Island": "RI", "South Carolina": "SC", "South Dakota": "SD",
    "Tennessee": "TN", "Texas": "TX", "Utah": "UT", "Vermont": "VT", "Virginia": "VA", "Washington": "WA",
    "West Virginia": "WV", "Wisconsin": "WI", "Wyoming": "WY",
}


def state_table(spark: SparkSession, codes: Mapping[str, object] = STATE_CODES) -> DataFrame:
    """(state_name, state): the fixed list of states."""
    return spark.createDataFrame(list(codes.items()), ["state_name", "state"])


def stations(raw: DataFrame, large_ports: int = LARGE_SITE_PORTS, own: str = "OWN", rival: str = "RIVAL") -> DataFrame:
    """Fast-charging stations with typed columns and flags.

    Raw columns: id, name, state, latitude, longitude, fast_ports, network, status, open_date,
    pricing, funding. Rows without a positive port count are left out; an unreadable date is null.
    """
    require_columns(raw, ["id", "name", "state", "latitude", "longitude", "fast_ports", "network", "status",
                          "open_date", "pricing", "funding"], "stations")
    network = F.coalesce("network", F.lit("Unknown"))
    opened = lenient_date(F.col("open_date"))
    ports = F.col("fast_ports").cast("int")
    return raw.filter(F.coalesce("fast_ports", F.lit(0)) > 0).select(
        F.col("id").cast("bigint").alias("station_id"), "name", "state",
        F.col("latitude").cast("double").alias("lat"), F.col("longitude").cast("double").alias("lon"),
        ports.alias("dc_ports"), network.alias("network"), "status", opened.alias("open_date"),
        "pricing", "funding", F.year(opened).alias("open_year"),
        (F.upper(network) == own.upper()).alias("is_own"), contains_ci(network, rival).alias("is_rival"),
        (ports >= large_ports).alias("is_large"), contains_ci(F.col("name"), "NOT A PUBLIC").alias("non_public_flag"))


MISSING_OPEN_YEAR = 2010  # fixed value: before the panel starts


def working_stations(st: DataFrame, statuses: Sequence[str] = ("E", "T"),
                     missing_year: int = MISSING_OPEN_YEAR) -> DataFrame:
    """Open or temporarily closed public stations; a missing open year is filled and flagged."""
    return (st.filter(in_list(F.col("status"), list(statuses)) & ~F.col("non_public_flag"))
            .withColumns({"open_year_filled": F.coalesce("open_year", F.lit(missing_year)).cast("int"),
                          "open_year_imputed": F.col("open_year").isNull()}))


TRAFFIC_COLUMNS = ["fwy_vmt", "fwy_miles", "interstate_miles"]


def traffic(raw: DataFrame, override: DataFrame, mapping: DataFrame, override_prefix: str = "09",
            width: int = 5) -> DataFrame:
    """(fips, fwy_vmt, fwy_miles, interstate_miles, traffic_imputed, has_freeway).

    ``raw`` adds ``match_status``: areas marked "No qualifying" are true zeros, not missing.
    ``override`` (fips, final_vmt, final_miles) replaces the rows of one state, flagged; a missing
    value there stays missing. Parts of a split area become flagged zeros; dropped codes leave.
    """
    require_columns(raw, ["fips", "match_status", *TRAFFIC_COLUMNS], "traffic")
    require_columns(override, ["fips", "final_vmt", "final_miles"], "traffic override")
    raw, override = (d.withColumn("fips", padded_code(F.col("fips"), width)) for d in (raw, override))
    none = F.startswith(F.coalesce("match_status", F.lit("")), F.lit("No qualifying"))
    base = raw.select("fips", *[F.when(none, 0.0).otherwise(F.col(c).cast("double")).alias(c) for c in TRAFFIC_COLUMNS])
    over = (override.filter(F.col("fips").startswith(override_prefix))
            .select("fips", F.col("final_vmt").cast("double").alias("o_vmt"),
                    F.col("final_miles").cast("double").alias("o_miles"), F.lit(True).alias("hit")))
    hit = F.coalesce("hit", F.lit(False))
    rows = base.join(over, "fips", "left").select(
        "fips", F.when(hit, F.col("o_vmt")).otherwise(F.col("fwy_vmt")).alias("fwy_vmt"),
        F.when(hit, F.col("o_miles")).otherwise(F.col("fwy_miles")).alias("fwy_miles"),
        F.when(hit, F.col("o_miles")).otherwise(F.col("interstate_miles")).alias("interstate_miles"),
        hit.alias("traffic_imputed"))
    # Renames follow the crosswalk; a split area has no measured traffic of its own.
    split = mapping.groupBy("old").agg(F.count("new").alias("parts")).filter(F.col("parts") > 1)
    parts = mapping.join(split, "old", "left_semi").select(
        F.col("new").alias("fips"), *[F.lit(0.0).alias(c) for c in TRAFFIC_COLUMNS], F.lit(True).alias("traffic_imputed"))
    moved = apply_crosswalk(rows.join(split.withColumnRenamed("old", "fips"), "fips", "left_anti"), mapping, "fips")
    return moved.unionByName(parts).withColumn("has_freeway", F.coalesce(F.col("fwy_miles") > 0, F.lit(False)))


def state_values(raw: DataFrame, states: DataFrame, name: str, values: Mapping[str, str]) -> DataFrame:
    """(state, values): rows of a per-state file, non-state rows such as national totals left out."""
    named = raw.select(F.col(name).alias("state_name"), *[F.col(src).cast("double").alias(out) for out, src in values.items()])
    return named.join(states, "state_name").select("state", *values)


def registrations(raw: DataFrame, states: DataFrame) -> DataFrame:
    require_columns(raw, ["State", "Electric (EV)", "Plug-In Hybrid Electric (PHEV)"], "registrations")
    return state_values(raw, states, "State", {
        "bev_regs": "`Electric (EV)`", "phev_regs": "`Plug-In Hybrid Electric (PHEV)`"})


def electricity(raw: DataFrame, states: DataFrame) -> DataFrame:
    require_columns(raw, ["Name", "Average retail price (cents/kWh)"], "electricity")
    return state_values(raw, states, "Name", {"elec_price_c_kwh": "`Average retail price (cents/kWh)`"})


def incentives(raw: DataFrame, tag: str = "ELEC", types: Sequence[str] = ("State Incentives", "Incentives"),
               federal: str = "US", closed: Sequence[str] = ("archived", "expired")) -> DataFrame:
    """(state, enacted_year) of state incentive records in force; an unreadable date gives null.

    Raw columns: state, type, technology, enacted, status. Null status and null state are kept.
    """
    require_columns(raw, ["state", "type", "technology", "enacted", "status"], "incentives")
    return (raw.filter(F.coalesce(F.contains("technology", F.lit(tag)), F.lit(False))
                       & in_list(F.col("type"), list(types))
                       & not_in_list(F.col("state"), [federal]) & not_in_list(F.col("status"), list(closed)))
            .select("state", F.year(lenient_date(F.col("enacted"))).alias("enacted_year")))
