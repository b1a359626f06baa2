"""Model features derived from panel columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteplan.functions.arith import floor_at

# Model features in order, and the seven used for clustering.
FEATURES = [
    "log_pop", "pop_growth", "log_density", "bev_per_1k", "elec_price_c_kwh", "ev_incentives", "log_fwy_vmt",
    "has_freeway", "log_interstate_miles", "log_dcfc_ports", "log_large_sites", "log_ports_per_1k_bev",
    "rival_share", "log_dist_large_dcfc", "log_ports_50mi", "log_new_large_t", "state_new_large_per_1m",
]
CLUSTER_FEATURES = ["log_pop", "log_density", "log_fwy_vmt", "bev_per_1k", "log_ports_per_1k_bev",
                    "log_dist_large_dcfc", "pop_growth"]

LOG1P = {
    "log_fwy_vmt": "fwy_vmt", "log_interstate_miles": "interstate_miles", "log_dcfc_ports": "dcfc_ports",
    "log_large_sites": "large_sites", "log_ports_per_1k_bev": "ports_per_1k_bev",
    "log_dist_large_dcfc": "dist_large_dcfc_mi", "log_ports_50mi": "ports_within_50mi",
    "log_new_large_t": "new_large_sites_t",
}


def transform_columns() -> dict[str, Column]:
    return {"log_pop": F.ln("pop"), "log_density": F.ln(floor_at(F.col("pop_density"), 0.1)),
            "has_freeway": F.col("has_freeway").cast("double"),
            **{out: F.log1p(src) for out, src in LOG1P.items()}}


def model_features(panel: DataFrame) -> DataFrame:
    """Add the eleven transformed features."""
    return panel.withColumns(transform_columns())


def complete_cases(df: DataFrame, label: str, features: list[str] = FEATURES) -> DataFrame:
    return df.dropna(subset=[label, *features])
