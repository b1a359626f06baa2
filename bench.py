"""Time the headline jobs; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the cores.
Each job runs to completion through a no-op sink, so no result is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import REGISTRY  # noqa: E402
from checks.base import Tables  # noqa: E402
from siteplan.session import build_session  # noqa: E402

# In pipeline order: "panel" and "app_table" write the tables the later jobs read, as in the offline
# run. Held-out folds, importance and the metrics document are left out.
HEADLINE = {
    "stations": "s5_station_table", "population": "s4_population_sheet", "traffic": "s6_traffic_table",
    "point_in_polygon": "j7_point_in_polygon", "snap": "j8_snap_to_polygon", "nearest": "j9_nearest_target",
    "radius_sum": "j10_radius_sum", "supply": "b1_supply_measures", "panel": "a15_label_counts",
    "features": "b5_model_transforms", "logistic": "m2_logistic_probabilities",
    "lasso": "m3_l1_logistic", "coefficients": "m8_coefficient_table",
    "baselines": "m6_rank_baselines", "measures": "m12_all_measures_by_group", "latest_scores": "m17_latest_scores",
    "clusters": "m19_kmeans_members", "price_medians": "a6_state_median_price", "components": "c1_percentile_components",
    "app_table": "c2_saturation", "rescore_and_select": "c13_ranked_recommendation",
    "forest": "m4_forest_probabilities", "exact_selection": "c10_exact_selection", "greedy": "c9_greedy_selection", "sweep": "c12_what_if_sweep", "facts": "q10_facts",
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", cpus=cpus, shuffle_partitions=int(cpus), spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    tables = Tables(spark, folder)
    times: dict[str, float] = {}
    for name, key in HEADLINE.items():
        t0 = time.perf_counter()
        REGISTRY[key].run(tables).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": Path(folder).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
