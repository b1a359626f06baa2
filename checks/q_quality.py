"""Data-quality and reconciliation jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.base import MODEL_YEARS, SNAPSHOT, SPINE, YEARS, Tables, query, rounded, tile, with_ctes
from siteplan.functions.transforms import FEATURES, model_features
from siteplan.operators import polygons, quality
from siteplan.plans import facts
from siteplan.plans.scoring import score


@query("q1_unique_key", "select o_custkey, count(*) as n from orders group by 1 having count(*) > 1")
def _(t: Tables) -> DataFrame:
    quality.assert_key(t.panel(), ["fips", "year"], "panel")
    return quality.duplicate_keys(t.raw("orders"), ["o_custkey"])


@query("q2_expected_rows", f"select count(*) * {len(SPINE)} as n from customer")
def _(t: Tables) -> DataFrame:
    expected = t.raw("customer").count() * len(SPINE)
    panel = quality.assert_key(t.panel(), ["fips", "year"], "panel", expected)
    try:
        quality.assert_key(panel, ["fips", "year"], "panel", expected + 1)
    except ValueError:
        return panel.agg(F.count("*").alias("n"))
    raise AssertionError("a wrong row count went unnoticed")


@query("q3_unmatched_rows", "select c_custkey from customer where c_custkey not in (select o_custkey from orders)")
def _(t: Tables) -> DataFrame:
    return quality.unmatched(t.raw("customer").select("c_custkey"), t.raw("orders").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("q4_supply_never_falls", with_ctes("supply", then="""select count(*) as rows_checked, count(*) filter (where step < 0) as falls
  from (select dcfc_ports - lag(dcfc_ports) over (partition by fips order by year) as step from supply) q"""))
def _(t: Tables) -> DataFrame:
    rows = t.panel().select("fips", "year", "dcfc_ports")
    falls = quality.falling_steps(rows, "fips", "year", "dcfc_ports").agg(F.count("*").alias("falls"))
    return rows.agg(F.count("*").alias("rows_checked")).withColumn("falls", falls.scalar())


@query("q5_spatial_reconciliation", with_ctes("station", then="").rstrip() + f""", tiles as (select {', '.join(tile(0.0))} from nation)
  select status, count(*) as kept, count(*) as within from station join tiles on lon >= x0 and lon < x9 and lat >= y0 and lat < y9 group by status""")
def _(t: Tables) -> DataFrame:
    out = polygons.assign_points(t.stations().select("station_id", "status", "lat", "lon"), "station_id", t.tiles())
    return out.groupBy("status").agg(F.count_if(F.col("assigned") != "dropped").alias("kept"), F.count_if(F.col("assigned") == "within").alias("within"))


@query("q6_labels_match_next_year", with_ctes("panel", then="""select count(*) filter (where a.y_new_site is not null and a.y_new_site <> case when b.new_large_sites_t > 0 then 1 else 0 end) as a_not_next_year,
  count(*) filter (where a.y_new_site not in (0, 1)) as a_not_binary, count(*) filter (where a.y_first_site is not null and a.large_sites <> 0) as b_where_site_exists,
  count(*) filter (where a.year > 1999 and (a.y_new_site is not null or a.y_first_site is not null)) as label_after_last_year
  from panel a left join panel b on b.fips = a.fips and b.year = a.year + 1"""))
def _(t: Tables) -> DataFrame:
    return quality.label_mismatches(t.panel(), YEARS[-1] - 1)


@query("q7_ranges", with_ctes("rated", then="""select count(*) filter (where p_new_site not between 0 and 1 or p_first_site not between 0 and 1) as bad_probability,
  count(*) filter (where net_opportunity not between 0 and 100 or future_deployment not between 0 and 100) as bad_score,
  count(*) filter (where future_deployment > net_opportunity + 1e-9) as raised_by_penalty, count(*) as rows_checked from rated"""))
def _(t: Tables) -> DataFrame:
    return quality.violation_counts(score(t.components()), {
        "bad_probability": ~(F.col("p_new_site").between(0, 1) & F.col("p_first_site").between(0, 1)),
        "bad_score": ~(F.col("net_opportunity").between(0, 100) & F.col("future_deployment").between(0, 100)),
        "raised_by_penalty": F.col("future_deployment") > F.col("net_opportunity") + 1e-9, "rows_checked": F.lit(True)})


@query("q8_structural_zeros", with_ctes("traffic", then="""select count(*) filter (where not has_freeway and fwy_vmt <> 0) as traffic_without_freeway,
  count(*) filter (where fwy_vmt is null) as missing, count(*) filter (where fwy_vmt = 0) as zeros from traffic"""))
def _(t: Tables) -> DataFrame:
    return quality.violation_counts(t.traffic(), {
        "traffic_without_freeway": ~F.col("has_freeway") & (F.col("fwy_vmt") != 0), "missing": F.col("fwy_vmt").isNull(),
        "zeros": F.col("fwy_vmt") == 0})


@query("q9_null_features", with_ctes("full_panel", then="select " + ", ".join(
    f"count(*) filter (where {c} is null) as {f}" for f, c in {
        "log_pop": "pop", "pop_growth": "pop_growth", "log_density": "pop_density", "bev_per_1k": "bev_per_1k", "elec_price_c_kwh": "elec_price_c_kwh",
        "ev_incentives": "ev_incentives", "log_fwy_vmt": "fwy_vmt", "has_freeway": "has_freeway", "log_interstate_miles": "interstate_miles",
        "log_dcfc_ports": "dcfc_ports", "log_large_sites": "large_sites", "log_ports_per_1k_bev": "ports_per_1k_bev", "rival_share": "rival_share",
        "log_dist_large_dcfc": "dist_large_dcfc_mi", "log_ports_50mi": "ports_within_50mi", "log_new_large_t": "new_large_sites_t",
        "state_new_large_per_1m": "state_new_large_per_1m"}.items()) + " from full_panel"))
def _(t: Tables) -> DataFrame:
    return quality.null_counts(model_features(t.panel()), FEATURES)


@query("q10_facts", with_ctes("station", "work", "panel", "price", then="").rstrip() + """, lc as (select year, count(y_new_site) as an, coalesce(sum(y_new_site), 0) as ap from panel group by year)
  select * from (select 'stations' as fact, cast(count(*) as double) as value from station
  union all select 'status ' || status, count(*) from station group by status
  union all select 'used', count(*) from work union all select 'used ports', sum(dc_ports) from work
  union all select 'open year filled', count(*) filter (where open_year_imputed) from work
  union all select 'not public', count(*) filter (where non_public_flag) from station
  union all select 'own sites', count(*) filter (where is_own) from work
  union all select 'own mean ports', round(avg(case when is_own then dc_ports end), 9) from work
  union all select 'prices', count(price_kwh) from price
  union all select 'panel rows', count(*) from panel where year < 2001
  union all select 'no freeway', count(*) filter (where not has_freeway) from panel where year = 2001
  union all select 'train a', sum(an) from lc where year in (1996,1997,1998) union all select 'train a positive', sum(ap) from lc where year in (1996,1997,1998)) q""")
def _(t: Tables) -> DataFrame:
    from siteplan.plans.prices import priced
    st, work, panel = t.stations(), t.working(), t.panel()
    one = F.count("*")
    labels = facts.label_counts(panel).filter(F.col("year").isin(MODEL_YEARS.train))
    parts = [
        facts.fact_rows(st, {"stations": one, "not public": F.count_if("non_public_flag")}),
        facts.count_facts(st, "status", "status "),
        facts.fact_rows(work, {"used": one, "used ports": F.sum("dc_ports"), "open year filled": F.count_if("open_year_imputed"),
                               "own sites": F.count_if("is_own"), "own mean ports": F.avg(F.when(F.col("is_own"), F.col("dc_ports")))}),
        facts.fact_rows(priced(t.price_rows()), {"prices": F.count("price_kwh")}),
        facts.fact_rows(panel.filter(F.col("year") < SNAPSHOT), {"panel rows": one}),
        facts.fact_rows(panel.filter(F.col("year") == SNAPSHOT), {"no freeway": F.count_if(~F.col("has_freeway"))}),
        facts.fact_rows(labels, {"train a": F.sum("a_n"), "train a positive": F.sum("a_pos")})]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return rounded(out, {"value": 9})
