"""Supply, panel, labels, aggregates and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.base import MODEL_YEARS, SNAPSHOT, SPINE, YEARS, Tables, query, rounded, with_ctes
from siteplan.functions.transforms import FEATURES, LOG1P, complete_cases, model_features
from siteplan.operators import metrics as mt
from siteplan.operators.ordering import exact_quantiles, percentile_ranks, row_numbers
from siteplan.operators.quality import difference_from_previous
from siteplan.plans import facts, panel, prices, supply
from siteplan.plans.models import Scaler
from siteplan.plans.panel import PANEL_COLUMNS
from siteplan.plans.scoring import fill_with_median
from siteplan.session import bucketed

MEASURES = ", ".join(supply.MEASURES)


@query("j11_in_force_count", with_ctes("in_force", then="select state, cast(year as int) as year, ev_incentives from in_force"))
def _(t: Tables) -> DataFrame:
    return supply.in_force_by_year(t.entity(), t.incentives(), SPINE)


@query("j12_next_year_label", with_ctes("panel", then="select fips, year, coalesce(y_new_site, -1e0) as y_new_site from panel"))
def _(t: Tables) -> DataFrame:
    rows = t.panel().select("fips", "year", "large_sites", "new_large_sites_t")
    return panel.next_year_labels(rows, YEARS[-1] - 1).select("fips", "year", F.coalesce("y_new_site", F.lit(-1.0)).alias("y_new_site"))


@query("a1_grouped_sum_and_size", with_ctes("entity", "station", then="""select e.fips, cast(coalesce(sum(dc_ports),0) as bigint) as ports, count(station_id) as sites
  from entity e left join station s on s.fips = e.fips group by e.fips"""))
def _(t: Tables) -> DataFrame:
    by = t.stations().groupBy("fips").agg(F.sum("dc_ports").alias("ports"), F.count("*").alias("sites"))
    return t.entity().select("fips").join(by, "fips", "left").fillna(0, ["ports", "sites"])


@query("a2_filtered_aggregates", with_ctes("work", then="""select fips, count(*) filter (where is_large) as large, count(*) filter (where is_own) as own,
  cast(coalesce(sum(dc_ports) filter (where is_rival),0) as bigint) as rival_ports, count(*) filter (where open_year_filled = 1999) as opened from work group by fips"""))
def _(t: Tables) -> DataFrame:
    return t.working().groupBy("fips").agg(
        F.count_if("is_large").alias("large"), F.count_if("is_own").alias("own"),
        F.coalesce(F.sum(F.when(F.col("is_rival"), F.col("dc_ports"))), F.lit(0)).alias("rival_ports"),
        F.count_if(F.col("open_year_filled") == 1999).alias("opened"))


@query("a3_supply_as_of_year", with_ctes("supply", then="select fips, year, dcfc_ports, dcfc_sites from supply"))
def _(t: Tables) -> DataFrame:
    return supply.supply_by_year(t.entity(), t.working(), SPINE).select("fips", "year", "dcfc_ports", "dcfc_sites")


@query("b1_supply_measures", with_ctes("supply", then=f"select fips, year, {MEASURES} from supply"))
def _(t: Tables) -> DataFrame:
    return supply.supply_by_year(t.entity(), t.working(), SPINE)


@query("a4_state_year_rate", with_ctes("panel", then="select fips, year, round(state_new_large_per_1m, 6) as rate from panel"))
def _(t: Tables) -> DataFrame:
    rows = t.panel().drop("state_new_large_per_1m")
    return panel.state_year_rate(rows).select("fips", "year", F.round("state_new_large_per_1m", 6).alias("rate"))


@query("a5_state_population_rate", with_ctes("rates", then="select state, round(state_pop, 2) as state_pop, round(bev_per_1k, 6) as bev_per_1k from rates"))
def _(t: Tables) -> DataFrame:
    return rounded(panel.state_rates(t.population(), t.entity(), t.registrations(), YEARS[-1]), {"state_pop": 2, "bev_per_1k": 6})


@query("a6_state_median_price", with_ctes("price", then="""select cast(state as string) as state, round(coalesce(median(price_kwh), -1e0), 9) as price, count(price_kwh) as obs from price group by state
  union all select 'all', round(median(price_kwh), 9), count(price_kwh) from price"""))
def _(t: Tables) -> DataFrame:
    rows = prices.price_counts(prices.priced(t.price_rows()))
    by = prices.state_prices(rows).select(F.col("state").cast("string"), F.round(F.coalesce("dcfc_price_kwh", F.lit(-1.0)), 9).alias("price"), F.col("price_obs").alias("obs"))
    return by.unionByName(prices.national_price(rows).select(F.lit("all").alias("state"), F.round("national", 9).alias("price"), "obs"))


THIN = 1200


@query("a7_thin_group_fallback", with_ctes("price", then=f"""select n_nationkey as state, coalesce(n, 0) < {THIN} as price_imputed,
  round(case when coalesce(n, 0) < {THIN} then (select median(price_kwh) from price) else med end, 9) as price
  from nation left join (select state, median(price_kwh) as med, count(price_kwh) as n from price group by state) p on state = n_nationkey"""))
def _(t: Tables) -> DataFrame:
    states = t.raw("nation").select(F.col("n_nationkey").alias("state"))
    out = prices.with_prices(states, prices.priced(t.price_rows()), THIN)
    return out.select("state", "price_imputed", F.round("dcfc_price_kwh", 9).alias("price"))


@query("a8_median_fill", """select o_orderkey, round(coalesce(v, (select median(v) from (select case when o_orderkey%9=0 then null else o_totalprice end as v from orders))), 6) as v
  from (select o_orderkey, case when o_orderkey%9=0 then null else o_totalprice end as v from orders) q""")
def _(t: Tables) -> DataFrame:
    rows = t.raw("orders").selectExpr("o_orderkey", "case when o_orderkey%9=0 then null else o_totalprice end as v")
    return rounded(fill_with_median(rows, ["v"]), {"v": 6})


@query("a9_distinct_counts", "select count(distinct o_custkey) as areas, count(distinct o_orderstatus) as statuses, count(distinct o_orderpriority) as networks from orders")
def _(t: Tables) -> DataFrame:
    return t.raw("orders").agg(F.countDistinct("o_custkey").alias("areas"), F.countDistinct("o_orderstatus").alias("statuses"),
                               F.countDistinct("o_orderpriority").alias("networks"))


@query("a10_market_totals", with_ctes("supply", "work", then="""select 'total' as part, year, cast(sum(dcfc_ports) as bigint) as ports, cast(sum(large_sites) as bigint) as sites from supply group by year
  union all select 'opened', open_year, 0, count(*) from work where is_large and open_year between 1996 and 2000 group by open_year"""))
def _(t: Tables) -> DataFrame:
    totals = facts.market_by_year(t.panel()).select(F.lit("total").alias("part"), "year", F.col("dcfc_ports").alias("ports"), F.col("large_sites").alias("sites"))
    opened = facts.new_large_by_year(t.working(), 1996, 2000)
    return totals.unionByName(opened.select(F.lit("opened").alias("part"), F.col("open_year").alias("year"), F.lit(0).cast("bigint").alias("ports"), F.col("n").alias("sites")))


@query("a11_label_base_rates", with_ctes("panel", then="""select year, round(coalesce(avg(y_new_site)*100, -1e0), 9) as a_pct, round(coalesce(avg(y_first_site)*100, -1e0), 9) as b_pct
  from panel where year < 2001 group by year"""))
def _(t: Tables) -> DataFrame:
    before, _ = panel.split_snapshot(t.panel(), SNAPSHOT)
    return facts.base_rates(before).select("year", *[F.round(F.coalesce(c, F.lit(-1.0)), 9).alias(c) for c in ("a_pct", "b_pct")])


@query("a14_frequency_table", "select o_orderstatus, count(*) as n from orders group by 1")
def _(t: Tables) -> DataFrame:
    return facts.frequencies(t.raw("orders"), "o_orderstatus").orderBy(F.col("n").desc(), "o_orderstatus")


@query("a15_label_counts", with_ctes("panel", then="""select year, count(y_new_site) as a_n, cast(coalesce(sum(y_new_site),0) as bigint) as a_pos, count(y_first_site) as b_n,
  cast(coalesce(sum(y_first_site),0) as bigint) as b_pos from panel group by year"""))
def _(t: Tables) -> DataFrame:
    return facts.label_counts(t.panel())


@query("a16_feature_moments", with_ctes("panel", then="""select x.f as feature, round(avg(x.v), 6) as mean, round(stddev_samp(x.v), 6) as sd from (
  select unnest(['log_pop','has_freeway','log_dcfc_ports','rival_share']) as f,
    unnest([ln(pop), cast(cast(has_freeway as int) as double), ln(1 + dcfc_ports), rival_share]) as v
  from panel where year in (1996,1997,1998) and y_new_site is not null) x group by 1"""))
def _(t: Tables) -> DataFrame:
    rows = model_features(t.panel()).filter(F.col("year").isin(MODEL_YEARS.train) & F.col("y_new_site").isNotNull())
    sc = Scaler.fit(rows, ["log_pop", "has_freeway", "log_dcfc_ports", "rival_share"], sample=True).varying()
    table = t.spark.createDataFrame(list(zip(sc.features, sc.mean, sc.sd, strict=True)), "feature string, mean double, sd double")
    return rounded(table, {"mean": 6, "sd": 6})


# ---- windows -------------------------------------------------------------------------------

PCT = "(rank() over (order by {c}) + (count(*) over (partition by {c}) - 1)/2e0) / count(*) over ()"


@query("w1_percentile_rank", f"""select c_custkey, round({PCT.format(c='c_acctbal')}, 9) as up, round(1 - {PCT.format(c='c_nationkey')} + 1e0 / count(*) over (), 9) as down from customer""")
def _(t: Tables) -> DataFrame:
    out = percentile_ranks(t.raw("customer"), "c_custkey", {"up": (F.col("c_acctbal"), 1), "down": (F.col("c_nationkey"), -1)})
    return rounded(out, {"up": 9, "down": 9})


@query("w2_yearly_growth", with_ctes("growth", then="select fips, cast(year as int) as year, round(coalesce(pop_growth, -9e0), 9) as pop_growth from growth"))
def _(t: Tables) -> DataFrame:
    return panel.growth(t.population()).select("fips", "year", F.round(F.coalesce("pop_growth", F.lit(-9.0)), 9).alias("pop_growth"))


@query("w3_running_total", with_ctes("work", then="""select fips, open_year_filled as y, cast(sum(sum(dc_ports)) over (partition by fips order by open_year_filled) as bigint) as ports
  from work group by fips, open_year_filled"""))
def _(t: Tables) -> DataFrame:
    by = t.working().groupBy("fips", F.col("open_year_filled").alias("y")).agg(F.sum("dc_ports").alias("n"))
    return supply.running_total(by, "fips", "y", "n", "ports").drop("n")


@query("w4_running_minimum", with_ctes("near_large", then="select fips, y, round(min(miles) over (partition by fips order by y), 6) as miles from near_large"))
def _(t: Tables) -> DataFrame:
    from siteplan.operators.cells import nearest_since
    e = t.entity().select("fips", F.col("cent_lat").alias("lat"), F.col("cent_lon").alias("lon"))
    large = t.working().filter("is_large").select("lat", "lon", F.col("open_year_filled").alias("since"))
    # A year whose openings cannot beat an earlier year has no row; the running minimum bridges it.
    years = large.select(F.col("since").alias("y")).distinct()
    near = e.join(nearest_since(e, large), ["lat", "lon"]).select("fips", F.col("since").alias("y"), "miles")
    grid = e.select("fips", F.explode(F.lit(sorted(r[0] for r in years.collect()))).alias("y"))
    return rounded(supply.running_min(grid.join(near, ["fips", "y"], "left"), "fips", "y", "miles", "miles"), {"miles": 6})


@query("w5_quantile_bins", with_ctes("scored", then="select id, " + " + ".join(f"cast(p > e[{i}] as int)" for i in range(1, 10)) + """ as bin
  from scored cross join (select quantile_cont(p, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) as e from scored) q"""))
def _(t: Tables) -> DataFrame:
    return mt.quantile_bins(t.scored(), "p", 10).select("id", "bin")


@query("w6_first_per_key", "select o_custkey, min(o_orderkey) as o_orderkey, arg_min(o_orderpriority, o_orderkey) as priority from orders group by 1")
def _(t: Tables) -> DataFrame:
    return t.raw("orders").groupBy("o_custkey").agg(F.min("o_orderkey").alias("o_orderkey"), F.min_by("o_orderpriority", "o_orderkey").alias("priority"))


@query("w7_output_rank", "select row_number() over (order by o_totalprice desc, o_orderkey) as rn, o_orderkey from orders")
def _(t: Tables) -> DataFrame:
    o = t.raw("orders").select("o_orderkey", "o_totalprice")
    return row_numbers(o, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()]).select("rn", "o_orderkey")


@query("w8_year_over_year_change", with_ctes("supply", then="""select fips, year, coalesce(dcfc_ports - lag(dcfc_ports) over (partition by fips order by year), 0) as change from supply"""))
def _(t: Tables) -> DataFrame:
    out = difference_from_previous(t.panel().select("fips", "year", "dcfc_ports"), "fips", "year", "dcfc_ports", "change")
    return out.select("fips", "year", F.coalesce("change", F.lit(0)).alias("change"))


@query("exact_quantiles_by_group", """select o_orderstatus, round(quantile_cont(o_totalprice, 0.25), 4) as q1, round(quantile_cont(o_totalprice, 0.9), 4) as q9, count(*) as n from orders group by 1""")
def _(t: Tables) -> DataFrame:
    q = exact_quantiles(t.raw("orders"), {"v": F.col("o_totalprice")}, [0.25, 0.9], ["o_orderstatus"])
    return q.select("o_orderstatus", F.round(F.col("q")[0], 4).alias("q1"), F.round(F.col("q")[1], 4).alias("q9"), "n")


# ---- panel and features --------------------------------------------------------------------

PANEL_DIGITS = {"cent_lat": 6, "cent_lon": 6, "dist_large_dcfc_mi": 6, "pop": 4, "pop_growth": 9, "fwy_vmt": 2, "fwy_miles": 4,
                "interstate_miles": 4, "bev_per_1k": 6, "bev_est": 6, "pop_density": 6, "ports_per_1k_bev": 6, "rival_share": 9,
                "state_new_large_per_1m": 6}
NULLABLE = ["pop_growth", "new_large_next", "y_new_site", "y_first_site"]


def _panel_sql() -> str:
    def col(c: str) -> str:
        e = f"coalesce(cast({c} as double), -9e0)" if c in NULLABLE else c
        return f"round({e}, {PANEL_DIGITS[c]}) as {c}" if c in PANEL_DIGITS else f"{e} as {c}"
    return ", ".join(col(c) for c in PANEL_COLUMNS)


@query("b3_panel", with_ctes("full_panel", then=f"select {_panel_sql()} from full_panel"))
def _(t: Tables) -> DataFrame:
    full = panel.build_panel(t.inputs(), YEARS, SNAPSHOT)
    return rounded(full.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(-9.0)) for c in NULLABLE}), PANEL_DIGITS)


@query("s11_panel_from_buckets", with_ctes("full_panel", then=f"select {_panel_sql()} from full_panel"))
def _(t: Tables) -> DataFrame:
    """The same panel from tables in buckets of the entity."""
    full = panel.build_panel(panel.co_located(t.inputs(), 16), YEARS, SNAPSHOT)
    return rounded(full.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(-9.0)) for c in NULLABLE}), PANEL_DIGITS)


@query("w2_growth_from_buckets", with_ctes("growth", then="select fips, cast(year as int) as year, round(coalesce(pop_growth, -9e0), 9) as pop_growth from growth"))
def _(t: Tables) -> DataFrame:
    grown = panel.growth(bucketed(t.population(), ["fips"], 16, "population"))
    return grown.select("fips", "year", F.round(F.coalesce("pop_growth", F.lit(-9.0)), 9).alias("pop_growth"))


@query("b2_spatial_supply", with_ctes("spatial", then="select fips, cast(year as int) as year, round(dist_large_dcfc_mi, 6) as miles, ports_within_50mi from spatial"))
def _(t: Tables) -> DataFrame:
    return supply.spatial_supply_by_year(t.entity(), t.working(), SPINE).select("fips", "year", F.round("dist_large_dcfc_mi", 6).alias("miles"), "ports_within_50mi")


@query("b4_labels", with_ctes("panel", then="select fips, year, coalesce(y_new_site, -1e0) as a, coalesce(y_first_site, -1e0) as b from panel"))
def _(t: Tables) -> DataFrame:
    return t.panel().select("fips", "year", F.coalesce("y_new_site", F.lit(-1.0)).alias("a"), F.coalesce("y_first_site", F.lit(-1.0)).alias("b"))


def _feature_sql(digits: int = 6) -> str:
    e = {"log_pop": "ln(pop)", "log_density": "ln(greatest(pop_density, 0.1e0))", "has_freeway": "cast(cast(has_freeway as int) as double)",
         **{o: f"ln(1 + {s})" for o, s in LOG1P.items()}}
    return ", ".join(f"round({v}, {digits}) as {k}" for k, v in e.items())


@query("b5_model_transforms", with_ctes("full_panel", then=f"select fips, year, {_feature_sql()} from full_panel"))
def _(t: Tables) -> DataFrame:
    names = ["log_pop", "log_density", "has_freeway", *LOG1P]
    return rounded(model_features(t.panel()).select("fips", "year", *names), dict.fromkeys(names, 6))


@query("b6_estimated_demand", with_ctes("core", then="""select fips, year, round(bev_est, 6) as bev_est, round(pop_density, 6) as pop_density,
  round(ports_per_1k_bev, 6) as ports_per_1k_bev from core"""))
def _(t: Tables) -> DataFrame:
    base = t.panel().drop("bev_est", "pop_density", "ports_per_1k_bev", "rival_share").withColumns(panel.demand_columns())
    return rounded(base.select("fips", "year", "bev_est", "pop_density", "ports_per_1k_bev"), {"bev_est": 6, "pop_density": 6, "ports_per_1k_bev": 6})


@query("p9_complete_cases", with_ctes("panel", then="select fips, year from panel where y_first_site is not null and pop_growth is not null"))
def _(t: Tables) -> DataFrame:
    return complete_cases(model_features(t.panel()), "y_first_site").select("fips", "year")


@query("p12_year_split", with_ctes("panel", then="""select case when year = 1999 then 'test' else 'train' end as part, count(*) as n, cast(sum(y_new_site) as bigint) as positives
  from panel where year between 1996 and 1999 group by 1"""))
def _(t: Tables) -> DataFrame:
    rows = complete_cases(model_features(t.panel()), "y_new_site", FEATURES)
    part = F.when(F.col("year") == MODEL_YEARS.test, "test").when(F.col("year").isin(MODEL_YEARS.train), "train")
    return (rows.filter(F.col("year").isin(MODEL_YEARS.final)).groupBy(part.alias("part"))
            .agg(F.count("*").alias("n"), F.sum("y_new_site").cast("bigint").alias("positives")))
