"""Components, scores, costs, selection and portfolio."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.base import CTES, OWN, SNAPSHOT, STAND_IN, Tables, query, rounded, with_ctes
from siteplan.functions.text import in_list
from siteplan.operators import selection
from siteplan.operators.ordering import top_rows
from siteplan.plans import clusters, cost, portfolio
from siteplan.plans.portfolio import NET, Controls
from siteplan.plans.scoring import DEFAULT_WEIGHTS, DEMAND, SATURATION, add_components, site_options, score
from siteplan.sources import sinks

# ---- SQL side: the application table and the default plan ----------------------------------


def _pct(col: str, direction: int) -> str:
    r = f"(rank() over (order by {col}) + (count(*) over (partition by {col}) - 1)/2e0) / count(*) over ()"
    return r if direction > 0 else f"1 - {r} + 1e0 / count(*) over ()"


PARTS = {f"c_{n}": _pct(c, d) for n, (c, d) in ((n, of[:2]) for n, of in {**DEMAND, **SATURATION}.items())}
CTES["snap"] = (["full_panel"], f"""select *, county_name as cluster, {', '.join(f'{e} as {n}' for n, e in STAND_IN.items())}
  from full_panel where year = {SNAPSHOT}""")
CTES["app"] = (["snap", "price"], f"""select c.*, (c_local_density + c_nearby_ports) / 2e0 as saturation,
  case when coalesce(n, 0) < 10 then (select median(price_kwh) from price) else med end as dcfc_price_kwh, coalesce(n, 0) < 10 as price_imputed
  from (select *, {', '.join(f'{e} as {n}' for n, e in PARTS.items())} from snap) c
  left join (select state, median(price_kwh) as med, count(price_kwh) as n from price group by state) p on p.state = c.state""")


def net_sql(weights: dict[str, float] | None = None) -> str:
    w = {k: max(v, 0) for k, v in {**DEFAULT_WEIGHTS, **(weights or {})}.items()}
    return "(" + " + ".join(f"c_{n} * {float(w[n])}e0" for n in DEMAND) + f") / {float(sum(w.values()))}e0 * 100"


CTES["rated"] = (["app"], f"""select *, net_opportunity * (1 - saturation * 0.5e0) as future_deployment
  from (select *, {net_sql()} as net_opportunity from app) q""")
BASE_COST = Controls().unit_cost()
CTES["cand"] = (["rated"], f"""select * from (select fips, k.k, future_deployment * pow(0.5e0, own_sites + k.k - 1) as value, {BASE_COST}e0 as cost
  from rated cross join (select unnest([1, 2]) as k) k) q where value > 0""")
CTES["picks"] = (["cand"], """select *, row_number() over (order by value desc, k, fips) as rank from cand
  qualify row_number() over (order by value desc, k, fips) <= 50""")
# Unequal costs: a regional multiplier per state.
CTES["priced_cand"] = (["rated"], f"""select * from (select fips, k.k, future_deployment * pow(0.5e0, own_sites + k.k - 1) as value,
  {BASE_COST}e0 * (0.8e0 + state / 5e1) as cost from rated cross join (select unnest([1, 2, 3]) as k) k) q where value > 0""")


def _rated(t: Tables) -> DataFrame:
    return score(t.components())


def _cand(t: Tables) -> DataFrame:
    return site_options(_rated(t), "future_deployment", BASE_COST, 2, 0.5)


def _priced_cand(t: Tables) -> DataFrame:
    rated = _rated(t)
    return site_options(rated, "future_deployment", F.lit(BASE_COST) * (0.8 + F.col("state") / 50.0), 3, 0.5)


COMPONENTS = list(PARTS)


@query("c1_percentile_components", with_ctes("app", then="select fips, " + ", ".join(f"round({c}, 9) as {c}" for c in COMPONENTS) + " from app"))
def _(t: Tables) -> DataFrame:
    snap = t.panel().filter(F.col("year") == SNAPSHOT).withColumns({n: F.expr(e) for n, e in STAND_IN.items()})
    return rounded(add_components(snap).select("fips", *COMPONENTS), dict.fromkeys(COMPONENTS, 9))


@query("c2_saturation", with_ctes("app", then="select fips, round(saturation, 9) as saturation from app"))
def _(t: Tables) -> DataFrame:
    return rounded(t.components().select("fips", "saturation"), {"saturation": 9})


@query("c3_opportunity_scores", with_ctes("rated", then="select fips, net_opportunity, future_deployment from rated"))
def _(t: Tables) -> DataFrame:
    return _rated(t).select("fips", "net_opportunity", "future_deployment")


OVERRIDE = {"traffic": -1.0, "growth": 0.5, "policy": 0.0}


@query("p13_weight_overrides", with_ctes("app", then=f"select fips, round({net_sql(OVERRIDE)}, 8) as net_opportunity from app"))
def _(t: Tables) -> DataFrame:
    try:
        score(t.components(), dict.fromkeys(DEMAND, 0.0))
    except ValueError:
        return rounded(score(t.components(), OVERRIDE, 0.0).select("fips", "net_opportunity"), {"net_opportunity": 8})
    raise AssertionError("all-zero weights went unnoticed")


@query("p11_user_pool", with_ctes("rated", then="select fips, state from rated where pop >= 4e4 and state in (1, 4, 9, 16)"))
def _(t: Tables) -> DataFrame:
    return portfolio.pool(_rated(t), 4e4, [1, 4, 9, 16]).select("fips", "state")


@query("c4_candidate_expansion", with_ctes("cand", then="select fips, k, value, cost from cand"))
def _(t: Tables) -> DataFrame:
    return _cand(t)


@query("c5_site_cost_by_scenario", f"""select c_custkey, scenario, round((pp * (4 + c_custkey%13) + fx) * (1e0 + c_nationkey/1e2) * (1 - (c_custkey%5)/1e1), 2) as cost
  from customer join (values {', '.join(f"({i}, '{s.name}', {s.per_port}e0, {s.site_fixed}e0)" for i, s in enumerate(cost.SCENARIOS.values()))}) v(i, scenario, pp, fx) on i = c_custkey % 3""")
def _(t: Tables) -> DataFrame:
    rows = t.raw("customer").withColumn("scenario", F.element_at(F.array(*[F.lit(n) for n in cost.SCENARIOS]), (F.col("c_custkey") % 3 + 1).cast("int")))
    out = cost.site_costs(rows, cost.scenario_table(t.spark), 4 + F.col("c_custkey") % 13, 1.0 + F.col("c_nationkey") / 100.0, (F.col("c_custkey") % 5) / 10.0)
    return out.select("c_custkey", "scenario", F.round("cost", 2).alias("cost"))


ADDER = f"{cost.DEMAND_CHARGE_ADDER}e0"
ECON = f"""select {{key}}, round(kwh, 2) as kwh, round(kwh * price, 2) as revenue, round(kwh * (elec / 100 + {ADDER}), 2) as energy_cost,
  round(kwh * price - kwh * (elec / 100 + {ADDER}), 2) as gross_margin"""


@query("c6_annual_economics", with_ctes("app", then=ECON.format(key="fips") + """ from (select fips, cast(8 * 176 * 365 as double) as kwh,
  dcfc_price_kwh as price, elec_price_c_kwh as elec from app) q"""))
def _(t: Tables) -> DataFrame:
    econ = cost.annual_economics(8, 176, F.col("dcfc_price_kwh"), F.col("elec_price_c_kwh"))
    return rounded(t.components().withColumns(econ).select("fips", *econ), dict.fromkeys(econ, 2))


@query("c7_simple_payback", with_ctes("app", then=f"""select fips, round(coalesce(case when m > 0 then {BASE_COST}e0 / m end, -1e0), 6) as state_price,
  round(coalesce(case when f > 0 then {BASE_COST}e0 / f end, -1e0), 6) as flat_price from (
  select fips, 513920e0 * dcfc_price_kwh - 513920e0 * (elec_price_c_kwh / 100 + {ADDER}) as m, 513920e0 * 0.45e0 - 513920e0 * (elec_price_c_kwh / 100 + {ADDER}) as f from app) q"""))
def _(t: Tables) -> DataFrame:
    rows = t.components().withColumn("cost", F.lit(BASE_COST))
    state = cost.with_economics(rows).select("fips", F.round(F.coalesce("payback_years", F.lit(-1.0)), 6).alias("state_price"))
    flat = cost.with_economics(rows, flat_price=0.45).select("fips", F.round(F.coalesce("payback_years", F.lit(-1.0)), 6).alias("flat_price"))
    return state.join(flat, "fips")


@query("c8_equal_cost_selection", with_ctes("picks", then="select fips, k, value, cost from picks"))
def _(t: Tables) -> DataFrame:
    picks, method = selection.select_sites(_cand(t), 100e6)
    if method != "exact (equal costs)":
        raise AssertionError(method)
    return picks


GREEDY_BUDGET = 150e6
ORDERED = f"""with recursive {with_ctes('priced_cand', then='')[5:].rstrip()},
  o as (select *, row_number() over (order by value / cost desc, k, fips) as pos from priced_cand),
  walk as (select 0::bigint as pos, 0e0 as spent, false as taken
    union all select o.pos, case when w.spent + o.cost <= {GREEDY_BUDGET}e0 then w.spent + o.cost else w.spent end, w.spent + o.cost <= {GREEDY_BUDGET}e0
    from walk w join o on o.pos = w.pos + 1)
"""


@query("c9_greedy_selection", ORDERED + "select o.fips, o.k, o.value, round(o.cost, 2) as cost from walk join o using (pos) where taken")
def _(t: Tables) -> DataFrame:
    picks, method = selection.select_sites(_priced_cand(t), GREEDY_BUDGET)
    if method != "greedy (value per dollar)":
        raise AssertionError(method)
    return rounded(picks, {"cost": 2})


@query("c10_budget_bound", with_ctes("priced_cand", then=f"""select round(sum(case when s <= {GREEDY_BUDGET}e0 then value
    when s - cost < {GREEDY_BUDGET}e0 then ({GREEDY_BUDGET}e0 - (s - cost)) / cost * value else 0 end), 6) as bound,
  count(*) filter (where s <= {GREEDY_BUDGET}e0) as whole_items
  from (select *, sum(cost) over (order by value / cost desc, k, fips rows unbounded preceding) as s from priced_cand) q"""))
def _(t: Tables) -> DataFrame:
    return rounded(selection.budget_bound(_priced_cand(t), GREEDY_BUDGET), {"bound": 6})


@query("c10_greedy_gap", ORDERED + f""", b as (select sum(case when s <= {GREEDY_BUDGET}e0 then value
    when s - cost < {GREEDY_BUDGET}e0 then ({GREEDY_BUDGET}e0 - (s - cost)) / cost * value else 0 end) as bound
    from (select *, sum(cost) over (order by pos rows unbounded preceding) as s from o) q),
  g as (select sum(value) as greedy_value from walk join o using (pos) where taken)
  select round(bound, 6) as bound, round(greedy_value, 6) as greedy_value, round(bound - greedy_value, 6) as gap from b cross join g""")
def _(t: Tables) -> DataFrame:
    return rounded(selection.greedy_gap(_priced_cand(t), GREEDY_BUDGET), {"bound": 6, "greedy_value": 6, "gap": 6})


# Costs in whole steps of 100,000, so that SQL can fill a table of the best value for each amount of money.
STEPS = 600
CTES["step_cand"] = (["priced_cand"], "select fips, k, value, cast(round(cost / 1e5) as bigint) as steps from priced_cand")


@query("c10_exact_selection", f"""with recursive {with_ctes('step_cand', then='')[5:].rstrip()},
  area as materialized (select fips, max(steps) as s, max(case when k = 1 then value end) as v1, max(case when k = 2 then value end) as v2,
    max(case when k = 3 then value end) as v3, row_number() over (order by fips) as i from step_cand group by fips),
  fill as (select 0::bigint as i, list_transform(range({STEPS + 1}), lambda b: 0e0) as best
    union all select a.i, list_transform(list_zip(f.best, {', '.join(f'list_concat(repeat([-1e9], cast({k} * a.s as int)), f.best[1:{STEPS + 1} - {k} * a.s])' for k in (1, 2, 3))}),
      lambda x: greatest(x[1], x[2] + a.v1, x[3] + a.v1 + a.v2, x[4] + a.v1 + a.v2 + a.v3)) from fill f join area a on a.i = f.i + 1)
  select 'exact (core search)' as method, round(best[{STEPS + 1}], 6) as value, true as affordable, true as in_order
  from fill order by i desc limit 1""")
def _(t: Tables) -> DataFrame:
    cand = _priced_cand(t).withColumn("cost", F.round(F.col("cost") / 1e5) * 1e5)
    picks, method = selection.select_sites(cand, STEPS * 1e5, exact=True)
    chains = picks.groupBy("fips").agg(F.max("k").alias("last"), F.count("*").alias("n"), F.sum("value").alias("value"), F.sum("cost").alias("cost"))
    return chains.agg(F.lit(method).alias("method"), F.round(F.sum("value"), 6).alias("value"), (F.sum("cost") <= STEPS * 1e5).alias("affordable"),
                      F.bool_and(F.col("last") == F.col("n")).alias("in_order"))


@query("c11_selection_methods", with_ctes("cand", "priced_cand", then=f"""select 'enough' as money, 'exact (equal costs)' as method, least(count(*), 50) as sites from cand
  union all select 'too little', 'exact (equal costs)', count(*) from cand where cost <= 1
  union all select 'no candidates', 'none', count(*) from cand where value > 1e9
  union all select 'too little, unequal', 'greedy (value per dollar)', count(*) from priced_cand where cost <= 1"""))
def _(t: Tables) -> DataFrame:
    c = _cand(t)
    cases = {"enough": (c, 100e6), "too little": (c, 1.0), "no candidates": (c.filter("value > 1e9"), 100e6),
             "too little, unequal": (_priced_cand(t), 1.0)}
    out = None
    for name, (cand, budget) in cases.items():
        picks, method = selection.select_sites(cand, budget)
        if picks.columns != c.columns:
            raise AssertionError(picks.columns)
        row = picks.agg(F.lit(name).alias("money"), F.lit(method).alias("method"), F.count("*").alias("sites"))
        out = row if out is None else out.unionByName(row)
    return out


SETTINGS = [
    Controls("default"), Controls("net", target=NET), Controls("low cost", scenario="Low", budget=60e6),
    Controls("grant", grant=0.5, ports=6, max_sites=3), Controls("steep", penalty=1.0, decay=0.25, min_pop=3e4),
    Controls("traffic", weights={"traffic": 1.0, "policy": 0.0}), Controls("some states", states=(2, 3, 5, 7, 11, 13)),
    Controls("large budget", budget=2e9, scenario="High", max_sites=5, decay=0.9)]


def _setting_sql(c: Controls) -> str:
    unit, pen = c.unit_cost(), c.penalty if c.target != NET else 0.0
    w = {k: max(v, 0) for k, v in {**DEFAULT_WEIGHTS, **c.weights}.items()}
    tot = sum(w.values())
    net = " + ".join(f"c_{n} * {w[n] / tot}e0" for n in DEMAND)
    only = f" and state in {tuple(c.states)}" if c.states else ""
    return f"""select '{c.name}' as setting, row_number() over (order by value desc, k, fips) as rank, fips, k, value, {unit}e0 as cost
      from (select fips, k.k, ({net}) * 100 * (1 - {pen}e0 * saturation) * pow({c.decay}e0, own_sites + k.k - 1) as value
        from app cross join (select unnest(range(1, {c.max_sites + 1})) as k) k where pop >= {c.min_pop}e0{only}) q
      where value > 0 qualify row_number() over (order by value desc, k, fips) <= {int(c.budget // unit)}"""


@query("c12_what_if_sweep", with_ctes("app", then="select setting, rank, fips, k, round(value, 12) as value, round(cost, 4) as cost from (\n" + "\nunion all ".join(
    f"(select * from ({_setting_sql(c)}) s{i})" for i, c in enumerate(SETTINGS)) + ") u"))
def _(t: Tables) -> DataFrame:
    return rounded(portfolio.sweep(t.components(), SETTINGS), {"value": 12, "cost": 4})


REC_DIGITS = {"dist_large_dcfc_mi": 6, "pop": 4}


def _rec_sql() -> str:
    cols = ["rank", "county_key", "state", "k", "future_deployment as score", "net_opportunity", "future_deployment", "p_new_site",
            "p_first_site", "dcfc_ports", "own_sites", "dist_large_dcfc_mi", "pop", "cost", "cluster"]
    out = []
    for c in cols:
        src, _, name = c.partition(" as ")
        name = name or src
        out.append(f"round({src}, {REC_DIGITS[name]}) as {name}" if name in REC_DIGITS else c)
    return ", ".join(out)


@query("c13_ranked_recommendation", with_ctes("picks", then=f"select {_rec_sql()} from picks join rated using (fips)"))
def _(t: Tables) -> DataFrame:
    picks, _ = portfolio.plan(t.components())
    return rounded(portfolio.recommendation(picks), REC_DIGITS)


COUNTY = "Customer#000000042"


@query("c14_area_lookup", with_ctes("app", then=" union all ".join(
    f"select '{label}' as component, round(c_{n}, 9) as percentile from app where county_key = '{COUNTY}'" for n, (_, _, label) in DEMAND.items())))
def _(t: Tables) -> DataFrame:
    return rounded(portfolio.area_profile(t.components(), COUNTY), {"percentile": 9})


@query("c15_sites_per_area", with_ctes("picks", then="""select fips, round(cent_lat, 6) as cent_lat, round(cent_lon, 6) as cent_lon, county_key, count(*) as new_sites
  from picks join rated using (fips) group by all"""))
def _(t: Tables) -> DataFrame:
    picks, _ = portfolio.plan(t.components())
    return rounded(portfolio.sites_per_area(picks), {"cent_lat": 6, "cent_lon": 6})


@query("a12_group_profile", with_ctes("rated", then="""select cluster, count(*) as counties, round_even(sum(pop)/1e6, 1) as population_m,
  round_even(median(dcfc_ports), 1) as median_dc_ports, round_even(median(dist_large_dcfc_mi), 1) as median_miles_to_large,
  round_even(avg(net_opportunity), 1) as mean_net_opportunity from rated group by cluster"""))
def _(t: Tables) -> DataFrame:
    return clusters.group_profile(_rated(t))


@query("a13_portfolio_figures", with_ctes("picks", then=f"""select count(*) as sites, sum(cost) as capital, count(distinct fips) as counties, count(distinct state) as states,
  round(sum(513920e0 * dcfc_price_kwh), 2) as revenue, round(sum(m), 2) as margin, round(case when sum(m) > 0 then sum(cost) / sum(m) end, 6) as payback_years
  from (select *, 513920e0 * dcfc_price_kwh - 513920e0 * (elec_price_c_kwh / 100 + {ADDER}) as m from picks join rated using (fips)) q"""))
def _(t: Tables) -> DataFrame:
    picks, _ = portfolio.plan(t.components())
    return rounded(portfolio.key_figures(cost.with_economics(picks)), {"revenue": 2, "margin": 2, "payback_years": 6})


@query("s16_app_columns", with_ctes("app", then="select fips, county_key, cluster, dcfc_price_kwh, price_imputed, own_ports, own_sites, round(c_traffic, 9) as c_traffic, 39 as n_columns from app"))
def _(t: Tables) -> DataFrame:
    app = sinks.app_columns(t.components())
    return (app.withColumn("n_columns", F.lit(len(app.columns)))
            .select("fips", "county_key", "cluster", "dcfc_price_kwh", "price_imputed", "own_ports", "own_sites", F.round("c_traffic", 9).alias("c_traffic"), "n_columns"))


@query("t1_top_by_value", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 100")
def _(t: Tables) -> DataFrame:
    return top_rows(t.raw("orders").select("o_orderkey", "o_totalprice"), [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], 100)


@query("t1_top_third_by_value", "select o_orderkey from (select o_orderkey, row_number() over (order by o_totalprice desc, o_orderkey) as r, count(*) over () as n from orders) q where r <= greatest(n // 3, 10001)")
def _(t: Tables) -> DataFrame:
    o = t.raw("orders").select("o_orderkey", "o_totalprice")
    return top_rows(o, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], max(o.count() // 3, 10001)).select("o_orderkey")


@query("t3_value_per_dollar_order", with_ctes("priced_cand", then="select fips, k, row_number() over (order by value / cost desc, k, fips) as pos from priced_cand"))
def _(t: Tables) -> DataFrame:
    from siteplan.operators.ordering import row_numbers
    return row_numbers(_priced_cand(t), selection.ratio_order(), "pos").select("fips", "k", "pos")


@query("own_network_share_by_status", f"""select o_orderstatus, count(*) as n, count(*) filter (where o_orderpriority in ('{OWN}')) as own from orders group by 1""")
def _(t: Tables) -> DataFrame:
    return t.raw("orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.count_if(in_list(F.col("o_orderpriority"), [OWN])).alias("own"))
