"""Sources, projections, keys, joins on keys, reshapes, scalar expressions, sinks."""

from __future__ import annotations

import glob

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.base import (MISSING_YEAR, OWN, POP, RIVAL, STATUSES, YEARS, Tables, code, query, rounded, with_ctes, year_list)
from siteplan.functions import arith, text
from siteplan.operators import quality
from siteplan.plans.supply import dense_years
from siteplan.session import scratch_path
from siteplan.sources import loaders, sinks, tables

RAW_STATION_SCHEMA = T.StructType([T.StructField(n, t) for n, t in [
    ("id", T.StringType()), ("name", T.StringType()), ("state", T.StringType()), ("latitude", T.DoubleType()),
    ("longitude", T.DoubleType()), ("fast_ports", T.IntegerType()), ("network", T.StringType()),
    ("status", T.StringType()), ("open_date", T.StringType()), ("pricing", T.StringType()), ("funding", T.StringType())]])

RENAMES = {"0000000003": ("9000000003", "Renamed area 3", "renamed")}
SPLITS = {"0000000005": [("9000000005", "Part one of 5", "part one"), ("9000000006", "Part two of 5", "part two")]}
DROPS = ["0000000007"]
MAPPING_SQL = """mapping as (select * from (values
  ('0000000003','9000000003','Renamed area 3','renamed'), ('0000000005','9000000005','Part one of 5','part one'),
  ('0000000005','9000000006','Part two of 5','part two'), ('0000000007',null,null,null)) m(old, new, new_key, new_name))"""


def _mapping(t: Tables) -> DataFrame:
    return tables.crosswalk_table(t.spark, RENAMES, SPLITS, DROPS)


@query("s1_delimited_read", with_ctes("raw_station", then="select id, fast_ports, latitude, status, open_date from raw_station"))
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    sinks.write_csv(t.raw_stations(), path)
    return tables.read_delimited(t.spark, path, RAW_STATION_SCHEMA,
                                 ["id", "fast_ports", "latitude", "status", "open_date"], "stations")


@query("s2_required_columns", "select o_orderstatus as status, count(*) as n from orders group by 1")
def _(t: Tables) -> DataFrame:
    ok = quality.require_columns(t.raw("orders"), ["o_orderkey", "o_orderstatus"], "orders")
    try:
        quality.require_columns(ok, ["o_orderkey", "not_there"], "orders")
    except ValueError as e:
        if str(e) != "orders: missing columns ['not_there']":
            raise
        return ok.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"))
    raise AssertionError("a missing column went unnoticed")


def _raw_keys(t: Tables) -> DataFrame:
    return t.raw("customer").selectExpr("concat('  ', c_name, ' ') as county_key", "concat(' ', cast(c_custkey as string)) as fips",
                                        "c_nationkey as state", "c_mktsegment as county_name")


@query("s3_county_keys", f"""with {MAPPING_SQL} select coalesce(new, fips) as fips, coalesce(new_key, c_name) as county_key,
  coalesce(new_name, c_mktsegment) as county_name, c_nationkey as state
  from (select *, {code('c_custkey')} as fips from customer) c left join mapping on old = fips where old is null or new is not null""")
def _(t: Tables) -> DataFrame:
    return tables.county_keys(_raw_keys(t), _mapping(t), width=10, expected=t.raw("customer").count())


def _sheet(t: Tables) -> DataFrame:
    """The population sheet: a dotted, oddly spaced name per area, one column per year, title rows."""
    body = t.raw("customer").selectExpr("concat('..', replace(c_name, 'Customer#', 'customer # ')) as name",
                                        *[f"{POP.format(y=y)} as `{y}`" for y in YEARS])
    titles = t.raw("region").selectExpr("r_name as name", *[f"cast(null as double) as `{y}`" for y in YEARS])
    return titles.unionByName(body)


@query("s4_population_sheet", with_ctes("pop", then="select fips, cast(year as int) as year, round(pop, 4) as pop from pop"))
def _(t: Tables) -> DataFrame:
    return rounded(tables.population(_sheet(t), t.entity().select("fips", "county_key"), YEARS), {"pop": 4})


STATION_OUT = ["station_id", "state", "dc_ports", "network", "open_year", "is_own", "is_rival", "is_large", "non_public_flag"]


@query("s5_station_table", with_ctes("raw_station", then=f"""select cast(id as bigint) as station_id, state, fast_ports as dc_ports,
  coalesce(network, 'Unknown') as network, cast(coalesce(year(try_cast(open_date as date)), 0) as int) as open_year,
  upper(coalesce(network,'Unknown')) = '{OWN}' as is_own, contains(upper(coalesce(network,'Unknown')), '{RIVAL}') as is_rival,
  fast_ports >= 4 as is_large, contains(upper(name), 'NOT A PUBLIC') as non_public_flag
  from raw_station where coalesce(fast_ports, 0) > 0"""))
def _(t: Tables) -> DataFrame:
    st = loaders.stations(t.raw_stations(), own=OWN, rival=RIVAL)
    return st.select(STATION_OUT).fillna({"open_year": 0})


def _override(t: Tables) -> DataFrame:
    return t.raw("customer").selectExpr(f"{code('c_custkey')} as fips", "c_acctbal + 2e4 as final_vmt",
                                        "cast(c_custkey % 40 as double) as final_miles")


@query("s6_traffic_table", with_ctes("raw_traffic", then="").rstrip() + f""", {MAPPING_SQL},
  base as (select r.fips, case when z then 0e0 else fwy_vmt end as v, case when z then 0e0 else fwy_miles end as m,
    case when z then 0e0 else interstate_miles end as i, starts_with(r.fips, '00000002') as hit, c_acctbal + 2e4 as ov,
    cast(c_custkey % 40 as double) as om
    from (select *, match_status like 'No qualifying%' as z from raw_traffic) r join customer on r.fips = {code('c_custkey')}),
  fin as (select fips, case when hit then ov else v end as fwy_vmt, case when hit then om else m end as fwy_miles,
    case when hit then om else i end as interstate_miles, hit as traffic_imputed from base
    where fips not in ('0000000005','0000000007')
    union all select new, 0e0, 0e0, 0e0, true from mapping where old = '0000000005')
  select case when fips = '0000000003' then '9000000003' else fips end as fips, round(fwy_vmt, 2) as fwy_vmt,
    round(fwy_miles, 4) as fwy_miles, round(interstate_miles, 4) as interstate_miles, traffic_imputed, fwy_miles > 0 as has_freeway from fin""")
def _(t: Tables) -> DataFrame:
    out = loaders.traffic(t.raw_traffic(), _override(t), _mapping(t), override_prefix="00000002", width=10)
    return rounded(out, {"fwy_vmt": 2, "fwy_miles": 4, "interstate_miles": 4})


def _states(t: Tables) -> DataFrame:
    return t.raw("nation").selectExpr("n_name as state_name", "n_nationkey as state")


def _registration_file(t: Tables) -> DataFrame:
    """Per-state counts with the national total as a last row."""
    by = (t.raw("customer").join(t.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name")
          .agg(F.sum(F.expr("100*(1 + c_custkey%7)")).alias("Electric (EV)"),
               F.sum(F.expr("10*(1 + c_custkey%11)")).alias("Plug-In Hybrid Electric (PHEV)")))
    both = by.withColumnRenamed("n_name", "State")
    return both.unionByName(both.agg(F.lit("United States").alias("State"), *[F.sum(f"`{c}`").alias(c) for c in both.columns[1:]]))


@query("s7_registrations_by_state", """select c_nationkey as state, cast(sum(100*(1 + c_custkey%7)) as double) as bev_regs,
  cast(sum(10*(1 + c_custkey%11)) as double) as phev_regs from customer group by 1""")
def _(t: Tables) -> DataFrame:
    return loaders.registrations(_registration_file(t), _states(t))


@query("s8_electricity_by_state", """select s_nationkey as state, cast(8 + count(*) % 7 as double) as elec_price_c_kwh from supplier group by 1""")
def _(t: Tables) -> DataFrame:
    col = "Average retail price (cents/kWh)"
    by = (t.raw("supplier").join(t.raw("nation"), F.col("s_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("Name"))
          .agg((8 + F.count("*") % 7).alias(col)))
    return loaders.electricity(by.unionByName(by.agg(F.lit("U.S. Total").alias("Name"), F.max(f"`{col}`").alias(col))), _states(t))


RAW_INCENTIVE = [
    "case when s_suppkey%41=0 then null when s_suppkey%37=0 then 'US' else cast(s_nationkey as string) end as state",
    "case s_suppkey%5 when 0 then 'Laws and Regulations' when 1 then 'State Incentives' when 2 then 'Incentives' when 3 then null else 'State Incentives' end as type",
    "case s_suppkey%6 when 0 then 'BIOD' when 1 then null else 'HY|ELEC|PHEV' end as technology",
    "case when s_suppkey%4=0 then 'undated' when s_suppkey%9=0 then null else concat(cast(1990+s_suppkey%12 as string), '-03-15 00:00:00') end as enacted",
    "case s_suppkey%7 when 0 then 'archived' when 1 then 'expired' when 2 then null else 'enacted' end as status"]


@query("s9_incentive_records", f"""select state, cast(coalesce(year(try_cast(substring(enacted, 1, 10) as date)), 0) as int) as enacted_year
  from (select {', '.join(RAW_INCENTIVE)} from supplier) r where technology like '%ELEC%' and type in ('State Incentives','Incentives')
  and coalesce(state <> 'US', true) and coalesce(status not in ('archived','expired'), true)""")
def _(t: Tables) -> DataFrame:
    return loaders.incentives(t.raw("supplier").selectExpr(*RAW_INCENTIVE)).fillna({"enacted_year": 0})


@query("s11_parquet_round_trip", f"""select {code('c_custkey')} as fips, y.year, round({POP.format(y='y.year')}, 4) as pop
  from customer cross join {year_list(YEARS)} y""")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "panel")
    sinks.write_parquet(t.population(), path, ["year"])
    back = tables.read_table(t.spark, path, ["fips", "year", "pop"])
    return rounded(back, {"pop": 4})


@query("s12_csv_export", with_ctes("entity", then="select fips, county_key, round(cent_lat, 6) as cent_lat, round(cent_lon, 6) as cent_lon from entity"))
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    df = t.entity().select("fips", "county_key", "cent_lat", "cent_lon")
    sinks.write_csv(df, path)
    return rounded(tables.read_delimited(t.spark, path, df.schema, df.columns, "export"), {"cent_lat": 6, "cent_lon": 6})


@query("s13_metrics_json", """select cast(c_nationkey as string) as target, c_mktsegment as section, 'm' || cast(c_custkey%3 as string) as model,
  x.metric, round(case x.metric when 'n' then cast(count(*) as double) else sum(c_acctbal) end, 2) as value
  from customer cross join (values ('n'), ('total')) x(metric) group by 1, 2, 3, 4""")
def _(t: Tables) -> DataFrame:
    by = (t.raw("customer").groupBy(F.expr("cast(c_nationkey as string)").alias("target"), F.col("c_mktsegment").alias("section"),
                                    F.expr("concat('m', cast(c_custkey%3 as string))").alias("model"))
          .agg(F.count("*").cast("double").alias("n"), F.sum("c_acctbal").alias("total")))
    long = by.unpivot(["target", "section", "model"], ["n", "total"], "metric", "value")
    path = scratch_path(t.spark, "metrics")
    sinks.write_metrics(long, path)
    return rounded(sinks.read_metrics(t.spark, path), {"value": 2})


@query("s14_map_features", with_ctes("entity", then=f"""select fips as id, 5 as corners, round(cent_lon - h, 4) as west, round(cent_lat + h, 4) as north
  from (select e.*, 2e-2 + (c_custkey%7)*1e-2 as h, c_custkey from entity e join customer on fips = {code('c_custkey')}) q where c_custkey % 50 <> 0"""))
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "features")
    sinks.write_map_features(sinks.map_features(t.plots(), t.entity().select(F.col("fips").alias("poly"))), path)
    back = t.spark.read.schema("id string, type string, geometry struct<type:string,coordinates:array<array<array<double>>>>").json(path)
    ring = F.col("geometry.coordinates")[0]
    return back.select("id", F.size(ring).alias("corners"), F.round(F.array_min(F.transform(ring, lambda p: p[0])), 4).alias("west"),
                       F.round(F.array_max(F.transform(ring, lambda p: p[1])), 4).alias("north"))


@query("s15_file_digests", "select sha256(n_name || chr(10) || n_nationkey || chr(10)) as sha256, length(n_name || n_nationkey) + 2 as bytes from nation")
def _(t: Tables) -> DataFrame:
    """One file a nation, of two lines; its digest and size as found by reading the file."""
    from siteplan.session import scratch_path
    path = scratch_path(t.spark, "digests")
    lines = t.raw("nation").select("n_nationkey", F.concat_ws("\n", "n_name", F.col("n_nationkey").cast("string")).alias("value"))
    lines.repartition("n_nationkey").write.partitionBy("n_nationkey").text(path)
    return sinks.file_inventory(t.spark, [path]).filter("bytes > 0 and name like 'part-%'").select("sha256", F.col("bytes").cast("long").alias("bytes"))


@query("s15_file_inventory")
def _(t: Tables) -> DataFrame:
    paths = sorted(glob.glob(f"{t.dir}/*.parquet"))
    names = [p.rsplit("/", 1)[1] for p in paths]
    sizes = None
    for p, n in zip(paths, names, strict=True):
        df = t.spark.read.parquet(p)
        one = df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("name"), "rows", F.lit(len(df.columns)).alias("cols"))
        sizes = one if sizes is None else sizes.unionByName(one)
    return sinks.file_inventory(t.spark, paths).join(sizes, "name")


@query("s16_map_station_subset", with_ctes("station", then="""select name, lat, lon, dc_ports, network, is_own, is_rival,
  coalesce(open_year, 0) as open_year, fips from station where is_large or is_own"""))
def _(t: Tables) -> DataFrame:
    return sinks.map_stations(t.stations()).fillna({"open_year": 0})


# ---- projections and predicates ------------------------------------------------------------

@query("p1_membership", """select o_orderkey, o_orderstatus in ('O','F') as inside, o_orderstatus not in ('P') as outside from orders""")
def _(t: Tables) -> DataFrame:
    s = F.col("o_orderstatus")
    return t.raw("orders").select("o_orderkey", text.in_list(s, ["O", "F"]).alias("inside"), text.not_in_list(s, ["P"]).alias("outside"))


@query("p2_null_safe_positive", with_ctes("raw_station", then="select id, fast_ports from raw_station where coalesce(fast_ports,0) > 0"))
def _(t: Tables) -> DataFrame:
    return t.raw_stations().select("id", "fast_ports").filter(F.coalesce("fast_ports", F.lit(0)) > 0)


@query("p3_contains_ignoring_case", with_ctes("raw_station", then="""select id, coalesce(network ilike '%high%', false) as rival,
  coalesce(name ilike '%not a public%', false) as closed from raw_station"""))
def _(t: Tables) -> DataFrame:
    return t.raw_stations().select("id", text.contains_ci(F.col("network"), "High").alias("rival"),
                                   text.contains_ci(F.col("name"), "NOT A PUBLIC").alias("closed"))


@query("p4_prefix", with_ctes("raw_traffic", then="select fips from raw_traffic where match_status like 'No qualifying%' and fips like '00000%'"))
def _(t: Tables) -> DataFrame:
    return t.raw_traffic().filter(F.col("match_status").startswith("No qualifying") & F.col("fips").startswith("00000")).select("fips")


@query("p5_masked_update", with_ctes("traffic", then="select fips, round(fwy_vmt, 2) as fwy_vmt, round(fwy_miles, 4) as fwy_miles, has_freeway from traffic"))
def _(t: Tables) -> DataFrame:
    return rounded(t.traffic().select("fips", "fwy_vmt", "fwy_miles", "has_freeway"), {"fwy_vmt": 2, "fwy_miles": 4})


@query("p6_working_stations", with_ctes("work", then="select station_id, status, open_year_filled, open_year_imputed from work"))
def _(t: Tables) -> DataFrame:
    return loaders.working_stations(t.stations(), STATUSES, MISSING_YEAR).select("station_id", "status", "open_year_filled", "open_year_imputed")


@query("p7_floor_and_cap", "select c_custkey, greatest(c_acctbal, 0e0) as floored, least(c_acctbal, 5e3) as capped from customer")
def _(t: Tables) -> DataFrame:
    b = F.col("c_acctbal")
    return t.raw("customer").select("c_custkey", arith.floor_at(b, 0.0).alias("floored"), arith.cap_at(b, 5e3).alias("capped"))


@query("p8_range_gate", """select l_orderkey, l_linenumber, coalesce(case when l_discount between 0.02e0 and 0.08e0 then l_discount end, -1e0) as kept from lineitem""")
def _(t: Tables) -> DataFrame:
    return t.raw("lineitem").select("l_orderkey", "l_linenumber", F.coalesce(text.range_gate(F.col("l_discount"), 0.02, 0.08), F.lit(-1.0)).alias("kept"))


@query("p10_zero_guarded_ratio", with_ctes("supply", then="""select fips, year, case when dcfc_ports > 0 then
  cast(rival_ports as double) / greatest(dcfc_ports, 1) else 0e0 end as share from supply"""))
def _(t: Tables) -> DataFrame:
    return t.panel().select("fips", "year", arith.guarded_ratio(F.col("rival_ports").cast("double"), F.col("dcfc_ports")).alias("share"))


# ---- joins on keys -------------------------------------------------------------------------

@query("j1_inner_join", "select n_name, count(*) as n, cast(sum(c_custkey) as bigint) as keys from customer join nation on c_nationkey = n_nationkey group by 1")
def _(t: Tables) -> DataFrame:
    return (t.raw("customer").join(t.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy("n_name").agg(F.count("*").alias("n"), F.sum("c_custkey").alias("keys")))


@query("j2_left_join", with_ctes("entity", "station", then="""select e.fips, count(s.station_id) as stations
  from entity e left join station s on s.fips = e.fips group by e.fips"""))
def _(t: Tables) -> DataFrame:
    by = t.stations().groupBy("fips").agg(F.count("*").alias("n"))
    return t.entity().select("fips").join(by, "fips", "left").select("fips", F.coalesce("n", F.lit(0)).alias("stations"))


ALIASES = {"oldname11": "customer#000000011"}


@query("j3_name_join", "select c_custkey, c_custkey as matched from customer")
def _(t: Tables) -> DataFrame:
    left = t.raw("customer").selectExpr("c_custkey", "case when c_custkey = 11 then 'Old Name 11' else replace(upper(c_name), '#', ' # ') end as label")
    right = t.raw("customer").selectExpr("c_custkey as matched", "c_name")
    a, b = tables.match_names(left, F.col("label"), right, F.col("c_name"), ALIASES)
    quality.assert_matched(a, b, ["norm"], "label", "names")
    return a.join(b, "norm").select("c_custkey", "matched")


@query("j4_lookup", """select o_orderkey, case o_orderstatus when 'O' then 'open' when 'F' then 'filled' else 'none' end as status from orders""")
def _(t: Tables) -> DataFrame:
    names = t.spark.createDataFrame([("O", "open"), ("F", "filled")], "o_orderstatus string, label string")
    return (t.raw("orders").join(F.broadcast(names), "o_orderstatus", "left")  # two rows
            .select("o_orderkey", F.coalesce("label", F.lit("none")).alias("status")))


@query("j5_code_crosswalk", f"""with {MAPPING_SQL} select coalesce(new, fips) as fips, year, round(pop, 4) as pop from (
  select {code('c_custkey')} as fips, y.year, {POP.format(y='y.year')} as pop from customer cross join (select unnest({YEARS}) as year) y) p
  left join mapping on old = fips where old is null or new is not null""")
def _(t: Tables) -> DataFrame:
    return rounded(tables.apply_crosswalk(t.population(), _mapping(t), "fips"), {"pop": 4})


@query("j6_semi_and_anti_join", with_ctes("entity", "work", then="""select fips, exists (select 1 from work w where w.fips = e.fips and w.is_own) as has_own from entity e"""))
def _(t: Tables) -> DataFrame:
    own = t.working().filter("is_own")
    e = t.entity().select("fips")
    return (e.join(own, "fips", "left_semi").withColumn("has_own", F.lit(True))
            .unionByName(quality.unmatched(e, own, ["fips"]).withColumn("has_own", F.lit(False))))


@query("j13_dense_spine", with_ctes("spine", then="select fips, cast(year as int) as year from spine"))
def _(t: Tables) -> DataFrame:
    from checks.base import SPINE
    return dense_years(t.entity().select("fips"), SPINE)


@query("j14_point_lookup", with_ctes("station", "pop", then="""select station_id, round(coalesce(pop, -1e0), 4) as pop
  from station s left join pop p on p.fips = s.fips and p.year = s.open_year"""))
def _(t: Tables) -> DataFrame:
    st = t.stations().select("station_id", "fips", F.col("open_year").alias("year"))
    return st.join(t.population(), ["fips", "year"], "left").select("station_id", F.round(F.coalesce("pop", F.lit(-1.0)), 4).alias("pop"))


# ---- set operations and reshapes -----------------------------------------------------------

@query("u1_concatenate", """select o_custkey as key, 'o' as src from orders union all select c_custkey, 'c' from customer""")
def _(t: Tables) -> DataFrame:
    a = t.raw("orders").select(F.col("o_custkey").alias("key"), F.lit("o").alias("src"))
    return a.unionByName(t.raw("customer").select(F.lit("c").alias("src"), F.col("c_custkey").alias("key")))


@query("u2_key_sets", """select 'both' as part, count(*) as n from (select c_custkey from customer intersect select o_custkey from orders) a
  union all select 'only_customer', count(*) from (select c_custkey from customer except select o_custkey from orders) b""")
def _(t: Tables) -> DataFrame:
    c, o = t.raw("customer").select("c_custkey"), t.raw("orders").select(F.col("o_custkey").alias("c_custkey"))
    return (c.intersect(o).agg(F.lit("both").alias("part"), F.count("*").alias("n"))
            .unionByName(c.subtract(o).agg(F.lit("only_customer").alias("part"), F.count("*").alias("n"))))


@query("h1_wide_to_long", f"""select {code('c_custkey')} as fips, y.year, round({POP.format(y='y.year')}, 4) as pop
  from customer cross join (select unnest({YEARS}) as year) y""")
def _(t: Tables) -> DataFrame:
    wide = t.raw("customer").selectExpr(f"{code('c_custkey')} as fips", *[f"{POP.format(y=y)} as `{y}`" for y in YEARS])
    return wide.unpivot("fips", [str(y) for y in YEARS], "year", "pop").select("fips", F.col("year").cast("int"), F.round("pop", 4).alias("pop"))


@query("h2_long_to_wide", "select " + code("c_custkey") + " as fips, " + ", ".join(f"round({POP.format(y=y)}, 4) as pop_{y}" for y in YEARS) + " from customer")
def _(t: Tables) -> DataFrame:
    wide = t.population().groupBy("fips").pivot("year", YEARS).agg(F.first("pop"))
    return wide.select("fips", *[F.round(str(y), 4).alias(f"pop_{y}") for y in YEARS])


# ---- scalar expressions --------------------------------------------------------------------

@query("f1_text_functions", """select c_custkey, trim(concat('  ', c_name, ' ')) as trimmed, lower(c_name) as low, upper(c_mktsegment) as up,
  replace(lower(c_name), '#', '') as plain, ltrim(concat('..', c_name), '.') as stripped, lpad(cast(c_custkey as string), 10, '0') as padded,
  substring(c_name, 1, 10) as head from customer""")
def _(t: Tables) -> DataFrame:
    n = F.col("c_name")
    return t.raw("customer").select(
        "c_custkey", F.trim(F.concat(F.lit("  "), n, F.lit(" "))).alias("trimmed"), F.lower(n).alias("low"),
        F.upper("c_mktsegment").alias("up"), text.normal_name(n, {"#": ""}).alias("plain"),
        text.strip_leading(F.concat(F.lit(".."), n), ".").alias("stripped"),
        text.padded_code(F.col("c_custkey"), 10).alias("padded"), F.substring(n, 1, 10).alias("head"))


@query("f2_price_extraction", with_ctes("price", then="select l_orderkey, l_linenumber, pricing, coalesce(price_kwh, -1e0) as price_kwh from price"))
def _(t: Tables) -> DataFrame:
    rows = t.price_rows()
    return rows.select("l_orderkey", "l_linenumber", "pricing", F.coalesce(text.price_per_kwh(F.col("pricing")), F.lit(-1.0)).alias("price_kwh"))


@query("f3_lenient_date", with_ctes("raw_station", then="select id, cast(coalesce(year(try_cast(open_date as date)), 0) as int) as open_year from raw_station"))
def _(t: Tables) -> DataFrame:
    return t.raw_stations().select("id", F.coalesce(F.year(text.lenient_date(F.col("open_date"))), F.lit(0)).alias("open_year"))


@query("f4_math_functions", """select o_orderkey, round(ln(o_totalprice), 9) as ln_v, round(ln(1 + o_totalprice), 9) as log1p_v,
  round(exp(o_totalprice/1e6), 9) as exp_v, round(pow(0.5e0, o_orderkey%9), 9) as pow_v, cast(floor(o_totalprice/1e3) as bigint) as floor_v,
  round(radians(o_totalprice/1e4), 9) as rad_v from orders""")
def _(t: Tables) -> DataFrame:
    v = F.col("o_totalprice")
    return t.raw("orders").select("o_orderkey", F.round(F.ln(v), 9).alias("ln_v"), F.round(F.log1p(v), 9).alias("log1p_v"),
                                  F.round(F.exp(v / 1e6), 9).alias("exp_v"), F.round(F.pow(F.lit(0.5), F.col("o_orderkey") % 9), 9).alias("pow_v"),
                                  F.floor(v / 1e3).alias("floor_v"), F.round(F.radians(v / 1e4), 9).alias("rad_v"))


@query("f6_half_even_rounding", "select c_custkey, round_even(c_acctbal, 1) as one, round_even(c_custkey/2e0, 0) as whole from customer")
def _(t: Tables) -> DataFrame:
    return t.raw("customer").select("c_custkey", arith.half_even(F.col("c_acctbal"), 1).alias("one"),
                                    arith.half_even(F.col("c_custkey") / 2.0, 0).alias("whole"))


@query("f7_null_handling", with_ctes("raw_station", then="""select id, coalesce(network, 'Unknown') as network, coalesce(fast_ports, 0) as ports,
  open_date is null as undated from raw_station"""))
def _(t: Tables) -> DataFrame:
    return t.raw_stations().select("id", F.coalesce("network", F.lit("Unknown")).alias("network"),
                                   F.coalesce("fast_ports", F.lit(0)).alias("ports"), F.col("open_date").isNull().alias("undated"))
