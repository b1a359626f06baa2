"""Registry and the roles the given tables play.

A role is a table the jobs expect (areas, stations, population ...). Its columns are written once
as expressions that both engines read, so both sides start from the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteplan.functions.geo import EARTH_RADIUS_MI
from siteplan.plans.models import Years
from siteplan.plans.panel import Inputs, build_panel
from siteplan.plans.supply import dense_years
from siteplan.session import stage
from siteplan.sources.loaders import working_stations

YEARS = list(range(1995, 2001))
SNAPSHOT = 2001  # orders stop in August 2001: the partial year
SPINE = [*YEARS, SNAPSHOT]
MODEL_YEARS = Years(train=[1996, 1997, 1998], test=1999, final=[1996, 1997, 1998, 1999], latest=2000, snapshot=SNAPSHOT)
LARGE_PORTS = 11
MISSING_YEAR = 1990
OWN, RIVAL = "1-URGENT", "2-HIGH"
STATUSES = ["O", "F"]


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[Tables], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        REGISTRY[name] = Query(name, fn, sql)
        return fn
    return add


def code(expr: str) -> str:
    return f"lpad(cast({expr} as string), 10, '0')"


ENTITY = [
    f"{code('c_custkey')} as fips", "c_name as county_key", "c_mktsegment as county_name", "c_nationkey as state",
    "25e0 + cast((c_custkey*7919)%24000 as double)/1e3 as cent_lat",
    "-120e0 + cast((c_custkey*104729)%50000 as double)/1e3 as cent_lon",
    "cast(50+(c_custkey*37)%950 as double) as area_sqmi"]
POP = "(1e3 + (c_custkey*7919)%90000) * (1e0 + (((c_custkey+{y})%11)-3)/1e2)"
STATION = [
    "o_orderkey as station_id", f"{code('o_custkey')} as fips",
    "concat('Site ', cast(o_orderkey as string), case when o_orderkey%97=0 then ' - Not a Public station' else '' end) as name",
    "cast(o_custkey%25 as int) as state", "o_orderstatus as status", "o_orderpriority as network",
    "cast(1 + o_orderkey%12 as int) as dc_ports", f"(1 + o_orderkey%12) >= {LARGE_PORTS} as is_large",
    f"o_orderpriority = '{OWN}' as is_own", f"o_orderpriority = '{RIVAL}' as is_rival",
    "o_orderkey%97 = 0 as non_public_flag",
    "case when o_orderkey%101=0 then null else cast(year(o_orderdate) as int) end as open_year",
    "25e0 + cast((o_orderkey*6151)%24000 as double)/1e3 as lat",
    "-120e0 + cast((o_orderkey*92821)%50000 as double)/1e3 as lon"]
RAW_STATION = [
    "cast(o_orderkey as string) as id",
    "concat('Site ', cast(o_orderkey as string), case when o_orderkey%97=0 then ' - Not a Public station' else '' end) as name",
    "cast(o_custkey%25 as string) as state",
    "25e0 + cast((o_orderkey*6151)%24000 as double)/1e3 as latitude",
    "-120e0 + cast((o_orderkey*92821)%50000 as double)/1e3 as longitude",
    "case when o_orderkey%13=0 then null when o_orderkey%17=0 then 0 else cast(1 + o_orderkey%12 as int) end as fast_ports",
    "case when o_orderkey%19=0 then null else o_orderpriority end as network", "o_orderstatus as status",
    "case when o_orderkey%101=0 then null when o_orderkey%103=0 then 'not a date' "
    "else cast(cast(o_orderdate as date) as string) end as open_date",
    "case when o_orderkey%7=0 then null else concat('$0.', cast(10+o_orderkey%90 as string), ' per kWh') end as pricing",
    "case when o_orderkey%3=0 then 'NEVI' else null end as funding"]
PRICE_TEXT = ("concat('$0.', lpad(cast(l_suppkey%100 as string),2,'0'), case l_linenumber%3 when 0 then '/kWh' "
              "when 1 then ' per kWh' else ' per hour' end)")
INCENTIVE = ["s_nationkey as state", "cast(case when s_suppkey%3=0 then null else 1990+s_suppkey%12 end as int) as enacted_year"]
TRAFFIC = ["cast(coalesce(vmt,0e0) as double)"]
SCORED = ["o_orderkey as id", "case when o_totalprice > 250000e0 then 1 else 0 end as y",
          "cast((o_orderkey*7919)%1000 as double)/1e3 as p"]
TILE = {"x0": "-120e0 + 10e0*(n_nationkey%5)", "y0": "25e0 + 4.8e0*floor(n_nationkey/5e0)"}


def rect(x0: str, y0: str, x1: str, y1: str, key: str) -> list[str]:
    return [f"{key} as poly", f"{x0} as x0", f"{y0} as y0", f"{x1} as x9", f"{y1} as y9"]


def tile(inset: float) -> list[str]:
    return rect(f"{TILE['x0']} + {inset}e0", f"{TILE['y0']} + {inset}e0", f"{TILE['x0']} + 10e0 - {inset}e0",
                f"{TILE['y0']} + 4.8e0 - {inset}e0", "n_nationkey")


HALF = "(2e-2 + (c_custkey%7)*1e-2)"
PLOT = rect(f"cent_lon - {HALF}", f"cent_lat - {HALF}", f"cent_lon + {HALF}", f"cent_lat + {HALF}", "fips")
CORNERS = [("x0", "y0", "x9", "y0"), ("x9", "y0", "x9", "y9"), ("x9", "y9", "x0", "y9"), ("x0", "y9", "x0", "y0")]


def edges_of(rects: DataFrame) -> DataFrame:
    """Four directed edges per rectangle, with their place in the ring."""
    return rects.select("poly", F.lit(0).alias("ring"), F.inline(F.array(*[
        F.struct(F.lit(i).alias("seq"), *[F.col(c).alias(n) for c, n in zip(e, ("x1", "y1", "x2", "y2"), strict=True)])
        for i, e in enumerate(CORNERS)])))


class Tables:
    """The given tables and their roles for one session and folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def entity(self) -> DataFrame:
        return self.raw("customer").selectExpr(*ENTITY)

    def population(self) -> DataFrame:
        return (dense_years(self.raw("customer"), YEARS)
                .selectExpr(f"{code('c_custkey')} as fips", "year", f"{POP.format(y='year')} as pop"))

    def stations(self) -> DataFrame:
        return self.raw("orders").selectExpr(*STATION)

    def working(self) -> DataFrame:
        return working_stations(self.stations(), STATUSES, MISSING_YEAR)

    def raw_stations(self) -> DataFrame:
        return self.raw("orders").selectExpr(*RAW_STATION)

    def raw_traffic(self) -> DataFrame:
        sums = (self.raw("lineitem").join(self.raw("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
                .groupBy("o_custkey").agg(F.sum("l_extendedprice").alias("fwy_vmt"),
                                          (F.sum("l_quantity") / 10).alias("fwy_miles"),
                                          (F.sum(F.when(F.col("l_linenumber") <= 2, F.col("l_quantity"))) / 10)
                                          .alias("interstate_miles")))
        return (self.raw("customer").join(sums, F.col("c_custkey") == F.col("o_custkey"), "left")
                .selectExpr(f"{code('c_custkey')} as fips",
                            "case when c_custkey%5=0 then 'No qualifying roads' else 'Matched' end as match_status",
                            "coalesce(fwy_vmt,0e0) as fwy_vmt", "coalesce(fwy_miles,0e0) as fwy_miles",
                            "coalesce(interstate_miles,0e0) as interstate_miles"))

    def traffic(self) -> DataFrame:
        zero = F.col("match_status").startswith("No qualifying")
        cols = {c: F.when(zero, 0.0).otherwise(F.col(c)) for c in ("fwy_vmt", "fwy_miles", "interstate_miles")}
        return (self.raw_traffic().withColumns(cols).drop("match_status")
                .withColumns({"traffic_imputed": F.lit(False), "has_freeway": F.col("fwy_miles") > 0}))

    def registrations(self) -> DataFrame:
        return self.raw("nation").selectExpr("n_nationkey as state", "1e3*(1+n_nationkey) as bev_regs")

    def electricity(self) -> DataFrame:
        return self.raw("nation").selectExpr("n_nationkey as state", "8e0 + n_nationkey%7 as elec_price_c_kwh")

    def incentives(self) -> DataFrame:
        return self.raw("supplier").selectExpr(*INCENTIVE)

    def price_rows(self) -> DataFrame:
        return (self.raw("lineitem").join(self.raw("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
                .selectExpr("l_orderkey", "l_linenumber", "s_nationkey as state", f"{PRICE_TEXT} as pricing"))

    def scored(self) -> DataFrame:
        return self.raw("orders").selectExpr(*SCORED)

    def tiles(self, inset: float = 0.0) -> DataFrame:
        return edges_of(self.raw("nation").selectExpr(*tile(inset)))

    def plots(self) -> DataFrame:
        """A small rectangle around every area; every 50th area has no shape."""
        return edges_of(self.raw("customer").selectExpr("*", *ENTITY).filter("c_custkey % 50 <> 0").selectExpr(*PLOT))

    def inputs(self) -> Inputs:
        return Inputs(self.entity(), self.working(), self.population(), self.traffic(), self.registrations(),
                      self.electricity(), self.incentives())

    # The panel and the models are the offline part: computed once per session and folder.
    def _once(self, name: str, make: Callable[[], object]):
        return _memo(self.spark, self.dir, name, make)

    def panel(self) -> DataFrame:
        """All years, snapshot included."""
        return self._once("panel", lambda: stage(build_panel(self.inputs(), YEARS, SNAPSHOT), "panel"))

    def components(self) -> DataFrame:
        """Snapshot rows with stand-in probabilities, percentile components and prices."""
        from siteplan.plans.prices import priced, with_prices
        from siteplan.plans.scoring import add_components

        def make() -> DataFrame:
            snap = self.panel().filter(F.col("year") == SNAPSHOT).withColumns({n: F.expr(e) for n, e in STAND_IN.items()})
            app = with_prices(add_components(snap), priced(self.price_rows()))
            return stage(app.withColumn("cluster", F.col("county_name")), "app")
        return self._once("components", make)


STAND_IN = {"p_new_site": "cast((cast(fips as bigint)*7919)%1000 as double)/1e3",
            "p_first_site": "cast((cast(fips as bigint)*6151)%1000 as double)/1e3"}

_cache: dict[tuple[str, str, str], object] = {}


def _memo(spark: SparkSession, folder: str, name: str, make: Callable[[], object]):
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _cache:
        _cache[key] = make()
    return _cache[key]


# ---- SQL side ------------------------------------------------------------------------------

def hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (f"sin(radians({lat2} - {lat1})/2)*sin(radians({lat2} - {lat1})/2) + cos(radians({lat1}))*cos(radians({lat2}))"
         f"*sin(radians({lon2} - {lon1})/2)*sin(radians({lon2} - {lon1})/2)")
    return f"(asin(least(sqrt({a}), 1e0)) * {2 * EARTH_RADIUS_MI}e0)"


def _cols(cols: list[str]) -> str:
    return ", ".join(cols)


def year_list(years: list[int]) -> str:
    return f"(select unnest({years}) as year)"


STATUS_SQL = ", ".join(f"'{s}'" for s in STATUSES)

CTES: dict[str, tuple[list[str], str]] = {
    "entity": ([], f"select {_cols(ENTITY)} from customer"),
    "pop": ([], f"select {code('c_custkey')} as fips, y.year, {POP.format(y='y.year')} as pop from customer cross join {year_list(YEARS)} y"),
    "station": ([], f"select {_cols(STATION)} from orders"),
    "work": (["station"], f"""select *, coalesce(open_year, {MISSING_YEAR}) as open_year_filled, open_year is null as open_year_imputed
        from station where status in ({STATUS_SQL}) and not non_public_flag"""),
    "raw_station": ([], f"select {_cols(RAW_STATION)} from orders"),
    "raw_traffic": ([], f"""select {code('c_custkey')} as fips,
        case when c_custkey%5=0 then 'No qualifying roads' else 'Matched' end as match_status,
        coalesce(vmt,0e0) as fwy_vmt, coalesce(miles,0e0) as fwy_miles, coalesce(inter,0e0) as interstate_miles
        from customer left join (select o_custkey, sum(l_extendedprice) as vmt, sum(l_quantity)/10 as miles,
            sum(case when l_linenumber <= 2 then l_quantity end)/10 as inter
            from lineitem join orders on l_orderkey = o_orderkey group by o_custkey) t on c_custkey = o_custkey"""),
    "traffic": (["raw_traffic"], """select fips, case when z then 0e0 else fwy_vmt end as fwy_vmt,
        case when z then 0e0 else fwy_miles end as fwy_miles, case when z then 0e0 else interstate_miles end as interstate_miles,
        false as traffic_imputed, case when z then 0e0 else fwy_miles end > 0 as has_freeway
        from (select *, starts_with(match_status, 'No qualifying') as z from raw_traffic) q"""),
    "regs": ([], "select n_nationkey as state, 1e3*(1+n_nationkey) as bev_regs from nation"),
    "elec": ([], "select n_nationkey as state, 8e0 + n_nationkey%7 as elec_price_c_kwh from nation"),
    "inc": ([], f"select {_cols(INCENTIVE)} from supplier"),
    "price_row": ([], f"""select l_orderkey, l_linenumber, s_nationkey as state, {PRICE_TEXT} as pricing
        from lineitem join supplier on l_suppkey = s_suppkey"""),
    "price": (["price_row"], r"""select *, case when v between 0.05e0 and 1.5e0 then v end as price_kwh from (select *,
        try_cast(regexp_extract(pricing, '\$\s*(\d+(?:\.\d+)?)\s*(?:/|per)\s*kwh', 1, 'i') as double) as v from price_row) q"""),
    "scored": ([], f"select {_cols(SCORED)} from orders"),
    "spine": (["entity"], f"select e.*, y.year from entity e cross join {year_list(SPINE)} y"),
    "supply": (["spine", "work"], """select s.fips, s.year,
        cast(coalesce(sum(w.dc_ports),0) as bigint) as dcfc_ports, count(w.station_id) as dcfc_sites,
        count(*) filter (where w.is_large) as large_sites,
        cast(coalesce(sum(w.dc_ports) filter (where w.is_rival),0) as bigint) as rival_ports,
        cast(coalesce(sum(w.dc_ports) filter (where w.is_own),0) as bigint) as own_ports,
        count(*) filter (where w.is_own) as own_sites,
        count(*) filter (where w.is_large and w.open_year_filled = s.year) as new_large_sites_t
        from spine s left join work w on w.fips = s.fips and w.open_year_filled <= s.year group by s.fips, s.year"""),
    "near_large": (["entity", "work"], f"""select e.fips, w.open_year_filled as y,
        min({hav('e.cent_lat', 'e.cent_lon', 'w.lat', 'w.lon')}) as miles
        from entity e cross join work w where w.is_large group by e.fips, w.open_year_filled"""),
    "near_ports": (["entity", "work"], f"""select e.fips, w.open_year_filled as y, sum(w.dc_ports) as ports
        from entity e join work w on w.lat between e.cent_lat - 1e0 and e.cent_lat + 1e0
            and {hav('e.cent_lat', 'e.cent_lon', 'w.lat', 'w.lon')} <= 50e0 group by e.fips, w.open_year_filled"""),
    "spatial": (["spine", "near_large", "near_ports"], """select s.fips, s.year,
        (select min(miles) from near_large n where n.fips = s.fips and n.y <= s.year) as dist_large_dcfc_mi,
        (select coalesce(cast(sum(ports) as double), 0e0) from near_ports n where n.fips = s.fips and n.y <= s.year) as ports_within_50mi
        from spine s"""),
    "growth": (["pop"], """select fips, year, pop, pop / lag(pop) over (partition by fips order by year) - 1 as pop_growth from pop"""),
    "rates": (["pop", "entity", "regs"], f"""select r.state, p.state_pop, bev_regs / p.state_pop * 1000 as bev_per_1k from regs r left join
        (select state, sum(pop) as state_pop from pop join entity using (fips) where year = {YEARS[-1]} group by state) p using (state)"""),
    "in_force": (["entity", "inc"], f"""select s.state, y.year, count(i.state) as ev_incentives
        from (select distinct state from entity) s cross join {year_list(SPINE)} y
        left join inc i on i.state = s.state and (i.enacted_year is null or i.enacted_year <= y.year) group by s.state, y.year"""),
    "core": (["spine", "supply", "growth", "traffic", "rates", "elec", "in_force"], f"""select s.*, u.* exclude (fips, year), g.pop, g.pop_growth,
        t.* exclude (fips), r.bev_per_1k, e.elec_price_c_kwh, f.ev_incentives,
        r.bev_per_1k * g.pop / 1000 as bev_est, g.pop / s.area_sqmi as pop_density,
        u.dcfc_ports / greatest(r.bev_per_1k * g.pop / 1000, 1e0) * 1000 as ports_per_1k_bev,
        case when u.dcfc_ports > 0 then cast(u.rival_ports as double) / greatest(u.dcfc_ports, 1) else 0e0 end as rival_share
        from spine s join supply u using (fips, year) join growth g on g.fips = s.fips and g.year = least(s.year, {YEARS[-1]})
        join traffic t on t.fips = s.fips left join rates r on r.state = s.state left join elec e on e.state = s.state
        left join in_force f on f.state = s.state and f.year = s.year"""),
    "panel": (["core"], f"""select *, case when new_large_next is null then null when new_large_next > 0 then 1e0 else 0e0 end as y_new_site,
        case when large_sites = 0 and new_large_next is not null then case when new_large_next > 0 then 1e0 else 0e0 end end as y_first_site
        from (select c.*, s.state_new_large_per_1m,
            case when c.year < {YEARS[-1]} then lead(c.new_large_sites_t) over (partition by c.fips order by c.year) end as new_large_next
            from core c join (select state, year, sum(new_large_sites_t) / sum(pop) * 1e6 as state_new_large_per_1m
                from core group by state, year) s on s.state = c.state and s.year = c.year) q"""),
    "full_panel": (["panel", "spatial"], """select p.*, s.dist_large_dcfc_mi, s.ports_within_50mi
        from panel p join spatial s using (fips, year)"""),
}


def with_ctes(*names: str, then: str) -> str:
    """Common table expressions of the named roles (with what they need), then the query."""
    seen: dict[str, str] = {}

    def add(n: str) -> None:
        deps, sql = CTES[n]
        for d in deps:
            add(d)
        seen.setdefault(n, sql)
    for n in names:
        add(n)
    return "with " + ",\n".join(f"{n} as ({s})" for n, s in seen.items()) + "\n" + then


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), d) for c, d in digits.items()})
