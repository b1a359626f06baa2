"""Polygons, nearest targets, radius sums, great-circle distance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.base import CORNERS, PLOT, Tables, hav, query, rounded, tile, with_ctes
from siteplan.functions.geo import AlbersConus, haversine_miles
from siteplan.operators import cells, polygons


def _plain_points(t: Tables) -> DataFrame:
    return t.stations().select("station_id", "lat", "lon", "dc_ports", "is_large")


@query("f5_great_circle_distance", with_ctes("entity", "station", then=f"""select station_id, round({hav('e.cent_lat', 'e.cent_lon', 's.lat', 's.lon')}, 6) as miles
  from station s join entity e on e.fips = s.fips"""))
def _(t: Tables) -> DataFrame:
    both = t.stations().select("station_id", "fips", "lat", "lon").join(t.entity().select("fips", "cent_lat", "cent_lon"), "fips")
    return both.select("station_id", F.round(haversine_miles("cent_lat", "cent_lon", "lat", "lon"), 6).alias("miles"))


TILE_SQL = "tiles as (select {cols} from nation)"


@query("j7_point_in_polygon", with_ctes("station", then="").rstrip() + f""", tiles as (select {', '.join(tile(0.0))} from nation)
  select station_id, min(poly) as poly from station join tiles on lon >= x0 and lon < x9 and lat >= y0 and lat < y9 group by station_id""")
def _(t: Tables) -> DataFrame:
    return polygons.place_points(_plain_points(t), "station_id", t.tiles()).filter(F.col("poly").isNotNull()).select("station_id", "poly")


@query("j7_many_small_polygons", with_ctes("entity", "station", then="").rstrip() + f""", plots as (select {', '.join(PLOT)}
  from (select e.*, c_custkey from entity e join customer on c_name = county_key where c_custkey % 50 <> 0) q)
  select station_id, min(poly) as poly from station join plots on lon >= x0 and lon < x9 and lat >= y0 and lat < y9 group by station_id""")
def _(t: Tables) -> DataFrame:
    placed = polygons.place_points(_plain_points(t), "station_id", t.plots())
    return placed.filter(F.col("poly").isNotNull()).select("station_id", "poly")


A = AlbersConus
N, C, RHO0, QP = A.constants()


def albers(lat: str, lon: str) -> tuple[str, str]:
    s = f"sin(radians({lat}))"
    q = f"({1 - A.E2}e0 * ({s}/(1 - {A.E2}e0*{s}*{s}) - ln((1 - {A.E}e0*{s})/(1 + {A.E}e0*{s}))/{2 * A.E}e0))"
    rho = f"(sqrt({C}e0 - {N}e0*{q}) * {A.A / N}e0)"
    th = f"(radians({lon} - {A.LON0}e0) * {N}e0)"
    return f"({rho} * sin({th}))", f"({RHO0}e0 - {rho} * cos({th}))"


def edge_sql(source: str) -> str:
    """Projected edges of rectangles: poly, ax, ay, ex, by."""
    parts = []
    for a, b, c, d in CORNERS:
        (ax, ay), (bx, by) = albers(b, a), albers(d, c)
        parts.append(f"select poly, {ax} as ax, {ay} as ay, {bx} as ex, {by} as ey from {source}")
    return " union all ".join(parts)


MX, MY = albers("lat", "lon")


@query("j8_snap_to_polygon", with_ctes("station", then="").rstrip() + f""", tiles as (select {', '.join(tile(0.1))} from nation),
  inside as (select station_id, min(poly) as poly from station join tiles on lon >= x0 and lon < x9 and lat >= y0 and lat < y9 group by station_id),
  edges as ({edge_sql('tiles')}),
  miss as (select station_id, {MX} as mx, {MY} as my from station where station_id not in (select station_id from inside)),
  near as (select station_id, poly, min(sqrt((mx-ax-t*(ex-ax))*(mx-ax-t*(ex-ax)) + (my-ay-t*(ey-ay))*(my-ay-t*(ey-ay)))) as d
    from (select *, greatest(0e0, least(1e0, ((mx-ax)*(ex-ax) + (my-ay)*(ey-ay)) / ((ex-ax)*(ex-ax) + (ey-ay)*(ey-ay)))) as t from miss cross join edges) q
    group by station_id, poly),
  snap as (select station_id, arg_min(poly, d) as poly from near where d <= 5000 group by station_id)
  select s.station_id, coalesce(i.poly, n.poly, -1) as poly, case when i.poly is not null then 'within' when n.poly is not null then 'snapped' else 'dropped' end as assigned
  from station s left join inside i using (station_id) left join snap n using (station_id)""")
def _(t: Tables) -> DataFrame:
    out = polygons.assign_points(_plain_points(t), "station_id", t.tiles(0.1))
    return out.select("station_id", F.coalesce("poly", F.lit(-1)).alias("poly"), "assigned")


@query("j9_nearest_target", with_ctes("near_large", then="select fips, round(min(miles), 6) as miles from near_large group by fips"))
def _(t: Tables) -> DataFrame:
    e = t.entity().select("fips", F.col("cent_lat").alias("lat"), F.col("cent_lon").alias("lon"))
    return rounded(cells.nearest_miles(e, "fips", t.working().filter("is_large").select("lat", "lon")), {"miles": 6})


@query("j10_radius_sum", with_ctes("entity", "near_ports", then="""select e.fips, coalesce(cast(sum(ports) as double), 0e0) as weight
  from entity e left join near_ports n on n.fips = e.fips group by e.fips"""))
def _(t: Tables) -> DataFrame:
    e = t.entity().select("fips", F.col("cent_lat").alias("lat"), F.col("cent_lon").alias("lon"))
    return cells.weight_within(e, "fips", t.working().select("lat", "lon", F.col("dc_ports").alias("weight")), 50.0)


def _inverse_sql(x: str, y: str) -> tuple[str, str]:
    e2, e4, e6 = A.E2, A.E2 ** 2, A.E2 ** 3
    dy = f"({RHO0}e0 - {y})"
    b = f"asin(({C}e0 - ({x}*{x} + {dy}*{dy})*{(N / A.A) ** 2:.25f}) / {N}e0 / {QP}e0)"
    lat = (f"degrees({b} + sin(2*{b})*{e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040}e0 + sin(4*{b})*{23 * e4 / 360 + 251 * e6 / 3780:.20f}"
           f" + sin(6*{b})*{761 * e6 / 45360:.25f})")
    return lat, f"(degrees(atan2({x}, {dy}) / {N}e0) + {A.LON0}e0)"


INV = _inverse_sql("cx", "cy")


@query("s10_polygon_measures", with_ctes("entity", then="").rstrip() + f""", numbered as (select e.*, c_custkey from entity e join customer on c_name = county_key),
  plots as (select {', '.join(PLOT)} from numbered where c_custkey % 50 <> 0), edges as ({edge_sql('plots')}),
  sums as (select poly, abs(sum(ax*ey - ex*ay))/2/2.59e6 as area, sum((ax+ex)*(ax*ey - ex*ay))/3/sum(ax*ey - ex*ay) as cx,
    sum((ay+ey)*(ax*ey - ex*ay))/3/sum(ax*ey - ex*ay) as cy from edges group by poly)
  select fips as poly, round(coalesce(area, area_sqmi), 3) as area_sqmi, round(coalesce({INV[0]}, cent_lat), 5) as cent_lat,
    round(coalesce({INV[1]}, cent_lon), 5) as cent_lon from numbered left join sums on poly = fips""")
def _(t: Tables) -> DataFrame:
    spare = t.entity().select(F.col("fips").alias("poly"), "area_sqmi", "cent_lat", "cent_lon")
    out = polygons.polygon_measures(t.plots(), spare, spare)
    return rounded(out, {"area_sqmi": 3, "cent_lat": 5, "cent_lon": 5})
