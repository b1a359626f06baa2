import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from siteplan.functions.geo import EARTH_RADIUS_MI, AlbersConus
from siteplan.operators import cells, polygons


def miles(a, b):
    la, lo = np.radians(a[:, None, 0]), np.radians(a[:, None, 1])
    lb, lp = np.radians(b[None, :, 0]), np.radians(b[None, :, 1])
    h = np.sin((lb - la) / 2) ** 2 + np.cos(la) * np.cos(lb) * np.sin((lp - lo) / 2) ** 2
    return 2 * EARTH_RADIUS_MI * np.arcsin(np.minimum(1, np.sqrt(h)))


def cloud(rng, n, hot):
    """Points over the globe, a tight cluster, copies of one spot, and the antimeridian."""
    wide = np.column_stack([rng.uniform(-80, 80, n), rng.uniform(-180, 180, n)])
    city = np.column_stack([rng.normal(40, 0.02, hot), rng.normal(-100, 0.02, hot)])
    same = np.tile([[40.0, -100.0]], (hot // 2, 1))
    seam = np.column_stack([rng.uniform(-5, 5, 40), np.where(rng.random(40) < .5, 1, -1) * rng.uniform(179, 180, 40)])
    return np.vstack([wide, city, same, seam])


@pytest.fixture(scope="module")
def clouds(spark):
    rng = np.random.default_rng(3)
    s, t = cloud(rng, 300, 200), cloud(rng, 1500, 900)
    since = rng.integers(2000, 2005, len(t))
    w = rng.integers(1, 9, len(t))
    src = spark.createDataFrame(pd.DataFrame({"id": range(len(s)), "lat": s[:, 0], "lon": s[:, 1]}))
    tgt = spark.createDataFrame(pd.DataFrame({"lat": t[:, 0], "lon": t[:, 1], "since": since, "weight": w}))
    return s, t, since, w, src, tgt


def test_nearest_by_year_equals_brute_force(clouds):
    s, t, since, _, src, tgt = clouds
    near = src.join(cells.nearest_since(src, tgt), ["lat", "lon"], "left").groupBy("id").agg(
        *[F.min(F.when(F.col("since") <= y, F.col("miles"))).alias(str(y)) for y in range(2000, 2005)])
    got = near.toPandas().set_index("id").sort_index()
    d = miles(s, t)
    for y in range(2000, 2005):
        assert np.allclose(got[str(y)], d[:, since <= y].min(axis=1), atol=1e-6)


def test_radius_sum_equals_brute_force(clouds):
    s, t, since, w, src, tgt = clouds
    got = (src.join(cells.weight_within_since(src, tgt, 50.0), ["lat", "lon"], "left").groupBy("id")
           .agg(*[F.coalesce(F.sum(F.when(F.col("since") <= y, F.col("weight"))), F.lit(0)).alias(str(y))
                  for y in (2000, 2002, 2004)])).toPandas().set_index("id").sort_index()
    inside = miles(s, t) <= 50
    for y in (2000, 2002, 2004):
        assert (got[str(y)].to_numpy() == (inside * (w * (since <= y))).sum(axis=1)).all()


def test_no_targets(spark):
    src = spark.createDataFrame([("a", 40.0, -100.0)], "id string, lat double, lon double")
    none = spark.createDataFrame([], "lat double, lon double, weight long")
    assert cells.nearest_miles(src, "id", none).collect() == [("a", None)]
    assert cells.weight_within(src, "id", none, 50.0).collect() == [("a", 0.0)]


def test_known_pair_of_cities(spark):
    a = spark.createDataFrame([("d", 35.994, -78.899)], "id string, lat double, lon double")
    b = spark.createDataFrame([(35.780, -78.639)], "lat double, lon double")
    assert 20 < cells.nearest_miles(a, "id", b).first()["miles"] < 24


def ring(poly, pts, n=0):
    return [(poly, n, *pts[i], *pts[(i + 1) % len(pts)]) for i in range(len(pts))]


EDGE = "poly string, ring int, x1 double, y1 double, x2 double, y2 double"


def test_holes_parts_and_first_match(spark, monkeypatch):
    edges = spark.createDataFrame(
        ring("a", [(0., 0.), (4., 0.), (4., 4.), (0., 4.)])
        + ring("a", [(1., 1.), (1., 3.), (3., 3.), (3., 1.)], 1)   # hole
        + ring("b", [(2.5, 2.5), (6., 2.5), (6., 3.5), (2.5, 3.5)])
        + ring("b", [(8., 0.), (9., 0.), (8.5, 1.)], 1), EDGE)     # second part
    pts = spark.createDataFrame([(1, .5, .5), (2, 2., 2.), (3, 2.7, 2.7), (4, 3.2, 3.6), (5, .3, 8.5),
                                 (6, .9, 8.1), (7, 3.0, 5.0)], "id int, lat double, lon double")
    want = {1: "a", 2: None, 3: "b", 4: "a", 5: "b", 6: None, 7: "b"}
    got = {r["id"]: r["poly"] for r in polygons.place_points(pts, "id", edges).collect()}
    assert got == want
    monkeypatch.setattr(polygons, "BAND_EDGES", 0)  # every band takes the join path
    got = {r["id"]: r["poly"] for r in polygons.place_points(pts, "id", edges).collect()}
    assert got == want


def squares(corners, side):
    return [e for k, (x, y) in enumerate(corners)
            for e in ring(f"p{k:06d}", [(x, y), (x + side, y), (x + side, y + side), (x, y + side)])]


def test_many_polygons_in_one_cell(spark, monkeypatch):
    """12,000 plots in one cell, some over each other, half of all points in one plot: equal to a search of all plots."""
    rng = np.random.default_rng(4)
    side = 0.004
    grid = [(10 + a / 110 * 0.9, 20 + b / 110 * 0.9) for a in range(110) for b in range(110)][:12000]
    pile = [tuple(c) for c in rng.uniform(0.4000, 0.4015, (200, 2)) + (10, 20)]  # 200 boxes over each other
    corners = np.array(grid + pile + [(-3.5, 2.25), (10.95, 20.5)])
    boxes = spark.createDataFrame(pd.DataFrame({"poly": [f"p{k:06d}" for k in range(len(corners))], "bx1": corners[:, 0], "bx2": corners[:, 0] + side,
                                                "by1": corners[:, 1], "by2": corners[:, 1] + side}))
    edges = spark.createDataFrame(pd.DataFrame(squares(corners, side), columns=["poly", "ring", "x1", "y1", "x2", "y2"]))
    at = np.vstack([rng.uniform(0, 1, (1500, 2)) + (10, 20), rng.uniform(0, side, (2000, 2)) + grid[77], rng.uniform(0.4, 0.406, (500, 2)) + (10, 20), [(-3.498, 2.252), (5, 5)]])
    pts = spark.createDataFrame(pd.DataFrame({"id": range(len(at)), "lon": at[:, 0], "lat": at[:, 1]}))
    inside = ((at[:, None, :] >= corners[None]) & (at[:, None, :] < corners[None] + side)).all(axis=2)
    want = {k: f"p{np.argmax(row):06d}" if row.any() else None for k, row in enumerate(inside)}

    leaves, splits = polygons.index_cells(boxes, 1.0)
    cells, slow = polygons.cell_shapes(edges, leaves, 1.0, True)
    assert cells.agg(F.max(F.size("shapes"))).first()[0] <= polygons.NODE_SHAPES and len(splits) >= 4
    assert 200 <= slow.select("poly").distinct().count() < 400  # only the pile and the plots under it
    for sent, part in [(polygons.SENT_CELLS, 10**6), (0, 300)]:  # cells broadcast or joined, cells whole or in parts
        monkeypatch.setattr(polygons, "SENT_CELLS", sent)
        monkeypatch.setattr(polygons, "PART_POINTS", part)
        got = polygons.place_points(pts, "id", edges)
        assert got.columns == ["id", "lon", "lat", "poly"] and {r["id"]: r["poly"] for r in got.collect()} == want


def test_snapping_in_parts_equals_whole_cells(spark, monkeypatch):
    rng = np.random.default_rng(9)
    edges = spark.createDataFrame(ring("a", [(-100.0, 40.0), (-99.0, 40.0), (-99.0, 41.0), (-100.0, 41.0)])
                                  + ring("b", [(-98.96, 40.0), (-98.0, 40.0), (-98.0, 41.0), (-98.96, 41.0)]), EDGE)
    at = np.vstack([rng.uniform(-98.999, -98.961, 3000), rng.uniform(40.40, 40.42, 3000)]).T  # one cell, between the two
    pts = spark.createDataFrame(pd.DataFrame({"id": range(3000), "lon": at[:, 0], "lat": at[:, 1]}))
    whole = {r["id"]: (r["snap_poly"], r["snap_m"]) for r in polygons.snap_points(pts, "id", edges).collect()}
    monkeypatch.setattr(polygons, "PART_POINTS", 100)
    dealt, copied, on = polygons.in_parts(pts.withColumn("gx", F.lit(1)), spark.createDataFrame([(1, "a"), (2, "b")], "gx int, poly string"), ["gx"], "id")
    assert dealt.groupBy(*on).count().agg(F.max("count")).first()[0] < 200 and copied.count() == 31
    assert {r["id"]: (r["snap_poly"], r["snap_m"]) for r in polygons.snap_points(pts, "id", edges).collect()} == whole and len(whole) == 3000


def test_snap_and_drop(spark):
    edges = spark.createDataFrame(ring("a", [(-100., 40.), (-99., 40.), (-99., 41.), (-100., 41.)])
                                  + ring("b", [(-98.9, 40.), (-98., 40.), (-98., 41.), (-98.9, 41.)]), EDGE)
    pts = spark.createDataFrame([(1, 40.5, -99.5), (2, 40.5, -98.97), (3, 40.5, -98.92), (4, 42.0, -99.5)],
                                "id int, lat double, lon double")
    got = {r["id"]: (r["poly"], r["assigned"]) for r in polygons.assign_points(pts, "id", edges).collect()}
    assert got == {1: ("a", "within"), 2: ("a", "snapped"), 3: ("b", "snapped"), 4: (None, "dropped")}


def test_measures_of_a_cell(spark):
    n = 200  # dense edges, so that the straight projected edges follow the parallels
    xs = np.linspace(-96, -95, n)
    pts = [(x, 38.) for x in xs] + [(x, 39.) for x in xs[::-1]]
    row = polygons.polygon_measures(spark.createDataFrame(ring("a", [(float(x), y) for x, y in pts]), EDGE),
                                    spark.createDataFrame([("a",), ("none",)], "poly string"),
                                    spark.createDataFrame([("none", 2.0, 38.9, -77.2)],
                                                          "poly string, area_sqmi double, cent_lat double, cent_lon double"))
    got = {r["poly"]: r for r in row.collect()}
    e = AlbersConus

    def q(lat):  # area between the equator and lat, per radian, on the ellipsoid
        return e.A ** 2 * e._q_num(lat) / 2
    exact = np.radians(1) * (q(39) - q(38)) / 2.59e6
    assert got["a"]["area_sqmi"] == pytest.approx(exact, rel=1e-5)
    assert got["a"]["cent_lon"] == pytest.approx(-95.5, abs=1e-6)
    assert got["a"]["cent_lat"] == pytest.approx(38.5, abs=0.01)
    assert got["none"]["area_sqmi"] == 2.0


def test_long_thin_polygons_are_cut_across_only(spark):
    """600 strips of ten degrees in one degree: a strip is copied to its ten cells and hardly more."""
    wide = 1 / 600
    strips = [ring(f"s{k:04d}", [(k * wide, -0.0005), ((k + 1) * wide, -0.0005), ((k + 1) * wide, 10.), (k * wide, 10.)]) for k in range(600)]
    edges = spark.createDataFrame([e for r in strips for e in r], EDGE)
    boxes = spark.createDataFrame([(f"s{k:04d}", k * wide, (k + 1) * wide, -0.0005, 9.999) for k in range(600)], "poly string, bx1 double, bx2 double, by1 double, by2 double")
    leaves, splits = polygons.index_cells(boxes, 1.0)
    assert 3 <= len(splits) <= 5 and leaves.count() < 600 * 11 * 1.5 and leaves.filter("dense or ly > 0").isEmpty()
    pts = spark.createDataFrame([(k, (k * 37 % 1000) / 100 + 0.003, (k + 0.5) * wide) for k in range(600)], "id int, lat double, lon double")
    assert {r["id"]: r["poly"] for r in polygons.place_points(pts, "id", edges).collect()} == {k: f"s{k:04d}" for k in range(600)}


def test_edges_far_from_all_points_are_not_cut_to_pieces(spark):
    edges = spark.createDataFrame(ring("a", [(-100., 40.), (-99., 40.), (-99., 41.), (-100., 41.)]), EDGE)
    none = spark.createDataFrame([], "id int, lat double, lon double")
    one = spark.createDataFrame([(1, 40.5, -98.97)], "id int, lat double, lon double")
    assert polygons.snap_points(none, "id", edges).collect() == []
    plan = polygons.snap_points(one, "id", edges)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan
    assert [(r["id"], r["snap_poly"]) for r in polygons.snap_points(one, "id", edges).collect()] == [(1, "a")]
