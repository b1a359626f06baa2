import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siteplan.functions import text
from siteplan.operators import quality
from siteplan.plans import clusters, panel, supply
from siteplan.sources import loaders, sinks, tables


def test_price_text(spark):
    rows = [("$0.48 per kWh",), ("$0.50/kWh + $1 connection",), ("$4 per hour",), (None,), ("$ 0.30 PER KWH",), ("$9/kWh",)]
    df = spark.createDataFrame(rows, "t string")
    assert [r[0] for r in df.select(text.price_per_kwh(F.col("t"))).collect()] == [0.48, 0.50, None, None, 0.30, None]


def test_codes_and_names(spark):
    df = spark.createDataFrame([(" 37063 ", "LaSalle"), ("7", "La Salle"), ("x", None)], "c string, n string")
    rows = df.select(text.padded_code(F.col("c"), 5), text.normal_name(F.col("n"))).collect()
    assert [tuple(r) for r in rows] == [("37063", "lasalle"), ("00007", "lasalle"), (None, None)]


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match=r"file: missing columns \['b'\]"):
        quality.require_columns(spark.createDataFrame([(1,)], "a int"), ["a", "b"], "file")


KEYS = "county_key string, fips string, state string, county_name string"


def test_crosswalk(spark):
    m = tables.crosswalk_table(spark, {"00001": ("00011", "New One", "One")},
                               {"00002": [("00021", "Two A", "A"), ("00022", "Two B", "B")]}, ["00003"])
    raw = spark.createDataFrame([(" One ", "1", "S", "o"), ("Two", "2", "S", "t"), ("Three", "3", "S", "h"), ("Four", "4", "S", "f")], KEYS)
    got = {r["fips"]: r["county_key"] for r in tables.county_keys(raw, m, expected=4).collect()}
    assert got == {"00011": "New One", "00021": "Two A", "00022": "Two B", "00004": "Four"}
    with pytest.raises(ValueError, match="4 rows, expected 5"):
        tables.county_keys(raw, m, expected=5)


def test_population_reports_unmatched_names(spark):
    keys = spark.createDataFrame([("00001", "La Salle, X")], "fips string, county_key string")
    raw = spark.createDataFrame([("title", None), (".LaSalle, X", 5.0)], "name string, `2020` double")
    assert tables.population(raw, keys, [2020]).collect() == [("00001", 2020, 5.0)]
    with pytest.raises(ValueError, match="1 unmatched rows"):
        tables.population(raw.union(spark.createDataFrame([(".Nowhere", 1.0)], raw.schema)), keys, [2020])


def test_incentive_filters_keep_null_status(spark):
    raw = spark.createDataFrame([
        ("NC", "Incentives", "ELEC|HY", "2019-05-01 00:00:00", None), ("US", "Incentives", "ELEC", "2019-05-01", "enacted"),
        ("NC", "State Incentives", "ELEC", "soon", "enacted"), ("NC", "Incentives", "ELEC", "2001-01-01", "expired"),
        ("NC", "Incentives", None, "2001-01-01", "enacted"), (None, "Incentives", "ELEC", "2001-01-01", "enacted")],
        "state string, type string, technology string, enacted string, status string")
    assert {tuple(r) for r in loaders.incentives(raw).collect()} == {("NC", 2019), ("NC", None), (None, 2001)}


def test_labels_respect_gaps_and_last_year(spark):
    rows = [("a", 2020, 0, 0), ("a", 2021, 1, 1), ("a", 2022, 1, 0), ("b", 2020, 0, 0), ("b", 2022, 1, 1)]
    df = spark.createDataFrame(rows, "fips string, year int, large_sites int, new_large_sites_t int")
    got = {(r["fips"], r["year"]): (r["y_new_site"], r["y_first_site"]) for r in panel.next_year_labels(df, 2021).collect()}
    assert got == {("a", 2020): (1.0, 1.0), ("a", 2021): (0.0, None), ("a", 2022): (None, None),
                   ("b", 2020): (None, None), ("b", 2022): (None, None)}


def test_supply_counts_from_the_opening_year(spark):
    st = spark.createDataFrame([("a", 2019, 4, True, False, True), ("a", 2021, 2, False, True, False)],
                               "fips string, open_year_filled int, dc_ports int, is_large boolean, is_rival boolean, is_own boolean")
    areas = spark.createDataFrame([("a",), ("b",)], "fips string")
    got = {(r["fips"], r["year"]): (r["dcfc_ports"], r["large_sites"], r["rival_ports"], r["own_sites"], r["new_large_sites_t"])
           for r in supply.supply_by_year(areas, st, [2019, 2020, 2021]).collect()}
    assert got[("a", 2019)] == (4, 1, 0, 1, 1) and got[("a", 2020)] == (4, 1, 0, 1, 0)
    assert got[("a", 2021)] == (6, 1, 2, 1, 0) and got[("b", 2021)] == (0, 0, 0, 0, 0)


def test_cluster_names(spark):
    df = spark.createDataFrame([(0, 2.0, 2.0, 0.0, 0.0), (1, 0.0, 0.0, 0.0, 0.0), (2, 0.0, 0.0, 0.0, 0.0), (3, 0.0, 0.0, 0.0, -1.0)],
                               "cluster_id int, bev_per_1k double, log_pop double, log_dist_large_dcfc double, log_ports_per_1k_bev double")
    got = [r["cluster"] for r in clusters.name_clusters(df).orderBy("cluster_id").collect()]
    assert got == ["Counties in high-EV-adoption states", "Mixed", "Mixed (2)", "Small town, underserved"]


STATION = T.StructType([T.StructField("id", T.LongType()), T.StructField("status", T.StringType()), T.StructField("price", T.DoubleType())])


def test_columns_are_found_by_header(spark, tmp_path):
    wide = tmp_path / "wide.csv"
    wide.write_text('status,extra,price,id\nO,z,0.5,7\n"E, x",y,,x\n')
    got = tables.read_delimited(spark, str(wide), STATION, ["id", "status", "price"], "stations").collect()
    assert [tuple(r) for r in got] == [(7, "O", 0.5), (None, "E, x", None)]
    with pytest.raises(ValueError, match=r"stations: missing columns \['owner'\]"):
        tables.read_delimited(spark, str(wide), STATION, ["id", "owner"], "stations")
    bare = tmp_path / "bare.csv"
    bare.write_text("7,O,0.5\n")
    assert [tuple(r) for r in tables.read_delimited(spark, str(bare), STATION, ["id", "price"], "stations", header=False).collect()] == [(7, 0.5)]


def test_bad_codes_are_named(spark):
    m = tables.crosswalk_table(spark, {}, {}, [])
    raw = spark.createDataFrame([("One", "1", "S", "o"), ("Two", "x2", "S", "t"), ("Three", None, "S", "h")], KEYS)
    with pytest.raises(ValueError, match=r"fips must be whole numbers, found \[None, 'x2'\]"):
        tables.county_keys(raw, m, expected=None)


def test_traffic_codes_are_padded(spark):
    raw = spark.createDataFrame([("7", "Matched", 5.0, 2.0, 1.0), ("9001", "Matched", 1.0, 1.0, 1.0)],
                                "fips string, match_status string, fwy_vmt double, fwy_miles double, interstate_miles double")
    over = spark.createDataFrame([("9001", 8.0, 3.0)], "fips string, final_vmt double, final_miles double")
    got = {r["fips"]: (r["fwy_vmt"], r["traffic_imputed"]) for r in loaders.traffic(raw, over, tables.crosswalk_table(spark, {}, {}, [])).collect()}
    assert got == {"00007": (5.0, False), "09001": (8.0, True)}
    with pytest.raises(ValueError, match="traffic: missing columns"):
        loaders.traffic(raw.drop("fwy_miles"), over, tables.crosswalk_table(spark, {}, {}, []))


def test_several_shells_and_holes(spark):
    def square(poly, ring, x, y, side):
        c = [(x, y), (x + side, y), (x + side, y + side), (x, y + side)]
        return [(poly, ring, k, *c[k], *c[(k + 1) % 4]) for k in range(4)]

    rows = [*square("a", 0, 0.0, 0.0, 10.0), *square("a", 1, 2.0, 2.0, 6.0), *square("a", 2, 4.0, 4.0, 1.0),
            *square("a", 3, 20.0, 0.0, 5.0), *square("b", 0, 0.0, 20.0, 9.0), *square("b", 1, 1.0, 21.0, 1.0)]
    edges = spark.createDataFrame(rows, "poly string, ring int, seq int, x1 double, y1 double, x2 double, y2 double")
    got = {r.id: json.loads(r.value)["geometry"] for r in sinks.map_features(edges, edges.select("poly").distinct()).collect()}
    assert [got[p]["type"] for p in "ab"] == ["MultiPolygon", "Polygon"]
    assert [[ring[0] for ring in part] for part in got["a"]["coordinates"]] == [[[0.0, 0.0], [2.0, 2.0]], [[4.0, 4.0]], [[20.0, 0.0]]]
    assert [ring[0] for ring in got["b"]["coordinates"]] == [[0.0, 20.0], [1.0, 21.0]]
    assert all(ring[0] == ring[-1] for part in got["a"]["coordinates"] for ring in part)


def test_digest_of_a_file_above_two_gigabytes(spark, tmp_path):
    """A sparse file: three gigabytes of zeros, which no cell of a table could hold."""
    import hashlib

    from siteplan.sources import sinks
    size = 3_000_000_000
    with open(tmp_path / "large file%20.bin", "wb") as f:
        f.truncate(size)
    (tmp_path / "small.txt").write_text("abc")
    (tmp_path / "empty").write_text("")
    code = hashlib.sha256()
    block = bytes(1_000_000)
    for _ in range(size // len(block)):
        code.update(block)
    got = {r["name"]: (r["sha256"], r["bytes"]) for r in sinks.file_inventory(spark, [str(tmp_path)]).collect()}
    assert got == {"large file%20.bin": (code.hexdigest(), size),
                   "small.txt": ("ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad", 3)}  # no row for the empty file


def test_checks_are_counted_while_writing(spark, tmp_path):
    from pyspark.sql import functions as F

    from siteplan.operators import quality
    df = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("v")).repartition(5)
    table, seen = quality.write_checked(df, str(tmp_path / "t"), {"rows": F.lit(True), "large": F.col("v") > 500}, ["v"])
    plain = table.agg(F.count("*"), F.count_if(F.col("v") > 500), F.count_if(F.col("v").isNull())).first()
    assert seen == {"rows": 1000, "large": plain[1], "null_v": plain[2]} and plain[0] == 1000
    empty = quality.write_checked(df.limit(0), str(tmp_path / "e"), {"rows": F.lit(True)})[1]
    assert empty == {"rows": 0}
