"""Writers: Parquet, CSV, nested JSON, map features, file inventory."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siteplan.operators.polygons import crosses

# Columns of the app table and of the station map.
APP_COLUMNS = [
    "fips", "county_key", "county_name", "state", "cent_lat", "cent_lon", "pop", "pop_growth", "bev_est",
    "bev_per_1k", "fwy_vmt", "has_freeway", "traffic_imputed", "elec_price_c_kwh", "ev_incentives", "dcfc_ports",
    "dcfc_sites", "large_sites", "rival_ports", "own_ports", "own_sites", "ports_per_1k_bev", "ports_within_50mi",
    "dist_large_dcfc_mi", "p_new_site", "p_first_site", "cluster", "dcfc_price_kwh", "price_imputed", "saturation",
]
MAP_COLUMNS = [
    "name", "lat", "lon", "dc_ports", "network", "is_own", "is_rival", "open_year", "fips",
]


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a Parquet table; a panel partitioned by year lets later filters skip files."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def app_columns(df: DataFrame, named: Sequence[str] = APP_COLUMNS, prefix: str = "c_") -> DataFrame:
    """Named columns plus every column with the prefix."""
    return df.select(*named, *[c for c in df.columns if c.startswith(prefix)])


def map_stations(st: DataFrame) -> DataFrame:
    """Large stations and own stations, display columns only."""
    return st.filter(F.col("is_large") | F.col("is_own")).select(*[c for c in MAP_COLUMNS if c in st.columns])


def metrics_documents(metrics: DataFrame) -> DataFrame:
    """Long metrics (target, section, model, metric, value) to one JSON document per target."""
    inner = metrics.groupBy("target", "section", "model").agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("m"))
    mid = inner.groupBy("target", "section").agg(
        F.map_from_entries(F.collect_list(F.struct("model", "m"))).alias("models"))
    return mid.groupBy("target").agg(F.map_from_entries(F.collect_list(F.struct("section", "models"))).alias("doc")).select(
        F.to_json(F.struct("target", "doc")).alias("value"))


def write_metrics(metrics: DataFrame, path: str) -> None:
    metrics_documents(metrics).write.mode("overwrite").text(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Back to the long table."""
    schema = "target string, doc map<string,map<string,map<string,double>>>"
    return (spark.read.schema(schema).json(path)
            .select("target", F.explode("doc").alias("section", "models"))
            .select("target", "section", F.explode("models").alias("model", "metrics"))
            .select("target", "section", "model", F.explode("metrics").alias("metric", "value")))


def _inside(at: Column, ring: Column) -> Column:
    """Is a corner inside a closed ring of corners?"""
    edges = F.sequence(F.lit(0), F.size(ring) - 2)
    hits = F.filter(edges, lambda i: crosses(at[0], at[1], ring[i][0], ring[i][1], ring[i + 1][0], ring[i + 1][1]))
    return F.size(hits) % 2 == 1


def map_features(edges: DataFrame, keys: DataFrame, digits: int = 6) -> DataFrame:
    """One GeoJSON feature per polygon as a line of text; its id is the polygon key.

    ``edges`` needs ``seq``, the position within a ring. Polygons without edges and polygons
    outside ``keys`` give no feature. A ring that lies in an even number of other rings, as told by its first corner,
    is a shell; the rings one level inside it are its holes. Several shells give a MultiPolygon, in ring order.
    """
    wanted = edges.join(keys.select("poly"), "poly", "left_semi")
    corner = F.struct("seq", F.array(F.round("x1", digits), F.round("y1", digits)).alias("at"))
    rings = wanted.groupBy("poly", "ring").agg(F.array_sort(F.collect_list(corner)).alias("corners"))
    closed = rings.select("poly", F.struct("ring", F.concat(
        F.transform("corners", lambda c: c["at"]), F.array(F.col("corners")[0]["at"])).alias("xy")).alias("r"))
    shapes = closed.groupBy("poly").agg(F.array_sort(F.collect_list("r")).alias("rings"))

    def level(r: Column) -> Column:
        around = F.filter("rings", lambda o: (o["ring"] != r["ring"]) & _inside(r["xy"][0], o["xy"]))
        return F.struct(r["xy"].alias("xy"), F.size(around).alias("level"))

    def with_holes(s: Column) -> Column:
        holes = F.filter("parts", lambda h: (h["level"] == s["level"] + 1) & _inside(h["xy"][0], s["xy"]))
        return F.concat(F.array(s["xy"]), F.transform(holes, lambda h: h["xy"]))

    def feature(kind: str, coordinates: Column) -> Column:
        geometry = F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates"))
        return F.to_json(F.struct(F.lit("Feature").alias("type"), F.col("poly").alias("id"),
                                  F.create_map().cast("map<string,string>").alias("properties"), geometry.alias("geometry")))

    parts = (shapes.withColumn("parts", F.transform("rings", level))
             .withColumn("shells", F.transform(F.filter("parts", lambda r: r["level"] % 2 == 0), with_holes)))
    return parts.select(F.col("poly").alias("id"), F.when(F.size("shells") == 1, feature("Polygon", F.col("shells")[0]))
                        .otherwise(feature("MultiPolygon", F.col("shells"))).alias("value"))


def write_map_features(features: DataFrame, path: str) -> None:
    features.select("value").write.mode("overwrite").text(path)


CHUNK = 8 << 20  # bytes of a file in memory at once


def file_inventory(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(name, sha256, bytes) per file of any size. ``paths`` are files or folders.

    Spark lists the files without reading them (empty ones it leaves out); tasks then read one file after the other, a chunk at a time. A digest is
    taken in order, so a file is never split. Tasks open local, HDFS, S3 and GCS paths.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
             .select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes")))
    count = files.count()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for path in batch.column(0).to_pylist():
                # Spark names files without escapes.
                local = re.sub("^file:/+", "/", path)
                store, at = (fs.LocalFileSystem(), local) if local != path else fs.FileSystem.from_uri(quote(path, safe=":/"))
                code = hashlib.sha256()
                with store.open_input_stream(at) as f:
                    while part := f.read(CHUNK):
                        code.update(part)
                out.append(code.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(out, pa.string()), batch.column(2)], ["name", "sha256", "bytes"])

    tasks = max(1, min(count, 4 * spark.sparkContext.defaultParallelism))
    return files.repartition(tasks).mapInArrow(digest, "name string, sha256 string, bytes long")
