"""Session builder and the shared scratch folder for tables written between jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_scratch: dict[str, str] = {}
_swept: set[str] = set()


def build_session(app: str = "siteplan", cpus: int | str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew-join splitting and UTC time.

    ``cpus`` sets a local master; leave it out on a cluster, where the master comes from
    spark-submit. ``shuffle_partitions`` is only an upper bound: adaptive execution merges
    small partitions.
    """
    b = (SparkSession.builder.appName(app)
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true"))
    if cpus is not None:
        b = b.master(f"local[{cpus}]").config("spark.ui.enabled", "false")
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a temporary folder.
    """
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if shared:
        folder = f"{shared.rstrip('/')}/{sc.applicationId}"
        if folder not in _swept:  # the tables of a session are deleted when its driver ends
            path = sc._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(path)
            _swept.add(folder)
        return folder
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if sc.applicationId not in _local_scratch:
        _local_scratch[sc.applicationId] = tempfile.mkdtemp(prefix="siteplan-")
    return _local_scratch[sc.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the scratch folder."""
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    This cuts the lineage, survives the loss of executors and gives the planner real sizes.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# No bucket should hold a key with more rows than one task reads well.
KEY_ROWS = 5_000_000


def bucketed(df: DataFrame, keys: list[str], buckets: int, label: str) -> DataFrame:
    """Write ``df`` to the scratch folder in ``buckets`` sorted buckets of its keys and read it back.

    Joins, aggregations and windows on the keys between tables of as many buckets need no shuffle. A bucket is read by
    one task, so a table with a key of more than ``KEY_ROWS`` rows is staged without buckets instead: there a shuffle
    with map-side combine, or a join that adaptive execution splits, is the better plan.
    """
    spark = df.sparkSession
    plain = stage(df, label)
    if not plain.groupBy(*keys).count().filter(F.col("count") > KEY_ROWS).isEmpty():
        return plain
    name = f"{label}_{uuid.uuid4().hex}"
    (plain.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", scratch_path(spark, label)).saveAsTable(name))
    return spark.table(name)
