"""Tables in buckets of the entity: what is planned without a shuffle, and what is not written so."""

import pytest
from pyspark.sql import functions as F

from checks.base import SNAPSHOT, YEARS, Tables
from siteplan import session
from siteplan.plans import panel, supply

FOLDER = "/root/testdata/sf0.001"


def shuffles(df):
    """Lines of the plan that shuffle by the entity alone."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning(fips" in line]


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_entity_joins_windows_and_sums_without_a_shuffle(spark, no_broadcast):
    plain = Tables(spark, FOLDER).inputs()
    stored = panel.co_located(plain, 4)
    full = panel.build_panel(stored, YEARS, SNAPSHOT)
    assert not shuffles(full) and shuffles(panel.build_panel(plain, YEARS, SNAPSHOT))
    assert not shuffles(panel.growth(stored.population)) and shuffles(panel.growth(plain.population))
    yearly = supply.supply_by_year(stored.areas, stored.stations, YEARS)
    assert not shuffles(yearly)
    kept = session.bucketed(full.select("fips", "year", "new_large_sites_t", "large_sites"), ["fips"], 4, "labels")
    assert not shuffles(panel.next_year_labels(kept, YEARS[-1] - 1))
    for name in ("areas", "stations", "population", "traffic"):
        assert getattr(stored, name).exceptAll(getattr(plain, name)).isEmpty() and getattr(stored, name).count() == getattr(plain, name).count()


def test_a_table_with_a_hot_key_gets_no_buckets(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(session, "KEY_ROWS", 50)
    hot = spark.range(100).select(F.when(F.col("id") < 60, "a").otherwise(F.col("id").cast("string")).alias("fips"), "id")
    out = session.bucketed(hot, ["fips"], 4, "hot")
    assert shuffles(out.groupBy("fips").count()) and out.exceptAll(hot).isEmpty() and out.count() == 100
    none = session.bucketed(hot.limit(0), ["fips"], 4, "none")
    assert none.count() == 0 and not shuffles(none.groupBy("fips").count())
    nulls = session.bucketed(hot.filter("id >= 60").withColumn("fips", F.when(F.col("id") % 2 == 0, F.col("fips"))), ["fips"], 4, "nulls")
    assert nulls.filter(F.col("fips").isNull()).count() == 20 and nulls.count() == 40
