"""Null groups are groups like any other."""

from pyspark.sql import functions as F

from siteplan.operators import metrics
from siteplan.operators.ordering import exact_quantiles, row_numbers, top_rows


def test_row_numbers_keep_null_groups(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), ("a", 2)], "g string, v int")
    got = {(r.g, r.v): r.rn for r in row_numbers(df, [F.col("v").asc()], by=["g"]).collect()}
    assert got == {(None, 1): 1, (None, 3): 2, ("a", 2): 1}


def test_quantiles_and_metrics_keep_null_groups(spark):
    rows = [(None, i, i % 2, i / 10) for i in range(6)] + [("b", i, int(i > 2), i / 10) for i in range(6)]
    df = spark.createDataFrame(rows, "g string, k int, y int, p double")
    q = {r.g: r.q for r in exact_quantiles(df, {"p": F.col("p")}, [0.5], ["g"]).collect()}
    assert q == {None: [0.25], "b": [0.25]}
    got = {r.g: r for r in metrics.evaluate(df, "y", "p", "k", 3, ["g"]).collect()}
    assert set(got) == {None, "b"}
    assert got["b"].roc_auc == 1.0 and abs(got[None].roc_auc - 6 / 9) < 1e-12
    assert {r.g for r in metrics.calibration(df, "y", "p", 2, ["g"]).collect()} == {None, "b"}


def test_top_rows_of_any_size(spark):
    df = spark.range(100)
    assert sorted(r.id for r in top_rows(df, [F.col("id").desc()], 3).collect()) == [97, 98, 99]
    assert top_rows(df, [F.col("id").asc()], 1000).count() == 100
    assert top_rows(df, [F.col("id").asc()], 0).count() == 0
