import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from siteplan.operators import metrics as mt
from siteplan.operators import ordering


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"k": range(2000), "g": rng.integers(0, 3, 2000), "v": rng.normal(size=2000).round(1)})
    pdf.loc[rng.random(2000) < 0.35, "v"] = 0.0  # one value holds a third of the rows
    return pdf, spark.createDataFrame(pdf)


def test_percentile_rank_of_three(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0)], "k int, v double")
    got = {r["k"]: (r["up"], r["down"]) for r in
           ordering.percentile_ranks(df, "k", {"up": (F.col("v"), 1), "down": (F.col("v"), -1)}).collect()}
    assert got[1][0] == pytest.approx(1 / 3) and got[3][0] == 1 and got[1][1] > got[3][1]


def test_percentile_rank_equals_pandas(frame):
    pdf, df = frame
    got = ordering.percentile_ranks(df, "k", {"r": (F.col("v"), 1)}).toPandas().set_index("k")["r"].sort_index()
    assert np.allclose(got, pdf["v"].rank(pct=True))


def test_row_numbers_and_top(frame):
    pdf, df = frame
    got = ordering.row_numbers(df, [F.col("v").desc(), F.col("k").asc()], "rn", ["g"]).toPandas()
    want = pdf.sort_values(["v", "k"], ascending=[False, True]).assign(w=lambda d: d.groupby("g").cumcount() + 1)
    assert got.merge(want, on="k").eval("rn == w").all()
    order = [F.col("v").desc(), F.col("k").asc()]
    top = set(pdf.sort_values(["v", "k"], ascending=[False, True]).head(700)["k"])
    assert {r["k"] for r in ordering.top_rows(df, order, 700).collect()} == top


def test_quantiles_and_medians(frame):
    pdf, df = frame
    got = ordering.exact_quantiles(df, {"v": F.col("v")}, [0.1, 0.5, 0.83], ["g"]).toPandas().set_index("g")["q"]
    for g, part in pdf.groupby("g"):
        assert np.allclose(got[g], part["v"].quantile([0.1, 0.5, 0.83]))
    with_holes = df.withColumn("v", F.when(F.col("g") != 2, F.col("v")))
    m = {r["g"]: r for r in ordering.medians(with_holes, {"v": F.col("v")}, ["g"]).collect()}
    assert m[2]["v"] is None and m[2]["v_n"] == 0 and m[0]["v"] == pytest.approx(pdf[pdf.g == 0]["v"].median())


def test_ranking_metrics_equal_brute_force(frame, spark):
    pdf, _ = frame
    rng = np.random.default_rng(2)
    pdf = pdf.assign(y=(rng.random(len(pdf)) < 0.2).astype(int))
    got = mt.evaluate(spark.createDataFrame(pdf), "y", "v", "k", 50).first()
    pos, neg = pdf[pdf.y == 1]["v"].to_numpy(), pdf[pdf.y == 0]["v"].to_numpy()
    wins = (pos[:, None] > neg[None, :]).mean() + (pos[:, None] == neg[None, :]).mean() / 2
    assert got["roc_auc"] == pytest.approx(wins)
    ranked = pdf.sort_values(["v", "k"], ascending=[False, True])
    assert got["precision_at_k"] == pytest.approx(ranked["y"].head(50).mean())
    assert got["precision_at_n_positives"] == pytest.approx(ranked["y"].head(len(pos)).mean())
    assert got["precision_ranks_101_500"] == pytest.approx(ranked["y"].iloc[100:500].mean())
    ap = 0.0
    for s in np.unique(pdf["v"]):
        top = pdf[pdf["v"] >= s]
        ap += (pdf[pdf["v"] == s]["y"].sum() / len(pos)) * top["y"].mean()
    assert got["pr_auc"] == pytest.approx(ap)


def test_bins_drop_duplicate_edges(frame):
    pdf, df = frame
    got = mt.quantile_bins(df, "v", 10).toPandas().set_index("k")["bin"].sort_index()
    assert (got == pd.qcut(pdf["v"], 10, labels=False, duplicates="drop")).all()
