import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from siteplan.functions.transforms import FEATURES
from siteplan.operators import metrics as mt
from siteplan.plans import forest, l1path, models
from siteplan.plans.l1path import Fold


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    n = 1500
    x = rng.normal(size=(n, len(FEATURES)))
    x[:, 3] = 2.0  # never varies
    x[:, 5] = x[:, 4] + rng.normal(scale=0.1, size=n)
    p = 1 / (1 + np.exp(-(0.9 * x[:, 0] - 0.7 * x[:, 6] - 0.8)))
    y = (rng.random(n) < p).astype(float)
    data = [(f"{i:05d}", int(i % 7), 2021 + i % 4, float(y[i]), *map(float, x[i])) for i in range(n)]
    return spark.createDataFrame(data, "fips string, state int, year int, y double, " + ", ".join(f"{f} double" for f in FEATURES)).cache()


def test_l1_grid_equals_library_solver(rows):
    sc = models.Scaler.fit(rows)
    dealt = models.stratified_folds(rows)
    xs = dealt.select(F.array(*[sc.column(f) for f in FEATURES], F.lit(1.0)).alias("xs"), "y", "fold", F.lit(0).alias("part")).cache()
    grid = [0.01, 1.0]
    fits = l1path.l1_grid(xs, len(FEATURES), [(Fold(0, 0), c) for c in grid] + [(Fold(0, -1), 0.05)])
    assert all(f.converged for f in fits)
    for held, c, fit in [(0, 0.01, fits[0]), (0, 1.0, fits[1]), (-1, 0.05, fits[2])]:
        b0, b = fit.intercept, fit.coefficients
        part = sc.apply(dealt.filter(F.col("fold") != held)).select("x", "y")
        m = LogisticRegression(featuresCol="x", labelCol="y", regParam=1 / (c * part.count()), elasticNetParam=1.0,
                               standardization=False, maxIter=500, tol=1e-10).fit(part)
        assert np.allclose(m.coefficients.toArray(), b, atol=2e-3) and m.intercept == pytest.approx(b0, abs=2e-3)


def test_unconverged_cells_are_flagged(rows, monkeypatch):
    sc = models.Scaler.fit(rows)
    xs = models.stratified_folds(rows).select(F.array(*[sc.column(f) for f in FEATURES], F.lit(1.0)).alias("xs"), "y", "fold", F.lit(0).alias("part")).cache()
    monkeypatch.setattr(l1path, "MAX_PASSES", 1)
    assert not l1path.l1_grid(xs, len(FEATURES), [(Fold(0, -1), 1.0)])[0].converged
    assert not models.fit_logit(rows).extra["converged"]
    with pytest.raises(RuntimeError, match="converge"):
        models.fit_lasso(rows, grid=[1.0], folds=2)


def test_both_parts_in_one_grid_equal_each_alone(rows):
    a, b = rows.filter("state < 4"), rows.filter("state >= 2")
    for both, one in ((models.fit_lassos([a, b], [0.1, 1.0], 3), [models.fit_lasso(x, [0.1, 1.0], 3) for x in (a, b)]),
                      (models.fit_logits([a, b]), [models.fit_logit(x) for x in (a, b)])):
        for x, y in zip(both, one, strict=True):
            assert np.allclose(x.coefficients, y.coefficients, atol=1e-8) and x.intercept == pytest.approx(y.intercept, abs=1e-8)
            assert x.extra.get("C") == y.extra.get("C")


def test_shared_logit_equals_library_solver(rows):
    lib = {r["feature"]: r for r in models.library_coefficients(rows).collect()}
    own = {r["feature"]: r for r in models.coefficient_table(rows).collect()}
    assert set(lib) == set(own)
    for f, r in own.items():
        assert r["coef"] == pytest.approx(lib[f]["coef"], abs=1e-5)
        assert r["se"] == pytest.approx(lib[f]["se"], rel=1e-5) and r["p_value"] == pytest.approx(lib[f]["p_value"], abs=1e-6)
    # A fold's fit equals a fit on the other rows.
    dealt = models.stratified_folds(rows)
    fold = models.fit_logits([dealt], [Fold(0, 2)])[0]
    rest = models.fit_logit(dealt.filter("fold <> 2").drop("fold"))
    some = rows.limit(200)
    gap = fold.score(some, "a").select("fips", "a").join(rest.score(some, "b").select("fips", "b"), "fips").agg(F.max(F.abs(F.col("a") - F.col("b")))).first()[0]
    assert gap < 1e-6


def test_state_intervals_equal_plain_sums(rows):
    train = rows.filter("year < 2023")
    table = {r["feature"]: r for r in models.coefficient_table(train).collect()}
    data = train.toPandas()
    keep = [f for f in FEATURES if f in table]
    x = np.column_stack([*[(data[f] - data[f].mean()) / data[f].std() for f in keep], np.ones(len(data))])
    y, b = data["y"].to_numpy(), np.zeros(len(keep) + 1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ b))
        info = (x * (p * (1 - p))[:, None]).T @ x
        b = b + np.linalg.solve(info, x.T @ (y - p))
    slopes = np.stack([(x * (y - p)[:, None])[data["state"] == s].sum(axis=0) for s in sorted(set(data["state"]))])
    inv = np.linalg.inv(info)
    want = np.sqrt(np.diag(inv @ slopes.T @ slopes @ inv))
    for i, f in enumerate(keep):
        assert table[f]["coef"] == pytest.approx(b[i], abs=1e-5) and table[f]["state_se"] == pytest.approx(want[i], rel=1e-4)


def plain_split(bins, y, w, least):
    """(loss, feature, bin) of the best split, by trying all."""
    def impurity(m):
        n, p = w[m].sum(), (w[m] * y[m]).sum()
        return p * (n - p) / n
    best = None
    for f in range(bins.shape[1]):
        for c in range(bins[:, f].max()):
            right = bins[:, f] > c
            if w[right].sum() >= least and w[~right].sum() >= least:
                loss = impurity(right) + impurity(~right)
                if best is None or loss < best[0] - 1e-9:
                    best = (loss, f, c)
    return best


def test_tree_splits_equal_brute_force():
    rng = np.random.default_rng(1)
    bins = rng.integers(0, 12, (400, 5)).astype(np.uint8)
    y = (rng.random(400) < 0.2 + 0.5 * (bins[:, 2] > 6) * (bins[:, 4] > 3)).astype(np.uint8)
    w = rng.integers(0, 3, 400)
    t = forest.grow_tree(bins, y, w, np.random.default_rng(0), tried=5, least=20)
    rows_of = {0: np.flatnonzero(w)}
    for i in range(len(t.feature)):
        r = rows_of[i]
        assert w[r].sum() >= 20 and t.value[i] == pytest.approx((w[r] * y[r]).sum() / w[r].sum())
        want = plain_split(bins[r], y[r], w[r], 20)
        if t.feature[i] < 0:
            pure = (w[r] * y[r]).sum() * (w[r] * (1 - y[r])).sum() / w[r].sum()
            assert want is None or want[0] > pure - 1e-6
            continue
        right = bins[r, t.feature[i]] > t.cut[i]
        rows_of[t.left[i]], rows_of[t.left[i] + 1] = r[~right], r[right]
        got = sum((w[m] * y[m]).sum() * (w[m] * (1 - y[m])).sum() / w[m].sum() for m in (r[~right], r[right]))
        assert got == pytest.approx(want[0])
    leaf = t.leaves(bins)
    for i, r in rows_of.items():
        if t.feature[i] < 0:
            assert (leaf[r] == t.value[i]).all()
    again = forest.Tree.of(*t.blobs())
    assert np.allclose(again.leaves(bins), leaf, atol=1e-6)


def test_forest_is_as_good_as_the_library(rows):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    train, test = rows.filter("year < 2024"), rows.filter("year = 2024")
    own = models.fit_forest(train, trees=60).score(test).select("fips", "y", "p")
    build = VectorAssembler(inputCols=FEATURES, outputCol="x")
    lib = RandomForestClassifier(featuresCol="x", labelCol="y", numTrees=60, minInstancesPerNode=20, featureSubsetStrategy="0.5", maxDepth=30,
                                 maxBins=32, seed=1).fit(build.transform(train)).transform(build.transform(test))
    lib = lib.select("fips", vector_to_array("probability")[1].alias("q"))
    both = own.join(lib, "fips").cache()
    a, b = (mt.roc_auc(both, "y", c).first()[0] for c in "pq")
    assert a > b - 0.02 and both.agg(F.corr("p", "q")).first()[0] > 0.95


def test_held_out_labels_change_nothing(rows):
    """Trees of a fold do not see its labels; all folds come from one job."""
    dealt = models.stratified_folds(rows).cache()
    other = dealt.withColumn("y", F.when(F.col("fold") == 1, 1 - F.col("y")).otherwise(F.col("y")))
    folds = [Fold(0, 0), Fold(0, 1)]
    a, b = ({(r["fit"], r["tree"]): bytes(r["cut"]) for r in forest.grow([d], folds, 6).table.collect()} for d in (dealt, other))
    assert all((a[k] == b[k]) == (k[0] == 1) for k in a) and len(a) == 12


def test_held_out_scores_cover_every_row_once(rows):
    years = models.Years([2021, 2022], 2023, [2021, 2022, 2023], 2024, 2025)
    got = models.held_out_scores({"A": rows, "B": rows.filter("state < 6")}, years, folds=3, trees=10)
    n = {(r["target"], r["model"]): r["n"] for r in got.groupBy("target", "model").agg(F.count("*").alias("n")).collect()}
    want = {"A": rows.filter("year < 2024").count(), "B": rows.filter("year < 2024 and state < 6").count()}
    assert n == {(t, m): want[t] for t in "AB" for m in ("logit", "forest")}
    for r in models.grouped_cv(got).collect():
        assert 0.6 < r["min_auc"] <= r["mean_auc"] <= r["max_auc"] < 0.95


def test_forest_does_not_depend_on_input_files(rows):
    a, b = (models.fit_forest(r, trees=5).score(rows).agg(F.sum("p")).first()[0] for r in (rows.coalesce(1), rows.repartition(7)))
    assert a == pytest.approx(b, rel=1e-9)


def test_stratified_folds(rows):
    by = models.stratified_folds(rows).groupBy("fold").agg(F.sum("y").alias("p"), F.count("*").alias("n")).collect()
    assert max(r["p"] for r in by) - min(r["p"] for r in by) <= 1 and max(r["n"] for r in by) - min(r["n"] for r in by) <= 2


def test_models_recover_the_signal(rows):
    train, test = rows.filter("year < 2024"), rows.filter("year = 2024")
    lasso = models.fit_lasso(train)
    kept = {r["feature"] for r in models.kept_features(models.linear_coefficients(rows.sparkSession, lasso)).collect()}
    assert {FEATURES[0], FEATURES[6]} <= kept
    table = {r["feature"]: r for r in models.coefficient_table(train).collect()}
    assert FEATURES[3] not in table and table[FEATURES[0]]["p_value"] < 1e-3
    assert table[FEATURES[0]]["ci_lo"] < table[FEATURES[0]]["odds_ratio_per_sd"] < table[FEATURES[0]]["ci_hi"]
    assert models.solver_agreement(train, test).first()["agree"]
    forest = models.fit_forest(train, trees=30)
    imp = {r["feature"]: r["importance"] for r in models.permutation_importance(forest, test, 2).collect()}
    assert sorted(imp, key=imp.get)[-2:] in ([FEATURES[0], FEATURES[6]], [FEATURES[6], FEATURES[0]])
    p = forest.score(test).agg(F.min("p"), F.max("p")).first()
    assert 0 <= p[0] <= p[1] <= 1


def test_group_folds_balance(rows):
    out = models.group_folds(rows, "state", 5)
    load = [sum(n for _, n, f in out if f == i) for i in range(5)]
    assert len(out) == 7 and sum(load) == rows.count() and out[0][1] >= out[-1][1]


def test_borrowed_bins_are_scored_like_changed_rows():
    rng = np.random.default_rng(2)
    bins = rng.integers(0, 32, (20_000, 6)).astype(np.uint8)
    y = (rng.random(len(bins)) < 0.1 + 0.02 * (bins[:, 1] > bins[:, 4])).astype(np.uint8)
    t = forest.grow_tree(bins, y, rng.integers(0, 3, len(bins)), np.random.default_rng(0), tried=3)
    other = bins[rng.permutation(len(bins))]
    got = t.borrowed(bins, other)
    assert len(t.feature) > 100
    for j in range(6):
        changed = bins.copy()
        changed[:, j] = other[:, j]
        assert (got[:, j] == t.leaves(changed)).all()
    alone = forest.grow_tree(bins[:0], y[:0], y[:0], np.random.default_rng(0), tried=3)
    assert alone.borrowed(bins, other).shape == bins.shape and len(alone.leaves(bins[:0])) == 0


def test_trees_are_sent_in_bounded_runs(rows, monkeypatch):
    class Plain:  # scores every copy as a row of its own
        def __init__(self, fit):
            self.score = fit.score

    fit, test = models.fit_forest(rows.filter("year < 2024"), trees=12), rows.filter("year = 2024")
    whole = {r["fips"]: r["p"] for r in fit.score(test).collect()}
    want = {(r["feature"], r["rep"], r["fips"]): r["p"] for r in models.shuffled_scores(Plain(fit), test, 2).collect()}
    monkeypatch.setattr(forest, "SENT_BYTES", 1 << 11)
    sent = []
    real = type(rows.sparkSession.sparkContext).broadcast
    monkeypatch.setattr(type(rows.sparkSession.sparkContext), "broadcast", lambda self, v: sent.append(sum(len(b) for t in v for b in t)) or real(self, v))
    assert {r["fips"]: r["p"] for r in fit.score(test).collect()} == whole
    assert len(sent) > 1 and max(sent) <= 1 << 11
    got = {(r["feature"], r["rep"], r["fips"]): r["p"] for r in models.shuffled_scores(fit, test, 2).collect()}
    assert got == want and len(got) == (1 + 2 * len(FEATURES)) * len(whole)
    assert fit.score(test.filter("false")).collect() == []
