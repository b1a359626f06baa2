"""Classifiers, temporal evaluation, grouped cross-validation and their reports on ``pyspark.ml``."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siteplan.functions.transforms import FEATURES, complete_cases, model_features
from siteplan.operators import metrics as mt
from siteplan.operators.ordering import percentile_ranks, row_numbers
from siteplan.plans.forest import TREES, ForestFit, grow
from siteplan.plans.l1path import Fold, LogitCell, clustered_scores, l1_grid, logit_grid
from siteplan.session import stage

# Targets, their cuts and the baselines.
TARGETS = {"A": "y_new_site", "B": "y_first_site"}
CUT = {"A": 100, "B": 50}
SEED = 42
BASELINES = {"rank_by_population": "log_pop", "rank_by_freeway_vmt": "log_fwy_vmt",
             "rank_by_existing_ports": "log_dcfc_ports"}


@dataclass(frozen=True)
class Years:
    train: Sequence[int]
    test: int
    final: Sequence[int]
    latest: int
    snapshot: int


# Fixed values.
DEFAULT_YEARS = Years([2021, 2022, 2023], 2024, [2021, 2022, 2023, 2024], 2025, 2026)


@dataclass(frozen=True)
class Scaler:
    """Per-feature mean and population standard deviation, applied as Column arithmetic."""

    features: list[str]
    mean: list[float]
    sd: list[float]

    @classmethod
    def fit(cls, train: DataFrame, features: Sequence[str] = FEATURES, sample: bool = False) -> Scaler:
        dev = F.stddev_samp if sample else F.stddev_pop
        row = train.agg(*[F.avg(f).alias(f"m_{f}") for f in features],
                        *[dev(f).alias(f"s_{f}") for f in features]).first()
        mean = [row[f"m_{f}"] for f in features]
        # What is left of a constant column by rounding is no deviation.
        sd = [0.0 if s is not None and s <= 1e-12 * abs(m) else s for s, m in zip((row[f"s_{f}"] for f in features), mean, strict=True)]
        return cls(list(features), mean, sd)

    def varying(self) -> Scaler:
        """Without the features that never vary."""
        keep = [i for i, s in enumerate(self.sd) if s and s > 0]
        return Scaler(*[[v[i] for i in keep] for v in (self.features, self.mean, self.sd)])

    def column(self, f: str) -> Column:
        i = self.features.index(f)
        return (F.col(f) - F.lit(self.mean[i])) / F.lit(self.sd[i] or 1.0)

    def apply(self, df: DataFrame, out: str = "x") -> DataFrame:
        """Add the standardized vector."""
        return df.withColumn(out, array_to_vector(F.array(*[self.column(f) for f in self.features])))


def training_rows(panel: DataFrame, target: str) -> DataFrame:
    """Complete cases of a target with fips, state, year, y and the features."""
    return complete_cases(model_features(panel), TARGETS[target]).select(
        "fips", "state", "year", F.col(TARGETS[target]).alias("y"), *[F.col(f).cast("double").alias(f) for f in FEATURES])


@dataclass(frozen=True)
class LinearFit:
    """A logistic model on standardized features; scoring is Column arithmetic."""

    scaler: Scaler
    intercept: float
    coefficients: list[float]
    extra: dict

    def score(self, df: DataFrame, out: str = "p") -> DataFrame:
        margin = F.lit(self.intercept)
        for f, b in zip(self.scaler.features, self.coefficients, strict=True):
            if b:
                margin = margin + self.scaler.column(f) * F.lit(b)
        return df.withColumn(out, 1.0 / (1.0 + F.exp(-margin)))


ROWS_PER_TASK = 20_000
CELL_ROWS_PER_TASK = 500_000


def compact(df: DataFrame, rows: int) -> DataFrame:
    """Fewer partitions for few rows: every step of a library solver is a job with one task per partition.

    Only ever lowers the number, so large inputs keep theirs.
    """
    return df.coalesce(max(1, math.ceil(rows / ROWS_PER_TASK)))


def solver_rows(parts: Sequence[DataFrame], cells: int) -> tuple[list[Scaler], DataFrame]:
    """(scaler of each part, cached rows of all parts with xs, y, part, fold and state) for the shared-pass solvers.

    A part without a column ``fold`` has all its rows in fold 0. A pass costs rows x cells: that work is spread, up to the
    usual number of partitions.
    """
    scalers = [Scaler.fit(p) for p in parts]
    ready = None
    for i, (p, sc) in enumerate(zip(parts, scalers, strict=True)):
        xs = F.array(*[sc.column(f) for f in sc.features], F.lit(1.0)).alias("xs")
        fold = F.col("fold").cast("int") if "fold" in p.columns else F.lit(0)
        one = p.select(xs, F.col("y").cast("double").alias("y"), F.lit(i).alias("part"), fold.alias("fold"), F.col("state").cast("string").alias("state"))
        ready = one if ready is None else ready.unionByName(one)
    spark = ready.sparkSession
    most = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ready = ready.persist()
    total = ready.count()
    dealt = ready.repartition(max(1, min(most, math.ceil(total * cells / CELL_ROWS_PER_TASK)))).persist()
    dealt.count()
    ready.unpersist()
    return scalers, dealt


def _logit(sc: Scaler, cell: LogitCell) -> LinearFit:
    return LinearFit(sc, cell.intercept, cell.coefficients, {"converged": cell.converged, "information": cell.information})


def fit_logits(parts: Sequence[DataFrame], folds: Sequence[Fold] | None = None) -> list[LinearFit]:
    """Practically unpenalized logistic regressions on standardized features, one for each of ``folds``, in shared passes.

    Without ``folds``, one on all rows of each part. ``extra`` says whether a fit has converged.
    """
    cells = [Fold(i, -1) for i in range(len(parts))] if folds is None else list(folds)
    scalers, rows = solver_rows(parts, len(cells))
    try:
        return [_logit(scalers[f.part], c) for f, c in zip(cells, logit_grid(rows, len(FEATURES), cells), strict=True)]
    finally:
        rows.unpersist()


def fit_logit(train: DataFrame) -> LinearFit:
    return fit_logits([train])[0]


C_GRID = [10 ** (-4 + 8 * i / 19) for i in range(20)]


def stratified_folds(train: DataFrame, folds: int = 5) -> DataFrame:
    """Add ``fold``: rows of each label dealt out in turn, in the order (year, fips)."""
    return (row_numbers(train, [F.col("year").asc(), F.col("fips").asc()], "_rn", ["y"])
            .withColumn("fold", ((F.col("_rn") - 1) % folds).cast("int")).drop("_rn"))


def fit_lassos(parts: Sequence[DataFrame], grid: Sequence[float] = C_GRID, folds: int = 5) -> list[LinearFit]:
    """L1 logistic regression of each part; strength with the best mean AUC over stratified folds, then a refit.

    Features are scaled once on all training rows. The grids of all parts are fitted in a few shared passes, and the
    held-out rows of all cells are scored by one join with the small table of coefficients.
    """
    spark = parts[0].sparkSession
    scalers, ready = solver_rows([stratified_folds(p, folds) for p in parts], folds * len(grid))
    width = len(FEATURES)
    try:
        cells = [(p, f, c) for p in range(len(parts)) for f in range(folds) for c in range(len(grid))]
        fits = l1_grid(ready, width, [(Fold(p, f), grid[c]) for p, f, c in cells])
        # A strength counts only if its fits of all folds have converged.
        loose = {(p, c) for (p, _, c), fit in zip(cells, fits, strict=True) if not fit.converged}
        coefs = spark.createDataFrame([(*cell, fit.intercept, fit.coefficients) for cell, fit in zip(cells, fits, strict=True)
                                       if (cell[0], cell[2]) not in loose], "part int, fold int, c int, b0 double, b array<double>")
        held = ready.join(F.broadcast(coefs), ["part", "fold"])  # one row per cell of the grid
        margin = F.aggregate(F.zip_with("xs", "b", lambda x, b: F.coalesce(x * b, F.lit(0.0))), F.col("b0"), lambda a, v: a + v)
        auc = (mt.roc_auc(held.select("part", "fold", "c", "y", margin.alias("s")), "y", "s", ["part", "fold", "c"])
               .groupBy("part", "c").agg(F.avg("roc_auc").alias("auc")).collect())  # a row for each strength
        chosen = []
        for p in range(len(parts)):
            best = min((r for r in auc if r["part"] == p), key=lambda r: (-r["auc"], r["c"]), default=None)
            if best is None:
                raise RuntimeError("no strength of the L1 grid converged on all folds")
            chosen.append(best)
        last = l1_grid(ready, width, [(Fold(p, -1), grid[r["c"]]) for p, r in enumerate(chosen)])  # on all rows
        for fit, r in zip(last, chosen, strict=True):
            if not fit.converged:
                raise RuntimeError(f"the L1 fit with C = {grid[r['c']]} did not converge")
        return [LinearFit(sc, fit.intercept, fit.coefficients, {"C": grid[r["c"]], "cv_auc": r["auc"]})
                for sc, fit, r in zip(scalers, last, chosen, strict=True)]
    finally:
        ready.unpersist()


def fit_lasso(train: DataFrame, grid: Sequence[float] = C_GRID, folds: int = 5) -> LinearFit:
    return fit_lassos([train], grid, folds)[0]


def fit_forest(train: DataFrame, trees: int = TREES) -> ForestFit:
    return grow([train], [Fold(0, -1)], trees).fit(0)


AnyFit = ForestFit | LinearFit
FITTERS: dict[str, Callable[[DataFrame], AnyFit]] = {"logit": fit_logit, "lasso": fit_lasso, "forest": fit_forest}


def fit_all(name: str, parts: Sequence[DataFrame]) -> list[AnyFit]:
    """A fit of each part, all made in the same passes."""
    if name == "forest":
        forest = grow(parts, [Fold(i, -1) for i in range(len(parts))])
        return [forest.fit(i) for i in range(len(parts))]
    return {"logit": fit_logits, "lasso": fit_lassos}[name](parts)


def baseline_scores(test: DataFrame) -> DataFrame:
    """(fips, y, model, p): test rows ranked by one column each, ties at their average rank."""
    ranks = percentile_ranks(test, "fips", {m: (F.col(c), 1) for m, c in BASELINES.items()})
    long = ranks.unpivot("fips", list(BASELINES), "model", "p")
    return test.select("fips", "y").join(long, "fips").select("fips", "y", "model", "p")


def test_scores(rows: DataFrame, years: Years, fitted: dict[str, AnyFit]) -> DataFrame:
    """(section, model, fips, y, p): the test year scored by fitted models and ranked by baselines."""
    test = rows.filter(F.col("year") == years.test)
    scored = baseline_scores(test).withColumn("section", F.lit("baselines"))
    for name, f in fitted.items():
        scored = scored.unionByName(f.score(test, "p").select(
            "fips", "y", F.lit(name).alias("model"), "p", F.lit("test").alias("section")))
    return stage(scored, "scored")


def evaluate_target(rows: DataFrame, target: str, years: Years, fitted: dict[str, AnyFit]) -> DataFrame:
    """Test-year measures of fitted models and rank baselines: (section, model, measures)."""
    return evaluate_scores(test_scores(rows, years, fitted), target)


def evaluate_scores(scored: DataFrame, target: str) -> DataFrame:
    out = mt.evaluate(scored, "y", "p", "fips", CUT[target], ["section", "model"])
    # Ranks are no probabilities.
    return out.withColumn("brier", F.when(F.col("section") == "test", F.col("brier")))


MAX_GROUPS = 100_000


def group_folds(df: DataFrame, group: str, folds: int = 5) -> list[tuple[object, int, int]]:
    """(group, rows, fold): largest group first, each to the fold with the fewest rows so far.

    Only one row per group reaches the driver.
    """
    sizes = [(r[0], r[1]) for r in df.groupBy(group).count().orderBy(F.col("count").desc(), group)
             .limit(MAX_GROUPS + 1).collect()]
    if len(sizes) > MAX_GROUPS:
        raise ValueError(f"{group} has too many values for a fold table")
    load = [0] * folds
    out = []
    for g, n in sizes:
        f = load.index(min(load))
        load[f] += n
        out.append((g, n, f))
    return out


def fold_table(spark: SparkSession, df: DataFrame, group: str, folds: int = 5) -> DataFrame:
    rows = group_folds(df, group, folds)
    kind = df.schema[group].dataType.simpleString()
    return spark.createDataFrame(rows, f"{group} {kind}, n_rows long, fold int")


def held_out_scores(parts: Mapping[str, DataFrame], years: Years, names: Sequence[str] = ("logit", "forest"), folds: int = 5,
                    trees: int = TREES) -> DataFrame:
    """(target, model, fold, fips, year, y, p): every labelled row scored by fits that never saw its state.

    ``parts`` are the rows of each target. All folds of all targets are fitted together: one job grows all trees, and a few
    shared passes give all logistic fits.
    """
    spark = next(iter(parts.values())).sparkSession
    dealt = []
    for rows in parts.values():
        labelled = rows.filter(F.col("year").isin(list(years.final)))
        table = F.broadcast(fold_table(spark, labelled, "state", folds).select("state", "fold"))  # MAX_GROUPS rows at most
        dealt.append(stage(labelled.join(table, "state"), "folds"))
    cells = [Fold(p, f) for p in range(len(dealt)) for f in range(folds)]
    scored = []
    for name in names:
        if name == "forest":
            forest = grow(dealt, cells, trees)
            fits: list[AnyFit] = [forest.fit(i) for i in range(len(cells))]
        elif name == "logit":
            fits = fit_logits(dealt, cells)
        else:
            raise ValueError(f"no held-out fits of {name}")
        for p, target in enumerate(parts):
            mine = [(c.held, fit) for c, fit in zip(cells, fits, strict=True) if c.part == p]
            for f, fit in mine:
                scored.append(fit.score(dealt[p].filter(F.col("fold") == f), "p").select(
                    F.lit(target).alias("target"), F.lit(name).alias("model"), "fold", "fips", "year", "y", "p"))
    return stage(reduce(DataFrame.unionByName, scored), "held_out")


def grouped_cv(scores: DataFrame) -> DataFrame:
    """(target, model, mean_auc, min_auc, max_auc) over the folds of ``held_out_scores``."""
    auc = mt.roc_auc(scores, "y", "p", ["target", "model", "fold"])
    return auc.groupBy("target", "model").agg(F.avg("roc_auc").alias("mean_auc"), F.min("roc_auc").alias("min_auc"),
                                              F.max("roc_auc").alias("max_auc"))


def coefficient_table(train: DataFrame) -> DataFrame:
    """(feature, coef, se, p_value, odds_ratio_per_sd, ci_lo, ci_hi, state_se, state_ci_lo, state_ci_hi) per standard deviation.

    Errors come from the information matrix of the last pass. Those with ``state_`` also allow for rows of a state that go
    together: the matrix is set against the summed slopes of each state. Features that do not vary are left out.
    """
    fit = fit_logit(train)
    pop, sample = fit.scaler, Scaler.fit(train, sample=True)
    keep = [i for i, s in enumerate(pop.sd) if s and s > 0]
    at = [*keep, len(pop.features)]
    _, rows = solver_rows([train], 1)
    try:
        meat = clustered_scores(rows, "state", [*fit.coefficients, fit.intercept])[np.ix_(at, at)]
    finally:
        rows.unpersist()
    inverse = np.linalg.inv(fit.extra["information"][np.ix_(at, at)])
    robust = inverse @ meat @ inverse
    out = []
    for k, i in enumerate(keep):
        unit = sample.sd[i] / pop.sd[i]  # coefficients are told per sample deviation
        b, se, wide = fit.coefficients[i] * unit, math.sqrt(inverse[k, k]) * unit, math.sqrt(max(robust[k, k], 0.0)) * unit
        out.append((pop.features[i], b, se, math.erfc(abs(b) / se / math.sqrt(2)), math.exp(b), math.exp(b - 1.96 * se), math.exp(b + 1.96 * se),
                    wide, math.exp(b - 1.96 * wide), math.exp(b + 1.96 * wide)))
    return train.sparkSession.createDataFrame(out, "feature string, coef double, se double, p_value double, odds_ratio_per_sd double, "
                                                   "ci_lo double, ci_hi double, state_se double, state_ci_lo double, state_ci_hi double")


def library_coefficients(train: DataFrame) -> DataFrame:
    """(feature, coef, se, p_value) of the library's solver, to compare with."""
    sc = Scaler.fit(train, sample=True).varying()
    fit = GeneralizedLinearRegression(family="binomial", featuresCol="x", labelCol="y", maxIter=200, tol=1e-10).fit(
        compact(sc.apply(train).select("x", "y"), train.count()))
    s = fit.summary
    se, pv = s.coefficientStandardErrors, s.pValues  # the intercept comes last in both
    return train.sparkSession.createDataFrame([(f, float(fit.coefficients[i]), float(se[i]), float(pv[i])) for i, f in enumerate(sc.features)],
                                              "feature string, coef double, se double, p_value double")


def linear_coefficients(spark: SparkSession, fitted: LinearFit) -> DataFrame:
    """(feature, coef) of a linear model on standardized features."""
    return spark.createDataFrame([(f, float(c)) for f, c in zip(fitted.scaler.features, fitted.coefficients,
                                                                strict=True)], "feature string, coef double")


def kept_features(coefs: DataFrame, floor: float = 1e-6) -> DataFrame:
    return coefs.filter(F.abs("coef") > floor)


def largest_features(table: DataFrame, value: str, n: int = 5) -> DataFrame:
    return table.orderBy(F.col(value).desc(), "feature").limit(n)


def permutations(test: DataFrame, repeats: int = 5) -> DataFrame:
    """(rep, fips, donor): in each repeat every row gets the row whose values it borrows; a shuffle by hash, so it can be told."""
    places = row_numbers(test.select("fips"), [F.col("fips").asc()], "i").withColumn("rep", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
    donors = row_numbers(places.select("rep", F.xxhash64(F.lit(SEED), "rep", "fips").alias("h"), F.col("fips").alias("donor")),
                         [F.col("h").asc(), F.col("donor").asc()], "i", ["rep"]).select("rep", "i", "donor")
    return places.join(donors, ["rep", "i"]).select("rep", "fips", "donor")


def shuffled_scores(fitted: AnyFit, test: DataFrame, repeats: int = 5) -> DataFrame:
    """(feature, rep, fips, y, p): test rows scored with one feature borrowed from the donor; feature "" has the plain rows.

    One shuffle of the rows per repeat serves all features. All copies are scored together.
    """
    names = list(FEATURES)
    base = test.select("fips", "y", F.array(*[F.col(f).cast("double") for f in names]).alias("own"))
    other = base.select(F.col("fips").alias("donor"), F.col("own").alias("other"))
    pairs = permutations(test, repeats).join(base, "fips").join(other, "donor").select("rep", "fips", "y", "own", "other")
    plain = base.select(F.lit(0).alias("rep"), "fips", "y", "own", F.col("own").alias("other"), F.lit(-1).alias("j"))
    label = F.element_at(F.array(F.lit(""), *[F.lit(n) for n in names]), F.col("j") + 2)
    out = [label.alias("feature"), "rep", "fips", "y"]
    cols = [F.when(F.col("j") == i, F.col("other")[i]).otherwise(F.col("own")[i]).alias(f) for i, f in enumerate(names)]
    if isinstance(fitted, ForestFit):  # all features of a pair together
        lent = fitted.score_borrowed(pairs, "own", "other", "p").select("rep", "fips", "y", F.posexplode("p").alias("j", "p")).select(*out, "p")
        rows = plain.select(*out, *cols)
        return stage(lent.unionByName(fitted.score(rows, "p").select(*lent.columns)), "shuffled")
    each = pairs.select("*", F.explode(F.sequence(F.lit(0), F.lit(len(names) - 1))).alias("j"))
    rows = each.unionByName(plain).select(*out, *cols)
    return stage(fitted.score(rows, "p").select("feature", "rep", "fips", "y", "p"), "shuffled")


def permutation_importance(fitted: AnyFit, test: DataFrame, repeats: int = 5) -> DataFrame:
    """(feature, importance): mean drop of AUC when one feature is shuffled among the test rows."""
    return importance_of(shuffled_scores(fitted, test, repeats))


def importance_of(scores: DataFrame) -> DataFrame:
    """(feature, importance) of ``shuffled_scores``."""
    auc = stage(mt.roc_auc(scores, "y", "p", ["feature", "rep"]), "importance")
    whole = auc.filter("feature = ''").select("roc_auc").scalar()
    return (auc.filter("feature <> ''").groupBy("feature").agg(F.avg("roc_auc").alias("shuffled"))
            .select("feature", (whole - F.col("shuffled")).alias("importance")))


def score_latest(panel: DataFrame, years: Years, model: str = "logit") -> tuple[DataFrame, dict[str, AnyFit]]:
    """Refit on all labelled years and score the latest feature year.

    Adds p_new_site and p_first_site to the rows of that year; p_first_site is 0 where a large
    site exists.
    """
    parts = [training_rows(panel, t).filter(F.col("year").isin(list(years.final))) for t in TARGETS]
    fits = dict(zip(TARGETS, fit_all(model, parts), strict=True))
    latest = model_features(panel.filter(F.col("year") == years.latest))
    scored = fits["B"].score(fits["A"].score(latest, "p_new_site"), "p_first_site")
    return scored.withColumn("p_first_site", F.when(F.col("large_sites") == 0, F.col("p_first_site")).otherwise(0.0)), fits


def out_of_time(scored: DataFrame, snapshot: DataFrame) -> DataFrame:
    """(check, roc_auc, base_rate, n): latest-year scores against openings of the partial year."""
    seen = scored.select("fips", "large_sites", "p_new_site", "p_first_site").join(
        snapshot.select("fips", F.when(F.col("new_large_sites_t") > 0, 1).otherwise(0).alias("y")), "fips")
    both = (seen.select(F.lit("A").alias("check"), F.col("p_new_site").alias("p"), "y")
            .unionByName(seen.filter("large_sites = 0").select(F.lit("B").alias("check"), F.col("p_first_site").alias("p"), "y")))
    return mt.ranking_metrics(mt.score_steps(both, "y", "p", ["check"]), ["check"]).select(
        "check", "roc_auc", "base_rate", "n")


def solver_agreement(train: DataFrame, test: DataFrame, max_auc: float = 0.005, max_coef: float = 0.01) -> DataFrame:
    """One row comparing two solvers on the same rows: AUC gap, largest coefficient gap, verdict."""
    spark = train.sparkSession
    logit = fit_logit(train)
    glm = library_coefficients(train)
    sc = Scaler.fit(train, sample=True).varying()
    b = {r["feature"]: r["coef"] for r in glm.select("feature", "coef").collect()}
    margin = sum((sc.column(f) * b[f] for f in sc.features), F.lit(0.0))
    scored = logit.score(test, "p").select(F.lit("logit").alias("m"), "y", "p").unionByName(
        test.select(F.lit("glm").alias("m"), "y", margin.alias("p")))  # the intercept does not change ranks
    auc = {r["m"]: r["roc_auc"] for r in mt.roc_auc(scored, "y", "p", ["m"]).collect()}
    # One solver scales by the population deviation, the other by the sample one: same unit first.
    unit = dict(zip(sc.features, sc.sd, strict=True))
    pop = dict(zip(logit.scaler.features, logit.scaler.sd, strict=True))
    lin = {r["feature"]: r["coef"] for r in linear_coefficients(spark, logit).collect()}
    gap = max((abs(lin[f] / pop[f] * unit[f] - b[f]) for f in sc.features), default=0.0)
    d = abs(auc["logit"] - auc["glm"])
    return spark.createDataFrame([(auc["logit"], auc["glm"], d, gap, d < max_auc and gap < max_coef)],
                                 "auc_logit double, auc_glm double, auc_gap double, coef_gap double, agree boolean")
