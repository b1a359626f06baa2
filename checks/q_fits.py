"""Properties of fitted models against SQL.

No SQL fits a model, but what any right fit must satisfy can be counted: rows and labels come from SQL, and the numbers
of violations must be zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from checks.base import MODEL_YEARS, SNAPSHOT, Tables, query, rounded, with_ctes
from checks.q_models import _both, _clusters, _evaluated, _fit, _held_out_states, _latest, _test, _train
from siteplan.functions.transforms import model_features
from siteplan.plans import clusters, models
from siteplan.plans.panel import split_snapshot

TRAIN = f"year in ({', '.join(map(str, MODEL_YEARS.train))})"
TEST = f"year = {MODEL_YEARS.test}"
FINAL = f"year in ({', '.join(map(str, MODEL_YEARS.final))})"


def labelled(where: str) -> str:
    """Rows and positives of both targets."""
    return "(" + " union all ".join(
        f"select '{t}' as target, count(*) as n, cast(sum({y}) as bigint) as positives from panel where {where} and {y} is not null"
        for t, y in models.TARGETS.items()) + ") l"


def count_if(bad: Column) -> Column:
    """Rows for which ``bad`` is true or unknown."""
    return F.count(F.when(F.coalesce(bad, F.lit(True)), 1))


def _score_equations(t: Tables, target: str, name: str) -> dict[str, float]:
    """Sums of (p - y) and of (p - y) times each scaled feature over the training rows."""
    fit = _fit(t, target, name)
    gap = F.col("p") - F.col("y")
    return fit.score(_train(t, target), "p").agg(F.sum(gap).alias("intercept"), *[
        F.sum(gap * fit.scaler.column(f)).alias(f) for f in fit.scaler.features]).first().asDict()


def _probabilities(t: Tables, name: str) -> DataFrame:
    return _both(lambda target: _fit(t, target, name).score(_test(t, target), "p").agg(
        F.count("*").alias("n"), F.sum("y").cast("long").alias("positives"), F.countDistinct("fips").alias("areas"),
        count_if(~F.col("p").between(0, 1)).alias("outside")))


OUTSIDE_SQL = with_ctes("panel", then=f"select target, n, positives, n as areas, 0 as outside from {labelled(TEST)}")


@query("m2_probabilities_in_range", OUTSIDE_SQL)
def _(t: Tables) -> DataFrame:
    return _probabilities(t, "logit")


@query("m4_probabilities_in_range", OUTSIDE_SQL)
def _(t: Tables) -> DataFrame:
    return _probabilities(t, "forest")


@query("m2_score_equations", with_ctes("panel", then=f"select target, n, positives, 0 as violations from {labelled(TRAIN)}"))
def _(t: Tables) -> DataFrame:
    """At the maximum of the likelihood every sum is zero: none may exceed a thousandth of the rows."""
    def part(target: str) -> DataFrame:
        sums = _score_equations(t, target, "logit")
        return _train(t, target).agg(F.count("*").alias("n"), F.sum("y").cast("long").alias("positives")).withColumn(
            "violations", sum(((F.lit(abs(v)) > F.col("n") / 1000).cast("int") for v in sums.values()), F.lit(0)))
    return _both(part)


L1_SLACK = 0.02


@query("m3_l1_optimality", with_ctes("panel", then=f"select target, n, positives, 0 as violations from {labelled(TRAIN)}"))
def _(t: Tables) -> DataFrame:
    """Optimality of the L1 fit: C times the slope is minus the sign of a kept coefficient, and at most 1 for the others."""
    def part(target: str) -> DataFrame:
        sums, fit = _score_equations(t, target, "lasso"), _fit(t, target, "lasso")
        slopes = {f: fit.extra["C"] * sums[f] for f in fit.scaler.features}
        bad = abs(fit.extra["C"] * sums["intercept"]) > L1_SLACK
        for f, b in zip(fit.scaler.features, fit.coefficients, strict=True):
            bad += abs(slopes[f] + (1 if b > 0 else -1)) > L1_SLACK if b else abs(slopes[f]) > 1 + L1_SLACK
        return _train(t, target).agg(F.count("*").alias("n"), F.sum("y").cast("long").alias("positives")).withColumn("violations", F.lit(int(bad)))
    return _both(part)


MEASURES = ["roc_auc", "pr_auc", "precision_at_k", "precision_at_n_positives"]


@query("m5_evaluation_counts", with_ctes("panel", then=f"""select target, section, model, n, positives, round(positives / n, 9) as base_rate, 0 as outside
  from {labelled(TEST)} cross join (values {', '.join(f"('test', '{m}')" for m in models.FITTERS)}, {', '.join(f"('baselines', '{m}')" for m in models.BASELINES)}) m(section, model)"""))
def _(t: Tables) -> DataFrame:
    outside = sum(((~F.col(c).between(0, 1)).cast("int") for c in MEASURES), F.lit(0))
    return rounded(_evaluated(t).select("target", "section", "model", "n", "positives", "base_rate", outside.alias("outside")), {"base_rate": 9})


@query("m7_held_out_bounds", with_ctes("panel", then=f"""select target, model, true as ordered from {labelled(FINAL)}
  cross join (values ('logit'), ('forest')) m(model) where n > 0"""))
def _(t: Tables) -> DataFrame:
    ordered = (F.col("min_auc") >= 0) & (F.col("min_auc") <= F.col("mean_auc")) & (F.col("mean_auc") <= F.col("max_auc")) & (F.col("max_auc") <= 1)
    return _held_out_states(t).select("target", "model", ordered.alias("ordered"))


@query("m17_latest_scores_in_range", with_ctes("panel", then=f"""select count(*) as n, count(*) filter (where large_sites > 0) as n_large, 0 as outside, 0 as not_zero
  from panel where year = {MODEL_YEARS.latest}"""))
def _(t: Tables) -> DataFrame:
    large = F.col("large_sites") > 0
    return _latest(t)[0].agg(F.count("*").alias("n"), F.count(F.when(large, 1)).alias("n_large"),
                             count_if(~(F.col("p_new_site").between(0, 1) & F.col("p_first_site").between(0, 1))).alias("outside"),
                             count_if(large & (F.col("p_first_site") != 0)).alias("not_zero"))


@query("m18_out_of_time_counts", with_ctes("panel", then=f"""select c as "check", count(*) as n, round(avg(y), 9) as base_rate from (
    select unnest(case when l.large_sites = 0 then ['A', 'B'] else ['A'] end) as c, case when s.new_large_sites_t > 0 then 1e0 else 0e0 end as y
    from panel l join panel s on s.fips = l.fips and s.year = {SNAPSHOT} where l.year = {MODEL_YEARS.latest}) q group by c"""))
def _(t: Tables) -> DataFrame:
    return rounded(models.out_of_time(_latest(t)[0], split_snapshot(t.panel(), SNAPSHOT)[1]).select("check", "n", "base_rate"), {"base_rate": 9})


@query("m19_nearest_centre", with_ctes("panel", then=f"select count(*) as n, 5 as n_clusters, 0 as misplaced, true as cost_is_sum from panel where year = {SNAPSHOT}"))
def _(t: Tables) -> DataFrame:
    """Every area belongs to the nearest centre, and the reported cost is the sum of squared distances to it."""
    members, centres, cost = _clusters(t)
    names = clusters.CLUSTER_FEATURES
    filled = model_features(split_snapshot(t.panel(), SNAPSHOT)[1]).select("fips", *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in names])
    sc = models.Scaler.fit(filled, names)
    points = filled.select("fips", F.array(*[sc.column(f) for f in names]).alias("x")).join(members, "fips")
    place = {r["cluster_id"]: [r[f] for f in names] for r in centres.collect()}  # five centres

    def square(centre: list[float]) -> Column:
        return sum(((F.col("x")[i] - F.lit(v)) ** 2 for i, v in enumerate(centre)), F.lit(0.0))

    distances = F.array(*[square(place[i]) for i in range(len(place))])
    each = points.withColumn("d", distances).select("cluster_id", F.array_min("d").alias("least"), F.col("d")[F.col("cluster_id")].alias("own"))
    return each.agg(F.count("*").alias("n"), F.countDistinct("cluster_id").cast("int").alias("n_clusters"),
                    count_if(F.col("own") > F.col("least") + 1e-9).cast("int").alias("misplaced"),
                    (F.abs(F.sum("own") - F.lit(cost)) <= 1e-6 * F.lit(cost)).alias("cost_is_sum"))


@query("m21_solvers_agree", with_ctes("panel", then=f"select target, true as agree from {labelled(TRAIN)} where n > 0"))
def _(t: Tables) -> DataFrame:
    return _both(lambda target: models.solver_agreement(_train(t, target), _test(t, target)).select("agree"))


@query("m8_intervals", with_ctes("panel", then=f"select target, 0 as violations from {labelled(TRAIN)} where n > 0"))
def _(t: Tables) -> DataFrame:
    """Odds ratios are exp of the coefficient inside their interval, p-values in [0, 1]."""
    right = ((F.abs(F.log("odds_ratio_per_sd") - F.col("coef")) < 1e-9) & (F.col("ci_lo") <= F.col("odds_ratio_per_sd"))
             & (F.col("odds_ratio_per_sd") <= F.col("ci_hi")) & F.col("p_value").between(0, 1))
    return _both(lambda target: models.coefficient_table(_train(t, target)).agg(count_if(~right).cast("int").alias("violations")))
