"""Ranking metrics (with SQL) and fitted models (rows only: no SQL fits them)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.base import CTES, MODEL_YEARS, SNAPSHOT, Tables, query, rounded, with_ctes
from siteplan.functions.transforms import FEATURES, model_features
from siteplan.operators import metrics as mt
from siteplan.plans import clusters, models
from siteplan.plans.panel import split_snapshot
from siteplan.session import stage

# ---- SQL side ------------------------------------------------------------------------------


def metric_sql(source: str, k: int, low: int = 101, high: int = 500) -> str:
    """Measures of a table (g, key, y, p); the AUC by rank sums."""
    return f"""m_rank as (select *, rank() over (partition by g order by p) + (count(*) over (partition by g, p) - 1)/2e0 as r,
    row_number() over (partition by g order by p desc, key) as o, sum(y) over (partition by g) as pos, count(*) over (partition by g) as n from {source}),
  m_step as (select g, p, sum(y) as dp, sum(sum(y)) over (partition by g order by p desc) as cp, sum(count(*)) over (partition by g order by p desc) as cn from {source} group by g, p),
  m_ap as (select g, sum(dp * cp / cn) / sum(dp) as pr_auc from m_step group by g),
  m_all as (select g, (sum(case when y = 1 then r end) - max(pos)*(max(pos)+1)/2e0) / (max(pos)*(max(n)-max(pos))) as roc_auc,
    avg(y) as base_rate, count(*) as n, cast(sum(y) as bigint) as positives, avg((p-y)*(p-y)) as brier,
    avg(case when o <= {k} then y end) as precision_at_k, avg(case when o <= pos then y end) as precision_at_n_positives,
    avg(case when o between {low} and {high} then y end) as precision_ranks_{low}_{high} from m_rank group by g)"""


ONE = "one as (select 1 as g, id as key, y, p from scored)"
SCORED_CTE = with_ctes("scored", then="").rstrip()


@query("m10_roc_auc", f"{SCORED_CTE}, {ONE}, {metric_sql('one', 100)} select round(roc_auc, 9) as roc_auc from m_all")
def _(t: Tables) -> DataFrame:
    return rounded(mt.roc_auc(t.scored(), "y", "p"), {"roc_auc": 9})


@query("m11_average_precision", f"{SCORED_CTE}, {ONE}, {metric_sql('one', 100)} select round(pr_auc, 9) as pr_auc from m_ap")
def _(t: Tables) -> DataFrame:
    return rounded(mt.ranking_metrics(mt.score_steps(t.scored(), "y", "p")).select("pr_auc"), {"pr_auc": 9})


TOP = ["precision_at_k", "precision_at_n_positives", "precision_ranks_101_500"]


@query("t2_precision_in_top_ranks", f"{SCORED_CTE}, {ONE}, {metric_sql('one', 100)} select " + ", ".join(f"round({c}, 9) as {c}" for c in TOP) + " from m_all")
def _(t: Tables) -> DataFrame:
    return rounded(mt.precision_cuts(t.scored(), "y", "p", "id", 100), dict.fromkeys(TOP, 9))


ALL = ["roc_auc", "pr_auc", "base_rate", *TOP, "brier"]


@query("m12_all_measures_by_group", f"""{SCORED_CTE}, grouped as (select id % 3 as g, id as key, y, p from scored), {metric_sql('grouped', 50)}
  select g, n, positives, {', '.join(f'round({c}, 9) as {c}' for c in ALL)} from m_all join m_ap using (g)""")
def _(t: Tables) -> DataFrame:
    rows = t.scored().withColumn("g", F.col("id") % 3)
    return rounded(mt.evaluate(rows, "y", "p", "id", 50, ["g"]), dict.fromkeys(ALL, 9))


@query("m13_brier_score", f"{SCORED_CTE} select round(avg((p - y) * (p - y)), 9) as brier from scored")
def _(t: Tables) -> DataFrame:
    return rounded(mt.brier(t.scored(), "y", "p"), {"brier": 9})


@query("m15_calibration_deciles", with_ctes("scored", then="select bin, round(avg(p), 9) as p, round(avg(y), 9) as y from (select *, "
       + " + ".join(f"cast(p > e[{i}] as int)" for i in range(1, 10)) + """ as bin
  from scored cross join (select quantile_cont(p, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) as e from scored) q) b group by bin"""))
def _(t: Tables) -> DataFrame:
    return rounded(mt.calibration(t.scored(), "y", "p"), {"p": 9, "y": 9})


@query("m16_roc_curve", f"""{SCORED_CTE} select p as threshold, round(cn0 / n0, 9) as fpr, round(cp / np, 9) as tpr from (
  select p, sum(sum(y)) over (order by p desc) as cp, sum(sum(1 - y)) over (order by p desc) as cn0, sum(sum(y)) over () as np, sum(sum(1 - y)) over () as n0
  from scored group by p) q""")
def _(t: Tables) -> DataFrame:
    return rounded(mt.roc_curve(t.scored(), "y", "p"), {"fpr": 9, "tpr": 9})


CTES["test_rows"] = (["panel"], "select * from panel where year = 1999 and y_new_site is not null")
PCT = "(rank() over (order by {c}) + (count(*) over (partition by {c}) - 1)/2e0) / count(*) over ()"
BASE_COLS = {"rank_by_population": "pop", "rank_by_freeway_vmt": "fwy_vmt", "rank_by_existing_ports": "dcfc_ports"}
CTES["base_scores"] = (["test_rows"], " union all ".join(
    f"select '{m}' as g, fips as key, cast(y_new_site as int) as y, {PCT.format(c=c)} as p from test_rows" for m, c in BASE_COLS.items()))
M6 = [c for c in ALL if c != "brier"]


@query("m6_rank_baselines", with_ctes("base_scores", then="").rstrip() + f""", {metric_sql('base_scores', 100)}
  select g as model, n, positives, {', '.join(f'round({c}, 9) as {c}' for c in M6)} from m_all join m_ap using (g)""")
def _(t: Tables) -> DataFrame:
    test = _rows(t, "A").filter(F.col("year") == MODEL_YEARS.test)
    out = mt.evaluate(models.baseline_scores(test), "y", "p", "fips", 100, ["model"]).drop("brier")
    return rounded(out, dict.fromkeys(M6, 9))


@query("m7_state_fold_table", with_ctes("panel", then="").replace("with ", "with recursive ", 1).rstrip() + """,
  sizes as (select state, count(*) as n_rows, row_number() over (order by count(*) desc, state) as i from panel
    where year between 1996 and 1999 and y_new_site is not null group by state),
  deal as (select 0::bigint as i, [0,0,0,0,0]::bigint[] as load, -1::bigint as fold
    union all select s.i, [case when d.pick = 1 then d.load[1] + s.n_rows else d.load[1] end, case when d.pick = 2 then d.load[2] + s.n_rows else d.load[2] end,
      case when d.pick = 3 then d.load[3] + s.n_rows else d.load[3] end, case when d.pick = 4 then d.load[4] + s.n_rows else d.load[4] end,
      case when d.pick = 5 then d.load[5] + s.n_rows else d.load[5] end], d.pick - 1
    from (select *, cast(list_position(load, list_min(load)) as bigint) as pick from deal) d join sizes s on s.i = d.i + 1)
  select s.state, s.n_rows, d.fold from sizes s join deal d using (i)""")
def _(t: Tables) -> DataFrame:
    rows = _rows(t, "A").filter(F.col("year").isin(MODEL_YEARS.final))
    return models.fold_table(t.spark, rows, "state")


CENTRE_SQL = {"bev_per_1k": "avg(c_acctbal)/2.5e3 - 0.5e0", "log_pop": "cast(sum(c_custkey)%100 as double)/4e1 - 1e0",
              "log_dist_large_dcfc": "cast(count(*)%9 as double)/4e0 - 0.8e0", "log_ports_per_1k_bev": "cast(max(c_custkey)%17 as double)/8e0 - 1e0"}
NAME_CASE = "case " + " ".join(f"when {f} {s} {v} then '{n}'" for f, s, v, n in clusters.NAME_RULES) + f" else '{clusters.NO_RULE}' end"


@query("m20_cluster_names", f"""select cluster_id, case when row_number() over (partition by name order by cluster_id) = 1 then name
    else name || ' (' || cluster_id || ')' end as cluster from (select *, {NAME_CASE} as name from (
    select c_nationkey as cluster_id, {', '.join(f'{e} as {n}' for n, e in CENTRE_SQL.items())} from customer group by 1) c) q""")
def _(t: Tables) -> DataFrame:
    centres = t.raw("customer").groupBy(F.col("c_nationkey").alias("cluster_id")).agg(*[F.expr(e).alias(n) for n, e in CENTRE_SQL.items()])
    return clusters.name_clusters(centres).select("cluster_id", "cluster")


@query("t4_largest_features", with_ctes("panel", then="") + """select feature, round(sd, 6) as sd from (select x.f as feature, stddev_samp(x.v) as sd from (
    select unnest(['pop','area_sqmi','dcfc_ports','own_sites']) as f, unnest([pop, area_sqmi, cast(dcfc_ports as double), cast(own_sites as double)]) as v
    from panel where year = 2000) x group by 1) q order by sd desc limit 3""")
def _(t: Tables) -> DataFrame:
    names = ["pop", "area_sqmi", "dcfc_ports", "own_sites"]
    sc = models.Scaler.fit(t.panel().filter(F.col("year") == 2000), names, sample=True)
    table = t.spark.createDataFrame(list(zip(names, sc.sd, strict=True)), "feature string, sd double")
    return rounded(models.largest_features(table, "sd", 3), {"sd": 6})


# ---- fitted models -------------------------------------------------------------------------


def _rows(t: Tables, target: str) -> DataFrame:
    return t._once(f"rows_{target}", lambda: stage(models.training_rows(split_snapshot(t.panel(), SNAPSHOT)[0], target), "rows"))


def _train(t: Tables, target: str) -> DataFrame:
    return _rows(t, target).filter(F.col("year").isin(list(MODEL_YEARS.train)))


def _test(t: Tables, target: str) -> DataFrame:
    return _rows(t, target).filter(F.col("year") == MODEL_YEARS.test)


def _fit(t: Tables, target: str, name: str) -> models.AnyFit:
    """The fit of one target; those of both are made together."""
    def make() -> dict[str, models.AnyFit]:
        return dict(zip(models.TARGETS, models.fit_all(name, [_train(t, x) for x in models.TARGETS]), strict=True))
    return t._once(f"fits_{name}", make)[target]


def _latest(t: Tables):
    return t._once("latest", lambda: models.score_latest(split_snapshot(t.panel(), SNAPSHOT)[0], MODEL_YEARS))


@query("m1_standardized_features", with_ctes("panel", then="""select year, count(*) as n, round(avg(z), 6) as mean_log_pop, round(avg(z*z), 6) as spread from (
  select *, (ln(pop) - (select avg(ln(pop)) from panel where y_new_site is not null and year in (1996,1997,1998)))
    / (select stddev_pop(ln(pop)) from panel where y_new_site is not null and year in (1996,1997,1998)) as z from panel
  where y_new_site is not null and year between 1996 and 1999) q group by year"""))
def _(t: Tables) -> DataFrame:
    from pyspark.ml.functions import vector_to_array
    rows = _rows(t, "A").filter(F.col("year").isin(MODEL_YEARS.final))
    ready = models.Scaler.fit(_train(t, "A")).apply(rows)
    z = vector_to_array("x")[0]
    return ready.withColumn("z", z).groupBy("year").agg(F.count("*").alias("n"), F.round(F.avg("z"), 6).alias("mean_log_pop"),
                                                        F.round(F.avg(F.col("z") * F.col("z")), 6).alias("spread"))


def _scored_test(t: Tables, name: str) -> DataFrame:
    return _fit(t, "A", name).score(_test(t, "A"), "p").select("fips", "y", "p")


@query("m2_logistic_probabilities")
def _(t: Tables) -> DataFrame:
    return _scored_test(t, "logit")


def _both(part: Callable[[str], DataFrame]) -> DataFrame:
    """The rows of both targets."""
    a, b = (part(target).withColumn("target", F.lit(target)) for target in models.TARGETS)
    return a.unionByName(b)


@query("m3_l1_logistic")
def _(t: Tables) -> DataFrame:
    def part(target: str) -> DataFrame:
        f = _fit(t, target, "lasso")
        return models.linear_coefficients(t.spark, f).withColumn("C", F.lit(f.extra["C"])).withColumn("cv_auc", F.lit(f.extra["cv_auc"]))
    return _both(part)


@query("m4_forest_probabilities")
def _(t: Tables) -> DataFrame:
    return _scored_test(t, "forest")


def _test_scores(t: Tables, target: str) -> DataFrame:
    return t._once(f"test_scores_{target}", lambda: models.test_scores(_rows(t, target), MODEL_YEARS, {n: _fit(t, target, n) for n in models.FITTERS}))


def _evaluated(t: Tables) -> DataFrame:
    def part(target: str) -> DataFrame:
        return models.evaluate_scores(_test_scores(t, target), target)
    return t._once("evaluated", lambda: stage(_both(part), "evaluated"))


@query("m5_temporal_evaluation")
def _(t: Tables) -> DataFrame:
    return _evaluated(t)


def _held_out_scores(t: Tables) -> DataFrame:
    return t._once("held_out", lambda: models.held_out_scores({x: _rows(t, x) for x in models.TARGETS}, MODEL_YEARS))


def _held_out_states(t: Tables) -> DataFrame:
    return t._once("cv", lambda: stage(models.grouped_cv(_held_out_scores(t)), "cv"))


@query("m7_states_held_out")
def _(t: Tables) -> DataFrame:
    return _held_out_states(t)


@query("m8_coefficient_table")
def _(t: Tables) -> DataFrame:
    return _both(lambda target: models.coefficient_table(_train(t, target)))


@query("m9_kept_features")
def _(t: Tables) -> DataFrame:
    def part(target: str) -> DataFrame:
        f = _fit(t, target, "lasso")
        return models.kept_features(models.linear_coefficients(t.spark, f)).withColumn("C", F.lit(f.extra["C"]))
    return _both(part)


def _shuffled(t: Tables, target: str) -> DataFrame:
    return t._once(f"shuffled_{target}", lambda: models.shuffled_scores(_fit(t, target, "forest"), _test(t, target)))


@query("m14_permutation_importance")
def _(t: Tables) -> DataFrame:
    return _both(lambda target: models.importance_of(_shuffled(t, target)))


@query("m17_latest_scores")
def _(t: Tables) -> DataFrame:
    return _latest(t)[0].select("fips", "large_sites", "p_new_site", "p_first_site")


@query("m18_out_of_time_check")
def _(t: Tables) -> DataFrame:
    return models.out_of_time(_latest(t)[0], split_snapshot(t.panel(), SNAPSHOT)[1])


def _clusters(t: Tables):
    return t._once("clusters", lambda: clusters.fit_clusters(model_features(split_snapshot(t.panel(), SNAPSHOT)[1])))


@query("m19_kmeans_members")
def _(t: Tables) -> DataFrame:
    members, _, cost = _clusters(t)
    return members.withColumn("cost", F.lit(cost))


@query("m20_cluster_sizes")
def _(t: Tables) -> DataFrame:
    members, centres, _ = _clusters(t)
    return clusters.cluster_sizes(members, clusters.name_clusters(centres))


@query("m21_solver_agreement")
def _(t: Tables) -> DataFrame:
    return _both(lambda target: models.solver_agreement(_train(t, target), _test(t, target)))


@query("s13_model_metrics_document")
def _(t: Tables) -> DataFrame:
    from siteplan.session import scratch_path
    from siteplan.sources import sinks

    def long(df: DataFrame, section: str, model: str = "") -> DataFrame:
        """Long rows of a table with a target, a section, a model and measures."""
        named = df.withColumns({c: F.lit(v) for c, v in (("section", section), ("model", model)) if c not in df.columns})
        values = [c for c in named.columns if c not in ("target", "section", "model")]
        return named.select("target", "section", "model", *[F.col(c).cast("double") for c in values]).unpivot(
            ["target", "section", "model"], values, "metric", "value")

    def lasso(target: str) -> DataFrame:
        f = _fit(t, target, "lasso")
        kept = models.kept_features(models.linear_coefficients(t.spark, f))
        return kept.select(F.col("feature").alias("model"), "coef", F.lit(f.extra["C"]).alias("C"), F.lit(f.extra["cv_auc"]).alias("cv_auc"))

    coefs = _both(lambda target: models.coefficient_table(_train(t, target))).withColumnRenamed("feature", "model")
    late = models.out_of_time(_latest(t)[0], split_snapshot(t.panel(), SNAPSHOT)[1]).withColumnRenamed("check", "target")
    parts = [long(_evaluated(t), ""), long(_held_out_states(t), "states_held_out"), long(coefs, "coefficients"),
             long(_both(lasso), "lasso"), long(late, "out_of_time", "logit")]
    path = scratch_path(t.spark, "metrics")
    sinks.write_metrics(reduce(DataFrame.unionByName, parts), path)
    return sinks.read_metrics(t.spark, path)
