"""Measures of fitted models recomputed, by the SQL of the plain measures, from the very rows the operators return.

The row counts, folds and positives come from SQL on the given tables; the gaps between both computations must be zero.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.base import MODEL_YEARS, Tables, query, with_ctes
from checks.q_fits import FINAL, TEST, labelled
from checks.q_models import _evaluated, _held_out_scores, _held_out_states, _shuffled, _test, _test_scores, metric_sql
from siteplan.operators import metrics as mt
from siteplan.plans import models
from siteplan.session import stage


def plain_measures(scores: DataFrame, group: list[str], key: str, k: int) -> DataFrame:
    """The measures of ``scores`` (group, key, y, p) by window functions, as the SQL side writes them."""
    rows = scores.select(F.struct(*group).alias("g"), F.col(key).alias("key"), F.col("y").cast("double").alias("y"), "p")
    rows.createOrReplaceTempView("replayed")
    return scores.sparkSession.sql(f"with {metric_sql('replayed', k)} select m_all.*, m_ap.pr_auc from m_all join m_ap using (g)").select("g.*", "*").drop("g")


def gap(a: str, b: str):
    """Difference at nine digits; an unknown on one side only counts as 1."""
    return F.when(F.col(a).isNull() & F.col(b).isNull(), 0.0).otherwise(F.coalesce(F.round(F.abs(F.col(a) - F.col(b)), 9), F.lit(1.0)))


MEASURES = ["roc_auc", "pr_auc", "precision_at_k", "precision_at_n_positives", "precision_ranks_101_500", "brier"]
NAMES = ", ".join(f"('test', '{m}')" for m in models.FITTERS) + ", " + ", ".join(f"('baselines', '{m}')" for m in models.BASELINES)


@query("m5_measures_recomputed", with_ctes("panel", then=f"""select target, section, model, n, positives, {', '.join(f'0e0 as {m}_gap' for m in MEASURES)}
  from {labelled(TEST)} cross join (values {NAMES}) m(section, model)"""))
def _(t: Tables) -> DataFrame:
    out = None
    for target in models.TARGETS:
        plain = plain_measures(_test_scores(t, target), ["section", "model"], "fips", models.CUT[target])
        plain = plain.select("section", "model", *[F.col(m).alias(f"_{m}") for m in MEASURES])
        both = _evaluated(t).filter(F.col("target") == target).join(plain, ["section", "model"])
        # Ranks are no probabilities: they have no Brier score.
        both = both.withColumn("_brier", F.when(F.col("section") == "test", F.col("_brier")))
        part = both.select("target", "section", "model", "n", "positives", *[gap(m, f"_{m}").alias(f"{m}_gap") for m in MEASURES])
        out = part if out is None else out.unionByName(part)
    return out


FOLDS_SQL = with_ctes("panel", then="").replace("with ", "with recursive ", 1).rstrip() + f""",
  rows_of as (select 'A' as target, fips, state, y_new_site as y from panel where {FINAL} and y_new_site is not null
    union all select 'B', fips, state, y_first_site from panel where {FINAL} and y_first_site is not null),
  sizes as (select target, state, count(*) as n_rows, row_number() over (partition by target order by count(*) desc, state) as i from rows_of group by target, state),
  deal as (select target, 0::bigint as i, [0,0,0,0,0]::bigint[] as load, -1::bigint as fold from (values ('A'), ('B')) v(target)
    union all select d.target, s.i, list_transform(range(1, 6), lambda j: case when j = d.pick then d.load[j] + s.n_rows else d.load[j] end), d.pick - 1
    from (select *, cast(list_position(load, list_min(load)) as bigint) as pick from deal) d join sizes s on s.target = d.target and s.i = d.i + 1),
  folded as (select r.*, d.fold from rows_of r join sizes s using (target, state) join deal d on d.target = s.target and d.i = s.i)"""


@query("m7_held_out_scores", FOLDS_SQL + """ select target, model, cast(fold as int) as fold, count(*) as n, cast(sum(y) as bigint) as positives, 0e0 as auc_gap, 0 as outside
  from folded cross join (values ('logit'), ('forest')) m(model) group by target, model, fold""")
def _(t: Tables) -> DataFrame:
    """Every labelled row is scored once, in the fold of its state; the AUC of each fold is recomputed from the scores."""
    scores = _held_out_scores(t)
    group = ["target", "model", "fold"]
    plain = plain_measures(scores, group, "fips", 100).select(*group, "n", "positives", F.col("roc_auc").alias("plain"))
    outside = scores.groupBy(*group).agg(F.count(F.when(~F.coalesce(F.col("p").between(0, 1), F.lit(False)), 1)).cast("int").alias("outside"))
    return (mt.roc_auc(scores, "y", "p", group).join(plain, group).join(outside, group)
            .select(*group, "n", "positives", gap("roc_auc", "plain").alias("auc_gap"), "outside"))


@query("m7_fold_range", with_ctes("panel", then=f"""select target, model, 0e0 as mean_gap, 0e0 as min_gap, 0e0 as max_gap from {labelled(FINAL)}
  cross join (values ('logit'), ('forest')) m(model)"""))
def _(t: Tables) -> DataFrame:
    plain = plain_measures(_held_out_scores(t), ["target", "model", "fold"], "fips", 100).groupBy("target", "model").agg(
        F.avg("roc_auc").alias("mean"), F.min("roc_auc").alias("low"), F.max("roc_auc").alias("high"))
    return _held_out_states(t).join(plain, ["target", "model"]).select(
        "target", "model", gap("mean_auc", "mean").alias("mean_gap"), gap("min_auc", "low").alias("min_gap"), gap("max_auc", "high").alias("max_gap"))


REPEATS = 5


@query("m14_permutations", with_ctes("panel", then=f"""select target, rep, n, n as rows_lent, n as rows_borrowing from {labelled(TEST)}
  cross join (select unnest(range(1, {REPEATS + 1}))::int as rep) r"""))
def _(t: Tables) -> DataFrame:
    """In each repeat every test row lends its values once and borrows once."""
    out = None
    for target in models.TARGETS:
        part = models.permutations(_test(t, target), REPEATS).groupBy(F.lit(target).alias("target"), "rep").agg(
            F.count("*").alias("n"), F.countDistinct("donor").alias("rows_lent"), F.countDistinct("fips").alias("rows_borrowing"))
        out = part if out is None else out.unionByName(part)
    return out


@query("m14_importance_recomputed", with_ctes("panel", then=f"""select target, f.feature, n * {REPEATS} as n, 0e0 as gap from {labelled(TEST)}
  cross join (select unnest([{', '.join(f"'{f}'" for f in models.FEATURES)}]) as feature) f"""))
def _(t: Tables) -> DataFrame:
    """Importance of every feature, from the shuffled rows' own scores."""
    out = None
    for target in models.TARGETS:
        scores = _shuffled(t, target)
        auc = stage(plain_measures(scores, ["feature", "rep"], "fips", 100), "plain")
        whole = auc.filter("feature = ''").select("roc_auc").scalar()
        plain = auc.filter("feature <> ''").groupBy("feature").agg(F.sum("n").alias("n"), (whole - F.avg("roc_auc")).alias("plain"))
        part = models.importance_of(scores).join(plain, "feature").select(
            F.lit(target).alias("target"), "feature", "n", gap("importance", "plain").alias("gap"))
        out = part if out is None else out.unionByName(part)
    return out
