"""Ranking metrics from distinct scores, exact under ties and at any size.

All functions take a table of scored rows and can treat several groups (target, model) at once:
``by`` names the group columns. Scores are first reduced to (score, rows, positives).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteplan.operators.keys import join_on
from siteplan.operators.ordering import exact_quantiles, prefix_sums, row_numbers


def score_steps(scored: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, score, n, pos, cum_n, cum_pos) over distinct scores, best score first."""
    counts = scored.groupBy(*by, F.col(score).alias("score")).agg(
        F.count("*").alias("n"), F.sum(F.col(label).cast("bigint")).alias("pos"))
    return prefix_sums(counts, [F.col("score").desc()], {"cum_n": "n", "cum_pos": "pos"}, by)


def _totals(steps: DataFrame, by: Sequence[str]) -> DataFrame:
    return steps.groupBy(*by).agg(F.sum("n").alias("rows"), F.sum("pos").alias("positives"))


def _with_totals(steps: DataFrame, by: Sequence[str]) -> DataFrame:
    return join_on(steps, _totals(steps, by), by)


def ranking_metrics(steps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, roc_auc, pr_auc, base_rate, n, positives) from score steps.

    roc_auc counts a tied pair as half; pr_auc is the step form of average precision.
    """
    s = _with_totals(steps, by)
    neg = F.col("n") - F.col("pos")
    neg_below = (F.col("rows") - F.col("positives")) - (F.col("cum_n") - F.col("cum_pos"))
    won = F.sum(F.col("pos") * (neg_below + neg / 2))
    # Each step adds its share of the positives times the precision down to it.
    precision = F.sum(F.col("pos") * F.col("cum_pos") / F.col("cum_n"))
    out = s.groupBy(*by, "rows", "positives").agg(won.alias("won"), precision.alias("ap"))
    pairs = F.col("positives") * (F.col("rows") - F.col("positives"))
    return out.select(*by, F.when(pairs > 0, F.col("won") / pairs).alias("roc_auc"),
                      F.when(F.col("positives") > 0, F.col("ap") / F.col("positives")).alias("pr_auc"),
                      (F.col("positives") / F.col("rows")).alias("base_rate"),
                      F.col("rows").alias("n"), "positives")


def roc_auc(scored: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    return ranking_metrics(score_steps(scored, label, score, by), by).select(*by, "roc_auc")


def roc_curve(scored: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, threshold, fpr, tpr): one point per distinct score."""
    s = _with_totals(score_steps(scored, label, score, by), by)
    return s.select(*by, F.col("score").alias("threshold"),
                    ((F.col("cum_n") - F.col("cum_pos")) / (F.col("rows") - F.col("positives"))).alias("fpr"),
                    (F.col("cum_pos") / F.col("positives")).alias("tpr"))


def precision_cuts(scored: DataFrame, label: str, score: str, key: str, k: Column | int,
                   by: Sequence[str] = (), low: int = 101, high: int = 500) -> DataFrame:
    """(by, precision_at_k, precision_at_n_positives, precision_ranks_low_high).

    Ranks are by score descending, then key. A cut longer than the table uses all rows.
    """
    ranked = row_numbers(scored.select(*by, key, label, score, F.lit(k).alias("_k") if isinstance(k, int)
                                       else k.alias("_k")), [F.col(score).desc(), F.col(key).asc()], "_rank", by)
    totals = scored.groupBy(*by).agg(F.sum(label).alias("_pos"))
    ranked = join_on(ranked, totals, by)
    y, r = F.col(label).cast("double"), F.col("_rank")
    return ranked.groupBy(*by).agg(
        F.avg(F.when(r <= F.col("_k"), y)).alias("precision_at_k"),
        F.avg(F.when(r <= F.col("_pos"), y)).alias("precision_at_n_positives"),
        F.avg(F.when(r.between(low, high), y)).alias(f"precision_ranks_{low}_{high}"))


def brier(scored: DataFrame, label: str, prob: str, by: Sequence[str] = ()) -> DataFrame:
    gap = F.col(prob) - F.col(label)
    return scored.groupBy(*by).agg(F.avg(gap * gap).alias("brier"))


def evaluate(scored: DataFrame, label: str, score: str, key: str, k: Column | int = 100,
             by: Sequence[str] = ()) -> DataFrame:
    """All measures of a scored test set, one row per group."""
    parts = [ranking_metrics(score_steps(scored, label, score, by), by),
             precision_cuts(scored, label, score, key, k, by), brier(scored, label, score, by)]
    return join_on(join_on(parts[0], parts[1], by), parts[2], by)


def quantile_bins(df: DataFrame, value: str, bins: int = 10, by: Sequence[str] = (), out: str = "bin") -> DataFrame:
    """Add the 0-based quantile bin: linear-interpolated edges, duplicates dropped, right-closed."""
    edges = exact_quantiles(df, {value: F.col(value)}, [i / bins for i in range(bins + 1)], by).select(
        *by, F.array_distinct("q").alias("_edges"))
    with_edges = join_on(df, edges, by)
    inner = F.slice("_edges", F.lit(2), F.greatest(F.size("_edges") - 2, F.lit(0)))
    return with_edges.withColumn(out, F.size(F.filter(inner, lambda e: e < F.col(value)))).drop("_edges")


def calibration(scored: DataFrame, label: str, prob: str, bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """(by, bin, p, y): mean probability and mean outcome per quantile bin."""
    return (quantile_bins(scored, prob, bins, by).groupBy(*by, "bin")
            .agg(F.avg(prob).alias("p"), F.avg(label).alias("y")))
