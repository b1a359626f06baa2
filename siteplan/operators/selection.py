"""Selection of candidate sites (fips, k, value, cost) under a budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siteplan.operators.exact import select_exact
from siteplan.operators.ordering import prefix_sums, row_numbers, top_rows
from siteplan.session import stage

MICRO = 1_000_000  # costs are summed as whole millionths, so that the order of summing can't matter
BY_VALUE = [("value", False), ("k", True), ("fips", True)]


def _order(spec: list[tuple[str, bool]]) -> list[Column]:
    return [F.col(c).asc() if up else F.col(c).desc() for c, up in spec]


def value_order() -> list[Column]:
    return _order(BY_VALUE)


def ratio_order() -> list[Column]:
    return [(F.col("value") / F.col("cost")).desc(), F.col("k").asc(), F.col("fips").asc()]


def affordable(budget: float, cost: float) -> int:
    return int(budget // cost)


def select_equal_cost(cand: DataFrame, budget: float, cost: float) -> DataFrame:
    """With one cost for all, the highest values are exactly optimal."""
    return top_rows(cand, value_order(), affordable(budget, cost))


def _chain_ok(ordered: DataFrame) -> DataFrame:
    """Items whose lower-k chain is complete and earlier in the order; others can never be taken."""
    w = Window.partitionBy("fips").orderBy("k")
    above = w.rowsBetween(Window.unboundedPreceding, -1)
    step = (F.col("k") == F.row_number().over(w)) & (F.col("pos") > F.coalesce(F.max("pos").over(above), F.lit(0)))
    flagged = ordered.withColumn("_step", step.cast("int"))
    return (flagged.withColumn("_ok", F.min("_step").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .filter("_ok = 1").drop("_step", "_ok"))


def select_greedy(cand: DataFrame, budget: float) -> DataFrame:
    """One pass by value per dollar: skip what does not fit; the k-th site needs the one before.

    Done in rounds instead of row by row: accept the longest affordable prefix of the live items,
    drop the item that overflows and everything dearer than what is left, each with its later
    siblings, and repeat. What is left only shrinks, so a dropped item could never fit later.
    After the first round the rest is below one site cost, so at most max cost / min cost rounds
    follow, and each writes only the place and cost of the items that still fit.
    """
    ordered = row_numbers(cand, ratio_order(), "pos").withColumn("_micro", F.round(F.col("cost") * MICRO).cast("bigint"))
    left, taken = round(budget * MICRO), []
    live = stage(_chain_ok(ordered).filter(F.col("_micro") <= left), "live")
    while True:
        low = live.agg(F.min("_micro")).first()[0]
        if low is None or low > left:
            break
        run = prefix_sums(live.select("pos", "_micro"), [F.col("pos").asc()], {"spent": "_micro"})
        fits = F.col("spent") <= left
        r = run.agg(F.max(F.when(fits, F.col("pos"))).alias("last"), F.max(F.when(fits, F.col("spent"))).alias("spent"),
                    F.min(F.when(~fits, F.col("pos"))).alias("over")).first()
        taken.append(live.filter(F.col("pos") <= F.lit(r["last"])))
        left -= r["spent"]
        if r["over"] is None:
            break
        rest = live.filter(F.col("pos") > F.lit(r["last"]))
        dead = ((F.col("pos") == F.lit(r["over"])) | (F.col("_micro") > left)).cast("int")
        chain = Window.partitionBy("fips").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
        live = stage(rest.withColumn("_dead", F.max(dead).over(chain)).filter("_dead = 0").drop("_dead"), "live")
    if not taken:
        return cand.limit(0)
    out = taken[0]
    for t in taken[1:]:
        out = out.unionByName(t)
    return out.select(*cand.columns)


def select_sites(cand: DataFrame, budget: float, exact: bool = False) -> tuple[DataFrame, str]:
    """(chosen rows, method). An empty result keeps the schema.

    With ``exact``, unequal costs are searched for the best selection; the method says so if the search had to give up.
    """
    c = cand.agg(F.min("cost").alias("low"), F.max("cost").alias("high")).first()
    if c["low"] is None:
        return cand, "none"
    if c["low"] == c["high"]:
        return select_equal_cost(cand, budget, c["low"]), "exact (equal costs)"
    greedy = select_greedy(cand, budget)
    if not exact:
        return greedy, "greedy (value per dollar)"
    best, proven = select_exact(cand, budget, greedy)
    return best, "exact (core search)" if proven else "greedy (value per dollar), core too large"


def budget_bound(cand: DataFrame, budget: float) -> DataFrame:
    """One row (bound, whole_items): value of the fractional relaxation, an upper bound on any choice.

    Items are bought in the order of value per dollar and the breaking item in part.
    """
    run = prefix_sums(cand.filter(F.col("value") > 0), ratio_order(), {"spent": "cost"})
    before = F.col("spent") - F.col("cost")
    part = F.when(F.col("spent") <= budget, F.col("value")).when(
        before < budget, (budget - before) / F.col("cost") * F.col("value"))
    return run.agg(F.coalesce(F.sum(part), F.lit(0.0)).alias("bound"),
                   F.count_if(F.col("spent") <= budget).alias("whole_items"))


def greedy_gap(cand: DataFrame, budget: float) -> DataFrame:
    """One row (greedy_value, bound, gap): how far the greedy choice can be from the optimum."""
    got = select_greedy(cand, budget).agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias("greedy_value"))
    return (budget_bound(cand, budget).select("bound").withColumn("greedy_value", got.scalar())
            .withColumn("gap", F.col("bound") - F.col("greedy_value")))
