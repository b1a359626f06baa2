"""Running totals, row numbers, percentile ranks and exact quantiles in a global order.

A window without ``partitionBy`` sorts everything in one task. Here rows are range-partitioned,
written once with their partition number, totalled per partition, and each partition then adds
the total of those before it. Ranks and quantiles first shrink to distinct values with counts,
so a value that holds a third of all rows is one row here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siteplan.operators.keys import join_on
from siteplan.session import stage


def prefix_sums(df: DataFrame, order: Sequence[Column], sums: Mapping[str, str],
                by: Sequence[str] = ()) -> DataFrame:
    """Add running totals: ``sums`` maps each new column to the column it accumulates.

    ``order`` must be a total order within ``by`` and should be spread (distinct values or a
    unique key). The result is a table on disk, so later jobs see the same placement.
    """
    placed = stage(df.repartitionByRange(*[F.col(b).asc() for b in by], *order)
                   .withColumn("_slice", F.spark_partition_id()), "ordered")
    whole = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice (and per `by` value in it): small whatever the size of df.
    before = (placed.groupBy(*by, "_slice")
              .agg(*[F.sum(src).alias(f"_t_{src}") for src in set(sums.values())])
              .select(*by, "_slice", *[F.coalesce(F.sum(f"_t_{src}").over(whole), F.lit(0)).alias(f"_b_{src}")
                                       for src in set(sums.values())]))
    inside = (Window.partitionBy(*by, "_slice").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (join_on(placed.withColumns({new: F.sum(src).over(inside) for new, src in sums.items()}), before, [*by, "_slice"])
            .withColumns({new: F.col(new) + F.col(f"_b_{src}") for new, src in sums.items()})
            .drop("_slice", *[f"_b_{src}" for src in set(sums.values())]))


def row_numbers(df: DataFrame, order: Sequence[Column], out: str = "rn",
                by: Sequence[str] = ()) -> DataFrame:
    """1..n in a total order, per ``by`` group, whatever the size of a group."""
    one = df.withColumn("_one", F.lit(1).cast("bigint"))
    return prefix_sums(one, order, {out: "_one"}, by).drop("_one")


def _long_values(df: DataFrame, columns: Mapping[str, Column], keep: Sequence[str]) -> DataFrame:
    """One row per (row, named column)."""
    items = F.array(*[F.struct(F.lit(n).alias("_name"), c.cast("double").alias("_value"))
                      for n, c in columns.items()])
    return df.select(*keep, F.inline(items))


def _value_ranks(values: DataFrame, by: Sequence[str], weight: str | None = None) -> DataFrame:
    """(by, _name, _value, _n, _upto): distinct values, their counts and running counts."""
    size = F.count("*") if weight is None else F.sum(weight)
    counts = values.groupBy(*by, "_name", "_value").agg(size.alias("_n"))
    return prefix_sums(counts, [F.col("_value").asc()], {"_upto": "_n"}, [*by, "_name"])


def percentile_ranks(df: DataFrame, key: str, columns: Mapping[str, tuple[Column, int]]) -> DataFrame:
    """Average-tie percentile ranks: (key, one column per entry).

    ``columns`` maps the output to (column without nulls, direction). Direction +1 gives
    rank / n; -1, for "lower is better", gives 1 - rank / n + 1 / n.
    """
    values = _long_values(df, {n: c for n, (c, _) in columns.items()}, [key])
    ranks = _value_ranks(values, [])
    # One row per output column.
    totals = F.broadcast(ranks.groupBy("_name").agg(F.max("_upto").alias("_total")))
    up = [n for n, (_, d) in columns.items() if d > 0]
    share = (F.col("_upto") - (F.col("_n") - 1) / 2) / F.col("_total")
    pct = (ranks.join(totals, "_name")
           .select("_name", "_value",
                   F.when(F.col("_name").isin(*up) if up else F.lit(False), share)
                   .otherwise(1 - share + 1 / F.col("_total")).alias("_pct")))
    return (values.join(pct, ["_name", "_value"]).groupBy(key)
            .agg(*[F.max(F.when(F.col("_name") == n, F.col("_pct"))).alias(n) for n in columns]))


def exact_quantiles(df: DataFrame, columns: Mapping[str, Column], probs: Sequence[float],
                    by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Linear-interpolated quantiles: (by, name, n, q) with ``q`` an array in the order of ``probs``.

    Works on value counts, so neither a hot group nor many distinct values meet in one task. With
    ``weight``, a row stands for that many equal rows.
    """
    keep = [*by, weight] if weight else by
    values = _long_values(df, columns, keep).filter(F.col("_value").isNotNull())
    ranks = _value_ranks(values, list(by), weight)
    sizes = ranks.groupBy(*by, "_name").agg(F.max("_upto").alias("_total"))

    def at(index: Column) -> Column:
        here = (F.col("_upto") - F.col("_n") <= index) & (index < F.col("_upto"))
        return F.max(F.when(here, F.col("_value")))

    aggs = []
    for i, p in enumerate(probs):
        spot = (F.col("_total") - 1) * float(p)
        aggs += [at(F.floor(spot)).alias(f"_lo{i}"), at(F.ceil(spot)).alias(f"_hi{i}")]
    cells = join_on(ranks, sizes, [*by, "_name"]).groupBy(*by, "_name", "_total").agg(*aggs)

    def interpolate(i: int, p: float) -> Column:
        spot = (F.col("_total") - 1) * float(p)
        return F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (spot - F.floor(spot))

    return cells.select(*by, F.col("_name").alias("name"), F.col("_total").alias("n"),
                        F.array(*[interpolate(i, p) for i, p in enumerate(probs)]).alias("q"))


def medians(df: DataFrame, columns: Mapping[str, Column], by: Sequence[str] = (),
            weight: str | None = None) -> DataFrame:
    """Exact medians and non-null counts: (by, <name>, <name>_n for each entry).

    A group without any value has a null median and a count of 0.
    """
    one = F.lit(1) if weight is None else F.col(weight)
    counts = df.groupBy(*by).agg(*[F.coalesce(F.sum(F.when(c.isNotNull(), one)), F.lit(0)).alias(f"{n}_n")
                                   for n, c in columns.items()])
    q = exact_quantiles(df, columns, [0.5], by, weight)
    mid = q.groupBy(*by).agg(*[F.max(F.when(F.col("name") == n, F.col("q")[0])).alias(n) for n in columns])
    if by:
        return join_on(counts, mid, list(by), "left")
    return counts.withColumns({n: mid.select(n).scalar() for n in columns})


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of a total order, for any n: whole slices are placed, none is sorted in one task."""
    return row_numbers(df, order, "_rn").filter(F.col("_rn") <= n).drop("_rn")
