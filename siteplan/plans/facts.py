"""Small tables of facts about the data: totals, label counts, reconciliation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def market_by_year(panel: DataFrame) -> DataFrame:
    return panel.groupBy("year").agg(F.sum("dcfc_ports").alias("dcfc_ports"), F.sum("large_sites").alias("large_sites"))


def new_large_by_year(stations: DataFrame, first: int, last: int) -> DataFrame:
    return (stations.filter(F.col("is_large") & F.col("open_year").between(first, last))
            .groupBy("open_year").agg(F.count("*").alias("n")))


def base_rates(panel: DataFrame) -> DataFrame:
    """Label means per year in percent; years without labels give null."""
    return panel.groupBy("year").agg((F.avg("y_new_site") * 100).alias("a_pct"), (F.avg("y_first_site") * 100).alias("b_pct"))


def label_counts(panel: DataFrame) -> DataFrame:
    return panel.groupBy("year").agg(
        F.count("y_new_site").alias("a_n"), F.coalesce(F.sum("y_new_site"), F.lit(0.0)).cast("bigint").alias("a_pos"),
        F.count("y_first_site").alias("b_n"), F.coalesce(F.sum("y_first_site"), F.lit(0.0)).cast("bigint").alias("b_pos"))


def frequencies(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def fact_rows(df: DataFrame, facts: Mapping[str, Column]) -> DataFrame:
    """(fact, value): several aggregates of one table, in one pass."""
    wide = df.agg(*[c.cast("double").alias(n) for n, c in facts.items()])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(n).alias("fact"), F.col(n).alias("value")) for n in facts])))


def count_facts(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """(fact, value): one fact per value of a column."""
    return df.groupBy(column).agg(F.count("*").cast("double").alias("value")).select(
        F.concat(F.lit(prefix), F.col(column).cast("string")).alias("fact"), "value")
