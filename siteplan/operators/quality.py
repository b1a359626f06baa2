"""Checks on tables: violations as DataFrames, and asserting forms for load time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


def require_columns(df: DataFrame, columns: Sequence[str], source: str) -> DataFrame:
    """Raise when columns are missing; looks at the schema only."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{source}: missing columns {missing}")
    return df


def assert_codes(df: DataFrame, code: str, source: str) -> DataFrame:
    """Raise with the first five values of ``code`` that are not whole numbers; a null is one of them."""
    number = F.trim(F.col(code).cast("string")).try_cast("bigint")
    bad = [r[0] for r in df.filter(number.isNull()).select(code).orderBy(code).limit(5).collect()]
    if bad:
        raise ValueError(f"{source}: {code} must be whole numbers, found {bad}")
    return df


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def assert_key(df: DataFrame, key: Sequence[str], source: str, expected: int | None = None) -> DataFrame:
    """Raise when the key repeats or the row count is not the expected one."""
    if not duplicate_keys(df, key).isEmpty():
        raise ValueError(f"{source}: duplicate {', '.join(key)}")
    if expected is not None:
        n = df.count()
        if n != expected:
            raise ValueError(f"{source}: {n} rows, expected {expected}")
    return df


def unmatched(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``left`` without a partner."""
    return left.join(right, list(on), "left_anti")


def assert_matched(left: DataFrame, right: DataFrame, on: Sequence[str], show: str, source: str) -> None:
    """Raise with a count and the first five names when rows have no partner."""
    misses = unmatched(left, right, on)
    first = [r[0] for r in misses.select(show).orderBy(show).limit(5).collect()]
    if first:
        raise ValueError(f"{source}: {misses.count()} unmatched rows, e.g. {first}")


def difference_from_previous(df: DataFrame, key: str, order: str, value: str, out: str) -> DataFrame:
    """Change since the row before, within a key."""
    w = Window.partitionBy(key).orderBy(order)
    return df.withColumn(out, F.col(value) - F.lag(value).over(w))


def falling_steps(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Rows where a cumulative value falls."""
    return difference_from_previous(df, key, order, value, "_step").filter(F.col("_step") < 0).drop("_step")


def violation_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row: for each rule, the number of rows where it holds."""
    return df.agg(*[F.coalesce(F.count_if(rule), F.lit(0)).alias(name) for name, rule in rules.items()])


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: nulls per column."""
    return violation_counts(df, {c: F.col(c).isNull() for c in columns})


def label_mismatches(panel: DataFrame, last_label_year: int) -> DataFrame:
    """One row: labels that disagree with the next year's outcome or with their definition."""
    after = panel.select("fips", (F.col("year") - 1).alias("year"), F.col("new_large_sites_t").alias("after"))
    both = panel.join(after, ["fips", "year"], "left")
    return violation_counts(both, {
        "a_not_next_year": F.col("y_new_site").isNotNull()
        & (F.col("y_new_site") != F.when(F.col("after") > 0, 1.0).otherwise(0.0)),
        "a_not_binary": F.col("y_new_site").isNotNull() & ~F.col("y_new_site").isin(0.0, 1.0),
        "b_where_site_exists": F.col("y_first_site").isNotNull() & (F.col("large_sites") != 0),
        "label_after_last_year": (F.col("year") > last_label_year)
        & (F.col("y_new_site").isNotNull() | F.col("y_first_site").isNotNull()),
    })


def write_checked(df: DataFrame, path: str, rules: Mapping[str, Column], keys: Sequence[str] = ()) -> tuple[DataFrame, dict[str, int]]:
    """Write ``df`` as Parquet and count, for each rule, the rows where it holds, in the job that writes: (the table, counts).

    The counts are taken right below the write, so that no later stage can repeat them. ``keys`` are columns whose nulls are
    counted too, as ``null_<column>``.
    """
    seen = Observation("written")
    nulls = {f"null_{c}": F.col(c).isNull() for c in keys}
    counts = [F.coalesce(F.count_if(rule), F.lit(0)).alias(name) for name, rule in {**rules, **nulls}.items()]
    df.observe(seen, *counts).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), {k: int(v) for k, v in seen.get.items()}
