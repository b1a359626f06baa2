"""Joins in which a null key is a key like any other."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", small: bool = False) -> DataFrame:
    """Join on equal keys, nulls included; the key columns are the left side's.

    ``small`` broadcasts the right side: only for tables whose size is bounded by what they hold. Without keys
    ``right`` is one row, whose columns are added.
    """
    if not keys:
        return left.withColumns({c: right.select(c).scalar() for c in right.columns})
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in keys])
    return left.join(F.broadcast(renamed) if small else renamed, same, how).drop(*[f"_right_{k}" for k in keys])
