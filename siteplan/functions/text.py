"""String columns: keys, names, flags, dates and prices in free text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def padded_code(c: Column, width: int) -> Column:
    """Numeric code as text with leading zeros; text that is no number gives null."""
    return F.lpad(F.trim(c.cast("string")).try_cast("bigint").cast("string"), width, "0")


def strip_leading(c: Column, char: str) -> Column:
    """Drop every leading ``char``."""
    return F.ltrim(c, F.lit(char))


def normal_name(c: Column, aliases: Mapping[str, str] | None = None) -> Column:
    """Join key that ignores case and spaces; ``aliases`` are replacements on the result."""
    out = F.replace(F.lower(c), F.lit(" "), F.lit(""))
    for old, new in (aliases or {}).items():
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def contains_ci(c: Column, part: str) -> Column:
    """Case-insensitive substring test; null text is false."""
    return F.coalesce(F.contains(F.upper(c), F.lit(part.upper())), F.lit(False))


def in_list(c: Column, values: list) -> Column:
    """Membership that is false for null."""
    return F.coalesce(c.isin(*values), F.lit(False))


def not_in_list(c: Column, values: list) -> Column:
    """Negated membership that keeps null rows."""
    return ~in_list(c, values)


def lenient_date(c: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Date of the first ten characters; invalid text gives null."""
    return F.to_date(F.try_to_timestamp(F.substring(c, 1, 10), F.lit(fmt)))


# The price pattern and the plausible range in dollars per kWh.
PRICE_PATTERN = r"(?i)\$\s*(\d+(?:\.\d+)?)\s*(?:/|per)\s*kwh"
PRICE_RANGE = (0.05, 1.5)


def price_per_kwh(c: Column, low: float = PRICE_RANGE[0], high: float = PRICE_RANGE[1]) -> Column:
    """First dollar-per-kWh price in the text, null if absent or outside [low, high]."""
    return range_gate(F.regexp_extract(c, PRICE_PATTERN, 1).try_cast("double"), low, high)


def range_gate(c: Column, low: float, high: float) -> Column:
    """Null outside the closed range."""
    return F.when(c.between(low, high), c)
