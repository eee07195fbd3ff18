"""Disk and memory sizes in runtime attributes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

GIB = 1 << 30

# Size units. Binary symbols and names are exact; any other unit is
# read by its first letter as a decimal unit.
PREFIXES = ["k", "m", "g", "t", "p", "e"]
BINARY_NAMES = ["kibibyte", "mebibyte", "gibibyte", "tebibyte", "pebibyte", "exbibyte"]


def parse_disk(s: Column) -> Column:
    """First integer in the text, as GiB, in bytes. NULL when there is none."""
    return F.try_multiply(F.regexp_extract(s, r"(\d+)", 1).try_cast("bigint"), F.lit(GIB))


def parse_size(s: Column) -> Column:
    """``3.75 GB``, ``512 MiB``, ``1024`` in bytes. NULL when the text is not one number and one unit."""
    shape = r"^\s*(\d+(?:\.\d+)?)\s*([^\d]*?)\s*\z"
    number, unit = F.regexp_extract(s, shape, 1), F.lower(F.regexp_extract(s, shape, 2))
    singular = F.regexp_replace(unit, r"s+\z", "")
    factor = F.when((unit == "") | unit.startswith("b"), F.lit(1))
    for power, (prefix, name) in enumerate(zip(PREFIXES, BINARY_NAMES), start=1):
        factor = factor.when(singular.isin(prefix + "ib", name), F.lit(1024**power))
        factor = factor.when(singular.startswith(prefix), F.lit(1000**power))
    whole = F.try_multiply(number.try_cast("bigint"), factor)
    fraction = (number.try_cast("double") * factor).try_cast("bigint")
    return F.when(s.rlike(shape), F.when(number.contains("."), fraction).otherwise(whole))
