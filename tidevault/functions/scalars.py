"""Small column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EXACT = "decimal(38,12)"


def ratio_rounded(total: Column, count: Column, digits: int) -> Column:
    """``total / count`` rounded half away from zero, once.

    ``avg`` of a decimal is already rounded to its own scale, so rounding it again
    can move a figure; dividing the exact sum avoids that.
    """
    return F.round(total.cast(_EXACT) / count, digits)


def avg_rounded(value: Column | str, digits: int) -> Column:
    """Average of a decimal or integer column, nulls skipped, rounded once."""
    value = F.col(value) if isinstance(value, str) else value
    return ratio_rounded(F.sum(value), F.count(value), digits)


def pretty_bytes(size: Column | str) -> Column:
    """A size in readable units; the unit goes up at ten thousand and some of the smaller one."""
    size = F.col(size) if isinstance(size, str) else size
    label = F.concat(size.cast("string"), F.lit(" bytes"))
    for power, unit in enumerate(("kB", "MB", "GB", "TB", "PB"), start=1):
        scaled = F.round(size / F.lit(1024**power)).cast("long")
        label = F.when(
            size < 10 * 1024**power, label
        ).otherwise(F.concat(scaled.cast("string"), F.lit(f" {unit}")))
    return label
