"""Byte sizes and progress figures."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Unit names in ascending order.
UNITS = ("B", "KB", "MB", "GB", "TB", "PB")


def human_bytes(size: Column, base: int = 1024) -> Column:
    """One decimal and a unit, e.g. '1.5 KB'; everything past the last unit stays in it."""
    value = size.cast("double")
    text = None
    for power, unit in enumerate(UNITS):
        scaled = F.concat(
            F.call_function("format_number", value / F.lit(float(base) ** power), F.lit("0.0")), F.lit(" " + unit)
        )
        if power == len(UNITS) - 1:
            return text.otherwise(scaled)
        fits = value < F.lit(float(base) ** (power + 1))
        text = F.when(fits, scaled) if text is None else text.when(fits, scaled)


def remaining_percentage(done: Column, total: Column) -> Column:
    """Share still to come, in percent with two decimals; 0 when there is no total."""
    return F.when(total > 0, F.bround((total - done) / total * 100, 2)).otherwise(F.lit(0.0))
