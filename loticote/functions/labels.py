"""Label columns: trend, market position, colour, display text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from loticote.functions import fixed_values as fixed


def band_label(
    value: Column,
    labels: Sequence[str],
    high: float = fixed.INDEX_HIGH,
    low: float = fixed.INDEX_LOW,
) -> Column:
    """(above, below, between); a NULL value counts as between."""
    above, below, between = labels
    return F.when(value > high, above).when(value < low, below).otherwise(F.lit(between))


def trend(value: Column, high: float = fixed.INDEX_HIGH, low: float = fixed.INDEX_LOW) -> Column:
    return band_label(value, fixed.TREND_LABELS, high, low)


def market_position(value: Column) -> Column:
    return band_label(value, fixed.POSITION_LABELS)


def hex_byte(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value.cast("int")), 2, "0"))


def green_to_red(ratio: Column) -> Column:
    """Colour between green (0) and red (1) as ``#rrgg33``."""
    return F.concat(F.lit("#"), hex_byte(ratio * 255), hex_byte((1 - ratio) * 255), F.lit("33"))


def thousands(value: Column) -> Column:
    return F.format_number(value, 0)
